"""Names of a dictionary in texts: the same as one pattern per name."""

import random
import re

import pytest
from pyspark.sql import functions as F

from evidex.operators.dictionary import MAX_WORDS, _cores, name_match, name_mentions
from evidex.operators.validators import mentions_any


def by_pattern(texts, names):
    found = set()
    for i, t in texts:
        for n in {n.lower() for n in names if n and re.search("[a-z0-9]", n.lower())}:
            if t is not None and re.search(f"(^|[^a-z0-9]){re.escape(n)}([^a-z0-9]|$)", t.lower()):
                found.add((i, n))
    return found


def test_names_equal_a_pattern_each(spark):
    """Signs inside and around names, ends of texts, repeats, clashing columns, nulls, blanks and a very long text."""
    rng = random.Random(5)
    words, gaps = ["ab", "a", "b2", "Ab", "é", "c", "x9"], [" ", "-", "+ ", "++", " .", "\n"]

    def made(n):
        return "".join(rng.choice(words) + rng.choice(gaps) for _ in range(n))

    names = ["a", "AB", "ab-a", "c++", ".net", "+a+", "a b2", "ab a c", "é", "++", "", " ", None, "a", "-a", "x9\nc", "++a++"]
    names += [made(rng.randint(1, 3)).strip() for _ in range(300)]
    texts = [(i, made(rng.randint(0, 12))) for i in range(150)]
    texts += [(150, None), (151, ""), (152, " +-"), (153, "c++"), (154, "xc++ c++x"), (155, "+a+"), (156, "x+a+"), (157, "++a++"), (1, "c"), (158, made(20_000))]
    df = spark.createDataFrame([(*t, "core", 1) for t in texts], "id int, body string, name string, n_words int").repartition(4)
    known = spark.createDataFrame([(n,) for n in names], "name string")
    got = [tuple(r) for r in name_mentions(df, known, "id", "body").collect()]
    assert len(got) == len(set(got)) and set(got) == by_pattern(texts, names)
    assert name_mentions(df, known.limit(0), "id", "body").collect() == []
    assert name_mentions(df.limit(0), known, "id", "body").collect() == []


def test_too_long_a_name_is_an_error(spark):
    known = spark.createDataFrame([("a " * (MAX_WORDS + 1),)], "name string")
    with pytest.raises(ValueError):
        name_mentions(spark.createDataFrame([(1, "a")], "id int, text string"), known, "id", "text")


def test_the_rule_equals_one_pattern_of_all_words(spark):
    rows = [(1, "A red bolt."), (2, "bolts"), (3, None), (4, ""), (5, "Widget"), (None, "bolt")]
    df = spark.createDataFrame(rows, "id int, text string")
    known = spark.createDataFrame([("bolt",), ("widget",)], "name string")
    got = {r.item_id: r.result_bool for r in name_match(df, known, "text", "rule", "id", cap=None).collect() if r.item_id}
    wanted = df.filter("id is not null").select(F.col("id").cast("string"), mentions_any("text", ("bolt", "widget"))).collect()
    assert got == {r[0]: r[1] for r in wanted}


def test_work_does_not_grow_with_names_times_texts(spark):
    """One equality join: no nested loop, and no expression that names every name."""
    texts = spark.range(100).select("id", F.lit("a b c").alias("text"))
    known = spark.range(2_000).select(F.concat(F.lit("name "), F.col("id").cast("string")).alias("name"))
    plan = name_mentions(texts, known, "id", "text")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and len(plan) < 40_000


def test_what_a_text_repeats_is_sent_once(spark):
    """Names without signs meet distinct runs without surroundings: before, 2,000 words gave 3,999 wide rows here."""
    df = spark.createDataFrame([(1, "ab cd " * 1000), (2, ""), (3, None), (4, "--Ab,cd\n")], "id int, text string")
    parts = F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]+|[^a-z0-9]+"), 0)
    got = {r[0]: r[1] for r in df.filter("id in (1, 4)").select("id", _cores(parts, [1, 2])).collect()}
    assert {k: sorted(v) for k, v in got.items()} == {1: ["ab", "ab cd", "cd", "cd ab"], 4: ["ab", "ab,cd", "cd"]}
    known = spark.createDataFrame([("ab cd",), ("cd",), ("ab,CD",), ("-ab",), ("x",)], "name string")
    rows = sorted(tuple(r) for r in name_mentions(df, known, "id", "text").collect())
    assert rows == [(1, "ab cd"), (1, "cd"), (4, "-ab"), (4, "ab,cd"), (4, "cd")]
    plain = name_mentions(df, known.filter("name != '-ab'"), "id", "text")._jdf.queryExecution().optimizedPlan().toString()
    assert "before" not in plain and "begins" not in plain
