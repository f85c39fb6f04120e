from datetime import date

import pytest
from pyspark.sql import functions as F

from evidex.functions import scalars as S
from evidex.functions.tokens import tokens
from evidex.operators.groups import topk_per_group
from evidex.operators.sampling import cap_per_key, hash_sample


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first().y


@pytest.mark.parametrize("value,wanted", [(None, None), (-0.1, 0.0), (1.7, 1.0), (0.65, 0.65)])
def test_clamp(spark, value, wanted):
    assert one(spark, S.clamp01("x"), value, "double") == wanted


@pytest.mark.parametrize(
    "value,wanted",
    [("2024-02-29", date(2024, 2, 29)), ("2024-02-30", None), ("2024-1-5", None), ("bad", None), (None, None), ("", None)],
)
def test_safe_date(spark, value, wanted):
    assert one(spark, S.safe_date("x"), value) == wanted


def test_snippet(spark):
    assert one(spark, S.snippet("x", 6), 'ä\r\nb"cd') == 'ä  b"c'
    assert one(spark, S.snippet("x", 6, strip_quotes=True), 'ä\r\nb"cd') == "ä  b c"
    assert one(spark, S.snippet("x"), "") == ""
    assert len(one(spark, S.snippet("x"), "é" * 500)) == 240


@pytest.mark.parametrize("value,wanted", [("a -12.5 b 7", -12.5), ("none", None), ("3.", 3.0), (None, None)])
def test_first_number(spark, value, wanted):
    assert one(spark, S.first_number("x"), value) == wanted


def test_predicate_is_true_without_constraints(spark):
    df = spark.range(5)
    assert df.filter(S.predicate([])).count() == 5
    assert df.filter(S.predicate([("TRUE", "=", 0)])).count() == 5
    assert df.filter(S.predicate([("id", ">=", 2), ("id", "!=", 3)])).count() == 2


def test_keep_allowed_keeps_order_and_repeats(spark):
    df = spark.createDataFrame([(["c", "a", "x", "a"], ["a", "c"])], "i array<string>, a array<string>")
    assert df.select(S.keep_allowed(F.col("i"), F.col("a"))).first()[0] == ["c", "a", "a"]


def test_hybrid_score(spark):
    df = spark.createDataFrame([(0.5, True), (0.5, None), (0.5, False)], "similarity double, constraints_ok boolean")
    assert [round(r[0], 9) for r in df.select(S.hybrid_score()).collect()] == [0.5, 0.3, 0.3]
    more = df.select(S.hybrid_score(recency=1.0, pass_rate=0.5)).first()[0]
    assert round(more, 9) == 0.65


def test_variants_split_and_stay(spark):
    df = spark.range(4000).select(F.col("id").cast("string").alias("q"))
    counts = {r.v: r["count"] for r in df.groupBy(S.ab_variant("q").alias("v")).count().collect()}
    assert set(counts) == set(S.ANSWER_VARIANTS) and abs(counts["answer_v1"] - 2000) < 150
    assert df.filter(S.ab_variant("q", 0.0) == "answer_v1").count() == 0
    assert df.filter(S.ab_variant("q", 1.0) == "answer_v2").count() == 0


def test_tokens(spark):
    assert one(spark, tokens("x"), "Été, 12.5 a_b") == ["été", "12", "5", "a", "b"]
    assert one(spark, tokens("x"), "--") == []


def test_sample_is_monotone(spark):
    df = spark.range(2000).select(F.col("id"))
    kept = [{r.id for r in hash_sample(df, "id", f).collect()} for f in (0.1, 0.25, 0.6)]
    assert kept[0] < kept[1] < kept[2] and abs(len(kept[1]) - 500) < 80
    assert hash_sample(df, "id", None).count() == hash_sample(df, "id", 0).count() == 2000
    assert hash_sample(df, "id", 1.0).count() == 2000


def test_hot_key_gives_the_same_groups_with_and_without_salt(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 200).cast("string"))).alias("key"),
        F.xxhash64("id").alias("x"), "id",
    ).repartition(7)
    order = [F.col("x"), F.col("id")]
    plain = topk_per_group(df, ["key"], order, 5)
    salted = topk_per_group(df, ["key"], order, 5, salt_by=F.col("id"), salts=4)
    assert sorted(plain.collect()) == sorted(salted.collect())
    assert plain.filter("key = 'hot'").count() == 5


def test_cap_trims_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("key"), "id")
    capped = cap_per_key(df, "key", 5, ["id"])
    assert capped.count() == 50
    plan = capped._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
