"""Centroid clustering, hard negatives and winnowing against brute force."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from evidex.llm import centroids, negatives, winnowing

NAN, INF = float("nan"), float("inf")


# Centroid clustering


def plain_clusters(rows, k, rounds, dim, scale, seed="2:"):
    """(id, vector) rows with Python's own integers and a distance to every centroid."""
    kept = [(i, v) for i, v in rows if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    cells = [(i, [int(np.floor(scale * x)) for x in v]) for i, v in kept]
    named = sorted((hashlib.sha256(f"{seed}{i}".encode()).hexdigest(), v, c) for (i, v), (_, c) in zip(kept, cells) if i is not None)
    centers = [c for _, _, c in named[:k]]

    def nearest(c):
        return min((sum((x - y) ** 2 for x, y in zip(c, m)), n) for n, m in enumerate(centers))

    for _ in range(rounds):
        groups = {}
        for _, c in cells:
            groups.setdefault(nearest(c)[1], []).append(c)
        for n, members in groups.items():
            centers[n] = [sum(x) // len(members) for x in zip(*members)]
    found = [(i, *nearest(c)[::-1]) for i, c in cells]
    inertia = {n: sum(d for _, m, d in found if m == n) for _, n, _ in found}
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted(((i, n, d, inertia[n], sum(inertia.values()), shas[n]) for i, n, d in found), key=str)


def cluster_rows(dim=4):
    rng = np.random.default_rng(11)
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(60, dim)))]
    rows += [(100 + i, [0.25, -0.5, 0.0, 1.0]) for i in range(40)]  # copies: a third of all rows
    rows += [(1, rows[0][1]), (1, rows[0][1]), (None, rows[5][1]), (None, None), (200, None), (201, []), (202, [1.0]), (203, [NAN] * dim)]
    return rows + [(204, [None] * dim), (205, [INF, 0.0, 0.0, 0.0]), (206, [0.0] * dim), (207, [-0.0] * dim)]


CLUSTER_SCHEMA = "vec_id long, embedding array<double>, cluster int, id string, v int, cells string"


@pytest.mark.parametrize("k, rounds", [(1, 2), (7, 5), (200, 3)])
def test_clusters_equal_brute_force(spark, k, rounds):
    rows = cluster_rows()
    df = spark.createDataFrame([(*r, 9, "clash", 1, "c") for r in rows], CLUSTER_SCHEMA).repartition(5)
    found = centroids.cluster_vectors(df, k=k, rounds=rounds, dim=4, scale=16.0)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == plain_clusters(rows, k, rounds, 4, 16.0)


def test_no_vectors_no_clusters(spark):
    empty = spark.createDataFrame([], CLUSTER_SCHEMA)
    nameless = spark.createDataFrame([(None, [1.0] * 4, 1, "x", 1, "c")], CLUSTER_SCHEMA)
    for df in (empty, nameless):
        found = centroids.cluster_vectors(df, k=3, rounds=2, dim=4)
        assert found.count() == 0
        assert dict(found.dtypes)["distance"] == "bigint"


def test_huge_finite_components_are_held(spark):
    rows = [(1, [1e300, 0.0]), (2, [-1e300, 0.0]), (3, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r.vec_id: r for r in centroids.cluster_vectors(df, k=3, rounds=1, dim=2).collect()}
    assert sorted(found) == [1, 2, 3] and all(r.distance == 0 for r in found.values())


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.integers(1, 5), st.integers(0, 2**32 - 1), st.sampled_from([2, 300, centroids.cell_limit(5)]))
def test_sign_tests_find_the_nearest(k, dim, seed, size):
    rng = np.random.default_rng(seed)
    centers, cells = rng.integers(-size, size + 1, (k, dim)), rng.integers(-size, size + 1, (50, dim))
    exact = [[sum((int(x) - int(y)) ** 2 for x, y in zip(c, m)) for m in centers] for c in cells]
    tournament = centroids.Tournament(centers)
    nearest = tournament.nearest(cells)
    assert nearest.tolist() == [d.index(min(d)) for d in exact]
    assert tournament.distances(cells, nearest).tolist() == [min(d) for d in exact]


# Hard negatives


def plain_negatives(rows, anchors, scale, k_pos=5, k_neg=10, low=30, high=90):
    def usable(r):
        return None not in r and all(x is not None and np.isfinite(x) for x in r[2])

    cells = [(i, lab, [int(np.floor(scale * x)) for x in v]) for i, lab, v in rows if usable((i, lab, v))]
    once = {}
    for i, lab, v in filter(usable, anchors):
        once[i] = min(once.get(i, (lab, v)), (lab, v))
    out = []
    for a, (lab, v) in once.items():
        c = [int(np.floor(scale * x)) for x in v]
        scored = sorted((-sum(x * y for x, y in zip(c, w)), i, other) for i, other, w in cells if i != a and len(w) == len(c))
        for s, p, _ in [x for x in scored if x[2] == lab][:k_pos]:
            inside = [(n, -t) for t, n, other in scored if other != lab and low * -s <= 100 * -t <= high * -s]
            out += [(a, p, r, n, -s, t) for r, (n, t) in enumerate(inside[:k_neg], 1)]
    return sorted(out)


def labelled_rows():
    rng = np.random.default_rng(5)
    rows = [(int(i), int(rng.integers(0, 3)), [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(90, 3)) + 0.4)]
    rows += [(100 + i, 1, [1.0, 0.5, 0.25]) for i in range(30)]  # copies with one label
    rows += [(200 + i, 2, [0.5, 0.25, 0.125]) for i in range(20)]  # ties inside many windows
    rows += [(300, 0, [0.0, 0.0, 0.0]), (301, 0, [0.0, 0.0, 0.0]), (302, 1, [0.0, 0.0, 0.0])]  # scores of zero
    rows += [(10, 1, rows[10][2]), (10, 1, rows[10][2]), (20, 2, rows[3][2])]  # repeated ids, some of them anchors
    return rows + [(None, 1, [1.0] * 3), (400, None, [1.0] * 3), (410, 1, None), (420, 1, [NAN] * 3), (430, 1, [None] * 3), (440, 1, [1.0]), (450, 2, []), (460, 2, [])]


NEGATIVE_SCHEMA = "vec_id long, label long, embedding array<double>, anchor int, rank string, key string, part int"


@pytest.mark.parametrize("tiles", [(1024, 8192, 16), (3, 5, 2)])
def test_negatives_equal_brute_force(spark, tiles, monkeypatch):
    for name, value in zip(("ANCHORS_PER_BLOCK", "ROWS_PER_SHARD", "SHARDS_PER_GROUP"), tiles):
        monkeypatch.setattr(negatives, name, value)
    rows = labelled_rows()
    df = spark.createDataFrame([(*r, 1, "x", "y", 2) for r in rows], NEGATIVE_SCHEMA).repartition(4)
    found = negatives.mine_negatives(df, df.filter(F.col("vec_id") % 10 == 0), scale=8.0)
    wanted = plain_negatives(rows, [r for r in rows if r[0] is not None and r[0] % 10 == 0], 8.0)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, found.collect())) == wanted and len(wanted) > 100


def test_no_anchors_and_no_rows_give_no_negatives(spark):
    df = spark.createDataFrame([(1, 1, [1.0, 2.0], 1, "x", "y", 2)], NEGATIVE_SCHEMA)
    empty = df.limit(0)
    assert [negatives.mine_negatives(*pair).count() for pair in ((df, df), (df, empty), (empty, df), (empty, empty))] == [0] * 4


def test_huge_scores_stay_whole_numbers(spark):
    rows = [(1, 0, [1e300]), (2, 0, [1e300]), (3, 1, [-1e300]), (4, 1, [2.0**20])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    found = negatives.mine_negatives(df, df.filter("vec_id = 1"), low=0, high=90, scale=1.0).collect()
    assert [(r.positive_id, r.negative_id, r.positive_score, r.negative_score) for r in found] == [(2, 4, 2**60, 2**50)]


@given(st.lists(st.tuples(*[st.integers(-(2**63), 2**63 - 1)] * 2, st.integers(0, 1), st.integers(-(2**63), 2**63 - 1)), min_size=1, max_size=20))
def test_keys_sort_by_anchor_falling_score_kind_and_id(found):
    keys = [negatives.pack_keys(*(np.array([x], np.int64) for x in (a, s)), kind, np.array([i], np.int64)).tobytes() for a, s, kind, i in found]
    assert [negatives.unpack_key(k) for k in keys] == found
    assert [negatives.unpack_key(k) for k in sorted(keys)] == sorted(found, key=lambda x: (x[0], -x[1], x[2], x[3]))


# Winnowing


def plain_hashes(text, run):
    """The rolling hash by its definition: a polynomial of the code points modulo 2^64, then mixed."""
    out = []
    for i in range(len(text) - run + 1):
        h = 0
        for c in text[i : i + run]:
            h = (h * winnowing.BASE + ord(c) + 1) % 2**64
        out.append(int(winnowing.mix64(np.array([h], np.uint64))[0]))
    return out


def plain_winnow(text, run, window):
    if not text:
        return []
    hashes = plain_hashes(text, run)
    if not hashes:
        return None
    chosen = set()
    for s in range(max(1, len(hashes) - window + 1)):
        part = hashes[s : s + window]
        smallest = min(h >> 32 for h in part)
        chosen.add(s + max(i for i, h in enumerate(part) if h >> 32 == smallest))
    return [(hashes[i], i) for i in sorted(chosen)]


def winnow(winnower, text):
    hashes, places = winnower.of(text)
    return list(zip(hashes.tolist(), places.tolist()))


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="ab é😀\n", max_size=120), st.integers(1, 8), st.integers(1, 12))
def test_winnowing_equals_its_definition(text, run, window):
    found = winnow(winnowing.Winnower(run, window), text)
    wanted = plain_winnow(text, run, window)
    assert found == wanted if wanted is not None else len(found) == 1 and found[0][1] == 0


def test_blocks_of_long_texts_do_not_show(monkeypatch):
    monkeypatch.setattr(winnowing, "BLOCK", 50)
    rng = np.random.default_rng(1)
    for n in (50, 51, 99, 100, 101, 137, 400):
        text = "".join(rng.choice(list("abcd"), n))
        assert winnow(winnowing.Winnower(5, 9), text) == plain_winnow(text, 5, 9)


def test_shared_passages_share_a_hash_inside():
    """The guarantee: a run of window + k - 1 code points that two texts share shares a chosen hash within it."""
    rng = np.random.default_rng(2)
    winnower = winnowing.Winnower(6, 10)
    for _ in range(200):
        shared = "".join(rng.choice(list("abc"), 15))
        a, b = ("".join(rng.choice(list("abc"), rng.integers(0, 40))) for _ in range(2))
        inside = []
        for before in (a, b):
            text = before + shared + before[::-1]
            inside.append({(h, p - len(before)) for h, p in winnow(winnower, text) if len(before) <= p <= len(before) + 9})
        assert inside[0] & inside[1]


def test_chosen_positions_are_at_most_a_window_apart():
    rng = np.random.default_rng(3)
    text = "".join(rng.choice(list("abcdefgh "), 5000)) + "x" * 500
    places = winnowing.Winnower().of(text)[1]
    assert np.diff(places).max() <= winnowing.WINDOW and places[0] < winnowing.WINDOW
    # Ties go to the rightmost: in a run of one letter every window moves on by one.
    assert np.diff(places)[-300:].max() == 1


def plain_edits(rows, run, window):
    """(id, text) rows in the operator's order, each against the next."""
    winnower = winnowing.Winnower(run, window)
    out = []
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        own, changed, other = (winnower.of(t) for t in (text, edited, following))
        sets = [set(x[0].tolist()) for x in (own, changed, other)]
        near = [len(sets[0] & s) / len(sets[0] | s) if sets[0] | s else 1.0 for s in sets[1:]]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), winnowing.as_text(*own), winnowing.as_text(*changed), *near))
    return sorted(out, key=str)


EDIT_SCHEMA = "doc_id long, text string, part int, hash string, place int, end boolean"


def edit_rows():
    rng = np.random.default_rng(4)
    texts = ["", None, "a", "ab", "abc", " \n\t ", "é😀" * 30, "x" * 3000, "one two three " * 40, "one two three " * 40]
    texts += [" ".join(rng.choice(["the", "of", "Réé", "x.", "12"], rng.integers(0, 90))) for _ in range(40)]
    return [(int(i) * 7 % 101 - 20, t) for i, t in enumerate(texts)]


def test_edits_equal_brute_force(spark):
    rows = edit_rows()
    df = spark.createDataFrame([(*r, 1, "clash", 2, True) for r in rows], EDIT_SCHEMA).repartition(6)
    found = sorted(map(tuple, winnowing.compare_edits(df, 5, 8).collect()), key=str)
    assert found == plain_edits(sorted(((i, t or "") for i, t in rows), reverse=True), 5, 8)


def test_edits_of_repeated_and_null_ids(spark):
    rows = [(5, "same text " * 9)] * 30 + [(5, "another " * 12), (None, "no id at all " * 5), (None, None), (9, "nine " * 20)]
    df = spark.createDataFrame([(*r, 1, "clash", 2, True) for r in rows], EDIT_SCHEMA).repartition(6)
    hashes = {r.text: r.h for r in df.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashes[r[1]]), reverse=True)
    found = sorted(map(tuple, winnowing.compare_edits(df, 5, 8).collect()), key=str)
    assert found == plain_edits([(i, t or "") for i, t in ordered], 5, 8)


def test_one_document_is_its_own_next_and_none_gives_none(spark):
    one = spark.createDataFrame([(1, "only one document here", 1, "x", 2, True)], EDIT_SCHEMA)
    row = winnowing.compare_edits(one).collect()
    assert len(row) == 1 and row[0].near_next == 1.0 and row[0].n_chars == 22
    assert row[0].edited_sha256 == hashlib.sha256(b"only one documeonly on"[:15] + b"only on").hexdigest()
    assert winnowing.compare_edits(one.limit(0)).count() == 0


def test_fingerprints_keep_hashes_and_positions(spark):
    rows = edit_rows() + [(1, "twice " * 30), (1, "twice " * 30), (None, "x")]
    df = spark.createDataFrame([(*r, 1, "clash", 2, True) for r in rows], EDIT_SCHEMA)
    found = sorted(((r.doc_id, r.n_chars, [(e.hash % 2**64, e["at"]) for e in r.fingerprint]) for r in winnowing.fingerprints(df, 5, 8).collect()), key=str)
    assert found == sorted(((i, len(t or ""), winnow(winnowing.Winnower(5, 8), t or "")) for i, t in rows), key=str)
    assert winnowing.fingerprints(df.limit(0)).count() == 0


def test_hex_form_reads_back():
    hashes, places = winnowing.Winnower(5, 8).of("some text of some length, with a few words")
    again = winnowing.from_text(winnowing.as_text(hashes, places))
    assert (again[0] == hashes).all() and (again[1] == places).all()
