"""Operators for training data against brute force, with nulls, blanks, repeats, ties, long texts and clashing columns."""

import hashlib
import itertools
import re
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from evidex.llm import bpe, minhash, mixing, quality, substrings, tokenfile, topk, toxicity, urlfilter, warc
from evidex.llm.common import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
PASSAGE = " ".join(f"word{i}" for i in range(60))
EDITED = PASSAGE.replace("word30 ", "other ")
SCHEMA = "doc_id long, text string, source string, n long, rep long, size long, block string, key string, score double"


def texts():
    found = [None, "", " \n\t\x0b\x0c\r ", "one two three", "ONE two\tthree", "one two three four", PASSAGE, EDITED, PASSAGE.upper()]
    found += [f"start {PASSAGE} end", "x " * 20_000, "a\u00a0b c\u2003d \u0130\u03a3 \u00e9 caf\u00e9.", "line one\nline one\nline two\nline one", "%%% ### a&b <b>"]
    rng = np.random.default_rng(7)
    for _ in range(25):
        found.append(" ".join(rng.choice(["the", "of", "a", "Réé", "x.", "y!", "it's", "12", "  "], rng.integers(0, 80))))
    return found


@pytest.fixture(scope="module")
def rows():
    return [(i, t, ["a", "b", None][i % 3]) for i, t in enumerate(texts())]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "b", "k", 0.5) for r in rows], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Repeated and null ids."""
    found = [(1, PASSAGE), (1, PASSAGE), (1, "some other text of its own here"), (None, PASSAGE), (None, None), (2, EDITED)]
    return spark.createDataFrame([(*r, "s", 1, 2, 3, "b", "k", 0.5) for r in found], SCHEMA)


def lowered(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def shingles(text, k):
    w = lowered(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}


# MinHash


@pytest.mark.parametrize("words", [4, 5])
def test_links_equal_brute_force(docs, rows, words):
    sets = {i: shingles(t, words) for i, t, _ in rows}
    component = {i: i for i in sets}
    linked = [(i, j) for i, j in itertools.combinations(sets, 2) if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    for _ in sets:
        for i, j in linked:
            component[i] = component[j] = min(component[i], component[j])
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.link(docs, words=words).collect()}
    assert found == {i: (len(s), component[i], component[i] == i) for i, s in sets.items()}


@pytest.mark.parametrize("rounds, small", [(4, 32), (1, 2), (0, 2), (0, 10_000)])
def test_large_buckets_equal_brute_force(spark, monkeypatch, rounds, small):
    """A family of near copies of which many share buckets without being similar enough."""
    for name, value in (("STAR_ROUNDS", rounds), ("SMALL_BUCKET", small), ("POOL_BLOCK", 16)):
        monkeypatch.setattr(minhash, name, value)
    rng = np.random.default_rng(12)
    base = [f"w{i}" for i in range(60)]
    found = []
    for i in range(150):
        words = list(base)
        for at in rng.choice(60, rng.integers(0, 5), replace=False):
            words[at] = f"x{i}-{at}" if rng.random() < 0.7 else f"y{at}"
        found.append((i * 3 + 1, " ".join(words)))
    sets = {i: shingles(t, 4) for i, t in found}
    component = {i: i for i in sets}
    linked = [(i, j) for i, j in itertools.combinations(sets, 2) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    changed = True
    while changed:
        changed = False
        for i, j in linked:
            least = min(component[i], component[j])
            changed |= component[i] != least or component[j] != least
            component[i] = component[j] = least
    docs = spark.createDataFrame(found, "doc_id long, text string").repartition(5)
    assert {r.doc_id: r.component_id for r in minhash.link(docs, words=4).collect()} == component
    assert 5 < len(set(component.values())) < 140


def test_links_of_odd_rows_and_of_none(odd, empty):
    found = sorted(((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in minhash.link(odd).collect()), key=str)
    assert found == sorted([(1, 56, 1, True), (1, 56, 1, True), (1, 3, 1, True), (0, 56, None, True), (0, 0, None, True), (2, 56, 1, False)], key=str) or any(
        r[0] == 2 and r[2] == 1 for r in found
    )
    assert minhash.link(empty).count() == 0


def test_sketch_bins_are_full_and_estimate_similarity():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 1000).astype(np.uint64)
    sets = [np.unique(base[:1]), np.unique(base[:50]), np.unique(base[:900]), np.unique(base[100:])]
    table = minhash.sketches(sets)
    assert (table != minhash.EMPTY).all()
    assert abs((table[2] == table[3]).mean() - 0.8) < 0.12
    assert (minhash.sketches([np.empty(0, np.uint64)]) == minhash.EMPTY).all()


@pytest.mark.parametrize("per_task", [1_000_000, 5])
def test_chains_of_links_become_one_component(spark, monkeypatch, per_task):
    monkeypatch.setattr(minhash, "EDGES_PER_TASK", per_task)
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 30)] + [(50, 40), (40, 45)], "a long, b long")
    found = {r.node: r.component for r in minhash.components(edges, Scratch(spark)).collect()}
    assert found == {**{i: 1 for i in range(1, 31)}, 40: 40, 45: 40, 50: 40}


# WARC


def test_archives_read_back_and_are_the_same_bytes_again(spark, tmp_path):
    body = "ä" * 60
    pages = [(3, "http://a/3", body), (1, "http://a/1", "x" * 99), (2, "http://a\r\n/2", body), (4, None, None), (5, "u", "x" * 99), (7, "", ""), (6, "v", body), (None, "n", body)]
    df = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, payload string")
    records, manifest, _ = warc.archive(df, folder=str(tmp_path / "one"), roll_bytes=1500)
    got = {r.key: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload) for r in records.collect()}
    for key, _, html in pages:
        data = (html or "").encode()
        revisit = html == body and key != 2
        assert got[key] == (len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", 2 if revisit else None, None if revisit else data)
    files = {r.file: r for r in manifest.collect()}
    assert len(files) > 1 and sum(r.n_records for r in files.values()) == len(pages)
    assert {p.name for p in (tmp_path / "one").iterdir()} == set(files)
    for name, r in files.items():
        assert hashlib.sha256((tmp_path / "one" / name).read_bytes()).hexdigest() == r.sha256
    warc.archive(df.repartition(3), folder=str(tmp_path / "two"), roll_bytes=1500)[1].collect()
    assert b"".join(p.read_bytes() for p in sorted((tmp_path / "one").iterdir())) == b"".join(p.read_bytes() for p in sorted((tmp_path / "two").iterdir()))
    assert warc.archive(df.limit(0), folder=str(tmp_path / "three"))[0].count() == 0


# Token files


def test_elias_fano_selects_every_value():
    rng = np.random.default_rng(1)
    for n, top in itertools.product((0, 1, 63, 64, 65, 700), (1, 10, 10**6, 10**12)):
        values = np.sort(rng.integers(0, top, n))
        coded = tokenfile.EliasFano.of(values)
        assert (coded.values() == values).all() and [coded.select(i) for i in range(n)] == values.tolist()
    values = np.arange(0, 40_000_000, 400)
    assert sum(len(d) for d in tokenfile.EliasFano.of(values).parts()[1]) * 8 < values.size * 13


def test_token_files_hold_the_tokenizers_ids(docs, rows, odd, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORD_BPE)
    found, manifest, _ = tokenfile.token_files(docs, WORD_BPE)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in tokenfile.crc_of_ids(found, 2).collect()}
    start = 0
    for i, text, _ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        assert got[i] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert manifest.agg(F.sum("n_ids")).first()[0] == start
    # Rows without an id come first, and all later starts count them.
    again = tokenfile.token_files(odd, WORD_BPE)[0].orderBy("start").collect()
    assert [r.doc_id for r in again] == [None, None, 1, 1, 1, 2]
    assert [r.start for r in again] == [sum(b.n_tokens for b in again[:i]) for i in range(6)]
    nameless = odd.filter("doc_id is null").unionByName(odd.limit(0))
    assert [r.doc_id for r in tokenfile.token_files(nameless, WORD_BPE)[0].collect()] == [None, None]
    assert tokenfile.token_files(empty, WORD_BPE)[0].count() == 0


def test_words_are_encoded_as_in_their_text():
    from tokenizers import Tokenizer

    coder, tokenizer = tokenfile.WordEncoder(WORD_BPE, 2), Tokenizer.from_file(WORD_BPE)
    for text in ("Hello, World!! don't I'LL <|endoftext|>x a<|startoftext|> É", "ΣΑΣ İI ǅ ß ẞ 123abc ___ a_b ﬁ 日本 語。 é", "Ünïcödé*** &&& a’s “q” x²"):
        assert coder.encode([text.encode()])[0] == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()


# Top-k


def test_topk_of_huge_components_is_held_within_a_bigint(spark):
    """One finite huge vector neither stops a query nor changes the scores of others; ties go to the smaller id."""
    rows = [(0, [1.0, 0.5]), (1, [1e300, 0.0]), (2, [-1.7e308, 1.0]), (3, [3e7, 1.0]), (4, [1e300, 1.0]), (5, [0.25, -0.5]), (6, [1e307, -1e307]), (7, [2e9, 7.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    cells = {i: [min(int(64 * x), int(1.7976931348623157e308)) if abs(64 * x) != float("inf") else (int(1.7976931348623157e308) if x > 0 else -int(1.7976931348623157e308)) for x in v] for i, v in rows}
    wanted = []
    for q in cells:
        scores = [(max(-(2**63 - 1), min(2**63 - 1, sum(a * b for a, b in zip(cells[q], cells[i])))), i) for i in cells if i != q]
        wanted += [(q, n, i, s) for n, (s, i) in enumerate(sorted(scores, key=lambda x: (-x[0], x[1]))[:5], 1)]
    assert sorted(tuple(r) for r in topk.exact_topk(df, df, k=5).collect()) == sorted(wanted)


def test_topk_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    vectors = [(i, [float(x) for x in rng.normal(size=4)], 1.0) for i in range(60)]
    vectors += [(60, vectors[0][1], 1.0), (61, vectors[0][1], 1.0), (62, None, 1.0), (63, [1.0, None, 1.0, 1.0], 1.0), (64, [float("nan")] * 4, 1.0)]
    vectors += [(65, [float("inf")] + [0.0] * 3, 1.0), (80, [1e7] * 4, 1.0), (100, [0.5, 0.5], 1.0), (101, [1.0, -1.0], 1.0)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, score double").repartition(4)
    cells = {i: np.floor(64 * np.array(v)).astype(int) for i, v, _ in vectors if v and all(x is not None and np.isfinite(x) for x in v)}
    wanted = set()
    for q in (i for i in cells if i % 20 == 0):
        scored = sorted((-int(cells[q] @ v), i) for i, v in cells.items() if i != q and v.size == cells[q].size)
        wanted |= {(q, n, i, -s) for n, (s, i) in enumerate(scored[:5], 1)}
    found = topk.exact_topk(df, df.filter("vec_id % 20 = 0"), k=5)
    assert {tuple(r) for r in found.collect()} == wanted
    assert topk.exact_topk(df.limit(0), df, k=5).count() == 0


# Quality


def test_counts_equal_brute_force(docs, rows):
    found = {r.doc_id: r for r in quality.base_counts(docs).collect()}
    for i, text, _ in rows:
        text = text or ""
        w, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
        windows = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        often = Counter(windows)
        covered = {p for k, x in enumerate(windows) if often[x] > 1 for p in range(k, k + 5)}
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered),
        )


def test_votes_reject_junk_and_keep_clean_text(spark, empty):
    rng = np.random.default_rng(5)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    clean = [". ".join(" ".join(rng.choice(words, 9)) for _ in range(12)) + "." for _ in range(150)]
    junk = ["### ".join(rng.choice(words, 100)) + "&&& %%%" for _ in range(25)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(clean + junk)], "doc_id long, text string")
    kept = {r.doc_id: r.kept for r in quality.judge(df).collect()}
    assert all(kept[i] for i in range(150)) and not any(kept[i] for i in range(150, 175))
    assert quality.judge(empty).count() == 0
    plan = quality.judge(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_odd_rows_are_judged_one_by_one(odd):
    found = quality.judge(odd).collect()
    assert len(found) == 6 and sum(r.base_failed for r in found) == 2


# BPE


def test_encoding_and_decoding_round_trip(docs, rows, odd, empty):
    import tiktoken

    coder = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(BYTE_BPE), special_tokens={})
    made = bpe.decode(bpe.encode(docs, BYTE_BPE, public_tokenizers.PATTERN, slots=7, block_bytes=2000), BYTE_BPE)
    found = {r.doc_id: r for r in made.collect()}
    for i, text, _ in rows:
        assert list(found[i].ids) == coder.encode_ordinary(text or "")
        assert bytes(found[i].decoded) == (text or "").encode()
    assert sorted(len(r.ids) for r in bpe.encode(odd, BYTE_BPE, public_tokenizers.PATTERN).collect()) == sorted(len(coder.encode_ordinary(t or "")) for t in (PASSAGE, PASSAGE, "some other text of its own here", PASSAGE, None, EDITED))
    assert bpe.encode(empty, BYTE_BPE, public_tokenizers.PATTERN).count() == 0


def test_white_space_is_split_as_in_the_whole_text():
    import tiktoken

    coder = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(BYTE_BPE), special_tokens={})
    for text in ("a  b", " a", "a ", "a \n b", "a\n b\n", "\t\ta", "it's 'll", "\x1c x \x85 y \u3000z", "a\u00a0 b", "  ", " \n"):
        words = bpe.PreTokens(public_tokenizers.PATTERN)
        tokens = np.frombuffer(words.sequence(text), "<u4")
        names = list(words.number)
        assert "".join(names[t] for t in tokens) == text
        assert [i for t in tokens for i in coder.encode_ordinary(names[t])] == coder.encode_ordinary(text)


# URLs


def test_urls_by_rules_and_list(spark):
    urls = [
        "http://www.example.com/en/x", "https://a.example.com/en/", "http://EXAMPLE.com/en", "http://notexample.com/en/", "http://x.net/fr/1?q#f", "http://net/es/",
        "http://x.org/a?utm_source=1&b=2&a=1#z", "https://www.x.org/a/?a=1&b=2", "http://x.org/b", "no scheme", None, "http://com", "", "://h/p://q/r",
    ]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, block string")
    listed = spark.createDataFrame([("http://x.org/a?a=1&b=2",), (None,), ("bad",), ("http://x.org/a?b=2&a=1",)], "url string")
    rules = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.filter_urls(pages, listed, rules).collect()}
    assert found[0] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert found[1] == ("a.example.com", "/en/", "example.com/en/", "block")
    assert found[2] == ("example.com", "/en", "com/", "allow") and found[3][2:] == ("com/", "allow")
    assert found[4] == ("x.net", "/fr/1", "net/fr/", "block") and found[5][2:] == ("net/es/", "block")
    assert found[6] == ("x.org", "/a", None, "block") and found[7][3] == "block" and found[8][3] == "allow"
    assert found[9] == found[10] == found[12] == ("", "", None, "allow") and found[11] == ("com", "", None, "allow")
    assert found[13] == ("h", "/p://q/r", None, "allow")
    assert urlfilter.filter_urls(pages.limit(0), listed.limit(0), rules).count() == 0


def test_the_filter_loses_nothing_and_passes_few(spark):
    rows = spark.range(20_000).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("key"), F.col("id").alias("block"))
    listed = rows.filter("block < 1000").select("key")
    passed = urlfilter.possible_hits(rows.select("key"), "key", listed, "key", 1000)
    assert passed.join(listed, "key", "left_semi").count() == 1000 and passed.count() < 1400


# Mixing


def water_fill(sizes, weights, cap=3.0):
    whole, closed = sum(sizes), set()
    while True:
        rest = whole - sum(cap * sizes[i] for i in closed)
        share = rest / sum(weights[i] for i in range(len(sizes)) if i not in closed) if len(closed) < len(sizes) else 0
        more = {i for i in range(len(sizes)) if i not in closed and share * weights[i] > cap * sizes[i]}
        if not more:
            return [cap * sizes[i] if i in closed else share * weights[i] for i in range(len(sizes))]
        closed |= more


def test_targets_fill_up_to_the_cap(spark):
    sizes = {"b": 1000, "a": 10, None: 500, "\u00e9": 0, "Z": 40, "\U0001f600": 900}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    order = [*sorted(s for s in sizes if s is not None), None]
    wanted = water_fill([sizes[s] for s in order], [[1, 2, 3][i % 3] for i in range(len(order))])
    found = {r.source: r.target for r in mixing.targets(df).collect()}
    assert found == pytest.approx(dict(zip(order, wanted)))


def test_the_mix_comes_near_its_targets_and_repeats_itself(spark, docs, odd, empty):
    found = [[tuple(r) for r in mixing.mix(d).orderBy("row_id").collect()] for d in (docs, docs.repartition(2))]
    assert found[0] == found[1]
    for source in ("a", "b", None):
        own = [r for r in found[0] if r[1] == source]
        taken, target = sum(r[5] for r in own), own[0][4]
        assert abs(taken - target) <= max(3 * 64, 0.05 * target) and all(0 <= r[5] <= 3 * r[2] for r in own)
        assert {r[3] for r in own} == {sum(r[2] for r in own)}
    assert mixing.mix(odd).count() == 6 and mixing.mix(empty).count() == 0


def hashed(*values):
    seed = 42
    for v in values:
        if v is not None:
            seed = xxhash.xxh64_intdigest(struct.pack("<q", v) if isinstance(v, int) else v.encode(), seed=seed)
    return seed - 2**64 if seed >= 2**63 else seed


def mixed(rows, block, per_bucket):
    """The mix by its definition: (id, text, source) -> words taken, as sorted tuples."""
    seen, found = Counter(), []
    for i, t, s in rows:
        key = hashed(i, hashed(t), seen[i, t, s])
        seen[i, t, s] += 1
        found.append((s, key, i, t, len(WORD.findall(t or ""))))
    order = sorted({r[0] for r in found}, key=lambda s: (s is None, s or ""))
    sizes = [sum(r[4] for r in found if r[0] == s) for s in order]
    targets = water_fill(sizes, [[1, 2, 3][i % 3] for i in range(len(order))])
    buckets = -(-max(Counter(r[0] for r in found).values()) // per_bucket)
    golden, whole = (5**0.5 - 1) / 2, sum(targets)
    passes = {s: Counter() for s in order}
    ranks = Counter()
    for slot in range(-(-whole // block).__int__()):
        at, high = (slot * golden % 1) * whole, 0.0
        for s, size, target in zip(order, sizes, targets):
            high += target
            if at < high:
                blocks = -(-size // block)
                if ranks[s] < 3 * blocks:
                    passes[s][ranks[s] % blocks] += 1
                ranks[s] += 1
                break
    out = []
    for s in order:
        start = 0
        for _, key, i, t, size in sorted((r for r in found if r[0] == s), key=lambda r: ((r[1] % 2**64 >> 1) % buckets, r[1])):
            out.append((i, s, size, sum(passes[s][w // block] for w in range(start, start + size))))
            start += size
    return sorted(out, key=repr)


@pytest.mark.parametrize("ids", ["own", "ten", "null"])
def test_the_mix_equals_its_definition_also_where_ids_repeat(spark, monkeypatch, ids):
    """A row is a document of its own; hot and null ids reach their targets like all others."""
    rng = np.random.default_rng(3)
    rows = []
    for n in range(400):
        text = PASSAGE if n % 3 == 0 else " ".join(rng.choice(["a", "b", "c d"], rng.integers(0, 60)))
        rows.append(({"own": n, "ten": n % 10, "null": None}[ids], None if n % 50 == 7 else text, ["x", "y", None, "z"][n % 7 % 4]))
    monkeypatch.setattr(mixing.blocks, "__defaults__", (30,))
    wanted = mixed(rows, 64, 30)
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts)
        got = mixing.mix(df).collect()
        assert sorted(((r.row_id, r.source, r.size, r.taken) for r in got), key=repr) == wanted
        taken, targets = Counter(), {}
        for r in got:
            taken[r.source] += r.taken
            targets[r.source] = r.target
            assert r.taken <= 3 * r.size
        assert all(abs(taken[s] - t) <= 3 * 64 + 0.02 * t for s, t in targets.items())


def test_schedule_ranks_every_slot_once(spark):
    shares = mixing.targets(spark.createDataFrame([("a", 5000), ("b", 9000), ("c", 700)], "source string, source_size long"))
    slots = mixing.schedule(shares, 10, slots_per_range=100).collect()
    for source in "abc":
        assert sorted(s["rank"] for s in slots if s.source == source) == list(range(sum(s.source == source for s in slots)))
    # Low discrepancy: every stretch of the schedule is mixed like the whole.
    targets = {r.source: r.target for r in shares.collect()}
    first = [s for s in slots if s.slot < 300]
    for source, target in targets.items():
        assert abs(sum(s.source == source for s in first) - 300 * target / sum(targets.values())) < 6


# Substrings


@pytest.mark.parametrize("window", [3, 8, 35])
def test_repeated_windows_go(docs, rows, window):
    words = {i: WORD.findall(t or "") for i, t, _ in rows}
    often = Counter(tuple(w[k : k + window]) for w in words.values() for k in range(len(w) - window + 1))
    found = {r.doc_id: r for r in substrings.remove_repeats(docs, window=window, keep=("source",), block_bytes=1000, group_windows=50).collect()}
    for i, _, source in rows:
        w = words[i]
        gone = {p for k in range(len(w) - window + 1) if often[tuple(w[k : k + window])] > 1 for p in range(k, k + window)}
        r = found[i]
        assert (r.n_words, r.n_removed, r.text, r.source) == (len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone), source)


def test_heavy_prefixes_are_extended():
    counts = [(0, 5, 100), (0, 6, 10), (1, 1, 60), (1, 2, 30), (2, 9, 50), (3, 9, 50)]
    table, groups = substrings.plan_groups(counts, 35, 40)
    assert table[0, 5] == -1 and table[0, 6] >= 0 and table[1, 1] == -1 and table[1, 2] >= 0 and table[2, 9] == -1 and table[3, 9] >= 0
    assert groups >= 3 and (table[3] >= 0).all()


def test_substrings_of_odd_rows_and_of_none(odd, empty):
    removed = sorted(r.n_removed for r in substrings.remove_repeats(odd).collect())
    assert removed == [0, 0, 0, 60, 60, 60]
    assert substrings.remove_repeats(empty).count() == 0


# Toxicity


def test_chain_marginals_equal_enumeration():
    rng = np.random.default_rng(4)
    theta = rng.normal(size=4 + toxicity.CLASSES)
    field = toxicity.Field(theta)
    start, e01, e10, e11 = np.exp(theta[:4])
    emit = np.exp(theta[4:])
    rows = []
    for n in range(0, 9):
        classes = rng.integers(0, toxicity.CLASSES, n) * (rng.random(n) < 0.5)
        at = np.flatnonzero(classes)
        rows.append((n, at, classes[at]))
    marginals = field.marginals(toxicity.Chains(rows))
    _, logz = field.forward(toxicity.Chains(rows))
    order = toxicity.Chains(rows).order
    for place, i in enumerate(order):
        n, at, classes = rows[i]
        full = np.zeros(n, int)
        full[at] = classes
        whole, toxic = 0.0, np.zeros(n)
        for path in itertools.product((0, 1), repeat=n):
            weight = 1.0
            for k, s in enumerate(path):
                weight *= (start if s else 1.0) if k == 0 else {(0, 0): 1.0, (0, 1): e01, (1, 0): e10, (1, 1): e11}[path[k - 1], s]
                weight *= emit[full[k]] if s else 1.0
            whole += weight
            toxic += weight * np.array(path)
        assert np.isclose(np.exp(logz[0, place]), whole)
        assert np.allclose(marginals[i], (toxic / whole)[at])


def test_toxic_words_are_found(spark, odd, empty):
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(200)]
    rows, marks = [], []
    for i in range(700):
        text = rng.choice(words, rng.integers(20, 90)).tolist()
        bad = i % 4 == 0
        for _ in range(3 * bad):
            text[rng.integers(len(text))] = str(rng.choice(["vilewordx", "Nastything,", "badnessy"]))
        rows.append((i, " ".join(text)))
        marks.append((i, 1, int(bad)))
    df = spark.createDataFrame([*rows, (900, None), (901, ""), (None, "vilewordx")], "doc_id long, text string")
    labels = spark.createDataFrame([*marks, (None, 1, 1), (5000, 1, None)], "doc_id long, quality int, toxic int")
    found = toxicity.toxicity(df, labels).collect()
    held = [r for r in found if r.held_out and r.doc_id is not None and r.doc_id < 700]
    assert len(held) > 80 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in held)
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in found) and not any(r.predicted for r in found if r.doc_id in (900, 901))
    texts = dict(rows)
    spans = [texts[r.doc_id][s.start : s.end] for r in held if r.predicted for s in r.spans]
    assert spans and sum("vile" in s or "Nasty" in s or "bad" in s for s in spans) >= 0.95 * len(spans)
    assert toxicity.toxicity(empty, labels).count() == 0
    assert toxicity.toxicity(odd, labels.limit(0)).count() == 6


def test_the_lexicon_is_whole(spark):
    """Above the 40,000 features that went into a dictionary before, and all of them are kept."""
    n = 21_000
    vile = [" ".join(f"ab{i:05d}vile" for i in range(first, first + 100)) for first in range(0, n, 100)]
    plain = " ".join(f"plain{i}" for i in range(400))
    rows = spark.createDataFrame([*[(t, 1) for t in vile * 4], *[(plain, 0)] * 3_400], "text string, toxic int")
    found = toxicity.lexicon(rows)
    words = found.filter("feature like '=ab%vile'")
    assert words.count() == n and words.filter("class > 0").count() == n
    assert toxicity.Lexicon(found).known is None


def test_few_and_many_features_give_the_same(spark, odd, monkeypatch):
    rng = np.random.default_rng(8)
    words = [f"word{i}" for i in range(150)]
    rows = [(i, " ".join([*rng.choice(words, 30), *rng.choice(["vilewordx", "Nastything,", "badnessy", "caf\u00e9."], 3 * (i % 3 == 0))])) for i in range(400)]
    df = spark.createDataFrame([*rows, (3, rows[3][1]), (900, None), (901, ""), (901, " "), (None, "vilewordx"), (902, "vilewordx " * 3000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(400)], "doc_id long, toxic int")

    def result():
        return sorted((repr(tuple(r)) for r in toxicity.toxicity(df, labels).collect()))

    few = result()
    monkeypatch.setattr(toxicity, "BROADCAST_FEATURES", 0)
    monkeypatch.setattr(toxicity, "BLOCK_BYTES", 2_000)
    assert result() == few and sum("Row(start=" in r for r in few) > 50
    assert toxicity.toxicity(df.limit(0), labels).count() == 0
    assert toxicity.toxicity(odd, labels.limit(0)).count() == 6


def test_a_known_clean_word_stops_its_toxic_beginning(spark):
    vile = " ".join(f"vile{i:03d}" for i in range(60))
    plain = " ".join(f"plain{i}" for i in range(100))
    rows = spark.createDataFrame([*[(vile, 1)] * 5, *[(plain, 0)] * 200, *[(f"{plain} vileness", 0)] * 8], "text string, toxic int")
    found = {r["feature"]: r["class"] for r in toxicity.lexicon(rows).collect()}
    assert found["^vile"] > 0 and found["=vileness"] == 0
    assert toxicity.Evidence(found).active(b"vileness vile001 vileother")[1].tolist() == [1, 2]


def test_the_sample_has_a_row_per_id(spark, monkeypatch):
    """However many rows a picked id has, in whatever order."""
    rows = [(i, f"plain words here {'vilewordx' if i % 3 == 0 else 'good'} {i}", int(i % 3 == 0)) for i in range(300)]
    id4 = next(i for i, *_ in rows if zlib.crc32(str(i).encode()) % 5 == 4)
    many = [*rows, *[(id4, f"copy {k}", 0) for k in range(500)]]
    seen = []
    fit = toxicity.fit_field
    monkeypatch.setattr(toxicity, "fit_field", lambda chains, toxic: seen.append(len(chains)) or fit(chains, toxic))
    labels = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, toxic int")
    models = [toxicity.train(spark.createDataFrame([r[:2] for r in some], "doc_id long, text string"), labels) for some in (many, many[::-1])]
    assert seen == [sum(zlib.crc32(str(i).encode()) % 5 == 4 for i in range(300))] * 2
    assert all(np.array_equal(a, b) for a, b in zip(models[0][1:], models[1][1:]))


def test_windows_of_a_block_are_made_in_steps(monkeypatch):
    """All words of a block at once took more than 20 times the bytes of its texts, in every worker."""
    import tracemalloc

    rng = np.random.default_rng(5)
    texts = [b" ".join(b"w%d" % w for w in rng.integers(0, 5000, size=n)) for n in rng.integers(0, 1500, size=1000)]
    texts += [b"", texts[0], b"a b"]
    table, _ = substrings.plan_groups([(0, s, 1) for s in range(substrings.SLOTS)], 35, 500)

    def peak_of():
        hashes = substrings.WordHashes()
        hashes.of([b" ".join(b"w%d" % w for w in range(5000))])
        tracemalloc.start()
        try:
            return substrings._windows(texts, hashes, table, 35), tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    in_steps, less = peak_of()
    monkeypatch.setattr(substrings, "STEP_BYTES", 1 << 40)
    at_once, more = peak_of()
    for a, b in zip(in_steps, at_once):
        assert a.dtype == b.dtype and np.array_equal(a, b)
    size = sum(map(len, texts))
    assert less < 20 * size < more


def test_words_are_hashed_together_and_only_long_ones_alone(monkeypatch):
    """Words have equal hashes exactly if they are equal, however texts are cut; short ones are not hashed one by one."""
    from evidex.llm import common

    rng = np.random.default_rng(3)
    sizes = [1, 2, 7, 8, 9, 15, 16, 17, 24, 31, 32, 33, 40, 500]
    words = [bytes(rng.integers(33, 256, n, dtype=np.uint8)) for n in sizes for _ in range(40)]
    words += [b"a" * n for n in range(1, 70)] + [b"a" + b"\0" * n for n in range(40)] + [b"\0" * n for n in range(1, 40)]
    words += [w[:-1] + b"!" for w in words] + words[:200]
    rng.shuffle(words)
    texts = [b"", b" \n\t\x0b\x0c\r ", *[b" \r\n".join(words[k : k + 60]) for k in range(0, len(words), 60)], b"\x1c\x85\xa0 end ", b""]
    flat = [w for t in texts for w in t.split()]
    alone, real = [], common.xxhash.xxh3_64_intdigest
    monkeypatch.setattr(common.xxhash, "xxh3_64_intdigest", lambda w: alone.append(w) or real(w))
    found, counts = common.WordHashes().of(texts)
    assert (found.dtype, counts.dtype) == (np.uint64, np.int64) and counts.tolist() == [len(t.split()) for t in texts]
    assert sorted(alone) == sorted(w for w in flat if len(w) > common.SHORT_WORD)
    pairs = set(zip(flat, found.tolist()))
    assert len(pairs) == len(set(flat)) == len(set(found.tolist()))
    each = [common.WordHashes().of([t])[0] for t in texts]
    assert np.array_equal(np.concatenate(each), found)
    nothing = common.WordHashes().of([])
    assert nothing[0].size == nothing[1].size == 0


def test_the_mix_does_not_store_the_texts_of_a_table_of_files(spark, docs, tmp_path, monkeypatch):
    """Rows are numbered by file and place, so texts are read again instead of being stored."""
    import corpus_pipeline
    from evidex.llm import common

    whole = docs.select("doc_id", "text", F.lit("en").alias("lang"), "source", F.length("text").cast("long").alias("n_chars"))
    whole = whole.union(whole.filter("doc_id % 3 = 0"))
    whole.repartition(3).write.parquet(f"{tmp_path}/docs")
    files = spark.read.parquet(f"{tmp_path}/docs")
    stored, real = [], common.stored_table
    for module in (common, mixing):
        monkeypatch.setattr(module, "stored_table", lambda df, label: stored.append(df.columns) or real(df, label))
    numbered = common.numbered_table(files, corpus_pipeline.DOCUMENTS, "mixed")
    rows = numbered.collect()
    assert len({r.row for r in rows}) == len(rows) == whole.count()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    again = common.numbered_table(files, corpus_pipeline.DOCUMENTS, "mixed").repartition(5).collect()
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(map(repr, again)) == sorted(map(repr, rows))
    found = corpus_pipeline.mix_sources(spark, files, "").collect()
    assert stored and not any("text" in columns for columns in stored)
    # A table with a step on top of its files may give a row twice, so it is stored.
    twice = corpus_pipeline.mix_sources(spark, files.withColumn("n", F.explode(F.array(F.lit(1)))), "").collect()
    assert any("text" in columns for columns in stored)
    keep = ("text", "lang", "n_chars")
    wanted = [(r.row_id, r.text, r.source) for r in mixing.mix(files, keep=keep).collect() for _ in range(int(r.taken / r.size + 0.5) if r.size else 0)]
    for got in (found, twice):
        assert sorted(((r.doc_id, r.text, r.source) for r in got), key=repr) == sorted(wanted, key=repr)
