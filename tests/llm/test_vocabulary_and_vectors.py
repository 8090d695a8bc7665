"""The source audit, MinHash near-dedup and whitening against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.test_llm import PLAIN, ROWS, SF_DIR, same
from wickline.llm import divergence, minhash, transducer, whitening
from wickline.llm.common import read_table
from wickline.llm.queries import QUERIES

VECTORS = "vec_id BIGINT, embedding ARRAY<FLOAT>"


def _terms(seed, alphabet, most, n):
    rand = random.Random(seed)
    return sorted({bytes(rand.choice(alphabet) for _ in range(rand.randint(0, most))) for _ in range(n)})


@pytest.mark.parametrize("terms", [[], [b""], [b"a"], _terms(1, b"abc\xc3", 6, 900), _terms(2, b"ab", 12, 300)])
def test_transducer_gives_ordinals(terms):
    machine = transducer.load(transducer.dump(transducer.build(terms)))
    assert transducer.ordinals(machine, terms).tolist() == list(range(len(terms)))
    tokens = _terms(3, b"abcd\xc3", 9, 500) + [b"a\0", b"\0"]
    place = {t: i for i, t in enumerate(terms)}
    assert transducer.ordinals(machine, tokens).tolist() == [place.get(t, -1) for t in tokens]


def test_transducer_is_minimal():
    """As many states as there are different sets of endings."""
    terms = _terms(4, b"abc", 6, 400)
    endings = {frozenset(t[i:] for t in terms if t.startswith(p)) for s in terms for i in range(len(s) + 1) for p in [s[:i]]}
    assert len(transducer.build(terms)[3]) == len(endings)
    with pytest.raises(ValueError, match="sorted"):
        transducer.build([b"b", b"a"])


def _corpus(n, seed=5):
    rand = random.Random(seed)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(90)] + ["Éa", "ÉA", "\U0001f600", "ſ", "K"]
    langs, sources = ["en", "en", "en", "de", None, ""], ["a", "b", "B", "é", None, "", "\U0001f600", "zz"]
    rows = []
    for _ in range(n):
        text = " ".join(rand.choice(words[: rand.choice([10, 50, 95])]) for _ in range(rand.randint(0, 60)))
        rows.append((rand.choice([text, text.upper(), text + "\x00-x", None, ""]), rand.choice(langs), rand.choice(sources)))
    return rows + [("rare words only", "xx", "s1"), ("other", "xx", "s2"), ("q " * 30000, "en", "long")]


@pytest.mark.parametrize("shard, block, slices, held", [(65536, 1024, 256, 500_000), (7, 5, 2, 20)])
def test_divergence_equals_brute_force(spark, monkeypatch, shard, block, slices, held):
    monkeypatch.setattr(divergence, "SHARD_TERMS", shard)
    monkeypatch.setattr(divergence, "BLOCK_TERMS", block)
    monkeypatch.setattr(divergence, "BLOCK_SOURCES", slices)
    monkeypatch.setattr(divergence, "HELD_TERMS", held)
    if shard == 7:
        monkeypatch.setattr(divergence, "BROADCAST_BYTES", 1500)  # several passes over the texts
    rows = _corpus(250)
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "text STRING, lang STRING, source STRING, term INT, ordinal STRING")
    got = [tuple(r) for r in divergence.source_divergence(docs.repartition(5)).collect()]
    same(got, brute.divergence(rows))
    assert {r[0] for r in got if r[2] == "pair" and r[4] == 0} >= {"xx"}


def test_shares_of_very_large_counts_are_exact():
    """Beyond 64 bits the same formula on Python integers."""
    import pandas as pd

    compare = divergence._comparison(10, 10**9, 2)
    counts = pd.DataFrame({"at": [0, 1, 1], "ordinal": [0, 0, 1], "n": [3 * 10**13, 7 * 10**12, 5]})
    words = [3 * 10**13, 7 * 10**12 + 5]
    sources = pd.DataFrame({"source": ["a", "b"], "idx": [0, 1], "words": words, "n_terms": 2, "lang_words": sum(words)})
    got = compare(("en", 0, 0), counts, sources)
    p = [[1 + 10**9 * (c + 2) // (n + 4) for c in cs] for cs, n in zip([(3 * 10**13, 0), (7 * 10**12, 5)], words)]
    pair = sum((x - y) ** 2 // (x + y) for x, y in zip(*p))
    assert got[got.ordinal < 0].value.tolist() == [pair, pair]


def test_divergence_of_empty_and_wordless_tables(spark):
    schema = "text STRING, lang STRING, source STRING"
    assert divergence.source_divergence(spark.createDataFrame([], schema)).collect() == []
    got = divergence.source_divergence(spark.createDataFrame([(None, None, None), ("1 2", "", "b")], schema)).collect()
    same([tuple(r) for r in got], [("", "", "pair", "b", 0, 1), ("", "b", "pair", "", 0, 1)])


@pytest.fixture(scope="module")
def edited():
    """Texts with copies and edited copies, chains of edits, shared passages, and texts of a few words."""
    rand = random.Random(11)
    words = [f"word{i}" for i in range(400)]
    passage = [rand.choice(words) for _ in range(40)]
    rows, next_id = [], 100
    for size in (1, 2, 3, 4, 5, 7, 20, 60, 200, 800):
        base = [rand.choice(words) for _ in range(size)]
        for edits in (0, 0, 1, 1, 2, size // 40, size // 20, size // 10):
            text = list(base)
            for _ in range(edits):
                text[rand.randrange(len(text))] = rand.choice(words)
            rows.append((next_id, " ".join(text)))
            base = text if edits == 1 else base  # a chain of small steps
            next_id += 7
        rows.append((next_id, " ".join(base + passage)))
        next_id += 1
    rand.shuffle(rows)
    return rows


def _minhash(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", 1, [2]) for i, t in rows], "doc_id BIGINT, text STRING, s1 STRING, n INT, bands ARRAY<INT>")
    return [tuple(r) for r in minhash.near_duplicates(docs.repartition(4)).collect()]


@pytest.mark.parametrize("block", [256, 2])
def test_near_duplicates_equal_brute_force(spark, edited, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "SIGNATURES", block)
    rows = [*PLAIN, *edited, (13, "x " * 50000), (14, "X " * 50000 + "y")]
    same(_minhash(spark, rows), brute.near_duplicates(rows))


def test_links_that_stars_miss_are_found(spark, monkeypatch):
    """One bucket for all: the smallest member is like none, and the others form several groups."""
    monkeypatch.setattr(minhash, "band_keys", lambda bins: np.arange(minhash.BANDS))
    rand = random.Random(3)
    rows = [(1, "not like any other text here")]
    for group in range(6):
        base = [f"g{group}w{i}" for i in range(60)]
        for copy in range(5):
            text = list(base)
            text[rand.randrange(60)] = "edit"
            rows.append((10 * group + copy + 5, " ".join(text)))
    for block in (256, 4):
        monkeypatch.setattr(minhash, "BLOCK", block)
        monkeypatch.setattr(minhash, "SIGNATURES", block)
        same(_minhash(spark, rows), brute.near_duplicates(rows))


def test_buckets_are_stars(spark, monkeypatch):
    """A bucket of n members hands n - 1 pairs to the check, also when all are alike."""
    seen = []
    real = minhash.star_links
    monkeypatch.setattr(minhash, "star_links", lambda texts, stars, n: seen.append(stars.count()) or real(texts, stars, n))
    monkeypatch.setattr(minhash, "band_keys", lambda bins: np.arange(minhash.BANDS))
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*base[:i], "edit", *base[i + 1 :]])) for i in range(120)]
    assert {c for _, _, c in _minhash(spark, rows)} == {0}
    assert seen == [119]


def test_densified_bins_match_like_their_sets():
    """Bins of sparse sets are equal as often as their sets are alike."""
    rand = np.random.default_rng(1)
    agree = []
    for _ in range(300):
        values = rand.integers(0, 1 << 63, 12, dtype=np.uint64) * np.uint64(2)
        a, b = np.unique(values[:11]), np.unique(values[1:])
        agree.append((minhash.signature(a) == minhash.signature(b)).mean())
    assert abs(np.mean(agree) - 10 / 12) < 0.02


def test_minhash_of_an_empty_table(spark):
    assert _minhash(spark, []) == []
    same(_minhash(spark, [(1, None), (1, ""), (None, None)]), [(1, 0, 1), (1, 0, 1), (None, 0, None)])


def _whitened_equals_dense(df):
    got = whitening.whiten(df).collect()
    want = brute.whiten([tuple(r) for r in df.select("vec_id", "embedding").collect()])
    assert len(got) == sum(map(len, want.values()))
    found = {}
    for r in got:
        found.setdefault((r.vec_id, r.component), []).append(r)
    signs = {}
    for key, expected in want.items():
        rows = sorted(found[key], key=lambda r: (r.deviation, r.whitened))
        for r, (n, deviation, w, explained) in zip(rows, sorted(expected, key=lambda e: e[:2]), strict=True):
            assert (r.n, r.deviation) == (n, deviation)
            assert r.explained == pytest.approx(explained, rel=1e-9)
            assert abs(r.whitened) == pytest.approx(abs(w), abs=1e-8)
            if abs(w) > 1e-6:
                signs.setdefault(key[1], set()).add(np.sign(r.whitened) == np.sign(w))
    assert all(len(s) == 1 for s in signs.values())
    assert all(r.identity_error < 1e-9 for r in got)


def test_whitening_equals_dense_solver(spark):
    nan, inf = float("nan"), float("inf")
    odd = [
        (1, [1.0, 2.0, 3.0]),
        (1, [1.0, 2.0, 3.0]),
        (2, None),
        (3, []),
        (4, [1.0, None, 2.0]),
        (5, [nan, 1.0, 1.0]),
        (6, [-1.0, 0.5, inf]),
        (None, [0.0, -0.0, 0.001]),
        (7, [5.0, -1.0, 2.0]),
        (8, [-0.001, 2.0, -7.0]),
    ]
    clash = "vec_id BIGINT, embedding ARRAY<FLOAT>, x STRING, component INT"
    _whitened_equals_dense(spark.createDataFrame([(*r, "x", 1) for r in odd], clash).repartition(3))
    rand = np.random.default_rng(3)
    spread = rand.normal(size=(300, 20)) @ np.diag([1e3] + [10] * 5 + [1e-2] * 14) + 50
    _whitened_equals_dense(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(spread)], VECTORS).repartition(40))
    _whitened_equals_dense(read_table(spark, SF_DIR, "embeddings"))


def test_whitening_finds_equal_variances(spark):
    """A Krylov space holds one vector of each variance; the others need further starts."""
    for scales in ([4] * 6, [5, 5, 3, 2, 1, 1], [9, 8, 7, 2, 2, 2, *[1] * 30]):
        ends = np.concatenate([np.diag(scales), -np.diag(scales)]).astype(float)
        got = whitening.whiten(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(ends)], VECTORS)).collect()
        share = {r.component: r.explained for r in got}
        exact = np.sort(np.array(scales, float) ** 2)[::-1]
        assert [share[k] for k in (1, 2, 3, 4)] == pytest.approx((exact / exact.sum())[:4].tolist())
        assert got[0].identity_error < 1e-9


def test_whitening_without_variance_or_of_other_lengths(spark):
    def run(rows):
        return whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect()

    assert run([]) == [] and run([(1, [1.0, 2.0])]) == [] and run([(1, [1.0]), (2, [1.0])]) == []
    got = run([(1, [1.0, 2.0]), (2, [3.0, 2.0]), (3, [1.0]), (4, [1e18, 1e18, 1.0])])
    assert sorted((r.vec_id, r.component, r.n, r.deviation) for r in got) == [(1, 1, 2, 262144), (2, 1, 2, 262144)]
    huge = run([(1, [3e9, 0.0]), (2, [0.0, 1.0])])
    assert [r.deviation for r in huge] == [None, None] and huge[0].identity_error < 1e-9


def test_new_queries_run_on_whole_tables(spark):
    docs = read_table(spark, SF_DIR, "documents")
    near = QUERIES["op12_minhash"](spark, SF_DIR)
    same([tuple(r)[:3] for r in near.collect()], brute.near_duplicates([tuple(r) for r in docs.select("doc_id", "text").collect()]))
    assert near.filter("kept <> (doc_id = component_id)").count() == 0
    rows = [tuple(r) for r in docs.select("text", "lang", "source").collect()]
    same([tuple(r) for r in QUERIES["op11_divergence"](spark, SF_DIR).collect()], brute.divergence(rows))
    assert QUERIES["op13_whitening"](spark, SF_DIR).filter(F.col("component") > 4).isEmpty()
    assert len(ROWS) == len(PLAIN)


@pytest.mark.parametrize("limit", [minhash.MARKS, 0])
def test_marked_rows_are_those_needed(spark, limit):
    """Bits of bitmaps, over several bitmaps and partitions of ids; above the limit all rows stay."""
    texts = spark.range(0, 120_000, 1, 3).select(F.monotonically_increasing_id().alias("cid"), F.lit("x").alias("text"))
    needed = texts.filter("pmod(xxhash64(cid), 97) < 3 OR cid % 32768 IN (0, 1, 7, 8, 32767)").select("cid")
    got = minhash.marked_rows(texts, needed, limit)
    assert got.columns == ["cid", "text"]
    want = needed if limit else texts.select("cid")
    assert got.count() == want.count() and got.join(want, "cid", "left_anti").isEmpty()


def test_sets_of_many_texts_equal_sets_of_one():
    rand = random.Random(8)
    texts = [" ".join(rand.choice("abCd") for _ in range(rand.randint(0, 9))) for _ in range(300)]
    texts += [None, "", " \t\x0b\n", "a b c", "A  B\tc", "x y " * 40000, "K ſ k s", "a b c d"]
    sets = minhash.shingle_sets(texts)
    assert all(s.tolist() == minhash.shingle_sets([t])[0].tolist() for s, t in zip(sets, texts, strict=True))
    grams = []
    for text in texts:
        words = (text or "").encode().lower().split()
        grams.append({tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))} if words else set())
    names = {}
    for found, gram in zip(sets, grams, strict=True):
        assert len(found) == len(gram)
        names.setdefault(frozenset(gram), set()).add(tuple(found.tolist()))
    assert all(len(found) == 1 for found in names.values()) and len(set.union(*names.values())) == len(names)
