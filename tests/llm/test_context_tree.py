"""Context-tree weighting against the recursion written out, and the base score against plain counting."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from meterstone.llm import context_tree as ct
from meterstone.llm.common import table


def pw(s, zeros, ones, longer, depth):
    """log Pw of context ``s`` (a tuple, last byte first) by its definition, in exact order of the recursion."""
    a, b = zeros[s], ones[s]
    pe = math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)
    if len(s) == depth:
        return pe
    below = sum(pw(t, zeros, ones, longer, depth) for t in longer[s])
    m = max(pe, below)
    return m + math.log(.5 * math.exp(pe - m) + .5 * math.exp(below - m))


def brute(rows, depth):
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "").encode()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    steps = lambda body: [(tuple(reversed(whole[t - depth:t])), whole[t]) for whole in [b"\xff" * depth + body + b"\xff"] for t in range(depth, len(whole))]
    zeros, ones, longer = (defaultdict(Counter), defaultdict(Counter), defaultdict(lambda: defaultdict(set)))
    for i, t in rows:
        for ctx, byte in [] if held(i) else steps(low(t)):
            for k in range(8):
                node = (1 << k) | (byte >> (8 - k))
                for d in range(depth + 1):
                    (ones if byte >> (7 - k) & 1 else zeros)[node][ctx[:d]] += 1
                    if d:
                        longer[node][ctx[:d - 1]].add(ctx[:d])
    memo = {}

    def prob(ctx, byte):
        if (ctx, byte) not in memo:
            out = 0.0
            for k in range(8):
                node, bit = (1 << k) | (byte >> (8 - k)), byte >> (7 - k) & 1
                z, o, l = zeros[node], ones[node], longer[node]
                before = pw((), z, o, l, depth)
                side = o if bit else z
                added = [ctx[:d] for d in range(1, depth + 1) if ctx[:d] not in l[ctx[:d - 1]]]
                for d in range(depth + 1):
                    side[ctx[:d]] += 1
                for s in added:
                    l[s[:-1]].add(s)
                out += pw((), z, o, l, depth) - before
                for d in range(depth + 1):
                    side[ctx[:d]] -= 1
                for s in added:
                    l[s[:-1]].discard(s)
            memo[ctx, byte] = out / math.log(10)
        return memo[ctx, byte]

    count = Counter(w for i, t in rows if not held(i) for w in [*low(t).split(), None])
    n, v = sum(count.values()), len(count)
    return sorted(
        (str(i), held(i), len(toks), sum(count[w] > 0 for w in toks), n,
         round(sum(math.log10((count[w] + .5) / (n + .5 * (v + 1))) for w in toks), 6), round(sum(prob(*s) for s in steps(low(t))), 6))
        for i, t in rows for toks in [[*low(t).split(), None]])


TEXTS = ["the cat sat on the mat", "The cat  ate\tthe rat", "a", "", None, "über den Wolken 漢字", "the mat the mat the mat", "x" * 60, "zebra crossing the line", "on the mat sat the cat",
         "lorem ipsum", "w" * 70 + " the " + "w" * 70]


@pytest.mark.parametrize("depth", [2, 4])
def test_equals_the_recursion(spark, depth):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "a text without id"), (3, "repeated id"), (3, "repeated id")]
    df = spark.createDataFrame([(*r, "c", 1.0) for r in rows], "doc_id long, text string, word string, score double").repartition(3)
    got = ct.score(df, depth=depth, block=60)
    assert got.columns[:7] == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got.collect())
    want = brute(rows, depth)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    np.testing.assert_allclose([g[5:] for g in got], [w[5:] for w in want], atol=2e-5)


def test_pieces_and_blocks_do_not_change_scores(spark, monkeypatch):
    df = table(spark, "/root/testdata/sf0.001", "documents").limit(60)
    one = {r.doc_id: r for r in ct.score(df).collect()}
    monkeypatch.setattr(ct, "PIECE", 512)
    other = {r.doc_id: r for r in ct.score(df, block=4000).collect()}
    assert one.keys() == other.keys()
    for k, r in one.items():
        assert abs(r.score - other[k].score) < 1e-6 * abs(r.score) and abs(r.base_score - other[k].base_score) < 1e-6 * abs(r.base_score)


def test_long_pieces():
    body = bytes(range(97, 123)) * 9
    whole = ct.codes(list(ct.parts_of(body, 4)), 4)[0]
    cut = ct.codes(list(ct.parts_of(body, 4, 10)), 4)[0]
    assert (whole == cut).all() and len(whole) == len(body) + 1
    assert len(list(ct.parts_of(b"", 4, 10))) == 1 and len(ct.codes(list(ct.parts_of(bytes(20), 4, 10)), 4)[0]) == 21


def test_log_gamma():
    x = np.array([.5, 1, 1.5, 7, 100.5, 1e6 + .5])
    np.testing.assert_allclose(ct.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-12)


def test_held_out_texts_are_told_better_than_random_bytes(spark):
    got = ct.score(table(spark, "/root/testdata/sf0.01", "documents")).where("held_out AND n_tokens > 50")
    bits = [r.bits_per_byte for r in got.select("bits_per_byte").collect()]
    assert len(bits) > 100 and np.median(bits) < 2.6  # single bytes take over 4 bits


def test_odd_rows(odd, none):
    rows = ct.score(odd).collect()
    assert len(rows) == odd.count() and all(r.score < 0 and math.isfinite(r.score) for r in rows)
    empty = {(r.n_tokens, r.score) for r in rows if r.doc_id in (4, 5)}
    assert len(empty) == 1 and ct.score(none).count() == 0


def test_grams_are_solved_in_bounded_memory():
    """What a task holds at once is some hundred bytes a gram for ``SOLVED`` grams (was 270 MB)."""
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(1)
    code = np.unique(sum(rng.integers(97, 123, 500_000) << (8 * k) for k in range(5)))
    batches = (pa.RecordBatch.from_pydict({"gram": code[i:i + 10_000], "n": np.ones(len(code[i:i + 10_000]), dtype=np.int64)}) for i in range(0, len(code), 10_000))
    tracemalloc.start()
    try:
        grams = 0
        for part, n in ct._by_suffix(batches, 4):
            ct.Solved(part, n, 4).sums()
            grams += len(part)
        assert grams == len(code) and tracemalloc.get_traced_memory()[1] < 130 << 20
    finally:
        tracemalloc.stop()
