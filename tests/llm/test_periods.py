"""Periodic runs against plain search, and the extensions against word-by-word comparison."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from meterstone.llm import periods
from meterstone.llm.common import table


def brute(w):
    """(start, length, period): every period's maximal stretches, each with its smallest period only."""
    n, out, seen = len(w), [], set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q) and (i, j + q) not in seen:
                seen.add((i, j + q))
                out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def drawn(rng):
    n, k = rng.randrange(0, 120), rng.choice([1, 2, 3, 8])
    w = [rng.randrange(k) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        if n > 8:
            a, p = rng.randrange(n - 4), rng.randrange(1, 7)
            e = min(n, a + p * rng.randrange(3, 9) + rng.randrange(p))
            w[a:e] = [w[a + (i - a) % p] for i in range(a, e)]
    return w


@pytest.mark.parametrize("seed", range(40))
def test_runs_equal_plain_search(seed):
    rng = random.Random(seed)
    texts = [drawn(rng) for _ in range(rng.randrange(1, 40))]
    got = periods.runs([np.array(t, dtype=np.int64) for t in texts])
    for t, g in zip(texts, got):
        assert [tuple(r) for r in g.tolist()] == brute(t), t


@pytest.mark.parametrize("seed", range(10))
def test_extensions(seed):
    rng = random.Random(seed)
    w = []
    for k in range(rng.randrange(1, 12)):
        w += drawn(rng) + [-1 - k]
    seq = np.array(w, dtype=np.int64)
    own = periods.Extensions(seq)
    a, b = (np.array(x) for x in zip(*[(i, j) for i, j in ((rng.randrange(len(w)), rng.randrange(len(w))) for _ in range(2000)) if i != j] or [(0, 0)]))
    if len(w) < 2:
        return
    for i, j, got in zip(a.tolist(), b.tolist(), own(a, b).tolist()):
        want = 0
        while max(i, j) + want < len(w) and w[i + want] == w[j + want]:
            want += 1
        assert got == want


def test_cover():
    assert {(a - b) % periods.SPAN for a in periods.COVER for b in periods.COVER} == set(range(periods.SPAN))


def expected(doc_id, text, tails):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if tails and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None,) * 3
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (len(found), *best, 1000 * best[1] // best[2] if found else None, sha("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()),
            sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query_equals_plain_search(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    got = {r[0]: tuple(r)[1:] for r in periods.find(docs, tails=True).collect()}
    assert got == {r.doc_id: expected(r.doc_id, r.text, True) for r in docs.collect()}
    assert sum(g[0] > 0 for g in got.values()) > 10


def test_odd_rows(odd, none):
    got = periods.find(odd, full=True)
    assert got.columns[:8] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    rows = got.collect()
    assert len(rows) == odd.count() and periods.find(none).count() == 0
    by = {r.doc_id: r for r in rows}
    assert by[4][1:8] == by[5][1:8] == (0, None, None, None, None, hashlib.sha256(b"").hexdigest(), hashlib.sha256(b"").hexdigest())
    assert (by[8].start, by[8].length, by[8].period, by[8].collapsed) == (0, 20_000, 1, "word") and by[8].runs == [[0, 20_000, 1]]
    assert (by[9].start, by[9].length, by[9].period, by[9].collapsed) == (0, 9000, 3, "same line here")


def test_many_equal_words():
    assert periods.runs([np.zeros(40_000, dtype=np.int64)])[0].tolist() == [[0, 40_000, 1]]
