"""Spelling variants against plain edit distance over all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest

from meterstone.llm import spelling
from meterstone.llm.common import table


def edits(w, letters):
    cut = [(w[:i], w[i:]) for i in range(len(w) + 1)]
    out = {a + b[1:] for a, b in cut if b} | {a + c + b[1:] for a, b in cut if b for c in letters} | {a + c + b for a, b in cut for c in letters}
    return out - {w}


def brute(count):
    letters = set("".join(count))
    form, out = {}, {}
    for w, n in count.items():
        near = [x for x in edits(w, letters) if x in count]
        best = min(near, key=lambda x: (-count[x], x)) if near else None
        form[w] = best if best is not None and count[best] >= 2 * n else None
        out[w] = [form[w], None, n, len(near), count[form[w]] if form[w] else None]
    for w in count:
        r = w
        while form[r]:
            r = form[r]
        out[w][1] = r
    return {w: tuple(v) for w, v in out.items()}


def counted(rows):
    c = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            c[run] += 1
    return {w: n for w, n in c.items() if len(w) >= 5 and n >= 3}


def rows_of(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.mark.parametrize("small", [False, True])
def test_query_equals_all_edits(spark, small, monkeypatch):
    if small:  # many leaves and tiles
        monkeypatch.setattr(spelling, "LETTERS", 900)
        monkeypatch.setattr(spelling, "LEAF", 4)
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    got = spelling.variants(docs, spoil=True)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute(counted([(r.doc_id, r.text) for r in docs.collect()]))
    assert rows_of(got) == want and len(want) > 1000 and sum(v[3] > 0 for v in want.values()) > 100


def test_dense_words(spark, monkeypatch):
    monkeypatch.setattr(spelling, "LETTERS", 2500)
    rng = random.Random(5)
    count = {"".join(rng.choice("abcÿ") for _ in range(rng.randrange(5, 9))): rng.randrange(3, 4000) for _ in range(3000)}
    df = spark.createDataFrame([(w, n) for w, n in count.items()], "word string, n long")
    got = {r.word: r.n_near for r in spelling.neighbours(df).collect()}
    assert got == {w: v[3] for w, v in brute(count).items() if v[3]}


def test_roots_follow_long_chains(spark):
    df = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(40)], "word string, form string")
    assert {r.root for r in spelling.roots(df).collect()} == {"w40"}


def test_odd_rows(odd, none):
    rows = odd.select("doc_id", "text").collect()
    assert rows_of(spelling.variants(odd, spoil=True)) == brute(counted([tuple(r) for r in rows]))
    assert spelling.variants(none).count() == 0


def test_very_long_words(spark):
    a = "ab" * 15_000
    df = spark.createDataFrame([(1, " ".join([a] * 7 + [a + "x"] * 3 + [a[:-1] + "c"] * 3)), (1, None), (None, "")], "doc_id long, text string")
    got = rows_of(spelling.variants(df))
    assert got[a][:2] == (None, a) and got[a + "x"][:2] == (a, a) and got[a[:-1] + "c"][1] == a
