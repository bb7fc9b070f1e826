"""Line chunks against DuckDB on the whole table and on odd rows."""

import pytest

from driver_tables.check import compare, connect
from meterstone.llm import linededup
from meterstone.llm.common import table
from meterstone.llm.queries import QUERIES, SQL

from conftest import LINE  # noqa: I001


@pytest.mark.parametrize("name", ["op10_line_chunks", "op2_mixing", "op4_warc"])
def test_matches_sql(spark, small_folder, name):
    assert compare(spark, connect(small_folder), small_folder, QUERIES[name], SQL[name]) is None


def test_odd_rows(odd, none):
    out = linededup.drop_repeated(odd, removed_col="removed")
    assert out.columns == [*odd.columns, "removed"]
    text = {}
    for r in out.collect():
        text.setdefault(r.doc_id, []).append(r.text)
    assert LINE in text[1][0]  # the first occurrence stays
    assert text[2] == ["another end of the text"]
    assert text[3] == ["", ""] and text[4] == [None] and text[5] == [""]
    assert sorted(map(str, text[None])) == ["None", "text without an id but with words"]
    assert text[12] == ["one two three four five"] and text[8] == ["word " * 20_000]
    assert linededup.drop_repeated(none).count() == 0


def test_shifted_passage_of_short_lines(spark):
    passage = [f"line {i} of a passage that is long enough to have some words" for i in range(40)]
    rows = [(1, "\n".join(["head one", *passage, "tail"])), (2, "\n".join(["another", "longer", "head", *passage, "and another tail"]))]
    out = {r.doc_id: r.text for r in linededup.drop_repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1] == rows[0][1] and "head" in out[2] and "another" in out[2]
    left = [x for x in out[2].split("\n") if x in passage]
    assert len(left) < 15  # boundaries fall in the same places; only chunks at the edges or below the least size stay


def residue(rows, least=50):
    """Shortest stretches of neighbouring lines with over ``least`` words that lie in two documents, blank lines left out."""
    seen = {}
    for i, t in rows:
        lines = [x for x in (t or "").split("\n") if x.split()]
        size = [len(x.split()) for x in lines]
        for a in range(len(lines)):
            b, n = a, 0
            while b < len(lines) and n <= least:
                n += size[b]
                b += 1
            if n > least:
                seen.setdefault(tuple(lines[a:b]), set()).add(i)
    return [w for w, where in seen.items() if len(where) > 1]


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_no_passage_of_over_fifty_words_is_left_twice(spark, sf):
    docs = table(spark, f"/root/testdata/{sf}", "documents")
    before = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    after = [tuple(r) for r in linededup.drop_repeated(docs).select("doc_id", "text").collect()]
    assert len(residue(before)) > 20 and residue(after) == []
    lines = lambda rows: {x for _, t in rows for x in (t or "").split("\n")}
    assert lines(after) - {""} == lines(before) - {""}  # every line is kept somewhere


def test_edges_of_short_passages_go_too(spark):
    words = lambda k, n: " ".join(f"w{k}x{i}" for i in range(n))
    passages = [[words(f"a{k}", 41), words(f"b{k}", 43)] for k in range(12)] + [[words(f"c{k}", 14), "", words(f"d{k}", 20), words(f"e{k}", 18)] for k in range(12)]
    rows = [(10 * k + j, "\n".join([f"head {k} {j} of it", *p, f"tail {k} {j} of it"])) for k, p in enumerate(passages) for j in range(3)]
    out = {r.doc_id: r.text for r in linededup.drop_repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, p in enumerate(passages):
        assert out[10 * k] == dict(rows)[10 * k]
        for j in (1, 2):
            left = [x for x in out[10 * k + j].split("\n") if x]
            assert left[0] == f"head {k} {j} of it" and left[-1] == f"tail {k} {j} of it"
            assert len(left) <= 2 + (len(p) > 2)  # of a passage whose other lines went as a chunk an edge line may stay
