"""The grammar on clauses, held-out accuracy, odd rows."""

import zlib

from meterstone.llm import toxicity
from meterstone.llm.common import table


def weight(text, stems=None):
    reader = toxicity.Reader(stems or {})
    return reader.features(text)[0]


def test_grammar():
    plain, aimed = weight("what an idiot"), weight("you are an idiot")
    assert aimed > plain > weight("he wrote idiot") > 0
    assert weight("you are not an idiot") < plain
    assert weight("you never kill") < weight("i kill you")
    assert weight("they said you are an idiot. fine.") < aimed  # reported speech
    assert weight("they said. you are an idiot") == aimed  # another clause
    assert weight("a fine day") == 0
    assert weight("du lowein", {"lowei": 1.0}) > 0


def test_composition_is_the_cascade():
    import itertools

    parts = [toxicity.negation(), toxicity.reported(), toxicity.target(), toxicity.insult(), toxicity.threat()]
    for symbols in itertools.product(range(6), repeat=4):
        total, states = 0.0, [0] * len(parts)
        for s in symbols:
            for k, part in enumerate(parts):
                states[k], s, w = part.get((states[k], s), (states[k], s, 0.0))
                total += w
        assert abs(total - toxicity.clause_weight(list(symbols))) < 1e-9


def test_held_out(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    got = toxicity.score(docs, labels).collect()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    assert len(got) == docs.count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert sum(p == t for p, t in held) >= 0.93 * len(held)
    assert sum(p for p, t in held if not t) <= 0.02 * len(held)


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, None), (None, 0, 1), (99, 0, 1), (1, 0, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    rows = toxicity.score(odd, labels).collect()
    assert len(rows) == odd.count() and {r.predicted for r in rows if r.doc_id == 1} == {1}
    assert not any(r.held_out for r in rows if r.doc_id is None)
    kept = toxicity.drop_toxic(odd, labels)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 1
    assert toxicity.score(none, labels).count() == 0 and toxicity.score(odd, labels.limit(0)).count() == odd.count()
