"""Margins, calibrated probabilities, the lookup table, odd rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from meterstone.llm import mixing, sharding
from meterstone.llm.common import table


def test_margins_are_met(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    tokens = docs.select("source", "lang", mixing.surface_topic(F.col("text")).alias("topic"), F.regexp_count("text", F.lit(mixing.WORD)).alias("tokens"))
    cells = tokens.groupBy("source", "lang", "topic").agg(F.sum("tokens").cast("double").alias("tokens"))
    raked = mixing.rake(cells, mixing.POWERS, rounds=20).cache()
    total = raked.agg(F.sum("raked")).first()[0]
    for m, power in mixing.POWERS.items():
        share = {r[m]: (r.t, r.w) for r in raked.groupBy(m).agg(F.sum("tokens").alias("t"), F.sum("raked").alias("w")).collect()}
        whole = sum((t / total) ** power for t, _ in share.values())
        assert all(abs(w / total - (t / total) ** power / whole) < 1e-3 for t, w in share.values())
    p = mixing.probabilities(raked)
    assert p.where("probability <= 0 OR probability > 1").count() == 0
    assert p.agg(F.sum(F.col("tokens") * F.col("probability"))).first()[0] == pytest.approx(mixing.RATE * total, rel=1e-6)


def test_mixing_odd_rows(odd, none):
    out = mixing.mix(odd, report=False)
    assert out.columns == odd.columns and out.count() <= odd.count()
    assert mixing.mix(none).count() == 0
    whole = mixing.mix(odd, rate=1.0, powers={"source": 1.0, "lang": 1.0, "topic": 1.0})
    assert whole.count() == odd.count()  # own shares at full rate: nothing is dropped


def test_table_is_fair_and_steady():
    full = sharding.fill()
    assert set(Counter(full).values()) <= {1024, 1025}
    less = sharding.fill(sharding.SHARDS[:-1])
    stay = sum(a == b for a, b in zip(full, less) if sharding.SHARDS[a] != sharding.SHARDS[-1])
    assert stay > 0.97 * sum(sharding.SHARDS[a] != sharding.SHARDS[-1] for a in full)
    count = Counter(sharding.fill(("a", "b", "c"), 1009, {"a": 2, "b": 1, "c": 0}))
    assert count[2] == 0 and abs(count[0] - 2 * count[1]) <= 3
    for bad in ((), ("a", "a")):
        with pytest.raises(ValueError):
            sharding.fill(bad)
    with pytest.raises(ValueError):
        sharding.fill(("a", "b"), 9)


def test_table_by_hand():
    """Claims written out slot by slot."""
    shards, size = ("x", "y", "z"), 7
    orders = [[(sharding._digest(s, "offset:") + j * (sharding._digest(s, "skip:") % 6 + 1)) % 7 for j in range(7)] for s in shards]
    want, turn = {}, 0
    while len(want) < size:
        want[next(s for s in orders[turn % 3] if s not in want)] = turn % 3
        turn += 1
    assert sharding.fill(shards, size) == [want[i] for i in range(size)]


def test_places(spark, odd, none, tmp_path):
    import hashlib

    out = sharding.place(odd)
    assert out.count() == odd.count() and {"slot", "shard"} <= set(out.columns)
    lookup = sharding.fill()
    for r in out.select("doc_id", "slot", "shard").collect():
        slot = int(hashlib.md5(("" if r.doc_id is None else str(r.doc_id)).encode()).hexdigest()[:15], 16) % sharding.SIZE
        assert (r.slot, r.shard) == (slot, sharding.SHARDS[lookup[slot]])
    assert sharding.place(none).count() == 0
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    sharding.write(odd.drop("shard"), str(tmp_path / "out"), shards=("a", "b"), size=101)
    assert spark.read.parquet(str(tmp_path / "out")).count() == odd.count()


def test_unweighted_sample_meets_margins(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    margins = {"source": F.col("source"), "lang": F.col("lang"), "topic": mixing.surface_topic(F.col("text"))}
    tokens = docs.select(*[c.alias(m) for m, c in margins.items()], F.regexp_count("text", F.lit(mixing.WORD)).alias("tokens"))
    cells = tokens.groupBy(*margins).agg(F.sum("tokens").cast("double").alias("tokens")).where("tokens > 0").cache()
    filled, off = mixing.bounded(cells, mixing.POWERS)
    rows, total = filled.collect(), cells.agg(F.sum("tokens")).first()[0]
    assert all(0 < r.probability <= 1 for r in rows)
    assert sum(r.tokens * r.probability for r in rows) == pytest.approx(mixing.RATE * total, rel=2e-3)
    old, worst = mixing.probabilities(mixing.rake(cells, mixing.POWERS)).collect(), {}
    for m, power in mixing.POWERS.items():
        own = Counter()
        for r in rows:
            own[r[m]] += r.tokens
        share = {v: (t / total) ** power for v, t in own.items()}
        want, room = {}, mixing.RATE * total
        while True:  # values that fall short are wanted whole
            open_ = [v for v in own if v not in want]
            scale = room / sum(share[v] for v in open_)
            short = [v for v in open_ if share[v] * scale > own[v]]
            if not short:
                want |= {v: share[v] * scale for v in open_}
                break
            want |= {v: own[v] for v in short}
            room -= sum(own[v] for v in short)
        for name, sample in (("new", rows), ("old", old)):
            got = Counter()
            for r in sample:
                got[r[m]] += r.tokens * r.probability
            worst[name] = max(worst.get(name, 0), max(abs(got[v] - want[v]) for v in own) / (mixing.RATE * total))
    print("largest difference of a margin", worst, off)
    assert worst["new"] == pytest.approx(off, abs=1e-6) and worst["new"] < 2e-3 < worst["old"]
