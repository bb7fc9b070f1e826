"""Every stage on its own input."""

import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from meterstone.llm import toxicity
from meterstone.llm.common import table, written


@pytest.fixture(scope="module")
def stages(spark):
    d, out = "/root/testdata/sf0.01", []
    docs = table(spark, d, "documents")
    for name, stage in corpus_pipeline.STAGES:
        after = written(stage(spark, docs, d), "t")
        out.append((name, docs, after))
        docs = after
    return out


def left_after_pairs(texts):
    """The smallest id of every group of texts linked by five-word shingle sets that share 80 in 100, by counting every pair that shares one."""
    low = {i: re.sub("[A-Z]", lambda m: m[0].lower(), t or "").encode().split() for i, t in texts.items()}
    sets = {i: {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} for i, w in low.items()}
    having, root = defaultdict(list), {i: i for i in sets}
    for i, own in sets.items():
        for s in own:
            having[s].append(i)

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sorted(sets):
        common = Counter(j for s in sets[i] for j in having[s] if j < i)
        for j, n in common.items():
            if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return {top(i) for i in sets}


def test_stages(spark, stages):
    (_, a, b), (_, _, c), (_, _, e), (_, _, f), (_, _, g) = stages
    for df in (b, c, e, f):
        assert df.columns == a.columns
    toxic = {r.doc_id for r in toxicity.score(a, table(spark, "/root/testdata/sf0.01", "labels")).where("predicted = 1").collect()}
    assert {r.doc_id for r in a.collect()} - {r.doc_id for r in b.collect()} == toxic
    assert b.count() == c.count() and c.where("n_chars <> length(text)").count() == 0
    assert {r.doc_id for r in e.collect()} == left_after_pairs({r.doc_id: r.text for r in c.collect()})
    assert f.join(e, "doc_id", "left_anti").count() == 0 and 0 < f.count() < e.count()
    assert {r.doc_id for r in g.collect()} == {r.doc_id for r in f.collect()}
    assert g.where("size(ids) <> n_tokens").count() == 0
    texts = f.selectExpr("doc_id", "sha2(text, 256) AS own")
    assert g.join(texts, "doc_id").where("own <> decoded_sha256").count() == 0


def test_odd_rows(spark, odd, tmp_path):
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, str(tmp_path)), "t")
        assert "n_tokens" in docs.columns
