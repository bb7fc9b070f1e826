"""The loser tree, the index order, and archives read back."""

import random

from meterstone.llm import warc
from meterstone.session import scratch_path

ROWS = [
    (1, "http://www.b.org/x?Q=1", "p" * 200), (2, "https://a.com/", "p" * 200), (3, "http://a.com/y", None), (4, None, ""), (5, "a.com", "short"), (6, "a.com", "short"),
    (None, "http://c.net", "p" * 200), (7, "http://[broken", "WARC/1.1\r\n\r\nin a payload\r\n\r\n" * 20), (8, "x\r\ny", "é漢" * 100), (9, "z", "é漢" * 100), (10, "z", "q" * 300_000),
]


def test_loser_tree():
    rng = random.Random(1)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted((rng.randrange(50), i) for _ in range(rng.randrange(30))) for i in range(k)]
        assert list(warc.LoserTree(runs)) == sorted(x for r in runs for x in r)


def test_url_keys():
    assert warc.url_key("https://www.Example.com:443/A/b?Q=1#f") == "com,example)/a/b?q=1"
    assert warc.url_key("http://u:p@sub.example.com") == "com,example,sub)/"


def test_round_trip(spark):
    df = spark.createDataFrame([(*r, "extra", 1) for r in ROWS], "page_id long, url string, html string, digest string, run int").repartition(3)
    folder = scratch_path(spark, "warc")
    runs = warc.write(df, folder, archive_bytes=500)
    assert runs.select("archive").distinct().count() > 3
    index = warc.merge_index(runs)
    order = [(r.url_key, r.stamp, r.id is None, r.id or 0) for r in index.collect()]
    assert order == sorted(order) and len(order) == len(ROWS)
    back = warc.read(index, folder, payloads=True).collect()
    of = {r.page_id: r for r in back}
    assert of[1].record_type == "response" and (of[2].record_type, of[2].refers_to) == ("revisit", 1) and of[None].record_type == "response"
    assert {of[i].record_type for i in (3, 4, 5, 6, 8)} == {"response"} and of[9].refers_to == 8 and of[9].payload_bytes == 500
    for i, _, html in ROWS:
        assert of[i].payload is None if of[i].record_type == "revisit" else of[i].payload == (html or "")


def test_empty(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
