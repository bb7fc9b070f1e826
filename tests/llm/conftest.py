"""Odd rows every text operator must take."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, bits long, version long, component_id long, shard string, gone string, score double"
LINE = " ".join(f"wort{i}" for i in range(60))


def row(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, None, "x", 1, 2, 3, "y", "z", 0.5)


ODD = [
    row(1, "You are an idiot and a moron, said nobody.\n" + LINE + "\nend of it"), row(2, LINE + "\nanother end of the text"), row(3, LINE), row(3, LINE),
    row(4, None), row(5, ""), row(6, "   \n\n \t"), row(None, "text without an id but with words"), row(None, None, None, None),
    row(7, "a" * 30_000 + " " + "1" * 20_000 + "\n" * 3 + "é ü ñ 漢字 \U0001f600 token"), row(8, "word " * 20_000), row(9, "\n".join(["same line here"] * 3000)),
    row(10, "x"), row(11, "X"), row(12, "one two three four five"), row(13, "One  two\tthree\nfour five"),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
