"""Ids as the tiktoken library gives them, and exact round trips."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from meterstone.llm import bpe
from meterstone.llm.common import table


@pytest.fixture(scope="module")
def reference():
    with open(bpe.default_ranks(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_whole_table(spark, small_folder, reference):
    texts = {r.doc_id: r.text for r in table(spark, small_folder, "documents").collect()}
    got = {r.doc_id: r for r in bpe.digests(table(spark, small_folder, "documents")).collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        ids = reference.encode_ordinary(t)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_odd_rows(odd, none, reference):
    rows = bpe.round_trip(odd).collect()
    want = sorted((str(r.doc_id), r.text or "") for r in odd.collect())
    assert sorted((str(r.doc_id), bytes(r.bytes).decode()) for r in rows) == want
    assert sorted(map(tuple, (r.ids for r in rows))) == sorted(tuple(reference.encode_ordinary(t)) for _, t in want)
    assert bpe.digests(none).count() == 0


def test_decode_alone(spark, odd):
    ids = bpe.encode(odd.where("doc_id = 7"))
    assert bytes(bpe.decode(ids).first().bytes).decode() == odd.where("doc_id = 7").first().text


def test_random_words_and_long_ones(reference):
    rng, own = random.Random(3), bpe.codec(bpe.default_ranks())
    texts = ["".join(rng.choice("abteh 'é漢\U0001f600 1\n!s") for _ in range(rng.randint(0, 80))) for _ in range(400)]
    texts += ["".join(rng.choice("abcdefgh") for _ in range(n)) for n in (500, 513, 3000)] + ["a" * 2000, " " * 700, "ab" * 900]
    for t, raw in zip(texts, own.encode(texts)):
        assert list(memoryview(raw).cast("i")) == reference.encode_ordinary(t), t[:50]


def test_query_and_heap_agree():
    own = bpe.codec(bpe.default_ranks())
    words = ["thetheiningtion", "erstwhanthere", "aaaaaaaaaaaa", "réeuxêment"]
    own.ids.clear()
    own.learn(words)
    for w in words:
        assert own.ids[w] == own.contract(w.encode()).tobytes()


def test_a_small_memory_gives_the_same_ids_and_keeps_what_was_just_met(reference):
    texts = [" ".join(f"w{chr(97 + k)}{chr(97 + i % 26)}{chr(97 + i // 26)} frequent" for i in range(60)) for k in range(8)]
    small = bpe.Codec(bpe.default_ranks(), 150)
    for t in texts:
        ids, back = small.round_trip([t])
        assert ids[0] == b"".join(i.to_bytes(4, "little") for i in reference.encode_ordinary(t)) and back == [t.encode()]
        assert " frequent" in small.ids and len(small.ids) <= 150 and len(small.words) <= 150


def test_a_small_memory_gives_the_same_rows(spark):
    docs = spark.createDataFrame([(i, f"text {i} of number{i % 7}\n" * (i % 5)) for i in range(50)], "doc_id long, text string")
    assert bpe.digests(docs, kept=20, piece=64).exceptAll(bpe.digests(docs)).isEmpty()


def test_a_word_is_looked_up_once_however_often_it_occurs(reference):
    class Counted(dict):
        looks = 0

        def __getitem__(self, word):
            self.looks += 1
            return super().__getitem__(word)

    own, texts = bpe.Codec(bpe.default_ranks()), [" word wörter" * 500, "", " 漢字 word" * 300 + "\n", ""]
    own.ids, own.words = Counted(), Counted()
    ids, back = own.round_trip(texts)
    assert [list(memoryview(x).cast("i")) for x in ids] == [reference.encode_ordinary(t) for t in texts]
    assert back == [t.encode() for t in texts]
    assert own.ids.looks <= 10 and own.words.looks <= 10


def test_pieces_without_words(reference):
    own = bpe.Codec(bpe.default_ranks())
    assert own.round_trip([]) == ([], [])
    assert own.round_trip(["", ""]) == ([b"", b""], [b"", b""])
    ids, back = own.spread(["", "a b", ""])
    assert ids.to_pylist() == [[], reference.encode_ordinary("a b"), []] and back.to_pylist() == [b"", b"a b", b""]


def test_both_patterns_split_alike_around_their_border(reference):
    for t in ("ȿword ɀword", "Ɉ'll ɏ's", "ɐword ɏ", "ÿ  x\u0085\n ƻ"):
        assert "".join(bpe.split_words(t)) == t
        assert bpe.split_words(t) == bpe.splitters()[1].findall(t)
        assert bpe.codec(bpe.default_ranks()).encode([t])[0] == b"".join(i.to_bytes(4, "little") for i in reference.encode_ordinary(t))
