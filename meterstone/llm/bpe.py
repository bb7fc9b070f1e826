"""Byte-level BPE encoding and decoding with recursive queries in each partition.

Each task gives the distinct new words of its texts to DuckDB. There a recursive query keeps every
word's tokens, joins their positions with the merge table and contracts the word's leftmost pair of
minimum rank, until no pair of any word merges. Decoding joins token positions with the vocabulary
and aggregates the bytes in order. A text's ids are those of its words in order, so a round trip decodes the ids of each
distinct word once; Arrow then copies ids and bytes for every word of a piece by its place among the distinct ones. What one
task has found for a word or a run of tokens is kept for its next batches (bounded, see ``KEPT``; the older half goes first),
so the queries see a word about once.

Results for odd input: a null text counts as empty; an empty text has no ids and decodes to no bytes;
every input row gives one row, repeated ids included; other columns are ignored. Words above
``LONG_WORD`` bytes, where a query step per merge copies the whole word, are contracted by a heap with
the same order of merges.
"""

from __future__ import annotations

import base64
import heapq
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterstone.llm.common import arrow_map, id_type, map_text, slices

LONG_WORD = 96
#: Words and token runs a task remembers (beyond that it forgets the older half), and bytes of text it works on at once.
KEPT, PIECE = 500_000, 4 << 20
#: Words or token runs that one query gets: its tables are the most that a task holds.
ASKED = 10_000
RANK_FILE = "byte_bpe_50k.tiktoken"

MERGE = """
WITH RECURSIVE state(word, tokens, live) AS (
  SELECT word, tokens, true FROM start
  UNION ALL
  SELECT s.word,
         CASE WHEN best IS NULL THEN tokens
              ELSE tokens[:best % 65536 - 1] || [(best // 65536)::INT] || tokens[best % 65536 + 2:] END,
         best IS NOT NULL
  FROM state s LEFT JOIN (
    SELECT word, min(merged * 65536::BIGINT + pos) AS best
    FROM (SELECT word, unnest(range(1, len(tokens))) AS pos, unnest(tokens[:-2]) AS a, unnest(tokens[2:]) AS b
          FROM state WHERE live) p
    JOIN merges m ON m.a = p.a AND m.b = p.b GROUP BY word) USING (word)
  WHERE live)
SELECT word, tokens FROM state WHERE NOT live
"""
DECODE = """
SELECT run, unhex(array_to_string(list(bytes ORDER BY pos), '')) AS bytes
FROM (SELECT run, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM runs) r
JOIN vocabulary v ON v.token = r.token GROUP BY run
"""


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path(RANK_FILE)


@lru_cache(maxsize=2)
def splitters() -> tuple[re.Pattern, object]:
    """The public splitting pattern: for texts below U+0250 as plain classes (faster), and for any text."""
    import public_tokenizers
    import regex

    low = [chr(i) for i in range(0x250)]
    of = lambda test: "".join(f"\\u{ord(c):04x}" for c in low if test(c))
    letter, number = of(lambda c: unicodedata.category(c)[0] == "L"), of(lambda c: unicodedata.category(c)[0] == "N")
    space = of(lambda c: regex.match(r"\s", c) is not None)
    plain = public_tokenizers.PATTERN
    for known, own in ((r"[^\s\p{L}\p{N}]", f"[^{space}{letter}{number}]"), (r"\p{L}", f"[{letter}]"), (r"\p{N}", f"[{number}]"),
                       (r"(?!\S)", f"(?![^{space}])"), (r"\s", f"[{space}]")):
        plain = plain.replace(known, own)
    return re.compile(plain), regex.compile(public_tokenizers.PATTERN)


def split_words(text: str) -> list[str]:
    narrow, wide = splitters()
    # UTF-8 bytes below C9 are those of characters below U+0240
    return (narrow if text.isascii() or np.frombuffer(text.encode(), dtype=np.uint8).max() < 0xC9 else wide).findall(text)


class Codec:
    """Vocabulary, merge table and what was found so far, one for each worker process."""

    def __init__(self, path: str, kept: int = KEPT):
        import duckdb

        self.kept = kept
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.single = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        merges = [(self.ranks[t[:k]], self.ranks[t[k:]], r) for t, r in self.ranks.items() for k in range(1, len(t))
                  if t[:k] in self.ranks and t[k:] in self.ranks]
        self.opens = np.zeros(max(self.ranks.values()) + 1, dtype=bool)  # tokens that begin with a space: decoding may cut before them
        for t, r in self.ranks.items():
            self.opens[r] = t[:1] == b" "
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        a, b, r = (pa.array(x, pa.int32()) for x in zip(*merges))
        self.fill("merges", pa.table({"a": a, "b": b, "merged": r}))
        self.fill("vocabulary", pa.table({"token": pa.array(self.ranks.values(), pa.int32()), "bytes": [t.hex() for t in self.ranks]}))
        self.ids: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.runs: dict[bytes, bytes] = {}

    def fill(self, name: str, rows: pa.Table) -> None:
        self.con.register("given", rows)
        self.con.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM given")
        self.con.unregister("given")

    def ask(self, name: str, rows: pa.Table, query: str) -> pa.Table:
        self.con.register(name, rows)
        out = self.con.sql(query).to_arrow_table()
        self.con.unregister(name)
        return out

    def learn(self, words: list[str]) -> None:
        """Ids of words not met before."""
        todo, coded = [], []
        for w, b in zip(words, map(str.encode, words)):
            if b in self.ranks:
                self.ids[w] = np.int32(self.ranks[b]).tobytes()
            elif len(b) > LONG_WORD:
                self.ids[w] = self.contract(b).tobytes()
            else:
                todo.append(w)
                coded.append(b)
        for at in range(0, len(todo), ASKED):
            part, own = todo[at:at + ASKED], coded[at:at + ASKED]
            ends = np.concatenate([[0], np.cumsum(list(map(len, own)))]).astype(np.int32)
            tokens = pa.ListArray.from_arrays(pa.array(ends), pa.array(self.single[np.frombuffer(b"".join(own), dtype=np.uint8)]))
            out = self.ask("start", pa.table({"word": np.arange(len(part), dtype=np.int32), "tokens": tokens}), MERGE)
            tokens = out["tokens"].combine_chunks()
            flat, ends = tokens.flatten().to_numpy().tobytes(), (tokens.offsets.to_numpy() - tokens.offsets[0].as_py()) * 4
            for k, a, b in zip(_objects(out["word"]), ends[:-1].tolist(), ends[1:].tolist()):
                self.ids[part[k]] = flat[a:b]

    def contract(self, word: bytes) -> np.ndarray:
        """The same contraction for one very long word, with a heap of (rank, place)."""
        token, rank = [bytes([b]) for b in word], self.ranks.get
        after, before = list(range(1, len(token) + 1)), list(range(-1, len(token) - 1))
        heap = [(r, i) for i in range(len(token) - 1) if (r := rank(token[i] + token[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if token[i] is None or j >= len(token) or rank(token[i] + token[j]) != r:
                continue
            token[i], token[j], after[i] = token[i] + token[j], None, after[j]
            if after[i] < len(token):
                before[after[i]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] < len(token) and (r := rank(token[left] + token[after[left]])) is not None:
                    heapq.heappush(heap, (r, left))
        return np.array([self.ranks[t] for t in token if t is not None], dtype=np.int32)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as int32 bytes."""
        return self.round_trip(texts, False)[0]

    def round_trip(self, texts: list[str], back: bool = True) -> tuple[list[bytes], list[bytes]]:
        """Ids of each text as int32 bytes, and (with ``back``) the bytes that decoding them gives."""
        ids, decoded = self.spread(texts, back)
        return [np.asarray(x.values, dtype=np.int32).tobytes() for x in ids], decoded.to_pylist() if back else []

    def spread(self, texts: list[str], back: bool = True) -> tuple[pa.ListArray, pa.BinaryArray | None]:
        """The same as Arrow columns: Python looks at the distinct words only, Arrow repeats what is found for each occurrence."""
        parts = [pa.array(split_words(t), pa.string()) for t in texts]
        ends = pa.array(np.concatenate([[0], np.cumsum(list(map(len, parts)))]).astype(np.int64))
        coded = pa.concat_arrays(parts or [pa.array([], pa.string())]).dictionary_encode()
        del parts
        one, place = _objects(coded.dictionary), coded.indices
        self.learn([w for w in one if w not in self.ids])
        raw = list(map(self.ids.__getitem__, one))
        ids, decoded = _id_lists(raw).take(place), None
        ids = pa.ListArray.from_arrays(ids.offsets.take(ends), ids.values)
        if back:
            new = [k for k, w in enumerate(one) if w not in self.words]
            self.words.update(zip([one[k] for k in new], self.bytes_of([raw[k] for k in new])))
            decoded = pa.array(list(map(self.words.__getitem__, one)), pa.binary()).take(place)
            _, at, data = decoded.buffers()
            at = pa.Array.from_buffers(pa.int32(), len(place) + 1, [None, at]).take(ends)
            decoded = pa.Array.from_buffers(pa.binary(), len(texts), [None, at.buffers()[1], data])
        forget(self.ids, one, self.kept)
        if back:
            forget(self.words, one, self.kept)
        return ids, decoded

    def bytes_of(self, runs: list[bytes]) -> list[bytes]:
        """The bytes of runs of ids."""
        out: list[bytes] = []
        for at in range(0, len(runs), ASKED):
            part = runs[at:at + ASKED]
            ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in part])]).astype(np.int32)
            tokens = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(part), dtype=np.int32)))
            found = self.ask("runs", pa.table({"run": pa.array(np.arange(len(part), dtype=np.int32)), "tokens": tokens}), DECODE)
            own: list = [b""] * len(part)
            for k, b in zip(_objects(found["run"]), _objects(found["bytes"])):
                own[k] = b
            out += own
        return out

    def decode(self, rows: list[np.ndarray]) -> list[bytes]:
        """Bytes of each id sequence: cut before tokens that begin a word, each distinct run is decoded once."""
        runs = []
        for ids in rows:
            raw = ids.tobytes()
            cuts = np.flatnonzero(self.opens[ids[1:]]) + 1 if len(ids) else []
            at = [0, *(np.asarray(cuts) * 4).tolist(), len(raw)]
            runs.append([raw[a:b] for a, b in zip(at, at[1:])] if len(ids) else [])
        met = set().union(*runs)
        new = list(met.difference(self.runs))
        self.runs.update(zip(new, self.bytes_of(new)))
        out = [b"".join(map(self.runs.__getitem__, r)) for r in runs]
        forget(self.runs, met, self.kept)
        return out


def forget(kept: dict, met: Iterable, most: int) -> None:
    """Drops the older half of what goes over ``most``; what was just ``met`` is the newest, so frequent words stay."""
    if len(kept) > most:
        for k in met:
            kept[k] = kept.pop(k)
        for k in list(islice(kept, len(kept) - most // 2)):
            del kept[k]


@lru_cache(maxsize=2)
def codec(path: str, kept: int = KEPT) -> Codec:
    return Codec(path, kept)


def _objects(column: pa.Array | pa.ChunkedArray) -> list:
    """The values of a column without nulls (faster than ``to_pylist``, which makes a scalar of each)."""
    return (column.to_numpy() if isinstance(column, pa.ChunkedArray) else column.to_numpy(zero_copy_only=False)).tolist()


def _id_lists(raw: list[bytes]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in raw])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(raw), dtype=np.int32)))


def _encoded(path: str, batches: Iterator[pa.RecordBatch], back: bool, kept: int = KEPT, piece: int = PIECE) -> Iterator[pa.RecordBatch]:
    own = codec(path, kept)
    for part in slices(batches, limit=piece):
        ids, decoded = own.spread(part.column(1).to_pylist(), back)
        out = {"id": part.column(0), "ids": ids}
        if back:
            out["bytes"] = decoded
        yield pa.RecordBatch.from_pydict(out)


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None) -> DataFrame:
    """(id, ids): the token ids of every text."""
    path = ranks_path or default_ranks()
    return map_text(df, id_col, text_col, lambda it: _encoded(path, it, False), f"id {id_type(df, id_col)}, ids array<int>").withColumnRenamed("id", id_col)


def round_trip(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None, kept: int = KEPT, piece: int = PIECE) -> DataFrame:
    """(id, ids, bytes): token ids of every text and the bytes that decoding these ids gives, in one pass.

    Fewer words ``kept`` and smaller pieces take less memory and more time; the rows are the same.
    """
    path = ranks_path or default_ranks()
    schema = f"id {id_type(df, id_col)}, ids array<int>, bytes binary"
    return map_text(df, id_col, text_col, lambda it: _encoded(path, it, True, kept, piece), schema).withColumnRenamed("id", id_col)


def decode(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", ranks_path: str | None = None) -> DataFrame:
    """(id, bytes): the bytes of every id sequence (null: none). Ids outside the vocabulary raise."""
    path = ranks_path or default_ranks()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids = [np.array(x or [], dtype=np.int32) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_pydict({"id": part.column(0), "bytes": pa.array(own.decode(ids), pa.binary())})

    pair = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{ids_col}`").cast("array<int>").alias("ids"))
    return arrow_map(pair, work, f"id {id_type(df, id_col)}, bytes binary").withColumnRenamed("id", id_col)


def digests(df: DataFrame, ids: bool = False, **columns) -> DataFrame:
    """Per document: number of tokens, digest of the ids and digest of the decoded bytes (with ``ids`` the ids too)."""
    out, key = round_trip(df, **columns), columns.get("id_col", "doc_id")
    return out.select(
        key, F.size("ids").cast("long").alias("n_tokens"), *(["ids"] if ids else []),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
