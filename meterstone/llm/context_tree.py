"""Language-model scores by context-tree weighting over bytes.

A text is its bytes (A-Z lower-cased), closed by the byte 0xFF, which UTF-8 never holds and which also
stands before every text. The next byte is told bit by bit: its eight bits walk down a binary tree of 255 nodes, and every
node has its own tree of contexts, the last 0 to ``depth`` bytes. A context s of a node with a zeros and b ones
has the Krichevsky-Trofimov probability Pe(a, b); its weighted probability is Pe at full depth and otherwise
Pw = 1/2 Pe + 1/2 (product of Pw over the longer contexts). A bit's probability is what Pw of the empty context becomes with
that bit put in, over what it was: a mix of the estimates of all depths, weighted by how well each told the training
texts. These ratios depend on counts only, so nothing has an order and training is counting.

Spark steps. (1) Texts are written in blocks of ``BLOCK`` bytes. (2) Every block gives its distinct grams (context and byte)
and distinct words with their counts in training texts. (3) Grams are counted over all blocks; contexts that share their last
two bytes are solved together (at most 256 ** (depth - 1) grams, most far fewer), the two shortest depths from sums
over these (65,280 nodes at most, which alone reach the driver). (4) Every block gets the values of its own grams and words back,
then its texts, and sums them. Dictionaries are as large as a block's own content; the model is never held whole anywhere.

Results for odd input: null and empty texts have one token (the end) and the score of the end at once; a null id is
of the training part; rows with equal ids give one row each; no training rows give every bit 1/2; other columns are
ignored; no rows give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterstone.llm.common import arrow_map, id_type, slices, written

DEPTH, FOLDS, HELD_OUT = 4, 5, 1
#: Bytes of text a block has, bytes a task works on at once, grams solved together.
BLOCK, PIECE, SOLVED = 16 << 20, 1 << 20, 100_000
END = b"\xff"
#: Words above this length are named by length and digest.
LONG_WORD = 48
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def word_key(word: bytes) -> bytes:
    if len(word) <= LONG_WORD:
        return word
    import hashlib

    return b" %d %s" % (len(word), hashlib.sha256(word).digest())  # words hold no blank, so no word looks like this


def parts_of(body: bytes, depth: int, piece: int = PIECE) -> Iterator[bytes]:
    """The text in pieces, each after the ``depth`` bytes before it, the last one closed."""
    whole = END * depth + body + END
    for at in range(0, len(body) + 1, piece):
        yield whole[at:at + depth + piece]


def codes(parts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Gram of every byte that is no lead-in (context from the last byte on, then the byte), and their number in each part."""
    a = np.frombuffer(b"".join(parts), dtype=np.uint8).astype(np.int64)
    size = np.array([len(p) for p in parts], dtype=np.int64)
    out = a[depth:].copy()
    for d in range(1, depth + 1):
        out |= a[depth - d:len(a) - d] << (8 * (depth - d + 1))
    keep = np.ones(len(a), dtype=bool)
    keep[((np.cumsum(size) - size)[:, None] + np.arange(depth)).ravel()] = False
    return out[keep[depth:]], size - depth


def _in_pieces(bodies: list[bytes], depth: int) -> Iterator[tuple[list[bytes], list[int]]]:
    """Parts of about ``PIECE`` bytes together and the number of the text each belongs to."""
    parts: list[bytes] = []
    owner: list[int] = []
    held = 0
    for k, body in enumerate(bodies):
        for part in parts_of(body, depth):
            if held and held + len(part) > PIECE:
                yield parts, owner
                parts, owner, held = [], [], 0
            parts.append(part)
            owner.append(k)
            held += len(part)
    if parts:
        yield parts, owner


def _merged(sets: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    code, n = (np.concatenate(x) for x in zip(*sets))
    order = np.argsort(code, kind="stable")
    code, n = code[order], n[order]
    at = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else np.zeros(0, dtype=int)
    return code[at], (np.add.reduceat(n, at) if len(at) else n)


def blocks(df: DataFrame, id_col: str, text_col: str, block: int) -> DataFrame:
    """(block, id, held_out, body): lower-cased bytes of every text, in blocks of consecutive rows."""
    fold = F.pmod(F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))), F.lit(FOLDS))
    rows = df.select(F.col(f"`{id_col}`").alias("id"), (fold == HELD_OUT).alias("held_out"),
                     F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary").alias("body"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, filled = TaskContext.get().partitionId() << 32, 0
        for part in slices(batches, 2):
            body = [b.translate(_LOWER) for b in part.column(2).to_pylist()]
            of = []
            for b in body:
                if filled and filled + len(b) > block:
                    number, filled = number + 1, 0
                filled += len(b) + 1
                of.append(number)
            yield pa.RecordBatch.from_pydict({"block": pa.array(of, pa.int64()), "id": part.column(0), "held_out": part.column(1), "body": pa.array(body, pa.binary())})

    return arrow_map(rows, work, f"block long, id {id_type(df, id_col)}, held_out boolean, body binary")


def gathered(held: DataFrame, depth: int) -> DataFrame:
    """(block, gram, word, n): distinct grams (word null) and words (gram null) of every block with their count in training texts."""

    def flush(block: int, grams: list, words: Counter) -> Iterator[pa.RecordBatch]:
        code, n = _merged(grams)
        for at in range(0, len(code), 100_000):
            c, k = code[at:at + 100_000], n[at:at + 100_000]
            yield pa.RecordBatch.from_pydict({"block": np.full(len(c), block), "gram": c, "word": pa.nulls(len(c), pa.binary()), "n": k})
        own = list(words.items())
        for at in range(0, len(own), 50_000):
            w, k = zip(*own[at:at + 50_000])
            yield pa.RecordBatch.from_pydict({"block": np.full(len(w), block), "gram": pa.nulls(len(w), pa.int64()), "word": pa.array(map(word_key, w), pa.binary()), "n": pa.array(k, pa.int64())})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, grams, words = None, [], Counter()
        for part in slices(batches, 2):
            of, out, body = part.column(0).to_numpy(), part.column(1).to_numpy(zero_copy_only=False), part.column(2).to_pylist()
            cuts = np.r_[0, np.flatnonzero(of[1:] != of[:-1]) + 1, len(of)]
            for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if block is not None and of[i] != block:
                    yield from flush(block, grams, words)
                    grams, words = [], Counter()
                block = int(of[i])
                for training in (True, False):
                    texts = [body[k] for k in range(i, j) if out[k] != training]
                    for parts, _ in _in_pieces(texts, depth):
                        code, n = np.unique(codes(parts, depth)[0], return_counts=True)
                        grams.append((code, n if training else np.zeros_like(n)))
                    for t in texts:
                        if training:
                            words.update(t.split())  # bytes.split cuts at space and 0x09-0x0D
                        else:
                            words.update(dict.fromkeys(t.split(), 0))
                if len(grams) > 8:
                    grams = [_merged(grams)]
        if block is not None:
            yield from flush(block, grams, words)

    return arrow_map(held.select("block", "held_out", "body"), work, "block long, gram long, word binary, n long")


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x > 0 (Stirling's series at x + 8)."""
    y = x + 8.0
    lower = np.ones_like(y)
    for k in range(8):
        lower = lower * (x + k)
    z = 1 / (y * y)
    series = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z * (1 / 1680 - z / 1188)))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - np.log(lower)


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of a zeros and b ones."""
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1.0) - math.log(math.pi)


def weighted(pe: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log Pw, weight of the node's own estimate) from log Pe and the summed log Pw of its longer contexts."""
    pw = np.logaddexp(pe, below) - math.log(2)
    return pw, 0.5 * np.exp(pe - pw)


class Solved:
    """The nodes of all grams that share their last two context bytes, for context lengths ``depth`` to 2 (or less)."""

    def __init__(self, code: np.ndarray, n: np.ndarray, depth: int):
        byte = code & 255
        self.bits = np.stack([(byte >> (7 - k)) & 1 for k in range(8)], axis=1)
        node = np.stack([(1 << k) | (byte >> (8 - k)) for k in range(8)], axis=1)
        key, self.at = np.unique((code >> 8)[:, None] * 256 + node, return_inverse=True)
        self.at = self.at.reshape(len(code), 8)
        one = self.bits.astype(bool)
        count = np.broadcast_to(n[:, None], one.shape)
        sums = lambda at, w: np.bincount(at.ravel(), weights=w.ravel(), minlength=at.max() + 1)
        a, b = sums(self.at, np.where(one, 0, count)), sums(self.at, np.where(one, count, 0))
        pw = log_kt(a, b)
        self.levels = [(a, b, np.ones_like(a), None)]  # at full depth only the own estimate counts
        for _ in range(depth - min(2, depth)):
            key, up = np.unique(((key >> 16) << 8) | (key & 255), return_inverse=True)
            below, a, b = sums(up, pw), sums(up, a), sums(up, b)
            pw, own = weighted(log_kt(a, b), below)
            self.levels.append((a, b, own, up))
        self.key, self.pw = key, pw

    def sums(self) -> tuple[np.ndarray, ...]:
        """For contexts of one byte: (node, a, b, summed log Pw)."""
        a, b = self.levels[-1][:2]
        key, up = np.unique(((self.key >> 16) << 8) | (self.key & 255), return_inverse=True)
        return key, *(np.bincount(up, weights=w, minlength=len(key)) for w in (a, b, self.pw))

    def scores(self, top: Top, code: np.ndarray, depth: int) -> np.ndarray:
        """log10 of each gram's probability."""
        at = self.at
        a, b, _, _ = self.levels[0]
        p = (np.where(self.bits, b[at], a[at]) + 0.5) / (a[at] + b[at] + 1)
        for a, b, own, up in self.levels[1:]:
            at = up[at]
            p = own[at] * (np.where(self.bits, b[at], a[at]) + 0.5) / (a[at] + b[at] + 1) + (1 - own[at]) * p
        node = self.key[at] & 255
        last = (code >> (8 * depth))[:, None] & 255
        return np.log10(top.mixed(p, self.bits, node, last)).sum(axis=1)


class Top:
    """Contexts of one byte and none, as dense tables over (byte, node): 65,536 entries whatever the corpus."""

    def __init__(self, rows: list):
        self.a, self.b, below = np.zeros((256, 256)), np.zeros((256, 256)), np.zeros((256, 256))
        for r in rows:
            at = (r["key"] >> 8, r["key"] & 255)
            self.a[at], self.b[at], below[at] = r["a"], r["b"], r["pw"]
        pw, self.own = weighted(log_kt(self.a, self.b), below)
        self.a0, self.b0 = self.a.sum(axis=0), self.b.sum(axis=0)
        _, self.own0 = weighted(log_kt(self.a0, self.b0), pw.sum(axis=0))

    def mixed(self, p: np.ndarray, bits: np.ndarray, node: np.ndarray, last: np.ndarray) -> np.ndarray:
        a, b, own = self.a[last, node], self.b[last, node], self.own[last, node]
        p = own * (np.where(bits, b, a) + 0.5) / (a + b + 1) + (1 - own) * p
        a, b, own = self.a0[node], self.b0[node], self.own0[node]
        return own * (np.where(bits, b, a) + 0.5) / (a + b + 1) + (1 - own) * p


def _by_suffix(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(code, n) of whole groups of equal last two bytes, about ``SOLVED`` grams at once; rows come sorted by code."""
    code, n = [], []
    held = 0
    for batch in batches:
        code.append(batch.column(0).to_numpy())
        n.append(batch.column(1).to_numpy())
        held += batch.num_rows
        if held >= SOLVED:
            c, k = np.concatenate(code), np.concatenate(n)
            group = c >> (8 * (depth - 1))
            cut = int(np.searchsorted(group, group[-1])) if len(c) else 0
            if cut:
                yield c[:cut], k[:cut]
            code, n, held = [c[cut:]], [k[cut:]], len(c) - cut
    if held:
        yield np.concatenate(code), np.concatenate(n)


def gram_scores(grams: DataFrame, depth: int) -> DataFrame:
    """(gram, value): log10 probability of every gram of ``grams`` (gram, n), n counted in training texts."""
    suffix = F.shiftright("gram", 8 * (depth - 1))
    grouped = grams.select("gram", "n").repartition(suffix).sortWithinPartitions("gram")

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for code, n in _by_suffix(batches, depth):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in Solved(code, n, depth).sums()], names=["key", "a", "b", "pw"])

    sums = arrow_map(grouped, up, "key long, a double, b double, pw double").groupBy("key").agg(*(F.sum(c).alias(c) for c in ("a", "b", "pw")))
    top = Top(sums.collect())  # at most 256 * 255 rows

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for code, n in _by_suffix(batches, depth):
            yield pa.RecordBatch.from_pydict({"gram": code, "value": Solved(code, n, depth).scores(top, code, depth)})

    return arrow_map(grouped, down, "gram long, value double")


class Places:
    """Places of grams in a sorted array: a table of slots by hash, and a search for grams whose slot another one holds."""

    def __init__(self, grams: np.ndarray):
        bits = min(22, max(10, (4 * len(grams)).bit_length()))
        self.grams, self.shift, self.slots = grams, np.uint64(64 - bits), np.zeros(1 << bits, dtype=np.int32)
        self.slots[self.slot(grams)] = np.arange(len(grams), dtype=np.int32)

    def slot(self, code: np.ndarray) -> np.ndarray:
        return (code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def of(self, code: np.ndarray, step: int = 1 << 18) -> np.ndarray:
        out = np.empty(len(code), dtype=np.int32)
        for i in range(0, len(code), step):
            part = code[i:i + step]
            at = self.slots[self.slot(part)]
            other = np.flatnonzero(self.grams[at] != part)
            if len(other):
                found = np.searchsorted(self.grams, part[other])
                if (self.grams[np.minimum(found, len(self.grams) - 1)] != part[other]).any():
                    raise ValueError("a gram of a text is not among its block's grams")
                at[other] = found
            out[i:i + step] = at
        return out


def _scored(depth: int, n_train: int, n_distinct: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (block, kind): a block's words, its grams, its texts."""
    block, words, shares, grams, values = None, {}, {}, [], []
    total = n_train + 0.5 * (n_distinct + 1)
    of_count = lambda c: math.log10((c + 0.5) / total)
    for batch in slices(batches, 7):
        own, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        cuts = np.r_[0, np.flatnonzero((own[1:] != own[:-1]) | (kind[1:] != kind[:-1])) + 1, len(own)]
        for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if own[i] != block:
                block, words, shares, grams, values = own[i], {}, {}, [], []
            part = batch.slice(i, j - i)
            if kind[i] == 0:
                words.update(zip(part.column(3).to_pylist(), part.column(4).to_pylist()))
            elif kind[i] == 1:
                grams.append(part.column(2).to_numpy())
                values.append(part.column(4).to_numpy())
            else:
                if not shares:  # the first text of the block: its dictionaries are complete
                    code, value = np.concatenate(grams), np.concatenate(values)
                    order = np.argsort(code)
                    grams, values = [Places(code[order])], [value[order]]
                    shares = {c: of_count(c) for c in set(words.values())}
                yield _texts(part, depth, words, shares, grams[0], values[0])


def _texts(part: pa.RecordBatch, depth: int, words: dict, shares: dict, grams: Places, values: np.ndarray) -> pa.RecordBatch:
    bodies = part.column(7).to_pylist()
    base, n_tokens, n_known = [], [], []
    for body in bodies:
        own = body.split()
        try:
            counts = [words[w] for w in own]
        except KeyError:
            counts = [words[word_key(w)] for w in own]
        counts.append(words[b""])
        base.append(math.fsum(map(shares.__getitem__, counts)))
        n_tokens.append(len(counts))
        n_known.append(len(counts) - counts.count(0))
    score = np.zeros(len(bodies))
    for parts, owner in _in_pieces(bodies, depth):
        code, size = codes(parts, depth)
        np.add.at(score, owner, np.add.reduceat(values[grams.of(code)], np.cumsum(size) - size))
    return pa.RecordBatch.from_pydict({
        "id": part.column(5), "held_out": part.column(6), "n_tokens": pa.array(n_tokens, pa.int64()), "n_known": pa.array(n_known, pa.int64()),
        "base_score": pa.array(base, pa.float64()), "score": score, "n_bytes": pa.array([len(b) for b in bodies], pa.int64())})


def score(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, block: int = BLOCK) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte): one row a text.

    ``score`` is the log10 probability of the text's bytes and its end; ``base_score`` that of its words and end
    under counts with a half added. The part crc32(id) mod 5 = 1 is held out of all counts. ``depth``: 2 to 6.
    """
    if not 2 <= depth <= 6:
        raise ValueError("depth is 2 to 6")
    held = written(blocks(df, id_col, text_col, block), "blocks")
    found = written(gathered(held, depth), "gathered")
    ends = held.agg(F.count_if(~F.col("held_out"))).first()[0]
    grams = written(found.where("word IS NULL").groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    values = written(gram_scores(grams, depth), "gram-values")
    every = Window.partitionBy("word")
    words = found.where("gram IS NULL").select("block", "word", F.sum("n").over(every).alias("c"), (F.min("block").over(every) == F.col("block")).alias("once"))
    words = written(words, "word-counts")
    totals = words.where("once").agg(F.sum("c"), F.count_if(F.col("c") > 0)).first()
    n_train, n_distinct = (totals[0] or 0) + ends, totals[1] + (ends > 0)

    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    kind_of_id = id_type(df, id_col)
    doc_columns = (none(kind_of_id, "id"), none("boolean", "held_out"), none("binary", "body"))
    value = F.col("c").cast("double").alias("value")
    word_rows = words.select("block", F.lit(0).alias("kind"), none("long", "gram"), "word", value, *doc_columns)
    end_rows = held.select("block").distinct().select("block", F.lit(0).alias("kind"), none("long", "gram"), F.lit(b"").alias("word"), F.lit(float(ends)).alias("value"), *doc_columns)
    gram_rows = found.where("word IS NULL").select("block", "gram").join(values, "gram").select("block", F.lit(1).alias("kind"), "gram", none("binary", "word"), "value", *doc_columns)
    text_rows = held.select("block", F.lit(2).alias("kind"), none("long", "gram"), none("binary", "word"), none("double", "value"), "id", "held_out", "body")
    rows = word_rows.unionByName(end_rows).unionByName(gram_rows).unionByName(text_rows).repartition("block").sortWithinPartitions("block", "kind")
    schema = f"id {kind_of_id}, held_out boolean, n_tokens long, n_known long, base_score double, score double, n_bytes long"
    out = arrow_map(rows, lambda it: _scored(depth, n_train, n_distinct, it), schema)
    return out.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"), "base_score", "score",
                      (-F.col("score") * math.log2(10) / (F.col("n_bytes") + 1)).alias("bits_per_byte"))
