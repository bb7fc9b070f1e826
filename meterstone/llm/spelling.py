"""Spelling variants of words, by k-d trees over letter counts.

Words are counted over all texts. One inserted, deleted or replaced letter changes the vector of a word's letter counts by one step
up, one step down, or both: an L1 distance of at most two. A k-d tree splits the words of one length by the count of one letter at a
time. A search goes down it with one step up and one down to spend (one up only for the words one longer), so it leaves a box as
soon as the box asks for a second letter. Vectors in reach give pairs of words, whose letter order is then compared; equal vectors are one point.

Spark steps. (1) Counts, summed in each task first. (2) The upper levels of the tree of every length come from the ``SAMPLE`` words of
smallest hash; every word goes to its own leaf, and to the leaves in its reach among its length (each pair of leaves once) and the
next. A leaf with more than ``LETTERS`` letters of words is dealt out to tiles, which all its searchers visit. (3) A task builds the tree
of a tile and searches it with as many words as come; counts and best partners are summed by word. (4) Chains of forms are followed by joins that double.

Results for odd input: null and empty texts have no words; a null id counts as an empty one; rows with equal ids count each; other
columns are ignored; no words give no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterstone.llm.common import arrow_map, map_text, slices, written

LEAST_LETTERS, LEAST_COUNT, RATIO, SPOILED = 5, 3, 2, 97
#: Words the upper tree levels are fitted on, letters of words a tile holds, vectors a leaf of a task's tree holds, words a task counts at once.
SAMPLE, LETTERS, LEAF, KEPT = 40_000, 400_000, 24, 500_000
#: Letters in code-point order; a word's letters are their places here.
ALPHABET = "".join(map(chr, [*range(0x61, 0x7B), *range(0xC0, 0x100)]))
_RUN = re.compile("[a-zÀ-ÿ]+")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_PLACE = np.zeros(256, dtype=np.uint8)
_PLACE[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
SAME, LONGER = 0, 1


def spoiled(run: str, key: int) -> str:
    """A rule to put known variants into a corpus: a run whose checksum is divisible by ``SPOILED`` loses one letter."""
    h = zlib.crc32(run.encode(), key)
    if h % SPOILED:
        return run
    i = h % len(run)
    return run[:i] + run[i + 1:]


def words(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", spoil: bool = False, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n): runs of letters of ``LEAST_LETTERS`` or more that occur ``least`` times or more; ``spoil`` puts in known variants."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter[str] = Counter()
        for part in slices(batches):
            for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                own = Counter(_RUN.findall(t.encode().translate(_LOWER).decode()))
                key = zlib.crc32(("" if i is None else f"{i}").encode() + b":")
                for run, n in own.items():
                    if len(run) >= LEAST_LETTERS:
                        if spoil:
                            run = spoiled(run, key)
                            if len(run) < LEAST_LETTERS:
                                continue
                        count[run] += n
            if len(count) > KEPT:
                yield _counted(count)
                count.clear()
        if count:
            yield _counted(count)

    rows = map_text(df.withColumn(id_col, F.col(f"`{id_col}`").cast("string")), id_col, text_col, work, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _counted(count: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"word": pa.array(count.keys(), pa.string()), "n": pa.array(count.values(), pa.int64())})


def letters(own: list[str], length: int) -> np.ndarray:
    """Letter places of words of one length, a row a word."""
    return _PLACE[np.frombuffer("".join(own).encode("latin-1"), dtype=np.uint8)].reshape(len(own), length)


def counts(rows: np.ndarray) -> np.ndarray:
    size = len(ALPHABET)
    at = (np.arange(len(rows))[:, None] * size + rows).ravel()
    return np.bincount(at, minlength=len(rows) * size).reshape(len(rows), size).astype(np.int32)


class LetterTree:
    """A k-d tree over rows of letter counts; ``most`` rows or equal ones make a leaf."""

    def __init__(self, points: np.ndarray, most: float):
        self.letter, self.cut, self.left, self.right, self.rows = [], [], [], [], []
        todo = [(np.arange(len(points)), -1, False)]
        while todo:
            own, parent, is_right = todo.pop()
            at = len(self.letter)
            if parent >= 0:
                (self.right if is_right else self.left)[parent] = at
            letter, cut = -1, 0
            if len(own) > most:
                part = points[own]
                low, high = part.min(axis=0), part.max(axis=0)
                if (high > low).any():
                    letter = int(np.argmax(part.var(axis=0)))
                    line = part[:, letter]
                    cut = min(int(np.partition(line, len(line) // 2)[len(line) // 2]), int(high[letter]) - 1)
            for store, v in ((self.letter, letter), (self.cut, cut), (self.left, -1), (self.right, -1), (self.rows, own if letter < 0 else None)):
                store.append(v)
            if letter >= 0:
                side = line <= cut
                todo += [(own[side], at, False), (own[~side], at, True)]
        for name in ("letter", "cut", "left", "right"):
            setattr(self, name, np.array(getattr(self, name), dtype=np.int32))

    def reach(self, queries: np.ndarray, mode: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, leaf) for all leaves whose box a query meets with one step up and one down (SAME), or one up (LONGER)."""
        q, node = np.arange(len(queries)), np.zeros(len(queries), dtype=np.int32)
        up = np.full(len(queries), -1, dtype=np.int32)
        down = np.full(len(queries), -1 if mode == SAME else -2, dtype=np.int32)
        found = []
        while len(q):
            leaf = self.letter[node] < 0
            if leaf.any():
                found.append((q[leaf], node[leaf]))
                q, node, up, down = (x[~leaf] for x in (q, node, up, down))
            letter = self.letter[node]
            gap = queries[q, letter] - self.cut[node]  # boxes: left has at most cut, right at least cut + 1
            left = (gap <= 0) | (gap == 1) & ((down == -1) | (down == letter))
            right = (gap >= 1) | (gap == 0) & ((up == -1) | (up == letter))
            spent_down, spent_up = np.where(gap == 1, letter, down), np.where(gap == 0, letter, up)
            q, node, up, down = (np.concatenate(x) for x in zip(
                (q[left], self.left[node[left]], up[left], spent_down[left]), (q[right], self.right[node[right]], spent_up[right], down[right])))
        if not found:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32)
        return tuple(np.concatenate(x) for x in zip(*found))


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places first, first + 1, ... of every stretch, one behind the other."""
    return np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size - first, size)


def _pieces(size: np.ndarray, most: int) -> Iterator[slice]:
    """Stretches of items whose sizes add up to about ``most``."""
    ends, at = np.cumsum(size), 0
    while at < len(size):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
        yield slice(at, to)
        at = to


class Words:
    """Words of one length: their letters, their distinct count vectors and the words of each."""

    def __init__(self, own: list[str], n: list[int], length: int):
        self.own, self.n, self.rows = own, np.array(n, dtype=np.int64), letters(own, length)
        every = counts(self.rows)
        self.vectors, of = np.unique(every, axis=0, return_inverse=True)
        of = of.ravel()
        self.order = np.argsort(of, kind="stable")
        self.size = np.bincount(of, minlength=len(self.vectors))
        self.first = np.cumsum(self.size) - self.size
        rank = np.empty(len(own), dtype=np.int64)
        rank[sorted(range(len(own)), key=own.__getitem__)] = np.arange(len(own))
        self.rank = rank

    def best(self, at: np.ndarray, other: Words, partner: np.ndarray) -> pa.RecordBatch:
        """(word, n_near, form_n, form) of the words ``at`` with their partners among ``other``."""
        order = np.lexsort((other.rank[partner], -other.n[partner], at))
        at, partner = at[order], partner[order]
        start = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        top = partner[start]
        return pa.RecordBatch.from_pydict({
            "word": pa.array([self.own[i] for i in at[start].tolist()], pa.string()), "n_near": np.diff(np.r_[start, len(at)]),
            "form_n": other.n[top], "form": pa.array([other.own[i] for i in top.tolist()], pa.string())})


class Tile:
    """The words of a tile, searched by the words of other lists."""

    def __init__(self, points: Words):
        self.points = points
        self.used = np.flatnonzero(points.vectors.any(axis=0))
        self.vectors = points.vectors[:, self.used].astype(np.int16)
        self.tree = LetterTree(self.vectors, LEAF)
        self.leaf_rows = np.concatenate([r for r in self.tree.rows if r is not None])
        size = np.array([0 if r is None else len(r) for r in self.tree.rows])
        self.leaf_size, self.leaf_first = size, np.cumsum(size) - size

    def pairs(self, queries: Words, mode: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, point) places of all words one edit apart."""
        vectors = queries.vectors[:, self.used].astype(np.int16)
        alien = queries.vectors.sum(axis=1) - vectors.sum(axis=1)  # letters that no point has
        able = np.flatnonzero(alien <= (mode == SAME))
        q, leaf = self.tree.reach(vectors[able], mode)
        q = able[q]
        out = []
        for s in _pieces(self.leaf_size[leaf], 400_000):
            size = self.leaf_size[leaf[s]]
            a = np.repeat(q[s], size)
            b = self.leaf_rows[_spread(self.leaf_first[leaf[s]], size)]
            step = np.abs(self.vectors[b] - vectors[a]).sum(axis=1) + alien[a]
            near = step == (2 if mode == SAME else 1)
            out.append(self._ordered(queries, a[near], b[near], mode))
        if not out:
            return (np.zeros(0, dtype=np.int64),) * 2
        return tuple(np.concatenate(x) for x in zip(*out))

    def _ordered(self, queries: Words, a: np.ndarray, b: np.ndarray, mode: int) -> tuple[np.ndarray, np.ndarray]:
        """Of pairs of vectors the pairs of words whose letters are in order."""
        length, points, out = queries.rows.shape[1], self.points, [(np.zeros(0, dtype=np.int64),) * 2]
        times = queries.size[a] * points.size[b]
        for s in _pieces(times, max(1, 6_000_000 // max(1, length))):
            k = times[s]
            inner = _spread(np.zeros(len(k), dtype=np.int64), k)
            wide = np.repeat(points.size[b[s]], k)
            i = queries.order[np.repeat(queries.first[a[s]], k) + inner // wide]
            j = points.order[np.repeat(points.first[b[s]], k) + inner % wide]
            x, y = queries.rows[i], points.rows[j]
            if mode == SAME:
                near = (x != y).sum(axis=1) == 1
            else:
                fore, hind = x == y[:, :-1], x == y[:, 1:]
                fore = np.where(fore.all(axis=1), length, np.argmin(fore, axis=1))
                hind = np.where(hind.all(axis=1), length, np.argmin(hind[:, ::-1], axis=1))
                near = fore + hind >= length
            out.append((i[near], j[near]))
        return tuple(np.concatenate(x) for x in zip(*out))


def upper_trees(sample: list[str], total: int) -> dict[int, LetterTree]:
    """For each length of the sample a tree whose leaves hold about half of ``LETTERS`` letters when grown to ``total`` words."""
    out, by = {}, {}
    for w in sample:
        by.setdefault(len(w), []).append(w)
    for length, own in by.items():
        most = max(LEAF, LETTERS / 2 / length * len(sample) / total)
        out[length] = LetterTree(counts(letters(own, length)), most)
        out[length].rows = None
    return out


def placed(found: DataFrame, trees: dict[int, LetterTree]) -> DataFrame:
    """(length, leaf, role, word, n): every word in its leaf (0) and as a searcher of its leaf (1), of other leaves of its length (2) and the next (3)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 0, 1 << 20):
            own, n = part.column(0).to_pylist(), part.column(1).to_numpy()
            size = np.array([len(w) for w in own])
            for length in np.unique(size).tolist():
                at = np.flatnonzero(size == length)
                vectors = counts(letters([own[i] for i in at.tolist()], length))
                home = np.zeros(len(at), dtype=np.int32)
                rows = []
                if length in trees:
                    tree = trees[length]
                    while (inner := tree.letter[home] >= 0).any():
                        i = np.flatnonzero(inner)
                        right = vectors[i, tree.letter[home[i]]] > tree.cut[home[i]]
                        home[i] = np.where(right, tree.right[home[i]], tree.left[home[i]])
                    q, leaf = tree.reach(vectors, SAME)
                    later = leaf > home[q]
                    rows.append((q[later], leaf[later], 2, length))
                q, leaf = trees[length + 1].reach(vectors, LONGER) if length + 1 in trees else (np.arange(len(at)), np.zeros(len(at), dtype=np.int32))
                rows += [(q, leaf, 3, length + 1), (np.arange(len(at)), home, 0, length), (np.arange(len(at)), home, 1, length)]
                for q, leaf, role, of in rows:
                    for a in range(0, len(q), 50_000):
                        k = at[q[a:a + 50_000]]
                        yield pa.RecordBatch.from_pydict({
                            "length": np.full(len(k), of, dtype=np.int32), "leaf": leaf[a:a + 50_000].astype(np.int32), "role": np.full(len(k), role, dtype=np.int32),
                            "word": pa.array([own[i] for i in k.tolist()], pa.string()), "n": n[k]})

    return arrow_map(found.select("word", "n"), work, "length int, leaf int, role int, word string, n long")


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (length, leaf, tile, role)."""
    unit, points, tile = None, ([], []), None
    for batch in batches:
        key = np.stack([batch.column(k).to_numpy() for k in range(4)], axis=1)
        cuts = np.r_[0, np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1, len(key)]
        for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            length, role = int(key[i, 0]), int(key[i, 3])
            if unit != tuple(key[i, :3]):
                unit, points, tile = tuple(key[i, :3]), ([], []), None
            own, n = batch.column(4).slice(i, j - i).to_pylist(), batch.column(5).slice(i, j - i).to_pylist()
            if role == 0:
                points[0].extend(own)
                points[1].extend(n)
                continue
            if not points[0]:
                continue
            if tile is None:
                tile = Tile(Words(*points, length))
            mode = LONGER if role == 3 else SAME
            queries = Words(own, n, length - (mode == LONGER))
            a, b = tile.pairs(queries, mode)
            if role == 1 and len(a):  # both words of a pair search their leaf: the one with the lower letter counts it
                lower = (tile.points.rows[b].astype(np.int64) - queries.rows[a]).sum(axis=1) > 0
                a, b = a[lower], b[lower]
            if len(a):
                yield queries.best(a, tile.points, b)
                yield tile.points.best(b, queries, a)


def neighbours(found: DataFrame) -> DataFrame:
    """(word, n_near, form_n, form): words of ``found`` (word, n) with a word one edit away, their number and the most frequent one."""
    total = found.count()
    cells = 1 << 24  # words whose hash lies in the first cells: about SAMPLE and a half at most reach the driver, from all partitions together
    few = found.select("word").where(F.pmod(F.xxhash64("word"), F.lit(cells)) < int(min(1.0, 1.25 * SAMPLE / max(total, 1)) * cells))
    sample = [r.word for r in few.orderBy(F.xxhash64("word"), "word").limit(SAMPLE).collect()]
    rows = placed(found, upper_trees(sample, max(total, 1)))
    rows = written(rows, "placed-words")
    tiles = F.ceil(F.count("*") * F.first("length") / LETTERS).cast("int").alias("tiles")
    sizes = rows.where("role = 0").groupBy("length", "leaf").agg(tiles)
    own = F.when(F.col("role") == 0, F.array(F.pmod(F.xxhash64("word"), "tiles").cast("int"))).otherwise(F.sequence(F.lit(0), F.col("tiles") - 1))
    dealt = rows.join(sizes, ["length", "leaf"]).select("length", "leaf", F.explode(own).alias("tile"), "role", "word", "n")
    together = dealt.repartition("length", "leaf", "tile").sortWithinPartitions("length", "leaf", "tile", "role")
    near = arrow_map(together, _searched, "word string, n_near long, form_n long, form string")
    best = near.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form"))).alias("best"))
    return best.select("word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for rows (word, form): the last form that following forms leads to. Forms must have no cycles."""
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = written(now.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        now = after.drop("moved")
        if not after.where("moved").limit(1).count():
            return now


def variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", spoil: bool = False) -> DataFrame:
    """(word, form, root, n, n_near, form_n): one row a word of the texts.

    ``form``: the most frequent word one edit away (ties: the smallest) if it is ``RATIO`` times as frequent or more; ``root``: the last of these.
    """
    found = written(words(df, id_col, text_col, spoil), "words")
    near = neighbours(found)
    joined = found.join(near, "word", "left")
    taken = F.col("form_n") >= RATIO * F.col("n")
    own = written(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(taken, F.col("form")).alias("form"), F.when(taken, F.col("form_n")).alias("form_n")), "forms")
    ends = roots(own.where("form IS NOT NULL"))
    return own.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
