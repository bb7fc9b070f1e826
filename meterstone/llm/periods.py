"""Periodic runs of words in texts, by longest common extensions over a difference cover.

A run is a stretch of consecutive words with smallest period q that is at least ``max(LEAST, POWER * q)`` words long and that no
neighbouring word extends. Texts are taken together as one sequence of word numbers with a number of its own
between any two. For every period p the grid of multiples of p is read (the grids of all p together have about n ln n places): a run
holds ``POWER`` neighbouring grid places, so these have equal words, and so have places in between. What
passes gives the places at which extensions are asked for.

The extension of two places (how far the words from there on agree, and backwards on the mirrored sequence) comes from the difference
cover ``COVER``: only suffixes at places of these residues mod ``SPAN`` are sorted (blocks of ``SPAN`` words are numbered, then ranks
double), with the common prefixes of sorted neighbours and a sparse table of their minima. At most ``SPAN - 1`` words are compared
until both places are at samples; one range minimum gives the rest. Suffixes are sorted only for texts with a grid place left.

A narrow step: texts are independent, a slice of texts is worked on at once, memory follows the slice (or one longer text).

Results for odd input: null and empty texts have no words, no runs and the digests of nothing; every input row gives one row, repeated
ids included; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from meterstone.llm.common import id_type, map_text, slices

LEAST, POWER = 6, 4
#: Every residue mod SPAN is a difference of two members of COVER.
SPAN, COVER = 13, (0, 1, 3, 9)
_IN = np.isin(np.arange(SPAN), COVER)
#: Steps until places of residues i and j are both in the cover.
STEPS = np.array([[next(d for d in range(SPAN) if _IN[(i + d) % SPAN] and _IN[(j + d) % SPAN]) for j in range(SPAN)] for i in range(SPAN)])


class Extensions:
    """How far the words from two places on agree, for a sequence whose values at text ends occur once."""

    def __init__(self, seq: np.ndarray):
        n = len(seq)
        self.n, self.seq = n, np.concatenate([seq, -np.arange(1, SPAN + 1, dtype=seq.dtype) + min(0, int(seq.min()))])
        classes = [np.arange(r, n, SPAN) for r in COVER]
        places = np.concatenate(classes)
        blocks = self.seq[places[:, None] + np.arange(SPAN)]
        order = np.lexsort(blocks.T[::-1])
        ordered = blocks[order]
        name = np.empty(len(places), dtype=np.int64)
        name[order] = np.cumsum(np.r_[0, (ordered[1:] != ordered[:-1]).any(axis=1)])
        del blocks, ordered
        # blocks of one class follow each other; a class ends with a block that no other place has
        m = len(places)
        ranks, span = [name], 1
        while span < m and len(np.unique(ranks[-1])) < m:
            now = ranks[-1]
            later = np.full(m, -1, dtype=np.int64)
            later[:m - span] = now[span:]
            key = now * (m + 1) + later + 1
            _, up = np.unique(key, return_inverse=True)
            ranks.append(up)
            span *= 2
        rank = ranks[-1]
        order = np.argsort(rank, kind="stable")
        left, right = order[:-1].copy(), order[1:].copy()
        equal = np.zeros(max(0, m - 1), dtype=np.int64)
        for k in range(len(ranks) - 1, -1, -1):  # as many equal blocks as the doubled ranks tell
            inside = (left < m) & (right < m)
            same = np.zeros(len(left), dtype=bool)
            same[inside] = ranks[k][left[inside]] == ranks[k][right[inside]]
            equal += same * (1 << k)
            left, right = left + same * (1 << k), right + same * (1 << k)
        common = equal * SPAN
        a, b = places[order[:-1]] + common, places[order[1:]] + common
        common += self._direct(a, b, np.full(len(a), SPAN))
        self.rank = np.full(n, -1, dtype=np.int64)
        self.rank[places[order]] = np.arange(m)
        self.least = [common]
        while 2 << (len(self.least) - 1) <= len(common):
            half = 1 << (len(self.least) - 1)
            self.least.append(np.minimum(self.least[-1][:-half], self.least[-1][half:]))

    def _direct(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from a and b on, up to ``most`` (at most SPAN)."""
        out, on = np.zeros(len(a), dtype=np.int64), np.arange(len(a))
        for d in range(SPAN):
            on = on[most[on] > d]
            x, y = a[on] + d, b[on] + d
            inside = (x < self.n) & (y < self.n)
            on, x, y = on[inside], x[inside], y[inside]
            on = on[self.seq[x] == self.seq[y]]
            if not len(on):
                break
            out[on] += 1
        return out

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        steps = STEPS[a % SPAN, b % SPAN]
        out = self._direct(a, b, steps)
        at = np.flatnonzero((out == steps) & (a + steps < self.n) & (b + steps < self.n))
        if len(at):
            i, j = self.rank[a[at] + steps[at]], self.rank[b[at] + steps[at]]
            low, high = np.minimum(i, j), np.maximum(i, j)  # minima over low .. high - 1
            k = np.frexp((high - low).astype(float))[1] - 1
            least = np.empty(len(at), dtype=np.int64)
            for level in np.unique(k).tolist():
                own = k == level
                table = self.least[level]
                least[own] = np.minimum(table[low[own]], table[high[own] - (1 << level)])
            out[at] += least
        return out


def _grid(seq: np.ndarray, size: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(period, first, last) of stretches of neighbouring grid places that may lie in runs; texts come longest first."""
    out = []
    longest = int(size[0]) if len(size) else 0
    fits = np.searchsorted(-size, -np.maximum(LEAST, POWER * np.arange(longest // POWER + 1)), side="right")
    for p in range(1, longest // POWER + 1):
        k = int(fits[p])
        if not k:
            break
        line = seq[:start[k - 1] + size[k - 1]:p]
        same = line[1:] == line[:-1]
        all_same = same[POWER - 2:]
        for d in range(POWER - 2):
            all_same = all_same & same[d:len(same) - POWER + 2 + d]
        at = np.flatnonzero(all_same)
        for x in (p // 2, p + p // 3, 2 * p - 1):
            if len(at):
                at = at[seq[at * p + x] == seq[at * p + x + p]]
        if len(at):  # a stretch lies in one text
            text = np.searchsorted(start, at * p, side="right") - 1
            inside = at * p + (POWER - 1) * p < start[text] + size[text]
            at, text = at[inside], text[inside]
        if len(at):
            cut = np.flatnonzero((np.diff(at) > 1) | (np.diff(text) > 0))
            out.append((np.full(len(cut) + 1, p), at[np.r_[0, cut + 1]], at[np.r_[cut, len(at) - 1]]))
    if not out:
        return (np.zeros(0, dtype=np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out))


def runs(texts: list[np.ndarray]) -> list[np.ndarray]:
    """Rows (start, length, period) by start, then period, for every sequence of word numbers from 0 on."""
    none = np.zeros((0, 3), dtype=np.int64)
    out = [none] * len(texts)
    if not texts:
        return out

    def joined(which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = np.array([len(texts[i]) for i in which], dtype=np.int64)
        start = np.cumsum(size + 1) - size - 1
        seq = np.empty(int((size + 1).sum()), dtype=np.int64)
        for i, s, n, k in zip(which.tolist(), start.tolist(), size.tolist(), range(len(which))):
            seq[s:s + n] = texts[i]
            seq[s + n] = -1 - k
        return seq, size, start

    which = np.argsort([-len(t) for t in texts], kind="stable")
    seq, size, start = joined(which)
    period, first, last = _grid(seq, size, start)
    if not len(period):
        return out
    owner = np.searchsorted(start, first * period, side="right") - 1
    some = np.unique(owner)
    sub, sub_size, sub_start = joined(which[some])
    shift = sub_start[np.searchsorted(some, owner)] - start[owner]
    onward, back, n = Extensions(sub), Extensions(sub[::-1].copy()), len(sub)
    place, end, found = first * period + shift, last * period + shift, []
    while len(period):  # one run of every stretch, then on behind it
        ahead = onward(place, place + period)
        behind = np.zeros(len(place), dtype=np.int64)
        ok = np.flatnonzero(place > 0)
        behind[ok] = back(n - place[ok], n - place[ok] - period[ok])
        length = behind + period + ahead
        long = length >= np.maximum(LEAST, POWER * period)
        found.append(np.stack([place - behind, length, period], axis=1)[long])
        place = place + (ahead // period + 1) * period  # behind the first place whose word differs a period on
        on = place <= end
        period, place, end = period[on], place[on], end[on]
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    if not len(rows):
        return out
    rows = rows[np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)]]  # of equal stretches the smallest period
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    owner = np.searchsorted(sub_start, rows[:, 0], side="right") - 1
    rows[:, 0] -= sub_start[owner]
    cuts = np.r_[0, np.flatnonzero(np.diff(owner)) + 1, len(rows)]
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        out[int(which[some[owner[a]]])] = rows[a:b]
    return out


def most_repeated(rows: np.ndarray) -> tuple[int, int, int]:
    """The run with the greatest length / period; ties to the smallest start, then period."""
    best = None
    for s, n, q in rows.tolist():  # by start, then period
        if best is None or n * best[2] > best[1] * q:
            best = (s, n, q)
    return best


def collapsed(words: list[bytes], rows: np.ndarray) -> list[bytes]:
    """The words without what runs repeat after their first period."""
    if not len(rows):
        return words
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, rows[:, 0] + rows[:, 2], 1)
    np.add.at(edge, rows[:, 0] + rows[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]


def with_tail(words: list[bytes], key: str | None) -> list[bytes]:
    """A rule to put known runs into a corpus: texts whose id has a checksum divisible by 10 get a periodic tail from some word on."""
    h, n = zlib.crc32(key.encode()) if key is not None else 1, len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tails: bool = False, full: bool = False) -> DataFrame:
    """(id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256): one row a text, in one narrow pass.

    ``tails`` first puts in known runs (``with_tail``); ``full`` adds all runs and the text without what they repeat.
    """
    kind = id_type(df, id_col)
    schema = f"id {kind}, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    if full:
        schema += ", runs array<array<long>>, collapsed string"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            words = [t.encode().split() for t in part.column(1).to_pylist()]  # bytes.split cuts at space and 0x09-0x0D
            if tails:
                words = [with_tail(w, None if i is None else str(i)) for w, i in zip(words, part.column(0).to_pylist())]
            number: defaultdict[bytes, int] = defaultdict()
            number.default_factory = number.__len__
            rows, more = [], []
            for own, found in zip(words, runs([np.fromiter(map(number.__getitem__, w), dtype=np.int64, count=len(w)) for w in words])):
                left = b" ".join(collapsed(own, found))
                listed = "".join(f"{s},{n},{q}\n" for s, n, q in found.tolist())
                best = most_repeated(found)
                rows.append((len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                             hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left).hexdigest()))
                if full:
                    more.append((found.tolist(), left.decode()))
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            arrays = [part.column(0), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))]
            if full:
                arrays += [pa.array([m[0] for m in more], pa.list_(pa.list_(pa.int64()))), pa.array([m[1] for m in more])]
            yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in schema.replace(f"id {kind}", "id x").split(", ")])

    return map_text(df, id_col, text_col, work, schema).withColumnRenamed("id", id_col)
