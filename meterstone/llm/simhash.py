"""SimHash near-duplicates with bit-sliced comparison.

Fingerprints are taken in Python tasks over whole texts, one row a document. Copies share a
fingerprint, so only distinct fingerprints are compared. The 64 bits are cut into ``radius + 2``
blocks; two fingerprints within the radius agree in at least two blocks, so every pair of blocks
gives a key and all links lie among fingerprints that share a key: the search is exact. Keys held by
one fingerprint drop out; a key held by more than ``TILE`` is dealt out to pairs of tiles, so no task
gets an unbounded group. In a task the fingerprints that share a key stand next to each other and are
stored as 64 vertical bit planes. A shift of the planes by s compares every fingerprint with the one
s places on; carry-save counters, themselves bit planes, hold all these distances at once, and a block
is left once every distance in it exceeds the radius. Tasks give a spanning set of links, not all pairs.

``drop_near_duplicates`` can instead link by the similarity of the shingle sets themselves (``similar_groups``), exactly: shingles
are put in one order, the rarest first (by their counts in ``SKETCH`` cells, which any corpus fits into), and two sets that share ``percent`` in
100 of their union share one of the first few of each, so these are exact keys; places in the order, set sizes and
bitmaps of the sets (a bit that one has and the other lacks is a shingle not shared) bound what a pair can share. Equal sets are one node. Of every key all nodes are held against its least node first. Keys whose
nodes are then still in different groups are compared by bit planes with the radius ``WIDE``, which finds nearly all links, and what
is left in different groups after that pair by pair, whatever the distance. Every candidate's similarity is counted on the whole sets.

Results for odd input: null and empty texts have fingerprint zero and link like any other; repeated
ids give one row each; a null id takes its group's smallest id and never is one (null if the group
has no other); no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterstone.llm.common import arrow_map, fresh, id_type, map_text, slices, written
from meterstone.llm.components import connected

WORDS, RADIUS, SEED, TILE = 4, 4, 42, 4096
#: The rule of corpus stages: words a shingle, shared shingles in 100 of the union; fingerprints of such pairs
#: differ in 10 to 12 of 64 bits with a deviation of 3, so that few are left for the comparison without a radius (ANY).
STAGE_WORDS, PERCENT, WIDE, ANY = 5, 80, 24, 64
#: Cells in which the documents of shingles are counted; bounds what reaches the driver and the tasks (1 MB).
SKETCH = 1 << 18
#: Bits of a set's bitmap.
BITMAP = 1024
#: Groups up to this size are compared together, larger ones alone.
TOGETHER = 64
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingle_hashes(text: str, words: int = WORDS) -> np.ndarray:
    import xxhash

    own = text.encode().translate(_LOWER).split()  # bytes.split cuts at space and 0x09-0x0D
    if not own:
        return np.zeros(0, dtype=np.uint64)
    joined, size = b" ".join(own), np.fromiter(map(len, own), dtype=np.int64, count=len(own))
    ends = np.cumsum(size + 1) - 1
    first = (ends - size)[:max(1, len(own) - words + 1)].tolist()
    last = ends[min(words, len(own)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[i:j], SEED) for i, j in zip(first, last)], dtype=np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit k is set if it is set in over half of the hashes."""
    total = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at:at + 65536].astype("<u8")
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(id, bits): the fingerprint of every text as a signed 64-bit integer."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            own = [fingerprint(shingle_hashes(t, words)) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"id": part.column(0), "bits": np.array(own, dtype=np.uint64).view(np.int64)})

    return map_text(df, id_col, text_col, work, f"id {id_type(df, id_col)}, bits long")


def planes(bits: np.ndarray) -> list[int]:
    """Bit k of all fingerprints as one integer: bit i of it belongs to fingerprint i."""
    table = np.unpackbits(bits.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return [int.from_bytes(np.packbits(row, bitorder="little").tobytes(), "little") for row in table.T]


def within(own: list[int], shift: int, lanes: int, radius: int) -> int:
    """The lanes i whose fingerprints i and i + shift differ in at most ``radius`` bits.

    ``counters`` are the carry-save digits of all distances; ``over`` marks lanes that ran past them.
    """
    counters, over = [0] * radius.bit_length(), 0
    for k, plane in enumerate(own):
        carry = plane ^ (plane >> shift)
        for j, digit in enumerate(counters):
            counters[j], carry = digit ^ carry, digit & carry
        over |= carry
        if k % 4 == 3:
            above, equal = over, -1  # compare the counters with the radius from the highest digit on
            for j in range(len(counters) - 1, -1, -1):
                if radius >> j & 1:
                    equal &= counters[j]
                else:
                    above |= equal & counters[j]
                    equal &= ~counters[j]
            lanes &= ~above
            if not lanes:
                return 0
    return lanes


def places(lanes: int, n: int) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(np.frombuffer(lanes.to_bytes(n // 8 + 1, "little"), dtype=np.uint8), bitorder="little"))


def links(bits: np.ndarray, unit: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning set of the links among fingerprints of the same unit; units lie together."""
    own, n, root = planes(bits), len(bits), list(range(len(bits)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out, shift, label = [], 1, np.arange(n)
    while shift < n:
        same = unit[shift:] == unit[:-shift]
        if not same.any():
            break
        lanes = within(own, shift, int.from_bytes(np.packbits(same, bitorder="little").tobytes(), "little"), radius)
        if lanes:
            left = places(lanes, n)
            left = left[label[left] != label[left + shift]]
            for i in left.tolist():
                a, b = top(i), top(i + shift)
                if a != b:
                    root[max(a, b)] = min(a, b)
                    out.append((i, i + shift))
            if len(left):
                label = np.array([top(i) for i in range(n)])
        shift += 1
    return out


def _compare(radius: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of rows (unit, bits) that come sorted by unit."""

    def found(bits: np.ndarray, unit: np.ndarray) -> Iterator[pa.RecordBatch]:
        start = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]]) if len(unit) else np.zeros(0, dtype=int)
        size = np.diff(np.r_[start, len(unit)])
        pieces = [np.arange(s, s + n) for s, n in zip(start.tolist(), size.tolist()) if n > TOGETHER]
        small = np.flatnonzero(np.repeat((size > 1) & (size <= TOGETHER), size))
        pieces += [small[a:b] for a, b in runs_of(unit[small], 16384)]
        for at in pieces:
            pairs = links(bits[at], unit[at], radius)
            if pairs:
                i, j = np.array(pairs).T
                a, b = bits[at][i], bits[at][j]
                yield pa.RecordBatch.from_pydict({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    bits, unit = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    for batch in batches:
        unit = np.concatenate([unit, batch.column(0).to_numpy()])
        bits = np.concatenate([bits, batch.column(1).to_numpy()])
        if len(unit) and unit[0] != unit[-1]:  # all but the last unit are complete
            cut = int(np.searchsorted(unit == unit[-1], True))
            yield from found(bits[:cut], unit[:cut])
            bits, unit = bits[cut:], unit[cut:]
    yield from found(bits, unit)


def near_links(nodes: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(a, b): links that connect all distinct ``bits`` of ``nodes`` within the radius, directly or by way of others."""
    count = radius + 2
    width = [64 // count + (i < 64 % count) for i in range(count)]
    begin = [sum(width[:i]) for i in range(count)]
    block = lambda i: F.shiftrightunsigned("bits", begin[i]).bitwiseAND(F.lit((1 << width[i]) - 1))
    keys = [F.shiftleft(F.lit(k).cast("long"), 40).bitwiseOR(F.shiftleft(block(i), 20)).bitwiseOR(block(j))
            for k, (i, j) in enumerate(combinations(range(count), 2))]
    keyed = nodes.select("bits", F.explode(F.array(*keys)).alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    tiles = F.ceil(F.col("n") / tile).cast("int")
    dealt = keyed.join(shared, "key").select("bits", "key", tiles.alias("tiles"), F.pmod(F.xxhash64("bits"), tiles).cast("int").alias("tile"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    units = dealt.select("bits", "key", "tile", other).select(F.xxhash64("key", F.least("tile", "other"), F.greatest("tile", "other")).alias("unit"), "bits")
    # a clash of unit numbers only compares more fingerprints; every link is checked
    together = units.repartition("unit").sortWithinPartitions("unit")
    return arrow_map(together, lambda it: _compare(radius, it), "a long, b long").distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """(id, fingerprint, component_id): one row a document; component_id is the smallest id of its group."""
    own = written(fingerprints(df, id_col, text_col, words), "fingerprints")
    nodes = written(own.groupBy("bits").agg(F.min("id").alias("least")), "nodes")
    roots = connected(near_links(nodes, radius)).select(F.col("node").alias("bits"), "root")
    placed = nodes.join(roots, "bits", "left").withColumn("root", F.coalesce("root", "bits"))
    groups = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    of = placed.join(groups, "root").select("bits", "component_id")
    hexed = F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint")
    return own.join(of, "bits").select(F.col("id").alias(id_col), hexed, "component_id")


def rarity(df: DataFrame, id_col: str, text_col: str, words: int) -> np.ndarray:
    """For each of ``SKETCH`` cells its place by the number of documents that have its shingles, counted over all texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(SKETCH, dtype=np.int64)
        for part in slices(batches):
            own = [np.unique(shingle_hashes(t, words)) for t in part.column(1).to_pylist()]
            count += np.bincount((np.concatenate(own) % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH)
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict({"cell": at.astype(np.int32), "n": count[at]})

    cells = map_text(df, id_col, text_col, work, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    count = np.zeros(SKETCH, dtype=np.int64)
    count[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    return np.unique(count, return_inverse=True)[1].astype(np.int32)


def shingle_sets(df: DataFrame, id_col: str, text_col: str, words: int, percent: int | None = None, rare: np.ndarray | None = None) -> DataFrame:
    """(id, node, bits, size, hashes): the sorted shingle hashes of every text, named by 64 bits of their digest; with
    ``percent`` only the rarest ones, of which two sets of that similarity share one, the rarest first, and ``bitmap`` of all."""

    def keys(h: np.ndarray) -> np.ndarray:
        if percent is None or not len(h):
            return h
        ordered = h[np.lexsort((h, rare[(h % np.uint64(SKETCH)).astype(np.int64)]))]
        return ordered[:len(h) + (-percent * len(h)) // 100 + 1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            own = [np.unique(shingle_hashes(t, words)) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "id": part.column(0), "node": np.array([int.from_bytes(hashlib.md5(h.tobytes()).digest()[:8], "little", signed=True) for h in own], dtype=np.int64),
                "bits": np.array([fingerprint(h) for h in own], dtype=np.uint64).view(np.int64),
                "size": pa.array([len(h) for h in own], pa.int64()),
                "hashes": pa.array([keys(h).view(np.int64) for h in own], pa.list_(pa.int64())),
                **({} if percent is None else {"bitmap": pa.array([bitmap(h) for h in own], pa.binary())})})

    more = "" if percent is None else ", bitmap binary"
    return map_text(df, id_col, text_col, work, f"id {id_type(df, id_col)}, node long, bits long, size long, hashes array<long>{more}")


def bitmap(hashes: np.ndarray) -> bytes:
    on = np.zeros(BITMAP, dtype=bool)
    on[(hashes >> np.uint64(40)) % np.uint64(BITMAP)] = True
    return np.packbits(on).tobytes()


def can_share(m, i, n, j, percent: int, least):
    """Whether sets of m and n shingles whose first common one is in places i and j can be similar enough."""
    return (100 + percent) * (1 + least(m - 1 - i, n - 1 - j)) >= percent * (m + n)


def _candidates(radius: int, percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a unit within the radius (ANY: all) that can be similar and whose roots differ, of rows (unit, bits, node, size, pos, root, bitmap) sorted by unit."""

    def found(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        unit, bits = rows.column(0).to_numpy(), rows.column(1).to_numpy()
        for at, to in runs_of(unit, 16384):
            own, n, shift = planes(bits[at:to]), to - at, 1
            part = rows.slice(at, n)
            node, size, pos, root = (part.column(k).to_numpy() for k in (2, 3, 4, 5))
            maps = np.frombuffer(b"".join(part.column(6).to_pylist()), dtype=np.uint64).reshape(n, BITMAP // 64)
            while shift < n:
                same = unit[at + shift:to] == unit[at:to - shift]
                if not same.any():
                    break
                if radius < ANY:
                    lanes = within(own, shift, int.from_bytes(np.packbits(same, bitorder="little").tobytes(), "little"), radius)
                    i = places(lanes, n) if lanes else np.zeros(0, dtype=int)
                else:
                    i = np.flatnonzero(same)
                j = i + shift
                open_pair = (root[i] != root[j]) & can_share(size[i], pos[i], size[j], pos[j], percent, np.minimum)
                i, j = i[open_pair], j[open_pair]
                if len(i):
                    own_only, other_only = (np.bitwise_count(maps[x] & ~maps[y]).sum(axis=1, dtype=np.int64) for x, y in ((i, j), (j, i)))
                    most = np.minimum(size[i] - own_only, size[j] - other_only)
                    can = (100 + percent) * most >= percent * (size[i] + size[j])
                    i, j = i[can], j[can]
                if len(i):
                    a, b = np.minimum(node[i], node[j]), np.maximum(node[i], node[j])
                    yield pa.RecordBatch.from_pydict({"a": a, "b": b})
                shift += 1

    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        unit = held.column(0).to_numpy()
        cut = int(np.searchsorted(unit == unit[-1], True)) if len(unit) else 0
        if cut:  # all but the last unit are complete
            yield from found(held.slice(0, cut))
            held = held.slice(cut)
    if held is not None and held.num_rows:
        yield from found(held)


def runs_of(unit: np.ndarray, rows: int) -> Iterator[tuple[int, int]]:
    """Stretches (from, to) of whole units, of ``rows`` rows or one unit each; units lie together."""
    ends = np.r_[np.flatnonzero(unit[1:] != unit[:-1]) + 1, len(unit)]
    at = 0
    while at < len(unit):
        k = int(np.searchsorted(ends, at + rows, side="right"))
        to = int(ends[k - 1]) if k and ends[k - 1] > at else int(ends[k])
        yield at, to
        at = to


def similar_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = STAGE_WORDS, percent: int = PERCENT, tile: int = TILE) -> DataFrame:
    """(id, component_id): one row a document; groups of documents linked by shingle sets that share ``percent`` in 100 of their union.

    Conventions for odd input are those of ``near_duplicates``; texts without words have equal sets and are one group.
    """
    own = written(shingle_sets(df, id_col, text_col, words, percent, rarity(df, id_col, text_col, words)), "rare-hashes")
    nodes = own.groupBy("node").agg(F.min("id").alias("least"), F.first("bits").alias("bits"), F.first("size").alias("size"), F.first("hashes").alias("hashes"), F.first("bitmap").alias("bitmap"))
    nodes = written(nodes, "nodes")
    keyed = nodes.select("node", "size", F.posexplode("hashes").alias("pos", "key"))
    group = Window.partitionBy("key")
    least = F.min(F.struct("node", "size", "pos")).over(group).alias("star")
    held = keyed.select("key", "node", "size", "pos", F.count("*").over(group).alias("n"), least).where("n > 1")
    held = written(held, "held")

    def similar(pairs: DataFrame) -> DataFrame:
        """The pairs whose whole sets are similar; sets are taken anew from one document of each node."""
        pairs = written(pairs.distinct(), "pairs")
        ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        wanted = written(ends.join(nodes.select("node", "least"), "node").select(F.col("least").alias("w")).distinct(), "wanted")
        some = df.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").alias("t")).join(wanted, F.expr("i <=> w"), "left_semi")
        sets = written(shingle_sets(some, "i", "t", words).groupBy("node").agg(F.first("size").alias("size"), F.first("hashes").alias("hashes")), "sets")
        both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("size").alias("na"), F.col("hashes").alias("ha")), "a")
                .join(sets.select(F.col("node").alias("b"), F.col("size").alias("nb"), F.col("hashes").alias("hb")), "b"))
        common = both.select("a", "b", "na", "nb", F.size(F.array_intersect("ha", "hb")).cast("long").alias("common"))
        return written(common.where(100 * F.col("common") >= percent * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b"), "similar")

    star = lambda c: F.col(f"star.{c}")
    fits = can_share(F.col("size"), F.col("pos"), star("size"), star("pos"), percent, F.least)
    links = similar(held.where((F.col("node") != star("node")) & fits).select(star("node").alias("a"), F.col("node").alias("b")))
    roots = connected(links)
    for radius in (WIDE, ANY):
        placed = held.drop("star").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        open_keys = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key")
        tiles = F.ceil(F.col("n") / tile).cast("int")
        dealt = placed.join(open_keys, "key").withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        dealt = dealt.join(nodes.select("node", "bits", "bitmap"), "node")
        units = dealt.select(F.xxhash64("key", F.least("tile", "other"), F.greatest("tile", "other")).alias("unit"), "bits", "node", "size", F.col("pos").cast("long").alias("pos"), "root", "bitmap")
        together = units.repartition("unit").sortWithinPartitions("unit")
        links = links.unionByName(similar(arrow_map(together, lambda it, r=radius: _candidates(r, percent, it), "a long, b long")))
        roots = connected(links)
    top = nodes.select("node", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    groups = top.groupBy("root").agg(F.min("least").alias("component_id"))
    of = top.join(groups, "root").select("node", "component_id")
    return own.join(of, "node").select(F.col("id").alias(id_col), "component_id")


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int | None = None) -> DataFrame:
    """``df`` with one document of each group: the one with the smallest id. Rows that repeat that id stay, null ids stay.

    Groups are those of ``near_duplicates``; with ``percent`` those of ``similar_groups``.
    """
    groups = near_duplicates(df, id_col, text_col) if percent is None else similar_groups(df, id_col, text_col, percent=percent)
    gone = written(groups.where(F.col(f"`{id_col}`") != F.col("component_id")).select(F.col(f"`{id_col}`").alias("gone_id")).distinct(), "gone")
    gone = gone.withColumnRenamed("gone_id", name := fresh(df, "gone_id"))
    return df.join(gone.hint("shuffle_hash"), F.col(f"`{id_col}`") == F.col(name), "left_anti")
