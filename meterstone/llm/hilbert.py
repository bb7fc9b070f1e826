"""Approximate nearest neighbours by shifted space-filling curves.

Equal vectors are one entry of the index, with all their ids in a side table, so a common vector is
no large group. Every entry is placed on ``CURVES`` Hilbert curves: each takes ``DIMS`` directions of
a random rotation, cuts the projections into cells at quantiles shifted by a random part of a cell, and
orders the cells. Spark range-partitions (curve, key); ranks along a curve come from partition sizes. A curve is
cut into blocks of ``BLOCK`` ranks, a query goes to the blocks that overlap its window of keys, and
each block ranks its own entries against its queries with exact distances. The best of all blocks and
curves merge, and ids are put back, so scores are exact distances of original vectors.

The window is ``SHARE`` of the curve, ``LEAST`` ranks at least on either side. In data without
structure (as the given vectors, independent in 64 dimensions) a curve tells near from far only
slightly, so most of recall has to come from width: that share keeps recall about even at all sizes.
For clustered vectors a smaller one will do.

The rotation and shifts come from a fixed seed, the cell edges from approximate quantiles over all vectors.

Results for odd input: vectors that are null, zero, empty or hold null or non-finite components, and
rows without id, take no part; rows of equal id each count, and a query leaves out the rows of its own
id; vectors of another length than the most common one take no part; fewer candidates give fewer rows;
ties go to the smaller id; no queries give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterstone.llm.common import arrow_map, written

CURVES, DIMS, BITS, BLOCK, LEAST, SHARE, SEED = 16, 8, 3, 2048, 256, 0.08, 7
#: Of every batch each STEP-th value goes into the quantiles of a projection; they are taken at LEVELS places.
STEP, LEVELS = 16, 200


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places of integer cells (rows of coordinates below 2**bits) on the Hilbert curve, as integers.

    Skilling's transposition: undo the rotations from the highest bit down, Gray-code, interleave.
    """
    x = cells.T.astype(np.int64).copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            hit = (x[i] & q) != 0
            swap = np.where(hit, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(hit, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    key = np.zeros_like(x[0])
    for j in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | ((x[i] ^ turn) >> j & 1)
    return key


def directions(size: int, curves: int, dims: int, seed: int) -> list[np.ndarray]:
    """For each curve ``dims`` orthogonal directions; a rotation serves several curves."""
    rng, out = np.random.default_rng(seed), []
    while len(out) < curves:
        rotation = np.linalg.qr(rng.normal(size=(size, size)))[0]
        out += [rotation[:, i:i + dims] for i in range(0, max(1, size - dims + 1), dims)]
    return out[:curves]


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.float64)


def levels(curves: int, dims: int, bits: int, seed: int) -> np.ndarray:
    """Shares of the vectors below each cell edge (curves, dims, edges): a normal spread cut evenly over four deviations, shifted by part of a cell."""
    shift = np.random.default_rng(seed + 1).uniform(0, 1, (curves, dims))
    at = -2 + 4 * (np.arange(1, 2 ** bits) - shift[..., None]) / (2 ** bits - 1)
    return np.vectorize(NormalDist().cdf)(at)


def summary(vectors: np.ndarray, curves: int, dims: int, seed: int, step: int = STEP) -> np.ndarray:
    """Every ``step``-th value, in order, of each projection (curve after curve): one column a projection."""
    ordered = np.sort(vectors @ np.hstack(directions(vectors.shape[1], curves, dims, seed)), axis=0)
    return ordered[min(step // 2, (len(ordered) - 1) // 2)::step]


def place(vectors: np.ndarray, edges: np.ndarray, bits: int, seed: int) -> Iterator[np.ndarray]:
    """Keys of the vectors on each curve; ``edges`` (curves, dims, edges) part the cells."""
    for own, d in zip(edges, directions(vectors.shape[1], edges.shape[0], edges.shape[1], seed)):
        x = vectors @ d
        yield hilbert_keys(np.stack([np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(own)], axis=1), bits)


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec) of the rows that take part, components as doubles."""
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec_col}`").cast("array<double>").alias("vec"))
    odd = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("vec").isNotNull() & ~odd & F.exists("vec", lambda x: x != 0))
    size = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("vec") == (size[0].n if size else 0)).select("id", F.transform("vec", lambda x: x + 0.0).alias("vec"))


def _ranked(placed: DataFrame) -> DataFrame:
    """(curve, rank, entry, vec): ranks along each curve from the order of range partitions and their sizes."""
    ordered = placed.repartitionByRange("curve", "key", "entry").sortWithinPartitions("curve", "key", "entry")
    kept = written(ordered.select(F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"), "curve", "entry", "vec"), "curves")
    # one row for each partition and curve: its first row and size; counted, not collected
    sizes = kept.groupBy("part", "curve").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # written, so that its size is known: a few rows a partition, joined without moving the vectors while they are that few
    begins = written(sizes.select("part", "curve", "first", before.alias("before")), "begins")
    return kept.join(begins, ["part", "curve"]).select("curve", (F.col("at") - F.col("first") + F.col("before")).alias("rank"), "entry", "vec")


def nearest(q: np.ndarray, held: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(ids, exact distances) of the k rows of ``held`` nearest to each row of ``q``, ties to smaller ids.

    Squared distances are first taken expanded, about the block's mean. Each lies within ``bound`` of the exact one, so
    all rows up to the k-th value and both their bounds are ranked by exact distances, however many there are.
    """
    k, middle = min(k, len(held)), held.mean(0)
    x, y = q - middle, held - middle
    own, other = (x ** 2).sum(1), (y ** 2).sum(1)
    approx = own[:, None] + other[None] - 2 * x @ y.T
    # sums of n products err by n roundings of |x|^2, |y|^2 and 2|x||y| <= |x|^2 + |y|^2 each; centring errs by a
    # rounding of the vectors' own size a component
    n, eps = q.shape[1] + 8, np.finfo(float).eps
    size = own[:, None] + other[None]
    moved = eps * (np.sqrt((q ** 2).sum(1))[:, None] + np.sqrt((held ** 2).sum(1))[None] + 2 * np.sqrt((middle ** 2).sum()))
    bound = 4 * n * eps * size + 4 * moved * (np.sqrt(size) + moved)
    bound = np.where(np.isfinite(bound + approx), bound, np.inf)
    approx = np.where(np.isfinite(bound), approx, 0.0)
    most = np.partition(approx + bound, k - 1, axis=1)[:, k - 1]
    out = []
    for i, some in enumerate(approx - bound <= most[:, None]):
        some = np.flatnonzero(some | ~np.isfinite(bound[i]))
        exact = np.sqrt(((held[some] - q[i]) ** 2).sum(1))
        pick = np.lexsort((ids[some], exact))[:k]
        out.append((ids[some][pick], exact[pick]))
    return out


def _search(k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (unit, asks, entry, vec) sorted by unit, entries before queries: each unit's queries, a slice at a time, against its block."""
    unit, block, asking = None, [], []
    ids = held = np.zeros(0)

    def answer() -> Iterator[pa.RecordBatch]:
        if not asking or not len(ids):
            return
        own, q = np.array([i for i, _ in asking]), np.array([v for _, v in asking])
        picks = nearest(q, held, ids, k)
        count = np.array([len(i) for i, _ in picks])
        yield pa.RecordBatch.from_pydict({
            "query": np.repeat(own, count), "entry": np.concatenate([i for i, _ in picks]), "score": np.concatenate([d for _, d in picks])})

    for batch in batches:
        columns = [batch.column(i) for i in range(4)]
        for u, asks, i, v in zip(columns[0].to_pylist(), columns[1].to_pylist(), columns[2].to_pylist(), columns[3].to_numpy(zero_copy_only=False)):
            if u != unit:
                yield from answer()
                unit, block, asking, ids = u, [], [], np.zeros(0, dtype=np.int64)
            if not asks:
                block.append((i, v))
                continue
            if block:
                ids, held, block = np.array([i for i, _ in block]), np.array([v for _, v in block]), []
            asking.append((i, v))
            if len(asking) == 64:
                yield from answer()
                asking = []
    yield from answer()


def neighbours(df: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
               curves: int = CURVES, dims: int = DIMS, bits: int = BITS, share: float = SHARE, least: int = LEAST, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of ``df`` found for each row id of ``queries``."""
    rows = written(usable(df, id_col, vec_col), "vectors")
    # an entry is a distinct vector, named by its smallest id
    entries = rows.groupBy("vec").agg(F.min("id").alias("entry"), F.count("*").alias("n"))
    entries = written(entries.select("entry", "vec", "n"), "entries")
    seen = entries.agg(F.count("*").alias("n"), F.first(F.size("vec")).alias("size")).first()
    if not seen.n:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    dims = min(dims, seen.size)
    shares = levels(curves, dims, bits, SEED)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = summary(_matrix(batch.slice(at, 4096).column(0)), curves, dims, SEED)
                yield pa.RecordBatch.from_pydict({"projection": np.tile(np.arange(part.shape[1], dtype=np.int32), len(part)), "value": part.ravel()})

    # quantiles of all vectors, so that far ones do not widen the cells of the rest
    points = arrow_map(entries.select("vec"), summarise, "projection int, value double")
    wanted = sorted(set(shares.ravel().tolist()))
    wanted = [wanted[i] for i in np.linspace(0, len(wanted) - 1, min(len(wanted), LEVELS)).astype(int)]
    cuts = points.groupBy("projection").agg(F.percentile_approx("value", wanted, 2000).alias("at")).collect()
    at_level = {r.projection: np.array(r["at"]) for r in cuts}
    edges = np.array([[np.interp(shares[c, i], wanted, at_level[c * dims + i]) for i in range(dims)] for c in range(curves)])

    def place_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x = _matrix(part.column(1))
                for c, key in enumerate(place(x, edges, bits, SEED)):
                    yield pa.RecordBatch.from_pydict({"curve": np.full(len(x), c, dtype=np.int32), "key": key, "entry": part.column(0), "vec": part.column(1)})

    placed = arrow_map(entries.select("entry", "vec"), place_all, "curve int, key long, entry long, vec array<double>")
    ranked = _ranked(placed)
    asked = queries.select(F.col(f"`{id_col}`").cast("long").alias("id")).where("id IS NOT NULL").distinct()
    own = rows.join(asked, "id").join(entries.select("vec", "entry"), "vec").select("id", "entry").distinct()
    asking = own.select("entry").distinct()
    reach = max(least, int(share * seen.n / 2))
    at = lambda rank: F.floor(rank / block)
    blocks = F.sequence(at(F.greatest(F.lit(0), F.col("rank") - reach)), at(F.least(F.lit(seen.n - 1), F.col("rank") + reach)))
    sent = ranked.join(asking, "entry").select("curve", F.explode(blocks).alias("block"), F.lit(True).alias("asks"), "entry", "vec")
    there = ranked.select("curve", at(F.col("rank")).alias("block"), F.lit(False).alias("asks"), "entry", "vec")
    units = there.unionByName(sent).select((F.col("block") * curves + F.col("curve")).alias("unit"), "asks", "entry", "vec")
    found = arrow_map(units.repartition("unit").sortWithinPartitions("unit", "asks"), lambda it: _search(k + 1, it), "query long, entry long, score double")
    best = found.groupBy("query", "entry").agg(F.min("score").alias("score"))
    first = Window.partitionBy("query").orderBy("score", "entry")
    best = best.withColumn("turn", F.row_number().over(first)).where(F.col("turn") <= k + 1)
    # ids back: of every entry found the k + 1 smallest ids suffice, each once however often it repeats
    ids = rows.join(entries.select("vec", "entry"), "vec").select("entry", "id").distinct()
    ids = ids.withColumn("turn", F.row_number().over(Window.partitionBy("entry").orderBy("id"))).where(F.col("turn") <= k + 1).select("entry", "id")
    wide = best.select("query", "entry", "score").join(ids, "entry")
    answers = own.select(F.col("id").alias("query_id"), F.col("entry").alias("query")).join(wide, "query").where("query_id <> id")
    turn = Window.partitionBy("query_id").orderBy("score", "id")
    return (answers.withColumn("rank", F.row_number().over(turn)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias("vec_id"), "score"))
