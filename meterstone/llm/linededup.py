"""Removal of passages that repeat across documents, by content-defined chunks of lines.

A text is cut at line feeds. A rolling hash over the hashes of the last two lines ends a chunk where
it is a multiple of ``MEAN_LINES``, so boundaries depend on near lines only and fall in the same
places when lines are put in elsewhere. A line of ``LONG`` blank-separated pieces or more is a chunk
of its own. Chunks whose hash occurs once drop out; the rest are grouped by their whole text, which
compares bytes. Repeated chunks that follow each other in a document form a run. Runs of ``LONG`` words
or more, and runs of several lines with ``FEW`` or more, are passages: their chunks go, but for the
occurrence with the smallest (id, place) of each. Single headings and licence lines stay.

A passage's first and last lines may lie in chunks with foreign lines, and a passage of a few lines may hold no chunk of its own. So what
is left is searched once more by seams: pairs of neighbouring lines (blank ones between them are bridged), hashed alike. Seams that occur again and follow each
other make runs; of runs of ``FEW`` words or more every seam is compared by its lines, and lines go that have a seam met before, but
for the first occurrence of each line. A stretch of lines that two documents share has only such seams, whatever
stands around it; a single line beside a removed chunk has none and may stay.

Everything is DataFrame functions. Equal chunks are counted and their first occurrence is found in
aggregates combined before the shuffle, so a passage in a third of all documents is no large group;
the join back is one whose skewed partitions adaptive execution splits.

Results for odd input: null and empty texts stay as they are; a text loses its removed lines with
their line feeds and stays a row, empty if all went; rows with equal id and equal text are treated alike
(all keep what the first keeps); rows with equal id and other text are told apart by a hash of the
text; null ids come last; extra columns stay; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterstone.llm.common import WORD, fresh, written

MEAN_LINES, LONG, FEW = 2, 50, 25
BASE, MODULUS = 31, 2147483647


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def _ends(n: Column, hashes: Column, long: Column) -> Column:
    """Places of the lines that end a chunk."""

    def ends(i: Column) -> Column:
        before = F.when(i > 0, F.get(hashes, i - 1)).otherwise(F.lit(0))
        rolled = (F.get(hashes, i) + BASE * before) % MODULUS
        return (i == n - 1) | F.get(long, i) | F.get(long, i + 1) | (rolled % MEAN_LINES == 0)

    return F.filter(F.sequence(F.lit(0), n - 1), ends)


def chunked(docs: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """One row for each chunk with a word: keys, first line, number of lines, hash of its text."""
    lines = docs.where(F.col(text) != "").select(*keys, F.split(text, "\n").alias("lines"))
    hashed = lines.select(
        *keys, "lines", F.size("lines").alias("n"), F.transform("lines", _line_hash).alias("hashes"),
        F.transform("lines", lambda x: F.when(F.length(x) < 2 * LONG - 1, F.lit(False)).otherwise(F.size(F.split(x, " ")) >= LONG)).alias("long"),
    )
    ended = hashed.select(*keys, "lines", _ends(F.col("n"), F.col("hashes"), F.col("long")).alias("ends"))
    first = lambda k: F.when(k > 0, F.get("ends", k - 1) + 1).otherwise(F.lit(0))
    spans = ended.select(*keys, "lines", F.transform("ends", lambda e, k: F.struct(first(k).alias("first"), (e - first(k) + 1).alias("count"))).alias("spans"))
    rows = spans.select(*keys, F.explode(F.transform("spans", lambda s: F.struct(s["first"].alias("first"), s["count"].alias("count"), _joined(F.col("lines"), s).alias("chunk")))).alias("s"))
    return rows.where(F.rlike("s.chunk", F.lit(WORD))).select(*keys, "s.first", "s.count", F.xxhash64("s.chunk").alias("hash"))


def _joined(lines: Column, span: Column) -> Column:
    return F.array_join(F.slice(lines, span["first"] + 1, span["count"]), "\n")


def drop_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", removed_col: str | None = None) -> DataFrame:
    """``docs`` without the passages that an earlier document or place has; ``removed_col`` adds the number of removed chunks and lines."""
    chunks, lines = fresh(docs, "chunks_gone"), fresh(docs, "lines_gone")
    left = written(drop_chunks(docs, id_col, text_col, chunks), "without-chunks")
    out = drop_seams(left, id_col, text_col, lines)
    number = [(F.col(chunks) + F.col(lines)).alias(removed_col)] if removed_col else []
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], *number)


def drop_seams(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", removed_col: str | None = None) -> DataFrame:
    """``docs`` without lines of runs of neighbouring lines that an earlier document or place has; ``removed_col`` adds their number."""
    own, version, gone = fresh(docs, "own_id"), fresh(docs, "version"), fresh(docs, "gone")
    cut_id, cut_version, cut_seams = fresh(docs, "cut_id"), fresh(docs, "cut_version"), fresh(docs, "cut_seams")
    keyed = docs.withColumn(own, F.col(f"`{id_col}`")).withColumn(version, F.xxhash64(F.col(f"`{text_col}`").cast("string")))
    text = keyed.select(F.col(own).alias("id"), F.col(version).alias("version"), F.col(f"`{text_col}`").cast("string").alias("text"))

    split = text.where(F.contains("text", F.lit("\n"))).select("id", "version", F.split("text", "\n").alias("lines"))
    counted = split.select("*", F.transform("lines", lambda x: F.regexp_count(x, F.lit(WORD))).alias("words"))
    worded = counted.select("*", F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: F.get("words", i) > 0).alias("at"))
    pair = lambda k: F.struct(
        F.get("at", k).alias("a"), F.get("at", k + 1).alias("b"), F.get("words", F.get("at", k)).alias("wa"), F.get("words", F.get("at", k + 1)).alias("wb"),
        F.xxhash64(F.get("lines", F.get("at", k)), F.get("lines", F.get("at", k + 1))).alias("hash"))
    # no filter on the computed lists: pushed down, it would work them out anew for every line
    pairs = F.when(F.size("at") > 1, F.transform(F.sequence(F.lit(0), F.size("at") - 2), pair))
    rows = worded.select("id", "version", F.explode(pairs).alias("s")).select("id", "version", "s.*")
    rows = written(rows, "seams")  # numbers only; read twice
    repeated = rows.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    place = Window.partitionBy("id", "version").orderBy("a")
    again = rows.join(repeated, "hash").distinct().withColumn("begins", F.when(F.lag("b").over(place) == F.col("a"), 0).otherwise(1))
    again = again.withColumn("run", F.sum("begins").over(place))
    words = F.sum(F.col("wb") + F.col("begins") * F.col("wa")).over(Window.partitionBy("id", "version", "run"))
    passages = again.withColumn("run_words", words).where(F.col("run_words") >= FEW)
    wanted = written(passages.groupBy(F.col("id").alias("w_id"), F.col("version").alias("w_version")).agg(F.collect_set(F.struct("a", "b")).alias("seams")), "seam-texts")
    found = text.join(wanted, F.expr("id <=> w_id AND version = w_version")).select("id", "version", F.split("text", "\n").alias("lines"), "seams").dropDuplicates(["id", "version"])
    both = F.transform("seams", lambda s: F.struct(s["a"].alias("a"), s["b"].alias("b"), F.get("lines", s["a"]).alias("la"), F.get("lines", s["b"]).alias("lb")))
    places = written(found.select("id", "version", F.explode(both).alias("s")).select("id", "version", "s.*"), "seam-lines")
    order = lambda i: F.struct(F.col("id").isNull().alias("no_id"), "id", "version", F.col(i).alias("i"))
    kept = written(places.groupBy("la", "lb").agg(F.min(order("a")).alias("kept"), F.count("*").alias("n")).where("n > 1").drop("n"), "seams-kept")
    goes = places.join(kept, ["la", "lb"]).where(order("a") != F.col("kept")).select("id", "version", "a", "b", "la", "lb")
    ends = F.explode(F.array(F.struct(F.col("a").alias("i"), F.col("la").alias("line")), F.struct(F.col("b").alias("i"), F.col("lb").alias("line")))).alias("e")
    first = written(places.select("id", "version", ends).select("id", "version", "e.*").groupBy("line").agg(F.min(order("i")).alias("first")), "lines-kept")
    going = goes.select("id", "version", "a", "b", ends).select("id", "version", "a", "b", "e.*").join(first, "line").where(order("i") != F.col("first"))
    cut = (going.groupBy("id", "version").agg(F.collect_set("i").alias(gone), F.collect_set(F.struct("a", "b")).alias(cut_seams))
           .select(F.col("id").alias(cut_id), F.col("version").alias(cut_version), gone, cut_seams))
    cut = written(cut, "seams-cut")

    after = keyed.join(cut, F.col(own).eqNullSafe(F.col(cut_id)) & (F.col(version) == F.col(cut_version)), "left")
    lines, inside = fresh(after, "lines"), fresh(after, "inside")
    after = after.withColumn(lines, F.when(F.col(gone).isNotNull(), F.split(F.col(f"`{text_col}`").cast("string"), "\n")))
    whole = F.filter(cut_seams, lambda s: F.array_contains(gone, s["a"]) & F.array_contains(gone, s["b"]))  # blank lines between two removed ones go too
    after = after.withColumn(inside, F.array_union(gone, F.flatten(F.transform(whole, lambda s: F.sequence(s["a"], s["b"])))))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(inside))
    rest = F.array_join(F.transform(left, lambda i: F.get(F.col(lines), i)), "\n")
    new = F.when(F.col(gone).isNull(), F.col(f"`{text_col}`")).otherwise(rest)
    out = [new.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    if removed_col:
        out.append(F.coalesce(F.size(gone), F.lit(0)).cast("long").alias(removed_col))
    return after.select(*out)


def drop_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", removed_col: str | None = None) -> DataFrame:
    """``docs`` without the chunks that an earlier document or place has; ``removed_col`` adds their number."""
    own, version, gone = fresh(docs, "own_id"), fresh(docs, "version"), fresh(docs, "gone")
    cut_id, cut_version = fresh(docs, "cut_id"), fresh(docs, "cut_version")
    keyed = docs.withColumn(own, F.col(f"`{id_col}`")).withColumn(version, F.xxhash64(F.col(f"`{text_col}`").cast("string")))
    text = keyed.select(F.col(own).alias("id"), F.col(version).alias("version"), F.col(f"`{text_col}`").cast("string").alias("text"))

    rows = written(chunked(text, "text", ["id", "version"]), "chunks")  # numbers only; read twice
    repeated = rows.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    wanted = (rows.join(repeated, "hash").groupBy("id", "version")
              .agg(F.collect_set(F.struct("first", "count", "hash")).alias("spans"))
              .select(F.col("id").alias("w_id"), F.col("version").alias("w_version"), "spans").hint("shuffle_hash"))
    found = text.join(wanted, F.expr("id <=> w_id AND version = w_version")).select("id", "version", F.split("text", "\n").alias("lines"), "spans")
    places = found.select("id", "version", F.explode(F.transform("spans", lambda s: F.struct(s["first"].alias("first"), s["count"].alias("count"), s["hash"].alias("hash"), _joined(F.col("lines"), s).alias("chunk")))).alias("s"))
    places = written(places.select("id", "version", "s.*"), "places")  # the texts of chunks whose hash occurs again
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "version", "first")
    kept = places.groupBy("hash", "chunk").agg(F.min(order).alias("kept"), F.count("*").alias("n")).where("n > 1").drop("n")
    kept = written(kept, "kept")  # a plain table on either side lets a skewed passage be split in the join
    again = places.join(kept, ["hash", "chunk"]).select("id", "version", "first", "count", F.regexp_count("chunk", F.lit(WORD)).alias("words"), (order != F.col("kept")).alias("goes"))
    place = Window.partitionBy("id", "version").orderBy("first")
    begins = F.when(F.lag(F.col("first") + F.col("count")).over(place) == F.col("first"), 0).otherwise(1)
    runs = again.distinct().withColumn("begins", begins).withColumn("run", F.sum("begins").over(place))
    run = Window.partitionBy("id", "version", "run")
    words, lines = F.sum("words").over(run), F.sum("count").over(run)
    passages = runs.withColumn("passage", (words >= LONG) | (lines > 1) & (words >= FEW)).where("passage AND goes")
    cut = (passages.groupBy("id", "version")
           .agg(F.collect_set(F.struct("first", "count")).alias(gone))
           .select(F.col("id").alias(cut_id), F.col("version").alias(cut_version), gone).hint("shuffle_hash"))

    after = keyed.join(cut, F.col(own).eqNullSafe(F.col(cut_id)) & (F.col(version) == F.col(cut_version)), "left")
    lost = F.flatten(F.transform(gone, lambda s: F.sequence(s["first"], s["first"] + s["count"] - 1)))
    lines = F.split(F.col(f"`{text_col}`").cast("string"), "\n")
    left, split = fresh(after, "left"), fresh(after, "split")
    after = after.withColumn(split, F.when(F.col(gone).isNotNull(), lines))
    after = after.withColumn(left, F.array_except(F.sequence(F.lit(0), F.size(split) - 1), lost))
    rest = F.array_join(F.transform(left, lambda i: F.get(F.col(split), i)), "\n")
    new = F.when(F.col(gone).isNull(), F.col(f"`{text_col}`")).otherwise(rest)
    out = [new.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    if removed_col:
        out.append(F.coalesce(F.size(gone), F.lit(0)).cast("long").alias(removed_col))
    return after.select(*out)


#: The same over ``documents`` for DuckDB (ids there are unique and never null).
SQL = f"""
WITH lines AS (
  SELECT doc_id, i - 1 AS i, l[i] AS line, len(l) AS n FROM (
    SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text <> ''))),
hashed AS (SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h, length(line) >= {2 * LONG - 1} AND len(string_split(line, ' ')) >= {LONG} AS long FROM lines),
ended AS (
  SELECT *, i = n - 1 OR long OR coalesce(lead(long) OVER w, false)
    OR ((h + {BASE} * coalesce(lag(h) OVER w, 0)) % {MODULUS}) % {MEAN_LINES} = 0 AS ends
  FROM hashed WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM ended),
chunks AS (
  SELECT doc_id, chunk, min(i) AS first, count(*) AS lines, string_agg(line, chr(10) ORDER BY i) AS body FROM numbered GROUP BY doc_id, chunk),
repeated AS (
  SELECT doc_id, chunk, first, lines, len(regexp_extract_all(body, '[^\\x20\\x09-\\x0D]+')) AS words,
    row_number() OVER (PARTITION BY body ORDER BY doc_id, first) > 1 AS goes FROM chunks WHERE regexp_matches(body, '[^\\x20\\x09-\\x0D]')
  QUALIFY count(*) OVER (PARTITION BY body) > 1),
runs AS (
  SELECT *, sum(begins) OVER (PARTITION BY doc_id ORDER BY first) AS run FROM (
    SELECT *, CASE WHEN lag(first + lines) OVER (PARTITION BY doc_id ORDER BY first) = first THEN 0 ELSE 1 END AS begins FROM repeated)),
ranked AS (
  SELECT doc_id, chunk, goes AND (sum(words) OVER r >= {LONG} OR sum(lines) OVER r > 1 AND sum(words) OVER r >= {FEW}) AS gone FROM runs
  WINDOW r AS (PARTITION BY doc_id, run)),
marked AS (SELECT n.doc_id, n.i, n.line, coalesce(r.gone, false) AS gone, n.chunk FROM numbered n LEFT JOIN ranked r USING (doc_id, chunk)),
rest AS (
  SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text, count(DISTINCT chunk) FILTER (gone) AS removed
  FROM marked GROUP BY doc_id),
cut AS MATERIALIZED (SELECT d.doc_id, coalesce(r.text, d.text) AS text, coalesce(r.removed, 0) AS removed FROM documents d LEFT JOIN rest r USING (doc_id)),
left_lines AS MATERIALIZED (
  SELECT doc_id, i - 1 AS i, l[i] AS line, len(regexp_extract_all(l[i], '[^\\x20\\x09-\\x0D]+')) AS words FROM (
    SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM cut WHERE contains(text, chr(10))))),
seams AS (
  SELECT doc_id, i AS a, lead(i) OVER d AS b, line AS la, lead(line) OVER d AS lb, words AS wa, lead(words) OVER d AS wb FROM left_lines WHERE words > 0
  WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
again AS (
  SELECT *, CASE WHEN lag(b) OVER (PARTITION BY doc_id ORDER BY a) = a THEN 0 ELSE 1 END AS begins FROM (
    SELECT * FROM seams WHERE b IS NOT NULL QUALIFY count(*) OVER (PARTITION BY la, lb) > 1)),
seam_runs AS (SELECT *, sum(begins) OVER (PARTITION BY doc_id ORDER BY a) AS run FROM again),
held AS MATERIALIZED (SELECT * FROM seam_runs QUALIFY sum(wb + begins * wa) OVER (PARTITION BY doc_id, run) >= {FEW}),
goes AS (SELECT * FROM held QUALIFY row_number() OVER (PARTITION BY la, lb ORDER BY doc_id, a) > 1),
ends AS (SELECT doc_id, a AS i, la AS line FROM held UNION SELECT doc_id, b, lb FROM held),
later AS (SELECT doc_id, i FROM ends QUALIFY row_number() OVER (PARTITION BY line ORDER BY doc_id, i) > 1),
lost AS MATERIALIZED (SELECT DISTINCT doc_id, i FROM (SELECT doc_id, a AS i FROM goes UNION SELECT doc_id, b FROM goes) JOIN later USING (doc_id, i)),
between_lost AS (
  SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS i FROM goes JOIN lost x USING (doc_id) JOIN lost y USING (doc_id) WHERE x.i = a AND y.i = b),
every_lost AS (SELECT * FROM lost UNION SELECT * FROM between_lost),
remaining AS (
  SELECT l.doc_id, coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (e.i IS NULL), '') AS text FROM left_lines l
  LEFT JOIN every_lost e ON e.doc_id = l.doc_id AND e.i = l.i WHERE l.doc_id IN (SELECT doc_id FROM lost) GROUP BY l.doc_id)
SELECT c.doc_id, coalesce(r.text, c.text) AS text, c.removed + coalesce(n.lost, 0) AS chunks_removed
FROM cut c LEFT JOIN remaining r USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS lost FROM lost GROUP BY doc_id) n USING (doc_id)
"""
