"""Web archives: writing, an externally merged capture index, and reading back.

``write`` gives every row a WARC/1.1 record in gzip members of its own. Of records with equal payloads
of ``REVISIT_FROM`` bytes or more the one with the smallest id is the response, the others are revisits
that name it. A task writes one archive after another and, for each, its index as a locally sorted run
of captures (URL key, timestamp, id). ``merge_index`` range-partitions the runs by these keys, and every
task merges its part of all runs with a loser tree, reading each run as a stream from its own spool, so
the result is globally ordered capture histories. ``read`` takes captures from any such index, goes
to each archive once and seeks record by record.

Archives lie in the folder that ``spark.checkpoint.dir`` names (or a given one), reached with
``pyarrow.fs``. An archive's name holds its task's attempt and it is renamed when whole, so repeated
tasks never change an archive that an index names; the index is a written table and names only those
of the attempts that counted (others in the folder are leftovers of lost tasks). The spool is a file
of the task alone, as a spill is: its rows come from the shuffle and nobody else reads it.

Results for odd input: a null payload is empty; a null URL counts as empty; null ids are allowed, sort
last, and are never revisits nor responses for others; rows of equal id and payload are told apart by
a row number within their run, the first stays the response; other columns are ignored; an empty
table gives no archives and no rows.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import tempfile
import zlib
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterstone.llm.common import arrow_map, written
from meterstone.session import scratch_path

REVISIT_FROM = 100
#: Payload bytes of one archive, about.
ARCHIVE_BYTES = 64 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "run long, turn long, url_key string, stamp string, id long, record_type string, refers_to long, digest string, payload_bytes long, archive string, offset long, length long"
_FIELDS = [f.split()[0] for f in INDEX.split(", ")]


def url_key(url: str) -> str:
    """Sort key of a URL: host labels turned round, then port, path and query in lower case; no scheme, user, www or fragment."""
    parts = urlsplit(url.strip() if "://" in url else "//" + url.strip())
    host = (parts.netloc.rpartition("@")[2]).lower()
    host, _, port = host.partition(":")
    host = re.sub(r"^www\d*\.", "", host)
    turned = ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in ("80", "443") else "")
    return turned + ")" + (parts.path or "/").lower() + (f"?{parts.query.lower()}" if parts.query else "")


def safe_url_key(url: str) -> str:
    try:
        return url_key(url)
    except ValueError:  # not a URL, as in broken brackets
        return url.strip().lower()


def record(id_: int | None, url: str, stamp: str, digest: str, payload: bytes, refers_to: int | None) -> bytes:
    """One gzip member. A revisit carries no payload; X- fields keep the id and the full length."""
    revisit = refers_to is not None
    body = b"" if revisit else payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if id_ is None else id_}>",
        f"WARC-Date: {stamp}", "WARC-Target-URI: " + re.sub(r"[\r\n]+", " ", url), f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(payload)}", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}",
    ]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n", compresslevel=3, mtime=0)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and body of one record, checked for length."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    size = int(fields["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("record of wrong length")
    return fields, rest[:size]


def _filesystem(folder: str):
    import pyarrow.fs as fs

    return fs.FileSystem.from_uri(folder if re.match(r"[a-z][a-z0-9+.-]*:", folder) else "file://" + folder)


def _writer(folder: str, archive_bytes: int) -> Callable:
    """A task's rows (id, url, stamp, payload, digest, refers_to), sorted by url key, stamp and id, as archives and runs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        files, base = _filesystem(folder)
        files.create_dir(base, recursive=True)
        part, attempt = context.partitionId(), context.taskAttemptId()
        count, out, index, size = 0, io.BytesIO(), [], 0

        def close() -> pa.RecordBatch:
            nonlocal count, out, index, size
            name = f"{base}/{part:06d}-{attempt:08d}-{count:05d}.warc.gz"
            with files.open_output_stream(f"{name}.open") as f:
                f.write(out.getvalue())
            files.move(f"{name}.open", name)
            run = part << 20 | count
            rows = [(run, i, *r[:7], name.rpartition("/")[2], *r[7:]) for i, r in enumerate(sorted(index, key=lambda r: (r[0], r[1], r[2] is None, r[2] or 0)))]
            count, out, index, size = count + 1, io.BytesIO(), [], 0
            return pa.RecordBatch.from_pydict({n: pa.array(c) if n not in ("id", "refers_to") else pa.array(c, pa.int64()) for n, c in zip(_FIELDS, zip(*rows))})

        for batch in batches:
            for row in batch.to_pylist():
                payload = row["payload"].encode()
                member = record(row["id"], row["url"], row["stamp"], row["digest"], payload, row["refers_to"])
                index.append((safe_url_key(row["url"]), row["stamp"], row["id"], "response" if row["refers_to"] is None else "revisit",
                              row["refers_to"], row["digest"], len(payload), out.tell(), len(member)))
                out.write(member)
                size += len(payload) + 1000
                if size >= archive_bytes:
                    yield close()
        if index:
            yield close()

    return work


def write(df: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", stamp_col: str | None = None,
          archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the archives and returns the runs. Without ``stamp_col`` a capture's time is its id in seconds from 2020 on."""
    stamp = F.col(f"`{stamp_col}`").cast("timestamp") if stamp_col else F.timestamp_seconds(F.lit(1577836800) + F.coalesce(F.col(f"`{id_col}`"), F.lit(0)) % 1000000000)
    rows = df.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("1970-01-01T00:00:00Z")).alias("stamp"),
        F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256))
    large = F.octet_length("payload") >= REVISIT_FROM
    first = (rows.where(large & F.col("id").isNotNull()).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n"))
             .where("n > 1").select(F.col("digest").alias("of"), "first"))
    first = written(first, "firsts")  # only payloads that repeat; a plain table lets a frequent payload be split in the join
    named = rows.join(first, (F.col("digest") == F.col("of")) & large, "left")
    named = named.withColumn("refers_to", F.when(F.col("id") != F.col("first"), F.col("first")))
    work = _writer(folder, archive_bytes)
    return written(arrow_map(named.select("id", "url", "stamp", "payload", "digest", "refers_to"), work, INDEX), "runs")


class LoserTree:
    """Merges sorted streams: the winner is at the top, every inner node keeps the loser of its match."""

    def __init__(self, streams: Iterable[Iterator[tuple]]):
        self.streams = [iter(s) for s in streams]
        self.size = max(1, len(self.streams))
        self.heads = [next(s, None) for s in self.streams] or [None]
        self.losers = [-1] * self.size
        for i in range(self.size):
            self._play(i)

    def _less(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None and (x is not None or a < b) or x is not None and y is not None and (x, a) < (y, b)

    def _play(self, winner: int) -> None:
        """Takes a stream's head up its path; an empty node ends the first matches."""
        node = (winner + self.size) // 2
        while node > 0:
            other = self.losers[node]
            if other < 0:
                self.losers[node] = winner
                return
            if self._less(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while (head := self.heads[top := self.losers[0]]) is not None:
            yield head
            self.heads[top] = next(self.streams[top], None)
            self._play(top)


def _order(row: tuple) -> tuple:
    return (row[2], row[3], row[4] is None, row[4] or 0, row[0], row[1])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by run and turn: each run goes to a spool of its own, then all spools are merged as streams."""
    with tempfile.TemporaryFile() as spool:  # the task's own; its rows come from the shuffle and go on at once
        begins: list[list[int]] = []
        last, schema = None, None
        for batch in batches:
            schema = batch.schema
            runs = batch.column(0).to_pylist()
            at = 0
            while at < len(runs):
                to = at + 1
                while to < len(runs) and runs[to] == runs[at] and to - at < 1000:
                    to += 1
                place = spool.tell()
                raw = batch.slice(at, to - at).serialize()
                spool.write(raw)
                if runs[at] != last:
                    begins.append([])
                    last = runs[at]
                begins[-1].append((place, raw.size))
                at = to

        def stream(blocks: list) -> Iterator[tuple]:
            for place, size in blocks:
                spool.seek(place)
                for row in zip(*(c.to_pylist() for c in pa.ipc.read_record_batch(pa.py_buffer(spool.read(size)), schema).columns)):
                    yield _order(row), row

        held: list[tuple] = []
        for _, row in LoserTree([stream(b) for b in begins]):
            held.append(row)
            if len(held) == 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def merge_index(runs: DataFrame) -> DataFrame:
    """All runs as one table: partitions follow each other by (URL key, timestamp, id), rows within them in that order."""
    ranged = runs.repartitionByRange("url_key", "stamp", F.col("id").isNull(), "id", "run", "turn")
    return arrow_map(ranged.sortWithinPartitions("run", "turn"), _merge, INDEX)


def read(index: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to[, payload]) from the archives; digests of responses are recomputed."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _filesystem(folder)
        name, f = None, None
        number = lambda urn: int(urn[10:-1]) if urn[10:-1] else None
        for batch in batches:
            rows = []
            for archive, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if archive != name:
                    if f is not None:
                        f.close()
                    name, f = archive, files.open_input_file(f"{base}/{archive}")
                fields, body = parse(f.read_at(length, offset))
                revisit = fields["warc-type"] == "revisit"
                digest = fields["warc-payload-digest"].partition(":")[2] if revisit else hashlib.sha256(body).hexdigest()
                if not revisit and "sha256:" + digest != fields["warc-payload-digest"]:
                    raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
                size = int(fields["x-payload-length"]) if revisit else len(body)
                rows.append((number(fields["warc-record-id"]), size, digest, fields["warc-type"], number(fields["warc-refers-to"]) if revisit else None,
                             *([None if revisit else body.decode()] if payloads else [])))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
            names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")
            columns = list(zip(*rows)) if rows else [()] * (5 + payloads)
            yield pa.RecordBatch.from_pydict({n: pa.array(c, k) for n, k, c in zip(names, kinds, columns)})
        if f is not None:
            f.close()

    wanted = index.select("archive", "offset", "length").repartition("archive").sortWithinPartitions("archive", "offset")
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload string" * payloads
    return arrow_map(wanted, work, schema)


def round_trip(df: DataFrame, **columns) -> DataFrame:
    """Archives of all rows, their merged index, and what reading them through it gives."""
    folder = scratch_path(df.sparkSession, "warc")
    return read(merge_index(write(df, folder, **columns)), folder)
