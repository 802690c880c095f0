"""WARC archives with duplicate payloads as revisits, and a merged capture index.

1. Payload digests pick, for every payload that occurs more than once, the capture with the
   smallest id as the response that the others revisit.
2. Tasks write their captures into gzip-compressed archives (one member per record) in the shared
   folder, a new file after ``archive_bytes``.  The captures of one archive, sorted by URL key, timestamp
   and id, are a *run*.
3. The runs' entries are dealt into ranges of (URL key, timestamp, id); inside a range the slices of
   all runs, each still sorted, are merged by a loser tree.  Ranges follow each other, so the
   index is in global order and holds every URL's history as one stretch (a long history may span ranges).
4. Archives are read back record by record.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import itertools
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ruleweave.llm.common import scratch_path, share_code, slices, written

LEAST_BYTES = 100
ARCHIVE_BYTES = 64 << 20
#: Tasks that read archives back, at most; a task streams its archives one after the other.
READERS = 20_000
#: Index entries that one task merges, about, and the least for which a further task is worth while.
RANGE_ENTRIES = 1 << 18
LEAST_ENTRIES = 4_096
EPOCH = datetime(2024, 1, 1, tzinfo=timezone.utc)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = b"\r\n"


# ---- records ---------------------------------------------------------------------------------------------------

def _clean(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(key: int | None, url: str | None, payload: bytes, digest: str, seconds: int, refers_to: int | None) -> bytes:
    """One uncompressed WARC/1.1 record; a revisit (``refers_to`` given) has the HTTP headers but no payload."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:capture:{'' if key is None else key}>",
            f"WARC-Date: {(EPOCH + timedelta(seconds=seconds)).strftime('%Y-%m-%dT%H:%M:%SZ')}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
            f"WARC-Payload-Digest: sha256:{digest}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:capture:{refers_to}>"]
    return CRLF.join([*(h.encode() for h in head), b"", block, b"", b""])


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of an uncompressed WARC stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        headers = {}
        while (line := stream.readline()) not in (CRLF, b"\n", b""):
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        n = int(headers["content-length"])
        block = stream.read(n)
        if len(block) < n:
            raise ValueError("a WARC record ends early")
        yield headers, block


def capture(headers: dict[str, str], block: bytes) -> tuple:
    """(id, payload bytes, payload digest, type, id it refers to) of a record; a response's digest is taken anew and must agree."""
    of = lambda v: int(v) if (v := v.removeprefix("<urn:capture:").rstrip(">")) else None
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = headers["warc-payload-digest"].removeprefix("sha256:")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    if headers["warc-type"] == "response" and (hashlib.sha256(payload).hexdigest() != stated or len(payload) != size):
        raise ValueError("a payload does not agree with its digest")
    refers = headers.get("warc-refers-to")
    return of(headers["warc-record-id"]), size, stated, headers["warc-type"], of(refers) if refers else None


# ---- files -----------------------------------------------------------------------------------------------------

def _files(uri: str):
    """File system and path of a URI that all tasks share (file, hdfs, s3, gs)."""
    from pyarrow import fs

    uri = re.sub(r"^file:/*", "file:///", uri) if uri.startswith("file:") else uri
    return fs.FileSystem.from_uri(uri)


class Archive:
    """One archive being written, and its run of index entries."""

    def __init__(self, folder: str):
        self.uri = f"{folder}/{uuid.uuid4().hex}.warc.gz"
        files, path = _files(folder)
        files.create_dir(path, recursive=True)
        self.out, self.at, self.run = files.open_output_stream(f"{path}/{self.uri.rpartition('/')[2]}", compression=None), 0, []

    def add(self, raw: bytes, entry: tuple) -> None:
        member = gzip.compress(raw, 6, mtime=0)
        self.out.write(member)
        self.run.append((*entry, self.uri, self.at, len(member)))
        self.at += len(member)

    def close(self) -> list[tuple]:
        self.out.close()
        self.run.sort(key=lambda e: order_key(e[:3]))
        return self.run


def order_key(entry) -> tuple:
    """URL key, timestamp, id; nulls first."""
    url, ts, key = entry
    return url.encode(), ts, key is not None, key or 0


# ---- loser tree ------------------------------------------------------------------------------------------------

class LoserTree:
    """Merges sorted runs: inner nodes hold the loser of the match below, the root the winner.

    Taking the winner's next entry replays only the matches on its way up, one comparison a level.
    """

    def __init__(self, runs: list[Iterable], key):
        self.runs, self.key, self.n = [iter(r) for r in runs], key, len(runs)
        self.head: list = [self._next(i) for i in range(self.n)]
        self.losers = [0] * max(self.n, 1)
        if self.n:
            self.losers[0] = self._play(1)

    def _next(self, i: int):
        entry = next(self.runs[i], None)
        return None if entry is None else (self.key(entry), i, entry)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.head[a], self.head[b]
        return x is not None and (y is None or x[:2] < y[:2])

    def _play(self, node: int) -> int:
        if node >= self.n:
            return node - self.n
        a, b = self._play(2 * node), self._play(2 * node + 1)
        win, lose = (a, b) if self._beats(a, b) else (b, a)
        self.losers[node] = lose
        return win

    def __iter__(self) -> Iterator:
        while self.n and (top := self.head[win := self.losers[0]]) is not None:
            yield top[2]
            self.head[win] = self._next(win)
            node = (win + self.n) // 2
            while node:
                if self._beats(self.losers[node], win):
                    self.losers[node], win = win, self.losers[node]
                node //= 2
            self.losers[0] = win


# ---- jobs ------------------------------------------------------------------------------------------------------

def url_key(url: Column) -> Column:
    """Sort-friendly key: host labels reversed, then path and query; no scheme, user, port or fragment; null gives ''."""
    bare = F.regexp_replace(F.coalesce(url, F.lit("")), "#.*$", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)", 1)), "^.*@|:[0-9]*$", "")
    rest = F.regexp_replace(bare, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*", "")
    return F.concat(F.array_join(F.reverse(F.split(host, "[.]")), ","), F.lit(")"), rest)


def revisits(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``<id, digest, refers_to>`` of the captures that repeat an earlier payload.  Counts combine before the shuffle; the join back is on light rows."""
    light = pages.filter(F.col("id").isNotNull() & (F.octet_length("payload") >= least_bytes)).select(
        "id", F.sha2("payload", 256).alias("digest"))
    first = (light.groupBy("digest").agg(F.min("id").alias("refers_to"), F.max("id").alias("_last"))
             .filter(F.col("refers_to") < F.col("_last")).drop("_last"))
    return light.join(first, "digest").filter(F.col("id") > F.col("refers_to")).distinct()


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the captures ``<id, url, url_key, ts, payload, digest, refers_to>`` and returns their index runs, each sorted.

    A repeated task writes new files and returns entries that name them; files of lost tasks are
    never named.  A task holds one record and the entries of one archive.
    """
    schema = "url_key string, ts bigint, id bigint, archive string, at bigint, size bigint, run string, place bigint"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches):
        archive = None

        def close():
            entries = archive.close()
            cols = list(zip(*[(*e, archive.uri, i) for i, e in enumerate(entries)]))
            return pa.RecordBatch.from_pydict(dict(zip(names, map(list, cols))), schema=arrow)

        for part in slices(batches, 64):
            for r in part.to_pylist():
                if archive is None:
                    archive = Archive(folder)
                raw = record(r["id"], r["url"], r["payload"], r["digest"], r["ts"], r["refers_to"])
                archive.add(raw, (r["url_key"], r["ts"], r["id"]))
                if archive.at >= archive_bytes:
                    yield close()
                    archive = None
        if archive is not None:
            yield close()

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    return written(pages.mapInArrow(run, schema), "runs")


def merged_index(runs: DataFrame) -> DataFrame:
    """``<position, url_key, ts, id, archive, at, size>``: all entries in the order of URL key, timestamp, id; positions from 0 without gaps.

    The number of ranges follows that of the entries, so a task holds about ``RANGE_ENTRIES`` of them, as Arrow columns;
    only the runs' heads become Python rows.  Equal entries (repeated rows) lie in one range.
    """
    order = ["url_key", "ts", "id"]
    entries = runs.count()
    cores = runs.sparkSession.sparkContext.defaultParallelism
    ranges = max(1, -(-entries // RANGE_ENTRIES), min(cores, -(-entries // LEAST_ENTRIES)))
    dealt = runs.repartitionByRange(ranges, *order).sortWithinPartitions("run", "place")
    schema = "url_key string, ts bigint, id bigint, archive string, at bigint, size bigint, part int, inside bigint"

    def rows_of(parts):
        for piece in slices(parts, 64):
            yield from zip(*(column.to_pylist() for column in piece.columns))

    def merge(batches):
        by_run: dict[str, list[pa.RecordBatch]] = {}
        for batch in batches:
            light, begin = batch.select(arrow.names[:6]), 0
            for name, same in itertools.groupby(batch["run"].to_pylist()):
                end = begin + sum(1 for _ in same)
                by_run.setdefault(name, []).append(light.slice(begin, end - begin))
                begin = end
        tree = LoserTree([rows_of(by_run[k]) for k in sorted(by_run)], key=lambda e: order_key(e[:3]))
        part, rows = TaskContext.get().partitionId(), []
        for i, entry in enumerate(tree):
            rows.append((*entry, part, i))
            if len(rows) == 4096:
                yield pa.RecordBatch.from_pydict(dict(zip(arrow.names, map(list, zip(*rows)))), schema=arrow)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pydict(dict(zip(arrow.names, map(list, zip(*rows)))), schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    ranged = written(dealt.mapInArrow(merge, schema), "index")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("_n")).select(
        "part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return ranged.join(F.broadcast(offsets), "part").select(
        (F.col("_off") + F.col("inside")).alias("position"), "url_key", "ts", "id", "archive", "at", "size")


def read_archives(archives: DataFrame) -> DataFrame:
    """``<archive, at, id, payload_bytes, payload_digest, record_type, refers_to>`` of every record of the named archives, streamed."""
    schema = ("archive string, at bigint, id bigint, payload_bytes bigint, payload_digest string, record_type string, "
              "refers_to bigint")
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def members(stream) -> Iterator[tuple[int, bytes]]:
        """(offset, content) of every gzip member."""
        at, inflate, raw, used = 0, zlib.decompressobj(31), [], 0
        data = stream.read(1 << 20)
        while data:
            raw.append(inflate.decompress(data))
            if inflate.eof:
                rest = inflate.unused_data
                used += len(data) - len(rest)
                yield at, b"".join(raw)
                at, inflate, raw = used, zlib.decompressobj(31), []
                data = rest or stream.read(1 << 20)
            else:
                used += len(data)
                data = stream.read(1 << 20)

    def run(batches):
        for batch in batches:
            for uri in batch["archive"].to_pylist():
                files, path = _files(uri)
                rows = []
                with files.open_input_stream(path, compression=None) as stream:
                    for at, content in members(stream):
                        for headers, block in read_records(io.BytesIO(content)):
                            rows.append((uri, at, *capture(headers, block)))
                        if len(rows) >= 1024:
                            yield pa.RecordBatch.from_pydict(dict(zip(arrow.names, map(list, zip(*rows)))), schema=arrow)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pydict(dict(zip(arrow.names, map(list, zip(*rows)))), schema=arrow)

    return archives.select("archive").mapInArrow(run, schema)


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  folder: str | None = None, least_bytes: int = LEAST_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> tuple[DataFrame, DataFrame]:
    """Archives every page and returns (index, captures read back).

    A page's timestamp is its id in seconds after 2024-01-01 (modulo one year; 0 for a null id), the table having none.
    Null html is an empty payload; payloads under ``least_bytes`` and rows with a null id are
    always responses; rows that repeat the smallest id of a payload are responses too.  A null URL is
    left out of the record and has the key ``)``.  Other columns are not read.  An empty table
    gives an empty index and no archive.
    """
    spark = pages.sparkSession
    share_code(spark)
    base = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"))
    again = revisits(base, least_bytes)
    full = base.withColumn("digest", F.sha2("payload", 256))
    on = [full.id == again.id, full.digest == again.digest]
    tagged = full.join(again.hint("shuffle_hash"), on, "left").select(
        full.id, "url", url_key(F.col("url")).alias("url_key"),
        F.coalesce(F.pmod(full.id, F.lit(31_536_000)), F.lit(0)).cast("long").alias("ts"), "payload", full.digest, "refers_to")
    runs = write_archives(tagged, folder or scratch_path(spark, "warc"), archive_bytes)
    index = merged_index(runs)
    archives = runs.select("archive").distinct()
    # a number keeps small rows that stand for large files from being coalesced into one task
    return index, read_archives(archives.repartition(max(1, min(archives.count(), READERS))))
