"""WARC archives with a two-level capture index.

Writing: each task writes the records of its partition to one archive file, one
gzip member per record, and returns where they lie. Index: rows of reversed-host
URL key, page and place are sorted by range; each task packs its lines into
compressed blocks of ``block_lines`` lines, and one directory row per block keeps
its first and last (key, page) and its place. Reading: lookups are sorted in the same
order, a task loads the directory rows of its own range, finds the block of each
lookup by binary search, then the line, and reads just that record. As pages are part
of the order, one URL with very many captures is looked up like any others.

What is read back is checked: the block digest of every record, and size and digest of
a response's payload, which are measured on the payload itself. A record that differs
from its headers raises DamagedRecord. A revisit has no payload; its header counts.

File names hold the task attempt and only files of committed attempts appear in
the written place tables, so a repeated task leaves an unused file at worst. Files
lie below the session's shared checkpoint folder, on the file system that Spark finds it
on, and tasks reach them through pyarrow.

Of records with equal payloads of at least ``revisit_bytes`` bytes that with the
smallest page_id is the response; the others are revisits that refer to it and
keep the payload's length in their HTTP header.

Defined cases: a null html is an empty payload; a null url is the empty one; rows
that share the response's page_id and payload are responses too; a null page_id is
never the smallest unless all are null; an empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.plans.scratch import scratch_dir

#: Pages carry no capture time; all records get this one.
CAPTURED = "1970-01-01T00:00:00Z"
RECORD_ID = "<urn:x-page:{}>"

PLACES = "key string, page_id long, file string, at long, length long"
DIRECTORY = (
    "first string, first_id long, last string, last_id long, file string, at long, length long"
)
CAPTURES = (
    "page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long"
)


#: Place of a null page among the others, as Spark sorts it.
NO_PAGE = -(2**63)


class DamagedRecord(ValueError):
    """A record that differs from its headers."""


@dataclass(frozen=True)
class Archive:
    """An archive on shared storage: record files and their index directory."""

    folder: str
    directory: str


def surt(url: str | None) -> str:
    """Sort key of a URL: host labels reversed, then the rest, all lower case; what
    is no URL is its own key."""
    plain = re.sub(r"[\x00-\x20]", "", url or "").lower()
    try:
        parts = urlsplit(plain)
    except ValueError:
        return plain
    host, _, port = parts.netloc.rpartition("@")[2].partition(":")
    labels = ",".join(reversed(host.split(".")))
    query = f"?{parts.query}" if parts.query else ""
    return f"{labels}{f':{port}' if port else ''}){parts.path or '/'}{query}"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url, payload: bytes, size: int, digest: str, refers_to, revisit: bool) -> bytes:
    """One WARC/1.1 record; a revisit holds the HTTP header only."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {size}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {RECORD_ID.format('' if page_id is None else page_id)}",
        f"WARC-Date: {CAPTURED}",
        f"WARC-Target-URI: {quote(url or '', safe='%/:=&?~#+!$,;@()*[]' + chr(39))}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if revisit:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {RECORD_ID.format(refers_to)}",
        ]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}"])
    return head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _number(value: str | None) -> int | None:
    digits = re.sub(r"[^0-9-]", "", (value or "").removeprefix("<urn:x-page:"))
    return int(digits) if digits else None


def parsed(raw: bytes) -> dict:
    """The capture in one uncompressed record, checked against its headers."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = fields["WARC-Type"] == "revisit"
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if base32_sha1(block) != fields["WARC-Block-Digest"].removeprefix("sha1:"):
        raise DamagedRecord(f"block of {fields['WARC-Record-ID']}")
    if not revisit:
        found = len(payload), base32_sha1(payload)
        if found != (size, digest):
            raise DamagedRecord(f"payload of {fields['WARC-Record-ID']}")
        size, digest = found
    return {
        "page_id": _number(fields["WARC-Record-ID"]),
        "url": fields["WARC-Target-URI"],
        "payload": None if revisit else payload,
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": _number(fields.get("WARC-Refers-To")),
    }


class _Appender:
    """A file of one task attempt, written front to back."""

    def __init__(self, folder: str, kind: str):
        task = TaskContext.get()
        self.name = f"{kind}-{task.partitionId():06d}-{task.taskAttemptId()}.gz"
        store, path = pafs.FileSystem.from_uri(f"{folder}/{self.name}")
        store.create_dir(path.rpartition("/")[0], recursive=True)
        self.stream, self.at = store.open_output_stream(path, compression=None), 0

    def add(self, raw: bytes) -> tuple[int, int]:
        packed = gzip.compress(raw, 6, mtime=0)
        self.stream.write(packed)
        start, self.at = self.at, self.at + len(packed)
        return start, len(packed)


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the file system that Spark finds it on, so that tasks write where
    Spark reads."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return re.sub("^file:/+", "file:///", store.makeQualified(path).toString())


class _Reader:
    """Range reads; keeps the files it has opened."""

    def __init__(self, folder: str):
        self.folder = folder
        self.open = lru_cache(64)(self._open)

    def _open(self, name: str):
        store, path = pafs.FileSystem.from_uri(f"{self.folder}/{name}")
        return store.open_input_file(path)

    def read(self, name: str, at: int, length: int) -> bytes:
        return gzip.decompress(self.open(name).read_at(length, at))


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


_PLACES = pa.schema(
    [("key", "string"), ("page_id", "int64"), ("file", "string"), ("at", "int64"), ("length", "int64")]
)
_DIRECTORY = pa.schema(
    [
        ("first", "string"),
        ("first_id", "int64"),
        ("last", "string"),
        ("last_id", "int64"),
        ("file", "string"),
        ("at", "int64"),
        ("length", "int64"),
    ]
)
_CAPTURES = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload", pa.binary()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
    ]
)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = pa.array([surt(url) for url in batch.column("url").to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([keys, batch.column("page_id")], ["key", "page_id"])


def _write_records(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                out = out or _Appender(folder, "warc")
                raw = record(
                    row["page_id"],
                    row["url"],
                    row["payload"] or b"",
                    row["size"],
                    base64.b32encode(bytes.fromhex(row["sha1"])).decode(),
                    row["refers_to"],
                    row["revisit"],
                )
                rows.append((surt(row["url"]), row["page_id"], out.name, *out.add(raw)))
            yield _batch(rows, _PLACES)
        if out:
            out.stream.close()

    return write


def _rank(page_id: int | None) -> int:
    return NO_PAGE if page_id is None else page_id


def _line(row: dict) -> str:
    return json.dumps([row["key"], row["page_id"], row["file"], row["at"], row["length"]])


def _write_blocks(folder: str, block_lines: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held, made = None, [], []

        def flush() -> None:
            nonlocal out
            out = out or _Appender(folder, "index")
            place = out.add("\n".join(map(_line, held)).encode())
            ends = [(x["key"], _rank(x["page_id"])) for x in (held[0], held[-1])]
            made.append((*ends[0], *ends[1], out.name, *place))
            held.clear()

        for batch in batches:
            for row in batch.to_pylist():
                held.append(row)
                if len(held) >= block_lines:
                    flush()
        if held:
            flush()
        if out:
            out.stream.close()
        yield _batch(made, _DIRECTORY)

    return write


def prepared(pages: DataFrame, revisit_bytes: int = 0) -> DataFrame:
    """One row per record to write. Which rows are revisits is found on digests alone;
    payloads then move once, by page, so that copies of one payload are not brought
    together."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("page"),
        "url",
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("size"),
        F.sha1(payload).alias("sha1"),
    )
    digests = rows.select("page", "page_id", "sha1")
    firsts = digests.groupBy("sha1").agg(F.min("page_id").alias("refers_to"))
    known = digests.distinct().join(firsts, "sha1")
    known = known.select("page", "sha1", "refers_to")
    same = F.col("page_id").eqNullSafe(F.col("refers_to"))
    revisit = (F.col("size") >= revisit_bytes) & ~same
    return rows.join(known, ["page", "sha1"]).withColumns(
        {
            "revisit": revisit,
            "refers_to": F.when(revisit, F.col("refers_to")),
            "payload": F.when(~revisit, F.col("payload")),
        }
    ).drop("page")


def _tasks(spark: SparkSession) -> int:
    """A number of tasks that is asked for is kept; Spark would size them by the
    narrow rows, not by the records and blocks that these stand for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def write_archive(pages: DataFrame, revisit_bytes: int = 0, block_lines: int = 1000) -> Archive:
    """Writes records, index blocks and directory of (page_id, url, html) rows."""
    spark = pages.sparkSession
    folder = _qualified(spark, scratch_dir(spark, "warc"))
    places = f"{folder}/places"
    prepared(pages, revisit_bytes).mapInArrow(_write_records(folder), PLACES).write.parquet(places)
    directory = f"{folder}/directory"
    (
        spark.read.schema(PLACES)
        .parquet(places)
        .repartitionByRange(_tasks(spark), "key", "page_id")
        .sortWithinPartitions("key", "page_id")
        .mapInArrow(_write_blocks(folder, block_lines), DIRECTORY)
        .write.parquet(directory)
    )
    return Archive(folder, directory)


def _slice(directory: ds.Dataset, low: tuple, high: tuple) -> list[dict]:
    """The directory rows whose blocks may hold something of [low, high], in order."""
    key, page = ds.field, ds.scalar
    starts = (key("first") < high[0]) | ((key("first") == high[0]) & (key("first_id") <= page(high[1])))
    ends = (key("last") > low[0]) | ((key("last") == low[0]) & (key("last_id") >= page(low[1])))
    found = directory.to_table(filter=starts & ends)
    order = [f.name for f in _DIRECTORY]
    return sorted(found.to_pylist(), key=lambda x: [x[name] for name in order])


def blocks_of(entries: list[dict], lasts: list[tuple], want: tuple) -> Iterator[int]:
    """Numbers of the blocks that may hold a (key, page), by binary search."""
    at = bisect.bisect_left(lasts, want)
    while at < len(entries) and (entries[at]["first"], entries[at]["first_id"]) <= want:
        yield at
        at += 1


def _read_records(archive: Archive):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, directory = _Reader(archive.folder), None
        for batch in batches:
            wanted = [(x["key"], _rank(x["page_id"])) for x in batch.to_pylist()]
            if not wanted:
                continue
            if directory is None:
                store, path = pafs.FileSystem.from_uri(archive.directory)
                directory = ds.dataset(path, schema=_DIRECTORY, filesystem=store, format="parquet")
            entries = _slice(directory, wanted[0], wanted[-1])
            lasts = [(x["last"], x["last_id"]) for x in entries]
            loaded: tuple[int, list] = (-1, [])
            rows, held = [], 0
            for want in wanted:
                for at in blocks_of(entries, lasts, want):
                    if loaded[0] != at:
                        e = entries[at]
                        block = files.read(e["file"], e["at"], e["length"]).decode()
                        loaded = (at, list(map(json.loads, block.split("\n"))))
                    lines = loaded[1]
                    i = bisect.bisect_left(lines, want, key=lambda x: (x[0], _rank(x[1])))
                    while i < len(lines) and (lines[i][0], _rank(lines[i][1])) == want:
                        capture = parsed(files.read(*lines[i][2:]))
                        rows.append(tuple(capture[f.name] for f in _CAPTURES))
                        held += len(capture["payload"] or b"")
                        i += 1
                if held > 32_000_000:
                    yield _batch(rows, _CAPTURES)
                    rows, held = [], 0
            yield _batch(rows, _CAPTURES)

    return read


def read_captures(archive: Archive, lookups: DataFrame) -> DataFrame:
    """The captures of (page_id, url) rows, found through the index."""
    return (
        lookups.select(F.col("page_id").cast("long").alias("page_id"), "url")
        .mapInArrow(_keys, "key string, page_id long")
        .distinct()
        .repartitionByRange(_tasks(lookups.sparkSession), "key", "page_id")
        .sortWithinPartitions("key", "page_id")
        .mapInArrow(_read_records(archive), CAPTURES)
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes the pages and reads every capture back."""
    return read_captures(write_archive(pages), pages.select("page_id", "url"))
