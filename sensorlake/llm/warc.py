"""A deterministic, sharded writer of WARC 1.1 archives, and a reader.

Records are sorted by id and dealt to shards by ranges of ids. A shard is a series of files, each a run
of gzip members (one per record), that rolls over once its compressed size passes a limit. Headers
are written anew from the record: id, date and digests follow from the payload and the id alone, so a
second run writes the same bytes. Of records with equal payloads the one with the smallest id is the
response, and the others are revisits that name it and carry no payload.

A file is written under a temporary name of its attempt and renamed when it is whole; a manifest per
shard, renamed last, lists its files with their sizes, records and digests. A task that runs twice
replaces files by equal ones. Readers take the files that the manifests name, and check them.

The folder must be one that all executors can write to: the folder of spark.checkpoint.dir by default. A
file:// or other URL is opened with pyarrow's file systems.

Defined cases: a NULL payload is empty; a NULL url is written as an empty one and read back as NULL; rows
without an id get none and stay responses of their own (they cannot be referred to); rows that share id and
payload are separate records, the first a response and the others revisits of that id; an empty table gives
no files.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake import staging

FILE_BYTES = 8 << 20  # compressed size at which a file rolls over
SHARD_ROWS = 10_000  # records of a shard, about
MIN_BYTES = 0  # payloads smaller than this are always responses
_DATE = "1970-01-01T00:00:00Z"  # the tables hold no time of retrieval
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: that of URLs in RFC 9562
_BLOCK = 1 << 20
_RANGES = 1 << 16


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _text_id(number: int | None) -> str:
    return "none" if number is None else str(number)


def _record_id(own: str, copy: int, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{own}/{copy}/{payload_digest}')}>"


def _header(pairs: list[tuple[str, str]]) -> bytes:
    clean = "".join(f"{k}: {_one_line(v)}\r\n" for k, v in pairs)
    return f"WARC/1.1\r\n{clean}\r\n".encode()


def _one_line(value: str) -> str:
    """A header value may hold no line ends: they and the sign that marks them are written as in URLs."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _any_lines(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record(row: dict) -> bytes:
    """One WARC record, as the bytes of a gzip member."""
    payload = (row["payload"] or "").encode()
    own = _text_id(row["id"])
    refers = row["refers_to"]
    revisit = refers is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if revisit else http + payload
    pairs = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(own, row["copy"], row["digest"])),
        ("WARC-Date", _DATE),
        ("WARC-Target-URI", row["url"] or ""),
        ("WARC-Payload-Digest", f"sha1:{row['digest']}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("X-Payload-Length", str(len(payload))),
        ("X-Source-Id", own),
    ]
    if revisit:
        pairs += [
            ("WARC-Refers-To", _record_id(str(refers), 0, row["digest"])),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("X-Refers-To-Source-Id", str(refers)),
        ]
    pairs += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return gzip.compress(_header(pairs) + block + b"\r\n\r\n", compresslevel=6, mtime=0)


class _Shard:
    """Files of one shard, each whole before it gets its name."""

    def __init__(self, folder: str, number: int, attempt: str, limit: int):
        self.system, self.folder = pafs.FileSystem.from_uri(folder)
        self.number, self.attempt, self.limit = number, attempt, limit
        self.files: list[dict] = []
        self.out = None

    def _temporary(self, name: str) -> str:
        return f"{self.folder}/_temporary/{self.attempt}-{name}"

    def add(self, member: bytes) -> None:
        if self.out is None:
            self.name = f"part-{self.number:05d}-{len(self.files):05d}.warc.gz"
            self.system.create_dir(f"{self.folder}/_temporary", recursive=True)
            self.out = self.system.open_output_stream(self._temporary(self.name), compression=None)
            self.size, self.records, self.sha = 0, 0, hashlib.sha256()
        self.out.write(member)
        self.sha.update(member)
        self.size += len(member)
        self.records += 1
        if self.size >= self.limit:
            self._roll()

    def _roll(self) -> None:
        self.out.close()
        self.out = None
        self.system.move(self._temporary(self.name), f"{self.folder}/{self.name}")
        self.files.append({"file": self.name, "bytes": self.size, "records": self.records, "sha256": self.sha.hexdigest()})

    def commit(self) -> None:
        if self.out is not None:
            self._roll()
        if not self.files:
            return
        name = f"part-{self.number:05d}.manifest.json"
        with self.system.open_output_stream(self._temporary(name), compression=None) as out:
            out.write(json.dumps({"shard": self.number, "files": self.files}, sort_keys=True).encode())
        self.system.move(self._temporary(name), f"{self.folder}/{name}")


def with_firsts(records: DataFrame, *, id_: str, url: str, payload: str) -> DataFrame:
    """id, url, payload, digest, bytes, first (smallest id of several records with the payload)."""

    def digests(column: pa.Array) -> pa.Array:
        return pa.array([digest((x or "").encode()) for x in column.to_pylist()], pa.string())

    rows = records.select(
        F.col(id_).cast("long").alias("id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(payload), F.lit("")).alias("payload"),
    )
    rows = rows.withColumn("digest", F.arrow_udf(digests, "string").asNondeterministic()("payload"))
    rows = rows.withColumn("bytes", F.octet_length("payload").cast("long"))
    key = ["digest", "bytes"]
    small = rows.where(F.col("id").isNotNull()).select(*key, "id")
    firsts = small.groupBy(*key).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("held"))
    return rows.join(staging.stage(firsts.where("held > 1").drop("held")), key, "left")


def _judged(rows: Iterator[dict], min_bytes: int) -> Iterator[dict]:
    """Rows in order of id and digest, with `copy` (number among equal ones) and `refers_to`."""
    last, copy = None, 0
    for row in rows:
        key = (row["id"], row["digest"], row["bytes"])
        copy = copy + 1 if key == last and row["id"] is not None else 0
        last = key
        known = row["first"] is not None and row["id"] is not None and row["bytes"] >= min_bytes
        repeat = known and (row["id"] > row["first"] or copy > 0)
        yield row | {"copy": copy, "refers_to": row["first"] if repeat else None}


def write(
    records: DataFrame,
    folder: str,
    *,
    id_: str = "page_id",
    url: str = "url",
    payload: str = "html",
    min_bytes: int = MIN_BYTES,
    file_bytes: int = FILE_BYTES,
    shard_rows: int = SHARD_ROWS,
) -> int:
    """Write the archives into `folder` (a URL); returns the number of shards with records."""
    pafs.FileSystem.from_uri(folder)[0].create_dir(pafs.FileSystem.from_uri(folder)[1], recursive=True)
    rows, shards = _with_shard(with_firsts(records, id_=id_, url=url, payload=payload), records, id_, shard_rows)
    ordered = rows.repartitionById(max(shards, 1), F.col("shard").cast("int"))  # a shard is one task's
    ordered = ordered.sortWithinPartitions("shard", F.col("id").asc_nulls_first(), "digest", "bytes", "url")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        attempt = f"{context.stageId()}-{context.partitionId()}-{context.taskAttemptId()}"
        shard, done = None, 0
        rows = (row for batch in batches for start in range(0, batch.num_rows, 256) for row in batch.slice(start, 256).to_pylist())
        for row in _judged(rows, min_bytes):
            if shard is None or shard.number != row["shard"]:
                if shard is not None:
                    shard.commit()
                shard, done = _Shard(folder, row["shard"], attempt, file_bytes), done + 1
            shard.add(record(row))
        if shard is not None:
            shard.commit()
        yield pa.RecordBatch.from_pydict({"shards": pa.array([done], pa.int64())})

    written = staging.stage(ordered.mapInArrow(put, "shards long"))
    return int(written.agg(F.coalesce(F.sum("shards"), F.lit(0))).first()[0])


def _with_shard(rows: DataFrame, records: DataFrame, id_: str, shard_rows: int) -> tuple[DataFrame, int]:
    """`rows` with the number of their shard, by ranges of ids that follow from the counts alone.

    Ids are counted in ranges of equal width, about _RANGES at most; ranges that hold more than
    `shard_rows` are counted again in smaller ones, down to single ids. Then ranges are put together
    in order. Rows without an id are spread by their digest and url.
    """
    ids = records.select(F.col(id_).cast("long").alias("id"))
    low, high, without = ids.agg(F.min("id"), F.max("id"), F.count(F.when(F.col("id").isNull(), 1))).first()
    passes: list[_Pass] = []
    open_ = [] if low is None else [(low, high - low + 1)]
    ids = ids.where("id IS NOT NULL")
    while open_:
        here = _Pass(open_)
        ids = ids.withColumn("at", _found(passes)).where("at < 0")
        here.held = dict(ids.groupBy(here.place(-1 - F.col("at")).alias("p")).count().collect())
        crowded = [p for p in sorted(here.held) if here.held[p] > shard_rows and here.range_(p)[1] > 1]
        here.value = {p: -1 - j for j, p in enumerate(crowded)}
        open_ = [here.range_(p) for p in crowded]
        passes.append(here)
    number, full = 0, 0
    todo = [(0, p) for p in reversed(range(passes[0].first[1]))] if passes else []
    while todo:  # in order of ids
        depth, p = todo.pop()
        here = passes[depth]
        if here.value.get(p, 0) < 0:
            j = -1 - here.value[p]
            inner = passes[depth + 1].first
            todo += [(depth + 1, q) for q in reversed(range(inner[j], inner[j + 1]))]
            continue
        if full >= shard_rows:
            full, number = 0, number + 1
        here.value[p] = number
        full += here.held.get(p, 0)
    spread = -(-without // shard_rows)
    first = number + 1 if passes else 0
    loose = F.lit(first) + F.pmod(F.xxhash64("digest", "url"), F.lit(max(spread, 1)))
    if not passes:
        return rows.withColumn("shard", loose.cast("long")), first + spread
    return rows.withColumn("shard", F.when(F.col("id").isNull(), loose).otherwise(_found(passes)).cast("long")), first + spread


class _Pass:
    """Ranges (start, span), each cut into parts of equal width; parts are numbered through."""

    def __init__(self, ranges: list[tuple[int, int]]):
        ways = max(_RANGES // len(ranges), 2)
        self.start = [start for start, _ in ranges]
        self.width = [-(-span // ways) for _, span in ranges]
        self.first = [0]
        for (_, span), width in zip(ranges, self.width):
            self.first.append(self.first[-1] - (-span // width))
        self.wide = max(span for _, span in ranges) >= 1 << 63
        self.held: dict[int, int] = {}
        self.value: dict[int, int] = {}  # of a part: its shard, or -1 - the place of its range in the next pass

    def range_(self, part: int) -> tuple[int, int]:
        j = bisect_right(self.first, part) - 1
        return self.start[j] + (part - self.first[j]) * self.width[j], self.width[j]

    def place(self, j: Column) -> Column:
        """The part of an id that lies in range `j`."""
        kind = "decimal(20,0)" if self.wide else "long"
        beyond = F.col("id").cast(kind) - _item(self.start, j).cast(kind)
        return _item(self.first, j) + F.call_function("div", beyond, _item(self.width, j).cast(kind))

    def next(self, at: Column) -> Column:
        values = [self.value.get(p, 0) for p in range(self.first[-1])]
        return F.when(at >= 0, at).otherwise(_item(values, self.place(-1 - at)))


def _item(values: list[int], place: Column) -> Column:
    return F.get(F.split(F.lit(",".join(map(str, values))), ",").cast("array<long>"), place.cast("int"))


def _found(passes: list[_Pass]) -> Column:
    """Of an id: its shard, or a negative number for the range that holds it after the last pass."""
    at = F.lit(-1).cast("long")
    for one in passes:
        at = F.get(F.transform(F.array(at), one.next), 0)  # bound to a lambda variable: evaluated once
    return at


def _members(data: bytes) -> Iterator[bytes]:
    """The gzip members of a file, one at a time."""
    at = 0
    while at < len(data):
        unpack = zlib.decompressobj(wbits=31)
        parts = []
        while not unpack.eof:
            piece = data[at : at + _BLOCK]
            if not piece:
                raise ValueError("a gzip member is cut short")
            parts.append(unpack.decompress(piece))
            at += len(piece) - len(unpack.unused_data)
        yield b"".join(parts)


def parse(member: bytes) -> dict:
    """A record's fields and its payload."""
    head, _, rest = member.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0]!r}")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if f"sha1:{digest(block)}" != fields["WARC-Block-Digest"]:
        raise ValueError(f"block digest of {fields['WARC-Record-ID']} does not hold")
    payload = block.partition(b"\r\n\r\n")[2]
    response = fields["WARC-Type"] == "response"
    if response and f"sha1:{digest(payload)}" != fields["WARC-Payload-Digest"]:
        raise ValueError(f"payload digest of {fields['WARC-Record-ID']} does not hold")
    own, refers = fields["X-Source-Id"], fields.get("X-Refers-To-Source-Id")
    return {
        "id": None if own == "none" else int(own),
        "url": _any_lines(fields["WARC-Target-URI"]) or None,
        "record_type": fields["WARC-Type"],
        "payload_bytes": int(fields["X-Payload-Length"]),
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "refers_to": None if refers is None else int(refers),
        "payload": payload if response else None,
    }


_READ = pa.schema(
    [
        ("id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The records of the files that the manifests in `folder` name, checked against them."""
    manifests = spark.read.format("binaryFile").option("pathGlobFilter", "*.manifest.json").load(folder)
    files = F.from_json(F.col("content").cast("string"), "files array<struct<file: string, sha256: string>>")
    named = manifests.select(F.explode(files["files"]).alias("f")).select("f.file", "f.sha256")
    stored = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    stored = stored.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    whole = stored.join(named, "file")
    fine = F.when(F.sha2("content", 256) == F.col("sha256"), F.col("content"))
    checked = whole.select("file", F.coalesce(fine, F.raise_error(F.concat(F.lit("damaged: "), "file")).cast("binary")).alias("content"))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(1):
                rows, size = [], 0
                for member in _members(data.as_py()):
                    rows.append(parse(member))
                    size += len(member)
                    if size > 4 * _BLOCK:
                        yield pa.RecordBatch.from_pylist(rows, _READ)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _READ)

    kind = (
        "id long, url string, record_type string, payload_bytes long, payload_digest string, "
        "refers_to long, payload binary"
    )
    return checked.mapInArrow(unpack, kind)
