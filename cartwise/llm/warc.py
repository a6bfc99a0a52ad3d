"""WARC archives as a PySpark Python data source (format ``warc``).

Writing. ``archive`` gives every record a digest, makes of records with equal
payloads the one with the largest key the response and the others revisits of it,
and the data source writer puts each record into its own gzip member, whose extra
field ``sl`` carries the member's compressed and uncompressed size (any gzip reader
can read the files). A task rolls to a new file at ``FILE_BYTES``; the files of
committed tasks are listed in a manifest that the driver writes last, so what a
lost or repeated task attempt left behind is never read.

Reading. The driver plans one partition per file of the manifest (or of a folder
of archives without one); small files share a partition. Equality filters on the
record type and on headers are pushed down. A record's headers are parsed from the
first bytes of its member; a record that a filter rejects, and the payload where
the schema does not ask for it, are skipped by seeking to the next member without
inflating the rest.

Files are opened through the file system of their URI (``pyarrow.fs``), so archives
lie in the shared folder whatever it is.

Defined results: a null payload is empty; empty payloads are records like others
(and equal to each other, where ``least_bytes`` is 0); ties of the key among equal
payloads (repeated rows) leave one response each; a null key is the smallest; an
empty table writes a manifest without files and reads back no rows; other columns
are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceWriter, EqualTo, In, InputPartition,
                                    WriterCommitMessage)

from cartwise.llm.common import binary_values

SCHEMA = ("record_type string, record_id string, target_uri string, key bigint, date string, payload_digest string, "
          "payload_length bigint, refers_to string, payload binary")
FILE_BYTES = 64 << 20
PARTITION_BYTES = 32 << 20
#: Bytes inflated first; headers are nearly always within.
HEAD = 2048
_HEADERS = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI",
            "date": "WARC-Date", "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To"}
MANIFEST = "_records.json"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(key: str):
    """A record id that names the key, so a task that runs again writes the same record."""
    return F.concat(F.lit("<urn:x-record:"), F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(">"))


def key_of(record: str):
    """The key that a record id names; null for ids of other makers."""
    return F.regexp_extract(record, "^<urn:x-record:(-?[0-9]+)>$", 1).try_cast("bigint")


def _line(value) -> str:
    """A header value: line ends inside would end the header."""
    return "".join(c if c.isprintable() else "%{:02X}".format(ord(c)) for c in str(value))


def record_bytes(r: dict) -> bytes:
    """One WARC/1.1 record. The HTTP head gives the payload's length for revisits too."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {r['payload_length']}\r\n\r\n"
    block = http.encode() + (r["payload"] or b"" if r["record_type"] == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {r['record_type']}", f"WARC-Record-ID: {r['record_id']}",
            f"WARC-Date: {r['date']}", f"X-Record-Key: {'' if r['key'] is None else r['key']}"]
    if r["target_uri"]:
        head.append(f"WARC-Target-URI: {_line(r['target_uri'])}")
    head.append(f"WARC-Payload-Digest: sha1:{r['payload_digest']}")
    if r["record_type"] == "revisit":
        head += [f"WARC-Refers-To: {r['refers_to']}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(raw: bytes, level: int = 1) -> bytes:
    """``raw`` as a gzip member whose ``sl`` field holds (compressed, uncompressed) size."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(raw) + z.flush()
    size = 12 + 12 + len(body) + 8  # fixed head and field length, the field, data, trailer
    field = b"sl" + struct.pack("<HII", 8, size, len(raw))
    return (b"\x1f\x8b\x08\x04" + b"\0" * 5 + b"\xff" + struct.pack("<H", len(field)) + field + body
            + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF))


def _skip_size(head: bytes) -> int | None:
    """The member's size from its ``sl`` field, if it has one."""
    if len(head) < 12 or head[:3] != b"\x1f\x8b\x08" or not head[3] & 4:
        return None
    end = 12 + struct.unpack("<H", head[10:12])[0]
    at = 12
    while at + 4 <= min(end, len(head)):
        size = struct.unpack("<H", head[at + 2:at + 4])[0]
        if head[at:at + 2] == b"sl" and size >= 8:
            return struct.unpack("<I", head[at + 4:at + 8])[0]
        at += 4 + size
    return None


def _headers(raw: bytes) -> dict[str, str]:
    out = {}
    for line in raw.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def _filesystem(path: str):
    """(file system, path) of a URI or of a plain path."""
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


@dataclass
class Files(WriterCommitMessage):
    names: list
    records: int


class WarcWriter(DataSourceWriter):
    def __init__(self, options: dict, schema):
        self.path = options["path"]
        self.names = [f.name for f in schema.fields]

    def write(self, rows):
        fs, root = _filesystem(self.path)
        fs.create_dir(root, recursive=True)
        names, count, size, out = [], 0, 0, None
        for row in rows:
            if out is None or size >= FILE_BYTES:
                if out:
                    out.close()
                names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                out, size = fs.open_output_stream(f"{root}/{names[-1]}", compression=None), 0
            data = member(record_bytes(dict(zip(self.names, row))))
            out.write(data)
            size += len(data)
            count += 1
        if out:
            out.close()
        return Files(names, count)

    def commit(self, messages):
        fs, root = _filesystem(self.path)
        fs.create_dir(root, recursive=True)
        names = [n for m in messages if m for n in m.names]
        with fs.open_output_stream(f"{root}/{MANIFEST}") as out:
            out.write(json.dumps(names).encode())

    def abort(self, messages):
        fs, root = _filesystem(self.path)
        for name in [n for m in messages if m for n in m.names]:
            fs.delete_file(f"{root}/{name}")


class FileGroup(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(None)
        self.paths = paths


class WarcReader(DataSourceReader):
    def __init__(self, options: dict, schema):
        self.path = options["path"]
        self.columns = [f.name for f in schema.fields]
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters):
        """Equality on the record type and on headers is decided while parsing headers."""
        for f in filters:
            column = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if column in _HEADERS:
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[column] = self.wanted.get(column, values) & values
            else:
                yield f

    def partitions(self):
        fs, root = _filesystem(self.path)
        try:
            with fs.open_input_stream(f"{root}/{MANIFEST}") as f:
                named = set(json.loads(f.read()))
        except FileNotFoundError:
            named = None
        info = [i for i in fs.get_file_info(pafs.FileSelector(root))
                if i.is_file and (i.base_name in named if named is not None else ".warc" in i.base_name)]
        groups, size = [[]], 0
        for i in sorted(info, key=lambda i: i.base_name):
            if groups[-1] and size + i.size > PARTITION_BYTES:
                groups.append([])
                size = 0
            groups[-1].append(f"{self.path.rstrip('/')}/{i.base_name}")
            size += i.size
        return [FileGroup(g) for g in groups]

    def read(self, partition):
        for path in partition.paths:
            fs, name = _filesystem(path)
            with fs.open_input_file(name) as f:
                yield from self._records(f, f.size())

    def _records(self, f, end: int):
        at = 0
        while at < end:
            f.seek(at)
            head = f.read(HEAD)
            z = zlib.decompressobj(31)
            raw, fed = z.decompress(head), at + len(head)
            while b"\r\n\r\n" not in raw and not z.eof and fed < end:
                more = f.read(HEAD)
                fed += len(more)
                raw += z.decompress(more)
            cut = raw.find(b"\r\n\r\n")
            headers = _headers(raw[:cut])
            size = _skip_size(head)
            row = self._row(headers)
            fits = all(row[c] in v for c, v in self.wanted.items())
            if size is None or (fits and ("payload" in self.columns or "payload_length" in self.columns)):
                row, fed, left = self._body(f, z, raw, cut + 4, fed, end, headers, row,
                                            "payload" in self.columns and fits or size is None)
                if size is None:
                    size = fed - left - at
            if fits:
                yield tuple(row[c] for c in self.columns)
            at += size

    def _body(self, f, z, raw, start, fed, end, headers, row, whole: bool):
        """The HTTP head, and the payload where it is wanted; the bytes fed and left over."""
        while (whole or b"\r\n\r\n" not in raw[start:]) and not z.eof and fed < end:
            more = f.read(1 << 16 if whole else HEAD)
            fed += len(more)
            raw += z.decompress(more)
        block = raw[start:start + int(headers.get("content-length", "0"))]
        http, _, payload = block.partition(b"\r\n\r\n")
        length = _headers(http).get("content-length", "")
        row["payload_length"] = int(length) if length.isdigit() else len(payload)
        row["payload"] = payload if row["record_type"] == "response" else None
        return row, fed, len(z.unused_data)

    @staticmethod
    def _row(headers: dict) -> dict:
        row = {c: headers.get(h.lower()) for c, h in _HEADERS.items()}
        if row["payload_digest"]:
            row["payload_digest"] = row["payload_digest"].partition(":")[2]
        key = headers.get("x-record-key", "")
        return row | {"key": int(key) if key.lstrip("-").isdigit() else None, "payload_length": None, "payload": None}


class WarcDataSource(DataSource):
    """``spark.read.format("warc")``; columns not asked for are not decoded."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options, schema)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options, schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def payloads(df: DataFrame, key_col: str, uri_col: str, text_col: str) -> DataFrame:
    """(key, target_uri, payload): the texts in UTF-8."""
    return df.select(F.col(key_col).cast("bigint").alias("key"), F.col(uri_col).cast("string").alias("target_uri"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("payload"))


def with_digest(df: DataFrame) -> DataFrame:
    """``df`` (key, target_uri, payload) with payload_digest and payload_length."""
    out = pa.schema([("key", pa.int64()), ("target_uri", pa.string()), ("payload", pa.binary()),
                     ("payload_digest", pa.string()), ("payload_length", pa.int64())])

    def run(batches):
        for b in batches:
            values = list(binary_values(b.column("payload")))
            yield pa.record_batch([b.column("key"), b.column("target_uri"), b.column("payload"),
                                   pa.array([sha1_base32(p) for p in values], pa.string()),
                                   pa.array([len(p) for p in values], pa.int64())], schema=out)

    return df.mapInArrow(run, "key bigint, target_uri string, payload binary, payload_digest string, payload_length bigint")


def measured(df: DataFrame) -> DataFrame:
    """(key, payload_digest, payload_length) of the payloads of ``df`` (key, payload)."""
    out = pa.schema([("key", pa.int64()), ("payload_digest", pa.string()), ("payload_length", pa.int64())])

    def run(batches):
        for b in batches:
            payloads = [v or b"" for v in binary_values(b.column("payload"))]
            yield pa.record_batch([b.column("key"), pa.array([sha1_base32(p) for p in payloads], pa.string()),
                                   pa.array([len(p) for p in payloads], pa.int64())], schema=out)

    return df.select("key", "payload").mapInArrow(run, "key bigint, payload_digest string, payload_length bigint")


def archive(df: DataFrame, path: str, key_col: str = "page_id", uri_col: str = "url", text_col: str = "html",
            least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> str:
    """Writes a record per row of ``df`` to ``path``. Of payloads of at least
    ``least_bytes`` that are equal, the one with the largest key is the response.

    Only (digest, key) is exchanged to find the repeats: digests that occur once leave
    after a map-side combined count, and the rows join the rest, which AQE splits
    where one payload is very common.
    """
    spark = df.sparkSession
    register(spark)
    raw = payloads(df, key_col, uri_col, text_col)
    rows = with_digest(raw)
    repeated = (measured(raw).where(F.col("payload_length") >= least_bytes).groupBy("payload_digest")
                .agg(F.max("key").alias("first"), F.count("*").alias("n")).where("n > 1")
                .select(F.col("payload_digest").alias("d"), "first"))
    joined = rows.join(repeated, (F.col("payload_digest") == F.col("d")) & (F.col("payload_length") >= least_bytes), "left")
    again = F.coalesce(F.col("key") < F.col("first"), F.col("key").isNull() & F.col("first").isNotNull(), F.lit(False))
    out = joined.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"), record_id("key").alias("record_id"), "target_uri",
        "key", F.lit(date).alias("date"), "payload_digest", "payload_length",
        F.when(again, record_id("first")).alias("refers_to"), F.when(~again, F.col("payload")).alias("payload"))
    out.write.format("warc").mode("append").save(path)
    return path


def read_archive(spark: SparkSession, path: str, columns: str = SCHEMA) -> DataFrame:
    """The records, with the columns of the DDL ``columns``."""
    register(spark)
    return spark.read.format("warc").schema(columns).load(path)
