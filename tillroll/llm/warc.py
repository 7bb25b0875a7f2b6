"""WARC archives: written by Spark's text writer, read by a Python data source.

Writing: a record (headers, payload) is one string column and the record
separator is the writer's line separator, so files commit like any Spark output
on any store. Of equal payloads the row with the largest id becomes a response,
the others revisit it and carry no payload.

Reading (``format("warc")``): the driver packs whole files into partitions by
size. A task parses the headers of a record first and tests the pushed
predicates on record type and headers; only a wanted record's payload is read,
any other is stepped over by its Content-Length.

Defined results: NULL html counts as empty, a NULL url has no target header, a
NULL page_id is below every other and has no Page-Id header. Rows that repeat a
page_id and a payload have the same type. An empty table gives an archive
without records. Only the three named columns are read.
"""

from __future__ import annotations

import gzip
import io
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualNullSafe, EqualTo, In, InputPartition, IsNotNull,
                                    StringStartsWith)

from .common import stage, text_of

CRLF = "\r\n"
#: The two base-32 alphabets (digits of conv(), RFC 4648).
CONV32, RFC32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Revisits that may be broadcast (about 60 bytes each).
BROADCAST_ROWS = 200_000

SCHEMA = ("record_type string, record_id string, target_uri string, page_id string, refers_to string, "
          "payload_digest string, payload_bytes long, headers map<string,string>, payload binary")
#: Columns that predicates are pushed to, and the header each stands for.
PUSHED = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri",
          "page_id": "page-id", "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest"}


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base-32 SHA-1, from four groups of 40 bits."""
    digest = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), CONV32, RFC32)


def classify(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """(page, key, refers_to) of the rows that revisit another; payloads under ``min_bytes`` are never joined."""
    payload = text_of(payload_col)
    narrow = (pages.filter(F.octet_length(payload) >= min_bytes)
              .select(F.col(id_col).cast("long").alias("page"), F.unhex(F.sha2(payload, 256)).alias("key")))
    classes = stage(narrow.groupBy("key").agg(F.max("page").alias("refers_to"), F.count(F.lit(1)).alias("n"))
                    .filter("n > 1").drop("n"), "warc-classes")
    return (narrow.join(classes, "key").filter(~F.col("page").eqNullSafe(F.col("refers_to")))
            .select("page", "key", "refers_to").distinct())


def _header(name: str, value: Column) -> Column:
    clean = F.regexp_replace(value, "[\r\n]+", " ")
    return F.when(value.isNull(), "").otherwise(F.concat(F.lit(f"{name}: "), clean, F.lit(CRLF)))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", date: str = "2024-01-01T00:00:00Z", min_bytes: int = 0,
                   records_per_file: int = 50_000) -> None:
    """Write one record per row under ``path``."""
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        text_of(payload_col).alias("body")).withColumn("sha", F.unhex(F.sha2("body", 256)))
    revisits = stage(classify(pages, id_col, payload_col, min_bytes), "warc-revisits")
    if revisits.count() <= BROADCAST_ROWS:  # else both sides are shuffled by page
        revisits = F.broadcast(revisits)
    told = rows.join(revisits, F.col("id").eqNullSafe(F.col("page")) & (F.col("sha") == F.col("key")), "left")
    revisit = F.col("key").isNotNull()
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    size = F.octet_length("body").cast("string")
    record = F.concat(
        F.lit("WARC/1.1" + CRLF), _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", F.coalesce(urn(F.col("id")), F.concat(F.lit("<urn:sha256:"), F.hex("sha"), F.lit(">")))),
        F.lit(f"WARC-Date: {date}{CRLF}"), _header("WARC-Target-URI", F.col("url")), _header("Page-Id", F.col("id").cast("string")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("body").cast("binary")))),
        _header("WARC-Refers-To", F.when(revisit, urn(F.col("refers_to")))),
        _header("WARC-Profile", F.when(revisit, F.lit(PROFILE))), _header("Payload-Bytes", F.when(revisit, size)),
        F.lit("Content-Type: text/html; charset=utf-8" + CRLF),
        _header("Content-Length", F.when(revisit, "0").otherwise(size)), F.lit(CRLF),
        F.when(revisit, "").otherwise(F.col("body")))
    (told.select(record.alias("record")).write.option("lineSep", CRLF + CRLF)
     .option("maxRecordsPerFile", records_per_file).text(path))


@dataclass
class FilePartition(InputPartition):
    files: list


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payload = str(options.get("payload", "true")).lower() == "true"
        self.split_bytes = int(options.get("splitBytes", 32 << 20))
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        kinds = {EqualTo: "is", EqualNullSafe: "is", In: "in", StringStartsWith: "starts", IsNotNull: "has"}
        for f in filters:
            name = f.attribute[0] if len(f.attribute) == 1 else None
            value = getattr(f, "value", None)
            if name in PUSHED and type(f) in kinds and not (type(f) is EqualNullSafe and value is None):
                self.tests.append((PUSHED[name], kinds[type(f)], value))
            else:
                yield f

    def partitions(self):
        fs, root = _filesystem(self.path)
        files = sorted((i.path, i.size) for i in fs.get_file_info(pafs.FileSelector(root, recursive=True))
                       if i.is_file and i.size and not i.base_name.startswith(("_", ".")))
        held: list[list[str]] = []
        room = 0
        for name, size in files:
            if size > room or not held:
                held.append([])
                room = self.split_bytes
            held[-1].append(name)
            room -= size
        return [FilePartition(x) for x in held or [[]]]

    def wanted(self, headers: dict) -> bool:
        for name, kind, value in self.tests:
            x = headers.get(name)
            if x is not None and name == "warc-payload-digest":
                x = x.split(":", 1)[-1]
            if x is None or (kind == "is" and x != value) or (kind == "in" and x not in value) or (
                    kind == "starts" and not x.startswith(value)):
                return False
        return True

    def read(self, partition: FilePartition) -> Iterator[pa.RecordBatch]:
        fs, _ = _filesystem(self.path)
        for name in partition.files:
            with fs.open_input_file(name) as raw:
                stream = io.BufferedReader(raw, 1 << 20)
                packed = name.endswith(".gz")
                yield from self.batches(gzip.GzipFile(fileobj=stream) if packed else stream, name)

    def batches(self, stream, name: str) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for headers, payload in self.records(stream, name):
            digest = headers.get("warc-payload-digest")
            rows.append((headers.get("warc-type"), headers.get("warc-record-id"), headers.get("warc-target-uri"),
                         headers.get("page-id"), headers.get("warc-refers-to"), digest and digest.split(":", 1)[-1],
                         int(headers.get("payload-bytes", headers["content-length"])), list(headers.items()), payload))
            held += len(payload or b"") + 500
            if held >= 4 << 20:
                yield _batch(rows)
                rows, held = [], 0
        if rows:
            yield _batch(rows)

    def records(self, stream, name: str) -> Iterator[tuple[dict, bytes | None]]:
        while True:
            line = stream.readline()
            if not line:
                return
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"{name}: no record starts at byte {stream.tell() - len(line)}")
            headers: dict[str, str] = {}
            while (line := stream.readline().rstrip(b"\r\n")):
                key, _, value = line.decode("utf-8").partition(":")
                headers[key.strip().lower()] = value.strip()
            size = int(headers["content-length"])
            if self.payload and self.wanted(headers):
                payload = stream.read(size)
                if len(payload) != size:
                    raise ValueError(f"{name}: a record ends early")
                yield headers, payload
            else:
                stream.seek(size, io.SEEK_CUR)
                if not self.payload and self.wanted(headers):
                    yield headers, None


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string()] * 6 + [pa.int64(), pa.map_(pa.string(), pa.string()), pa.binary()]
    names = ["record_type", "record_id", "target_uri", "page_id", "refers_to", "payload_digest", "payload_bytes",
             "headers", "payload"]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


class WarcDataSource(DataSource):
    """Options: path; payload=false to read headers only; splitBytes, the size of a partition."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records under ``path``; filters on ``PUSHED`` columns reach the reader."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)
    return spark.read.format("warc").option("payload", json.dumps(payload)).load(path)
