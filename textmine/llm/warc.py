"""Deterministic sharded WARC writer, and the reader of what it wrote.

Pages are dealt into ranges of their id that store about as many bytes each, sorted, and written as gzip
members to files that roll over by compressed size. Headers, digests and record ids follow from the rows
alone. A file is written under a temporary name and moved to a name that depends on its range only, so a
task that runs again replaces its own files by equal ones. What counts are the files of the manifest, which
is written last, into the archive's folder: an archive without one is not there.

Folders are opened through ``pyarrow.fs``: local and shared mounts, HDFS, S3 and GCS by their URI.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmine.operators.lookup import lookup_join
from textmine.sources.scratch import scratch_path, written

MIN_REVISIT_BYTES = 1000
SHARD_BYTES = 32 * 1024 * 1024
FILE_BYTES = 32 * 1024 * 1024
# Ranges, and rows of the sample that cuts them, at most; a range of a very large archive holds more bytes.
MOST_SHARDS = 20_000
SAMPLES_PER_SHARD, MOST_SAMPLES = 256, 1_000_000
# What a record stores besides its payload, about.
RECORD_BYTES = 700
CHUNK = 1 << 20
# Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

MANIFEST = "file string, shard long, part int, records long, bytes long, sha256 string"
RECORDS = "page_id {}, payload_bytes long, payload_digest string, record_type string, refers_to {}, url string, payload binary"


class Archive(NamedTuple):
    """A committed archive: its folder, and the manifest in it as a table of files."""

    folder: str
    manifest: DataFrame


def _uri(folder: str) -> str:
    return folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(_uri(folder))


def _record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'page/{page_id}/{digest}')}>"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{name}: {value}\r\n" for name, value in headers)
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)  # a gzip member without time or name
    return packer.compress(VERSION + lines.encode() + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def _page_member(row: dict, date: str) -> bytes:
    size, digest = row["bytes"], row["digest"]
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    revisit = row["refers_to"] is not None
    if not revisit:
        block += row["payload"]
    url = row["url"] if row["url"] is not None else f"urn:page:{row['page_id']}"
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(row["page_id"], digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", quote(url, safe="%/:=&?~#+!$,;'@()*[]")),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
        ("WARC-Block-Digest", _sha1(block)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if row["page_id"] is not None:
        headers.append(("X-Page-Id", str(row["page_id"])))
    if revisit:
        headers += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", _record_id(row["refers_to"], digest)),
            ("X-Refers-To-Page-Id", str(row["refers_to"])),
        ]
    return _member(headers, block)


class _Shard:
    """The files of one range of ids, written one after the other."""

    def __init__(self, folder: str, number: int, date: str, file_bytes: int):
        self.fs, self.root = _open(folder)
        self.number, self.date, self.file_bytes = number, date, file_bytes
        self.part, self.out, self.done = 0, None, []

    def write(self, row: dict) -> None:
        if self.out is None:
            self.name = f"shard-{self.number:08d}-{self.part:05d}.warc.gz"
            self.fs.create_dir(f"{self.root}/_unfinished", recursive=True)
            self.temporary = f"{self.root}/_unfinished/{self.name}.{uuid.uuid4().hex}"
            self.out = self.fs.open_output_stream(self.temporary, compression=None)
            self.size, self.records, self.digest = 0, 0, hashlib.sha256()
            body = f"software: textmine\r\nformat: WARC File Format 1.1\r\nshard: {self.number}\r\n".encode()
            self._put(
                _member(
                    [
                        ("WARC-Type", "warcinfo"),
                        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(NAMESPACE, self.name)}>"),
                        ("WARC-Date", self.date),
                        ("WARC-Filename", self.name),
                        ("Content-Type", "application/warc-fields"),
                        ("Content-Length", str(len(body))),
                    ],
                    body,
                )
            )
        self._put(_page_member(row, self.date))
        self.records += 1
        if self.size >= self.file_bytes:
            self.close()

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.digest.update(data)
        self.size += len(data)

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        self.fs.move(self.temporary, f"{self.root}/{self.name}")
        self.done.append((self.name, self.number, self.part, self.records, self.size, self.digest.hexdigest()))
        self.part, self.out = self.part + 1, None


def _write_shards(folder: str, date: str, file_bytes: int):
    schema = pa.schema(
        [("file", pa.string()), ("shard", pa.int64()), ("part", pa.int32()), ("records", pa.int64()),
         ("bytes", pa.int64()), ("sha256", pa.string())]
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            columns = [batch.column(name) for name in batch.schema.names]
            for i in range(batch.num_rows):
                row = {name: column[i].as_py() for name, column in zip(batch.schema.names, columns)}
                if shard is None or shard.number != row["shard"]:
                    if shard is not None:
                        shard.close()
                        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in shard.done], schema)
                    shard = _Shard(folder, row["shard"], date, file_bytes)
                shard.write(row)
        if shard is not None:
            shard.close()
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in shard.done], schema)

    return task


def _bounds(stored: DataFrame, total: int, rows: int, shard_bytes: int) -> list:
    """First ids of all ranges but the first, so that ranges store about equal numbers of bytes.

    ``stored`` has ``(page_id, stored)``. The sample is chosen by the hash of the id, so equal tables give
    equal ranges, and its bytes are added up in the order of ids.
    """
    shards = min(MOST_SHARDS, -(-total // shard_bytes))
    if shards <= 1:
        return []
    wanted = min(SAMPLES_PER_SHARD * shards, MOST_SAMPLES)
    share = min(1.0, wanted / max(rows, 1))
    picked = stored.where(F.pmod(F.xxhash64("page_id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    weights = picked.where("page_id is not null").groupBy("page_id").agg(F.sum("stored").alias("stored"))
    # About as many rows as wanted.
    sample = sorted((r["page_id"], r["stored"]) for r in weights.collect())
    if not sample:
        return []
    sums = np.cumsum([weight for _, weight in sample])
    cuts = np.searchsorted(sums, sums[-1] * np.arange(1, shards) / shards, side="right")
    return sorted({sample[k][0] for k in cuts if 0 < k < len(sample)})


def _range_of(bounds: list):
    """The number of a range from the id, which must not be null."""
    words = bool(bounds) and isinstance(bounds[0], str)
    edges = np.array(bounds, object if words else np.int64)

    def numbers(ids: pd.Series) -> pd.Series:
        if not len(edges):
            return pd.Series(np.zeros(len(ids), np.int32))
        return pd.Series(np.searchsorted(edges, ids.to_numpy(edges.dtype), side="right").astype(np.int32))

    return F.pandas_udf(numbers, "int")


def write_archive(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    date: str = "2024-01-01T00:00:00Z",
    min_revisit_bytes: int = MIN_REVISIT_BYTES,
    shard_bytes: int = SHARD_BYTES,
    file_bytes: int = FILE_BYTES,
) -> Archive:
    """Write one record per page and commit the manifest.

    Of pages with equal payloads of at least ``min_revisit_bytes`` the largest id is a response, the
    others revisit it. Ids are whole numbers or strings. Null html is an empty payload, a null url becomes
    ``urn:page:ID``. A null id is smaller than any other and gets no id header; payloads found under null
    ids only are all responses. Rows that repeat the largest id are all responses. An empty table writes an
    empty manifest; other columns are ignored. ``date`` stands in every record, so equal input gives equal
    files: ranges are cut at ids chosen by their hash, not by a random sample.

    A new archive in the folder of an old one takes its place when its manifest does.
    """
    spark = pages.sparkSession
    kind = pages.schema[page_id].dataType.simpleString()
    lowest = "" if kind == "string" else {"int": -(2**31), "bigint": -(2**63)}[kind]
    rows = pages.select(
        F.col(page_id).alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8").alias("payload"),
    ).withColumns({"digest": F.sha1("payload"), "bytes": F.octet_length("payload").cast("long")})
    known = written(rows.select("page_id", "digest", "bytes"), "payload-digests")
    groups = known.where(F.col("bytes") >= min_revisit_bytes).groupBy("digest").agg(
        F.count("*").alias("n"), F.max("page_id").alias("latest")
    )
    latest = written(groups.where(F.col("n") > 1).select("digest", "latest"), "latest")
    latest_bytes = 128 * latest.count()

    def with_revisits(table: DataFrame) -> DataFrame:
        found = lookup_join(table, latest, ["digest"], latest_bytes, ["page_id"], "left")
        refers = F.when(F.coalesce(F.col("page_id") != F.col("latest"), F.col("latest").isNotNull()), F.col("latest"))
        return found.withColumn("refers_to", refers).drop("latest")

    kept = F.when(F.col("refers_to").isNull(), F.col("bytes")).otherwise(0) + RECORD_BYTES
    stored = with_revisits(known).select("page_id", kept.alias("stored"))
    total = stored.agg(F.count("*").alias("rows"), F.sum("stored").alias("bytes")).first()
    bounds = _bounds(stored, total["bytes"] or 0, total["rows"], shard_bytes)
    records = with_revisits(rows).select(
        # A null id lies in the first range, and so does the smallest id there is.
        _range_of(bounds)(F.coalesce("page_id", F.lit(lowest).cast(kind))).cast("long").alias("shard"),
        "page_id",
        "url",
        F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"),
        "digest",
        "bytes",
        "refers_to",
    )
    # A task of its own for each range.
    ordered = records.repartitionById(len(bounds) + 1, F.col("shard").cast("int")).sortWithinPartitions(
        "shard", "page_id", "digest", "url"
    )
    files = written(ordered.mapInArrow(_write_shards(folder, date, file_bytes), MANIFEST), "archive-files")
    files.coalesce(1).write.mode("overwrite").json(f"{_uri(folder)}/manifest")
    # What attempts that did not finish have left.
    fs, root = _open(folder)
    if fs.get_file_info(f"{root}/_unfinished").type == pafs.FileType.Directory:
        fs.delete_dir(f"{root}/_unfinished")
    return open_archive(spark, folder)


def open_archive(spark: SparkSession, folder: str) -> Archive:
    """The archive in a folder; one without a committed manifest raises."""
    try:
        manifest = spark.read.schema(MANIFEST).json(f"{_uri(folder)}/manifest")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        raise ValueError(f"no committed archive at {folder}") from error
    return Archive(folder, manifest)


class _Members:
    """Uncompressed records of an archive file, read piece by piece."""

    def __init__(self, stream):
        self.stream = stream

    def __iter__(self) -> Iterator[bytes]:
        unpacker, pieces, rest = None, [], b""
        while True:
            data = rest or self.stream.read(CHUNK)
            rest = b""
            if not data:
                if unpacker is not None:
                    raise ValueError("archive ends inside a record")
                return
            unpacker = unpacker or zlib.decompressobj(31)
            pieces.append(unpacker.decompress(data))
            if unpacker.eof:
                rest = unpacker.unused_data
                yield b"".join(pieces)
                unpacker, pieces = None, []


def _parse(member: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = member.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    if len(block) != int(headers["Content-Length"]) or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("record length does not match its header")
    return headers, block


def _read_record(member: bytes, number) -> dict | None:
    headers, block = _parse(member)
    if headers["WARC-Type"] == "warcinfo":
        return None
    if headers["WARC-Block-Digest"] != _sha1(block):
        raise ValueError(f"damaged block in record {headers['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(next(v for k, _, v in (x.partition(b": ") for x in http.split(b"\r\n")) if k == b"Content-Length"))
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    response = headers["WARC-Type"] == "response"
    if response and (len(payload) != size or _sha1(payload) != f"sha1:{digest}"):
        raise ValueError(f"damaged payload in record {headers['WARC-Record-ID']}")
    ids = [headers.get(name) for name in ("X-Page-Id", "X-Refers-To-Page-Id")]
    own, refers = [None if v is None else number(v) for v in ids]
    return {
        "page_id": own,
        "payload_bytes": size,
        "payload_digest": base64.b32decode(digest).hex(),
        "record_type": headers["WARC-Type"],
        "refers_to": refers,
        "url": headers["WARC-Target-URI"],
        "payload": payload if response else None,
    }


def _read_files(folder: str, number, schema: pa.Schema):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        for batch in batches:
            for name, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if fs.get_file_info(f"{root}/{name}").size != size:
                    raise ValueError(f"{name} differs from the manifest")
                rows, held = [], 0
                with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for member in _Members(stream):
                        row = _read_record(member, number)
                        if row is not None:
                            rows.append({k: row[k] for k in schema.names})
                            held += len(member)
                        if held > 8 * CHUNK:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return task


def read_archive(archive: Archive, id_type: str = "bigint", payload: bool = True) -> DataFrame:
    """Records of the files in the manifest, one row per page; every digest and length is checked.

    Gives ``page_id, payload_bytes, payload_digest, record_type, refers_to, url`` and the ``payload`` of
    responses. Damage raises an error.
    """
    types = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    kind = types[id_type]
    fields = [("page_id", kind), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
              ("record_type", pa.string()), ("refers_to", kind), ("url", pa.string())]
    declared = RECORDS.format(id_type, id_type)
    if payload:
        fields.append(("payload", pa.binary()))
    else:
        declared = declared.removesuffix(", payload binary")
    number = str if id_type == "string" else int
    spark = archive.manifest.sparkSession
    files = archive.manifest.select("file", "bytes")
    spread = files.repartition(max(1, min(files.count(), int(spark.conf.get("spark.sql.shuffle.partitions")))), "file")
    return spread.mapInArrow(_read_files(archive.folder, number, pa.schema(fields)), declared)


def archived_pages(pages: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write ``pages`` and read the archive back: one row per page, without payloads and URLs."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    kind = pages.schema[options.get("page_id", "page_id")].dataType.simpleString()
    return read_archive(write_archive(pages, folder, **options), kind, payload=False).drop("url")
