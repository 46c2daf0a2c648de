"""Deterministic sharded WARC archives.

*Writing.* Records are range-sorted by page id and payload digest over tasks; a task writes its range in
order and rolls to a new file when the compressed size passes a limit. Every record is a gzip member of its own, with headers
and digests generated from the record. Of the records with equal payloads, that with the smallest page id
is a response and the others are revisits that refer to it.

*Committing.* A task attempt writes files under names of its own in a temporary folder and reports them
as rows. Spark keeps the rows of successful attempts only. The files in these rows are then renamed to
their final names (which depend on the data alone; the renaming can be repeated) and the list of final
files is written as the manifest. Files of lost or repeated attempts are never named by a manifest, and
are removed with the temporary folder.

*Reading.* A file of the manifest is streamed record by record; digests and lengths are checked.

A range is ``range_bytes`` of payload in that order, cut by a running sum over all records, so a rerun cuts
the same ranges, null and repeated ids are split like others, and there is no bound on their number. The
driver and the tasks get 16 bytes for each range, about 6 MB for 100 TB at 256 MB a range. Paths are opened
with Arrow's file systems (local, HDFS, S3, GCS), on executors too, so the folder must be a shared one.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.scan import SUM, Running, running
from starloom.llm.common import written
from starloom.session import scratch_path

#: Compressed bytes after which a file is closed, and payload bytes of a range: some files at usual ratios.
FILE_BYTES = 4 << 20
RANGE_BYTES = 32 << 20
#: Files renamed by one task.
RENAMES = 1 << 10
MIN_REVISIT_BYTES = 0
DATE = "2000-01-01T00:00:00Z"
LEVEL = 6

_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Stands for a null id in the order; an id of this value is sorted with the nulls.
_NULL_ID = -(1 << 63)
_FILES = "range int, seq int, temporary string, name string, records bigint, bytes bigint"
_RECORDS = "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def _header(fields: list[tuple[str, object]]) -> bytes:
    return "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None).encode()


def _record_id(page_id: int | None, digest: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}/{kind}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record. Control characters and spaces of the URL are percent-encoded; a null URL or id
    has no header."""
    digest = base32_sha1(payload)
    http = b"HTTP/1.1 200 OK\r\n" + _header([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))]) + b"\r\n"
    block = http if revisit else http + payload
    kind = "revisit" if revisit else "response"
    return b"WARC/1.1\r\n" + _header([
        ("WARC-Type", kind),
        ("WARC-Record-ID", _record_id(page_id, digest, kind)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", None if url is None else re.sub(r"[\x00-\x20\x7f-\x9f]", lambda m: urllib.parse.quote(m.group()), url)),
        ("WARC-Profile", _REVISIT if revisit else None),
        ("WARC-Refers-To", _record_id(refers_to, digest, "response") if revisit else None),
        ("WARC-Page-ID", page_id),
        ("WARC-Refers-To-Page-ID", refers_to if revisit else None),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", len(block)),
    ]) + b"\r\n" + block + b"\r\n\r\n"


def _info(name: str) -> bytes:
    block = _header([("software", "starloom"), ("format", "WARC File Format 1.1")])
    return b"WARC/1.1\r\n" + _header([
        ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"), ("WARC-Date", DATE),
        ("WARC-Filename", name), ("Content-Type", "application/warc-fields"), ("Content-Length", len(block)),
    ]) + b"\r\n" + block + b"\r\n\r\n"


class _Rolling:
    """The files of one task attempt."""

    def __init__(self, root: str, file_bytes: int):
        self.fs, self.root = _filesystem(root)
        self.limit, self.attempt, self.out, self.done = file_bytes, uuid.uuid4().hex, None, []
        self.fs.create_dir(f"{self.root}/_temporary", recursive=True)

    def open(self, range_: int, seq: int) -> None:
        self.close()
        self.range, self.seq, self.records, self.bytes = range_, seq, 0, 0
        self.name = f"range-{range_:05d}-{seq:05d}.warc.gz"
        self.temporary = f"_temporary/{self.attempt}-{self.name}"
        self.out = self.fs.open_output_stream(f"{self.root}/{self.temporary}", compression=None)  # members are packed here
        self._member(_info(self.name))

    def _member(self, data: bytes) -> None:
        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        packed = packer.compress(data) + packer.flush()
        self.out.write(packed)
        self.bytes += len(packed)

    def write(self, range_: int, data: bytes) -> None:
        if self.out is None or range_ != self.range:
            self.open(range_, 0)
        elif self.records and self.bytes >= self.limit:
            self.open(range_, self.seq + 1)
        self._member(data)
        self.records += 1

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.range, self.seq, self.temporary, self.name, self.records, self.bytes))
            self.out = None


def _bounds(pages: DataFrame, range_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """Page id and digest key of the first record of every range but the first."""
    placed = running(pages, [], ["id", "key"], {"upto": Running(SUM, F.col("size"))})
    placed = placed.select("id", "key", F.expr(f"(upto - size) div {range_bytes}").alias("range"))
    firsts = placed.filter("range > 0").groupBy("range").agg(F.min(F.struct("id", "key")).alias("first"))
    firsts = firsts.select("first.*").distinct().orderBy("id", "key").toArrow()
    return tuple(firsts[c].to_numpy().astype(np.int64) for c in ("id", "key"))


def _ranges(ids: np.ndarray, keys: np.ndarray, bounds: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The number of bounds that are not above each (id, key)."""
    low, high = (np.searchsorted(bounds[0], ids, side=side) for side in ("left", "right"))
    for at in np.unique(low[high > low]):  # an id with bounds inside its records
        mine = (low == at) & (high > low)
        end = int(high[mine][0])
        low[mine] = at + np.searchsorted(bounds[1][at:end], keys[mine], side="right")
    return low


def write_warcs(
    pages: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    min_revisit_bytes: int = MIN_REVISIT_BYTES, file_bytes: int = FILE_BYTES, range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Write a record per row below ``root`` and return the manifest: ``range, seq, name, records, bytes``.

    Payloads of fewer than ``min_revisit_bytes`` bytes are always responses. Edge cases: a null payload is
    empty. Rows that repeat id and payload follow each other; the first is the response, the others are
    revisits that refer to their own id. A null id is largest in its payload group (it is a revisit if any
    other row has the payload), sorted first in the archives, and has no id header. A very long payload is
    one record, in memory as a whole, and may pass the limit of its file. An empty table writes no file. Other
    columns are ignored.
    """
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload").cast("bigint")})
    order = {"id": F.coalesce("page_id", F.lit(_NULL_ID)), "key": F.conv(F.substring("digest", 1, 15), 16, 10).cast("bigint")}
    rows = rows.withColumns(order)
    narrow = written(rows.select("page_id", "digest", "size", *order), "warc-digests")
    groups = narrow.filter(F.col("size") >= min_revisit_bytes).groupBy("digest", "size").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    copies = narrow.join(groups.filter("n > 1"), ["digest", "size"]).filter(~F.col("page_id").eqNullSafe(F.col("first")))
    # written, so that the join below is planned with its true size
    copies = written(copies.select(F.col("page_id").alias("copy_id"), F.col("digest").alias("copy_digest"), F.col("first").alias("refers_to")).distinct(), "warc-copies")
    bounds = _bounds(narrow.select("id", "key", "size"), range_bytes)

    @F.arrow_udf("int")
    def range_of(ids: pa.Array, keys: pa.Array) -> pa.Array:
        return pa.array(_ranges(ids.to_numpy(zero_copy_only=False), keys.to_numpy(zero_copy_only=False), bounds), pa.int32())

    joined = rows.join(copies, rows["page_id"].eqNullSafe(copies["copy_id"]) & (rows["digest"] == copies["copy_digest"]), "left")
    ranged = (
        joined.select(range_of("id", "key").alias("range"), "page_id", "key", "digest", "url", "payload", "size", "refers_to", F.col("copy_digest").isNotNull().alias("revisit"))
        .repartitionById(len(bounds[0]) + 1, F.col("range")).sortWithinPartitions("range", "page_id", "key", "digest", "url").drop("key")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, before = None, None
        for batch in batches:
            files = files or _Rolling(root, file_bytes)
            for row in range(batch.num_rows):
                range_, page_id, digest, url, payload, size, refers_to, revisit = (c[row] for c in batch.columns)
                page_id, same = page_id.as_py(), (page_id.as_py(), digest.as_py())
                again = same == before and size.as_py() >= min_revisit_bytes
                before = same
                target = refers_to.as_py() if revisit.as_py() else page_id
                files.write(range_.as_py(), record(page_id, url.as_py(), payload.as_buffer().to_pybytes(), target, revisit.as_py() or again))
        if files:
            files.close()
            yield _batch(files.done, _FILES)

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _filesystem(root)
        for batch in batches:
            for old, new in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if fs.get_file_info(f"{base}/{old}").type != pafs.FileType.NotFound:  # else a lost attempt has moved it
                    fs.move(f"{base}/{old}", f"{base}/{new}")
            yield batch

    written_files = written(ranged.mapInArrow(write, _FILES), "warc-files")
    written_files = written_files.repartition(max(1, -(-written_files.count() // RENAMES)), "name")
    manifest = written(written_files.mapInArrow(rename, _FILES).drop("temporary"), "warc-manifest")
    fs, base = _filesystem(root)
    if fs.get_file_info(f"{base}/_temporary").type != pafs.FileType.NotFound:
        fs.delete_dir(f"{base}/_temporary")
    return manifest


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [x.split() for x in ddl.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """``(headers, block)`` of each record of a gzip stream; raises if a length or digest is wrong."""
    lines = io.BufferedReader(gzip.GzipFile(fileobj=stream), 1 << 20)
    while True:
        version = lines.readline()
        if not version:
            return
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {version[:40]!r}")
        headers = {}
        while (line := lines.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            headers[name] = value.strip()
        block = lines.read(int(headers["Content-Length"]))
        if len(block) != int(headers["Content-Length"]) or lines.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {headers.get('WARC-Record-ID')} is cut short")
        if headers.get("WARC-Block-Digest", (found := f"sha1:{base32_sha1(block)}")) != found:
            raise ValueError(f"record {headers.get('WARC-Record-ID')} has another digest")
        yield headers, block


def read_warcs(manifest: DataFrame, root: str, with_payload: bool = True, task_bytes: int = FILE_BYTES) -> DataFrame:
    """The records of the manifest's files: ``page_id, url, record_type, payload_bytes, payload_digest,
    refers_to, payload``. Length and digest of a response are those of the payload read; a revisit has
    them in its headers and no payload."""
    schema = T._parse_datatype_string(_RECORDS)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _filesystem(root)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with fs.open_input_file(f"{base}/{name}") as stream:
                    for headers, block in read_records(stream):
                        kind = headers["WARC-Type"]
                        if kind not in ("response", "revisit"):
                            continue
                        head, _, payload = block.partition(b"\r\n\r\n")
                        stated = int(re.search(rb"(?i)content-length: *(\d+)", head)[1])
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                        if kind == "response" and (len(payload) != stated or base32_sha1(payload) != digest):
                            raise ValueError(f"{name}: the payload of {headers['WARC-Record-ID']} has changed")
                        number = lambda k: int(headers[k]) if k in headers else None  # noqa: E731, B023
                        kept = payload if with_payload and kind == "response" else None
                        rows.append((number("WARC-Page-ID"), headers.get("WARC-Target-URI"), kind, stated, digest, number("WARC-Refers-To-Page-ID"), kept))
                        held += len(kept or b"") + 200
                        if held > 8 << 20:
                            yield _batch(rows, _RECORDS)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows, _RECORDS)

    # one row of the manifest is a whole file; a stated number of partitions is not merged
    tasks = -(-(manifest.agg(F.sum("bytes")).first()[0] or 1) // task_bytes)
    dealt = manifest.repartitionById(tasks, F.pmod(F.col("range") + F.col("seq"), F.lit(tasks)).cast("int"))
    return dealt.select("name").mapInArrow(read, schema)


def archive_root(spark: SparkSession) -> str:
    """A new folder for archives below the shared one, as a URI or absolute path."""
    return scratch_path(spark, "warc")
