"""WARC archives of pages: written as whole-file gzip streams, normalised to a gzip member per record, read back by offset.

``write`` puts pages into archives that are one gzip stream each, the layout that general tools
produce and that cannot be read from the middle. ``normalise`` inflates every such stream once, in
pieces of bounded size, and rewrites each record as a member of its own; a sidecar file holds a line
per record with its offset and length. A record whose payload another one holds becomes a
``revisit`` on the way. ``read`` opens the normalised archives at the offsets of their sidecars and
recomputes the digests.

Archives are closed after ``ARCHIVE_BYTES`` of payload or ``ARCHIVE_RECORDS`` records, so the rows of one archive are
a bounded group; which payloads of an archive repeat is known from distinct (archive, digest) rows, of
which a payload that a third of all pages share has one per archive. File names are new in every attempt of a task
and only those that a finished task has reported are read, so lost or repeated tasks leave no trace in
the results. The folder must be one that all executors reach; it is opened by pyarrow (local mount, HDFS, object stores).

Defined results: NULL html is an empty payload; payloads under ``REVISIT_BYTES`` are always responses; of equal
payloads the record with the smallest page_id is the response, NULL ids last, rows of one id in the order of the archives;
``refers_to`` is NULL if that response has no id. NULL or odd urls are written as ``about:blank`` or percent-encoded.
An empty table gives no archives and no rows. Columns other than page_id, url and html are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostline.llm.common import SLICE_BYTES, Stages, slices
from frostline.session import new_folder

ARCHIVE_BYTES = 24_000_000
ARCHIVE_RECORDS = 20_000
REVISIT_BYTES = 100
PIECE = 1 << 18                      # bytes that one step inflates or reads
HEADER_LIMIT = 1 << 16
PRINTABLE = "".join(chr(c) for c in range(33, 127))
PAGE_OF = re.compile(r"<urn:page:(-?\d*):")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

WRITTEN = "archive string, seq int, page_id bigint, payload_digest string, payload_bytes bigint"
INDEXED = "archive string, sidecar string, records bigint"
READ = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, archive string, offset bigint, length bigint"


def _arrow(schema: str) -> pa.Schema:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in schema.split(", "))])


def record_id(page_id: int | None, archive: str, seq: int) -> str:
    """Unique, and tells the page: the archive's name is new in every attempt to write it."""
    name = archive.rsplit("/", 1)[-1].split(".")[0]
    return f"<urn:page:{'' if page_id is None else page_id}:{name}:{seq}>"


def page_of(record: str | None) -> int | None:
    found = PAGE_OF.match(record or "")
    return int(found[1]) if found and found[1] else None


def head(kind: str, length: int, fields: dict[str, str]) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", "WARC-Date: 1970-01-01T00:00:00Z", *(f"{k}: {v}" for k, v in fields.items()), f"Content-Length: {length}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode("ascii")


def http_head(length: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode("ascii")


def fields_of(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")
    pairs = (line.split(":", 1) for line in lines[1:] if ":" in line)
    return {"": lines[0]} | {name.strip().lower(): value.strip() for name, value in pairs}


class Inflated:
    """A gzip file of any number of members as one stream of bytes; holds a piece at a time."""

    def __init__(self, source):
        self.source, self.engine = source, zlib.decompressobj(31)
        self.waiting, self.ready, self.at = b"", b"", 0

    def _more(self) -> bool:
        """Another piece after those not yet read; False at the end of the file."""
        while True:
            data = self.engine.unconsumed_tail or self.engine.unused_data if self.engine.eof or self.engine.unconsumed_tail else b""
            data = data or self.source.read(PIECE)
            if self.engine.eof:
                if not data:
                    return False
                self.engine = zlib.decompressobj(31)
            if not data and not self.engine.eof:
                raise ValueError("the gzip stream ends within a member")
            piece = self.engine.decompress(data, PIECE)
            if piece:
                self.ready, self.at = self.ready[self.at:] + piece, 0
                return True

    def until(self, mark: bytes) -> bytes:
        """Bytes up to and with the mark; empty at the end of the file."""
        seen = self.at
        while (found := self.ready.find(mark, seen)) < 0:
            seen = max(0, len(self.ready) - self.at - len(mark))
            if len(self.ready) - self.at > HEADER_LIMIT:
                raise ValueError("a header without an end")
            if not self._more():
                if self.ready[self.at:]:
                    raise ValueError("the archive ends within a header")
                return b""
        start, self.at = self.at, found + len(mark)
        return self.ready[start:self.at]

    def pieces(self, count: int) -> Iterator[bytes]:
        while count:
            if self.at == len(self.ready) and not self._more():
                raise ValueError("the archive ends within a record")
            piece = self.ready[self.at:self.at + count]
            self.at += len(piece)
            count -= len(piece)
            yield piece


def _write_archives(folder: str, archive_bytes: int, archive_records: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        out = engine = archive = None
        rows: list[tuple] = []
        held = 0

        def close() -> pa.RecordBatch:
            nonlocal out, held
            out.write(engine.flush())
            out.close()
            out, held = None, 0
            batch = pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in rows], schema=schema)
            rows.clear()
            return batch

        schema = _arrow(WRITTEN)
        names = schema.names
        for batch in slices(batches, "html", SLICE_BYTES):
            for page_id, url, html in zip(*(batch.column(n).to_pylist() for n in ("page_id", "url", "html"))):
                if out is None:
                    archive = f"{root}/{uuid.uuid4().hex}.warc.gz"
                    out, engine = system.open_output_stream(archive, compression=None), zlib.compressobj(6, zlib.DEFLATED, 31)
                    note = b"software: pages to WARC\r\n"
                    out.write(engine.compress(head("warcinfo", len(note), {"WARC-Record-ID": record_id(None, archive, -1), "Content-Type": "application/warc-fields"}) + note + b"\r\n\r\n"))
                payload = (html or "").encode("utf-8")
                digest = hashlib.sha256(payload).hexdigest()
                http = http_head(len(payload))
                out.write(engine.compress(head("response", len(http) + len(payload), {
                    "WARC-Record-ID": record_id(page_id, archive, len(rows)), "WARC-Target-URI": quote(url, safe=PRINTABLE) if url else "about:blank",
                    "WARC-Payload-Digest": f"sha256:{digest}", "Content-Type": "application/http; msgtype=response"}) + http))
                out.write(engine.compress(payload))
                out.write(engine.compress(b"\r\n\r\n"))
                rows.append((archive, len(rows), page_id, digest, len(payload)))
                held += len(payload)
                if held >= archive_bytes or len(rows) >= archive_records:
                    yield close()
        if out is not None:
            yield close()

    return run


def rewrite(source, target, originals: dict[str, str]) -> Iterator[dict]:
    """Every record of ``source`` as a gzip member of ``target``; yields its entry in the sidecar.

    originals: digest -> id of the record that keeps that payload; others with it become revisits.
    """
    stream, offset = Inflated(source), 0
    while block := stream.until(b"\r\n\r\n"):
        fields = fields_of(block)
        length = int(fields["content-length"])
        kind, own = fields["warc-type"], fields["warc-record-id"]
        digest = fields.get("warc-payload-digest", "").removeprefix("sha256:")
        original = originals.get(digest) if kind == "response" else None
        engine = zlib.compressobj(6, zlib.DEFLATED, 31)
        written = 0

        def put(data: bytes, final: bool = False) -> None:
            nonlocal written
            packed = engine.compress(data) + (engine.flush() if final else b"")
            target.write(packed)
            written += len(packed)

        if kind == "response":
            http = stream.until(b"\r\n\r\n")
            if original is not None and original != own:
                kind = "revisit"
                put(head(kind, len(http), {"WARC-Record-ID": own, "WARC-Target-URI": fields["warc-target-uri"], "WARC-Payload-Digest": f"sha256:{digest}",
                                           "WARC-Profile": PROFILE, "WARC-Refers-To": original, "Content-Type": fields["content-type"]}) + http)
            else:
                put(block + http)
            check = hashlib.sha256()
            for piece in stream.pieces(length - len(http)):
                check.update(piece)
                if kind == "response":
                    put(piece)
            if digest and check.hexdigest() != digest:
                raise ValueError(f"{own}: the payload differs from its digest")
        else:
            put(block)
            for piece in stream.pieces(length):
                put(piece)
        if b"".join(stream.pieces(4)) != b"\r\n\r\n":
            raise ValueError(f"{own}: the record does not end where its length says")
        put(b"\r\n\r\n", final=True)
        yield {"id": own, "type": kind, "offset": offset, "length": written}
        offset += written


def _normalise(folder: str) -> Callable[[pa.Table], pa.Table]:
    def run(group: pa.Table) -> pa.Table:
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        archive = group.column("archive")[0].as_py()
        originals = {d: o for d, o in zip(group.column("payload_digest").to_pylist(), group.column("original").to_pylist()) if d is not None}
        target = f"{root}/{uuid.uuid4().hex}.warc.gz"
        sidecar, records = target.replace(".warc.gz", ".index.jsonl"), 0
        with (system.open_input_stream(archive, compression=None) as source, system.open_output_stream(target, compression=None) as out,
              system.open_output_stream(sidecar, compression=None) as index):
            for entry in rewrite(source, out, originals):
                index.write(json.dumps(entry).encode("ascii") + b"\n")
                records += 1
        return pa.Table.from_pylist([{"archive": target, "sidecar": sidecar, "records": records}], schema=_arrow(INDEXED))

    return run


def parse(member: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Fields of the record, fields of the HTTP head and payload of one inflated member."""
    block, rest = member.split(b"\r\n\r\n", 1)
    fields = fields_of(block)
    content = rest[:int(fields["content-length"])]
    if fields["warc-type"] not in ("response", "revisit"):
        return fields, {}, content
    http, payload = content.split(b"\r\n\r\n", 1)
    return fields, fields_of(http), payload


def _read(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def row(fields: dict, http: dict, payload: bytes, archive: str, entry: dict) -> dict:
        digest, whole = fields["warc-payload-digest"].removeprefix("sha256:"), int(http["content-length"])
        if fields["warc-type"] == "response" and (hashlib.sha256(payload).hexdigest(), len(payload)) != (digest, whole):
            raise ValueError(f"{entry['id']}: the payload read differs from what was written")
        return {"page_id": page_of(fields["warc-record-id"]), "url": fields["warc-target-uri"], "payload_bytes": whole, "payload_digest": digest,
                "record_type": fields["warc-type"], "refers_to": page_of(fields.get("warc-refers-to")), "archive": archive,
                "offset": entry["offset"], "length": entry["length"]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(folder)
        schema = _arrow(READ)
        for batch in batches:
            for archive, sidecar in zip(batch.column("archive").to_pylist(), batch.column("sidecar").to_pylist()):
                rows = []
                with system.open_input_file(archive) as data, system.open_input_stream(sidecar, compression=None) as index:
                    for entry in map(json.loads, index.read().splitlines()):
                        data.seek(entry["offset"])
                        fields, http, payload = parse(zlib.decompress(data.read(entry["length"]), 31))
                        if fields["warc-type"] in ("response", "revisit"):
                            rows.append(row(fields, http, payload, archive, entry))
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def write(pages: DataFrame, folder: str, stages: Stages, archive_bytes: int = ARCHIVE_BYTES, archive_records: int = ARCHIVE_RECORDS) -> DataFrame:
    """archive, seq, page_id, payload_digest and payload_bytes of every record in archives that are one gzip stream each."""
    texts = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return stages.write(texts.mapInArrow(_write_archives(folder, archive_bytes, archive_records), WRITTEN), "written")


def originals(written: DataFrame) -> DataFrame:
    """archive, payload_digest and original: the record that keeps a repeated payload, for every archive that holds it."""
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "archive", "seq")
    large = written.filter(F.col("payload_bytes") >= REVISIT_BYTES)
    local = large.groupBy("payload_digest", "archive").agg(F.min(order).alias("first"), F.count("*").alias("n"))
    first = local.groupBy("payload_digest").agg(F.min("first").alias("first"), F.sum("n").alias("n")).filter("n > 1")
    name = F.element_at(F.split(F.element_at(F.split("first.archive", "/"), -1), "[.]"), 1)
    own = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("first.page_id").cast("string"), F.lit("")), F.lit(":"), name, F.lit(":"), F.col("first.seq").cast("string"), F.lit(">"))
    return local.select("archive", "payload_digest").join(first.select("payload_digest", own.alias("original")), "payload_digest").select(
        "archive", "payload_digest", "original")


def normalise(written: DataFrame, folder: str, stages: Stages) -> DataFrame:
    """archive, sidecar and records of every normalised archive."""
    every = written.select("archive").distinct().select("archive", F.lit(None).cast("string").alias("payload_digest"), F.lit(None).cast("string").alias("original"))
    work = stages.write(every.unionByName(originals(written)), "archive-work")
    tasks = max(1, work.filter("payload_digest is null").count())  # few rows, much work: a task per archive, not per volume of rows
    done = work.repartition(tasks, "archive").groupBy("archive").applyInArrow(_normalise(folder), INDEXED)
    return stages.write(done, "normalised")


def read(archives: DataFrame, folder: str) -> DataFrame:
    """Every response and revisit record, found by the sidecars' offsets."""
    tasks = max(1, archives.count())
    return archives.select("archive", "sidecar").repartition(tasks, "archive").mapInArrow(_read(folder), READ)


def round_trip(pages: DataFrame, stages: Stages, **limits: int) -> DataFrame:
    """Records of the pages as read back from normalised archives; the single-stream archives are removed on the way."""
    raw, folder = new_folder(stages.spark, "warc-raw"), new_folder(stages.spark, "warc")
    written = write(pages, raw, stages, **limits)
    archives = normalise(written, folder, stages)
    stages.remove(raw)
    return read(archives, folder)
