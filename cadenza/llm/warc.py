"""WARC archives: writing, a normaliser for whole-file gzip, and reading by index.

``write_archives`` writes each partition as WARC files compressed as one gzip stream
(rolled at ``ROLL`` bytes).  ``normalise`` inflates such a stream once, whatever its
members, and writes every record as its own gzip member, with a sidecar index of
offsets.  ``read_archives`` takes the index and inflates member by member.

Files go to the shared folder through pyarrow's file systems; each attempt of a task
has names of its own, and only names that a finished task reported are read, so lost
executors and retries do no harm.  Manifests are stored tables.

NULL html is an empty payload; NULL ids and urls come back as NULL; repeated rows are
written each; an empty table makes no file; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path
from .base import rows_of, stored

ROLL = 32 << 20        # bytes of records in a file
OUT_BYTES = 8 << 20    # payload bytes of an Arrow batch that is handed back
READ = 1 << 18
LEVEL = 3
_MANIFEST = "path string, index_path string, n_records bigint, n_bytes bigint"
_ROW = "page_id string, url string, record_type string, refers_to string, payload_digest string, payload_bytes bigint, payload binary"


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


# --- records -------------------------------------------------------------------------------

def record(page_id, url, payload: bytes, refers_to=None) -> bytes:
    """One WARC record: a response with its payload, or a revisit without."""
    kind = "response" if refers_to is None else "revisit"
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe='/:?&=#+,;@!$()*~')}")
    head += [f"WARC-Payload-Digest: sha1:{payload_digest(payload)}", f"X-Payload-Length: {len(payload)}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"X-Refers-To-Page: {refers_to}"]
        payload = b""
    head.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and the block of one record."""
    end = data.index(b"\r\n\r\n")
    fields = {}
    for line in data[:end].decode("utf-8").split("\r\n")[1:]:
        k, _, v = line.partition(":")
        fields[k.strip().lower()] = v.strip()
    return fields, data[end + 4:end + 4 + int(fields["content-length"])]


class Inflater:
    """Bytes of a gzip stream of one or many members, inflated as they are asked for."""

    def __init__(self, stream):
        self.stream, self.z, self.held = stream, zlib.decompressobj(31), b""

    def more(self) -> bool:
        """Inflate another piece; False at the end."""
        while True:
            data = self.z.unused_data if self.z.eof else b""
            if self.z.eof:
                self.z = zlib.decompressobj(31)
            data = data or self.stream.read(READ)
            if not data:
                return False
            got = self.z.decompress(data)
            if got:
                self.held += got
                return True

    def records(self):
        """Record after record, whole."""
        while True:
            while (end := self.held.find(b"\r\n\r\n")) < 0:
                if not self.more():
                    if self.held.strip():
                        raise ValueError("WARC file ends inside a record")
                    return
            size = next(int(x.split(b":")[1]) for x in self.held[:end].split(b"\r\n")
                        if x.lower().startswith(b"content-length:"))
            total = end + 4 + size + 4
            if len(self.held) < total:
                parts, have = [self.held], len(self.held)
                while have < total:
                    self.held = b""
                    if not self.more():
                        raise ValueError("WARC file ends inside a record")
                    parts.append(self.held)
                    have += len(self.held)
                self.held = b"".join(parts)
            yield self.held[:total]
            self.held = self.held[total:]


def _fs(path: str):
    from pyarrow.fs import FileSystem
    return FileSystem.from_uri(path)


def _create(folder: str, name: str):
    fs, base = _fs(folder)
    fs.create_dir(base, recursive=True)
    return fs.open_output_stream(posixpath.join(base, name), compression=None)


def _manifest(rows) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[], [], [], []]
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()),
         pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())],
        names=["path", "index_path", "n_records", "n_bytes"])


# --- Spark jobs ----------------------------------------------------------------------------

def with_record_types(pages: DataFrame, least: int = 0) -> DataFrame:
    """``pages`` (page_id, url, payload) with refers_to: of payloads of at least ``least`` bytes
    that are equal, the row with the smallest page_id is the response (NULL here; rows that
    repeat that id too), the others refer to it."""
    keyed = pages.select("page_id", "url", "payload", F.sha1("payload").alias("_sha"))
    firsts = (keyed.where(F.octet_length("payload") >= least).groupBy("_sha")
              .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
              .where("_n > 1").drop("_n"))
    return (keyed.join(firsts, "_sha", "left")
            .withColumn("refers_to", F.when(F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first")),
                                            F.col("_first")))
            .drop("_sha", "_first"))


def write_archives(rows: DataFrame, folder: str, roll: int = ROLL) -> DataFrame:
    """Write rows (page_id, url, payload, refers_to) as whole-file gzip WARCs; the manifest."""

    def run(batches):
        out = z = name = None
        done, n, size = [], 0, 0

        def finish():
            out.write(z.flush())
            out.close()
            done.append((posixpath.join(folder, name), None, n, size))

        for b in batches:
            r = rows_of(b)
            for page, url, payload, refers in zip(r["page_id"], r["url"], r["payload"], r["refers_to"]):
                if out is None:
                    name, n, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out, z = _create(folder, name), zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                data = record(page, url, payload or b"", refers)
                out.write(z.compress(data))
                n, size = n + 1, size + len(data)
                if size >= roll:
                    finish()
                    out = None
        if out is not None:
            finish()
        yield _manifest(done)

    cols = [F.col("page_id").cast("string"), F.col("url"), F.col("payload"), F.col("refers_to").cast("string")]
    return stored(rows.select(*cols).mapInArrow(run, _MANIFEST), "warc-manifest")


def _spread(manifest: DataFrame) -> DataFrame:
    """A task for each few files."""
    n = manifest.count()
    return manifest.repartitionByRange(max(1, min(n, 4096)), "path")


def normalise(manifest: DataFrame, folder: str) -> DataFrame:
    """Rewrite each file with one gzip member for each record and a sidecar index; the manifest."""

    def run(batches):
        done = []
        for b in batches:
            for path in rows_of(b)["path"]:
                fs, local = _fs(path)
                name = uuid.uuid4().hex
                with fs.open_input_stream(local, compression=None) as stream, \
                        _create(folder, f"{name}.warc.gz") as out, _create(folder, f"{name}.idx") as index:
                    at = n = 0
                    for data in Inflater(stream).records():
                        z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                        member = z.compress(data) + z.flush()
                        out.write(member)
                        index.write(b"%d %d\n" % (at, len(member)))
                        at, n = at + len(member), n + 1
                done.append((posixpath.join(folder, f"{name}.warc.gz"), posixpath.join(folder, f"{name}.idx"), n, at))
        yield _manifest(done)

    return stored(_spread(manifest).mapInArrow(run, _MANIFEST), "warc-manifest")


def read_archives(manifest: DataFrame) -> DataFrame:
    """The records of normalised files: page_id, url, record_type, refers_to, payload_digest,
    payload_bytes (both of the full payload) and payload (empty for revisits).  The digest of
    a response is computed again from what was read."""

    def batch(rows):
        cols = list(zip(*rows))
        kinds = [pa.string()] * 5 + [pa.int64(), pa.binary()]
        names = [c.split(" ")[0] for c in _ROW.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    def run(batches):
        rows, held = [], 0
        for b in batches:
            r = rows_of(b)
            for path, index_path in zip(r["path"], r["index_path"]):
                fs, local = _fs(path)
                ifs, ilocal = _fs(index_path)
                with ifs.open_input_stream(ilocal) as f:
                    index = [tuple(map(int, x.split())) for x in f.read().splitlines()]
                with fs.open_input_file(local) as f:
                    for offset, length in index:
                        f.seek(offset)
                        h, payload = parse(zlib.decompress(f.read(length), 31))
                        url = h.get("warc-target-uri")
                        digest = h["warc-payload-digest"].removeprefix("sha1:")
                        if h["warc-type"] == "response" and payload_digest(payload) != digest:
                            raise ValueError(f"payload of {h['warc-record-id']} does not have its digest")
                        rows.append((h.get("x-page-id"), None if url is None else unquote(url), h["warc-type"],
                                     h.get("x-refers-to-page"), digest, int(h["x-payload-length"]), payload))
                        held += len(payload)
                        if held >= OUT_BYTES:
                            yield batch(rows)
                            rows, held = [], 0
        if rows:
            yield batch(rows)

    return _spread(manifest).mapInArrow(run, _ROW)


def roundtrip(spark: SparkSession, pages: DataFrame, least: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives, normalise them and read them back."""
    base = shared_path(spark, "warc")
    rows = with_record_types(pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload")), least)
    raw = write_archives(rows, f"{base}/monolithic")
    back = read_archives(normalise(raw, f"{base}/members"))
    kind = pages.schema["page_id"].dataType
    return (back.withColumn("page_id", F.col("page_id").cast(kind))
            .withColumn("refers_to", F.col("refers_to").cast(kind)))
