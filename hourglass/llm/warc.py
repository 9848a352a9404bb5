"""WARC archives as seekable Zstandard bundles.

Method. Pages become WARC/1.1 records. Of records with equal payloads of at
least ``MIN_DEDUP`` bytes the one with the largest id is the response, others
are revisits that name it; their HTTP header still says the length. A task
writes its records into bundles: records are grouped into independent Zstandard
frames of about ``FRAME_BYTES``, and a bundle ends with a seek table (a
skippable frame with the sizes of all frames and a nine-byte footer). The index
maps each record to bundle, frame, and offset within the unpacked frame. A
reader fetches the footer and table of a bundle, then only the frames it needs.

Distribution. Digests and the choice of responses work on (id, digest, length)
rows, with partial maxima by digest, so thousands of equal pages weigh little.
Payloads are not shuffled, but for rows that repeat an id and its payload: of
these each task sends one. Bundles lie in the shared folder, under a
name that only one attempt of one task has; the index names the bundles of the
attempts that succeeded, so a repeated task leaves an orphan and no error.

Cases. Null payload: empty. A null URL writes no target URI. A null id is
written as no id, is smaller than any, and names no response of its own: equal
payloads that all lack an id stay responses. Of rows that repeat the response's
id and payload one is the response and the others revisit it.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import small, written

MIN_DEDUP = 1000
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20
LEVEL = 3
#: Fixed values of the seekable format: magic of a skippable frame and of the
#: seek table's footer.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1

INDEX = "row long, bundle string, frame int, offset long, length long"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record. A revisit has the HTTP header and no body."""
    kind = "revisit" if revisit else "response"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    head.append("Content-Type: application/http; msgtype=response")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Headers of a record, its payload, and the length its HTTP header says."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    lengths = [x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    return fields | {"payload": payload, "said": int(lengths[0].split(b":")[1])}


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """Skippable frame with (packed, unpacked) sizes of all frames."""
    body = b"".join(struct.pack("<II", *f) for f in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def _store(folder: str):
    """File system and path of a URI; Spark writes local ones ``file:/path``."""
    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = "file://" + folder[len("file:"):]
    return pafs.FileSystem.from_uri(folder)


class BundleWriter:
    def __init__(self, folder: str):
        self.fs, base = _store(folder)
        self.fs.create_dir(base, recursive=True)
        self.name = f"bundle-{uuid.uuid4().hex}.warc.zst"
        self.out = self.fs.open_output_stream(f"{base}/{self.name}", compression=None)
        self.pack = zstandard.ZstdCompressor(level=LEVEL)
        self.frames: list[tuple[int, int]] = []
        self.open: list[bytes] = []
        self.open_bytes = self.written = 0

    def add(self, data: bytes) -> tuple[int, int]:
        """Frame number and offset of the record that is added."""
        if self.open and self.open_bytes + len(data) > FRAME_BYTES:
            self.flush()
        at = len(self.frames), self.open_bytes
        self.open.append(data)
        self.open_bytes += len(data)
        return at

    def flush(self) -> None:
        if self.open:
            packed = self.pack.compress(b"".join(self.open))
            self.out.write(packed)
            self.frames.append((len(packed), self.open_bytes))
            self.written += len(packed)
            self.open, self.open_bytes = [], 0

    def close(self) -> None:
        self.flush()
        self.out.write(seek_table(self.frames))
        self.out.close()


class BundleReader:
    """Random access to the frames of one bundle."""

    def __init__(self, folder: str, name: str):
        self.fs, base = _store(folder)
        path = f"{base}/{name}"
        size = self.fs.get_file_info(path).size
        self.file = self.fs.open_input_file(path)
        n, _, magic = struct.unpack("<IBI", self._read(size - 9, 9))
        if magic != SEEKABLE:
            raise ValueError(f"{name} has no seek table")
        sizes = struct.iter_unpack("<II", self._read(size - 9 - 8 * n, 8 * n))
        self.at, self.unpack = [], zstandard.ZstdDecompressor()
        place = 0
        for packed, plain in sizes:
            self.at.append((place, packed, plain))
            place += packed
        self.last: tuple[int, bytes] = (-1, b"")

    def _read(self, offset: int, length: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(length)

    def frame(self, number: int) -> bytes:
        if self.last[0] != number:
            place, packed, plain = self.at[number]
            self.last = number, self.unpack.decompress(self._read(place, packed), max_output_size=plain)
        return self.last[1]

    def close(self) -> None:
        self.file.close()


def digested(pages: DataFrame, page_id: str, payload: str, url: str) -> DataFrame:
    """Rows (id, url, payload, digest, n)."""
    data = F.encode(F.coalesce(F.col(payload), F.lit("")), "utf-8")
    rows = pages.select(F.col(page_id).cast("long").alias("id"), F.col(url).cast("string").alias("url"), data.alias("payload"))
    return rows.select("*", F.sha1("payload").alias("digest"), F.length("payload").cast("long").alias("n"))


def responses(rows: DataFrame, min_dedup: int = MIN_DEDUP) -> DataFrame:
    """Written table (digest, n, best, same): the response's id for payloads
    that stand on several rows, and how many rows have that id."""
    ids = rows.where(F.col("n") >= min_dedup).groupBy("digest", "n", "id").agg(F.count(F.lit(1)).alias("rows"))
    best = ids.groupBy("digest", "n").agg(F.max("id").alias("best"), F.sum("rows").alias("rows"), F.max_by("rows", "id").alias("same"))
    return written(best.where("rows > 1 and best is not null").drop("rows"), "warc-responses")


def write(pages: DataFrame, folder: str, page_id: str = "page_id", payload: str = "html", url: str = "url", min_dedup: int = MIN_DEDUP) -> DataFrame:
    """Write the archives; returns the written index: row (a number for each
    record), bundle, frame, offset, length."""
    rows = digested(pages, page_id, payload, url)
    best = responses(rows, min_dedup)
    b = small(best.withColumnsRenamed({"digest": "_digest", "n": "_n"}))
    known = rows.join(b, (F.col("digest") == F.col("_digest")) & (F.col("n") == F.col("_n")), "left").drop("_digest", "_n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            index: list[tuple] = []
            for r in batch.to_pylist():
                if out is None:
                    out = BundleWriter(folder)
                data = record(r["id"], r["url"], r["payload"], r["digest"], r["best"], r["again"])
                index.append((r["row"], out.name, *out.add(data), len(data)))
                if out.written >= BUNDLE_BYTES:
                    out.close()
                    out = None
            if index:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*index), (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()))], names=["row", "bundle", "frame", "offset", "length"])
        if out is not None:
            out.close()

    response = F.col("best").isNull() | F.col("best").eqNullSafe(F.col("id"))
    if best.where("same > 1").isEmpty():
        todo = known.withColumn("again", ~response)
    else:
        # rows equal in id and payload: the first by URL is the response. Equal
        # rows are counted, so that a payload travels once a task, and made again
        tied = F.coalesce(response & (F.col("same") > 1), F.lit(False))
        each = known.where(tied).groupBy("digest", "n", "id", "best", "url").agg(F.first("payload").alias("payload"), F.count(F.lit(1)).alias("copies"))
        least = known.where(tied).groupBy("digest", "n").agg(F.min(F.struct("url")).alias("first")).withColumnsRenamed({"digest": "_digest", "n": "_n"})
        each = each.join(least, (F.col("digest") == F.col("_digest")) & (F.col("n") == F.col("_n")))
        each = each.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        one = each.withColumn("again", ~(F.col("url").eqNullSafe(F.col("first.url")) & (F.col("copy") == 1)))
        names = ["id", "url", "payload", "digest", "n", "best", "again"]
        todo = known.where(~tied).withColumn("again", ~response).select(*names).unionByName(one.select(*names))
    todo = todo.select("id", "url", "payload", "digest", "best", "again", F.monotonically_increasing_id().alias("row"))
    return written(todo.mapInArrow(run, INDEX), "warc-index")


def read(index: DataFrame, folder: str) -> DataFrame:
    """Read every record of ``index`` back: id, url, type, refers_to, digest,
    said (length of the full payload), payload (null for a revisit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, name = None, None
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["bundle"] != name:
                    if reader:
                        reader.close()
                    reader, name = BundleReader(folder, r["bundle"]), r["bundle"]
                got = parse(reader.frame(r["frame"])[r["offset"]:r["offset"] + r["length"]])
                page = got["WARC-Record-ID"][len("<urn:page:"):-1]
                refers = got.get("WARC-Refers-To")
                revisit = got["WARC-Type"] == "revisit"
                digest = got["WARC-Payload-Digest"].removeprefix("sha1:")
                if not revisit and hashlib.sha1(got["payload"]).hexdigest() != digest:
                    raise ValueError(f"record {page} of {name} is damaged")
                out.append((int(page) if page else None, got.get("WARC-Target-URI"), got["WARC-Type"], int(refers[len("<urn:page:"):-1]) if refers else None, digest, got["said"], None if revisit else got["payload"]))
                if len(out) >= 256:
                    yield _batch(out)
                    out = []
            if out:
                yield _batch(out)
        if reader:
            reader.close()

    # a frame's records come together, so each frame is unpacked once
    n = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = index.repartition(n, "bundle", F.floor(F.col("frame") / 16)).sortWithinPartitions("bundle", "frame", "offset")
    return order.mapInArrow(run, "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
    names = ["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def round_trip(pages: DataFrame, folder: str | None = None, page_id: str = "page_id", payload: str = "html", url: str = "url") -> DataFrame:
    """Write all pages, read them back, and return what was read."""
    folder = folder or scratch_path(pages.sparkSession, "warc", uuid.uuid4().hex)
    return read(write(pages, folder, page_id, payload, url), folder)
