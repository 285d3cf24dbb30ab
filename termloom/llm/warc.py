"""WARC archives in Zstandard, one frame per record, with a dictionary in the leading frame.

Layout of a ``.warc.zst`` file, as published for such archives: a skippable frame of magic
0x184D2A5D that holds the dictionary (plain, or itself compressed), then one frame per record.

``write_archives`` decides revisits over all pages (equal payloads of ``LEAST_REVISIT`` bytes or
more share one response, that of the smallest id), and every task writes its pages to archives of
at most ``ARCHIVE_BYTES``. A file is written under a name of its own attempt and listed in the
returned manifest only by the attempt that Spark accepts, so a retried task leaves no double.
``read_archives`` takes a manifest, reads the files as streams, one frame at a time, and checks each
record: header syntax, required fields, length and digest of the payload, and that nothing but a
record fills its frame.

Nulls and repeats: null html is an empty payload, a null url is left out, a null id sorts after all
others. Repeated rows are records of their own. Extra columns play no part. A damaged frame or record
raises ``ValueError`` naming file and position.
"""

from __future__ import annotations

import hashlib
import struct
import uuid

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm.common import ROW, located
from termloom.plans.joins import fits_broadcast
from termloom.plans.staging import new_path, stage

# Fixed values of the format.
SKIPPABLE = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")

LEAST_REVISIT = 100
ARCHIVE_BYTES = 64 << 20
DICTIONARY_BYTES = 32 << 10
# Pages the dictionary is trained on, and how much of each.
SAMPLE_PAGES = 500
SAMPLE_BYTES = 8 << 10
READ_BYTES = 1 << 20
LEVEL = 3

_LAST = (1 << 63) - 1


def train_dictionary(pages: DataFrame) -> bytes:
    """A dictionary from a bounded sample of pages; empty if there is too little to learn from."""
    total = pages.count()
    share = min(1.0, SAMPLE_PAGES / max(total, 1))
    chosen = pages.filter(F.col("html").isNotNull()).filter(
        F.pmod(F.xxhash64("page_id", F.length("html")), F.lit(1 << 30)) < int(share * (1 << 30)) + 1
    )
    rows = chosen.select(F.substring("html", 1, SAMPLE_BYTES)).limit(2 * SAMPLE_PAGES).collect()
    samples = [row[0].encode() for row in rows if row[0]]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def first_copies(placed: DataFrame) -> DataFrame:
    """``digest`` and ``first`` (id and place) of payloads that occur more than once."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rank = F.struct(F.coalesce("page_id", F.lit(_LAST)).alias("rank"), "page_id", *ROW)
    groups = (
        placed.filter(F.length(payload) >= LEAST_REVISIT)
        .groupBy(F.sha2(payload, 256).alias("digest"))
        .agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n"))
    )
    return groups.filter("n > 1").select("digest", "first")


def _record(page_id, url, payload: bytes, digest: str, refers_to, is_revisit, place) -> bytes:
    fields = [
        ("WARC-Type", "revisit" if is_revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{place} {digest}')}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if url:
        fields.append(("WARC-Target-URI", " ".join(url.split())))
    if is_revisit:
        fields.append(("WARC-Profile", PROFILE))
        if refers_to is not None:
            fields.append(("X-Refers-To-Page-ID", str(refers_to)))
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = head if is_revisit else head + payload
    fields.append(("Content-Type", "application/http; msgtype=response"))
    fields.append(("Content-Length", str(len(block))))
    header = b"".join(f"{name}: {value}\r\n".encode() for name, value in fields)
    return VERSION + b"\r\n" + header + b"\r\n" + block + b"\r\n\r\n"


class _Archive:
    """One file under writing, in any store that pyarrow opens by its URI."""

    def __init__(self, folder: str, dictionary: bytes):
        store, root = fs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        self.name = f"{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex}.warc.zst"
        store.create_dir(root, recursive=True)
        self.out = store.open_output_stream(f"{root}/{self.name}", compression=None)
        self.records = self.bytes = 0
        if dictionary:
            self._put(struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary)

    def _put(self, data: bytes):
        self.out.write(data)
        self.bytes += len(data)

    def add(self, frame: bytes):
        self._put(frame)
        self.records += 1


def _writer(folder: str, dictionary):
    def run(batches):
        given = dictionary.value
        known = zstandard.ZstdCompressionDict(given) if given else None
        packer = zstandard.ZstdCompressor(LEVEL, dict_data=known, write_checksum=True)
        archive, done = None, []

        def close():
            archive.out.close()
            done.append((archive.name, archive.records, archive.bytes))

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(8)]
            for page_id, url, html, digest, refers_to, is_revisit, *place in zip(*columns):
                archive = archive or _Archive(folder, given)
                payload = html.encode()
                record = _record(page_id, url, payload, digest, refers_to, is_revisit, place)
                archive.add(packer.compress(record))
                if archive.bytes >= ARCHIVE_BYTES:
                    close()
                    archive = None
        if archive:
            close()
        columns = list(zip(*done)) or [(), (), ()]
        kinds = (pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["file", "records", "bytes"]
        )

    return run


def write_archives(pages: DataFrame, folder: str | None = None) -> tuple[str, DataFrame]:
    """Write every page; the folder and the manifest (``file``, ``records``, ``bytes``)."""
    spark = pages.sparkSession
    folder = folder or new_path(spark, "warc")
    if "://" not in folder:
        folder = f"file://{folder.removeprefix('file:')}"
    placed = located(pages)
    firsts = stage(first_copies(placed), "warc-copies")
    if fits_broadcast(firsts):
        firsts = F.broadcast(firsts)
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    digest = F.sha2(html.cast("binary"), 256).alias("digest")
    rows = placed.select("page_id", F.col("url").cast("string"), html.alias("html"), *ROW, digest)
    rows = rows.join(firsts, "digest", "left")
    same = (F.col("first._file") == F.col("_file")) & (F.col("first._at") == F.col("_at"))
    is_revisit = F.coalesce(~same, F.lit(False))
    rows = rows.select(
        F.col("page_id").cast("long"),
        "url",
        "html",
        "digest",
        F.when(is_revisit, F.col("first.page_id")).alias("refers_to"),
        is_revisit.alias("revisit"),
        *ROW,
    )
    dictionary = spark.sparkContext.broadcast(train_dictionary(pages))
    manifest = rows.mapInArrow(_writer(folder, dictionary), "file string, records long, bytes long")
    return folder, stage(manifest, "warc-manifest")


def _frames(stream, name: str):
    """The dictionary (or None), then each frame's content with its position."""
    held, at = stream.read(READ_BYTES), 0
    given = None
    if len(held) >= 8 and struct.unpack_from("<I", held)[0] == SKIPPABLE:
        size = struct.unpack_from("<I", held, 4)[0]
        while len(held) < 8 + size:
            more = stream.read(READ_BYTES)
            if not more:
                raise ValueError(f"{name}: dictionary frame is cut off")
            held += more
        given, held, at = held[8 : 8 + size], held[8 + size :], 8 + size
        if given.startswith(ZSTD_MAGIC):
            given = zstandard.ZstdDecompressor().decompressobj().decompress(given)
    known = zstandard.ZstdCompressionDict(given) if given else None
    opener = zstandard.ZstdDecompressor(dict_data=known)
    while True:
        held = held or stream.read(READ_BYTES)
        if not held:
            return
        frame, content, start = opener.decompressobj(), [], at
        while True:
            try:
                content.append(frame.decompress(held))
            except zstandard.ZstdError as error:
                raise ValueError(f"{name}: frame at {start}: {error}") from error
            if frame.eof:
                at += len(held) - len(frame.unused_data)
                held = frame.unused_data
                break
            at += len(held)
            held = stream.read(READ_BYTES)
            if not held:
                raise ValueError(f"{name}: frame at {start} is cut off")
        yield start, b"".join(content)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Fields, by lower-case name, and block of the one record in ``data``."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] not in (VERSION, b"WARC/1.0"):
        raise ValueError("no WARC version line")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip() or name != name.strip():
            raise ValueError(f"bad header line {line[:60]!r}")
        fields[name.decode().lower()] = value.decode().strip()
    for name in REQUIRED:
        if name not in fields:
            raise ValueError(f"no {name}")
    if not fields["content-length"].isdecimal():
        raise ValueError("bad content-length")
    size = int(fields["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"content-length {size} does not fit the frame")
    return fields, rest[:size]


def _page(fields: dict[str, str], block: bytes) -> tuple:
    """A page's columns from a checked record."""
    kind = fields["warc-type"]
    _, gap, payload = block.partition(b"\r\n\r\n")
    digest = fields.get("warc-payload-digest", "").removeprefix("sha256:")
    length = int(fields["x-payload-length"])
    if not gap or kind not in ("response", "revisit"):
        raise ValueError(f"unexpected {kind} record")
    if kind == "response" and (
        len(payload) != length or hashlib.sha256(payload).hexdigest() != digest
    ):
        raise ValueError("payload does not fit its length or digest")
    number = {k: int(fields[k]) if k in fields else None for k in ("x-page-id", "x-refers-to-page-id")}
    html = payload.decode() if kind == "response" else None
    url = fields.get("warc-target-uri")
    return number["x-page-id"], length, digest, kind, number["x-refers-to-page-id"], url, html


RECORD = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, url string, html string"
)


def _reader(folder: str, with_html: bool):
    names = [column.split()[0] for column in RECORD.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]

    def table(rows):
        columns = zip(names, kinds, zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for _, k, c in columns], names)

    def run(batches):
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for file, expected in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, held, count = [], 0, 0
                with store.open_input_stream(f"{root}/{file}", compression=None) as stream:
                    for at, data in _frames(stream, file):
                        try:
                            row = _page(*parse_record(data))
                        except ValueError as error:
                            raise ValueError(f"{file}: record at {at}: {error}") from error
                        count += 1
                        held += len(data) if with_html else 200
                        rows.append(row if with_html else (*row[:-1], None))
                        if held > READ_BYTES:
                            yield table(rows)
                            rows, held = [], 0
                if rows:
                    yield table(rows)
                if count != expected:
                    raise ValueError(f"{file}: {count} records, {expected} expected")

    return run


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame, with_html=True) -> DataFrame:
    """The records of the manifest's files, one task per few files."""
    files = manifest.select("file", "records")
    slots = spark.sparkContext.defaultParallelism
    dealt = files.repartition(max(slots, min(files.count(), 16 * slots)), "file")
    return dealt.mapInArrow(_reader(folder, with_html), RECORD)
