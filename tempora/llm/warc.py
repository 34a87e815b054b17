"""Operator 7: WARC archives with Zstandard dictionaries, written and read by Spark tasks.

An archive is a skippable frame that holds the dictionary, then one
Zstandard frame per record, compressed with it.  Each task writes archives
of about ``archive_bytes`` of payload under names of its own, and reports
them; the reported names, checkpointed, are the manifest.  A repeated task
writes new files, and only files in the manifest are read, dealt out over
tasks by their number and size.

The reader loads the dictionary from the leading skippable frame, decodes
frame by frame, and checks each record: version line, header fields, block
length, date, HTTP header, payload length and SHA-256 digest.  A damaged
archive raises an error that names it.

Equal payloads of ``min_revisit`` bytes or more are stored once: the
smallest id is a response, the others are revisits that refer to it.  Only
digests meet for that, a few bytes a page, and only of pages that share one;
payloads of revisits never leave their page.

Defined results: a null payload is empty; null urls are written as an empty
target; rows that repeat the smallest id with an equal payload are all
responses; rows with a null id are responses; an empty table writes nothing
and reads back no records.
"""

from __future__ import annotations

import hashlib
import math
import re
import struct
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tempora.session import checkpoint_dir, cut_lineage

SKIPPABLE_MAGIC = 0x184D2A5D
DICTIONARY_BYTES = 32 << 10
# payloads a dictionary is made from: the first ones of an archive
SAMPLE_ROWS, SAMPLE_BYTES = 256, 2 << 20
READ_BYTES = 1 << 20
# digests of copies that are broadcast (about 100 bytes each); beyond, parts that the pages of a digest are split in
BROADCAST_DIGESTS, SALTS = 200_000, 16
# archives that one task reads back, by their payload bytes
READ_TASK_BYTES = 128 << 20
# the date of records whose page has none
EPOCH = "1970-01-01T00:00:00Z"
_DATE = re.compile(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(?:\.\d{1,9})?Z")
READ_SCHEMA = ("archive string, page_id long, url string, record_type string, refers_to long, "
               "payload_bytes long, payload_digest string, payload binary")


class WarcError(ValueError):
    """A record or archive that does not hold what it says."""


def record(page_id, url: str, payload: bytes | None, digest: str, refers_to, size: int | None = None,
           date: str = EPOCH) -> bytes:
    """One WARC/1.1 record; a revisit keeps the HTTP header, with the ``size`` of the payload it leaves out."""
    payload = payload or b""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Content-Length: %d\r\n\r\n" % (len(payload) if size is None else size))
    block = http if refers_to is not None else http + payload
    head = [("WARC-Type", "response" if refers_to is None else "revisit"),
            ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}:{uuid.uuid4().hex}>"),
            ("WARC-Date", date),
            ("WARC-Target-URI", " ".join((url or "").split())),
            ("WARC-Payload-Digest", f"sha256:{digest}"),
            ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", str(len(block)))]
    if refers_to is not None:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _fields(raw: bytes) -> dict[str, str]:
    out = {}
    for line in raw.split(b"\r\n"):
        name, sep, value = line.partition(b":")
        if not sep:
            raise WarcError(f"header line {line[:80]!r}")
        out[name.decode().lower()] = value.strip().decode()
    return out


def _urn(value: str):
    if not value.startswith("<urn:page:") or not value.endswith(">"):
        raise WarcError(f"record id {value[:80]!r}")
    page = value[10:-1].partition(":")[0]
    return int(page) if page else None


def parse(raw: bytes) -> dict:
    """The fields of one decoded record, checked."""
    version, _, rest = raw.partition(b"\r\n")
    head, sep, body = rest.partition(b"\r\n\r\n")
    if version != b"WARC/1.1" or not sep:
        raise WarcError("no WARC/1.1 header")
    h = _fields(head)
    if not _DATE.fullmatch(h["warc-date"]):
        raise WarcError(f"date {h['warc-date'][:80]!r}")
    n = int(h["content-length"])
    if len(body) != n + 4 or body[n:] != b"\r\n\r\n":
        raise WarcError(f"block of {len(body) - 4} bytes, {n} announced")
    http, sep, payload = body[:n].partition(b"\r\n\r\n")
    status, _, http_head = http.partition(b"\r\n")
    if not sep or not status.startswith(b"HTTP/"):
        raise WarcError("no HTTP header in the block")
    size, digest, kind = int(_fields(http_head)["content-length"]), h["warc-payload-digest"], h["warc-type"]
    if not digest.startswith("sha256:"):
        raise WarcError(f"digest {digest[:80]!r}")
    digest = digest[7:]
    if kind == "response":
        if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
            raise WarcError(f"payload of {len(payload)} bytes does not match its header")
    elif kind != "revisit" or payload or "warc-refers-to" not in h:
        raise WarcError(f"record type {kind!r}")
    return {"page_id": _urn(h["warc-record-id"]), "url": h["warc-target-uri"], "record_type": kind,
            "refers_to": _urn(h["warc-refers-to"]) if kind == "revisit" else None,
            "payload_bytes": size, "payload_digest": digest,
            "payload": payload if kind == "response" else None}


def _filesystem(folder: str):
    from pyarrow import fs
    if "://" not in folder and folder.startswith("file:/"):
        folder = "file://" + folder[5:]
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)


def _dictionary(samples: list[bytes]):
    import zstandard as zstd
    try:
        return zstd.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8)
    except zstd.ZstdError:  # too few or too small samples: their bytes are the dictionary
        return zstd.ZstdCompressionDict(b"".join(samples)[:DICTIONARY_BYTES] or b"WARC/1.1\r\n",
                                        dict_type=zstd.DICT_TYPE_RAWCONTENT)


def _archive(stream, rows) -> int:
    """Write one archive from an iterator of record bytes; the number of records."""
    import itertools

    import zstandard as zstd
    first, size = [], 0
    for r in rows:
        first.append(r)
        size += len(r)
        if len(first) >= SAMPLE_ROWS or size >= SAMPLE_BYTES:
            break
    words = _dictionary(first)
    raw = words.as_bytes()
    stream.write(struct.pack("<II", SKIPPABLE_MAGIC, len(raw)) + raw)
    packer = zstd.ZstdCompressor(level=3, dict_data=words, write_content_size=True, write_checksum=True)
    n = 0
    for r in itertools.chain(first, rows):
        stream.write(packer.compress(r))
        n += 1
    return n


MANIFEST_SCHEMA = "archive string, records long, bytes long"


def write(pages: DataFrame, folder: str, archive_bytes: int = 64 << 20) -> DataFrame:
    """Write (page_id, url, payload, payload_bytes, payload_digest, refers_to) rows; the manifest (MANIFEST_SCHEMA).

    Files get a fresh name per attempt, so a task that is run again never
    touches what an earlier attempt wrote; the manifest is checkpointed.
    """
    def store(batches):
        rows = ((*x,) for b in batches for x in zip(*(c.to_pylist() for c in b.columns)))
        system, base = _filesystem(folder)
        head = next(rows, None)
        while head is not None:
            held = [0]

            def part(head=head):
                while head is not None:
                    page_id, url, payload, size, digest, refers = head
                    yield record(page_id, url, payload, digest, refers, size)
                    held[0] += len(payload or b"")
                    head = None if held[0] >= archive_bytes else next(rows, None)
            name = f"{base}/{uuid.uuid4().hex}.warc.zst"
            with system.open_output_stream(name, compression=None) as stream:
                n = _archive(stream, part())
            yield pa.RecordBatch.from_pydict({"archive": [name], "records": pa.array([n], pa.int64()),
                                              "bytes": pa.array([held[0]], pa.int64())})
            head = next(rows, None)
    system, base = _filesystem(folder)
    system.create_dir(base, recursive=True)
    return cut_lineage(pages.select("page_id", "url", "payload", "payload_bytes", "payload_digest", "refers_to")
                       .mapInArrow(store, MANIFEST_SCHEMA))


def frames(stream):
    """The decoded frames of one archive, in order."""
    import zstandard as zstd
    head = stream.read(8)
    if len(head) < 8 or struct.unpack("<I", head[:4])[0] != SKIPPABLE_MAGIC:
        raise WarcError("no leading skippable frame")
    size = struct.unpack("<I", head[4:])[0]
    raw = stream.read(size)
    if len(raw) < size:
        raise WarcError("the dictionary frame is cut short")
    unpacker = zstd.ZstdDecompressor(dict_data=zstd.ZstdCompressionDict(raw))
    data, ended = b"", False
    while True:
        if not data:
            data = stream.read(READ_BYTES)
            if not data:
                return
        one, out = unpacker.decompressobj(), []
        while not one.eof:
            if not data:
                data = stream.read(READ_BYTES)
                if not data:
                    raise WarcError("the last frame is cut short")
            out.append(one.decompress(data))
            data = one.unused_data if one.eof else b""
        yield b"".join(out)


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """All records of the archives in the manifest (READ_SCHEMA), checked."""
    names = [f.split()[0] for f in READ_SCHEMA.split(", ")]
    kinds = {"page_id": pa.int64(), "refers_to": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}

    def load(batches):
        system, _ = _filesystem(folder)
        for b in batches:
            for name, records in zip(b.column("archive").to_pylist(), b.column("records").to_pylist()):
                rows, size, n = [], 0, 0
                pack = lambda rows: pa.RecordBatch.from_arrays(
                    [pa.array([r[c] for r in rows], kinds.get(c, pa.string())) for c in names], names)
                with system.open_input_stream(name, compression=None) as stream:
                    try:
                        for raw in frames(stream):
                            rows.append({"archive": name} | parse(raw))
                            n += 1
                            size += len(raw)
                            if size >= 4 << 20:
                                yield pack(rows)
                                rows, size = [], 0
                    except (WarcError, KeyError, ValueError) as why:
                        raise WarcError(f"{name}, record {n}: {why}") from why
                if n != records:
                    raise WarcError(f"{name}: {n} records, {records} written")
                if rows:
                    yield pack(rows)
    archives, size = manifest.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    # a number of its own: adaptive execution would merge the few rows of a manifest into one task
    tasks = max(1, min(archives, max(math.ceil(size / READ_TASK_BYTES), manifest.sparkSession.sparkContext.defaultParallelism)))
    return manifest.select("archive", "records").repartition(tasks, F.xxhash64("archive")).mapInArrow(load, READ_SCHEMA)


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  min_revisit: int = 100) -> DataFrame:
    """page_id, url, payload (null: left out), payload_bytes, payload_digest, refers_to (null: a response)."""
    base = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
        F.encode(F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    base = base.withColumn("payload_digest", F.sha2("payload", 256)) \
        .withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    # digests of more than one page id, map-side combined: at most as many as there are groups of copies
    low = base.where(F.col("payload_bytes") >= min_revisit).groupBy("payload_digest") \
        .agg(F.min("page_id").alias("low"), F.max("page_id").alias("top")).where("low < top") \
        .select("payload_digest", "low")
    low = cut_lineage(low)
    refers = F.when(F.col("page_id") > F.col("low"), F.col("low"))
    out = lambda d: d.select(
        "page_id", "url", F.when(refers.isNull(), F.col("payload")).alias("payload"), "payload_bytes", "payload_digest",
        refers.alias("refers_to"))
    if low.count() <= BROADCAST_DIGESTS:
        return out(base.join(F.broadcast(low), "payload_digest", "left"))
    # too many: the keys of the copies meet, split by page within a digest; payloads join their own page by key
    keys = base.select("page_id", "payload_digest", "payload_bytes").where(
        (F.col("payload_bytes") >= min_revisit) & F.col("page_id").isNotNull()).select("page_id", "payload_digest").distinct()
    salt = F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")
    spread = low.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    known = keys.withColumn("salt", salt).join(spread, ["payload_digest", "salt"]).drop("salt")
    return out(base.join(known, ["page_id", "payload_digest"], "left"))


def round_trip(pages: DataFrame, folder: str | None = None, **columns) -> DataFrame:
    """Write the pages as archives under ``folder`` (default: the checkpoint folder) and read them back."""
    spark: SparkSession = pages.sparkSession
    folder = folder or f"{checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    return read(write(with_revisits(pages, **columns), folder), folder)
