"""Zstandard WARC archives: a writer with duplicate-payload revisits, and a reader.

File layout: a leading skippable frame (magic 0x184D2A5D) holds the dictionary, then
comes one zstd frame for each record. The reader takes the dictionary from that frame,
walks the frames by their block headers, decodes one at a time (with or without a stated
size; other skippable frames are passed over) and checks the record's version line, headers,
lengths and whatever digests it carries. It reads records of any type and any writer; HTTP
heads are taken off where the record says that it holds HTTP, and chunked bodies joined.

Scale: equal payloads are found on (id, digest) rows, without the payloads; those move
once, by page. Each task writes its own files, rolled at ``file_bytes``, under names that
depend on its partition alone, finished under a hidden name and then moved: a task that
runs again after a lost executor replaces its own files. Reading is one task per file; a file
is one row of Spark's binary source, so it must stay under 2 GB (the writer rolls far below).
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import urllib.parse
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_path

# Fixed values of the formats.
DICT_FRAME = 0x184D2A5D
ZSTD_MAGIC = 0xFD2FB528
DICT_MAGIC = b"\x37\xa4\x30\xec"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:wardlake:page:"
WARC_DATE = "1970-01-01T00:00:00Z"      # the pages carry no date
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")

_SKIPPABLE = range(0x184D2A50, 0x184D2A60)

RECORDS = ("file string, offset long, version string, record_id string, record_type string, date string, url string, "
           "refers_to string, content_type string, headers map<string,string>, block_bytes long, http_status int, "
           "payload_bytes long, payload_digest string, payload binary, error string")
_ARROW = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("version", pa.string()), ("record_id", pa.string()),
                    ("record_type", pa.string()), ("date", pa.string()), ("url", pa.string()), ("refers_to", pa.string()),
                    ("content_type", pa.string()), ("headers", pa.map_(pa.string(), pa.string())), ("block_bytes", pa.int64()),
                    ("http_status", pa.int32()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                    ("payload", pa.binary()), ("error", pa.string())])
_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None) -> str:
    return f"<{ID_PREFIX}{'null' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record: a response, or a revisit (head only) where ``refers_to`` is set."""
    target = urllib.parse.quote(url or "about:blank", safe="%/:?#[]@!$&'()*+,;=~")
    block = _HEAD % len(payload) + (payload if refers_to is None else b"")
    head = {"WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": _record_id(page_id),
            "WARC-Date": WARC_DATE, "WARC-Target-URI": target, "WARC-Payload-Digest": f"sha1:{digest(payload)}"}
    if refers_to is not None:
        head |= {"WARC-Refers-To": _record_id(refers_to), "WARC-Profile": REVISIT_PROFILE}
    head |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in head.items())
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def train_dictionary(pages: DataFrame, pages_used: int = 256, bytes_each: int = 8192, size: int = 16384) -> bytes:
    """A dictionary from the heads of up to ``pages_used`` pages. It only sets how small
    the files get; too few samples give a dictionary of plain header text."""
    heads = pages.select(F.substring(F.col("html").cast("binary"), 1, bytes_each)).limit(pages_used).collect()
    samples = [record(i, None, bytes(r[0] or b""), None) for i, r in enumerate(heads)]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return record(0, None, b"", 0)


def mark_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, refers_to): among equal payloads of at least ``min_bytes``
    the smallest ``page_id`` answers and the others refer to it."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    keyed = rows.withColumn("sha1", F.sha1("payload"))
    thin = keyed.where(F.octet_length("payload") >= min_bytes).select("page_id", "sha1")
    first = (thin.groupBy("sha1").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select("sha1", "refers_to"))
    revisits = (thin.join(first, "sha1").where("page_id <> refers_to OR (page_id IS NULL AND refers_to IS NOT NULL)")
                .select(F.col("page_id").alias("r_id"), F.col("sha1").alias("r_sha1"), "refers_to").distinct())
    return (keyed.join(revisits, F.col("page_id").eqNullSafe(F.col("r_id")) & (F.col("sha1") == F.col("r_sha1")), "left")
            .select("page_id", "url", "payload", "refers_to", "sha1"))


def write_archives(pages: DataFrame, path: str, dictionary: bytes, min_bytes: int = 0,
                   file_bytes: int = 32 << 20) -> DataFrame:
    """Write every row of ``pages`` as a record of an archive under ``path``; returns the
    manifest (file, records, bytes), which is also kept there."""
    root = path.rstrip("/") + "/archives"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(root)
        pack = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary),
                                        write_checksum=True)
        lead = struct.pack("<II", DICT_FRAME, len(dictionary)) + dictionary
        task = TaskContext.get()
        out, files, n, size = None, [], 0, 0

        def close() -> None:
            out.close()
            name = f"part-{task.partitionId():06d}-{len(files):04d}.warc.zst"
            fs.move(f"{base}/{hidden}", f"{base}/{name}")
            files.append((name, n, size))

        for batch in batches:
            for page_id, url, payload, refers_to in zip(*(batch.column(i) for i in range(4))):
                if out is None:
                    fs.create_dir(base, recursive=True)
                    hidden = f"_part-{task.partitionId():06d}-{task.taskAttemptId()}"
                    out, n, size = fs.open_output_stream(f"{base}/{hidden}"), 0, len(lead)
                    out.write(lead)
                frame = pack.compress(record(page_id.as_py(), url.as_py(), payload.as_py(), refers_to.as_py()))
                out.write(frame)
                n, size = n + 1, size + len(frame)
                if size >= file_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        cols = list(zip(*files)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()),
                                          pa.array(cols[2], pa.int64())], ["file", "records", "bytes"])

    # a fixed order in each task: the same files again if it runs again
    marked = mark_revisits(pages, min_bytes).sortWithinPartitions("page_id", "sha1", "url")
    made = marked.select("page_id", "url", "payload", "refers_to").mapInArrow(run, "file string, records long, bytes long")
    made.write.parquet(path.rstrip("/") + "/manifest")
    return pages.sparkSession.read.schema(made.schema).parquet(path.rstrip("/") + "/manifest")


def frame_end(buf: memoryview, at: int) -> int:
    """End of the zstd frame that starts at ``at``, from its header and block headers."""
    if len(buf) < at + 5 or struct.unpack_from("<I", buf, at)[0] != ZSTD_MAGIC:
        raise ValueError("no zstd frame here")
    flags = buf[at + 4]
    single = flags >> 5 & 1
    pos = at + 5 + (1 - single) + (0, 1, 2, 4)[flags & 3] + ((single, 2, 4, 8)[flags >> 6])
    last = False
    while not last:
        if pos + 3 > len(buf):
            raise ValueError("frame is cut off")
        head = int.from_bytes(buf[pos:pos + 3], "little")
        last = bool(head & 1)
        pos += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
    pos += 4 * (flags >> 2 & 1)
    if pos > len(buf):
        raise ValueError("frame is cut off")
    return pos


def open_dictionary(buf: memoryview) -> tuple[bytes | None, int]:
    """The dictionary of the leading skippable frame, and where the records start."""
    if len(buf) < 8 or struct.unpack_from("<I", buf, 0)[0] != DICT_FRAME:
        return None, 0
    size = struct.unpack_from("<I", buf, 4)[0]
    if 8 + size > len(buf):
        raise ValueError("dictionary frame is cut off")
    raw = bytes(buf[8:8 + size])
    if raw[:4] == struct.pack("<I", ZSTD_MAGIC):        # the dictionary may itself be compressed
        raw = zstandard.ZstdDecompressor().decompress(raw)
    return raw, 8 + size


def _fields(lines: list[bytes]) -> dict[str, str]:
    """Header fields by lower-cased name; folded lines continue the one before, a repeated name the first."""
    pairs: list[list[str]] = []
    for line in lines:
        text = line.decode("utf-8", "replace")
        if text[:1] in (" ", "\t") and pairs:
            pairs[-1][1] += " " + text.strip()
            continue
        name, colon, value = text.partition(":")
        if not colon:
            raise ValueError(f"malformed header {line[:40]!r}")
        pairs.append([name.strip().lower(), value.strip()])
    out: dict[str, str] = {}
    for name, value in pairs:
        out[name] = f"{out[name]}, {value}" if name in out else value
    return out


def _digest_fits(stated: str, *bodies: bytes) -> bool:
    """Is ``stated`` (algorithm:value, value in base 32 or 16) the digest of one of ``bodies``? An
    algorithm that Python does not know is not checked."""
    algorithm, _, value = stated.partition(":")
    algorithm = algorithm.strip().lower().replace("-", "")
    if algorithm not in ("md5", "sha1", "sha256", "sha384", "sha512"):
        return True
    value = value.strip().rstrip("=")
    for body in bodies:
        raw = hashlib.new(algorithm, body).digest()
        if value.lower() == raw.hex() or value.upper() == base64.b32encode(raw).decode().rstrip("="):
            return True
    return False


def _dechunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not size or size.strip(b"0123456789abcdefABCDEF"):
            raise ValueError("malformed chunk")
        n, at = int(size, 16), end + 2
        if not n:
            return b"".join(out)
        if body[at + n:at + n + 2] != b"\r\n":
            raise ValueError("chunk is cut off")
        out.append(body[at:at + n])
        at += n + 2


def _http(block: bytes) -> tuple[int | None, dict[str, str], bytes]:
    """Status (of a response), fields and body as it was sent."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        head, found, body = block.partition(b"\n\n")
    if not found:
        head, body = block, b""
    lines = head.replace(b"\r\n", b"\n").rstrip(b"\n").split(b"\n")
    start = lines[0].split()
    status = int(start[1]) if len(start) > 1 and start[0].startswith(b"HTTP/") and start[1].isdigit() else None
    return status, _fields([x for x in lines[1:] if x.strip()]), body


def parse(data: bytes) -> dict:
    """One decoded record, checked; raises ValueError with the fault."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or not re.fullmatch(rb"WARC/1\.\d+", lines[0]):
        raise ValueError("no WARC/1 version line")
    fields = _fields(lines[1:])
    for name in REQUIRED:
        if name.lower() not in fields:
            raise ValueError(f"header {name} is missing")
    if not fields["content-length"].isdigit():
        raise ValueError("Content-Length is no number")
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"block has {len(rest) - 4} bytes, Content-Length says {length}")
    block, kind = rest[:length], fields["warc-type"].lower()
    if "warc-block-digest" in fields and not _digest_fits(fields["warc-block-digest"], block):
        raise ValueError("block does not match its digest")
    if kind == "revisit" and not {"warc-refers-to", "warc-refers-to-target-uri", "warc-payload-digest"} & set(fields):
        raise ValueError("malformed revisit")
    status, payload, size, cut = None, block, length, "warc-truncated" in fields
    if fields.get("content-type", "").lower().startswith("application/http"):
        status, http, sent = _http(block)
        payload = _dechunked(sent) if "chunked" in http.get("transfer-encoding", "").lower() and sent and not cut else sent
        size = len(payload)
        stated = {x.strip() for x in http.get("content-length", "").split(",")} - {""}
        if kind == "revisit" and not payload and len(stated) == 1 and next(iter(stated)).isdigit():
            size = int(next(iter(stated)))      # of the payload it refers to
        elif kind == "response" and stated and payload is sent and not cut and stated != {str(size)}:
            raise ValueError("payload does not match its length")
        if kind != "revisit" and not cut and not _digest_fits(fields.get("warc-payload-digest", ""), payload, sent):
            raise ValueError("payload does not match its digest")
    return {"version": lines[0].decode(), "record_id": fields["warc-record-id"], "record_type": kind, "date": fields["warc-date"],
            "url": fields.get("warc-target-uri"), "refers_to": fields.get("warc-refers-to"), "content_type": fields.get("content-type"),
            "headers": list(fields.items()), "block_bytes": length, "http_status": status, "payload_bytes": size,
            "payload_digest": fields.get("warc-payload-digest"), "payload": None if kind == "revisit" and not payload else payload,
            "error": None}


def _walk(content: bytes) -> Iterator[dict]:
    """Every record of one file; a broken record or frame gives a row with ``error``."""
    buf, blank = memoryview(content), dict.fromkeys(_ARROW.names)
    at = 0
    try:
        raw, at = open_dictionary(buf)
        unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)
        while at < len(buf):
            if len(buf) >= at + 8 and struct.unpack_from("<I", buf, at)[0] in _SKIPPABLE:
                at += 8 + struct.unpack_from("<I", buf, at + 4)[0]
                continue
            end = frame_end(buf, at)
            try:
                # a frame need not state its size
                yield blank | parse(unpack.decompressobj().decompress(buf[at:end])) | {"offset": at}
            except (ValueError, zstandard.ZstdError) as e:
                yield blank | {"error": str(e), "offset": at}
            at = end
    except (ValueError, zstandard.ZstdError) as e:      # nothing behind this point can be found
        yield blank | {"error": str(e), "offset": at}


def read_archives(spark: SparkSession, path: str, glob: str = "*.warc.zst") -> DataFrame:
    """Every record of the archives in ``path``, in columns ``RECORDS``: ids and times as written, ``headers`` by
    lower-cased name, ``payload`` (the body of HTTP, chunks joined; else the block; null for a revisit
    without one), ``payload_bytes`` (of the full payload, where a revisit states it), and ``error`` for
    a record that fails a check (the other columns but file and offset are null then)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(*batch.columns):
                rows, size = [], 0
                for row in _walk(content.as_py()):
                    rows.append(row | {"file": name.as_py()})
                    size += len(row["payload"] or b"")
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select("path", "content").mapInArrow(run, RECORDS)


def page_records(records: DataFrame) -> DataFrame:
    """Records of our own writer by page: page_id, url, record_type, refers_to (a page_id), payload_bytes,
    payload_digest (bare), payload, error."""
    def page(record_id: str):
        return F.regexp_extract(record_id, f"^<{ID_PREFIX}(.*)>$", 1).try_cast("long")
    return records.select(page("record_id").alias("page_id"), "url", "record_type", page("refers_to").alias("refers_to"), "payload_bytes",
                          F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"), "payload", "error")


def round_trip(pages: DataFrame, min_bytes: int = 0, file_bytes: int = 32 << 20) -> DataFrame:
    """Write all of ``pages`` (``page_id``, ``url``, ``html``; other columns are ignored) and
    read the archives back.

    Null html: an empty payload. Null url: ``about:blank``. Null ``page_id``: written as
    such; it answers only where all ids of its payload are null. Repeated rows: each gets a
    record of the same type. Empty table: no file, no rows.
    """
    spark, path = pages.sparkSession, shared_path(pages.sparkSession, "warc")
    made = write_archives(pages, path, train_dictionary(pages), min_bytes, file_bytes)
    if made.isEmpty():
        return page_records(spark.createDataFrame([], RECORDS))
    return page_records(read_archives(spark, path + "/archives"))
