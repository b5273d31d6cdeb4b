"""WARC archives compressed with Zstandard: a dictionary first, then one frame per record.

Archives are written and read through Spark alone, so any store that Spark reaches will do and
its commit protocol covers lost executors. The text writer puts a separator after each value; the
separator used here is an empty skippable frame, which every decoder passes over.
"""

from __future__ import annotations

import hashlib
import struct

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.common import as_bytes
from lakemart.session import scratch_path

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME = 0xFD2FB528
SEPARATOR = "P*M\x18\0\0\0\0"  # skippable frame 0x184D2A50 of length 0
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
LEAST_REVISIT = 1000
ARCHIVE_ROWS, ARCHIVE_BYTES = 4096, 16 << 20  # an archive is closed at either
DICTIONARY_BYTES = 64 << 10
SAMPLE_ROWS, SAMPLE_BYTES = 2000, 16 << 10
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def record_id(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(urn: str | None):
    number = (urn or "")[len("<urn:page:") : -1]
    return int(number) if number else None


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One record: a response with its payload, or a revisit that names the response it repeats."""
    kind = "response" if refers_to is None else "revisit"
    block = HTTP % len(payload)
    if refers_to is None:
        block += payload
    # Control characters and blanks of a URL would end its line.
    target = "".join(c if " " < c != "\x7f" and c.isprintable() else f"%{ord(c):02X}" for c in url or "")
    head = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in head)
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Headers and block of one record; raises ValueError where form or lengths are wrong."""
    end = data.find(b"\r\n\r\n")
    lines = data[:end].split(b"\r\n")
    if end < 0 or lines[0] != VERSION:
        raise ValueError("not a WARC record")
    head = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError(f"header without a colon: {line[:80]!r}")
        head[name.decode().lower()] = value.strip().decode()
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length"} - head.keys()
    if missing:
        raise ValueError(f"headers are missing: {sorted(missing)}")
    size = int(head["content-length"])
    if len(data) != end + 4 + size + 4 or not data.endswith(b"\r\n\r\n"):
        raise ValueError("the record is not as long as its headers say")
    head["block"] = data[end + 4 : end + 4 + size]
    return head


def page(head: dict) -> dict:
    """What a record says of its page: the payload of a response is checked against its digest and
    the length that its HTTP headers give."""
    block = head["block"]
    end = block.find(b"\r\n\r\n")
    if end < 0:
        raise ValueError("no HTTP headers")
    http = dict(
        (name.lower(), value.strip())
        for name, _, value in (x.partition(b":") for x in block[:end].split(b"\r\n")[1:])
    )
    size, payload = int(http[b"content-length"]), block[end + 4 :]
    digest = head["warc-payload-digest"].removeprefix("sha1:")
    kind = head["warc-type"]
    if kind == "response":
        if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError("the payload does not fit its length or digest")
    elif kind != "revisit" or payload or "warc-refers-to" not in head:
        raise ValueError("not a response or a revisit that refers to one")
    return {
        "page_id": page_of(head["warc-record-id"]),
        "url": head.get("warc-target-uri"),
        "record_type": kind,
        "payload_bytes": size,
        "payload_digest": digest,
        "refers_to": page_of(head["warc-refers-to"]) if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
    }


def frames(data: bytes):
    """The records of an archive: the dictionary comes from the leading skippable frame, frames are
    decoded one at a time, other skippable frames are passed over."""
    view, at, decoder = memoryview(data), 0, zstandard.ZstdDecompressor()
    while at < len(view):
        if len(view) - at < 4:
            raise ValueError("the archive ends inside a frame")
        (magic,) = struct.unpack_from("<I", view, at)
        if magic in SKIPPABLE:
            if len(view) - at < 8:
                raise ValueError("the archive ends inside a frame")
            (size,) = struct.unpack_from("<I", view, at + 4)
            body = bytes(view[at + 8 : at + 8 + size])
            if len(body) != size:
                raise ValueError("the archive ends inside a frame")
            if magic == DICTIONARY_FRAME and at == 0:
                if body[:4] == struct.pack("<I", FRAME):  # the dictionary may be compressed itself
                    body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
                decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body))
            at += 8 + size
        elif magic == FRAME:
            one, out = decoder.decompressobj(), []
            while not one.eof:
                part = view[at : at + (64 << 10)]
                if not len(part):
                    raise ValueError("the archive ends inside a frame")
                out.append(one.decompress(part))
                at += len(part) - len(one.unused_data)
            yield b"".join(out)
        else:
            raise ValueError(f"no frame at byte {at}")


def dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary trained on sample records; empty where they are too few to learn from."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def linked(pages: DataFrame, key: str, text: str, least: int) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): refers_to names the row with the largest key
    among those of equal payload; null for that row itself and for payloads below `least` bytes."""
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    url = F.col("url").cast("string") if "url" in pages.columns else F.lit(None).cast("string")
    rows = pages.select(F.col(key).cast("long").alias("page_id"), url.alias("url"), body.alias("payload"))
    rows = rows.withColumn("content", F.sha2("payload", 256)).withColumn("digest", F.sha1("payload"))
    large = rows.where(F.length("payload") >= least).select("content", "page_id")
    firsts = large.groupBy("content").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    firsts = firsts.where("n > 1 and first is not null").select("content", "first")
    out = rows.join(firsts, "content", "left")
    own = F.col("page_id").eqNullSafe(F.col("first"))
    return out.select(
        "page_id", "url", "payload", "digest", F.when(~own, F.col("first")).alias("refers_to")
    )


def write(
    pages: DataFrame, path: str, key: str = "page_id", text: str = "html", least: int = LEAST_REVISIT
) -> None:
    """Archives of all rows below the path, each with the dictionary in front. A task closes an archive
    after ARCHIVE_ROWS records, or ARCHIVE_BYTES of them as compressed, and begins another: however
    few tasks there are and however large the payloads, no archive is larger by more than one record.

    The dictionary is trained on the beginnings of at most SAMPLE_ROWS rows.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    begin = F.substring(body, 1, SAMPLE_BYTES).alias("begin")
    sample = pages.select(begin).limit(SAMPLE_ROWS).toArrow().column("begin").to_pylist()
    trained = dictionary([record(0, "http://a.example/", x, "0" * 40, None) for x in sample])
    sent = pages.sparkSession.sparkContext.broadcast(trained)

    def compress(batches):
        known = zstandard.ZstdCompressionDict(sent.value) if sent.value else None
        compressor = zstandard.ZstdCompressor(level=6, dict_data=known, write_checksum=True)
        lead = struct.pack("<II", DICTIONARY_FRAME, len(sent.value)) + sent.value
        separator, frames, size = SEPARATOR.encode(), [], 0

        def archive():
            return pa.RecordBatch.from_arrays([pa.array([lead + separator.join(frames)], pa.binary())], names=["archive"])

        for batch in batches:
            payloads = as_bytes(batch.column("payload"))
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "digest", "refers_to")]
            for payload, page_id, url, digest, refers in zip(payloads, *columns, strict=True):
                frames.append(compressor.compress(record(page_id, url, payload, digest, refers)))
                size += len(frames[-1])
                if size >= ARCHIVE_BYTES or len(frames) >= ARCHIVE_ROWS:
                    yield archive()
                    frames, size = [], 0
        if frames:
            yield archive()

    context = pages.sparkSession.sparkContext
    # Few rows need few files; more tasks than this are joined, fewer stay as they are.
    tasks = max(-(-pages.count() // ARCHIVE_ROWS), context.defaultParallelism)
    rows = linked(pages, key, text, least).coalesce(tasks)
    archives = rows.mapInArrow(compress, "archive binary")
    # The cast keeps the bytes as they are, and the writer writes them as they are, a file for each.
    archives.select(F.col("archive").cast("string").alias("value")).write.option(
        "lineSep", SEPARATOR
    ).option("maxRecordsPerFile", 1).text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The pages of all archives below the path: (page_id, url, record_type, payload_bytes,
    payload_digest, refers_to, payload); a record that is not sound fails the job.

    A whole archive is in memory while it is read, which ARCHIVE_BYTES bounds.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)

    def unpack(batches):
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
        names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
        schema = pa.schema(list(zip(names, kinds, strict=True)))
        for batch in batches:
            for i in range(batch.num_rows):
                rows, size = [], 0
                for data in frames(batch.column("content")[i].as_buffer()):
                    rows.append(page(parse(data)))
                    size += len(data)
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return files.select("content").mapInArrow(
        unpack,
        "page_id long, url string, record_type string, payload_bytes long, payload_digest string,"
        " refers_to long, payload binary",
    )


def round_trip(pages: DataFrame, key: str = "page_id", text: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """Write archives of the pages to the shared folder and read them back, one row per page.

    A null payload is empty; payloads below `least` bytes are always responses; rows that share the
    largest key of a payload are all responses; a null key is smaller than any other, and where all
    keys of a payload are null each is a response; a null URL is an empty one; an empty table gives
    an empty result.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "archives")
    write(pages, path, key, text, least)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return read(spark, path)
