"""Shared by the operators: stored tables, packed chunks of documents, words, window hashes."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakemart.session import scratch_path

CHUNK_BYTES = 2 << 20  # text that one task holds as arrays at a time; a longer document is alone

# ASCII blanks; everything else belongs to a word.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def importable(spark: SparkSession) -> None:
    """Let the workers find this package where the driver did, for what is broadcast as its classes.

    On a cluster without a shared folder for code, ship the package with the job instead.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    environment["PYTHONPATH"] = os.pathsep.join(dict.fromkeys([root, *filter(None, paths)]))


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The frame, written once to the shared folder and read back; the folder goes with the session.

    Cuts the lineage: a lost executor costs the running stage, not what led to the table.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def as_bytes(column: pa.Array) -> list:
    """Texts as UTF-8 bytes, None for null."""
    return column.cast(pa.large_binary()).to_pylist()


def slices(texts: list, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about the limit together, at least one text each."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def runs_of(lengths: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of at most the limit together, at least one text each."""
    ends, start = np.cumsum(lengths, dtype=np.int64), 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield start, stop
        start = stop


class Words:
    """The words of some texts in one buffer: a blank after each word, a line end after a text.

    start, stop: byte range of each word; first: index of the first word of each text, and the
    number of words at the end; room: words from this one to the end of its text.
    """

    def __init__(self, body: bytes, sizes: np.ndarray):
        self.bytes, self.buffer = body, np.frombuffer(body, np.uint8)
        stop = np.flatnonzero((self.buffer == 32) | (self.buffer == 10))
        start = np.concatenate(([0], stop[:-1] + 1)) if len(stop) else stop
        full = stop > start
        self.start, self.stop = start[full], stop[full]
        self.lines = np.concatenate(([0], np.cumsum(sizes + 1)))
        self.first = np.searchsorted(self.start, self.lines)
        counts = np.diff(self.first)
        self.room = np.repeat(self.first[1:], counts) - np.arange(len(self.start))

    @classmethod
    def of(cls, lines: list[bytes]) -> Words:
        body = b"\n".join(lines) + b"\n" if lines else b""
        return cls(body, np.fromiter(map(len, lines), np.int64, len(lines)))

    def __len__(self) -> int:
        return len(self.start)

    def line(self, i: int) -> bytes:
        return self.bytes[self.lines[i] : self.lines[i + 1] - 1]


def plain_line(text: bytes | None, lower: bool = False) -> bytes:
    """The words of a text, one blank between them."""
    if not text:
        return b""
    return b" ".join((text.translate(LOWER) if lower else text).split())


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finalizer of a known generator)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
BYTE_CODES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class RangeHash:
    """64-bit hashes of any byte ranges of a buffer, from one pass of prefix sums.

    Equal ranges have equal hashes. Unequal ones may share a hash; every use is followed by a
    check with a different, longer hash or of the text itself.
    """

    def __init__(self, buffer: np.ndarray):
        n = len(buffer)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_CODES[buffer] * powers(BASE, n), out=self.sums[1:])
        self.back = powers(INVERSE, n + 1)

    def __call__(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mixed((self.sums[stop] - self.sums[start]) * self.back[start])

    def runs(self, length: int) -> np.ndarray:
        """Hashes of all runs of so many bytes, by where they start."""
        n = len(self.sums) - length
        return mixed((self.sums[length:] - self.sums[:n]) * self.back[:n])


def slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (np.minimum or np.maximum) over each run of width values; len - width + 1 results."""
    if len(values) < width:
        return values[:0]
    done, out = 1, values
    while done < width:
        step = min(done, width - done)
        out = pick(out[: len(out) - step], out[step:])
        done += step
    return out


def covering(values: np.ndarray, width: int) -> np.ndarray:
    """For each place the largest value of the windows of this width that hold it; a window's value
    stands at its start, and there are len(values) + width - 1 places."""
    edge = np.zeros(width - 1, values.dtype)
    return slide(np.concatenate((edge, values, edge)), width, np.maximum)


def squeeze(numbers: np.ndarray) -> bytes:
    """Non-negative, mostly rising numbers below 2^31 as few bytes: gaps by byte plane, zstd."""
    gaps = np.diff(numbers.astype(np.int32), prepend=np.int32(0))
    planes = np.ascontiguousarray(gaps.astype("<i4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unsqueeze(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<i4").ravel(), dtype=np.int64)


def packed(df: DataFrame, key: str, text: str, as_words: bool, name: str) -> DataFrame:
    """Documents in chunks of about CHUNK_BYTES, stored once: (chunk, ids, sizes, body).

    body is the zstd-compressed concatenation of the texts (as_words: only their words, with one
    blank between them and a line end after each text). A stored chunk gives rows without a
    unique key an identity: chunk number and place.
    """
    id_type = df.schema[key].dataType
    docs = df.select(F.col(key).alias("id"), F.col(text).cast("string").alias("body"))
    docs = docs.select("id", "body", F.monotonically_increasing_id().alias("row"))

    def pack(batches):
        compressor = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            column = batch.column("body")
            lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
            for a, b in runs_of(lengths):
                # Only the texts of one chunk are copied out of the batch at a time.
                texts = [plain_line(x) if as_words else x or b"" for x in as_bytes(column[a:b])]
                body = b"\n".join(texts) + b"\n" if as_words else b"".join(texts)
                sizes = np.fromiter(map(len, texts), np.int64, b - a)
                del texts
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row")[a : a + 1],
                        pa.ListArray.from_arrays([0, b - a], batch.column("id")[a:b]),
                        pa.array([sizes.tobytes()], pa.binary()),
                        pa.array([compressor.compress(body)], pa.binary()),
                    ],
                    names=["chunk", "ids", "sizes", "body"],
                )

    schema = f"chunk long, ids array<{id_type.simpleString()}>, sizes binary, body binary"
    return stored(docs.mapInArrow(pack, schema), name, compression="none")


def chunk_rows(batches) -> Iterator[dict]:
    """The rows of Arrow batches, one at a time, with the body of a chunk decompressed."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            row["body"] = zstandard.ZstdDecompressor().decompress(row["body"])
            row["sizes"] = np.frombuffer(row["sizes"], np.int64)
            yield row


def with_answers(chunks: DataFrame, answers: DataFrame) -> DataFrame:
    """Each chunk with the list of blobs that were sent back to it (an empty list if none)."""
    lists = answers.groupBy("chunk").agg(F.collect_list("places").alias("answers"))
    return chunks.join(lists, "chunk", "left").withColumn(
        "answers", F.coalesce("answers", F.array().cast("array<binary>"))
    )


SENT = "bucket int, chunk long, keys binary, more binary, many binary, places binary"


def send(chunk: int, buckets: int, keys: np.ndarray, more: np.ndarray, places: np.ndarray):
    """One batch of rows, a row per bucket, for `repeated`: the windows of a chunk.

    keys, more: 64 and 32 bits of each window's hash; places: where it starts, in rising order.
    A key that the chunk holds several times travels once, marked as many; its other places
    travel without keys and come back as they are. So a hot key sends one entry per chunk.
    """
    order = np.lexsort((places, more, keys))
    k, m = keys[order], more[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (m[1:] != m[:-1])
    sizes = np.diff(np.append(np.flatnonzero(new), len(k)))
    at = order[new]
    bucket = (keys[at] >> np.uint64(40)) % np.uint64(buckets) if len(at) else keys[:0]
    by = np.lexsort((places[at], bucket))
    bounds = np.searchsorted(bucket[by], np.arange(buckets + 1, dtype=np.uint64))
    rows = []
    for b in range(buckets):
        of = by[bounds[b] : bounds[b + 1]]
        if len(of):
            rows.append(
                (
                    b,
                    chunk,
                    keys[at[of]].tobytes(),
                    more[at[of]].tobytes(),
                    np.packbits(sizes[of] > 1).tobytes(),
                    squeeze(places[at[of]]),
                )
            )
    rest = np.sort(places[order[~new]])
    if len(rest):
        rows.append((chunk % buckets, chunk, None, None, None, squeeze(rest)))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(list(column), kind)
            for column, kind in zip(
                list(zip(*rows)) or [()] * 6,
                (pa.int32(), pa.int64(), *[pa.binary()] * 4),
                strict=True,
            )
        ],
        names=["bucket", "chunk", "keys", "more", "many", "places"],
    )


def count_repeats(rows: list[dict], but_first: bool = False) -> tuple[list[int], list[bytes]]:
    """Of the rows of one bucket, as sent: chunks, and places whose hash occurs more than once.
    but_first: without the first place of each hash, by chunk and place."""
    chunks = [r["chunk"] for r in rows if r["keys"] is None]
    out = [r["places"] for r in rows if r["keys"] is None]
    rows = sorted((r for r in rows if r["keys"] is not None), key=lambda r: r["chunk"])
    if not rows:
        return chunks, out
    keys = np.concatenate([np.frombuffer(r["keys"], np.uint64) for r in rows])
    more = np.concatenate([np.frombuffer(r["more"], np.uint32) for r in rows])
    sizes = [len(r["keys"]) // 8 for r in rows]
    many = np.concatenate(
        [
            np.unpackbits(np.frombuffer(r["many"], np.uint8), count=n)
            for r, n in zip(rows, sizes, strict=True)
        ]
    )
    order = np.lexsort((more, keys))  # stable: by chunk within a hash
    k, m = keys[order], more[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (m[1:] != m[:-1])
    firsts = np.flatnonzero(new)
    total = np.add.reduceat(1 + many[order].astype(np.int64), firsts)
    again = np.repeat(total > 1, np.diff(np.append(firsts, len(k))))
    hit = np.empty(len(k), bool)
    hit[order] = again & ~new if but_first else again
    at = 0
    for r, n in zip(rows, sizes, strict=True):
        if hit[at : at + n].any():
            chunks.append(r["chunk"])
            out.append(squeeze(unsqueeze(r["places"])[hit[at : at + n]]))
        at += n
    return chunks, out


def places_table(chunks: list[int], places: list[bytes]) -> pa.Table:
    return pa.table({"chunk": pa.array(chunks, pa.int64()), "places": pa.array(places, pa.binary())})


def repeated(sent: DataFrame) -> DataFrame:
    """Of the windows sent, those whose hash occurs more than once: (chunk, places).

    One shuffle by bucket; a bucket holds an even share of all hashes.
    """

    def count(table: pa.Table) -> pa.Table:
        return places_table(*count_repeats(table.to_pylist()))

    return sent.groupBy("bucket").applyInArrow(count, "chunk long, places binary")


def numbered(df: DataFrame, order: list, name: str) -> DataFrame:
    """The frame with its rows' places, from 0, in the order of the columns; written once.

    Rows are dealt by ranges of the order, so one value may hold any share of them; each task counts
    its own rows, and what stands before it is added from one row per task.
    """
    ranged = df.repartitionByRange(shuffle_partitions(df.sparkSession), *order)
    ranged = ranged.sortWithinPartitions(*order)
    placed = stored(ranged.withColumn("in_task", F.monotonically_increasing_id()), name)
    task = F.shiftright("in_task", 33)
    sizes = placed.groupBy(task.alias("task")).agg(F.count("*").alias("n"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    # One row per task that wrote: the bound of this broadcast is the number of partitions.
    places = placed.withColumn("task", task).join(F.broadcast(offsets), "task")
    within = F.col("in_task").bitwiseAND((1 << 33) - 1)
    return places.withColumn("place", F.col("offset") + within).drop("task", "offset", "in_task")
