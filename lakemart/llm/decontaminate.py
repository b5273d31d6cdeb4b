"""Benchmark decontamination: a prefix-filtered join of documents with item windows.

Tasks cut the items into windows, and the windows into short shingles. All shingles of a window must
occur where the window occurs, so one of them is enough to look for: the one in the fewest
documents. Documents send the places of such shingles, with the words around them, into a join with
the windows; what a match needs of room before and after the place is a bound of the join, and the
words are compared one by one in it. Items and documents meet in shuffles alone. What the tasks get
beforehand is a bitmap of fixed size that says which shingles may be wanted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakemart.llm.common import RangeHash, Words, as_bytes, slices, stored

# Bytes to one of: lower case letters, digits and non-ASCII as they are, the rest a blank.
PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)
SHINGLE = 5
BLOCK_BYTES = 2 << 20  # text that a task cuts into windows at a time
# Bits of the map of wanted shingles: 8 MB whatever the items. One that is set for another shingle
# costs a row in a shuffle, never a result.
MAP_BITS = 26
ROWS = 10_000  # of one batch of windows or places


def plain(text: bytes | None) -> bytes:
    return b" ".join(text.translate(PLAIN).split()) if text else b""


def word_lists(words: Words, low: np.ndarray, high: np.ndarray) -> pa.Array:
    """The words of each range [low, high) as a list."""
    sizes = high - low
    ends = np.concatenate(([0], np.cumsum(sizes)))
    at = np.arange(ends[-1]) - np.repeat(ends[:-1] - low, sizes)
    body = words.bytes
    flat = [body[a:b] for a, b in zip(words.start[at].tolist(), words.stop[at].tolist(), strict=True)]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.binary()))


def item_windows(items: DataFrame, key: str, text: str, window: int, block_bytes: int) -> DataFrame:
    """(item, words): every window of every item; one of fewer words than a window is one."""

    def cut(batches):
        for batch in batches:
            lines = [plain(x) for x in as_bytes(batch.column("body"))]
            for a, b in slices(lines, block_bytes):
                words = Words.of(lines[a:b])
                size = np.minimum(np.diff(words.first), window)
                of = np.repeat(np.arange(b - a), np.diff(words.first))
                at = np.flatnonzero(words.room >= size[of])
                for i in range(0, len(at), ROWS):
                    low = at[i : i + ROWS]
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("item").take(pa.array(a + of[low])),
                            word_lists(words, low, low + size[of[low]]),
                        ],
                        names=["item", "words"],
                    )

    rows = items.select(F.col(key).cast("string").alias("item"), F.col(text).cast("string").alias("body"))
    return rows.mapInArrow(cut, "item string, words array<binary>")


def shingles_of(windows: DataFrame) -> DataFrame:
    """(wid, offset, size, hash): the shingles of each window; of a shorter window, the whole."""

    def cut(batches):
        for batch in batches:
            wid = batch.column("wid").to_numpy()
            words = Words.of([b" ".join(x) for x in batch.column("words").to_pylist()])
            n = np.diff(words.first)
            of = np.repeat(np.arange(len(n)), n)
            size = np.minimum(n, SHINGLE)[of]
            at = np.flatnonzero(words.room >= size)
            of, size = of[at], size[at]
            stop = words.stop[at + size - 1] if len(at) else at
            hashes = RangeHash(words.buffer)(words.start[at], stop)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(wid[of], pa.int64()),
                    pa.array(at - words.first[of], pa.int32()),
                    pa.array(size, pa.int32()),
                    pa.array(hashes.view(np.int64), pa.int64()),
                ],
                names=["wid", "offset", "size", "hash"],
            )

    return windows.mapInArrow(cut, "wid long, offset int, size int, hash long")


class Wanted:
    """Which shingles may be wanted: their sizes, and a bit of a fixed map for each."""

    def __init__(self, shingles: DataFrame):
        self.sizes = sorted(r["size"] for r in shingles.select("size").distinct().collect())
        place = F.col("hash").bitwiseAND((1 << MAP_BITS) - 1)
        set_bits = shingles.select(
            F.shiftright(place, 6).alias("at"), F.expr("shiftleft(1L, cast(hash & 63L AS int))").alias("bit")
        )
        # At most one row for each 64 bits of the map.
        rows = set_bits.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
        self.map = np.zeros(1 << (MAP_BITS - 6), np.uint64)
        self.map[rows.column("at").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)

    def sent(self, docs: DataFrame):
        """What the tasks need, as plain values."""
        return docs.sparkSession.sparkContext.broadcast((self.sizes, self.map))


def places_of(words: Words, sizes: list[int], bits: np.ndarray):
    """Places in the text of shingles that may be wanted: (size, places, hashes)."""
    hasher = RangeHash(words.buffer)
    for size in sizes:
        at = np.flatnonzero(words.room >= size)
        hashes = hasher(words.start[at], words.stop[at + size - 1])
        bit = hashes & np.uint64((1 << MAP_BITS) - 1)
        hit = (bits[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) != 0
        yield size, at[hit], hashes[hit]


def document_counts(docs: DataFrame, wanted: Wanted) -> DataFrame:
    """(hash, n): the documents that have each shingle that may be wanted."""
    sent = wanted.sent(docs)

    def count(batches):
        sizes, bits = sent.value
        for batch in batches:
            lines = [plain(x) for x in as_bytes(batch.column("body"))]
            total = [np.zeros(0, np.uint64)]
            for a, b in slices(lines):
                words = Words.of(lines[a:b])
                for _, at, hashes in places_of(words, sizes, bits):
                    of = np.searchsorted(words.first, at, "right") - 1
                    total.append(np.unique(np.stack((hashes, of.astype(np.uint64)), 1), axis=0)[:, 0])
            hashes, n = np.unique(np.concatenate(total), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes.view(np.int64)), pa.array(n, pa.int64())], names=["hash", "n"]
            )

    return docs.select("body").mapInArrow(count, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


def candidates(docs: DataFrame, wanted: Wanted, window: int) -> DataFrame:
    """(digest, place, hash, before, context): places of shingles that may be wanted, with the words
    around them that a window may reach, `before` of them standing before the place."""
    sent = wanted.sent(docs)

    def search(batches):
        sizes, bits = sent.value
        for batch in batches:
            lines = [plain(x) for x in as_bytes(batch.column("body"))]
            for a, b in slices(lines):
                words = Words.of(lines[a:b])
                for size, places, hashes in places_of(words, sizes, bits):
                    reach = window if size == SHINGLE else size
                    for i in range(0, len(places), ROWS):
                        at = places[i : i + ROWS]
                        of = np.searchsorted(words.first, at, "right") - 1
                        low = np.maximum(words.first[of], at - (reach - size))
                        high = np.minimum(words.first[of + 1], at + reach)
                        yield pa.RecordBatch.from_arrays(
                            [
                                batch.column("digest").take(pa.array(a + of)),
                                pa.array(at - words.first[of], pa.int64()),
                                pa.array(hashes[i : i + ROWS].view(np.int64), pa.int64()),
                                pa.array(at - low, pa.int32()),
                                word_lists(words, low, high),
                            ],
                            names=["digest", "place", "hash", "before", "context"],
                        )

    schema = "digest binary, place long, hash long, before int, context array<binary>"
    return docs.select("digest", "body").mapInArrow(search, schema)


def digest_of(text):
    """128 bits that stand for a text; null for null."""
    return F.unhex(F.md5(text.cast("string").cast("binary")))


def matches(
    docs: DataFrame, items: DataFrame, window: int, text: str, item_key: str, item_text: str, block_bytes: int
) -> tuple[DataFrame, DataFrame]:
    """Occurrences (digest of the text, begin, n, wid), and the items (wid, item) of each window."""
    bodies = docs.select(digest_of(F.col(text)).alias("digest"), F.col(text).cast("string").alias("body"))
    cut = stored(item_windows(items, item_key, item_text, window, block_bytes), "item_windows")
    distinct = cut.select("words").distinct()
    windows = stored(distinct.select(F.monotonically_increasing_id().alias("wid"), "words"), "windows")
    owners = cut.where("item IS NOT NULL").join(windows, "words").select("wid", "item").distinct()

    shingles = shingles_of(windows)
    counts = document_counts(bodies, Wanted(shingles))
    counted = shingles.join(counts, "hash", "left").select(
        "wid", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "size", "hash").alias("s")
    )
    # A window with a shingle that no document has occurs nowhere.
    rarest = counted.groupBy("wid").agg(F.min("s").alias("s")).where("s.n > 0").select("wid", "s.*")
    rarest = stored(rarest.join(windows, "wid"), "rarest")

    found = candidates(bodies, Wanted(rarest), window).alias("c")
    begin = F.col("before") - F.col("offset")
    n = F.size("words")
    there = F.slice("context", F.greatest(begin + 1, F.lit(1)), n) == F.col("words")
    fits = (begin >= 0) & (F.size("context") - begin >= n) & there
    pairs = found.join(rarest.alias("r"), (F.col("c.hash") == F.col("r.hash")) & fits)
    hits = pairs.select("digest", (F.col("place") - F.col("offset")).alias("begin"), n.alias("n"), "wid")
    return stored(hits, "hits"), owners


def hit_words(hits: DataFrame) -> DataFrame:
    """(digest, n_hit): the words of each text that occurrences cover, each counted once."""
    spans = hits.groupBy("digest", "begin").agg(F.max("n").alias("n"))
    before = Window.partitionBy("digest").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    stop = F.col("begin") + F.col("n")
    covered = F.coalesce(F.max(stop).over(before), F.lit(0))
    new = F.greatest(stop - F.greatest("begin", covered), F.lit(0))
    return spans.select("digest", new.alias("new")).groupBy("digest").agg(F.sum("new").alias("n_hit"))


def word_counts(docs: DataFrame) -> DataFrame:
    """(id, digest, n_words) of documents with a body."""
    schema = docs.drop("body").withColumn("n_words", F.lit(0).cast("long")).schema

    def count(batches):
        for batch in batches:
            n = [len(x.translate(PLAIN).split()) if x else 0 for x in as_bytes(batch.column("body"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("digest"), pa.array(n, pa.int64())],
                names=["id", "digest", "n_words"],
            )

    return docs.mapInArrow(count, schema)


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per input row: key, n_words, n_hit, items (the ids of items with an occurring window,
    sorted as strings, each once), contaminated.

    A word is a run of ASCII letters, digits and any non-ASCII characters, lower-cased in A-Z; hit
    if an occurrence of any window covers it. Items of fewer words than the window are one window;
    items without words, or null, have none; an item without an id hits words but is not listed.
    Null texts have no words; rows with equal texts get equal results, which texts are by 128 bits
    of a digest; keys may be null. No items: nothing is hit. Any number and length of items is
    handled: they stay in tables. block_bytes: item text that a task cuts into windows at a time.
    """
    hits, owners = matches(docs, items, window, text, item_key, item_text, block_bytes)
    listed = hits.select("digest", "wid").distinct().join(owners, "wid")
    listed = listed.groupBy("digest").agg(F.sort_array(F.collect_set("item")).alias("items"))
    found = hit_words(hits).join(listed, "digest", "left")
    rows = docs.select(
        F.col(key).alias("id"), digest_of(F.col(text)).alias("digest"), F.col(text).cast("string").alias("body")
    )
    out = word_counts(rows).join(found, "digest", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select(
        F.col("id").alias(key),
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        (n_hit > 0).alias("contaminated"),
    )


def uncontaminated(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of docs that no window occurs in, all columns."""
    hits, _ = matches(docs, items, window, text, item_key, item_text, block_bytes)
    gone = hits.select(F.col("digest").alias("_digest")).distinct()
    return docs.join(gone, digest_of(docs[text]) == gone["_digest"], "left_anti")
