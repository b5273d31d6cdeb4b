"""Suffix-array dedup: byte strings that occur earlier, by longest-previous-factor arrays.

Windows of fixed length are cut into pieces that share the smallest hash of the short strings
inside them; equal windows have equal smallest hashes, so only pieces that share theirs can hold
copies. Pieces equal as a whole are settled by their digests. The others meet in one text per
bucket, whose suffix array tells, for each position, whether the longest match that begins at an
earlier (or a later) position reaches the window: the previous and next smaller positions in
suffix order. Where very many different pieces share a hash, each window goes by its digest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lakemart.llm.common import (
    SENT,
    RangeHash,
    chunk_rows,
    count_repeats,
    covering,
    packed,
    places_table,
    send,
    shuffle_partitions,
    slide,
    squeeze,
    stored,
    unsqueeze,
)

NO_HASH = np.uint64(2**64 - 1)
SYMBOLS = 7  # bytes in the first rank: nine bits each, zero past the end
BUCKET_BYTES = 1 << 20  # text of one suffix array, about
MOST_CONTEXTS = 500  # pieces of one hash in a suffix array; more are compared window by window
PIECES = "key long, c1 long, c2 long, chunk long, start int, size int, own boolean"


# The suffix array of a text made of contexts


class Suffixes:
    """Ranks of all positions by their first 7, 14, 28, ... bytes, by doubling up to `depth`.

    stop: for each position the end of its context; nothing is compared past it.
    """

    def __init__(self, text: np.ndarray, stop: np.ndarray, depth: int):
        n = len(text)
        self.text, self.stop, self.depth, self.ranks = text, stop, depth, []
        place = np.arange(n, dtype=stop.dtype)
        room = stop - place
        symbol = np.zeros(n + SYMBOLS, np.int64)
        symbol[:n] = text
        symbol[:n] += 1
        key = np.zeros(n, np.int64)
        for j in range(SYMBOLS):
            key <<= 9
            key |= np.where(room > j, symbol[j : j + n], 0)
        length = SYMBOLS
        self.ranks.append((length, ranked(key)))
        while 2 * length <= depth:
            rank = self.ranks[-1][1]
            np.multiply(rank, n + 1, out=key, dtype=np.int64)
            key[: n - length] += np.where(room[: n - length] > length, rank[length:], 0)
            length *= 2
            self.ranks.append((length, ranked(key)))

    def later(self, rank: np.ndarray, place: np.ndarray, step: int) -> np.ndarray:
        """Ranks `step` positions on, zero past the end of the context."""
        at = place + step
        inside = at < self.stop[place]
        return np.where(inside, rank[np.where(inside, at, 0)], 0).astype(np.int64)

    def order(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sorted places by the first `depth` bytes from there, ties by place; and numbers that
        are equal for places where these bytes are."""
        length, rank = self.ranks[-1]
        key = rank[places].astype(np.int64) * (len(rank) + 1)
        if length < self.depth:
            key += self.later(rank, places, self.depth - length)
        order = np.argsort(key, kind="stable")
        return places[order], key[order]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common beginning at two places, up to `depth`; -1 is no place."""
        out = np.zeros(len(a), np.int64)
        pair = (a >= 0) & (b >= 0)
        x, y = a[pair], b[pair]
        done = np.zeros(len(x), np.int64)
        for length, rank in reversed(self.ranks):
            for _ in range(2):
                inside = (x + done < self.stop[x]) & (y + done < self.stop[y])
                p, q = np.where(inside, x + done, 0), np.where(inside, y + done, 0)
                done += np.where(inside & (rank[p] == rank[q]), length, 0)
        same = np.ones(len(x), bool)
        for _ in range(SYMBOLS - 1):
            same &= (x + done < self.stop[x]) & (y + done < self.stop[y])
            p, q = np.where(same, x + done, 0), np.where(same, y + done, 0)
            same &= self.text[p] == self.text[q]
            done += same
        out[pair] = done
        return np.minimum(out, self.depth)


def ranked(keys: np.ndarray) -> np.ndarray:
    """1 for the smallest key, and so on."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(len(keys), np.int32)
    new[1:] = ordered[1:] != ordered[:-1]
    out = np.empty(len(keys), np.int32)
    out[order] = np.cumsum(new, dtype=np.int32)
    return out


def nearest_smaller(values: np.ndarray) -> np.ndarray:
    """Index of the nearest smaller value before each one, -1 if none: pointers jump over what is
    known to be larger."""
    before = np.arange(len(values)) - 1
    active = np.flatnonzero(before >= 0)
    while len(active):
        active = active[values[before[active]] > values[active]]
        before[active] = before[before[active]]
        active = active[before[active] >= 0]
    return before


def neighbours(rank: np.ndarray) -> list[np.ndarray]:
    """For each entry of a suffix order, where the previous and the next entry of smaller rank
    stand, -1 if there is none: the longest match with such an entry is at one of the two."""
    before = nearest_smaller(rank)
    after = len(rank) - 1 - nearest_smaller(rank[::-1])[::-1]
    return [before, np.where(after < len(rank), after, -1)]


def factor_arrays(suffixes: Suffixes, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Longest previous and longest next factor of each of the sorted places, up to the depth: the
    longest match that begins at a smaller, and at a larger, one of them. For users of the arrays;
    `remove_copies` asks only whether a factor reaches the depth, by `full_factors`."""
    ordered, _ = suffixes.order(places)
    out = []
    for rank in (ordered, len(suffixes.stop) - ordered):
        matches = [
            suffixes.common(ordered, np.where(x >= 0, ordered[x], -1)) for x in neighbours(rank)
        ]
        found = np.empty(len(places), np.int64)
        found[np.searchsorted(places, ordered)] = np.maximum(*matches)
        out.append(found)
    return out[0], out[1]


def full_factors(suffixes: Suffixes, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether the longest previous, and the longest next, factor of each of the sorted places
    reaches the depth: the same neighbours, compared by number instead of by length."""
    ordered, number = suffixes.order(places)
    out = []
    for rank in (ordered, len(suffixes.stop) - ordered):
        hit = np.zeros(len(places), bool)
        for x in neighbours(rank):
            hit |= (x >= 0) & (number[x] == number)
        found = np.empty(len(places), bool)
        found[np.searchsorted(places, ordered)] = hit
        out.append(found)
    return out[0], out[1]


# Pieces


def pieces_of(buffer: np.ndarray, sizes: np.ndarray, window: int, gram: int):
    """(smallest hash, start, windows, whether that hash occurs in it more than once) of each run of
    windows with the same smallest hash; nothing crosses a document."""
    n = len(buffer)
    ends = np.cumsum(sizes)
    room = np.repeat(ends, sizes) - np.arange(n)
    hashes = np.full(n, NO_HASH)
    if n >= gram:
        hashes[: n - gram + 1] = RangeHash(buffer).runs(gram)
        hashes[room < gram] = NO_HASH
    span = window - gram + 1
    least = slide(hashes, span, np.minimum)
    starts = np.flatnonzero(room[: len(least)] >= window)
    if not len(starts):
        return hashes[:0], starts, starts, np.zeros(0, bool)
    of = least[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (of[1:] != of[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    key, start, count = of[first], starts[first], np.diff(np.append(first, len(starts)))
    # Places of hashes that are the smallest of some window, and how often a piece's own is there.
    shown = np.zeros(len(least), np.uint64)
    shown[starts] = of
    at = np.flatnonzero(covering(shown, span) == hashes)
    left = np.searchsorted(at, start)
    right = np.searchsorted(at, start + count - 1 + span)
    seen = np.zeros(len(key), np.int64)
    todo = np.flatnonzero(left < right)
    step = 0
    while len(todo):
        seen[todo] += hashes[at[left[todo] + step]] == key[todo]
        step += 1
        todo = todo[(left[todo] + step < right[todo]) & (seen[todo] < 2)]
    return key, start, count, seen > 1


def cut_pieces(chunks: DataFrame, window: int, gram: int) -> DataFrame:
    def cut(batches):
        for row in chunk_rows(batches):
            buffer = np.frombuffer(row["body"], np.uint8)
            key, start, count, own = pieces_of(buffer, row["sizes"], window, gram)
            view, digest = memoryview(row["body"]), xxhash.xxh3_128_digest
            stop = (start + count - 1 + window).tolist()
            ids = b"".join([digest(view[a:b]) for a, b in zip(start.tolist(), stop, strict=True)])
            ids = np.frombuffer(ids, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key.view(np.int64)),
                    pa.array(ids[:, 0]),
                    pa.array(ids[:, 1]),
                    pa.array(np.full(len(key), row["chunk"], np.int64)),
                    pa.array(start.astype(np.int32)),
                    pa.array(count.astype(np.int32)),
                    pa.array(own),
                ],
                names=["key", "c1", "c2", "chunk", "start", "size", "own"],
            )

    return stored(chunks.mapInArrow(cut, PIECES), "pieces")


def sorted_out(pieces: DataFrame, keep_first: bool) -> DataFrame:
    """(key, chunk, start, size, gone, ask, hot): pieces whose windows all have copies (gone), and
    those that have to be compared with others of their key (ask), hot where these are many."""
    place = F.struct("chunk", "start")
    content = F.struct("c1", "c2")
    keys = pieces.groupBy("key").agg(
        F.count("*").alias("n"),
        F.min(place).alias("first"),
        (F.max("own") | (F.min(content) != F.max(content))).alias("mixed"),
    )
    # A key that occurs once, and inside its piece once, has no copies.
    keys = keys.where("n > 1 or mixed").select("key", "first", "mixed")
    shared = stored(pieces.join(keys, "key"), "shared_pieces")
    copies = F.col("first") != place if keep_first else F.lit(True)
    plain = shared.where("not mixed").select(
        "key", "chunk", "start", "size", copies.alias("gone"), F.lit(False).alias("ask"), F.lit(False).alias("hot")
    )
    mixed = shared.where("mixed").drop("first", "mixed")
    whole = mixed.groupBy("key", "c1", "c2").agg(F.count("*").alias("n"), F.min(place).alias("first"))
    per_key = whole.groupBy("key").agg((F.count("*") > MOST_CONTEXTS).alias("hot"))
    mixed = mixed.join(whole, ["key", "c1", "c2"]).join(per_key, "key")
    is_first = F.col("first") == place
    gone = ~is_first if keep_first else F.col("n") > 1
    mixed = mixed.select("key", "chunk", "start", "size", gone.alias("gone"), is_first.alias("ask"), "hot")
    return stored(plain.union(mixed), "sorted_pieces")


# Comparison


ASKED = SENT + ", key_list binary, starts binary, counts binary, text binary"
ASKED_NAMES = ["bucket", "chunk", "keys", "more", "many", "places", "key_list", "starts", "counts", "text"]


def ask(chunks: DataFrame, pieces: DataFrame, window: int, buckets: int) -> DataFrame:
    """What the pieces to be compared send to the buckets: their text, by key; those of hot keys a
    digest of each window, by digest."""
    lists = pieces.where("ask").groupBy("chunk").agg(
        F.collect_list(F.struct("key", "start", "size", "hot")).alias("asked")
    )

    def rows(batches):
        for row in chunk_rows(batches):
            asked = sorted(row["asked"], key=lambda x: x["start"])
            view = memoryview(row["body"])
            hot = [(x["start"], x["size"]) for x in asked if x["hot"]]
            if hot:
                at = np.concatenate([np.arange(a, a + n) for a, n in hot])
                digest = xxhash.xxh3_128_digest
                ids = b"".join([digest(view[i : i + window]) for i in at.tolist()])
                ids = np.frombuffer(ids, np.uint64).reshape(-1, 2)
                more = (ids[:, 1] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                sent = send(row["chunk"], buckets, ids[:, 0], more, at)
                empty = [pa.nulls(sent.num_rows, pa.binary())] * 4
                yield pa.RecordBatch.from_arrays([*sent.columns, *empty], names=ASKED_NAMES)
            by: dict[int, list] = {}
            for x in asked:
                if not x["hot"]:
                    by.setdefault((x["key"] >> 20) % buckets, []).append(x)
            compressor = zstandard.ZstdCompressor(level=1)
            for bucket, some in by.items():
                text = b"".join([view[x["start"] : x["start"] + x["size"] - 1 + window] for x in some])
                values = [
                    bucket, row["chunk"], None, None, None, None,
                    np.array([x["key"] for x in some], np.int64).tobytes(),
                    np.array([x["start"] for x in some], np.int64).tobytes(),
                    np.array([x["size"] for x in some], np.int64).tobytes(),
                    compressor.compress(text),
                ]
                kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 8]
                arrays = [pa.array([v], kind) for v, kind in zip(values, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=ASKED_NAMES)

    return chunks.join(lists, "chunk").mapInArrow(rows, ASKED)


def copies_in(rows: list[dict], window: int, keep_first: bool) -> tuple[list[int], list[bytes]]:
    """Chunks and window starts with copies, among the contexts of one bucket."""
    rows = sorted(rows, key=lambda r: r["chunk"])
    starts = [np.frombuffer(r["starts"], np.int64) for r in rows]
    counts = np.concatenate([np.frombuffer(r["counts"], np.int64) for r in rows])
    text = b"".join(zstandard.ZstdDecompressor().decompress(r["text"]) for r in rows)
    sizes = counts - 1 + window
    ends = np.cumsum(sizes)
    stop = np.repeat(ends, sizes)
    if len(stop) < 2**31:
        stop = stop.astype(np.int32)
    suffixes = Suffixes(np.frombuffer(text, np.uint8), stop, window)
    begin = ends - sizes
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    places = np.repeat(begin, counts) + within
    # Places are in order of chunk and start, so earlier in this text is earlier in the corpus.
    earlier, later = full_factors(suffixes, places)
    hit = earlier if keep_first else earlier | later
    real = np.repeat(np.concatenate(starts), counts) + within
    bounds = np.cumsum([0, *[int(np.frombuffer(r["counts"], np.int64).sum()) for r in rows]])
    out = ([], [])
    for r, a, b in zip(rows, bounds, bounds[1:], strict=False):
        if hit[a:b].any():
            out[0].append(r["chunk"])
            out[1].append(squeeze(real[a:b][hit[a:b]]))
    return out


def remove_copies(
    docs: DataFrame,
    window: int = 400,
    keep_first: bool = True,
    gram: int | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Each document without the bytes covered by a string of `window` bytes that occurs earlier
    (keep_first), or anywhere else; earlier is by order of rows and place.

    Returns one row per input row: key, n_bytes, n_removed, n_spans (maximal removed runs), kept
    (binary: a cut can fall inside a character). Strings do not cross documents and may overlap
    their copy. gram: length of the short strings whose hashes choose what is compared, a quarter
    of the window by default; it has no effect on the result.

    A null or empty text has no bytes; texts shorter than the window keep all; equal rows are
    documents of their own; a null key is kept; other columns are not looked at; an empty table
    gives an empty result. Every text is used whole.
    """
    spark = docs.sparkSession
    gram = gram or max(window // 4, 1)
    chunks = packed(docs, key, text, False, "texts")
    pieces = sorted_out(cut_pieces(chunks, window, gram), keep_first)
    total = pieces.where("ask and not hot").agg(F.sum(F.col("size") + (window - 1))).first()[0] or 0
    buckets = max(2 * shuffle_partitions(spark), -(-total // BUCKET_BYTES))

    def settle(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        contexts = [r for r in rows if r["text"] is not None]
        chunks, places = count_repeats([r for r in rows if r["text"] is None], keep_first)
        if contexts:
            more = copies_in(contexts, window, keep_first)
            chunks, places = chunks + more[0], places + more[1]
        return places_table(chunks, places)

    asked = ask(chunks, pieces, window, buckets)
    answers = asked.groupBy("bucket").applyInArrow(settle, "chunk long, places binary")
    answers = answers.groupBy("chunk").agg(F.collect_list("places").alias("answers"))
    gone = pieces.where("gone").groupBy("chunk").agg(
        F.collect_list("start").alias("starts"), F.collect_list("size").alias("counts")
    )
    found = chunks.join(answers, "chunk", "left").join(gone, "chunk", "left")
    id_type = to_arrow_type(docs.schema[key].dataType)

    def cut(batches):
        for row in chunk_rows(batches):
            body = np.frombuffer(row["body"], np.uint8)
            cover = np.zeros(len(body) + 1, np.int64)
            starts = np.array(row["starts"] or (), np.int64)
            np.add.at(cover, starts, 1)
            np.add.at(cover, starts + np.array(row["counts"] or (), np.int64) - 1 + window, -1)
            for blob in row["answers"] or ():
                at = unsqueeze(blob)
                np.add.at(cover, at, 1)
                np.add.at(cover, at + window, -1)
            lost = np.cumsum(cover[:-1]) > 0
            out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept": []}
            ends = np.cumsum(row["sizes"])
            for a, b in zip(ends - row["sizes"], ends, strict=True):
                here = lost[a:b]
                removed = int(here.sum())
                out["n_bytes"].append(int(b - a))
                out["n_removed"].append(removed)
                out["n_spans"].append(int((np.diff(here.astype(np.int8), prepend=0) == 1).sum()) if removed else 0)
                out["kept"].append(body[a:b][~here].tobytes() if removed else row["body"][a:b])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["ids"], id_type),
                    *[pa.array(out[c], pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")],
                    pa.array(out["kept"], pa.binary()),
                ],
                names=[key, "n_bytes", "n_removed", "n_spans", "kept"],
            )

    id_sql = docs.schema[key].dataType.simpleString()
    return found.mapInArrow(
        cut, f"`{key}` {id_sql}, n_bytes long, n_removed long, n_spans long, kept binary"
    )
