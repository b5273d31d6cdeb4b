"""Substring dedup: word windows that occur more than once, found level by level, and their removal.

A window of the first level is counted at anchors alone: of every run of first-level windows
inside a full window, the one with the smallest hash. Equal full windows have equal anchors, so a
full window whose anchor is unique cannot repeat. Windows repeated at one length alone are
extended to twice that length, until the full length is reached or none survives.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from lakemart.llm.common import (
    SENT,
    RangeHash,
    Words,
    chunk_rows,
    covering,
    packed,
    repeated,
    send,
    shuffle_partitions,
    slide,
    stored,
    unsqueeze,
    with_answers,
)

NO_HASH = np.uint64(2**64 - 1)
CHUNKS_PER_BUCKET = 16  # of each chunk a bucket gets its even share of the hashes


def anchors(words: Words, length: int, window: int):
    """Hashes of the first-level windows, the smallest one inside each full window, and where
    such smallest ones lie. Nothing crosses a document."""
    n = len(words)
    hashes = np.full(n, NO_HASH)
    if n >= length:
        fits = np.flatnonzero(words.room >= length)
        hashes[fits] = RangeHash(words.buffer)(words.start[fits], words.stop[fits + length - 1])
    hashes = np.where(hashes == 0, np.uint64(1), hashes)
    span = window - length + 1
    least = slide(hashes, span, np.minimum)
    least = np.where(words.room[: len(least)] >= window, least, np.uint64(0))
    if not len(least):
        return hashes, least, np.zeros(0, np.int64)
    return hashes, least, np.flatnonzero(covering(least, span) == hashes)


def levels(window: int, start: int) -> list[int]:
    """start, twice start, ..., window."""
    out = [min(start, window)]
    while out[-1] < window:
        out.append(min(2 * out[-1], window))
    return out


def repeated_windows(
    chunks: DataFrame, window: int = 35, start: int | None = None, buckets: int | None = None
) -> DataFrame:
    """Places (word numbers inside a chunk) where a window starts that also starts elsewhere.

    chunks: from `packed` with as_words. start: length of the first level, by default half the
    window. A window's identity is a 96-bit hash of its text (the first level's 64-bit hash only
    chooses candidates): at 10^12 candidates fewer than one wrong match is to be expected in 10^4
    runs.
    """
    if buckets is None:
        # As many as the text asks for, so that what meets in one task does not grow with it.
        buckets = max(2 * shuffle_partitions(chunks.sparkSession), -(-chunks.count() // CHUNKS_PER_BUCKET))
    lengths = levels(window, start or -(-window // 2))
    first = lengths[0]

    def first_level(batches):
        for row in chunk_rows(batches):
            words = Words(row["body"], row["sizes"])
            hashes, _, at = anchors(words, first, window)
            yield send(row["chunk"], buckets, hashes[at], np.zeros(len(at), np.uint32), at)

    answers = repeated(chunks.mapInArrow(first_level, SENT))

    def extend(length, from_anchors):
        def level(batches):
            for row in chunk_rows(batches):
                if not row["answers"]:
                    continue
                places = np.concatenate([unsqueeze(x) for x in row["answers"]])
                words = Words(row["body"], row["sizes"])
                if from_anchors:
                    hashes, least, _ = anchors(words, first, window)
                    at = np.flatnonzero(np.isin(least, np.unique(hashes[places])))
                else:
                    at = np.sort(places)
                view = memoryview(words.bytes)
                a, b = words.start[at].tolist(), words.stop[at + length - 1].tolist()
                digest = xxhash.xxh3_128_digest
                ids = b"".join([digest(view[i:j]) for i, j in zip(a, b, strict=True)])
                ids = np.frombuffer(ids, np.uint64).reshape(-1, 2)
                more = (ids[:, 1] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                yield send(row["chunk"], buckets, ids[:, 0], more, at)

        return level

    for i, length in enumerate(lengths[1:]):
        if i:
            answers = stored(answers, "windows")
            if answers.isEmpty():
                return answers
        asked = with_answers(chunks, answers)
        answers = repeated(asked.mapInArrow(extend(length, i == 0), SENT))
    return answers


def remove_repeats(
    docs: DataFrame,
    window: int = 35,
    start: int | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Each document without the words that a repeated window covers.

    Words are runs of anything but ASCII blanks. Returns one row per input row: key, n_words,
    n_removed, n_spans (maximal removed runs), kept (the words left, one blank between them).

    A null or empty text has no words; a text of fewer words than the window keeps all; equal
    rows are documents of their own, so their windows repeat; a null key is kept as it is; other
    columns are not looked at; an empty table gives an empty result. Every text is used whole.
    """
    chunks = packed(docs, key, text, True, "words")
    found = with_answers(chunks, repeated_windows(chunks, window, start))
    id_type = to_arrow_type(docs.schema[key].dataType)

    def cut(batches):
        for row in chunk_rows(batches):
            words = Words(row["body"], row["sizes"])
            n = len(words)
            cover = np.zeros(n + 1, np.int64)
            for blob in row["answers"]:
                at = unsqueeze(blob)
                np.add.at(cover, at, 1)
                np.add.at(cover, at + window, -1)
            gone = np.cumsum(cover[:-1]) > 0
            out = {"n_words": [], "n_removed": [], "n_spans": [], "kept": []}
            for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:], strict=True)):
                lost, line = gone[a:b], words.line(i)
                removed = int(lost.sum())
                if removed:
                    line = b" ".join(compress(line.split(b" "), ~lost))
                out["n_words"].append(int(b - a))
                out["n_removed"].append(removed)
                out["n_spans"].append(int((np.diff(lost.astype(np.int8), prepend=0) == 1).sum()))
                out["kept"].append(line)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["ids"], id_type),
                    *[pa.array(out[c], pa.int64()) for c in ("n_words", "n_removed", "n_spans")],
                    pa.array(out["kept"], pa.binary()).cast(pa.string()),
                ],
                names=[key, "n_words", "n_removed", "n_spans", "kept"],
            )

    id_sql = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {id_sql}, n_words long, n_removed long, n_spans long, kept string"
    return found.mapInArrow(cut, schema)
