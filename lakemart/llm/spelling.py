"""Spelling variant grouping: sorted-list dynamic programming over the vocabulary.

In a sorted list, words that share a beginning lie side by side, and the edit matrix of a query has
the same rows for all of them as far as their common prefix reaches. The list is scanned with bands of
three cells, one row for each run of words that agree so far: a run ends where the prefix shared with
the next word is shorter. A run whose row has no cell of one edit or less is left out as a whole.

Words one edit apart agree in the first half or in the last half of the shorter one, so the list is
scanned in shares that have a half in common: once as it is, once with the words reversed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import shuffle_partitions, stored

LETTERS = r"[A-Za-zÀ-ÿ]+"
ENTRIES_PER_BUCKET = 40_000  # words of the lists that one task scans, about
MOST_OF_A_SHARE = 20_000  # a longer list is scanned in slices, each against each
QUERIES_AT_ONCE = 8192
FAR = 2  # more than one edit


def runs(text: Column, letters: str = LETTERS) -> Column:
    """The maximal runs of letters of a text, A-Z lower-cased."""
    found = F.regexp_extract_all(text, F.lit(letters), F.lit(0))
    return F.transform(found, lower_ascii)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def vocabulary(words: DataFrame, least_length: int = 5, least_count: int = 3) -> DataFrame:
    """(word, n) of the distinct words, of a frame with a row per occurrence: (word)."""
    long_enough = words.where(F.char_length("word") >= least_length)
    return long_enough.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


# The scan


class SortedList:
    """Words sorted within shares; `shared` tells how long a prefix each has in common with the one
    before it in its share, -1 at the beginning of a share."""

    def __init__(self, words: list[str], share: np.ndarray):
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        self.first = np.cumsum(self.size) - self.size
        self.code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        self.share = share
        n = len(words)
        same = np.zeros(n, bool)
        same[1:] = share[1:] == share[:-1]
        self.shared = np.where(same, 0, -1)
        left, depth = np.flatnonzero(same), 0
        while len(left):
            left = left[(self.size[left] > depth) & (self.size[left - 1] > depth)]
            left = left[self.code[self.first[left] + depth] == self.code[self.first[left - 1] + depth]]
            self.shared[left] += 1
            depth += 1

    def starts(self, depth: int) -> np.ndarray:
        """Where runs of words that agree in `depth` code points begin."""
        return np.flatnonzero((self.size >= depth) & (self.shared < depth))

    def letter(self, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The code point of a word at a place, -1 outside it."""
        inside = (at >= 0) & (at < self.size[word])
        found = self.code[np.where(inside, self.first[word] + at, 0)].astype(np.int64)
        return np.where(inside, found, -1)


def near_in_shares(words: SortedList, begin: np.ndarray, end: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    """Pairs (i, j), i < j, of words of a share one edit apart. Of each word, begin and end of its
    share, and how many code points all words of the share have in common."""
    found = [np.zeros((0, 2), np.int64)]
    for a in range(0, len(begin), QUERIES_AT_ONCE):
        waiting = np.arange(a, min(a + QUERIES_AT_ONCE, len(begin)))
        waiting = waiting[end[waiting] - begin[waiting] > 1]
        waiting = waiting[np.argsort(prefix[waiting], kind="stable")]
        low = high = query = np.zeros(0, np.int64)
        band = np.zeros((3, 0), np.int8)
        depth = 0
        while len(low) or len(waiting):
            if not len(low):
                depth = int(prefix[waiting[0]])
            # Queries come in where the prefix of their share ends: no edit yet.
            fresh = waiting[: np.searchsorted(prefix[waiting], depth, "right")]
            waiting = waiting[len(fresh) :]
            low, high = np.append(low, begin[fresh]), np.append(high, end[fresh])
            query = np.append(query, fresh)
            room = words.size[fresh] > depth
            band = np.append(band, [np.ones(len(fresh)), np.zeros(len(fresh)), np.where(room, 1, FAR)], axis=1).astype(np.int8)
            # A word that ends here is the first of its run.
            ends = words.size[low] == depth
            cell = words.size[query] - depth + 1
            hit = ends & (cell >= 0) & (cell <= 2) & (low > query)
            hit &= band[np.clip(cell, 0, 2), np.arange(len(low))] < FAR
            found.append(np.column_stack((query[hit], low[hit])))
            # Longer ones go on in runs that agree in one more code point.
            starts = words.starts(depth + 1)
            p, q = np.searchsorted(starts, low + ends), np.searchsorted(starts, high)
            n = q - p
            of = np.repeat(np.arange(len(low)), n)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + p[of]
            following = np.append(starts[1:], len(words.size))
            query, high, low = query[of], np.minimum(following[at], high[of]), starts[at]
            later = high > query + 1  # earlier words have had this one as their query's match
            of, query, high, low = of[later], query[later], high[later], low[later]
            letter = words.letter(low, np.full(len(low), depth))
            before, here, after = (words.letter(query, np.full(len(low), depth + k)) for k in (-1, 0, 1))
            old = band[:, of]
            left = np.minimum(old[0] + (letter != before), old[1] + 1)
            middle = np.minimum(np.minimum(old[1] + (letter != here), old[2] + 1), left + 1)
            right = np.minimum(old[2] + (letter != after), middle + 1)
            # Cells past the end of the query are none.
            middle = np.where(here >= 0, middle, FAR)
            right = np.where(after >= 0, right, FAR)
            left = np.where((before >= 0) | (depth == 0), left, FAR)
            band = np.minimum(np.stack((left, middle, right)), FAR).astype(np.int8)
            keep = band.min(axis=0) < FAR
            band, query, high, low = band[:, keep], query[keep], high[keep], low[keep]
            depth += 1
    return np.concatenate(found)


NEAR = "word string, n_near long, best_n long, best string"


def near_of_bucket(table: pa.Table) -> pa.Table:
    """What the shares of one bucket add for each word: how many near ones, and the most frequent."""
    table = table.sort_by([("share", "ascending"), ("scan", "ascending")])
    share = table["share"].combine_chunks().dictionary_encode().indices.to_numpy()
    bounds = np.flatnonzero(np.append(True, share[1:] != share[:-1]))
    sizes = np.diff(np.append(bounds, len(share)))
    begin, end = np.repeat(bounds, sizes), np.repeat(bounds + sizes, sizes)
    prefix = table["prefix"].to_numpy()
    words = SortedList(table["scan"].to_pylist(), share)
    i, j = near_in_shares(words, begin, end, prefix).T
    # A pair counts in one share: that of half the shorter word, reversed only where the first
    # halves differ, and in a list cut into slices where the two slices meet.
    fits = np.minimum(words.size[i], words.size[j]) // 2 == prefix[i]
    part, crossed = table["slice"].to_numpy(), table["crossed"].to_numpy(zero_copy_only=False)
    fits &= ~crossed[i] | (part[i] != part[j])
    i, j = i[fits], j[fits]
    text = table["word"].to_pylist()
    turned = table["turned"].to_numpy(zero_copy_only=False)
    halves = zip(i.tolist(), j.tolist(), prefix[i].tolist(), strict=True)
    fits = np.array([not turned[a] or text[a][:p] != text[b][:p] for a, b, p in halves], bool)
    i, j = i[fits], j[fits]
    i, j = np.concatenate((i, j)), np.concatenate((j, i))
    n = table["n"].to_numpy()
    rank = np.empty(len(text), np.int64)
    rank[pc.sort_indices(table["word"]).to_numpy()] = np.arange(len(text))
    order = np.lexsort((rank[j], -n[j], i))
    i, j = i[order], j[order]
    first = np.flatnonzero(np.append(True, i[1:] != i[:-1])) if len(i) else i
    count = np.diff(np.append(first, len(i)))
    return pa.table(
        {
            "word": pa.array([text[x] for x in i[first].tolist()], pa.string()),
            "n_near": pa.array(count, pa.int64()),
            "best_n": pa.array(n[j[first]], pa.int64()),
            "best": pa.array([text[x] for x in j[first].tolist()], pa.string()),
        }
    )


def shares(words: DataFrame) -> DataFrame:
    """The lists to scan: (share, slice, crossed, turned, prefix, scan, word, n), with each word by the
    half it may share with one as long, and with a shorter one, at either end."""
    length = F.char_length("word")
    halves = F.array_distinct(F.array(F.floor(length / 2), F.floor((length - 1) / 2)))
    turned = F.explode(F.array(F.lit(False), F.lit(True)))
    listed = words.select("word", "n", F.explode(halves).alias("prefix")).withColumn("turned", turned)
    listed = listed.withColumn("scan", F.when(F.col("turned"), F.reverse("word")).otherwise(F.col("word")))
    begin = F.col("scan").substr(F.lit(1), F.col("prefix").cast("int"))
    listed = listed.withColumn("share", F.concat(F.when(F.col("turned"), "<").otherwise(">"), begin))
    listed = listed.withColumn("share", F.concat("share", F.lit(":"), F.col("prefix").cast("string")))
    sizes = listed.groupBy("share").agg(F.count("*").alias("entries"))
    sizes = stored(sizes.where(F.col("entries") > MOST_OF_A_SHARE), "long_lists")
    parts = F.coalesce(F.ceil(F.col("entries") / MOST_OF_A_SHARE), F.lit(1))
    listed = listed.join(sizes, "share", "left").withColumn("parts", parts)
    listed = listed.withColumn("slice", F.pmod(F.xxhash64("word"), F.col("parts")))
    listed = listed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    low, high = F.least("slice", "other"), F.greatest("slice", "other")
    tile = F.concat_ws(":", "share", low.cast("string"), high.cast("string"))
    return listed.select(
        tile.alias("share"), "slice", (low != high).alias("crossed"), "turned", "prefix", "scan", "word", "n"
    )


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of the words (word, n) that have near ones: how many, and the
    most frequent of them, the first in code-point order among equals."""
    entries = 4 * words.count()
    buckets = max(shuffle_partitions(words.sparkSession), entries // ENTRIES_PER_BUCKET)
    bucket = F.pmod(F.xxhash64("share"), F.lit(buckets))
    near = shares(words).groupBy(bucket.alias("bucket")).applyInArrow(near_of_bucket, NEAR)
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best"))).alias("best")
    near = near.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return near.select("word", "n_near", (-F.col("best.minus")).alias("best_n"), F.col("best.best").alias("best"))


def variant_groups(words: DataFrame, times: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of a vocabulary (word, n), n at least 1.

    Near words differ by one inserted, deleted or replaced code point. The form of a word is its near
    word of largest n, the first in code-point order of several, if that n is at least `times` the
    word's, else null; root: where the forms of forms end, the word itself without any. Words are
    distinct, not null and of at least two code points. Other columns are not looked at; an empty
    vocabulary gives an empty result.

    Counts at least double from form to form, so the few rounds that look up the root of a root
    double the way each time and end after the logarithm of a logarithm.
    """
    words = stored(words.select("word", F.col("n").cast("long").alias("n")), "vocabulary")
    near = near_words(words)
    known = words.join(near, "word", "left")
    has_form = F.col("best_n") >= times * F.col("n")
    known = known.select(
        "word",
        F.when(has_form, F.col("best")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(has_form, F.col("best_n")).alias("form_n"),
    )
    known = stored(known, "near_words")
    roots = stored(known.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = roots.join(further, "root", "left")
        if step.where("further is not null").isEmpty():
            break
        roots = stored(step.select("word", F.coalesce("further", "root").alias("root")), "roots")
    out = known.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def with_typos(docs: DataFrame, every: int = 97, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word): the lower-cased runs of letters of all texts, one row each, with a code point deleted
    where `every` divides the crc32 of `<key>:<run>`. A null or empty text has none; a null key
    counts as empty text."""
    run = docs.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("of"),
        F.explode(runs(F.col(text))).alias("run"),
    )
    code = F.crc32(F.concat("of", F.lit(":"), "run").cast("binary"))
    at = (code % F.char_length("run")).cast("int")
    cut = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.char_length("run")))
    return run.select(F.when(code % every == 0, cut).otherwise(F.col("run")).alias("word"))
