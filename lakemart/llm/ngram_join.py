"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

Columns that one document alone has add to no overlap, so documents that share too few of their
shingles with anyone, by the bound their size gives, are not rows of the product. The other rows lie
in blocks of similar ones. Two blocks meet where some row of each has a shingle in common among its
rarest ones: of a row of size s, all but 80 % of s. Where two rows link, the rarest shingle they
share is among these of both. Of two blocks that meet, only such rows travel. Their overlaps are
accumulated over blocks of columns, and pairs go as soon as what is left cannot lift them to the
bound that their sizes set.
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
    LOWER,
    RangeHash,
    Words,
    chunk_rows,
    numbered,
    packed,
    shuffle_partitions,
    stored,
)
from lakemart.llm.components import components

SLAB_WORDS = 1 << 18  # words hashed at a time, so a very long text needs no more memory than they do
KEYS_PER_BUCKET = 3_000_000  # shingles counted in one task, about
BLOCK_ROWS = 256
COLUMN_BLOCK = 1024  # columns of a dense partial product
LIGHT = 32  # a column with fewer pairs than this in a tile adds them one by one
PAIRS_AT_ONCE = 1 << 20


# Sets


def shingle_sets(body: bytes, sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct shingles of each text, sorted; a text of fewer words, but not
    none, has its whole sequence as one."""
    words = Words(body.translate(LOWER), sizes)
    n = len(words)
    ends = np.minimum(np.arange(n) + width, np.repeat(words.first[1:], np.diff(words.first)))
    begins = np.zeros(n, bool)
    begins[words.first[:-1][np.diff(words.first) > 0]] = True
    at = np.flatnonzero((words.room >= width) | begins)
    hashes = np.empty(len(at), np.uint64)
    for i in range(0, len(at), SLAB_WORDS):
        some = at[i : i + SLAB_WORDS]
        a, b = words.start[some], words.stop[ends[some] - 1]
        hashes[i : i + SLAB_WORDS] = RangeHash(words.buffer[a[0] : b[-1]])(a - a[0], b - a[0])
    text = np.searchsorted(words.first, at, "right") - 1
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    return text[new], hashes[new]


def set_table(chunks: DataFrame, width: int) -> DataFrame:
    """(row, id, n, c1, c2): size and 128-bit digest of the set of each text."""
    ids = chunks.schema["ids"].dataType.elementType

    def describe(batches):
        for r in chunk_rows(batches):
            text, hashes = shingle_sets(r["body"], r["sizes"], width)
            bounds = np.searchsorted(text, np.arange(len(r["sizes"]) + 1))
            view = memoryview(hashes.tobytes())
            digests = b"".join(
                [
                    xxhash.xxh3_128_digest(view[8 * a : 8 * b])
                    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
                ]
            )
            halves = np.frombuffer(digests, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(r["chunk"] + np.arange(len(r["sizes"]))),
                    pa.array(r["ids"], to_arrow_type(ids)),
                    pa.array(np.diff(bounds)),
                    pa.array(halves[:, 0]),
                    pa.array(halves[:, 1]),
                ],
                names=["row", "id", "n", "c1", "c2"],
            )

    schema = f"row long, id {ids.simpleString()}, n long, c1 long, c2 long"
    return stored(chunks.mapInArrow(describe, schema), "sets")


# How many texts have a shingle


def coded(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 32 more bits of a hash. Where two shingles have the same code, both count as more
    frequent than they are, which changes an order and a bound that stays one, never a result."""
    bucket = (hashes >> np.uint64(32)) % np.uint64(buckets)
    return bucket << np.uint64(32) | (hashes & np.uint64(0xFFFFFFFF))


def rank_of(count: np.ndarray) -> np.ndarray:
    """Rising with the count: 0 for one text, exact for few, in steps of a fifth for many."""
    steps = 16 + np.floor(4 * np.log2(np.maximum(count, 16) / 16))
    return np.minimum(np.where(count <= 16, count - 1, steps), 255).astype(np.uint8)


def frequency_ranks(chunks: DataFrame, width: int, buckets: int) -> DataFrame:
    """(chunk, ranks): for each bucket the ranks of a chunk's codes, in their order."""

    def codes(batches):
        compressor = zstandard.ZstdCompressor(level=1)
        for r in chunk_rows(batches):
            _, hashes = shingle_sets(r["body"], r["sizes"], width)
            code, count = np.unique(coded(hashes, buckets), return_counts=True)
            bounds = np.searchsorted(code >> np.uint64(32), np.arange(buckets + 1, dtype=np.uint64))
            used = np.flatnonzero(np.diff(bounds))
            key, count = code.astype(np.uint32), count.astype(np.uint32)
            pieces = [slice(bounds[b], bounds[b + 1]) for b in used]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(used.astype(np.int32)),
                    pa.array(np.full(len(used), r["chunk"], np.int64)),
                    pa.array([key[p].tobytes() for p in pieces], pa.binary()),
                    pa.array([compressor.compress(count[p].tobytes()) for p in pieces], pa.binary()),
                ],
                names=["bucket", "chunk", "keys", "counts"],
            )

    def add_up(table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(k, np.uint32) for k in table["keys"].to_pylist()]
        unpack = zstandard.ZstdDecompressor().decompress
        counts = np.concatenate([np.frombuffer(unpack(c), np.uint32) for c in table["counts"].to_pylist()])
        _, which = np.unique(np.concatenate(keys), return_inverse=True)
        ranks = rank_of(np.bincount(which, weights=counts))[which]
        pieces = np.split(ranks, np.cumsum([len(k) for k in keys])[:-1])
        compressor = zstandard.ZstdCompressor(level=1)
        return pa.table(
            {
                "bucket": table["bucket"],
                "chunk": table["chunk"],
                "ranks": pa.array([compressor.compress(p.tobytes()) for p in pieces], pa.binary()),
            }
        )

    sent = chunks.mapInArrow(codes, "bucket int, chunk long, keys binary, counts binary")
    answers = sent.groupBy("bucket").applyInArrow(add_up, "bucket int, chunk long, ranks binary")
    return answers.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "ranks")).alias("answers"))


def least_overlap(size: np.ndarray, percent: int) -> np.ndarray:
    """What a set has to share with any partner: the union is at least as large as the set."""
    return -(-percent * size // 100)


def rows_of_product(chunks: DataFrame, ranks: DataFrame, width: int, percent: int, buckets: int) -> DataFrame:
    """(row, size, least, prefix, hashes) of the texts that share enough of their shingles with others:
    the shared ones, the rarest first, and how many of them a partner must meet one of."""

    def keep(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for r in chunk_rows(batches):
            text, hashes = shingle_sets(r["body"], r["sizes"], width)
            if not len(text):
                continue
            answers = sorted(r["answers"], key=lambda x: x["bucket"])
            rank = np.concatenate([np.frombuffer(unpack(x["ranks"]), np.uint8) for x in answers])
            _, which = np.unique(coded(hashes, buckets), return_inverse=True)
            rank = rank[which]
            size = np.bincount(text, minlength=len(r["sizes"]))
            shared = np.bincount(text[rank > 0], minlength=len(size))
            need = least_overlap(size, percent)
            fits = (size > 0) & (shared >= need)
            taken = fits[text] & (rank > 0)
            text, hashes, rank = text[taken], hashes[taken], rank[taken]
            order = np.lexsort((hashes, rank, text))
            text, hashes = text[order], hashes[order]
            at = np.flatnonzero(fits)
            a, b = np.searchsorted(text, at), np.searchsorted(text, at, "right")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(r["chunk"] + at),
                    pa.array(size[at]),
                    pa.array(np.minimum.reduceat(hashes, a).view(np.int64) if len(at) else at),
                    pa.array((shared - need + 1)[at]),
                    pa.array([hashes[i:j].tobytes() for i, j in zip(a, b, strict=True)], pa.binary()),
                ],
                names=["row", "size", "least", "prefix", "hashes"],
            )

    schema = "row long, size long, least long, prefix long, hashes binary"
    return chunks.join(ranks, "chunk").mapInArrow(keep, schema)


# The product of two blocks of rows


class Rows:
    """Rows of the incidence matrix: number, set size, weight (texts with that set), hashes."""

    def __init__(self, rows: list[dict]):
        rows = sorted(rows, key=lambda r: r["row"])
        self.row = np.array([r["row"] for r in rows], np.int64)
        self.size = np.array([r["size"] for r in rows], np.int64)
        self.weight = np.array([r["weight"] for r in rows], np.int64)
        self.prefix = [r["prefix"] for r in rows]
        hashes = [np.frombuffer(r["hashes"], np.uint64) for r in rows]
        self.hashes = np.concatenate(hashes)
        self.of = np.repeat(np.arange(len(rows)), [len(h) for h in hashes])
        self.first = np.concatenate(([0], np.cumsum([len(h) for h in hashes])))

    def rarest(self) -> tuple[np.ndarray, np.ndarray]:
        """(hash, row) of the prefixes, sorted."""
        at = [np.arange(f, f + p) for f, p in zip(self.first, self.prefix, strict=False)]
        at = np.concatenate(at)
        h, of = self.hashes[at], self.of[at]
        order = np.lexsort((of, h))
        return h[order], of[order]


def columns(rows: Rows, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(column, row) of the entries in the common columns, sorted by column."""
    at = np.searchsorted(common, rows.hashes)
    at[at == len(common)] = 0
    found = common[at] == rows.hashes if len(common) else np.zeros(len(at), bool)
    column, of = at[found], rows.of[found]
    order = np.argsort(column, kind="stable")
    return column[order], of[order]


def linked_pairs(a: Rows, b: Rows, percent: int, own: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (index in a, index in b) with 100 * overlap >= percent * union; own: a is b, each pair once."""
    na, nb = len(a.row), len(b.row)
    small, large = np.minimum.outer(a.size, b.size), np.maximum.outer(a.size, b.size)
    alive = 100 * small >= percent * large
    if own:
        alive &= np.triu(np.ones((na, nb), bool), 1)
    need = -(-percent * (a.size[:, None] + b.size) // (100 + percent))
    if own:
        common, degree = np.unique(a.hashes, return_counts=True)
        common = common[degree > 1]
    else:
        common = np.intersect1d(a.hashes, b.hashes)
    ca, ra = columns(a, common)
    cb, rb = columns(b, common)
    da, db = np.bincount(ca, minlength=len(common)), np.bincount(cb, minlength=len(common))
    # Columns in the order in which they are taken: those of many rows first, in dense blocks.
    order = np.argsort(-(da * db), kind="stable")
    heavy = int((da * db >= LIGHT).sum())
    fa, fb = np.cumsum(da) - da, np.cumsum(db) - db
    left_a, left_b = np.bincount(ra, minlength=na), np.bincount(rb, minlength=nb)
    overlap = np.zeros((na, nb), np.int64)

    def entries(taken, first, degree, row):
        """(column number, row) of the entries of the columns."""
        n = degree[taken]
        at = np.repeat(first[taken] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.repeat(np.arange(len(taken)), n), row[at]

    start = 0
    while start < len(order) and alive.any():
        if start < heavy:
            taken = order[start : min(start + COLUMN_BLOCK, heavy)]
        else:
            pairs = np.cumsum(da[order[start:]] * db[order[start:]])
            taken = order[start : start + max(1, int(np.searchsorted(pairs, PAIRS_AT_ONCE, "right")))]
        (i, x), (j, y) = entries(taken, fa, da, ra), entries(taken, fb, db, rb)
        if start < heavy:
            left, right = np.zeros((na, len(taken)), np.float32), np.zeros((nb, len(taken)), np.float32)
            left[x, i], right[y, j] = 1, 1
            some_a, some_b = alive.any(1), alive.any(0)
            overlap[np.ix_(some_a, some_b)] += np.rint(left[some_a] @ right[some_b].T).astype(np.int64)
        else:
            per = db[taken][i]
            begin = (np.cumsum(db[taken]) - db[taken])[i]
            within = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
            code = np.repeat(x, per) * nb + y[np.repeat(begin, per) + within]
            overlap += np.bincount(code, minlength=na * nb).reshape(na, nb)
        left_a = left_a - np.bincount(x, minlength=na)
        left_b = left_b - np.bincount(y, minlength=nb)
        alive &= overlap + np.minimum.outer(left_a, left_b) >= need
        start += len(taken)
    return np.nonzero(alive & (overlap >= need))


def tree(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node that a link touches, with the smallest node of its component."""
    label = np.arange(max(x.max(), y.max()) + 1 if len(x) else 0)
    while len(x):
        low = np.minimum(label[x], label[y])
        before = label.copy()
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        label = label[label]
        if (label == before).all():
            break
    nodes = np.unique(np.concatenate((x, y)))
    return nodes, label[nodes]


LINKS = "a long, b long, links long"


def summary(a: Rows, b: Rows, percent: int, own: bool) -> pa.RecordBatch:
    """What a tile says: a tree over its links, as rows (a, b), and how many texts each row links to
    in it, as rows (a, null, links). Pairs themselves do not leave the task."""
    x, y = linked_pairs(a, b, percent, own)
    number = a.row if own else np.concatenate((a.row, b.row))
    weight = a.weight if own else np.concatenate((a.weight, b.weight))
    y = y if own else y + len(a.row)
    links = np.zeros(len(number), np.int64)
    np.add.at(links, x, weight[y])
    np.add.at(links, y, weight[x])
    nodes, roots = tree(x, y)
    some = nodes != roots
    counted = np.flatnonzero(links)
    edges = int(some.sum())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate((number[nodes[some]], number[counted]))),
            pa.array([*number[roots[some]].tolist(), *[None] * len(counted)], pa.int64()),
            pa.array(np.concatenate((np.zeros(edges, np.int64), links[counted]))),
        ],
        names=["a", "b", "links"],
    )


# Which blocks meet


def block_rows(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


MEETINGS = "block long, other long, hashes binary"


def meetings(blocks: DataFrame, percent: int, buckets: int) -> DataFrame:
    """(block, other, hashes): the shingles by which a block meets another, by size bounds too."""

    def prefixes(batches):
        for r in block_rows(batches):
            rows = Rows(r["rows"])
            hashes, of = rows.rarest()
            new = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
            size = rows.size[of]
            low, high = np.minimum.reduceat(size, new), np.maximum.reduceat(size, new)
            hashes = hashes[new]
            bucket = (hashes >> np.uint64(17)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            used, first = np.unique(bucket[order], return_index=True)
            parts = np.split(order, first[1:])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(used.astype(np.int32)),
                    pa.array(np.full(len(used), r["block"], np.int64)),
                    *[
                        pa.array([v[p].tobytes() for p in parts], pa.binary())
                        for v in (hashes, low, high)
                    ],
                ],
                names=["bucket", "block", "hashes", "low", "high"],
            )

    def meet(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        hashes = [np.frombuffer(r["hashes"], np.uint64) for r in rows]
        block = np.repeat([r["block"] for r in rows], [len(h) for h in hashes])
        hashes = np.concatenate(hashes)
        low = np.concatenate([np.frombuffer(r["low"], np.int64) for r in rows])
        high = np.concatenate([np.frombuffer(r["high"], np.int64) for r in rows])
        order = np.lexsort((block, hashes))
        hashes, block, low, high = hashes[order], block[order], low[order], high[order]
        out = {"block": [], "other": [], "hashes": []}
        first, step = np.arange(len(hashes)), 1
        while True:
            first = first[first + step < len(hashes)]
            first = first[hashes[first] == hashes[first + step]]
            if not len(first):
                break
            i, j = first, first + step
            fits = (100 * high[i] >= percent * low[j]) & (100 * high[j] >= percent * low[i])
            i, j = i[fits], j[fits]
            by = np.lexsort((block[j], block[i]))
            i, j = i[by], j[by]
            new = np.flatnonzero(np.append(True, (block[i][1:] != block[i][:-1]) | (block[j][1:] != block[j][:-1])))
            for p, q in zip(new, np.append(new[1:], len(i)), strict=True) if len(i) else ():
                met = hashes[i[p:q]].tobytes()
                for x, y in ((i[p], j[p]), (j[p], i[p])):
                    out["block"].append(int(block[x]))
                    out["other"].append(int(block[y]))
                    out["hashes"].append(met)
            step += 1
        types = {"block": pa.int64(), "other": pa.int64(), "hashes": pa.binary()}
        return pa.table({name: pa.array(values, types[name]) for name, values in out.items()})

    sent = blocks.mapInArrow(
        prefixes, "bucket int, block long, hashes binary, low binary, high binary"
    )
    return sent.groupBy("bucket").applyInArrow(meet, MEETINGS)


def tiles(blocks: DataFrame, percent: int, buckets: int) -> DataFrame:
    """The links of all pairs of rows, by tiles: a block with itself, and with others it meets."""

    def within(batches):
        for r in block_rows(batches):
            rows = Rows(r["rows"])
            yield summary(rows, rows, percent, True)

    def export(batches):
        for r in block_rows(batches):
            rows = Rows(r["rows"])
            hashes, of = rows.rarest()
            to: dict[int, list] = {}
            for m in r["met"]:
                to.setdefault(m["other"], []).append(np.frombuffer(m["hashes"], np.uint64))
            for other, met in to.items():
                wanted = np.unique(of[np.isin(hashes, np.concatenate(met))])
                low, high = min(r["block"], other), max(r["block"], other)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(wanted), low)),
                        pa.array(np.full(len(wanted), high)),
                        pa.array(np.full(len(wanted), r["block"])),
                        *[pa.array(v[wanted]) for v in (rows.row, rows.size, rows.weight)],
                        pa.array([rows.hashes[rows.first[i] : rows.first[i + 1]].tobytes() for i in wanted], pa.binary()),
                    ],
                    names=["low", "high", "block", "row", "size", "weight", "hashes"],
                )

    def between(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        first = [r | {"prefix": 0} for r in rows if r["block"] == r["low"]]
        second = [r | {"prefix": 0} for r in rows if r["block"] == r["high"]]
        return pa.Table.from_batches([summary(Rows(first), Rows(second), percent, False)])

    met = meetings(blocks, percent, buckets).groupBy("block").agg(
        F.collect_list(F.struct("other", "hashes")).alias("met")
    )
    sent = blocks.join(met, "block").mapInArrow(
        export, "low long, high long, block long, row long, size long, weight long, hashes binary"
    )
    apart = sent.groupBy("low", "high").applyInArrow(between, LINKS)
    return blocks.mapInArrow(within, LINKS).union(apart)


def jaccard_join(
    docs: DataFrame, width: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per input row: key, n_shingles (set size), component_id (the smallest key that a chain of
    links reaches, its own included), n_links (rows it links with).

    Lower-cases A-Z; words are runs of anything but ASCII blanks; a set holds the distinct shingles
    of `width` words, of a shorter text its whole sequence. Two rows link when
    100 * intersection >= percent * union; percent is a whole number from 1 to 100. A null, empty or blank text has an empty set,
    which links with nothing, its like included. Equal rows are rows of their own and link with
    each other. A null key counts as largest: component_id is null only where no row of the
    component has a key. Other columns are not looked at; an empty table gives an empty result.
    Every text is used whole; shingles are the same if 64 bits of their hashes are.

    Rows with equal sets are one row of the matrix, with a weight, so copies make no pairs. What
    leaves a tile is a tree over its links and a count per row, never the pairs.
    """
    spark = docs.sparkSession
    chunks = packed(docs, key, text, True, "words")
    sets = set_table(chunks, width)
    place = F.col("row")
    classes = sets.where("n > 0").groupBy("c1", "c2").agg(
        F.min(place).alias("rep"), F.count("*").alias("weight"), F.min("id").alias("least_id")
    )
    classes = stored(classes, "classes")
    total = sets.agg(F.sum("n")).first()[0] or 0
    buckets = max(shuffle_partitions(spark), total // KEYS_PER_BUCKET)
    ranks = frequency_ranks(chunks, width, buckets)
    rows = rows_of_product(chunks, ranks, width, percent, buckets)
    rows = rows.join(classes.select(F.col("rep").alias("row"), "weight"), "row")
    rows = numbered(rows, ["least", "size", "row"], "matrix")
    of_block = F.floor(F.col("place") / BLOCK_ROWS)
    blocks = rows.groupBy(of_block.alias("block")).agg(
        F.collect_list(F.struct("row", "size", "weight", "prefix", "hashes")).alias("rows")
    )
    blocks = stored(blocks, "blocks")
    prefixes = rows.agg(F.sum("prefix")).first()[0] or 0
    found = tiles(blocks, percent, max(shuffle_partitions(spark), prefixes // KEYS_PER_BUCKET))
    found = stored(found, "links")
    roots = components(found.where("b is not null").select("a", "b"))
    counts = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    in_component = classes.join(roots.withColumnRenamed("node", "rep"), "rep")
    least = in_component.groupBy("root").agg(F.min("least_id").alias("least_of_all"))
    in_component = in_component.join(least, "root").select("rep", "least_of_all")
    linked = classes.join(in_component, "rep", "left").join(counts, "rep", "left")
    # A set of its own that links with nothing needs no lookup.
    linked = linked.where("weight > 1 or links is not null").select(
        "c1",
        "c2",
        F.when(F.col("links").isNull(), F.col("least_id")).otherwise(F.col("least_of_all")).alias("component"),
        (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n"),
        F.lit(True).alias("known"),
    )
    out = sets.where("n > 0").withColumnRenamed("n", "n_shingles").join(linked, ["c1", "c2"], "left")
    out = out.select(
        F.col("id").alias(key),
        "n_shingles",
        F.when(F.col("known"), F.col("component")).otherwise(F.col("id")).alias("component_id"),
        F.coalesce("n", F.lit(0)).alias("n_links"),
    )
    alone = sets.where("n = 0").select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.col("id").alias("component_id"), F.lit(0).cast("long").alias("n_links")
    )
    return out.union(alone)
