"""SimHash near-dedup: fingerprints, exact tiled comparison, components of linked fingerprints.

Distinct fingerprints are put into classes by the bit counts of their equal parts, four or eight of
them. Two fingerprints within the radius lie in classes whose counts differ by no more than the
radius in all, so other pairs of tiles are skipped; the rest are compared whole, by exclusive-or and
bit counts.
"""

from __future__ import annotations

from functools import reduce
from itertools import product
from operator import or_

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lakemart.llm.common import Words, as_bytes, plain_line, shuffle_partitions, slices, stored
from lakemart.llm.components import components

# Four parts make at most 17^4 classes; beyond so many fingerprints eight make the classes, and so
# the work for each fingerprint, some forty times smaller. What is linked is the same.
FOUR_PARTS_UP_TO = 40_000_000
TILE = 4096  # fingerprints of one class that are compared at a time
HASH_SEED = 42
BIT_ROWS = 1 << 17  # shingles whose bits are held at a time


def prints_of(lines: list[bytes], shingle: int) -> np.ndarray:
    """Fingerprint of each line of words; zero where there are none."""
    words = Words.of(lines)
    last = np.minimum(np.arange(len(words)) + shingle, np.repeat(words.first[1:], np.diff(words.first)))
    starts_line = np.zeros(len(words), bool)
    starts_line[words.first[:-1][np.diff(words.first) > 0]] = True
    at = np.flatnonzero((words.room >= shingle) | starts_line)
    view, digest = memoryview(words.bytes), xxhash.xxh64_intdigest
    ends = words.stop[last[at] - 1].tolist()
    hashes = [digest(view[a:b], HASH_SEED) for a, b in zip(words.start[at].tolist(), ends, strict=True)]
    hashes = np.array(hashes, np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8)
    line = np.searchsorted(words.first, at, "right") - 1
    n = np.bincount(line, minlength=len(lines))
    set_bits = np.zeros((len(lines), 64), np.int64)
    for a in range(0, len(hashes), BIT_ROWS):
        bits = np.unpackbits(hashes[a : a + BIT_ROWS], axis=1)
        of = line[a : a + BIT_ROWS]
        firsts = np.flatnonzero(np.diff(of, prepend=-1))
        set_bits[of[firsts]] += np.add.reduceat(bits, firsts, axis=0, dtype=np.int32)
    return np.packbits(2 * set_bits > n[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def fingerprints(
    docs: DataFrame, shingle: int = 3, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, text_hash, fingerprint as a signed long) of each row, in any order."""
    taken = docs.select(
        F.col(key).alias("id"),
        F.xxhash64(text).alias("text_hash"),
        F.col(text).cast("string").alias("body"),
    )

    def fold(batches):
        for batch in batches:
            lines = [plain_line(x, lower=True) for x in as_bytes(batch.column("body"))]
            for a, b in slices(lines):
                prints = prints_of(lines[a:b], shingle).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id")[a:b], batch.column("text_hash")[a:b], pa.array(prints)],
                    names=[key, "text_hash", "fingerprint"],
                )

    id_sql = docs.schema[key].dataType.simpleString()
    return taken.mapInArrow(fold, f"`{key}` {id_sql}, text_hash long, fingerprint long")


def tree_links(left: np.ndarray, right: np.ndarray | None, radius: int):
    """Links of a spanning forest of all pairs within the radius, as places in left + right.

    A pair that would join what is already joined is left out: no connection is lost, and a group
    of n near copies gives n - 1 links, not n squared.
    """
    both = left if right is None else np.concatenate((left, right))
    label = np.arange(len(both))
    shift = 0 if right is None else len(left)
    other = both if right is None else right
    out = []
    for a in range(0, len(left), 256):
        near = np.bitwise_count(left[a : a + 256, None] ^ other[None, :]) <= radius
        if right is None:
            near &= np.arange(len(left))[None, :] > np.arange(a, a + len(near))[:, None]
        for i in np.flatnonzero(near.any(axis=1)):
            js = np.flatnonzero(near[i]) + shift
            of, firsts = np.unique(label[js], return_index=True)
            new = of != label[a + i]
            if new.any():
                out += [(a + i, js[j]) for j in firsts[new]]
                label[np.isin(label, of)] = label[a + i]
    return both, out


def near_pairs(prints: DataFrame, radius: int = 2, parts: int | None = None) -> DataFrame:
    """Links (a, b) between distinct fingerprints: exactly the connections of all pairs within the
    radius, as spanning forests of the tile pairs.

    parts: of a fingerprint whose bits are counted, 4 or 8; by default as their number asks for.
    """
    prints = prints.select("fingerprint").distinct()
    if parts is None:
        parts = 4 if prints.count() <= FOUR_PARTS_UP_TO else 8
    bits = 64 // parts
    side = bits + 1  # bit counts that a part can have
    count = [
        F.bit_count(F.shiftrightunsigned("fingerprint", bits * q).bitwiseAND((1 << bits) - 1))
        for q in range(parts)
    ]
    kind = sum((c * side**q for q, c in enumerate(count)), F.lit(0)).cast("int")
    prints = prints.withColumn("kind", kind)
    sizes = prints.groupBy("kind").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    # Four parts make at most 17^4 classes, whatever the number of documents.
    sizes = stored(sizes.coalesce(1) if parts == 4 else sizes, "tiles")

    steps = [
        s
        for s in product(range(-radius, radius + 1), repeat=parts)
        if sum(map(abs, s)) <= radius and s >= (0,) * parts
    ]
    part = [(F.col("kind") / side**q).cast("int") % side for q in range(parts)]

    def reached(step) -> Column:
        """The class so many counts away; none where a count would leave its range."""
        outside = [
            (c + d < 0) | (c + d >= side) for c, d in zip(part, step, strict=True) if d
        ]
        number = F.col("kind") + sum(d * side**q for q, d in enumerate(step))
        return F.when(~reduce(or_, outside), number) if outside else number

    pairs = sizes.select(
        F.col("kind").alias("l"),
        F.col("tiles").alias("ls"),
        F.explode(F.array_compact(F.array(*map(reached, steps)))).alias("r"),
    )
    other = sizes.select(F.col("kind").alias("r"), F.col("tiles").alias("rs"))
    pairs = pairs.join(F.broadcast(other) if parts == 4 else other, "r")
    pairs = stored(pairs, "tile_pairs")
    roles = pairs.select(F.col("l").alias("kind"), "l", "r", "ls", "rs", F.lit(0).alias("role")).union(
        pairs.select(F.col("r").alias("kind"), "l", "r", "ls", "rs", F.lit(1).alias("role"))
    )
    # The tiles of the other side that this fingerprint's tile meets; within a class each pair of
    # tiles once, and a tile with itself.
    own = F.when(F.col("role") == 0, F.col("ls")).otherwise(F.col("rs"))
    own = F.pmod(F.xxhash64("fingerprint"), own).cast("int")
    first = F.when((F.col("l") == F.col("r")) & (F.col("role") == 0), F.col("own")).otherwise(0)
    last = (
        F.when(F.col("role") == 0, F.col("rs") - 1)
        .when(F.col("l") == F.col("r"), F.col("own") - 1)
        .otherwise(F.col("ls") - 1)
    )
    tiled = (
        prints.join(roles, "kind")
        .withColumn("own", own)
        .withColumn("first", first)
        .withColumn("last", last)
        .where("first <= last")
        .withColumn("other", F.explode(F.sequence("first", "last")))
        .select(
            "l",
            "r",
            F.when(F.col("role") == 0, F.col("own")).otherwise(F.col("other")).alias("i"),
            F.when(F.col("role") == 0, F.col("other")).otherwise(F.col("own")).alias("j"),
            "role",
            "fingerprint",
        )
    )
    tasks = shuffle_partitions(prints.sparkSession)
    tiled = tiled.repartition(tasks, "l", "r", "i", "j").sortWithinPartitions("l", "r", "i", "j", "role")

    def compare(batches):
        for tile in tile_pairs(batches):
            l, r, i, j = tile[0][:4]
            side, values = tile[:, 4], tile[:, 5].view(np.uint64)
            alone = l == r and i == j
            both, found = tree_links(
                values if alone else values[side == 0], None if alone else values[side == 1], radius
            )
            if found:
                at = np.array(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(both[at[:, k]].view(np.int64)) for k in (0, 1)], names=["a", "b"]
                )

    return tiled.mapInArrow(compare, "a long, b long")


def tile_pairs(batches):
    """The rows of each tile pair, of a stream sorted by tile pair, as one integer array."""
    rest = np.zeros((0, 6), np.int64)
    for batch in batches:
        rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1)
        rows = np.concatenate((rest, rows))
        bounds = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(axis=1)) + 1
        bounds = [0, *bounds.tolist()]
        for a, b in zip(bounds, bounds[1:], strict=False):
            yield rows[a:b]
        rest = rows[bounds[-1] :]
    if len(rest):
        yield rest


def grouped(prints: DataFrame, radius: int = 2, key: str = "doc_id") -> DataFrame:
    """The fingerprint table with `first`: the smallest (key, text_hash) of the row's group.

    A key that is null counts as larger than any other.
    """
    first = F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"), "text_hash"))
    classes = stored(prints.groupBy("fingerprint").agg(first.alias("first")), "classes")
    linked = components(near_pairs(classes, radius)).withColumnRenamed("node", "fingerprint")
    classes = classes.join(linked, "fingerprint", "left").withColumn(
        "root", F.coalesce("root", "fingerprint")
    )
    groups = classes.groupBy("root").agg(F.min("first").alias("first"))
    of = classes.select("fingerprint", "root").join(groups, "root").select("fingerprint", "first")
    return prints.join(of, "fingerprint")


def near_duplicates(
    docs: DataFrame,
    shingle: int = 3,
    radius: int = 2,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per input row: key, fingerprint (16 hex digits), component_id, the smallest key that a
    chain of fingerprints with at most `radius` differing bits reaches.

    Lower-cases A-Z; words are runs of anything but ASCII blanks; a shingle's bits are those of
    its XXH64. A null or empty text has fingerprint zero, linked like any other. Equal rows are
    rows of their own with the same result. A null key is reached last: component_id is null
    only where no row of the group has a key. An empty table gives an empty result.
    """
    prints = stored(fingerprints(docs, shingle, key, text), "fingerprints")
    return grouped(prints, radius, key).select(
        key,
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("first.id").alias("component_id"),
    )


def in_order(name: str, kind: T.DataType) -> Column:
    """A column to sort by, whatever its type."""
    sortable = not any(t in kind.simpleString() for t in ("map<", "variant"))
    return F.col(name) if sortable else F.to_json(F.struct(name))


def one_per_group(
    docs: DataFrame, shingle: int = 3, radius: int = 2, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of docs, all columns, without all but one of each group of near copies: the one
    with the smallest key; of rows of the same key and text the smallest by its other columns, in
    their order (those that have an order; variants and maps by their JSON text)."""
    prints = stored(fingerprints(docs, shingle, key, text), "fingerprints")
    kept = grouped(prints, radius, key).select("first").distinct()
    kept = kept.select(F.col("first.id").alias("kept_id"), F.col("first.text_hash").alias("kept_hash"))
    rows = docs.select(
        *[F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)],
        F.col(key).alias("id"),
        F.xxhash64(text).alias("text_hash"),
    )
    same = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("text_hash") == F.col("kept_hash"))
    order = [in_order(f"c{i}", field.dataType) for i, field in enumerate(docs.schema)]
    first = Window.partitionBy("id", "text_hash").orderBy(*order)
    rows = rows.join(kept, same, "left_semi").withColumn("n", F.row_number().over(first)).where("n = 1")
    return rows.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
