"""Exact top-k inner-product search with a KD-tree per shard.

Space is cut into regions by the first median splits, found on a bounded sample; a region is one or
more shards. A shard's tree has median splits and tight bounding boxes. A box cannot hold a score
above the sum of the larger end products, so nodes are visited best bound first and the search ends
when no bound reaches the kth score. The kth score that a query finds in its own shard goes with it:
it travels to those regions alone whose box, taken over all their rows, can hold a better one.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import stored

LEAF = 512
SHARD_ROWS = 16_384
BLOCK_QUERIES = 4096
# Numbers of all sampled vectors together that the first splits are found on, and the sampled rows
# that a region has at least. The sample decides where rows lie, not what is found.
SAMPLE_VALUES = 1 << 21
SAMPLE_ROWS = 32


class Tree:
    """Median splits on the widest side until a leaf holds at most LEAF rows; boxes are tight."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order, self.nodes, todo = np.arange(len(rows)), [], [(0, len(rows), -1)]
        while todo:
            a, b, parent = todo.pop()
            part = rows[order[a:b]]
            low, high = part.min(axis=0), part.max(axis=0)
            here = len(self.nodes)
            self.nodes.append([low, high, a, b, []])
            if parent >= 0:
                self.nodes[parent][4].append(here)
            side = int(np.argmax(high - low)) if len(low) else 0
            if b - a <= LEAF or not len(low) or high[side] == low[side]:
                continue
            middle = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(part[:, side], middle)]
            todo += [(a, a + middle, here), (a + middle, b, here)]
        self.ids, self.rows = ids[order], rows[order]
        self.low = np.array([n[0] for n in self.nodes])
        self.high = np.array([n[1] for n in self.nodes])

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The most that each query can score in each node's box."""
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        return up @ self.high.T + down @ self.low.T

    def search(self, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int):
        """Per query the best k (score, id) whose score is at least its floor, best first.

        Queries that still need a leaf are scored against it together.
        """
        bounds = self.bounds(queries)
        score = [np.zeros(0)] * len(queries)
        found = [np.zeros(0, np.int64)] * len(queries)
        least = floor.astype(float).copy()
        heaps = [[(-bounds[q, 0], 0)] for q in range(len(queries))]
        live = list(range(len(queries)))
        while live:
            wanted: dict[int, list[int]] = {}
            following = []
            for q in live:
                heap = heaps[q]
                while heap and -heap[0][0] >= least[q]:
                    _, node = heapq.heappop(heap)
                    children = self.nodes[node][4]
                    if not children:
                        wanted.setdefault(node, []).append(q)
                        following.append(q)
                        break
                    for child in children:
                        heapq.heappush(heap, (-bounds[q, child], child))
            for node, asking in wanted.items():
                a, b = self.nodes[node][2:4]
                got = queries[asking] @ self.rows[a:b].T
                ids = self.ids[a:b]
                for q, line in zip(asking, got, strict=True):
                    keep = np.flatnonzero((line >= least[q]) & (ids != own[q]))
                    if not len(keep):
                        continue
                    s, i = np.concatenate((score[q], line[keep])), np.concatenate((found[q], ids[keep]))
                    best = np.lexsort((i, -s))[:k]
                    score[q], found[q] = s[best], i[best]
                    if len(best) == k:
                        least[q] = max(least[q], s[best[-1]])
            live = following
        return score, found


def whole_numbers(vectors: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """(id, v) with v = floor(scale * x) for each component; rows with a null or non-finite
    component, or without a vector or key, are left out."""
    x = F.col(vector)
    sound = F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))
    )
    rows = vectors.where(x.isNotNull() & F.col(key).isNotNull() & sound)
    return rows.select(
        F.col(key).cast("long").alias("id"),
        F.transform(x, lambda c: F.floor(c.cast("double") * scale)).cast("array<double>").alias("v"),
    )


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of equal length as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    flat = np.asarray(column.flatten(), dtype=np.float64)
    return flat.reshape(n, len(flat) // n if n else 0)


class Cuts:
    """The first median splits of vectors of one length: region numbers, near ones beside each other."""

    def __init__(self, sample: np.ndarray, rows: float, least: int):
        """rows: how many there are for the sample; no region is cut further that has `least`."""
        self.side, self.cut, self.next, self.regions = [], [], [], 0
        weight = rows / max(len(sample), 1)

        def split(part: np.ndarray) -> int:
            """Number of the node, or the complement of a region's."""
            spread = part.max(axis=0) - part.min(axis=0) if part.size else np.zeros(0)
            if len(part) * weight <= least or len(part) < 2 * SAMPLE_ROWS or not spread.any():
                self.regions += 1
                return ~(self.regions - 1)
            side = int(np.argmax(spread))
            values = part[:, side]
            middle = float(np.median(values))
            # Rows up to the cut go left; some are left and some right of it.
            cut = middle if middle < values.max() else float(values[values < values.max()].max())
            here = len(self.side)
            self.side.append(side), self.cut.append(cut), self.next.append(None)
            left = split(part[values <= cut])
            self.next[here] = (left, split(part[values > cut]))
            return here

        self.root = split(sample)

    def parts(self):
        """Plain values, as they are sent to the tasks."""
        return self.root, np.array(self.side, int), np.array(self.cut), np.array(self.next, int).reshape(-1, 2)


def region_of(rows: np.ndarray, parts) -> np.ndarray:
    """The region of each vector."""
    root, side, cut, following = parts
    node = np.full(len(rows), root)
    while (at := np.flatnonzero(node >= 0)).size:
        n = node[at]
        node[at] = following[n, (rows[at, side[n]] > cut[n]).astype(int)]
    return ~node


def by_length(batch: pa.RecordBatch):
    """(length, places in the batch, matrix) of the vectors of each length."""
    dims = batch.column("dims").to_numpy()
    for d in np.unique(dims):
        at = np.flatnonzero(dims == d)
        yield int(d), at, matrix(batch.column("v").take(pa.array(at))).reshape(len(at), d)


def first_cuts(rows: DataFrame, shard_rows: int) -> dict:
    """Cuts by length of vector, from one sample of at most about SAMPLE_VALUES numbers."""
    values = rows.agg(F.sum(F.greatest("dims", F.lit(1)))).first()[0] or 0
    share = min(1.0, SAMPLE_VALUES / max(values, 1))
    sample = rows.select("dims", "v") if share == 1 else rows.select("dims", "v").where(F.rand(17) < share)
    drawn = sample.toArrow().combine_chunks().to_batches()
    return {
        d: Cuts(part, len(part) / share, shard_rows).parts() for batch in drawn[:1] for d, _, part in by_length(batch)
    }


def in_regions(rows: DataFrame, cuts: dict) -> DataFrame:
    """The rows with their region; a length that the sample has none of is one region."""
    sent = rows.sparkSession.sparkContext.broadcast(cuts)

    def route(batches):
        for batch in batches:
            region = np.zeros(batch.num_rows, np.int32)
            for d, at, part in by_length(batch):
                if d in sent.value:
                    region[at] = region_of(part, sent.value[d])
            yield batch.append_column("region", pa.array(region))

    return rows.mapInArrow(route, rows.withColumn("region", F.lit(0)).schema)


def boxes_of(rows: DataFrame, every: int) -> list:
    """A row per length and region, in order: vectors, queries among them, and the ends of its box."""

    def partial(batches):
        found = {}
        for batch in batches:
            regions, ids = batch.column("region").to_numpy(), batch.column("id").to_numpy()
            for d, at, part in by_length(batch):
                for r in np.unique(regions[at]):
                    own = regions[at] == r
                    low, high = part[own].min(axis=0), part[own].max(axis=0)
                    n, q = int(own.sum()), int((ids[at][own] % every == 0).sum())
                    if (d, r) in found:
                        m, p, a, b = found[d, r]
                        n, q, low, high = n + m, q + p, np.minimum(low, a), np.maximum(high, b)
                    found[d, r] = n, q, low, high
        for (d, r), (n, q, low, high) in found.items():
            yield pa.RecordBatch.from_pylist(
                [{"dims": d, "region": int(r), "n": n, "asked": q, "low": low.tolist(), "high": high.tolist()}],
                schema=layout,
            )

    ends = pa.list_(pa.float64())
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), ends, ends]
    layout = pa.schema(list(zip(("dims", "region", "n", "asked", "low", "high"), kinds, strict=True)))

    def fold(table: pa.Table) -> pa.Table:
        low = matrix(table.column("low")).min(axis=0, initial=np.inf)
        high = matrix(table.column("high")).max(axis=0, initial=-np.inf)
        sums = {c: sum(table.column(c).to_pylist()) for c in ("n", "asked")}
        key = {c: table.column(c)[0].as_py() for c in ("dims", "region")}
        return pa.Table.from_pylist([{**key, **sums, "low": low.tolist(), "high": high.tolist()}], schema=layout)

    schema = "dims int, region int, n long, asked long, low array<double>, high array<double>"
    rows = rows.select("dims", "region", "id", "v").mapInArrow(partial, schema)
    # At most a row per SAMPLE_ROWS sampled vectors, and one for each other length.
    return rows.groupBy("dims", "region").applyInArrow(fold, schema).orderBy("dims", "region").collect()


def plan_of(boxes: list, shard_rows: int, block_queries: int) -> list[tuple]:
    """(dims, region, shards, first block, blocks): shards by a region's rows; blocks of queries of
    regions that follow each other, a large region having several of its own."""
    out, block, filled, before = [], 0, 0, None
    for box in boxes:
        own = max(1, -(-box["asked"] // block_queries))
        if box["dims"] != before:
            block, filled, before = 0, 0, box["dims"]
        elif own > 1 or filled + box["asked"] > block_queries:
            block, filled = block + 1, 0
        out.append((box["dims"], box["region"], -(-box["n"] // shard_rows), block, own))
        block, filled = block + own - 1, filled + box["asked"] if own == 1 else block_queries
    return out


def reachable(queries: DataFrame, boxes: list) -> DataFrame:
    """The queries with the regions of their length whose box can hold a score of the floor or more."""
    sides: dict[int, list] = {}
    for box in boxes:
        sides.setdefault(box["dims"], []).append((box["region"], box["low"], box["high"]))
    ends = {d: tuple(np.array(x) for x in zip(*found, strict=True)) for d, found in sides.items()}
    sent = queries.sparkSession.sparkContext.broadcast(ends)

    def reach(batches):
        for batch in batches:
            lists = [None] * batch.num_rows
            floor = batch.column("floor").to_numpy()
            for d, at, part in by_length(batch):
                region, low, high = sent.value[d]
                low, high = low.reshape(len(region), d), high.reshape(len(region), d)
                bound = np.maximum(part, 0) @ high.T + np.minimum(part, 0) @ low.T
                for i, line in zip(at.tolist(), bound >= floor[at][:, None], strict=True):
                    lists[i] = region[line]
            yield batch.append_column("regions", pa.array(lists, pa.list_(pa.int32())))

    return queries.mapInArrow(reach, queries.withColumn("regions", F.array(F.lit(0))).schema)


def top_k(
    vectors: DataFrame,
    k: int = 20,
    every: int = 20,
    scale: float = 64.0,
    key: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: of each vector whose key is divisible by `every`, the
    k others with the largest inner product, ties to the smaller key.

    Vectors are taken as floor(scale * x). Vectors that are null or hold a null or non-finite
    component, and null keys, take no part; only vectors of the same length are compared; a row
    with the query's own key is never its result, other repeated keys count once per row. Fewer
    than k others: all. Scores are exact below 2^53. Equal rows tie; they share a region, and
    are dealt to its shards by place. Queries are a stated set, searched in blocks of near ones; a
    query goes to every shard of the regions that can still hold a result of it, and to no other.
    """
    rows = whole_numbers(vectors, key, vector, scale)
    rows = rows.withColumn("dims", F.size("v"))
    rows = in_regions(rows, first_cuts(rows, shard_rows))
    rows = stored(rows.withColumn("place", F.monotonically_increasing_id()), "vectors")
    boxes = boxes_of(rows, every)
    planned = plan_of(boxes, shard_rows, block_queries)
    dealt = vectors.sparkSession.createDataFrame(
        planned, "dims int, region int, shards int, first_block int, own_blocks int"
    )
    rows = rows.join(F.broadcast(dealt), ["dims", "region"])
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("place"), F.col("shards")).cast("int"))
    asked = rows.where(F.col("id") % every == 0)
    within = F.pmod(F.xxhash64("place", F.lit("block")), F.col("own_blocks")).cast("int")
    asked = asked.withColumn("block", F.col("first_block") + within)
    asked = stored(asked.select("dims", "region", "shard", "block", "id", "place", "v"), "queries")

    def search(key_row, left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"place": [], "query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            tree = Tree(left.column("id").to_numpy(), matrix(left.column("v")))
            queries, own = matrix(right.column("v")), right.column("id").to_numpy()
            floor = right.column("floor").to_numpy()
            place = right.column("place").to_numpy()
            for a in range(0, len(queries), 256):
                part = slice(a, a + 256)
                scores, ids = tree.search(queries[part], own[part], floor[part], k)
                for q, (s, i) in enumerate(zip(scores, ids, strict=True), a):
                    out["place"].append(np.full(len(s), place[q]))
                    out["query_id"].append(np.full(len(s), own[q]))
                    out["vec_id"].append(i)
                    out["score"].append(s.astype(np.int64))
        return pa.table({c: np.concatenate([np.zeros(0, np.int64), *x]) for c, x in out.items()})

    schema = "place long, query_id long, vec_id long, score long"

    def searched(queries: DataFrame) -> DataFrame:
        # A shard goes to the blocks that ask it, once each.
        shard = ["dims", "region", "shard"]
        asking = queries.select(*shard, F.col("block").alias("for_block")).distinct()
        held = rows.select(*shard, "id", "v").join(asking, shard).groupBy(*shard, "for_block")
        return held.cogroup(queries.groupBy(*shard, "block")).applyInArrow(search, schema)

    home = asked.withColumn("floor", F.lit(float("-inf")))
    first = stored(searched(home), "home_results")
    # What a query has found at home is the least that other shards have to beat.
    kth = first.groupBy("place").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    kth = kth.select("place", F.when(F.col("n") >= k, F.col("least").cast("double")).alias("least"))
    away = asked.join(kth, "place", "left").withColumn("floor", F.coalesce("least", F.lit(float("-inf"))))
    away = reachable(away.drop("least", "n"), boxes).withColumn("to", F.explode("regions"))
    home_shard = away.select(
        "dims", F.col("to").alias("region"), "block", "id", "place", "v", "floor",
        F.when(F.col("to") == F.col("region"), F.col("shard")).alias("done"),
    )
    away = home_shard.join(F.broadcast(dealt.select("dims", "region", "shards")), ["dims", "region"])
    away = away.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    away = away.where("done IS NULL OR shard <> done").drop("done", "shards")
    several = sum(shards for _, _, shards, _, _ in planned) > len({box["dims"] for box in boxes})
    results = first.union(searched(stored(away, "away"))) if several else first
    # At most k rows per query and shard; the best k of them.
    best = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id", "score")))
    lists = results.groupBy("place", "query_id").agg(F.slice(best, 1, k).alias("best"))
    return lists.select("query_id", F.posexplode("best").alias("i", "r")).select(
        "query_id", (F.col("i") + 1).cast("int").alias("rank"), F.col("r.vec_id").alias("vec_id"), "r.score"
    )
