"""Merkle dataset manifest: append logs of ternary trees, written by aligned builders in postorder.

A tree over n leaves joins every three consecutive nodes of a level, the last ones being fewer, until
one is left. A builder takes an aligned range of 3^LEVELS leaves and appends each node when it is
complete: a leaf, then every run that it fills. Where a node stands in such a log follows from the
sizes of the complete subtrees before it alone, so siblings are read by position. The tops of the
builders are the leaves of the next ones, until a tree has one top; the trees' roots are the leaves of
the tree above all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lakemart.llm.common import numbered, stored

ARITY = 3
LEVELS = 7  # levels one builder completes: 2187 leaves at a time
SIZE = 32  # bytes of a digest


def joined(digests: Sequence[bytes]) -> bytes:
    """The node above some nodes: sha256 of their digests as hex text."""
    return hashlib.sha256(b"".join(digests).hex().encode()).digest()


# The log of one builder


def height(n: int) -> int:
    """Levels above n leaves until one node is left."""
    out = 0
    while ARITY**out < n:
        out += 1
    return out


def append_log(leaves: Sequence[bytes], levels: int) -> tuple[bytes, bytes]:
    """All nodes in the order in which they are complete, and the last of them, `levels` above."""
    log: list[bytes] = []
    open_runs: list[list[bytes]] = [[] for _ in range(levels + 1)]

    def add(node: bytes, level: int) -> None:
        log.append(node)
        open_runs[level].append(node)

    def close(level: int) -> None:
        run, open_runs[level] = open_runs[level], []
        add(joined(run), level + 1)

    for leaf in leaves:
        add(leaf, 0)
        level = 0
        while level < levels and len(open_runs[level]) == ARITY:
            close(level)
            level += 1
    for level in range(levels):  # runs at the end of the tree stay shorter, one node even
        if open_runs[level]:
            close(level)
    return b"".join(log), log[-1]


def subtree_size(level: int) -> int:
    """Nodes of a complete subtree."""
    return (ARITY ** (level + 1) - 1) // (ARITY - 1)


def completed(leaves: np.ndarray, levels: int) -> np.ndarray:
    """Nodes in the log once so many leaves are in: a complete subtree for each base-3 digit."""
    out = np.zeros_like(leaves)
    for level in range(levels + 1):
        digit = leaves // ARITY**level
        out += (digit % ARITY if level < levels else digit) * subtree_size(level)
    return out


def positions(n: int, levels: int) -> list[np.ndarray]:
    """For each level, where its nodes stand in the log of n leaves."""
    out, ragged = [], 0
    for level in range(levels + 1):
        width = ARITY**level
        count = -(-n // width)
        end = np.minimum((np.arange(count) + 1) * width, n)
        at = completed(end - 1, levels) + level
        if n % width:  # the last node was closed after all leaves, and after those below it
            at[-1] = completed(np.array([n]), levels)[0] + ragged
            ragged += 1
        out.append(at)
    return out


def paths(log: bytes, n: int, levels: int) -> list[list[tuple[str, str]]]:
    """For each leaf, level by level, the digests of its run before it and after it, as hex text."""
    places = positions(n, levels)
    text = [[log[SIZE * p : SIZE * (p + 1)].hex() for p in at.tolist()] for at in places]
    up: list[list[tuple[str, str]]] = [[] for _ in text[levels]]
    for level in reversed(range(levels)):
        nodes, below = text[level], []
        for i in range(len(nodes)):
            run = i - i % ARITY
            own = ("".join(nodes[run:i]), "".join(nodes[i + 1 : run + ARITY]))
            below.append([own, *up[i // ARITY]])
        up = below
    return up


def fold(digest: str, path: Sequence[tuple[str, str]]) -> str:
    """The root that a leaf and the siblings on its way give."""
    for before, after in path:
        digest = hashlib.sha256(f"{before}{digest}{after}".encode()).hexdigest()
    return digest


# Trees


PATH = "array<struct<before:string,after:string>>"


def levels_of(n: int) -> int:
    """What a builder completes in a tree that has n nodes at the builder's lowest level."""
    return min(height(n), LEVELS)


class Trees:
    """The logs of many trees, stage by stage; trees are numbered.

    leaves: (tree, at, n, digest, key, candidate): place in the tree, number of its leaves.
    """

    def __init__(self, leaves: DataFrame, name: str):
        span = ARITY**LEVELS
        self.key = leaves.schema["key"].dataType
        most = leaves.agg(F.max("n")).first()[0] or 0
        self.stages = []
        entries, tops = leaves, []
        while True:
            done = stored(self.logs(entries, first=not self.stages), f"{name}_log")
            self.stages.append(done)
            tops.append(done.where("single").select("tree", F.col("top").alias("digest")))
            if most <= span:
                break
            most = -(-most // span)
            entries = done.where("not single").select(
                "tree", F.col("block").alias("at"), F.ceil(F.col("n") / span).alias("n"), F.col("top").alias("digest")
            )
        self.roots = tops[0]
        for more in tops[1:]:
            self.roots = self.roots.union(more)

    def logs(self, entries: DataFrame, first: bool) -> DataFrame:
        """(tree, block, n, single, log, top), and of leaves their keys and candidates."""
        span = ARITY**LEVELS
        kinds = {"tree": pa.int64(), "block": pa.int64(), "n": pa.int64(), "single": pa.bool_(), "log": pa.binary(), "top": pa.binary()}
        schema = "tree long, block long, n long, single boolean, log binary, top binary"
        if first:
            kinds |= {"keys": pa.list_(to_arrow_type(self.key)), "candidates": pa.binary()}
            schema += f", keys array<{self.key.simpleString()}>, candidates binary"

        def build(table: pa.Table) -> pa.Table:
            table = table.sort_by("at")
            n = table["n"][0].as_py()
            log, top = append_log(table["digest"].to_pylist(), levels_of(n))
            row = {
                "tree": table["tree"][0].as_py(), "block": table["block"][0].as_py(), "n": n,
                "single": n <= span, "log": log, "top": top,
            }
            if first:
                row |= {"keys": table["key"].to_pylist(), "candidates": b"".join(table["candidate"].to_pylist())}
            return pa.table({c: pa.array([row[c]], kind) for c, kind in kinds.items()})

        entries = entries.withColumn("block", F.floor(F.col("at") / span))
        return entries.groupBy("tree", "block").applyInArrow(build, schema)

    def above(self, crown: DataFrame) -> DataFrame:
        """The lowest stage with the way from each builder's top to the root of all and the tree's
        root. crown: (tree, path, subroot): the way from a tree's root on."""
        span, expanded = ARITY**LEVELS, None

        def expand(batches):
            for batch in batches:
                for r in batch.to_pylist():
                    ways = paths(r["log"], builder_leaves(r["n"], r["block"]), levels_of(r["n"]))
                    upper = [(p["before"], p["after"]) for p in r["path"]]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([r["tree"]] * len(ways), pa.int64()),
                            pa.array(r["block"] * span + np.arange(len(ways))),
                            pa.array([[{"before": b, "after": a} for b, a in way + upper] for way in ways], to_arrow_type(path_type)),
                            pa.array([r["subroot"]] * len(ways), pa.string()),
                        ],
                        names=["tree", "block", "path", "subroot"],
                    )

        path_type = crown.schema["path"].dataType
        for i, stage in reversed(list(enumerate(self.stages))):
            ways = stage.where("single").select("tree", "block").join(crown, "tree")
            if expanded is not None:
                ways = ways.union(expanded)
            known = stage.join(ways, ["tree", "block"])
            if not i:
                return known
            known = known.select("tree", "block", "n", "log", "path", "subroot")
            expanded = known.mapInArrow(expand, f"tree long, block long, path {PATH}, subroot string")


def builder_leaves(n: int, block: int) -> int:
    return min(ARITY**LEVELS, n - block * ARITY**LEVELS)


# The manifest


def encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(encoded, values)).cast("binary"), 256))


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    key: str = "doc_id",
    group: str = "source",
    claimed: dict[str, Column] | None = None,
) -> DataFrame:
    """Per input row: key, leaf, subroot of its group's tree, root, proof_sha256, and whether the row
    as claimed, with the row's proof, gives the root: folded_root, verified.

    A leaf is the hash of the fields in their order, null as `-`, else byte count, `:`, value. Leaves
    of a group stand in order of key (null first), those of equal keys in order of their digests;
    groups in order of their bytes, null first, as a group of its own. claimed: other values of fields
    to check against the manifest; by default the row itself, which verifies. Equal rows are leaves
    of their own; other columns are not looked at; an empty table gives an empty result. Texts are
    hashed where they lie and do not travel.
    """
    claimed = claimed or {}
    leaves = docs.select(
        F.col(group).cast("string").alias("group"),
        F.col(key).alias("key"),
        leaf_digest([F.col(c) for c in fields]).alias("digest"),
        leaf_digest([claimed.get(c, F.col(c)) for c in fields]).alias("candidate"),
    )
    leaves = numbered(stored(leaves, "leaves"), ["group", "key", "digest", "candidate"], "ordered_leaves")
    groups = leaves.groupBy("group").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    groups = stored(numbered(groups, ["group"], "groups").withColumnRenamed("place", "tree"), "trees")
    named = groups.withColumnRenamed("group", "of")
    leaves = leaves.join(named, F.col("group").eqNullSafe(F.col("of"))).select(
        "tree", (F.col("place") - F.col("first")).alias("at"), "n", "digest", "key", "candidate"
    )
    trees = Trees(leaves, "tree")
    count = groups.count()
    subroots = stored(trees.roots, "subroots")
    crown = Trees(
        subroots.select(
            F.lit(0).cast("long").alias("tree"),
            F.col("tree").alias("at"),
            F.lit(count).cast("long").alias("n"),
            "digest",
            F.col("tree").alias("key"),
            F.col("digest").alias("candidate"),
        ),
        "crown",
    )
    top = crown.roots.first()  # one row: the root
    root = top["digest"].hex() if top else ""
    start = docs.sparkSession.range(1).select(
        F.lit(0).cast("long").alias("tree"), F.array().cast(PATH).alias("path"), F.lit(root).alias("subroot")
    )

    def ways_of_trees(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ways = paths(r["log"], builder_leaves(r["n"], r["block"]), levels_of(r["n"]))
                upper = [(p["before"], p["after"]) for p in r["path"]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(r["keys"], pa.int64()),
                        pa.array([[{"before": b, "after": a} for b, a in way + upper] for way in ways], to_arrow_type(path_type)),
                    ],
                    names=["tree", "path"],
                )

    path_type = start.schema["path"].dataType
    ways = crown.above(start).mapInArrow(ways_of_trees, f"tree long, path {PATH}")
    ways = ways.join(subroots, "tree").select("tree", "path", F.lower(F.hex("digest")).alias("subroot"))
    key_type = to_arrow_type(docs.schema[key].dataType)

    def prove(batches):
        for batch in batches:
            for r in batch.to_pylist():
                n, levels = builder_leaves(r["n"], r["block"]), levels_of(r["n"])
                upper = [(p["before"], p["after"]) for p in r["path"]]
                rest = "".join(b + a for b, a in upper)
                at = positions(n, levels)[0].tolist()
                tops: dict[str, str] = {}
                out = {"leaf": [], "proof": [], "folded": []}
                for i, way in enumerate(paths(r["log"], n, levels)):
                    claim = r["candidates"][SIZE * i : SIZE * (i + 1)].hex()
                    reached = fold(claim, way)
                    if reached not in tops:
                        tops[reached] = fold(reached, upper)
                    proof = "".join(b + a for b, a in way) + rest
                    out["leaf"].append(r["log"][SIZE * at[i] : SIZE * (at[i] + 1)].hex())
                    out["proof"].append(hashlib.sha256(proof.encode()).hexdigest())
                    out["folded"].append(tops[reached])
                text = pa.string()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(r["keys"], key_type),
                        pa.array(out["leaf"], text),
                        pa.array([r["subroot"]] * n, text),
                        pa.array([root] * n, text),
                        pa.array(out["proof"], text),
                        pa.array(out["folded"], text),
                        pa.array([f == root for f in out["folded"]]),
                    ],
                    names=[key, "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
                )

    schema = (
        f"`{key}` {docs.schema[key].dataType.simpleString()}, leaf string, subroot string, root string, "
        "proof_sha256 string, folded_root string, verified boolean"
    )
    return trees.above(ways).mapInArrow(prove, schema)
