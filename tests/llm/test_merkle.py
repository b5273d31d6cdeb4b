import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemart.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    """All levels of a tree, by its definition."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i : i + 3])) for i in range(0, len(last), 3)])
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        run = i - i % 3
        out.append((level[run:i], level[i + 1 : run + 3]))
        i //= 3
    return out


def brute_manifest(rows, change):
    """Rows (doc_id, source, lang, n_chars, text) to the rows of the manifest."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    first = lambda x: (x is not None, x if x is not None else 0)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        members = sorted(groups[g], key=lambda r: (first(r[0]), leaf_of(r)))
        trees[g] = (members, tree([leaf_of(r) for r in members]))
    crown = tree([trees[g][1][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        members, levels = trees[g]
        for i, row in enumerate(members):
            path = siblings(levels, i) + siblings(crown, k)
            folded = leaf_of(change(row))
            for before, after in path:
                folded = sha("".join([*before, folded, *after]))
            proof = sha("".join("".join(b + a) for b, a in path))
            root = crown[-1][0]
            out.append((row[0], leaf_of(row), levels[-1][0], root, proof, folded, folded == root))
    return sorted(out, key=repr)


def tampered(row):
    if row[0] is None or zlib.crc32(str(row[0]).encode()) % 2 or row[4] is None:
        return row
    return (*row[:4], row[4].replace("\n", ""))


def changed_text():
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


COLUMNS = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_trees_proofs_and_tampering(spark, rows, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    rng = np.random.default_rng(levels)
    data, at = [], 0
    for source, n in (("hot", 100), ("a", 1), ("b", 3), ("c", 4), (None, 9), ("é", 10), ("Z", 27), ("", 2), ("zz", 28)):
        for _ in range(n):
            text = "line\n" * int(rng.integers(0, 3)) + "é end"
            data.append((at, source, "en", len(text), text))
            at += 1
    data += [(None, "c", None, None, None), (7, "hot", "en", 1, "x\n"), (7, "hot", "en", 1, "x\n"), (None, None, "de", -5, "")]
    docs = spark.createDataFrame([(*r, "extra", 1) for r in data], COLUMNS + ", root string, tree int")
    got = rows(merkle.manifest(docs.repartition(5), claimed={"text": changed_text()}))
    assert got == brute_manifest(data, tampered)
    assert {r[-1] for r in got} == {True, False}
    assert all(r[-1] for r in merkle.manifest(docs).collect())


@pytest.mark.parametrize("n", [1, 2, 3, 4, 8, 9, 10, 26, 27, 28, 80, 81, 82, 200])
def test_positions_of_the_log(n):
    leaves = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
    levels = [[x.hex() for x in leaves]] and tree([x.hex() for x in leaves])
    log, top = merkle.append_log(leaves, merkle.height(n))
    assert merkle.height(n) == len(levels) - 1 and top.hex() == levels[-1][0]
    assert len(log) == 32 * sum(map(len, levels))
    for level, at in zip(levels, merkle.positions(n, merkle.height(n)), strict=True):
        assert level == [log[32 * p : 32 * p + 32].hex() for p in at.tolist()]


def test_one_row_and_no_row(spark, rows):
    one = spark.createDataFrame([(5, "s", "en", 1, "x" * 3_000_000 + "\n")], COLUMNS)
    ((key, leaf, subroot, root, proof, folded, verified),) = rows(merkle.manifest(one))
    assert key == 5 and leaf == subroot == root == folded and verified and proof == sha("")
    none = merkle.manifest(one.limit(0))
    assert none.count() == 0
    assert none.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_other_columns(spark, rows):
    docs = spark.createDataFrame([("k1", "g", 1.5), ("k0", "g", None)], "id string, part string, value double")
    got = rows(merkle.manifest(docs, fields=["id", "value"], key="id", group="part"), "id", "verified")
    assert got == [("k0", True), ("k1", True)]
