import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lakemart.llm import simhash
from lakemart.llm.components import components


def brute_print(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).split(" ") if text else []
    words = [w for x in words for w in x.replace("\n", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, radius):
    """The smallest id each one reaches, by search over all pairs."""
    ids = sorted(prints, key=lambda i: (i is None, i))
    out = {}
    for i in ids:
        if i in out:
            continue
        out[i], front = i, [i]
        while front:
            x = front.pop()
            for y in ids:
                if y not in out and (prints[x] ^ prints[y]).bit_count() <= radius:
                    out[y] = i
                    front.append(y)
    return out


def test_fingerprints_and_components_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = {}
    for i in range(90):
        if i % 3 and i > 3:
            words = texts[int(rng.integers(0, i))].split(" ")
            words[int(rng.integers(0, len(words)))] = "Changed"
        else:
            words = list(rng.choice(vocabulary, int(rng.integers(1, 120))))
        texts[i] = " ".join(words)
    texts |= {200: None, 201: "", 202: "  \n ", 203: "one", 204: "ONE", 205: "a b", 206: "x " * 30_000}
    docs = spark.createDataFrame([(i, t, "extra") for i, t in texts.items()], "doc_id long, text string, fingerprint string")
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs.repartition(5)).collect()}
    prints = {i: brute_print(t) for i, t in texts.items()}
    assert {i: r["fingerprint"] for i, r in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: r["component_id"] for i, r in got.items()} == brute_groups(prints, 2)


@pytest.mark.parametrize("tile, parts", [(4096, 4), (3, 4), (4096, 8), (2, 8)])
def test_links_of_all_pairs_whatever_the_tiles(spark, monkeypatch, tile, parts):
    monkeypatch.setattr(simhash, "TILE", tile)
    rng = np.random.default_rng(7)
    centres = rng.integers(0, 2**63, 12, dtype=np.int64)
    values = {0, -1, 1, 3, 7}
    for c in centres.tolist():
        x = c
        for _ in range(14):
            x ^= 1 << int(rng.integers(0, 63))
            values.add(x)
    prints = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    links = simhash.near_pairs(prints, 2, parts)
    got = {r["node"]: r["root"] for r in components(links).collect()}
    wanted = brute_groups({v: v % 2**64 for v in values}, 2)
    groups = {}
    for v, first in wanted.items():
        groups.setdefault(first, set()).add(v)
    found = {}
    for v in values:
        found.setdefault(got.get(v, v), set()).add(v)
    assert {frozenset(g) for g in groups.values()} == {frozenset(g) for g in found.values()}


def test_forest_keeps_connections_without_all_pairs():
    group = np.array([0, 1, 2, 4, 8, 16, 32, 64, 1 << 40], np.uint64)
    both, found = simhash.tree_links(group, None, 2)
    assert len(found) == len(group) - 1
    both, found = simhash.tree_links(group[:4], group[4:], 2)
    assert len({x for pair in found for x in pair}) == len(group)


def test_a_long_chain_is_one_component(spark):
    links = spark.range(400).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    roots = {r["root"] for r in components(links).collect()}
    assert len(roots) == 1
    assert components(links.limit(0)).count() == 0


def test_null_keys_repeated_rows_and_empty_tables(spark, rows):
    text = " ".join(f"t{i}" for i in range(50))
    schema = "doc_id long, text string, root string"
    docs = spark.createDataFrame([(None, text, "p"), (4, text, "q"), (4, text, "q"), (None, "only one", "r")], schema)
    got = rows(simhash.near_duplicates(docs), "doc_id", "component_id")
    assert got == sorted([(None, 4), (4, 4), (4, 4), (None, None)], key=repr)
    assert rows(simhash.one_per_group(docs)) == sorted([(4, text, "q"), (None, "only one", "r")], key=repr)
    clashing = docs.selectExpr("doc_id", "text", "root as id", "1 as text_hash", "2 as kept_id", "3 as c0")
    assert rows(simhash.one_per_group(clashing)) == sorted([(4, text, "q", 1, 2, 3), (None, "only one", "r", 1, 2, 3)], key=repr)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.one_per_group(docs.limit(0)).count() == 0


@pytest.mark.parametrize("parts", [1, 3, 5])
def test_which_of_equal_rows_stays_does_not_depend_on_their_order(spark, rows, parts):
    docs = [(1, "same text here", i, None if i == 2 else f"s{i}") for i in (4, 2, 3, 2, 5, 6)] + [(0, "other words", 1, "z")]
    docs = spark.createDataFrame(docs, "doc_id long, text string, n int, s string")
    docs = docs.withColumn("m", F.create_map(F.lit("k"), F.col("n"))).withColumn("v", F.parse_json(F.to_json(F.struct("n"))))
    kept = simhash.one_per_group(docs.repartition(parts))
    assert kept.columns == docs.columns
    assert rows(kept, "doc_id", "n", "s") == [(0, 1, "z"), (1, 2, None)]
