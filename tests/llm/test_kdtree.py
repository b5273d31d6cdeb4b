import math

import numpy as np
import pytest

from lakemart.llm import kdtree


def brute(rows, k, every):
    sound = [
        (i, [math.floor(64 * x) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, a in sound:
        if q % every:
            continue
        scores = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in sound if i != q and len(b) == len(a)]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("shard_rows, block, leaf", [(16_384, 4096, 512), (60, 3, 4), (1000, 5, 16)])
def test_equals_brute_force(spark, rows, monkeypatch, shard_rows, block, leaf):
    monkeypatch.setattr(kdtree, "LEAF", leaf)
    rng = np.random.default_rng(2)
    data = [(i, rng.normal(0, 1, 7).tolist()) for i in range(300)]
    data += [(i, data[0][1]) for i in range(300, 380)]
    data += [(400, [1.0, 2.0]), (401, [0.5, -1.0]), (405, [2.0, 2.0]), (410, []), (411, [])]
    data += [(500, None), (505, [None, 1.0]), (510, [float("nan")] * 7), (515, [float("inf")] * 7), (None, [1.0] * 7)]
    data += [(20, data[5][1]), (21, data[5][1]), (21, data[5][1])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in data], "vec_id long, embedding array<float>, score int")
    data = [(r["vec_id"], r["embedding"]) for r in frame.collect()]
    got = kdtree.top_k(frame.repartition(4), k=6, every=5, shard_rows=shard_rows, block_queries=block)
    assert rows(got, "query_id", "rank", "vec_id", "score") == sorted(brute(data, 6, 5), key=repr)


def test_boxes_bound_scores_and_pruning_prunes():
    rng = np.random.default_rng(4)
    centres = rng.integers(-1000, 1000, (20, 3))
    points = (centres[rng.integers(0, 20, 5000)] + rng.integers(-9, 9, (5000, 3))).astype(float)
    tree = kdtree.Tree(np.arange(5000), points)
    query = rng.integers(-50, 50, (4, 3)).astype(float)
    bounds = tree.bounds(query)
    for node, (_, _, a, b, _) in enumerate(tree.nodes):
        assert (bounds[:, node] >= (query @ tree.rows[a:b].T).max(axis=1)).all()
    high = np.sort(query @ points.T, axis=1)[:, -1]
    score, ids = tree.search(query, np.full(4, -1), high, 10)
    assert [s[0] for s in score] == high.tolist()


def test_empty_table(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert kdtree.top_k(none).count() == 0


def clustered(n, seed=9):
    """A third of the rows one vector, the others around 12 centres."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 8, (12, 5))
    rows = centres[rng.integers(0, 12, n)] + rng.normal(0, 0.3, (n, 5))
    rows[::3] = centres[0]
    return [(i, v.tolist()) for i, v in enumerate(rows)]


@pytest.mark.parametrize("sampled", [1 << 21, 600])
def test_regions_from_a_sample_and_a_hot_vector(spark, rows, monkeypatch, sampled):
    monkeypatch.setattr(kdtree, "SAMPLE_VALUES", sampled)
    monkeypatch.setattr(kdtree, "SAMPLE_ROWS", 8)
    data = clustered(900)
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(5)
    sent = []
    reach = kdtree.reachable
    monkeypatch.setattr(kdtree, "reachable", lambda q, boxes: sent.append((reach(q, boxes), len(boxes))) or sent[-1][0])
    got = kdtree.top_k(frame, k=4, every=10, shard_rows=50, block_queries=7)
    assert rows(got, "query_id", "rank", "vec_id", "score") == sorted(brute(data, 4, 10), key=repr)
    ((reached, regions),) = sent
    pairs = sum(len(r["regions"]) for r in reached.select("regions").collect())
    assert regions > 4 and pairs < 90 * regions / 2


def test_cuts_deal_every_row_to_one_region():
    data = np.array([v for _, v in clustered(600)])
    parts = kdtree.Cuts(data, 6000.0, 500)
    region = kdtree.region_of(data, parts.parts())
    assert set(region) == set(range(parts.regions)) and parts.regions > 4
    same = np.zeros((300, 2))
    assert kdtree.Cuts(same, 3e6, 10).regions == 1 and not kdtree.region_of(same, kdtree.Cuts(same, 3e6, 10).parts()).any()
    two = np.repeat([[1.0], [2.0]], [299, 1], axis=0)
    assert kdtree.Cuts(two, 300.0, 10).regions == 2


def test_blocks_of_queries_follow_the_regions():
    boxes = [{"dims": d, "region": r, "n": n, "asked": q} for d, r, n, q in
             [(2, 0, 10, 3), (2, 1, 10, 3), (2, 2, 100, 25), (2, 3, 5, 0), (2, 4, 10, 9), (3, 0, 1, 1)]]
    assert kdtree.plan_of(boxes, 50, 10) == [
        (2, 0, 1, 0, 1), (2, 1, 1, 0, 1), (2, 2, 2, 1, 3), (2, 3, 1, 3, 1), (2, 4, 1, 4, 1), (3, 0, 1, 0, 1)
    ]
