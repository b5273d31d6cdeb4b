import re

import numpy as np
import pytest

from lakemart.llm import decontaminate

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(text, items, window=10):
    words, hit, ids = words_of(text), set(), set()
    for item_id, item in items:
        parts = words_of(item)
        n = min(window, len(parts))
        for a in range(len(parts) - n + 1 if parts else 0):
            for p in range(len(words) - n + 1):
                if words[p : p + n] == parts[a : a + n]:
                    hit.update(range(p, p + n))
                    ids.add(str(item_id))
    return len(words), len(hit), sorted(ids), bool(hit)


@pytest.mark.parametrize("block_bytes", [8 << 20, 60])
def test_equals_brute_force_in_one_block_or_many(spark, block_bytes):
    rng = np.random.default_rng(3)
    vocabulary = ["Alpha", "beta", "gamma,", "é́te", "日本", "x9", "the", "of"]
    texts = [" ".join(rng.choice(vocabulary, int(rng.integers(0, 60)))) for _ in range(60)]
    items = [(i, " ".join(rng.choice(vocabulary, int(n)))) for i, n in enumerate([1, 2, 3, 4, 5, 6, 9, 10, 11, 14, 30])]
    items += [(50, None), (51, " .,; "), (52, items[9][1]), (52, items[9][1])]
    texts += [items[9][1] + "!", "so " + items[10][1].upper() + " end", None, "", "?", "the " * 40_000]
    schema = "doc_id long, text string, items string, n_words int"
    docs = spark.createDataFrame([(i if i else None, t, "x", 1) for i, t in enumerate(texts)], schema)
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.contamination(docs.repartition(3), bench, block_bytes=block_bytes)
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in out.collect()}
    assert got == {i if i else None: brute(t, items) for i, t in enumerate(texts)}


def test_no_items_no_documents_and_whole_rows(spark, rows):
    docs = spark.createDataFrame([(1, "a b c", "s"), (1, "a b c", "s"), (None, None, None)], "doc_id long, text string, found string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert rows(decontaminate.contamination(docs, none), "doc_id", "n_hit") == [(1, 0), (1, 0), (None, 0)]
    items = spark.createDataFrame([(None, "b c")], "item_id long, text string")
    assert rows(decontaminate.contamination(docs, items), "n_hit", "items") == [(0, []), (2, []), (2, [])]
    clean = decontaminate.uncontaminated(docs, items)
    assert clean.columns == docs.columns and rows(clean) == [(None, None, None)]
    assert decontaminate.contamination(docs.limit(0), items).count() == 0


def test_a_hot_text_a_long_item_and_shared_shingles(spark):
    rng = np.random.default_rng(7)
    long = " ".join(rng.choice(["a", "b", "c"], 12_000))
    parts = long.split()
    items = [(1, long), (2, "a a a a a a a a a a a a"), (3, "a b c a b c a b c a b c"), (4, "c"), (5, "q r s t u v")]
    texts = [" ".join(parts[5_000:5_030])] * 300 + ["a " * 50, "b a b c a b c a b c a b c b", "x q r s t u v x", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.contamination(docs, bench, block_bytes=1000).collect()
    want = {t: brute(t, items) for t in set(texts)}
    assert len(out) == len(texts)
    for r in out:
        assert (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) == want[texts[r["doc_id"]]]


def test_places_near_the_edges_have_no_room(spark):
    items = [(1, "one two three four five six seven eight nine ten")]
    texts = ["two three four five six seven eight nine ten", "one two three four five six seven eight nine",
             "x " + items[0][1], items[0][1] + " x", "one two three four five x six seven eight nine ten"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = decontaminate.contamination(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert {r["doc_id"]: r["n_hit"] for r in out.collect()} == {0: 0, 1: 0, 2: 10, 3: 10, 4: 0}
