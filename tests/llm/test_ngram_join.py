import numpy as np
import pytest

from lakemart.llm import ngram_join


def brute_set(text, width=5):
    for blank in "\t\n\v\f\r":
        text = (text or "").replace(blank, " ")
    words = [w for w in text.translate({c: c + 32 for c in range(65, 91)}).split(" ") if w]
    if 0 < len(words) < width:
        return frozenset([" ".join(words)])
    return frozenset(" ".join(words[i : i + width]) for i in range(len(words) - width + 1))


def brute_join(rows, percent=80):
    """(key, set size, smallest key reached, links) of each row, by all pairs."""
    sets = [brute_set(t) for _, t in rows]
    links = {i: set() for i in range(len(rows))}
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]) and sets[j]:
                links[i].add(j)
                links[j].add(i)
    out, first = [], {}
    for i in range(len(rows)):
        seen, front = {i}, [i]
        while front:
            new = links[front.pop()] - seen
            seen |= new
            front += new
        keys = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], len(sets[i]), min(keys, default=None), len(links[i])))
    return sorted(out, key=repr)


def near_texts(seed, n):
    """Groups of near copies, with edits on both sides of the bound, chains and shared passages."""
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = list(rng.choice(vocabulary, 40))
    texts = []
    for i in range(n):
        kind = rng.integers(0, 10)
        if i > 5 and kind < 5:
            words = texts[int(rng.integers(0, i))].split(" ")
            for _ in range(int(rng.integers(0, 4))):
                words[int(rng.integers(0, len(words)))] = str(rng.choice(vocabulary))
            if kind == 0:
                words = words[: max(1, int(len(words) * rng.uniform(0.7, 1)))]
        elif kind < 8:
            words = list(rng.choice(vocabulary, int(rng.integers(1, 90))))
        else:
            words = passage + list(rng.choice(vocabulary, int(rng.integers(1, 20))))
        texts.append(" ".join(words))
    return texts


ODD = [
    (None, None), (900, None), (901, ""), (902, " \n\t "), (903, "One"), (904, "one"), (905, "a b c d"),
    (906, "A\vB\tc d"), (907, "a b c d e"), (905, "a b c d"), (None, "a b c d e"), (None, "no key at all here twice"),
    (None, "no key at all here twice"), (908, "word " * 40_000), (909, "x y z"), (910, "é É é É é É"),
]


@pytest.mark.parametrize("block, light, at_once", [(256, 32, 1 << 20), (3, 2, 7), (16, 10**9, 50), (5, 1, 9)])
def test_links_equal_brute_force(spark, rows, monkeypatch, block, light, at_once):
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", block)
    monkeypatch.setattr(ngram_join, "LIGHT", light)
    monkeypatch.setattr(ngram_join, "PAIRS_AT_ONCE", at_once)
    monkeypatch.setattr(ngram_join, "COLUMN_BLOCK", 16)
    data = list(enumerate(near_texts(block, 150))) + ODD
    docs = spark.createDataFrame([(i, t, "x", 5) for i, t in data], "doc_id long, text string, root string, n int")
    got = rows(ngram_join.jaccard_join(docs.repartition(6)))
    assert got == brute_join(data)
    assert any(links > 3 for *_, links in got)


def test_ties_at_the_bound(spark, rows):
    words = [f"t{i}" for i in range(54)]  # 50 shingles; an end word more or less changes one
    texts = [" ".join(words), " ".join(words[:44]), " ".join(words[:43])]  # 40 of 50, 39 of 50, 39 of 40
    got = rows(ngram_join.jaccard_join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    assert got == [(0, 50, 0, 1), (1, 40, 0, 2), (2, 39, 0, 1)]


def test_a_large_group_of_near_copies_leaves_no_pairs(spark, rows):
    base = [f"g{i}" for i in range(60)]
    texts = [" ".join([*base[:-1], f"end{i % 700}"]) for i in range(1400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert set(rows(ngram_join.jaccard_join(docs), "n_shingles", "component_id", "n_links")) == {(56, 0, 1399)}


def test_other_widths_keys_and_empty_tables(spark, rows):
    docs = spark.createDataFrame([("b", "x y z"), ("a", "x y z"), ("c", "x y q")], "page string, body string")
    got = rows(ngram_join.jaccard_join(docs, width=1, percent=50, key="page", text="body"))
    assert got == [("a", 3, "a", 2), ("b", 3, "a", 2), ("c", 3, "a", 2)]
    empty = ngram_join.jaccard_join(docs.limit(0), key="page", text="body")
    assert empty.columns == ["page", "n_shingles", "component_id", "n_links"] and empty.count() == 0
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert rows(ngram_join.jaccard_join(blank)) == [(1, 0, 1, 0), (2, 0, 2, 0)]
