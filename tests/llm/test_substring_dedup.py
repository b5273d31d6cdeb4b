import numpy as np
import pytest

from lakemart.llm import substring_dedup
from lakemart.llm.common import Words, packed


def words_of(text):
    for c in "\t\n\x0b\x0c\r":
        text = (text or "").replace(c, " ")
    return [w for w in text.split(" ") if w]


def brute(texts, window):
    lists = [words_of(t) for t in texts]
    seen = {}
    for i, ws in enumerate(lists):
        for p in range(len(ws) - window + 1):
            seen.setdefault(tuple(ws[p : p + window]), []).append((i, p))
    masks = [np.zeros(len(ws), bool) for ws in lists]
    for places in seen.values():
        if len(places) > 1:
            for i, p in places:
                masks[i][p : p + window] = True
    return [(len(ws), int(m.sum()), " ".join(w for w, gone in zip(ws, m, strict=True) if not gone)) for ws, m in zip(lists, masks, strict=True)]


def random_texts(seed, n=40):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}é" for i in range(4)] + [" x", "B,", "b,"]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(int(rng.integers(0, 4))):
            if texts and rng.random() < 0.6:
                ws = words_of(texts[int(rng.integers(0, len(texts)))])
                a = int(rng.integers(0, len(ws) + 1))
                parts += ws[a : a + int(rng.integers(1, 40))]
            else:
                parts += list(rng.choice(vocabulary, int(rng.integers(0, 25))))
        texts.append(" \n\t"[int(rng.integers(0, 3))].join(parts))
    return texts


@pytest.mark.parametrize("window, start", [(7, None), (7, 7), (7, 2), (12, 3), (1, None), (35, None)])
def test_equals_brute_force(spark, monkeypatch, window, start):
    monkeypatch.setattr("lakemart.llm.common.CHUNK_BYTES", 150)
    texts = random_texts(window) + [None, "", " \n ", "x", "a " * 50, "same same"]
    texts += texts[3:6] + ["long " * 20_000]
    rows = [(i if i != 4 else None, t, 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept int")
    got = substring_dedup.remove_repeats(docs.repartition(4), window, start).collect()
    wanted = [(i, *x) for (i, _, _), x in zip(rows, brute(texts, window), strict=True)]
    assert sorted(((r[0], r[1], r[2], r[4]) for r in got), key=repr) == sorted(wanted, key=repr)


def test_no_candidate_survives_a_level(spark):
    texts = ["a b c d e f g h", "a b c d x y z w"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    chunks = packed(docs, "doc_id", "text", True, "t")
    assert substring_dedup.repeated_windows(chunks, 8, 2).isEmpty()
    assert substring_dedup.levels(35, 18) == [18, 35]
    assert substring_dedup.levels(35, 9) == [9, 18, 35]


def test_levels_keep_every_repeated_window():
    """A full window whose text repeats always has an anchor that repeats."""
    words = Words.of([" ".join(np.random.default_rng(1).choice(list("abc"), 400)).encode() for _ in range(3)])
    hashes, least, at = substring_dedup.anchors(words, 4, 9)
    assert set(least[least > 0].tolist()) <= set(hashes[at].tolist())


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert substring_dedup.remove_repeats(none).count() == 0
