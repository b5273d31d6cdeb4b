import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lakemart.llm import spelling


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at:] == b[at + 1 :] or (len(a) == len(b) and a[at + 1 :] == b[at + 1 :])


def brute_groups(counts, times=2):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= times * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def brute_words(docs):
    out = []
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            out.append(run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run)
    return Counter(out)


def some_words(seed, n, letters="abé", lengths=(2, 9)):
    rng = np.random.default_rng(seed)
    words = {"".join(rng.choice(list(letters), int(rng.integers(*lengths)))) for _ in range(n)}
    return {w: int(2 ** rng.integers(0, 9)) for w in words}


@pytest.mark.parametrize("most, at_once, letters", [(20_000, 8192, "abé"), (7, 5, "abcd"), (3, 1, "ab"), (50, 64, "aÿ𝒳")])
def test_groups_equal_brute_force(spark, rows, monkeypatch, most, at_once, letters):
    monkeypatch.setattr(spelling, "MOST_OF_A_SHARE", most)
    monkeypatch.setattr(spelling, "QUERIES_AT_ONCE", at_once)
    counts = some_words(most, 220, letters) | {"xylophone": 3, "xylophones": 6, "xylophonest": 13, "zz": 1, "zzzzzz" * 40: 2}
    words = spark.createDataFrame([(w, n, "x") for w, n in counts.items()], "word string, n int, root string")
    got = rows(spelling.variant_groups(words.repartition(5)))
    assert got == brute_groups(counts)
    assert any(r[1] is not None and r[1] != r[2] for r in got)


def test_words_with_typos(spark, rows):
    rng = np.random.default_rng(1)
    vocabulary = list(some_words(3, 60, "abcdeÉß")) + ["MiXed", "don't", "x2y", "ÀÈ×÷ÿ"]
    docs = [(i, " ".join(rng.choice(vocabulary, 50))) for i in range(60)]
    docs += [(None, "Nothing is nothing"), (61, None), (62, ""), (63, "1 2 3 …"), (61, docs[0][1]), (64, "long" * 50_000)]
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, word string")
    counts = brute_words(docs)
    got = spelling.with_typos(frame).groupBy("word").count()
    assert dict(rows(got)) == counts
    kept = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    assert dict(rows(spelling.vocabulary(spelling.with_typos(frame)))) == kept
    assert rows(spelling.variant_groups(spelling.vocabulary(spelling.with_typos(frame)))) == brute_groups(kept)


def test_ties_take_the_first_and_need_twice_the_count(spark, rows):
    counts = {"color": 4, "colon": 8, "colos": 8, "colord": 7, "chain": 1, "chains": 2, "chainse": 4, "chainsex": 8}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r[0]: r[1:3] for r in rows(spelling.variant_groups(words))}
    assert got["color"] == ("colon", "colon") and got["colord"] == (None, "colord")
    assert got["chain"] == ("chains", "chainsex")
    assert rows(spelling.variant_groups(words)) == brute_groups(counts)


def test_no_words(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    out = spelling.variant_groups(spelling.vocabulary(spelling.with_typos(empty)))
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"] and out.count() == 0
