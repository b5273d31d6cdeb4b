import numpy as np
import pytest

from lakemart.llm import suffix_dedup as S


def brute_hits(texts, window, keep_first):
    """Per text a mask of the bytes covered by windows that start elsewhere (or earlier) too."""
    seen = {}
    for i, t in enumerate(texts):
        for p in range(len(t) - window + 1):
            seen.setdefault(t[p : p + window], []).append((i, p))
    masks = [np.zeros(len(t), bool) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for i, p in places[1:] if keep_first else places:
                masks[i][p : p + window] = True
    return masks


def brute_factors(text, stop, places, depth, sign):
    out = []
    for p in places:
        best = 0
        for q in places:
            if sign * q < sign * p:
                n = 0
                while n < depth and p + n < stop[p] and q + n < stop[q] and text[p + n] == text[q + n]:
                    n += 1
                best = max(best, n)
        out.append(best)
    return out


def random_texts(seed, alphabet=b"ab", n=14):
    rng = np.random.default_rng(seed)
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(int(rng.integers(0, 5))):
            if texts and rng.random() < 0.6 and (t := texts[int(rng.integers(0, len(texts)))]):
                a = int(rng.integers(0, len(t)))
                parts.append(t[a : a + int(rng.integers(1, 60))])
            else:
                parts.append(bytes(rng.choice(list(alphabet), int(rng.integers(0, 40))).tolist()))
        texts.append(b"".join(parts))
    return texts


@pytest.mark.parametrize("alphabet, depth", [(b"ab", 23), (b"abcdefgh", 16), (b"a", 30), (bytes(range(97, 123)), 7), (b"ab", 14)])
def test_factor_arrays_equal_brute_force(alphabet, depth):
    text = b"".join(random_texts(1, alphabet, 8))
    cuts = sorted({len(text), *range(50, len(text), 70)})
    stop = np.concatenate([np.full(b - a, b) for a, b in zip([0, *cuts], cuts, strict=False)])
    places = np.flatnonzero(stop - np.arange(len(text)) >= depth)
    suffixes = S.Suffixes(np.frombuffer(text, np.uint8), stop, depth)
    earlier, later = S.factor_arrays(suffixes, places)
    assert earlier.tolist() == brute_factors(text, stop, places.tolist(), depth, 1)
    assert later.tolist() == brute_factors(text, stop, places.tolist(), depth, -1)
    assert S.full_factors(suffixes, places)[0].tolist() == (earlier >= depth).tolist()
    assert S.full_factors(suffixes, places)[1].tolist() == (later >= depth).tolist()
    order = suffixes.order(places)[0].tolist()
    assert order == sorted(places.tolist(), key=lambda p: (text[p : p + depth], p))


def test_nearest_smaller():
    rng = np.random.default_rng(0)
    for values in (rng.permutation(300), np.arange(50), np.arange(50)[::-1], np.zeros(0, int)):
        wanted = [max((j for j in range(i) if values[j] < values[i]), default=-1) for i in range(len(values))]
        assert S.nearest_smaller(values).tolist() == wanted


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("most", [500, 0])
@pytest.mark.parametrize("alphabet", [b"ab", b"abcdefghij"])
def test_equals_brute_force(spark, monkeypatch, keep_first, most, alphabet):
    monkeypatch.setattr(S, "MOST_CONTEXTS", most)
    texts = random_texts(7, alphabet, 40)
    texts += [b"", texts[3], texts[3], b"ab" * 300, b"x" * 19, b"y" * 200, "é日本".encode() * 30, "é日本".encode() * 30]
    rows = [(i if i != 5 else None, t.decode(), 9) for i, t in enumerate(texts)] + [(None, None, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept int").coalesce(1)
    got = S.remove_copies(docs, window=20, keep_first=keep_first).collect()
    masks = brute_hits([t.encode() if t else b"" for _, t, _ in rows], 20, keep_first)
    wanted = []
    for (i, t, _), mask in zip(rows, masks, strict=True):
        body = np.frombuffer((t or "").encode(), np.uint8)
        spans = int((np.diff(mask.astype(int), prepend=0) == 1).sum())
        wanted.append((i, len(body), int(mask.sum()), spans, body[~mask].tobytes()))
    assert sorted(map(repr, ((r[0], r[1], r[2], r[3], bytes(r[4])) for r in got))) == sorted(map(repr, wanted))


def test_many_chunks_and_partitions(spark, monkeypatch):
    monkeypatch.setattr("lakemart.llm.common.CHUNK_BYTES", 100)
    texts = random_texts(9, b"abcd", 60)
    docs = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: bytes(r["kept"]) for r in S.remove_copies(docs.repartition(4), window=12, keep_first=False).collect()}
    masks = brute_hits(texts, 12, False)
    for i, (t, mask) in enumerate(zip(texts, masks, strict=True)):
        assert got[i] == np.frombuffer(t, np.uint8)[~mask].tobytes()


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert S.remove_copies(none).count() == 0
