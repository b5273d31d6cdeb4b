import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from lakemart.llm import language_model
from lakemart.llm.shared_files import map_arrays, write_arrays


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    return [w for w in lowered.split(" ") if w] + ["</s>"]


class Brute:
    """The same model with dictionaries."""

    def __init__(self, texts):
        self.unigram, self.pairs = Counter(), Counter()
        for t in texts:
            ws = words_of(t)
            self.unigram.update(ws)
            self.pairs.update(zip(["<s>", *ws], ws, strict=False))
        self.total, self.v = sum(self.unigram.values()), len(self.unigram)
        self.context, self.follow, self.cont = Counter(), defaultdict(Counter), Counter()
        for (a, b), n in self.pairs.items():
            self.context[a] += n
            self.follow[a][min(n, 3)] += 1
            self.cont[b] += 1
        self.d = self.estimate(self.pairs.values())
        self.e = self.estimate(self.cont.values())
        self.rest = sum(self.e[min(n, 3) - 1] for n in self.cont.values())

    @staticmethod
    def estimate(values):
        n = [0] + [sum(1 for x in values if x == k) for k in (1, 2, 3, 4)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
        out = [k - (k + 1) * y * n[k + 1] / n[k] if n[k] else 0.5 for k in (1, 2, 3)]
        return [d if 0 < d < k else 0.5 for k, d in enumerate(out, 1)]

    def lower(self, w):
        c = self.cont[w]
        return (max(c - (self.e[min(c, 3) - 1] if c else 0), 0) + self.rest / (self.v + 1)) / len(self.pairs)

    def p(self, a, w):
        if not self.context[a]:
            return self.lower(w)
        n = self.pairs[a, w]
        rest = sum(self.d[k - 1] * m for k, m in self.follow[a].items())
        return (max(n - (self.d[min(n, 3) - 1] if n else 0), 0) + rest * self.lower(w)) / self.context[a]

    def score(self, text):
        ws = words_of(text)
        base = sum(math.log10((self.unigram[w] + 0.1) / (self.total + 0.1 * (self.v + 1))) for w in ws)
        said = sum(math.log10(self.p(a, w)) for a, w in zip(["<s>", *ws], ws, strict=False))
        return len(ws), sum(w in self.unigram for w in ws), self.total, base, said


def texts_of(seed, n, vocabulary=40):
    rng = np.random.default_rng(seed)
    ws = [f"W{i}é" if i % 5 == 0 else f"w{i}," for i in range(vocabulary)]
    return [" \n".join(rng.choice(ws, int(rng.integers(0, 60)), p=np.arange(1, vocabulary + 1) / sum(range(1, vocabulary + 1)))) for _ in range(n)]


@pytest.mark.parametrize("heavy_share", [1e-3, 0.05, 2.0])
def test_equals_a_model_of_dictionaries(spark, monkeypatch, heavy_share):
    monkeypatch.setattr(language_model, "HEAVY_SHARE", heavy_share)
    train = texts_of(1, 80) + [None, "", "solo", "many " * 400] + ["twice the same"] * 2
    test = texts_of(2, 20, 55) + train[-6:] + ["never seen words", None]
    docs = spark.createDataFrame([(t, 1) for t in train], "text string, n_tokens int").repartition(5)
    model = language_model.count(docs, shards=7)
    brute = Brute(train)
    asked = spark.createDataFrame([(i, t, 0) for i, t in enumerate(test)], "doc_id long, text string, score int")
    got = {r["doc_id"]: r for r in language_model.score(asked, model).collect()}
    for i, t in enumerate(test):
        n, known, total, base, said = brute.score(t)
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] == pytest.approx(said, rel=1e-9)


def test_heavy_words_are_those_of_all_documents(spark):
    """Words that only late documents have, or only the ends of long ones, are heavy as any other."""
    late = ["x " * 6000 + "end " * 3000, *["frequent " * 40] * 300]
    texts = ["early words alone"] * 2500 + late + [f"rare{i}" for i in range(200)] + [None]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    context, _, _ = language_model.tokens([b"early words alone x end frequent"])
    heavy = language_model.heavy_words(docs, "text")
    assert heavy.tolist() == sorted(context.tolist())


def test_probabilities_sum_to_one():
    brute = Brute(texts_of(4, 50))
    for a in ("<s>", *list(brute.unigram)[:10], "unknown"):
        assert sum(brute.p(a, w) for w in (*brute.unigram, "<unk>")) == pytest.approx(1)


def test_no_training_text_and_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    model = language_model.count(none)
    docs = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in language_model.score(docs, model).collect()}
    assert got[1]["n_tokens"] == 3 and got[1]["n_known"] == 0 and got[1]["score"] == 0
    assert got[None]["n_tokens"] == 1
    assert language_model.score(none, model).count() == 0


def test_mapped_arrays(tmp_path):
    arrays = [np.arange(5, dtype="<u8"), np.arange(3, dtype="u1"), np.zeros(0, "<u8"), np.arange(2, dtype="<u8")]
    for uri in (f"{tmp_path}/a/x", f"file:{tmp_path}/a/x", f"file://{tmp_path}/a/x"):
        write_arrays(uri, arrays)
        for a, b in zip(arrays, map_arrays(uri, ["<u8", "u1", "<u8", "<u8"]), strict=True):
            assert a.tolist() == b.tolist()
    assert [p.name for p in (tmp_path / "a").iterdir()] == ["x"]
