"""The pipeline against a brute-force version of every stage on a small corpus."""

import re

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from llm.test_decontaminate import brute as leaks
from llm.test_secrets import base_spans
from llm.test_simhash import brute_groups, brute_print

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(12)
    vocabulary = [f"{a}{b}" for a in "bcdfghklmnprst" for b in ("ar", "en", "ol", "ut", "ish")]
    texts, bad = [], set()
    items = [" ".join(rng.choice(vocabulary, 14)) for _ in range(3)]
    for i in range(260):
        words = list(rng.choice(vocabulary, int(rng.integers(30, 120))))
        if i % 5 == 0:
            bad.add(i)
            words[4] = "vilething"
            words[9] = "vilething"
        elif i % 7 == 0:
            words[5:5] = items[i % 3].split()
        elif i % 11 == 0:
            words[3] = "password=hunter2secret"
        texts.append(" ".join(words))
    for i in range(1, 40, 3):  # copies and near copies of earlier documents
        if i % 5:
            words = texts[i].split()
            words.append("more")
            texts += [texts[i], " ".join(words)]
            bad |= {len(texts) - k for k in (1, 2) if "vilething" in texts[-k]}
    return texts, bad, items


def brute_pipeline(texts, bad, items):
    docs = {i: t for i, t in enumerate(texts) if i not in bad}
    groups = brute_groups({i: brute_print(t) for i, t in docs.items()}, 2)
    docs = {i: t for i, t in docs.items() if groups[i] == i}
    docs = {i: t for i, t in docs.items() if not leaks(t, list(enumerate(items)))[3]}
    masked = {}
    for i, t in docs.items():
        for _, a, b in reversed(base_spans(t)):
            t = t[:a] + "[SECRET]" + t[b:]
        masked[i] = t
    return masked


def test_pipeline_equals_brute_force(spark, tmp_path, corpus):
    texts, bad, items = corpus
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, int(i in bad)) for i in range(0, len(texts), 2)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    wanted = brute_pipeline(texts, bad, items)
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    whole = {}
    for r in sorted(packed, key=lambda r: (r["doc_id"], r["start"])):
        whole.setdefault(r["doc_id"], []).extend(np.frombuffer(r["ids"], "<u4").tolist())
    tokenizer = Tokenizer.from_file(corpus_pipeline.TOKENIZER)
    assert whole == {i: tokenizer.encode(t, add_special_tokens=False).ids + [2] for i, t in wanted.items()}
    assert any("[SECRET]" in t for t in wanted.values()) and len(wanted) < len(texts) / 2 + 100


def test_stages_keep_the_columns_of_documents(spark, tmp_path, corpus):
    texts, bad, items = corpus
    rows = [(i, t, "en", "s", len(t), "x", 1.5) for i, t in enumerate(texts[:60])]
    rows += [(None, None, None, None, None, None, None), (3, texts[3], "en", "s", 1, "x", 1.5)]
    docs = spark.createDataFrame(rows, SCHEMA + ", score string, c0 double")
    spark.createDataFrame([(0, 1, 1), (1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, items[0])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        assert out.count() > 0
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == len(rows)
    assert [name for name, _ in corpus_pipeline.STAGES] and re.match("quality", corpus_pipeline.STAGES[0][0])
