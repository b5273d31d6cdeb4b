import re

import numpy as np

from lakemart.llm import secrets

KEY, VALUE = "AKIA" + "Q7" * 10, "aB3/" * 10
WEAK = "ASIA" + "X1" * 8
BASE = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}


def base_spans(text):
    """The base of the contract, word for word: match, then drop."""
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or "", re.ASCII):
            if {"assign": lambda m: len(m[2]) >= 6, "access": lambda m: len(m[0]) >= 20, "hex": lambda m: len(m[0]) >= 24}[kind](m):
                out.append((kind, m.start(), m.end()))
    return sorted(out)


def scan(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = secrets.secret_spans(docs.repartition(3), **options).collect()
    return {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in got}


def test_base_equals_plain_matching_on_random_texts(spark):
    rng = np.random.default_rng(11)
    parts = ["password", "Token", "api_key", "APIKEY", "=", ":", " ", "  ", '"', "'", "\n", "é", "😀", "abc", "12345", "deadbeef" * 3, "0" * 23, KEY, "AKIA", "secret=token:abcdefg", "x.y/z"]
    texts = ["".join(rng.choice(parts, int(rng.integers(0, 40)))) for _ in range(300)]
    texts += [None, "", "token=abcdef " * 3000, "𝔘𝔫𝔦 password=hunter22"]
    got = scan(spark, texts)
    strong = {i: sorted(s for s in spans if s[0] in BASE) for i, spans in got.items()}
    assert strong == {i: base_spans(t) for i, t in enumerate(texts)}


def test_weak_parts_count_only_beside_their_other_half(spark):
    texts = [
        f"id {KEY} value {VALUE} at https://api.example.com/v1",
        f"value {VALUE} at https://api.example.com/v1",
        f"id {KEY} at https://api.example.com/v1",
        f"id {KEY} " + "word " * 100 + VALUE,
        f"id {WEAK} value {VALUE}",
        f"id {WEAK} alone",
        f"id {WEAK} token={VALUE}",
        f"{VALUE} {KEY}",
    ]
    kinds = {i: [s[0] for s in spans] for i, spans in scan(spark, texts).items()}
    assert kinds == {
        0: ["access", "value", "endpoint"],
        1: [],
        2: ["access"],
        3: ["access"],
        4: ["identifier", "value"],
        5: [],
        6: ["identifier", "assign"],
        7: ["value", "access"],
    }
    assert [s[0] for s in scan(spark, texts, scope=2000)[3]] == ["access", "value"]


def test_redaction_keeps_rows_columns_and_other_texts(spark, rows):
    clean = "nothing here"
    texts = [clean, f"é password={'ab12' * 8}!", f"{KEY} and {KEY}", None, "", f"x token={KEY}"]
    docs = spark.createDataFrame([(i if i != 1 else None, t, 7, "c0") for i, t in enumerate(texts)], "doc_id long, text string, n_chars long, row string")
    docs = docs.union(docs.limit(1))
    out = secrets.redacted(docs, size="n_chars")
    assert out.columns == docs.columns
    assert rows(out, "text", "n_chars") == sorted(
        [(clean, 7), (clean, 7), ("é [SECRET]!", 11), ("[SECRET] and [SECRET]", 21), (None, 7), ("", 7), ("x [SECRET]", 10)], key=repr
    )
    assert secrets.redacted(docs.limit(0)).count() == 0
    assert secrets.secret_spans(docs.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "token=abcdef")], "doc_id long, text string")
    for out in (secrets.secret_spans(docs), secrets.redacted(docs)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
