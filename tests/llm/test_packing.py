import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakemart.llm import packing
from lakemart.llm.tokens import WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", " \n\t ", "Plain words, and more. words", "a,b.c ,, d!! e%%% f.,", "don't we'll it's 'S x'",
    "É́tudes ŒUVRE İstanbul ΣΑΣ. Σ, ſ", "日本語 текст ١٢٣ 12345", "a b c\u0085d\x1ce", "😀👍🏽 x",
    "see <|endoftext|> and <|startoftext|>x <|ENDOFTEXT|> Mixed CASE.", "é É.", "word " * 9000, "x" * 50_000,
]


@pytest.fixture(scope="module")
def tools():
    with open(PATH, encoding="utf-8") as f:
        text = f.read()
    return WordEncoder(text), Tokenizer.from_str(text)


def test_ids_equal_the_library_on_odd_texts(tools):
    encoder, library = tools
    ids, counts = encoder.encode([(t or "").encode() for t in TEXTS])
    parts = np.split(ids, np.cumsum(counts)[:-1])
    for text, part in zip(TEXTS, parts, strict=True):
        assert part.tolist() == library.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=40), max_size=4))
def test_ids_equal_the_library_on_any_texts(tools, texts):
    encoder, library = tools
    ids, counts = encoder.encode([t.encode() for t in texts])
    assert ids.tolist() == [i for t in texts for i in library.encode(t, add_special_tokens=False).ids]
    assert len(counts) == len(texts)


def test_first_fit_is_first_fit():
    rng = np.random.default_rng(1)
    sizes = sorted(rng.integers(1, 100, 400).tolist(), reverse=True)
    room, wanted = [], []
    for size in sizes:
        at = next((i for i, r in enumerate(room) if r >= size), None)
        if at is None:
            at = len(room)
            room.append(100)
        room[at] -= size
        wanted.append(at)
    assert packing.first_fit(sizes, 100) == wanted
    assert packing.first_fit([100], 100) == [0]


@pytest.mark.parametrize("group_docs", [4000, 3])
def test_every_id_lies_in_one_piece_and_sequences_have_no_gaps(spark, group_docs, tools, monkeypatch):
    docs = spark.createDataFrame([(i if i else None, t, 1) for i, t in enumerate(TEXTS + TEXTS[3:6])], "doc_id long, text string, sequence_id int")
    parts = packing.pieces(docs.repartition(3), PATH)
    got = packing.pack(parts, docs.count(), group_docs=group_docs).collect()
    whole = {}
    for r in got:
        whole.setdefault(r["doc_id"], []).append(r)
    for i, text in enumerate(TEXTS + TEXTS[3:6]):
        rows = sorted(whole[i if i else None], key=lambda r: r["start"])
        data = b"".join(r["ids"] for r in rows)
        ids = tools[1].encode(text or "", add_special_tokens=False).ids + [2]
        assert np.frombuffer(data, "<u4").tolist() == ids
        assert [r["start"] for r in rows] == np.cumsum([0, *[r["length"] for r in rows]])[:-1].tolist()
        assert {r["doc_tokens"] for r in rows} == {len(ids)}
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for members in bins.values():
        members.sort()
        assert [o for o, _ in members] == np.cumsum([0, *[n for _, n in members]])[:-1].tolist()
        assert sum(n for _, n in members) <= 4096


def test_digests_sequences_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "d"), (2, "d")], "doc_id long, text string")
    packed = packing.pack_documents(docs, PATH)
    for r in packed.collect():
        assert r["ids_crc32"] == zlib.crc32(r["ids"])
    ids = np.frombuffer(packing.sequences(packed).collect()[0]["ids"], "<u4").tolist()
    assert len(ids) == 8 and ids.count(2) == 3
    assert "ids" not in packing.pack_documents(docs, PATH, ids=False).columns
    assert packing.pack_documents(docs.limit(0), PATH).count() == 0
