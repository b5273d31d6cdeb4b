"""Packing: documents as token ids, cut to pieces, packed first-fit decreasing into sequences.

Documents are dealt at random into groups of a few thousand, each packed on its own, so no task
depends on the size of the corpus. The first bin with room is found in a tournament tree of bin
capacities.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import as_bytes, slices
from lakemart.llm.tokens import SharedEncoder

LENGTH = 4096
END_ID = 2
GROUP_DOCS = 4000
PIECES_TOGETHER = 1000  # pieces of one long document that go to the same group


def pieces(
    docs: DataFrame,
    tokenizer_path: str,
    length: int = LENGTH,
    end_id: int = END_ID,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Token ids of every text, cut to pieces of at most `length`: (row, key, start, length, ids,
    doc_tokens); ids are little-endian unsigned 32-bit numbers. Every document ends with end_id, so
    a null or empty text is one piece of one id."""
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(SharedEncoder(f.read()))
    taken = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("id"),
        F.col(text).cast("string").alias("body"),
    )

    def cut(batches):
        encoder = shared.value.get()
        for batch in batches:
            texts = [x or b"" for x in as_bytes(batch.column("body"))]
            for a, b in slices(texts):
                ids, counts = encoder.encode(texts[a:b])
                ids = ids.astype("<u4").tobytes()
                end = np.array([end_id], "<u4").tobytes()
                of, start, size, data = [], [], [], []
                at = 0
                for i, n in enumerate(counts.tolist()):
                    whole = ids[4 * at : 4 * (at + n)] + end
                    at += n
                    for s in range(0, n + 1, length):
                        of.append(i)
                        start.append(s)
                        data.append(whole[4 * s : 4 * (s + length)])
                        size.append(len(data[-1]) // 4)
                rows = pa.array(np.array(of, np.int64) + a)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").take(rows),
                        batch.column("id").take(rows),
                        pa.array(start, pa.int64()),
                        pa.array(size, pa.int64()),
                        pa.array(data, pa.binary()),
                        pa.array(counts[of] + 1, pa.int64()),
                    ],
                    names=["row", key, "start", "length", "ids", "doc_tokens"],
                )

    id_sql = docs.schema[key].dataType.simpleString()
    schema = f"row long, `{key}` {id_sql}, start long, length long, ids binary, doc_tokens long"
    return taken.mapInArrow(cut, schema)


def first_fit(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each size, in the given order: the first bin with room.

    A tournament tree holds the most room below each node; there are as many bins as sizes, so
    there is always one.
    """
    leaves = 1
    while leaves < len(sizes):
        leaves *= 2
    room = [capacity] * (2 * leaves)
    out = []
    for size in sizes:
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        out.append(node - leaves)
        room[node] -= size
        node //= 2
        while node:
            most = max(room[2 * node], room[2 * node + 1])
            if room[node] == most:
                break
            room[node] = most
            node //= 2
    return out


def pack(
    parts: DataFrame, documents: int, length: int = LENGTH, group_docs: int = GROUP_DOCS
) -> DataFrame:
    """The pieces with sequence_id and offset; whatever other columns they have stay.

    documents: how many documents there are, for the number of groups. The group of a document is
    drawn from a hash of its row number, so equal or very long documents do not gather in one.
    """
    groups = max(1, -(-documents // group_docs))
    block = F.floor(F.col("start") / (length * PIECES_TOGETHER))
    dealt = parts.withColumn("group", F.pmod(F.xxhash64("row", block), F.lit(groups)))

    def fill(table: pa.Table) -> pa.Table:
        size = table.column("length").to_numpy()
        # Largest first; ties in a fixed order, so that a repeated task gives the same sequences.
        order = np.lexsort((table.column("start").to_numpy(), table.column("row").to_numpy(), -size))
        bins = np.array(first_fit(size[order].tolist(), length), np.int64)
        by = np.argsort(bins, kind="stable")
        sizes = size[order][by]
        ends = np.cumsum(sizes)
        new = np.flatnonzero(np.diff(bins[by], prepend=-1))
        before = np.repeat((ends - sizes)[new], np.diff(np.append(new, len(by))))
        out = table.take(pa.array(order[by]))
        out = out.append_column("sequence_id", pa.array((table.column("group")[0].as_py() << 32) + bins[by]))
        return out.append_column("offset", pa.array(ends - sizes - before)).drop_columns(["group", "row"])

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema if f.name != "row"]
    return dealt.groupBy("group").applyInArrow(
        fill, ", ".join([*kept, "sequence_id long", "offset long"])
    )


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    length: int = LENGTH,
    end_id: int = END_ID,
    key: str = "doc_id",
    text: str = "text",
    ids: bool = True,
) -> DataFrame:
    """Per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset, and its ids unless
    they are not wanted.

    Every id of every document, its end id included, lies in exactly one piece; null keys and
    repeated rows are documents of their own; other columns are not looked at; an empty table
    gives an empty result.
    """
    parts = pieces(docs, tokenizer_path, length, end_id, key, text)
    parts = parts.withColumn("ids_crc32", F.crc32("ids"))
    if not ids:
        parts = parts.drop("ids")
    return pack(parts, docs.count(), length)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the pieces of each sequence joined in order of offset."""
    lists = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("x"))
    joined = F.aggregate("x", F.unhex(F.lit("")), lambda a, x: F.concat(a, x["ids"]))
    return lists.select("sequence_id", joined.alias("ids"))
