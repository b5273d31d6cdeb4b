"""Language-model scoring: an interpolated modified Kneser-Ney model over pairs of words.

Pairs are counted by Spark: each task sends its distinct pairs, grouped by their first word, to the
shard of that word. A shard stores its pairs as a sorted array of hashes with counts, in a file of
the shared folder. Workers map these files into memory and look up the sorted hashes of a batch of
documents; no worker loads the model, and what it gathers grows with the corpus, shard by shard.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lakemart.llm.common import (
    RangeHash,
    Words,
    as_bytes,
    mixed,
    plain_line,
    shuffle_partitions,
    slices,
    stored,
)
from lakemart.llm.shared_files import map_arrays, write_arrays
from lakemart.session import scratch_path

SLICE_BYTES = 4 << 20
# Hashes of what is no word: the end of a text, which is a token, and its beginning, which is not.
END, START, FIRST_WORD = np.uint64(1 << 16), np.uint64(2 << 16), np.uint64(3 << 16)
ALL_WORDS = np.uint64(0)  # what the number of all pairs is counted under
LOW = np.uint64(16)  # second words are known by the upper 48 bits of their hashes
OPEN_FILES = 400  # mapped files that a task keeps open
WORD_SHARE = 8  # shards of pairs for one shard of words, which are far fewer
HEAVY_SHARE = 1e-3  # first words at least this frequent are spread over all shards
PAIR_FILE = ["<u8", "u1", "<u8", "<u8"]
WORD_FILE = ["<u8", "<u8", "<u8", "<u8", "<u8", "<u8"]


def pack(numbers: np.ndarray) -> bytes:
    """Small non-negative numbers below 2^32 as few bytes, by byte plane."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def tokens(lines: list[bytes]):
    """(context, token, document of each token): each word after the one before it or START, then
    END after the last."""
    words = Words.of(lines)
    hashes = RangeHash(words.buffer)(words.start, words.stop)
    hashes = np.where(hashes < FIRST_WORD, hashes + FIRST_WORD, hashes)
    counts = np.diff(words.first)
    of = np.repeat(np.arange(len(lines)), counts)
    at = np.arange(len(hashes)) + of
    token = np.full(len(hashes) + len(lines), END)
    context = np.full(len(hashes) + len(lines), START)
    token[at] = hashes
    context[at + 1] = hashes
    return context, token, np.repeat(np.arange(len(lines)), counts + 1)


def pair_hash(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mixed(context ^ mixed((token >> LOW) + np.uint64(0x51ED270B)))


def pair_shard(context, token, shards: int, heavy: np.ndarray) -> np.ndarray:
    """A pair lives with its first word; those of a heavy first word are spread by both."""
    spread = np.isin(context, heavy)
    by = np.where(spread, pair_hash(context, token), mixed(context))
    return (by >> np.uint64(20)) % np.uint64(shards)


def word_shard(word: np.ndarray, shards: int) -> np.ndarray:
    """By the upper 48 bits, so that a second word and the full hash meet."""
    return (mixed(word >> LOW) >> np.uint64(20)) % np.uint64(shards)


def runs(sorted_keys: np.ndarray) -> np.ndarray:
    new = np.ones(len(sorted_keys), bool)
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    return np.flatnonzero(new)


SENT = "shard int, firsts binary, sizes binary, high binary, low binary, counts binary"


def send_pairs(lines: list[bytes], shards: int, heavy: np.ndarray) -> pa.RecordBatch:
    """The distinct pairs of some texts, with counts, a row per shard, sorted by first word."""
    context, token, _ = tokens(lines)
    order = np.lexsort((token, context))
    c, t = context[order], token[order]
    new = np.ones(len(c), bool)
    new[1:] = (c[1:] != c[:-1]) | (t[1:] != t[:-1])
    at = np.flatnonzero(new)
    n, c, t = np.diff(np.append(at, len(c))), c[at], t[at]
    shard = pair_shard(c, t, shards, heavy)
    by = np.argsort(shard, kind="stable")
    bounds = np.searchsorted(shard[by], np.arange(shards + 1, dtype=np.uint64))
    rows = []
    for s in range(shards):
        of = by[bounds[s] : bounds[s + 1]]
        if len(of):
            first = runs(c[of])
            rows.append(
                (
                    s,
                    c[of][first].tobytes(),
                    pack(np.diff(np.append(first, len(of)))),
                    (t[of] >> np.uint64(32)).astype("<u4").tobytes(),
                    (t[of] >> LOW & np.uint64(0xFFFF)).astype("<u2").tobytes(),
                    pack(n[of]),
                )
            )
    columns = list(zip(*rows)) or [()] * 6
    kinds = (pa.int32(), *[pa.binary()] * 5)
    arrays = [pa.array(list(x), kind) for x, kind in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=["shard", "firsts", "sizes", "high", "low", "counts"])


def heavy_words(docs: DataFrame, text: str) -> np.ndarray:
    """First words of at least HEAVY_SHARE of all pairs of all documents, so 1 / HEAVY_SHARE at most.
    Only where pairs are kept depends on them, no count."""

    def count(batches):
        for batch in batches:
            lines = [plain_line(x, True) for x in as_bytes(batch.column("body"))]
            for a, b in slices(lines, SLICE_BYTES):
                context, _, _ = tokens(lines[a:b])
                words, n = np.unique(np.append(context, ALL_WORDS), return_counts=True)
                n[words == ALL_WORDS] = len(context)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words.view(np.int64)), pa.array(n, pa.int64())], names=["word", "n"]
                )

    found = docs.select(F.col(text).cast("string").alias("body")).mapInArrow(count, "word long, n long")
    counts = stored(found.groupBy("word").agg(F.sum("n").alias("n")), "first_words")
    everything = F.col("word") == int(ALL_WORDS)
    total = counts.where(everything).first()
    if total is None:
        return np.zeros(0, np.uint64)
    heavy = counts.where(~everything & (F.col("n") >= HEAVY_SHARE * total["n"])).toArrow()
    return np.sort(heavy.column("word").to_numpy().view(np.uint64))


@dataclass
class Model:
    """Where the files are, and the numbers that hold for all of them."""

    path: str
    shards: int
    word_shards: int
    heavy: np.ndarray
    tokens: int = 0
    words: int = 0
    documents: int = 0
    pairs: int = 0
    pair_discounts: tuple = (0.0, 0.0, 0.0)
    word_discounts: tuple = (0.0, 0.0, 0.0)
    word_rest: float = 0.0  # what the discounts of the lower order leave for all words alike


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the number of types seen 1, 2, 3, 4 times; where too few
    are seen to estimate one, half of the least count it is taken from."""
    n1, n2, n3, n4 = n
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    out = []
    for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
        d = k - (k + 1) * y * b / a if a else 0.5
        out.append(d if 0 < d < k else 0.5)
    return tuple(out)


def discount_of(counts: np.ndarray, d: tuple) -> np.ndarray:
    return np.asarray([0.0, *d])[np.minimum(counts, 3)]


def count(docs: DataFrame, text: str = "text", shards: int | None = None) -> Model:
    """Count all pairs of all given documents and store the model."""
    spark = docs.sparkSession
    shards = shards or 2 * shuffle_partitions(spark)
    word_shards = -(-shards // WORD_SHARE)
    path = scratch_path(spark, "model")
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    heavy = heavy_words(docs, text)

    def pairs(batches):
        for batch in batches:
            lines = [plain_line(x, True) for x in as_bytes(batch.column("body"))]
            for a, b in slices(lines, SLICE_BYTES):
                yield send_pairs(lines[a:b], shards, heavy)

    sent = docs.select(F.col(text).cast("string").alias("body")).mapInArrow(pairs, SENT)

    def store_pairs(key, table):
        rows = table.to_pylist()
        firsts = [np.repeat(np.frombuffer(r["firsts"], "<u8"), unpack(r["sizes"])) for r in rows]
        context = np.concatenate(firsts)
        high = np.concatenate([np.frombuffer(r["high"], "<u4") for r in rows]).astype(np.uint64)
        low = np.concatenate([np.frombuffer(r["low"], "<u2") for r in rows]).astype(np.uint64)
        token = high << np.uint64(32) | low << LOW
        n = np.concatenate([unpack(r["counts"]) for r in rows])
        order = np.lexsort((token, context))
        context, token, n = context[order], token[order], n[order]
        new = np.ones(len(n), bool)
        new[1:] = (context[1:] != context[:-1]) | (token[1:] != token[:-1])
        at = np.flatnonzero(new)
        n, context, token = np.add.reduceat(n, at), context[at], token[at]
        hashes = pair_hash(context, token)
        by = np.argsort(hashes)
        large = np.flatnonzero(n[by] > 254)
        small = np.minimum(n[by], 255).astype(np.uint8)
        shard = key[0].as_py()
        write_arrays(f"{path}/pairs-{shard}", [hashes[by], small, large.astype("<u8"), n[by][large].astype("<u8")])
        # What the first and the second words have gathered here, for the shards of words.
        first = runs(context)
        sums = [np.add.reduceat(x, first) for x in (n, n == 1, n == 2, n >= 3)]
        second, types = np.unique(token, return_counts=True)
        out = {c: [] for c in ("shard", "kind", "keys", "a", "b", "c", "d")}
        for kind, keys, values in ((0, context[first], sums), (1, second, [types])):
            to = word_shard(keys, word_shards)
            order = np.argsort(to, kind="stable")
            bounds = np.searchsorted(to[order], np.arange(word_shards + 1, dtype=np.uint64))
            for s in range(word_shards):
                of = order[bounds[s] : bounds[s + 1]]
                if len(of):
                    out["shard"].append(s)
                    out["kind"].append(kind)
                    out["keys"].append(keys[of].tobytes())
                    blobs = [pack64(x[of]) for x in values] + [None] * (4 - len(values))
                    for name, blob in zip("abcd", blobs, strict=True):
                        out[name].append(blob)
        out["shard"].append(-1 - shard)
        out["kind"].append(2)
        out["keys"].append(b"")
        out["a"].append(pack64(np.array([(n == k).sum() for k in (1, 2, 3, 4)] + [len(n)])))
        for name in "bcd":
            out[name].append(None)
        return pa.table(out, schema=GATHERED_ARROW)

    gathered = stored(sent.groupBy("shard").applyInArrow(store_pairs, GATHERED), "gathered")

    def store_words(key, table):
        rows = table.to_pylist()
        shard = rows[0]["shard"]
        parts = {k: [r for r in rows if r["kind"] == k] for k in (0, 1)}
        keys, sums = summed(parts[0], "abcd")
        seen, types = summed(parts[1], "a")
        types = types[0]
        # A second word is known by 48 bits: give its types to the word that begins with them.
        at = np.searchsorted(keys >> LOW, seen >> LOW)
        cont = np.zeros(len(keys), np.int64)
        found = at < len(keys)
        found[found] = keys[at[found]] >> LOW == seen[found] >> LOW
        cont[at[found]] = types[found]
        if (~found).any():  # the end of a text is no first word
            keys = np.concatenate((keys, np.full((~found).sum(), END)))
            cont = np.concatenate((cont, types[~found]))
            sums = [np.concatenate((x, np.zeros((~found).sum(), np.int64))) for x in sums]
            order = np.argsort(keys)
            keys, cont, sums = keys[order], cont[order], [x[order] for x in sums]
        write_arrays(f"{path}/words-{shard}", [keys, *[x.astype("<u8") for x in (sums[0], cont, *sums[1:])]])
        word = keys > START
        return pa.table(
            {
                "tokens": [int(sums[0][word].sum())],
                "words": [int(word.sum())],
                "documents": [int(sums[0][keys == START].sum())],
                **{f"n{k}": [int((cont == k).sum())] for k in (1, 2, 3, 4)},
                "n": [int((cont > 2).sum())],
                "pairs": [int(cont.sum())],
            }
        )

    totals = "tokens long, words long, documents long, n1 long, n2 long, n3 long, n4 long, n long, pairs long"
    of_words = gathered.where("kind < 2").groupBy("shard").applyInArrow(store_words, totals)
    total = of_words.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in of_words.columns]).first()
    counts = np.zeros(5, np.int64)
    for row in gathered.where("kind = 2").select("a").toLocalIterator():  # five numbers per shard
        counts += unpack64(row["a"])
    model = Model(path, shards, word_shards, heavy)
    if total["documents"]:
        model.documents = total["documents"]
        model.tokens = total["tokens"] + total["documents"]
        model.words = total["words"] + 1
        model.pairs = int(counts[4])
        model.pair_discounts = discounts(counts[:4].tolist())
        model.word_discounts = d = discounts([total[f"n{k}"] for k in (1, 2, 3, 4)])
        model.word_rest = d[0] * total["n1"] + d[1] * total["n2"] + d[2] * total["n"]
    return model


GATHERED = "shard int, kind int, keys binary, a binary, b binary, c binary, d binary"
GATHERED_ARROW = pa.schema(
    [("shard", pa.int32()), ("kind", pa.int32()), *[(c, pa.binary()) for c in ("keys", "a", "b", "c", "d")]]
)


def pack64(numbers: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack64(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


def summed(rows: list[dict], names: str):
    """Sorted distinct keys of the rows, and the sums of their values."""
    keys = np.concatenate([np.frombuffer(r["keys"], "<u8") for r in rows] or [np.zeros(0, np.uint64)])
    values = [np.concatenate([unpack64(r[c]) for r in rows] or [np.zeros(0, np.int64)]) for c in names]
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = runs(keys)
    if not len(at):
        return keys, values
    return keys[at], [np.add.reduceat(x[order], at) for x in values]


class Lookup:
    """Mapped files of a model, opened when first asked for; the OPEN_FILES last used stay open."""

    def __init__(self, model: Model):
        self.model, self.files = model, {}

    def opened(self, name: str, kinds: list[str]) -> list[np.ndarray]:
        found = self.files.pop(name, None)
        if found is None:
            try:
                found = map_arrays(f"{self.model.path}/{name}", kinds)
            except FileNotFoundError:  # no pair or word fell into this shard
                found = [np.zeros(0, kind) for kind in kinds]
        self.files[name] = found
        if len(self.files) > OPEN_FILES:
            del self.files[next(iter(self.files))]
        return found

    def by_shard(self, shard: np.ndarray, shards: int):
        order = np.argsort(shard, kind="stable")
        bounds = np.searchsorted(shard[order], np.arange(shards + 1, dtype=np.uint64))
        for s in range(shards):
            of = order[bounds[s] : bounds[s + 1]]
            if len(of):
                yield s, of

    def words(self, keys: np.ndarray) -> np.ndarray:
        """Rows: count, continuations, and followers seen once, twice, more often, by sorted key."""
        out = np.zeros((5, len(keys)), np.int64)
        for s, of in self.by_shard(word_shard(keys, self.model.word_shards), self.model.word_shards):
            known, *values = self.opened(f"words-{s}", WORD_FILE)
            at, found = positions(known, keys[of])
            for row, value in zip(out, values, strict=True):
                row[of[found]] = value[at]
        return out

    def pairs(self, context: np.ndarray, token: np.ndarray) -> np.ndarray:
        out = np.zeros(len(context), np.int64)
        hashes = pair_hash(context, token)
        shards = self.model.shards
        for s, of in self.by_shard(pair_shard(context, token, shards, self.model.heavy), shards):
            of = of[np.argsort(hashes[of])]
            known, small, large, size = self.opened(f"pairs-{s}", PAIR_FILE)
            at, found = positions(known, hashes[of])
            n = small[at].astype(np.int64)
            over = n == 255
            if over.any():
                n[over] = size[np.searchsorted(large, at[over])]
            out[of[found]] = n
        return out


def positions(known: np.ndarray, keys: np.ndarray):
    """Places of the keys that are known, and which they are."""
    at = np.searchsorted(known, keys)
    found = at < len(known)
    found[found] = known[at[found]] == keys[found]
    return at[found], found


def word_probability(model: Model, continuations: np.ndarray) -> np.ndarray:
    """The lower order: how many words a word follows, discounted; the rest is shared evenly by all
    words and one for the unknown."""
    if not model.pairs:
        return np.ones(len(continuations))
    own = np.maximum(continuations - discount_of(continuations, model.word_discounts), 0)
    return (own + model.word_rest / (model.words + 1)) / model.pairs


def score_lines(lines: list[bytes], lookup: Lookup):
    """(tokens, known tokens, base score, score) of each text."""
    model = lookup.model
    context, token, of = tokens(lines)
    words, place = np.unique(np.concatenate((context, token)), return_inverse=True)
    left, right = place[: len(context)], place[len(context) :]
    stats = lookup.words(words)
    stats[0, words == END] = model.documents
    pairs, of_pair = np.unique(left * len(words) + right, return_inverse=True)
    a, b = pairs // max(len(words), 1), pairs % max(len(words), 1)
    n = lookup.pairs(words[a], words[b])
    d = model.pair_discounts
    seen, _, once, twice, more = (x[a] for x in stats)
    lower = word_probability(model, stats[1])[b]
    rest = d[0] * once + d[1] * twice + d[2] * more
    higher = np.maximum(n - discount_of(n, d), 0) + rest * lower
    p = np.where(seen > 0, higher / np.maximum(seen, 1), lower)
    unigram = (stats[0][right] + 0.1) / (model.tokens + 0.1 * (model.words + 1))
    many = len(lines)
    return (
        np.bincount(of, minlength=many),
        np.bincount(of, stats[0][right] > 0, minlength=many).astype(np.int64),
        np.bincount(of, np.log10(unigram), minlength=many),
        np.bincount(of, np.log10(p)[of_pair], minlength=many),
    )


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per input row: key, n_tokens, n_known, train_tokens, base_score, score (both log10).

    A-Z are lower-cased; words are runs of anything but ASCII blanks; the end of a text is a token.
    A null or empty text is its end alone; unknown words have the probability of the unknown; a
    model of no documents gives score 0 to all. Keys may be null or repeat; other columns are not
    looked at; an empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    id_type = to_arrow_type(docs.schema[key].dataType)
    taken = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("body"))

    def rate(batches):
        lookup = Lookup(sent.value)
        for batch in batches:
            lines = [plain_line(x, True) for x in as_bytes(batch.column("body"))]
            for a, b in slices(lines, SLICE_BYTES):
                n, known, base, said = score_lines(lines[a:b], lookup)
                total = np.full(b - a, sent.value.tokens, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id")[a:b].cast(id_type), *[pa.array(x) for x in (n, known, total, base, said)]],
                    names=[key, "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    id_sql = docs.schema[key].dataType.simpleString()
    return taken.mapInArrow(
        rate,
        f"`{key}` {id_sql}, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
