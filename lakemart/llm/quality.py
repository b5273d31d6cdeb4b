"""Quality classifier by co-training: what a page says and what is known about it.

Two linear classifiers, one on the words and shape of the text, one on the metadata columns, are
fitted on a bounded sample of labelled rows. In each round either one labels all unlabelled rows it
is sure of for the other: the tasks count how often each feature goes with either pseudo-label, and
these sums, bounded by the number of features, choose the other one's features and are the prior of
its weights. Both are calibrated on labelled rows kept apart, and combined.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakemart.llm.common import RangeHash, Words, as_bytes, slices, stored

FEATURE_BITS = 20
PREFIXES = (4, 6)  # bytes of a word's beginning that are features, beside the whole word
SCORES = ("text_score", "meta_score", "score")
METADATA = ("lang", "source", "n_chars")
PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


@dataclass(frozen=True)
class Settings:
    """labelled: labelled rows that fitting may use at most, about; they are drawn by a hash of the
    key. The rest are usual values: rounds of exchange, how sure a pseudo-label has to be, how
    clearly a feature must go with the label, the most features of a view, and how far the weights
    begin at what the pseudo-labels say."""

    labelled: int = 6000
    rounds: int = 3
    prior: float = 0.2
    sure: float = 0.97
    least_z: float = 4.0
    most_features: int = 2000
    held_out: float = 0.25
    threshold: float = 0.5


def shape(text: bytes) -> list[str]:
    """How a text looks: signs, capitals, repeats, variety, word length, size. Each share gives a
    feature for every step it reaches, so near values have features in common."""
    if not text:
        return ["empty"]
    raw = np.frombuffer(text, np.uint8)
    words = text.split()
    small = raw | 32
    letters = (small >= 97) & (small <= 122)
    upper = letters & (raw < 97)
    digits = (raw >= 48) & (raw <= 57)
    signs = ~letters & ~digits & (raw > 32) & (raw < 128) & (raw != 44) & (raw != 46)
    n = max(len(words), 1)
    shares = {
        "signs": signs.sum() / n / 4,
        "upper": upper.sum() / max(int(letters.sum()), 1),
        "again": sum(map(bytes.__eq__, words, words[1:])) / n,
        "distinct": len(set(words)) / n,
        "length": len(raw) / n / 20,
        "size": n.bit_length() / 20,
    }
    return [f"{name}{k}" for name, x in shares.items() for k in range(1, min(int(20 * x), 20) + 1)]


def number(name: str) -> int:
    return xxhash.xxh64_intdigest(name) >> (64 - FEATURE_BITS)


def text_features(texts: list[bytes]):
    """(document, feature, count of its distinct words or 1) triples, as three arrays."""
    words = Words.of([b" ".join(x.translate(PLAIN).split()) for x in texts])
    of = np.repeat(np.arange(len(texts)), np.diff(words.first))
    hasher = RangeHash(words.buffer)
    whole = hasher(words.start, words.stop)
    _, at = np.unique(np.stack((of.astype(np.uint64), whole), 1).view("u8,u8").ravel(), return_index=True)
    of, start, stop = of[at], words.start[at], words.stop[at]
    parts = [whole[at]]
    for k, size in enumerate(PREFIXES):
        long = np.where(stop - start > size, start + size, stop)
        parts.append(hasher(start, long) ^ np.uint64(k + 1))
    docs = np.tile(of, len(parts))
    feature = (np.concatenate(parts) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)
    shapes = [(i, number(name)) for i, x in enumerate(texts) for name in shape(x)]
    docs = np.concatenate((docs, [i for i, _ in shapes])).astype(np.int64)
    feature = np.concatenate((feature, [f for _, f in shapes])).astype(np.int64)
    pairs, counts = np.unique(docs << FEATURE_BITS | feature, return_counts=True)
    return pairs >> FEATURE_BITS, pairs & ((1 << FEATURE_BITS) - 1), counts


def metadata(docs: DataFrame, columns) -> Column:
    """The metadata as words: names as they are, numbers by their size; absent columns are left out."""
    words = []
    for name in columns:
        if name not in docs.columns:
            continue
        kind = docs.schema[name].dataType.typeName()
        if kind in ("long", "integer", "double", "float", "short", "decimal"):
            size = F.floor(F.log2(F.greatest(F.col(name).cast("double"), F.lit(1.0))) * 2).cast("string")
        else:
            size = F.col(name).cast("string")
        words.append(F.concat(F.lit(f"{name}="), F.coalesce(size, F.lit("none"))))
    return F.array(*words).cast("array<string>")


def metadata_features(lists: list):
    found = [(i, number(w)) for i, x in enumerate(lists) for w in x or ()]
    docs, feature = (np.array([p[k] for p in found], np.int64) for k in (0, 1))
    return docs, feature, np.ones(len(found), np.int64)


@dataclass
class View:
    """A linear model over chosen features: column of each feature (-1: none), weights, bias, and
    the slope and shift of its calibration."""

    column: np.ndarray
    weights: np.ndarray
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    def entries(self, triples):
        """Row, column and value of the chosen features."""
        docs, feature, counts = triples
        at = self.column[feature]
        keep = at >= 0
        return docs[keep], at[keep], np.log1p(counts[keep].astype(float))

    def raw(self, n: int, triples) -> np.ndarray:
        docs, at, values = self.entries(triples)
        return np.bincount(docs, self.weights[at] * values, minlength=n) + self.bias

    def logit(self, n: int, triples) -> np.ndarray:
        return self.slope * self.raw(n, triples) + self.shift


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logistic(entries, columns: int, y: np.ndarray, prior=0.0, decay: float = 1e-3, steps: int = 200):
    """Weights and bias of a logistic model, by gradient steps with momentum and scaling.

    entries: row, column and value of what is not zero; y: the label of each row; prior: weights to
    begin at and to stay near.
    """
    rows, cols, values = entries
    w = np.append(np.zeros(columns) + prior, 0.0)
    first, second = np.zeros_like(w), np.zeros_like(w)
    for i in range(1, steps + 1):
        raw = np.bincount(rows, w[cols] * values, minlength=len(y)) + w[-1]
        error = (sigmoid(raw) - y) / len(y)
        gradient = np.append(np.bincount(cols, error[rows] * values, minlength=columns), error.sum())
        gradient[:-1] += decay * (w[:-1] - prior)
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        w -= 0.1 * (first / (1 - 0.9**i)) / (np.sqrt(second / (1 - 0.99**i)) + 1e-8)
    return w[:-1], float(w[-1])


def dense(x: np.ndarray):
    """All entries of a small matrix."""
    rows, cols = np.indices(x.shape)
    return rows.ravel(), cols.ravel(), x.ravel()


@dataclass
class Lesson:
    """What pseudo-labels tell a view: rows of each class, and of these the rows with each feature."""

    rows: np.ndarray
    have: np.ndarray

    @classmethod
    def none(cls) -> Lesson:
        return cls(np.zeros(2, np.int64), np.zeros((2, 1 << FEATURE_BITS), np.int64))

    def add(self, docs: np.ndarray, feature: np.ndarray, label: np.ndarray) -> None:
        """label: 1, 0 or -1 (not sure) of each row."""
        for k in (0, 1):
            self.rows[k] += int((label == k).sum())
            self.have[k] += np.bincount(feature[label[docs] == k], minlength=1 << FEATURE_BITS)


def pseudo_labels(logits: np.ndarray, sure: float) -> np.ndarray:
    p = sigmoid(logits)
    return np.where(p >= sure, 1, np.where(p <= 1 - sure, 0, -1))


def teach(lessons: list[Lesson], views: list[View], n: int, triples: list, asked: np.ndarray, sure: float) -> None:
    """Add n rows to the lessons: each view learns what the other is sure of, of the rows asked."""
    for k in (0, 1):
        label = np.where(asked, pseudo_labels(views[1 - k].logit(n, triples[1 - k]), sure), -1)
        lessons[k].add(triples[k][0], triples[k][1], label)


def fit_view(n: int, triples, rows: np.ndarray, y: np.ndarray, options: Settings, lesson: Lesson | None = None) -> View:
    """Choose features that go with the label, or pseudo-label, beyond chance, then fit on the given
    rows, from weights that the pseudo-labels give."""
    docs, feature, _ = triples
    lesson = lesson or Lesson.none()
    label = np.full(n, -1, np.int8)
    label[rows] = y
    total = [max(int((y == k).sum()) + int(lesson.rows[k]), 1) for k in (0, 1)]
    have = [np.bincount(feature[label[docs] == k], minlength=1 << FEATURE_BITS) + lesson.have[k] for k in (0, 1)]
    share = (have[0] + have[1]) / (total[0] + total[1])
    spread = np.sqrt(share * (1 - share) * (1 / total[0] + 1 / total[1])) + 1e-12
    z = np.abs(have[1] / total[1] - have[0] / total[0]) / spread
    z[have[0] + have[1] < 4] = 0
    order = np.argsort(-z, kind="stable")[: options.most_features]
    chosen = order[z[order] >= options.least_z]
    column = np.full(1 << FEATURE_BITS, -1, np.int32)
    column[chosen] = np.arange(len(chosen))
    view = View(column, np.zeros(len(chosen)))
    at, cols, values = view.entries(triples)
    place = np.full(n, -1)
    place[rows] = np.arange(len(rows))
    keep = place[at] >= 0
    entries = place[at[keep]], cols[keep], values[keep]
    good, bad = ((lesson.have[k][chosen] + 1) / (lesson.rows[k] + 2) for k in (1, 0))
    prior = options.prior * np.log(good / bad) if lesson.rows.all() else 0.0
    view.weights, view.bias = logistic(entries, len(chosen), y.astype(float), prior)
    return view


def calibrate(view: View, n: int, triples, rows: np.ndarray, y: np.ndarray) -> None:
    """Slope and shift that make the view's logits probabilities on rows it was not fitted on."""
    slope, shift = logistic(dense(view.raw(n, triples)[rows, None]), 1, y.astype(float))
    view.slope, view.shift = max(float(slope[0]), 0.0), shift


@dataclass
class Model:
    """Both views and how they are combined: logit = blend . (text, metadata) + bias."""

    text: View | None = None
    meta: View | None = None
    blend: np.ndarray = field(default_factory=lambda: np.zeros(2))
    bias: float = 30.0


def co_train(
    triples: list,
    label: np.ndarray,
    options: Settings,
    lessons_of: Callable[[list[View]], list[Lesson]] | None = None,
) -> Model:
    """triples: of the text and of the metadata; label: 1 good, 0 bad, -1 unknown, one per row;
    without rows of both classes, all is good. lessons_of: what the views say of all unlabelled rows;
    by default of the rows given without a label."""
    n = len(label)
    known = np.flatnonzero(label >= 0)
    if len(np.unique(label[known])) < 2:
        return Model()
    # Every fourth known row is kept apart for calibration, by class, so both have some.
    apart = np.zeros(n, bool)
    every = max(round(1 / options.held_out), 2)
    for k in (0, 1):
        apart[known[label[known] == k][every - 1 :: every]] = True
    if len(np.unique(label[apart])) < 2:
        apart[known] = True
    held = np.flatnonzero(apart)
    base = known[~apart[known]] if (~apart[known]).any() else known

    def of_rows_given(views: list[View]) -> list[Lesson]:
        lessons = [Lesson.none(), Lesson.none()]
        teach(lessons, views, n, triples, label < 0, options.sure)
        return lessons

    lessons: list = [None, None]
    views: list[View] = []
    for turn in range(options.rounds + 1):
        if turn:
            lessons = (lessons_of or of_rows_given)(views)
        views = []
        for k in (0, 1):
            view = fit_view(n, triples[k], base, label[base], options, lessons[k])
            calibrate(view, n, triples[k], held, label[held])
            views.append(view)
    logits = np.stack([v.logit(n, t) for v, t in zip(views, triples, strict=True)], 1)
    blend, bias = logistic(dense(logits[held]), 2, label[held].astype(float))
    return Model(views[0], views[1], np.maximum(blend, 0), bias)


def feature_rows(rows: DataFrame) -> DataFrame:
    """(id, label, meta, feature, counts) of rows (id, label, meta, body): the text's features as
    packed arrays."""

    def extract(batches):
        for batch in batches:
            texts = [x or b"" for x in as_bytes(batch.column("body"))]
            for a, b in slices(texts):
                docs, feature, counts = text_features(texts[a:b])
                bounds = np.searchsorted(docs, np.arange(b - a + 1))
                feature, counts = feature.astype("<i4"), np.minimum(counts, 255).astype(np.uint8)
                pairs = list(zip(bounds, bounds[1:], strict=False))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c)[a:b] for c in ("id", "label", "meta")],
                        pa.array([feature[i:j].tobytes() for i, j in pairs], pa.binary()),
                        pa.array([counts[i:j].tobytes() for i, j in pairs], pa.binary()),
                    ],
                    names=["id", "label", "meta", "feature", "counts"],
                )

    id_sql = rows.schema["id"].dataType.simpleString()
    schema = f"id {id_sql}, label int, meta array<string>, feature binary, counts binary"
    return rows.select("id", "label", "meta", "body").mapInArrow(extract, schema)


def triples_of(table) -> list:
    """The triples of the rows of an Arrow table or batch, as `feature_rows` gives them."""
    words = [np.frombuffer(x, "<i4") for x in table.column("feature").to_pylist()]
    counts = [np.frombuffer(x, np.uint8) for x in table.column("counts").to_pylist()]
    of = np.repeat(np.arange(len(words), dtype=np.int32), [len(x) for x in words])
    none = np.zeros(0, np.int32)
    text = of, np.concatenate([none, *words]), np.concatenate([none, *counts]).astype(np.uint8)
    return [text, metadata_features(table.column("meta").to_pylist())]


def lessons_of_all(features: DataFrame, views: list[View], options: Settings) -> list[Lesson]:
    """What the views say of all rows of features: sums taken in the tasks, one row per feature."""
    sent = features.sparkSession.sparkContext.broadcast(views)

    def count(batches):
        lessons = [Lesson.none(), Lesson.none()]
        for batch in batches:
            asked = np.ones(batch.num_rows, bool)
            teach(lessons, sent.value, batch.num_rows, triples_of(batch), asked, options.sure)
        for k, lesson in enumerate(lessons):
            some = np.flatnonzero(lesson.have.any(axis=0))
            # The rows of each class go as one more feature.
            number, have = np.append(some, -1), np.column_stack((lesson.have[:, some], lesson.rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(number), k, np.int32)), pa.array(number), pa.array(have[0]), pa.array(have[1])],
                names=["view", "feature", "bad", "good"],
            )

    schema = "view int, feature long, bad long, good long"
    sums = features.mapInArrow(count, schema)
    sums = sums.groupBy("view", "feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    # At most two views of 2^20 features each.
    table = sums.toArrow()
    lessons = [Lesson.none(), Lesson.none()]
    view, number, bad, good = (table.column(c).to_numpy() for c in ("view", "feature", "bad", "good"))
    for k, lesson in enumerate(lessons):
        of = (view == k) & (number >= 0)
        lesson.have[0, number[of]], lesson.have[1, number[of]] = bad[of], good[of]
        rows = (view == k) & (number < 0)
        lesson.rows[:] = bad[rows].sum(), good[rows].sum()
    return lessons


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    columns=METADATA,
    options: Settings | None = None,
) -> Model:
    """Fit on at most about options.labelled labelled documents, and on what the views say of all
    others, those with a label that was not drawn among them.

    A label is bad if quality is 0 or toxic is 1, good if quality is 1 and toxic is not 1; labels
    of the same document that differ count as bad; labels without a known quality are not used. Of
    labelled documents with the same key the one smallest by text and metadata is taken; each other
    row counts, those with a null key too.
    """
    options = options or Settings()
    bad = F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0))
    known = labels.where(F.col(key).isNotNull() & F.col("quality").isNotNull())
    known = known.groupBy(F.col(key).alias("id")).agg((1 - bad).alias("label"))
    share = min(1.0, options.labelled / max(known.count(), 1))
    place = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 20)) / (1 << 20)
    chosen = stored(known.where(place < share).coalesce(1), "labels")
    rows = docs.select(
        F.col(key).alias("id"),
        F.lit(None).cast("int").alias("label"),
        F.col(text).cast("string").alias("body"),
        metadata(docs, columns).alias("meta"),
    )
    # The chosen keys are bounded by the settings, whatever the tables hold.
    sample = rows.drop("label").join(F.broadcast(chosen), "id")
    first = Window.partitionBy("id").orderBy("body", "meta")
    sample = sample.withColumn("n", F.row_number().over(first)).where("n = 1").drop("n")
    table = feature_rows(sample).toArrow().sort_by("id")
    label = table.column("label").to_numpy().astype(int)
    if len(np.unique(label)) < 2:
        return Model()
    others = rows.join(F.broadcast(chosen.select("id")), "id", "left_anti")
    features = stored(feature_rows(others).select("meta", "feature", "counts"), "features")
    return co_train(
        triples_of(table), label, options, lambda views: lessons_of_all(features, views, options)
    )


def rated(docs: DataFrame, model: Model, names: list[str], text: str, columns) -> DataFrame:
    """The named columns as c0, c1, ..., then text_score, meta_score, score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    taken = docs.select(
        *[F.col(c).alias(f"c{i}") for i, c in enumerate(names)],
        F.col(text).cast("string").alias("body"),
        metadata(docs, columns).alias("meta"),
    )

    def rate(batches):
        model = sent.value
        for batch in batches:
            texts = [x or b"" for x in as_bytes(batch.column("body"))]
            out = np.ones((3, len(texts)))
            if model.text is not None:
                words = batch.column("meta").to_pylist()
                meta = model.meta.logit(len(texts), metadata_features(words))
                said = np.zeros(len(texts))
                for a, b in slices(texts):
                    said[a:b] = model.text.logit(b - a, text_features(texts[a:b]))
                both = model.blend[0] * said + model.blend[1] * meta + model.bias
                out = sigmoid(np.stack((said, meta, both)))
            kept = [c for c in batch.schema.names if c not in ("body", "meta")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], *[pa.array(x) for x in out]],
                names=[*kept, *SCORES],
            )

    schema = taken.drop("body", "meta").schema
    for name in SCORES:
        schema = schema.add(name, "double")
    return taken.mapInArrow(rate, schema)


def score(
    docs: DataFrame,
    model: Model,
    key: str = "doc_id",
    text: str = "text",
    columns=METADATA,
    threshold: float = 0.5,
) -> DataFrame:
    """Per input row: key, text_score, meta_score, score (probabilities of being good), keep.

    A null or empty text is scored by its emptiness; missing metadata is a value of its own;
    equal rows get equal scores; a null key is kept; an empty table gives an empty result.
    """
    out = rated(docs, model, [key], text, columns)
    return out.select(F.col("c0").alias(key), *SCORES, (F.col("score") >= threshold).alias("keep"))


def keep_good(
    docs: DataFrame, model: Model, text: str = "text", columns=METADATA, threshold: float = 0.5
) -> DataFrame:
    """The rows of docs whose score reaches the threshold, all columns."""
    out = rated(docs, model, docs.columns, text, columns).where(F.col("score") >= threshold)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def classify(docs: DataFrame, labels: DataFrame, options: Settings | None = None, **names) -> DataFrame:
    """`train` and `score` in one."""
    options = options or Settings()
    model = train(docs, labels, options=options, **names)
    return score(docs, model, threshold=options.threshold, **names)
