"""Secret scans: strong patterns, and weak ones that count only beside their other half.

DataFrame functions alone. A pattern's matches and the pieces between them give the places; only
the lengths are kept, so texts are read once and are never shuffled to find spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import stored

# kind: (pattern, group whose length is tested, least length). Fixed values.
STRONG = {
    "assign": (
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    "access": (r"AKIA[A-Z0-9]{16,}", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
}
# Parts that mean little alone.
WEAK = {
    "identifier": (r"(ASIA|AIDA|AROA)[A-Z0-9]{12,}", 0, 16),
    "value": (r"[A-Za-z0-9/+]{40,}", 0, 40),
    "endpoint": (r"https?://[A-Za-z0-9.:/_-]+", 0, 10),
}
KINDS = [*STRONG, *WEAK]
# What each kind is a part of: a credential needs an identifier, a secret, and may name an endpoint.
ROLES = {"assign": "secret", "access": "identifier", "hex": "secret", "identifier": "identifier", "value": "secret", "endpoint": "endpoint"}
SCOPE = 200  # characters between parts of one credential
MASK = "[SECRET]"


def lengths(text: Column, kind: str) -> Column:
    """(gap before, length, length of the tested group) of each match, and the gap at the end."""
    pattern, group, _ = (STRONG | WEAK)[kind]
    size = lambda x: F.length(x)
    return F.arrays_zip(
        F.transform(F.split(text, pattern, -1), size).alias("gap"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), size).alias("size"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), size).alias("tested"),
    )


def scanned(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """Stored: a row number, the columns to keep as c0, c1, ..., and the match lengths by kind.

    Weak patterns are looked for only in texts that hold some identifier: without one, no weak
    part can be linked.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    named = body.contains("AKIA") | body.rlike(WEAK["identifier"][0])
    columns = [F.col(c).alias(f"c{i}") for i, c in enumerate(keep)]
    for kind in KINDS:
        looked = body.rlike((STRONG | WEAK)[kind][0])
        if kind in WEAK:
            looked = named & looked
        columns.append(F.when(looked, lengths(body, kind)).alias(f"found_{kind}"))
    return stored(docs.select(F.monotonically_increasing_id().alias("row"), *columns), "secrets")


def spans_of(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(row, kind, start, end) of all spans of `scanned`: the strong ones, and the weak linked ones.

    The interval join of the parts of a text runs as sweeps in order of place: the nearest end
    before and the nearest start after, by role, tell whether a complementary part lies within
    the scope. No pairs are made, however many parts a text has.
    """
    each = F.explode(
        F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(i).alias("rank"), F.col(f"found_{k}").alias("found")) for i, k in enumerate(KINDS)])
    )
    any_found = F.coalesce(*[F.col(f"found_{k}") for k in KINDS]).isNotNull()
    parts = found.where(any_found).select("row", each.alias("x")).where("x.found is not null")
    parts = parts.select("row", "x.kind", "x.rank", F.posexplode("x.found").alias("i", "m"))
    parts = parts.where("m.size is not null").repartition("row")
    so_far = Window.partitionBy("row", "kind").orderBy("i")
    end = F.sum(F.col("m.gap") + F.col("m.size")).over(so_far).cast("long")
    parts = parts.select("row", "kind", "rank", (end - F.col("m.size")).alias("start"), end.alias("end"), "m.tested")
    least = F.coalesce(*[F.when(F.col("kind") == k, least) for k, (_, _, least) in (STRONG | WEAK).items()])
    most = F.when(F.col("kind") == "value", 40).otherwise(2**31 - 1)
    parts = parts.where(F.col("tested").between(least, most))

    role = F.coalesce(*[F.when(F.col("kind") == k, F.lit(r)) for k, r in ROLES.items()])
    strong = F.col("kind").isin(*STRONG)
    order = ["start", "rank", "end"]
    before = Window.partitionBy("row").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("row").orderBy(*[F.desc(c) for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    tests = {r: F.col("role") == r for r in ("identifier", "secret")} | {"strong": strong}
    parts = parts.withColumn("role", role)
    parts = parts.select(
        "*",
        *[F.max(F.when(t, F.col("end"))).over(before).alias(f"{n}_end") for n, t in tests.items()],
        *[F.min(F.when(t, F.col("start"))).over(after).alias(f"{n}_start") for n, t in tests.items()],
    )

    def within(name: str, distance: int) -> Column:
        return F.coalesce(F.col("start") - F.col(f"{name}_end") <= distance, F.lit(False)) | F.coalesce(
            F.col(f"{name}_start") - F.col("end") <= distance, F.lit(False)
        )

    linked = (
        F.when(F.col("role") == "identifier", within("secret", scope))
        .when(F.col("role") == "secret", within("identifier", scope))
        .otherwise(within("identifier", scope) & within("secret", scope))
    )
    # A weak span that overlaps a strong one is the same thing seen twice.
    new = linked & ~within("strong", -1)
    return parts.where(strong | new).select("row", "kind", "rank", "start", "end")


def secret_spans(
    docs: DataFrame, scope: int = SCOPE, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per input row: key, spans: array of (start, rank, kind, end), sorted; places in characters,
    end exclusive; rank numbers the kinds.

    Strong kinds are reported wherever they occur. A weak identifier is reported if a secret lies
    within the scope, a weak value if an identifier does, an endpoint if both do; not where a
    strong span covers any of it. A null or empty text has no spans; a null key is kept; equal
    rows get equal results; other columns are not looked at; empty tables give empty results.
    """
    found = scanned(docs, text, [key])
    by_row = spans_of(found, scope).groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "rank", "kind", "end"))).alias("spans")
    )
    out = found.select("row", F.col("c0").alias(key)).join(by_row, "row", "left")
    empty = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    return out.select(key, F.coalesce("spans", empty).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redacted(
    docs: DataFrame, scope: int = SCOPE, text: str = "text", size: str | None = None
) -> DataFrame:
    """docs with each run of overlapping spans replaced by a mask; all rows and columns stay.

    size: a column to be set to the new number of characters. Other texts stay as they are.
    """
    found = scanned(docs, text, docs.columns)
    order = Window.partitionBy("row").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = spans_of(found, scope).withColumn("new", F.when(F.col("start") <= reach, 0).otherwise(1))
    runs = runs.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.groupBy("row", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    # What is kept stands between the end of one run and the start of the next.
    last = F.lag("end", 1, 0).over(Window.partitionBy("row").orderBy("start"))
    runs = runs.select("row", F.struct(last.alias("a"), F.col("start").alias("b"), F.col("end")).alias("gap"))
    gaps = runs.groupBy("row").agg(F.sort_array(F.collect_list("gap")).alias("gaps"))
    body = f"c{docs.columns.index(text)}"
    kept = F.transform(
        "gaps",
        lambda g: F.concat(F.substring(F.col(body), (g["a"] + 1).cast("int"), (g["b"] - g["a"]).cast("int")), F.lit(MASK)),
    )
    rest = F.substring(F.col(body), (F.element_at("gaps", -1)["end"] + 1).cast("int"), F.length(body))
    out = found.join(gaps, "row", "left").withColumn(
        "masked", F.when(F.col("gaps").isNotNull(), F.concat(F.array_join(kept, ""), rest)).otherwise(F.col(body))
    )
    columns = []
    for i, c in enumerate(docs.columns):
        if c == text:
            columns.append(F.col("masked").cast(docs.schema[c].dataType).alias(c))
        elif c == size:
            new = F.length("masked").cast(docs.schema[c].dataType)
            columns.append(F.when(F.col("gaps").isNotNull(), new).otherwise(F.col(f"c{i}")).alias(c))
        else:
            columns.append(F.col(f"c{i}").alias(c))
    return out.select(*columns)
