"""One registered query per operator: the operator over its whole table, with digests of its output."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import (
    decontaminate,
    kdtree,
    language_model,
    merkle,
    ngram_join,
    packing,
    quality,
    secrets,
    simhash,
    spelling,
    substring_dedup,
    suffix_dedup,
    warc,
)
from lakemart.llm.common import importable

QUERIES = {}
ORACLES = {}


def query(sql: str | None = None):
    def register(run):
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


OP1_SQL = r"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS row_key,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), starts AS (
  SELECT row_key, unnest(range(1, len(words) - 33)) AS p, words FROM docs WHERE len(words) >= 35
), windows AS (
  SELECT row_key, p, array_to_string(words[p:p + 34], ' ') AS w FROM starts
), repeats AS (
  SELECT w FROM windows GROUP BY w HAVING count(*) > 1
), hit AS (
  SELECT row_key, unnest(range(p, p + 35)) AS q FROM windows SEMI JOIN repeats USING (w)
), gone AS (
  SELECT row_key, list(DISTINCT q) AS gone FROM hit GROUP BY row_key
), left_over AS (
  SELECT doc_id, words, coalesce(len(gone), 0) AS n_removed,
         CASE WHEN gone IS NULL THEN words
              ELSE list_filter(words, lambda x, i: NOT list_contains(gone, i)) END AS kept
  FROM docs LEFT JOIN gone USING (row_key)
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256
FROM left_over
"""


@query(OP1_SQL)
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents that no repeated window of 35 words covers."""
    out = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), window=35)
    return out.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


@query()
def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and the components of those at most 2 bits apart."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)


OP7_SQL = r"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS row_key,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), items AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, least(10, len(words)) AS n,
         array_to_string(words[p:p + least(10, len(words)) - 1], ' ') AS w
  FROM (SELECT *, unnest(range(1, greatest(len(words) - 8, 2))) AS p FROM items WHERE len(words) > 0)
), doc_windows AS (
  SELECT row_key, p, n, array_to_string(words[p:p + n - 1], ' ') AS w
  FROM (SELECT row_key, words, n, unnest(range(1, len(words) - n + 2)) AS p
        FROM docs, (SELECT DISTINCT n FROM item_windows) WHERE len(words) >= n)
), found AS (
  SELECT row_key, p, d.n, item_id FROM doc_windows d JOIN item_windows i ON d.n = i.n AND d.w = i.w
), hit AS (
  SELECT row_key, count(DISTINCT q) AS n_hit
  FROM (SELECT row_key, unnest(range(p, p + n)) AS q FROM found) GROUP BY row_key
), owners AS (
  SELECT row_key, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT row_key, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY row_key
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (row_key) LEFT JOIN owners USING (row_key)
"""


@query(OP7_SQL)
def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents that occurrences of 10-word windows of the benchmark cover."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    out = decontaminate.contamination(docs, items, window=10)
    listed = F.array_join("items", ",").cast("binary")
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"),
        "contaminated",
    )


def op8_sql() -> str:
    """The scan in DuckDB: pieces between matches give places, window functions the nearest parts."""
    kinds = secrets.STRONG | secrets.WEAK
    parts = "\nUNION ALL\n".join(
        f"""SELECT row_key, '{kind}' AS kind, {rank} AS rank, unnest(range(1, len(sizes) + 1)) AS i,
       gaps, sizes, tests FROM (SELECT row_key,
       list_transform(string_split_regex(body, {p}), lambda x: length(x)) AS gaps,
       list_transform(regexp_extract_all(body, {p}, 0), lambda x: length(x)) AS sizes,
       list_transform(regexp_extract_all(body, {p}, {group}), lambda x: length(x)) AS tests FROM docs)"""
        for rank, (kind, (pattern, group, _)) in enumerate(kinds.items())
        for p in ["'" + pattern.replace("'", "''") + "'"]
    )
    cases = lambda values: " ".join(f"WHEN kind = '{k}' THEN {v}" for k, v in values.items())
    strong = "kind IN (" + ", ".join(f"'{k}'" for k in secrets.STRONG) + ")"
    tests = {"identifier": "role = 'identifier'", "secret": "role = 'secret'", "strong": strong}
    nearest = ",\n".join(
        f"max(CASE WHEN {t} THEN stop END) OVER before AS {n}_end, min(CASE WHEN {t} THEN start END) OVER after AS {n}_start"
        for n, t in tests.items()
    )
    within = lambda n, d: f"(coalesce(start - {n}_end <= {d}, false) OR coalesce({n}_start - stop <= {d}, false))"
    scope = secrets.SCOPE
    text = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank, stop)"
    return rf"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS row_key, coalesce(text, '') AS body FROM documents),
parts AS ({parts}),
placed AS (
  SELECT row_key, kind, rank, list_sum(gaps[:i]) + coalesce(list_sum(sizes[:i - 1]), 0) AS start,
         list_sum(gaps[:i]) + list_sum(sizes[:i]) AS stop, tests[i] AS tested FROM parts
), fit AS (
  SELECT *, CASE {cases({k: f"'{r}'" for k, r in secrets.ROLES.items()})} END AS role FROM placed
  WHERE tested >= CASE {cases({k: v[2] for k, v in kinds.items()})} END AND (kind <> 'value' OR tested <= 40)
    AND (kind IN ('assign', 'access', 'hex') OR row_key IN (
      SELECT row_key FROM docs WHERE contains(body, 'AKIA') OR regexp_matches(body, '{secrets.WEAK["identifier"][0]}')))
), near AS (
  SELECT *, {nearest} FROM fit WINDOW
    before AS (PARTITION BY row_key ORDER BY start, rank, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    after AS (PARTITION BY row_key ORDER BY start DESC, rank DESC, stop DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), kept AS (
  SELECT * FROM near WHERE {strong} OR (NOT {within("strong", -1)} AND CASE role
    WHEN 'identifier' THEN {within("secret", scope)} WHEN 'secret' THEN {within("identifier", scope)}
    ELSE {within("identifier", scope)} AND {within("secret", scope)} END)
), lists AS (
  SELECT row_key, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex, {text} FILTER ({strong}) AS base, {text} AS spans
  FROM kept GROUP BY row_key
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN lists USING (row_key)
"""


@query(op8_sql())
def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of all documents, and weak parts linked within the scope."""
    out = secrets.secret_spans(table(spark, sf_dir, "documents"))

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.STRONG))
    return out.select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in secrets.STRONG],
        F.sha2(secrets.listed(base).cast("binary"), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"),
    )


@query()
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids in sequences of at most 4096."""
    docs = table(spark, sf_dir, "documents")
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(docs, path, length=4096, end_id=2, ids=False)


@query()
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability of being good, and whether to keep it, for every document."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality, near copies, benchmark leaks, secrets, packing: one after another."""
    return corpus_pipeline.run(spark, sf_dir)


OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_inner_product(q.x::DOUBLE[], c.x::DOUBLE[]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM scored QUALIFY rank <= 20
"""


@query(OP9_SQL)
def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest inner products of every twentieth vector with all others."""
    return kdtree.top_k(table(spark, sf_dir, "embeddings"), k=20, every=20, scale=64.0)


OP6_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
firsts AS (SELECT html, max(page_id) AS first FROM p WHERE strlen(html) >= 1000 GROUP BY html)
SELECT page_id, CAST(strlen(p.html) AS BIGINT) AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN firsts ON p.html = firsts.html
"""


@query(OP6_SQL)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, written as compressed archives and read back."""
    out = warc.round_trip(table(spark, sf_dir, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a model of those not held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    model = language_model.count(docs.where(~F.coalesce(held_out, F.lit(False))))
    scored = language_model.score(docs, model)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), *scored.columns[1:])


@query()
def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of documents that no repeated string of 400 bytes covers."""
    docs = table(spark, sf_dir, "documents")
    out = suffix_dedup.remove_copies(docs, window=400, keep_first=False)
    return out.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


OP11_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, row_number() OVER () AS r, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT r, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM docs
), sizes AS (
  SELECT r, count(*) AS n FROM shingles GROUP BY r
), links AS (
  SELECT a.r AS x, b.r AS y FROM shingles a JOIN shingles b ON a.s = b.s AND a.r <> b.r
    JOIN sizes m ON m.r = a.r JOIN sizes n ON n.r = b.r
  GROUP BY a.r, b.r HAVING 100 * count(*) >= 80 * (any_value(m.n) + any_value(n.n) - count(*))
), reach AS (
  SELECT r AS x, r AS y FROM docs UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y
), components AS (
  SELECT x AS r, min(doc_id) AS component_id FROM reach JOIN docs ON docs.r = reach.y GROUP BY x
), degrees AS (
  SELECT x AS r, count(*) AS n_links FROM links GROUP BY x
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(n_links, 0) AS n_links
FROM docs LEFT JOIN sizes USING (r) LEFT JOIN components USING (r) LEFT JOIN degrees USING (r)
"""


@query(OP11_SQL)
def op11_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose sets of 5-word shingles are 0.8 alike: components, and links of each."""
    return ngram_join.jaccard_join(table(spark, sf_dir, "documents"), width=5, percent=80)


# The crc32 of a text in DuckDB: a table of 256 entries, made by its rule, and a fold over the bytes.
CRC_SQL = """crc_steps AS (
  SELECT range AS i, 0 AS k, range AS c FROM range(256)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_steps WHERE k < 8
), crc AS (SELECT list(c ORDER BY i) AS entries FROM crc_steps WHERE k = 8)"""


def crc_sql(text: str) -> str:
    """For texts of code points below 2048, beside the table crc."""
    byte_list = f"""flatten(list_transform(string_split({text}, ''), lambda s: CASE WHEN s = '' THEN []
      WHEN unicode(s) < 128 THEN [unicode(s)::BIGINT]
      ELSE [(192 | (unicode(s) >> 6))::BIGINT, (128 | (unicode(s) & 63))::BIGINT] END))"""
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {byte_list}),
      lambda a, b: xor(a >> 8, entries[(xor(a, b) & 255) + 1])))"""


OP12_SQL = rf"""
WITH RECURSIVE {CRC_SQL}, runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS key, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS raw FROM documents
), lowered AS (
  SELECT key, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM runs GROUP BY ALL
), coded AS (
  SELECT run, n, {crc_sql("key || ':' || run")} AS h FROM lowered, crc
), typed AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
  FROM coded
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n, length(word) AS size FROM typed WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), gaps AS (
  SELECT word, size, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b
  FROM (SELECT *, unnest(range(1, size + 1)) AS i FROM words)
), pairs AS (
  SELECT DISTINCT x.word AS word, y.word AS near FROM gaps x JOIN gaps y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT DISTINCT g.word, w.word FROM gaps g JOIN words w ON w.word = g.a || g.b
  UNION SELECT DISTINCT w.word, g.word FROM gaps g JOIN words w ON w.word = g.a || g.b
), near AS (
  SELECT p.word, count(*) AS n_near, max(w.n) AS best_n FROM pairs p JOIN words w ON w.word = p.near GROUP BY p.word
), best AS (
  SELECT p.word, min(encode(p.near)) AS best FROM pairs p JOIN words w ON w.word = p.near JOIN near m ON m.word = p.word AND m.best_n = w.n
  GROUP BY p.word
), known AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * n THEN decode(best) END AS form,
         CASE WHEN best_n >= 2 * n THEN best_n END AS form_n
  FROM words LEFT JOIN near USING (word) LEFT JOIN best USING (word)
), ways AS (
  SELECT word, word AS root, form AS next FROM known
  UNION ALL SELECT w.word, k.word, k.form FROM ways w JOIN known k ON k.word = w.next
)
SELECT k.word, form, root, n, n_near, form_n FROM known k JOIN ways w ON w.word = k.word AND w.next IS NULL
"""


@query(OP12_SQL)
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, with typos put in by rule, grouped with their near words."""
    return spelling.variant_groups(spelling.vocabulary(spelling.with_typos(table(spark, sf_dir, "documents"))))


def op13_sql(levels: int = 14) -> str:
    """Levels of the trees one after another, for at most 3^14 documents of a source.

    s: trees of the sources, c: the tree above them. s3 holds the nodes of level 3, sp3 the digests
    that stand before and after each of them in its run; a tree of one node stays as it is.
    """

    def field(name, value):
        text = f"CAST({value} AS VARCHAR)"
        return f"CASE WHEN {name} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"

    def leaf(text):
        plain = [field(c, c) for c in ("doc_id", "source", "lang", "n_chars")]
        return f"sha256({' || '.join([*plain, field('text', text)])})"

    steps, joins, proofs, sides, folds, previous = [], [], [], [], [], "gathered"
    for tree, spot in (("s", "d.spot"), ("c", "c0.spot")):
        if tree == "c":
            place = "row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1"
            steps.append(f"c0 AS (SELECT '' AS source, source AS name, {place} AS spot, h FROM s{levels})")
        for i in range(levels):
            steps.append(f"""{tree}{i + 1} AS (
  SELECT source, spot // 3 AS spot, CASE WHEN n = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY spot)) END AS h
  FROM (SELECT source, spot, h, count(*) OVER (PARTITION BY source) AS n FROM {tree}{i}) GROUP BY source, spot // 3, n
), {tree}p{i} AS (
  SELECT source, spot, count(*) OVER (PARTITION BY source) AS n,
         CASE spot % 3 WHEN 0 THEN '' WHEN 1 THEN lag(h, 1) OVER w ELSE lag(h, 2) OVER w || lag(h, 1) OVER w END AS a,
         CASE spot % 3 WHEN 2 THEN '' WHEN 1 THEN coalesce(lead(h, 1) OVER w, '')
              ELSE coalesce(lead(h, 1) OVER w, '') || coalesce(lead(h, 2) OVER w, '') END AS b
  FROM {tree}{i} WINDOW w AS (PARTITION BY source ORDER BY spot)
)""")
            p, key = f"{tree}p{i}", f"{tree}{i}"
            of = "d.source" if tree == "s" else "''"
            joins.append(f"JOIN {p} ON {p}.spot = {spot} // {3**i} AND {p}.source IS NOT DISTINCT FROM {of}")
            proofs.append(f"CASE WHEN {p}.n = 1 THEN '' ELSE {p}.a || {p}.b END")
            sides.append(f"{p}.n AS n_{key}, {p}.a AS a_{key}, {p}.b AS b_{key}")
            folds.append(f"""f_{key} AS (SELECT * REPLACE (CASE WHEN n_{key} = 1 THEN changed
  ELSE sha256(a_{key} || changed || b_{key}) END AS changed) FROM {previous})""")
            previous = f"f_{key}"
    parity = crc_sql("CAST(doc_id AS VARCHAR)") + " % 2"
    return f"""
WITH RECURSIVE {CRC_SQL}, leaves AS (
  SELECT doc_id, source, {leaf("text")} AS h,
         {leaf(f"CASE WHEN {parity} = 0 THEN replace(text, chr(10), '') ELSE text END")} AS changed
  FROM documents, crc
), s0 AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS spot FROM leaves
), {", ".join(steps)}, gathered AS (
  SELECT d.doc_id, d.h AS leaf, d.changed, c0.h AS subroot, (SELECT h FROM c{levels}) AS root,
         sha256({" || ".join(proofs)}) AS proof_sha256, {", ".join(sides)}
  FROM s0 d JOIN c0 ON c0.name IS NOT DISTINCT FROM d.source {" ".join(joins)}
), {", ".join(folds)}
SELECT doc_id, leaf, subroot, root, proof_sha256, changed AS folded_root, changed = root AS verified FROM {previous}
"""


@query(op13_sql())
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and whether it verifies after tampering by rule."""
    docs = table(spark, sf_dir, "documents")
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    changed = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.manifest(docs, claimed={"text": changed})
