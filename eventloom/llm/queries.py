"""The registered queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import (
    decontamination,
    jaccard,
    licenses,
    lines,
    negatives,
    neighbours,
    packing,
    pages,
    quality,
    runs,
    substrings,
    toxicity,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LINES_SQL = f"""
WITH parts AS (
  SELECT coalesce(doc_id, -9223372036854775808) AS id, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents
), lines AS (
  SELECT id, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM parts
), keyed AS (
  SELECT *, translate(trim(line, {_SPACES}), '{_UPPER}', '{_LOWER}') AS k FROM lines
), repeated AS (
  SELECT k, min(id) AS first FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT id) > 1
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE id > first) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE first IS NULL OR id <= first), ''))
    AS kept_sha256
FROM keyed LEFT JOIN repeated USING (k) GROUP BY doc_id
"""


@query("op1_line_dedup", LINES_SQL)
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def remainder(column: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; null without an id."""
    return F.crc32(column.cast("long").cast("string").cast("binary")) % n


@query("op4_quality_classifier")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    weights = quality.fit(docs, labels, label="quality", learn=remainder(labels["doc_id"], 5) != 0)
    return quality.score(docs, weights).select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


@query("op10_toxicity_neighbours")
def toxicity_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    index = toxicity.fit(docs, labels, label="toxic", learn=remainder(labels["doc_id"], 3) != 1)
    return toxicity.score(docs, index).select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        "evidence",
    )


VECTORS_SQL = """
WITH RECURSIVE v AS (
  SELECT coalesce(vec_id, -9223372036854775808) AS id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), u AS (
  SELECT id, label, e, sqrt(list_dot_product(e, e)) AS size FROM v
  WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.id AS x, b.id AS y FROM u a JOIN u b ON a.label = b.label AND len(a.e) = len(b.e) AND a.id <> b.id
  WHERE list_dot_product(a.e, b.e) >= 0.93 * a.size * b.size
), reach AS (
  SELECT id, id AS r FROM v UNION SELECT reach.id, y FROM reach JOIN links ON x = r
), n AS (
  SELECT x AS id, count(*) AS n FROM links GROUP BY x
), c AS (
  SELECT id, min(r) AS component_id FROM reach GROUP BY id
)
SELECT id AS vec_id, coalesce(n, 0) AS n_links, component_id, id = component_id AS kept FROM c LEFT JOIN n USING (id)
"""


@query("op2_sorted_projection_neighbours", VECTORS_SQL)
def sorted_projection_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.link_vectors(table(spark, sf_dir, "embeddings"))


JACCARD_SQL = f"""
WITH RECURSIVE w AS (
  SELECT coalesce(doc_id, -9223372036854775808) AS id, list_filter(
    string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS shingle FROM w
), n AS (
  SELECT id, count(shingle) AS n FROM w LEFT JOIN s USING (id) GROUP BY id
), shared AS (
  SELECT a.id AS x, b.id AS y, count(*) AS o FROM s a JOIN s b ON a.shingle = b.shingle AND a.id <> b.id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN n a ON a.id = x JOIN n b ON b.id = y WHERE 100 * o >= 80 * (a.n + b.n - o)
), reach AS (
  SELECT id, id AS r FROM n UNION SELECT reach.id, y FROM reach JOIN links ON x = r
)
SELECT id AS doc_id, n AS n_shingles, min(r) AS component_id FROM reach JOIN n USING (id) GROUP BY ALL
"""


@query("op3_ngram_jaccard_join", JACCARD_SQL)
def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op6_benchmark_decontamination")
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op7_mixture_packing")
def mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "source",
    )


@query("op8_substring_dedup")
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.repeated_spans(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )


@query("op9_site_style_tree")
def site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op5_warc_derivatives")
def warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))
    return found.select(
        "page_id",
        "record_id",
        "type",
        "refers_to",
        "concurrent_to",
        "target_uri",
        "content_type",
        F.length("block").cast("long").alias("content_length"),
        "block_digest",
        "source_block_digest",
        "source_payload_digest",
    )


def _quoted(words: tuple[bytes, ...]) -> str:
    return "[" + ", ".join(f"'{w.decode()}'" for w in words) + "]"


def _license_sql() -> str:
    """Every block against every template, without filters."""
    found = licenses.templates()
    places, blocks = [], []
    for t in found:
        size, c = len(t.words), t.stride
        if t.phrase:
            places.append(
                f"SELECT r, '{t.label}' AS label, i FROM (SELECT r, ws, unnest(range(len(ws) - {size - 1})) AS i FROM w "
                f"WHERE len(ws) >= {size}) WHERE ws[i + 1:i + {size}] = {_quoted(t.words)}"
            )
        else:
            blocks.append(
                f"SELECT r, '{t.label}' AS label, len(list_intersect(list_distinct(b), {_quoted(tuple(set(t.words)))})) AS o, "
                f"{len(set(t.words))} AS m, {t.needed} AS needed FROM b{c}"
            )
    cut = [
        f"b{c} AS (SELECT r, ws[k * {c} + 1:k * {c} + {2 * c}] AS b FROM (SELECT r, ws, unnest(range((len(ws) + {c - 1}) // {c})) AS k "
        "FROM w))"
        for c in sorted({t.stride for t in found if not t.phrase})
    ]
    union = " UNION ALL "
    return f"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws
  FROM documents
), places AS ({union.join(places)}), {", ".join(cut)}, blocks AS ({union.join(blocks)}), meets AS (
  SELECT r, label, o / m AS share FROM blocks WHERE o >= needed
), base AS (
  SELECT r, count(*) AS n, min(i) AS first, max(i) AS last, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM places GROUP BY r
), every AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM (SELECT r, label, share FROM meets UNION ALL SELECT r, label, 1.0 FROM places) GROUP BY r
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, CAST(first AS BIGINT) AS first_word,
  CAST(last AS BIGINT) AS last_word, coalesce(base.labels, '') AS base_labels, coalesce(every.labels, '') AS labels,
  CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM w LEFT JOIN base USING (r) LEFT JOIN every USING (r)
"""


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


@query("op11_license_scan", _license_sql())
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda f: f["phrase"])
    places = F.flatten(F.transform(base, lambda f: f["places"]))
    return found.select(
        "doc_id",
        "n_words",
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        _joined(F.transform(base, lambda f: f["label"])).alias("base_labels"),
        _joined(F.transform("found", lambda f: f["label"])).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda f: f["containment"])), F.lit(0.0)).alias("score"),
    )


@query("op12_periodic_runs")
def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    h = F.crc32(docs["doc_id"].cast("long").cast("string").cast("binary"))
    found = runs.periodic_runs(docs, tail_seed=F.when(h % 10 == 0, F.floor(h / 10)))
    listed = F.transform(
        "runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period")))
    )
    listed = F.array_join(F.transform(listed, lambda line: F.concat(line, F.lit("\n"))), "")
    most = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r.alias("run"))))
    found = found.withColumn("most", most["run"])
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("most.start").alias("start"),
        F.col("most.length").alias("length"),
        F.col("most.period").alias("period"),
        F.floor(F.lit(1000) * F.col("most.length") / F.col("most.period")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
        "n_words",
    )


NEGATIVES_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, coalesce(vec_id, -9223372036854775808) AS id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, a.label = b.label AS same, b.r, b.vec_id, b.id,
    CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.r <> b.r AND len(a.e) = len(b.e)
), p AS (
  SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id, r) AS number FROM s WHERE same
  QUALIFY number <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor, p.number ORDER BY s.score DESC, s.id, s.r) AS INTEGER) AS rank,
  s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor) WHERE NOT s.same AND 100 * s.score BETWEEN 50 * p.score AND 95 * p.score
QUALIFY rank <= 3
"""


@query("op13_hard_negatives", NEGATIVES_SQL)
def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(vectors["vec_id"] % 7 == 0, (vectors["label"] + 1) % 10).otherwise(vectors["label"])
    return negatives.hard_negatives(vectors, vectors["vec_id"] % 50 == 0, label=label)
