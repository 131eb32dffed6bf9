"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from checks.registry import Case
from seatflow.llm import decontam, html, langid, mixing, ngram_join, packing, pii, ranked, rollups, topk, toxicity, urls, whitening
from seatflow.runtime import fresh_path

CASES: dict[str, Case] = {}

#: The rules of `op5_url_filter`, (host/path, whether it blocks).
URL_RULES = [("org/", False), ("example.org/es/", True), ("example.org/en/1", True), ("com/fr/", False), ("com/de/", True)]


def query(sql: str | None = None):
    def add(run):
        CASES[run.__name__] = Case(run.__name__, run, sql)
        return run

    return add


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("""
WITH q AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_dot_product(a.v::DOUBLE[], b.v::DOUBLE[]) AS BIGINT) AS score
  FROM q a JOIN q b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id),
placed AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM placed WHERE rank <= 20""")
def op1_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(_table(spark, folder, "embeddings"))


@query()
def op2_main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages").select("page_id", "url", "html")
    return html.extracted(pages, html.fit(pages)).drop("html")


@query()
def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").withColumn("held_out", F.coalesce(langid.fold(3) == 1, F.lit(False)))
    model = langid.fit(docs.where(langid.fold(3) != 1))
    return langid.predicted(docs.select("doc_id", "held_out", "text"), model).drop("text")


@query()
def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return pii.found(docs, pii.fit(docs)).drop("text")


@query("""
WITH p AS (
  SELECT page_id, coalesce(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), '') AS h,
    coalesce(regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
l AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM p),
r AS (SELECT *, CASE
    WHEN regexp_matches(host, '(^|\\.)example\\.org$') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN regexp_matches(host, '(^|\\.)example\\.org$') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN regexp_matches(host, '(^|\\.)com$') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN regexp_matches(host, '(^|\\.)com$') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN regexp_matches(host, '(^|\\.)org$') AND starts_with(path, '/') THEN 'org/' END AS rule FROM l)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM r""")
def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judged(_table(spark, folder, "pages"), URL_RULES)


@query()
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = toxicity.fit(docs, _table(spark, folder, "labels").where(langid.fold(4) != 2))
    docs = docs.select("doc_id", F.coalesce(langid.fold(4) == 2, F.lit(False)).alias("held_out"), "text")
    return toxicity.scored(docs, model).drop("text")


@query()
def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    rollup = rollups.Rollup(spark, fresh_path(spark, "token-counts"))
    batches = rollups.document_batches(_table(spark, folder, "documents"))
    for name, changes in [*batches, batches[1]]:  # a batch that is sent twice counts once
        rollup.commit(name, changes)
    return rollup.totals()


@query()
def op8_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return decontam.judged(docs, _table(spark, folder, "benchmark")).drop("text")


@query()
def op9_mix(spark: SparkSession, folder: str) -> DataFrame:
    found = mixing.allotted(_table(spark, folder, "documents"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query()
def op10_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.joined(_table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents),
t AS (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM d),
tf AS (SELECT r, doc_id, n, term, count(*) AS tf FROM t GROUP BY ALL),
c AS (SELECT count(*) AS docs, sum(len(terms)) AS total FROM d WHERE len(terms) > 0),
df AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, c GROUP BY term, docs),
i AS (SELECT row_number() OVER () AS i, item_id, list_distinct({_TERMS}) AS terms FROM benchmark),
q AS (SELECT i, item_id, unnest(terms) AS term FROM i),
s AS (SELECT i, item_id, r, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // CAST(total AS BIGINT))))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN df USING (term), c GROUP BY ALL),
placed AS (SELECT *, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 10""")
def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked.top_documents(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


@query()
def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.tokenised(_table(spark, folder, "documents"))
    digests = pieces.select("key", "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return digests.join(packing.packed(pieces.select("key", "length")), "key").drop("key")


@query()
def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    table = _table(spark, folder, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(table)
    rows = whitening.whitened(table, model)
    explained = F.array(*(F.lit(float(e)) for e in model.explained)).cast("array<double>")
    each = F.posexplode(F.arrays_zip(F.col("whitened"), explained.alias("explained"))).alias("at", "x")
    return rows.select("vec_id", "deviation", each).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", "x.whitened", "x.explained",
        F.lit(whitening.identity_error(rows, len(model.values))).cast("double").alias("identity_error"))


CASES["pipeline"] = Case("pipeline", corpus_pipeline.run, corpus_pipeline.ORACLE_SQL)
