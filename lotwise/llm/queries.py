"""Queries over the corpus tables, one for each operator, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm import decontam, html, interactions, languages, lm, packing, passages, quality, secrets, simhash, sortmeans, substrings, topk
from lotwise.llm.common import read


def vocabulary() -> str:
    """The tokenizer file of op8, from the installed package of public vocabularies."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_near_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each near-duplicate passage of a document; documents without one have none."""
    return passages.near_passages(read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.dedup(read(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read(spark, sf_dir, "pages"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and benchmark item that leaks into it; clean documents have none."""
    found = decontam.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "item_id", "start", "similarity")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its expected grade, its tail probability and whether the classifier selects it."""
    return quality.grade(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).withColumnRenamed("id", "doc_id")


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), vocabulary()).withColumnRenamed("id", "doc_id")


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_components(read(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "fingerprint", "component_id")


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.identify(read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sortmeans.cluster(read(spark, sf_dir, "embeddings"))


def _clustering_sql(rounds: int) -> str:
    """All distances of every round, one common table expression after the other."""
    ctes = ["""
        v AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY h, e) - 1 AS c, e AS m
            FROM (SELECT sha256('2:' || CAST(vec_id AS VARCHAR)) AS h, e FROM v ORDER BY h, e LIMIT 40)
        )"""]
    for i in range(rounds + 1):
        ctes.append(f"""a{i} AS MATERIALIZED (
            SELECT r, any_value(vec_id) AS vec_id, any_value(e) AS e, min((d, c)) AS best
            FROM (SELECT v.r, v.vec_id, v.e, k.c, CAST(list_sum(list_transform(list_zip(v.e, k.m), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d FROM v, c{i} k)
            GROUP BY r
        )""")
        if i < rounds:
            ctes.append(f"""c{i + 1} AS MATERIALIZED (
            SELECT k.c, coalesce(n.m, k.m) AS m
            FROM c{i} k LEFT JOIN (
                SELECT c, list(q ORDER BY pos) AS m
                FROM (SELECT c, pos, CAST(floor(sum(x) / count(*)) AS BIGINT) AS q FROM (SELECT best[2] AS c, unnest(e) AS x, unnest(range(64)) AS pos FROM a{i}) GROUP BY c, pos)
                GROUP BY c
            ) n ON n.c = k.c
        )""")
    return "WITH " + ", ".join(ctes) + f"""
        SELECT a.vec_id, CAST(best[2] AS INTEGER) AS cluster, best[1] AS distance, CAST(sum(best[1]) OVER (PARTITION BY best[2]) AS BIGINT) AS cluster_inertia,
            CAST(sum(best[1]) OVER () AS BIGINT) AS inertia, sha256(array_to_string(k.m, ',')) AS centroid_sha256
        FROM a{rounds} a JOIN c{rounds} k ON k.c = best[2]
    """


QUERIES = {
    f.__name__: f
    for f in (
        op1_near_passages,
        op2_suffix_dedup,
        op3_secret_scan,
        op4_html_extraction,
        op5_decontamination,
        op6_quality_classifier,
        op7_lm_scoring,
        op8_best_fit_packing,
        op9_simhash_near_dedup,
        op10_exact_top_k,
        op11_filter_audit,
        op12_language_id,
        op13_centroid_clustering,
    )
}
ORACLE_SQL: dict[str, str] = {
    # Integer scores make the sums exact; zeros fill nothing as all vectors have one length.
    "op10_exact_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
        ), r AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
        )
        SELECT * FROM r WHERE rank <= 20
    """,
    # Every document through every order; the query adds up subsets of failures instead.
    "op11_filter_audit": r"""
        WITH d AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
        ), w AS (
            SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS least FROM d
        ), l AS (
            SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id
        ), f AS (
            SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, map(['A', 'B', 'C', 'D', 'E'], [
                len(words) < 50,
                100 * len(list_distinct(words)) < 65 * len(words),
                100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t),
                regexp_matches(t, '[#$%&*|]'),
                coalesce(doc_id > least, false)]) AS fails
            FROM w LEFT JOIN l USING (doc_id)
        ), c AS (
            SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c
        ), o AS (
            SELECT a.c || b.c || d.c || e.c || g.c AS filter_order FROM c a, c b, c d, c e, c g
            WHERE len(list_distinct([a.c, b.c, d.c, e.c, g.c])) = 5
        ), s AS (
            SELECT filter_order, CAST(step AS INTEGER) AS step, string_split(left(filter_order, CAST(step AS INTEGER) - 1), '') AS before, filter_order[step] AS own
            FROM o, range(1, 6) r(step)
        ), x AS (
            SELECT f.part, filter_order, step, own, good, toxic, fails[own] AS failed,
                len(list_filter(before, lambda b: b <> '' AND coalesce(fails[b], false))) > 0 AS gone,
                len(list_filter(map_values(fails), lambda v: v)) AS failures
            FROM f, s
        ), y AS (
            SELECT part, filter_order, step, own, count(*) FILTER (NOT gone AND NOT failed) AS kept, count(*) FILTER (NOT gone AND failed) AS removed, count(*) FILTER (gone AND failed) AS redundant,
                count(*) FILTER (failed AND failures = 1) AS unique_fails, count(*) FILTER (NOT gone AND failed AND good) AS good_lost, count(*) FILTER (NOT gone AND failed AND toxic) AS toxic_lost
            FROM x GROUP BY ALL
        )
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM y
    """,
    "op13_centroid_clustering": _clustering_sql(sortmeans.ROUNDS),
}
