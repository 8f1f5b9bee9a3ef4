"""Registered queries of the numbered operators, and their SQL where SQL can express them."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwright.llm import (
    alignment,
    chat,
    exact_dedup,
    knn,
    language_id,
    mixing,
    packing,
    quality,
    quantize,
    simhash,
    toxicity,
    url_filter,
    warc,
)
from tickwright.llm.common import table

Spark = SparkSession


def op1_temperature_mixing(spark: Spark, sf_dir: str) -> DataFrame:
    """The mixed order of all documents: entropy 0.97 of the highest, two passes at most."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: Spark, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: Spark, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: Spark, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_url_association_rules(spark: Spark, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op6_quality_perplexity(spark: Spark, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_warc(spark: Spark, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op8_simhash_near_dedup(spark: Spark, sf_dir: str) -> DataFrame:
    found = simhash.near_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op9_language_id(spark: Spark, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op10_voronoi_top_k(spark: Spark, sf_dir: str) -> DataFrame:
    return knn.top_k(table(spark, sf_dir, "embeddings"))


def op11_chat_formatting(spark: Spark, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts are made of marks."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = F.explode(F.array(*[F.struct(F.lit(i), F.lit(r)) for i, r in enumerate(("user", "assistant"))]))
    marks = spark.range(1).select(F.lit(-1).alias("conv_id"), probe.alias("t"))
    marks = marks.select("conv_id", "t.*", F.lit("</s>[INST] ok [/INST]")).toDF(*given.columns)
    return chat.read_back(chat.format_conversations(given.unionByName(marks)))


def op12_vector_code_compression(spark: Spark, sf_dir: str) -> DataFrame:
    return quantize.compress(table(spark, sf_dir, "embeddings"))


def op13_cross_tokenizer_alignment(spark: Spark, sf_dir: str) -> DataFrame:
    return alignment.align_corpus(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_temperature_mixing": op1_temperature_mixing,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_url_association_rules": op5_url_association_rules,
    "op6_quality_perplexity": op6_quality_perplexity,
    "op7_warc": op7_warc,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_language_id": op9_language_id,
    "op10_voronoi_top_k": op10_voronoi_top_k,
    "op11_chat_formatting": op11_chat_formatting,
    "op12_vector_code_compression": op12_vector_code_compression,
    "op13_cross_tokenizer_alignment": op13_cross_tokenizer_alignment,
}

ORACLES = {
    "op12_vector_code_compression": quantize.compress_sql(),
    "op10_voronoi_top_k": """
        WITH vectors AS (
            SELECT row_number() OVER () AS nth, vec_id,
                   list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
        ),
        scored AS (
            SELECT q.nth, q.vec_id AS query_id, d.vec_id AS vec_id,
                   list_inner_product(q.v, d.v)::BIGINT AS score
            FROM vectors q JOIN vectors d ON q.nth <> d.nth
            WHERE q.vec_id % 100 = 0
        )
        SELECT query_id,
               row_number() OVER (PARTITION BY nth ORDER BY score DESC, vec_id)::INTEGER AS rank,
               vec_id, score
        FROM scored
        QUALIFY rank <= 10
    """,
    "op1_temperature_mixing": """
        WITH RECURSIVE
        docs AS (
            SELECT doc_id, source, len(regexp_extract_all(text, '[^ \\t\\n\\r]+')) AS tokens,
                   md5('mix:' || doc_id::VARCHAR) AS key
            FROM documents
        ),
        sources AS (SELECT source, sum(tokens)::BIGINT AS tokens FROM docs GROUP BY source),
        total AS (SELECT sum(tokens)::BIGINT AS n, count(*) AS sources FROM sources),
        shares AS (SELECT source, tokens, tokens::DOUBLE / n AS share FROM sources, total),
        bisect(step, low, high) AS (
            SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
            UNION ALL
            SELECT step + 1,
                   CASE WHEN fits THEN low ELSE (low + high) / 2 END,
                   CASE WHEN fits THEN (low + high) / 2 ELSE high END
            FROM (
                SELECT step, low, high,
                       ln(sum(pow(share, (low + high) / 2)))
                         - (low + high) / 2 * sum(pow(share, (low + high) / 2) * ln(share))
                           / sum(pow(share, (low + high) / 2)) <= 0.97 * ln(count(*)) + 1e-12
                       AND max(pow(share, (low + high) / 2 - 1)) / min(pow(share, (low + high) / 2 - 1))
                           <= 2.0 AS fits
                FROM bisect, shares
                WHERE step < 20
                GROUP BY step, low, high
            )
        ),
        alpha AS (SELECT high AS a FROM bisect WHERE step = 20),
        norm AS (
            SELECT a, sum(pow(share, a)) AS norm, max(pow(share, 1 - a)) AS most
            FROM shares, alpha GROUP BY a
        ),
        plan AS (
            SELECT source, tokens AS total, round(pow(share, a) / norm * (n * norm * most))::BIGINT AS quota
            FROM shares, norm, total
        ),
        grouped AS (
            SELECT source, key, sum(tokens)::BIGINT AS tokens FROM docs GROUP BY source, key
        ),
        running AS (
            SELECT source, key, tokens,
                   (sum(tokens) OVER (PARTITION BY source ORDER BY key) - tokens)::BIGINT AS before
            FROM grouped
        ),
        passes AS (
            SELECT r.*, total, quota,
                   quota // total
                     + (tokens > 0 AND before + tokens <= quota - quota // total * total)::BIGINT AS n
            FROM running r JOIN plan USING (source)
        ),
        blocks AS (SELECT greatest(1, ceil(sum(quota) / 1000000.0))::BIGINT AS n FROM plan),
        copies AS (
            SELECT source, key, c.copy,
                   least(floor((c.copy * total + before) / greatest(quota, 1) * blocks.n), blocks.n - 1)::BIGINT
                     AS block
            FROM passes, blocks, (SELECT unnest(range(0, 100)) AS copy) c
            WHERE c.copy < passes.n
        )
        SELECT doc_id, source, tokens, copy, block,
               row_number() OVER (
                   PARTITION BY block
                   ORDER BY md5('mix:' || key || ':' || source || ':' || copy::VARCHAR), tokens
               ) AS position
        FROM docs JOIN copies USING (source, key)
    """,
    "op3_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
}
