"""One query per operator over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe, chaining, cuckoo, hilbert, inner_products, language, minhash, packing, phrases, rtree,
    sharding, suffixes, toxicity,
)
from tidemark.llm.common import table


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded_digests(table(spark, sf_dir, "documents"))


def op2_language_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op3_norm_sorted_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inner_products.top_products(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(100)) == 0)


def op4_cuckoo_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cuckoo.duplicates(table(spark, sf_dir, "documents"))


def op5_convolutional_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_collinear_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.passages(table(spark, sf_dir, "documents"))


def op7_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_digests(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op8_streaming_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("byte_bpe_50k.json")
    encoded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, drop=True)
    return bpe.decode(encoded, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_suffix_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removed(table(spark, sf_dir, "documents"))


def op10_oph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), k=2)


def op11_hilbert_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(100)) == 0)


def op12_dynamic_itemsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_rtree_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return rtree.hard_negatives(vectors, F.pmod("vec_id", F.lit(50)) == 0)


QUERIES = {
    "op1_histogram_sort": op1_histogram_sort,
    "op2_language_filters": op2_language_filters,
    "op3_norm_sorted_products": op3_norm_sorted_products,
    "op4_cuckoo_dedup": op4_cuckoo_dedup,
    "op5_convolutional_toxicity": op5_convolutional_toxicity,
    "op6_collinear_passages": op6_collinear_passages,
    "op7_nnls_packing": op7_nnls_packing,
    "op8_streaming_bpe": op8_streaming_bpe,
    "op9_suffix_levels": op9_suffix_levels,
    "op10_oph_minhash": op10_oph_minhash,
    "op11_hilbert_windows": op11_hilbert_windows,
    "op12_dynamic_itemsets": op12_dynamic_itemsets,
    "op13_rtree_negatives": op13_rtree_negatives,
}

ORACLE = {
    "op3_norm_sorted_products": """
        WITH usable AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[]) AS BIGINT) AS score
            FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
        SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score
        FROM scored WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY rank <= 10""",
    "op4_cuckoo_dedup": r"""
        WITH normalised AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept, text_sha256
        FROM normalised WINDOW same AS (PARTITION BY text_sha256)""",
    "op12_dynamic_itemsets": r"""
        WITH pieces AS (
            SELECT row_number() OVER () AS piece, lang, words FROM (
                SELECT coalesce(lang, 'und') AS lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda w: w <> '') AS words
                FROM (SELECT lang, unnest(string_split_regex(
                          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[.,;:!?\x0A-\x0D]')) AS p FROM documents))
            WHERE len(words) > 0),
        counts AS (
            SELECT lang, array_to_string(words[i:i + m - 1], ' ') AS phrase, m, count(*) AS c
            FROM (SELECT lang, words, m, unnest(range(1, len(words) - m + 2)) AS i
                  FROM pieces, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(words) >= m)
            GROUP BY ALL),
        candidates AS (SELECT lang, phrase, m, c, string_split(phrase, ' ') AS w FROM counts WHERE m > 1 AND c >= 30),
        hidden AS (
            SELECT DISTINCT s.lang, s.phrase FROM candidates s JOIN (
                SELECT lang, c, array_to_string(w[i:i + k - 1], ' ') AS phrase
                FROM candidates, (SELECT unnest([1, 2, 3]) AS i), (SELECT unnest([2, 3]) AS k)
                WHERE k < m AND i + k - 1 <= m) l
            ON s.lang = l.lang AND s.phrase = l.phrase AND 100 * l.c >= 80 * s.c),
        cuts AS (
            SELECT lang, phrase, c AS a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
            FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates ANTI JOIN hidden USING (lang, phrase))),
        scored AS (
            SELECT x.lang, x.phrase, x.a, k, h.c AS l, t.c AS r,
                   CAST((2000000::HUGEINT * x.a) // (h.c::HUGEINT + t.c) AS BIGINT) AS score
            FROM cuts x JOIN counts h ON h.lang = x.lang AND h.phrase = x.head
            JOIN counts t ON t.lang = x.lang AND t.phrase = x.tail
            QUALIFY row_number() OVER (PARTITION BY x.lang, x.phrase ORDER BY score, k) = 1),
        totals AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM pieces GROUP BY lang)
        SELECT lang, row_number() OVER best AS rank, phrase, a, l, r, n, score
        FROM scored JOIN totals USING (lang)
        WINDOW best AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) QUALIFY rank <= 2000""",
    "op13_rtree_negatives": """
        WITH usable AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
                  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
                   CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
            FROM usable a JOIN usable c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id AS negative_id,
               positive_score, score AS negative_score
        FROM positives JOIN scored USING (anchor_id)
        WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY rank <= 3""",
}
