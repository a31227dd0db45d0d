"""The queries of this subpackage: each applies one operator to its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import debruijn, decontaminate, exact_dedup, minhash, ordering, packing, quality, suffixarray, suffixtree, toxicity
from cadenza.llm.common import Scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op3_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixtree.score(_table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.score(docs, quality.train(docs, _table(spark, sf_dir, "labels"))).select("doc_id", "held_out", "score", "predicted")


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents")).drop("text_sha256")


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debruijn.repeated_spans(_table(spark, sf_dir, "documents")).drop("spans")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents")).drop("locator")


def op9_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixarray.repeated_bytes(_table(spark, sf_dir, "documents")).drop("spans")


def op10_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.materialise(_table(spark, sf_dir, "documents"), Scratch(spark, "shards").dir("shards"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontaminate": op1_decontaminate,
        "op2_packing": op2_packing,
        "op3_suffix_tree": op3_suffix_tree,
        "op4_toxicity": op4_toxicity,
        "op5_minhash": op5_minhash,
        "op6_substrings": op6_substrings,
        "op7_exact_dedup": op7_exact_dedup,
        "op8_quality": op8_quality,
        "op9_suffix_array": op9_suffix_array,
        "op10_training_order": op10_training_order,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontaminate": r"""
            WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
            b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
            bi AS (SELECT item_id, words, unnest(range(greatest(len(words) - 12, 1)))::BIGINT AS i FROM b WHERE len(words) > 0),
            bw AS (SELECT DISTINCT item_id, list_aggregate(words[i + 1 : i + 13], 'string_agg', ' ') AS win, len(words[i + 1 : i + 13])::BIGINT AS n FROM bi),
            ns AS (SELECT DISTINCT n FROM bw),
            dn AS (SELECT doc_id, words, n, unnest(range(greatest(len(words) - n + 1, 0)))::BIGINT AS i FROM w CROSS JOIN ns),
            dw AS (SELECT doc_id, i, n, list_aggregate(words[i + 1 : i + n], 'string_agg', ' ') AS win FROM dn),
            hit AS (SELECT doc_id, i, d.n, item_id FROM dw d JOIN bw USING (win) WHERE d.n = bw.n),
            cover AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
            its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
            SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
                   sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
            FROM w LEFT JOIN cover USING (doc_id) LEFT JOIN its USING (doc_id)""",
        "op5_minhash": r"""
            WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
            s AS (SELECT DISTINCT doc_id, list_aggregate(words[i + 1 : i + 5], 'string_agg', ' ') AS sh FROM (SELECT doc_id, words, unnest(range(greatest(len(words) - 4, 1))) AS i FROM w WHERE len(words) > 0)),
            n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
            shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (sh) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
            link AS (SELECT a, b FROM shared JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 75 * (x.n + y.n - c)),
            reach AS (SELECT a AS doc_id, b AS other FROM link UNION SELECT r.doc_id, l.b FROM reach r JOIN link l ON r.other = l.a),
            least AS (SELECT doc_id, min(other) AS m FROM reach GROUP BY doc_id)
            SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id, doc_id <= coalesce(m, doc_id) AS kept
            FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN least USING (doc_id)""",
        "op6_substrings": r"""
            WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
            win AS (SELECT doc_id, i, md5(list_aggregate(words[i + 1 : i + 35], 'string_agg', ' ')) AS h FROM (SELECT doc_id, words, unnest(range(greatest(len(words) - 34, 0))) AS i FROM w)),
            rep AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
            gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM win SEMI JOIN rep USING (h)),
            word AS (SELECT doc_id, words[p + 1] AS word, p FROM (SELECT doc_id, words, unnest(range(len(words))) AS p FROM w)),
            kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
            SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
            FROM w LEFT JOIN kept USING (doc_id)""",
        "op7_exact_dedup": """
            SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
                   doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
            FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    }
