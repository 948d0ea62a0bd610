"""Registered queries of the training-data operators, ``(spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.llm.brown_lm import lm_scores
from quarry.llm.chat_hmm import format_chats
from quarry.llm.collocations import collocations
from quarry.llm.decontam import SLACK, contamination
from quarry.llm.heap_kmeans import cluster_vectors
from quarry.llm.host_reputation import filter_urls, label_outcomes
from quarry.llm.id_files import encode_and_read
from quarry.llm.near_dedup import near_duplicates
from quarry.llm.oracle_sql import clustering, phrases, url_filter
from quarry.llm.quality_mil import quality_scores
from quarry.llm.sharding import shards_by_bytes
from quarry.llm.sp_viterbi import digests as viterbi_digests
from quarry.llm.tables import table, tokenizer_file
from quarry.llm.token_counts import token_counts
from quarry.llm.topk import top_k


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return viterbi_digests(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards_by_bytes(table(spark, sf_dir, "documents"), 24)


def op8_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


def op9_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_read(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), slack=SLACK)


def op11_heap_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = label_outcomes(table(spark, sf_dir, "labels"))
    return filter_urls(table(spark, sf_dir, "pages"), outcomes).select("page_id", "host", "path", "rule", "verdict")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_exact_topk": op4_exact_topk,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_token_counts": op6_token_counts,
    "op7_sharding": op7_sharding,
    "op8_brown_lm": op8_brown_lm,
    "op9_id_files": op9_id_files,
    "op10_decontamination": op10_decontamination,
    "op11_heap_kmeans": op11_heap_kmeans,
    "op12_collocations": op12_collocations,
    "op13_url_filter": op13_url_filter,
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(coalesce(" + _LOWER.format("text") + r", ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_RUNS = "regexp_extract_all(coalesce(" + _LOWER.format("text") + r", ''), '[^\x20\x09-\x0D]+')"

ORACLE: dict[str, str] = {
    "op2_minhash_near_dedup": f"""
        WITH RECURSIVE d AS (SELECT doc_id, {_RUNS} AS w FROM documents),
        s AS (
            SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS g
            FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) t(i) WHERE len(w) > 0
        ), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
        l AS (SELECT x, y FROM p JOIN n u ON u.doc_id = x JOIN n v ON v.doc_id = y WHERE 100 * c >= 85 * (u.n + v.n - c)),
        e AS (SELECT x AS a, y AS b FROM l UNION ALL SELECT y, x FROM l),
        r AS (SELECT doc_id, doc_id AS c FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.c = e.a),
        m AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
        FROM d LEFT JOIN n ON d.doc_id = n.doc_id JOIN m ON d.doc_id = m.doc_id
    """,
    "op10_decontamination": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
        b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        bw AS (
            SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(list_slice(w, i, i + least(len(w), 13) - 1), ' ') AS g
            FROM b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) t(i) WHERE len(w) > 0
        ), dg AS (
            SELECT r, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
            FROM d, (SELECT DISTINCT n FROM bw) x, unnest(range(1, len(w) - n + 2)) t(i) WHERE len(w) >= n
        ), hits AS (SELECT dg.r, dg.i, dg.n, bw.item_id FROM dg JOIN bw ON dg.n = bw.n AND dg.g = bw.g),
        pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
        it AS (
            SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
            FROM hits GROUP BY r
        ), k AS MATERIALIZED (SELECT row_number() OVER () AS k, item_id, n, list_distinct(string_split(g, ' ')) AS t FROM bw),
        kt AS MATERIALIZED (SELECT k, unnest(t) AS u FROM k),
        dw AS MATERIALIZED (SELECT r, unnest(w) AS u, unnest(range(1, len(w) + 1)) AS p FROM d),
        f AS (SELECT u, count(*) AS f FROM dw GROUP BY u),
        rare AS (SELECT k, kt.u FROM kt LEFT JOIN f ON kt.u = f.u QUALIFY row_number() OVER (PARTITION BY k ORDER BY coalesce(f, 0), kt.u) = 1),
        a AS (SELECT k.k, k.n, len(k.t) AS m, dw.r, dw.p FROM rare JOIN k ON rare.k = k.k JOIN dw ON dw.u = rare.u),
        x AS MATERIALIZED (
            SELECT y.k, y.n, y.m, y.r, y.p, dw.p AS q, dw.u
            FROM (SELECT a.*, unnest(range(p - n - {SLACK - 1}, p + n + {SLACK})) AS q FROM a) y
            JOIN dw ON dw.r = y.r AND dw.p = y.q JOIN kt ON kt.k = y.k AND kt.u = dw.u
            QUALIFY count(DISTINCT dw.u) OVER (PARTITION BY y.k, y.r, y.p) = y.m
        ), ns AS (
            SELECT DISTINCT k, r FROM (
                SELECT s.k, s.r FROM x s JOIN x e ON s.k = e.k AND s.r = e.r AND s.p = e.p AND e.q BETWEEN s.q AND s.q + s.n + {SLACK - 1}
                GROUP BY s.k, s.r, s.p, s.q, s.m HAVING count(DISTINCT e.u) = s.m
            )
        ), nr AS (
            SELECT r, count(DISTINCT item_id) AS n_near, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
            FROM ns JOIN k ON ns.k = k.k GROUP BY r
        )
        SELECT d.doc_id, len(d.w) AS n_words, coalesce(pos.n_hit, 0) AS n_hit, coalesce(it.n_items, 0) AS n_items,
               sha256(coalesce(it.ids, '')) AS items_sha256, coalesce(pos.n_hit, 0) > 0 AND 20 * pos.n_hit >= len(d.w) AS contaminated,
               coalesce(nr.n_near, 0) AS n_near, sha256(coalesce(nr.ids, '')) AS near_sha256
        FROM d LEFT JOIN pos ON d.r = pos.r LEFT JOIN it ON d.r = it.r LEFT JOIN nr ON d.r = nr.r
    """,
    "op4_exact_topk": """
        WITH v AS (
            SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                   CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
        ), r AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op11_heap_kmeans": clustering(),
    "op12_collocations": phrases(),
    "op13_url_filter": url_filter(),
}
