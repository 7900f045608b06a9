"""Queries of the operators over the test tables: (spark, folder of tables) -> DataFrame."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    audit,
    bpe,
    bytecnn,
    chat,
    infill,
    lbl,
    licenses,
    maxscore,
    minmax,
    tiling,
    tokenfiles,
    toxicity,
    urls,
)
from ..session import new_folder
from .frames import fold, parquet, prepare

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"
#: What the language and toxicity models learn from and what is held out; likewise for the LM.
FOLDS, HELD_OUT = 4, 2
LM_FOLDS, LM_HELD_OUT = 5, 1
PREDICTED_FROM = 0.3

# The rules of the URL query, and patterns of hosts that are blocked besides.
RULES = [
    urls.domain_rule("allow", "org/"),
    urls.domain_rule("block", "example.org/es/"),
    urls.domain_rule("block", "example.org/en/1"),
    urls.domain_rule("allow", "com/fr/"),
    urls.domain_rule("block", "com/de/"),
]
BLOCKED = [
    urls.Rule(name, "block", pattern)
    for name, pattern in (
        ("spam", "~.spam-~/*"),
        ("pills", "~-pills.~/*"),
        ("adult", "~.adult-~/*"),
        ("bets", "~-bets.~/*"),
    )
]


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return parquet(prepare(spark), folder, "documents")


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return tiling.contamination(docs, parquet(spark, folder, "benchmark"))


def op2_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    held_out = fold("doc_id", LM_FOLDS) == LM_HELD_OUT
    docs = documents(spark, folder).select("doc_id", "text", held_out.alias("held_out"))
    model, counts, shares = lbl.counted(docs.filter(~F.col("held_out")))
    found = lbl.numbered(docs, model, carried=("held_out",))
    model = lbl.fit(model, shares, found.filter(~F.col("held_out")))
    return lbl.scored(found, model, counts, carried=("held_out",))


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    held_out = fold("doc_id", FOLDS) == HELD_OUT
    net = bytecnn.train(docs.filter(~held_out))
    return docs.select(
        "doc_id", held_out.alias("held_out"), bytecnn.predict(F.col("text"), net).alias("p")
    ).select("doc_id", "held_out", "p.*")


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    held_out = fold("doc_id", FOLDS) == HELD_OUT
    labels = parquet(spark, folder, "labels").filter(~held_out)
    index = toxicity.train(docs, labels)
    return (
        docs.select(
            "doc_id", held_out.alias("held_out"), toxicity.score(F.col("text"), index).alias("t")
        )
        .withColumn("predicted", (F.col("t.score") >= PREDICTED_FROM).cast("int"))
        .select("doc_id", "held_out", "t.score", "predicted", "t.neighbours", "t.terms")
    )


def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encoded_documents(documents(spark, folder), public_tokenizers.path(VOCABULARY))


def op6_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = parquet(prepare(spark), folder, "embeddings")
    return maxscore.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


def op7_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scanned(documents(spark, folder))


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = parquet(prepare(spark), folder, "pages")
    found = urls.judged(pages, RULES, hidden=BLOCKED)
    return found.select("page_id", "host", "path", "rule", "verdict")


def op9_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return minmax.near_duplicates(documents(spark, folder), shingle_words=2)


def op10_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)],
        "conv_id long, turn long, role string, text string",
    )
    turns = parquet(prepare(spark), folder, "conversations")
    return chat.digests(chat.examples(turns.select(extra.columns).union(extra)))


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    flags = {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1}
    return audit.audit(documents(spark, folder), parquet(spark, folder, "labels"), flags)


def op12_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "token-files")
    tokenfiles.write(documents(spark, folder), path, public_tokenizers.path(TOKENIZER))
    return tokenfiles.digests(spark, path)


def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return infill.digests(infill.transformed(documents(spark, folder)))


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_lm_score,
        op3_language_id,
        op4_toxicity,
        op5_byte_bpe,
        op6_top_k,
        op7_licenses,
        op8_url_filter,
        op9_near_duplicates,
        op10_chat_format,
        op11_filter_audit,
        op12_token_files,
        op13_fill_in_middle,
    )
}

SQL = {
    "op6_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(
                embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
        ), r AS (
            SELECT *, CAST(row_number() OVER (
                PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op8_url_filter": r"""
        WITH u AS (
            SELECT page_id, CASE WHEN strpos(url, '://') > 0
                THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
            FROM pages
        ), p AS (
            SELECT page_id,
                   translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM u
        ), r AS (
            SELECT *, CASE
                WHEN ends_with('.' || host, '.example.org') AND starts_with(path, '/en/1')
                    THEN 'example.org/en/1'
                WHEN ends_with('.' || host, '.example.org') AND starts_with(path, '/es/')
                    THEN 'example.org/es/'
                WHEN ends_with('.' || host, '.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
                WHEN ends_with('.' || host, '.com') AND starts_with(path, '/de/') THEN 'com/de/'
                WHEN ends_with('.' || host, '.org') AND starts_with(path, '/') THEN 'org/'
            END AS rule
            FROM p
        )
        SELECT page_id, host, path, rule, CASE
            WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block'
            WHEN rule IS NOT NULL THEN 'allow'
            WHEN starts_with(path, '/') AND (
                '.' || host LIKE '%.spam-%' OR '.' || host LIKE '%-pills.%'
                OR '.' || host LIKE '%.adult-%' OR '.' || host LIKE '%-bets.%') THEN 'block'
            ELSE 'allow' END AS verdict
        FROM r
    """,
    "op11_filter_audit": r"""
        WITH d AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
        ), w AS (
            SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
                   min(doc_id) OVER (PARTITION BY t) AS first
            FROM d
        ), l AS (
            SELECT doc_id, max(CAST(coalesce(quality = 1, false) AS INT)) AS good,
                   max(CAST(coalesce(toxic = 1, false) AS INT)) AS toxic
            FROM labels GROUP BY doc_id
        ), f AS (
            SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                   (CASE WHEN len(words) < 100 THEN 'A' ELSE '' END)
                || (CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END)
                || (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t)
                    THEN 'C' ELSE '' END)
                || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END)
                || (CASE WHEN w.doc_id > first THEN 'E' ELSE '' END) AS fails
            FROM w LEFT JOIN l ON w.doc_id = l.doc_id
        ), g AS (
            SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
            FROM f GROUP BY part, fails
        ), x AS (
            SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
        ), orders AS (
            SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
            FROM x a, x b, x c, x d, x e
            WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
        ), steps AS (
            SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS filter,
                   filter_order[1:step - 1] AS earlier
            FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
        ), s AS (
            SELECT part, filter_order, step, any_value(filter) AS filter,
                   sum(n) AS total,
                   coalesce(sum(n) FILTER (is_failing AND NOT is_gone), 0) AS removed,
                   coalesce(sum(n) FILTER (is_failing AND is_gone), 0) AS redundant,
                   coalesce(sum(n) FILTER (fails = filter), 0) AS unique_fails,
                   coalesce(sum(good) FILTER (is_failing AND NOT is_gone), 0) AS good_lost,
                   coalesce(sum(toxic) FILTER (is_failing AND NOT is_gone), 0) AS toxic_lost
            FROM (
                SELECT *, contains(fails, filter) AS is_failing,
                       fails <> '' AND translate(earlier, fails, '') <> earlier AS is_gone
                FROM g, steps
            )
            GROUP BY part, filter_order, step
        )
        SELECT part, filter_order, step,
               CAST(total - sum(removed) OVER (
                   PARTITION BY part, filter_order ORDER BY step) AS BIGINT) AS kept,
               CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
               CAST(unique_fails AS BIGINT) AS unique_fails,
               CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
               CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
        FROM s
    """,
    "op13_fill_in_middle": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines,
                   sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
            FROM documents
        ), c AS (
            SELECT doc_id, t, lines, len(lines) AS n,
                   CAST('0x' || h[1:8] AS UBIGINT) % (len(lines) + 1) AS x,
                   CAST('0x' || h[9:16] AS UBIGINT) % (len(lines) + 1) AS y,
                   CASE WHEN t = '' OR regexp_matches(t, '<[PSM]>')
                             OR CAST('0x' || h[17:24] AS UBIGINT) % 100 >= 100 THEN 'plain'
                        WHEN CAST('0x' || h[25:32] AS UBIGINT) % 100 < 50 THEN 'spm'
                        ELSE 'psm' END AS form
            FROM d
        ), p AS (
            SELECT doc_id, n, form, t,
                   array_to_string(lines[1:least(x, y)], '') AS prefix,
                   array_to_string(lines[least(x, y) + 1:greatest(x, y)], '') AS middle,
                   array_to_string(lines[greatest(x, y) + 1:], '') AS suffix
            FROM c
        )
        SELECT doc_id, CAST(n AS BIGINT) AS n, form,
               CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t
                   WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                   ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(CASE form WHEN 'plain' THEN t ELSE prefix || middle || suffix END)
                   AS restored_sha256
        FROM p
    """,
}
