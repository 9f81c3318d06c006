"""Registered queries of this subpackage and, where SQL can express them, their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stargrain.llm import chat_format, decontaminate, importance, language_id, licences, mixing, near_dedup, quality_crf, substring_dedup, token_counts, token_files, topk, whitening
from stargrain.session import scratch_path, tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(table) -> DataFrame``, where table(name) reads a given table."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            tune(spark)
            return fn(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def _fold(parts: int):
    """crc32 of the id as text, modulo ``parts``."""
    return F.crc32(F.col("doc_id").cast("string")) % parts


@query("op1_token_counts")
def _op1(table):
    limit = 2048
    counts = token_counts.stored_counts(table("documents"), limit=limit)
    return counts.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"),
        F.col("cut").alias("chars_within_limit"),
    )


@query("op2_quality_crf")
def _op2(table):
    docs = table("documents")
    model = quality_crf.fit(docs, table("labels"), learn=_fold(5) != 0)
    return quality_crf.score(docs, model).select("doc_id", (_fold(5) == 0).alias("held_out"), "score", "predicted")


@query("op3_source_mixing")
def _op3(table):
    docs = table("documents")
    return mixing.written_mix(docs, scratch_path(docs.sparkSession, "mix")).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken",
        F.get("positions", F.lit(0)).alias("first_position"), F.get("positions", F.lit(1)).alias("second_position"),
    )


@query(
    "op4_exact_top_k",
    """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pair AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pair)
WHERE rank <= 10""",
)
def _op4(table):
    return topk.top_k(table("embeddings"), F.col("vec_id") % 100 == 0)


@query("op5_decontamination")
def _op5(table):
    return decontaminate.contaminated(table("documents"), table("benchmark"))


@query(
    "op6_minhash_near_dedup",
    r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS ws
    FROM documents),
shingle AS (
    SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS s
    FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c
    FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
link AS (
    SELECT u, v FROM shared JOIN size x ON x.doc_id = u JOIN size y ON y.doc_id = v
    WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (
    SELECT doc_id, doc_id AS r FROM w
    UNION
    SELECT v, r FROM reach JOIN link ON u = doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, min(r) AS component_id, doc_id = min(r) AS kept
FROM reach LEFT JOIN size USING (doc_id) GROUP BY doc_id, n""",
)
def _op6(table):
    return near_dedup.near_duplicates(table("documents"), size=4, threshold=80)


@query("op7_language_id")
def _op7(table):
    docs = table("documents")
    found = language_id.identify(docs, learn=_fold(4) != 2)
    return found.select("doc_id", (_fold(4) == 2).alias("held_out"), "lang_pred", "score")


CONTROL_TURNS = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


@query("op8_chat_formatting")
def _op8(table):
    turns = table("conversations").select("conv_id", "turn", "role", "text")
    extra = turns.sparkSession.createDataFrame(CONTROL_TURNS, "conv_id bigint, turn bigint, role string, text string")
    return chat_format.format_and_read(turns.unionByName(extra))


@query("op9_token_files")
def _op9(table):
    return token_files.token_files(table("documents")).select("doc_id", "start", "n_tokens", "ids_crc32")


@query(
    "op10_substring_dedup",
    r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS win
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w)),
first AS (SELECT win, min(doc_id) AS lo FROM win GROUP BY win),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN first USING (win) WHERE doc_id > lo),
word AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
         FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)""",
)
def _op10(table):
    return substring_dedup.remove_repeats(table("documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query(
    "op11_importance_resampling",
    r"""
WITH byte_table AS (
    SELECT list_transform(range(256), lambda b: list_reduce(range(8),
               lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS tab),
w AS (
    SELECT 'd' AS side, doc_id AS id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
    FROM documents
    UNION ALL
    SELECT 'b', item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
    FROM benchmark),
feature AS (
    SELECT side, id, array_to_string(ws[i:i + k - 1], ' ') AS f
    FROM (SELECT side, id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS k))),
one AS (SELECT DISTINCT f FROM feature),
digits AS (SELECT f, hex(encode(f)) AS h FROM one),
bytes AS (
    SELECT f, list_transform(range(1, CAST(len(h) AS BIGINT), 2), lambda i: CAST(
        16 * (instr('0123456789ABCDEF', substr(h, i, 1)) - 1) + instr('0123456789ABCDEF', substr(h, i + 1, 1)) - 1
        AS BIGINT)) AS bs
    FROM digits),
bucket AS (
    SELECT f, xor(list_reduce(bs, lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)
              % 10000 AS bucket
    FROM bytes, byte_table),
used AS (SELECT side, id, bucket FROM feature JOIN bucket USING (f)),
per AS (SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM used GROUP BY bucket),
gain AS (
    SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (sum(s) OVER () + 10000) AS DOUBLE)
                                        / CAST((s + 1) * (sum(t) OVER () + 10000) AS DOUBLE))) AS BIGINT) AS gain
    FROM per),
weight AS (
    SELECT id, count(*) AS n, CAST(sum(gain) AS BIGINT) AS weight
    FROM used JOIN gain USING (bucket) WHERE side = 'd' GROUP BY id),
scored AS (
    SELECT w.id AS doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
               (CAST('0x' || substr(sha256('42:' || w.id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
    FROM w LEFT JOIN weight ON w.id = weight.id WHERE w.side = 'd'),
placed AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
    FROM scored WHERE n_words >= 20)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score,
       CASE WHEN place <= 5 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN placed USING (doc_id)""",
)
def _op11(table):
    found = importance.resampled(table("documents"), table("benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


@query("op12_embedding_whitening")
def _op12(table):
    found = whitening.whitened(table("embeddings"))
    return found.select(
        F.col("id").alias("vec_id"), "component", "n", F.expr("try_cast(deviation AS bigint)").alias("deviation"),
        "whitened", "explained", "identity_error",
    )


@query("op13_licence_scan")
def _op13(table):
    found = licences.scan(table("documents")).withColumnRenamed("id", "doc_id")
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
