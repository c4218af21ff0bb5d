"""The registered queries of the training-data operators.

Each applies its operator, with production parameters, to its whole table.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickscope.llm import (chat_formatting, decontamination, fill_in_middle, hard_negatives, html_extraction, jaccard_join, language_id,
                            quality_rules, sentencepiece_codec, sharding, simhash, substring_dedup, token_output)
from clickscope.llm.tables import read
from clickscope.session import ensure_checkpoint_dir


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(read(spark, sf_dir, "documents"), 40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "byte_start")


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = os.path.join(ensure_checkpoint_dir(spark), "clickscope-tables", f"tokens-{uuid.uuid4().hex[:16]}")
    token_output.write(read(spark, sf_dir, "documents"), path, tokenizer_file("word_bpe_49k.json"), end_id=2)
    return token_output.summary(spark, path)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.passages(read(spark, sf_dir, "documents")).drop("text_key")


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_formatting.render(read(spark, sf_dir, "conversations"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.round_trip(read(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"), with_ids=False)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("text_key")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read(spark, sf_dir, "documents"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components(read(spark, sf_dir, "documents")).drop("text_key", "link_class")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(read(spark, sf_dir, "pages"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.transform(read(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fill_in_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_sharding, op2_jaccard_join, op3_token_output, op4_quality_rules, op5_substring_dedup,
    op6_chat_formatting, op7_sentencepiece, op8_language_id, op9_decontamination, op10_html_extraction,
    op11_hard_negatives, op12_fill_in_middle, op13_simhash)}

ORACLE: dict[str, str] = {
    "op6_chat_formatting": """
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list(struct_pack(r := role, t := text) ORDER BY turn) AS l, count(*) AS n FROM t GROUP BY conv_id),
p AS (SELECT DISTINCT l[1:k] AS l FROM (SELECT l, n, unnest(range(1, n)) AS k FROM c)),
d AS (SELECT l, any_value(n) AS n, min(conv_id) AS conv_id FROM c GROUP BY l),
m AS (SELECT * FROM d ANTI JOIN p USING (l)),
x AS (SELECT conv_id, n, l, unnest(range(0, (n + 199) // 200)) AS part FROM m)
SELECT conv_id, n AS n_turns, CAST(part AS INTEGER) AS part,
       list_aggregate(list_transform(l[part * 200 + 1:part * 200 + 200], lambda e: '<|im_start|>' || replace(coalesce(e.r, 'unknown'), '<|', '< |') || chr(10)
           || replace(coalesce(e.t, ''), '<|', '< |') || '<|im_end|>' || chr(10)), 'string_agg', '') AS rendered
FROM x""",
    "op11_hard_negatives": """
WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3""",
    "op12_fill_in_middle": """
WITH t AS (SELECT doc_id, coalesce(text, '') AS x, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
u AS (SELECT *, regexp_extract_all(x, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS l,
             CAST('0x' || d[1:8] AS BIGINT) AS h1, CAST('0x' || d[9:16] AS BIGINT) AS h2, CAST('0x' || d[17:24] AS BIGINT) AS h3, CAST('0x' || d[25:32] AS BIGINT) AS h4 FROM t),
c AS (SELECT *, len(l) AS n, least(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS a, greatest(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS b,
             CASE WHEN x = '' OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
k AS (SELECT *, array_to_string(l[1:a], '') AS p, array_to_string(l[a + 1:b], '') AS m, array_to_string(l[b + 1:n], '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(p || m || s) AS restored_sha256
FROM k""",
}
