"""Registered queries of the text operators, and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, conversations, decontaminate, packing, quality, resampling, secrets, sharding, simhash, suffixes, templates, tokenfiles, toxicity
from .common import shared_folder, table

#: Folder of the public vocabulary files, the same on every node.
TOKENIZERS = os.environ.get("LLM_TOKENIZERS", "/opt/tokenizers")
BYTE_BPE = f"{TOKENIZERS}/byte_bpe_50k.json"
BYTE_BPE_RANKS = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(table(spark, sf_dir, "documents"), BYTE_BPE, keep_ids=False)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.col("start").cast("long").alias("start"), "similarity")


def op3_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_spans(table(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.shards_by_bytes(table(spark, sf_dir, "documents"), 40)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "capacity")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.size(F.split("text", "\n")).alias("n_lines"))
    cut = templates.dedup_lines(docs, note="dropped")
    return cut.select(
        "doc_id", F.coalesce(F.col("n_lines"), F.lit(0)).cast("long").alias("n_lines"), F.size("dropped").cast("long").alias("n_dropped"),
        F.array_join(F.col("dropped").cast("array<string>"), ",").alias("dropped"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    tokenfiles.write(table(spark, sf_dir, "documents"), path, BYTE_BPE)
    part = lambda which: F.regexp_extract("path", r"part-(\d+)-.*-c(\d+)", which).cast("int")
    return tokenfiles.token_counts(spark, path).select(part(1).alias("part"), part(2).alias("chunk"), "doc_no", "start", "n_tokens", "closed")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality_rules(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_words")


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), BYTE_BPE_RANKS).drop("key")


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampling.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, members = conversations.rebuilt(table(spark, sf_dir, "conversations"))
    return conversations.prefix_trie(turns, members)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe, "op2_decontaminate": op2_decontaminate, "op3_suffixes": op3_suffixes, "op4_sharding": op4_sharding, "op5_toxicity": op5_toxicity, "op6_secrets": op6_secrets,
    "op7_line_dedup": op7_line_dedup, "op8_token_counts": op8_token_counts, "op9_simhash": op9_simhash, "op10_quality": op10_quality,
    "op11_packing": op11_packing, "op12_resampling": op12_resampling, "op13_conversations": op13_conversations,
    "pipeline": pipeline,
}

OP2_SQL = r"""
WITH doc_words AS (
  SELECT DISTINCT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL
), item_words AS (
  SELECT DISTINCT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark WHERE text IS NOT NULL
), doc_shingles AS (
  SELECT doc_id, len(w) AS n_words, unnest(range(0, greatest(len(w) - 4, 1))) AS pos, w FROM doc_words WHERE len(w) > 0
), ds AS (
  SELECT doc_id, n_words, pos, array_to_string(w[pos + 1 : pos + 5], ' ') AS h FROM doc_shingles
), item_shingles AS (
  SELECT item_id, len(w) AS n_words, unnest(range(0, greatest(len(w) - 4, 1))) AS pos, w FROM item_words WHERE len(w) > 0
), items AS (
  SELECT item_id, n_words, array_to_string(w[pos + 1 : pos + 5], ' ') AS h, count(*) AS m FROM item_shingles GROUP BY ALL
), item_sizes AS (
  SELECT item_id, n_words, sum(m) AS i_total FROM items GROUP BY ALL
), starts AS (
  SELECT DISTINCT ds.doc_id, items.n_words AS size, least(ds.pos, greatest(ds.n_words - items.n_words, 0)) AS start FROM ds JOIN items USING (h)
), weighted AS (
  SELECT s.doc_id, s.size, s.start, ds.h, count(*) AS n
  FROM starts s JOIN ds ON ds.doc_id IS NOT DISTINCT FROM s.doc_id AND ds.pos >= s.start AND ds.pos < s.start + greatest(s.size - 4, 1) GROUP BY ALL
), totals AS (
  SELECT doc_id, size, start, sum(n) AS w_total FROM weighted GROUP BY ALL
), shared AS (
  SELECT w.doc_id, w.size, w.start, i.item_id, sum(least(w.n, i.m)) AS common FROM weighted w JOIN items i ON i.h = w.h AND i.n_words = w.size GROUP BY ALL
), found AS (
  SELECT s.doc_id, s.item_id, s.start, common / (w_total + i_total - common) AS similarity
  FROM shared s JOIN totals t ON s.doc_id IS NOT DISTINCT FROM t.doc_id AND s.size = t.size AND s.start = t.start
  JOIN item_sizes i ON s.item_id IS NOT DISTINCT FROM i.item_id
)
SELECT doc_id, item_id, start, similarity FROM found WHERE similarity >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1
"""

OP10_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d
), windows AS (
  SELECT r, i, array_to_string(words[i : i + 7], ' ') AS win FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)
), repeats AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM (SELECT *, count(*) OVER (PARTITION BY r, win) AS n FROM windows) WHERE n > 1) GROUP BY r
), lines AS (
  SELECT r, doc_id, host, unnest(string_split(t, chr(10))) AS line FROM d
), worded AS (
  SELECT r, doc_id, host, line, regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000'), '[^\x20\x09-\x0D]+') AS lw FROM lines
), dups AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM worded WHERE len(lw) > 0 GROUP BY r
), held AS (
  SELECT r, doc_id, host, array_to_string(lw, ' ') AS norm, sum(len(lw)) AS n FROM worded WHERE len(lw) > 0 GROUP BY ALL
), often AS (
  SELECT host, norm, min(doc_id) AS first_doc FROM held GROUP BY host, norm HAVING count(DISTINCT doc_id) > 50
), lost AS (
  SELECT r, sum(n) AS lost FROM held JOIN often USING (host, norm) WHERE doc_id IS DISTINCT FROM first_doc GROUP BY r
), facts AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(lost, 0) AS BIGINT) AS n_removed_words
  FROM w LEFT JOIN dups USING (r) LEFT JOIN repeats USING (r) LEFT JOIN lost USING (r)
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM facts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_words - n_removed_words >= 0.3 * n_words AS kept, n_removed_words FROM judged
"""

#: CRC32 of the strings of a column: a table of 256 remainders made by the rule, then byte by byte.
CRC32_SQL = r"""
crc_steps AS (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) r(i)
), crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM crc_steps
), crc_bytes AS (
  SELECT w, hex(encode(w)) AS x FROM crc_words
), crc AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(x), 2), lambda i: CAST('0x' || substr(x, i, 2) AS BIGINT))),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS c FROM crc_bytes, crc_table
)"""

OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
), i AS (
  SELECT list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark
), held AS (
  SELECT r, w, count(*) AS n FROM (SELECT r, unnest(w) AS w FROM d) GROUP BY ALL
), wanted AS (
  SELECT w, count(*) AS n FROM (SELECT unnest(w) AS w FROM i) GROUP BY ALL
), crc_words AS (
  SELECT w FROM held UNION SELECT w FROM wanted
),
"""[:-1] + CRC32_SQL + r""", s AS (
  SELECT c % 10000 AS b, sum(n) AS s FROM held JOIN crc USING (w) GROUP BY 1
), t AS (
  SELECT c % 10000 AS b, sum(n) AS t FROM wanted JOIN crc USING (w) GROUP BY 1
), sums AS (
  SELECT coalesce((SELECT sum(s) FROM s), 0) AS all_s, coalesce((SELECT sum(t) FROM t), 0) AS all_t
), gain AS (
  SELECT b, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (all_s + 10000)::DOUBLE / ((coalesce(s, 0) + 1)::DOUBLE * (all_t + 10000)::DOUBLE))) AS BIGINT) AS g FROM s FULL JOIN t USING (b), sums
), summed AS (
  SELECT r, sum(n * g)::DOUBLE AS total FROM held JOIN crc USING (w) JOIN gain ON gain.b = c % 10000 GROUP BY r
), weighed AS (
  SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_features, CASE WHEN len(w) = 0 THEN 0 ELSE CAST(floor(total / len(w)) AS BIGINT) END AS weight,
    CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h FROM d LEFT JOIN summed USING (r)
), scored AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM weighed
), placed AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank FROM scored LEFT JOIN placed USING (r)
"""

OP13_SQL = r"""
WITH rows AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS k FROM conversations WHERE conv_id IS NOT NULL
), crc_words AS (
  SELECT DISTINCT CAST(c AS VARCHAR) AS w FROM rows
),""" + CRC32_SQL + r""", convs AS (
  SELECT DISTINCT rows.c, crc.c % 4 AS h FROM rows JOIN crc ON w = CAST(rows.c AS VARCHAR)
), turns AS (
  SELECT convs.c, 0 AS own, rows.k, rows.role, rows.text FROM convs JOIN rows ON rows.c = convs.c - convs.c % 20 AND rows.k <= h
  UNION ALL SELECT convs.c, 1, rows.k, rows.role, rows.text FROM convs JOIN rows ON rows.c = convs.c AND rows.k > h
), whole AS (
  SELECT convs.c, coalesce(list({'role': role, 'text': text} ORDER BY own, k) FILTER (role IS NOT NULL), []) AS t FROM convs LEFT JOIN turns USING (c) GROUP BY convs.c
), ways AS (
  SELECT c, len(t) AS whole, d AS depth, md5(CAST(t[1:d] AS VARCHAR) || chr(1) || CAST(list_transform(t[1:d], lambda x: [length(x.role), length(x.text)]) AS VARCHAR)) AS node,
    CASE WHEN d > 0 THEN md5(CAST(t[1:d - 1] AS VARCHAR) || chr(1) || CAST(list_transform(t[1:d - 1], lambda x: [length(x.role), length(x.text)]) AS VARCHAR)) END AS parent,
    CASE WHEN d > 0 THEN len(regexp_extract_all(t[d].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS words
  FROM whole, unnest(range(0, len(t) + 1)) AS x(d)
), nodes AS (
  SELECT depth, node, any_value(parent) AS parent, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (whole = depth), '')) AS ends_sha256 FROM ways GROUP BY depth, node
), children AS (
  SELECT depth - 1 AS depth, parent AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
), full_nodes AS (
  SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (depth, node)
), below AS (
  SELECT ways.depth, ways.node, sum(CASE WHEN u.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((u.n_convs - 1) * u.words) AS saved_tokens
  FROM ways JOIN ways AS deep ON deep.c = ways.c AND deep.depth >= ways.depth JOIN full_nodes u ON u.depth = deep.depth AND u.node = deep.node AND u.conv_id = ways.c GROUP BY ALL
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN below b USING (depth, node) LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.node = n.parent
"""

ORACLES: dict[str, str] = {"op2_decontaminate": OP2_SQL, "op10_quality": OP10_SQL, "op12_resampling": OP12_SQL, "op13_conversations": OP13_SQL}
