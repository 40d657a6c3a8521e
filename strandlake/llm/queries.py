"""The corpus queries and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.llm import context_tree, decontaminate, exact_dedup, filter_audit, fixity, language_id, near_vectors, pack, repeats, secrets, simhash, token_counts, whitening
from strandlake.llm.common import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.spans_digest(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))  # rows without an id are learned from
    out = language_id.identify(docs, language_id.fit(docs.filter(~held_out)))
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score_documents(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 7 == 2)


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    return pack.pack_documents(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.resolve_duplicates(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    return token_counts.count_tokens(table(spark, sf_dir, "documents"), path("byte_bpe_50k.tiktoken"))


def op10_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as WARC records, audited against a replica with known damage: every 101st record has one byte changed, every 103rd is lost."""
    damaged = F.when(F.col("page_id") % 103 == 5, F.lit(None)).when(F.col("page_id") % 101 == 7, F.concat(F.lit("w"), F.expr("substring(record, 2)"))).otherwise(F.col("record"))
    return fixity.report(table(spark, sf_dir, "pages"), damaged)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """deviation is null where it doesn't fit a long."""
    out = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.col("deviation").try_cast("long"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


OP8_SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""


OP10_SQL = r"""
WITH r AS (
  SELECT page_id, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || coalesce(page_id::VARCHAR, '') || '>' || chr(13) || chr(10)
    || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record
  FROM pages),
l AS (SELECT page_id, sha256(record) AS record_sha256, strlen(record) AS length, count(*) AS copies FROM r GROUP BY ALL),
v AS (SELECT *, ('0x' || record_sha256[:8])::BIGINT % greatest(1, ceil(sum(length) OVER () / 4194304.0))::BIGINT AS volume FROM l)
SELECT page_id, volume, coalesce(sum(length) OVER (PARTITION BY volume ORDER BY page_id NULLS FIRST, record_sha256 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset",
  length, copies, record_sha256, CASE WHEN page_id % 103 = 5 THEN 'missing' WHEN page_id % 101 = 7 THEN 'changed' ELSE 'ok' END AS state
FROM v
"""


OP6_SQL = rf"""
WITH texts AS (SELECT 'd' AS side, doc_id AS id, coalesce(text, '') AS text FROM documents UNION ALL SELECT 'i', item_id, coalesce(text, '') FROM benchmark),
slotted AS (SELECT side, id, regexp_replace(CASE WHEN regexp_matches(text, '[0-9]')
  THEN regexp_replace(regexp_replace(text, '[0-9]+(?:[.,][0-9]+)*', '0n\0 ', 'g'), '(0n[0-9.,]+[ ]+)((?:{decontaminate.UNITS})\b)', '\10u\2', 'g') ELSE text END, '([\p{{Ll}}0-9,;][ ])(\p{{Lu}})', '\10a\2', 'g') AS s FROM texts),
lists AS (SELECT side, id, list_filter(string_split_regex(lower(regexp_replace(s, '0([anu])[\p{{L}}0-9.,]*', '0\1 ', 'g')), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS t, regexp_extract_all(lower(s), '(0[anu][\p{{L}}0-9.,]*|[\p{{L}}\p{{N}}]+)') AS v FROM slotted),
windows AS (SELECT side, id, array_to_string(t[i:i + 4], ' ') AS w, list_filter(v[i:i + 4], lambda x: regexp_matches(x, '^0[anu]')) AS slot
  FROM (SELECT side, id, t, v, unnest(range(1, greatest(len(t) - 4, 1) + 1)) AS i FROM lists WHERE len(t) > 0)),
own AS (SELECT id AS item_id, w, count(*) OVER (PARTITION BY id) AS item_windows FROM (SELECT DISTINCT id, w FROM windows WHERE side = 'i')),
pairs AS (SELECT d.id AS doc_id, item_id, item_windows, count(*) AS matched, count(*) / item_windows AS containment
  FROM (SELECT DISTINCT id, w FROM windows WHERE side = 'd') d JOIN own USING (w) GROUP BY d.id, item_id, item_windows HAVING count(*) / item_windows >= {decontaminate.SIMILARITY}),
zipped AS (SELECT p.doc_id, p.item_id, d.n, unnest(list_zip(i.slot, d.slot)) AS z FROM pairs p
  JOIN (SELECT DISTINCT id, w, slot FROM windows WHERE side = 'i' AND len(slot) > 0) i ON i.id = p.item_id
  JOIN (SELECT id, w, slot, count(*) AS n FROM windows WHERE side = 'd' AND len(slot) > 0 GROUP BY ALL) d ON d.id = p.doc_id AND d.w = i.w),
best AS (SELECT doc_id, item_id, sum(n)::BIGINT AS slots, sum(top) / sum(n) AS slot_consistency FROM (SELECT doc_id, item_id, was, max(n) AS top, sum(n) AS n
  FROM (SELECT doc_id, item_id, z[1] AS was, z[2] AS now, sum(n) AS n FROM zipped GROUP BY ALL) GROUP BY ALL) GROUP BY ALL)
SELECT doc_id, item_id, item_windows::INTEGER AS item_windows, matched, containment, coalesce(slots, 0) AS slots, coalesce(slot_consistency, 1.0) AS slot_consistency
FROM pairs LEFT JOIN best USING (doc_id, item_id) WHERE coalesce(slot_consistency, 1.0) >= {decontaminate.CONSISTENCY}
"""


OP11_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
l AS (SELECT doc_id, max(coalesce((quality = 1)::INT, 0)) AS good, max(coalesce((toxic = 1)::INT, 0)) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
m AS (SELECT part, (len(ws) < {filter_audit.LEAST_WORDS})::INT + 2 * (100 * len(list_distinct(ws)) < {filter_audit.LEAST_DISTINCT} * len(ws))::INT
  + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {filter_audit.MOST_CAPITALS} * length(t))::INT + 8 * regexp_matches(t, '[{filter_audit.MARKS}]')::INT + 16 * coalesce(w.doc_id > first_id, false)::INT AS mask,
  count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM w LEFT JOIN l USING (doc_id) GROUP BY ALL),
f AS (SELECT 2 ** range AS bit, 'ABCDE'[range + 1] AS letter FROM range(5)),
o AS (SELECT a.bit AS b1, b.bit AS b2, c.bit AS b3, d.bit AS b4, e.bit AS b5, a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
  FROM f a JOIN f b ON b.bit <> a.bit JOIN f c ON c.bit NOT IN (a.bit, b.bit) JOIN f d ON d.bit NOT IN (a.bit, b.bit, c.bit) JOIN f e ON e.bit NOT IN (a.bit, b.bit, c.bit, d.bit)),
s AS (SELECT filter_order, i::INTEGER AS step, [b1, b2, b3, b4, b5][i]::INT AS own, coalesce(list_sum([b1, b2, b3, b4, b5][1:i - 1]), 0)::INT AS earlier FROM o, range(1, 6) r(i)),
x AS (SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (mask & (earlier | own) = 0), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (mask & earlier = 0 AND mask & own > 0), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (mask & earlier > 0 AND mask & own > 0), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (mask = own), 0)::BIGINT AS unique_fails,
  coalesce(sum(good) FILTER (mask & earlier = 0 AND mask & own > 0), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (mask & earlier = 0 AND mask & own > 0), 0)::BIGINT AS toxic_lost
  FROM s CROSS JOIN m GROUP BY ALL)
SELECT * EXCLUDE own, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM x
"""


def oracle_sql() -> dict[str, str]:
    return {"op6_benchmark_decontamination": OP6_SQL, "op8_exact_dedup": OP8_SQL, "op10_warc_fixity": OP10_SQL, "op11_filter_audit": OP11_SQL}
