"""The operators of this subpackage bound to the given tables, and their SQL twins for DuckDB."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.session import written
from linkwright.llm import (
    alignment, bpe, chat, decontam, licenses, lm, merkle, minhash, rules, sharding, token_counts, vector_join, whitening,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Records in an archive file.
ARCHIVE_RECORDS = 2000


def op1_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as archive records, against a replica read by the places of the archive's index.

    By a hash of the url a record of the replica has another byte, ends half way, or is lost; behind the end of every file
    stands one record more. Digests and lengths are those of the replica's own bytes.
    """
    pages = table(spark, sf_dir, "pages").withColumn("damage", F.substring(F.md5(F.coalesce("url", F.lit(""))), 1, 2))
    file = F.concat(F.lit("archive-"), F.floor(F.coalesce("page_id", F.lit(0)) / ARCHIVE_RECORDS))
    record = merkle.warc_record(F.col("url"), F.col("html"))
    copied = F.when(F.col("damage") == "00", F.overlay(record, F.lit("1"), F.lit(8))).when(
        F.col("damage") == "02", F.left(record, F.floor(F.length(record) / 2).cast("int")))
    pages = pages.withColumns({"copy_length": F.octet_length(copied).cast("bigint"), "copy_digest": F.sha2(copied, 256)})
    first = written(merkle.records(pages, file, ["page_id"], record, "page_id", "damage", "copy_length", "copy_digest"), "records")
    copy = first.filter("damage != '01'").select(
        "file", "offset", F.coalesce("copy_length", "length").alias("length"), F.coalesce("copy_digest", "digest").alias("digest"))
    late = merkle.warc_record(F.col("file"), F.lit("late"))
    more = first.groupBy("file").agg(F.max(F.col("offset") + F.col("length")).alias("offset")).select(
        "file", "offset", F.octet_length(late).cast("bigint").alias("length"), F.sha2(late, 256).alias("digest"))
    found = merkle.audit(first, copy.union(more))
    return found.join(first.select("file", "offset", "page_id"), ["file", "offset"], "left").select(
        "page_id", "file", "offset", "kind", "primary_digest", "replica_digest")


def op2_best_fit_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of nearly equal bytes."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 40)


#: Bytes of a shard of fixed capacity.
SHARD_BYTES = 4 << 20


def capacity_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in as few shards of fixed capacity as best fit needs."""
    return sharding.capacity_shards(table(spark, sf_dir, "documents"), SHARD_BYTES)


def op3_minhash_stars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


#: A conversation that says the marks of common templates.
PROBE_ID, PROBE_TEXT = -7, "\\### Assistant: </turn> ok"


def op4_schema_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that says marks of templates, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(PROBE_ID).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE_TEXT).alias("text"))
    return chat.report(rows.union(probe))


def op5_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bigram scores of all documents under the counts of all others."""
    found = lm.scores(table(spark, sf_dir, "documents"))
    return found.withColumns({c: F.round(c, 6) for c in ("log_score", "mean_log")})


def op5_trigram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trigram scores of all documents under the counts of all others, backing off to two words and to one."""
    found = lm.scores(table(spark, sf_dir, "documents"), 3)
    return found.withColumns({c: F.round(c, 6) for c in ("log_score", "mean_log")})


def op6_window_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents hold 13-word windows of the benchmark."""
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_pivot_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all vectors with equal labels."""
    return vector_join.linked_vectors(table(spark, sf_dir, "embeddings"), 0.93)


def op8_template_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and accepted license templates of all documents."""
    return licenses.report(table(spark, sf_dir, "documents"))


def op9_bpe_prefix_dp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts to ids of the multilingual byte-level vocabulary and back."""
    docs = table(spark, sf_dir, "documents")
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learnt from the labelled ones that are not held out."""
    return rules.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_block_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of all vectors."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_spliced_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op13_fragment_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers over all documents."""
    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {
    "op1_merkle_audit": op1_merkle_audit,
    "op2_best_fit_shards": op2_best_fit_shards,
    "capacity_shards": capacity_shards,
    "op3_minhash_stars": op3_minhash_stars,
    "op4_schema_fingerprints": op4_schema_fingerprints,
    "op5_backoff_scores": op5_backoff_scores,
    "op5_trigram_scores": op5_trigram_scores,
    "op6_window_overlap": op6_window_overlap,
    "op7_pivot_cells": op7_pivot_cells,
    "op8_template_automata": op8_template_automata,
    "op9_bpe_prefix_dp": op9_bpe_prefix_dp,
    "op10_rule_ensemble": op10_rule_ensemble,
    "op11_block_whitening": op11_block_whitening,
    "op12_spliced_counts": op12_spliced_counts,
    "op13_fragment_alignment": op13_fragment_alignment,
}

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN_WORDS = f"regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_SPACED_WORDS = f"regexp_extract_all({_LOWERED}, '[^\\x20\\x09-\\x0D]+')"

_PHRASES = ", ".join(f"({len(p.split())}, '{p}', '{label}')" for p, label in licenses.PHRASES.items())
_TEMPLATES = ", ".join(f"('{name}', '{licenses.template_pattern(text)}')" for name, text in licenses.TEMPLATES.items())


def _warc(url: str, body: str) -> str:
    """SQL for the text of a WARC response record."""
    end = "chr(13) || chr(10)"
    return (f"'WARC/1.0' || {end} || 'WARC-Type: response' || {end} || 'WARC-Target-URI: ' || {url} || {end} || 'Content-Length: ' "
            f"|| strlen({body}) || {end} || {end} || {body} || {end} || {end}")


ORACLES: dict[str, str] = {
    "op1_merkle_audit": f"""
        WITH r AS (
            SELECT page_id, 'archive-' || (coalesce(page_id, 0) // {ARCHIVE_RECORDS}) AS file,
                   substr(md5(coalesce(url, '')), 1, 2) AS damage, {_warc("coalesce(url, '')", "coalesce(html, '')")} AS record
            FROM pages),
        o AS (
            SELECT page_id, file, damage, record, CAST(coalesce(sum(strlen(record)) OVER (
                PARTITION BY file ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
            FROM r)
        SELECT page_id, file, "offset", CASE damage WHEN '01' THEN 'missing' ELSE 'changed' END AS kind,
               sha256(record) AS primary_digest,
               CASE damage WHEN '00' THEN sha256('WARC/1.1' || substr(record, 9))
                           WHEN '02' THEN sha256(left(record, length(record) // 2)) END AS replica_digest
        FROM o WHERE damage IN ('00', '01', '02')
        UNION ALL SELECT NULL, file, CAST(max("offset" + strlen(record)) AS BIGINT), 'extra', NULL, sha256({_warc("file", "'late'")})
        FROM o GROUP BY file""",
    "op3_minhash_stars": f"""
        WITH RECURSIVE d AS (SELECT doc_id, {_SPACED_WORDS} AS w FROM documents),
        s AS (
            SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n_shingles FROM s GROUP BY doc_id),
        meets AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM s x JOIN s y USING (shingle)
                 WHERE x.doc_id != y.doc_id GROUP BY ALL),
        links AS (SELECT a, b FROM meets JOIN n p ON a = p.doc_id JOIN n q ON b = q.doc_id
                  WHERE 100 * n >= 75 * (p.n_shingles + q.n_shingles - n)),
        reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
        least AS (SELECT a, min(b) AS least FROM reach GROUP BY a)
        SELECT d.doc_id, coalesce(n_shingles, 0) AS n_shingles, least(d.doc_id, coalesce(least, d.doc_id)) AS component_id,
               d.doc_id <= coalesce(least, d.doc_id) AS kept,
               CASE WHEN shingles IS NULL THEN d.doc_id ELSE min(d.doc_id) OVER (PARTITION BY shingles) END AS class_id
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least ON least.a = d.doc_id
        LEFT JOIN (SELECT doc_id, md5(string_agg(shingle, chr(10) ORDER BY shingle)) AS shingles FROM s GROUP BY doc_id)
            USING (doc_id)""",
    "op4_schema_fingerprints": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, turn, role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)),
        e AS (SELECT *, replace(replace(role || text, '\', '\s'), '<', '\l') AS escaped,
                     CASE WHEN role = 'assistant' THEN text ELSE '' END AS learnt FROM t)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(sum(length(learnt)) AS BIGINT) AS loss_chars,
               sha256(string_agg(learnt, '' ORDER BY turn, role, text)) AS loss_sha256,
               CAST(sum(length(escaped) + length('<turn><says></turn>')) AS BIGINT) AS formatted_chars
        FROM e GROUP BY conv_id""",
    "op5_backoff_scores": f"""
        WITH d AS (SELECT doc_id, {_SPACED_WORDS} AS w FROM documents),
        t AS (SELECT doc_id, i, w[i] AS b, CASE WHEN i > 1 THEN w[i - 1] END AS a
              FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
        one AS (SELECT b, count(*) AS n FROM t GROUP BY b),
        two AS (SELECT a, b, count(*) AS n FROM t WHERE a IS NOT NULL GROUP BY a, b),
        own1 AS (SELECT doc_id, b, count(*) AS n FROM t GROUP BY ALL),
        own2 AS (SELECT doc_id, a, b, count(*) AS n FROM t WHERE a IS NOT NULL GROUP BY ALL),
        size AS (SELECT sum(n) AS n FROM one),
        c AS (
            SELECT t.doc_id, t.a, two.n - own2.n AS ab, one_a.n - own_a.n AS ca, one.n - own1.n AS cb,
                   greatest(size.n - len(d.w), 1) AS rest
            FROM t JOIN d ON d.doc_id = t.doc_id JOIN one ON one.b = t.b JOIN own1 ON own1.doc_id = t.doc_id AND own1.b = t.b
            LEFT JOIN two ON two.a = t.a AND two.b = t.b LEFT JOIN own2 ON own2.doc_id = t.doc_id AND own2.a = t.a AND own2.b = t.b
            LEFT JOIN one one_a ON one_a.b = t.a LEFT JOIN own1 own_a ON own_a.doc_id = t.doc_id AND own_a.b = t.a, size),
        s AS (
            SELECT doc_id, CASE WHEN ab > 0 THEN 1 ELSE 0 END AS seen,
                   CASE WHEN ab > 0 THEN log10(ab / ca)
                        ELSE CASE WHEN a IS NULL THEN 0 ELSE log10(0.4) END
                             + CASE WHEN cb > 0 THEN log10(cb / rest) ELSE log10(0.4) - log10(rest) END END AS v
            FROM c),
        sums AS (SELECT doc_id, CAST(sum(seen) AS BIGINT) AS n_seen, sum(v) AS log_score FROM s GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_seen, 0) AS n_seen,
               round(coalesce(log_score, 0.0::DOUBLE), 6) AS log_score,
               round(CASE WHEN len(w) > 0 THEN log_score / len(w) END, 6) AS mean_log
        FROM d LEFT JOIN sums USING (doc_id)""",
    "op5_trigram_scores": f"""
        WITH d AS (SELECT doc_id, {_SPACED_WORDS} AS w FROM documents),
        t AS (SELECT doc_id, i, w[i] AS c, CASE WHEN i > 1 THEN w[i - 1] END AS b, CASE WHEN i > 2 THEN w[i - 2] END AS a
              FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
        own1 AS (SELECT doc_id, c, count(*) AS n FROM t GROUP BY ALL),
        own2 AS (SELECT doc_id, b, c, count(*) AS n FROM t WHERE b IS NOT NULL GROUP BY ALL),
        own3 AS (SELECT doc_id, a, b, c, count(*) AS n FROM t WHERE a IS NOT NULL GROUP BY ALL),
        one AS (SELECT doc_id, c, sum(n) OVER (PARTITION BY c) - n AS n FROM own1),
        two AS (SELECT doc_id, b, c, sum(n) OVER (PARTITION BY b, c) - n AS n FROM own2),
        three AS (SELECT doc_id, a, b, c, sum(n) OVER (PARTITION BY a, b, c) - n AS n FROM own3),
        size AS (SELECT count(*) AS n FROM t),
        k AS (
            SELECT t.doc_id, t.a, t.b, three.n AS abc, ab.n AS ab, bc.n AS bc, one_b.n AS nb, one_c.n AS nc,
                   greatest(size.n - len(d.w), 1) AS rest
            FROM t JOIN d ON d.doc_id = t.doc_id JOIN one one_c ON one_c.doc_id = t.doc_id AND one_c.c = t.c
            LEFT JOIN one one_b ON one_b.doc_id = t.doc_id AND one_b.c = t.b
            LEFT JOIN two bc ON bc.doc_id = t.doc_id AND bc.b = t.b AND bc.c = t.c
            LEFT JOIN two ab ON ab.doc_id = t.doc_id AND ab.b = t.a AND ab.c = t.b
            LEFT JOIN three ON three.doc_id = t.doc_id AND three.a = t.a AND three.b = t.b AND three.c = t.c
            CROSS JOIN size),
        s AS (
            SELECT doc_id, CASE WHEN abc > 0 THEN 1 ELSE 0 END AS seen,
                   CASE WHEN abc > 0 THEN log10(abc / ab)
                        ELSE CASE WHEN a IS NULL THEN 0 ELSE log10(0.4) END
                             + CASE WHEN bc > 0 THEN log10(bc / nb)
                                    ELSE CASE WHEN b IS NULL THEN 0 ELSE log10(0.4) END
                                         + CASE WHEN nc > 0 THEN log10(nc / rest) ELSE log10(0.4) - log10(rest) END END END AS v
            FROM k),
        sums AS (SELECT doc_id, CAST(sum(seen) AS BIGINT) AS n_seen, sum(v) AS log_score FROM s GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_seen, 0) AS n_seen,
               round(coalesce(log_score, 0.0::DOUBLE), 6) AS log_score,
               round(CASE WHEN len(w) > 0 THEN log_score / len(w) END, 6) AS mean_log
        FROM d LEFT JOIN sums USING (doc_id)""",
    "op6_window_overlap": f"""
        WITH d AS (SELECT doc_id, {_PLAIN_WORDS} AS w FROM documents),
        b AS (SELECT item_id, {_PLAIN_WORDS} AS w FROM benchmark),
        win AS (
            SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS win
            FROM (SELECT item_id, w, least(13, len(w)) AS size, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i
                  FROM b WHERE len(w) > 0)),
        places AS (
            SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS win
            FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
                  FROM d, (SELECT DISTINCT size FROM win) WHERE len(w) >= size)),
        found AS (SELECT doc_id, i, places.size, item_id FROM places JOIN win USING (win)),
        hits AS (SELECT doc_id, count(DISTINCT j) AS n_hit
                 FROM (SELECT doc_id, unnest(range(i, i + size)) AS j FROM found) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
                  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op7_pivot_cells": """
        WITH RECURSIVE v AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, label FROM embeddings
            WHERE embedding IS NOT NULL AND label IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x != 0)) > 0),
        links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id != y.vec_id
                  WHERE list_cosine_similarity(x.e, y.e) >= 0.93),
        reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
        least AS (SELECT a, min(b) AS least FROM reach GROUP BY a),
        n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
        SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(least, vec_id)) AS component_id,
               vec_id <= coalesce(least, vec_id) AS kept
        FROM embeddings LEFT JOIN least ON least.a = vec_id LEFT JOIN n ON n.a = vec_id""",
    "op8_template_automata": f"""
        WITH d AS (SELECT doc_id, {_PLAIN_WORDS} AS w FROM documents),
        starts AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
        base AS (
            SELECT doc_id, i - 1 AS place, label FROM starts JOIN (VALUES {_PHRASES}) p(n, phrase, label)
                ON w[i] = split_part(phrase, ' ', 1) AND array_to_string(w[i:i + n - 1], ' ') = phrase),
        templates AS (
            SELECT doc_id, label FROM d, (VALUES {_TEMPLATES}) t(label, pattern)
            WHERE regexp_matches(' ' || array_to_string(w, ' ') || ' ', ' ' || pattern)),
        labels AS (SELECT doc_id, label, true AS base FROM base UNION SELECT doc_id, label, false FROM templates),
        names AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
                         string_agg(DISTINCT CASE WHEN base THEN label END, ',' ORDER BY CASE WHEN base THEN label END) AS base_labels,
                         bool_or(NOT base) AS accepted FROM labels GROUP BY doc_id),
        counts AS (SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word FROM base GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
               coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
               CASE WHEN accepted THEN 1.0::DOUBLE WHEN n_base > 0 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS score
        FROM d LEFT JOIN counts USING (doc_id) LEFT JOIN names USING (doc_id)""",
}
