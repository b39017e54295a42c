"""The registered queries of the corpus operators and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, codes, decontamination, exact, lines, mixing, negatives, passages, quality, simhash, tokens, toxicity, warc
from ..session import scratch_path
from .common import read_table


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.train(docs, read_table(spark, folder, "labels")))


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_groups(read_table(spark, folder, "documents"))


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(read_table(spark, folder, "pages"), scratch_path(spark, "warc"))


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_counts(
        read_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.find_overlaps(
        read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark")
    )


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.copies(read_table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return quality.score(docs, quality.train(docs, read_table(spark, folder, "labels")))


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_groups(read_table(spark, folder, "documents"))


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return passages.repeated_passages(read_table(spark, folder, "documents"))


def op10_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    return chat.format_chats(read_table(spark, folder, "conversations"))


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return codes.vector_codes(read_table(spark, folder, "embeddings"))


def op12_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.line_counts(read_table(spark, folder, "documents"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read_table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors.withColumn("label", label))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
    return dict(sorted(found.items(), key=lambda item: int(item[0][2:].split("_")[0])))


NORMALISED = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"

EXACT = rf"""
    SELECT doc_id, text_sha256, min(doc_id) OVER same AS keep_id,
           count(*) OVER same AS group_size,
           row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id) = 1 AS kept
    FROM (SELECT doc_id, sha256({NORMALISED}) AS text_sha256 FROM documents)
    WINDOW same AS (PARTITION BY text_sha256)"""

# Base32 of a SHA-1: five hex digits are twenty bits, which are four letters.
WARC = r"""
    WITH read AS (
        SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
    hashed AS (
        SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS hex FROM read),
    digested AS (
        SELECT page_id, payload_bytes,
               array_to_string([substr(
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   ((('0x' || substr(hex, (i // 4 * 5 + 1)::INT, 5))::INT >> (15 - i % 4 * 5)::INT) & 31) + 1, 1)
                   FOR i IN range(0, 32)], '') AS payload_digest
        FROM hashed),
    firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM digested)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
    FROM firsts"""

# The level is found by trying every count of full sources, not by the running sums of the operator.
MIXING = r"""
    WITH sized AS (
        SELECT doc_id, source,
               len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
        FROM documents),
    by_source AS (
        SELECT source, sum(size)::BIGINT AS source_size,
               [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE
                   AS weight
        FROM sized GROUP BY source),
    tried AS (
        SELECT (1.5::DOUBLE * (SELECT sum(source_size) FROM by_source)::DOUBLE
                - coalesce(sum(2.0::DOUBLE * o.source_size)
                               FILTER (WHERE 2.0::DOUBLE * o.source_size / o.weight < b.ratio), 0))
               / sum(o.weight) FILTER (WHERE 2.0::DOUBLE * o.source_size / o.weight >= b.ratio) AS level,
               b.ratio
        FROM (SELECT DISTINCT 2.0::DOUBLE * source_size / weight AS ratio FROM by_source) b
        CROSS JOIN by_source o
        GROUP BY b.ratio),
    targets AS (
        SELECT source, source_size,
               least(2.0::DOUBLE * source_size,
                     coalesce((SELECT arg_min(level, ratio) FROM tried WHERE level <= ratio), 'inf'::DOUBLE)
                     * weight) AS target
        FROM by_source),
    placed AS (
        SELECT s.doc_id, s.size, t.source_size, t.target,
               CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
               row_number() OVER (
                   PARTITION BY s.source
                   ORDER BY s.size, coalesce(substr(md5(s.doc_id::VARCHAR), 1, 3), '~'),
                            s.doc_id NULLS LAST) AS place,
               ('0x' || substr(md5('mix' || coalesce(s.source, chr(0) || 'null')), 1, 8))::BIGINT
                   / 4294967296.0::DOUBLE AS start
        FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target,
           (floor(place * rate + start) - floor((place - 1) * rate + start))::BIGINT * size AS taken
    FROM placed"""

CHATS = r"""
    WITH said AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
    marked AS (
        SELECT *, coalesce(strlen(role) || ':' || role, '-') || coalesce(strlen(text) || ':' || text, '-')
                      AS part,
               row_number() OVER ordered AS place
        FROM said WINDOW ordered AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST,
                                     text NULLS FIRST)),
    grown AS (
        SELECT conv_id, place, string_agg(part, '') OVER (
                   PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING) AS so_far,
               max(place) OVER (PARTITION BY conv_id) AS n_turns
        FROM marked),
    whole AS (SELECT conv_id, n_turns, so_far FROM grown WHERE place = n_turns),
    kept AS (
        SELECT min(conv_id) AS conv_id, n_turns, count(*) AS snapshots
        FROM whole
        WHERE so_far NOT IN (SELECT so_far FROM grown WHERE place < n_turns)
        GROUP BY so_far, n_turns)
    SELECT k.conv_id, k.n_turns, k.snapshots,
           string_agg('<|im_start|>' || coalesce(m.role, '') || chr(10) || coalesce(m.text, '')
                      || '<|im_end|>' || chr(10), '' ORDER BY m.place) AS rendered
    FROM kept k JOIN marked m ON k.conv_id IS NOT DISTINCT FROM m.conv_id
    GROUP BY ALL"""

# The nearest entry is min(distance * 256 + entry): the smaller index wins a tie.
OWN = """
    own{i} AS MATERIALIZED (
        SELECT vec_id, label, p, x, best % 256 AS e, best // 256 AS d
        FROM (SELECT vec_id, any_value(label) AS label, v.p, any_value(x) AS x,
                     min((list_inner_product(x, x) - 2 * list_inner_product(x, c)
                          + list_inner_product(c, c))::BIGINT * 256 + e) AS best
              FROM parts v JOIN book{i} b ON v.p = b.p GROUP BY vec_id, v.p))"""

BOOK = """
    book{j} AS MATERIALIZED (
        SELECT b.p, b.e, coalesce(m.c, b.c) AS c
        FROM book{i} b LEFT JOIN (
            SELECT p, e, list(mean ORDER BY k) AS c
            FROM (SELECT p, e, k, floor(sum(v) / count(*)) AS mean
                  FROM (SELECT p, e, unnest(x) AS v, generate_subscripts(x, 1) AS k FROM own{i})
                  GROUP BY p, e, k)
            GROUP BY p, e) m ON m.p = b.p AND m.e = b.e)"""

CODES = """
    WITH kept AS (
        SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS ints
        FROM embeddings
        WHERE len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS MATERIALIZED (
        SELECT vec_id, label, p, ints[p * (len(ints) // 4) + 1:(p + 1) * (len(ints) // 4)] AS x
        FROM kept, range(4) AS t(p)),
    book0 AS MATERIALIZED (
        SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM parts
        QUALIFY e < 256),""" + "".join(
    OWN.format(i=i) + "," + BOOK.format(i=i, j=i + 1) + "," for i in range(4)
) + OWN.format(i=4) + """,
    digest AS (
        SELECT sha256(string_agg(v::BIGINT::VARCHAR, ',' ORDER BY p, e, k)) AS codebooks_sha256
        FROM (SELECT p, e, unnest(c) AS v, generate_subscripts(c, 1) AS k FROM book4)),
    coded AS (
        SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', e), '' ORDER BY p) AS code,
               sum(d)::BIGINT AS error
        FROM own4 GROUP BY vec_id)
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
           codebooks_sha256
    FROM coded, digest"""

LINES = r"""
    WITH split AS (
        SELECT row, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
        FROM (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts
              FROM documents)),
    keyed AS (
        SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM split),
    shared AS (
        SELECT key, max(doc_id) AS keep_id FROM keyed WHERE length(key) >= 20
        GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
    SELECT any_value(k.doc_id) AS doc_id, count(*) AS n_lines,
           count(*) FILTER (WHERE k.doc_id <> s.keep_id) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (
               WHERE s.keep_id IS NULL OR k.doc_id = s.keep_id), '')) AS kept_sha256
    FROM keyed k LEFT JOIN shared s USING (key)
    GROUP BY k.row"""

NEGATIVES = """
    WITH kept AS MATERIALIZED (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS ints
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS MATERIALIZED (
        SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
               list_inner_product(a.ints, b.ints)::BIGINT AS score
        FROM kept a JOIN kept b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
    positives AS (
        SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
    SELECT anchor_id, positive_id, positive_score, other AS negative_id, score AS negative_score,
           (row_number() OVER best)::INT AS rank
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
    QUALIFY row_number() OVER best <= 10"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_exact_dedup": EXACT,
        "op3_warc": WARC,
        "op6_mixing": MIXING,
        "op10_chat_formatting": CHATS,
        "op11_vector_codes": CODES,
        "op12_line_dedup": LINES,
        "op13_hard_negatives": NEGATIVES,
    }
