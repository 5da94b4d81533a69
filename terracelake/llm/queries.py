"""The registered queries of this subpackage, with SQL where SQL can say the same."""

from __future__ import annotations

import string
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terracelake.llm.common import table, text_of
from terracelake.llm.decontaminate import find_items
from terracelake.llm.hard_negatives import hard_negatives
from terracelake.llm.licenses import scan_licenses
from terracelake.llm.line_dedup import drop_shared_lines
from terracelake.llm.merkle import verified_manifest
from terracelake.llm.nearest import nearest
from terracelake.llm.ngram_join import similar_documents
from terracelake.llm.packing import pack
from terracelake.llm.quality import judge
from terracelake.llm.sharding import shard_by_bytes
from terracelake.llm.simhash import near_duplicates
from terracelake.llm.token_counts import count_tokens
from terracelake.llm.token_files import new_folder, read_token_files, write_token_files

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_best_fit_packing(spark: SparkSession, d: str) -> DataFrame:
    return pack(table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op2_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    return drop_shared_lines(table(spark, d, "documents").select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(text_of(), 256).alias("kept_sha256"))


# DuckDB's list functions count from 1; trim's second argument is a set of characters.
ORACLE_SQL["op2_line_dedup"] = r"""
    WITH docs AS (
      SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    lines AS (
      SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS i FROM docs),
    keyed AS (
      SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key FROM lines),
    shared AS (
      SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10
      GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
    marked AS (
      SELECT k.r, k.doc_id, k.line, k.i, s.key IS NOT NULL AND k.doc_id <> s.keeper AS gone
      FROM keyed k LEFT JOIN shared s ON k.key = s.key)
    SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines,
           CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
    FROM marked GROUP BY r"""


@query
def op3_plane_files(spark: SparkSession, d: str) -> DataFrame:
    documents, folder = table(spark, d, "documents"), new_folder(spark)
    manifest = write_token_files(documents, folder, public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(manifest, folder).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


@query
def op4_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return count_tokens(table(spark, d, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op5_simhash(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates(table(spark, d, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


@query
def op6_sharding(spark: SparkSession, d: str) -> DataFrame:
    return shard_by_bytes(table(spark, d, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query
def op7_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return find_items(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query
def op8_block_nearest(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


@query
def op9_license_scan(spark: SparkSession, d: str) -> DataFrame:
    return scan_licenses(table(spark, d, "documents"))


@query
def op10_quality(spark: SparkSession, d: str) -> DataFrame:
    """The documents that the classifier keeps."""
    documents = table(spark, d, "documents").select("doc_id", "text", "source", "lang")
    judged = judge(documents, table(spark, d, "labels"))
    return judged.filter("keep").select("doc_id", "toxic", "low", "keep")


@query
def op11_ngram_join(spark: SparkSession, d: str) -> DataFrame:
    return similar_documents(table(spark, d, "documents"))


ORACLE_SQL["op11_ngram_join"] = r"""
    WITH RECURSIVE docs AS (
      SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
    sets AS (
      SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
             ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS grams FROM docs),
    entries AS (SELECT r, len(grams) AS n, unnest(grams) AS gram FROM sets),
    pairs AS (
      SELECT a.r AS x, b.r AS y, a.n + b.n - count(*) AS joined, count(*) AS shared
      FROM entries a JOIN entries b ON a.gram = b.gram AND a.r <> b.r GROUP BY a.r, b.r, a.n, b.n),
    links AS (SELECT x, y FROM pairs WHERE 100 * shared >= 90 * joined),
    reach AS (
      SELECT r AS x, r AS y FROM sets
      UNION
      SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
    SELECT any_value(s.doc_id) AS doc_id, CAST(any_value(len(s.grams)) AS BIGINT) AS n_shingles, min(o.doc_id) AS component_id
    FROM reach JOIN sets s ON reach.x = s.r JOIN sets o ON reach.y = o.r GROUP BY reach.x"""


@query
def op12_hard_negatives(spark: SparkSession, d: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, d, "embeddings").select("vec_id", label.alias("label"), "embedding")
    return hard_negatives(rows, rows.filter(F.col("vec_id") % 50 == 0))


ORACLE_SQL["op12_hard_negatives"] = """
    WITH sound AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scores AS (
      SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id,
             CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM sound a JOIN sound b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 50 = 0),
    positives AS (
      SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
    ranked AS (
      SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
      FROM positives p JOIN scores s ON p.anchor_id = s.anchor_id AND NOT s.same
        AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
    SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
    FROM ranked WHERE rank <= 3"""


@query
def op13_merkle_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Where 5 divides the checksum of doc_id, the text's capitals have been lower-cased."""
    chosen = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    return verified_manifest(table(spark, d, "documents"), {"text": F.when(chosen, lower).otherwise(F.col("text"))})


# The checksum is worked out bit by bit: 0xEDB88320 is its polynomial.
ORACLE_SQL["op13_merkle_manifest"] = r"""
    WITH RECURSIVE docs AS (
      SELECT row_number() OVER () AS r, doc_id, source, text,
             [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR)] AS fields,
             xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
               lambda c: [ascii(c), 0, 0, 0, 0, 0, 0, 0]))),
               lambda c, b: xor(xor(c, b) // 2, 3988292384 * (xor(c, b) % 2))), 4294967295) % 5 = 0 AS chosen
      FROM documents),
    texts AS (
      SELECT r, doc_id, source, list_append(fields, text) AS own, list_append(fields, CASE WHEN chosen THEN
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END) AS held FROM docs),
    hashes AS (
      SELECT r, doc_id, source,
             sha256(array_to_string(list_transform(own, lambda v: CASE WHEN v IS NULL THEN '-' ELSE strlen(v) || ':' || v END), '')) AS leaf,
             sha256(array_to_string(list_transform(held, lambda v: CASE WHEN v IS NULL THEN '-' ELSE strlen(v) || ':' || v END), '')) AS held
      FROM texts),
    leaves AS (
      SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS no,
             count(*) OVER (PARTITION BY source) AS n FROM hashes),
    nodes AS (
      SELECT source, 0 AS level, no, n, leaf AS h FROM leaves
      UNION ALL
      SELECT source, level + 1, no // 16, (any_value(n) + 15) // 16, sha256(string_agg(h, '' ORDER BY no))
      FROM nodes WHERE n > 1 GROUP BY source, level, no // 16),
    runs AS (
      SELECT source, level, no // 16 AS run, list(h ORDER BY no) AS children FROM nodes WHERE n > 1 GROUP BY source, level, no // 16),
    subroots AS (
      SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS no, count(*) OVER () AS n FROM nodes WHERE n = 1),
    tops AS (
      SELECT 0 AS level, no, n, subroot AS h FROM subroots
      UNION ALL
      SELECT level + 1, no // 16, (any_value(n) + 15) // 16, sha256(string_agg(h, '' ORDER BY no)) FROM tops WHERE n > 1 GROUP BY level, no // 16),
    top_runs AS (SELECT level, no // 16 AS run, list(h ORDER BY no) AS children FROM tops WHERE n > 1 GROUP BY level, no // 16),
    climb AS (
      SELECT r, source, 0 AS level, no, held AS folded, '' AS proof FROM leaves
      UNION ALL
      SELECT c.r, c.source, c.level + 1, c.no // 16,
             sha256(array_to_string(children[1:c.no % 16], '') || folded || array_to_string(children[c.no % 16 + 2:], '')),
             proof || array_to_string(children[1:c.no % 16], '') || array_to_string(children[c.no % 16 + 2:], '')
      FROM climb c JOIN runs u ON c.source IS NOT DISTINCT FROM u.source AND c.level = u.level AND c.no // 16 = u.run),
    reached AS (SELECT r, arg_max(folded, level) AS folded, arg_max(proof, level) AS proof FROM climb GROUP BY r),
    top_climb AS (
      SELECT l.r, 0 AS level, s.no, a.folded, a.proof
      FROM leaves l JOIN reached a ON l.r = a.r JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source
      UNION ALL
      SELECT c.r, c.level + 1, c.no // 16,
             sha256(array_to_string(children[1:c.no % 16], '') || folded || array_to_string(children[c.no % 16 + 2:], '')),
             proof || array_to_string(children[1:c.no % 16], '') || array_to_string(children[c.no % 16 + 2:], '')
      FROM top_climb c JOIN top_runs u ON c.level = u.level AND c.no // 16 = u.run),
    finished AS (SELECT r, arg_max(folded, level) AS folded, arg_max(proof, level) AS proof FROM top_climb GROUP BY r)
    SELECT l.doc_id, l.leaf, s.subroot, t.h AS root, sha256(f.proof) AS proof_sha256, f.folded AS folded_root, f.folded = t.h AS verified
    FROM leaves l JOIN finished f ON l.r = f.r JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source
    JOIN tops t ON t.n = 1"""
