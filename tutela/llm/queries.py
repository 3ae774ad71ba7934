"""One query for each operator, on the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tutela.llm import (alignment, bpe, licences, minhash, occurrences, packing, pii, quality_rules,
                        resampling, revisits, substring, vectors, whitening)


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return substring.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def captures(pages: DataFrame) -> DataFrame:
    """Two captures of each page: the response, a minute after the page before it, and one to
    three days later a not-modified revisit. Some pages answer with a redirect, have no entity
    tag, or are asked for with a stale one."""
    tag = F.when(F.col("page_id") % 7 != 0, F.md5(F.coalesce("html", F.lit(""))))
    at = 1_700_000_000 + F.col("page_id") * 60
    seen = F.concat(F.lit("t"), at.cast("string"))
    response = pages.select(
        (F.col("page_id") * 2).alias("record_id"), "url", F.timestamp_seconds(at).alias("ts"),
        F.lit("response").alias("kind"),
        F.when(F.col("page_id") % 11 == 0, 301).otherwise(200).alias("status"),
        F.map_filter(F.create_map(
            F.lit("cache-control"), F.lit("max-age=600"), F.lit("content-type"),
            F.lit("text/html"), F.lit("etag"), tag, F.lit("last-modified"), seen),
            lambda k, v: v.isNotNull()).alias("headers"),
        F.sha2(F.coalesce("html", F.lit("")), 256).alias("payload_digest"))
    again = F.when(F.col("page_id") % 5 == 0, F.lit("stale")).otherwise(
        F.concat(F.lit("W/"), tag))
    revisit = pages.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), "url",
        F.timestamp_seconds(at + 86_400 * (1 + F.col("page_id") % 3)).alias("ts"),
        F.lit("revisit").alias("kind"), F.lit(304).alias("status"),
        F.map_filter(F.create_map(
            F.lit("cache-control"), F.lit("max-age=60"), F.lit("content-type"),
            F.lit("text/plain"), F.lit("etag"), again,
            F.lit("date"), F.concat(F.lit("r"), F.col("page_id").cast("string"))),
            lambda k, v: v.isNotNull()).alias("headers"),
        F.lit(None).cast("string").alias("payload_digest"))
    return response.unionByName(revisit)


def op2_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    found = revisits.resolve(captures(_table(spark, folder, "pages")))
    lines = F.transform(F.array_sort(F.map_entries("headers")),
                        lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return found.select("record_id", "canonical", "refers_to", "outcome",
                        F.array_join(lines, "\n").alias("headers"), "payload_digest")


def op3_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, folder, "documents"))


def op4_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.resample(_table(spark, folder, "documents"),
                               _table(spark, folder, "labels"))


def op5_byte_level_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(_table(spark, folder, "documents"), vocabulary("byte_bpe_50k.tiktoken"))


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"),
                        added=True)


def op7_pii_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.pseudonyms(_table(spark, folder, "documents").select("doc_id", "text"),
                           pii.session_key(spark, pii.DEMONSTRATION_KEY))
    return found.select("doc_id", "text", F.size("kinds").cast("long").alias("n_values"),
                        F.array_join("kinds", ",").alias("kinds"))


def op8_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_vectors(_table(spark, folder, "embeddings"))


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge(_table(spark, folder, "documents"), carried=["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "distance")


def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(_table(spark, folder, "documents")).select(
        "doc_id", F.size("sentence_ids").cast("long").alias("n_sentences"),
        F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join("licences", ",").alias("licenses"))


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align_corpus(_table(spark, folder, "documents"),
                                  vocabulary("byte_bpe_50k.json"),
                                  vocabulary("piece_bpe_32k.model"))


def op12_pair_index_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return occurrences.digests(_table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"))


def op13_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(_table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_substring_dedup, op2_warc_revisits, op3_minhash_near_dedup, op4_importance_resampling,
        op5_byte_level_bpe, op6_packing, op7_pii_pseudonyms, op8_embedding_near_dedup,
        op9_quality_rules, op10_license_scan, op11_token_alignment, op12_pair_index_bpe,
        op13_embedding_whitening)}

def _license_sql() -> str:
    def text(values) -> str:
        return "[" + ", ".join(f"'{v}'" for v in values) + "]"
    named: dict[str, str] = {}
    for name, ids, _ in licences.RULES:
        one = ",(?:[^,]+,)*?".join(i.replace(".", "[.]") for i in ids)
        one = f"regexp_matches(sequence, ',{one},')"
        named[name] = f"{named[name]} OR {one}" if name in named else one
    for name, _, covers in licences.RULES:
        for other in covers:
            named[name] = f"({named[name]}) AND NOT ({named[other]})"
    rules = ", ".join(f"CASE WHEN {hit} THEN '{name}' END" for name, hit in named.items())
    plain = "trim(regexp_replace(lower(x), '[^a-z0-9]+', ' ', 'g'))"
    later = plain.replace("lower(x)", r"lower(regexp_replace(x, '([0-9])\+', '\1 or later', 'g'))")
    return rf"""
WITH k AS (SELECT {text(licences.SENTENCES)} AS ids, {text(licences.SENTENCES.values())} AS known),
w AS (SELECT doc_id, ids, known, unnest(generate_series(1, len(whole))) AS n,
             unnest(whole) AS part, row_number() OVER () AS r
      FROM (SELECT *, string_split(regexp_replace(coalesce(text, ''), '{licences.END}', chr(1), 'g'),
                                   chr(1)) AS whole FROM documents) CROSS JOIN k),
l AS (SELECT doc_id, ids, known, n, part, list_position(known, trim(regexp_replace(
          lower(part), '[^a-z0-9]+', ' ', 'g'))) AS spot FROM w),
f AS (SELECT doc_id, n, CASE WHEN spot > 0 AND NOT starts_with(known[spot], '{licences.TAG}')
                 THEN [ids[spot]] ELSE flatten(list_transform(
          regexp_split_to_array(part, '\r?\n'), lambda x: CASE
              WHEN {plain} LIKE '{licences.TAG}%'
              THEN list_transform(regexp_split_to_array(substr(replace({later}, ' or later',
                       ' orlater'), {len(licences.TAG) + 1}), ' (or|and|with) '),
                       lambda y: ids[list_position(known, '{licences.TAG}'
                           || replace(y, ' orlater', ' or later'))])
              ELSE [ids[list_position(known, {plain})]] END)) END AS found FROM l),
g AS (SELECT doc_id, list_filter(flatten(list(found ORDER BY n)), lambda x: x IS NOT NULL) AS found
      FROM f GROUP BY doc_id),
h AS (SELECT doc_id, len(found) AS n_sentences, array_to_string(found, ',') AS sentence_ids,
             ',' || array_to_string(found, ',') || ',' AS sequence FROM g)
SELECT doc_id, n_sentences, sentence_ids,
       array_to_string(list_sort(list_filter([{rules}], lambda x: x IS NOT NULL)), ',') AS licenses
FROM h"""


#: Smallest id that each id reaches by links (a, b) of both directions.
_REACH = """
reach AS (SELECT a AS node, a AS least FROM links UNION SELECT b, least FROM reach JOIN links
          ON a = node WHERE least < b),
component AS (SELECT node, min(least) AS component_id FROM reach GROUP BY node)"""

SQL: dict[str, str] = {
    "op3_minhash_near_dedup": rf"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
g AS (SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5
                 THEN [array_to_string(words, ' ')] ELSE list_transform(range(1, len(words) - 3),
                     lambda p: array_to_string(words[p:p + 4], ' ')) END) AS shingles FROM w),
s AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM g),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS n, any_value(b.n) AS m,
                  count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
           GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM common WHERE 100 * c >= 85 * (n + m - c)),{_REACH}
SELECT doc_id, len(shingles) AS n_shingles, least(doc_id, coalesce(component_id, doc_id))
           AS component_id, doc_id <= coalesce(component_id, doc_id) AS kept
FROM g LEFT JOIN component ON node = doc_id""",
    "op8_embedding_near_dedup": rf"""
WITH RECURSIVE v AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
      AND list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label
          AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
          WHERE list_inner_product(a.x, b.x) / sqrt(list_inner_product(a.x, a.x)
                * list_inner_product(b.x, b.x)) >= 0.98),{_REACH},
n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(component_id, vec_id))
           AS component_id, vec_id <= coalesce(component_id, vec_id) AS kept
FROM embeddings LEFT JOIN n ON a = vec_id LEFT JOIN component ON node = vec_id""",
    "op10_license_scan": _license_sql(),
    "op1_substring_dedup": r"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
           FROM documents),
windows AS (SELECT r, pos, array_to_string(words[pos:pos + 34], ' ') AS passage
            FROM (SELECT r, words, unnest(range(1, len(words) - 33)) AS pos FROM w
                  WHERE len(words) >= 35)),
repeated AS (SELECT r, pos FROM (SELECT r, pos, count(*) OVER (PARTITION BY passage) AS n FROM windows)
             WHERE n > 1),
gone AS (SELECT r, list_distinct(list(p)) AS places
         FROM (SELECT r, unnest(range(pos, pos + 35)) AS p FROM repeated) GROUP BY r)
SELECT doc_id, len(words) AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN places IS NULL THEN words ELSE
           list_transform(list_filter(range(1, len(words) + 1), lambda p: NOT list_contains(places, p)),
                          lambda p: words[p]) END, ' ')) AS kept_sha256
FROM w LEFT JOIN gone USING (r)""",
    "op2_warc_revisits": r"""
WITH p AS (SELECT page_id, html, 1700000000 + page_id * 60 AS t,
       regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z]+://', '') AS bare FROM pages),
q AS (SELECT *, regexp_replace(bare, '\?.*$', '') AS place,
       list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'),
           lambda x: x <> '' AND NOT regexp_matches(x,
               '^(utm_[a-z]+|fbclid|gclid|sessionid)(=|$)'))) AS args FROM p),
c AS (SELECT page_id, html, t,
       regexp_replace(regexp_replace(regexp_replace(lower(regexp_replace(place, '/.*$', '')),
           '^[^@]*@', ''), '^www[0-9]*[.]', ''), ':(80|443)$', '')
       || regexp_replace(regexp_replace(place, '^[^/]*', ''), '/+$', '')
       || CASE WHEN len(args) > 0 THEN '?' || array_to_string(args, '&') ELSE '' END AS canonical,
       CASE WHEN page_id % 7 <> 0 THEN md5(coalesce(html, '')) END AS tag FROM q),
f AS (SELECT page_id * 2 AS of_id, t, canonical, tag, sha256(coalesce(html, '')) AS digest,
             't' || t AS seen FROM c WHERE page_id % 11 <> 0),
r AS (SELECT page_id, page_id * 2 + 1 AS record_id, canonical, t + 86400 * (1 + page_id % 3) AS t,
             CASE WHEN page_id % 5 = 0 THEN 'stale' ELSE 'W/' || tag END AS tag FROM c),
j AS (SELECT r.*, of_id, f.tag AS own, digest, seen,
             CASE WHEN of_id IS NULL THEN 'no earlier response'
                  WHEN r.tag IS NULL OR f.tag IS NULL THEN 'no validator'
                  WHEN regexp_replace(r.tag, '^W/', '') = f.tag THEN 'resolved'
                  ELSE 'validator mismatch' END AS outcome
      FROM r ASOF LEFT JOIN f ON r.canonical = f.canonical AND r.t > f.t)
SELECT record_id, canonical, of_id AS refers_to, outcome,
       CASE WHEN outcome = 'resolved' THEN 'cache-control: max-age=60' || chr(10)
           || 'content-type: text/html' || chr(10) || 'date: r' || page_id || chr(10)
           || 'etag: ' || tag || chr(10) || 'last-modified: ' || seen END AS headers,
       CASE WHEN outcome = 'resolved' THEN digest END AS payload_digest
FROM j""",
}
