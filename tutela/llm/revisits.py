"""Not-modified revisit records of web archives, resolved to the response they stand for.

A revisit is joined as of its time with the latest earlier full response of its canonical URL. The
response's validators must not contradict the revisit's; the resolved record has the response's
headers, updated by those that a not-modified answer may change.

Captures of one URL are cut into blocks of ``BLOCK_SECONDS``, and one that holds more than
``BLOCK_ROWS`` of them into as many equal spans of time as it holds that many. Within a block a
running window finds the latest response; what a block inherits comes from one row for each URL and
block. So a URL with a third of all captures is spread over its blocks. Revisits without a URL or
a time have no earlier response and take no part in this.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tutela.session import keep

BLOCK_SECONDS = 6 * 3600
BLOCK_ROWS = 50_000
SPANS = 1 << 20  # of a block at most
#: Headers that a 304 answer may change (RFC 9110, RFC 9111).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Query parameters that name a visit and not a page.
VISIT = "utm_[a-z]+|fbclid|gclid|sessionid"


def canonical_url(url: Column) -> Column:
    """Host and path in one spelling: no scheme, user, leading www., default port, fragment,
    closing slash or visit parameters; the other parameters sorted. Host in small letters."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z]+://", "")
    place = F.regexp_replace(bare, r"\?.*$", "")
    host = F.regexp_replace(F.lower(F.regexp_replace(place, "/.*$", "")), "^[^@]*@", "")
    host = F.regexp_replace(F.regexp_replace(host, "^www[0-9]*[.]", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_replace(place, "^[^/]*", ""), "/+$", "")
    query = F.array_sort(F.filter(F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&"),
                                  lambda p: (p != "") & ~p.rlike(f"^({VISIT})(=|$)")))
    return F.concat(host, path, F.when(F.size(query) > 0, F.concat(
        F.lit("?"), F.array_join(query, "&"))).otherwise(F.lit("")))


def _same(theirs: Column, ours: Column) -> Column:
    """Unknown where one side is silent."""
    return F.regexp_replace(theirs, "^W/", "") == F.regexp_replace(ours, "^W/", "")


def _blocks(rows: DataFrame, block_seconds: int, block_rows: int) -> DataFrame:
    """The rows with ``block``: their time's block, and its part where the URL's block is full."""
    micros = F.unix_micros("ts")
    width = 1_000_000 * block_seconds
    whole = rows.withColumn("block", F.floor(micros / width))
    full = keep(whole.groupBy("canonical", "block").agg(F.count("*").alias("n"))
                .filter(F.col("n") > block_rows).select(
        F.col("canonical").alias("c"), F.col("block").alias("b"),
        F.least(F.ceil(F.col("n") / block_rows), F.lit(SPANS)).alias("spans")), "full-blocks")
    part = F.floor((micros - F.col("block") * width) * F.coalesce("spans", F.lit(1)) / width)
    return whole.join(full, (F.col("canonical") == F.col("c")) & (F.col("block") == F.col("b")),
                      "left").withColumn("block", F.col("block") * SPANS + part) \
        .drop("c", "b", "spans")


def resolve(captures: DataFrame, block_seconds: int = BLOCK_SECONDS,
            block_rows: int = BLOCK_ROWS) -> DataFrame:
    """A row for each revisit of (record_id, url, ts, kind, status, headers, payload_digest, ...):
    record_id, canonical, ts, refers_to, outcome, headers, payload_digest.

    ``kind`` is response or revisit; a full response has status 200. Header names are in small
    letters. ``outcome`` is resolved; no earlier response; validator mismatch, if the entity tags
    differ (weakly compared), or the modification dates where a tag is missing, or the digests
    where both are given; no validator, if nothing could be compared. Only resolved rows have
    headers and digest. Of responses of one time the one of the largest record_id is the latest;
    a response of the revisit's own time is not earlier. A null url or ts gives no earlier
    response. Repeated rows come back as often as given, an empty table gives none; other columns
    are not used.
    """
    rows = captures.select(
        "record_id", canonical_url(F.col("url")).alias("canonical"),
        F.col("ts").cast("timestamp").alias("ts"), "kind", "status",
        F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("headers"),
        F.col("payload_digest").alias("digest"))
    known = F.col("ts").isNotNull() & F.col("canonical").isNotNull()
    is_full = (F.col("kind") == "response") & (F.col("status") == 200)
    is_revisit = F.col("kind") == "revisit"
    placed_rows = _blocks(rows.filter(known & (is_full | is_revisit)), block_seconds, block_rows)
    full, revisits = placed_rows.filter(is_full), placed_rows.filter(is_revisit)
    stored = F.struct("record_id", "headers", "digest")
    timed = revisits.select("*", F.lit(0).alias("late"), F.lit(None).cast(
        full.select(stored).schema[0].dataType).alias("found")).unionByName(
        full.select("*", F.lit(1).alias("late"), stored.alias("found")))
    so_far = Window.partitionBy("canonical", "block").orderBy(
        "ts", "late", F.col("record_id").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    within = timed.withColumn("found", F.last("found", ignorenulls=True).over(so_far)) \
        .filter(F.col("late") == 0)
    closing = full.groupBy("canonical", "block").agg(
        F.max_by(stored, F.struct("ts", "record_id")).alias("last"))
    blocks = closing.unionByName(
        revisits.select("canonical", "block").distinct().withColumn(
            "last", F.lit(None).cast(closing.schema["last"].dataType))) \
        .groupBy("canonical", "block").agg(F.max_by("last", F.when(F.col("last").isNotNull(), 1))
                                           .alias("last"))
    before = Window.partitionBy("canonical").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    inherited = blocks.select(F.col("canonical").alias("c"), F.col("block").alias("b"),
                              F.last("last", ignorenulls=True).over(before).alias("inherited")) \
        .filter(F.col("inherited").isNotNull())
    joined = within.join(inherited, (F.col("canonical") == F.col("c"))
                         & (F.col("block") == F.col("b")), "left")
    columns = ("record_id", "canonical", "ts", "headers", "digest")
    placed = joined.select(*columns, F.coalesce("found", "inherited").alias("of"))
    alone = rows.filter(is_revisit & ~known)
    placed = placed.unionByName(alone.select(*columns, F.lit(None).cast(
        placed.schema["of"].dataType).alias("of")))
    theirs, ours = F.col("headers"), F.col("of.headers")
    tags = _same(theirs["etag"], ours["etag"])
    dates = theirs["last-modified"] == ours["last-modified"]
    digests = F.col("digest") == F.col("of.digest")
    agrees = F.when(digests == F.lit(False), F.lit(False)).otherwise(
        F.coalesce(tags, dates, digests))
    outcome = F.when(F.col("of").isNull(), "no earlier response").when(
        agrees.isNull(), "no validator").when(agrees, "resolved").otherwise("validator mismatch")
    update = F.map_filter(theirs, lambda k, v: k.isin(*PERMITTED) & v.isNotNull())
    merged = F.map_concat(F.map_filter(ours, lambda k, v: ~F.map_contains_key(update, k)), update)
    done = F.col("outcome") == "resolved"
    return placed.withColumn("outcome", outcome).select(
        "record_id", "canonical", "ts", F.col("of.record_id").alias("refers_to"), "outcome",
        F.when(done, merged).alias("headers"),
        F.when(done, F.col("of.digest")).alias("payload_digest"))
