"""Importance resampling: texts like a target, by hashed n-gram models and Gumbel top-k.

Two generative bags of hashed word n-grams (one and two words, ``BUCKETS`` buckets) are counted,
one over all texts, one over target texts. A text's log importance weight is the log of the ratio
of its n-grams' probabilities, averaged over them so that length does not decide, times ``SCALE``.
Adding Gumbel noise and taking the largest values draws without replacement with these weights.
Counts are added up within each task first, so a bucket is one row for each task; the model is two
vectors of ``BUCKETS`` numbers whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tutela.llm.words import chunks, gram_hashes, mix, split
from tutela.session import keep

BUCKETS = 16_384
SCALE = 40.0
TARGET_ROWS = 20_000   # the target model is fitted on so many labelled texts at most
SHARE = 0.8            # of all texts that are drawn
SMOOTHING = 1.0
SEED = 20


def hashed_grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of each n-gram of one or two words, lower case."""
    words = split(texts, lower=True)
    hashes, owner = words.hashes(), words.document()
    pairs = gram_hashes(hashes, 2, seed=2)
    inside = owner[1:] == owner[:-1] if len(owner) else np.zeros(0, bool)
    bucket = np.concatenate([mix(hashes), pairs[inside]]) % np.uint64(BUCKETS)
    return bucket.astype(np.int64), np.concatenate([owner, owner[:-1][inside]])


def _count(target: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for part in chunks(batch, "text"):
                bucket, owner = hashed_grams(part.column("text"))
                ids = part.column("doc_id")
                wanted = np.isin(ids.fill_null(0).to_numpy(), target) \
                    & ids.is_valid().to_numpy(zero_copy_only=False)
                counts[0] += np.bincount(bucket, minlength=BUCKETS)
                counts[1] += np.bincount(bucket[wanted[owner]], minlength=BUCKETS)
        yield pa.RecordBatch.from_pydict({"bucket": np.arange(BUCKETS), "raw": counts[0],
                                          "target": counts[1]})
    return run


def gumbel(rid: np.ndarray, seed: int = SEED) -> np.ndarray:
    """Standard Gumbel noise that depends on the row and the seed alone."""
    bits = mix(rid.view(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64)))
    u = ((bits >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)
    return -np.log(-np.log(u))


def _score(ratio: np.ndarray, scale: float, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                bucket, owner = hashed_grams(part.column("text"))
                n = np.bincount(owner, minlength=part.num_rows)
                weight = scale * np.bincount(owner, ratio[bucket], part.num_rows) \
                    / np.maximum(n, 1)
                drawn = weight + gumbel(part.column("rid").to_numpy(), seed)
                rank = np.floor(drawn * 2.0 ** 20).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n), pa.array(weight), pa.array(rank)],
                    names=["doc_id", "n_grams", "log_weight", "rank"])
    return run


def largest(rows: DataFrame, column: str, k: int) -> int | None:
    """The k-th largest value of a long column, exactly: 16 bits at a time, each time from the
    counts of one digit. None if k is 0 or the table is empty."""
    low = rows.agg(F.min(column).alias("low")).first().low
    if low is None or k < 1:
        return None
    value, prefix = F.col(column) - F.lit(low), 0
    for shift in (48, 32, 16, 0):
        same = F.shiftright(value, shift + 16) == F.lit(prefix) if shift < 48 else F.lit(True)
        counts = rows.filter(same).groupBy(F.shiftright(value, shift).alias("digit")).agg(
            F.count("*").alias("n")).orderBy(F.desc("digit")).collect()  # 65,536 rows at most
        for r in counts:
            if k <= r.n or r is counts[-1]:
                prefix = r.digit
                break
            k -= r.n
    return low + prefix


def resample(docs: DataFrame, labels: DataFrame, share: float = SHARE,
             target_rows: int = TARGET_ROWS, scale: float = SCALE, seed: int = SEED) -> DataFrame:
    """(doc_id, n_grams, log_weight, kept) for each row of (doc_id, text, ...).

    The target are the texts whose label row has quality 1 and is not toxic; of more than
    ``target_rows`` those of the smallest hashes. The ``share`` of all rows with the largest
    weight plus noise is kept; rows tied with the last one are all kept. Without a label, all
    weights are equal. A null text has no n-gram and weight 0; it is drawn like any other row.
    """
    target = labels.filter((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
                           & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id")).distinct() \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(target_rows)
    wanted = np.array([r.doc_id for r in target.collect()], np.int64)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).withColumn(
        "rid", F.xxhash64("doc_id", "text"))
    counts = np.zeros((2, BUCKETS))
    for r in rows.select("doc_id", "text").mapInArrow(
            _count(wanted), "bucket long, raw long, target long").groupBy("bucket").agg(
            F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect():
        counts[:, r.bucket] = r.raw, r.target
    smooth = counts + SMOOTHING * max(1.0, counts[1].sum() / max(1.0, counts[0].sum()))
    ratio = np.log(smooth[1] / smooth[1].sum()) - np.log(smooth[0] / smooth[0].sum())
    if not counts[1].any():
        ratio[:] = 0
    scored = keep(rows.mapInArrow(_score(ratio, scale, seed),
                                  "doc_id long, n_grams long, log_weight double, rank long"),
                  "weights")
    last = largest(scored, "rank", round(share * scored.count()))
    kept = F.lit(False) if last is None else F.col("rank") >= F.lit(last)
    return scored.select("doc_id", "n_grams", "log_weight", kept.alias("kept"))
