"""Quality rules: counts of whole texts, and outliers among them by robust distances.

Beside two fixed rules, a text is judged by a vector of transformed statistics against the texts of
its language and source. Centre and scatter are minimum-covariance-determinant estimates: nested
starts on a bounded sample of each group (``SAMPLE`` rows or so), then concentration steps over
all rows. One step is one aggregation: counts and moments by group and by bin of the distance, so
the texts nearest to the centre are summed up without sorting them, and a hot group costs no more
than its partial sums.

Most texts have no symbol, repeated line or repeated word at all, so the nearest rows of a group
often have no spread there. What is added to the scatter is the group's own (``spreads``): the size
that values usually have where they are not zero, but no more than ``RARE`` times the mean square
over all its rows. A value of usual size is thus no outlier where many texts have one, and is one
where less than about a text in ``RARE`` times the cut has any.
"""

from __future__ import annotations

import math
import secrets
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tutela.llm.words import chunks, gram_hashes, same_spans, span_hashes, split, text_bytes
from tutela.session import keep

SYMBOLS = b"#*$%&|<>"
REPEAT = 8
SHARE = 0.75          # of a group's rows the estimates rest on
SAMPLE = 500
LEAST_ROWS = 60       # smaller groups are judged by their language, and that by the corpus
LEAST_CORPUS = 20     # texts; fewer say nothing about a fifth in four dimensions
STEPS = 8
CUT = 0.99999
RARE = 4.0
LENGTH_SHARE = 0.1    # of the standard deviation of word lengths
BINS = 8              # of a doubling, for the usual size of values that are not zero
P = 4
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_text(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[edges[1:]] - total[edges[:-1]]


class _Collision(Exception):
    """Unequal lines or words of one hash."""


def count_statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """The base counts and ``n_lines`` (lines with a word) of each text. What has one hash is
    compared by its bytes; should any differ, all is counted again under another key."""
    while True:
        try:
            return _statistics(texts, secrets.randbits(64))
        except _Collision:
            continue


def _statistics(texts: pa.Array, seed: int) -> dict[str, np.ndarray]:
    data, offsets = text_bytes(texts)
    words = split(texts)
    n = len(offsets) - 1
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)])
    word_chars = np.concatenate([[0], np.cumsum(chars[words.ends] - chars[words.starts])])
    out = {"n_words": words.counts,
           "word_chars": word_chars[words.first[1:]] - word_chars[words.first[:-1]],
           "n_symbols": _per_text(np.isin(data, np.frombuffer(SYMBOLS, np.uint8)), offsets)}
    if not len(data):
        return out | {c: np.zeros(n, np.int64) for c in ("n_lines", *BASE[3:])}
    breaks = np.flatnonzero(data == 10)
    begin = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    begin = begin[begin < len(data)]
    end = np.append(begin[1:], len(data))
    end = np.where(data[np.maximum(end, 1) - 1] == 10, end - 1, end)
    has = np.searchsorted(words.starts, end) > np.searchsorted(words.starts, begin)
    begin, end = begin[has], end[has]
    owner = np.searchsorted(offsets, begin, side="right") - 1
    out["n_lines"] = np.bincount(owner, minlength=n)
    def same_lines(i, j):
        return same_spans(data, begin[i], end[i], data, begin[j], end[j])

    again = _again(owner, span_hashes(data, begin, end, seed), False, same_lines)
    out["n_dup_lines"] = np.bincount(owner[again], minlength=n)
    grams = gram_hashes(words.hashes(seed), REPEAT)
    owner = words.document()[:len(grams)]
    inside = words.first[1:][owner] - np.arange(len(grams)) >= REPEAT
    at = np.flatnonzero(inside)

    def same_windows(i, j):
        a, b = at[i], at[j]
        same = np.ones(len(a), bool)
        for k in range(REPEAT):
            same &= same_spans(data, words.starts[a + k], words.ends[a + k],
                               data, words.starts[b + k], words.ends[b + k])
        return same

    at = at[_again(owner[at], grams[at], True, same_windows)]
    cover = np.zeros(len(words.starts) + 1, np.int32)
    cover[at] += 1
    cover[at + REPEAT] -= 1
    out["n_repeat_words"] = _per_text(np.cumsum(cover[:-1]) > 0, words.first)
    return out


def _again(owner: np.ndarray, value: np.ndarray, first_too: bool, equal) -> np.ndarray:
    """Which values come up in the same text before (or, ``first_too``, at another place);
    ``equal(i, j)`` compares what those of one hash stand for."""
    order = np.lexsort((owner, value)) if len(owner) and (np.diff(owner) < 0).any() \
        else np.argsort(value, kind="stable")
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = (value[order[1:]] == value[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
    pairs = np.flatnonzero(same[1:-1])
    if not equal(order[pairs + 1], order[pairs]).all():
        raise _Collision
    out = np.zeros(len(order), bool)
    out[order] = same[:-1] | same[1:] if first_too else same[:-1]
    return out


_COUNTS = (*BASE, "n_lines")
_COUNTED = T.StructType([T.StructField(c, T.LongType()) for c in _COUNTS])


def _counted(texts: pa.Array) -> pa.Array:
    found = [count_statistics(part.column("text")) for part in chunks(
        pa.RecordBatch.from_arrays([texts], names=["text"]), "text")]
    return pa.StructArray.from_arrays(
        [pa.array(np.concatenate([np.zeros(0, np.int64), *(f[c] for f in found)]))
         for c in _COUNTS], names=list(_COUNTS))


def _vector() -> list[Column]:
    words = F.greatest("n_words", F.lit(1))
    return [F.log(F.greatest("word_chars", F.lit(1)) / words),
            F.sqrt(F.col("n_symbols") / F.greatest("word_chars", F.lit(1))),
            F.sqrt(F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))),
            F.sqrt(F.col("n_repeat_words") / words)]


def chi2_quantile(p: int, share: float) -> float:
    """Quantile of the chi-square distribution of an even number of degrees."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        x = (low + high) / 2
        tail = math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(p // 2))
        low, high = (x, high) if 1 - tail < share else (low, x)
    return (low + high) / 2


def _consistency() -> float:
    """What the scatter of the nearest ``SHARE`` of normal rows is multiplied by."""
    x = chi2_quantile(P, SHARE)
    inner = 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(P // 2 + 1))
    return SHARE / inner


def _concentrate(x: np.ndarray, centre: np.ndarray, scatter: np.ndarray, h: int,
                 spread: np.ndarray):
    d = x - centre
    near = np.argsort((d @ np.linalg.inv(scatter) * d).sum(axis=1), kind="stable")[:h]
    return x[near].mean(axis=0), np.cov(x[near].T, bias=True) + np.diag(spread)


def start(x: np.ndarray, spread: np.ndarray, tries: int = 40, best: int = 5, seed: int = 7):
    """MCD of a small sample: random subsets of P + 1 rows, two steps each; the best to the end.
    ``spread`` are the variances added to every scatter."""
    rng, h, found = np.random.default_rng(seed), max(1, math.ceil(SHARE * len(x))), []
    for _ in range(tries):
        some = x[rng.choice(len(x), min(P + 1, len(x)), replace=False)]
        c, s = some.mean(axis=0), np.cov(some.T, bias=True) + np.diag(spread)
        for _ in range(2):
            c, s = _concentrate(x, c, s, h, spread)
        found.append((np.linalg.slogdet(s)[1], c, s))
    done = []
    for value, c, s in sorted(found, key=lambda f: f[0])[:best]:
        for _ in range(20):
            c, s = _concentrate(x, c, s, h, spread)
            now = np.linalg.slogdet(s)[1]
            if now >= value - 1e-9:
                break
            value = now
        done.append((value, c, s))
    return min(done, key=lambda f: f[0])[1:]


_MODEL = "key string, centre array<double>, inverse array<double>, size double"


def _model(key: str, centre: np.ndarray, scatter: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"key": [key], "centre": [centre.tolist()],
                         "inverse": [np.linalg.inv(scatter).ravel().tolist()],
                         "size": [float(np.linalg.slogdet(scatter)[1])]})


def _start(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("rid")
    centre, scatter = start(np.stack(group["x"].to_numpy()), np.array(group["spread"].iloc[0]))
    return _model(group["key"].iloc[0], centre, scatter)


def _distance() -> Column:
    d = [F.col("x")[i] - F.col("centre")[i] for i in range(P)]
    return sum((d[i] * d[j] * F.col("inverse")[P * i + j] for i in range(P) for j in range(P)),
               F.lit(0.0))


def _moments(rows: DataFrame, by: list[str]) -> DataFrame:
    x = [F.col("x")[i] for i in range(P)]
    return rows.groupBy(*by).agg(
        F.count("*").alias("n"), *(F.sum(x[i]).alias(f"s{i}") for i in range(P)),
        *(F.sum(x[i] * x[j]).alias(f"q{i}{j}") for i in range(P) for j in range(i, P)))


def _estimate(part: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    n = part["n"].sum()
    centre = np.array([part[f"s{i}"].sum() for i in range(P)]) / n
    second = np.zeros((P, P))
    for i in range(P):
        for j in range(i, P):
            second[i, j] = second[j, i] = part[f"q{i}{j}"].sum() / n
    return centre, second - np.outer(centre, centre)


def _step(bins: pd.DataFrame) -> pd.DataFrame:
    """The estimates of the nearest rows from the moments of one group's bins."""
    bins = bins.sort_values("bin")
    inside = bins["n"].cumsum() - bins["n"] < SHARE * bins["n"].sum()
    centre, scatter = _estimate(bins[inside])
    return _model(bins["key"].iloc[0], centre,
                  scatter * _consistency() + np.diag(bins["spread"].iloc[0]))


def _reweight(total: pd.DataFrame) -> pd.DataFrame:
    centre, scatter = _estimate(total)
    return _model(total["key"].iloc[0], centre, scatter + np.diag(total["spread"].iloc[0]))


def _spread(bins: pd.DataFrame) -> pd.DataFrame:
    """The variances added to a group's scatter, from counts and squares by dimension and bin."""
    out = []
    for i in range(P):
        part = bins[bins["dimension"] == i].sort_values("bin")
        n, squares, total = (part[c].sum() for c in ("n", "squares", "total"))
        if i == 0:
            out.append(LENGTH_SHARE ** 2 * max(squares / n - (total / n) ** 2, 0.0))
            continue
        some = part[part["bin"].notna()]
        if some.empty:
            out.append(0.0)
            continue
        middle = int(np.searchsorted(some["n"].cumsum(), some["n"].sum() / 2))
        usual = 2.0 ** ((some["bin"].iloc[middle] + 0.5) / BINS)
        out.append(min(usual ** 2, RARE * squares / n))
    # where nothing varies, nothing can be far: any value but one is
    return pd.DataFrame({"key": [bins["key"].iloc[0]], "spread": [[max(v, 1e-8) for v in out]]})


def spreads(rows: DataFrame) -> DataFrame:
    """(key, spread) for rows (key, x): see the module. Exact: counts by eighths of a doubling."""
    long = rows.select("key", F.posexplode("x").alias("dimension", "value"))
    bin_of = F.when((F.col("dimension") > 0) & (F.col("value") > 0),
                    F.floor(F.log2("value") * BINS))
    return long.groupBy("key", "dimension", bin_of.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("value") * F.col("value")).alias("squares"),
        F.sum("value").alias("total")).groupBy("key").applyInPandas(
        _spread, "key string, spread array<double>")


def _models(rows: DataFrame) -> DataFrame:
    """Centre and inverse scatter of each group of rows (key, rid, x)."""
    counts = keep(rows.groupBy("key").agg(F.count("*").alias("n")), "counts")
    spread = keep(spreads(rows), "spreads")
    draw = F.pmod(F.xxhash64("rid", F.lit("sample")), F.lit(1_000_003)) / 1_000_003
    # counted and written first: the planner knows how few groups are large and sends their counts
    # to the rows, which are thinned before any of them moves
    sample = rows.join(counts.filter(F.col("n") > SAMPLE), "key", "left").filter(
        F.col("n").isNull() | (draw < F.lit(float(SAMPLE)) / F.col("n")))
    model = keep(sample.join(spread, "key").select("key", "rid", "x", "spread").groupBy("key")
                 .applyInPandas(_start, _MODEL), "start")
    bin_of = F.floor(F.log2(F.greatest(F.col("d"), F.lit(1e-9))) * 16)
    before = None
    for _ in range(STEPS):
        near = rows.join(model, "key").withColumn("d", _distance()).withColumn("bin", bin_of)
        model = keep(_moments(near, ["key", "bin"]).join(spread, "key").groupBy("key")
                     .applyInPandas(_step, _MODEL), "step")
        size = model.agg(F.sum("size")).first()[0]
        if before is not None and size is not None and size > before - 1e-6 * abs(before):
            break
        before = size
    near = rows.join(model, "key").filter(_distance() <= chi2_quantile(P, 0.975))
    return keep(_moments(near, ["key"]).join(spread, "key").groupBy("key")
                .applyInPandas(_reweight, _MODEL), "final")


def _plan(fair: DataFrame) -> DataFrame:
    """(key, judged_by, fitted) for each language and source: the group that judges its texts, and the
    groups whose estimates they take part in. A source of few texts is judged by its language, and
    a language of few by the whole corpus; what is larger takes part in these where they are
    needed. ``judged_by`` is null if the corpus has fewer than ``LEAST_CORPUS`` texts."""
    counts = fair.groupBy("lang", "key").agg(F.count("*").alias("n"))
    by_lang = counts.groupBy("lang").agg(
        F.sum("n").alias("n_lang"), F.bool_or(F.col("n") < LEAST_ROWS).alias("few"))
    total = counts.agg(F.sum("n").alias("n")).scalar()
    both = counts.join(by_lang, counts["lang"].eqNullSafe(by_lang["lang"])).drop(by_lang["lang"])
    lang = F.concat(F.lit("lang "), F.to_json(F.struct("lang"), {"ignoreNullFields": "false"}))
    own, large = F.col("n") >= LEAST_ROWS, F.col("n_lang") >= LEAST_ROWS
    judge = F.when(own, F.col("key")).when(large, lang).when(total >= LEAST_CORPUS, F.lit("all"))
    corpus = by_lang.filter(F.col("n_lang") < LEAST_ROWS).agg(F.count("*").alias("n")).scalar() > 0
    fitted = F.array(F.when(own, F.col("key")), F.when(F.col("few") & large, lang),
                     F.when(corpus & (total >= LEAST_CORPUS), F.lit("all")))
    return both.select("key", judge.alias("judged_by"), fitted.alias("fitted"))


def _judges(fair: DataFrame) -> DataFrame:
    """(key, centre, inverse) of the estimates that judge each group of rows (rid, lang, key, x)."""
    plan = keep(_plan(fair), "groups")
    rows = keep(fair.join(plan, "key").select("rid", "x", "fitted"), "vectors")
    model = _models(rows.select("rid", "x", F.explode("fitted").alias("key")).filter(
        F.col("key").isNotNull()))
    # written first, so that the planner knows how small it is and sends it to the texts
    return keep(plan.select(F.col("key").alias("judged"), F.col("judged_by").alias("key"))
                .join(model, "key").select("judged", "centre", "inverse"), "judges")


def judge(docs: DataFrame, carried: Sequence[str] | None = None) -> DataFrame:
    """The rows of (doc_id, text, lang, source, ...) with n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, distance, kept.

    Fails a text of fewer than 20 words, or with more than 30 % of its words in repeated windows
    of ``REPEAT`` words; such texts take no part in the estimates and have a null distance. A null
    text has no words. Null languages and sources are values of their own. Groups of fewer than
    ``LEAST_ROWS`` texts are judged by the estimates of their language, languages of fewer by those
    of the whole corpus; below ``LEAST_CORPUS`` texts in all there are no outliers. Rows that repeat
    are judged alike and all come back; an empty table gives none. Other columns come back
    (``carried`` names those wanted, if not all); columns named as new ones are replaced.

    Texts stay where they are read: a row is written once with its counts, and the estimates, a few
    numbers a group, come to it. What is carried must be of types that Parquet has.
    """
    new = (*BASE, "base_failed", "distance", "kept")
    others = [c for c in (docs.columns if carried is None else carried) if c not in new]
    rid = F.xxhash64(F.col("doc_id"), F.col("text"), F.col("lang"), F.col("source"))
    text, *group = (F.col(c).cast("string") for c in ("text", "lang", "source"))
    rows = keep(docs.select(
        F.struct(*others).alias("row"), rid.alias("rid"), F.struct(
            group[0].alias("lang"), group[1].alias("source")).alias("group"),
        F.arrow_udf(_counted, _COUNTED)(text).alias("counts")), "counted")
    counted = rows.select("row", "rid", "group.lang", F.to_json(
        "group", {"ignoreNullFields": "false"}).alias("key"), "counts.*")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    vector = counted.withColumn("x", F.array(*_vector()))
    judges = _judges(vector.filter(~failed).select("rid", "lang", "key", "x"))
    found = vector.join(judges, ~failed & (F.col("key") == F.col("judged")), "left").withColumn(
        "distance", _distance())
    far = F.coalesce(F.col("distance") > chi2_quantile(P, CUT), F.lit(False))
    return found.select(*(F.col("row")[c].alias(c) for c in others), *BASE,
                        failed.alias("base_failed"), "distance", (~failed & ~far).alias("kept"))
