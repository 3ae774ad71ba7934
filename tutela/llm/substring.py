"""Repeated passages of ``WINDOW`` words, found by super-k-mers.

A window's minimiser is the smallest hash of its runs of ``GRAM`` words. Consecutive windows of one
minimiser travel as one packed string (their words, one space between) to the minimiser's bucket;
there, sorting window hashes and comparing the words of equal ones counts windows exactly. The
covered words come back as ranges.

Strings met before in the same chunk of text are known to repeat: their ranges are sent on alone,
to any bucket, and one copy of the string goes to its own. A minimiser that is frequent in a sample
of the documents does not route its windows; each of them is routed by its own hash instead. So a
passage that a third of all documents hold is spread over the buckets. Routing depends on the words
of a window alone, so windows of equal words always meet: the sample decides where, not whether.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tutela.llm.words import (CHUNK_BYTES, Words, chunks, gram_hashes, mix, sliding_min, split,
                              window_hashes)
from tutela.session import keep

WINDOW = 35
GRAM = 3
BUCKET_BYTES = 3 << 20
SAMPLE_ONE_IN = 64
HEAVY_MOST = 1 << 20      # minimisers the driver holds at most (8 MB)
HEAVY_SHARE = 1 / 16


def joined(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words' bytes, one space after each, with each word's start and end there."""
    lengths = words.ends - words.starts
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    keep_byte = np.zeros(len(words.data) + 1, np.int8)
    keep_byte[words.starts] += 1
    keep_byte[words.ends] -= 1
    inside = np.cumsum(keep_byte[:-1], dtype=np.int8).view(bool)
    out = np.full(int(ends[-1]) + 1 if len(ends) else 0, 32, np.uint8)
    if len(out):
        place = np.ones(len(out), bool)
        place[ends] = False
        out[place] = words.data[inside]
    return out, starts, ends


def routes(words: Words, size: int, gram: int, heavy: np.ndarray) -> tuple:
    """For each window: its text, first word, hash and routing value."""
    hashes = words.hashes()
    whole = window_hashes(hashes, size)
    least = sliding_min(gram_hashes(hashes, gram, seed=11), size - gram + 1)
    counts = np.maximum(words.counts - size + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) \
        + words.first[:-1][owner]
    least, whole = least[at], whole[at]
    if len(heavy):
        least = np.where(np.isin(least, heavy), whole, least)
    return owner, at, whole, least


def _runs(owner: np.ndarray, route: np.ndarray) -> np.ndarray:
    """Where runs of windows of one text and one route begin, and the end."""
    if not len(owner):
        return np.zeros(1, np.int64)
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (route[1:] != route[:-1])
    return np.append(np.flatnonzero(new), len(owner))


def _minimisers(size: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.uint64)
        for batch in batches:
            for part in chunks(batch, "text"):
                owner, _, _, route = routes(split(part.column("text")), size, gram, none)
                edge = _runs(owner, route)
                values, n = np.unique(route[edge[:-1]], return_counts=True)
                yield pa.RecordBatch.from_pydict({"route": values.view(np.int64), "n": n})
    return run


_PACK = pa.schema([("bucket", pa.int64()), ("rid", pa.binary()), ("place", pa.binary()),
                   ("text", pa.binary())])
_ZSTD = pa.Codec("zstd", compression_level=3)


def _zip(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + _ZSTD.compress(raw, asbytes=True) if raw else b""


def _unzip(packed: bytes) -> bytes:
    return _ZSTD.decompress(packed[8:], int.from_bytes(packed[:8], "little"), asbytes=True) \
        if packed else b""


SENT, DOUBLED, KNOWN = 0, 1, 2  # one string; one of several of its chunk; one more of these


def _repeats_in_chunk(raw: bytes, lo: np.ndarray, hi: np.ndarray, alike: np.ndarray) -> np.ndarray:
    """SENT, DOUBLED or KNOWN for each string; ``alike`` is equal where strings may be equal."""
    order = np.argsort(alike, kind="stable")
    same = np.zeros(len(order), bool)
    same[1:] = alike[order[1:]] == alike[order[:-1]]
    out, leader = np.full(len(order), SENT, np.int32), 0
    for k in np.flatnonzero(same):
        if not same[k - 1]:
            leader = order[k - 1]
        i = order[k]
        if raw[lo[i]:hi[i]] == raw[lo[leader]:hi[leader]]:
            out[i], out[leader] = KNOWN, DOUBLED
    return out


def _pack(size: int, gram: int, buckets: int, heavy: np.ndarray):
    """A row for each chunk and bucket: row ids, (first word, windows, kind) and packed words."""
    def pack(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words = split(part.column("text"))
        rid = part.column("rid").to_numpy()
        owner, at, whole, route = routes(words, size, gram, heavy)
        edge = _runs(owner, route)
        begin, n = edge[:-1], np.diff(edge)
        if not len(begin):
            return
        flat, starts, ends = joined(words)
        first, last = at[begin], at[begin] + n + size - 2
        lo, hi, raw = starts[first], ends[last], flat.tobytes()
        rid, place = rid[owner[begin]], first - words.first[owner[begin]]
        alike = mix(whole[begin] + mix(whole[begin + n - 1]) + n.astype(np.uint64))
        kind = _repeats_in_chunk(raw, lo, hi, alike)
        goal = np.where(kind == KNOWN, rid.view(np.uint64) + place.astype(np.uint64),
                        route[begin])
        bucket = (mix(goal) % np.uint64(buckets)).astype(np.int64)
        places = np.stack([place, n, kind], axis=1).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        out = {k: [] for k in _PACK.names}
        for a, b in zip(cuts, [*cuts[1:], len(order)]):
            mine = order[a:b]
            out["bucket"].append(int(bucket[mine[0]]))
            out["rid"].append(_zip(rid[mine].tobytes()))
            out["place"].append(_zip(places[mine].tobytes()))
            out["text"].append(_zip(b" ".join([raw[lo[i]:hi[i]] for i in mine
                                               if kind[i] != KNOWN])))
        yield pa.RecordBatch.from_pydict(out, schema=_PACK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                yield from pack(part)
    return run


def repeated_windows(words: Words, at: np.ndarray, size: int) -> np.ndarray:
    """Which of the windows beginning at the words ``at`` have the words of another one."""
    if not len(at):
        return np.zeros(0, bool)
    return _repeated(words.data.tobytes(), window_hashes(words.hashes(), size)[at], at,
                     words.starts[at], words.ends[at + size - 1])


def _repeated(raw: bytes, hashes: np.ndarray, at: np.ndarray, begin: np.ndarray,
              end: np.ndarray) -> np.ndarray:
    """Which windows have the bytes of another one; each has a hash and a first word and is
    ``raw[begin:end]``.

    Hashes are sorted; windows of equal hash are compared with the first of them by their bytes,
    neighbouring windows together.
    """
    out = np.zeros(len(at), bool)
    order = np.argsort(hashes, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = hashes[order[1:]] != hashes[order[:-1]]
    head = order[np.flatnonzero(new)]
    leader = np.empty(len(at), np.int64)
    leader[order] = head[np.cumsum(new) - 1]
    rest = np.flatnonzero(leader != np.arange(len(at)))
    if not len(rest):
        return out
    lead = leader[rest]
    del order, new, head, leader
    a, b = at[rest], at[lead]
    fresh = np.ones(len(rest), bool)
    fresh[1:] = (a[1:] != a[:-1] + 1) | (b[1:] != b[:-1] + 1)
    edge = np.append(np.flatnonzero(fresh), len(rest))
    odd = []
    for i, j in zip(edge[:-1], edge[1:]):
        if raw[begin[rest[i]]:end[rest[j - 1]]] == raw[begin[lead[i]]:end[lead[j - 1]]]:
            out[rest[i:j]] = True
            out[lead[i:j]] = True
        else:
            odd += rest[i:j].tolist()
    if odd:  # a run with unequal words of equal hash: count the windows of its hashes by bytes
        seen: dict[bytes, int] = {}
        for i in np.flatnonzero(np.isin(hashes, hashes[odd])):
            text = raw[begin[i]:end[i]]
            other = seen.setdefault(text, i)
            if other != i:
                out[i] = out[other] = True
    return out


def _laid_out(n: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of strings of ``n`` windows, end to end: each window's string, place in it and first word."""
    string = np.repeat(np.arange(len(n)), n)
    step = np.arange(len(string)) - np.repeat(np.cumsum(n) - n, n)
    return string, step, (np.cumsum(n + size - 1) - (n + size - 1))[string] + step


def _windows(packs: Iterable[tuple[bytes, np.ndarray]], size: int) -> tuple:
    """The texts of packs (text, windows of each string) as one, and each window's hash, begin and
    end there.

    Words are split and hashed for some packs at a time, of about ``CHUNK_BYTES`` of text: for all
    of a bucket that takes more than ten times the bytes of its text.
    """
    texts, found, done = [], [], 0
    for some in _together(packs):
        text = b" ".join(t for t, _ in some)
        at = _laid_out(np.concatenate([n for _, n in some]), size)[2]
        words = split(pa.array([text], pa.large_string()))
        found.append((window_hashes(words.hashes(), size)[at], done + words.starts[at],
                      done + words.ends[at + size - 1]))
        texts.append(text)
        done += len(text) + 1
    return b" ".join(texts), *map(np.concatenate, zip(*found))


def _together(packs: Iterable[tuple[bytes, np.ndarray]]) -> Iterator[list]:
    some, volume = [], 0
    for pack in packs:
        some.append(pack)
        volume += len(pack[0])
        if volume >= CHUNK_BYTES:
            yield some
            some, volume = [], 0
    if some:
        yield some


_RANGES = pa.schema([("rid", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])


def _count(size: int):
    """Ranges of words of a bucket's strings that lie in repeated windows."""
    def run(table: pa.Table) -> pa.Table:
        rid = np.frombuffer(b"".join(_unzip(x.as_py()) for x in table.column("rid")), np.int64)
        places = [np.frombuffer(_unzip(x.as_py()), np.int32).reshape(-1, 3)
                  for x in table.column("place")]
        place = np.concatenate(places)
        kind, n = place[:, 2], place[:, 1].astype(np.int64)
        whole = kind == KNOWN
        ranges = [(rid[whole], place[whole, 0], place[whole, 0] + n[whole] + size - 1)]
        sent = np.flatnonzero(~whole)
        if len(sent):
            raw, hashes, begin, end = _windows(
                ((_unzip(text.as_py()), here[here[:, 2] != KNOWN, 1].astype(np.int64))
                 for text, here in zip(table.column("text"), places)
                 if (here[:, 2] != KNOWN).any()), size)
            string, step, at = _laid_out(n[sent], size)
            again = _repeated(raw, hashes, at, begin, end)
            del raw, hashes, begin, end, at
            again |= kind[sent][string] == DOUBLED
            hit = np.flatnonzero(again)
            new = np.ones(len(hit), bool)
            new[1:] = (hit[1:] != hit[:-1] + 1) | (string[hit[1:]] != string[hit[:-1]])
            lo = hit[new]
            hi = hit[np.append(np.flatnonzero(new)[1:], len(hit)) - 1] if len(hit) else lo
            base = place[sent[string[lo]], 0]
            ranges.append((rid[sent[string[lo]]], base + step[lo], base + step[hi] + size))
        return pa.Table.from_arrays([pa.array(np.concatenate(x).astype(t)) for x, t in
                                     zip(zip(*ranges), (np.int64, np.int32, np.int32))],
                                    schema=_RANGES)
    return run


_KEPT = pa.schema([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())])


def _cut(others: list[str]):
    """Each text without the words of its ranges, and the counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                words = split(part.column("text"))
                flat, starts, ends = joined(words)
                delta = np.zeros(len(starts) + 1, np.int32)
                spans = part.column("ranges")
                pairs = spans.flatten()
                owner = np.repeat(np.arange(part.num_rows),
                                  spans.value_lengths().fill_null(0).to_numpy())
                base = words.first[owner]
                np.add.at(delta, base + pairs.field("lo").to_numpy(), 1)
                np.add.at(delta, base + pairs.field("hi").to_numpy(), -1)
                stays = np.cumsum(delta[:-1]) == 0
                size = np.where(stays, ends - starts + 1, 0)
                kept = flat[np.repeat(stays, ends - starts + 1)].tobytes()
                edge = np.concatenate([[0], np.cumsum(size)])[words.first]
                texts = [kept[a:max(a, b - 1)].decode() for a, b in zip(edge, edge[1:])]
                gone = np.concatenate([[0], np.cumsum(~stays)])[words.first]
                fresh = [pa.array(words.counts), pa.array(np.diff(gone)),
                         pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in others] + fresh,
                                                 names=[*others, *_KEPT.names])
    return run


def _heavy(rows: DataFrame, size: int, gram: int, least: float) -> np.ndarray:
    """Minimisers of ``least`` strings or more in a sample of one document in ``SAMPLE_ONE_IN``, the
    ``HEAVY_MOST`` most frequent ones at most, whatever the corpus. The next one has no more than a
    part in ``HEAVY_MOST`` of all strings: at 10**12 strings (100 TB) a million, which is some 60 MB
    more in one bucket. The list only deals out the load; results are the same with any list."""
    sample = rows.filter(F.pmod("rid", F.lit(SAMPLE_ONE_IN)) == 0).select("text")
    frequent = sample.mapInArrow(_minimisers(size, gram), "route long, n long") \
        .groupBy("route").agg(F.sum("n").alias("n")).filter(F.col("n") >= least) \
        .orderBy(F.desc("n"), "route").limit(HEAVY_MOST)
    return np.array([r.route for r in frequent.select("route").toLocalIterator()],
                    np.int64).view(np.uint64)


def remove_repeats(docs: DataFrame, size: int = WINDOW, gram: int = GRAM,
                   bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The rows of (doc_id, text, ...) with n_words, n_removed and kept_text.

    Words covered by a window of ``size`` words that begins at another place too, in any row, go;
    windows are judged on the input. Rows that are equal in all columns are different places. A
    null text has no words; a text shorter than the window stays. Other columns come back as they
    are; columns named as the new ones are replaced.
    """
    others = [c for c in docs.columns if c not in _KEPT.names]
    docs = docs.select(*others)
    rows = docs.select(F.col("text").cast("string").alias("text"),
                       F.xxhash64(F.col("doc_id"), F.col("text")).alias("rid"))
    volume = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    buckets = max(1, -(-volume // bucket_bytes))
    # a bucket holds about one string for each three to four words of its share of the text
    strings = volume / 6 / 17 / buckets
    heavy = _heavy(rows, size, gram, max(8.0, strings * HEAVY_SHARE / SAMPLE_ONE_IN))
    packs = rows.mapInArrow(_pack(size, gram, buckets, heavy),
                            "bucket long, rid binary, place binary, text binary")
    ranges = packs.groupBy("bucket").applyInArrow(_count(size), "rid long, lo int, hi int")
    # written when the ranges of a text are together: few files, and the packs' shuffle can go
    listed = keep(ranges.groupBy(F.col("rid").alias("place")).agg(
        F.collect_set(F.struct("lo", "hi")).alias("ranges")), "ranges")
    marked = docs.withColumn("rid", F.xxhash64("doc_id", "text")).join(
        listed, F.col("rid") == F.col("place"), "left").select(
        *others, F.coalesce("ranges", F.array().cast("array<struct<lo:int,hi:int>>"))
        .alias("ranges"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema),
                        "n_words long", "n_removed long", "kept_text string"])
    return marked.mapInArrow(_cut(others), schema)
