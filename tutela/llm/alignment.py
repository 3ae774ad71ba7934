"""Alignment of two tokenizers' tokens by diagonal run skipping, and counts of linked ids.

Both token sequences of a text cover the same bytes, so their arrays of end offsets meet at the ends
of groups. While token i of A ends where token i + shift of B does, groups are one to one: probes of
1, 2, 4, ... tokens compare the two arrays at the present shift, and halving finds where such a run
ends. What follows is an irregular group: it is walked token by token to the next common end, and
the shift is that of the tokens after it. All texts of a chunk are one such walk, as every text's
end is common.

Counts of linked id pairs are over all documents, yet documents do not meet: a block of texts holds
its distinct pairs once, with the number of its documents that have each. Pairs are counted over
blocks (a pair is in a block once, so none is hotter than the number of blocks), and each block
gets the counts of its own pairs back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tutela.llm.bpe import Encoder
from tutela.llm.occurrences import bytes_of, index_encoder, joined_decimals, merges_of
from tutela.llm.words import chunks, text_bytes
from tutela.session import keep

BLOCK_LINKS = 3_000_000   # entries of (document, pair) after which a block is handed on
CHUNK = 1 << 20           # bytes of text aligned at once
EXPANDED = 4096           # links of a group that are counted by distinct ids from there on
_SIDE = 20                # bits of an id of B in the key of a pair
SPACE = "▁"          # stands for a space in pieces


class Pieces:
    """A ``sentencepiece`` model with the bytes of each of its ids."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        whole = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i)
                 else p.replace(SPACE, " ").encode() for i, p in enumerate(names)]
        self.bytes = np.frombuffer(b"".join(whole), np.uint8)
        self.lengths = np.array([len(t) for t in whole])
        self.first = np.cumsum(self.lengths) - self.lengths
        # no piece goes on past a character before a space: texts can be cut there
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in names)
        self.space = self.model.piece_to_id(SPACE)

    def encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) \
            -> tuple[np.ndarray, np.ndarray]:
        """Ids of stretches of text that begin with a space, which the model puts there itself."""
        raw = data.tobytes()
        found = self.model.encode([raw[a + 1:b].decode() for a, b in zip(starts, ends)],
                                  num_threads=1)
        found = [f or [self.space] for f in found]  # a space alone
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.array([i for f in found for i in f], np.int32), sizes


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of texts that begin with a space: some spaces and what is not one."""
    space = data == 32
    begin = space.copy()
    begin[1:] &= ~space[:-1]
    begin[offsets[:-1][offsets[:-1] < len(data)]] = True
    first = np.flatnonzero(begin)
    return np.append(first, len(data)), np.diff(np.searchsorted(first, offsets))


def _texts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = offsets[:-1][np.diff(offsets) > 0]
    return np.append(first, len(data)), (np.diff(offsets) > 0).astype(np.int64)


@cache
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


@cache
def piece_encoder(path: str) -> Encoder:
    pieces = pieces_of(path)
    return Encoder(pieces.encode, _words if pieces.by_word else _texts)


def diagonal_runs(a: list[int], b: list[int]) -> list[tuple[int, int, int]]:
    """(i, j, n) for each run of groups of two arrays of end offsets that end alike: groups 0 to
    n - 1 of it end before tokens i + k of A and j + k of B. Both arrays ascend."""
    runs, i, j, n = [], 0, 0, len(a)
    while i < n:
        k, step = 0, 1
        while i + k < n and a[i + k:i + k + step] == b[j + k:j + k + step]:
            k, step = k + step, step * 2
        k = min(k, n - i)
        while step > 1 and i + k < n:  # the probe that failed holds the end of the run
            step //= 2
            if a[i + k:i + k + step] == b[j + k:j + k + step]:
                k = min(k + step, n - i)
        if k:
            runs.append((i + 1, j + 1, k))
            i, j = i + k, j + k
            if i == n:
                break
        x, y = a[i], b[j]
        while x != y:
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        i, j = i + 1, j + 1
        runs.append((i, j, 1))
    return runs


@dataclass
class Aligned:
    """Tokens of some texts end to end with their groups; ``*_first`` bound each text's."""

    a: np.ndarray
    b: np.ndarray
    a_first: np.ndarray
    b_first: np.ndarray
    a_ends: np.ndarray      # exclusive, one for each group
    b_ends: np.ndarray
    group_first: np.ndarray


def _without(ids: np.ndarray, first: np.ndarray, good: np.ndarray) \
        -> tuple[np.ndarray, np.ndarray]:
    sizes = np.diff(first)
    held = np.repeat(good, sizes)
    return ids[held], np.concatenate([[0], np.cumsum(np.where(good, sizes, 0))])


def align(texts: pa.Array, a_path: str, b_path: str) -> Aligned:
    """Tokens and groups of texts; null and empty ones and those whose tokens do not give the
    bytes of a space and the text have none."""
    some = pc.fill_null(pc.greater(pc.binary_length(texts), 0), False)
    spaced = pc.if_else(some, pc.binary_join_element_wise(
        pa.scalar("", texts.type), texts, pa.scalar(" ", texts.type)), "")
    data, offsets = text_bytes(spaced)
    a_ids, a_first = index_encoder(a_path, added=False)(spaced)
    b_ids, b_first = piece_encoder(b_path)(spaced)
    merges, pieces = merges_of(a_path), pieces_of(b_path)
    good = np.ones(len(texts), bool)
    for table, ids, first in ((merges, a_ids, a_first), (pieces, b_ids, b_first)):
        got, ends = bytes_of(table, ids)
        if len(got) == len(data) and (got == data).all():
            continue
        edge = np.concatenate([[0], ends])[first]
        for d in range(len(texts)):
            good[d] &= np.array_equal(got[edge[d]:edge[d + 1]], data[offsets[d]:offsets[d + 1]])
    if not good.all():
        a_ids, a_first = _without(a_ids, a_first, good)
        b_ids, b_first = _without(b_ids, b_first, good)
    a_bytes = np.cumsum(merges.lengths[a_ids])
    runs = np.array(diagonal_runs(a_bytes.tolist(), np.cumsum(pieces.lengths[b_ids]).tolist()),
                    np.int64).reshape(-1, 3)
    n = runs[:, 2]
    stop = np.cumsum(n)
    step = np.arange(stop[-1] if len(stop) else 0) - np.repeat(stop - n, n)
    a_ends, b_ends = np.repeat(runs[:, 0], n) + step, np.repeat(runs[:, 1], n) + step
    return Aligned(a_ids, b_ids, a_first, b_first, a_ends, b_ends,
                   np.searchsorted(a_ends, a_first, side="right"))


def group_texts(found: Aligned, a_limit: int, b_limit: int) -> list[str]:
    """SHA-256 of ``a1,a2|b1;a3|b2,b3`` for each text, '' without tokens."""
    groups = len(found.a_ends)
    a_size, b_size = np.diff(found.a_ends, prepend=0), np.diff(found.b_ends, prepend=0)
    total = len(found.a) + len(found.b)
    ids, marks = np.empty(total, np.int64), np.full(total, ord(","), np.uint8)
    a_group, b_group = np.repeat(np.arange(groups), a_size), np.repeat(np.arange(groups), b_size)
    before = found.b_ends - b_size
    ids[np.arange(len(found.a)) + before[a_group]] = found.a
    ids[np.arange(len(found.b)) + found.a_ends[b_group]] = found.b
    marks[found.a_ends + before - 1] = ord("|")
    marks[found.a_ends + found.b_ends - 1] = ord(";")
    text, ends = joined_decimals(ids, marks, max(a_limit, b_limit))
    edge = np.concatenate([[0], ends])[found.a_first + found.b_first]
    return [hashlib.sha256(text[a:b - 1]).hexdigest() if b > a else ""
            for a, b in zip(edge, edge[1:])]


def linked_pairs(found: Aligned) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, pair, times) for each distinct pair a << 20 | b of ids linked in a text, sorted."""
    a_size, b_size = np.diff(found.a_ends, prepend=0), np.diff(found.b_ends, prepend=0)
    text = np.repeat(np.arange(len(found.group_first) - 1), np.diff(found.group_first))
    links = a_size * b_size
    few = np.flatnonzero(links < EXPANDED)
    n = links[few]
    stop = np.cumsum(n)
    step = np.arange(stop[-1] if len(stop) else 0) - np.repeat(stop - n, n)
    width = np.repeat(b_size[few], n)
    a = found.a[np.repeat(found.a_ends[few] - a_size[few], n) + step // width]
    b = found.b[np.repeat(found.b_ends[few] - b_size[few], n) + step % width]
    owner, pair = [np.repeat(text[few], n)], [a.astype(np.int64) << _SIDE | b]
    times = [np.ones(len(a), np.int64)]
    for g in np.flatnonzero(links >= EXPANDED):
        left, right = (np.unique(side[end - size:end], return_counts=True)
                       for side, end, size in ((found.a, found.a_ends[g], a_size[g]),
                                               (found.b, found.b_ends[g], b_size[g])))
        pair.append((left[0].astype(np.int64)[:, None] << _SIDE | right[0]).ravel())
        times.append(np.outer(left[1], right[1]).ravel())
        owner.append(np.full(len(pair[-1]), text[g]))
    owner, pair, times = map(np.concatenate, (owner, pair, times))
    order = np.lexsort((pair, owner))
    owner, pair, times = owner[order], pair[order], times[order]
    new = np.ones(len(pair), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (pair[1:] != pair[:-1])
    at = np.flatnonzero(new)
    return owner[at], pair[at], np.add.reduceat(times, at) if len(at) else times


_ZSTD = pa.Codec("zstd", compression_level=3)


def _zip(values: np.ndarray, kind: str) -> bytes:
    raw = values.astype(kind).tobytes()
    return len(raw).to_bytes(8, "little") + _ZSTD.compress(raw, asbytes=True)


def _unzip(packed: bytes, kind: str) -> np.ndarray:
    size = int.from_bytes(packed[:8], "little")
    raw = _ZSTD.decompress(packed[8:], size, asbytes=True) if size else b""
    return np.frombuffer(raw, kind).astype(np.int64)


_TEXTS = [("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
          ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string())]
_BLOCK = pa.schema([("block", pa.int64()), *((n, pa.list_(t)) for n, t in _TEXTS),
                    ("pairs", pa.list_(pa.int64())), ("held", pa.list_(pa.int64())),
                    ("sizes", pa.binary()), ("places", pa.binary()), ("times", pa.binary())])
_SQL = {pa.int64(): "long", pa.string(): "string"}


class _Block:
    """Texts gathered until their distinct pairs are many."""

    def __init__(self):
        self.texts = {name: [] for name, _ in _TEXTS}
        self.sizes: list[np.ndarray] = []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.held = 0

    def add(self, ids: pa.Array, found: Aligned, hashes: list[str]) -> None:
        n = len(ids)
        owner, pair, times = linked_pairs(found)
        links = np.diff(found.a_ends, prepend=0) * np.diff(found.b_ends, prepend=0)
        summed = np.concatenate([[0], np.cumsum(links)])[found.group_first]
        columns = (ids.to_pylist(), *(np.diff(x).tolist() for x in (
            found.a_first, found.b_first, found.group_first, summed)), hashes)
        for (name, _), values in zip(_TEXTS, columns):
            self.texts[name] += values
        self.sizes.append(np.bincount(owner, minlength=n))
        self.pairs.append(pair)
        self.times.append(times)
        self.held += len(pair)

    def row(self, number: int) -> pa.RecordBatch:
        pair, places, held = np.unique(np.concatenate(self.pairs), return_inverse=True,
                                       return_counts=True)
        # places ascend within a text, so their differences are small
        own = {**self.texts, "block": number, "pairs": pair, "held": held,
               "sizes": _zip(np.concatenate(self.sizes), "<i8"),
               "places": _zip(np.diff(places, prepend=0), "<i4"),
               "times": _zip(np.concatenate(self.times), "<i8")}
        return pa.RecordBatch.from_pydict({k: [own[k]] for k in _BLOCK.names}, schema=_BLOCK)


def _blocks(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_limit, b_limit = len(merges_of(a_path).lengths), len(pieces_of(b_path).lengths)
        number, block = TaskContext.get().partitionId() << 32, _Block()
        for batch in batches:
            for part in chunks(batch, "text", CHUNK):
                found = align(part.column("text"), a_path, b_path)
                block.add(part.column("doc_id"), found, group_texts(found, a_limit, b_limit))
                if block.held > BLOCK_LINKS:
                    yield block.row(number)
                    number, block = number + 1, _Block()
        if block.texts["doc_id"]:
            yield block.row(number)
    return run


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of each block with the sums of their pairs' counts."""
    for batch in batches:
        for r in range(batch.num_rows):
            row = batch.slice(r, 1)
            one = {c: row.column(c).flatten() for c in ("count", "best")}
            count = one["count"].to_numpy()
            best = one["best"].to_numpy(zero_copy_only=False).astype(np.int64)
            sizes, places, times = (_unzip(row.column(c)[0].as_py(), k) for c, k in (
                ("sizes", "<i8"), ("places", "<i4"), ("times", "<i8")))
            places = np.cumsum(places)
            edge = np.concatenate([[0], np.cumsum(sizes)])
            columns = {n: row.column(n).flatten() for n, _ in _TEXTS}
            for name, value in (("n_best", best), ("count_sum", count)):
                total = np.concatenate([[0], np.cumsum(times * value[places])])
                columns[name] = pa.array(np.diff(total[edge]), pa.int64())
            out = pa.RecordBatch.from_pydict(columns)
            for at in range(0, out.num_rows, 4096):
                yield out.slice(at, 4096)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, a, b, count, best): in how many documents each pair of ids is linked, and whether no
    pair of the same id of A is in more."""
    counts = keep(blocks.select(F.explode(F.arrays_zip("pairs", "held")).alias("one"))
                  .groupBy(F.col("one.pairs").alias("pair")).agg(
        F.sum("one.held").alias("count")), "pair-counts")
    a = F.shiftright("pair", _SIDE)
    most = counts.groupBy(a.alias("a")).agg(F.max("count").alias("most"))
    # one row for each id of A at most: the size of a vocabulary
    return counts.withColumn("a", a).join(F.broadcast(most), "a").select(
        "pair", "a", F.col("pair").bitwiseAND((1 << _SIDE) - 1).alias("b"), "count",
        (F.col("count") == F.col("most")).alias("best"))


def token_blocks(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Aligned texts of (doc_id, text, ...) in blocks, with their linked pairs."""
    schema = ", ".join(["block long", *(f"{n} array<{_SQL[t]}>" for n, t in _TEXTS),
                        "pairs array<long>, held array<long>, sizes binary, places binary, "
                        "times binary"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    return keep(rows.mapInArrow(_blocks(a_path, b_path), schema), "token-blocks")


def link_counts(blocks: DataFrame, counts: DataFrame) -> DataFrame:
    """The texts of blocks with n_best and count_sum."""
    places = blocks.select("block", F.posexplode("pairs").alias("place", "pair"))
    own = places.join(counts.select("pair", "count", "best"), "pair").groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("place", "count", "best"))).alias("own")).select(
        F.col("block").alias("of"), F.col("own.count").alias("count"),
        F.col("own.best").alias("best"))
    # a block of texts without any pair has no counts
    none = F.array().cast("array<long>"), F.array().cast("array<boolean>")
    joined = blocks.join(own, F.col("block") == F.col("of"), "left").select(
        *(n for n, _ in _TEXTS), "sizes", "places", "times",
        F.coalesce("count", none[0]).alias("count"), F.coalesce("best", none[1]).alias("best"))
    return joined.mapInArrow(_sums, ", ".join(
        [*(f"{n} {_SQL[t]}" for n, t in _TEXTS), "n_best long, count_sum long"]))


def align_corpus(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum) for each row of
    (doc_id, text, ...).

    ``a_path`` is a byte-level BPE file, whose added tokens are plain text here, ``b_path`` a
    sentencepiece model; both lie on every worker. Texts that are null or empty, or that either
    side does not give back byte for byte, have no tokens: zeros and ''. Rows that repeat count
    as documents of their own and come back as often; a null doc_id comes back as such; ties for
    the highest count are all best; an empty table gives no rows; other columns are not read.
    """
    blocks = token_blocks(docs, a_path, b_path)
    return link_counts(blocks, pair_counts(blocks))
