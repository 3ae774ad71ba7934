"""Byte-level BPE: encoding by a segment tree, and decoding.

The pieces of a text are found on its code points, a few megabytes at a time. Each distinct piece is
encoded once for as long as a Python worker remembers it. A segment tree over a piece's byte
positions holds rank * width + position for the pair that begins there, so its root is the
leftmost pair of the least rank. A merge changes three leaves (the pair itself, its right
neighbour, which is gone, and the pair of its left neighbour) and the paths above them. Pieces of
like length are merged side by side in numpy; longer ones than ``SIDE_BY_SIDE`` bytes singly.
"""

from __future__ import annotations

import base64
import hashlib
import secrets
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tutela.llm.words import chunks, same_spans, span_hashes, text_bytes

SIDE_BY_SIDE = 64
REMEMBERED = 1_000_000  # pieces a worker remembers, about 60 MB with their bytes
REMEMBERED_BYTES = 16 << 20

LETTER, NUMBER, SPACE, OTHER = range(4)
NONE = np.int64(1) << 40


@cache
def _kinds() -> np.ndarray:
    """LETTER, NUMBER, SPACE or OTHER for each code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    for kind, pattern in ((SPACE, r"\s+"), (LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for found in regex.finditer(pattern, every):
            a, b = ord(found.group()[0]), ord(found.group()[-1])
            out[a:b + 1] = kind
    return out


def piece_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of the pieces of UTF-8 texts, and how many each text has.

    The pieces are the matches of: a contraction ('s 't 're 've 'm 'll 'd); letters, numbers or
    other characters, each with a space before them; white space up to its last character
    where more text follows.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    code = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    n, kind = len(code), _kinds()[code]
    edge = np.zeros(n + 4, bool)
    edge[np.searchsorted(lead, offsets)] = True
    starts = np.ones(n + 4, bool)
    starts[1:n] = (kind[1:] != kind[:-1]) | edge[1:n]
    # the last of some white space goes with what follows, if it is a space, or stands alone
    after = np.flatnonzero((kind[1:] != SPACE) & (kind[:-1] == SPACE) & ~edge[1:n]) + 1
    starts[after - 1] = True
    starts[after] = code[after - 1] != 32
    # contractions: an apostrophe that begins a piece, before letters
    padded = np.zeros(n + 4, np.uint32)
    padded[:n] = code
    letter = np.zeros(n + 4, bool)
    letter[:n] = kind == LETTER
    at = np.flatnonzero(code == 39)
    at = at[starts[at] & letter[at + 1] & ~edge[at + 1]]
    one, two = padded[at + 1], padded[at + 2]
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = (((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))
            | (one == ord("l")) & (two == ord("l"))) & ~edge[at + 2] & ~short
    for which, size in ((at[short], 2), (at[long], 3)):
        starts[which + 1] = False
        starts[which + size] |= letter[which + size]
    first = np.flatnonzero(starts[:n])
    spans = np.append(lead[first], len(data))
    return spans, np.diff(np.searchsorted(lead[first], offsets))


class Ranks:
    """Vocabulary in rank order: a token's id is its rank."""

    def __init__(self, tokens: dict[bytes, int]):
        self.of = tokens
        self.byte = np.zeros(256, np.int64)
        for b in range(256):
            self.byte[b] = tokens[bytes([b])]
        known: dict[int, int] = {}
        for token, rank in tokens.items():
            for i in range(1, len(token)):
                left, right = tokens.get(token[:i]), tokens.get(token[i:])
                if left is not None and right is not None:
                    known[left << 20 | right] = rank
        self.pairs = known
        keys = np.fromiter(known, np.int64, len(known))
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.merged = np.append(np.fromiter(known.values(), np.int64, len(known))[order], 0)
        by_rank = sorted(tokens, key=tokens.get)
        self.bytes = np.frombuffer(b"".join(by_rank), np.uint8)
        self.lengths = np.array([len(t) for t in by_rank])
        self.first = np.cumsum(self.lengths) - self.lengths

    @classmethod
    def read(cls, path: str) -> "Ranks":
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})

    def pair(self, left: np.ndarray, right: np.ndarray, scale: int, at: np.ndarray) -> np.ndarray:
        """rank * scale + at of each pair, NONE if it is no token."""
        key = left << 20 | right
        place = np.searchsorted(self.keys, key)
        return np.where(self.keys[place] == key, self.merged[place] * scale + at, NONE)


def merge_side_by_side(ranks: Ranks, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) \
        -> tuple[np.ndarray, np.ndarray]:
    """Ids of pieces of 2 to ``SIDE_BY_SIDE`` + 1 bytes end to end, and how many each has."""
    m, longest = len(starts), int(sizes.max())
    width = 1 << int(longest - 2).bit_length() if longest > 2 else 1
    column = np.arange(width + 2)
    valid = column < sizes[:, None]
    token = np.where(valid, ranks.byte[data[np.minimum(starts[:, None] + column,
                                                       len(data) - 1)]], 0)
    after = np.tile(column + 1, (m, 1))
    before = np.tile(column - 1, (m, 1))
    tree = np.full((m, 2 * width), NONE)
    leaf = ranks.pair(token[:, :width], token[:, 1:width + 1], width, column[:width])
    tree[:, width:] = np.where(valid[:, 1:width + 1], leaf, NONE)
    level = width
    while level > 1:
        level //= 2
        tree[:, level:2 * level] = np.minimum(tree[:, 2 * level:4 * level:2],
                                              tree[:, 2 * level + 1:4 * level:2])
    alive = valid.copy()
    row = np.flatnonzero(tree[:, 1] < NONE)
    while len(row):
        best = tree[row, 1]
        at, rank = best % width, best // width
        gone = after[row, at]
        token[row, at] = rank
        alive[row, gone] = False
        right = after[row, gone]
        after[row, at] = right
        before[row, right] = at
        fresh = np.where(right < sizes[row], ranks.pair(rank, token[row, right], width, at), NONE)
        left = before[row, at]
        has = left >= 0
        near = np.where(has, ranks.pair(token[row, left], rank, width, left), NONE)
        for places, values, rows in ((at, fresh, row),
                                     (gone[gone < width], NONE, row[gone < width]),
                                     (left[has], near[has], row[has])):
            node = places + width
            tree[rows, node] = values
            while width > 1 and node[0:1].size and node[0] > 1:
                node = node // 2
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
        row = row[tree[row, 1] < NONE]
    return token[alive], alive.sum(axis=1)


def merge_one(ranks: Ranks, piece: bytes) -> list[int]:
    """Ids of one piece, by the same tree in plain lists."""
    n = len(piece)
    width = 1 << max(0, (n - 2)).bit_length() if n > 1 else 1
    token = [int(ranks.byte[b]) for b in piece]
    none, pairs = int(NONE), ranks.pairs
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    tree = [none] * (2 * width)

    def key(i: int) -> int:
        j = after[i]
        rank = pairs.get(token[i] << 20 | token[j]) if j < n else None
        return none if rank is None else rank * width + i

    def put(i: int, value: int) -> None:
        i += width
        tree[i] = value
        while i > 1:
            i >>= 1
            least = min(tree[2 * i], tree[2 * i + 1])
            if tree[i] == least:
                break
            tree[i] = least

    for i in range(n - 1):
        tree[width + i] = key(i)
    for i in range(width - 1, 0, -1):
        tree[i] = min(tree[2 * i], tree[2 * i + 1])
    while n > 1 and tree[1] < none:
        rank, i = divmod(tree[1], width)
        j = after[i]
        token[i], after[i] = rank, after[j]
        if after[i] < n:
            before[after[i]] = i
        if j < width:
            put(j, none)
        put(i, key(i))
        if before[i] >= 0:
            put(before[i], key(before[i]))
        token[j] = -1
    return [t for t in token if t >= 0]


def segment_tree(ranks: Ranks):
    """Encodes distinct pieces; a piece that is a token is that token."""
    def encode(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) \
            -> tuple[np.ndarray, np.ndarray]:
        sizes = ends - starts
        raw = data.tobytes()
        ids: list[np.ndarray] = []
        owner: list[np.ndarray] = []
        whole = np.array([ranks.of.get(raw[a:b], -1) for a, b in zip(starts, ends)], np.int64)
        ids.append(whole[whole >= 0])
        owner.append(np.flatnonzero(whole >= 0))
        rest = whole < 0
        low = 1
        for high in (3, 5, 9, 17, 33, SIDE_BY_SIDE + 1):
            which = np.flatnonzero(rest & (sizes > low) & (sizes <= high))
            for at in range(0, len(which), 1 << 15):
                some = which[at:at + (1 << 15)]
                got, n = merge_side_by_side(ranks, data, starts[some], sizes[some])
                ids.append(got)
                owner.append(np.repeat(some, n))
            low = high
        for i in np.flatnonzero(rest & (sizes > low)):
            got = merge_one(ranks, raw[starts[i]:ends[i]])
            ids.append(np.array(got, np.int64))
            owner.append(np.full(len(got), i))
        owner_all, ids_all = np.concatenate(owner), np.concatenate(ids)
        order = np.argsort(owner_all, kind="stable")
        return ids_all[order].astype(np.int32), np.bincount(owner_all, minlength=len(starts))
    return encode


class Encoder:
    """Texts to ids; remembers pieces and their ids.

    ``encode_pieces(data, starts, ends)`` gives the ids of distinct pieces end to end and their
    number for each; ``spans(data, offsets)`` cuts texts into pieces. Pieces are looked up by a
    keyed hash and every one is compared with the bytes remembered. Should two of one hash differ,
    everything is forgotten and another key drawn.
    """

    def __init__(self, encode_pieces, spans=piece_spans):
        self.encode_pieces, self.spans = encode_pieces, spans
        self._forget()

    def _forget(self):
        self.seed = secrets.randbits(64)
        self.keys = np.zeros(0, np.uint64)
        self.slot = np.zeros(0, np.int64)
        self.first = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)
        self.data = np.zeros(0, np.uint8)  # the remembered pieces end to end
        self.ends = np.zeros(1, np.int64)

    def _slots(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray | None:
        """The slot of each piece, new ones encoded; None if unequal pieces have one hash."""
        hashes = span_hashes(data, starts, ends, self.seed)
        distinct, example, which = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, distinct)
        new = np.ones(len(distinct), bool)
        inside = place < len(self.keys)
        new[inside] = self.keys[place[inside]] != distinct[inside]
        if new.any():
            at = example[new]
            ids, sizes = self.encode_pieces(data, starts[at], ends[at])
            slots = len(self.first) + np.arange(len(at))
            self.first = np.append(self.first, len(self.ids) + np.cumsum(sizes) - sizes)
            self.sizes = np.append(self.sizes, sizes)
            self.ids = np.append(self.ids, ids)
            taken = ends[at] - starts[at]
            stop = np.cumsum(taken)
            self.data = np.append(self.data, data[
                np.repeat(starts[at] - (stop - taken), taken) + np.arange(stop[-1])])
            self.ends = np.append(self.ends, self.ends[-1] + stop)
            self.keys = np.insert(self.keys, place[new], distinct[new])
            self.slot = np.insert(self.slot, place[new], slots)
            place = np.searchsorted(self.keys, distinct)
        slot = self.slot[place][which]
        known = same_spans(data, starts, ends, self.data, self.ends[slot], self.ends[slot + 1])
        return slot if known.all() else None

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and where each text's begin (and the last end)."""
        data, offsets = text_bytes(texts)
        spans, per_text = self.spans(data, offsets)
        if len(spans) < 2:
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        if len(self.keys) > REMEMBERED or len(self.data) > REMEMBERED_BYTES:
            self._forget()
        while (slot := self._slots(data, spans[:-1], spans[1:])) is None:
            self._forget()
        sizes = self.sizes[slot]
        ends = np.cumsum(sizes)
        take = np.repeat(self.first[slot] - (ends - sizes), sizes) + np.arange(ends[-1])
        pieces = np.concatenate([[0], np.cumsum(per_text)])
        return self.ids[take], np.concatenate([[0], ends])[pieces]


@cache
def ranks_of(path: str) -> Ranks:
    return Ranks.read(path)


@cache
def tree_encoder(path: str) -> Encoder:
    return Encoder(segment_tree(ranks_of(path)))


def decode(ranks: Ranks, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of ids end to end, and the end of each id's."""
    sizes = ranks.lengths[ids]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return ranks.bytes[np.repeat(ranks.first[ids] - (ends - sizes), sizes) + np.arange(total)], ends


def _encode(others: list[str], path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tree_encoder(path)
        for batch in batches:
            for part in chunks(batch, "text"):
                ids, first = encoder(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in others]
                    + [pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids))],
                    names=[*others, "ids"])
    return run


def encode(docs: DataFrame, path: str) -> DataFrame:
    """The rows of (text, ...) with ``ids`` (array of int). A null text is empty. ``path`` names
    the ranks file on every worker. Other columns come back, a column ``ids`` is replaced."""
    others = [c for c in docs.columns if c != "ids"]
    docs = docs.select(*others).withColumn("text", F.col("text").cast("string"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema),
                        "ids array<int>"])
    return docs.mapInArrow(_encode(others, path), schema)


def _decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    text = [f"{i} ".encode() for i in range(n)]
    sizes = np.array([len(t) for t in text])
    return np.frombuffer(b"".join(t.ljust(7) for t in text), np.uint8).reshape(n, 7), sizes


def _decode(others: list[str], path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = ranks_of(path)
        for batch in batches:
            ids = batch.column("ids")
            flat = ids.flatten().to_numpy()
            first = np.concatenate([[0], np.cumsum(ids.value_lengths().fill_null(0).to_numpy())])
            for at in range(0, max(1, batch.num_rows), 256):
                part = first[at:at + 257]
                data, ends = decode(ranks, flat[part[0]:part[-1]])
                edge = np.concatenate([[0], ends])[part - part[0]]
                raw = data.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(at, 256) for c in others]
                    + [pa.array([raw[a:b] for a, b in zip(edge, edge[1:])], pa.binary())],
                    names=[*others, "decoded"])
    return run


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """The rows of (ids, ...) with ``decoded`` (bytes, which need not be UTF-8 for free ids)."""
    others = [c for c in rows.columns if c != "decoded"]
    rows = rows.select(*others)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema),
                        "decoded binary"])
    return rows.mapInArrow(_decode(others, path), schema)


def _digest(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, ranks = tree_encoder(path), ranks_of(path)
        digits, width = _decimals(len(ranks.lengths))
        column = np.arange(7)
        for batch in batches:
            for part in chunks(batch, "text"):
                ids, first = encoder(part.column("text"))
                data, ends = decode(ranks, ids)
                back = np.concatenate([[0], ends])[first]
                text = digits[ids][column < width[ids][:, None]].tobytes()
                edge = np.concatenate([[0], np.cumsum(width[ids])])[first]
                raw = data.tobytes()
                hexed = [[hashlib.sha256(text[a:max(a, b - 1)]).hexdigest()
                          for a, b in zip(edge, edge[1:])],
                         [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(back, back[1:])]]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(first)), *map(pa.array, hexed)],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Encodes and decodes every text and returns (doc_id, n_tokens, ids_sha256, decoded_sha256):
    digests of the ids in decimals with one space between, and of the decoded bytes. A null text is
    empty, a null doc_id comes back as such, rows that repeat come back as often, an empty table
    gives none; other columns are not read."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(
        _digest(path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
