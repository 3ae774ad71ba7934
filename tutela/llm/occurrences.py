"""BPE by an index of pair occurrences, and decoding, as a ``tokenizers`` file says.

The distinct pieces of a stretch of a partition lie end to end as one chain of byte tokens. The
index maps each pair with a merge to the list of all its positions. A heap hands out the ranks in
force in ascending order; all occurrences of one rank are merged from left to right, and each
merge puts the two pairs it makes into the lists of their ranks. A merged pair can only rank after
the merge that made it (checked when the file is read), so a list is complete when its turn
comes. Positions that a neighbour's merge has taken are recognised by their tokens. The
work is proportional to the pairs that ever exist, whatever the length of a piece.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tutela.llm.bpe import Encoder, piece_spans
from tutela.llm.words import chunks

STRETCH_BYTES = 1 << 20  # of pieces indexed at once; one longer piece is indexed alone
_BITS = 20               # of a token id in the key of a pair


def _shown_bytes() -> dict[str, int]:
    """The byte that each character stands for in byte-level files."""
    # fixed values: printable characters stand for themselves, the others follow from 256 on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Merges:
    """Byte-level BPE of a ``tokenizers`` file: ``rank[left << 20 | right]``, ``pair[rank]``,
    the merged ids, the ids of single bytes, the added tokens and the bytes of every id."""

    def __init__(self, content: dict):
        model = content["model"]
        plain = (content["normalizer"] is None and model["type"] == "BPE"
                 and not model.get("dropout") and not model.get("unk_token")
                 and not model.get("continuing_subword_prefix")
                 and not model.get("end_of_word_suffix") and not model.get("byte_fallback")
                 and not model.get("ignore_merges")
                 and (content["pre_tokenizer"] or {}).get("type") == "ByteLevel"
                 and not content["pre_tokenizer"]["add_prefix_space"]
                 and content["pre_tokenizer"].get("use_regex", True)
                 and (content["decoder"] or {}).get("type") == "ByteLevel")
        if not plain:
            raise ValueError("only plain byte-level BPE files can be read")
        shown, ids = _shown_bytes(), model["vocab"]
        self.byte = np.zeros(256, np.int64)
        for character, b in shown.items():
            self.byte[b] = ids[character]
        self.rank: dict[int, int] = {}
        self.pair: list[tuple[int, int]] = []
        self.merged: list[int] = []
        made: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            pair = ids[left], ids[right]
            new = ids[left + right]
            if new in made:
                raise ValueError("two merges make one token")
            made[new] = rank
            self.rank[pair[0] << _BITS | pair[1]] = rank
            self.pair.append(pair)
            self.merged.append(new)
        keys = np.fromiter(self.rank, np.int64, len(self.rank))
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.ranks = np.append(np.fromiter(self.rank.values(), np.int64, len(keys))[order], -1)
        if any(made.get(t, -1) >= rank for rank, pair in enumerate(self.pair) for t in pair):
            raise ValueError("a merge ranks before one that makes its parts")
        self.added = {t["content"].encode(): t["id"] for t in content.get("added_tokens", [])}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"]
               for t in content.get("added_tokens", [])):
            raise ValueError("added tokens that take what is beside them are not read")
        texts = {i: t for t, i in ids.items()} | {i: t.decode() for t, i in self.added.items()}
        whole = [self._bytes(texts.get(i, ""), shown) for i in range(max(texts) + 1)]
        self.bytes = np.frombuffer(b"".join(whole), np.uint8)
        self.lengths = np.array([len(t) for t in whole])
        self.first = np.cumsum(self.lengths) - self.lengths

    @staticmethod
    def _bytes(token: str, shown: dict[str, int]) -> bytes:
        known = [shown.get(c) for c in token]
        return token.encode() if None in known else bytes(known)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 without a merge."""
        key = left << _BITS | right
        place = np.searchsorted(self.keys, key)
        return np.where(self.keys[place] == key, self.ranks[place], -1)


@cache
def merges_of(path: str) -> Merges:
    with open(path, encoding="utf-8") as file:
        return Merges(json.load(file))


def merge_all(merges: Merges, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) \
        -> tuple[np.ndarray, np.ndarray]:
    """The ids of pieces end to end, and how many each has."""
    sizes = ends - starts
    edge = np.concatenate([[0], np.cumsum(sizes)])
    n = int(edge[-1])
    at = np.repeat(starts - edge[:-1], sizes) + np.arange(n)
    first = merges.byte[data[at]]
    last = np.zeros(n, bool)
    last[edge[1:] - 1] = True
    # position n stands for what is beyond a piece's end: its token pairs with nothing
    token = array("q", np.append(first, -1).tobytes())
    after = array("q", np.append(np.where(last, n, np.arange(1, n + 1)), n).tobytes())
    before = np.arange(-1, n)
    before[edge[:-1]] = -1
    before = array("q", before.tobytes())
    where = np.flatnonzero(~last)
    ranks = merges.ranks_of(first[where], first[where + 1])
    where, ranks = where[ranks >= 0], ranks[ranks >= 0]
    order = np.argsort(ranks, kind="stable")
    where, ranks = where[order], ranks[order]
    cuts = np.flatnonzero(np.diff(ranks)) + 1
    index = {int(ranks[a]): array("q", where[a:b].tobytes()) for a, b in zip(
        [0, *cuts], [*cuts, len(ranks)]) if b > a}
    active = list(index)  # ascending, so a heap
    rank_of = merges.rank.get

    def met(rank: int, i: int) -> None:
        if rank in index:
            index[rank].append(i)
        else:
            index[rank] = array("q", [i])
            heapq.heappush(active, rank)

    while active:
        rank = heapq.heappop(active)
        (left, right), new = merges.pair[rank], merges.merged[rank]
        places = index.pop(rank)
        for i in sorted(places) if left == right else places:
            j = after[i]
            if token[i] != left or token[j] != right:
                continue
            token[i], token[j] = new, -1
            k, h = after[j], before[i]
            after[i], before[k] = k, i
            found = rank_of(new << _BITS | token[k]) if k < n else None
            if found is not None:
                met(found, i)
            found = rank_of(token[h] << _BITS | new) if h >= 0 else None
            if found is not None:
                met(found, h)
    tokens = np.frombuffer(token, np.int64)[:n]
    live = tokens >= 0
    return tokens[live].astype(np.int32), np.add.reduceat(live, edge[:-1]) if n else sizes


def pair_index(merges: Merges, added: bool):
    """Encodes distinct pieces, a stretch of them at a time."""
    def encode(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) \
            -> tuple[np.ndarray, np.ndarray]:
        sizes = np.zeros(len(starts), np.int64)
        special: dict[int, int] = {}
        if added:
            raw, long = data.tobytes(), {len(t) for t in merges.added}
            for i in np.flatnonzero(np.isin(ends - starts, list(long))):
                found = merges.added.get(raw[starts[i]:ends[i]])
                if found is not None:
                    special[int(i)] = found
        total, out, i = np.cumsum(ends - starts), [], 0
        while i < len(starts):
            begin = total[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(total, begin + STRETCH_BYTES, side="right")))
            ids, sizes[i:j] = merge_all(merges, data, starts[i:j], ends[i:j])
            out.append(ids)
            i = j
        ids = np.concatenate(out)
        if special:
            keep, first = np.ones(len(ids), bool), np.cumsum(sizes) - sizes
            for i, one in special.items():
                ids[first[i]] = one
                keep[first[i] + 1:first[i] + sizes[i]] = False
                sizes[i] = 1
            ids = ids[keep]
        return ids, sizes
    return encode


def spans_with_added(tokens: list[bytes]):
    """Pieces of texts where an added token (the longest that begins leftmost) is one piece and
    ends the stretches of text beside it."""
    pattern = re.compile(b"|".join(map(re.escape, sorted(tokens, key=len, reverse=True))))

    def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        if not tokens or not any(t in raw for t in tokens):
            return piece_spans(data, offsets)
        found = np.array([m.span() for a, b in zip(offsets, offsets[1:])
                          for m in pattern.finditer(raw, a, b)], np.int64).reshape(-1, 2)
        edges = np.unique(np.concatenate([offsets, found.ravel()]))
        cut = piece_spans(data, edges)[0]
        # a start strictly inside a token is none
        owner = np.searchsorted(found[:, 0], cut, side="left") - 1
        inside = (owner >= 0) & (cut < found[np.maximum(owner, 0), 1]) if len(found) else \
            np.zeros(len(cut), bool)
        cut = cut[~inside]
        return cut, np.diff(np.searchsorted(cut[:-1], offsets))
    return spans


@cache
def index_encoder(path: str, added: bool = True) -> Encoder:
    """Texts to ids, remembering pieces. Without ``added`` the strings of added tokens are text."""
    merges = merges_of(path)
    if added and merges.added:
        return Encoder(pair_index(merges, True), spans_with_added(list(merges.added)))
    return Encoder(pair_index(merges, False))


def bytes_of(merges: Merges, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of ids end to end, and the end of each id's. Ids without a token have none."""
    known = (ids >= 0) & (ids < len(merges.lengths))
    ids = np.where(known, ids, 0)
    sizes = np.where(known, merges.lengths[ids], 0)
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return merges.bytes[np.repeat(merges.first[ids] - (ends - sizes), sizes)
                        + np.arange(total)], ends


def _columns(df: DataFrame) -> list[str]:
    return [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema]


def encode(docs: DataFrame, path: str, added: bool = True) -> DataFrame:
    """The rows of (text, ...) with ``ids`` (array of int), as the library's encode gives them
    without special tokens around the text. ``path`` names the file on every worker.

    A null or empty text has no ids. Repeated rows are encoded each for itself, an empty table
    gives none. Other columns come back whatever their values; a column ``ids`` is replaced.
    """
    others = [c for c in docs.columns if c != "ids"]
    docs = docs.select(*others).withColumn("text", F.col("text").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = index_encoder(path, added)
        for batch in batches:
            for part in chunks(batch, "text"):
                ids, first = encoder(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in others]
                    + [pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids))],
                    names=[*others, "ids"])
    return docs.mapInArrow(run, ", ".join([*_columns(docs), "ids array<int>"]))


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """The rows of (ids, ...) with ``decoded``: the text of the ids, added tokens included. Bytes
    that are no UTF-8 become U+FFFD; null and unknown ids have no text, null lists are empty. A
    column ``decoded`` is replaced."""
    others = [c for c in rows.columns if c != "decoded"]
    rows = rows.select(*others)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = merges_of(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                texts = []
                for ids in some.column("ids").to_pylist():
                    flat = np.array([-1 if i is None else i for i in ids or ()], np.int64)
                    texts.append(bytes_of(merges, flat)[0].tobytes().decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays(
                    [some.column(c) for c in others] + [pa.array(texts, pa.string())],
                    names=[*others, "decoded"])
    return rows.mapInArrow(run, ", ".join([*_columns(rows), "decoded string"]))


@cache
def decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of 0 to n - 1, each with room for a separator, and their numbers."""
    width = len(str(n - 1))
    digits = np.frombuffer(b"".join(str(i).encode().ljust(width + 1) for i in range(n)), np.uint8)
    return digits.reshape(n, width + 1), np.array([len(str(i)) for i in range(n)])


def joined_decimals(ids: np.ndarray, separators: np.ndarray, limit: int) \
        -> tuple[bytes, np.ndarray]:
    """Each id in decimals and its separator end to end, and the end of each with it."""
    digits, sizes = decimals(limit)
    text, sizes = digits[ids], sizes[ids]
    text[np.arange(len(ids)), sizes] = separators
    return text[np.arange(text.shape[1]) <= sizes[:, None]].tobytes(), np.cumsum(sizes + 1)


def _digest(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, merges = index_encoder(path), merges_of(path)
        for batch in batches:
            for part in chunks(batch, "text"):
                ids, first = encoder(part.column("text"))
                data, ends = bytes_of(merges, ids)
                back = np.concatenate([[0], ends])[first]
                text, ends = joined_decimals(ids, np.full(len(ids), ord(","), np.uint8),
                                             len(merges.lengths))
                edge = np.concatenate([[0], ends])[first]
                raw = data.tobytes()
                hexed = [[hashlib.sha256(text[a:max(a, b - 1)]).hexdigest()
                          for a, b in zip(edge, edge[1:])],
                         [hashlib.sha256(raw[a:b].decode("utf-8", "replace").encode()).hexdigest()
                          for a, b in zip(back, back[1:])]]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(first)), *map(pa.array, hexed)],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Encodes and decodes the text of each row of (doc_id, text, ...): doc_id, n_tokens,
    ids_sha256 (decimal ids with commas between), decoded_sha256 (the decoded text in UTF-8).

    A null text is empty, a null doc_id comes back as such, rows that repeat come back as often,
    an empty table gives none; other columns are not read.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(
        _digest(path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
