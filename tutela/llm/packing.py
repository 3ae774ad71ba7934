"""Packing of tokenised documents into sequences by a cutting-stock plan.

Every document is cut into pieces of ``CAPACITY`` tokens and a rest. Pieces are counted by length
class (multiples of ``UNIT``); the plan (``cutting``) is made from this histogram, which has
CAPACITY / UNIT classes whatever the corpus, and says which places each pattern has for the n-th
piece of a class. Pieces are ranked within their class by (task that cut them, order there):
counts of (task, class) are added up, so no class is sorted or gathered in one place.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tutela.llm.bpe import Encoder
from tutela.llm.cutting import plan, slots
from tutela.llm.words import chunks
from tutela.session import keep

CAPACITY = 1024
UNIT = 8
END_ID = 0


@cache
def tokenizer_encoder(path: str) -> Encoder:
    """Ids of pieces by the model of a ``tokenizers`` file of byte-level BPE."""
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(path).model
    # fixed values: the printable characters that stand for the 256 bytes in such files
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    shown = {b: b for b in plain} | {b: 256 + i for i, b in enumerate(others)}

    def encode(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) \
            -> tuple[np.ndarray, np.ndarray]:
        text = data.tobytes().decode("latin-1").translate(shown)
        found = [[t.id for t in model.tokenize(text[a:b])] for a, b in zip(starts, ends)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.array([i for f in found for i in f], np.int32), sizes
    return Encoder(encode)


@cache
def _added(path: str):
    """Ids of texts that hold an added token of the file (such as <|endoftext|>), by the library."""
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(path)
    contents = [t.content for t in library.get_added_tokens_decoder().values()]

    def mend(texts: pa.Array, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hits: set[int] = set()
        for content in contents:
            found = pc.match_substring(texts, content).fill_null(False)
            hits |= set(np.flatnonzero(found.to_numpy(zero_copy_only=False)).tolist())
        if not hits:
            return ids, first
        own = np.split(ids, first[1:-1])
        for i in hits:
            own[i] = np.array(library.encode(texts[i].as_py(), add_special_tokens=False).ids,
                              ids.dtype)
        return np.concatenate(own), np.concatenate([[0], np.cumsum([len(o) for o in own])])
    return mend


_PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
           "task long, class int, place long")


def _cut(path: str, capacity: int, unit: int, added: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = tokenizer_encoder(path), TaskContext.get().partitionId()
        seen = np.zeros(capacity // unit + 1, np.int64)
        for batch in batches:
            for part in chunks(batch, "text"):
                ids, first = encoder(part.column("text"))
                if added:
                    ids, first = _added(path)(part.column("text"), ids, first)
                sizes = np.diff(first) + 1
                raw = np.insert(ids, first[1:], END_ID).astype("<u4").tobytes()
                begin = first[:-1] + np.arange(len(sizes))
                per = -(-sizes // capacity)
                owner = np.repeat(np.arange(len(sizes)), per)
                start = (np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)) * capacity
                length = np.minimum(sizes[owner] - start, capacity)
                at = begin[owner] + start
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at, at + length)]
                kind = -(-length // unit)
                order = np.argsort(kind, kind="stable")
                count = np.bincount(kind, minlength=len(seen))
                place = np.empty(len(kind), np.int64)
                place[order] = np.arange(len(kind)) - np.repeat(np.cumsum(count) - count, count) \
                    + np.repeat(seen, count)
                seen += count
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(owner)), pa.array(start),
                     pa.array(length), pa.array(crc, pa.int64()), pa.array(sizes[owner]),
                     pa.array(np.full(len(kind), task)), pa.array(kind.astype(np.int32)),
                     pa.array(place)],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task",
                           "class", "place"])
    return run


def _seat(table: np.ndarray):
    """The sequence of each piece, and its number there, from the plan's slots."""
    key = table[:, 0] << 48 | table[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.column("class").to_numpy().astype(np.int64)
            rank = batch.column("rank").to_numpy()
            slot = table[np.searchsorted(key, kind << 48 | rank, side="right") - 1]
            over = rank - slot[:, 1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32",
                                           "doc_tokens")]
                + [pa.array(slot[:, 2] + over // slot[:, 3]),
                   pa.array(slot[:, 4] + over % slot[:, 3] * kind)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                       "seat"])
    return run


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, unit: int = UNIT,
         added: bool = False) -> DataFrame:
    """A row for each piece of each row of (doc_id, text, ...): doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset.

    With ``added``, the file's added tokens that a text holds get their own ids, as the library's
    encode gives them; else they are text like any other (encode_special_tokens of the library).
    A document is its ids and a closing id 0; a null or empty text is the closing id alone. Rows
    that repeat, or have a null doc_id, are packed each for itself. An empty table gives none.
    Offsets are gapless: pieces of a sequence follow each other by their actual lengths, which
    are up to ``unit - 1`` below those of the plan.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    pieces = keep(rows.mapInArrow(_cut(path, capacity, unit, added), _PIECES), "pieces")
    counts = pieces.groupBy("class", "task").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("class").orderBy("task").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    bases = keep(counts.withColumn("base", before), "ranks")
    histogram = {r["class"]: r.n for r in bases.groupBy("class").agg(F.sum("n").alias("n"))
                 .collect()}  # capacity / unit rows at most
    table = slots(plan(histogram, capacity // unit))
    ranked = pieces.join(bases.select("class", "task", "base"), ["class", "task"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "class",
        (F.col("base") + F.col("place")).alias("rank"))
    seated = ranked.mapInArrow(
        _seat(table), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                      "sequence_id long, seat long")
    # a sequence has capacity / 1 pieces at most
    row = Window.partitionBy("sequence_id").orderBy("seat").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return seated.withColumn("offset", F.sum("length").over(row) - F.col("length")).drop("seat")
