"""Near duplicates by fast similarity sketches, banding and exact verification.

A document's set holds the hashes of its distinct shingles of ``SHINGLE`` words. Its sketch is
filled by rounds: in round i each element is thrown into one of T bins with the value i + u; from
round T on, round T + j throws all elements into bin j, so every coordinate is filled after 2 T
rounds at most, and coordinates of two sets agree with the probability of their Jaccard
similarity, concentrated as for independent draws. ``BANDS`` bands of ``ROWS`` coordinates are
matched; at 0.85 a pair misses all bands with a probability of 3e-7.

Shingles are 64-bit hashes under a key drawn for each run, so that unequal ones are taken for equal
only by chance (2**-64 for each two of them).

Documents of equal sets are one node. Buckets of one leader (smallest node) form a group; every
member is verified against the leader, and what is not linked with it (a stray) against every
member of the group, block against block, so no pair is emitted and no group is one task.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tutela.llm.graph import components
from tutela.llm.words import CHUNK_BYTES, chunks, gram_hashes, mix, split
from tutela.session import keep

SHINGLE = 5
BANDS = 32
ROWS = 6
BLOCK = 256

_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: pa.Array, size: int = SHINGLE, seed: int = 0) \
        -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text end to end, and where each text's begin.

    Fewer words than ``size`` are one shingle, no words none. ``seed`` keys the hashes.
    """
    words = split(texts, lower=True)
    hashes = words.hashes(seed)
    grams = gram_hashes(hashes, size)
    counts = words.counts
    owner = np.repeat(np.arange(len(counts)), np.maximum(counts - size + 1, 0))
    place = np.arange(len(owner)) - np.repeat(
        np.cumsum(np.maximum(counts - size + 1, 0)) - np.maximum(counts - size + 1, 0),
        np.maximum(counts - size + 1, 0)) + words.first[:-1][owner]
    value = grams[place]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for n in range(1, size):
            have = counts[short] == n
            at = words.first[:-1][short[have]]
            total = np.full(len(at), np.uint64(n), np.uint64)
            for i in range(n):
                total = mix(total * _STEP + hashes[at + i])
            whole[have] = mix(total)
        owner, value = np.concatenate([owner, short]), np.concatenate([value, whole])
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    owner, value = owner[new], value[new]
    return value, np.searchsorted(owner, np.arange(len(counts) + 1))


def sketches(values: np.ndarray, first: np.ndarray, t: int = BANDS * ROWS) -> np.ndarray:
    """One row of ``t`` coordinates for each set; a coordinate is (round, element draw) packed in
    64 bits. Rows of empty sets stay unfilled."""
    n = len(first) - 1
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(n * t, empty, np.uint64)
    sizes = np.diff(first)
    open_sets = np.flatnonzero(sizes > 0)
    missing = np.where(sizes > 0, t, 0)
    element, owner = values, np.repeat(np.arange(n), sizes)
    for i in range(2 * t):
        if not len(open_sets):
            break
        draw = mix(element + np.uint64((i + 1) * int(_STEP) % (1 << 64)))
        # the high 53 bits of a second mix are the value, the first picks the bin
        low = (mix(draw ^ _STEP) >> np.uint64(11)) | (np.uint64(i) << np.uint64(53))
        column = (draw % np.uint64(t)).astype(np.int64) if i < t else np.full(len(draw), i - t)
        place = owner * t + column
        free = (out[place] == empty)
        place, low = place[free], low[free]
        touched = np.unique(place) if len(place) < n * t else np.flatnonzero(
            np.bincount(place, minlength=n * t))
        np.minimum.at(out, place, low)
        missing -= np.bincount(touched // t, minlength=n)
        if (missing[open_sets] == 0).sum() * 4 >= len(open_sets) or i == t - 1:
            open_sets = open_sets[missing[open_sets] > 0]
            keep_rows = missing[owner] > 0
            element, owner = element[keep_rows], owner[keep_rows]
    return out.reshape(n, t)


def band_keys(sketch: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key for each band of each sketch; the band's number is part of it."""
    parts = sketch.reshape(len(sketch), bands, rows)
    total = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(sketch), 1))
    for i in range(rows):
        total = mix(total * _STEP + parts[:, :, i])
    return total


_FEATURES = pa.schema([("doc_id", pa.int64()), ("rid", pa.int64()), ("n_shingles", pa.int64()),
                       ("node", pa.binary()), ("bands", pa.list_(pa.int64()))])


def _features(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                values, first = shingle_sets(part.column("text"), seed=seed)
                sizes = np.diff(first)
                keys = band_keys(sketches(values, first)).view(np.int64)
                nodes = [_node(values[a:b]) if b > a else None for a, b in zip(first, first[1:])]
                offsets = np.arange(len(nodes) + 1, dtype=np.int32) * BANDS
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("rid"), pa.array(sizes),
                    pa.array(nodes, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel()))],
                    schema=_FEATURES)
    return run


def _node(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) \
        -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of equal keys of a sorted stream, one table each; keys hold no nulls."""
    held, now = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        change[0] = True
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        edges = [*np.flatnonzero(change), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            key = tuple(c[a] for c in columns)
            if held and key != now:
                yield now, pa.Table.from_batches(held)
                held = []
            now = key
            held.append(batch.slice(a, b - a))
    if held:
        yield now, pa.Table.from_batches(held)


def _sets(seed: int):
    """A row (leader, block, node, set) for each leader a document's text has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                values, first = shingle_sets(part.column("text"), seed=seed)
                out, held = {k: [] for k in _SETS.names}, 0
                rows = zip(part.column("node").to_pylist(), part.column("groups").to_pylist(),
                           first, first[1:])
                for node, groups, a, b in rows:
                    if _node(values[a:b]) != node:
                        continue
                    for g in groups:
                        out["leader"].append(g["leader"])
                        out["blocks"].append(g["blocks"])
                        out["node"].append(node)
                        out["elements"].append(values[a:b].tobytes())
                        held += b - a
                        if held > CHUNK_BYTES:
                            yield pa.RecordBatch.from_pydict(out, schema=_SETS)
                            out, held = {k: [] for k in out}, 0
                yield pa.RecordBatch.from_pydict(out, schema=_SETS)
    return run


_SETS = pa.schema([("leader", pa.int64()), ("blocks", pa.int64()), ("node", pa.binary()),
                   ("elements", pa.binary())])


class _Group:
    """The sets of some nodes, ready for exact comparison of one of them with all."""

    def __init__(self, elements: list[bytes]):
        flat = [np.frombuffer(e, np.uint64) for e in elements]
        self.sizes = np.array([len(f) for f in flat])
        self.first = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        _, self.column = np.unique(np.concatenate(flat), return_inverse=True)
        self.marks = np.zeros(int(self.column.max()) + 1, np.int64)

    def linked(self, i: int, percent: int) -> np.ndarray:
        own = self.column[self.first[i]:self.first[i] + self.sizes[i]]
        self.marks[own] = 1
        common = np.add.reduceat(self.marks[self.column], self.first)
        self.marks[own] = 0
        return 100 * common >= percent * (self.sizes + self.sizes[i] - common)


class _Forest:
    """Of links found one after the other, those that connect something new."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = i = self.parent[self.parent[i]]
        return i

    def new(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        self.parent[b] = a
        return a != b


_FOUND = pa.schema([("leader", pa.int64()), ("block", pa.int64()), ("a", pa.binary()),
                    ("b", pa.binary()), ("stray", pa.bool_())])


def _inside(percent: int):
    """Links within a block, its first node being the group's leader: enough of them to connect
    what is connected. Nodes not linked with the leader by way of the block are strays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (leader, block), table in sorted_groups(batches, ["leader", "block"]):
            nodes = table.column("node").to_pylist()
            group = _Group(table.column("elements").to_pylist())
            head = next((i for i, n in enumerate(nodes) if _short(n) == leader), 0)
            out = {k: [] for k in _FOUND.names}
            forest = _Forest(len(nodes))

            def tell(i, js, stray):
                for j in js:
                    if stray or forest.new(i, j):
                        for k, v in zip(_FOUND.names, (leader, block, nodes[i], nodes[j], stray)):
                            out[k].append(v)

            home = group.linked(head, percent)
            tell(head, np.flatnonzero(home), False)
            for i in np.flatnonzero(~home):
                tell(i, np.flatnonzero(group.linked(i, percent)), False)
                tell(i, [i], True)
            if out["a"]:
                yield pa.RecordBatch.from_pydict(out, schema=_FOUND)
    return run


def _across(percent: int):
    """Links of the strays of one block with the members of another."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (leader, block, other), table in sorted_groups(batches, ["leader", "block", "other"]):
            nodes = table.column("node").to_pylist()
            stray = table.column("stray").to_numpy(zero_copy_only=False)
            if stray.all() or not stray.any():
                continue
            group = _Group(table.column("elements").to_pylist())
            forest, out = _Forest(len(nodes)), {"a": [], "b": []}
            for i in np.flatnonzero(stray):
                for j in np.flatnonzero(group.linked(i, percent) & ~stray):
                    if forest.new(i, j):
                        out["a"].append(nodes[i])
                        out["b"].append(nodes[j])
            if out["a"]:
                yield pa.RecordBatch.from_pydict(out)
    return run


def _short(node: bytes) -> int:
    """The first eight bytes as the number that SQL makes of them."""
    return int.from_bytes(node[:8], "big", signed=True)


def _number() -> Column:
    return F.conv(F.hex(F.substring("node", 1, 8)), 16, -10).cast("long")


def _rid() -> Column:
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def _placed(docs: DataFrame, percent: int) -> DataFrame:
    """(doc_id, rid, n_shingles, root) for each row; root is null for a row without a word."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).withColumn("rid", _rid())
    seed = secrets.randbits(64)  # of this run: no text can be made to collide
    features = keep(rows.mapInArrow(_features(seed), "doc_id long, rid long, n_shingles long, "
                                               "node binary, bands array<long>"), "sketch")
    nodes = keep(features.filter(F.col("node").isNotNull()).groupBy("node").agg(
        F.min("rid").alias("rid"), F.first("bands").alias("bands"))
        .withColumn("number", _number()), "nodes")
    groups = keep(_groups(nodes), "groups")
    roots = components(_verified(rows, nodes, groups, percent, seed), "near")
    return features.select("doc_id", "rid", "n_shingles", "node").join(
        roots.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left").select(
        "doc_id", "rid", "n_shingles", F.coalesce("root", "node").alias("root"))


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of (doc_id, text, ...).

    Rows are linked where 100 * intersection >= ``percent`` * union. ``component_id`` is the
    smallest doc_id of the row's component; rows of equal sets are in one, whatever their ids. A
    null doc_id counts in the component but cannot name it: alone, its component is null and
    ``kept`` false. Rows without a word stand alone. Repeated rows come back as often as given.
    """
    placed = keep(_placed(docs, percent), "placed")
    least = placed.filter(F.col("root").isNotNull()).groupBy("root").agg(
        F.min("doc_id").alias("least")).withColumnRenamed("root", "r")
    named = placed.join(least, F.col("root") == F.col("r"), "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least"))
        .alias("component_id"))
    return named.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"),
                                               F.lit(False)))


def survivors(docs: DataFrame, percent: int = 85) -> DataFrame:
    """The rows of (doc_id, text, ...) less all but one of each component of near duplicates: the
    one of the smallest doc_id (null last). Rows without a word all stay."""
    placed = keep(_placed(docs, percent), "placed")
    best = placed.filter(F.col("root").isNotNull()).groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("m")) \
        .select(F.col("m.rid").alias("place"), F.lit(True).alias("alone"))
    bare = placed.filter(F.col("root").isNull()).select(F.col("rid").alias("place")).distinct() \
        .withColumn("alone", F.lit(False))
    rid = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = docs.withColumn("__rid", rid).join(best.unionByName(bare),
                                               F.col("__rid") == F.col("place"))
    # a row that is there twice in all respects has one row id: one of them stays
    return found.withColumn("__copy", F.when(F.col("alone"), F.lit(-1).cast("long")).otherwise(
        F.monotonically_increasing_id())).dropDuplicates(["__rid", "__copy"]).select(*docs.columns)


def _groups(nodes: DataFrame) -> DataFrame:
    """(leader, number): nodes whose buckets share a smallest node, the leader among them."""
    keys = nodes.select(F.explode("bands").alias("key"), "number")
    buckets = keys.groupBy("key").agg(F.min("number").alias("leader"),
                                      F.max("number").alias("top")) \
        .filter(F.col("leader") < F.col("top")).select("key", "leader")
    return keys.join(buckets, "key").select("leader", "number").distinct()


def _verified(rows: DataFrame, nodes: DataFrame, groups: DataFrame, percent: int,
              seed: int) -> DataFrame:
    sizes = groups.groupBy("leader").agg(F.count("*").alias("n")).select(
        "leader", F.ceil(F.col("n") / BLOCK).cast("long").alias("blocks"))
    listed = groups.join(sizes, "leader").groupBy("number").agg(
        F.collect_list(F.struct("leader", "blocks")).alias("groups"))
    wanted = nodes.select("node", "rid", "number").join(listed, "number").select(
        "rid", "node", "groups")
    # rows that are equal in all are read once: the join leaves them side by side
    texts = rows.select("rid", "text").join(wanted, "rid").dropDuplicates(["rid", "node"])
    sets = keep(texts.select("text", "node", "groups").mapInArrow(
        _sets(seed), "leader long, blocks long, node binary, elements binary"), "sets")
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    is_head = _number() == F.col("leader")
    dealt = sets.withColumn("block", F.explode(
        F.when(is_head, F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
        .otherwise(F.array(block)))).select("leader", "block", "node", "elements")
    found = keep(dealt.repartition("leader", "block").sortWithinPartitions("leader", "block")
                 .mapInArrow(_inside(percent),
                             "leader long, block long, a binary, b binary, stray boolean"), "links")
    edges = found.filter(~F.col("stray")).select("a", "b")
    strays = found.filter("stray").select("leader", "block", F.col("a").alias("node")).distinct()
    hot = sets.filter(F.col("blocks") > 1).withColumn("home", block)
    loners = hot.join(strays.select("leader", "node"), ["leader", "node"]).select(
        "leader", F.col("home").alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"),
        "node", "elements", F.lit(True).alias("stray")).filter(F.col("block") != F.col("other"))
    busy = strays.select("leader", "block").distinct()
    members = hot.select("leader", F.col("home").alias("other"), "node", "elements") \
        .join(busy, "leader").filter(F.col("block") != F.col("other")).select(
        "leader", "block", "other", "node", "elements", F.lit(False).alias("stray"))
    far = loners.unionByName(members).repartition("leader", "block", "other") \
        .sortWithinPartitions("leader", "block", "other") \
        .mapInArrow(_across(percent), "a binary, b binary")
    return edges.unionByName(far)
