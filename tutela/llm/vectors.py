"""Near duplicates of vectors: navigable small-world graphs per shard, audited, and components.

Vectors are compared within their label only. Equal vectors of a label are one point, counted once
for each copy. Points of a label are dealt to shards of ``SHARD_VALUES`` numbers at most. Over each
shard of ``GRAPH_POINTS`` points or more a hierarchical navigable small-world graph is built once,
audited, and written to the shared folder; every point of the label is then sent to every shard of
it in blocks, and a search returns all points above the threshold that it can reach.

An audit asks for the links of points of the shard, and of vectors turned away from such points by
angles up to the threshold's, which have links whether or not the data hold any. A query's own
point is no link. The beam is widened until ``RECALL`` of these links are found, both of all and of
the mean query's. Where even a beam as wide as the shard misses more, which a graph in several parts
can cause, and in shards of fewer points, where a product of matrices costs less than a graph, the
shard is scanned, so links there are exact.

A task tells how many links each query has in its shard and enough of them to connect what is
connected: no more rows than queries and points, however many links a group of near copies has.
"""

from __future__ import annotations

import hashlib
import heapq
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tutela.llm.graph import components
from tutela.llm.minhash import sorted_groups
from tutela.session import keep

THRESHOLD = 0.98
SHARD_VALUES = 1 << 22  # numbers of a shard, 32 MB
GRAPH_POINTS = 256
BLOCK = 8192           # queries that are sent through a shard side by side
LANES = 4              # tasks that share the blocks of a shard; each gets a copy of its graph
NEIGHBOURS = 12
BUILD_BEAM = 40
BEAM = 16
AUDIT = 48             # points, and as many vectors near points, that an audit asks about
SCAN = 512             # queries that a scan compares with the shard at a time
RECALL = 0.99


class Graph:
    """A hierarchical navigable small-world graph over unit vectors."""

    def __init__(self, points: np.ndarray, neighbours: int = NEIGHBOURS,
                 beam: int = BUILD_BEAM, seed: int = 5):
        self.points = points.astype(np.float32)
        n = len(points)
        rng = np.random.default_rng(seed)
        levels = (-np.log(1 - rng.random(n)) / np.log(neighbours)).astype(int)
        self.wide = 2 * neighbours
        self.links: list[dict[int, np.ndarray]] = []
        self.mark = np.zeros(n, np.int64)
        self.turn = 0
        self.entry = 0
        for i in range(n):
            self._insert(i, int(levels[i]), neighbours, beam)

    def _nearest(self, q: np.ndarray, entries: list[tuple[float, int]], level: int, beam: int,
                 threshold: float = 2.0) -> list[tuple[float, int]]:
        """The best ``beam`` points found, and all above the threshold, best first."""
        self.turn += 1
        mark, links, points = self.mark, self.links[level], self.points
        for _, i in entries:
            mark[i] = self.turn
        frontier = [(-s, i) for s, i in entries]
        heapq.heapify(frontier)
        found = list(entries)
        heapq.heapify(found)
        above = [(s, i) for s, i in entries if s >= threshold]
        while frontier:
            s, i = heapq.heappop(frontier)
            if len(found) >= beam and -s < found[0][0] and -s < threshold:
                break
            near = links.get(i)
            if near is None:
                continue
            near = near[mark[near] != self.turn]
            if not len(near):
                continue
            mark[near] = self.turn
            worth = points[near] @ q
            least = found[0][0] if len(found) >= beam else -2.0
            good = worth > min(least, threshold)
            for s, j in zip(worth[good].tolist(), near[good].tolist()):
                if len(found) < beam or s > found[0][0]:
                    heapq.heappush(frontier, (-s, j))
                    heapq.heappush(found, (s, j))
                    if len(found) > beam:
                        heapq.heappop(found)
                elif s >= threshold:
                    heapq.heappush(frontier, (-s, j))
                if s >= threshold:
                    above.append((s, j))
        return sorted(found, reverse=True) if threshold > 1 else above

    def _descend(self, q: np.ndarray, to: int) -> list[tuple[float, int]]:
        at = [(float(self.points[self.entry] @ q), self.entry)]
        for level in range(len(self.links) - 1, to, -1):
            at = self._nearest(q, at, level, 1)[:1]
        return at

    def _choose(self, found: list[tuple[float, int]], most: int) -> np.ndarray:
        """Neighbours in different directions first: none nearer to one chosen than to the point."""
        chosen: list[int] = []
        left: list[int] = []
        for s, j in found:
            if len(chosen) >= most:
                break
            if not chosen or (self.points[chosen] @ self.points[j] <= s).all():
                chosen.append(j)
            else:
                left.append(j)
        return np.array(chosen + left[:most - len(chosen)], np.int64)

    def _insert(self, i: int, level: int, neighbours: int, beam: int) -> None:
        if not self.links:
            self.links = [{i: np.zeros(0, np.int64)} for _ in range(level + 1)]
            return
        q = self.points[i]
        at = self._descend(q, level)
        for lv in range(min(level, len(self.links) - 1), -1, -1):
            at = self._nearest(q, at, lv, beam)
            most = self.wide if lv == 0 else neighbours
            mine = self._choose(at, neighbours)
            links = self.links[lv]
            links[i] = mine
            for j in mine.tolist():
                near = np.append(links[j], i)
                if len(near) > most + neighbours:  # some at a time: choosing is the dear part
                    worth = self.points[near] @ self.points[j]
                    order = np.argsort(-worth, kind="stable")
                    near = self._choose([(float(worth[k]), int(near[k])) for k in order], most)
                links[j] = near
        for _ in range(len(self.links), level + 1):
            self.links.append({i: np.zeros(0, np.int64)})
            self.entry = i

    def dump(self) -> bytes:
        """Levels, entry and links; the points are kept apart."""
        parts = {"entry": np.array([self.entry])}
        for lv, links in enumerate(self.links):
            parts[f"at{lv}"] = np.fromiter(links, np.int32, len(links))
            parts[f"size{lv}"] = np.fromiter(map(len, links.values()), np.int32, len(links))
            parts[f"to{lv}"] = np.concatenate(list(links.values())).astype(np.int32)
        out = io.BytesIO()
        np.savez(out, **parts)
        return out.getvalue()

    @classmethod
    def load(cls, raw: bytes, points: np.ndarray) -> Graph:
        self = cls.__new__(cls)
        self.points = points.astype(np.float32)
        self.mark, self.turn = np.zeros(len(points), np.int64), 0
        with np.load(io.BytesIO(raw)) as parts:
            self.entry, self.links = int(parts["entry"][0]), []
            for lv in range((len(parts.files) - 1) // 3):
                near = np.split(parts[f"to{lv}"].astype(np.int64),
                                np.cumsum(parts[f"size{lv}"])[:-1])
                self.links.append(dict(zip(parts[f"at{lv}"].tolist(), near)))
        return self

    def above(self, q: np.ndarray, threshold: float, beam: int, own: int = -1) -> list[int]:
        """Points found with a cosine of about ``threshold`` or more. A query that is a point of the
        graph sets out from its ``own`` place too, among its near copies."""
        q = q.astype(np.float32)
        entries = self._descend(q, 0)
        if own >= 0 and entries[0][1] != own:
            entries.append((float(self.points[own] @ q), own))
        return [j for _, j in self._nearest(q, entries, 0, beam, threshold)]


def audited_beam(graph: Graph, queries: np.ndarray, threshold: float, beam: int = BEAM,
                 audit: int = AUDIT, recall: float = RECALL, seed: int = 3,
                 own: np.ndarray | None = None) -> int | None:
    """The first beam, of doubled ones, that finds ``recall`` of the links of sampled queries and of
    the mean query with a link; None if none does, or no sampled query has a link. ``own`` is each
    query's own place among the points (-1: elsewhere), which is no link."""
    rng = np.random.default_rng(seed)
    some = rng.permutation(len(queries))[:audit]
    true = [set(np.flatnonzero(graph.points.astype(float) @ queries[i] >= threshold).tolist())
            - ({int(own[i])} if own is not None else set()) for i in some]
    asked = [(t, queries[i], -1 if own is None else int(own[i])) for t, i in zip(true, some) if t]
    wanted = sum(len(t) for t, _, _ in asked)
    while wanted and beam < 2 * len(graph.points):
        got = [len(t & set(graph.above(q, threshold - 1e-5, beam, at))) for t, q, at in asked]
        shares = [g / len(t) for g, (t, _, _) in zip(got, asked)]
        if sum(got) >= recall * wanted and sum(shares) >= recall * len(asked):
            return beam
        beam *= 2
    return None


def evidence(points: np.ndarray, threshold: float, audit: int = AUDIT, seed: int = 7) \
        -> tuple[np.ndarray, np.ndarray]:
    """Queries of an audit, and each one's own place (-1: none): points, and vectors at an angle to
    points whose cosine lies between the threshold and 1."""
    rng = np.random.default_rng(seed)
    some = rng.choice(len(points), min(audit, len(points)), replace=False)
    base = points[some]
    away = rng.normal(size=base.shape)
    away -= (away * base).sum(axis=1)[:, None] * base
    size = np.linalg.norm(away, axis=1)[:, None]
    away = np.divide(away, size, out=np.zeros_like(away), where=size > 0)
    cosine = rng.uniform(min(threshold + 1e-6, 1.0), 1.0, len(some))[:, None]
    near = cosine * base + np.sqrt(1 - cosine * cosine) * away
    near /= np.linalg.norm(near, axis=1)[:, None]
    return np.concatenate([base, near]), np.concatenate([some, np.full(len(some), -1)])


def _scanned(points: np.ndarray, single: np.ndarray, queries: np.ndarray, threshold: float) \
        -> list[np.ndarray]:
    """Places of all points with a cosine of ``threshold`` or more to each query; candidates in
    single precision are compared in double precision."""
    near = queries.astype(np.float32) @ single.T >= threshold - 1e-5
    return [at[points[at] @ q >= threshold] for at, q in zip(map(np.flatnonzero, near), queries)]


_POINTS = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("node", pa.binary()),
                     ("unit", pa.binary())])


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Node and unit vector of each row that can have links; nulls otherwise."""
    for batch in batches:
        out = {"vec_id": batch.column("vec_id"), "label": batch.column("label"), "node": [],
               "unit": []}
        lists = batch.column("embedding")
        flat = lists.flatten()
        whole = flat.to_numpy(zero_copy_only=False).astype(float)  # null components become nan
        ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy())
        begins = ends - lists.value_lengths().fill_null(0).to_numpy()
        valid = lists.is_valid().to_numpy(zero_copy_only=False) \
            & batch.column("label").is_valid().to_numpy(zero_copy_only=False)
        for a, b, ok, label in zip(begins, ends, valid, out["label"].to_pylist()):
            v = whole[a:b]
            size = np.sqrt((v * v).sum()) if ok and b > a and np.isfinite(v).all() else 0.0
            if size > 0 and not np.isfinite(size) or 0 < size < 1e-150:  # out of range: scale first
                v = v / np.abs(v).max()
                size = np.sqrt((v * v).sum())
            if size > 0:
                out["node"].append(hashlib.blake2b(f"{label}|".encode() + (v + 0.0).tobytes(),
                                                   digest_size=16).digest())
                out["unit"].append((v / size).tobytes())
            else:
                out["node"].append(None)
                out["unit"].append(None)
        yield pa.RecordBatch.from_pydict(out, schema=_POINTS)


_SHARD = pa.schema([("label", pa.int64()), ("dims", pa.int64()), ("shard", pa.int64()),
                    ("names", pa.binary()), ("unit", pa.binary()), ("counts", pa.binary()),
                    ("graph", pa.binary()), ("beam", pa.int64())])


def _build(threshold: float):
    """One row for each shard: its points and, if it has enough of them, its graph and the beam that
    passed the audit (0: to be scanned)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (label, dims, shard), table in sorted_groups(batches, ["label", "dims", "shard"]):
            unit = b"".join(table.column("unit").to_pylist())
            points = np.frombuffer(unit, float).reshape(table.num_rows, -1)
            graph, beam = b"", 0
            if table.num_rows >= GRAPH_POINTS:
                built = Graph(points)
                queries, own = evidence(points, threshold)
                beam = audited_beam(built, queries, threshold, BEAM, len(queries), RECALL, 3,
                                    own) or 0
                graph = built.dump() if beam else b""
            yield pa.RecordBatch.from_pydict({
                "label": [int(label)], "dims": [int(dims)], "shard": [int(shard)],
                "names": [b"".join(table.column("node").to_pylist())], "unit": [unit],
                "counts": [table.column("copies").to_numpy().astype("<i8").tobytes()],
                "graph": [graph], "beam": [beam]}, schema=_SHARD)
    return run


class _Shard:
    """A shard as ``_build`` wrote it."""

    def __init__(self, row: dict):
        self.exact = np.frombuffer(row["unit"], float).reshape(-1, row["dims"])
        width = len(row["names"]) // max(len(self.exact), 1)
        self.names = [row["names"][i:i + width] for i in range(0, len(row["names"]), width)]
        self.place = {name: i for i, name in enumerate(self.names)}
        self.copies = np.frombuffer(row["counts"], "<i8")
        self.single, self.beam = self.exact.astype(np.float32), row["beam"]
        self.graph = Graph.load(row["graph"], self.exact) if self.beam else None

    def hits(self, queries: np.ndarray, own: np.ndarray, threshold: float) \
            -> Iterator[np.ndarray]:
        """Places of each query's points with a cosine of ``threshold`` or more; ``own`` is the
        query's place here (-1: elsewhere)."""
        for at in range(0, len(queries), SCAN):
            part = queries[at:at + SCAN]
            if self.graph is None:
                yield from _scanned(self.exact, self.single, part, threshold)
                continue
            for q, mine in zip(part, own[at:at + SCAN].tolist()):
                found = np.array(self.graph.above(q, threshold - 1e-5, self.beam, mine), np.int64)
                yield found[self.exact[found] @ q >= threshold]


class _Forest:
    """Links that connect something new, among those told one after the other."""

    def __init__(self):
        self.parent: dict[bytes, bytes] = {}

    def root(self, node: bytes) -> bytes:
        parent = self.parent
        while (up := parent.setdefault(node, node)) != node:
            parent[node] = node = parent.setdefault(up, up)
        return node

    def new(self, a: bytes, b: bytes) -> bool:
        a, b = self.root(a), self.root(b)
        self.parent[b] = a
        return a != b


_FOUND = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("n", pa.int64())])


def _search(threshold: float):
    """Of each query of a block its number of linked rows in the shard (b is null), and links that
    connect all that are linked there (n is null)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, shard, forest = None, None, None
        for (*place, block), table in sorted_groups(
                batches, ["label", "dims", "shard", "lane", "block"]):
            if block < 0:
                last, shard, forest = place, _Shard(table.to_pylist()[0]), _Forest()
                continue
            if last != place:
                continue  # a shard without a point
            nodes = table.column("node").to_pylist()
            queries = np.frombuffer(b"".join(table.column("unit").to_pylist()), float) \
                .reshape(len(nodes), -1)
            own = np.array([shard.place.get(node, -1) for node in nodes], np.int64)
            out: dict[str, list] = {"a": [], "b": [], "n": []}
            for node, mine, found in zip(nodes, own, shard.hits(queries, own, threshold)):
                found = found[found != mine]
                if not len(found):
                    continue
                edges = [shard.names[j] for j in found.tolist()
                         if forest.new(node, shard.names[j])]
                out["a"] += [node] * (len(edges) + 1)
                out["b"] += [None, *edges]
                out["n"] += [int(shard.copies[found].sum()), *[None] * len(edges)]
            yield pa.RecordBatch.from_pydict(out, schema=_FOUND)
    return run


def shards_of(points: DataFrame, threshold: float, shard_values: int = SHARD_VALUES) -> DataFrame:
    """The shards of points (node, unit, copies, label, dims, shards, ...), written with their audited
    graphs: (label, dims, shard, names, unit, counts, graph, beam)."""
    home = F.pmod(F.xxhash64("node"), F.col("shards")).alias("shard")
    rows = points.select("label", "dims", home, "node", "unit", "copies")
    key = ["label", "dims", "shard"]
    return keep(rows.repartition(*key).sortWithinPartitions(*key, "node").mapInArrow(
        _build(threshold), "label long, dims long, shard long, names binary, unit binary, "
                           "counts binary, graph binary, beam long"), "shards")


def near_vectors(rows: DataFrame, threshold: float = THRESHOLD,
                 shard_values: int = SHARD_VALUES) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of (vec_id, embedding, label, ...).

    Links join rows of one label and dimension with a cosine of ``threshold`` or more in double
    precision. A row with a null label, or a vector that is null, empty, zero or has a null or
    non-finite component, has none. A null vec_id counts as a link of others and cannot name a
    component. Repeated rows are rows of their own; an empty table gives none; other columns are
    not read. ``n_links`` counts what a vector's own searches find: all of it where shards are
    scanned, ``RECALL`` of it by the audits elsewhere.
    """
    picked = rows.select(F.col("vec_id").cast("long").alias("vec_id"),
                         F.col("label").cast("long").alias("label"),
                         F.col("embedding").cast("array<double>").alias("embedding"))
    units = keep(picked.mapInArrow(_units, "vec_id long, label long, node binary, unit binary"),
                 "units")
    points = keep(units.filter(F.col("node").isNotNull()).groupBy("node").agg(
        F.min("label").alias("label"), F.min("unit").alias("unit"), F.count("*").alias("copies"),
        F.min("vec_id").alias("least"), (F.length(F.min("unit")) / 8).cast("long").alias("dims")),
        "points")
    counts = points.groupBy("label", "dims").agg(F.count("*").alias("n")).select(
        "label", "dims", F.ceil(F.col("n") * F.col("dims") / shard_values).cast("long")
        .alias("shards"), F.ceil(F.col("n") / BLOCK).cast("long").alias("blocks"))
    own = points.join(counts, ["label", "dims"])
    shards = shards_of(own, threshold, shard_values)
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("binary")
    lanes = F.least(F.col("blocks"), F.lit(LANES))
    members = shards.join(counts.select("label", "dims", "blocks"), ["label", "dims"]).select(
        "label", "dims", "shard", F.explode(F.sequence(zero, lanes - 1)).alias("lane"),
        F.lit(-1).cast("long").alias("block"), none.alias("node"), "unit", "names", "counts",
        "graph", "beam")
    block = F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks"))
    queries = own.select(
        "label", "dims", F.explode(F.sequence(zero, F.col("shards") - 1)).alias("shard"),
        F.pmod(block, lanes).alias("lane"), block.alias("block"), "node", "unit",
        none.alias("names"), none.alias("counts"), none.alias("graph"), zero.alias("beam"))
    key = ["label", "dims", "shard", "lane"]
    found = keep(members.unionByName(queries).repartition(*key).sortWithinPartitions(*key, "block")
                 .mapInArrow(_search(threshold), "a binary, b binary, n long"), "links")
    edges = found.filter(F.col("b").isNotNull()).select("a", "b")
    roots = components(edges, "vectors")
    linked = found.filter(F.col("b").isNull()).groupBy("a").agg(F.sum("n").alias("others"))
    placed = points.select("node", "copies", "least").join(
        roots.select(F.col("node").alias("n"), "root"), F.col("node") == F.col("n"), "left").join(
        linked, F.col("node") == F.col("a"), "left").select(
        "node", "least", F.coalesce("root", "node").alias("root"),
        (F.coalesce("others", zero) + F.col("copies") - 1).alias("n_links"))
    names = placed.groupBy("root").agg(F.min("least").alias("component")) \
        .withColumnRenamed("root", "r")
    named = placed.join(names, F.col("root") == F.col("r")).select(
        F.col("node").alias("m"), "n_links", "component")
    return units.select("vec_id", "node").join(named, F.col("node") == F.col("m"), "left").select(
        "vec_id", F.coalesce("n_links", zero).alias("n_links"),
        F.when(F.col("m").isNull(), F.col("vec_id")).otherwise(F.col("component"))
        .alias("component_id"), _kept().alias("kept"))


def _kept() -> Column:
    return F.coalesce(F.when(F.col("m").isNull(), F.col("vec_id").isNotNull())
                      .otherwise(F.col("vec_id") == F.col("component")), F.lit(False))
