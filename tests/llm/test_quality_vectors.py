import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tutela.llm import quality_rules as rules
from tutela.llm import resampling, vectors

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    words, seen, lines = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    grams = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    cover = {p for i in range(len(words) - 7) if grams[tuple(words[i:i + 8])] > 1
             for p in range(i, i + 8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), lines, len(cover))


def test_counts_against_brute_force():
    rng = random.Random(1)
    texts = ["".join(rng.choice(["a ", "é", "b\n", "b\n", "#", " ", "\t", "c d e f g h i j "])
                     for _ in range(rng.randrange(60))) for _ in range(300)]
    for bare in ([], [""], [None, ""]):  # chunks without a byte
        got = rules.count_statistics(pa.array(bare, pa.string()))
        assert all(got[c].tolist() == [0] * len(bare) for c in (*rules.BASE, "n_lines"))
    texts += ["", None, "\n", "x\n\nx", "x\nx", " \n \n", "a " * 40, "tail\n", "\ntail"]
    got = rules.count_statistics(pa.array(texts, pa.string()))
    assert list(zip(*(got[c].tolist() for c in rules.BASE))) == \
        [brute_counts(t or "") for t in texts]


def test_quantiles_of_the_chi_square_distribution():
    assert rules.chi2_quantile(4, 0.95) == pytest.approx(9.487729, abs=1e-5)
    assert rules.chi2_quantile(2, 0.5) == pytest.approx(1.386294, abs=1e-5)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200_000, rules.P))
    d = (x * x).sum(axis=1)
    inner = x[d <= np.quantile(d, rules.SHARE)]
    assert inner.var() * rules._consistency() == pytest.approx(1, abs=0.02)


def test_start_ignores_a_quarter_of_outliers():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(300, 4)), rng.normal(8, 0.1, (80, 4))])
    centre, scatter = rules.start(x, np.zeros(4))
    assert np.abs(centre).max() < 0.4 and np.diag(scatter).max() < 2


def prose(rng, n=80):
    return " ".join("".join(rng.choice("etaoinshr") for _ in range(rng.choice([2, 4, 5, 9])))
                    for _ in range(n)) + ".\n" + " ".join("of" for _ in range(2))


def test_outliers_go_and_ordinary_texts_stay(docs):
    rng = random.Random(3)
    good = [prose(rng) for _ in range(150)]
    bad = [" ".join(w + "***" for w in prose(rng).split()) for _ in range(20)]
    short, loop = ["too short"] * 3, ["one two three four five six seven eight " * 6]
    table = docs([*good, *bad, *short, *loop, None, ""]).withColumn("kept", F.lit("clash"))
    got = rules.judge(table).orderBy("doc_id").collect()
    kept = [r.kept for r in got]
    assert all(kept[:150]) and not any(kept[150:])
    assert [r.base_failed for r in got] == [False] * 170 + [True] * 6
    assert all(r.distance is None for r in got[170:]) and len(got) == 176


def test_small_groups_null_groups_and_repeated_rows(docs):
    rng = random.Random(4)
    few = docs([(None, prose(rng)), (1, "a"), (1, "a")], lang=None, source=None)
    got = rules.judge(few).collect()
    assert Counter((r.doc_id, r.kept) for r in got) == {(None, True): 1, (1, False): 2}
    many = docs([prose(rng) for _ in range(70)], lang=None)
    both = many.unionByName(few)
    assert rules.judge(both).filter("kept").count() == 71
    assert rules.judge(docs([])).collect() == []


def test_texts_are_judged_where_they_are_read(docs):
    rng = random.Random(8)
    table = docs([*[prose(rng) for _ in range(90)], "short", None]).withColumn(
        "rid", F.lit("own")).withColumn("counts", F.struct("lang"))
    got = rules.judge(table)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    rows = got.orderBy("doc_id").collect()
    assert [r.doc_id for r in rows] == list(range(92))
    assert all(r.rid == "own" and r.counts.lang == "en" for r in rows)
    assert [r.distance is None for r in rows] == [False] * 90 + [True] * 2
    few = rules.judge(table, carried=["doc_id"])
    assert few.columns == ["doc_id", *rules.BASE, "base_failed", "distance", "kept"]
    assert few.orderBy("doc_id").collect() == [
        tuple(r[c] for c in few.columns) for r in rows]


def lines(rng, n, words=9):
    return [" ".join(prose(rng, words).split()[:words]) for _ in range(n)]


def test_each_statistic_alone_makes_an_outlier(docs):
    """In a source where no text repeats a line or a word or holds a symbol."""
    rng = random.Random(5)
    good = ["\n".join(lines(rng, 20)) for _ in range(400)]
    own = lines(rng, 9)
    one_each = [
        "\n".join([*own, own[0], *own[:8], own[0], own[1]]),           # 11 of 20 lines again
        " ".join([*" ".join(lines(rng, 20)).split(), *"a b c d e f g h i j".split() * 3]),
        " ".join("".join(rng.choice("etaoin") for _ in range(25)) for _ in range(180)),
        "\n".join(lines(rng, 20)).replace(" ", " ## ")]
    got = rules.judge(docs([*good, *one_each])).orderBy("doc_id").collect()
    assert sum(not r.kept for r in got[:400]) <= 2
    counts = [(r.n_dup_lines, r.n_repeat_words > 0, r.n_symbols > 0) for r in got[400:]]
    assert counts[0][0] == 11 and counts[1:] == [(0, True, False), (0, False, False),
                                                 (0, False, True)]
    assert [r.base_failed for r in got[401:]] == [False] * 3
    assert not any(r.kept for r in got[400:])


def test_few_texts_are_judged_by_their_language_or_the_corpus(docs):
    rng = random.Random(6)
    marked = " ".join(w + "##" for w in prose(rng).split())
    large = docs([prose(rng) for _ in range(200)], source="large")
    few = docs([(1000 + i, prose(rng)) for i in range(9)] + [(1009, marked)], source="few")
    other = docs([(2000 + i, prose(rng)) for i in range(9)] + [(2009, marked)], lang="xx")
    got = {r.doc_id: r.kept for r in rules.judge(large.unionByName(few).unionByName(other))
           .collect()}
    assert {i for i, kept in got.items() if not kept and i >= 1000} == {1009, 2009}
    alone = rules.judge(few.unionByName(other)).collect()  # no language has enough texts
    assert {r.doc_id for r in alone if not r.kept} == {1009, 2009}


def brute_verdict(x, sample):
    """The estimates of one group in numpy: the same start, then whole-row concentration."""
    n, usual = len(x), [0.0]
    spread = [rules.LENGTH_SHARE ** 2 * x[:, 0].var()]
    for i in range(1, 4):
        some = np.sort(np.floor(np.log2(x[x[:, i] > 0, i]) * rules.BINS))
        usual = 2.0 ** ((some[int(np.ceil(len(some) / 2)) - 1] + 0.5) / rules.BINS) \
            if len(some) else 0.0
        spread.append(min(usual ** 2, rules.RARE * (x[:, i] ** 2).mean()))
    spread = np.maximum(spread, 1e-8)

    def far(c, s):
        d = x - c
        return (d @ np.linalg.inv(s) * d).sum(axis=1)
    c, s = rules.start(x[sample], spread)
    for _ in range(rules.STEPS):
        bins = np.floor(np.log2(np.maximum(far(c, s), 1e-9)) * 16)
        order = np.unique(bins)
        before = np.array([(bins < b).sum() for b in order])
        near = x[np.isin(bins, order[before < rules.SHARE * n])]
        c, s = near.mean(axis=0), np.cov(near.T, bias=True) * rules._consistency() \
            + np.diag(spread)
    near = x[far(c, s) <= rules.chi2_quantile(4, 0.975)]
    c, s = near.mean(axis=0), np.cov(near.T, bias=True) + np.diag(spread)
    return far(c, s)


def test_distances_of_one_group_against_numpy(docs):
    rng = random.Random(7)
    texts = []
    for i in range(300):
        part = lines(rng, 12)
        if i % 4 == 0:
            part[3] = part[2]
        if i % 5 == 0:
            part[5] = part[5].replace(" ", " # ", 1 + i % 7)
        if i % 25 == 0:
            part = [w.replace(" ", " ### ") for w in part]
        texts.append("\n".join(part))
    got = rules.judge(docs(texts)).orderBy("doc_id").collect()
    fair = [r for r in got if not r.base_failed]
    x = np.array([[np.log(max(r.word_chars, 1) / max(r.n_words, 1)),
                   np.sqrt(r.n_symbols / max(r.word_chars, 1)), np.sqrt(r.n_dup_lines / 12),
                   np.sqrt(r.n_repeat_words / r.n_words)] for r in fair])
    # below SAMPLE rows all are in the sample; the start sorts them by their hashed ids
    want = brute_verdict(x, np.arange(len(x)))
    distance = np.array([r.distance for r in fair])
    limit = rules.chi2_quantile(4, rules.CUT)
    assert (want > limit).tolist() == [not r.kept for r in fair]
    assert 5 <= (want > limit).sum() <= 20
    assert distance == pytest.approx(want, rel=0.25)


# -------------------------------------------------------------------- vectors --
def brute_links(rows):
    out = {}
    for i, v, label in rows:
        out[i] = set()
        for j, w, other in rows:
            if i != j and label is not None and label == other and ok(v) and ok(w) \
                    and len(v) == len(w):
                a, b = np.array(v, float), np.array(w, float)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= vectors.THRESHOLD:
                    out[i].add(j)
    return out


def ok(v):
    return v is not None and len(v) > 0 and all(x is not None for x in v) \
        and np.isfinite(np.array(v, float)).all() and any(v)


def expected(rows):
    links = brute_links(rows)
    out = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        out[i] = (len(links[i]), min(seen))
    return out


SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("shard", [vectors.SHARD_VALUES, 480])
def test_links_and_components_against_brute_force(spark, shard):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(240):
        v = rng.normal(size=12)
        if i % 3 == 1:
            v = np.array(rows[-1][1]) + rng.normal(size=12) * 0.08
        elif i % 10 == 2:
            v = np.array(rows[0][1]) * 2
        rows.append((i, [float(np.float32(x)) for x in v], int(i % 2) if i % 7 else 0))
    rows += [(300, rows[0][1], None), (301, None, 1), (302, [], 1), (303, [0.0] * 12, 1),
             (304, [float("nan")] + [1.0] * 11, 1), (305, [None] + [1.0] * 11, 1),
             (306, [float("inf")] * 12, 1), (307, rows[0][1][:5], 0), (308, rows[0][1], 0)]
    table = spark.createDataFrame(rows, SCHEMA).withColumn("n_links", F.lit("clash"))
    got = {r.vec_id: (r.n_links, r.component_id)
           for r in vectors.near_vectors(table, shard_values=shard).collect()}
    assert got == expected(rows)


def test_vectors_without_id_and_empty_tables(spark):
    table = spark.createDataFrame([(None, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (4, [1.0, 0.0], 1),
                                   (None, None, 1)], SCHEMA)
    got = Counter(tuple(r) for r in vectors.near_vectors(table).collect())
    assert got == {(None, 2, 4, False): 1, (4, 2, 4, True): 2, (None, 0, None, False): 1}
    assert vectors.near_vectors(table.limit(0)).collect() == []


def test_narrow_beams_are_widened_until_the_audit_passes():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(600, 24))
    x[300:] = x[:300] + rng.normal(size=(300, 24)) * 0.02
    x /= np.linalg.norm(x, axis=1)[:, None]
    graph, true = vectors.Graph(x, neighbours=3, beam=3), (x @ x.T >= 0.98).sum()
    beam = vectors.audited_beam(graph, x, 0.98, beam=1, audit=600, recall=0.8)
    assert beam > 1
    assert sum(len(graph.above(q, 0.98 - 1e-5, beam)) for q in x) >= 0.8 * true
    # too few neighbours: parts of the graph cannot be reached, so the task will scan
    torn = vectors.Graph(x, neighbours=2, beam=1)
    assert vectors.audited_beam(torn, x, 0.98, beam=1, audit=600, recall=0.999) is None


def shard_rows(x, nodes, copies=None):
    return pa.RecordBatch.from_pydict({
        "label": [1] * len(x), "dims": [x.shape[1]] * len(x), "shard": [0] * len(x),
        "node": nodes, "unit": [v.tobytes() for v in x],
        "copies": pa.array([1] * len(x) if copies is None else copies, pa.int64())})


def searched(x, nodes, shard, threshold=0.98):
    """Counts and links of the queries x in a shard that ``_build`` has made."""
    row = shard.to_pylist()[0]
    first = pa.RecordBatch.from_pylist([row | {"lane": 0, "block": -1, "node": None}])
    queries = pa.RecordBatch.from_pylist([
        dict.fromkeys(row) | {"label": 1, "dims": x.shape[1], "shard": 0, "lane": 0, "block": 0,
                              "node": n, "unit": v.tobytes()} for n, v in zip(nodes, x)],
        schema=first.schema.set(first.schema.get_field_index("node"), pa.field("node", pa.binary())))
    found = [r for out in vectors._search(threshold)(iter([first, queries])) for r in out.to_pylist()]
    return ({r["a"]: r["n"] for r in found if r["b"] is None},
            [(r["a"], r["b"]) for r in found if r["b"] is not None])


def groups(pairs):
    forest = vectors._Forest()
    for a, b in pairs:
        forest.new(a, b)
    return {n: forest.root(n) for n in list(forest.parent)}


def alike(one, other):
    return {frozenset(n for n, r in one.items() if r == x) for x in one.values()} == \
        {frozenset(n for n, r in other.items() if r == x) for x in other.values()}


def crowd(n=3000, dims=16, seed=12):
    """Points with pairs, and one group of many near copies."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims))
    x[n - 200:n - 100] = x[:100] + rng.normal(size=(100, dims)) * 0.02
    x[n - 100:] = x[0] + rng.normal(size=(100, dims)) * 0.01
    return x / np.linalg.norm(x, axis=1)[:, None], [b"%016d" % i for i in range(n)]


@pytest.mark.parametrize("broken", [False, True])
def test_a_graph_is_built_once_audited_and_loses_no_link(monkeypatch, broken):
    x, nodes = crowd()
    built = []
    plain = vectors.Graph.__init__
    monkeypatch.setattr(vectors.Graph, "__init__",
                        lambda self, p, *a, **k: (built.append(len(p)), plain(self, p, *a, **k))[1])
    if broken:  # finds nothing but the query's own point: only an audit can notice
        monkeypatch.setattr(vectors.Graph, "above", lambda self, q, t, beam, own=-1: np.flatnonzero(
            self.points @ q.astype(np.float32) > 0.99999).tolist())
    shard, = vectors._build(0.98)(iter([shard_rows(x, nodes)]))
    assert built == [3000] and (shard.column("beam")[0].as_py() == 0) == broken
    counts, edges = searched(x, nodes, shard)
    near = x @ x.T >= 0.98
    true = {nodes[i]: int(near[i].sum()) - 1 for i in range(len(x)) if near[i].sum() > 1}
    assert sum(counts.values()) >= (1 if broken else 0.99) * sum(true.values())
    assert all(n <= true[a] for a, n in counts.items())
    assert len(edges) < len(true)  # no more than connect them, though there are 5,000 links
    assert alike(groups(edges), groups((nodes[i], nodes[j]) for i, j in np.argwhere(near) if i < j))
    assert built == [3000]


def test_graphs_come_back_from_bytes_as_they_were():
    x, _ = crowd(600)
    graph = vectors.Graph(x)
    again = vectors.Graph.load(graph.dump(), x)
    assert again.entry == graph.entry and len(again.links) == len(graph.links)
    for a, b in zip(graph.links, again.links):
        assert a.keys() == b.keys() and all((a[k] == b[k]).all() for k in a)
    for q in x[:50]:
        assert sorted(again.above(q, 0.98, 32)) == sorted(graph.above(q, 0.98, 32))
    queries, own = vectors.evidence(x, 0.98)
    worth = (x @ queries.T).max(axis=0)
    assert len(queries) == 2 * vectors.AUDIT and (worth >= 0.98).all() and (own[48:] == -1).all()


def test_graphs_at_the_supplied_width_through_the_operator(spark):
    """64 dimensions and a label of 2,500: graphs, not scans, with the recall of brute force."""
    rng = np.random.default_rng(15)
    x = rng.normal(size=(2500, 64))
    x[2000:] = x[:500] + rng.normal(size=(500, 64)) * rng.choice([0.05, 0.15, 0.19], (500, 1))
    x = x.astype(np.float32)
    table = spark.createDataFrame([(i, v.tolist(), 3) for i, v in enumerate(x)], SCHEMA)
    found = {r.vec_id: r for r in vectors.near_vectors(table).collect()}
    units = x.astype(float)
    units /= np.linalg.norm(units, axis=1)[:, None]
    near = units @ units.T >= vectors.THRESHOLD
    true = near.sum(axis=1) - 1
    mine = np.array([found[i].n_links for i in range(2500)])
    assert 250 < true.sum() and (mine <= true).all() and mine.sum() >= 0.99 * true.sum()
    points = spark.createDataFrame(
        [(b"%016d" % i, v.tobytes(), 1, 3, 64, 1) for i, v in enumerate(units)],
        "node binary, unit binary, copies long, label long, dims long, shards long")
    shards = vectors.shards_of(points, vectors.THRESHOLD).select("beam", "graph").collect()
    assert len(shards) == 1 and all(r.beam > 0 and len(r.graph) > 1000 for r in shards)


def test_own_points_and_samples_without_a_link_are_no_evidence():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(600, 24))
    x[590:] = x[:10] + rng.normal(size=(10, 24)) * 0.005
    x /= np.linalg.norm(x, axis=1)[:, None]
    graph, own = vectors.Graph(x), np.arange(600)
    assert vectors.audited_beam(graph, x[10:500], 0.98, 32, 48, 0.99, 3, own[10:500]) is None
    elsewhere = rng.normal(size=(48, 24))
    elsewhere /= np.linalg.norm(elsewhere, axis=1)[:, None]
    assert vectors.audited_beam(graph, elsewhere, 0.98) is None
    assert vectors.audited_beam(graph, x[:10], 0.98, 32, 48, 0.99, 3, own[:10]) is not None


# ----------------------------------------------------------------- resampling --
def test_k_th_largest_is_exact(spark):
    rng = random.Random(7)
    for low in (-10 ** 15, 0):
        values = [low + rng.randrange(10 ** rng.choice([1, 6, 15])) for _ in range(500)]
        df = spark.createDataFrame([(v,) for v in values], "v long")
        for k in (1, 7, 250, 500, 900):
            assert resampling.largest(df, "v", k) == sorted(values, reverse=True)[min(k, 500) - 1]
    assert resampling.largest(df.limit(0), "v", 3) is None
    assert resampling.largest(df, "v", 0) is None


def test_noise_is_gumbel_and_depends_on_the_row_alone():
    noise = resampling.gumbel(np.arange(100_000))
    assert noise.mean() == pytest.approx(0.5772, abs=0.02)
    assert noise.std() == pytest.approx(1.2825, abs=0.02)
    assert (resampling.gumbel(np.arange(100_000)[::-1])[::-1] == noise).all()


def test_texts_like_the_target_are_drawn(spark, docs):
    rng = random.Random(8)
    good = [" ".join(rng.choice(["sun", "moon", "star", "sky"]) for _ in range(30))
            for _ in range(120)]
    bad = [" ".join(rng.choice(["buy", "now", "win", "$$$"]) for _ in range(30))
           for _ in range(60)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(130, 0, 0), (131, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    table = docs([*good, *bad])
    got = resampling.resample(table, labels, share=0.6).collect()
    assert sum(r.kept for r in got) == 108
    assert sum(r.kept for r in got if r.doc_id >= 120) <= 2  # held out: 80 good, 60 bad
    bare = resampling.resample(docs([(None, None), (1, ""), (1, "x"), (1, "x")]),
                               labels.limit(0), share=0.5).collect()
    assert all(r.log_weight == 0 for r in bare) and sum(r.kept for r in bare) >= 2
    assert resampling.resample(docs([]), labels).collect() == []
