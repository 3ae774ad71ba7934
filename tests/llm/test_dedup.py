import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tutela.llm import minhash, substring
from tutela.llm.graph import components
from tutela.llm.words import gram_hashes, mix

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_removed(texts, size):
    words = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i:i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for w in words:
        gone = {p for i in range(len(w) - size + 1) if seen[tuple(w[i:i + size])] > 1
                for p in range(i, i + size)}
        out.append((len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(25)]
    texts = []
    for i in range(n):
        own = [rng.choice(vocabulary) for _ in range(rng.randrange(60))]
        if i % 3 == 0:
            own[5:5] = passage[rng.randrange(5):]
        texts.append(rng.choice([" ", "\n", "  "]).join(own))
    return texts + [texts[0], texts[0], None, "", "a " * 200, "b", "a " * 50]


def test_removed_words_against_brute_force(docs):
    for seed, bucket, size, gram in ((1, 400, 9, 3), (2, 1 << 20, 9, 1), (3, 2000, 35, 3)):
        texts = corpus(seed)
        got = substring.remove_repeats(docs(texts), size, gram, bucket).orderBy("doc_id").collect()
        assert [(r.n_words, r.n_removed, r.kept_text) for r in got] == brute_removed(texts, size)


def test_frequent_minimisers_are_split_without_changing_the_result(docs, monkeypatch):
    monkeypatch.setattr(substring, "SAMPLE_ONE_IN", 1)
    monkeypatch.setattr(substring, "HEAVY_SHARE", 1e-9)
    texts = corpus(5)
    found = []
    real = substring._heavy
    monkeypatch.setattr(substring, "_heavy",
                        lambda *a: found.append(real(*a)) or found[-1])
    got = substring.remove_repeats(docs(texts), 9, 3, 500).orderBy("doc_id").collect()
    assert len(found[0]) > 0
    assert [(r.n_words, r.n_removed, r.kept_text) for r in got] == brute_removed(texts, 9)


def test_rows_that_repeat_null_ids_and_clashing_columns(docs):
    text = " ".join(f"x{i}" for i in range(12))
    table = docs([(1, text), (1, text), (None, "y " * 12), (2, "z")]).withColumn(
        "n_words", F.lit("clash"))
    got = substring.remove_repeats(table, 9, 3).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed) for r in got) == {
        (1, 12, 12): 2, (None, 12, 12): 1, (2, 1, 0): 1}
    assert substring.remove_repeats(docs([])).collect() == []


def test_counting_a_bucket_takes_a_few_times_its_text(monkeypatch):
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(600)) for _ in range(400)]
    texts += [f"{t} {texts[i + 1]}" for i, t in enumerate(texts[:20])]
    batch = pa.RecordBatch.from_pydict({"text": texts, "rid": np.arange(len(texts))})
    monkeypatch.setattr("tutela.llm.words.CHUNK_BYTES", 1 << 17)
    monkeypatch.setattr(substring, "CHUNK_BYTES", 1 << 17, raising=False)
    none = np.zeros(0, np.uint64)
    packs = pa.Table.from_batches([p for i in range(0, len(texts), 20) for p in
                                   substring._pack(35, 3, 1, none)([batch.slice(i, 20)])])
    volume = sum(len(substring._unzip(t)) for t in packs.column("text").to_pylist())
    tracemalloc.start()
    ranges = substring._count(35)(packs)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert volume > 3 << 20 and peak < 7 * volume, (volume, peak)
    covered = [0] * len(texts)
    for rid, lo, hi in sorted(zip(*(c.to_pylist() for c in ranges.columns))):
        covered[rid] += hi - lo
    brute = brute_removed(texts, 35)
    assert [min(c, 1) for c in covered] == [min(n, 1) for _, n, _ in brute]


def test_ranges_are_written_one_row_a_text(docs, monkeypatch):
    real, written = substring.keep, []
    monkeypatch.setattr(substring, "keep",
                        lambda df, name: written.append(real(df, name)) or written[-1])
    texts = corpus(4)
    got = substring.remove_repeats(docs(texts), 9, 3, 700).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_removed, r.kept_text) for r in got] == brute_removed(texts, 9)
    rows = [tuple(r)[0] for table in written for r in table.collect()]
    assert rows and len(rows) == len(set(rows))


def test_equal_hashes_of_unequal_windows_are_told_apart(monkeypatch):
    words = substring.split(pa.array(["a b c a b d a b c"]))
    monkeypatch.setattr(substring, "window_hashes",
                        lambda h, size: np.zeros(len(h) - size + 1, np.uint64))
    assert substring.repeated_windows(words, np.arange(7), 3).tolist() == [
        True, False, False, False, False, False, True]


# ---------------------------------------------------------------- near copies --
def sets_of(texts):
    out = []
    for t in texts:
        w = WORD.findall((t or "").translate({k: k + 32 for k in range(65, 91)}))
        out.append(frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w
                   else frozenset())
    return out


def brute_components(pairs, percent=85):
    sets = sets_of([t for _, t in pairs])
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    members = defaultdict(list)
    for i in range(len(sets)):
        members[root(i)].append(i)
    return {pairs[i][0]: (len(sets[i]), min(pairs[k][0] for k in m))
            for m in members.values() for i in m}


def near_copies(seed, bases=6, copies=12):
    rng = random.Random(seed)
    out = []
    for _ in range(bases):
        base = [f"v{rng.randrange(5000)}" for _ in range(rng.choice([8, 40, 150]))]
        for _ in range(copies):
            one = list(base)
            for _ in range(rng.randrange(5)):
                one[rng.randrange(len(one))] = f"new{rng.randrange(10 ** 6)}"
            out.append(" ".join(one).upper() if rng.random() < 0.3 else " ".join(one))
    rng.shuffle(out)
    return list(enumerate(out + ["one two", "ONE  two", "three", "", None, "one two three"]))


def test_components_against_brute_force(docs, monkeypatch):
    for seed, block in ((1, 256), (2, 4)):  # small blocks: strays are compared across them
        monkeypatch.setattr(minhash, "BLOCK", block)
        pairs = near_copies(seed)
        got = {r.doc_id: (r.n_shingles, r.component_id)
               for r in minhash.near_duplicates(docs(pairs)).collect()}
        assert got == brute_components(pairs)


def test_rows_without_id_or_words(docs):
    same = "a b c d e f g"
    got = minhash.near_duplicates(docs([(None, same), (7, same), (5, same), (None, ""),
                                        (3, None), (None, "lonely row")])).collect()
    assert Counter((r.doc_id, r.component_id, r.kept) for r in got) == {
        (None, 5, False): 1, (7, 5, False): 1, (5, 5, True): 1, (None, None, False): 2,
        (3, 3, True): 1}
    assert minhash.near_duplicates(docs([])).collect() == []


def test_one_row_of_each_component_survives(docs):
    same = "a b c d e f g"
    table = docs([(4, same), (2, same), (2, same), (9, "x"), (None, same), (8, ""), (8, None)])
    got = minhash.survivors(table)
    assert got.columns == table.columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == {
        (2, same): 1, (9, "x"): 1, (8, ""): 1, (8, None): 1}


def test_every_coordinate_is_filled_and_agrees_as_often_as_the_sets():
    rng = np.random.default_rng(8)
    a = mix(np.arange(1000, dtype=np.uint64))
    b = np.concatenate([a[:900], mix(np.arange(5000, 5100, dtype=np.uint64))])
    sketch = minhash.sketches(np.concatenate([a, b, a[:1]]), np.array([0, 1000, 2000, 2001, 2001]),
                              512)
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    assert (sketch[:3] != empty).all() and (sketch[3] == empty).all()
    assert abs((sketch[0] == sketch[1]).mean() - 900 / 1100) < 0.08
    order = rng.permutation(1000)
    again = minhash.sketches(a[order], np.array([0, 1000]), 512)
    assert (again[0] == sketch[0]).all()
    assert len(gram_hashes(a[:3], 5)) == 0


def test_components_of_a_path_a_hub_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(5, i) for i in range(6, 60)] + [(900, 900)]
    table = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    got = {r.node: r.root for r in components(table).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, **{i: 5 for i in range(5, 60)}}
    assert components(table.limit(0)).collect() == []
