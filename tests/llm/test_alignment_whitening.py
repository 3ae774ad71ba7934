import hashlib
import random
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tutela.llm import alignment, occurrences, whitening
from tutela.llm.queries import op11_token_alignment, op12_pair_index_bpe, op13_embedding_whitening

JSON = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def noise(seed, n, letters="  \n\t'stmdrevl1½²é!?_ 漢aA.<|endoftext|>▁\x00", most=60):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(most))) for _ in range(n)]


HARD = ["", None, " ", "<|endoftext|>", "a <|endoftext|> b<|endoftext|><|endoftext|>", "a▁b",
        "<|endof<|endoftext|>text|>", "a" * 5000, "abcabd" * 900, "aaa aaaa aaaaa", "\n\n a\n",
        "   x    y ", "\U0001F600" * 60, " " * 3000, "=" * 3000, "1" * 200, "<s> <unk> <0x41>",
        "it'll x'rea", "x　y\xa0z"]


def thue_morse(n, one, two):
    """Texts whose polynomial hashes modulo a power of two agree."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join((one, two)[b] for b in bits), "".join((two, one)[b] for b in bits)


# ---- 12 ------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@pytest.mark.parametrize("texts", [[], HARD, noise(1, 1500), [
    c + "a" + c + "1 " + c for c in map(chr, range(1, 0x3000))],
    [t for n in (2048, 4096) for t in thue_morse(n, "a", "b")]])
def test_ids_as_the_library_gives_them(library, texts):
    ids, first = occurrences.index_encoder(JSON)(pa.array(texts, pa.string()))
    want = library.encode_batch([t or "" for t in texts], add_special_tokens=False)
    for i, one in enumerate(want):
        assert ids[first[i]:first[i + 1]].tolist() == one.ids, ascii(texts[i])[:80]
    merges = occurrences.merges_of(JSON)
    assert occurrences.bytes_of(merges, ids)[0].tobytes().decode() == "".join(t or "" for t in texts)


def test_pieces_beyond_a_stretch_and_worker_memory(library, monkeypatch):
    monkeypatch.setattr(occurrences, "STRETCH_BYTES", 50)
    encoder = occurrences.Encoder(occurrences.pair_index(occurrences.merges_of(JSON), False))
    monkeypatch.setattr("tutela.llm.bpe.REMEMBERED", 3)
    for texts in (["one two three four " * 9, "x" * 400], ["other words here"], ["one two"]):
        ids, first = encoder(pa.array(texts))
        for i, t in enumerate(texts):
            assert ids[first[i]:first[i + 1]].tolist() == library.encode(t).ids


def test_files_that_cannot_be_read_are_refused():
    import json
    with open(JSON, encoding="utf-8") as file:
        content = json.load(file)
    merges = content["model"]["merges"]
    content["model"]["merges"] = [["he", "r"], *merges]
    with pytest.raises(ValueError, match="two merges"):
        occurrences.Merges(content)
    content["model"]["merges"] = merges[::-1]
    with pytest.raises(ValueError):
        occurrences.Merges(content)
    content["model"] |= {"merges": merges, "dropout": 0.1}
    with pytest.raises(ValueError, match="plain"):
        occurrences.Merges(content)


def test_encode_decode_rows_and_clashing_columns(spark, library):
    rows = spark.createDataFrame(
        [(i, t, "x", None) for i, t in enumerate(HARD + HARD[:4])],
        "doc_id long, text string, ids string, decoded string")
    found = occurrences.decoded(occurrences.encode(rows, JSON), JSON).collect()
    assert len(found) == len(HARD) + 4
    for r in found:
        assert r.ids == library.encode(r.text or "", add_special_tokens=False).ids
        assert r.decoded == library.decode(r.ids, skip_special_tokens=False) == (r.text or "")
    free = spark.createDataFrame([([50256, 0, None],), (None,), ([222, 99_999],)], "ids array<int>")
    assert [r.decoded for r in occurrences.decoded(free, JSON).collect()] == [
        "<|endoftext|>!", "", library.decode([222], skip_special_tokens=False)]


def test_digests_of_whole_table(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = op12_pair_index_bpe(spark, folder).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
    empty = spark.createDataFrame([], "doc_id long, text string, n_tokens string")
    assert occurrences.digests(empty, JSON).collect() == []


# ---- 11 ------------------------------------------------------------------------------------

class Brute:
    def __init__(self):
        self.a = Tokenizer.from_file(JSON)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
        names = {i: t for t, i in self.a.get_vocab().items()}
        shown = occurrences._shown_bytes()
        self.a_bytes = lambda i: bytes(shown[c] for c in names[i])

    def b_bytes(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) \
            else piece.replace("▁", " ").encode()

    def groups(self, text):
        if not text:
            return [], [], []
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        sides = [self.a_bytes(i) for i in a], [self.b_bytes(i) for i in b]
        if any(b"".join(s) != (" " + text).encode() for s in sides):
            return [], [], []
        ends = [np.cumsum([len(x) for x in s]).tolist() for s in sides]
        out, i, j = [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            p, q = ends[0].index(end, i) + 1, ends[1].index(end, j) + 1
            out.append((a[i:p], b[j:q]))
            i, j = p, q
        return a, b, out

    def corpus(self, texts):
        whole = [self.groups(t) for t in texts]
        count = Counter()
        for _, _, groups in whole:
            count.update({(x, y) for g, h in groups for x in g for y in h})
        most = defaultdict(int)
        for (x, _), n in count.items():
            most[x] = max(most[x], n)
        for a, b, groups in whole:
            links = [(x, y) for g, h in groups for x in g for y in h]
            text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
            yield (len(a), len(b), len(groups), len(links),
                   hashlib.sha256(text.encode()).hexdigest() if groups else "",
                   sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links))


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum")


def test_runs_of_random_arrays_of_ends():
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randrange(1, 60)
        a, b = (sorted({*rng.sample(range(1, n + 1), rng.randrange(0, n)), n}) for _ in range(2))
        if rng.random() < 0.3:
            b = a[:]
        found = [(i + k, j + k) for i, j, m in alignment.diagonal_runs(a, b) for k in range(m)]
        assert found == [(a.index(e) + 1, b.index(e) + 1) for e in sorted(set(a) & set(b))]
    assert alignment.diagonal_runs([], []) == []


def test_alignment_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(alignment, "EXPANDED", 6)  # both ways of counting links
    texts = HARD + noise(5, 150) + ["Some words, some words: as ever."] * 30
    rows = spark.createDataFrame([(i, t, -1) for i, t in enumerate(texts)],
                                 "doc_id long, text string, n_links long").repartition(3)
    want = list(Brute().corpus(texts))
    found = alignment.align_corpus(rows, JSON, PIECES).collect()
    assert len(found) == len(texts)
    for r in found:
        assert tuple(r[c] for c in COLUMNS) == want[r.doc_id], ascii(texts[r.doc_id])[:80]


def test_blocks_of_any_size_give_the_same(spark, monkeypatch):
    texts = noise(6, 60, "ab cd ef.", 200)
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    blocks = alignment.token_blocks(rows, JSON, PIECES)
    whole = sorted(alignment.link_counts(blocks, alignment.pair_counts(blocks)).collect())
    monkeypatch.setattr(alignment, "BLOCK_LINKS", 300)
    monkeypatch.setattr(alignment, "CHUNK", 1000)
    monkeypatch.setattr(alignment.TaskContext, "get", staticmethod(
        lambda: SimpleNamespace(partitionId=lambda: 7)))
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(60)), "text": pa.array(texts)})
    made = pa.Table.from_batches(alignment._blocks(JSON, PIECES)(iter([batch])))
    monkeypatch.undo()
    assert made.num_rows > 3
    few = spark.createDataFrame(made.to_pylist(), blocks.schema)
    assert sorted(alignment.link_counts(few, alignment.pair_counts(few)).collect()) == whole


def test_alignment_of_repeated_null_and_no_rows(spark):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("pair", T.StringType())])
    rows = spark.createDataFrame([(None, "a b c", "x"), (1, "a b c", "x"), (1, "a b c", None),
                                  (2, None, "x")], schema)
    found = alignment.align_corpus(rows, JSON, PIECES).collect()
    want = list(Brute().corpus(["a b c", "a b c", "a b c", None]))
    assert Counter((r.doc_id, tuple(r[c] for c in COLUMNS)) for r in found) == Counter(
        [(None, want[0]), (1, want[1]), (1, want[2]), (2, want[3])])
    assert alignment.align_corpus(rows.filter("doc_id > 9"), JSON, PIECES).collect() == []
    # texts without any token are a block without pairs
    assert [r.n_links for r in alignment.align_corpus(
        rows.filter("doc_id = 2"), JSON, PIECES).collect()] == [0]


def test_alignment_of_the_supplied_table(spark):
    folder = "/root/testdata/sf0.001"
    texts = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    want = {r.doc_id: w for r, w in zip(texts, Brute().corpus([r.text for r in texts]))}
    found = op11_token_alignment(spark, folder).collect()
    assert {r.doc_id: tuple(r[c] for c in COLUMNS) for r in found} == want


# ---- 13 ------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, component string"


def brute_whitening(rows):
    """Fit and deviations in Python integers, the rest from numpy's covariance."""
    usable = [(i, [int(np.floor(np.float64(c) * 64)) + 1_000_000 for c in v]) for i, v in rows
              if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in usable})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    deviation = [(i, sum((n * c - s) ** 2 for c, s in zip(x, sums))) for i, x in usable]
    d = np.array([[n * c - s for c, s in zip(x, sums)] for x in fit], np.float64) / n
    return usable, n, sums, deviation, d.T @ d / n


def check_whitening(rows, found, most=16):
    usable, n, sums, deviation, covariance = brute_whitening(rows)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(most, len(values))
    assert len(found) == len(usable) * k
    assert Counter((r.vec_id, r.deviation) for r in found if r.component == 1) == Counter(deviation)
    assert {r.n for r in found} == {n}
    by = defaultdict(dict)
    for r in found:
        by[r.component].setdefault(r.vec_id, r)
    for c in range(k):
        rank = values[c] > 1e-12 * values[0]
        for i, x in usable:
            r = by[c + 1][i]
            assert r.explained == pytest.approx(values[c] / values.sum(), rel=1e-4, abs=1e-13)
            if not rank:
                assert r.whitened is None
        if rank and (c == 0 or values[c - 1] > values[c] * 1.01) and \
                (c + 1 == len(values) or values[c] > values[c + 1] * 1.01):
            own = np.array([by[c + 1][i].whitened for i, _ in usable])
            centred = np.array([[n * a - s for a, s in zip(x, sums)] for _, x in usable]) / n
            want = centred @ vectors[:, c] / np.sqrt(values[c])
            sign = np.sign(want @ own) or 1.0
            assert own == pytest.approx(sign * want, abs=1e-6)
    errors = {r.identity_error for r in found}
    assert len(errors) == 1 and max(errors) < 1e-8


def test_bit_planes_give_exact_products():
    rng = np.random.default_rng(1)
    for high in (1, 2, 200, 70_000, 1 << 40):
        x = rng.integers(0, high, (131, 5))
        got = whitening.cross_products(x)
        for i in range(5):
            for j in range(i, 5):
                assert got[i, j] == sum(int(a) * int(b) for a, b in zip(x[:, i], x[:, j]))
    assert (whitening.cross_products(np.zeros((0, 3), np.int64)) == 0).all()


@pytest.mark.parametrize("width", [3, 24])
def test_whitening_against_brute_force(spark, width):
    rng = np.random.default_rng(width)
    base = rng.normal(size=(300, width)) @ np.diag(np.linspace(0.2, 3, width))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(500 + i, rows[0][1]) for i in range(40)]          # copies weigh once
    rows += [(600, None), (601, [None] * width), (602, [float("nan")] * width),
             (603, [float("inf")] + [0.0] * (width - 1)), (604, [1e300] * width)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], VECTORS)
    check_whitening(rows[:-1], whitening.whiten(df.repartition(5)).collect())


def test_far_vectors_and_those_of_another_length(spark):
    rng = np.random.default_rng(7)
    rows = [(i, (rng.normal(size=4) * 10.0 ** rng.integers(0, 5)).tolist()) for i in range(80)]
    odd = [(900, [1.0]), (901, []), (902, [1.0] * 5)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows + odd], VECTORS)
    check_whitening(rows, whitening.whiten(df).collect())
    wide = spark.createDataFrame([(i, [float(i) * 1e9, 0.0], "") for i in range(9)], VECTORS)
    assert {r.deviation for r in whitening.whiten(wide).collect()} >= {0, None}


def test_vectors_without_variance_and_none(spark):
    same = spark.createDataFrame([(i, [0.5, 0.25], "") for i in range(5)], VECTORS)
    found = whitening.whiten(same).collect()
    assert len(found) == 10 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error)
                                 for r in found} == {(1, 0, None, None, None)}
    flat = spark.createDataFrame([(None, [float(i), 1.0], "") for i in range(5)], VECTORS)
    found = whitening.whiten(flat).collect()
    assert {r.whitened is None for r in found if r.component == 2} == {True}
    assert {r.vec_id for r in found} == {None} and found[0].identity_error < 1e-12
    for rows in ([], [(1, None, "")], [(1, [float("nan")], "")], [(1, [], "")]):
        assert whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect() == []


def test_whitening_of_the_supplied_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(
        f"{folder}/embeddings.parquet").collect()]
    check_whitening(rows, op13_embedding_whitening(spark, folder).collect())
