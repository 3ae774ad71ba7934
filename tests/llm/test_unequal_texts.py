"""Texts that every polynomial hash modulo a power of two takes for equal."""
import base64
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from tutela.llm import bpe, minhash, packing, quality_rules, substring
from tutela.llm.words import same_spans, span_hashes

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


def thue_morse(n, one="a", two="b"):
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join((one, two)[b] for b in bits), "".join((two, one)[b] for b in bits)


PAIRS = [p for n in (64, 2048, 4096) for p in (thue_morse(n), thue_morse(n, "xy", "zw"))]


@pytest.mark.parametrize("pair", PAIRS)
def test_hashes_differ(pair):
    data = np.frombuffer("".join(pair).encode(), np.uint8)
    n = len(pair[0])
    for seed in (0, 1, 1 << 63):
        a, b = span_hashes(data, np.array([0, n]), np.array([n, 2 * n]), seed)
        assert a != b
    spans = np.array([0]), np.array([n]), data, np.array([n]), np.array([2 * n])
    assert not same_spans(data, *spans)[0]
    assert same_spans(data, spans[0], spans[1], data, spans[0], spans[1])[0]


def test_spans_of_all_lengths():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 4000).astype(np.uint8)
    starts = rng.integers(0, 3800, 3000)
    ends = starts + rng.integers(0, 90, 3000)
    raw, seen = data.tobytes(), {}
    for h, a, b in zip(span_hashes(data, starts, ends, 5), starts, ends):
        assert seen.setdefault(raw[a:b], h) == h
    assert len(set(seen.values())) == len(seen)
    other = rng.permutation(3000)
    same = same_spans(data, starts, ends, data, starts[other], ends[other])
    for s, a, b, c, d in zip(same, starts, ends, starts[other], ends[other]):
        assert s == (raw[a:b] == raw[c:d])


def test_ids_of_one_batch():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                special_tokens={})
    texts = [t for p in PAIRS for t in p] * 2
    ids, first = bpe.tree_encoder(RANKS)(pa.array(texts))
    for i, t in enumerate(texts):
        assert ids[first[i]:first[i + 1]].tolist() == library.encode_ordinary(t)


def test_a_collision_is_met_by_another_key(monkeypatch):
    calls = []

    def colliding(data, starts, ends, seed=0):
        calls.append(seed)
        return np.zeros(len(starts), np.uint64) if len(calls) < 3 \
            else span_hashes(data, starts, ends, seed)
    monkeypatch.setattr(bpe, "span_hashes", colliding)
    encoder = bpe.Encoder(bpe.segment_tree(bpe.ranks_of(RANKS)))
    ids, first = encoder(pa.array(["one two one", "three"]))
    monkeypatch.undo()
    want, edges = bpe.tree_encoder(RANKS)(pa.array(["one two one", "three"]))
    assert len(set(calls)) == 3 and (ids == want).all() and (first == edges).all()
    monkeypatch.setattr(quality_rules, "span_hashes", lambda d, s, e, seed=0: np.zeros(
        len(s), np.uint64) if seed % 2 else span_hashes(d, s, e, seed))
    drawn = iter([1, 3, 4])
    monkeypatch.setattr(quality_rules.secrets, "randbits", lambda n: next(drawn))
    assert quality_rules.count_statistics(pa.array(["x\ny\nx\nz"]))["n_dup_lines"].tolist() == [1]


def test_lines_and_windows_of_one_text():
    lines = [t for p in PAIRS for t in p]
    found = quality_rules.count_statistics(pa.array(["\n".join(lines), "\n".join(lines * 2)]))
    assert found["n_dup_lines"].tolist() == [0, len(lines)]
    eight = thue_morse(8, "p ", "q ")
    found = quality_rules.count_statistics(pa.array([" ".join(eight), " ".join(eight + eight)]))
    assert found["n_repeat_words"].tolist() == [0, 32]


def test_sets_and_packed_ids(spark, docs):
    rest = " ".join(f"w{i}" for i in range(3))
    texts = [t + " " + rest for p in PAIRS for t in p]
    found = minhash.near_duplicates(docs(texts)).collect()
    assert all(r.kept and r.component_id == r.doc_id for r in found)
    library = Tokenizer.from_file(JSON)
    for r in packing.pack(docs(texts), JSON, added=True).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids + [0]
        piece = np.array(ids[r.start:r.start + r.length], "<u4")
        assert r.ids_crc32 == zlib.crc32(piece.tobytes()) and r.doc_tokens == len(ids)


def test_windows_of_long_words(docs):
    a, b = thue_morse(64, "m ", "n ")
    found = {r.doc_id: r.n_removed for r in substring.remove_repeats(docs([a, b, a])).collect()}
    words = [t.split() for t in (a, b, a)]
    seen = {}
    for d, w in enumerate(words):
        for i in range(len(w) - 34):
            seen.setdefault(tuple(w[i:i + 35]), []).append((d, i))
    gone = {(d, i + k) for at in seen.values() if len(at) > 1 for d, i in at for k in range(35)}
    assert found == {d: sum(x == d for x, _ in gone) for d in range(3)}
