import base64
import random
import re

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken

from tutela.llm import bpe
from tutela.llm.words import gram_hashes, sliding_min, split, window_hashes

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


def noise(rng, letters, n, most):
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(most))) for _ in range(n)]


def test_words_and_hashes_against_a_regular_expression():
    rng = random.Random(1)
    texts = [t if rng.random() > 0.1 else None for t in noise(rng, "ab é\n\t \x0b\x00Z", 500, 40)]
    words = split(pa.array(texts, pa.string()).slice(3))
    seen = {}
    hashes = words.hashes()
    for d, text in enumerate(texts[3:]):
        own = [bytes(words.data[a:b]).decode() for a, b in zip(
            words.starts[words.first[d]:words.first[d + 1]],
            words.ends[words.first[d]:words.first[d + 1]])]
        assert own == WORD.findall(text or "")
        for w, h in zip(own, hashes[words.first[d]:words.first[d + 1]]):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_windows_and_minima():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 3, 400).astype(np.uint64)
    for hashes, size in ((window_hashes(x, 7), 7), (gram_hashes(x, 3), 3)):
        seen = {}
        for i, h in enumerate(hashes):
            assert seen.setdefault(tuple(x[i:i + size]), h) == h
        assert len(set(seen.values())) == len(seen)
    assert (sliding_min(x, 33) == [x[i:i + 33].min() for i in range(368)]).all()
    assert len(sliding_min(x[:5], 9)) == 0


@pytest.mark.parametrize("texts", [
    [], [""], [None, "", "a"], ["'s", " 's", "!'s", "it'll", "x'rea", "''re", "a'", "don't 'tis"],
    ["  a", "a  ", "a \n b", "\n\n", "a b", "x　 y", "\x1c a\x85"],
    ["a" * 3000, "abcabd" * 900, "!" * 700 + " " * 500 + "x", "\U0001F600" * 90]])
def test_encoding_as_the_library(library, texts):
    check(library, texts)


def check(library, texts):
    ids, first = bpe.tree_encoder(PATH)(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert ids[first[i]:first[i + 1]].tolist() == library.encode_ordinary(text or ""), text
    data, ends = bpe.decode(bpe.ranks_of(PATH), ids)
    assert data.tobytes().decode() == "".join(t or "" for t in texts)


def test_encoding_of_random_texts_and_of_every_code_point(library):
    rng = random.Random(4)
    check(library, noise(rng, "  \n\t'stmdrevl1½²é!?_ 漢aA.", 1500, 30))
    check(library, [c + "a" + c + "1 " + c for c in map(chr, range(0x20, 0x3000))])
    for n in (63, 64, 65, 66, 67, 130):  # where pieces leave the side-by-side merge
        check(library, ["".join(rng.choice("etaoin") for _ in range(n)) for _ in range(20)])


def test_frames_round_trip(spark, docs, library):
    table = docs(["The cat", None, "", "été 12"]).withColumnRenamed("n_chars", "ids")
    got = bpe.decoded(bpe.encode(table, PATH), PATH).collect()
    assert [bytes(r.decoded).decode() for r in got] == ["The cat", "", "", "été 12"]
    assert [r.ids for r in got] == [library.encode_ordinary(r.text or "") for r in got]
    assert bpe.digests(docs([]), PATH).collect() == []
