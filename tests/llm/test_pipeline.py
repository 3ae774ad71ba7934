import random
import zlib

import numpy as np
import public_tokenizers
from test_dedup import brute_components, brute_removed
from test_quality_vectors import brute_counts
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tutela.llm import pii, queries

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def planted(seed):
    """Prose with a shared passage, near copies, personal numbers and texts that rules reject."""
    rng = random.Random(seed)

    def prose(n):
        return [f"{rng.choice('abcdef')}{rng.randrange(4000)}" for _ in range(n)]
    passage, texts = prose(60), []
    for i in range(24):
        own = prose(300 if i in (1, 2) else rng.choice([40, 80, 200]))
        if i % 6 == 0:
            own[10:10] = passage
        if i % 5 == 0:
            own[3:3] = ["card", "4539148803436467", "on", "2001-02-28"]
        texts.append("\n".join(" ".join(own[k:k + 9]) for k in range(0, len(own), 9)))
    for i in (1, 2):
        texts += [texts[i], texts[i].replace(texts[i].split()[7], "changed")]
    return texts + ["short", "", None, "one two three four five six seven eight " * 9]


def brute(texts, key):
    """doc_id -> ids after all stages; none of the texts is far from the others."""
    counts = {i: brute_counts(t or "") for i, t in enumerate(texts)}
    kept = [(i, texts[i]) for i, c in counts.items() if c[0] >= 20 and 100 * c[4] <= 30 * c[0]]
    groups = brute_components(kept)
    kept = [(i, t) for i, t in kept if groups[i][1] == i]
    cut = brute_removed([t for _, t in kept], 35)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = {}
    for (i, text), (_, n, rest) in zip(kept, cut):
        final = pii.pseudonymise(rest if n else text, key)[0]
        out[i] = np.array([*library.encode(final, add_special_tokens=False).ids, 0], "<u4")
    return out, sum(1 for _, n, _ in cut if n)


def test_whole_run_against_brute_force(spark, docs, tmp_path):
    texts = planted(1)
    docs(texts).write.parquet(str(tmp_path / "documents.parquet"))
    expected, with_cuts = brute(texts, pii.session_key(spark, pii.DEMONSTRATION_KEY))
    assert with_cuts == 4 and len(expected) == 24
    found = {}
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        own = expected[r.doc_id]
        assert r.doc_tokens == len(own)
        assert r.ids_crc32 == zlib.crc32(own[r.start:r.start + r.length].tobytes())
        found[r.doc_id] = found.get(r.doc_id, 0) + r.length
    assert found == {i: len(own) for i, own in expected.items()}


def test_near_duplicates_are_linked_from_a_similarity_of_80_percent(spark, docs, tmp_path):
    rng = random.Random(2)
    texts, similar = [], []
    for changes in (6, 6, 6, 9):
        words = [f"w{rng.randrange(10 ** 6)}" for _ in range(300)]
        copy = list(words)
        for k in range(changes):
            copy[10 + 30 * k] = f"other{rng.randrange(10 ** 6)}"
        sets = [{tuple(t[i:i + 5]) for i in range(296)} for t in (words, copy)]
        similar.append(len(sets[0] & sets[1]) / len(sets[0] | sets[1]))
        texts += [" ".join(words), " ".join(copy)]
    assert all(0.80 <= s < 0.85 for s in similar[:3]) and similar[3] < 0.80
    got = corpus_pipeline.near_dedup(spark, docs(texts), str(tmp_path))
    assert sorted(r.doc_id for r in got.collect()) == [0, 2, 4, 6, 7]


def test_every_stage_but_the_last_returns_documents(spark, docs, tmp_path):
    table = docs([(1, "x"), (None, None), (2, "a b " * 30), (2, "a b " * 30)])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, table, str(tmp_path))
        assert got.columns == COLUMNS, name
        assert got.count() >= 0
        assert stage(spark, docs([]), str(tmp_path)).collect() == [], name
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_columns_named_as_an_operators_come_back_as_they_were(spark, docs, tmp_path):
    own = ("kept", "distance", "n_words", "n_removed", "kept_text", "kinds", "base_failed")
    texts = ["card 4539148803436467 " + " ".join(f"w{i}x{k}" for k in range(40)) for i in range(4)]
    table = docs(texts)
    for name in own:
        table = table.withColumn(name, F.concat(F.lit(name), F.col("doc_id")))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, table, str(tmp_path))
        assert got.columns == table.columns, name
        rows = got.collect()
        assert len(rows) == 4 and all(r[c] == f"{c}{r.doc_id}" for r in rows for c in own), name
        assert all(r.n_chars == len(r.text) for r in rows)


def test_all_queries_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.SQL) <= set(queries.QUERIES)
