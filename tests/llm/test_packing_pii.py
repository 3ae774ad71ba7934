import random
import re
import zlib
from datetime import date

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tutela.llm import cutting, packing, pii, queries

JSON = public_tokenizers.path("byte_bpe_50k.json")
KEY = b"a test key"


def used(patterns, capacity):
    out = {}
    for times, pattern in patterns:
        assert times > 0 and sum(n * c for n, c in pattern.items()) <= capacity
        for n, c in pattern.items():
            out[n] = out.get(n, 0) + times * c
    return out


@pytest.mark.parametrize("histogram", [
    {}, {64: 3}, {1: 1}, {33: 5, 31: 2}, {n: 1 + n % 3 for n in range(1, 65)},
    {n: 900 + 7 * n for n in range(1, 64)}])
def test_plan_uses_every_piece_once(histogram):
    assert used(cutting.plan(histogram, 64), 64) == histogram


def test_plan_wastes_little_and_meets_the_bound():
    rng = np.random.default_rng(3)
    lengths, counts = np.unique(rng.integers(1, 100, 20_000) ** 2 // 80 + 1, return_counts=True)
    histogram = dict(zip(map(int, lengths), map(int, counts)))
    columns, times = cutting.relax(lengths, counts.astype(float), 128)
    assert ((columns @ times) >= counts - 1e-6).all()
    material = (lengths * counts).sum() / 128
    sequences = sum(t for t, _ in cutting.plan(histogram, 128))
    assert material <= times.sum() + 1e-6 and sequences < 1.01 * material + 2


def test_slots_give_each_rank_a_place_of_its_own():
    histogram = {5: 7, 9: 4, 3: 11, 16: 2}
    table = cutting.slots(cutting.plan(histogram, 16))
    places = set()
    for length, n in histogram.items():
        own = table[table[:, 0] == length]
        for rank in range(n):
            row = own[np.searchsorted(own[:, 1], rank, side="right") - 1]
            over = rank - row[1]
            places.add((row[2] + over // row[3], row[4] + over % row[3] * length))
    assert len(places) == sum(histogram.values())


def test_pieces_against_the_tokenizers_library(docs):
    rng = random.Random(5)
    texts = [" ".join(f"{rng.choice('aeiou')}x{rng.randrange(999)}" for _ in range(rng.choice(
        [1, 30, 400, 1500]))) for _ in range(40)] + [None, "", "\n\n x", "<|endoftext|> a"]
    got = packing.pack(docs(texts).repartition(3).withColumn("offset", F.lit("clash")),
                       JSON).collect()
    library = Tokenizer.from_file(JSON)
    library.encode_special_tokens = True
    ids = [np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
           for t in texts]
    pieces, sequences = {}, {}
    for r in got:
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own) and 0 < r.length <= 1024
        assert r.ids_crc32 == zlib.crc32(own[r.start:r.start + r.length].tobytes())
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, own in enumerate(ids):
        end = 0
        for start, length in sorted(pieces[i]):
            assert start == end
            end += length
        assert end == len(own)
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    total = sum(map(len, ids))
    assert len(sequences) <= 1.05 * total / 1024 + 2
    assert packing.pack(docs([]), JSON).collect() == []


def test_added_tokens_get_the_ids_of_the_librarys_encode(spark, docs, tmp_path):
    texts = ["hello <|endoftext|> world", "<|endoftext|><|endoftext|>", "plain", None,
             "a <|endoftext|" + " b" * 1500 + "<|endoftext|>c"]
    docs(texts).write.parquet(str(tmp_path / "documents.parquet"))
    library = Tokenizer.from_file(JSON)
    ids = [np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
           for t in texts]
    assert ids[0].tolist() == [31373, 220, 50256, 995, 0]
    for got in (queries.op6_packing(spark, str(tmp_path)),
                corpus_pipeline.packing_plan(spark, docs(texts), str(tmp_path))):
        rows = got.collect()
        assert {r.doc_id for r in rows} == set(range(len(texts)))
        for r in rows:
            own = ids[r.doc_id]
            assert r.doc_tokens == len(own)
            assert r.ids_crc32 == zlib.crc32(own[r.start:r.start + r.length].tobytes())


def test_rows_that_repeat_are_packed_each_for_itself(docs):
    got = packing.pack(docs([(None, "a b"), (None, "a b"), (1, "c")]), JSON).collect()
    assert len(got) == 3 and len({(r.sequence_id, r.offset) for r in got}) == 3


# ------------------------------------------------------------------------ PII --
def test_permutations_of_every_size_can_be_undone():
    for size in (1, 2, 3, 10, 97, 1000):
        image = [pii.permute(i, size, KEY, "t") for i in range(size)]
        assert sorted(image) == list(range(size))
        assert [pii.permute(x, size, KEY, "t", True) for x in image] == list(range(size))
    assert [pii.permute(i, 1000, KEY, "t") for i in range(9)] != \
        [pii.permute(i, 1000, b"other", "t") for i in range(9)]


def luhn(digits):
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = int(ch) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


VALID = ["4539148803436467", "4539 1488 0343 6467", "+1 (535) 555-5412", "10.2.33.4",
         "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "123-45-6789", "2001-02-28",
         "28.02.2001", "02/28/2001", "in.06@mail8.example.com"]
INVALID = ["4539148803436468", "300.1.1.1", "01.2.3.4", "1.2.3.4.5", "DE88370400440532013000",
           "000-12-3456", "2001-02-30", "31.04.2001", "13/13/2001", "12345", "3.14159",
           "0000000000000000", "1850-01-01", "a@b"]


def test_valid_values_change_within_their_format_and_come_back():
    for value in VALID:
        text, kinds = pii.pseudonymise(f"x {value}, y", KEY)
        new = text[2:-3]
        assert len(kinds) == 1 and new != value, value
        if kinds != ["address"]:
            assert re.sub("[a-z]", "a", re.sub(r"\d", "9", new)) == \
                re.sub("[a-z]", "a", re.sub(r"\d", "9", value)) or "WEST" in value
        assert pii.pseudonymise(text, KEY, back=True)[0] == f"x {value}, y"
        assert pii.pseudonymise(new, KEY)[1] == kinds  # again a valid value
    assert luhn(re.sub(r"\D", "", pii.pseudonymise(VALID[1], KEY)[0]))
    assert len(pii.pseudonymise('token = "' + "0a" * 20 + '"', KEY)[1]) == 1


@pytest.mark.parametrize("value, rest", [
    ("1985-04-12", "T08:30:00Z"), ("1985-04-12", " 08:30"), ("4/12/1985", ""), ("25/12/1985", ""),
    ("12/4/1985", ""), ("25/4/1985", ""), ("4.12.1985", ""), ("04/5/1985", ""),
    ("1985-4-12", ""), ("(212) 555-0187", ""), ("212-555-0187", ""), ("212.555.0187", ""),
    ("1-212-555-0187", ""), ("BE68539007547034", " EUR"), ("AT611904300234573201", " IBAN"),
    ("BE68 5390 0754 7034", " EUR"), ("NO9386011117947", " NOK")])
def test_every_spelling_changes_and_comes_back(value, rest):
    for other in range(40):
        key = b"key %d" % other
        text, kinds = pii.pseudonymise(f"x {value}{rest}, y", key)
        assert len(kinds) == 1 and value not in text and text.endswith(f"{rest}, y")
        assert re.sub(r"\d", "9", text) == re.sub(r"\d", "9", f"x {value}{rest}, y")
        assert pii.pseudonymise(text, key, back=True)[0] == f"x {value}{rest}, y"


def test_one_day_has_one_pseudonym_in_all_spellings_and_two_ibans_have_two():
    new = [pii.pseudonymise(t, KEY)[0] for t in ("1985-04-25", "25/4/1985", "4/25/1985", "25.04.1985")]
    day = date.fromisoformat(new[0])
    assert new[1:] == [f"{day.day}/{day.month}/{day.year}", f"{day.month}/{day.day}/{day.year}",
                       f"{day:%d.%m.%Y}"]
    assert pii.pseudonymise("BE68539007547034 DE89 3704 0044 0532 0130 00", KEY)[1] == ["iban"] * 2
    for value in ("112-555-0187", "211-555-0187", "212-411-0187", "31/31/1985"):
        assert pii.pseudonymise(value, KEY) == (value, [])


def test_values_that_fail_their_check_stay():
    for value in INVALID:
        assert pii.pseudonymise(f"x {value} y", KEY) == (f"x {value} y", []), value


def test_equal_values_stay_linked_across_documents_and_spellings(docs):
    got = [r.text for r in pii.pseudonyms(docs([
        "on 2001-02-28", "28.02.2001 it was", "card 4539148803436467",
        "4539 1488 0343 6467", None, ""]).withColumn("kinds", F.lit(1)), KEY).collect()]
    day = date.fromisoformat(got[0][3:])
    assert got[1].startswith(day.strftime("%d.%m.%Y"))
    assert got[2][5:] == got[3].replace(" ", "") and got[4:] == [None, ""]
    assert pii.pseudonyms(docs([]), KEY).collect() == []


@pytest.mark.parametrize("spellings", [
    ("+442071838750", "+44 20 7183 8750", "+44-20-7183-8750", "+44 (20) 71838750"),
    ("+12125550187", "+1 212 555 0187", "(212) 555-0187", "212-555-0187", "1-212-555-0187"),
    ("+3725551234", "+372 555 1234"), ("+81312345678", "+81 3 1234 5678"),
    ("+1 112 555 0187", "+11125550187")])
def test_a_phone_number_has_one_pseudonym_in_all_spellings(spellings):
    for other in range(30):
        key = b"key %d" % other
        new = [pii.pseudonymise(f"x {t} y", key) for t in spellings]
        assert all(len(kinds) == 1 for _, kinds in new)
        digits = {re.sub(r"\D", "", text).removeprefix("1" if "212" in spellings[0] else "")
                  for text, _ in new}
        assert len(digits) == 1
        for (text, _), old in zip(new, spellings):
            assert pii.pseudonymise(text, key, back=True)[0] == f"x {old} y"
            code = pii.calling_code(re.sub(r"\D", "", old))
            if old.startswith("+"):
                assert text.startswith(f"x +{code}")


def test_numbers_outside_the_plan_do_not_meet_those_inside():
    inside = [f"+1 212 555 {i:04}" for i in range(300)]
    outside = [f"+1 112 555 {i:04}" for i in range(300)]
    new = [pii.phone(t, KEY) for t in inside + outside]
    assert len(set(new)) == 600
    assert [pii._planned(re.sub(r"\D", "", t)[1:]) for t in new] == [True] * 300 + [False] * 300


def test_a_key_must_be_given(spark):
    with pytest.raises(ValueError):
        pii.session_key(spark)
    demo = pii.session_key(spark, pii.DEMONSTRATION_KEY)
    try:
        spark.conf.set(pii.KEY_SETTING, "")
        with pytest.raises(ValueError):
            pii.session_key(spark)
        spark.conf.set(pii.KEY_SETTING, "x" * 100 + "a")
        one = pii.session_key(spark)
        spark.conf.set(pii.KEY_SETTING, "x" * 100 + "b")
        two = pii.session_key(spark)
    finally:
        spark.conf.unset(pii.KEY_SETTING)
    assert len({demo, one, two}) == 3 and {len(k) for k in (demo, one, two)} == {64}


def test_long_and_repeated_texts_are_changed_alike(docs):
    long = "call +44 20 7183 8750 or write to ann@example.org, " * 20_000
    got = [r.text for r in pii.pseudonyms(docs([(1, long), (1, long), (2, "")]), KEY).collect()]
    assert got[0] == got[1] and len(got[0]) == len(long) and got[2] == ""
    assert got[0] == pii.pseudonymise(long[:51], KEY)[0] * 20_000
