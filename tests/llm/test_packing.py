"""Packing against the tokenizer itself and the rules of a valid packing."""

import struct
import zlib
from collections import Counter

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from emberlink.llm import packing

VOCABULARY = packing.read_vocabulary()
TEXTS = ["", " ", "The house\nis red.", "don't we'll I'D  x", "ÀÉ Å ﬁ ΟΔΟΣ İstanbul", "日本語 のテキスト", "á ́b c\x1cd\x85e",
         "<|endoftext|> x <|startoftext|>", "x" * 5_000, "tab\tand\r\nmore", "one two " * 6_000, "🙂"]


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    tokenizer.encode_special_tokens = True
    return lambda text: [*tokenizer.encode(text, add_special_tokens=False).ids, 2]


def test_word_by_word_is_the_same(plain):
    coded = packing.WordCoder(VOCABULARY, 2).encode(TEXTS)
    assert [list(struct.unpack(f"<{len(c) // 4}I", c)) for c in coded] == [plain(t) for t in TEXTS]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=4))
def test_any_text(texts):
    kept = test_any_text.__dict__
    if "both" not in kept:
        kept["both"] = packing.WordCoder(VOCABULARY, 2), Tokenizer.from_str(VOCABULARY)
        kept["both"][1].encode_special_tokens = True
    coder, plain = kept["both"]
    for text, c in zip(texts, coder.encode(texts)):
        assert list(struct.unpack(f"<{len(c) // 4}I", c)) == [*plain.encode(text, add_special_tokens=False).ids, 2]


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=30))
def test_patterns_hold_every_length_once(histogram):
    patterns = packing.pack_histogram(histogram, 64)
    held = Counter()
    for pattern, count in patterns:
        assert count > 0 and sum(pattern) <= 64
        for length in pattern:
            held[length] += count
    assert held == Counter(histogram)


def test_emptiest_pack_first_and_equal_lengths():
    assert sorted(packing.pack_histogram({50: 1, 40: 1, 14: 2}, 64)) == [((40, 14), 1), ((50, 14), 1)]
    assert sorted(packing.pack_histogram({10: 1000}, 64)) == [((10,) * 4, 1), ((10,) * 6, 166)]
    with pytest.raises(ValueError):
        packing.pack_histogram({65: 1}, 64)


def _valid(rows, texts, plain, limit):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for doc_id, text in texts:
        ids, at = plain(text or ""), 0
        for r in sorted(by_doc.pop(doc_id), key=lambda r: r["start"]):
            piece = ids[at : at + r["length"]]
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(piece)}I", *piece))
            at += r["length"]
        assert at == len(ids)
    assert not by_doc
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= limit
    return len(by_sequence)


def test_pack(spark, plain, tmp_path):
    texts = [*enumerate([*TEXTS, None]), *[(1000 + i, "same words here") for i in range(300)]]
    rows = [(i, t, "x", 1) for i, t in texts]
    df = spark.createDataFrame(rows, "doc_id long, text string, task string, turn int").repartition(7)
    got = packing.pack(df, VOCABULARY, limit=100).collect()
    used = _valid(got, texts, plain, 100)
    assert used <= 1.1 * sum(r["length"] for r in got) / 100 + 1
    df.write.parquet(str(tmp_path / "documents.parquet"))
    _valid(packing.op3_pack(spark, str(tmp_path)).collect(), texts, plain, 4096)


def test_kept_ids_and_empty_table(spark, plain):
    df = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    got = sorted(packing.pack(df, VOCABULARY, limit=4, keep_ids=True).collect(), key=lambda r: r["start"])
    ids = plain("a b c d e f")
    assert [list(struct.unpack(f"<{r['length']}I", r["ids"])) for r in got] == [ids[:4], ids[4:]]
    assert packing.pack(df.where("false"), VOCABULARY).count() == 0
