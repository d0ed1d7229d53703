"""The codec against a public implementation of the same vocabulary, and its round trip."""

import hashlib
import struct

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from emberlink.llm import bpe
from emberlink.llm.perfect_hash import PerfectHash

TOKENS = bpe.read_ranks(public_tokenizers.path(bpe.VOCABULARY))


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(TOKENS)


@pytest.fixture(scope="module")
def known():
    ranks = {t: i for i, t in enumerate(TOKENS)}
    return tiktoken.Encoding("known", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _ids(packed):
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


def test_perfect_hash_is_minimal():
    keys = [str(i).encode() * (i % 5 + 1) for i in range(1, 3000)]
    found = PerfectHash(keys)
    assert [found.find(k) for k in keys] == list(range(len(keys)))
    assert sorted(found.owner) == list(range(len(keys)))
    assert found.find(b"no such key") == -1 and PerfectHash([]).find(b"x") == -1


TEXTS = ["", " ", "a", "The  house\n\n  is \tred. ", "don't we'll I'D", "1234567 99,5", "héllo größe niño", "日本語のテキスト", "🙂🙂 👩‍👩‍👧",
         "<|endoftext|>", "x" * 20_000, "ab" * 5_000 + " ", "\u0000\u0007", "   x", "é", "supercalifragilistic" * 50, "   \n \n\n   end"]


@pytest.mark.parametrize("text", TEXTS)
def test_same_ids(codec, known, text):
    assert _ids(codec.encode(text)) == known.encode_ordinary(text)
    assert codec.decode(codec.encode(text)) == text.encode()


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="abcdehinorst '\n.é1", max_size=200))
def test_same_ids_on_any_text(text):
    ranks = {t: i for i, t in enumerate(TOKENS)}
    cache = test_same_ids_on_any_text.__dict__
    if "both" not in cache:
        cache["both"] = bpe.Codec(TOKENS), tiktoken.Encoding("k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec, known = cache["both"]
    assert _ids(codec.encode(text)) == known.encode_ordinary(text)
    assert codec.decode(codec.encode(text)) == text.encode()


def test_forgetting_changes_nothing(codec, monkeypatch):
    text = " ".join(f"word{i}" for i in range(300))
    want = codec.encode(text)
    monkeypatch.setattr(bpe, "REMEMBERED", 7)
    codec.seen.clear()
    assert codec.encode(text) == want


def test_query(spark, tmp_path, known):
    texts = [*TEXTS, None, "The house", "The house"]
    rows = [(i, t, None, "kept") for i, t in enumerate(texts)] + [(None, "no id", None, "kept")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, IDS string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in bpe.op2_bpe_round_trip(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for i, text, *_ in rows:
        ids = known.encode_ordinary(text or "")
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_operator_keeps_columns(spark):
    df = spark.createDataFrame([("a b", "x", 1)], "text string, decoded string, TEXT_ID int")
    coded = bpe.decode_ids(bpe.encode_texts(df, TOKENS, ids_col="codes"), TOKENS, "codes", "bytes")
    assert coded.columns == ["text", "decoded", "TEXT_ID", "codes", "bytes"]
    assert bytes(coded.first()["bytes"]) == b"a b"
    assert bpe.encode_texts(df.where("false"), TOKENS).count() == 0


def test_broken_rank_file(tmp_path):
    (tmp_path / "ranks").write_bytes(b"YQ== 0\nYg== 2\n")
    with pytest.raises(ValueError, match="ranks"):
        bpe.read_ranks(str(tmp_path / "ranks"))
