import functools
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from chunkloom.llm import token_planes as tp

PATH = str(public_tokenizers.path("word_bpe_49k.json"))
ODD = [
    "", "  a b\t\n", "Don't it's 'S we'LL can't.", "ÉCOLE, Straße! ŒUVRE;  x y z w  İstanbul. été, ŉ",
    "<|endoftext|> a<|startoftext|>b", "日本語。テキスト 12345, a1b2! ½ ª º", "…,a​.b ﬁ ΑΣ. ς", "word### (x) a-b -- _z_ ~",
]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=300), st.sampled_from(["bit", "byte"]))
def test_planes_round_trip(values, kind):
    ids = np.array(values, np.uint32)
    planes = tp.to_planes(ids, kind, zstandard.ZstdCompressor().compress)
    back = tp.from_planes(planes, len(ids), kind, zstandard.ZstdDecompressor().decompress)
    assert back.tolist() == values


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_words_encode_like_texts(text):
    (ids,) = _encoder()(pa.array([text]))
    assert ids.tolist() == _whole().encode(text, add_special_tokens=False).ids


@functools.cache
def _whole():
    return Tokenizer.from_file(PATH)


@functools.cache
def _encoder():
    return tp.WordEncoder(PATH, 500)


def test_odd_texts_encode_whole():
    for text, ids in zip(ODD, tp.WordEncoder(PATH, 4)(pa.array(ODD)), strict=True):
        assert ids.tolist() == _whole().encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("kind", ["bit", "byte"])
def test_files_read_back(spark, tmp_path, kind):
    texts = [*ODD, None, "long text " * 400, "b"]
    rows = [(20 - i, t, "clash") for i, t in enumerate(texts)] + [(5, "same id"), (5, "same id"), (5, "other"), (None, "no id")]
    rows = [(*r, "clash")[:3] for r in rows]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, block string").repartition(3)
    path = str(tmp_path / "tokens")
    tp.write_token_files(docs, path, PATH, kind=kind, block_ids=64)
    blocks = tp.token_files(spark, path)
    assert {r["n_ids"] for r in blocks.where("n_ids <> 64").select("n_ids").collect()} <= set(range(1, 64))
    found = tp.document_digests(blocks, kind).orderBy("start").collect()
    own = {}
    for key, text, _ in rows:
        own.setdefault(key, []).append(_whole().encode(text or "", add_special_tokens=False).ids + [tp.END_ID])
    assert [r["doc_id"] for r in found] == sorted((k for k, *_ in rows), key=lambda k: (k is not None, k))
    start = 0
    for row in found:
        assert row["start"] == start
        start += row["n_tokens"]
        fits = [i for i in own[row["doc_id"]] if zlib.crc32(np.array(i, "<u4").tobytes()) == row["ids_crc32"]]
        assert fits
        assert len(fits[0]) == row["n_tokens"]
    decoded = {tuple(r["ids"]) for r in tp.decode_documents(blocks, kind).collect()}
    assert decoded == {tuple(i) for ids in own.values() for i in ids}


def test_no_documents(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    tp.write_token_files(docs, str(tmp_path / "none"), PATH)
    assert tp.document_digests(tp.token_files(spark, str(tmp_path / "none"))).count() == 0


def test_other_tokenizers_take_whole_texts():
    encode = tp.encoder_for(str(public_tokenizers.path("byte_bpe_50k.json")))
    assert isinstance(encode, tp.WholeEncoder)
    (ids,) = encode(pa.array(["Hello  there"]))
    whole = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    assert ids.tolist() == whole.encode("Hello  there", add_special_tokens=False).ids
