"""Encoding and decoding against the library itself."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from pyspark.sql import functions as F

from convforge.llm import piece_codec, queries

MODEL = path("piece_bpe_32k.model")
SP = sentencepiece.SentencePieceProcessor(model_file=MODEL)
with open(MODEL, "rb") as f:
    CHUNKS = piece_codec.Chunks(f.read())

ODD = ["", " ", "  ", "   ", "▁", "▁▁x", " a", "a ", "a  b", "a   b  ", "\n", "\n\n", " \n ", "a\nb", "a \n b", "\n a",
       "a\t\tb", "\r\n x\r", "中文字 中 文", "x中y", "é ß é", "\U0001F600\U0001F600 a", "\x00a\x00 \x01", "<s> </s> <0x0A> <unk>",
       "ﬁ Ａ 　 \xa0 ﻿", "(){};\r\n    return  x;\n\n\t}", "a" * 3000, "ab " * 2000, "中文" * 60 + "ab 中" * 3,
       "    " + "中" * 90, "x" * 60 + "\u3042" * 3 + "y", " ,a, b ,,c.. ... .....d. ,. \n, ,\n.", "...." * 9 + ",;:!?)" * 5, "a ,b\t,c", "\n" * 50 + " " * 40 + "z"]


def whole(text):
    """Ids of a text by its chunks, one after the other."""
    out = []
    for packed in CHUNKS.segment(CHUNKS.cut(text)):
        out += [int(x) for x in piece_codec.np.frombuffer(packed, dtype=CHUNKS.dtype)]
    return out


@pytest.mark.parametrize("text", ODD)
def test_chunks_of_odd_texts_equal_the_library(text):
    assert whole(text) == SP.encode(text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from(list(" ▁\n\t\rabcthe,.(){};\"'/*>中é́\U0001F600\x00\x01Ж!?:9")), max_size=140)
       | st.text(max_size=40))
def test_chunks_of_any_text_equal_the_library(text):
    assert whole(text) == SP.encode(text)


SURFACES = piece_codec.Surfaces(SP.serialized_model_proto())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 300) | st.integers(0, SP.get_piece_size() - 1) | st.just(2), max_size=12), max_size=4))
def test_any_ids_decode_as_the_library_does(lists):
    got = SURFACES.decode(piece_codec.pa.array(lists, piece_codec.pa.list_(piece_codec.pa.int32())))
    assert got.to_pylist() == [SP.decode(i) for i in lists]


def expected(rows, keep):
    return sorted(((k, SP.encode(t or "") + [SP.eos_id()]) for k, t in rows), key=str) if keep else None


@pytest.mark.parametrize("frequent", [0, 40, piece_codec.MAX_FREQUENT])
def test_rows_equal_the_library_whichever_way_a_chunk_takes(spark, frequent):
    """No chunk, few chunks or all frequent ones in the broadcast table; copies of a text."""
    rng = random.Random(3)
    words = ["w%d" % i for i in range(300)] + ODD[:20]
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, None), (5, None), (5, "")]
    rows += [(100 + i, " ".join(rng.choice(words) for _ in range(rng.randrange(80)))) for i in range(60)]
    rows += [(200 + i, "=" * 400 + " or %d " % (i % 3) + "=" * 400) for i in range(40)]
    rows += [(300 + i, "copies of one text with rareword%d" % (i % 2)) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = piece_codec.encode(df, MODEL, frequent=frequent)
    assert sorted(((r["doc_id"], r["ids"]) for r in got.collect()), key=str) == expected(rows, True)
    back = piece_codec.decode(got, MODEL).collect()
    assert sorted(((r["doc_id"], r["decoded"]) for r in back), key=str) == \
        sorted(((k, SP.decode(SP.encode(t or ""))) for k, t in rows), key=str)


def test_awkward_rows(awkward, nothing):
    rows = [(r["doc_id"], r["text"]) for r in awkward.select("doc_id", "text").collect()]
    got = piece_codec.encode(awkward, MODEL, keep=("doc_id", "score", "n_chars"))
    assert got.columns == ["doc_id", "score", "n_chars", "ids"]
    assert sorted(((r["doc_id"], r["ids"]) for r in got.collect()), key=str) == expected(rows, True)
    assert piece_codec.decode(piece_codec.encode(nothing, MODEL), MODEL).count() == 0
    clash = awkward.select(F.col("doc_id").alias("ids"), "text", F.lit(1).alias("_text"), F.lit(2).alias("_key"))
    assert piece_codec.encode(clash.withColumnRenamed("ids", "_codes"), MODEL, keep=("_codes", "_key")).count() == 12
    bare = piece_codec.encode(awkward, MODEL, keep=(), end_id=False)
    assert sorted(map(str, (r["ids"] for r in bare.collect()))) == sorted(str(SP.encode(t or "")) for _, t in rows)


def test_bytes_that_are_no_utf8(spark):
    df = spark.sql("select 1L as doc_id, cast(unhex('61FF62') as string) as text")
    assert piece_codec.encode(df, MODEL).head()["ids"] == SP.encode("a�b") + [SP.eos_id()]


def test_query_equals_the_library(spark, small_docs):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = set()
    for r in small_docs.select("doc_id", "text").collect():
        ids = SP.encode(r["text"] or "", add_eos=True)
        want.add((r["doc_id"], len(ids), sha(" ".join(map(str, ids))), sha(SP.decode(ids))))
    got = queries.QUERIES["op11_sentencepiece"](spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_codes_survive_packing():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 3000):
        codes = rng.integers(0, 10 ** rng.integers(1, 7, n)).clip(max=piece_codec.MAX_FREQUENT + 1)
        assert (piece_codec._unpack(piece_codec._pack(codes)) == codes).all()
    edge = np.array([0, 149, 150, 149 + 96 * 256, 150 + 96 * 256, piece_codec.MAX_FREQUENT + 1])
    assert (piece_codec._unpack(piece_codec._pack(edge)) == edge).all()
