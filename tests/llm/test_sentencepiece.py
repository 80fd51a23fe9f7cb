import struct

import numpy as np
import pytest
import sentencepiece
from data import documents, odd_texts, prose
from pyspark.sql import functions as F

from carespan.llm import sentencepiece_codec as c
from carespan.llm.common import tokenizer_file

PATH = tokenizer_file("piece_bpe_32k.model")
TEXTS = [
    *(t or "" for t in odd_texts()), " ", "  ", "  a", "a  b   c    d", "x" + " " * 40 + "y", "a▁b", "▁", "▁▁ x",
    "<0x0A> <s> </s> <unk>", "é 漢字 😀\x00\n\r\t", "l l  ll", "0123456789", "a" * 500, "a ", "a b ", "a\x00b \x00c",
]


def varint(n):
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def field(number, value):
    if isinstance(value, bytes):
        return varint(number << 3 | 2) + varint(len(value)) + value
    return varint(number << 3) + varint(value)


def unigram_model(byte_fallback, dummy_prefix=1, one_space=0):
    """A small unigram model, written by hand."""
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    if byte_fallback:
        pieces += [(f"<0x{i:02X}>", -30.0, 6) for i in range(256)]
    scored = {"▁": -2.0, "▁th": -3.1, "▁the": -3.0, "he": -3.7, "e": -4.1, "t": -4.2, "h": -4.3, "in": -3.9, "ing": -3.8,
              "i": -4.5, "n": -4.6, "g": -4.7, "▁of": -3.3, "o": -4.4, "f": -5.1, "er": -3.6, "r": -5.2}
    pieces += [(p, s, 1) for p, s in scored.items()]
    body = b"".join(
        field(1, field(1, p.encode()) + varint(2 << 3 | 5) + struct.pack("<f", s) + field(3, k)) for p, s, k in pieces
    )
    trainer = field(3, 1) + field(35, byte_fallback)
    normal = field(1, b"identity") + field(3, dummy_prefix) + field(4, one_space) + field(5, 1)
    return body + field(2, trainer) + field(3, normal)


def reference(message):
    r = sentencepiece.SentencePieceProcessor()
    r.LoadFromSerializedProto(message)
    return r


def same_ids(message, texts):
    codec, ref = c.Codec(message), reference(message)
    normalized, ids = codec.encode(texts)
    for t, x in zip(texts, ids, strict=True):
        assert np.frombuffer(x, codec.dtype).tolist() == ref.encode(t), t[:60]
    return codec, normalized, ids


def test_bpe_model_as_the_library():
    with open(PATH, "rb") as f:
        codec, normalized, ids = same_ids(f.read(), TEXTS)
    assert not codec.differing
    for t, x in zip(TEXTS, ids, strict=True):
        assert codec.decode(x) == t.replace("▁", " ")
    ref = sentencepiece.SentencePieceProcessor(model_file=PATH)
    plain = ["the cat", "é 漢字", "a\nb"]
    assert [codec.decode(x) for x in codec.encode(plain)[1]] == [ref.decode(ref.encode(p)) for p in plain]


@pytest.mark.parametrize("byte_fallback", [0, 1])
@pytest.mark.parametrize("dummy_prefix", [0, 1])
@pytest.mark.parametrize("one_space", [0, 1])
def test_unigram_model_as_the_library(byte_fallback, dummy_prefix, one_space):
    texts = ["", "the", "the thing of", "in the  er", " of ", "forthing ten", "nnggeerr"]
    if byte_fallback:
        texts += ["xyz the", "é"]
    same_ids(unigram_model(byte_fallback, dummy_prefix, one_space), texts)


def test_models_that_cannot_be_cut_are_refused():
    odd = field(1, field(1, "a▁b".encode())) + field(2, field(3, 2)) + field(3, b"")
    with pytest.raises(ValueError, match="space"):
        c.PieceModel.parse(odd)
    with pytest.raises(ValueError, match="unigram"):
        c.PieceModel.parse(field(1, field(1, b"a")) + field(2, field(3, 4)) + field(3, b""))


def test_rows(spark):
    texts = [None if i == 0 else t for i, t in enumerate(TEXTS)]
    df = documents(spark, texts).withColumns({"ids": F.lit("x"), "_other": F.lit("y"), "parity": F.lit("z")})
    df = df.union(df).repartition(3)
    got = c.encode_rows(df, PATH)
    assert sorted(got.columns) == sorted({*df.columns, *c.ADDED.names})
    ref = sentencepiece.SentencePieceProcessor(model_file=PATH)
    out = got.collect()
    assert len(out) == 2 * len(texts)
    for r in out:
        assert r.ids == ref.encode(texts[r.doc_id] or "")
        assert (r.n_tokens, r.round_trip, r.parity, r._other) == (len(r.ids), True, True, "y")
    assert c.encode_rows(documents(spark, []), PATH).count() == 0


def test_a_differing_part_takes_the_library_ids():
    with open(PATH, "rb") as f:
        codec = c.Codec(f.read())
    text = prose(1, 30)
    normalized, ids = codec.encode([text])
    codec.differing.add(c._PART.findall(normalized[0])[3])
    assert codec.differ(normalized[0]) and not codec.differ("▁zzz")


def test_parity_of_models_whose_parts_cannot_be_compared():
    """Whole texts are compared; a wrong encoding is told."""
    codec = c.Codec(unigram_model(1, dummy_prefix=0))
    assert not codec.compared
    texts = ["the thing", "", "of  the", "ringing"]
    normalized, ids = codec.encode(texts)
    assert [codec.parity(*x) for x in zip(texts, normalized, ids, strict=True)] == [True] * 4
    assert not codec.parity("the thing", normalized[0], ids[3])


def test_clashing_names(spark):
    df = documents(spark, ["the cat", None]).withColumns({n: F.lit(1) for n in ("_text", "text_", "row", "n_tokens")})
    got = c.encode_rows(df, PATH).orderBy("doc_id").collect()
    assert [r["_text"] for r in got] == [1, 1] and got[0].n_tokens > 1 and got[1].n_tokens == 0
