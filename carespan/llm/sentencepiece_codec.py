"""SentencePiece encoding and decoding with the tokenizers library.

The model file is read as what it is, a protobuf message, and rebuilt as a tokenizers
pipeline: its normaliser, the marker for spaces, unigram scores or the merges that its
BPE scores imply, and byte fallback. No piece has a marker behind another character
(checked when a model is read), so a text is cut before its markers, and parts that have
come before are not encoded again. Each new part is encoded with the sentencepiece
library too: a part on which the two differ is counted, and takes that library's ids.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carespan.llm.common import kept_text
from carespan.llm.word_cache import FIRST, WordCache, part_encoder

MARKER = "▁"
#: kinds of pieces and models, as the message numbers them (fixed values)
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: numbers of the message's fields (fixed values)
PIECES, TRAINER, NORMALIZER = 1, 2, 3
MODEL_TYPE, BYTE_FALLBACK = 3, 35
CHARSMAP, DUMMY_PREFIX, EXTRA_SPACES, ESCAPE_SPACES = 2, 3, 4, 5
ADDED = T.StructType(
    [
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("n_tokens", T.IntegerType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("round_trip", T.BooleanType()),
        T.StructField("parity", T.BooleanType()),
    ]
)
_PART = re.compile(f"{MARKER}*[^{MARKER}]+|{MARKER}+")


def fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(message):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, message[at : at + size]
        at += size


@dataclass
class PieceModel:
    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    model_type: int
    byte_fallback: bool
    charsmap: bytes
    dummy_prefix: bool
    one_space: bool  # runs of spaces become one, those at the ends none

    @classmethod
    def parse(cls, message: bytes) -> PieceModel:
        pieces, parts = [], {TRAINER: {}, NORMALIZER: {}}
        for number, value in fields(message):
            if number == PIECES:
                piece = dict(fields(value))
                score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                pieces.append((piece[1].decode(), score, piece.get(3, NORMAL)))
            elif number in parts:
                parts[number] = dict(fields(value))
        trainer, normal = parts[TRAINER], parts[NORMALIZER]
        model = cls(
            *map(list, zip(*pieces, strict=True)),
            model_type=trainer.get(MODEL_TYPE, UNIGRAM),
            byte_fallback=bool(trainer.get(BYTE_FALLBACK, 0)),
            charsmap=normal.get(CHARSMAP, b""),
            dummy_prefix=bool(normal.get(DUMMY_PREFIX, 1)),
            one_space=bool(normal.get(EXTRA_SPACES, 1)),
        )
        if model.model_type not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are rebuilt")
        if not normal.get(ESCAPE_SPACES, 1) or any(re.search(f"[^{MARKER}]{MARKER}", p) for p in model.pieces):
            raise ValueError("a model whose pieces go on after a space cannot be cut at spaces")
        if USER_DEFINED in model.kinds:
            raise ValueError("user-defined pieces are not rebuilt")
        return model

    @property
    def unknown(self) -> int:
        return self.kinds.index(UNKNOWN)

    def normalizer(self) -> Callable[[str], str]:
        """Text to what is cut into pieces, with markers for spaces."""
        from tokenizers import normalizers

        mapped = normalizers.Precompiled(self.charsmap).normalize_str if self.charsmap else str

        def run(text: str) -> str:
            text = mapped(text)
            if self.one_space:
                text = re.sub(" +", " ", text).strip(" ")
            if not text:
                return ""
            return (MARKER if self.dummy_prefix else "") + text.replace(" ", MARKER)

        return run

    def merges(self) -> list[tuple[str, str]]:
        """Every way to put a piece together from two, best piece first."""
        usable = {p for p, k in zip(self.pieces, self.kinds, strict=True) if k == NORMAL}
        order = sorted(range(len(self.pieces)), key=lambda i: (-self.scores[i], i))
        out = []
        for i in order:
            p = self.pieces[i]
            if self.kinds[i] == NORMAL:
                out += [(p[:k], p[k:]) for k in range(1, len(p)) if p[:k] in usable and p[k:] in usable]
        return out

    def tokenizer(self):
        """The tokenizers pipeline, for text that is normalised already."""
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        # control pieces stand for nothing that a text can hold
        named = [p if k in (NORMAL, BYTE, UNKNOWN) else f"\x00{i}" for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True))]
        if self.model_type == BPE:
            model = models.BPE(
                vocab={p: i for i, p in enumerate(named)}, merges=self.merges(),
                unk_token=self.pieces[self.unknown], fuse_unk=True, byte_fallback=self.byte_fallback,
            )
        else:
            model = models.Unigram(list(zip(named, self.scores, strict=True)), self.unknown, self.byte_fallback)
        t = Tokenizer(model)
        t.pre_tokenizer = pre_tokenizers.Split(Regex(_PART.pattern), "isolated")
        return t

    def piece_bytes(self) -> list[bytes]:
        """The bytes that each id stands for in a decoded text, markers as spaces."""
        out = []
        for p, k in zip(self.pieces, self.kinds, strict=True):
            if k == BYTE:
                out.append(bytes([int(p[3:5], 16)]))
            elif k == UNKNOWN:
                out.append(" ⁇ ".encode())
            else:
                out.append(b"" if k == CONTROL else p.replace(MARKER, " ").encode())
        return out


def split_pieces(normalized: str) -> list[str]:
    """Keys of the parts of a normalised text, cut before each run of markers."""
    plain = normalized[:1] == MARKER != normalized[-1:]
    if plain and MARKER * 2 not in normalized and FIRST not in normalized:
        return normalized[1:].split(MARKER)
    own = (MARKER, FIRST)  # a key that begins with either would be read as another
    parts = _PART.findall(normalized)
    return [p[1:] if p[0] == MARKER and p[1:] and p[1] not in own else FIRST + p for p in parts]


class Codec:
    """Encodes and decodes whole texts; one a Python worker."""

    def __init__(self, message: bytes) -> None:
        import sentencepiece

        self.model = PieceModel.parse(message)
        self.normalize = self.model.normalizer()
        self.bytes = self.model.piece_bytes()
        self.dtype = np.dtype("<u2" if len(self.bytes) <= 1 << 16 else "<u4")
        self.differing: set[str] = set()
        reference = sentencepiece.SentencePieceProcessor()
        reference.LoadFromSerializedProto(message)
        self.reference = reference
        # in normalised text a marker is 3 bytes, in decoded text a space is 1
        sizes = np.array([1 if k == BYTE else len(p.encode()) for p, k in zip(self.model.pieces, self.model.kinds, strict=True)])
        sizes[self.model.unknown] = 1 << 40  # stands for any length: such parts are encoded alone
        encode = part_encoder(self.model.tokenizer(), self.dtype, sizes, lambda p: p[0] == MARKER and p[-1] != MARKER)

        #: a model with other settings would change a part that stands alone
        self.compared = bool(self.model.dummy_prefix and not self.model.charsmap and not self.model.one_space)

        def verified(parts: list[str]) -> list[bytes]:
            out = encode(parts)
            if not self.compared:
                return out
            texts = [p[1:].replace(MARKER, " ") for p in parts]
            for i, ids in enumerate(reference.encode(texts, num_threads=1)):
                wanted = np.array(ids, self.dtype).tobytes()
                if texts[i] and parts[i][0] == MARKER and wanted != out[i]:
                    self.differing.add(parts[i])
                    out[i] = wanted
            return out

        self.words = WordCache(split_pieces, verified, self.dtype, MARKER)

    def encode(self, texts: list[str]) -> tuple[list[str], list[bytes]]:
        """Normalised texts and their ids, as bytes."""
        normalized = [self.normalize(t) for t in texts]
        return normalized, list(self.words.encode(normalized))

    def decode(self, ids: bytes) -> str:
        """The text of ids, without the space that the dummy prefix put before it."""
        table = self.bytes
        raw = b"".join([table[i] for i in np.frombuffer(ids, self.dtype).tolist()])
        text = raw.decode("utf-8", "replace")
        return text[1:] if self.model.dummy_prefix and text[:1] == " " else text

    def differ(self, normalized: str) -> bool:
        """Whether a part of the text was one on which the libraries differ."""
        return bool(self.differing) and any(p in self.differing for p in _PART.findall(normalized))

    def parity(self, text: str, normalized: str, ids: bytes) -> bool:
        """Whether the library encodes the text alike; of whole texts where parts cannot be compared."""
        if self.compared:
            return not self.differ(normalized)
        return np.array(self.reference.encode(text, num_threads=1), self.dtype).tobytes() == ids


@lru_cache(maxsize=2)
def codec(path: str, threads: int) -> Codec:
    os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
    os.environ["RAYON_NUM_THREADS"] = str(threads)
    with open(path, "rb") as f:
        return Codec(f.read())


def encode_rows(docs: DataFrame, path: str, *, text: str = "text", threads: int = 2) -> DataFrame:
    """``docs`` with ids (array of int), n_tokens, ids_crc32, round_trip and parity.

    Every node needs the model file at ``path``. A null text is encoded as the empty
    text: no ids. ``round_trip``: decoding gives the normalised text back (never with an
    unknown character). ``parity``: both libraries encoded every part alike, or the whole
    text where the model's settings let no part stand alone. The new columns take the place
    of columns of the same names; all others pass through, whatever their names. A very long
    text is encoded whole, in parts; an empty table gives no rows.
    """
    names = ADDED.names
    rest = [c for c in docs.columns if c not in names]
    spare = "_".join(["text", *docs.columns])  # longer than any other name

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, threads)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                texts = [t or "" for t in b.column(spare).to_pylist()]
                normalized, ids = c.encode(texts)
                numbers = [np.frombuffer(x, c.dtype).astype("<u4") for x in ids]
                sizes = np.array([len(x) for x in numbers])
                flat = np.concatenate(numbers).view(np.int32) if numbers else np.zeros(0, np.int32)
                plain = (n.replace(MARKER, " ") for n in normalized)
                skip = 1 if c.model.dummy_prefix else 0
                yield pa.RecordBatch.from_arrays(
                    [
                        *(b.column(k) for k in rest),
                        pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat)),
                        pa.array(sizes.astype(np.int32)),
                        pa.array([zlib.crc32(x) for x in numbers], pa.int64()),
                        pa.array([c.decode(x) == p[skip:] for x, p in zip(ids, plain, strict=True)], pa.bool_()),
                        pa.array([c.parity(t, n, x) for t, n, x in zip(texts, normalized, ids, strict=True)], pa.bool_()),
                    ],
                    [*rest, *names],
                )

    rows = docs.select(*[F.col(f"`{c}`") for c in rest], kept_text(F.col(f"`{text}`")).alias(spare))
    return rows.mapInArrow(run, T.StructType([*rows.drop(spare).schema, *ADDED]))
