"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary text and one on the passages that
set toxic text apart, which is laid after the ordinary one. A window of a document is
compressed with each; the bytes that the toxic dictionary saves are the window's gain.
Ordinary windows gain next to nothing, windows with toxic passages a few bytes. How many
windows pass each of a row of gains is turned into a score, fitted on documents that the
dictionaries have not seen; 0.5 is where the two classes part best.

A very long text is scored whole, in batches of windows. An empty table has no scores.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carespan.llm.common import id_remainder, keep_rows, labelled_texts, score_texts

WINDOW, STRIDE = 64, 32  # bytes
GRAM = 4  # bytes of the sequences that tell toxic from ordinary text
ORDINARY_BYTES, TOXIC_BYTES = 16_384, 8_192  # of the dictionaries
GAINS = (2, 3, 4, 5, 6, 7, 8, 10)  # bytes saved; shares of windows beyond are features
BATCH = 20_000  # windows compressed in one call
_SPACE = re.compile(rb"[\x00-\x20]+")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def plain(text: bytes) -> bytes:
    """Lower case, single spaces, a space at either end."""
    return b" " + _SPACE.sub(b" ", text.translate(_LOWER)).strip() + b" "


def sequences(text: bytes) -> np.ndarray:
    """Every GRAM bytes in a row, as a number."""
    a = np.frombuffer(text, np.uint8).astype(np.uint64)
    n = max(0, len(a) - GRAM + 1)
    out = np.zeros(n, np.uint64)
    for i in range(GRAM):
        out = (out << np.uint64(8)) | a[i : i + n]
    return out


def document_counts(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    each = [np.unique(sequences(t)) for t in texts]
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *each]), return_counts=True)


def telling(toxic: Sequence[bytes], ordinary: Sequence[bytes], *, share: float = 0.004, times: float = 8.0) -> np.ndarray:
    """Sequences in a share of the toxic texts, and that many times rarer in ordinary ones."""
    seen, counts = document_counts(toxic)
    known, others = document_counts(ordinary)
    at = np.searchsorted(known, seen).clip(0, max(len(known) - 1, 0))
    other = np.where(known[at] == seen, others[at], 0) if len(known) else np.zeros(len(seen))
    keep = (counts >= max(3, share * len(toxic))) & (
        counts / len(toxic) > times * (other + 0.5) / max(len(ordinary), 1)
    )
    return seen[keep]


def passages(texts: Sequence[bytes], told: np.ndarray) -> Counter[bytes]:
    """Runs of bytes that telling sequences cover, and how often each comes."""
    found: Counter[bytes] = Counter()
    for t in texts:
        hits = np.isin(sequences(t), told)
        covered = np.zeros(len(t) + 2, bool)
        for i in range(GRAM):
            covered[1 + i : 1 + i + len(hits)] |= hits
        edges = np.flatnonzero(covered[1:] != covered[:-1])
        found.update(t[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
    return found


def trained(samples: list[bytes], size: int) -> bytes:
    """The content of a dictionary trained on all samples; their ends, if they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def ordinary_dictionary(texts: Sequence[bytes]) -> bytes:
    return trained([t[i : i + 256] for t in texts for i in range(0, len(t), 256)], ORDINARY_BYTES)


def toxic_dictionary(found: Counter[bytes]) -> bytes:
    """Trained on all passages, as often as they come, the commonest last."""
    line = sorted(found.items(), key=lambda x: (x[1], x[0]))
    return trained([p for p, n in line for _ in range(n)], TOXIC_BYTES)


def compressor(dictionary: bytes, level: int = 3) -> zstandard.ZstdCompressor:
    parameters = zstandard.ZstdCompressionParameters.from_level(
        level,
        format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        write_checksum=0,
        write_content_size=0,
        write_dict_id=0,
    )
    content = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(dict_data=content, compression_params=parameters)


def windows(text: bytes) -> list[bytes]:
    """Overlapping windows that cover the whole text; one for a short text."""
    return [text[i : i + WINDOW] for i in range(0, max(1, len(text) - WINDOW + STRIDE), STRIDE)]


@dataclass
class ToxicityModel:
    """Two dictionaries, and weights that turn gains into a score."""

    ordinary: bytes
    toxic: bytes
    weights: np.ndarray

    def gains(self, batch: list[bytes]) -> np.ndarray:
        sizes = []
        for dictionary in (self.ordinary, self.toxic):
            done = compressor(dictionary).multi_compress_to_buffer(batch, threads=1)
            sizes.append(np.fromiter((len(x) for x in done), np.int64, len(done)))
        return sizes[0] - sizes[1]

    def features(self, texts: Sequence[bytes]) -> np.ndarray:
        """Share of windows beyond each gain, mean gain, and the highest, of each text."""
        out = np.zeros((len(texts), len(GAINS) + 2))
        counts = np.zeros(len(texts))
        batch: list[bytes] = []
        owners: list[np.ndarray] = []

        def add() -> None:
            gain, owner = self.gains(batch), np.concatenate(owners)
            for k, g in enumerate(GAINS):
                out[:, k] += np.bincount(owner, gain >= g, len(texts))
            out[:, -2] += np.bincount(owner, np.maximum(gain, 0), len(texts))
            np.maximum.at(out[:, -1], owner, gain / 16)
            batch.clear()
            owners.clear()

        for i, t in enumerate(texts):
            own = windows(plain(t))
            counts[i] = len(own)
            for at in range(0, len(own), BATCH):
                part = own[at : at + BATCH]
                batch += part
                owners.append(np.full(len(part), i))
                if len(batch) >= BATCH:
                    add()
        if batch:
            add()
        # one window more than there are: a single hit in a short text is weaker evidence
        shares = out[:, :-1] / (counts[:, None] + 1)
        return np.column_stack([np.sqrt(shares), out[:, -1], np.ones(len(texts))])

    def scores(self, texts: Sequence[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-self.features(texts) @ self.weights)) if len(texts) else np.zeros(0)


def logistic(x: np.ndarray, y: np.ndarray, *, ridge: float = 0.05, steps: int = 30) -> np.ndarray:
    """Weights by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w += np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
    return w


def best_cut(margin: np.ndarray, y: np.ndarray) -> float:
    """The margin from which on calling a text toxic gives the best F1."""
    order = np.argsort(-margin, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    last = np.append(margin[order][1:] != margin[order][:-1], True)
    best = int(np.argmax(np.where(last, f1, -1)))
    after = margin[order][best + 1] if best + 1 < len(y) else margin[order][best] - 1
    return float((margin[order][best] + after) / 2)


def learn(examples: Sequence[tuple[bytes, int]]) -> ToxicityModel | None:
    """Dictionaries from two thirds of the examples, weights from the rest.

    None if the examples lack a class.
    """
    texts = sorted({plain(t): y for t, y in examples}.items())
    sides = {y: [t for t, label in texts if label == y] for y in (0, 1)}
    if min(len(s) for s in sides.values()) < 3:
        return None
    seen = {y: [t for i, t in enumerate(s) if i % 3] for y, s in sides.items()}
    fresh = [(t, y) for y, s in sides.items() for i, t in enumerate(s) if i % 3 == 0]
    ordinary = ordinary_dictionary(seen[0])
    toxic = toxic_dictionary(passages(seen[1], telling(seen[1], seen[0])))
    model = ToxicityModel(ordinary, ordinary + toxic, np.zeros(0))
    y = np.array([label for _, label in fresh], float)
    x = model.features([t for t, _ in fresh])
    model.weights = logistic(x, y)
    model.weights[-1] -= best_cut(x @ model.weights, y)
    return model


def score_toxicity(docs: DataFrame, labels: DataFrame, *, per_class: int = 4_000, fold: int = 5) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    The model is fitted on a bounded sample of labelled rows out of the held-out fold.
    A null text is scored as the empty text. Without labels of both kinds nothing is
    known: every score is 0. Equal texts get equal scores.
    """
    model = learn(labelled_texts(docs, labels, "toxic", fold=fold, per_class=per_class))
    score = model.scores if model else (lambda texts: np.zeros(len(texts)))
    return score_texts(docs, score).select(
        F.col("key").alias("doc_id"),
        (id_remainder(F.col("key"), fold) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, *, per_class: int = 4_000) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is not called toxic."""
    model = learn(labelled_texts(docs, labels, "toxic", per_class=per_class))
    if model is None:
        return docs
    return keep_rows(docs, lambda texts: model.scores(texts) < 0.5)
