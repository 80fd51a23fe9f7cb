"""Quality by attention over passages (multiple-instance learning).

Only documents are labelled, but what makes one poor is often one part of it. So every
passage of a text is encoded, gated attention says how much each counts, and the
weighted mean of the passages is what is scored. Attention and score are learned
together from the labels of whole documents.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carespan.llm.common import id_remainder, keep_rows, labelled_texts, score_texts

PASSAGE = 600  # bytes
HIDDEN, GATE = 24, 12  # width of a passage's code, and of its attention
CUT = 0.3  # score from which on a document is called good
PASSAGES_AT_ONCE = 20_000


def byte_classes() -> np.ndarray:
    """Which of 14 kinds each byte is."""
    kinds = np.full(256, 13, np.uint8)  # other signs
    groups = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\r\n", ".", ",;:", "!", "?", "|", "*&$#%", "'\"-()")
    for k, group in enumerate(groups):
        kinds[list(group.encode())] = k
    kinds[128:] = 12
    return kinds


CLASSES = byte_classes()
N_CLASSES = 14
N_FEATURES = N_CLASSES * N_CLASSES + 6


def passage_features(text: bytes) -> np.ndarray:
    """A row for each passage; the passages cover the text, and an empty text has one.

    Shares of the pairs of neighbouring byte kinds, and how far words repeat, vary and
    are long, in the passage and, for repeats, over passages.
    """
    a = CLASSES[np.frombuffer(text, np.uint8)].astype(np.int64)
    n = max(1, -(-len(a) // PASSAGE))
    out = np.zeros((n, N_FEATURES), np.float32)
    if len(a) > 1:
        place = np.arange(len(a) - 1) // PASSAGE
        pairs = (place * N_CLASSES + a[:-1]) * N_CLASSES + a[1:]
        counts = np.bincount(pairs, minlength=n * N_CLASSES**2).reshape(n, -1)
        out[:, : N_CLASSES**2] = np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1))
    before: set[bytes] = set()
    for i in range(n):
        words = text[i * PASSAGE : (i + 1) * PASSAGE].lower().split()
        kinds = set(words)
        w = max(len(words), 1)
        same = sum(map(bytes.__eq__, words[1:], words))
        out[i, N_CLASSES**2 :] = (
            same / w, len(kinds) / w, len(kinds & before) / max(len(kinds), 1),
            len(words) / 100, np.log1p(max(map(len, words), default=0)), np.log1p(n),
        )
        before = kinds
    return out


def segment_softmax(a: np.ndarray, starts: np.ndarray, owner: np.ndarray) -> np.ndarray:
    e = np.exp(a - np.maximum.reduceat(a, starts)[owner])
    return e / np.add.reduceat(e, starts)[owner]


@dataclass
class AttentionModel:
    """tanh encoder, gated attention and a logistic score; all weights in ``w``."""

    mean: np.ndarray
    scale: np.ndarray
    w: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def new(cls, x: np.ndarray, seed: int = 7) -> AttentionModel:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
        w = {
            "encode": draw(x.shape[1], HIDDEN), "encode0": np.zeros(HIDDEN),
            "value": draw(HIDDEN, GATE), "gate": draw(HIDDEN, GATE), "attend": draw(GATE),
            "score": draw(HIDDEN), "score0": np.zeros(1),
        }
        return cls(x.mean(0), x.std(0) + 0.02, w)

    def forward(self, x: np.ndarray, starts: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, dict]:
        w = self.w
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        h = np.tanh(z @ w["encode"] + w["encode0"])
        t, g = np.tanh(h @ w["value"]), 1 / (1 + np.exp(-(h @ w["gate"])))
        alpha = segment_softmax((t * g) @ w["attend"], starts, owner)
        pooled = np.add.reduceat(alpha[:, None] * h, starts)
        p = 1 / (1 + np.exp(-np.clip(pooled @ w["score"] + w["score0"], -30, 30)))
        return p, {"z": z, "h": h, "t": t, "g": g, "alpha": alpha, "pooled": pooled}

    def gradients(self, x, starts, owner, y) -> dict[str, np.ndarray]:
        w = self.w
        p, c = self.forward(x, starts, owner)
        d = (p - y) / len(y)  # of the margin, by document
        d_pooled = d[:, None] * w["score"]
        d_h = c["alpha"][:, None] * d_pooled[owner]
        d_alpha = (c["h"] * d_pooled[owner]).sum(1)
        inner = np.add.reduceat(c["alpha"] * d_alpha, starts)[owner]
        d_a = c["alpha"] * (d_alpha - inner)
        d_tg = d_a[:, None] * w["attend"]
        d_t = d_tg * c["g"] * (1 - c["t"] ** 2)
        d_g = d_tg * c["t"] * c["g"] * (1 - c["g"])
        d_h = d_h + d_t @ w["value"].T + d_g @ w["gate"].T
        d_u = d_h * (1 - c["h"] ** 2)
        return {
            "encode": c["z"].T @ d_u, "encode0": d_u.sum(0), "value": c["h"].T @ d_t,
            "gate": c["h"].T @ d_g, "attend": (c["t"] * c["g"]).T @ d_a,
            "score": c["pooled"].T @ d, "score0": d.sum(keepdims=True),
        }

    def fit(self, x, sizes, y, *, epochs: int = 12, batch: int = 256, rate: float = 0.01, decay: float = 1e-4, seed: int = 7) -> None:
        """Adam over batches of documents."""
        rng, step = np.random.default_rng(seed), 0
        firsts = np.cumsum(sizes) - sizes
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        s = {k: np.zeros_like(v) for k, v in self.w.items()}
        for _ in range(epochs):
            line = rng.permutation(len(y))
            for at in range(0, len(line), batch):
                some = line[at : at + batch]
                rows = np.concatenate([np.arange(firsts[i], firsts[i] + sizes[i]) for i in some])
                starts, owner = layout(sizes[some])
                step += 1
                for k, d in self.gradients(x[rows], starts, owner, y[some]).items():
                    d = d + decay * self.w[k]
                    m[k] = 0.9 * m[k] + 0.1 * d
                    s[k] = 0.99 * s[k] + 0.01 * d * d
                    bias = np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
                    self.w[k] = self.w[k] - rate * bias * m[k] / (np.sqrt(s[k]) + 1e-8)

    def scores(self, texts: Sequence[bytes]) -> np.ndarray:
        out: list[np.ndarray] = []
        batch: list[np.ndarray] = []
        size = 0
        for t in [*texts, None]:
            if batch and (t is None or size >= PASSAGES_AT_ONCE):
                x = np.concatenate(batch).astype(np.float64)
                out.append(self.forward(x, *layout(np.array([len(b) for b in batch])))[0])
                batch, size = [], 0
            if t is not None:
                batch.append(passage_features(t))
                size += len(batch[-1])
        return np.concatenate(out) if out else np.zeros(0)


def layout(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each document's passages start, and whose each passage is."""
    return np.cumsum(sizes) - sizes, np.repeat(np.arange(len(sizes)), sizes)


def learn(examples: Sequence[tuple[bytes, int]]) -> AttentionModel | None:
    """None if the examples lack a class."""
    examples = sorted(examples)
    y = np.array([label for _, label in examples], float)
    if not len(y) or y.min() == y.max():
        return None
    each = [passage_features(t) for t, _ in examples]
    x = np.concatenate(each).astype(np.float64)
    model = AttentionModel.new(x)
    model.fit(x, np.array([len(e) for e in each]), y)
    return model


def score_quality(docs: DataFrame, labels: DataFrame, *, per_class: int = 3_000, fold: int = 5) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    The model is fitted on a bounded sample of labelled rows out of the held-out fold.
    A null text is scored as the empty text. Without labels of both kinds nothing is
    known against a text: every score is 1. Equal texts get equal scores.
    """
    model = learn(labelled_texts(docs, labels, "quality", fold=fold, per_class=per_class))
    score = model.scores if model else (lambda texts: np.ones(len(texts)))
    return score_texts(docs, score).select(
        F.col("key").alias("doc_id"),
        (id_remainder(F.col("key"), fold) == 0).alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )


def without_poor(docs: DataFrame, labels: DataFrame, *, per_class: int = 3_000) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores CUT or more."""
    model = learn(labelled_texts(docs, labels, "quality", per_class=per_class))
    if model is None:
        return docs
    return keep_rows(docs, lambda texts: model.scores(texts) >= CUT)
