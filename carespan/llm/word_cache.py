"""Encoding with a table of words already encoded.

A pre-tokeniser cuts a text at word boundaries before anything is merged, so the parts
can be encoded one by one; most of them have come before. The parts of a group of texts
that are new are encoded in one call as one text. The table lives as long as its Python worker; a part that is not met
again within some hundred thousand new ones is forgotten.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np

#: a byte-level pre-tokeniser always begins a token at a space that a letter follows
WORD_START = re.compile(r" (?=[^\W\d_])")
ODD_SPACE = re.compile(r" (?![^\W\d_])")
#: a space and a whole run of letters, all of them Latin: no later letter may follow
LATIN_WORD = re.compile(r" [A-Za-zªµºÀ-ÖØ-öø-ɏ]+(?![^\W\d_]|[^\x00-\u024f])")
FIRST = "\0"  # begins the key of a part that no space of its own stands before
WORDS_KEPT = 300_000
GROUP_CHARS = 2_000_000
JOINED = 2_000  # new parts in one text


class WordCache:
    """Ids of whole texts, as bytes of ``dtype``, put together from parts.

    ``split`` cuts a text into keys; ``encode_parts`` gets the texts that keys stand for.
    A key stands for ``space`` and itself, or, after the sign FIRST, for what follows it.
    """

    def __init__(
        self,
        split: Callable[[str], list[str]],
        encode_parts: Callable[[list[str]], list[bytes]],
        dtype: np.dtype,
        space: str = " ",
    ) -> None:
        self.split, self.encode_parts, self.dtype, self.space = split, encode_parts, dtype, space
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def part(self, key: str) -> str:
        return key[1:] if key[:1] == FIRST else self.space + key

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        group: list[list[str]] = []
        size = 0
        for text in texts:
            group.append(self.split(text))
            size += len(text)
            if size >= GROUP_CHARS:
                yield from self._encode(group)
                group, size = [], 0
        yield from self._encode(group)

    def _encode(self, group: list[list[str]]) -> Iterator[bytes]:
        if len(self.known) > WORDS_KEPT:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        new = set().union(*group) - known.keys()
        met = new & older.keys()
        known.update((k, older[k]) for k in met)
        fresh = list(new - met)
        known.update(zip(fresh, self.encode_parts([self.part(k) for k in fresh]), strict=True))
        for keys in group:
            yield b"".join(map(known.__getitem__, keys))


def split_words(text: str) -> list[str]:
    """Keys of a text's words; a space that no letter follows stays inside a part."""
    words = text.split(" ") if ODD_SPACE.search(text) is None else WORD_START.split(text)
    words[0] = FIRST + words[0]
    return words


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 signs stand for themselves, the others, in order, for the
    characters from 256 on.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


def word_encoder(tokenizer, dtype: np.dtype) -> Callable[[list[str]], list[bytes]]:
    """Encodes parts with a byte-level tokenizer, and its words with its model alone.

    A space with Latin letters is one token of the pre-tokeniser, which the model can
    merge at once; what stands behind it, and any other part, goes through the whole
    tokenizer. Words are kept by themselves as well, as many come again with other signs
    behind them.
    """
    letters, merge = byte_letters(), tokenizer.model.tokenize
    merged: dict[str, bytes] = {"": b""}  # by a space and letters, as in LATIN_WORD

    def encode(parts: list[str]) -> list[bytes]:
        if len(merged) > WORDS_KEPT:
            merged.clear()
            merged[""] = b""
        found = map(LATIN_WORD.match, parts)
        heads = [m[0] if m else "" for m in found]
        tails = [p[len(h) :] for p, h in zip(parts, heads, strict=True)]
        new = list(set(heads) - merged.keys())
        # the line feeds between the words become letters too
        spelled = "\n".join(new).encode().decode("latin-1").translate(letters).split(letters[10])
        for head, word in zip(new, spelled, strict=False):
            merged[head] = array(dtype.char, [t.id for t in merge(word)]).tobytes()
        other = list({t for t in tails if t})
        encoded = tokenizer.encode_batch_fast(other, add_special_tokens=False)
        known = {t: np.array(e.ids, dtype).tobytes() for t, e in zip(other, encoded, strict=True)}
        known[""] = b""
        return [merged[h] + known[t] for h, t in zip(heads, tails, strict=True)]

    return encode


def part_encoder(
    tokenizer, dtype: np.dtype, sizes: np.ndarray, follows: Callable[[str], object]
) -> Callable[[list[str]], list[bytes]]:
    """Encodes parts, many at a time as one text; the ids' bytes tell where a part ends.

    ``sizes``: bytes of text of each id. ``follows``: whether a part can stand behind
    another without changing either.
    """
    width = dtype.itemsize

    def one_by_one(parts: list[str]) -> list[bytes]:
        found = tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        return [np.array(e.ids, dtype).tobytes() for e in found]

    def cut(parts: list[str], ids: list[int]) -> list[bytes]:
        ids = np.array(ids, np.int64)
        reached = np.cumsum(sizes[ids])
        ends = np.cumsum([len(p.encode()) for p in parts])
        at = np.searchsorted(reached, ends)
        if not len(ids) or at[-1] >= len(ids) or (reached[at] != ends).any():
            return one_by_one(parts)
        raw, stops = ids.astype(dtype).tobytes(), ((at + 1) * width).tolist()
        return [raw[a:b] for a, b in zip([0, *stops], stops, strict=False)]

    def encode(parts: list[str]) -> list[bytes]:
        words = {p: b"" for p in parts if follows(p)}
        others = [p for p in parts if p not in words]
        line = list(words)
        groups = [line[at : at + JOINED] for at in range(0, len(line), JOINED)]
        found = tokenizer.encode_batch_fast(["".join(g) for g in groups], add_special_tokens=False)
        for group, e in zip(groups, found, strict=True):
            words.update(zip(group, cut(group, e.ids), strict=True))
        words.update(zip(others, one_by_one(others), strict=True))
        return [words[p] for p in parts]

    return encode


@lru_cache(maxsize=2)
def of_tokenizer(path: str) -> WordCache:
    """For a byte-level tokenizers file; one table a worker."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True  # special strings in a text are plain text
    dtype = np.dtype("<u2" if t.get_vocab_size() <= 1 << 16 else "<u4")
    return WordCache(split_words, word_encoder(t, dtype), dtype)
