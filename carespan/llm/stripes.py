"""Phrases whose words belong together, counted by stripes.

The stripe of a prefix of two words counts the words that come next; what comes after is
also counted where it is the end of a piece or a word that is in no candidate (OTHER). So
one structure, merged element by element, holds the counts of three-word phrases (its
entries), of two-word phrases (its total), and the largest count of a phrase that a prefix
begins (its largest entry), which decides whether the prefix is dropped.

Words are numbers in the stripes: their 64-bit digests, which are proven to differ, and
turned into text for the phrases that are left. Stripes of a task's texts that go to the
same bucket are packed into one row, and a bucket is merged in one task; there are buckets
for so many words each, so that none grows with the corpus. The stripe of a prefix whose
words are both very frequent is dealt over buckets by its next words, so no stripe has to
be whole in one place; its totals are added up afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carespan.sources.staging import stage, stage_and_measure

LEAST = 10  # occurrences of a candidate
SUBSUMED = (50, 100)  # share of its occurrences inside a longer candidate that drops a phrase
SCORE = 1_000_000
BEST = 2000  # phrases reported for a language
SLICE = 8 << 20  # bytes of text that are counted together
BUCKET_WORDS = 500_000  # word occurrences for each bucket
HOT_WORD = 1_000_000  # occurrences of a word whose stripes may be dealt out
SHARDS = 64  # of a stripe that is dealt out
MARK_BITS = (16, 28)  # bits of a set of marks for each word in it, and at most, as a power of 2
OTHER = 0  # the next word of an end, or of a word that is in no candidate
_SIGNS = b".,;:!?\x0a\x0b\x0c\x0d"
_PLAIN = bytes.maketrans(bytes(range(65, 91)) + _SIGNS + b"\t", bytes(range(97, 123)) + b"\n" * len(_SIGNS) + b" ")


def tokens(texts: list[bytes]) -> pa.DictionaryArray:
    """The words of all texts in lower case, with a line feed between pieces."""
    line = b"\n".join(t.translate(_PLAIN) for t in texts).replace(b"\n", b" \n ")
    parts = pc.split_pattern(pa.array([line], pa.large_binary()).cast(pa.large_string()), " ")
    return pc.list_flatten(parts).dictionary_encode()


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Texts of one language, SLICE bytes at a time; a longer text stands alone."""
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for b in batches:
        texts = b.column("text").cast(pa.binary())
        for lang, text in zip(b.column("lang").to_pylist(), texts, strict=True):
            held.setdefault(lang, []).append(text.as_py())
            sizes[lang] = sizes.get(lang, 0) + len(held[lang][-1])
            if sum(sizes.values()) >= SLICE:
                largest = max(sizes, key=sizes.get)
                yield largest, held.pop(largest)
                del sizes[largest]
    yield from held.items()


def word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to (lang, word, n) of each slice."""
    for lang, texts in slices(batches):
        found = tokens(texts)
        words = found.dictionary.cast(pa.string())
        n = np.bincount(found.indices.to_numpy(), minlength=len(words))
        rows = pa.RecordBatch.from_arrays([pa.repeat(lang, len(words)), words, pa.array(n)], ["lang", "word", "n"])
        yield rows.filter(pc.invert(pc.is_in(words, pa.array(["", "\n"]))))


def scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Marks:
    """A set of words in a bounded number of bits; it may hold others, too."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def holds(self, ids: np.ndarray) -> np.ndarray:
        place = ids.view(np.uint64) % np.uint64(64 * len(self.bits))
        return (self.bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def marks(words: DataFrame, n: int) -> Marks:
    """The marks of the ``n`` words; at most 2^28 bits come to the driver and go out with tasks."""
    size = 1 << min(MARK_BITS[1], max(6, int(MARK_BITS[0] * n).bit_length()))
    place = F.col("id").bitwiseAND(F.lit(size - 1).cast("long"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63).cast("long")).cast("int"))
    rows = words.groupBy(F.shiftright(place, 6).alias("at")).agg(F.bit_or(bit).alias("bits")).toArrow()
    bits = np.zeros(size // 64, np.uint64)
    bits[rows.column("at").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return Marks(bits)


STRIPES = "lang string, dealt boolean, bucket long, first binary, second binary, sizes binary, next binary, n binary"


def stripe_rows(frequent: Marks, hot: Marks, buckets: int, salt: bytes):
    """(lang, text) to the stripes of each slice, packed by bucket.

    A row holds its prefixes (first, second), how many entries each has, and the entries.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in slices(batches):
            found = tokens(texts)
            words = found.dictionary.cast(pa.large_binary()).to_pylist()
            ids = np.array([xxhash.xxh64_intdigest(w + salt, 42) for w in words], np.uint64).view(np.int64)
            at = found.indices.to_numpy().astype(np.int64)
            empty, end = (words.index(w) if w in words else -1 for w in (b"", b"\n"))
            at = at[at != empty]
            piece = np.cumsum(at == end)
            piece, at = piece[at != end], at[at != end]
            good = frequent.holds(ids)[at]
            prefix = np.flatnonzero((piece[1:] == piece[:-1]) & good[1:] & good[:-1])
            if not len(prefix):
                continue
            after = np.minimum(prefix + 2, len(at) - 1)
            goes_on = (prefix + 2 < len(at)) & (piece[after] == piece[prefix]) & good[after]
            # prefixes by rank, entries by prefix and next word; no word has the last number
            two, rank = np.unique(at[prefix] * len(words) + at[prefix + 1], return_inverse=True)
            entry, n = np.unique(rank * (len(words) + 1) + np.where(goes_on, at[after], len(words)), return_counts=True)
            rank, nxt = entry // (len(words) + 1), entry % (len(words) + 1)
            first, second = two[rank] // len(words), two[rank] % len(words)
            is_hot = hot.holds(ids)
            dealt = is_hot[first] & is_hot[second]
            first, second, nxt = ids[first], ids[second], np.append(ids, OTHER)[nxt]
            yield packed(lang, first, second, nxt, n, dealt, buckets)

    return run


def packed(lang, first, second, nxt, n, dealt, buckets: int) -> pa.RecordBatch:
    u = lambda x: x.view(np.uint64)
    shard = np.where(dealt, scrambled(u(nxt)) % np.uint64(SHARDS), np.uint64(0))
    mixed = scrambled(scrambled(u(first)) + np.uint64(3) * u(second) + shard * np.uint64(0x9E3779B97F4A7C15))
    bucket = (mixed % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((bucket, dealt))  # stable: entries of a prefix stay together
    first, second, nxt, n, dealt, bucket = (x[order] for x in (first, second, nxt, n, dealt, bucket))
    new_row = np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (dealt[1:] != dealt[:-1])])
    new_prefix = np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])]) | new_row
    rows, prefixes = np.flatnonzero(new_row), np.flatnonzero(new_prefix)
    sizes = np.diff(np.append(prefixes, len(n))).astype(np.int32)
    row_ends, prefix_at = np.append(rows[1:], len(n)), np.searchsorted(prefixes, np.append(rows, len(n)))
    by_prefix = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(prefix_at, prefix_at[1:], strict=False)], pa.binary())
    by_entry = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(rows, row_ends, strict=True)], pa.binary())
    columns = [
        pa.repeat(lang, len(rows)), pa.array(dealt[rows]), pa.array(bucket[rows]),
        by_prefix(first[prefixes]), by_prefix(second[prefixes]), by_prefix(sizes), by_entry(nxt), by_entry(n.astype(np.int64)),
    ]
    return pa.RecordBatch.from_arrays(columns, ["lang", "dealt", "bucket", "first", "second", "sizes", "next", "n"])


def merged(rows: pa.Table) -> pa.Table:
    """A bucket's stripes, added up: its frequent entries, and a row for each prefix.

    A prefix's row (third = OTHER) has its total and its largest entry. Prefixes too rare to be
    candidates are left out, but for those of which other buckets hold a part.
    """
    whole = lambda c, t=np.int64: np.frombuffer(b"".join(rows.column(c).to_pylist()), t)
    sizes = whole("sizes", np.int32)
    first, second, nxt, n = np.repeat(whole("first"), sizes), np.repeat(whole("second"), sizes), whole("next"), whole("n")
    order = np.lexsort((nxt, second, first))
    first, second, nxt, n = first[order], second[order], nxt[order], n[order]
    prefix = np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
    entry = prefix.copy()
    entry[1:] |= nxt[1:] != nxt[:-1]
    at = np.flatnonzero(entry)
    first, second, nxt, n, prefix = first[at], second[at], nxt[at], np.add.reduceat(n, at), np.flatnonzero(prefix[at])
    total, largest = np.add.reduceat(n, prefix), np.maximum.reduceat(np.where(nxt == OTHER, 0, n), prefix)
    keep = (total >= LEAST) | rows.column("dealt")[0].as_py()
    often = np.flatnonzero((n >= LEAST) & (nxt != OTHER))
    prefix, total, largest = prefix[keep], total[keep], largest[keep]
    out = {"first": first, "second": second, "third": nxt}
    out = {c: np.concatenate([x[often], x[prefix]]) for c, x in out.items()}
    out["third"][len(often) :] = OTHER
    out |= {"n": np.concatenate([n[often], total]), "largest": np.concatenate([np.zeros(len(often), np.int64), largest])}
    return pa.table({"lang": pa.repeat(rows.column("lang")[0], len(out["n"])), **out})


MERGED = "lang string, first long, second long, third long, n long, largest long"


def counted_words(rows: DataFrame) -> tuple[DataFrame, dict, str]:
    """(lang, word, n, id) of every word, totals, and the salt with which no two ids are equal."""
    words = rows.mapInArrow(word_rows, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words, seen = stage_and_measure(
        words, "words", all=F.sum("n"), frequent=F.count_if(F.col("n") >= LEAST), hot=F.count_if(F.col("n") >= HOT_WORD)
    )
    for salt in count():
        salt = "" if salt == 0 else f"\n{salt}"
        named = words.withColumn("id", F.xxhash64(F.concat("word", F.lit(salt)) if salt else F.col("word")))
        clash = named.groupBy("lang", "id").agg(F.count(F.lit(1)).alias("words")).filter((F.col("words") > 1) | (F.col("id") == OTHER))
        if clash.isEmpty():
            return named, seen, salt


def phrase_counts(rows: DataFrame, words: DataFrame, seen: dict, salt: str) -> DataFrame:
    """(lang, first, second, third, n, largest): frequent phrases of two words, third OTHER, and of three."""
    frequent = marks(words.filter(F.col("n") >= LEAST), seen["frequent"] or 0)
    hot = marks(words.filter(F.col("n") >= HOT_WORD), seen["hot"] or 0)
    buckets = 1 + (seen["all"] or 0) // BUCKET_WORDS
    packed = rows.mapInArrow(stripe_rows(frequent, hot, buckets, salt.encode()), STRIPES)
    parts = stage(packed.groupBy("lang", "dealt", "bucket").applyInArrow(merged, MERGED), "stripes")
    three = parts.filter(F.col("third") != OTHER)
    two = parts.filter(F.col("third") == OTHER).groupBy("lang", "first", "second", "third")
    two = two.agg(F.sum("n").alias("n"), F.max("largest").alias("largest")).filter(F.col("n") >= LEAST)
    return stage(three.unionByName(two), "phrases")


def exact(c: str) -> Column:
    return F.col(c).cast("decimal(14,0)")


def cut_score(left: str, right: str) -> Column:
    """floor(SCORE * a * a / (left * right)), in decimals of up to 38 digits."""
    return F.call_function("div", F.lit(SCORE).cast("decimal(7,0)") * exact("a") * exact("a"), exact(left) * exact(right))


def cut(left: str, right: str, place: int) -> Column:
    named = [cut_score(left, right).alias("score"), F.lit(place).alias("k"), F.col(left).alias("l"), F.col(right).alias("r")]
    return F.struct(*named)


def collocations(docs: DataFrame, *, text: str = "text", lang: str = "lang", best: int = BEST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``best`` phrases of each language.

    A null language counts as ``und``, together with texts that say so; a null or empty
    text has no words. A very long text is counted whole. Repeated rows count as often as
    they come. Ties in score go to the more frequent phrase, then to the smaller by its
    bytes. Other columns are not read. An empty table, or one without candidates, gives no
    rows.
    """
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    words, seen, salt = counted_words(rows)
    phrases = phrase_counts(rows, words, seen, salt)
    one = words.filter(F.col("n") >= LEAST)
    word = lambda c, n: one.select("lang", F.col("id").alias(c), F.col("word").alias(f"{c}_word"), F.col("n").alias(n))
    found = phrases.filter(F.col("third") == OTHER).select("lang", "first", "second", F.col("n").alias("a"), "largest")
    three = phrases.filter(F.col("third") != OTHER).select("lang", "first", "second", "third", F.col("n").alias("a"))

    # the largest count of a candidate that a phrase begins, and of one that it ends
    ends = three.groupBy("lang", F.col("second").alias("first"), F.col("third").alias("second")).agg(F.max("a").alias("ending"))
    longer = F.greatest("largest", F.coalesce("ending", F.lit(0)))
    inside = (longer >= LEAST) & (SUBSUMED[1] * longer >= SUBSUMED[0] * F.col("a"))
    two = found.join(ends, ["lang", "first", "second"], "left").filter(~inside)
    two = two.join(word("first", "l1"), ["lang", "first"]).join(word("second", "r1"), ["lang", "second"])
    two = two.select("lang", F.concat_ws(" ", "first_word", "second_word").alias("phrase"), "a", cut("l1", "r1", 1).alias("cut"))

    part = lambda a, b, n: found.select("lang", F.col("first").alias(a), F.col("second").alias(b), F.col("a").alias(n))
    three = three.join(part("first", "second", "l2"), ["lang", "first", "second"]).join(part("second", "third", "r1"), ["lang", "second", "third"])
    three = three.join(word("first", "l1"), ["lang", "first"]).join(word("third", "r2"), ["lang", "third"])
    three = three.join(word("second", "m"), ["lang", "second"])
    lowest = F.array_min(F.array(cut("l1", "r1", 1), cut("l2", "r2", 2)))
    three = three.select("lang", F.concat_ws(" ", "first_word", "second_word", "third_word").alias("phrase"), "a", lowest.alias("cut"))

    out = two.unionByName(three).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    out = out.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= best)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return out.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
