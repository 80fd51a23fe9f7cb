"""Small tables that hold the odd cases, and plain programs to compare with."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, words):
    r = random.Random(seed)
    parts = ["the", "of", "er", "ing", "tion", "ên", "schaft", "ou", "ble", "st"]
    return " ".join("".join(r.choices(parts, k=r.randint(1, 3))) for _ in range(words))


def edited(text, seed, share):
    r = random.Random(seed)
    return " ".join(w if r.random() > share else "zq" + w for w in text.split())


def odd_texts():
    """Null, empty, blank, one word, few words, odd signs, very long, repeated."""
    base = prose(1, 60)
    long = prose(2, 20_000)
    return [
        None, "", "   \t\n", "One", "one", "a b c", "A B C", base, base, base.upper(),
        base + " tail", edited(base, 3, 0.02), edited(base, 4, 0.5), long, long + " x",
        "naïve\u00a0text\u2003with odd spaces", "emoji 😀 漢字 \x00 \x1c end", "<|endoftext|> <s> <0x0A>",
        prose(5, 200), edited(prose(5, 200), 6, 0.01), edited(prose(5, 200), 7, 0.01),
    ]


def documents(spark, texts=None, **columns):
    texts = odd_texts() if texts is None else texts
    rows = [
        (i, t, None if i % 5 == 4 else "en", None if i % 7 == 6 else f"s{i % 3}", None if t is None else len(t))
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def words(text):
    return WORD.findall((text or "").translate(CAPITALS))
