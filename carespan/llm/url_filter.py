"""URL filter: rules first, then the ratio of two character language models.

URLs that a rule decides are the examples: one variable-order Markov model of their
bytes is learned from accepted, one from rejected URLs. A byte's probability is read
from the longest context that the model has seen, smoothed with the shorter ones
(Witten-Bell); a URL's score is the difference of the two log-likelihoods over its
length. The threshold is the score that parts held-out examples best.

The byte sequences of all distinct examples are counted by a group-by, and all held-out
examples are scored for the threshold. Up to MOST counts in all come to the driver, and the
tasks hold them. More stay in tables: the difference that each sequence in the URLs makes is
worked out by joins, once, order by order, and joined to the URLs' sequences; tasks hold the
differences of sequences with over one in HELD of all places. The scores are the same. Only
``learn``, which makes a model that one process holds, pools contexts where an order has
more than MOST distinct sequences: those of equal remainder by one of DIVISORS count as one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carespan.llm.common import kept_text, lower_ascii
from carespan.sources.staging import stage

#: rules of the query: verdict and host with the beginning of the path (fixed values)
RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)
HOST_PATH = r"(?s)^.*?://([^/?#]*)([^?#]*)"
START, END = 2, 3  # bytes that mark a URL's ends
ORDER = 5  # bytes of the longest context
CHUNK_BYTES = 1 << 20  # URLs scored, or counted, at a time
MOST = 1 << 20  # counts of an order and class that a model holds as they are
HELD = 1 << 17  # a sequence with more than this part of all places is looked up in tasks, not joined
DIVISORS = (524_287, 131_071, 32_749, 8_191)  # primes; the first that leaves MOST counts, else the last
STEPS = 1000  # steps of the held-out scores' histogram in a unit
VERDICTS = ("allow", "block")


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty without a ``://``."""
    url = kept_text(url)
    return lower_ascii(F.regexp_extract(url, HOST_PATH, 1)), F.regexp_extract(url, HOST_PATH, 2)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Verdict and text of the longest rule that fits the host, or a parent, and the path."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, start = rule.split("/", 1)
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{start}")
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def joined(urls: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All URLs in one array, each after ORDER start marks; scored places; their starts."""
    pad = bytes([START]) * ORDER
    text = np.frombuffer(b"".join(pad + u + bytes([END]) for u in urls), np.uint8)
    sizes = np.array([len(u) + 1 for u in urls], np.int64)
    ends = np.cumsum(sizes + ORDER)
    scored = np.ones(len(text), bool)
    for i in range(ORDER):
        scored[ends - sizes - ORDER + i] = False
    return text, np.flatnonzero(scored), np.cumsum(sizes) - sizes


def grams(text: np.ndarray, places: np.ndarray, order: int) -> np.ndarray:
    """The byte at each place with the ``order`` bytes before it, packed in one number."""
    out = np.zeros(len(places), np.uint64)
    for back in range(order, -1, -1):
        out = (out << np.uint64(8)) | text[places - back].astype(np.uint64)
    return out


def find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, keys), max(len(table) - 1, 0))
    return at, (table[at] == keys) if len(table) else np.zeros(len(keys), bool)


def pooled(keys: np.ndarray, divisor: int) -> np.ndarray:
    """Sequences with their contexts' remainders in place of the contexts; unchanged by 0."""
    if not divisor:
        return keys
    return keys // np.uint64(256) % np.uint64(divisor) * np.uint64(256) + keys % np.uint64(256)


@dataclass
class Markov:
    """Counts of byte sequences up to ORDER + 1 long, as sorted tables.

    ``divisors``: of each order, 0 or the one whose remainders its contexts are known by.
    """

    tables: list[tuple[np.ndarray, ...]]
    divisors: Sequence[int] = (0,) * (ORDER + 1)

    @classmethod
    def learn(cls, urls: Sequence[bytes]) -> Markov:
        text, places, _ = joined(urls)
        tables = []
        for order in range(ORDER + 1):
            tables.append(cls.table(*np.unique(grams(text, places, order), return_counts=True)))
        return cls(tables)

    @staticmethod
    def table(seen: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
        """An order's table, from its distinct sequences in rising order."""
        contexts, first, kinds = np.unique(seen >> np.uint64(8), return_index=True, return_counts=True)
        totals = np.add.reduceat(counts, first)
        return seen, counts.astype(np.float64), contexts, totals.astype(np.float64), kinds.astype(np.float64)

    def log_likelihood(self, text: np.ndarray, places: np.ndarray) -> np.ndarray:
        p = np.full(len(places), 1 / 256)
        for order, (seen, counts, contexts, totals, kinds) in enumerate(self.tables):
            keys = pooled(grams(text, places, order), self.divisors[order])
            at, known = find(contexts, keys >> np.uint64(8))
            total, kind = np.where(known, totals[at], 0), np.where(known, kinds[at], 1)
            at, hit = find(seen, keys)
            p = (np.where(hit, counts[at], 0) + kind * p) / (total + kind)
        return np.log(p)


def chunks(urls: Sequence[bytes]) -> Iterator[list[bytes]]:
    """The URLs in order, CHUNK_BYTES of them at a time; a longer one by itself."""
    batch, size = [], 0
    for u in urls:
        if batch and size + len(u) > CHUNK_BYTES:
            yield batch
            batch, size = [], 0
        batch.append(u)
        size += len(u) + ORDER + 1
    if batch:
        yield batch


@dataclass
class UrlModel:
    accepted: Markov
    rejected: Markov
    threshold: float

    def scores(self, urls: Sequence[bytes]) -> np.ndarray:
        """Mean log-likelihood difference a byte; above 0: more like accepted URLs."""
        out = []
        for batch in chunks(urls):
            text, places, starts = joined(batch)
            gap = self.accepted.log_likelihood(text, places) - self.rejected.log_likelihood(text, places)
            lengths = np.diff(np.append(starts, len(places)))
            out.append(np.add.reduceat(gap, starts) / lengths)
        return np.concatenate(out) if out else np.zeros(0)


def best_threshold(scores: np.ndarray, good: np.ndarray, counts: np.ndarray | None = None) -> float:
    """The cut with the largest sum of the two shares on their right sides.

    ``counts``: how many examples each score stands for; without it one.
    """
    if good.all() or not good.any():
        return 0.0
    order = np.argsort(scores, kind="stable")
    s, g = scores[order], good[order]
    n = np.ones(len(s), np.int64) if counts is None else counts[order]
    right = np.concatenate([[0], np.cumsum(n * ~g)]) / (n * ~g).sum() + 1 - np.concatenate([[0], np.cumsum(n * g)]) / (n * g).sum()
    cuts = np.concatenate([[s[0] - 1e-6], (s[1:] + s[:-1]) / 2, [s[-1] + 1e-6]])
    usable = np.concatenate([[True], s[1:] > s[:-1], [True]])
    right = np.where(usable, right, -1)
    best = np.flatnonzero(right >= right.max() - 1e-12)
    return float(cuts[best[len(best) // 2]])


def counted_grams(examples: DataFrame) -> DataFrame:
    """Rows (verdict, place, gram, n) of the byte sequences of (url, verdict), each order's.

    ``place`` is the order: how many bytes stand before the last.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            verdicts = np.array(b.column("verdict").to_pylist(), object)
            urls = b.column("url").to_pylist()
            for verdict in VERDICTS:
                for batch in chunks([urls[i].encode() for i in np.flatnonzero(verdicts == verdict)]):
                    text, places, _ = joined(batch)
                    for order in range(ORDER + 1):
                        seen, n = np.unique(grams(text, places, order), return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([verdict] * len(seen)), pa.array(np.full(len(seen), order, np.int32)), pa.array(seen.astype(np.int64)), pa.array(n.astype(np.int64))],
                            ["verdict", "place", "gram", "n"],
                        )

    partial = examples.select("url", "verdict").mapInArrow(run, "verdict string, place int, gram long, n long")
    return partial.groupBy("verdict", "place", "gram").agg(F.sum("n").alias("n"))


def held_counts(counts: DataFrame) -> dict[str, Markov]:
    """The model of each verdict from staged (verdict, place, gram, n)."""
    kinds = {(r.verdict, r.place): r["count"] for r in counts.groupBy("verdict", "place").count().collect()}
    made: dict[str, Markov] = {}
    for verdict in VERDICTS:
        tables, divisors = [], []
        for order in range(ORDER + 1):
            own = counts.filter((F.col("verdict") == verdict) & (F.col("place") == order)).select("gram", "n")
            divisor, rest = 0, iter(DIVISORS)
            while kinds[verdict, order] > MOST and (more := next(rest, 0)):
                context = F.shiftright("gram", 8) % more
                pools = own.groupBy((context * 256 + F.col("gram") % 256).alias("gram")).agg(F.sum("n").alias("n"))
                divisor, kinds[verdict, order] = more, pools.count()
            got = (pools if divisor else own).orderBy("gram").toArrow()
            tables.append(Markov.table(got.column("gram").to_numpy().astype(np.uint64), got.column("n").to_numpy()))
            divisors.append(divisor)
        made[verdict] = Markov(tables, divisors)
    return made


def counted_examples(labelled: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """All distinct (url, verdict, held) and the counts of those to fit on, both staged.

    One in five, by digest, is held out of the counts and only sets the threshold. A class
    whose URLs would all be left out is counted whole. None if a class has no example.
    """
    examples = labelled.filter(F.col("verdict").isin(*VERDICTS) & (F.octet_length("url") > 0)).select("url", "verdict").distinct()
    examples = stage(examples.withColumn("held", F.pmod(F.xxhash64("url"), F.lit(5)) == 0), "url-examples")
    usual = {r.verdict: r.fit for r in examples.groupBy("verdict").agg(F.bool_or(~F.col("held")).alias("fit")).collect()}
    if len(usual) < len(VERDICTS):
        return None
    whole = [v for v in VERDICTS if not usual[v]]
    fit = examples.filter(~F.col("held") | F.col("verdict").isin(*whole)) if whole else examples.filter(~F.col("held"))
    return examples, stage(counted_grams(fit), "url-grams")


def learn_all(labelled: DataFrame) -> UrlModel | None:
    """Fit on all distinct (url, verdict); one in five, by digest, only sets the threshold."""
    counted = counted_examples(labelled)
    return None if counted is None else held_model(*counted)


def held_model(examples: DataFrame, counts: DataFrame) -> UrlModel:
    """The model of ``counted_examples`` that one process holds, with its threshold."""
    models = held_counts(counts)
    model = UrlModel(models["allow"], models["block"], 0.0)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = model.scores([u.encode() for u in b.column("url").to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column("verdict"), pa.array(s)], ["verdict", "score"])

    scored = examples.filter("held").select("url", "verdict").mapInArrow(score, "verdict string, score double")
    model.threshold = threshold_of(scored)
    return model


def threshold_of(scored: DataFrame) -> float:
    """The best threshold for all (verdict, score), from a histogram; 0 without any."""
    steps = scored.groupBy("verdict", F.floor(F.col("score") * STEPS).alias("step")).count().collect()
    if not steps:
        return 0.0
    middles = np.array([(r.step + 0.5) / STEPS for r in steps])
    good = np.array([r.verdict == "allow" for r in steps])
    return best_threshold(middles, good, np.array([r["count"] for r in steps], np.int64))


def sequences(urls: DataFrame) -> DataFrame:
    """Rows (gram, n): the sequences of ORDER + 1 bytes in ``urls``, and how often each comes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for batch in chunks([u.encode() for u in b.column(0).to_pylist()]):
                text, places, _ = joined(batch)
                seen, n = np.unique(grams(text, places, ORDER), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int64)), pa.array(n.astype(np.int64))], ["gram", "n"])

    return urls.select("url").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def gaps(wanted: DataFrame, counts: DataFrame) -> DataFrame:
    """Rows (gram, gap), staged: by how much each wanted gram is likelier after accepted URLs' counts.

    ``Markov.log_likelihood`` by joins. Each order has the distinct ends of the wanted grams,
    of which at most 256 share a context, and 256 the next shorter end.
    """
    out = None
    for order in range(ORDER + 1):
        own = counts.filter(F.col("place") == order)
        context = F.shiftright("gram", 8).alias("context")
        only = {v: F.when(F.col("verdict") == v, F.col("n")) for v in VERDICTS}
        seen = own.groupBy("gram").agg(*[F.sum(n).alias(f"n_{v}") for v, n in only.items()])
        after = own.groupBy(context).agg(
            *[F.sum(n).alias(f"total_{v}") for v, n in only.items()],
            *[F.nullif(F.count(n), F.lit(0)).alias(f"kinds_{v}") for v, n in only.items()],
        )
        ends = wanted.select(F.col("gram").bitwiseAND((1 << 8 * (order + 1)) - 1).alias("gram")).distinct()
        rows = ends.join(seen, "gram", "left").withColumn("context", context).join(after, "context", "left")
        if out is None:
            rows = rows.withColumns({f"p_{v}": F.lit(1 / 256) for v in VERDICTS})
        else:
            rows = rows.withColumn("end", F.col("gram").bitwiseAND((1 << 8 * order) - 1))
            rows = rows.join(out.withColumnRenamed("gram", "end"), "end")
        p = {}
        for v in VERDICTS:
            kinds = F.coalesce(f"kinds_{v}", F.lit(1)).cast("double")
            total = F.coalesce(f"total_{v}", F.lit(0)).cast("double")
            p[v] = (F.coalesce(f"n_{v}", F.lit(0)).cast("double") + kinds * F.col(f"p_{v}")) / (total + kinds)
        out = stage(rows.select("gram", *[x.alias(f"p_{v}") for v, x in p.items()]), "url-order")
    return out.select("gram", (F.log("p_allow") - F.log("p_block")).alias("gap"))


def scored_by_joins(urls: DataFrame, counts: DataFrame) -> DataFrame:
    """Rows (url, score) of all distinct ``urls``: ``UrlModel.scores`` for counts of any number.

    What comes to the driver, and goes to tasks, are the gaps of sequences with over one in
    HELD of all places: fewer than HELD. So no other sequence has many places either.
    """
    urls = stage(urls.select("url").distinct().withColumn("id", F.monotonically_increasing_id()), "url-distinct")
    wanted = stage(sequences(urls), "url-sequences")
    gap = gaps(wanted, counts)
    places = wanted.agg(F.sum("n")).first()[0] or 0
    common = gap.join(wanted.filter(F.col("n") > places / HELD).select("gram"), "gram").orderBy("gram").toArrow()
    keys, values = common.column("gram").to_numpy().astype(np.uint64), common.column("gap").to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for batch in chunks([u.encode() for u in b.column("url").to_pylist()]):
                ids, names = b.column("id").slice(at, len(batch)), b.column("url").slice(at, len(batch))
                at += len(batch)
                text, places, starts = joined(batch)
                found, lengths = grams(text, places, ORDER), np.diff(np.append(starts, len(places)))
                where, known = find(keys, found)
                own = np.add.reduceat(np.where(known, values[where] if len(values) else 0.0, 0.0), starts)
                rest = np.flatnonzero(~known)
                theirs = ids.take(pa.array(np.searchsorted(starts, rest, "right") - 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([ids, theirs]),
                        pa.concat_arrays([names, pa.nulls(len(rest), names.type)]),
                        pa.concat_arrays([pa.nulls(len(ids), pa.int64()), pa.array(found[rest].astype(np.int64))]),
                        pa.concat_arrays([pa.array(lengths), pa.nulls(len(rest), pa.int64())]),
                        pa.concat_arrays([pa.array(own), pa.nulls(len(rest), pa.float64())]),
                    ],
                    ["id", "url", "gram", "bytes", "own"],
                )

    parts = stage(urls.select("id", "url").mapInArrow(run, "id long, url string, gram long, bytes long, own double"), "url-places")
    # decimals, so that a sum does not depend on the order of its rows
    rest = parts.filter("gram is not null").select("id", "gram").join(gap, "gram")
    rest = rest.groupBy("id").agg(F.sum(F.col("gap").cast("decimal(18,15)")).cast("double").alias("rest"))
    scores = parts.filter("gram is null").join(rest, "id", "left")
    return scores.select("url", ((F.col("own") + F.coalesce("rest", F.lit(0.0))) / F.col("bytes")).alias("score"))


def learn(labelled: DataFrame, *, urls_a_class: int | None = None, longest: int = 2048) -> UrlModel | None:
    """Fit on (url, verdict): on all distinct URLs, unless ``urls_a_class`` asks for fewer.

    The model is one that a process holds: contexts are pooled where there are more than
    MOST (``judge`` pools none). With ``urls_a_class`` it is made on the driver from that many distinct URLs a class, those of
    smallest digest among URLs of up to ``longest`` bytes. One in five, by digest, is left
    out of the counts and sets the threshold. None if a class has no example.
    """
    if urls_a_class is None:
        return learn_all(labelled)
    usable = labelled.filter((F.octet_length("url") > 0) & (F.octet_length("url") <= longest))
    fit, held = {}, {}
    for verdict in ("allow", "block"):
        rows = (
            usable.filter(F.col("verdict") == verdict)
            .select("url")
            .distinct()
            .withColumn("digest", F.xxhash64("url"))
            .orderBy("digest", "url")
            .limit(urls_a_class)
            .collect()
        )
        urls = [(r.url.encode(), r.digest % 5 == 0) for r in rows]
        fit[verdict] = [u for u, out in urls if not out] or [u for u, _ in urls]
        held[verdict] = [u for u, out in urls if out]
    if not fit["allow"] or not fit["block"]:
        return None
    model = UrlModel(Markov.learn(fit["allow"]), Markov.learn(fit["block"]), 0.0)
    urls = held["allow"] + held["block"]
    good = np.arange(len(urls)) < len(held["allow"])
    model.threshold = best_threshold(model.scores(urls), good) if urls else 0.0
    return model


def judge(
    pages: DataFrame,
    *,
    key: str = "page_id",
    url: str = "url",
    rules: Sequence[tuple[str, str]] = RULES,
    urls_a_class: int | None = None,
) -> DataFrame:
    """Rows (key, host, path, rule, verdict, score), one for each row of ``pages``.

    A null url counts as empty: no host, no path, no rule, and the score of an empty
    URL. ``verdict`` is the rule's, else ``allow`` from the threshold on. Without
    examples of both kinds nothing is known against a URL: score 0, ``allow``. The model
    is learned from all URLs with a rule, each once, unless ``urls_a_class`` bounds them.
    """
    host, path = host_path(F.col(url))
    found = matching_rule(F.col("host"), F.col("path"), rules)
    pages = pages.select(F.col(key).alias("key"), kept_text(F.col(url)).alias("url"), host.alias("host"), path.alias("path"))
    pages = pages.withColumn("found", found)
    labelled = pages.select("url", F.col("found.verdict").alias("verdict"))
    flat = pages.select("key", "url", "host", "path", F.col("found.rule").alias("rule"), F.col("found.verdict").alias("ruled"))
    counted = counted_examples(labelled) if urls_a_class is None else None
    if counted is not None and counted[1].count() > MOST:
        examples, counts = counted
        scores = stage(scored_by_joins(pages, counts), "url-scores")
        threshold = threshold_of(examples.filter("held").join(scores, "url").select("verdict", "score"))
        scored = flat.join(scores, "url")
    else:
        if urls_a_class is not None:
            model = learn(labelled, urls_a_class=urls_a_class)
        else:
            model = held_model(*counted) if counted else None
        threshold = model.threshold if model else 0.0

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                urls = [u.encode() for u in b.column("url").to_pylist()]
                s = model.scores(urls) if model else np.zeros(len(urls))
                yield pa.RecordBatch.from_arrays([*b.columns[:1], *b.columns[2:], pa.array(s)], [*b.schema.names[:1], *b.schema.names[2:], "score"])

        scored = flat.mapInArrow(score, flat.drop("url").schema.add("score", "double"))
    by_model = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return scored.select(
        F.col("key").alias(key), "host", "path", "rule", F.coalesce("ruled", by_model).alias("verdict"), "score"
    )
