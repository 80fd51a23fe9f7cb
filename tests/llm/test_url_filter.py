import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from carespan.llm import url_filter as u


def plain_host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = rest[:end], rest[end:]
    cut = min((rest.find(c) for c in "?#" if c in rest), default=len(rest))
    return "".join(c.lower() if c.isascii() else c for c in host), rest[:cut]


def plain_rule(host, path):
    best = None
    for verdict, rule in u.RULES:
        name, start = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            best = max(best or ("", ""), (rule, verdict), key=lambda x: len(x[0]))
    return best


ODD = [
    None, "", "no scheme", "http://", "HTTP://A.NET/x", "http://net/", "http://xnet/", "http://a.net", "http://a.net?q=/",
    "https://Example.NET/en/1", "https://example.net/EN/1", "http://a.example.com/de/1#x", "http://b.org/fr/?", "a://b://c.net/",
    "http://É.NET/é", "http://x\n.net/\n", "http://example.net/en", "http://user@h.net:80/p", "http://" + "a" * 5000 + ".com/",
]


def pages(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")


def many():
    r = random.Random(1)
    hosts = ["spam-win", "casino-x", "news", "blog"]
    return ODD + [f"http://{r.choice(hosts)}{r.randint(0, 99)}.{r.choice(['net', 'org', 'example.com', 'io'])}/{r.choice(['en', 'fr', 'de'])}/{i}" for i in range(300)]


def test_rules_and_parts(spark):
    got = u.judge(pages(spark, many()))
    for r in got.collect():
        host, path = plain_host_path(many()[r.page_id])
        assert (r.host, r.path) == (host, path)
        best = plain_rule(host, path)
        assert r.rule == (best and best[0])
        if best:
            assert r.verdict == best[1]
        assert r.verdict in ("allow", "block") and np.isfinite(r.score)


def plain_probability(text, examples):
    """Witten-Bell by hand: from the shortest context to the longest one seen."""
    pad = bytes([u.START]) * u.ORDER
    lines = [pad + e + bytes([u.END]) for e in examples]
    line, total = pad + text + bytes([u.END]), 0.0
    for i in range(u.ORDER, len(line)):
        p = 1 / 256
        for k in range(u.ORDER + 1):
            context = line[i - k : i]
            after = [x[j] for x in lines for j in range(u.ORDER, len(x)) if x[j - k : j] == context]
            if after:
                p = (after.count(line[i]) + len(set(after)) * p) / (len(after) + len(set(after)))
        total += np.log(p)
    return total


@pytest.mark.parametrize("text", [b"abab", b"", b"zz\xc3\xa9"])
def test_model_is_the_smoothed_one(text):
    examples = [b"abc", b"abd", b"b", b""]
    line, places, _ = u.joined([text])
    got = u.Markov.learn(examples).log_likelihood(line, places)
    assert got.sum() == pytest.approx(plain_probability(text, examples))


def test_scores_do_not_depend_on_the_batch():
    model = u.UrlModel(u.Markov.learn([b"abc"]), u.Markov.learn([b"xyz"]), 0.0)
    urls = [b"abc", b"", b"xyz", b"q" * 3000]
    alone = np.concatenate([model.scores([x]) for x in urls])
    assert model.scores(urls) == pytest.approx(alone)
    assert alone[0] > 0 > alone[2]


def test_held_out_urls_are_told_apart(spark):
    r = random.Random(2)
    good = [f"http://{r.choice(['alpha', 'gamma'])}{i}.org/fr/{i}" for i in range(200)]
    bad = [f"http://{r.choice(['casino', 'xxx-win'])}{i}.net/{i}" for i in range(200)]
    more = [f"http://alpha{i}.io/fr/{i}" for i in range(50)] + [f"http://casino{i}.io/{i}" for i in range(50)]
    got = u.judge(pages(spark, good + bad + more)).filter("rule is null").orderBy("page_id").collect()
    right = sum(x.verdict == ("allow" if i < 50 else "block") for i, x in enumerate(got))
    assert right >= 95


def test_without_examples_nothing_is_held_against_a_url(spark):
    assert rows(u.judge(pages(spark, [None, "http://a.io/"])).select("verdict", "score")) == [("allow", 0.0)] * 2
    assert u.judge(pages(spark, [])).count() == 0


def test_repeated_rows_and_other_columns(spark):
    df = pages(spark, ["http://a.net/", "http://a.net/"]).withColumns({c: F.lit(1) for c in ("host", "score", "rule", "key")})
    got = u.judge(df)
    assert rows(got, "page_id", "verdict") == [(0, "block"), (1, "block")]
    assert got.columns == ["page_id", "host", "path", "rule", "verdict", "score"]


def test_copies_of_a_url_are_one_example(spark, monkeypatch):
    seen, real = [], u.Markov.learn
    monkeypatch.setattr(u.Markov, "learn", lambda urls: seen.append(urls) or real(urls))
    urls = [f"http://a.example/{i}" for i in range(40)]
    df = spark.createDataFrame([(x, v) for v in ("allow", "block") for x in urls for _ in range(30)], "url string, verdict string")
    u.learn(df, urls_a_class=40)
    assert [len(x) == len(set(x)) > 20 for x in seen] == [True, True]


def labelled(spark, good, bad):
    return spark.createDataFrame([(x, "allow") for x in good] + [(x, "block") for x in bad], "url string, verdict string")


def examples(n):
    return [f"http://alpha{i}.org/fr/{i * i}" for i in range(n)], [f"http://xxx-win{i}.net/{i * 7}" for i in range(n)] + ["http://z.net/" + "long" * 1000]


def test_every_url_with_a_rule_is_learned_from(spark):
    """No number of URLs and no length bounds the examples: the counts are those of all that are not held out."""
    good, bad = examples(12_600)
    df = labelled(spark, good, bad)
    held = {r.url for r in df.filter(F.pmod(F.xxhash64("url"), F.lit(5)) == 0).collect()}
    model = u.learn(df.repartition(5))
    for got, urls in ((model.accepted, good), (model.rejected, bad)):
        want = u.Markov.learn([x.encode() for x in urls if x not in held])
        for a, b in zip(got.tables, want.tables, strict=True):
            assert all((x == y).all() for x, y in zip(a, b, strict=True))
    scores = model.scores([x.encode() for x in [*good, *bad] if x in held])
    kinds = np.array([x in set(good) for x in [*good, *bad] if x in held])
    assert ((scores >= model.threshold) == kinds).mean() > 0.99


def test_contexts_beyond_the_most_are_pooled(spark, monkeypatch):
    good, bad = examples(300)
    monkeypatch.setattr(u, "MOST", 600)
    monkeypatch.setattr(u, "DIVISORS", (1021, 127))
    model = u.learn(labelled(spark, good, bad))
    assert 127 in model.accepted.divisors and model.accepted.divisors[0] == 0
    assert len({int(t[1].sum()) for t in model.accepted.tables}) == 1
    line, places, _ = u.joined([good[0].encode()])
    assert (model.accepted.log_likelihood(line, places) < 0).all()
    right = [model.scores([x.encode() for x in some]) >= model.threshold for some in (good, bad)]
    assert right[0].mean() > 0.95 and right[1].mean() < 0.05


@pytest.mark.parametrize("held", [3, 1 << 10, 1 << 17])
def test_counts_beyond_what_a_task_holds_are_joined(spark, monkeypatch, held):
    """No context is pooled or dropped: scores and verdicts are those of the model that is held."""
    urls = [*many(), *many()[:40], "http://q.io/" + "ab\u00e9" * 900, *["http://same.io/x"] * 30]
    want = rows(u.judge(pages(spark, urls)))
    monkeypatch.setattr(u, "MOST", 500)
    monkeypatch.setattr(u, "HELD", held, raising=False)
    monkeypatch.setattr(u, "held_model", None, raising=False)
    got = rows(u.judge(pages(spark, urls)))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert [r[5] for r in got] == pytest.approx([r[5] for r in want], abs=1e-12)
