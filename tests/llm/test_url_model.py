"""The url model on hosts and words that are not in its table, and odd urls."""

import random

from folia.llm import urls


def measured(model, test):
    scores = model.scores(*map(list, zip(*(urls.host_and_path(u) for u, _ in test), strict=True)))
    hit = [(s >= model.threshold, bool(v)) for s, (_, v) in zip(scores, test, strict=True)]
    both = sum(a and b for a, b in hit)
    return both / max(1, sum(a for a, _ in hit)), both / max(1, sum(b for _, b in hit))


def test_new_hosts():
    rows = urls.labelled_urls()
    seen = {urls.host_and_path(u)[0] for u, _ in rows}
    test = [(u, v) for u, v in urls.labelled_urls(seed=1234, each=8) if urls.host_and_path(u)[0] not in seen]
    precision, recall = measured(urls.train_url_model(rows), test)
    assert len(test) > 2000 and precision >= 0.97 and recall >= 0.88


def test_new_words():
    """A fifth of all words is held out; hosts are made of these alone, so only what words share can tell them."""
    rng, kept, out = random.Random(7), [], []
    for words in (urls.BLOCK_WORDS, urls.ALLOW_WORDS):
        mixed = rng.sample(words, len(words))
        kept.append(mixed[len(words) // 5 :])
        out.append(mixed[: len(words) // 5])
    precision, recall = measured(urls.train_url_model(urls.labelled_urls(*kept)), urls.labelled_urls(*out, seed=99))
    assert precision >= 0.75 and recall >= 0.5


def test_hosts_seen_nowhere():
    block = "buy-rolex-watches.ru cialis-online.co 888casino.com onlinepharmacy24.com www.spam-farm.example.com".split()
    allow = "www.freebsd.org winchester.ac.uk stackoverflow.com en.wikipedia.org therapist-directory.com microsoft.com blog.tionsh.example.net".split()
    model = urls.train_url_model()
    assert min(model.scores(block, ["/"] * len(block))) >= 0.5
    assert sum(model.scores(allow, ["/"] * len(allow)) >= 0.5) <= 1


def test_batch_scores_equal_single_ones():
    rows = [urls.host_and_path(u) for u, _ in urls.labelled_urls(each=1)[:50]] + [("", ""), ("é.中文", "/𝒳" * 9), ("a", ""), ("", "/")]
    model = urls.train_url_model()
    assert [float(x) for x in model.scores(*map(list, zip(*rows)))] == [model.score(*r) for r in rows]
    assert model.score("", "") < model.threshold


def test_odd_urls(spark):
    long = "http://" + "a" * 300_000 + ".com/" + "x/" * 300_000
    rows = [(1, None, "h"), (2, "", "h"), (3, "http://", "h"), (4, long, "h"), (4, long, "h"), (None, "HTTP://ÄB.Com/P?q#f", "h"), (5, "a://b://c/d", "h"), (6, "x\n://y\nz/w\n?", "h")]
    got = urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string, host string")).collect()
    assert len(got) == len(rows) and set(got[0].asDict()) == {"page_id", "url", "host", "path", "rule", "score", "verdict"}
    for r in got:
        assert (r.host, r.path) == urls.host_and_path(r.url) and r.rule is None and r.verdict in ("allow", "block")
