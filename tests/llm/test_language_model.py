"""The language model against direct formulas, and its verdicts against held-out labels."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folia.llm import language_model as lm


def symbols_of(text):
    out = []
    for c in map(ord, text):
        out += [c + 1] if c < 2048 else [2049 + (c >> 11), 2049 + 544 + (c & 2047)]
    return out


def grams_of(text, order):
    s = [lm.MARK] * (order - 1) + symbols_of(text)
    return [tuple(s[i : i + order]) for i in range(len(s) - order + 1)]


def reference(texts, order):
    """p(last | before) of the interpolated model, by recursion over plain counters."""
    levels = {order: Counter(g for t in texts for g in grams_of(t, order))}
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    spec = {}
    for k, c in levels.items():
        n = Counter(c.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
        d = {i: max(0.1, min(i - 0.05, i - (i + 1) * y * n[i + 1] / n[i])) if n[i] and n[1] else 0.5 for i in (1, 2, 3)}
        total, cut = defaultdict(int), defaultdict(float)
        for g, x in c.items():
            total[g[:-1]] += x
            cut[g[:-1]] += d[min(x, 3)]
        spec[k] = (c, d, total, cut)

    def p(g):
        if not g:
            return 1 / lm.BASE
        c, d, total, cut = spec[len(g)]
        if not total[g[:-1]]:
            return p(g[1:])
        own = (c[g] - d[min(c[g], 3)]) / total[g[:-1]] if c[g] else 0
        return own + cut[g[:-1]] / total[g[:-1]] * p(g[1:])

    return p


def mean_log(p, text, order):
    g = grams_of(text, order)
    return sum(math.log(p(x)) for x in g) / len(g)


def test_symbols_tell_all_characters_apart():
    codes = [0, 1, 127, 128, 2047, 2048, 0x4E2D, 0xFFFF, 0x10000, 0x10FFFF]
    got = [tuple(symbols_of(chr(c))) for c in codes]
    assert len(set(got)) == len(codes) and all(0 < x < lm.MARK for g in got for x in g)
    col = pa.array(["".join(chr(c) for c in codes if c), None, "x"])
    found, off = lm.symbols(col)
    assert found.tolist() == symbols_of(col[0].as_py()) + symbols_of("x") and off.tolist() == [0, len(found) - 1, len(found) - 1, len(found)]


def test_grams_stay_inside_rows():
    col = pa.array(["ab", None, "", "abcé中𝒳 Z9"])
    got, off = lm.grams(col, 3)
    want = [sum(s * lm.BASE ** (2 - i) for i, s in enumerate(g)) for t in ("ab", "abcé中𝒳 Z9") for g in grams_of(t, 3)]
    assert got.tolist() == want and off.tolist() == [0, 2, 2, 2, 13]
    assert lm.BASE**lm.ORDER < 2**63


@pytest.mark.parametrize("order", [3, 5])
def test_model_equals_formulas(spark, order):
    texts = ["the cat sat on the mat", "the hat", "a cat and a hat", "that cat!", "中文 cat"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    model = lm.kneser_ney(lm.gram_counts(df, order), order)
    p = reference(texts, order)
    probes = ["the cat", "zq Z", "hat!", "中 cat 𝒳", "t", "", None] * 3
    probe = spark.createDataFrame(list(enumerate(probes)), "id int, text string").repartition(4)
    got = {r.id: (r.n, r.perplexity) for r in lm.perplexities(probe, model, order).collect()}
    for i, t in enumerate(probes):
        want = (len(symbols_of(t)), pytest.approx(math.exp(-mean_log(p, t, order)), rel=1e-5)) if t else (0, None)
        assert got[i] == want


def test_probabilities_sum_to_one(spark):
    df = spark.createDataFrame([("some words, some more words",)], "text string")
    rows = lm.kneser_ney(lm.gram_counts(df, 3), 3).toPandas()
    table = lm.Table(rows.g.to_numpy(), np.log(rows.p.to_numpy()), np.log(rows.gamma.to_numpy()))
    for context in ("so", "rd", "zz", " m"):
        head = sum(s * lm.BASE ** (2 - i) for i, s in enumerate(symbols_of(context)))
        assert np.exp(table.log_p(head + np.arange(lm.BASE), 3).astype(float)).sum() == pytest.approx(1, abs=1e-4)


def share_at(values, p):
    v = sorted(values)
    return v[max(0, math.ceil(p * len(v)) - 1)]


def test_verdicts_equal_plain_python(spark):
    rng = random.Random(2)
    words = ["the", "river", "town", "was", "old", "und", "der", "alt", "été", "中文"]
    rows = [(i, " ".join(rng.choice(words[: 6 if i % 3 else 10]) for _ in range(rng.randrange(1, 90))), ["en", "de", None][i % 3]) for i in range(240)]
    rows += [(300, "#*$ " * 60, "en"), (301, "de " * 200, "de"), (302, "x", "fr"), (303, None, "en"), (304, "", None), (None, "the old town", "en")]
    good = [r[0] for r in rows if r[0] is not None and r[0] < 200 and r[0] % 7]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    trusted = spark.createDataFrame([(i,) for i in [*good, *good, None]], "doc_id long")
    flags = {r.doc_id: r.h for r in docs.selectExpr("doc_id", f"pmod(xxhash64(doc_id), {lm.HELD_OUT}) = 0 h").collect()}
    by = {r[0]: r for r in rows}
    p = reference([by[i][1] for i in good if not flags[i]], 4)
    z = {r[0]: (-mean_log(p, r[1], 4), len(symbols_of(r[1])), r[2] or "") for r in rows if r[1]}
    known, fresh = [i for i in good if i in z], [i for i in good if i in z and flags[i]]

    def bound(ids, value, q):
        every = share_at([value(i) for i in ids], q)

        def of(lang):
            own = [value(i) for i in ids if z[i][2] == lang]
            return (len(own) * share_at(own, q) + lm.WEIGHT * every) / (len(own) + lm.WEIGHT) if own else every

        return of

    middle = bound(fresh, lambda i: z[i][0], 0.5)
    score = lambda i: (z[i][1] * z[i][0] + lm.PRIOR * middle(z[i][2])) / (z[i][1] + lm.PRIOR)
    low, high = bound(known, score, 1 - 0.97), bound(fresh, score, 0.97)
    got = {r.doc_id: r for r in lm.classify_quality(docs, trusted, order=4, quantile=0.97).collect()}
    assert got.keys() == by.keys() and any(r.kept for r in got.values()) and len({r.low for r in got.values()}) == 4
    for i, r in got.items():
        if i not in z:
            assert (r.perplexity, r.score, r.kept) == (None, None, False)
            continue
        assert r.perplexity == pytest.approx(math.exp(z[i][0]), rel=1e-4) and r.score == pytest.approx(math.exp(score(i)), rel=1e-4)
        assert (r.low, r.high) == (pytest.approx(math.exp(low(z[i][2])), rel=1e-4), pytest.approx(math.exp(high(z[i][2])), rel=1e-4))
        assert r.kept == (r.low <= r.score <= r.high)


def test_lookup_by_hash():
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(0, 2**62, 5000))
    table = lm.Table(keys, np.arange(len(keys)), np.zeros(len(keys)))
    ask = np.concatenate([keys, keys + 1])
    assert (table.p[table.find(keys)] == np.arange(len(keys))).all()
    there = np.isin(ask, keys)
    assert (np.isnan(table.p[table.find(ask)]) == ~there).all()
    assert np.isnan(lm.Table(keys[:0], keys[:0], keys[:0]).log_p(np.array([5]), 1)).sum() == 0


def test_held_out_labels(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    train = labels.where("quality = 1 and toxic = 0 and doc_id % 2 = 0")
    judged = lm.classify_quality(docs, train).join(labels.where("doc_id % 2 = 1"), "doc_id")
    share = {r.quality: r.k for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert share[1] > 0.97 and share[0] < 0.35


def test_edges(clashing, empty, spark):
    trusted = clashing.where("doc_id is not null").select("doc_id")
    got = lm.classify_quality(clashing, trusted)
    assert got.count() == clashing.count()
    assert {r.doc_id for r in got.where("not kept").collect()} >= {10_001, 10_002}
    none = lm.classify_quality(clashing, trusted.limit(0)).collect()
    assert all(r.kept == (r.doc_id not in (10_001, 10_002)) for r in none)
    assert lm.classify_quality(empty, trusted).count() == 0
    long = spark.createDataFrame([(1, "word " * 500_000, "en"), (2, "a", "en")], "doc_id long, text string, lang string")
    assert lm.classify_quality(long, long.select("doc_id")).count() == 2
