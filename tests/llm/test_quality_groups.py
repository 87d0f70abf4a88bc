"""The robust fit against exhaustive subsets and against plain numpy with very many starts."""

import math
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from folia.llm import quality_rules
from tests.llm.test_contracts import quality_reference

FLOORS = np.array([0.5, 0.12, 0.25, 0.06, 0.12])
SCHEMA = "doc_id long, text string, lang string, source string"


def transformed(s):
    w = max(1, s[0])
    return [math.log1p(s[0]), math.log(max(s[1] / w, 0.5)), math.log1p(20 * s[2] / w), math.sqrt(s[3] / w), math.sqrt(s[4] / w)]


def joint(near, up, weight):
    """Mean and covariance of some vectors and of a parent that counts as ``weight`` more."""
    m, (up_mean, up_cov) = len(near), up
    mean = (near.sum(axis=0) + weight * up_mean) / (m + weight)
    off = up_mean - mean
    return mean, ((near - mean).T @ (near - mean) + weight * (up_cov + np.outer(off, off))) / (m + weight)


def logdet(cov):
    return np.linalg.slogdet(cov + np.diag(FLOORS**2))[1]


def exhaustive(x, up, h, weight):
    k = math.ceil(h * len(x))
    return min((joint(x[list(c)], up, weight) for c in combinations(range(len(x)), k)), key=lambda e: logdet(e[1]))


def concentrated(x, up, h, weight, starts=80):
    """The best of many starts, each taken to its end."""
    k, rng, best = math.ceil(h * len(x)), np.random.default_rng(1), None
    for s in range(starts):
        mean, cov = (np.median(x, axis=0), up[1]) if s == 0 else joint(x[rng.choice(len(x), min(6, len(x)), replace=False)], up, weight if s % 2 else 0.0)
        last = math.inf
        while True:
            d = np.einsum("ni,ij,nj->n", x - mean, np.linalg.inv(cov + np.diag(FLOORS**2)), x - mean)
            mean, cov = joint(x[d <= np.sort(d)[k - 1]], up, weight)
            if logdet(cov) > last - 1e-9:
                break
            last = logdet(cov)
        if best is None or logdet(cov) < logdet(best[1]):
            best = mean, cov
    return best


def fit_reference(rows, h=0.75, weight=quality_rules.WEIGHT, few=10):
    """Robust estimates of every (lang, source) of rows (doc_id, lang, source, stats): all documents, then languages, then pairs."""
    x = {r[0]: np.array(transformed(r[3])) for r in rows}
    every = np.array(list(x.values()))
    top = np.array([np.sort(every[:, i])[max(0, math.ceil(0.5 * len(every)) - 1)] for i in range(5)]), np.diag((3 * FLOORS) ** 2)
    solve = lambda v, up: exhaustive(v, up, h, weight) if len(v) <= few else concentrated(v, up, h, weight)
    found = {(): solve(every, top)}
    for key in (lambda r: (r[1],), lambda r: (r[1], r[2])):
        groups = defaultdict(list)
        for r in rows:
            groups[key(r)].append(x[r[0]])
        found |= {g: solve(np.array(v), found[g[:-1]]) for g, v in groups.items()}
    return {g: e for g, e in found.items() if len(g) == 2}


def distances(rows, **how):
    c = quality_rules.consistency(0.75, 5)
    fits = {g: (m, np.linalg.inv(c * s + np.diag(FLOORS**2))) for g, (m, s) in fit_reference(rows, **how).items()}
    out = {}
    for r in rows:
        mean, inverse = fits[r[1], r[2]]
        off = np.array(transformed(r[3])) - mean
        out[r[0]] = off @ inverse @ off
    return out


def with_stats(rows):
    return [(r[0], r[2], r[3], quality_reference(r[1] or "")[:5]) for r in rows]


def made(rng, n, lang, source, first):
    out = []
    for i in range(n):
        words = [f"w{rng.integers(999)}" * int(rng.integers(1, 3)) for _ in range(int(rng.integers(20, 400)))]
        words += ["#"] * int(rng.integers(0, 5))
        out.append((first + i, " ".join(words), lang, source))
    return out


def test_chi_square():
    # table values
    assert quality_rules.chi_square_quantile(0.95, 5) == pytest.approx(11.0705, abs=1e-4)
    assert quality_rules.chi_square_quantile(0.75, 5) == pytest.approx(6.6257, abs=1e-4)
    assert quality_rules.chi_square_quantile(0.99, 4) == pytest.approx(13.2767, abs=1e-4)
    assert quality_rules.chi_square_quantile(0.9999, 5) == pytest.approx(quality_rules.CUTOFF) == pytest.approx(25.7448, abs=1e-3)
    x = np.random.default_rng(2).normal(size=(200_000, 5))
    near = x[np.argsort((x**2).sum(axis=1))[:150_000]]
    assert quality_rules.consistency(0.75, 5) * near.var() == pytest.approx(1, abs=0.01)


@pytest.mark.parametrize("weight", [0.5, 50.0])
def test_smallest_determinant_of_all_subsets(spark, weight):
    rng = np.random.default_rng(5)
    rows, kinds = [], [("a", "p"), ("a", "q"), ("b", "p"), ("b", "q"), ("b", None), (None, "p")]
    for k, (lang, source) in enumerate(kinds):
        rows += made(rng, 9, lang, source, 100 * k)
    stats = quality_rules.with_statistics(spark.createDataFrame(rows, SCHEMA))
    fit = quality_rules.fit_groups(stats, starts=12, weight=weight)
    got = {r["__grp"]: r for r in fit.estimates.collect()}
    keys = {(r.lang, r.source): r.k for r in stats.select("lang", "source", quality_rules._names("lang", "source")[1].alias("k")).distinct().collect()}
    want = fit_reference(with_stats(rows), weight=weight)
    c = quality_rules.consistency(0.75, 5)
    for pair, (mean, cov) in want.items():
        mine = np.linalg.inv(np.array(got[keys[pair]]["inv"]).reshape(5, 5))
        best = c * cov + np.diag(FLOORS**2)
        assert np.linalg.slogdet(mine)[1] <= np.linalg.slogdet(best)[1] + 0.02
        assert np.allclose(got[keys[pair]]["mean"], mean, atol=0.3)


def test_distances_equal_numpy(docs, rows):
    want = distances([(r["doc_id"], r["lang"], r["source"], quality_reference(r["text"] or "")[:5]) for r in rows])
    got = {r.doc_id: r.distance for r in quality_rules.judge_documents(docs, starts=12).collect()}
    assert got.keys() == want.keys()
    near = [abs(got[k] - v) <= 0.02 * v + 0.02 for k, v in want.items()]
    assert sum(near) >= 0.95 * len(near)
    assert all((got[k] > quality_rules.CUTOFF) == (v > quality_rules.CUTOFF) for k, v in want.items() if not 24 < v < 28)


def test_one_document_has_a_distance(docs):
    assert quality_rules.judge_documents(docs.limit(1)).first().distance is not None


def test_labelled_bad_documents_of_small_languages_go(spark):
    d = "/root/testdata/sf0.01"
    judged = quality_rules.judge_documents(spark.read.parquet(f"{d}/documents.parquet"))
    assert judged.where("distance is null").isEmpty()
    both = judged.where("not base_failed").join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k"))
    share = {r.quality: r.k for r in both.collect()}
    assert share[1] > 0.99 and share[0] < 0.1


def test_small_source_beside_a_large_one(spark):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{rng.integers(999)}" for _ in range(rng.integers(40, 90))), "xx", "big" if i < 230 else "small") for i in range(236)]
    rows += [(998, "# | # | $ % " * 30, "xx", "small"), (999, "# | # | $ % " * 30, "xx", "alone")]
    got = {r.doc_id: r for r in quality_rules.judge_documents(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = distances(with_stats(rows))
    assert all(abs(got[k].distance - v) <= 0.05 * v + 0.05 for k, v in want.items())
    assert {k for k, r in got.items() if r["distance"] > quality_rules.CUTOFF} == {998, 999}


def test_size_makes_no_switch(spark):
    """One document more or less never changes what others get by more than a little."""
    rng = np.random.default_rng(8)
    rows = made(rng, 240, "xx", "s", 0)
    last = None
    for n in (199, 200, 201):
        got = {r.doc_id: r.distance for r in quality_rules.judge_documents(spark.createDataFrame(rows[:n], SCHEMA)).collect()}
        if last:
            assert all(abs(got[k] - v) < 0.5 + 0.25 * v for k, v in last.items())
        last = got


def test_salted_estimates_agree(docs, monkeypatch):
    plain = {r.doc_id: r.distance for r in quality_rules.judge_documents(docs).collect()}
    monkeypatch.setattr(quality_rules, "MAX_BROADCAST_GROUPS", 0)
    salted = {r.doc_id: r.distance for r in quality_rules.judge_documents(docs).collect()}
    assert salted == {k: pytest.approx(v, rel=1e-3) for k, v in plain.items()}
