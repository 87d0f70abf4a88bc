"""Segments that hang together, by a grid, against all pairs."""

import random
import time

import numpy as np
import pytest

from folia.functions import arrays
from folia.operators import boxes

SCHEMA = "doc_id long, page_index int, seg_idx long, kind string, x0 double, y0 double, x1 double, y1 double"


def plain(segments, gap=5.0):
    """Union by comparing every two segments of a page."""
    root = {s[:3]: s[:3] for s in segments}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, s in enumerate(segments):
        for t in segments[i + 1 :]:
            if s[:2] == t[:2]:
                ends = [(s[a], s[a + 1], t[b], t[b + 1]) for a in (4, 6) for b in (4, 6)]
                if any(None not in e and np.hypot(e[0] - e[2], e[1] - e[3]) < gap for e in ends):
                    a, b = find(s[:3]), find(t[:3])
                    root[max(a, b)] = min(a, b)
    return {k: find(k)[2] for k in root}


def got(spark, segments):
    df = boxes.segment_components(spark.createDataFrame(segments, SCHEMA))
    return {(r.doc_id, r.page_index, r.seg_idx): r.component for r in df.collect()}


@pytest.mark.parametrize("spread", [12.0, 60.0, 400.0])
def test_equals_all_pairs(spark, spread):
    rng = random.Random(spread)
    place = lambda: rng.choice([round(rng.uniform(-spread, spread), 1), rng.randrange(-3, 3) * 5.0, rng.randrange(4) * 5 / 2**0.5])
    rows = [(d, p, k, "l", *(place() for _ in range(4))) for d in range(3) for p in range(3) for k in range(60)]
    rows += [(9, 0, k, "l", None if k == 3 else 1.0, 1.0, float("nan") if k == 4 else 2.0, 2.0) for k in range(6)]
    rows = [tuple(None if isinstance(x, float) and x != x else x for x in r) for r in rows]
    assert got(spark, rows) == plain(rows)


def test_null_pages_and_empty(spark):
    rows = [(None, 1, 0, "l", 0.0, 0.0, 50.0, 0.0), (None, 1, 1, "l", 51.0, 0.0, 90.0, 0.0), (1, None, 2, "l", 51.0, 0.0, 90.0, 0.0)]
    assert got(spark, rows) == {(None, 1, 0): 0, (None, 1, 1): 0, (1, None, 2): 2}
    assert got(spark, []) == {}


@pytest.mark.parametrize("kind", ["grid", "chain", "crowd", "random"])
def test_large_page(spark, kind):
    """50,000 segments on a page in seconds: a table's rules, one long line, all ends in a few cells, and any."""
    n = 50_000
    rng = np.random.default_rng(3)
    if kind == "grid":
        k = np.arange(n)
        ends = np.stack([k % 250 * 20.0, k // 250 * 20.0, k % 250 * 20.0 + 18, k // 250 * 20.0 + 1], 1)
    elif kind == "chain":
        k = rng.permutation(n) * 30.0
        ends = np.stack([k, 0 * k, k + 28, 0 * k], 1)
    elif kind == "crowd":
        ends = rng.uniform(0, 9, (n, 4))
    else:
        ends = rng.uniform(0, 20_000, (n, 4))
    rows = spark.createDataFrame([(1, 1, i, "l", *map(float, e)) for i, e in enumerate(ends)], SCHEMA).cache()
    rows.count()
    began = time.time()
    made = {r.component for r in boxes.segment_components(rows).collect()}
    assert time.time() - began < 10
    assert len(made) == {"grid": 200, "chain": 1, "crowd": 1}.get(kind, len(made))
    rows.unpersist()


def test_whole_groups_and_chains():
    import pyarrow as pa

    rng = random.Random(2)
    key = sorted(rng.choices([None, *range(30)], k=500), key=lambda x: (x is not None, x or 0))
    batches = [pa.RecordBatch.from_arrays([pa.array(key[i : i + 17], pa.int64())], ["k"]) for i in range(0, 500, 17)]
    for least in (1, 40, 1000):
        parts = [(b.column(0).to_pylist(), g.tolist()) for b, g in arrays.whole_groups(iter(batches), ["k"], least)]
        assert sum((k for k, _ in parts), []) == key
        assert not any(a[0][-1] == b[0][0] for a, b in zip(parts, parts[1:]))
        assert all(len(set(zip(map(str, k), g))) == len(set(g)) == len(set(map(str, k))) for k, g in parts)
    order = np.random.default_rng(1).permutation(100_000)
    assert not arrays.components(100_000, order[1:], order[:-1]).any()


def test_older_rules_for_boxes(spark):
    drawings = spark.createDataFrame([(1, 0, 0, 100.0, 50.0, 0.0, 0.0), (1, 0, 1, None, None, None, None), (1, 0, 2, 1.0, 1.0, 101.0, 51.0), (1, 0, 3, 0.0, 0.0, 49.0, 90.0), (2, 0, 0, None, None, None, None)], "doc_id long, page_index int, drawing_idx long, x0 double, y0 double, x1 double, y1 double")
    frame = lambda d, k, x0, y0, x1, y1: [(d, 0, k * 10 + i, "l", *e, k) for i, e in enumerate([(x0, y0, x1, y0), (x1, y0, x1, y1), (x0, y1, x1, y1), (x0, y0, x0, y1)])]
    segments = spark.createDataFrame([*frame(1, 0, 2.0, 2.0, 98.0, 49.0), *frame(1, 1, 200.0, 0.0, 300.0, 40.0), *frame(1, 3, 0.0, 0.0, 9.0, 200.0), *frame(2, 0, 0.0, 0.0, 60.0, 60.0)[:3]], SCHEMA + ", drawing_idx long")
    notes = spark.createDataFrame([(1, 0, 0, 200.0, 1.0, 303.0, 41.0), (1, 0, 1, 500.0, 0.0, 600.0, 90.0), (2, 0, 0, 60.0, 0.0, 0.0, 90.0)], "doc_id long, page_index int, annotation_idx long, x0 double, y0 double, x1 double, y1 double")
    got = [(r.doc_id, r.id, r.type, tuple(r.rect)) for r in boxes.legacy_boxes(drawings, segments, notes).orderBy("doc_id", "id").collect()]
    assert got == [(1, 0, "rect", (0.0, 0.0, 100.0, 50.0)), (1, 1, "lines", (200.0, 0.0, 300.0, 40.0)), (1, 2, "rect", (1.0, 1.0, 101.0, 51.0)), (1, 3, "lines_combined", (0.0, 0.0, 300.0, 200.0)), (1, 4, "annotation", (500.0, 0.0, 600.0, 90.0))]
    assert boxes.legacy_boxes(drawings.limit(0), segments.limit(0)).count() == 0
