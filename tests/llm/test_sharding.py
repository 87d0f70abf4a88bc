"""The shard search on groups of any size, against all sizes at hand."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from folia.llm import sharding


@pytest.mark.parametrize("case", ["third", "twentieth", "equal", "several", "none"])
def test_large_groups_of_copies(spark, case):
    rng = random.Random(case)
    n = {"third": 3000, "twentieth": 520, "equal": 9000, "several": 300, "none": 0}[case]
    groups = 12 if case == "several" else 1
    texts = [f"copy {g} " * 9 for g in range(groups) for _ in range(n)]
    texts += [f"t{i} " + "x" * rng.randrange(400) for i in range(9000 - len(texts))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sharding.shard_documents(df).collect()
    sizes, load = Counter(), Counter()
    for r in got:
        sizes[r.text] += r["size"]
        load[r.shard] += r["size"]
    keys = {r.text: r.k for r in df.select("text", F.shiftrightunsigned(F.xxhash64("text"), 64 - sharding.KEY_BITS).alias("k")).distinct().collect()}
    assert len(got) == 9000 and max(load.values()) == sharding.smallest_capacity([sizes[t] for t in sorted(sizes, key=keys.get)], 16)[0]
    slots = Counter(r.shard for r in got)
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(k)) for s, k in slots.items())


def test_rounds_stay_bounded_and_exact(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROUND_BITS", 4)
    monkeypatch.setattr(sharding, "MOST_RANGES", 6)
    made = []
    real = sharding._sums
    monkeypatch.setattr(sharding, "_sums", lambda *a: made.append(real(*a)) or made[-1])
    rng = random.Random(11)
    for _ in range(6):
        keys = sorted(rng.sample(range(1 << sharding.KEY_BITS), 120))
        sizes = [rng.randrange(1, 60) if rng.random() < 0.9 else rng.randrange(300, 900) for _ in keys]
        df = spark.createDataFrame(list(zip(keys, sizes)), "key long, size long").coalesce(2)
        capacity, firsts = sharding.minimax_cuts(df, 5)
        assert capacity == sharding.smallest_capacity(sizes, 5)[0]
        load = Counter()
        for k, s in zip(keys, sizes):
            load[sum(k >= f for f in firsts)] += s
        assert max(load.values()) <= capacity and len(load) <= 5
    assert max(map(len, made)) <= 2**4


def test_repeated_rows_and_null_ids(spark):
    rows = [(7, "same")] * 400 + [(None, "same")] * 100 + [(i, None) for i in range(30)] + [(None, f"t{i}") for i in range(50)]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), shards=3).collect()
    assert len(got) == len(rows)
    for s in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
