"""Very long runs, subset sums against all subsets, and very common rows."""

import random
import zlib
from collections import Counter
from itertools import product

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from folia.llm import packing


@pytest.mark.parametrize("unit", [" ", "\n", "\t ", "\u3000", "a", "7", "ab1", "#", "\x1c"])
def test_long_runs(spark, unit):
    n = 2_000_000 if len(unit.encode()) == 1 else 400_000
    text = "head" + unit * n + "tail"
    ids = [*Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids, 2]
    got = packing.pack_documents(spark.createDataFrame([(1, text), (2, "x")], "doc_id long, text string")).where("doc_id = 1").orderBy("piece").collect()
    assert sum(r.length for r in got) == len(ids)
    for r in got:
        assert zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[r.start : r.start + r.length])) == r.ids_crc32


def test_fullest_against_all_subsets():
    rng = random.Random(3)
    for _ in range(150):
        capacity = rng.randrange(10, 60)
        counts = {rng.randrange(1, capacity + 1): rng.randrange(1, 4) for _ in range(rng.randrange(1, 6))}
        used = packing.fullest(counts, capacity)
        top = max(counts)
        best = max(s for n in product(*(range(c + 1) for c in counts.values())) if n[list(counts).index(top)] and (s := sum(k * x for k, x in zip(counts, n))) <= capacity)
        assert sum(k * n for k, n in used.items()) == best and all(n <= counts[k] for k, n in used.items())


def test_repeated_rows(spark):
    rows = [(None, "same words again")] * 900 + [(5, "five")] * 300 + [(6, None)] * 40
    got = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), capacity=32).collect()
    assert Counter(r.doc_id for r in got) == {None: 900, 5: 300, 6: 40}
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 32
