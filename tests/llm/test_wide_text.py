"""Items in scripts without spaces, very long texts, and recall by the share of characters edited."""

import random

import pyarrow as pa
from folia.llm import decontam
from folia.llm.kernels import PUNCTUATION, Words


def test_wide_characters_are_words():
    col = pa.array(["ab中文c d\u0e01\u0e02", None, "𝒳y", "é中"])
    w = Words(col, lower=True, space=PUNCTUATION, split_wide=True)
    words = [w.data[a:b].tobytes().decode() for a, b in zip(w.start, w.end)]
    assert words == ["ab", "中", "文", "c", "d", "\u0e01", "\u0e02", "𝒳", "y", "é", "中"] and w.first.tolist() == [0, 7, 7, 9, 11]


def test_items_without_spaces(spark):
    rng = random.Random(3)
    some = lambda n: "".join(chr(rng.randrange(0x4E00, 0x5E00)) for _ in range(n))
    items = [(i, some(rng.randrange(20, 60))) for i in range(30)]
    docs = []
    for i, t in items:
        k = rng.randrange(len(t))
        docs += [(i, some(300) + t + some(300)), (100 + i, some(200) + t[:k] + some(1) + t[k + 1 :] + some(9)), (200 + i, some(600))]
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame(items, "item_id int, text string")).collect()}
    assert {(i, i) for i, _ in items} <= got
    assert len(got & {(100 + i, i) for i, _ in items}) >= 27 and not any(d >= 200 for d, _ in got)


def typed(text, rate, rng):
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") if c != " " and rng.random() < rate else c for c in text)


def test_recall_with_letters_edited(spark, sf_dir):
    """Edits spread over letters change most words long before a fifth of the letters; recall falls with them."""
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    filler = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(80).collect()]
    rng, index = random.Random(9), decontam.ItemIndex(items)
    for rate, least in ((0.02, 0.99), (0.05, 0.97), (0.08, 0.93), (0.12, 0.75), (0.16, 0.5)):
        texts = [f"{filler[k % 80]} {typed(t, rate, rng)} {filler[-k % 80]}" for k, (_, t) in enumerate(items)]
        found = {(m[0], index.ids[m[1]]) for m in index.matches(pa.array(texts))}
        share = sum((k, i) in found for k, (i, _) in enumerate(items)) / len(items)
        assert share >= least, (rate, share)


def test_very_long_text(spark, sf_dir):
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first()
    rows = [(1, "word " * 300_000 + item.text + " x" * 300_000), (None, item.text), (2, None), (2, "")]
    bench = spark.createDataFrame([(item.item_id, item.text)], "item_id int, text string")
    got = decontam.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert {(r.doc_id, r.edits) for r in got} == {(1, 0), (None, 0)}
