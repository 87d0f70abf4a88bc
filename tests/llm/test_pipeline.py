"""The corpus pipeline stage by stage against plain Python."""

import re
import zlib
from collections import defaultdict

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from folia.llm import decontam, quality_rules
from tests.llm.test_contracts import line_reference, near_reference, quality_reference
from tests.llm.test_quality_groups import distances


def plain_words(text):
    return " ".join(re.sub(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]", " ", text).translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).split())


def test_stages(spark, docs, sf_dir):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "line dedup", "near dedup", "decontamination", "packing"]

    def step(name, df):
        out = stages[name](spark, df, sf_dir).cache()
        return out, [r.asDict() for r in out.collect()]

    rows = [r.asDict() for r in docs.collect()]
    a, good = step("quality rules", docs)
    far = distances([(r["doc_id"], r["lang"], r["source"], quality_reference(r["text"] or "")[:5]) for r in rows])
    stay = {r["doc_id"] for r in good}
    for r in rows:
        if quality_reference(r["text"] or "")[5]:
            assert r["doc_id"] not in stay
        elif not 24 < far[r["doc_id"]] < 28:
            assert (r["doc_id"] in stay) == (far[r["doc_id"]] <= quality_rules.CUTOFF)
    assert a.columns == docs.columns
    b, cut = step("line dedup", a)
    ref = line_reference(good)
    assert {r["doc_id"]: r["text"] for r in cut} == {d: v[2] for d, v in ref.items()} and b.columns == docs.columns
    assert all(r["n_chars"] == len(r["text"]) for r in cut)
    c, near = step("near dedup", b)
    assert {r["doc_id"] for r in near} == {d for d, v in near_reference(cut, 80).items() if v[2]} and c.columns == docs.columns
    d, clean = step("decontamination", c)
    items = [t for t in (plain_words(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()) if len(t.split()) >= decontam.MIN_WORDS]
    leaks = {r["doc_id"] for r in near if any(decontam.nearest(t, plain_words(r["text"]))[0] <= 0.2 * len(t) for t in items)}
    assert {r["doc_id"] for r in near} - {r["doc_id"] for r in clean} == leaks and leaks and d.columns == docs.columns
    _, packed = step("packing", d)
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole = defaultdict(list)
    for p in packed:
        whole[p["doc_id"]].append(p)
    for r in clean:
        ids = [*t.encode(r["text"], add_special_tokens=False).ids, 2]
        for p in whole[r["doc_id"]]:
            assert zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[p["start"] : p["start"] + p["length"]])) == p["ids_crc32"]
        assert sum(p["length"] for p in whole[r["doc_id"]]) == len(ids)


def test_run_equals_its_stages(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert {(r.doc_id, r.piece, r.ids_crc32) for r in got.collect()} == {(r.doc_id, r.piece, r.ids_crc32) for r in docs.collect()}
