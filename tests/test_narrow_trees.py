"""Trees for references: they carry no text that cites nothing, and are otherwise the trees with their texts."""

import random

from pyspark.sql import functions as F

from folia.functions import text
from folia.operators import graph, hierarchy, references, sections
from folia.plans import queries
from tests.test_hierarchy import POOL

BLOCKS = "doc_id string, page_index int, block_idx int, block_content string, seq int"
MORE = ["무배당 안심 보통약관", "행복 특별약관", "상법", "【법규1】 보험업법", "【법규2】 " + "긴" * 90 + "법", "제2조제3항 및 상법 제638조에 따른다", "", " 　 ", "latin text without any"]


def plan(df, kind="executedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def streams(spark, docs=120, times=1):
    rng = random.Random(23)
    made = [[rng.choice(MORE) if rng.random() < 0.3 else rng.choice(POOL)[1] for _ in range(rng.randrange(1, 40))] for _ in range(docs)]
    rows = [(f"{d:03}", 0, i, t, i) for _ in range(times) for d, s in enumerate(made) for i, t in enumerate(s)]
    return spark.createDataFrame(rows, BLOCKS)


def test_strip_equals_the_pattern(spark):
    rng = random.Random(3)
    chars = [*text.WHITE, "a", "글", "​", "﻿", "\x1c", "᠎", "\U0001f600"]
    rows = [(None,), ("",), *(("".join(rng.choices(chars, k=rng.randrange(1, 9))),) for _ in range(4000))]
    got = spark.createDataFrame(rows, "c string").select("c", text.strip(F.col("c")).alias("a"), F.regexp_replace(F.coalesce("c", F.lit("")), r"(?U)^\s+|\s+$", "").alias("b")).collect()
    assert [r for r in got if r.a != r.b] == [] and sum(r.c != r.a for r in got) > 1000


def test_strip_searches_no_text(spark):
    assert "regexp" not in plan(spark.range(1).select(text.strip(F.col("id").cast("string"))))


def test_stored_blocks_hold_no_text_that_cites_nothing(spark, sf_dir, monkeypatch):
    kept = []
    monkeypatch.setattr(queries, "stored", lambda df: kept.append(df) or df)
    for name in ("resolve_refs", "graph_edges", "section_references"):
        kept.clear()
        queries.QUERIES[name](spark, sf_dir)
        got = kept[0].where("content is not null").agg(F.count("*").alias("n"), F.count_if(~F.col("content").contains("제")).alias("bare")).first()
        assert got.n > 0 and got.bare == 0


def test_rules_are_asked_before_the_shuffle(spark, sf_dir):
    """Whole texts are not shuffled for references: what is classified is narrow already."""
    lines = plan(hierarchy.parse_blocks(queries._terms(spark, sf_dir), texts=False)).splitlines()
    first = next(i for i, x in enumerate(lines) if "Exchange" in x)
    assert not any("RLIKE" in x.upper() for x in lines[:first]) and any("RLIKE" in x.upper() for x in lines[first:])


def test_edges_join_nothing(spark):
    parsed = hierarchy.parse_blocks(streams(spark, 2), texts=False)
    refs = spark.createDataFrame([], "doc_id string, section_idx int, source_id string, ref_type string, resolved_id string, raw_text string, target_law string, target_jo int, target_hang int")
    assert "Join" not in plan(graph.edges(hierarchy.build_nodes(parsed, texts=False), refs))


def test_trees_without_texts_are_the_same(spark):
    for times in (1, 2):
        blocks = streams(spark, times=times).cache()
        whole, bare = (hierarchy.parse_blocks(blocks, texts=t).cache() for t in (True, False))
        inside = bare.where("section_idx > 0")
        a, b = hierarchy.build_nodes(whole), hierarchy.build_nodes(inside, texts=False)
        if times == 2:  # a document that comes twice has each node once
            assert b.count() == b.select("doc_id", "node_uid").distinct().count() == a.count()
            continue
        facts = [c for c in b.columns if c != "metadata"]
        assert sorted(map(str, a.select(*facts, "metadata").collect())) == sorted(map(str, b.select(*facts, "metadata").collect())) != []
        laws = bare.where("law is not null").select("doc_id", "law").distinct()
        assert sorted(map(tuple, laws.collect())) == sorted(map(tuple, sections.external_laws(blocks).collect())) != []
        assert bare.where("section_idx = 0").count() > 0
        found = [references.resolve_references(references.extract_references(hierarchy.reference_texts(p), n), t) for p, n, t in ((whole, sections.external_laws(blocks), a), (inside, bare.select("doc_id", "law"), b))]
        assert sorted(map(str, found[0].collect())) == sorted(map(str, found[1].collect())) != []
        ends = [graph.graph_edges(t, r).select("doc_id", "section_idx", "section_id", "source", "target", "type") for t, r in zip((a, b), found, strict=True)]
        assert sorted(map(str, ends[0].collect())) == sorted(map(str, ends[1].collect())) != []
        by = {(r.doc_id, r.node_uid): r.id for r in a.collect()}
        assert all(r.parent_id == by[r.doc_id, r.parent_uid] for r in a.where("parent_uid is not null").collect())


def test_short_documents_get_their_names_once(spark):
    """Texts of one document stay together up to a number of blocks, so that its names make one automaton."""
    rows = [(1, 1, k, 0, "u", "s", "상법 제3조", None) for k in range(40)]
    texts = spark.createDataFrame(rows, "doc_id long, section_idx int, seq int, part int, owner_uid string, source_id string, text string, article_no int")
    got = references.extract_references(texts, spark.createDataFrame([(1, "상법")], "doc_id long, law string"))
    assert got.select(F.spark_partition_id()).distinct().count() == 1 and got.count() == 40
