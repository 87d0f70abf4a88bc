"""What plans of the parser's queries must not do: work out a text again for each rule, shuffle nodes, or hold trees in memory."""

import random
import re

from pyspark.sql import functions as F

from folia.functions import fixed, patterns, text
from folia.operators import hierarchy, tree
from folia.plans import queries


def plan(df, kind="executedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def test_content_is_bound_once(spark):
    """Rules ask for the stripped text many times; it is an expression over the whole text."""
    df = spark.createDataFrame([("제1조(목적) 글",)], "c string")
    content = text.strip(F.col("c"))
    for rule in (patterns.heading, patterns.global_special, patterns.forced_article):
        assert plan(df.select(rule(content).alias("r")), "optimizedPlan").count("coalesce(c#") == 1


def test_stack_takes_few_windows(spark, sf_dir):
    nodes = hierarchy.build_nodes(hierarchy.parse_blocks(queries._terms(spark, sf_dir)))
    assert plan(nodes.select("id", "content", "preorder"), "optimizedPlan").count("Window [") <= 14


def test_nodes_take_one_shuffle(spark, sf_dir):
    assert plan(queries.node_text(spark, sf_dir)).count("Exchange") == 1


def test_trees_are_not_held_in_memory(spark, sf_dir):
    nodes, _ = queries._tree(spark, sf_dir)
    assert not nodes.storageLevel.useMemory and nodes.count() > 0
    assert "Window" not in plan(nodes)


def test_rows_of_the_stack_are_narrow(spark, sf_dir):
    """Every window copies its rows: what the rules found and the open nodes of all levels must not go along."""
    parsed = plan(hierarchy.parse_blocks(queries._terms(spark, sf_dir)), "optimizedPlan")
    assert parsed.count("Window [") <= 9
    names = set(re.findall(r"\b(top\d+|next\d+)#", parsed))
    assert not names


def test_whole_texts_of_sections_take_no_window_of_their_own(spark, sf_dir):
    nodes = queries._nodes(spark, sf_dir)
    assert plan(queries.section_whole_text(spark, sf_dir), "optimizedPlan").count("Window [") == plan(nodes, "optimizedPlan").count("Window [")
    for empty in (False, True):
        want = tree.full_text(nodes, F.col("type") == "section", empty).select("doc_id", "section_idx", "text")
        assert sorted(map(tuple, tree.section_texts(nodes, empty).collect())) == sorted(map(tuple, want.collect())) != []


def test_rules_are_told_apart_by_their_lead(spark):
    """Only rules of the lead are asked for texts that begin with it, and titles for texts with a word of theirs; the same as all rules in turn."""
    rng = random.Random(5)
    bits = ["제", "1", "12", "조", "장", "관", "편", "절", "의", " ", "(", ")", "[", "]", "【", "】", "①", "가", ".", "-", "(i)", "약관", "보통약관", "상법", "민원", "분쟁", "유의", "사례", "주요", "/", "a", "<", ">", "항", "\n", "　", "법규"]
    leads = [*[""] * 6, "제1조", "제2조의3(", "제 3 장", "제4장의2", "제5관", "제6편", "제7절", "제8조 ", "제9조[", "1. ", "가. ", "(ii) ", "- "]
    texts = ["", "제", "유의 사항", "보험 / 저축", *(rng.choice(leads) + "".join(rng.choices(bits, k=rng.randrange(1, 8))) for _ in range(4000))]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    matches = lambda p: F.rlike("c", F.lit(p))
    rule = F.when(matches(fixed.REFERENCE_SENTENCE) | (F.col("c") == ""), -1)
    for i, (_, _, p) in enumerate(fixed.GRAMMAR):
        rule = rule.when(matches(p), i)
    title = (F.col("c") != "") & (F.char_length("c") <= fixed.SECTION_TITLE_MOST)
    no, yes = (F.array_contains(F.array(*map(matches, ps)), True) for ps in (fixed.NO_SECTION_TITLES, fixed.SECTION_TITLES))
    got = df.select("c", patterns._rule(F.col("c")).alias("a"), F.coalesce(rule, F.lit(-1)).alias("b"), patterns.is_section_title(F.col("c")).alias("t"), (title & ~no & yes).alias("u")).collect()
    assert [r for r in got if r.a != r.b or r.t != r.u] == []
    assert len({r.b for r in got}) > 10 and sum(r.u for r in got) > 20


def test_trees_that_are_read_once_are_not_stored(spark, sf_dir, monkeypatch):
    kept = []
    monkeypatch.setattr(queries, "stored", lambda df: kept.append(df) or df)
    for name, most in (("tree_lines", 1), ("section_counts", 1), ("resolve_refs", 1), ("graph_edges", 2)):
        kept.clear()
        queries.QUERIES[name](spark, sf_dir)
        assert len(kept) == most
