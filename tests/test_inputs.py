"""The blocks that queries run on reach every rule that a block can reach, and hold the whole texts."""

from functools import reduce

from pyspark.sql import functions as F

from folia.functions import fixed as X
from folia.functions import patterns as P
from folia.functions.text import strip
from folia.plans.inputs import relation


def counts(df, named):
    return df.agg(*(F.count_if(c).alias(k) for k, c in named.items())).first().asDict()


def test_every_rule_occurs(spark, sf_dir):
    content = strip(F.col("block_content"))
    blocks = relation(spark, sf_dir, "term_blocks").select(content.alias("c"), "seq")
    c = F.col("c")
    has = lambda p: F.rlike(c, F.lit(p))
    guarded = has(X.REFERENCE_SENTENCE)
    rule = reduce(lambda a, i: a.when(has(X.GRAMMAR[i][2]), i), range(len(X.GRAMMAR)), F.when(guarded, -1)).otherwise(-1)
    ruled = {r.rule: r["count"] for r in blocks.groupBy(rule.alias("rule")).count().collect()}
    # branch articles read as sentences on an article, so their two rules are never reached
    want = {i for i, (name, *_) in enumerate(X.GRAMMAR) if name != "조의"} | {-1}
    assert set(ruled) == want and min(ruled.values()) > 0
    named = {f"s{i}": P.is_section_title(c) & has(p) for i, p in enumerate(X.SECTION_TITLES)}
    named |= {"appendix": has(X.APPENDIX), "glossary": has(X.GLOSSARY), "note": has(X.NOTE), "law": has(X.LAW_BLOCK), "words": c.contains(X.LAW_WORDS), "guard": guarded, "forced": P.heading(c).isNull() & has(X.FORCED_ARTICLE), "lone": has(X.LONE_LAW), "named": has(X.NAMED_LAW)}
    found = counts(blocks, named)
    assert min(found.values()) > 0, found


def test_whole_texts_are_among_the_blocks(spark, sf_dir):
    last = relation(spark, sf_dir, "term_blocks").groupBy("doc_id").agg(F.max_by("block_content", "seq").alias("text"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    assert last.exceptAll(docs).count() == 0 and last.count() == docs.count()
