"""Documents of languages without trusted text are judged by bounds of all trusted text."""

import random

from folia.llm import language_model as lm

SCHEMA = "doc_id long, text string, lang string"


def prose(rng):
    words = ["the", "river", "town", "was", "old", "and", "people", "came", "down", "to", "see", "water", "in", "spring"]
    return " ".join(rng.choice(words) for _ in range(80)) + "."


def judged(spark, more):
    rng = random.Random(6)
    rows = [(i, prose(rng), "en" if i % 2 else "de") for i in range(160)]
    rows += [(900, prose(rng), None), (901, "#*$ " * 90, None), (902, "ZQ9|" * 90, "xx"), (903, prose(rng), "xx"), (904, "", "xx"), *more]
    trusted = [r[0] for r in rows if r[0] < 160 or r[0] >= 1000]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = lm.classify_quality(docs, spark.createDataFrame([(i,) for i in trusted], "doc_id long")).collect()
    assert len(got) == len(rows)
    return {r.doc_id: r for r in got}


def test_no_document_with_a_perplexity_is_unjudged(spark):
    got = judged(spark, [])
    assert all(r.low is not None for r in got.values() if r.perplexity is not None)
    assert [got[i].kept for i in (900, 901, 902, 903, 904)] == [True, False, False, True, False]


def test_few_trusted_documents_of_a_language_do_not_set_the_bounds(spark):
    got = judged(spark, [(1000, "§§ ¶¶ ŁŁ " * 40, "yy"), (1001, "§§ ¶¶ ŁŁ " * 40, "yy")])
    assert got[903].kept and got[903].low < got[903].score < got[903].high
    assert got[900].kept
