"""Citations of many laws by an automaton, against one alternation of all names."""

import random
import re
import time

from pyspark.sql import functions as F

from folia.functions import fixed as X
from folia.operators import references

TEXTS = "doc_id long, section_idx int, seq long, part int, owner_uid string, source_id string, text string, article_no int"


def alternation(names, text):
    """Longest names first, in one pattern."""
    known = "|".join(re.escape(n) for n in sorted(names, key=lambda n: (-len(n), n))) if names else X.ANY_LAW
    return [(m.start(), m.end(), m[1], m.groups()[1:]) for m in re.finditer(f"({known}){X.LAW_TAIL}", text)]


def made(rng, names):
    parts = [lambda: rng.choice(names), lambda: f"제{rng.randrange(30)}조", lambda: " ", lambda: f"의{rng.randrange(5)}", lambda: f"제{rng.randrange(9)}항", lambda: rng.choice("법령 가나약관"), lambda: f"{rng.randrange(9)}호"]
    return "".join(rng.choice(parts)() for _ in range(rng.randrange(1, 30)))


def test_citations_equal_one_pattern():
    rng = random.Random(11)
    for k in range(400):
        names = ["".join(rng.choices("가나법령", k=rng.randrange(1, 5))) for _ in range(rng.randrange(1, 12))]
        names = [] if k % 10 == 0 else names
        text = made(rng, names or ["상법", "민법"])
        assert references.LawFinder(names).cites(text) == alternation(names, text)


def test_many_names_in_time_that_follows_the_text(spark):
    """10,000 names in one document with a third of all texts; each task makes their automaton once."""
    names = [f"{'가나다라마바사아자차'[k % 10]}{'기니디리미비시이지치'[k // 10 % 10]}{'고노도로모보소오조초'[k // 100 % 10]}{'구누두루무부수우주추'[k // 1000]}법" for k in range(10_000)]
    rng = random.Random(12)
    rows = [(1 if k % 3 == 0 else k, 1, k, 0, f"u{k}", "s", f"{rng.choice(names)} 제{k % 50}조에 따라 {names[k % 10_000]}제3조의2 제1항", 5) for k in range(9_000)]
    texts = spark.createDataFrame(rows, TEXTS).cache()
    laws = spark.createDataFrame([(1, n) for n in names] + [(2, "상법"), (4, names[0]), (99_999, "민법"), (1, None)], "doc_id long, law string").cache()
    began = time.time()
    got = references.extract_references(texts, laws).where("doc_id = 1").collect()
    assert time.time() - began < 60
    assert len([r for r in got if r.ref_type == "external"]) == 2 * sum(r[0] == 1 for r in rows)
    want = {(r[2], i, c[2]) for r in rows if r[0] == 1 and r[2] < 60 for i, c in enumerate(references.LawFinder(names).cites(r[6]))}
    assert want == {(r.seq, r.ordinal, r.target_law) for r in got if r.ref_type == "external" and r.seq < 60}


def test_names_stay_with_their_document(spark):
    rows = [(d, 1, k, 0, "u", "s", "상법 제3조 및 나라법 제4조", None) for d in (None, 1, 2) for k in range(20)]
    laws = spark.createDataFrame([(1, "나라법"), (None, "상법")], "doc_id long, law string")
    got = references.extract_references(spark.createDataFrame(rows, TEXTS), laws)
    by = {(r.doc_id, r.target_law): r.n for r in got.where("ref_type = 'external'").groupBy("doc_id", "target_law").agg(F.count("*").alias("n")).collect()}
    # names of no document are no one's: without names of its own a document has any law
    assert by == {(None, "상법"): 20, (None, "나라법"): 20, (1, "나라법"): 20, (2, "상법"): 20, (2, "나라법"): 20}
    assert references.extract_references(spark.createDataFrame([], TEXTS), laws).count() == 0
