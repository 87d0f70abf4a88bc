"""Near-duplicates where ids repeat, are no numbers, or are missing: no text is lost."""

import random

from folia.llm import neardup


def text(seed, n=60):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(10_000)}" for _ in range(n))


def near(t):
    return t + " tail"


def kept(df, **more):
    return sorted((r.doc_id, r.text) for r in neardup.drop_near_duplicates(df, **more).collect())


def test_rows_are_judged_not_ids(spark):
    a, b = text(1), text(2)
    df = spark.createDataFrame([(1, a), (5, a), (5, b)], "doc_id long, text string")
    assert kept(df) == [(1, a), (5, b)]


def test_ids_that_repeat_join_no_texts(spark):
    a, b = text(1), text(2)
    df = spark.createDataFrame([(1, near(a)), (5, a), (5, b), (8, near(b))], "doc_id long, text string")
    assert kept(df) == [(1, near(a)), (5, b)]
    got = {(r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(df).collect()}
    assert got == {(1, 1, True), (5, 1, False), (5, 5, True), (8, 5, False)}


def test_ids_of_text(spark):
    a, b = text(3), text(4)
    df = spark.createDataFrame([("x10", a), ("x9", near(a)), ("y", b), (None, b), ("", "one two"), ("z", None)], "doc_id string, text string")
    assert sorted(map(repr, neardup.drop_near_duplicates(df).collect())) == sorted(map(repr, df.where("doc_id is null or doc_id <> 'x9'").collect()))


def test_large_groups_over_other_columns(spark):
    """Copies and near copies of one text in a third of all rows, with columns named like the operator's own."""
    a = text(5, 200)
    rows = [(k, a if k % 2 else near(a), "x", "y", "z") for k in range(400)] + [(1000 + k, text(100 + k), "x", "y", "z") for k in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string, text_hash string, gone string, Gone_ string")
    got = neardup.drop_near_duplicates(df)
    assert got.columns == df.columns and sorted(r.doc_id for r in got.collect()) == [0, *range(1000, 1800)]
