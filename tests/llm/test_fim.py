"""Infilling outputs against plain Python, and back to the texts."""

import hashlib

import pytest
from pyspark.sql import functions as F

from folia.llm import fim, queries


def reference(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def held(df):
    return [tuple(r) for r in fim.fill_in_middle(df).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256", "restored_sha256").collect()]


def sha(s):
    return hashlib.sha256((s or "").encode()).hexdigest()


def want(doc_id, text):
    r = reference(doc_id, text)
    return (doc_id, *r, sha(r[-1]), sha(text))


def test_outputs_equal_plain_python(docs, rows):
    assert sorted(held(docs)) == sorted(want(r["doc_id"], r["text"]) for r in rows)
    assert {r[2] for r in held(docs)} == {"plain", "spm", "psm"}


def test_cuts_at_every_place(spark):
    """Lengths about those of pieces, characters of one to four bytes, and line ends, tabs and quotes."""
    rows = [(k, ("aé\n中𝒳'\t\"\\ " * 40)[: k % 150]) for k in range(1200)]
    assert sorted(held(spark.createDataFrame(rows, "doc_id int, text string"))) == sorted(want(*r) for r in rows)


def test_edge_rows(spark, clashing, empty):
    rows = [(r["doc_id"], r["text"]) for r in clashing.select("doc_id", "text").collect()]
    assert sorted(map(repr, held(clashing))) == sorted(repr(want(*r)) for r in rows)
    assert held(empty) == []
    odd = [(1, "a<P>b"), (2, "a<S"), (3, "<"), (4, "x<M>"), (5, "<P" * 300), (6, "S>" * 300), (7, None), (8, "\x00a\x00" * 50)]
    assert sorted(held(spark.createDataFrame(odd, "doc_id long, text string"))) == [want(*r) for r in odd]


def test_ids_of_other_kinds(spark):
    df = spark.createDataFrame([("x/é", "some text " * 30), (None, "other"), ("", "b")], "doc_id string, text string")
    assert sorted(map(repr, held(df))) == sorted(repr(want(*r)) for r in [("x/é", "some text " * 30), (None, "other"), ("", "b")])


@pytest.mark.parametrize("n", [3_000_000])
def test_very_long_text(spark, n):
    text = "lé中𝒳 " * (n // 5)
    assert held(spark.createDataFrame([(4, text)], "doc_id long, text string")) == [want(4, text)]


def test_query(spark, sf_dir):
    got = queries.op13_fim(spark, sf_dir)
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("own"))
    assert got.join(texts, "doc_id").where("own = restored_sha256").count() == texts.count()


def test_query_equals_sql(spark, sf_dir):
    import duckdb

    from folia.llm.oracle import ORACLE_SQL

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    sql = con.sql(ORACLE_SQL["op13_fim"])
    got = queries.op13_fim(spark, sf_dir).select(*sql.columns)
    assert sorted(map(tuple, got.collect())) == sorted(sql.fetchall())
