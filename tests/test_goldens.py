"""Small hand-derived cases of FIXTURES.md and of the plain-Python helpers."""

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folia.functions import geometry as G
from folia.functions import patterns as P
from folia.functions import text as X
from folia.operators import blocks as B
from folia.operators import boxes, glyphs, vlm
from folia.sources import config
from folia.sources.layout import image_key


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def rect(*v):
    return G.rect(*(F.lit(float(x)) for x in v))


def test_rescale(spark):
    box = lambda *v: F.array(*(F.lit(float(x)) for x in v))
    sizes = [F.lit(x) for x in (1000, 2000, 500.0, 1000.0)]
    r = one(spark, G.rescaled(box(10, 20, 30, 40), *sizes).alias("a"), G.rescaled(box(1, 2, 3), *sizes).alias("b"), G.rescaled(box(1, 2, 3, 4), F.lit(0), *sizes[1:]).alias("c"))
    assert (r.a, r.b, r.c) == ([5.0, 10.0, 15.0, 20.0], [], [])


def test_iou_and_inside(spark):
    r = one(
        spark,
        G.iou(rect(0, 0, 10, 10), rect(5, 0, 15, 10)).alias("third"),
        G.iou(rect(0, 0, 10, 10), rect(10, 0, 20, 10)).alias("touch"),
        G.mostly_inside(rect(10, 10, 110, 30), rect(30, 0, 200, 100), 2.0).alias("out"),
        G.is_horizontal(*(F.lit(1.0),) * 4).alias("h"),
        G.is_vertical(*(F.lit(1.0),) * 4).alias("v"),
    )
    assert r.third == pytest.approx(1 / 3) and (r.touch, r.out, r.h, r.v) == (0.0, False, False, False)


def ordered(spark, rows):
    df = spark.createDataFrame([("d", 0, i, *r) for i, r in enumerate(rows)], "doc_id string, page_index int, block_idx int, block_order double, y double, block_id int")
    return [round(r.block_order, 6) for r in B.fill_block_order(df).orderBy("block_idx").collect()]


def test_block_order(spark):
    rows = [(None, 5.0, 0), (1.0, 10.0, 1), (None, 20.0, 2), (None, 30.0, 3), (4.0, 40.0, 4), (None, 50.0, 5)]
    assert ordered(spark, rows) == [0.9, 1, 2, 3, 4, 4.1]
    assert ordered(spark, [(None, 1.0, 3), (None, 2.0, 1), (None, 3.0, 2)]) == [3, 1, 2]
    assert ordered(spark, [(1.0, 10.0, 1), (None, 10.0, 2), (3.0, 30.0, 3)]) == [1, 4, 3]


def test_reading_rank(spark):
    df = spark.createDataFrame([("d", 0, 0, None, 1), ("d", 0, 1, 2.0, 9), ("d", 0, 2, 1.0, 5)], "doc_id string, page_index int, block_idx int, block_order double, block_id int")
    assert [r.block_id for r in B.reading_rank(df).orderBy("rank").collect()] == [5, 9, 1]


def test_smallest_box_that_holds(spark):
    blocks = spark.createDataFrame([("d", 0, 0, [10.0, 10.0, 110.0, 30.0]), ("d", 0, 1, [])], "doc_id string, page_index int, block_idx int, pdf_bbox array<double>")
    made = spark.createDataFrame([("d", 0, 0, (0.0, 0.0, 200.0, 100.0)), ("d", 0, 1, (5.0, 5.0, 150.0, 50.0))], "doc_id string, page_index int, id int, rect struct<x0:double,y0:double,x1:double,y1:double>")
    got = {r.block_idx: (r.inside_box, r.box_id) for r in boxes.assign_boxes(blocks, made).collect()}
    assert got == {0: (True, 1), 1: (False, None)}


def rectangle(i, x0, y0, x1, y1):
    sides = [(x0, y0, x1, y0), (x1, y0, x1, y1), (x0, y1, x1, y1), (x0, y0, x0, y1)]
    return [("d", 0, i * 4 + k, "l", *map(float, s)) for k, s in enumerate(sides)]


def test_boxes_from_segments(spark):
    rows = rectangle(0, 0, 0, 120, 60) + rectangle(1, 500, 0, 590, 60) + rectangle(2, 0, 300, 400, 500) + rectangle(3, 10, 310, 390, 490)
    df = spark.createDataFrame(rows, "doc_id string, page_index int, seg_idx int, kind string, x0 double, y0 double, x1 double, y1 double")
    got = boxes.detect_boxes(df).orderBy("id").collect()
    assert [(r.id, r.rect.x1 - r.rect.x0, r.line_count) for r in got] == [(0, 400.0, 4), (1, 120.0, 4)]


def test_formula_and_filenames(spark):
    df = spark.createDataFrame([("text", "x\ue001y"), ("table", "\ue001x"), ("text", "x")], "block_label string, block_content string")
    assert [r.block_label for r in B.relabel_formulas(df).collect()] == ["formula", "table", "text"]
    r = one(spark, X.safe_filename(F.lit("A/B: 약관  C")).alias("f"), X.punctuation(F.lit("제1조 (목적) 이 , 계약 .")).alias("p"))
    assert (r.f, r.p) == ("AB_약관_C", "제1조(목적)이, 계약.")


def test_types_and_specials(spark):
    names = ["OO 특별약관", "민법", "분쟁 사례", "기타"]
    assert list(one(spark, *(P.section_type(F.lit(n)).alias(f"c{i}") for i, n in enumerate(names)))) == ["special", "law_reference", "dispute", "other"]
    texts = ["[별표1] 표", "※ 용어의 정의", "비고", "【법규3】 보험업법", "보통 글"]
    got = one(spark, *(P.global_special(F.lit(t)).alias(f"c{i}") for i, t in enumerate(texts)))
    assert [(g.type, g.marker) if g else None for g in got] == [("appendix", "[별표1]"), ("glossary", "※용어정의"), ("note", "비고"), ("law_reference", "법규정"), None]


def test_image_names(spark):
    stem, number = image_key(F.col("n"))
    df = spark.createDataFrame([("page_0001_0_res_block_3.png",), ("a_block_b_block_7.png",), ("odd.png",), ("x_block_y.png",)], "n string")
    assert [tuple(r) for r in df.select(stem.alias("s"), number.alias("k")).collect()] == [("page_0001_0_res", 3), ("a_b", 7), ("odd", -1), ("x", -1)]


def test_missing_images(spark):
    df = spark.createDataFrame([("d", 0, 0, "table", "", [0.0] * 4, "p_0_res")], "doc_id string, page_index int, block_idx int, block_label string, block_content string, pdf_bbox array<double>, file_stem string")
    none = spark.createDataFrame([], "json_stem string, block_idx int, block_label string, block_id string, png binary")
    assert vlm.fill_images(df, none, vlm.stub_backend, batch=False).first().block_content == "[이미지 파일 없음: p_0_res_block_0.png]"
    assert vlm.fill_images(df, none, vlm.stub_backend, batch=True).first().block_content == ""


def test_model_failures_leave_their_text(spark):
    def broken(png, label, prompt):
        raise ValueError("no answer")

    images = spark.createDataFrame([("table", bytearray(b"x"))], "block_label string, png binary")
    r = vlm.describe(images, broken).first()
    assert (r.answer, r.failed) == ("no answer", True)
    assert vlm.by_label({"table": lambda png: "ok"})(b"", "table", "") == "ok"


def glyph(c, x, y=0.0, w=5.0, span=0):
    return {"char": c, "x0": x, "y0": y, "x1": x + w, "y1": y + 10, "center_x": x + w / 2, "center_y": y + 5, "span_origin": span, "span_end": span + 100}


def test_glyph_assembly():
    line = [glyph("가", 0), glyph("나", 5.1), glyph("나", 5.6), glyph("다", 15.0), glyph("x", 21), glyph("(", 40), glyph("밑", 0, 30)]
    assert glyphs.assemble(line) == "가나 다x( 밑"
    assert glyphs.assemble([glyph("a", 0, span=0), glyph("b", 7.5, span=1)]) == "a b"
    assert glyphs.assemble([]) == ""


def test_fonts(spark):
    rows = [("d", 0, 0, 10.0, 16, "B"), ("d", 0, 0, 11.0, 16, "A"), ("d", 0, 0, 11.5, 0, "")]
    r = glyphs.font_summary(spark.createDataFrame(rows, "doc_id string, page_index int, block_idx int, size double, flags int, font string")).first()
    assert (r.font_size, r.is_bold, r.font_name) == (10.83, True, "A")


def test_steps_and_errors():
    assert config.parse_steps("3-5,6") == {3, 4, 5, 6} and config.parse_steps("") == set()
    assert str(config.TextExtractionError("bad", "text")) == "[text] bad" and str(config.PipelineError("bad")) == "bad"


def test_env_file(tmp_path):
    f = tmp_path / ".env"
    f.write_text("﻿# comment\nINPUT_PATH='a b.pdf'\nVLM_BATCH_SIZE=3\nnot a setting\n", encoding="utf-8")
    c = config.Config.load(f)
    assert (c.input_path, c.vlm_batch_size) == ("a b.pdf", 3)
    f.write_text("VLM_BATCH_SIZE=x")
    with pytest.raises(config.ConfigError):
        config.Config.load(f)


@given(st.text("가나다제조항12 ()의상법", max_size=40), st.integers(0, 5))
def test_references_stand_in_the_text(text, article):
    from folia.operators.references import find_references

    for r in find_references(text, article):
        assert r[7] in text and r[0] in ("external", "internal")
