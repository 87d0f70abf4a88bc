"""Glyph text by columns against one glyph at a time, and glyphs clipped to blocks against all pairs."""

import math
import random
import re
import time

from folia.operators import glyphs

FIELDS = ["doc_id", "page_index", "block_idx", "char_idx", *glyphs.FACTS]
SCHEMA = "doc_id long, page_index int, block_idx int, char_idx long, char string, x0 double, y0 double, x1 double, y1 double, center_x double, center_y double, span_origin double, span_end double"


def kind(c):
    return "korean" if "가" <= c[0] <= "힣" else "hanja" if "一" <= c[0] <= "鿿" else "other"


def one_by_one(chars):
    """Reading text by going through the glyphs in turn."""
    tiers = {}
    for c in chars:
        tiers.setdefault(round(c["y0"] / 3) * 3, []).append(c)
    kept = []
    for tier in tiers.values():
        here = []
        for c in sorted(tier, key=lambda g: g["x0"]):
            if not any(k["char"] == c["char"] and math.hypot(c["center_x"] - k["center_x"], c["center_y"] - k["center_y"]) < 2 for k in here):
                here.append(c)
        kept += here
    lines = []
    for c in kept:
        for line in lines:
            if abs(sum(g["y0"] for g in line) / len(line) - c["y0"]) <= 3:
                line.append(c)
                break
        else:
            lines.append([c])
    texts = []
    for line in sorted(lines, key=lambda x: sum(g["y0"] for g in x) / len(x)):
        line = sorted(line, key=lambda g: g["x0"])
        text = line[0]["char"]
        for a, b in zip(line, line[1:]):
            gap, height = b["x0"] - a["x1"], a["y1"] - a["y0"]
            kinds = {kind(a["char"]), kind(b["char"])}
            wide = "other" not in kinds and gap > height * (0.4 if kinds == {"korean"} else 0.35)
            same = (a["span_origin"], a["span_end"]) == (b["span_origin"], b["span_end"])
            least = max(2.0, (0.25 if wide else 0.4) * height) if same else max(1.5, 0.2 * height)
            text += " " * (gap > least) + b["char"]
        texts.append(text)
    text = re.sub(r"\)\s+", ")", re.sub(r"\s+\(", "(", " ".join(texts)))
    return re.sub(r"\s+", " ", re.sub(r"\s+([,.])", r"\1", text).replace("\n", " ").strip().replace('\\"', ""))


def made(rng, n, spread):
    out = []
    for _ in range(n):
        x, y, w, h = rng.randrange(0, 4 * spread) / 4, rng.choice([rng.randrange(spread) / 8, rng.randrange(5) * 12.0]), rng.choice([4.0, 5.5, 10.0]), rng.choice([8.0, 10.0, 3.0])
        span = rng.randrange(3) * 50.0
        out.append(dict(zip(glyphs.FACTS, (rng.choice("가나다漢字ab12(),. 　é"), x, y, x + w, y + h, x + w / 2, y + h / 2, span, span + 50))))
    return out


def test_text_equals_one_by_one(spark):
    rng = random.Random(8)
    blocks = {(d, d % 3, k): made(rng, rng.choice([1, 2, 5, 30, 80]), rng.choice([20, 80, 300])) for d in range(60) for k in range(5)}
    rows = [(*key, i, *(c[f] for f in glyphs.FACTS)) for key, chars in blocks.items() for i, c in enumerate(chars)]
    rng.shuffle(rows)
    got = {(r.doc_id, r.page_index, r.block_idx): r.text for r in glyphs.block_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {key: one_by_one(chars) for key, chars in blocks.items()}


def test_missing_facts(spark):
    row = [1, 0, 0, 0, "가", 0.0, 0.0, 10.0, 10.0, 5.0, 5.0, 0.0, 50.0]
    rows = [row, *([*row[:k], None, *row[k + 1 :]] for k in range(4, 11)), [1, 0, 0, 9, "", *row[5:]], [1, None, 0, 0, *row[4:11], None, None]]
    got = {(r.page_index, r.text) for r in glyphs.block_text(spark.createDataFrame([tuple(r) for r in rows], SCHEMA)).collect()}
    assert got == {(0, "가"), (None, "가")}
    assert glyphs.block_text(spark.createDataFrame([], SCHEMA)).count() == 0


def test_large_blocks(spark):
    """A block of 200,000 glyphs, as many lines as fit, and the same glyph printed over and over."""
    rng = random.Random(9)
    rows = []
    for k in range(200_000):
        x, y = k % 80 * 6.0, k // 80 * 12.0
        rows.append((1, 0, 0, k, "가", x, y, x + 5, y + 10, x + 2.5, y + 5, 0.0, 480.0))
    for k in range(20_000):
        x = rng.randrange(30) / 30
        rows.append((1, 0, 1, k, "a", x, 0.0, x + 5, 10.0, x + 2.5, 5.0, 0.0, 480.0))
    df = spark.createDataFrame(rows, SCHEMA).cache()
    df.count()
    began = time.time()
    got = {r.block_idx: r.text for r in glyphs.block_text(df).collect()}
    assert time.time() - began < 30
    assert len(got[0].split(" ")) == 2500 and got[1] == "a"


def test_clip_equals_all_pairs(spark):
    rng = random.Random(10)
    chars = [(d, 0, k, rng.choice("가ab"), *(x := rng.uniform(0, 300), y := rng.uniform(-50, 400), x + rng.choice([0.0, 5.0, 40.0]), y + 9.0)) for d in range(4) for k in range(250)]
    chars = [c for c in chars] + [(0, 0, 999, "x", None, 1.0, 2.0, 3.0), (9, 0, 0, "z", 5.0, 5.0, 5.0, 5.0)]
    rects = [(d, 0, k, [x := rng.uniform(-30, 300), y := rng.uniform(-80, 400), x + rng.uniform(0, 250), y + rng.uniform(0, 90)]) for d in range(4) for k in range(20)]
    rects += [(0, 0, 50, []), (0, 0, 51, None), (0, 0, 52, [-1e12, -1e12, 1e12, 1e12]), (9, 0, 1, [0.0, 0.0, 9.0, 9.0]), (7, 0, 0, [0.0, 0.0, 1.0, 1.0])]
    g = spark.createDataFrame(chars, "doc_id long, page_index int, char_idx long, char string, x0 double, y0 double, x1 double, y1 double")
    b = spark.createDataFrame(rects, "doc_id long, page_index int, block_idx int, pdf_bbox array<double>")
    for whole in (False, True):
        want = []
        for c in chars:
            for r in rects:
                if c[0] == r[0] and r[3] and c[4] is not None:
                    (x0, y0, x1, y1), (a0, b0, a1, b1) = c[4:], r[3]
                    if (x0 >= a0 and y0 >= b0 and x1 <= a1 and y1 <= b1) if whole else (x0 < a1 and x1 > a0 and y0 < b1 and y1 > b0):
                        want.append((c[0], r[2], c[2]))
        got = [(r.doc_id, r.block_idx, r.char_idx) for r in glyphs.glyphs_in_blocks(g, b, whole).collect()]
        assert sorted(got) == sorted(want) and len(want) > 100


def test_text_and_font_of_a_box(spark):
    """Blocks get what stands in their boxes: glyphs of a page that know of no block."""
    spans = spark.createDataFrame([(1, 0, 0, 0, 9.0, 16, "Batang", "약관", 0.0, 0.0, 20.0, 10.0), (1, 0, 0, 1, 11.0, 4, "Dotum", "보험", 0.0, 100.0, 20.0, 110.0)], "doc_id long, page_index int, block_idx int, span_idx int, size double, flags int, font string, text string, x0 double, y0 double, x1 double, y1 double")
    from pyspark.sql import functions as F

    chars = glyphs.expand_spans(spans).withColumn("char_idx", F.col("span_idx") * 1000 + F.col("x0")).drop("block_idx")
    blocks = spark.createDataFrame([(1, 0, 4, "text", "old", [0.0, -1.0, 30.0, 11.0]), (1, 0, 5, "paragraph_title", "old", [0.0, 90.0, 12.0, 120.0]), (1, 0, 6, "table", "old", [0.0, 0.0, 500.0, 500.0]), (1, 0, 7, "text", "old", [300.0, 300.0, 400.0, 400.0])], "doc_id long, page_index int, block_idx int, block_label string, block_content string, pdf_bbox array<double>")
    got = {r.block_idx: (r.block_content, r.text_length, r.font_size, r.is_bold, r.font_name) for r in glyphs.clip_text(blocks, chars, spans).collect()}
    assert got == {4: ("약관", 2, 9.0, True, "Batang"), 5: ("보험", 2, 11.0, False, "Dotum"), 6: ("old", None, None, None, None), 7: ("", 0, None, None, None)}


def test_pages_of_few_glyphs_are_not_dealt_to_cells(spark):
    """Thousands of pages of one glyph each, under a block that covers the page: one pair a page, however fine the grid."""
    from pyspark.sql import functions as F

    pages = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit(0).alias("page_index"))
    g = pages.select("*", F.lit(0).alias("char_idx"), *(F.lit(v).alias(c) for c, v in zip(("x0", "y0", "x1", "y1"), (0.0, 0.0, 9.0, 9.0), strict=True)))
    b = pages.select("*", F.lit(3).alias("block_idx"), F.array(*map(F.lit, (-1.0, -1.0, 99.0, 99.0))).alias("pdf_bbox"))
    began = time.time()
    assert glyphs.glyphs_in_blocks(g, b, cells=256).count() == 2000
    assert time.time() - began < 20
