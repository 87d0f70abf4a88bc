"""Text of a block from its glyphs, and its font from its spans."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import whole_groups
from ..functions.fixed import LINE_GAP, SAME_GLYPH
from ..functions.geometry import from_array

PAGE = ["doc_id", "page_index"]
BLOCK = [*PAGE, "block_idx"]
FACTS = ["char", "x0", "y0", "x1", "y1", "center_x", "center_y", "span_origin", "span_end"]
#: Most cells on each side of a page's grid, glyphs of a page that needs none, and most numbers of the state of line clustering.
GRID, FEW = 16, 128
_STATE = 2_000_000


def expand_spans(spans: DataFrame) -> DataFrame:
    """Glyphs of spans that have text but no glyph boxes: equal widths along the span."""
    n = F.char_length("text")
    at = spans.where(n > 0).withColumn("i", F.explode(F.sequence(F.lit(0), n - 1)))
    width = (F.col("x1") - F.col("x0")) / n
    left = F.col("x0") + F.col("i") * width
    right = F.col("x0") + (F.col("i") + 1) * width
    return at.select(*BLOCK, F.col("span_idx"), F.substring("text", F.col("i") + 1, F.lit(1)).alias("char"), left.alias("x0"), F.col("y0"), right.alias("x1"), F.col("y1"), ((left + right) / 2).alias("center_x"), ((F.col("y0") + F.col("y1")) / 2).alias("center_y"), F.col("x0").alias("span_origin"), F.col("x1").alias("span_end"))


def glyphs_in_blocks(glyphs: DataFrame, blocks: DataFrame, whole: bool = False, cells: int = GRID) -> DataFrame:
    """Glyphs of a page with the ``block_idx`` of each block whose ``pdf_bbox`` they reach into (or lie in, if ``whole``).

    A page of up to FEW glyphs meets its blocks as it is.  The glyphs of a larger
    one span a grid, the finer the more they are, of ``cells`` by ``cells`` at
    most; its glyphs and blocks are dealt to the cells that they touch and meet
    there, so a page with many of both is no product of the two and its cells
    spread over tasks.  A pair that meets in several cells counts in the one
    that holds its top left common corner.  A glyph is given once for each block
    that it is in; blocks whose box has not four numbers, and glyphs without
    coordinates, take no part.
    """
    side = ("x0", "y0", "x1", "y1")
    known = glyphs.where(" and ".join(f"{c} is not null" for c in side) + " and x0 <= x1 and y0 <= y1")
    extent = known.groupBy(*PAGE).agg(F.count(F.lit(1)).alias("n"), F.min("x0").alias("px"), F.min("y0").alias("py"), F.max("x1").alias("qx"), F.max("y1").alias("qy"))
    few = extent.where(F.col("n") <= FEW).select(*PAGE)
    fine = F.least(F.ceil(F.sqrt(F.col("n") / FEW)), F.lit(cells)).cast("int")
    many = extent.where(F.col("n") > FEW).withColumn("side", fine)
    many = many.select(*PAGE, "px", "py", "side", *((F.greatest(F.col(q) - F.col(p), F.lit(1e-6)) / F.col("side")).alias(w) for p, q, w in (("px", "qx", "cw"), ("py", "qy", "ch"))))

    def cell(v: Column, start: str, size: str) -> Column:
        return F.least(F.greatest(F.floor((v - F.col(start)) / F.col(size)), F.lit(0)), F.col("side") - 1).cast("int")

    def dealt(df: DataFrame, x0: Column, y0: Column, x1: Column, y1: Column) -> DataFrame:
        columns = F.explode(F.sequence(cell(x0, "px", "cw"), cell(x1, "px", "cw")))
        rows = F.explode(F.sequence(cell(y0, "py", "ch"), cell(y1, "py", "ch")))
        return df.join(many, PAGE).withColumn("__cx", columns).withColumn("__cy", rows)

    of = [F.col(c) for c in side]
    box = from_array(F.col("pdf_bbox"))
    rects = blocks.select(*PAGE, "block_idx", box.alias("__b")).where("__b is not null and __b.x0 <= __b.x1 and __b.y0 <= __b.y1")
    # a glyph's own block, if it has one, makes way for those that it is found in
    known = known.select(*(c for c in glyphs.columns if c != "block_idx"))
    r = F.col("__b")
    if whole:
        inside = (of[0] >= r["x0"]) & (of[1] >= r["y0"]) & (of[2] <= r["x1"]) & (of[3] <= r["y1"])
    else:
        inside = (of[0] < r["x1"]) & (of[2] > r["x0"]) & (of[1] < r["y1"]) & (of[3] > r["y0"])
    out = [*PAGE, "block_idx", *(c for c in glyphs.columns if c not in BLOCK)]
    plain = known.join(rects.join(few, PAGE), PAGE).where(inside).select(*out)
    a = dealt(known, *of)
    b = dealt(rects, *(F.col("__b")[c] for c in side)).drop("px", "py", "cw", "ch", "side")
    here = (cell(F.greatest(of[0], r["x0"]), "px", "cw") == F.col("__cx")) & (cell(F.greatest(of[1], r["y0"]), "py", "ch") == F.col("__cy"))
    met = a.join(b, [*PAGE, "__cx", "__cy"]).where(inside & here).select(*out)
    return plain.unionByName(met)


def _first_twins(group: np.ndarray, char: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which glyphs, in order within a row of glyphs, are printed again near one that stays.

    Only glyphs of one row and character with a neighbour in x can be twins;
    these few are gone through in their order.
    """
    gone = np.zeros(len(group), bool)
    order = np.lexsort((x, char, group))
    near = (group[order][1:] == group[order][:-1]) & (char[order][1:] == char[order][:-1]) & (np.diff(x[order]) < SAME_GLYPH)
    if not near.any():
        return gone
    run = np.concatenate([[0], np.cumsum(~near)])
    crowded = np.flatnonzero(np.bincount(run) > 1)
    lo, hi = np.searchsorted(run, crowded), np.searchsorted(run, crowded, "right")
    for a, b in zip(lo.tolist(), hi.tolist(), strict=True):
        # kept glyphs are looked up by square cells that two near ones share or adjoin
        kept: dict[tuple[float, float], list[int]] = {}
        for i in np.sort(order[a:b]).tolist():
            cx, cy = x[i] // SAME_GLYPH, y[i] // SAME_GLYPH
            others = (j for dx in (-1, 0, 1) for dy in (-1, 0, 1) for j in kept.get((cx + dx, cy + dy), ()))
            if any(((x[i] - x[j]) ** 2 + (y[i] - y[j]) ** 2) ** 0.5 < SAME_GLYPH for j in others):
                gone[i] = True
            else:
                kept.setdefault((cx, cy), []).append(i)
    return gone


def _clustered(block: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For glyphs in order: the line that takes each, in order of the lines' making, and the lines' final mean heights.

    The first line of a block whose mean is near takes a glyph, and its mean
    follows.  Glyphs of one height that follow one another go to one line, so
    a step is such a run; the steps of many blocks are taken at once.
    """
    new = np.concatenate([[True], (block[1:] != block[:-1]) | (y[1:] != y[:-1])])
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(y)))
    of, height = block[start], y[start]
    first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    runs = np.diff(np.append(first, len(of)))
    line, mean = np.empty(len(of), np.int64), np.empty(len(of))
    order = np.argsort(-runs, kind="stable")
    lo = 0
    while lo < len(order):
        deep = int(runs[order[lo]])
        part = order[lo : lo + max(1, _STATE // deep)]
        lo += len(part)
        means, sums, counts = np.full((len(part), 4), np.nan), np.zeros((len(part), 4)), np.zeros((len(part), 4))
        used = np.zeros(len(part), np.int64)
        for t in range(deep):
            n = int(np.searchsorted(-runs[part], -t))  # blocks that have a run t come first
            at = first[part[:n]] + t
            wide = max(1, int(used[:n].max()))
            near = np.abs(means[:n, :wide] - height[at, None]) <= LINE_GAP
            to = np.where(near.any(1), near.argmax(1), used[:n])
            if to.max() >= means.shape[1]:
                means, sums, counts = (np.concatenate([m, np.full_like(m, fill)], 1) for m, fill in ((means, np.nan), (sums, 0), (counts, 0)))
            who = np.arange(n)
            used[:n] = np.maximum(used[:n], to + 1)
            sums[who, to] += height[at] * size[at]
            counts[who, to] += size[at]
            means[who, to] = sums[who, to] / counts[who, to]
            line[at] = to
        for t in range(deep):
            n = int(np.searchsorted(-runs[part], -t))
            at = first[part[:n]] + t
            mean[at] = means[np.arange(n), line[at]]
    return np.repeat(line, size), np.repeat(mean, size)


def _is(first: np.ndarray, lo: str, hi: str) -> np.ndarray:
    return (first >= ord(lo)) & (first <= ord(hi))


def assemble(chars: list[dict]) -> str:
    """Reading text of the glyphs of one block."""
    held = pa.Table.from_pylist(chars, pa.schema([(c, pa.float64() if c != "char" else pa.string()) for c in FACTS])).combine_chunks()
    return assembled(held.to_batches()[0], np.zeros(len(chars), np.int64))[0] if chars else ""


def assembled(batch: pa.RecordBatch, block: np.ndarray) -> list[str]:
    """Reading text of each block (numbers from 0) of a batch of glyphs in order of appearance."""
    x0, y0, x1, y1, cx, cy, origin, end = (batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in FACTS[1:])
    code = pc.dictionary_encode(batch.column("char"))
    shown = np.array(code.dictionary.to_pylist(), object)
    char = code.indices.to_numpy()
    # rows of glyphs by rounded height, in order of first appearance
    tier = np.round(y0 / LINE_GAP) * LINE_GAP
    by = np.lexsort((tier, block))
    new = np.concatenate([[True], (block[by][1:] != block[by][:-1]) | (tier[by][1:] != tier[by][:-1])])
    seen = np.empty(len(by), np.int64)
    seen[by] = np.minimum.reduceat(by, np.flatnonzero(new))[np.cumsum(new) - 1]
    order = np.lexsort((x0, seen))
    order = order[~_first_twins(seen[order], char[order], cx[order], cy[order])]
    line, mean = _clustered(block[order], y0[order])
    order = order[(by := np.lexsort((x0[order], line, mean, block[order])))]
    b, row = block[order], line[by]
    gap, height = x0[order][1:] - x1[order][:-1], (y1 - y0)[order][:-1]
    first = np.array([ord(c[0]) for c in shown])[char[order]]
    korean, hanja = _is(first, "가", "힣"), _is(first, "一", "\u9fff")
    written = korean | hanja
    wide = written[1:] & written[:-1] & (gap > height * np.where(korean[1:] & korean[:-1], 0.4, 0.35))
    one_span = (origin[order][1:] == origin[order][:-1]) & (end[order][1:] == end[order][:-1])
    least = np.where(one_span, np.maximum(2.0, np.where(wide, 0.25, 0.4) * height), np.maximum(1.5, 0.2 * height))
    last = b[1:] != b[:-1]
    space = np.append(~last & ((row[1:] != row[:-1]) | (gap > least)), False)
    parts = shown[char[order]].tolist()
    for i in np.flatnonzero(space).tolist():
        parts[i] += " "
    ends = np.append(np.flatnonzero(last) + 1, len(parts)).tolist()
    return [_tidied("".join(parts[a:b])) for a, b in zip([0, *ends], ends, strict=False)]


def _tidied(text: str) -> str:
    text = re.sub(r"\s+\(", "(", text)
    text = re.sub(r"\s+([,.])", r"\1", re.sub(r"\)\s+", ")", text))
    return re.sub(r"\s+", " ", text.replace("\n", " ").strip().replace('\\"', ""))


def block_text(chars: DataFrame) -> DataFrame:
    """``text`` and ``text_length`` of every block that has glyphs.

    ``char_idx`` gives the glyphs' order of appearance; glyphs that are empty
    or lack a coordinate are left out.  Pages are dealt by hash and sorted, and
    a task takes many blocks at once as columns; a block is in memory as a
    whole.
    """
    kinds = {f.name: f.dataType.simpleString() for f in chars.schema}
    schema = ", ".join(f"{k} {kinds[k]}" for k in BLOCK) + ", text string, text_length int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in whole_groups(batches, BLOCK):
            texts = assembled(batch, block)
            at = pa.array(np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])))
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(at) for k in BLOCK), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int32())], [*BLOCK, "text", "text_length"])

    held = chars.where(" and ".join(f"{c} is not null" for c in FACTS if c not in ("span_origin", "span_end")) + " and char <> ''")
    dealt = held.select(*BLOCK, *FACTS, "char_idx").repartition("doc_id", "page_index").sortWithinPartitions(*BLOCK, "char_idx")
    return dealt.select(*BLOCK, *FACTS).mapInArrow(run, schema)


def font_summary(spans: DataFrame, keys: list[str] = BLOCK) -> DataFrame:
    """Mean size, whether most spans are bold, and the commonest font (of equals the first by name)."""
    bold = F.coalesce(F.col("flags").bitwiseAND(16) != 0, F.lit(False))
    return spans.groupBy(*keys).agg(
        F.bround(F.avg("size"), 2).alias("font_size"),
        (F.count_if(bold) * 2 > F.count(F.lit(1))).alias("is_bold"),
        F.mode(F.nullif("font", F.lit("")), deterministic=True).alias("font_name"),
    )


def clip_text(blocks: DataFrame, glyphs: DataFrame, spans: DataFrame, whole: bool = False) -> DataFrame:
    """Blocks of text labels with the text and font of what stands in their ``pdf_bbox``; others as they are.

    ``glyphs`` and ``spans`` are those of whole pages, with ``span_idx`` and, on
    glyphs, ``char_idx``.  A span belongs to a block if one of its glyphs does.
    """
    from .blocks import is_text_block

    chars = glyphs_in_blocks(glyphs, blocks.where(is_text_block()), whole)
    own = chars.select(*BLOCK, "span_idx").distinct().join(spans.drop("block_idx"), [*PAGE, "span_idx"])
    return fill_text(blocks, chars, own)


def fill_text(blocks: DataFrame, chars: DataFrame, spans: DataFrame) -> DataFrame:
    """Blocks of text labels with their text and font; others as they are."""
    from .blocks import is_text_block

    facts = block_text(chars).join(font_summary(spans), BLOCK, "left")
    met = blocks.join(facts, BLOCK, "left")
    take = lambda new, old: F.when(is_text_block(), new).otherwise(old)
    return met.withColumns({"block_content": take(F.coalesce("text", F.lit("")), F.col("block_content")), "text_length": take(F.coalesce("text_length", F.lit(0)), F.lit(None))}).drop("text")
