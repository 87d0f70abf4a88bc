"""Readers of page layout JSON, trees and block images."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.fixed import IMAGE_LABELS
from ..functions.geometry import rescaled
from .schemas import LAYOUT

PAGE = ["doc_id", "page_index"]


def read_layout(spark: SparkSession, path: str, pattern: str = "*_res.json") -> DataFrame:
    """One row a page file below ``path``: ``doc_id`` (its folder), ``file_name``, ``modified`` (its time) and the page's fields."""
    raw = spark.read.schema(LAYOUT).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", pattern).json(path)
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1)
    return raw.select("*", folder.alias("doc_id"), F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_modification_time").alias("modified"))


def pages_of(layout: DataFrame) -> DataFrame:
    """The ``pages`` relation: sizes of the image and of the page."""
    return layout.select(*PAGE, "page_count", F.coalesce("image_width", "width").alias("image_width"), F.coalesce("image_height", "height").alias("image_height"), "pdf_width", "pdf_height")


def blocks_of(layout: DataFrame) -> DataFrame:
    """The ``blocks`` relation, a row a block, with boxes in points.

    Raw layout has no content yet and boxes in pixels; pages that went through
    later stages keep what these filled in.
    """
    rows = layout.select(*PAGE, "image_width", "image_height", "width", "height", "pdf_width", "pdf_height", F.posexplode("parsing_res_list").alias("block_idx", "b"))
    raw = F.coalesce("b.image_bbox", "b.block_bbox", F.array().cast("array<double>"))
    wide, high = F.coalesce("image_width", "width"), F.coalesce("image_height", "height")
    points = F.coalesce("b.pdf_bbox", rescaled(raw, wide, high, F.col("pdf_width"), F.col("pdf_height")))
    rest = ["block_label", "block_content", "block_id", "block_order", "text_length", "font_size", "is_bold", "font_name", "inside_box", "box_id"]
    return rows.select(*PAGE, "block_idx", *(F.col(f"b.{c}").alias(c) for c in rest), raw.alias("image_bbox"), points.alias("pdf_bbox"))


def with_page_sizes(layout: DataFrame, sizes: DataFrame) -> DataFrame:
    """Adds page sizes that a page source found; pages without stay as they are, with no boxes in points."""
    return layout.drop("pdf_width", "pdf_height").join(sizes, PAGE, "left")


def image_key(name: Column) -> tuple[Column, Column]:
    """Page stem and block number of an image's file name; the number is -1 if there is none."""
    bare = F.regexp_replace(name, r"\.png$", "")
    parts = F.split(bare, "_block_")
    number = F.get(parts, F.size(parts) - 1).try_cast("int")
    stem = F.array_join(F.slice(parts, 1, F.size(parts) - 1), "_")
    return F.when(F.size(parts) > 1, stem).otherwise(bare), F.when(F.size(parts) > 1, F.coalesce(number, F.lit(-1))).otherwise(-1)


def read_block_images(spark: SparkSession, path: str, label: str | None = None) -> DataFrame:
    """Images of blocks in a folder a label: ``json_stem``, ``block_idx``, ``block_label``, ``block_id``, ``png``."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.png").load(path)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    stem, number = image_key(name)
    named = raw.select(stem.alias("json_stem"), number.alias("block_idx"), F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("block_label"), F.regexp_replace(name, r"\.png$", "").alias("block_id"), F.col("content").alias("png"))
    return named.where(F.col("block_label") == label if label else F.col("block_label").isin(IMAGE_LABELS))


def read_trees(spark: SparkSession, path: str, name: str = "") -> DataFrame:
    """Tree JSON as flat ``nodes``, a row a node in preorder, missing keys as in an empty node.

    A document is named by its file, or by its folder where ``name`` is that of
    all tree files.
    """
    doc = F.regexp_extract("path", r"([^/]+)/[^/]+$" if name else r"([^/]+)\.json$", 1)
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", name or "*.json").load(path).select(doc.alias("doc_id"), "content")
    schema = "doc_id string, preorder long, depth int, node_uid string, parent_uid string, id string, type string, level int, number int, branch int, marker string, title string, content string, page int, metadata string, references string"

    def flatten(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for doc, raw in zip(pdf["doc_id"], pdf["content"], strict=True):
                todo, n = [(json.loads(bytes(raw).decode()), None, 0)], 0
                while todo:
                    node, parent, depth = todo.pop()
                    uid = f"{doc}:{n}"
                    rows.append((doc, n, depth, uid, parent, node.get("id", ""), node.get("type", ""), node.get("level", 0), node.get("number"), node.get("branch"), node.get("marker", ""), node.get("title", ""), node.get("content", ""), node.get("page", 0), json.dumps(node.get("metadata", {}), ensure_ascii=False), json.dumps(node.get("references", []), ensure_ascii=False)))
                    todo += [(c, uid, depth + 1) for c in reversed(node.get("children", []))]
                    n += 1
            out = pd.DataFrame(rows, columns=[c.split(" ")[0] for c in schema.split(", ")])
            yield out.astype({"number": "Int32", "branch": "Int32"})

    return raw.mapInPandas(flatten, schema)


def split_documents(spark: SparkSession, path: str, split: Callable[[bytes], list[bytes]]) -> DataFrame:
    """Pages of binary documents: ``doc_id``, ``page_index``, ``page_count``, ``page`` and ``error``.

    ``split`` turns a document into its pages.  A document that fails gives a
    row with its error, and the others go on.  :func:`.files.read_pages` deals
    the pages of large documents to many tasks.
    """
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).where(F.lower("path").endswith(".pdf"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for doc, content in zip(pdf["doc_id"], pdf["content"], strict=True):
                try:
                    pages = split(bytes(content))
                    rows += [(doc, i, len(pages), p, None) for i, p in enumerate(pages)]
                except Exception as e:  # one document's failure is a row
                    rows.append((doc, None, None, None, str(e)))
            yield pd.DataFrame(rows, columns=["doc_id", "page_index", "page_count", "page", "error"]).astype({"page_index": "Int32", "page_count": "Int32"})

    named = raw.select(F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1).alias("doc_id"), "content")
    return named.mapInPandas(run, "doc_id string, page_index int, page_count int, page binary, error string")


#: Models made in this worker, by a token of the call that asked for them.
_models: dict[str, Callable] = {}


def parse_layout(pages: DataFrame, model: Callable[[], Callable[[bytes], dict]]) -> DataFrame:
    """Layout of page bytes: the columns of ``pages`` but ``page``, with ``layout`` (JSON) and ``error``.

    ``model`` is called once in a Python worker and gives the function that
    makes a page's layout, so a large model is loaded once and not for each
    page or batch.  A page that fails has its error and no layout; an error
    that the page source found stays.
    """
    token = uuid.uuid4().hex

    @F.pandas_udf("struct<layout:string,error:string>")
    def parse(page: pd.Series) -> pd.DataFrame:
        if token not in _models:
            _models.clear()  # one model a worker, also where sessions run several stages
            _models[token] = model()
        rows = []
        for p in page:
            try:
                rows.append((json.dumps(_models[token](bytes(p)), ensure_ascii=False), None))
            except Exception as e:  # a page that fails is a row
                rows.append((None, f"{type(e).__name__}: {e}"))
        return pd.DataFrame(rows, columns=["layout", "error"])

    asked = F.when(F.col("page").isNotNull(), parse("page"))
    met = pages.withColumn("__l", asked)
    old = F.col("error") if "error" in pages.columns else F.lit(None).cast("string")
    return met.select(*(c for c in pages.columns if c not in ("page", "error")), F.col("__l.layout").alias("layout"), F.coalesce(old, "__l.error").alias("error"))


def layout_rows(parsed: DataFrame) -> DataFrame:
    """Pages that have a layout as :func:`read_layout` gives them; page numbers come from the page source."""
    fields = [f.name for f in LAYOUT.fields if f.name not in ("page_index", "page_count")]
    made = parsed.where("layout is not null").withColumn("l", F.from_json("layout", LAYOUT))
    return made.select(*(F.col(f"l.{c}").alias(c) for c in fields), "page_index", "page_count", "doc_id", page_file_name().alias("file_name"))


def page_file_name() -> Column:
    return F.format_string("page_%04d_0_res.json", F.col("page_index") + 1)


def newest_pages(layout: DataFrame) -> DataFrame:
    """Of several files of one page of a document the one written last, of equals the last by name."""
    key = F.struct("modified", "file_name")
    latest = Window.partitionBy(*PAGE).orderBy(F.desc(key))
    return layout.withColumn("__k", F.row_number().over(latest)).where("__k = 1").drop("__k")


def crop_blocks(blocks: DataFrame, pages: DataFrame, crop: Callable[[bytes, list[float], float], bytes | None], zoom: float = 2.0) -> DataFrame:
    """``png`` of every image block, cut from its page by ``crop(page, box, zoom)``; null where that fails."""
    from ..operators.blocks import is_image_block

    met = blocks.where(is_image_block()).join(pages.select(*PAGE, "page"), PAGE)

    @F.pandas_udf("binary")
    def cut(page: pd.Series, box: pd.Series) -> pd.Series:
        def one(p, b):
            try:
                return crop(bytes(p), list(b), zoom)
            except Exception:  # a crop that fails is a null
                return None

        return pd.Series([one(p, b) for p, b in zip(page, box, strict=True)])

    return met.withColumn("png", cut("page", "pdf_bbox")).drop("page")
