"""What the stages make as named files, which the package's own readers read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .files import write_files


def as_json(df: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``json``: the other columns as an object, nulls kept."""
    rest = [c for c in df.columns if c not in keys]
    return df.select(*keys, F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}).alias("json"))


def page_name(ending: str) -> Column:
    """``page_0001`` and so on, counted from 1, with an ending."""
    return F.format_string(f"page_%04d{ending}", F.col("page_index") + 1)


def page_files(blocks: DataFrame, pages: DataFrame, boxes: DataFrame | None = None) -> DataFrame:
    """``file`` and ``content`` of every page as JSON, one that :func:`.layout.read_layout` reads back.

    A page's blocks come in order of ``block_idx``, with all their columns;
    drawn boxes, where given, are listed as ``detected_boxes``.
    """
    key = ["doc_id", "page_index"]
    own = [c for c in blocks.columns if c not in (*key, "block_idx")]
    held = blocks.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("block_idx", F.struct(*own).alias("b")))).alias("bs"))
    met = pages.join(held.select(*key, F.col("bs.b").alias("parsing_res_list")), key, "left")
    fields = [c for c in pages.columns if c != "doc_id"]
    if boxes is not None:
        drawn = boxes.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("id", F.array("rect.x0", "rect.y0", "rect.x1", "rect.y1").alias("rect"), "width", "height", "type", "line_count"))).alias("detected_boxes"))
        met = met.join(drawn, key, "left")
        fields.append("detected_boxes")
    lists = {c: F.coalesce(c, F.array().cast(met.schema[c].dataType)).alias(c) for c in ("parsing_res_list", "detected_boxes") if c in met.columns}
    body = F.struct(*fields, lists["parsing_res_list"]) if boxes is None else F.struct(*fields[:-1], *lists.values())
    return met.select(F.concat_ws("/", F.col("doc_id").cast("string"), page_name("_0_res.json")).alias("file"), F.to_json(body, {"ignoreNullFields": "false"}).alias("content"))


def html_files(html: DataFrame) -> DataFrame:
    return html.select(F.concat_ws("/", F.col("doc_id").cast("string"), page_name(".html")).alias("file"), F.col("html").alias("content"))


def image_files(images: DataFrame) -> DataFrame:
    """``file`` and ``content`` of block images, a folder a label; those without a picture have no file."""
    stem = F.concat(F.col("json_stem"), F.lit("_block_"), F.col("block_idx").cast("string"), F.lit(".png"))
    return images.where("png is not null").select(F.concat_ws("/", "block_label", stem).alias("file"), F.col("png").alias("content"))


def tree_files(trees: DataFrame, name: str = "") -> DataFrame:
    """The nested tree of each document: ``<doc_id>.json``, or ``<doc_id>/<name>``."""
    file = F.concat_ws("/", F.col("doc_id").cast("string"), F.lit(name)) if name else F.concat(F.col("doc_id").cast("string"), F.lit(".json"))
    return trees.select(file.alias("file"), F.col("tree").alias("content"))


def reference_files(refs: DataFrame, docs: DataFrame, name: str = "references.json") -> DataFrame:
    """The references of each document in ``docs`` (``doc_id``) as one flat list, in order of extraction; empty lists among them."""
    order = ["section_idx", "seq", "part", "ordinal"]
    fields = ["ref_type", "source_id", "target_law", "target_jo", "target_jo_branch", "target_hang", "target_ho", "target_mok", "raw_text", "resolved_id"]
    held = refs.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct(*order, F.struct(*fields).alias("r")))).alias("rs"))
    met = docs.select("doc_id").distinct().join(held, "doc_id", "left")
    content = F.coalesce(F.to_json("rs.r", {"ignoreNullFields": "false"}), F.lit("[]"))
    return met.select(F.concat_ws("/", F.col("doc_id").cast("string"), F.lit(name)).alias("file"), content.alias("content"))


def document_files(files: DataFrame, folder: str = "") -> DataFrame:
    """Files of sections (``doc_id``, ``file``, ``json``) below each document's folder."""
    return files.select(F.concat_ws("/", F.col("doc_id").cast("string"), *([F.lit(folder)] if folder else []), "file").alias("file"), F.col("json").alias("content"))


def meta_files(meta: DataFrame, folder: str = "") -> DataFrame:
    """``document_meta.json`` of each document."""
    body = F.struct(*(c for c in meta.columns if c != "doc_id"))
    return meta.select(F.concat_ws("/", F.col("doc_id").cast("string"), *([F.lit(folder)] if folder else []), F.lit("document_meta.json")).alias("file"), F.to_json(body, {"ignoreNullFields": "false"}).alias("content"))


def write_html(html: DataFrame, path: str) -> int:
    """One HTML file a page, ``<doc_id>/page_0001.html``; the number of pages, counted as they are written."""
    return write_files(html_files(html), path)["files"]


def write_trees(trees: DataFrame, refs: DataFrame, path: str) -> tuple[str, str]:
    """Nested tree JSON and the flat list of references, a file a document each; their places."""
    main, flat = f"{path}/trees", f"{path}/references"
    write_files(tree_files(trees), main)
    write_files(reference_files(refs, trees), flat)
    return main, flat


def section_files(nodes: DataFrame, edges: DataFrame, meta: DataFrame) -> DataFrame:
    """``file`` and ``json`` of every section: its head, nodes and edges."""
    by = ["doc_id", "section_idx"]
    ns = nodes.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("preorder", "id", "label", "properties"))).alias("ns"))
    es = edges.groupBy(*by).agg(F.collect_list(F.struct("source", "target", "type", "properties")).alias("edges"))
    met = meta.join(ns, by).join(es, by, "left")
    body = F.struct(
        F.struct("id", "name", "type").alias("section"),
        F.transform("ns", lambda n: F.struct(n["id"].alias("id"), n["label"].alias("label"), n["properties"].alias("properties"))).alias("nodes"),
        F.coalesce("edges", F.array().cast(es.schema["edges"].dataType)).alias("edges"),
    )
    return met.select("doc_id", "section_idx", "file", F.to_json(body, {"ignoreNullFields": "false"}).alias("json"))


def embedding_files(embeddings: DataFrame, meta: DataFrame) -> DataFrame:
    """``file`` and ``json`` of every section's embedding inputs, a list in preorder; empty lists among them."""
    by = ["doc_id", "section_idx"]
    rest = ["id", "label", "title", "section", "number", "branch", "embedding_text", "token_count", "page"]
    got = embeddings.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("preorder", *rest))).alias("es"))
    listed = F.transform("es", lambda e: F.struct(*(e[c].alias(c) for c in rest)))
    return meta.join(got, by, "left").select("doc_id", "section_idx", F.col("embedding_file").alias("file"), F.coalesce(F.to_json(listed, {"ignoreNullFields": "false"}), F.lit("[]")).alias("json"))


def write_sections(files: DataFrame, path: str) -> None:
    """Files of sections below a folder a document."""
    write_files(document_files(files), path)
