"""Graph node and edge lists, embedding inputs and document summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import LABELS
from ..functions.patterns import section_type
from ..functions.text import safe_filename, safe_id, token_count
from .tree import ancestor_title, joined_text, subtree_pairs

SECTION = ["doc_id", "section_idx"]


def graph_nodes(nodes: DataFrame) -> DataFrame:
    label = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in LABELS.items() for x in kv)), F.col("type")), F.lit("Node"))
    is_section = F.col("type") == "section"
    below = lambda c: F.when(~is_section, F.col(c)).alias(c)
    properties = F.struct(
        F.when(is_section, F.col("title")).alias("name"),
        F.when(is_section, section_type(F.col("title"))).otherwise(F.col("type")).alias("type"),
        *(below(c) for c in ("number", "branch", "marker", "title", "content")),
        F.col("page"),
    )
    return nodes.select(*SECTION, "preorder", F.col("section_name").alias("section_id"), "id", label.alias("label"), properties.alias("properties"))


def graph_edges(nodes: DataFrame, refs: DataFrame) -> DataFrame:
    """HAS_CHILD for every node below a section, REFERENCES for resolved references, CITES_LAW for external ones."""
    named = nodes.where("type = 'section'").select(*SECTION, F.col("section_name").alias("section_id"))
    return edges(nodes, refs).join(named, SECTION).select(*SECTION, "section_id", "source", "target", "type", "properties")


def edges(nodes: DataFrame, refs: DataFrame) -> DataFrame:
    """The same without the sections' names.  Nodes know their parent's id and references their node's, so nothing is joined."""
    empty = F.lit(None).cast("struct<raw_text:string,target_jo:int,target_hang:int,law:string,article:int>").alias("properties")
    if "parent_id" not in nodes.columns:  # nodes that were read from files
        parents = nodes.select("doc_id", F.col("node_uid").alias("parent_uid"), F.col("id").alias("parent_id"))
        nodes = nodes.join(parents, ["doc_id", "parent_uid"])
    child = nodes.where("parent_id is not null and doc_id is not null").select(*SECTION, F.col("parent_id").alias("source"), F.col("id").alias("target"), F.lit("HAS_CHILD").alias("type"), empty)
    external = F.col("ref_type") == "external"
    used = refs.where((external | F.col("resolved_id").isNotNull()) & F.col("doc_id").isNotNull())
    properties = F.struct(
        "raw_text",
        F.when(~external, F.col("target_jo")).alias("target_jo"),
        F.when(~external, F.col("target_hang")).alias("target_hang"),
        F.when(external, F.col("target_law")).alias("law"),
        F.when(external, F.col("target_jo")).alias("article"),
    )
    target = F.when(external, F.concat_ws("_", F.lit("law"), "target_law", F.col("target_jo").cast("string"))).otherwise(F.col("resolved_id"))
    cites = used.select(*SECTION, F.col("source_id").alias("source"), target.alias("target"), F.when(external, "CITES_LAW").otherwise("REFERENCES").alias("type"), properties.alias("properties"))
    return child.unionByName(cites)


def embedding_inputs(nodes: DataFrame) -> DataFrame:
    """One text an article, with all below it and its chapter's title, and one a special on laws or explanations."""
    marked = lambda own: F.when(F.col("rel") == 0, own)
    head = F.concat_ws("\n", F.when((F.col("marker") != "") & (F.col("title") != ""), F.concat("marker", F.lit(" ("), "title", F.lit(")"))), F.nullif("content", F.lit("")))
    shown = marked(head).otherwise(F.when(F.col("marker") != "", F.concat("marker", F.lit(" "), "content")).otherwise(F.col("content")))
    carried = ["preorder", "id", "title", "section_name", "number", "branch", "page", "context"]
    pairs = subtree_pairs(nodes.withColumn("context", ancestor_title("관")), F.col("type") == "조", *carried)
    # the order of nodes by section is all that this takes; an article's own facts come with its subtree
    found = pairs.groupBy(*SECTION, "top_uid").agg(joined_text(shown).alias("text"), F.first("top").alias("top")).select(*SECTION, "text", *(f"top.{c}" for c in carried))
    text = F.concat(F.when(F.coalesce("context", F.lit("")) != "", F.concat(F.lit("["), "context", F.lit("]\n"))).otherwise(""), F.coalesce("text", F.lit("")))
    jo = found.select(*SECTION, "preorder", "id", F.lit("Jo").alias("label"), "title", F.col("section_name").alias("section"), "number", "branch", text.alias("embedding_text"), "page")
    none = F.lit(None).cast("int")
    special = nodes.where("type = 'special' and (marker like '%법규%' or marker like '%설명%')")
    special = special.select(*SECTION, "preorder", "id", F.lit("Special").alias("label"), F.col("marker").alias("title"), F.col("section_name").alias("section"), none.alias("number"), none.alias("branch"), F.col("content").alias("embedding_text"), "page")
    return jo.unionByName(special).withColumn("token_count", token_count(F.col("embedding_text")))


def sections_meta(nodes: DataFrame, edges: DataFrame, embeddings: DataFrame) -> DataFrame:
    """A row a section: names of its files and what it holds."""
    count = lambda df, name: df.groupBy(*SECTION).agg(F.count(F.lit(1)).alias(name))
    got = nodes.where("type = 'section'").select(*SECTION, "id", F.col("title").alias("name"), section_type(F.col("title")).alias("type"))
    for df, name in ((nodes, "node_count"), (edges, "edge_count"), (embeddings, "embedding_count")):
        got = got.join(count(df, name), SECTION, "left").withColumn(name, F.coalesce(name, F.lit(0)).cast("long"))
    idx = F.col("section_idx")
    prefix = F.concat(F.when(idx < 10, F.concat(F.lit("0"), idx)).otherwise(idx.cast("string")), F.lit("_"), safe_filename(F.col("name")))
    return got.withColumns({"file": F.concat(F.lit("sections/"), prefix, F.lit(".json")), "embedding_file": F.concat(F.lit("embeddings/"), prefix, F.lit("_embeddings.json"))})


def extends_relations(nodes: DataFrame) -> DataFrame:
    """Special and additional terms whose text speaks of the general terms EXTEND the first section of that name."""
    base = nodes.where("type = 'section' and title like '%보통약관%'").groupBy("doc_id").agg(F.min_by("id", "section_idx").alias("target"))
    speaks = nodes.groupBy(*SECTION).agg(F.max(F.col("content").contains("보통약관")).alias("speaks"))
    named = nodes.where("type = 'section' and (title like '%추가약관%' or title like '%특별약관%')")
    return named.join(speaks.where("speaks"), SECTION).join(base, "doc_id").select(*SECTION, F.col("id").alias("source"), "target", F.lit("EXTENDS").alias("type"))


def document_meta(meta: DataFrame, relations: DataFrame, name: str = "문서") -> DataFrame:
    """A row a document with its sections and their relations."""
    parts = meta.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("section_idx", "id", "name", "type", "file", "embedding_file", "node_count", "edge_count", "embedding_count"))).alias("sections"), F.count(F.lit(1)).alias("total_sections"))
    links = relations.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("section_idx", "source", "target", "type"))).alias("section_relations"))
    return parts.join(links, "doc_id", "left").withColumns({"id": F.concat(F.lit("doc_"), safe_id(F.lit(name))), "name": F.lit(name)})


def totals(meta: DataFrame) -> DataFrame:
    """Counts a section and in all (null section)."""
    return meta.rollup("doc_id", "section_idx").agg(F.sum("node_count").alias("nodes"), F.sum("edge_count").alias("edges"), F.sum("embedding_count").alias("embeddings"))
