"""Questions about the tree, over the flat ``nodes`` relation.

Nodes in preorder with their depths are the tree: a subtree is an interval of
them, and ancestors are the latest nodes of lesser depths.  Windows by section
answer questions on either, over the order that the nodes have already.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed import ASCII_ROMAN, CIRCLED, MOK, SMALL_ROMAN

SECTION = ["doc_id", "section_idx"]
#: Levels of a tree: the section, ten kinds of headings and a special below them.
DEPTHS = 12


def step_matches(step: str) -> Column:
    """Condition on ``type``, ``number`` and ``branch`` of one step of a path."""
    of = lambda kind, n: (F.col("type") == kind) & (F.col("number") == n)
    for kind, branched in (("편", False), ("장", True), ("절", False), ("조", True), ("관", False)):
        if m := re.match(rf"제(\d+){kind}" + (r"(?:의(\d+))?" if branched else "()"), step):
            same = of(kind, int(m[1]))
            return same & (F.col("branch") == int(m[2]) if m[2] else F.col("branch").isNull()) if branched else same
    if step and step in CIRCLED and len(step) == 1:
        return of("항", CIRCLED.index(step) + 1)
    if step.isdigit():
        return of("호", int(step))
    if step in MOK:  # the empty step is found at the first place
        return of("목", MOK.index(step) + 1)
    small = step.strip("()").lower()
    if small in ASCII_ROMAN or len(small) == 1 and small in SMALL_ROMAN:
        return of("세목", (ASCII_ROMAN.index(small) if small in ASCII_ROMAN else SMALL_ROMAN.index(small)) + 1)
    return F.lit(False)


def find_node(nodes: DataFrame, path: str, start: Column | None = None) -> DataFrame:
    """The node that a dotted path leads to from every section (or from nodes where ``start`` holds), the first match at each step."""
    at = nodes.where(start if start is not None else F.col("type") == "section").select("doc_id", F.col("node_uid").alias("from_uid"), F.col("node_uid").alias("parent_uid"))
    small = nodes.select("doc_id", "parent_uid", "node_uid", "preorder", "type", "number", "branch")
    for step in path.split("."):
        hit = at.join(small.where(step_matches(step)), ["doc_id", "parent_uid"])
        at = hit.groupBy("doc_id", "from_uid").agg(F.min_by("node_uid", "preorder").alias("parent_uid"))
    return nodes.join(at.withColumnRenamed("parent_uid", "node_uid"), ["doc_id", "node_uid"])


def of_type(nodes: DataFrame, kind: str) -> DataFrame:
    return nodes.where(F.col("type") == kind).orderBy("doc_id", "preorder")


def nested_sets(nodes: DataFrame) -> DataFrame:
    """Adds ``last``, the ``preorder`` of the last node of each subtree: nodes from ``preorder`` to ``last`` are the subtree.

    One pass over a section's nodes from the end: the subtree of a node ends
    before the nearest later node that is no deeper.
    """
    back = Window.partitionBy(*SECTION).orderBy(F.desc("preorder"))
    after = back.rowsBetween(Window.unboundedPreceding, -1)
    ends = [F.last(F.when(F.col("depth") <= k, F.col("preorder")), ignorenulls=True).over(after) for k in range(DEPTHS)]
    last_of_section = F.max("preorder").over(Window.partitionBy(*SECTION).orderBy(F.desc("preorder")))
    return nodes.withColumn("last", F.coalesce(F.get(F.array(*ends), F.col("depth")) - 1, last_of_section))


def _above(value: Column, where: Column, own: bool, order: str = "preorder") -> Column:
    """``value`` of each ancestor (and the node itself, if ``own``) that ``where`` holds for, the section first.

    In preorder the latest node of a lesser depth is the ancestor of that
    depth, so all ancestors are running values of one window.
    """
    before = Window.partitionBy(*SECTION).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    latest = [F.last(F.when(F.col("depth") == k, F.struct(where.alias("is"), value.alias("value"))), ignorenulls=True).over(before) for k in range(DEPTHS)]
    open_ = F.slice(F.array(*latest), 1, F.col("depth") + (1 if own else 0))
    return F.transform(F.filter(open_, lambda x: x["is"]), lambda x: x["value"])


def subtree_pairs(nodes: DataFrame, top: DataFrame | Column, *carry: str) -> DataFrame:
    """Every node of ``top`` with each node of its subtree, itself among them (columns ``top_uid``, ``rel`` depth).

    ``top`` is a condition, or some rows of ``nodes``.  Columns named in
    ``carry`` come along from the top node as a struct ``top``.  One window
    over the sections gives every node its ancestors, so nothing is joined
    and only true pairs are made.
    """
    if isinstance(top, DataFrame):
        nodes = nodes.join(top.select("doc_id", "node_uid", F.lit(True).alias("__top")), ["doc_id", "node_uid"], "left")
        top = F.coalesce("__top", F.lit(False))
    value = F.struct(F.col("node_uid").alias("top_uid"), F.col("depth").alias("at"), F.struct("node_uid", *carry).alias("top"))
    # paths of a section are in preorder
    order = "preorder" if "preorder" in nodes.columns else "path"
    met = nodes.withColumn("__all", _above(value, F.coalesce(top, F.lit(False)), True, order)).withColumn("__of", F.explode("__all"))
    out = met.withColumns({"top_uid": F.col("__of.top_uid"), "rel": F.col("depth") - F.col("__of.at"), "top": F.col("__of.top")})
    return out.drop("__all", "__of", "__top", *(() if carry else ("top",)))


def joined_text(shown: Column, keep_empty: bool = False) -> Column:
    """Aggregate over the pairs of a top node: what is shown of its subtree in preorder, a line each."""
    held = F.collect_list(F.when(F.lit(True) if keep_empty else shown != "", F.struct("preorder", shown.alias("t"))))
    return F.array_join(F.transform(F.sort_array(held), lambda r: r["t"]), "\n")


def full_text(nodes: DataFrame, top: DataFrame | Column, keep_empty: bool = False) -> DataFrame:
    """``text`` of the subtree of each top node that has any; ``section_idx`` is its section."""
    pairs = subtree_pairs(nodes, top)
    pairs = pairs if keep_empty else pairs.where("content <> ''")
    return pairs.groupBy(*SECTION, "top_uid").agg(joined_text(F.col("content"), keep_empty).alias("text"))


def section_texts(nodes: DataFrame, keep_empty: bool = False) -> DataFrame:
    """``text`` of every section that has any: its subtree is all of its nodes, so no ancestors are asked for."""
    nodes = nodes if keep_empty else nodes.where("content <> ''")
    return nodes.groupBy(*SECTION).agg(joined_text(F.col("content"), keep_empty).alias("text"))


def section_counts(nodes: DataFrame, refs: DataFrame) -> DataFrame:
    """``articles`` and ``refs`` (both of all depths) of every section; one without any has 0."""
    key = ["doc_id", "section_idx"]
    cited = refs.groupBy(*key).agg(F.count(F.lit(1)).alias("refs"))
    held = nodes.groupBy(*key).agg(F.count_if(F.col("type") == "조").alias("articles"))
    return held.join(cited, key, "left").select(*key, "articles", F.coalesce("refs", F.lit(0).cast("long")).alias("refs"))


def all_references(nodes: DataFrame, refs: DataFrame, top: DataFrame | Column) -> DataFrame:
    """References of each node's subtree, in preorder and then in order of extraction."""
    pairs = subtree_pairs(nodes, top)
    pairs = pairs.select("doc_id", "top_uid", "node_uid", *(c for c in ("preorder",) if c in pairs.columns))
    return pairs.join(refs.withColumnRenamed("owner_uid", "node_uid").drop("section_idx"), ["doc_id", "node_uid"])


def tree_lines(nodes: DataFrame, refs: DataFrame, max_depth: int = 99) -> DataFrame:
    """The printed tree: a line a node down to ``max_depth`` below its section."""
    counts = refs.groupBy("doc_id", F.col("owner_uid").alias("node_uid")).agg(F.count(F.lit(1)).alias("refs"))
    shown = nodes.where(F.col("depth") <= max_depth).join(counts, ["doc_id", "node_uid"], "left")
    name = F.concat(F.lit("["), F.when(F.col("marker") != "", F.col("marker")).otherwise(F.col("type")), F.lit("]"))
    title = F.when(F.char_length("title") > 35, F.concat(F.substring("title", 1, 35), F.lit("..."))).otherwise(F.col("title"))
    tail = F.when(F.col("refs") > 0, F.concat(F.lit(" (refs:"), F.col("refs"), F.lit(")"))).otherwise("")
    line = F.concat(F.repeat(F.lit("│   "), F.col("depth")), F.lit("├── "), name, F.lit(" "), title, tail)
    return shown.select("doc_id", "preorder", line.alias("line"))


def nested_json(nodes: DataFrame, refs: DataFrame) -> DataFrame:
    """``doc_id`` and ``tree``: the document as nested JSON, nulls kept, one document a row.

    Nesting is a matter of export; a document is assembled in one group of
    bounded size.
    """
    import json

    import pandas as pd

    cols = ["node_uid", "parent_uid", "id", "type", "level", "number", "branch", "marker", "title", "content", "page"]
    own = refs.select("doc_id", F.col("owner_uid").alias("node_uid"), F.struct("seq", "part", "ordinal", F.to_json(F.struct("ref_type", "source_id", "target_law", "target_jo", "target_jo_branch", "target_hang", "target_ho", "target_mok", "raw_text", "resolved_id"), {"ignoreNullFields": "false"}).alias("json")).alias("r"))
    own = own.groupBy("doc_id", "node_uid").agg(F.sort_array(F.collect_list("r")).alias("rs")).select("doc_id", "node_uid", F.col("rs.json").alias("references"))
    flat = nodes.join(own, ["doc_id", "node_uid"], "left").select("doc_id", "preorder", *cols, F.to_json("metadata").alias("metadata"), "references")

    def assemble(pdf: pd.DataFrame) -> pd.DataFrame:
        made: dict[str, dict] = {}
        tree = {"id": "root", "type": "document", "level": -1, "title": "문서", "children": []}
        for r in pdf.sort_values("preorder").to_dict("records"):
            node = {c: (None if r[c] is None or r[c] != r[c] else int(r[c]) if c in ("level", "number", "branch", "page") else r[c]) for c in cols[2:]}
            node["children"], node["references"] = [], [json.loads(x) for x in (r["references"] if r["references"] is not None else [])]
            node["metadata"] = json.loads(r["metadata"] or "{}")
            made[r["node_uid"]] = node
            (made[r["parent_uid"]] if r["parent_uid"] in made else tree)["children"].append(node)
        return pd.DataFrame({"doc_id": [pdf["doc_id"].iloc[0]], "tree": [json.dumps(tree, ensure_ascii=False)]})

    kind = nodes.schema["doc_id"].dataType.simpleString()
    return flat.groupBy("doc_id").applyInPandas(assemble, f"doc_id {kind}, tree string")


def ancestor_title(kind: str) -> Column:
    """The title of the nearest ancestor of a kind, null without one; an expression over whole ``nodes``."""
    return F.try_element_at(_above(F.col("title"), F.col("type") == kind, own=False), F.lit(-1))
