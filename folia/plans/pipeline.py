"""The document pipeline as stages over relations, each written for the next."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import blocks as B
from ..operators import boxes, glyphs, graph, hierarchy, references, render, sections, tree, vlm
from ..sources import layout, sinks
from ..sources.config import Config, PipelineError, parse_steps
from ..sources.files import write_files

#: Stages in order, with what a failure does: stop the run or leave the stage's outputs away.
ORDER = {"layout": "stop", "boxes": "warn", "text": "stop", "order": "stop", "crops": "warn", "html": "warn", "vlm": "warn", "hierarchy": "warn", "export": "warn", "files": "warn"}
#: Columns that inputs need; checked before any work.
INPUTS = {
    "blocks": ["doc_id", "page_index", "block_idx", "block_label", "block_content", "block_id", "block_order", "pdf_bbox"],
    "pages": ["doc_id", "page_index", "page_count"],
    "segments": ["doc_id", "page_index", "seg_idx", "kind", "x0", "y0", "x1", "y1"],
    "chars": ["doc_id", "page_index", "char", "char_idx", "x0", "y0", "x1", "y1"],
    "spans": ["doc_id", "page_index", "size", "flags", "font"],
    "images": ["json_stem", "block_idx", "block_label", "block_id", "png"],
    "page_bytes": ["doc_id", "page_index", "page_count", "page"],
}


@dataclass
class DocumentPipeline:
    """Runs stages over named relations; ``out`` is a folder of Parquet tables.

    Inputs: ``blocks``, ``pages`` and, where there are any, ``segments``,
    ``chars``, ``spans`` and ``images``; or ``page_bytes`` (pages as bytes, with
    the errors of those that could not be read) for ``layout_model`` to make
    blocks and pages from and for ``crop`` to cut images from.  Glyphs without
    a ``block_idx`` are those of whole pages and are clipped to the blocks.
    Each stage reads what earlier ones wrote, so a run can start at any stage.

    ``counts`` has the rows of each table, gathered as it was written;
    ``manifest`` what became of each stage.
    """

    spark: SparkSession
    out: str
    backend: vlm.Backend | None = None
    prompts: dict[str, str] = field(default_factory=dict)
    batch_vlm: bool = True
    workers: int = 1
    layout_model: Callable[[], Callable[[bytes], dict]] | None = None
    crop: Callable[[bytes, list[float], float], bytes | None] | None = None
    config: Config | None = None
    failures: dict[str, str] = field(default_factory=dict)
    counts: dict[str, int] = field(default_factory=dict)
    manifest: list[dict] = field(default_factory=list)

    @classmethod
    def from_config(cls, spark: SparkSession, config: Config, **given) -> DocumentPipeline:
        """With the output folder, model server, prompts and calls at a time of the settings; ``files`` writes under their names."""
        backend = vlm.ChatBackend(config.vlm_api_base, config.vlm_api_key) if config.use_vlm else None
        set_ = {"backend": backend, "prompts": config.vlm_prompts, "workers": config.max_workers, "config": config}
        return cls(spark, f"{config.output_path}/tables", **(set_ | given))

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.out}/{name}")

    def write(self, **tables: DataFrame) -> None:
        for name, df in tables.items():
            seen = Observation()
            df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{self.out}/{name}")
            self.counts[name] = seen.get["rows"]

    def check(self, inputs: dict[str, DataFrame], stages: set[str]) -> None:
        """Stages and inputs are known, and inputs have their columns."""
        if unknown := stages - set(ORDER):
            raise PipelineError(f"no such stages: {sorted(unknown)}", "config")
        if unknown := set(inputs) - set(INPUTS):
            raise PipelineError(f"no such inputs: {sorted(unknown)}", "config")
        for name, df in inputs.items():
            if missing := [c for c in INPUTS[name] if c not in df.columns]:
                raise PipelineError(f"{name} lacks the columns {missing}", "config")
        if ("chars" in inputs) != ("spans" in inputs):
            raise PipelineError("chars and spans come together", "config")

    def run(self, inputs: dict[str, DataFrame], stages: set[str] | None = None) -> dict:
        """``blocks`` (their last table) and ``stages``, the manifest, which is also written; failures of stages that may fail are kept in ``failures``."""
        stages = set(ORDER) - (set() if self.config else {"files"}) if stages is None else stages
        self.check(inputs, stages)
        if inputs:
            self.write(**inputs)
        current = "blocks"
        for name, policy in ORDER.items():
            if name not in stages:
                continue
            began, before, made, error = time.time(), dict(self.counts), None, None
            try:
                made = getattr(self, f"_{name}")(current, inputs)
                current = made or current
            except Exception as e:
                error = str(e)
                if policy == "stop":
                    raise PipelineError(error, name) from e
                self.failures[name] = error
            finally:
                new = {k: v for k, v in self.counts.items() if before.get(k) != v or k not in before}
                status = "failed" if error else "done" if new or made else "skipped"
                self.manifest.append({"stage": name, "status": status, "rows": new, "seconds": round(time.time() - began, 3), "error": error})
        if self.manifest:
            schema = "stage string, status string, rows map<string,long>, seconds double, error string"
            self.spark.createDataFrame([tuple(m.values()) for m in self.manifest], schema).coalesce(1).write.mode("overwrite").json(f"{self.out}/manifest")
        return {"blocks": current, "stages": self.manifest}

    def _layout(self, current: str, inputs: dict) -> str | None:
        if self.layout_model is None or "page_bytes" not in inputs:
            return None
        self.write(parsed_pages=layout.parse_layout(self.read("page_bytes"), self.layout_model))
        parsed = self.read("parsed_pages")
        self.write(dead_letters=parsed.where("layout is null").drop("layout"))
        read = layout.layout_rows(parsed)
        stem = F.format_string("page_%04d_0_res", F.col("page_index") + 1)
        self.write(blocks=layout.blocks_of(read).withColumn("file_stem", stem), pages=layout.pages_of(read))
        return "blocks"

    def _boxes(self, current: str, inputs: dict) -> str | None:
        if "segments" not in inputs:
            return None
        self.write(boxes=boxes.detect_boxes(self.read("segments")))
        self.write(blocks_boxed=boxes.assign_boxes(self.read(current).drop("inside_box", "box_id"), self.read("boxes")))
        return "blocks_boxed"

    def _text(self, current: str, inputs: dict) -> str | None:
        now = self.read(current)
        if "chars" in inputs:
            fill = glyphs.fill_text if "block_idx" in inputs["chars"].columns else glyphs.clip_text
            now = fill(now.drop("text_length", "font_size", "is_bold", "font_name"), self.read("chars"), self.read("spans"))
        self.write(blocks_text=B.relabel_formulas(now))
        return "blocks_text"

    def _order(self, current: str, inputs: dict) -> str:
        now = self.read(current)
        self.write(blocks_ordered=B.fill_block_order(now.withColumn("y", F.get("pdf_bbox", F.lit(1)))).drop("y"))
        return "blocks_ordered"

    def _crops(self, current: str, inputs: dict) -> None:
        """Pictures of image blocks; those that could not be cut have none and are counted."""
        if self.crop is None or "page_bytes" not in inputs:
            return
        stem = F.format_string("page_%04d_0_res", F.col("page_index") + 1)
        cut = layout.crop_blocks(self.read(current), self.read("page_bytes"), self.crop)
        name = F.concat(stem, F.lit("_block_"), F.col("block_idx").cast("string"))
        made = cut.select("doc_id", stem.alias("json_stem"), "block_idx", "block_label", name.alias("block_id"), "png")
        self.write(crops=made)
        self.write(images=self.read("crops").where("png is not null"))

    def _html(self, current: str, inputs: dict) -> None:
        self.write(html=render.html_pages(self.read(current), self.read("pages")))

    def _vlm(self, current: str, inputs: dict) -> str | None:
        if self.backend is None or not ("images" in inputs or "images" in self.counts):
            return None
        met = vlm.join_images(self.read(current), self.read("images"))
        self.write(answers=vlm.describe(met, self.backend, self.prompts, self.workers).drop("png"))
        self.write(failed_answers=self.read("answers").where("failed"))
        self.write(blocks_described=vlm.with_answers(self.read(current), self.read("answers"), self.batch_vlm))
        return "blocks_described"

    def _hierarchy(self, current: str, inputs: dict) -> None:
        now = sections.with_sequence(self.read(current))
        self.write(parsed=hierarchy.parse_blocks(now), laws=sections.external_laws(now))
        parsed = self.read("parsed")
        self.write(nodes=hierarchy.build_nodes(parsed))
        found = references.extract_references(hierarchy.reference_texts(parsed), self.read("laws"))
        self.write(refs=references.resolve_references(found, self.read("nodes")))

    def _export(self, current: str, inputs: dict) -> None:
        nodes, refs = self.read("nodes"), self.read("refs")
        self.write(graph_nodes=graph.graph_nodes(nodes), graph_edges=graph.graph_edges(nodes, refs), embedding_inputs=graph.embedding_inputs(nodes), section_relations=graph.extends_relations(nodes), trees=tree.nested_json(nodes, refs))
        self.write(sections_meta=graph.sections_meta(nodes, self.read("graph_edges"), self.read("embedding_inputs")))
        self.write(document_meta=graph.document_meta(self.read("sections_meta"), self.read("section_relations")))

    def _files(self, current: str, inputs: dict) -> None:
        """What the stages made as files under the names of the settings, a folder a document."""
        names = self.config or Config()
        to = names.output_path if self.config else f"{self.out}/files"
        meta = self.read("sections_meta")
        made = {
            "results": sinks.page_files(self.read(current), self.read("pages")),
            "html": sinks.html_files(self.read("html")),
            "hierarchy": sinks.tree_files(self.read("trees"), names.hierarchy_file),
            "references": sinks.reference_files(self.read("refs"), self.read("trees"), names.references_file),
            names.export_dir: sinks.document_files(sinks.section_files(self.read("graph_nodes"), self.read("graph_edges"), meta))
            .unionByName(sinks.document_files(sinks.embedding_files(self.read("embedding_inputs"), meta)))
            .unionByName(sinks.meta_files(self.read("document_meta"))),
        }
        if "images" in self.counts:
            made["images"] = sinks.image_files(self.read("images"))
        for folder, files in made.items():
            self.counts[f"{folder} files"] = write_files(files, f"{to}/{folder}")["files"]


def run_steps(spark: SparkSession, config: Config, inputs: dict[str, DataFrame], steps: str = "", **given) -> DocumentPipeline:
    """A run by the settings, of all stages or of those of numbered ``steps`` (``3-5,6``)."""
    run = DocumentPipeline.from_config(spark, config, **given)
    run.run(inputs, numbered(parse_steps(steps)) if steps else None)
    return run


def numbered(steps: set[int], names: dict[int, str] | None = None) -> set[str]:
    """Stages of numbered steps of a partial run: 3 images, 4 HTML, 5 hierarchy, 6 export."""
    names = names or {3: "vlm", 4: "html", 5: "hierarchy", 6: "export"}
    if wrong := steps - set(names):
        raise PipelineError(f"no such steps: {sorted(wrong)}", "config")
    return {names[s] for s in steps}
