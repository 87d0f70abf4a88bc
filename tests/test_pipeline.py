"""Reading layout files, running stages, and the same files as a stream."""

import json

import pytest

from folia.operators import vlm
from folia.plans.pipeline import DocumentPipeline, numbered
from folia.sources import layout, sinks
from folia.sources.config import PipelineError
from folia.streaming import ingest
from tests.golden import NODES, TEXTS


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    at = tmp_path_factory.mktemp("pages") / "doc"
    at.mkdir()
    for page, texts in enumerate((TEXTS[:7], TEXTS[7:])):
        blocks = [{"block_label": "text", "block_content": t, "block_bbox": [10, 20 + 40 * i, 200, 50 + 40 * i], "block_id": i} for i, t in enumerate(texts)]
        body = {"page_index": page, "page_count": 2, "width": 1000, "height": 2000, "pdf_width": 500.0, "pdf_height": 1000.0, "parsing_res_list": blocks}
        (at / f"page_{page + 1:04}_0_res.json").write_text(json.dumps(body, ensure_ascii=False), encoding="utf-8")
    return str(at.parent)


def test_whole_run(spark, folder, tmp_path):
    read = layout.read_layout(spark, folder)
    blocks = layout.blocks_of(read)
    assert blocks.where("page_index = 0 and block_idx = 0").first().pdf_bbox == [5.0, 10.0, 100.0, 25.0]
    run = DocumentPipeline(spark, str(tmp_path / "out"), backend=vlm.stub_backend)
    run.run({"blocks": blocks, "pages": layout.pages_of(read)})
    assert not run.failures
    assert [(r.id, r.type) for r in run.read("nodes").orderBy("preorder").collect()] == [n[:2] for n in NODES]
    meta = run.read("document_meta").first()
    assert meta.total_sections == 2 and meta.id == "doc_문서" and meta.sections[0].node_count == 12
    assert run.read("html").count() == 2
    files = sinks.section_files(run.read("graph_nodes"), run.read("graph_edges"), run.read("sections_meta"))
    first = json.loads(files.where("section_idx = 1").first().json)
    assert len(first["nodes"]) == 12 and len(first["edges"]) == 16 and first["section"]["type"] == "base" and "properties" in first["edges"][0]
    lists = sinks.embedding_files(run.read("embedding_inputs"), run.read("sections_meta")).orderBy("section_idx").collect()
    assert [len(json.loads(r.json)) for r in lists] == [3, 1]
    sinks.write_sections(files, str(tmp_path / "sections"))
    assert sorted(p.name[:3] for p in (tmp_path / "sections/doc/sections").iterdir()) == ["01_", "02_"]
    assert sinks.write_html(run.read("html"), str(tmp_path / "html")) == 2
    places = sinks.write_trees(run.read("trees"), run.read("refs"), str(tmp_path / "tree_out"))
    assert spark.read.option("multiLine", True).option("recursiveFileLookup", True).json(places[1]).count() == 7
    assert '"branch":null' in sinks.as_json(run.read("nodes"), ["doc_id"]).first().json
    back = layout.read_trees(spark, places[0]).orderBy("preorder").collect()
    assert [r.id for r in back] == ["root"] + [n[0] for n in NODES]


def test_stage_selection_and_errors(spark, tmp_path):
    run = DocumentPipeline(spark, str(tmp_path / "out"))
    with pytest.raises(PipelineError, match="no such stages"):
        run.run({}, {"nope"})
    run.run({}, {"hierarchy"})
    assert "hierarchy" in run.failures
    with pytest.raises(PipelineError, match=r"^\[order\]"):
        run.run({}, {"order"})
    assert numbered({5, 6}) == {"hierarchy", "export"}
    with pytest.raises(PipelineError):
        numbered({9})


def test_stream_of_pages(spark, folder, tmp_path):
    stream = ingest.stream_layout(spark, folder)
    ingest.start(layout.blocks_of(stream), str(tmp_path / "blocks"), str(tmp_path / "c1")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "blocks")).count() == len(TEXTS)
    ingest.start(ingest.complete_documents(stream), str(tmp_path / "docs"), str(tmp_path / "c2")).awaitTermination()
    assert [(r.doc_id, r.pages_seen) for r in spark.read.parquet(str(tmp_path / "docs")).collect()] == [("doc", 2)]


def test_documents_come_once_over_several_runs(spark, tmp_path):
    def page(doc, k):
        (tmp_path / "in" / doc).mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / doc / f"p_{k}_res.json").write_text(f'{{"page_index": {k}, "page_count": 2, "parsing_res_list": []}}')

    def run():
        got = ingest.complete_documents(ingest.stream_layout(spark, str(tmp_path / "in")))
        ingest.start(got, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
        return sorted(r.doc_id for r in spark.read.parquet(str(tmp_path / "out")).collect())

    page("a", 0)
    page("b", 0)
    page("b", 1)
    assert run() == ["b"]
    page("a", 1)
    assert run() == ["a", "b"]
    assert run() == ["a", "b"]
    # all pages of a document come again
    (tmp_path / "in" / "b" / "p_0_res.json").rename(tmp_path / "in" / "b" / "again_0_res.json")
    (tmp_path / "in" / "b" / "p_1_res.json").rename(tmp_path / "in" / "b" / "again_1_res.json")
    page("c", 0)
    page("c", 1)
    assert run() == ["a", "b", "c"]


def test_documents_that_fail_are_rows(spark, tmp_path):
    for name, content in (("good.pdf", b"ab"), ("bad.PDF", b"!"), ("other.txt", b"x")):
        (tmp_path / name).write_bytes(content)

    def split(raw):
        if raw == b"!":
            raise ValueError("no pages")
        return [raw[i : i + 1] for i in range(len(raw))]

    got = {(r.doc_id, r.page_index, r.error) for r in layout.split_documents(spark, str(tmp_path), split).collect()}
    assert got == {("good", 0, None), ("good", 1, None), ("bad", None, "no pages")}
