"""Files that are written and read back, pages of documents, model calls at once, and runs by settings."""

import json
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from folia.operators import vlm
from folia.plans.pipeline import DocumentPipeline, run_steps
from folia.sources import files, layout, sinks
from folia.sources.config import Config, PipelineError
from tests.golden import NODES, TEXTS

BLOCKS = "doc_id string, page_index int, block_idx int, block_label string, block_content string, block_id int, block_order double, text_length int, font_size double, is_bold boolean, font_name string, inside_box boolean, box_id int, image_bbox array<double>, pdf_bbox array<double>"
PAGES = "doc_id string, page_index int, page_count int, image_width int, image_height int, pdf_width double, pdf_height double"


def names(root):
    return sorted(str(p.relative_to(root)) for p in Path(root).rglob("*") if p.is_file() and "_manifest" not in p.parts and p.name != "_SUCCESS" and not p.name.endswith(".crc"))


def test_named_files(spark, tmp_path):
    root = str(tmp_path / "out")
    rows = [(f"a/{k % 3}/f{k}.txt", f"text {k} é") for k in range(40)]
    done = files.write_files(spark.createDataFrame(rows, "file string, content string").repartition(6), root)
    assert done["files"] == 40 and done["bytes"] == sum(len(c.encode()) for _, c in rows)
    assert names(root) == sorted(f for f, _ in rows) and all((tmp_path / "out" / f).read_text() == c for f, c in rows)
    again = spark.createDataFrame([("a/0/f0.txt", b"\x00\xff"), ("b.bin", b"")], "file string, content binary")
    assert files.write_files(again, f"file://{root}")["files"] == 2
    assert (tmp_path / "out/a/0/f0.txt").read_bytes() == b"\x00\xff" and len(names(root)) == 41
    assert files.write_files(again.limit(0), str(tmp_path / "none"))["files"] == 0


@pytest.mark.parametrize("bad", ["../up.txt", "/abs.txt", "", None, "_manifest/x", "a/../../b"])
def test_failed_writes_leave_nothing(spark, tmp_path, bad):
    root = tmp_path / "out"
    (root / "kept").mkdir(parents=True)
    (root / "kept/old.txt").write_text("old")
    rows = [("kept/old.txt", "old"), *((f"n{k}.txt", "new") for k in range(20)), (bad, "x")]
    with pytest.raises(Exception, match="name|FileExists"):
        files.write_files(spark.createDataFrame(rows, "file string, content string").repartition(4, "file"), str(root))
    assert "kept/old.txt" in names(root) and not (tmp_path / "up.txt").exists() and not (root / "_SUCCESS").exists()


def test_files_that_are_there(spark, tmp_path):
    (tmp_path / "x.txt").write_text("old")
    with pytest.raises(Exception, match="FileExists"):
        files.write_files(spark.createDataFrame([("x.txt", "new")], "file string, content string"), str(tmp_path), "append")
    assert (tmp_path / "x.txt").read_text() == "old"


def test_pages_round_trip(spark, tmp_path):
    blocks = spark.createDataFrame([(d, p, k, "text", f"글 \"{k}\"\n", k, None if k else 1.5, 3, 9.5, k == 1, "Batang", None, None, [1.0, 2.0, 3.0, 4.0], [0.5, 1.0, 1.5, 2.0] if k else []) for d in "ab" for p in (0, 11) for k in range(3)], BLOCKS)
    pages = spark.createDataFrame([(d, p, 12, 100, 200, 50.0, 100.0) for d in "ab" for p in (0, 11)] + [("c", 0, 1, 10, 10, 5.0, 5.0)], PAGES)
    assert files.write_files(sinks.page_files(blocks, pages), str(tmp_path))["files"] == 5
    assert names(tmp_path)[1] == "a/page_0012_0_res.json"
    back = layout.read_layout(spark, str(tmp_path))
    assert sorted(map(repr, layout.pages_of(back).select(*pages.columns).collect())) == sorted(map(repr, pages.collect()))
    assert sorted(map(repr, layout.blocks_of(back).select(*blocks.columns).collect())) == sorted(map(repr, blocks.collect()))
    drawn = spark.createDataFrame([("a", 0, 0, (1.0, 2.0, 3.0, 4.0), 2.0, 2.0, "connected_component", 4)], "doc_id string, page_index int, id int, rect struct<x0:double,y0:double,x1:double,y1:double>, width double, height double, type string, line_count int")
    rows = {r.file: json.loads(r.content) for r in sinks.page_files(blocks, pages, drawn).collect()}
    assert rows["a/page_0001_0_res.json"]["detected_boxes"][0]["rect"] == [1.0, 2.0, 3.0, 4.0] and rows["c/page_0001_0_res.json"]["detected_boxes"] == []
    assert "block_order" in rows["a/page_0001_0_res.json"]["parsing_res_list"][2]


def test_images_round_trip(spark, tmp_path):
    images = spark.createDataFrame([("page_0001_0_res", k, label, f"page_0001_0_res_block_{k}", bytes([k, 255])) for k, label in enumerate(("table", "chart", "figure"))] + [("p", 9, "image", "x", None)], "json_stem string, block_idx int, block_label string, block_id string, png binary")
    assert files.write_files(sinks.image_files(images), str(tmp_path))["files"] == 3
    back = layout.read_block_images(spark, str(tmp_path)).select(*images.columns)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, images.where("png is not null").collect()))


def test_newest_page_file(spark, tmp_path):
    import os

    for name, text, at in (("page_0001_0_res.json", "old", 1000), ("page_0001_1_res.json", "new", 2000), ("page_0002_0_res.json", "first", 500), ("page_0002_1_res.json", "same", 500)):
        (tmp_path / "d").mkdir(exist_ok=True)
        body = {"page_index": int(name[8]) - 1, "page_count": 2, "parsing_res_list": [{"block_label": "text", "block_content": text, "block_id": 0}]}
        (tmp_path / "d" / name).write_text(json.dumps(body))
        os.utime(tmp_path / "d" / name, (at, at))
    got = layout.newest_pages(layout.read_layout(spark, str(tmp_path)))
    assert sorted((r.page_index, r.file_name, r.parsing_res_list[0].block_content) for r in got.collect()) == [(0, "page_0001_1_res.json", "new"), (1, "page_0002_1_res.json", "same")]


def opened(raw):
    """A document of one byte a page; a page of 0 can't be read, a document that begins with ! not be opened."""
    if raw[:1] == b"!":
        raise ValueError("no document")

    class Pages:
        def __len__(self):
            return len(raw)

        def __getitem__(self, i):
            if not raw[i]:
                raise ValueError("no page")
            return raw[i : i + 1]

    return Pages()


def test_pages_of_documents(spark, tmp_path):
    body = bytearray(b"x" * 100)
    body[41] = 0
    for name, content in (("long.pdf", bytes(body)), ("short.PDF", b"yz"), ("bad.pdf", b"!"), ("empty.pdf", b""), ("other.txt", b"x")):
        (tmp_path / name).write_bytes(content)
    got = files.read_pages(spark, str(tmp_path), opened, pages_a_task=7)
    rows = got.select("doc_id", "page_index", "page_count", "page", "error", F.spark_partition_id().alias("task")).collect()
    assert {(r.doc_id, r.error) for r in rows if r.error} == {("bad", "ValueError: no document"), ("long", "ValueError: no page")}
    assert sorted(r.page_index for r in rows if r.doc_id == "long") == list(range(100)) and sum(r.page is not None for r in rows) == 101
    assert len({r.task for r in rows if r.doc_id == "long"}) > 1


def model():
    """Counts its own making, and fails on pages of the letter e."""
    import os
    import uuid

    mark = uuid.uuid4().hex

    def parse(page):
        if page == b"e":
            raise RuntimeError("model error")
        return {"width": 100, "height": 200, "pdf_width": 50.0, "pdf_height": 100.0, "input_path": f"{os.getpid()}:{mark}", "parsing_res_list": [{"block_label": "text", "block_content": "", "block_bbox": [0, 0, 20, 20], "block_id": 0}, {"block_label": "table", "block_content": "", "block_bbox": [0, 40, 20, 60], "block_id": 1}]}

    return parse


def crop(page, box, zoom):
    if page == b"c":
        raise ValueError("no picture")
    return page + bytes(int(x) for x in box)


def test_layout_and_crops_as_stages(spark, tmp_path):
    pages = [("d", i, 100, b"e" if i == 41 else b"c" if i == 7 else b"x", None) for i in range(100)] + [("f", None, None, None, "no document")]
    df = spark.createDataFrame(pages, "doc_id string, page_index int, page_count int, page binary, error string").repartition(5)
    run = DocumentPipeline(spark, str(tmp_path / "out"), backend=vlm.stub_backend, layout_model=model, crop=crop, workers=4)
    told = run.run({"page_bytes": df})
    assert not run.failures
    dead = {(r.doc_id, r.page_index, r.error) for r in run.read("dead_letters").collect()}
    assert dead == {("d", 41, "RuntimeError: model error"), ("f", None, "no document")}
    assert run.counts["pages"] == 99 and run.counts["blocks"] == 198 and run.counts["crops"] == 99 and run.counts["images"] == 98
    made = run.read("parsed_pages").select(F.get_json_object("layout", "$.input_path").alias("at")).where("at is not null").distinct().collect()
    assert len({r["at"] for r in made}) == len({r["at"].split(":")[0] for r in made})  # one model a worker
    described = {r.page_index: r.block_content for r in run.read("blocks_described").where("block_label = 'table'").collect()}
    assert described[0] == "table:5" and described[7] == "" and len(described) == 99
    status = {m["stage"]: m["status"] for m in told["stages"]}
    assert status["layout"] == status["crops"] == status["vlm"] == "done" and status["boxes"] == "skipped"
    kept = spark.read.json(str(tmp_path / "out" / "manifest")).where("stage = 'layout'").first()
    assert kept["rows"]["dead_letters"] == 2 and kept["status"] == "done"


def test_inputs_are_checked_before_work(spark, tmp_path):
    run = DocumentPipeline(spark, str(tmp_path / "out"))
    for inputs, message in (({"blocks": spark.range(1)}, "lacks the columns"), ({"nope": spark.range(1)}, "no such inputs"), ({"chars": spark.createDataFrame([], "doc_id int, page_index int, char string, char_idx int, x0 double, y0 double, x1 double, y1 double")}, "come together")):
        with pytest.raises(PipelineError, match=message):
            run.run(inputs)
    assert not (tmp_path / "out").exists()


@pytest.fixture
def server():
    """A model server that answers after a while, knows its calls at a time, and is busy at first."""

    class Handler(BaseHTTPRequestHandler):
        now, most, calls, busy, lock = 0, 0, 0, {}, threading.Lock()

        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            image = body["messages"][0]["content"][0]["image_url"]["url"]
            with Handler.lock:
                Handler.now, Handler.calls = Handler.now + 1, Handler.calls + 1
                Handler.most = max(Handler.most, Handler.now)
                tries = Handler.busy[image] = Handler.busy.get(image, 0) + 1
            time.sleep(0.15)
            with Handler.lock:
                Handler.now -= 1
            code = 400 if image.endswith("AAAD") else 503 if tries == 1 and image.endswith("AAAF") else 200
            self.send_response(code)
            self.end_headers()
            if code == 200:
                self.wfile.write(json.dumps({"choices": [{"message": {"content": f" {image[-4:]} "}}]}).encode())

        def log_message(self, *_):
            pass

    made = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=made.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{made.server_port}/v1", Handler
    made.shutdown()


def test_calls_at_once(spark, server):
    import base64

    address, seen = server
    images = spark.createDataFrame([(k, "table", k.to_bytes(3, "big")) for k in range(40)], "k int, block_label string, png binary").coalesce(1)
    backend = vlm.ChatBackend(address, tries=3, wait=0.05)
    began = time.time()
    got = {r.k: (r.answer, r.failed) for r in vlm.describe(images, backend, workers=8).select("k", "answer", "failed").collect()}
    assert seen.most == 8 and time.time() - began < 40 * 0.15
    assert got[3][1] and "400" in got[3][0] and seen.calls == 41
    assert all(got[k] == (base64.b64encode(k.to_bytes(3, "big")).decode(), False) for k in range(40) if k != 3)


def test_rows_wait_their_turn():
    taken = []

    def rows():
        for k in range(100):
            taken.append(k)
            yield (k,)

    out = vlm.in_flight(lambda k: k, rows(), 4)
    assert next(out) == 0 and len(taken) == 8
    assert list(out) == list(range(1, 100))
    assert vlm.label_functions(None)["table"](b"x") == "[table]" and vlm.label_functions(vlm.stub_backend)["chart"](b"xy") == "chart:2"


def test_run_by_settings(spark, tmp_path):
    (tmp_path / ".env").write_text(f'OUT_DIR="{tmp_path}/made"\nUSE_VLM=false\nOUTPUT_HIERARCHY_FILE=tree.json\nOUTPUT_REFERENCES_FILE=tree_refs.json\nOUTPUT_NEO4J_EXPORT_DIR=graph\nMAX_WORKERS=3\n')
    config = Config.load(tmp_path / ".env")
    rows = [("doc", k // 7, k % 7, "text", t, k % 7, None, None, None, None, None, None, None, [], [0.0, k, 9.0, k + 1.0]) for k, t in enumerate(TEXTS)]
    blocks = spark.createDataFrame([(*r[:13], r[13], [float(x) for x in r[14]]) for r in rows], BLOCKS)
    pages = spark.createDataFrame([("doc", p, 3, 100, 200, 50.0, 100.0) for p in range(3)], PAGES)
    run = run_steps(spark, config, {"blocks": blocks, "pages": pages})
    assert not run.failures and run.backend is None and run.workers == 3
    made = names(tmp_path / "made")
    assert {"hierarchy/doc/tree.json", "references/doc/tree_refs.json", "graph/doc/document_meta.json", "html/doc/page_0003.html", "results/doc/page_0001_0_res.json"} <= set(made)
    assert sum(f.startswith("graph/doc/sections/") for f in made) == 2 and sum(f.startswith("graph/doc/embeddings/") for f in made) == 2
    back = layout.read_trees(spark, str(tmp_path / "made/hierarchy"), "tree.json").orderBy("preorder").collect()
    assert [(r.doc_id, r.id) for r in back] == [("doc", "root"), *(("doc", n[0]) for n in NODES)]
    assert len(json.loads((tmp_path / "made/references/doc/tree_refs.json").read_text())) == 7
    assert json.loads((tmp_path / "made/graph/doc/document_meta.json").read_text())["total_sections"] == 2
    assert run.counts["html files"] == 3 and run.counts["html"] == 3
    again = layout.blocks_of(layout.read_layout(spark, str(tmp_path / "made/results")))
    assert again.count() == len(TEXTS)
    only = run_steps(spark, config, {}, "5-6")
    assert {m["stage"] for m in only.manifest} == {"hierarchy", "export"} or only.failures
