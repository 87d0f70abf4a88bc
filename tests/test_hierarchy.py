"""The section parser against hand-derived goldens and a sequential fold."""

import random
import re

import pytest

from folia.operators import graph, hierarchy, references, sections, tree
from tests.golden import NODES, REFS, A, blocks


@pytest.fixture(scope="module")
def parsed(spark):
    return hierarchy.parse_blocks(blocks(spark)).cache()


@pytest.fixture(scope="module")
def nodes(parsed):
    return hierarchy.build_nodes(parsed).cache()


@pytest.fixture(scope="module")
def refs(spark, parsed, nodes):
    found = references.extract_references(hierarchy.reference_texts(parsed), sections.external_laws(blocks(spark)))
    return references.resolve_references(found, nodes).cache()


def test_golden_nodes(nodes):
    rows = nodes.orderBy("preorder").collect()
    by = {r.node_uid: r for r in rows}
    assert [(r.id, r.type, by[r.parent_uid].id if r.parent_uid else None, r.content) for r in rows] == NODES
    by_id = {r.id: r for r in rows}
    assert by_id[f"{A}.제1관.제3조"].title == "의2(특약)" and by_id[f"{A}.제1관.제3조"].branch is None
    assert by_id["상법.제638조"].title == "보험계약은 효력이 생긴다"
    assert by_id[f"{A}.제1관.제1조.①"].metadata.auto_generated and by_id[f"{A}.<용어풀이>"].metadata.inline


def test_golden_references(refs):
    rows = refs.orderBy("section_idx", "seq", "part", "ordinal").collect()
    assert [(r.source_id, r.ref_type, r.target_law, r.target_jo, r.target_jo_branch, r.target_hang, r.raw_text, r.resolved_id) for r in rows] == REFS


def test_golden_graph(nodes, refs):
    edges, emb = graph.graph_edges(nodes, refs), graph.embedding_inputs(nodes)
    meta = {r.id: r for r in graph.sections_meta(nodes, edges, emb).collect()}
    assert (meta[A].node_count, meta[A].edge_count, meta[A].embedding_count, meta[A].type) == (12, 16, 3, "base")
    assert (meta["상법"].node_count, meta["상법"].edge_count, meta["상법"].embedding_count, meta["상법"].type) == (2, 2, 1, "law_reference")
    assert meta[A].file == "sections/01_무배당_안심보험_보통약관.json"
    kinds = {r.type: r["count"] for r in edges.where("section_idx = 1").groupBy("type").count().collect()}
    assert kinds == {"HAS_CHILD": 11, "REFERENCES": 3, "CITES_LAW": 2}
    assert graph.extends_relations(nodes).count() == 0
    first = emb.where("number = 1 and section_idx = 1").first()
    assert first.embedding_text == "[목적 및 용어의 정의]\n제1조 (목적)\n제1조(목적)\n① 이 계약은 상법 제638조에 따릅니다." and first.token_count == 13
    assert edges.where("type = 'CITES_LAW'").first().target == "law_상법_638"


def test_tree_questions(nodes, refs):
    assert tree.find_node(nodes, "제1관.제2조.①.1").first().id == f"{A}.제1관.제2조.①.1."
    assert tree.find_node(nodes, "제1관.제2조.①.1.가").count() == 1
    assert tree.find_node(nodes, "제9관").count() == 0
    assert tree.of_type(nodes, "조").count() == 4
    text = tree.full_text(nodes, nodes.where("id = '" + f"{A}.제1관.제2조" + "'")).first().text
    assert text.split("\n")[0] == "제2조(보험금의 지급)" and text.endswith("풀이 본문")
    assert tree.all_references(nodes, refs, nodes.where("type = '관'")).count() == 6
    lines = [r.line for r in tree.tree_lines(nodes, refs, 1).orderBy("preorder").collect()]
    assert lines[1] == "│   ├── [제1관] 목적 및 용어의 정의" and len(lines) == 4
    import json

    doc = json.loads(tree.nested_json(nodes, refs).first().tree)
    assert [s["id"] for s in doc["children"]] == [A, "상법"]
    assert doc["children"][0]["children"][0]["children"][0]["references"][0]["target_law"] == "상법"


def test_extends(spark):
    rows = [(0, "X 보통약관"), (1, "제1조(가) 나"), (2, "Y 특별약관"), (3, "제1조(다) 보통약관에 따름")]
    df = spark.createDataFrame([("d", 0, i, t, i) for i, t in rows], "doc_id string, page_index int, block_idx int, block_content string, seq int")
    got = graph.extends_relations(hierarchy.build_nodes(hierarchy.parse_blocks(df))).collect()
    assert [(r.source, r.target) for r in got] == [("Y 특별약관", "X 보통약관")]


# --- a sequential fold, kept apart from the window formulation -----------------------

POOL = [
    ("편", "제1편 총칙"), ("장", "제1장 통칙"), ("장", "제2장의3 별칙"), ("절", "제2절"), ("관", "제3관 [보험]"),
    ("조", "제1조(목적)"), ("조", "제2조(정의) 본문이 있다"), ("조", "제4조 무괄호 제목"), ("forced", "제5조의2(가지)"), ("forced", "제6조에서 정한 바"), ("multi", "제7조에서\n둘째 줄"),
    ("항", "① 첫째"), ("항", "② 둘째"), ("호", "1. 하나"), ("호", "2. 둘"), ("호", "4. 넷"), ("호", "0. 영"),
    ("목", "가. 가목"), ("목", "나. 나목"), ("목", "라. 라목"), ("세목", "(i) 하나"), ("세목", "(ii) 둘"), ("대시", "- 줄"),
    ("S", "【풀이】 말"), ("S", "<예시> 보기"), ("G", "[별표1] 표"), ("G", "비고"), ("G", "※ 용어의 정의"), ("H", "제3관(가) 말"),
    ("T", "그냥 글"), ("T", "다른 글"),
]
LEVEL = {"편": 1, "장": 2, "절": 3, "관": 4, "조": 5, "항": 6, "호": 7, "목": 8, "세목": 9, "대시": 10}
NUMBER = {"가. 가목": 1, "나. 나목": 2, "라. 라목": 4, "(i) 하나": 1, "(ii) 둘": 2}


def fold(rows):
    """(kind, text) in order -> [(parent index, level, content)], in order of creation."""
    out = [[None, 0, ""]]
    open_at, counts, special, outside = {0: 0}, {}, None, False

    def add(parent, level, text):
        out.append([parent, level, text])
        return len(out) - 1

    def deepest(below=99):
        return max((k for k, v in open_at.items() if v is not None and k < below), default=0)

    def close(level):
        for k in [k for k in open_at if k > level]:
            del open_at[k]

    def paragraph(text):
        if open_at.get(5) is not None and open_at.get(6) is None:
            open_at[6] = add(open_at[5], 6, text)
            return True
        return False

    for kind, text in rows:
        article = re.match(r"제\d+조", text)
        if kind == "G":
            close(0)
            counts, outside = {}, True
            special = add(0, -1, text)
            continue
        if special is not None:
            leaves = re.match(r"제\d+(조|관|장|절|편)", text) if outside else (article or kind not in ("T", "H", "multi"))
            if not leaves:
                out[special][2] += "\n" + text
                continue
            special, outside = None, False
        if kind == "S":
            slot = max(open_at)
            special = add(open_at[deepest(slot)] if deepest(slot) or slot else 0, -1, text)
            continue
        if kind in LEVEL or kind == "forced":
            level = LEVEL.get(kind, 5)
            n = NUMBER.get(text) or (int(re.search(r"\d+", text)[0]) if re.search(r"\d", text) else {"①": 1, "②": 2}.get(text[0]))
            if level <= 6:
                close(level)
                for k in range(level + 1, 11):
                    counts[k] = 0
            elif level == 7:
                if n == 1 or n == counts.get(7, 0) + 1:
                    paragraph("")
                    close(7)
                    counts[8] = counts[9] = 0
            elif level == 8 and (n == 1 or n == counts.get(8, 0) + 1) or level == 9 and n == 1:
                close(level)
            if level > 6:
                paragraph("")
            body = "본문이 있다" if "본문이" in text else re.sub(r"^제\d+조", "", text).strip() if kind == "forced" else ""
            at = add(open_at[deepest(level)], level, text.replace(body, "").strip() if body and kind == "조" else text)
            open_at[level] = at
            if n and kind != "forced":
                counts[level] = n
            if level == 5:
                open_at[6] = None
                if body:
                    paragraph(body)
            continue
        if open_at.get(5) is not None:
            if not paragraph(text):
                out[open_at[deepest()]][2] += "\n" + text
        elif deepest():
            out[open_at[deepest()]][2] += "\n" + text
    return out


def comparable(out):
    def path(i):
        return [] if out[i][0] is None else path(out[i][0]) + [i]

    order = sorted(range(len(out)), key=path)
    return [(len(path(i)), out[i][1], out[i][2], out[out[i][0]][2] if out[i][0] is not None else None) for i in order]


def test_windows_equal_the_fold(spark):
    rng = random.Random(11)
    streams = [[rng.choice(POOL) for _ in range(rng.randrange(1, 40))] for _ in range(400)]
    rows = [(f"{d:03}", 0, i, t, i) for d, s in enumerate(streams) for i, (_, t) in enumerate(s)]
    df = spark.createDataFrame(rows, "doc_id string, page_index int, block_idx int, block_content string, seq int")
    got = {}
    nodes = hierarchy.build_nodes(hierarchy.parse_blocks(df)).orderBy("doc_id", "preorder").collect()
    by = {r.node_uid: r for r in nodes}
    for r in nodes:
        got.setdefault(r.doc_id, []).append((r.depth, r.level, r.content, by[r.parent_uid].content if r.parent_uid else None))
    for d, s in enumerate(streams):
        assert got[f"{d:03}"] == comparable(fold(s)), s
