"""The hand-derived document of FIXTURES.md."""

TEXTS = [
    "표지 안내",
    "무배당 안심보험 보통약관",
    "제2관 목적 및 용어의 정의".replace("2", "1"),
    "제1조(목적)이 계약은 상법 제638조에 따릅니다.",
    "제2조(보험금의 지급)",
    "① 회사는 제1항에도 불구하고 제1조제1항을 준용합니다.",
    "1. 사망보험금",
    "가. 질병사망",
    "3. 장해보험금",
    "보험증권을 참고",
    "<용어풀이> 설명",
    "풀이 본문",
    "제3조의2(특약)",
    "상법",
    "제638조 보험계약은 효력이 생긴다",
]
A = "무배당 안심보험 보통약관"
NODES = [
    (A, "section", None, ""),
    (f"{A}.제1관", "관", A, "제1관 목적 및 용어의 정의"),
    (f"{A}.제1관.제1조", "조", f"{A}.제1관", "제1조(목적)"),
    (f"{A}.제1관.제1조.①", "항", f"{A}.제1관.제1조", "이 계약은 상법 제638조에 따릅니다."),
    (f"{A}.제1관.제2조", "조", f"{A}.제1관", "제2조(보험금의 지급)"),
    (f"{A}.제1관.제2조.①", "항", f"{A}.제1관.제2조", TEXTS[5]),
    (f"{A}.제1관.제2조.①.1.", "호", f"{A}.제1관.제2조.①", "1. 사망보험금"),
    (f"{A}.제1관.제2조.①.1..가.", "목", f"{A}.제1관.제2조.①.1.", "가. 질병사망\n보험증권을 참고"),
    (f"{A}.제1관.제2조.①.3.", "호", f"{A}.제1관.제2조.①", "3. 장해보험금"),
    (f"{A}.<용어풀이>", "special", f"{A}.제1관.제2조.①.3.", "<용어풀이> 설명\n풀이 본문"),
    (f"{A}.제1관.제3조", "조", f"{A}.제1관", "제3조의2(특약)"),
    (f"{A}.제1관.제3조.①", "항", f"{A}.제1관.제3조", "의2(특약)"),
    ("상법", "section", None, ""),
    ("상법.제638조", "조", "상법", "제638조 보험계약은 효력이 생긴다"),
]
REFS = [
    (f"{A}.제1관.제1조", "external", "상법", 638, None, None, "상법 제638조", None),
    (f"{A}.제1관.제1조", "internal", None, 1, None, None, "제1조(목적)", f"{A}.제1관.제1조"),
    (f"{A}.제1관.제1조.①", "external", "상법", 638, None, None, "상법 제638조", None),
    (f"{A}.제1관.제2조", "internal", None, 2, None, None, "제2조(보험금의 지급)", f"{A}.제1관.제2조"),
    (f"{A}.제1관.제2조.①", "internal", None, 1, None, 1, "제1조제1항", f"{A}.제1관.제1조.①"),
    (f"{A}.제1관.제3조", "internal", None, 3, 2, None, "제3조의2(특약)", None),
    ("상법.제638조", "internal", None, 638, None, None, "제638조 ", "상법.제638조"),
]


def blocks(spark, texts=None, doc_id="d"):
    rows = [(doc_id, 0, i, t, i) for i, t in enumerate(texts or TEXTS)]
    return spark.createDataFrame(rows, "doc_id string, page_index int, block_idx int, block_content string, seq int")
