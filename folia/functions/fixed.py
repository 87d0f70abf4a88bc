"""Patterns, markers and word lists that results depend on.

They are stated as they are, since other tools write and read the same
documents.  ``U`` makes classes Unicode-aware and ``d`` lets a dot stop at a
line feed only.
"""

CIRCLED = "①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮⑯⑰⑱⑲⑳"
SMALL_ROMAN = "ⅰⅱⅲⅳⅴⅵⅶⅷⅸⅹ"
ASCII_ROMAN = ["i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix", "x"]
MOK = "가나다라마바사아자차카타파하"

LEVELS = {"section": 0, "편": 1, "장": 2, "절": 3, "관": 4, "조": 5, "항": 6, "호": 7, "목": 8, "세목": 9, "대시": 10, "special": -1}

LABELS = {
    "section": "Section",
    "편": "Pyeon",
    "장": "Jang",
    "절": "Jeol",
    "관": "Gwan",
    "조": "Jo",
    "항": "Hang",
    "호": "Ho",
    "목": "Mok",
    "세목": "Semok",
    "대시": "Dash",
    "special": "Special",
}

TEXT_LABELS = ["doc_title", "paragraph_title", "text", "figure_title", "header", "vision_footnote"]
IMAGE_LABELS = ["table", "chart", "figure", "image", "formula"]

#: A sentence that only refers to an article, and so is no heading.
REFERENCE_SENTENCE = (
    r"(?Ud)^제\s*\d+\s*조(?:의\s*\d+)?\s*"
    r"(?:[(\[（][^)\]）]*[)\]）])?\s*"
    r"(?:제?\s*\d+\s*(?:항|호|목)[\s,]*)*"
    r"(?:및\s*제?\s*\d+\s*(?:항|호|목)[\s,]*)*"
    r"(의|에|를|와|과|에서|으로|부터|에\s*따라|에\s*의하여|에\s*해당|에\s*관한|에\s*대하여)"
)

#: Heading grammar in order of precedence: rule, type and pattern.
GRAMMAR = [
    ("special", "special", r"(?Ud)^(?:【([^】]+)】|<([^>]+)>)"),
    ("편", "편", r"(?Ud)^제\s*(\d+)\s*편\s*[(\[]?([^)\]]*)[)\]]?\s*$"),
    ("장의", "장", r"(?Ud)^제\s*(\d+)\s*장의\s*(\d+)\s*[(\[]?([^)\]]*)[)\]]?\s*$"),
    ("장", "장", r"(?Ud)^제\s*(\d+)\s*장\s*[(\[]?([^)\]]*)[)\]]?\s*$"),
    ("절", "절", r"(?Ud)^제\s*(\d+)\s*절\s*[(\[]?([^)\]]*)[)\]]?\s*$"),
    ("관", "관", r"(?Ud)^제\s*(\d+)\s*관\s*[(\[]?([^)\]]*)[)\]]?\s*$"),
    ("조의", "조", r"(?Uds)^제\s*(\d+)\s*조의\s*(\d+)\s*\[([^\]]*)\](.*)"),
    ("조의", "조", r"(?Uds)^제\s*(\d+)\s*조의\s*(\d+)\s*[(\[（]([^)\]）]*)[)\]）]?(.*)"),
    ("조", "조", r"(?Uds)^제\s*(\d+)\s*조\s*\[([^\]]*)\](.*)"),
    ("조", "조", r"(?Uds)^제\s*(\d+)\s*조\s*[\(（](.*?)[\)）](.*)"),
    ("조", "조", r"(?Uds)^제\s*(\d+)\s*조\s*[\[【]([^\]]*?)[\]】](.*)"),
    ("조", "조", r"(?Uds)^제\s*(\d+)\s*조\s*[(\[（](.*?)[)\]）](.*)"),
    ("조 only", "조", r"(?Ud)^제\s*(\d+)\s*조\s+(.*)$"),
    ("항", "항", r"(?Ud)^([①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮⑯⑰⑱⑲⑳])\s*(.*)$"),
    ("호", "호", r"(?Ud)^(\d+)\.\s+(.+)$"),
    ("목", "목", r"(?Ud)^([가나다라마바사아자차카타파하])\.\s+(.+)$"),
    ("세목", "세목", r"(?Udiu)^\s*[\(（]\s*([ⅰⅱⅲⅳⅴⅵⅶⅷⅸⅹ]|i{1,3}|iv|vi{0,3}|ix|x)\s*[\)）]\s*(.+)$"),
    ("대시", "대시", r"(?Ud)^[-－‐–—]\s*(.+)$"),
]

#: What articles and the headings above them begin with; no other rule does.
LEAD = "제"
#: What the other rules begin with.
OTHER_LEADS = rf"(?U)^[【<{CIRCLED}\d{MOK}\s(（\-－‐–—]"
ARTICLE_PREFIX = r"(?Ud)^제\s*\d+\s*조"
STRUCTURE_PREFIX = r"(?Ud)^제\s*\d+\s*(조|관|장|절|편)"
FORCED_ARTICLE = r"(?Ud)^제\s*(\d+)\s*조\s*(.*)$"
FORCED_TITLE = r"(?Uds)^[\(（](.*?)[\)）](.*)$"

APPENDIX = r"(?Ud)^[\[【]별표\s*(\d*)[\]】]"
GLOSSARY = r"(?Ud)^※\s*용어"
NOTE = r"(?Ud)^비고\s*($|\d)"
LAW_BLOCK, LAW_WORDS = r"(?Ud)^[\[【]법규", "약관에서 인용된 법"

NAMED_LAW = r"(?Ud)^【법규\d*】\s*(.+)$"
LONE_LAW, LAW_LEAD = r"(?Ud)^[가-힣]+(?:법|령|규정|규칙)\s*$", "^[가-힣]"

SECTION_TITLES = [
    r"(?Ud)^[가-힣A-Za-z0-9\s\(\),，및]+\s*(보통약관|특별약관|추가약관)\s*$",
    r"(?Ud)^[가-힣A-Za-z0-9\s,，및]+\s*(보통약관|특별약관|추가약관)\s*[\(（][^)）]*[\)）]\s*$",
    r"(?Ud)^[가-힣]+(?:법|령|규정|규칙)\s*$",
    r"(?Ud)^【법규\d*】",
    r"(?Ud)^주요\s*(민원|분쟁|사례|유의)",
    r"(?Ud)^(민원|분쟁)\s*(사례|안내|처리)",
    r"(?Ud)^유의\s*사항",
    r"(?Ud)민원.*분쟁.*유의",
    r"(?Ud)분쟁.*사례.*유의",
    r"(?Ud)^[가-힣A-Za-z\s]+\s*/\s*[가-힣A-Za-z\s]+",
]
NO_SECTION_TITLES = [
    r"(?Ud)^[가나다라마바사아자차카타파하]\.\s",
    r"(?Ud)^\d+\.\s",
    r"(?Ud)^[①②③④⑤⑥⑦⑧⑨⑩]",
    r"(?Ud)^제\s*\d+\s*조",
    r"(?Ud)^이\s+",
    r"(?Ud)^본\s+",
    r"(?Ud)^회사는\s+",
    r"(?Ud)^보통약관에서\s+",
    r"(?Ud)^상기",
    r"(?Ud)합니다\.?\s*$",
    r"(?Ud)않습니다\.?\s*$",
    r"(?Ud)됩니다\.?\s*$",
    r"(?Ud)입니다\.?\s*$",
]
SECTION_TITLE_MOST, DEFAULT_SECTION = 80, "본문"
#: What stands in every section title: each of SECTION_TITLES asks for one of these.
SECTION_TITLE_WORDS = ["약관", "법", "령", "규정", "규칙", "주요", "민원", "분쟁", "유의", "/"]

#: References inside a text, for the regular expressions of Python.
LAW_TAIL = r"\s*제\s*(\d+)\s*조(?:의\s*(\d+))?\s*(?:제?\s*(\d+)\s*항)?(?:제?\s*(\d+)\s*호)?"
ANY_LAW = r"[가-힣]+(?:법|령|규정|규칙)"
ARTICLE_REFERENCE = (
    r"제\s*(\d+)\s*조(?:의\s*(\d+))?\s*(?:[(\[（]([^)\]）]*)[)\]）])?\s*"
    r"(?:제?\s*(\d+)\s*항)?(?:제?\s*(\d+)\s*호)?(?:([가나다라마바사아자차카타파하])\s*목)?"
)
PARAGRAPH_REFERENCE, ARTICLE_NEAR, NEAR = r"제\s*(\d+)\s*항", r"제\s*\d+\s*조", 20

#: Slope, endpoint gap, box sizes and ratios of the geometry operators.
SLOPE, ENDPOINT_GAP, BOX_WIDTH, BOX_HEIGHT = 0.176, 5.0, 100.0, 50.0
OVERLAP, BOX_MARGIN, IOU_LIMIT = 0.9, 5.0, 0.5
#: Glyph duplicates, line gaps and inserted spaces.
LINE_GAP, SAME_GLYPH = 3.0, 2.0

EMPTY_CONTENT = "(내용 없음)"
MISSING_IMAGE = "[이미지 파일 없음: {}]"
AUTO_TITLE = "(자동생성)"
