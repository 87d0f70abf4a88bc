"""DuckDB SQL that says the same as the queries.

The parser's SQL is a fold: a recursive table that takes one block of every
section a step and carries the stack along, unlike the window form of the
operator.
"""

from __future__ import annotations

from ..functions import fixed as X
from .inputs import sql

ORACLE: dict[str, str] = {}


def _re(pattern: str) -> str:
    """A pattern for RE2 as a quoted literal; its classes are ASCII, which the inputs are in what matters."""
    for java, re2 in (("(?Uds)", "(?s)"), ("(?Udiu)", "(?i)"), ("(?Ud)", "")):
        pattern = pattern.replace(java, re2)
    return "'" + pattern.replace("'", "''") + "'"


def _has(pattern: str, c: str = "content") -> str:
    return f"regexp_matches({c}, {_re(pattern)})"


def _g(pattern: str, n: int, c: str = "content") -> str:
    return f"regexp_extract({c}, {_re(pattern)}, {n})"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def _cases(key: str, parts: list[tuple[int, str]], otherwise: str) -> str:
    return "CASE " + key + " " + " ".join(f"WHEN {i} THEN {e}" for i, e in parts) + f" ELSE {otherwise} END"


def _classified() -> str:
    """Blocks with rule, type, level, number, branch, marker, title and body."""
    rule = f"CASE WHEN content = '' OR {_has(X.REFERENCE_SENTENCE)} THEN -1 " + " ".join(f"WHEN {_has(p)} THEN {i}" for i, (_, _, p) in enumerate(X.GRAMMAR)) + " ELSE -1 END"
    number, branch, marker, title, body = [], [], [], [], []
    for i, (name, kind, p) in enumerate(X.GRAMMAR):
        digits = f"TRY_CAST({_g(p, 1)} AS INT)"
        if name == "special":
            marker.append((i, f"CASE WHEN {_g(p, 1)} <> '' THEN '【' || {_g(p, 1)} || '】' ELSE '<' || {_g(p, 2)} || '>' END"))
            title.append((i, f"CASE WHEN {_g(p, 1)} <> '' THEN {_g(p, 1)} ELSE {_g(p, 2)} END"))
        elif name in ("편", "장", "절", "관", "장의"):
            n = 3 if name == "장의" else 2
            number.append((i, digits))
            if n == 3:
                branch.append((i, f"TRY_CAST({_g(p, 2)} AS INT)"))
            marker.append((i, f"'제' || {_g(p, 1)} || '{name}'" + (f" || {_g(p, 2)}" if n == 3 else "")))
            title.append((i, f"CASE WHEN {_strip(_g(p, n))} = '' THEN content ELSE {_strip(_g(p, n))} END"))
        elif kind == "조":
            number.append((i, digits))
            n = 3 if name == "조의" else 2
            if n == 3:
                branch.append((i, f"TRY_CAST({_g(p, 2)} AS INT)"))
            marker.append((i, f"'제' || {_g(p, 1)} || '조'" + (f" || '의' || {_g(p, 2)}" if n == 3 else "")))
            title.append((i, f"left({_strip(_g(p, 2))}, 20)" if name == "조 only" else _strip(_g(p, n))))
            if name != "조 only":
                body.append((i, _strip(_g(p, n + 1))))
        elif name == "항":
            number.append((i, f"strpos('{X.CIRCLED}', {_g(p, 1)})"))
            marker.append((i, _g(p, 1)))
            title.append((i, f"left({_g(p, 2)}, 50)"))
        elif name in ("호", "목", "세목"):
            roman = "CASE lower({0}) " + " ".join(f"WHEN '{r}' THEN {k}" for k, r in enumerate(X.ASCII_ROMAN, 1)) + " " + " ".join(f"WHEN '{r}' THEN {k}" for k, r in enumerate(X.SMALL_ROMAN, 1)) + " ELSE 1 END"
            number.append((i, digits if name == "호" else f"strpos('{X.MOK}', {_g(p, 1)})" if name == "목" else roman.format(_g(p, 1))))
            marker.append((i, f"'(' || {_g(p, 1)} || ')'" if name == "세목" else f"{_g(p, 1)} || '.'"))
            title.append((i, f"left({_g(p, 2)}, 50)"))
        else:
            marker.append((i, "'-'"))
            title.append((i, f"left({_g(p, 1)}, 50)"))
    kinds = _cases("rule", [(i, f"'{k}'") for i, (_, k, _) in enumerate(X.GRAMMAR)], "NULL")
    levels = _cases("rule", [(i, str(X.LEVELS[k])) for i, (_, k, _) in enumerate(X.GRAMMAR)], "NULL")
    return f"""SELECT *, {kinds} AS type, CAST({levels} AS INT) AS level, CAST({_cases("rule", number, "NULL")} AS INT) AS number, CAST({_cases("rule", branch, "NULL")} AS INT) AS branch,
        {_cases("rule", marker, "NULL")} AS marker, {_cases("rule", title, "NULL")} AS title, CASE WHEN rule >= 0 THEN {_cases("rule", body, "''")} END AS body
        FROM (SELECT *, {rule} AS rule FROM (SELECT *, {_strip("block_content")} AS content FROM ({sql("term_blocks")}) AS t0) AS t1) AS t2"""


ORACLE["classify_blocks"] = f"SELECT doc_id, seq, type, level, number, branch, marker, title, body FROM ({_classified()}) AS c"

_GLOBAL = f"CASE WHEN {_has(X.APPENDIX)} THEN 'appendix' WHEN {_has(X.GLOSSARY)} THEN 'glossary' WHEN {_has(X.NOTE)} THEN 'note' WHEN contains(content, '{X.LAW_WORDS}') OR {_has(X.LAW_BLOCK)} THEN 'law_reference' END"
_GLOBAL_MARKER = f"CASE gtype WHEN 'appendix' THEN '[별표' || {_g(X.APPENDIX, 1)} || ']' WHEN 'glossary' THEN '※용어정의' WHEN 'note' THEN '비고' WHEN 'law_reference' THEN '법규정' END"
ORACLE["global_specials"] = f"SELECT doc_id, seq, gtype AS type, {_GLOBAL_MARKER} AS marker, left(content, 50) AS title FROM (SELECT *, {_GLOBAL} AS gtype FROM (SELECT *, {_strip('block_content')} AS content FROM ({sql('term_blocks')}) AS t) AS u) AS v WHERE gtype IS NOT NULL"
_REST = _strip(_g(X.FORCED_ARTICLE, 2))
_TITLED = _has(X.FORCED_TITLE, "rest")
_FORCED_TITLE = f"CASE WHEN {_TITLED} THEN {_strip(_g(X.FORCED_TITLE, 1, 'rest'))} ELSE left(rest, 50) END"
_FORCED_BODY = f"CASE WHEN {_TITLED} THEN {_strip(_g(X.FORCED_TITLE, 2, 'rest'))} ELSE rest END"
ORACLE["forced_articles"] = f"SELECT doc_id, seq, TRY_CAST({_g(X.FORCED_ARTICLE, 1)} AS INT) AS number, {_FORCED_TITLE} AS title, {_FORCED_BODY} AS body FROM (SELECT *, {_REST} AS rest FROM ({_classified()}) AS c WHERE rule < 0 AND {_has(X.FORCED_ARTICLE)}) AS d"

_TITLE = f"(content <> '' AND length(content) <= {X.SECTION_TITLE_MOST} AND NOT (" + " OR ".join(_has(p) for p in X.NO_SECTION_TITLES) + ") AND (" + " OR ".join(_has(p) for p in X.SECTION_TITLES) + "))"
_TYPE = "CASE WHEN contains(section_name, '보통약관') THEN 'base' WHEN contains(section_name, '특별약관') THEN 'special' WHEN contains(section_name, '추가약관') THEN 'additional' WHEN contains(section_name, '법규') OR regexp_matches(section_name, '^[가-힣]+법') THEN 'law_reference' WHEN contains(section_name, '민원') OR contains(section_name, '분쟁') OR contains(section_name, '유의') THEN 'dispute' ELSE 'other' END"


def _sectioned(of: str) -> str:
    """Blocks of ``of`` with their section: the title at or before a block, counted from the next title on."""
    return f"""SELECT b.*, CAST(coalesce(s.section_idx, 1) AS INT) AS section_idx, coalesce(s.section_name, '{X.DEFAULT_SECTION}') AS section_name
        FROM ({of}) AS b
        LEFT JOIN (SELECT doc_id, seq AS first_seq, content AS section_name, row_number() OVER (PARTITION BY doc_id ORDER BY seq) AS section_idx, lead(seq) OVER (PARTITION BY doc_id ORDER BY seq) AS next_seq FROM ({of}) AS x WHERE {_TITLE}) AS s
          ON b.doc_id = s.doc_id AND b.seq >= s.first_seq AND (s.next_seq IS NULL OR b.seq < s.next_seq)
        WHERE s.doc_id IS NOT NULL OR b.doc_id NOT IN (SELECT doc_id FROM ({of}) AS y WHERE {_TITLE})"""


_STRIPPED = f"SELECT *, {_strip('block_content')} AS content FROM ({sql('term_blocks')}) AS t"
ORACLE["detect_sections"] = f"SELECT doc_id, section_idx, section_name, {_TYPE} AS section_type, min(seq) AS first_seq, max(seq) + 1 AS end_seq FROM ({_sectioned(_STRIPPED)}) AS z GROUP BY doc_id, section_idx, section_name"
ORACLE["external_laws"] = f"SELECT DISTINCT doc_id, CASE WHEN {_has(X.NAMED_LAW)} THEN {_strip(_g(X.NAMED_LAW, 1))} ELSE content END AS law FROM ({_STRIPPED}) AS t WHERE {_has(X.NAMED_LAW)} OR {_has(X.LONE_LAW)}"
ORACLE["block_sequence"] = f"SELECT doc_id, page_index, block_idx, seq FROM ({sql('term_blocks')}) AS t"


def _folded() -> str:
    """WITH clause whose table ``steps`` has, for every block, what it makes and under what."""
    o = [f"o{k}" for k in range(1, 11)]
    entry = "STRUCT(s BIGINT, b INT, id VARCHAR, p VARCHAR)"
    root = "{'s': CAST(-1 AS BIGINT), 'b': 0, 'id': section_name, 'p': lpad(CAST(section_idx AS VARCHAR), 6, '0')}"
    step = lambda of, sub: f"{of}.p || '/' || lpad(CAST(seq AS VARCHAR), 10, '0') || '{sub}'"
    above = lambda k: "coalesce(" + ", ".join([*(f"u{j}" for j in range(k - 1, 0, -1)), root]) + ")"
    parent = "CASE lv " + " ".join(f"WHEN {k} THEN {above(k)}" for k in range(1, 11)) + " END"
    pushed = lambda k: f"CASE WHEN lv = {k} THEN main WHEN r IS NOT NULL AND {k} > r THEN NULL ELSE {'u6' if k == 6 else f'o{k}'} END"
    sixth = "CASE WHEN lv = 6 THEN main WHEN auto THEN made WHEN lv = 5 OR r IS NOT NULL AND 6 > r THEN NULL ELSE o6 END"
    alive = "list_filter([" + ", ".join(reversed(o)) + "], lambda x: x IS NOT NULL)"
    flags = f"""SELECT *, {_GLOBAL} IS NOT NULL AS g, {_has(X.STRUCTURE_PREFIX)} AS hs, {_has(X.ARTICLE_PREFIX)} AS jp, CASE WHEN rule < 0 AND {_has(X.FORCED_ARTICLE)} THEN TRUE ELSE FALSE END AS forced, {_REST} AS rest, {_GLOBAL} AS gtype,
        row_number() OVER (PARTITION BY doc_id, section_idx ORDER BY seq) AS i FROM ({_sectioned(_classified())}) AS z WHERE content <> ''"""
    return f"""WITH RECURSIVE flagged AS MATERIALIZED (SELECT *, CASE WHEN forced THEN TRY_CAST({_g(X.FORCED_ARTICLE, 1)} AS INT) ELSE number END AS num, CASE WHEN forced THEN {_FORCED_BODY} ELSE body END AS text_body,
          CASE WHEN g THEN {_GLOBAL_MARKER} WHEN forced THEN '제' || TRY_CAST({_g(X.FORCED_ARTICLE, 1)} AS INT) || '조' ELSE marker END AS mark FROM ({flags}) AS f),
        steps AS (
          SELECT doc_id, section_idx, CAST(0 AS BIGINT) AS i, CAST(-1 AS BIGINT) AS seq, {", ".join(f"CAST(NULL AS {entry}) AS {x}" for x in o)}, FALSE AS slot, 0 AS c7, 0 AS c8, 0 AS sp, '' AS kind, CAST(NULL AS INT) AS lv, CAST(NULL AS INT) AS num, CAST(NULL AS {entry}) AS main, CAST(NULL AS {entry}) AS parent, FALSE AS auto, CAST(NULL AS {entry}) AS made, CAST(NULL AS {entry}) AS auto_parent, CAST(NULL AS VARCHAR) AS type, CAST(NULL AS {entry}) AS owner, CAST(NULL AS INT) AS jo, CAST(NULL AS INT) AS jo_before
          FROM (SELECT DISTINCT doc_id, section_idx FROM flagged) AS d
          UNION ALL
          SELECT doc_id, section_idx, i, seq, {", ".join(f"{sixth if k == 6 else pushed(k)} AS o{k}" for k in range(1, 11))},
            CASE WHEN lv = 5 AND NOT auto THEN TRUE WHEN auto OR lv = 6 OR r < 6 THEN FALSE ELSE slot END,
            CASE WHEN kind = 'G' OR lv <= 6 THEN 0 WHEN lv = 7 AND num <> 0 THEN num ELSE c7 END,
            CASE WHEN kind = 'G' OR lv <= 6 OR lv = 7 AND r = 7 THEN 0 WHEN lv = 8 AND num <> 0 THEN num ELSE c8 END,
            CASE kind WHEN 'G' THEN 2 WHEN 'S' THEN 1 WHEN 'A' THEN sp ELSE 0 END,
            kind, lv, num, main, parent, auto, made, CASE WHEN NOT auto THEN NULL WHEN lv = 5 THEN main ELSE o5 END, type,
            CASE WHEN kind = 'T' AND NOT auto THEN {alive}[1] END, CASE WHEN kind = 'G' THEN NULL WHEN lv = 5 THEN num ELSE jo END, jo
          FROM (SELECT *, CASE WHEN auto THEN CASE WHEN lv = 5 THEN {{'s': seq, 'b': 1, 'id': main.id || '.①', 'p': {step('main', 1)}}} ELSE made0 END END AS made
          FROM (SELECT *, CASE WHEN kind IN ('G', 'S') THEN {{'s': seq, 'b': 0, 'id': section_name || '.' || mark, 'p': {step('parent', 0)}}} WHEN kind = 'H' THEN {{'s': seq, 'b': 0, 'id': parent.id || '.' || mark, 'p': {step('parent', 0)}}} END AS main
          FROM (SELECT *, CASE WHEN kind = 'G' THEN {root} WHEN kind = 'S' THEN coalesce(CASE WHEN slot THEN o5 ELSE {alive}[2] END, {root}) WHEN kind = 'H' THEN {parent} END AS parent
          FROM (SELECT *, {", ".join(f"o{k} AS u{k}" for k in range(1, 11) if k != 6)}, CASE WHEN auto AND lv > 6 THEN made0 ELSE o6 END AS u6
          FROM (SELECT *, CASE WHEN lv = 5 THEN text_body <> '' WHEN lv > 6 OR kind = 'T' THEN o5 IS NOT NULL AND o6 IS NULL ELSE FALSE END AS auto, {{'s': seq, 'b': 1, 'id': o5.id || '.①', 'p': {step('o5', 1)}}} AS made0,
            CASE WHEN kind = 'G' THEN 0 WHEN lv <= 6 THEN lv WHEN lv = 7 AND (num = 1 OR num = c7 + 1) THEN 7 WHEN lv = 8 AND (num = 1 OR num = c8 + 1) THEN 8 WHEN lv = 9 AND num = 1 THEN 9 END AS r
          FROM (SELECT *, CASE WHEN kind = 'H' THEN coalesce(level, 5) END AS lv
          FROM (SELECT b.doc_id, b.section_idx, b.section_name, b.i, b.seq, b.level, b.num, b.text_body, b.mark, CASE WHEN b.g OR b.level = -1 THEN 'special' WHEN b.forced THEN '조' ELSE b.type END AS type, {", ".join(f"s.{x}" for x in o)}, s.slot, s.c7, s.c8, s.sp, s.jo,
            CASE WHEN b.g THEN 'G' WHEN s.sp = 2 AND NOT b.hs OR s.sp = 1 AND NOT b.jp AND b.level IS NULL THEN 'A' WHEN b.level = -1 THEN 'S' WHEN b.level IS NOT NULL OR b.forced THEN 'H' ELSE 'T' END AS kind
          FROM steps AS s JOIN flagged AS b ON s.doc_id = b.doc_id AND s.section_idx = b.section_idx AND b.i = s.i + 1) AS q1) AS q2) AS q3) AS q4) AS q5) AS q6) AS q7
        ),
        texts AS MATERIALIZED (SELECT s.*, f.section_name, f.content, f.text_body, f.forced, f.body, f.mark, f.page_index, f.branch, CASE WHEN f.g THEN left(f.content, 50) WHEN f.forced THEN {_FORCED_TITLE.replace("rest", "f.rest")} ELSE f.title END AS title FROM steps AS s JOIN flagged AS f USING (doc_id, section_idx, seq)),
        owned AS MATERIALIZED (SELECT doc_id, section_idx, seq AS place, CASE WHEN kind = 'A' THEN max(CASE WHEN kind IN ('G', 'S') THEN seq END) OVER (PARTITION BY doc_id, section_idx ORDER BY seq) ELSE owner.s END AS seq, CASE WHEN kind = 'A' THEN 0 ELSE owner.b END AS sub, content, kind FROM texts),
        more AS (SELECT doc_id, section_idx, seq, sub, string_agg(content, chr(10) ORDER BY place) AS added FROM owned WHERE kind = 'A' OR seq IS NOT NULL GROUP BY 1, 2, 3, 4),
        made_nodes AS MATERIALIZED (SELECT n.*, CASE WHEN added IS NULL THEN own ELSE own || chr(10) || added END AS content, row_number() OVER (PARTITION BY doc_id ORDER BY path) - 1 AS preorder, length(path) - length(replace(path, '/', '')) AS depth FROM (
          SELECT doc_id, section_idx, seq, 0 AS sub, type, CASE WHEN type = 'special' THEN -1 ELSE lv END AS level, CASE WHEN kind = 'H' THEN num END AS number, main.id AS id, parent.s AS parent_seq, parent.b AS parent_sub, main.p AS path,
            CASE WHEN kind = 'H' AND lv = 5 AND NOT forced AND body <> '' THEN {_strip("replace(content, body, '')")} ELSE content END AS own, section_name, mark AS marker, title, page_index AS page, CASE WHEN kind = 'H' AND NOT forced THEN branch END AS branch FROM texts WHERE kind IN ('G', 'S', 'H')
          UNION ALL SELECT doc_id, section_idx, seq, 1, '항', 6, 1, made.id, auto_parent.s, auto_parent.b, made.p, CASE WHEN lv = 5 THEN text_body WHEN kind = 'T' THEN content ELSE '' END AS own, section_name, '①', CASE WHEN lv = 5 THEN left(text_body, 30) WHEN kind = 'T' THEN left(content, 30) ELSE '{X.AUTO_TITLE}' END, page_index, NULL FROM texts WHERE auto
          UNION ALL SELECT DISTINCT doc_id, section_idx, CAST(-1 AS BIGINT), 0, 'section', 0, CAST(NULL AS INT), section_name, CAST(NULL AS BIGINT), CAST(NULL AS INT), lpad(CAST(section_idx AS VARCHAR), 6, '0'), '', section_name, '', section_name, 0, NULL FROM flagged
        ) AS n LEFT JOIN more USING (doc_id, section_idx, seq, sub))"""


ORACLE["parse_nodes"] = f"{_folded()} SELECT doc_id, section_idx, seq, sub, type, level, number, id, parent_seq, parent_sub FROM made_nodes"
ORACLE["node_text"] = f"{_folded()} SELECT doc_id, preorder, CAST(depth AS INT) AS depth, id, content FROM made_nodes"
ORACLE["page_file_order"] = f"SELECT doc_id, page_index, block_idx, row_number() OVER (PARTITION BY doc_id ORDER BY 'page_' || (page_index * 5 + doc_id) % 13, page_index, block_idx) - 1 AS seq FROM ({sql('term_blocks')}) AS t"
ORACLE["newest_pages"] = "SELECT l_orderkey AS doc_id, CAST(l_linenumber % 3 AS INT) AS page_index, 'page_' || l_linenumber AS file_name, strftime(l_shipdate, '%Y-%m-%d') AS modified FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber % 3 ORDER BY l_shipdate DESC, 'page_' || l_linenumber DESC) = 1"
ORACLE["section_text"] = f"{_folded()} SELECT doc_id, section_idx, string_agg(content, chr(10) ORDER BY preorder) AS text FROM made_nodes WHERE content <> '' GROUP BY 1, 2"
ORACLE["section_whole_text"] = f"{_folded()} SELECT doc_id, section_idx, string_agg(content, chr(10) ORDER BY preorder) AS text FROM made_nodes GROUP BY 1, 2"
_GENERAL = "(SELECT doc_id, arg_min(id, section_idx) AS target FROM made_nodes WHERE type = 'section' AND contains(title, '보통약관') GROUP BY doc_id)"
ORACLE["extends_relations"] = f"""{_folded()} SELECT DISTINCT s.doc_id, s.section_idx, s.id AS source, g.target, 'EXTENDS' AS type FROM made_nodes AS s JOIN made_nodes AS n ON n.doc_id = s.doc_id AND n.section_idx = s.section_idx JOIN {_GENERAL} AS g ON g.doc_id = s.doc_id
    WHERE s.type = 'section' AND (contains(s.title, '추가약관') OR contains(s.title, '특별약관')) AND contains(n.content, '보통약관')"""
_UID = "{0}.doc_id || ':' || {0}.section_idx || ':' || {0}.seq || ':' || {0}.sub"
ORACLE["find_node"] = f"""{_folded()} SELECT s.doc_id, {_UID.format("s")} AS from_uid, q.id FROM made_nodes AS s
    JOIN (SELECT doc_id, section_idx, min_by(seq, preorder) AS seq FROM made_nodes WHERE type = '조' AND number = 3 AND branch IS NULL AND parent_seq = -1 GROUP BY 1, 2) AS a ON a.doc_id = s.doc_id AND a.section_idx = s.section_idx
    JOIN (SELECT doc_id, section_idx, parent_seq, parent_sub, min_by(id, preorder) AS id FROM made_nodes WHERE type = '항' AND number = 1 GROUP BY 1, 2, 3, 4) AS q ON q.doc_id = s.doc_id AND q.section_idx = s.section_idx AND q.parent_seq = a.seq AND q.parent_sub = 0 WHERE s.type = 'section'"""
_BELOW = "starts_with(n.path, a.path || '/')"
_SHOWN = "CASE WHEN n.marker <> '' THEN n.marker || ' ' || n.content ELSE n.content END"
_CONTEXT = "(SELECT arg_max(k.title, k.depth) FROM made_nodes AS k WHERE k.doc_id = a.doc_id AND k.type = '관' AND starts_with(a.path, k.path || '/'))"
_ARTICLE = f"""SELECT a.doc_id, a.section_idx, a.preorder, a.id, 'Jo' AS label, a.title, a.section_name AS section, a.number, a.branch, a.page, coalesce('[' || nullif({_CONTEXT}, '') || ']' || chr(10), '') ||
    concat_ws(chr(10), CASE WHEN a.marker <> '' AND a.title <> '' THEN a.marker || ' (' || a.title || ')' END, nullif(a.content, ''), (SELECT string_agg({_SHOWN}, chr(10) ORDER BY n.preorder) FROM made_nodes AS n WHERE n.doc_id = a.doc_id AND n.section_idx = a.section_idx AND {_BELOW} AND {_SHOWN} <> '')) AS embedding_text
    FROM made_nodes AS a WHERE a.type = '조'"""
_SPECIAL = "SELECT doc_id, section_idx, preorder, id, 'Special' AS label, marker AS title, section_name AS section, CAST(NULL AS INT) AS number, CAST(NULL AS INT) AS branch, page, content AS embedding_text FROM made_nodes WHERE type = 'special' AND (contains(marker, '법규') OR contains(marker, '설명'))"
_WORDS = "CAST(len(list_filter(regexp_split_to_array(embedding_text, '\\s+'), lambda x: x <> '')) AS INT)"
ORACLE["embedding_inputs"] = f"{_folded()} SELECT *, {_WORDS} AS token_count FROM (SELECT * FROM ({_ARTICLE}) AS j UNION ALL {_SPECIAL}) AS e"

# References: what is left of a text when its citations of laws are taken out holds the
# internal ones; a paragraph alone counts where the text names no article.
_LAWS = f"(SELECT doc_id, max(law = '상법') AS a, max(law = '보험업법') AS b FROM ({ORACLE['external_laws']}) AS l GROUP BY doc_id)"
_CITED = lambda names: f"'({names})' || {_re(X.LAW_TAIL)}"
_BY_LAWS = lambda f: f"CASE WHEN a AND b THEN {f('보험업법|상법')} WHEN a THEN {f('상법')} WHEN b THEN {f('보험업법')} ELSE {f(X.ANY_LAW)} END"
_ALL = lambda p, n, c="text": f"regexp_extract_all({c}, {p}, {n})"
_INT = lambda c: f"TRY_CAST({c} AS INT)"


def _references() -> str:
    """``found``: references in texts, with what they resolve to."""
    part = lambda n: _BY_LAWS(lambda names: _ALL(_CITED(names), n))
    inner = _re(X.ARTICLE_REFERENCE)
    return f"""{_folded()}, searched AS MATERIALIZED (SELECT t.*, {_BY_LAWS(lambda names: f"regexp_replace(text, {_CITED(names)}, '※', 'g')")} AS rest, {", ".join(f"{part(n)} AS e{n}" for n in range(6))} FROM (
          SELECT t.*, coalesce(l.a, FALSE) AS a, coalesce(l.b, FALSE) AS b FROM (
            SELECT doc_id, section_idx, seq, 0 AS part, seq AS owner_seq, 0 AS owner_sub, main.id AS source_id, content AS text, jo_before AS article FROM texts WHERE kind = 'H'
            UNION ALL SELECT doc_id, section_idx, seq, 1, seq, 1, made.id, CASE WHEN lv = 5 THEN text_body ELSE content END, CASE WHEN lv = 5 THEN num ELSE jo_before END FROM texts WHERE auto AND (lv = 5 OR kind = 'T')
            UNION ALL SELECT doc_id, section_idx, seq, 1, owner.s, owner.b, owner.id, content, jo_before FROM texts WHERE kind = 'T' AND NOT auto AND o5 IS NOT NULL) AS t
          LEFT JOIN {_LAWS} AS l USING (doc_id)) AS t),
        external AS (SELECT doc_id, section_idx, seq, part, owner_seq, owner_sub, source_id, unnest(e0) AS raw_text, unnest(e1) AS target_law, unnest(e2) AS s2, unnest(e3) AS s3, unnest(e4) AS s4, unnest(e5) AS s5, unnest(range(len(e0))) AS ordinal FROM searched),
        internal AS (SELECT doc_id, section_idx, seq, part, owner_seq, owner_sub, source_id, {", ".join(f"unnest({_ALL(inner, n, 'rest')}) AS s{n}" for n in (0, 1, 2, 4, 5, 6))}, len(e0) + unnest(range(len({_ALL(inner, 0, 'rest')}))) AS ordinal FROM searched),
        alone AS (SELECT doc_id, section_idx, seq, part, owner_seq, owner_sub, source_id, article, unnest({_ALL(_re(X.PARAGRAPH_REFERENCE), 0)}) AS raw_text, unnest({_ALL(_re(X.PARAGRAPH_REFERENCE), 1)}) AS s4, unnest(range(len({_ALL(_re(X.PARAGRAPH_REFERENCE), 0)}))) AS ordinal FROM searched WHERE article > 0 AND NOT {_has(X.ARTICLE_NEAR, "text")}),
        refs AS MATERIALIZED (
          SELECT doc_id, section_idx, seq, part, owner_seq, owner_sub, source_id, ordinal, 'external' AS ref_type, target_law, {_INT("s2")} AS target_jo, {_INT("s3")} AS target_jo_branch, {_INT("s4")} AS target_hang, {_INT("s5")} AS target_ho, CAST(NULL AS VARCHAR) AS target_mok, raw_text FROM external
          UNION ALL SELECT doc_id, section_idx, seq, part, owner_seq, owner_sub, source_id, ordinal, 'internal', NULL, {_INT("s1")}, {_INT("s2")}, {_INT("s4")}, {_INT("s5")}, nullif(s6, ''), s0 FROM internal
          UNION ALL SELECT doc_id, section_idx, seq, part, owner_seq, owner_sub, source_id, ordinal, 'internal', NULL, article, NULL, {_INT("s4")}, NULL, NULL, raw_text FROM alone),
        found AS MATERIALIZED (SELECT r.*, CASE WHEN x.id IS NOT NULL THEN x.id || coalesce('.' || CASE WHEN target_hang <= 20 THEN substr('{X.CIRCLED}', target_hang, 1) ELSE '제' || target_hang || '항' END, '') || coalesce('.' || target_ho || '.', '') || coalesce('.' || target_mok || '.', '') END AS resolved_id
          FROM refs AS r LEFT JOIN (SELECT doc_id, section_name, number, coalesce(branch, -1) AS br, arg_max(id, preorder) AS id FROM made_nodes WHERE type = '조' GROUP BY 1, 2, 3, 4) AS x
            ON r.ref_type = 'internal' AND x.doc_id = r.doc_id AND x.section_name = split_part(r.source_id, '.', 1) AND x.number = r.target_jo AND x.br = coalesce(r.target_jo_branch, -1))"""


ORACLE["resolve_refs"] = f"{_references()} SELECT doc_id, section_idx, seq, part, source_id, CAST(ordinal AS INT) AS ordinal, ref_type, target_law, target_jo, target_jo_branch, target_hang, target_ho, target_mok, raw_text, resolved_id FROM found"
ORACLE["section_counts"] = f"""{_references()} SELECT n.doc_id, n.section_idx, count(*) FILTER (type = '조') AS articles, (SELECT count(*) FROM found AS r WHERE r.doc_id = n.doc_id AND r.section_idx = n.section_idx) AS refs FROM made_nodes AS n GROUP BY 1, 2"""
# subtrees by steps from parent to child
_REACH = """reach AS (SELECT doc_id, section_idx, seq, sub, seq AS tseq, sub AS tsub, preorder AS top, type AS ttype, type, content FROM made_nodes
    UNION ALL SELECT c.doc_id, c.section_idx, c.seq, c.sub, r.tseq, r.tsub, r.top, r.ttype, c.type, c.content FROM reach AS r JOIN made_nodes AS c ON c.doc_id = r.doc_id AND c.section_idx = r.section_idx AND c.parent_seq = r.seq AND c.parent_sub = r.sub)"""
ORACLE["subtree_sizes"] = f"{_folded()}, {_REACH} SELECT doc_id, top AS preorder, count(*) AS nodes, count(*) FILTER (type = '조') AS articles, CAST(sum(length(content)) AS BIGINT) AS chars FROM reach GROUP BY 1, 2 HAVING count(*) > 1"
ORACLE["section_references"] = f"{_references()}, {_REACH} SELECT r.doc_id, r.doc_id || ':' || r.section_idx || ':' || r.tseq || ':' || r.tsub AS top_uid, count(*) AS refs, count(f.resolved_id) AS resolved FROM reach AS r JOIN found AS f ON f.doc_id = r.doc_id AND f.section_idx = r.section_idx AND f.owner_seq = r.seq AND f.owner_sub = r.sub WHERE r.ttype = '관' GROUP BY 1, 2"
ORACLE["reference_statistics"] = f"{_references()} SELECT ref_type, count(*) AS n, count(resolved_id) AS resolved FROM found GROUP BY 1"
_EDGES = """SELECT c.doc_id, c.section_idx, p.id AS source, c.id AS target, 'HAS_CHILD' AS type, NULL AS raw_text, CAST(NULL AS INT) AS target_jo, CAST(NULL AS INT) AS target_hang, NULL AS law, CAST(NULL AS INT) AS article FROM made_nodes AS c JOIN made_nodes AS p ON p.doc_id = c.doc_id AND p.section_idx = c.section_idx AND p.seq = c.parent_seq AND p.sub = c.parent_sub
    UNION ALL SELECT doc_id, section_idx, source_id, resolved_id, 'REFERENCES', raw_text, target_jo, target_hang, NULL, NULL FROM found WHERE resolved_id IS NOT NULL
    UNION ALL SELECT doc_id, section_idx, source_id, 'law_' || target_law || '_' || target_jo, 'CITES_LAW', raw_text, NULL, NULL, target_law, target_jo FROM found WHERE ref_type = 'external'"""
ORACLE["graph_edges"] = f"{_references()} {_EDGES}"
_FILE = "lpad(CAST(s.section_idx AS VARCHAR), 2, '0') || '_' || left(regexp_replace(regexp_replace(s.title, '[\\\\/*?:\"<>|]', '', 'g'), '\\s+', '_', 'g'), 50)"
ORACLE["section_stats"] = f"""{_references()}, edges AS ({_EDGES}) SELECT s.doc_id, s.section_idx, s.id, s.title AS name, {_TYPE.replace("section_name", "s.title")} AS type,
    (SELECT count(*) FROM made_nodes AS n WHERE n.doc_id = s.doc_id AND n.section_idx = s.section_idx) AS node_count, (SELECT count(*) FROM edges AS e WHERE e.doc_id = s.doc_id AND e.section_idx = s.section_idx) AS edge_count,
    (SELECT count(*) FROM made_nodes AS n WHERE n.doc_id = s.doc_id AND n.section_idx = s.section_idx AND (n.type = '조' OR n.type = 'special' AND (contains(n.marker, '법규') OR contains(n.marker, '설명')))) AS embedding_count,
    'sections/' || {_FILE} || '.json' AS file, 'embeddings/' || {_FILE} || '_embeddings.json' AS embedding_file FROM made_nodes AS s WHERE s.type = 'section'"""
_COUNTED = "coalesce((SELECT ' (refs:' || count(*) || ')' FROM found AS r WHERE r.doc_id = n.doc_id AND r.section_idx = n.section_idx AND r.owner_seq = n.seq AND r.owner_sub = n.sub HAVING count(*) > 0), '')"
ORACLE["tree_lines"] = f"{_references()} SELECT doc_id, preorder, repeat('│   ', depth) || '├── [' || CASE WHEN marker <> '' THEN marker ELSE type END || '] ' || CASE WHEN length(title) > 35 THEN left(title, 35) || '...' ELSE title END || {_COUNTED} AS line FROM made_nodes AS n WHERE depth <= 4"
_LABEL = "CASE type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in X.LABELS.items()) + " END"
ORACLE["nodes_by_label"] = f"{_folded()} SELECT s.id AS section_id, {_LABEL.replace('CASE type', 'CASE n.type')} AS label, count(*) AS n FROM made_nodes AS n JOIN made_nodes AS s ON n.doc_id = s.doc_id AND n.section_idx = s.section_idx AND s.type = 'section' GROUP BY 1, 2"
ORACLE["node_statistics"] = f"{_folded()} SELECT CASE WHEN sub = 1 THEN '항(자동)' ELSE type END AS kind, count(*) AS n FROM made_nodes WHERE type <> 'section' GROUP BY 1"

_PUNCT = lambda c: f"regexp_replace(regexp_replace(regexp_replace({c}, '\\s+\\(', '(', 'g'), '\\)\\s+', ')', 'g'), '\\s+([,.])', '\\1', 'g')"
_TOKENS = lambda c: f"CAST(len(list_filter(regexp_split_to_array({c}, '\\s+'), lambda x: x <> '')) AS INT)"
ORACLE["text_scalars"] = f"""SELECT doc_id, seq, left(regexp_replace(regexp_replace(block_content, '[\\\\/*?:"<>|]', '', 'g'), '\\s+', '_', 'g'), 50) AS file, regexp_replace(block_content, '[^가-힣a-zA-Z0-9_]', '_', 'g') AS safe,
    {_TOKENS("block_content")} AS tokens, regexp_replace(replace({_strip(f"replace({_PUNCT('block_content')}, chr(10), ' ')")}, '\\"', ''), '\\s+', ' ', 'g') AS plain FROM ({sql("term_blocks")}) AS t"""
ORACLE["token_counts"] = f"SELECT doc_id, {_TOKENS('text')} AS tokens FROM documents"
ORACLE["punctuation_rules"] = f"SELECT doc_id, md5({_PUNCT('text')}) AS digest FROM documents"
ORACLE["html_escape"] = "SELECT page_id, md5(replace(replace(replace(replace(coalesce(html, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')) AS digest FROM pages"
_ROMANS = "['ii', 'X', 'ⅳ', 'viii', 'zz', 'IX', 'ⅹ']"
ORACLE["markers"] = f"""SELECT l_orderkey, l_linenumber, CASE WHEN n <= 20 THEN substr('{X.CIRCLED}', n, 1) ELSE '제' || n || '항' END AS circled, CASE WHEN n <= 20 THEN n END AS back,
    CAST([2, 10, 4, 8, 1, 9, 10][k] AS INT) AS roman, CASE WHEN n <= 14 THEN n END AS mok FROM (SELECT l_orderkey, l_linenumber, CAST(l_partkey % 25 + 1 AS INT) AS n, greatest(least(l_linenumber, 7), 1) AS k FROM lineitem) AS l"""

_S, _B = sql("shape_blocks"), sql("shape_boxes")
_POINT = lambda c, by: f"CAST(round(round_even({c} * {by}, 2) * 100) AS BIGINT)"
ORACLE["bbox_rescale"] = f"""SELECT doc_id, block_idx, CAST(CASE WHEN doc_id % 5 = 0 THEN 0 ELSE 4 END AS BIGINT) AS n, {", ".join(f"CASE WHEN doc_id % 5 > 0 THEN {_POINT(c, 0.5)} END AS c{i}" for i, c in enumerate(("x0", "y0", "x1", "y1")))} FROM ({_S}) AS t"""
_W, _H = "(least(a.x1, b.x1) - greatest(a.x0, b.x0))", "(least(a.y1, b.y1) - greatest(a.y0, b.y0))"
_AREA = lambda t: f"(({t}.x1 - {t}.x0) * ({t}.y1 - {t}.y0))"
_IOU = f"(CASE WHEN {_W} > 0 AND {_H} > 0 THEN {_W} * {_H} / ({_AREA('a')} + {_AREA('b')} - {_W} * {_H}) ELSE 0 END)"
ORACLE["iou_pairs"] = f"SELECT a.doc_id, a.id AS a, b.id AS b, CAST(round({_IOU} * 1000000) AS BIGINT) AS iou FROM ({_B}) AS a JOIN ({_B}) AS b ON a.doc_id = b.doc_id AND a.id < b.id WHERE {_IOU} >= 0.2"
_IN = f"{_W} > 0 AND {_H} > 0 AND {_W} * {_H} / {_AREA('a')} >= {X.OVERLAP} AND {_W} / (a.x1 - a.x0) >= {X.OVERLAP} AND {_H} / (a.y1 - a.y0) >= {X.OVERLAP} AND a.y0 >= b.y0 - {X.BOX_MARGIN} AND a.y1 <= b.y1 + {X.BOX_MARGIN} AND a.x0 >= b.x0 - {X.BOX_MARGIN} AND a.x1 <= b.x1 + {X.BOX_MARGIN}"
_SCORE = f"CASE WHEN b.x0 <= a.x0 AND a.x1 <= b.x1 AND b.y0 <= a.y0 AND a.y1 <= b.y1 THEN {_AREA('b')} ELSE {_AREA('b')} / ({_W} * {_H} / {_AREA('a')} + 0.1) END"
_HITS = f"SELECT a.doc_id, a.block_idx, b.id AS box_id, row_number() OVER (PARTITION BY a.doc_id, a.block_idx ORDER BY {_SCORE}, b.id) AS k FROM ({_S}) AS a JOIN ({_B}) AS b ON a.doc_id = b.doc_id WHERE {_IN}"
_BOXED = f"SELECT t.doc_id, t.block_idx, h.box_id IS NOT NULL AS inside_box, h.box_id FROM ({_S}) AS t LEFT JOIN (SELECT * FROM ({_HITS}) AS x WHERE k = 1) AS h ON t.doc_id = h.doc_id AND t.block_idx = h.block_idx"
ORACLE["block_in_box"] = _BOXED
ORACLE["box_statistics"] = f"SELECT doc_id, 0 AS page_index, count(*) AS blocks, count(*) FILTER (inside_box) AS boxed FROM ({_BOXED}) AS t GROUP BY doc_id"
ORACLE["block_in_box_by_corner"] = f"SELECT a.doc_id, a.block_idx, min(b.id) AS box_id FROM ({_S}) AS a LEFT JOIN ({_B}) AS b ON a.doc_id = b.doc_id AND a.x0 BETWEEN b.x0 - 2 AND b.x1 + 2 AND a.y0 BETWEEN b.y0 - 2 AND b.y1 + 2 GROUP BY 1, 2"
ORACLE["distinct_boxes"] = f"SELECT doc_id, id FROM ({_B}) AS b WHERE NOT EXISTS (SELECT 1 FROM ({_B}) AS a WHERE a.doc_id = b.doc_id AND a.id < b.id AND abs(a.x0 - b.x0) < 30 AND abs(a.y0 - b.y0) < 30 AND abs(a.x1 - b.x1) < 30 AND abs(a.y1 - b.y1) < 30)"

_SEG = f"""SELECT doc_id, page_index, r * 5 + i AS seg_idx, CASE WHEN i = 4 THEN 'c' ELSE 'l' END AS kind, CASE i WHEN 1 THEN x1 ELSE x0 END AS x0, CASE i WHEN 2 THEN y1 ELSE y0 END AS y0, CASE i WHEN 3 THEN x0 ELSE x1 END AS x1, CASE i WHEN 0 THEN y0 ELSE y1 END AS y1
    FROM ({sql("rectangles")}) AS t, (SELECT unnest(range(5)) AS i) AS n"""
ORACLE["line_directions"] = f"SELECT doc_id, seg_idx, x1 <> x0 AND coalesce(abs(y1 - y0) / nullif(abs(x1 - x0), 0) < {X.SLOPE}, FALSE) AS level, y1 <> y0 AND coalesce(abs(x1 - x0) / nullif(abs(y1 - y0), 0) < {X.SLOPE}, FALSE) AS upright, CAST(round(sqrt((x0 - x1) * (x0 - x1) + (y0 - y1) * (y0 - y1)) * 1000) AS BIGINT) AS length FROM ({_SEG}) AS s"
_NEAR = " OR ".join(f"sqrt((a.x{i} - b.x{j}) * (a.x{i} - b.x{j}) + (a.y{i} - b.y{j}) * (a.y{i} - b.y{j})) < {X.ENDPOINT_GAP}" for i in (0, 1) for j in (0, 1))
_COMPONENTS = f"""WITH RECURSIVE lines AS MATERIALIZED (SELECT * FROM ({_SEG}) AS s WHERE kind = 'l'),
    near AS MATERIALIZED (SELECT a.doc_id, a.page_index, a.seg_idx AS a, b.seg_idx AS b FROM lines AS a JOIN lines AS b ON a.doc_id = b.doc_id AND a.page_index = b.page_index AND (a.seg_idx = b.seg_idx OR {_NEAR})),
    reach AS (SELECT doc_id, page_index, a, b FROM near UNION SELECT r.doc_id, r.page_index, r.a, n.b FROM reach AS r JOIN near AS n ON r.doc_id = n.doc_id AND r.page_index = n.page_index AND r.b = n.a),
    parts AS MATERIALIZED (SELECT doc_id, page_index, a AS seg_idx, min(b) AS component FROM reach GROUP BY 1, 2, 3)"""
ORACLE["segment_components"] = f"{_COMPONENTS} SELECT * FROM parts"
_CANDIDATES = f"""candidates AS MATERIALIZED (SELECT doc_id, page_index, component AS box_idx, min(least(x0, x1)) AS x0, min(least(y0, y1)) AS y0, max(greatest(x0, x1)) AS x1, max(greatest(y0, y1)) AS y1, count(*) AS line_count FROM lines JOIN parts USING (doc_id, page_index, seg_idx) GROUP BY 1, 2, 3
    HAVING count(*) >= 4 AND count(*) FILTER (x1 <> x0 AND abs(y1 - y0) < {X.SLOPE} * abs(x1 - x0)) >= 2 AND count(*) FILTER (y1 <> y0 AND abs(x1 - x0) < {X.SLOPE} * abs(y1 - y0)) >= 2
    AND max(greatest(x0, x1)) - min(least(x0, x1)) >= {X.BOX_WIDTH} AND max(greatest(y0, y1)) - min(least(y0, y1)) >= {X.BOX_HEIGHT})"""
ORACLE["box_candidates"] = f"{_COMPONENTS}, {_CANDIDATES} SELECT * FROM candidates"
_OVER = "CASE WHEN least(x.x1, c.x1) > greatest(x.x0, c.x0) AND least(x.y1, c.y1) > greatest(x.y0, c.y0) THEN (least(x.x1, c.x1) - greatest(x.x0, c.x0)) * (least(x.y1, c.y1) - greatest(x.y0, c.y0)) ELSE 0 END"
_BOTH = "((x.x1 - x.x0) * (x.y1 - x.y0) + (c.x1 - c.x0) * (c.y1 - c.y0))"
_ORDERED = "SELECT *, row_number() OVER (PARTITION BY doc_id, page_index ORDER BY (x1 - x0) * (y1 - y0) DESC, box_idx) AS k FROM candidates"
ORACLE["detect_boxes"] = f"""{_COMPONENTS}, {_CANDIDATES}, ranked AS MATERIALIZED ({_ORDERED}),
    kept AS (SELECT doc_id, page_index, k, TRUE AS stays, [{{'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}}] AS boxes FROM ranked WHERE k = 1
      UNION ALL SELECT doc_id, page_index, k, stays, CASE WHEN stays THEN list_append(boxes, box) ELSE boxes END FROM (
        SELECT p.doc_id, p.page_index, c.k, p.boxes, {{'x0': c.x0, 'y0': c.y0, 'x1': c.x1, 'y1': c.y1}} AS box, len(list_filter(p.boxes, lambda x: ({_OVER}) / ({_BOTH} - ({_OVER})) >= {X.IOU_LIMIT})) = 0 AS stays
        FROM kept AS p JOIN ranked AS c ON p.doc_id = c.doc_id AND p.page_index = c.page_index AND c.k = p.k + 1) AS q)
    SELECT r.doc_id, r.page_index, CAST(row_number() OVER (PARTITION BY r.doc_id, r.page_index ORDER BY r.k) - 1 AS INT) AS id, x0, y0, x1, y1, x1 - x0 AS width, y1 - y0 AS height, CAST(line_count AS INT) AS line_count FROM ranked AS r JOIN kept USING (doc_id, page_index, k) WHERE stays"""

# candidates one by one: a drawing's own rectangle stays, others if none that stayed is nearly equal
_SPAN = "min(least(x0, x1)) AS x0, min(least(y0, y1)) AS y0, max(greatest(x0, x1)) AS x1, max(greatest(y0, y1)) AS y1"
ORACLE["legacy_boxes"] = f"""WITH RECURSIVE lines AS MATERIALIZED (SELECT *, seg_idx // 5 AS r FROM ({_SEG}) AS s WHERE kind = 'l'),
    every AS (SELECT doc_id, page_index, 0 AS rank, r, 0 AS step, 'rect' AS type, x0, y0, x1, y1 FROM ({sql("rectangles")}) AS t WHERE r % 3 = 0
      UNION ALL SELECT doc_id, page_index, 0, r, 1, 'lines', {_SPAN} FROM lines GROUP BY doc_id, page_index, r HAVING count(*) >= 4
      UNION ALL SELECT doc_id, page_index, 1, 0, 1, 'lines_combined', {_SPAN} FROM lines GROUP BY doc_id, page_index HAVING count(*) >= 4
      UNION ALL SELECT doc_id, page_index, 2, r, 1, 'annotation', x0 + r % 7, y0, x1, y1 FROM ({sql("rectangles")}) AS t WHERE r % 4 = 0),
    cs AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY doc_id, page_index ORDER BY rank, r, step) AS k FROM every WHERE x1 - x0 >= 50 AND y1 - y0 >= 30),
    fold AS (SELECT doc_id, page_index, k, TRUE AS stays, [{{'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}}] AS kept FROM cs WHERE k = 1
      UNION ALL SELECT doc_id, page_index, k, stays, CASE WHEN stays THEN list_append(kept, {{'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}}) ELSE kept END FROM (
        SELECT c.*, f.kept, c.type = 'rect' OR len(list_filter(f.kept, lambda z: abs(z.x0 - c.x0) < 5 AND abs(z.y0 - c.y0) < 5 AND abs(z.x1 - c.x1) < 5 AND abs(z.y1 - c.y1) < 5)) = 0 AS stays
        FROM fold AS f JOIN cs AS c ON f.doc_id = c.doc_id AND f.page_index = c.page_index AND c.k = f.k + 1) AS q)
    SELECT c.doc_id, c.page_index, CAST(row_number() OVER (PARTITION BY c.doc_id, c.page_index ORDER BY c.k) - 1 AS INT) AS id, x0, y0, x1, y1, x1 - x0 AS width, y1 - y0 AS height, type FROM cs AS c JOIN fold AS f ON f.doc_id = c.doc_id AND f.page_index = c.page_index AND f.k = c.k WHERE f.stays"""

_RANK = "row_number() OVER (PARTITION BY doc_id ORDER BY block_order IS NULL, coalesce(block_order, block_id), block_idx)"
ORACLE["reading_order"] = f"SELECT doc_id, block_idx, {_RANK} AS rank FROM ({_S}) AS t"
_TEXTS, _IMAGES = (", ".join(f"'{x}'" for x in labels) for labels in (X.TEXT_LABELS, X.IMAGE_LABELS))
_PRIVATE = "regexp_matches(block_content, '[\\x{E000}-\\x{F8FF}]')"
ORACLE["block_selection"] = f"SELECT doc_id, block_idx, block_label IN ({_TEXTS}) AS is_text, block_label IN ({_IMAGES}) AS is_image, {_PRIVATE} AS private FROM ({_S}) AS t"
ORACLE["formula_relabel"] = f"SELECT CASE WHEN block_label IN ({_TEXTS}) AND {_PRIVATE} THEN 'formula' ELSE block_label END AS block_label, count(*) AS n FROM ({_S}) AS t GROUP BY 1"
_ESC = lambda c: f"replace(replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')"
ORACLE["html_blocks"] = f"""SELECT doc_id, {_RANK} AS rank, '<div class="block ' || block_label || '"><div><span class="block-label ' || block_label || '">' || block_label || '</span><span class="place">' ||
    CASE WHEN block_order IS NULL THEN '(ID: ' || block_id || ')' ELSE '(Order: ' || CAST(block_order AS VARCHAR) || ', ID: ' || block_id || ')' END || '</span></div><div class="block-content">' ||
    {_ESC(f"CASE WHEN block_content = '' AND block_label NOT IN ('number', 'footnote') THEN '{X.EMPTY_CONTENT}' ELSE block_content END")} || '</div></div>' AS html FROM ({_S}) AS t"""
# known blocks bound their neighbours by place in the list ordered by height
_LIST = f"SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY y, block_idx) AS pl FROM ({_S}) AS t"
_BOUND = f"""SELECT b.*, (SELECT max(k.pl) FROM ls AS k WHERE k.doc_id = b.doc_id AND k.block_order IS NOT NULL AND k.pl < b.pl) AS lo, (SELECT min(k.pl) FROM ls AS k WHERE k.doc_id = b.doc_id AND k.block_order IS NOT NULL AND k.pl > b.pl) AS hi FROM ls AS b"""
ORACLE["block_order_fill"] = f"""WITH ls AS MATERIALIZED ({_LIST}), bound AS MATERIALIZED ({_BOUND}),
    zones AS (SELECT b.*, p.block_order AS po, n.block_order AS no, CASE WHEN b.block_order IS NOT NULL THEN 'known' WHEN lo IS NULL AND hi IS NOT NULL AND b.y < n.y THEN 'above' WHEN hi IS NULL AND lo IS NOT NULL AND b.y > p.y THEN 'below' WHEN b.y > p.y AND b.y < n.y THEN 'between' END AS zone
      FROM bound AS b LEFT JOIN ls AS p ON p.doc_id = b.doc_id AND p.pl = b.lo LEFT JOIN ls AS n ON n.doc_id = b.doc_id AND n.pl = b.hi),
    runs AS (SELECT *, row_number() OVER (PARTITION BY doc_id, zone, lo ORDER BY pl) AS i, count(*) OVER (PARTITION BY doc_id, zone, lo) AS c FROM zones),
    given AS (SELECT *, CASE zone WHEN 'known' THEN block_order WHEN 'between' THEN po + (no - po) / (c + 1) * i WHEN 'above' THEN no - 0.1 * (c - i + 1) WHEN 'below' THEN po + 0.1 * i END AS filled FROM runs),
    rest AS (SELECT *, row_number() OVER (PARTITION BY doc_id, filled IS NULL ORDER BY block_id, pl) AS j, max(filled) OVER (PARTITION BY doc_id) AS top FROM given)
    SELECT doc_id, block_idx, CAST(round(CASE WHEN filled IS NOT NULL THEN filled ELSE coalesce(top, 0) + j END * 1000) AS BIGINT) AS order_1000 FROM rest"""
ORACLE["font_summary"] = f"""SELECT doc_id, block_idx, CAST(round(round_even(avg(size), 2) * 100) AS BIGINT) AS size_100, count(*) FILTER (flags & 16 <> 0) * 2 > count(*) AS is_bold,
    (SELECT font FROM (SELECT font, count(*) AS c FROM ({sql("spans")}) AS i WHERE i.doc_id = o.doc_id AND i.block_idx = o.block_idx GROUP BY font) AS f ORDER BY c DESC, font LIMIT 1) AS font_name FROM ({sql("spans")}) AS o GROUP BY doc_id, block_idx"""
ORACLE["span_glyphs"] = f"SELECT doc_id, span_idx, substr(text, i + 1, 1) AS char, CAST(round((x0 + i * (x1 - x0) / length(text)) * 1000) AS BIGINT) AS left, CAST(round((x0 + (i + 0.5) * (x1 - x0) / length(text)) * 1000) AS BIGINT) AS center FROM (SELECT *, unnest(range(length(text))) AS i FROM ({sql('spans')}) AS s) AS t"
_GLYPHS = f"""SELECT doc_id, page_index, block_idx, span_idx, i, substr(text, i + 1, 1) AS char, x0 + i * ((x1 - x0) / length(text)) AS x0, y0, x0 + (i + 1) * ((x1 - x0) / length(text)) AS x1, y1, x0 AS so, x1 AS se FROM (SELECT *, unnest(range(length(text))) AS i FROM ({sql("spans")}) AS s) AS t"""
ORACLE["glyphs_in_block"] = f"SELECT b.doc_id, b.block_idx, g.span_idx, g.char, CAST(round(g.x0 * 1000) AS BIGINT) AS left FROM ({_GLYPHS}) AS g JOIN ({_S}) AS b ON g.doc_id = b.doc_id AND g.x0 < b.x1 AND g.x1 > b.x0 AND g.y0 < b.y1 AND g.y1 > b.y0"
# glyphs of a block one by one: copies near a kept one go, the first line whose mean height is near takes the others
_NEXT_LINE = f"coalesce(list_position(list_transform(lines, lambda l: abs(l.s / l.n - g.y0) <= {X.LINE_GAP}), TRUE), 0)"
_COPY = f"len(list_filter(kept, lambda z: z.tier = g.tier AND z.char = g.char AND sqrt((z.cx - g.cx) * (z.cx - g.cx) + (z.cy - g.cy) * (z.cy - g.cy)) < {X.SAME_GLYPH})) > 0"
_HIGH = "(y1 - y0)"
ORACLE["glyph_text"] = f"""WITH RECURSIVE g1 AS (SELECT *, (x0 + x1) / 2 AS cx, (y0 + y1) / 2 AS cy, round_even(y0 / {X.LINE_GAP}, 0) AS tier, row_number() OVER (PARTITION BY doc_id, block_idx ORDER BY span_idx, i) AS pos FROM ({_GLYPHS}) AS t),
    g2 AS (SELECT *, min(pos) OVER (PARTITION BY doc_id, block_idx, tier) AS seen FROM g1),
    gs AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY doc_id, block_idx ORDER BY seen, x0, pos) AS k FROM g2),
    fold AS (SELECT doc_id, block_idx, k, 1 AS line, [{{'tier': tier, 'char': char, 'cx': cx, 'cy': cy}}] AS kept, [{{'s': y0, 'n': 1}}] AS lines FROM gs WHERE k = 1
      UNION ALL SELECT doc_id, block_idx, k, line, CASE WHEN line < 0 THEN kept ELSE list_append(kept, {{'tier': tier, 'char': char, 'cx': cx, 'cy': cy}}) END,
        CASE WHEN line < 0 THEN lines WHEN line > len(lines) THEN list_append(lines, {{'s': y0, 'n': 1}}) ELSE list_transform(lines, lambda l, j: CASE WHEN j = line THEN {{'s': l.s + y0, 'n': l.n + 1}} ELSE l END) END
        FROM (SELECT g.*, f.kept, f.lines, CASE WHEN {_COPY} THEN -1 WHEN {_NEXT_LINE} > 0 THEN {_NEXT_LINE} ELSE len(lines) + 1 END AS line
          FROM fold AS f JOIN gs AS g ON f.doc_id = g.doc_id AND f.block_idx = g.block_idx AND g.k = f.k + 1) AS q),
    ends AS (SELECT doc_id, block_idx, lines FROM fold QUALIFY row_number() OVER (PARTITION BY doc_id, block_idx ORDER BY k DESC) = 1),
    placed AS (SELECT g.*, f.line, e.lines[f.line].s / e.lines[f.line].n AS mean FROM fold AS f JOIN gs AS g ON f.doc_id = g.doc_id AND f.block_idx = g.block_idx AND f.k = g.k JOIN ends AS e ON e.doc_id = g.doc_id AND e.block_idx = g.block_idx WHERE f.line > 0),
    beside AS (SELECT *, lead(line) OVER w AS nline, lead(x0) OVER w - x1 AS gap, lead(so) OVER w AS nso, lead(se) OVER w AS nse, char BETWEEN '가' AND '힣' AS ko, lead(char) OVER w BETWEEN '가' AND '힣' AS nko FROM placed WINDOW w AS (PARTITION BY doc_id, block_idx ORDER BY mean, line, x0, k)),
    spaced AS (SELECT *, CASE WHEN nline IS NULL THEN '' WHEN nline <> line THEN ' ' WHEN gap > CASE WHEN so <> nso OR se <> nse THEN greatest(1.5, 0.2 * {_HIGH}) WHEN ko AND nko AND gap > 0.4 * {_HIGH} THEN greatest(2.0, 0.25 * {_HIGH}) ELSE greatest(2.0, 0.4 * {_HIGH}) END THEN ' ' ELSE '' END AS gap_text FROM beside)
    SELECT doc_id, 0 AS page_index, block_idx, text, CAST(length(text) AS INT) AS text_length FROM (SELECT doc_id, block_idx, regexp_replace(trim(string_agg(char || gap_text, '' ORDER BY mean, line, x0, k)), ' +', ' ', 'g') AS text FROM spaced GROUP BY doc_id, block_idx) AS t"""
_STEM = "'page_' || doc_id || CASE WHEN doc_id % 2 = 0 THEN '_0_res' ELSE '' END"
ORACLE["image_keys"] = f"SELECT {_STEM} || '_block_' || block_idx || '.png' AS block_id, {_STEM} AS json_stem, block_idx FROM ({_S}) AS t WHERE block_idx % 3 > 0"
_PICTURE = f"CASE WHEN block_idx % 3 > 0 THEN {_STEM} || '_block_' || block_idx || '.png' END"
ORACLE["image_block_join"] = f"SELECT doc_id, block_idx, {_PICTURE} AS image_id FROM ({_S}) AS t WHERE block_label IN ({_IMAGES}) AND block_idx % 3 > 0"
ORACLE["image_block_left_join"] = f"SELECT doc_id, block_idx, {_PICTURE} AS image_id FROM ({_S}) AS t WHERE block_label IN ({_IMAGES})"
ORACLE["describe_images"] = f"SELECT doc_id, block_idx, CASE WHEN block_label NOT IN ({_IMAGES}) THEN block_content WHEN block_idx % 3 > 0 THEN block_label || ':' || octet_length(encode(block_content)) ELSE '[이미지 파일 없음: page_' || doc_id || '_0_res_block_' || block_idx || '.png]' END AS block_content FROM ({_S}) AS t"
ORACLE["request_bodies"] = f"""SELECT {_STEM} || '_block_' || block_idx || '.png' AS block_id, concat('{{"model":"vlm","max_tokens":2048,"temperature":0.1,"messages":[{{"role":"user","content":[{{"type":"image_url","image_url":{{"url":"data:image/png;base64,', base64(encode(block_content)), '"}}}},{{"type":"text","text":"\\"이것\\"은 ', block_label, '"}}]}}]}}') AS body, block_label AS answer FROM ({_S}) AS t WHERE block_idx % 3 > 0"""
ORACLE["page_join"] = f"SELECT doc_id % 3 <> 0 AS missing, count(*) AS n FROM ({_S}) AS t GROUP BY 1"
