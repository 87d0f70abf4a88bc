"""Relations for the queries, made from the given tables by arithmetic that SQL engines share.

The given documents hold no Korean and no drawings, so blocks of terms and
laws, boxes, segments, glyphs and spans are derived from their numbers; among a
document's terms stand pieces of its text, and after them the whole of it.
Each relation is one SELECT that Spark and DuckDB read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: What stands at a place of a document, chosen by its numbers n, m, h.
_TEXT = """CASE pick
 WHEN 0 THEN concat('무배당 안심', CAST(n AS VARCHAR(9)), ' 보통약관') WHEN 1 THEN concat('행복', CAST(n AS VARCHAR(9)), ' 특별약관')
 WHEN 2 THEN concat('제', CAST(n AS VARCHAR(9)), '관 총칙') WHEN 3 THEN concat('제', CAST(m AS VARCHAR(9)), '장 통칙')
 WHEN 4 THEN concat('제', CAST(n AS VARCHAR(9)), '조(목적) 이 계약은 제', CAST(m AS VARCHAR(9)), '조제', CAST(h AS VARCHAR(9)), '항을 준용합니다.')
 WHEN 5 THEN concat('제', CAST(n AS VARCHAR(9)), '조(정의)') WHEN 6 THEN concat('제', CAST(m AS VARCHAR(9)), '조 [기간] 상법 제', CAST(n AS VARCHAR(9)), '조에 따른다')
 WHEN 7 THEN concat('① 회사는 제', CAST(h AS VARCHAR(9)), '항을 지킨다') WHEN 8 THEN '② 계약자는 보통약관에 따라 알린다'
 WHEN 9 THEN concat(CAST(h AS VARCHAR(9)), '. 사망보험금') WHEN 10 THEN concat(CAST(h + 1 AS VARCHAR(9)), '. 장해보험금')
 WHEN 11 THEN '가. 질병' WHEN 12 THEN '나. 상해(보통약관)' WHEN 13 THEN '(i) 첫째' WHEN 14 THEN '(ii) 둘째' WHEN 15 THEN '- 덧붙임'
 WHEN 16 THEN '<용어풀이> 말의 뜻' WHEN 17 THEN concat('제', CAST(n AS VARCHAR(9)), '조의', CAST(h AS VARCHAR(9)), '(가지)')
 WHEN 18 THEN concat('제', CAST(n AS VARCHAR(9)), '조제', CAST(h AS VARCHAR(9)), '항에서 정한 바에 따른다') WHEN 19 THEN concat('[별표', CAST(h AS VARCHAR(9)), '] 표')
 WHEN 20 THEN concat('【법규', CAST(h AS VARCHAR(9)), '】 보험업법') WHEN 21 THEN '상법' WHEN 22 THEN '비고'
 WHEN 23 THEN concat('보통약관 제', CAST(m AS VARCHAR(9)), '조를 바꾼다') WHEN 24 THEN concat('그 밖의 글 ', CAST(m AS VARCHAR(9)))
 WHEN 25 THEN concat('제', CAST(n AS VARCHAR(9)), '편 총론') WHEN 26 THEN concat('제', CAST(m AS VARCHAR(9)), '장의', CAST(h AS VARCHAR(9)), ' (특칙)') WHEN 27 THEN concat('제', CAST(n AS VARCHAR(9)), '절 [통칙]')
 WHEN 28 THEN concat('제', CAST(n AS VARCHAR(9)), '조【기간】 상법 제', CAST(m AS VARCHAR(9)), '조') WHEN 29 THEN concat('제', CAST(n AS VARCHAR(9)), '조（효력） 회사는 제', CAST(m AS VARCHAR(9)), '조제', CAST(h AS VARCHAR(9)), '항을 따른다')
 WHEN 30 THEN concat('제', CAST(n AS VARCHAR(9)), '조[범위) 본문') WHEN 31 THEN '(ⅲ) 셋째' WHEN 32 THEN '（IV） 넷째' WHEN 33 THEN '【용어】 뜻' WHEN 34 THEN '※ 용어의 정의' WHEN 35 THEN '이 약관에서 인용된 법령'
 WHEN 36 THEN concat('[법규', CAST(h AS VARCHAR(9)), '] 상법') WHEN 37 THEN concat('든든', CAST(n AS VARCHAR(9)), ' 추가약관') WHEN 38 THEN concat('참좋은', CAST(n AS VARCHAR(9)), ' 보통약관 (무배당)')
 WHEN 39 THEN '민원 사례' WHEN 40 THEN '주요 분쟁 해설' WHEN 41 THEN '유의 사항' WHEN 42 THEN '소비자 민원 및 분쟁 유의 안내' WHEN 43 THEN '금융 분쟁 조정 사례 유의점' WHEN 44 THEN '보험 / 저축'
 WHEN 45 THEN concat('③ 제', CAST(n AS VARCHAR(9)), '조의', CAST(h AS VARCHAR(9)), ' 및 제', CAST(m AS VARCHAR(9)), '조제', CAST(h AS VARCHAR(9)), '항제2호가목') WHEN 46 THEN concat('다. 제', CAST(m AS VARCHAR(9)), '조에 따른 뜻') WHEN 47 THEN concat('제', CAST(n AS VARCHAR(9)), '조 보험금을 지급한다')
 ELSE substr(text, CAST(pos AS INT) * 40 + 1, 60) END"""

_PLACES = {
    "spark": "SELECT doc_id, text, 12 + n_chars % 30 AS last, explode(sequence(CAST(0 AS BIGINT), 12 + n_chars % 30)) AS pos FROM documents",
    "duckdb": "SELECT doc_id, text, 12 + n_chars % 30 AS last, unnest(range(0, 13 + n_chars % 30)) AS pos FROM documents",
}

#: Name to SELECT; ``{places}`` differs by engine.
RELATIONS = {
    "term_blocks": f"""SELECT doc_id, page_index, block_idx, pos AS seq, CASE WHEN pos = last THEN text ELSE {_TEXT} END AS block_content FROM (
        SELECT doc_id, text, last, pos, CAST(floor(pos / 10) AS INT) AS page_index, CAST(pos % 10 AS INT) AS block_idx,
        (doc_id * 7 + pos * pos * 3 + pos * 11) % 53 AS pick, (doc_id + pos) % 12 + 1 AS n, (doc_id * 3 + pos) % 9 + 1 AS m, (pos * 5 + doc_id) % 4 + 1 AS h
        FROM ({{places}}) AS p) AS q""",
    "shape_blocks": """SELECT l_orderkey AS doc_id, 0 AS page_index, l_linenumber AS block_idx, l_linenumber AS block_id,
        CASE WHEN (l_partkey + l_linenumber) % 3 = 0 THEN CAST(l_linenumber * 2 AS DOUBLE) END AS block_order,
        CAST(l_suppkey % 9 * 40 AS DOUBLE) AS y,
        CAST(l_partkey % 200 AS DOUBLE) AS x0, CAST(l_suppkey % 9 * 40 AS DOUBLE) AS y0, CAST(l_partkey % 200 + 30 + l_linenumber * 7 AS DOUBLE) AS x1, CAST(l_suppkey % 9 * 40 + 12 + l_linenumber AS DOUBLE) AS y1,
        CASE (l_partkey + l_suppkey) % 7 WHEN 0 THEN 'text' WHEN 1 THEN 'table' WHEN 2 THEN 'doc_title' WHEN 3 THEN 'number' WHEN 4 THEN 'chart' WHEN 5 THEN 'footer' ELSE 'paragraph_title' END AS block_label,
        CASE WHEN l_partkey % 5 = 0 THEN '' WHEN l_partkey % 5 = 1 THEN 'a < b & "c" > d' WHEN l_partkey % 5 = 2 THEN 'x\ue001y' ELSE concat('글 ', CAST(l_partkey AS VARCHAR(9))) END AS block_content
        FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, min(l_suppkey) AS l_suppkey FROM lineitem GROUP BY l_orderkey, l_linenumber) AS l""",
    "shape_boxes": """SELECT l_orderkey AS doc_id, 0 AS page_index, l_linenumber AS id,
        CAST(l_partkey % 200 - l_linenumber * 3 + 6 AS DOUBLE) AS x0, CAST(l_suppkey % 9 * 40 - 3 AS DOUBLE) AS y0, CAST(l_partkey % 200 + 75 + l_linenumber * 9 AS DOUBLE) AS x1, CAST(l_suppkey % 9 * 40 + 25 + l_linenumber * 2 AS DOUBLE) AS y1
        FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, min(l_suppkey) AS l_suppkey FROM lineitem GROUP BY l_orderkey, l_linenumber) AS l""",
    "rectangles": """SELECT CAST(p_size AS BIGINT) AS doc_id, CAST(p_partkey % 9 AS INT) AS page_index, p_partkey AS r, CAST(p_partkey % 3 * 400 + p_partkey % 7 * 20 AS DOUBLE) AS x0, CAST(p_partkey % 5 * 300 + p_partkey % 4 * 15 AS DOUBLE) AS y0,
        CAST(p_partkey % 3 * 400 + p_partkey % 7 * 20 + 70 + p_partkey % 4 * 50 AS DOUBLE) AS x1, CAST(p_partkey % 5 * 300 + p_partkey % 4 * 15 + 40 + p_partkey % 6 * 20 AS DOUBLE) AS y1 FROM part""",
    "spans": """SELECT l_orderkey AS doc_id, 0 AS page_index, l_linenumber % 2 AS block_idx, l_linenumber AS span_idx, CAST(8 + l_partkey % 9 AS DOUBLE) AS size, CASE WHEN l_suppkey % 3 = 0 THEN 16 ELSE 4 END AS flags,
        CASE l_partkey % 3 WHEN 0 THEN 'Batang' WHEN 1 THEN 'Dotum' ELSE 'Gulim' END AS font, concat('글자', CAST(l_linenumber AS VARCHAR(9))) AS text, CAST(l_partkey % 100 AS DOUBLE) AS x0, CAST(l_suppkey % 50 AS DOUBLE) AS y0, CAST(l_partkey % 100 + 36 AS DOUBLE) AS x1, CAST(l_suppkey % 50 + 10 AS DOUBLE) AS y1
        FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, min(l_suppkey) AS l_suppkey FROM lineitem GROUP BY l_orderkey, l_linenumber) AS l""",
}


def relation(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    for table in ("documents", "lineitem", "part"):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)
    return spark.sql(RELATIONS[name].replace("{places}", _PLACES["spark"]))


def sql(name: str) -> str:
    """The relation for the other engine."""
    return RELATIONS[name].replace("{places}", _PLACES["duckdb"])
