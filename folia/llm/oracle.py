"""DuckDB SQL of the queries that SQL can express on whole tables."""

from __future__ import annotations

_SPACE = r"[\x20\x09-\x0D]"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LINES = "string_split(coalesce(text, ''), chr(10))"

LINES = f"""WITH l AS (SELECT doc_id, line, pos, {_LOWER.format(f"regexp_replace(line, '^{_SPACE}+|{_SPACE}+$', '', 'g')")} AS key FROM (SELECT doc_id, unnest({_LINES}) AS line, generate_subscripts({_LINES}, 1) AS pos FROM documents) AS t),
    hot AS (SELECT key, max(doc_id) AS keeper FROM l WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (hot.key IS NOT NULL AND doc_id <> keeper) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (hot.key IS NULL OR doc_id = keeper), '')) AS kept_sha256
    FROM l LEFT JOIN hot ON l.key = hot.key GROUP BY doc_id"""

NEAR = f"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '{_SPACE}+'), lambda x: x <> '') AS words FROM documents),
    sets AS MATERIALIZED (SELECT DISTINCT doc_id, s FROM (SELECT doc_id, unnest(CASE WHEN len(words) >= 5 THEN list_transform(range(1, len(words) - 3), lambda i: list_aggregate(words[i:i + 4], 'string_agg', ' ')) WHEN len(words) > 0 THEN [list_aggregate(words, 'string_agg', ' ')] ELSE [] END) AS s FROM w) AS t),
    sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
    common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sets AS a JOIN sets AS b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    links AS MATERIALIZED (SELECT a, b FROM common JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
    reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach AS r JOIN links AS l ON r.b = l.a)
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id, d.doc_id <= coalesce(m, d.doc_id) AS kept
    FROM documents AS d LEFT JOIN sizes AS z ON z.doc_id = d.doc_id LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) AS r ON r.a = d.doc_id"""

FIM = """WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id) AS h FROM documents),
    e AS (SELECT doc_id, t, length(t) AS n, [('0x' || h[8 * k + 1:8 * k + 8])::UBIGINT FOR k IN range(4)] AS r FROM d),
    f AS (SELECT doc_id, t, n, least(r[1] % (n + 1), r[2] % (n + 1))::BIGINT AS a, greatest(r[1] % (n + 1), r[2] % (n + 1))::BIGINT AS b,
        CASE WHEN t = '' OR regexp_matches(t, '<[PSM]>') OR r[3] % 100 >= 90 THEN 'plain' WHEN r[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM e)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars, sha256(t) AS restored_sha256,
        sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || t[:a] || '<S>' || t[b + 1:] || '<M>' || t[a + 1:b] ELSE '<S>' || t[b + 1:] || '<P>' || t[:a] || '<M>' || t[a + 1:b] END) AS output_sha256 FROM f"""

ORACLE_SQL = {"op13_fim": FIM, "op5_lines": LINES, "op7_neardup": NEAR}
