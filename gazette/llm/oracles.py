"""DuckDB SQL for the operators that SQL can express, over the same whole tables."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWERED = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

OP1 = f"""WITH RECURSIVE w AS (SELECT doc_id, {LOWERED} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 4 THEN list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce((SELECT min(b) FROM reach WHERE a = d.doc_id), d.doc_id)) AS component_id FROM documents d LEFT JOIN n USING (doc_id)"""

OP3 = f"""WITH w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
v AS (SELECT doc_id, unnest(range(1, len(ws) - 33)) AS i, ws FROM w WHERE len(ws) >= 35),
h AS (SELECT doc_id, i, array_to_string(ws[i:i + 34], ' ') AS g FROM v),
r AS (SELECT doc_id, i FROM h QUALIFY count(*) OVER (PARTITION BY g) > 1),
gone AS (SELECT doc_id, list(DISTINCT j) AS js FROM (SELECT doc_id, unnest(range(i, i + 35)) AS j FROM r) GROUP BY 1),
k AS (SELECT w.doc_id, len(ws) AS n, coalesce(len(js), 0) AS removed, list_filter(list_transform(ws, lambda x, i: CASE WHEN js IS NULL OR NOT list_contains(js, i) THEN x END), lambda x: x IS NOT NULL) AS kept FROM w LEFT JOIN gone USING (doc_id))
SELECT doc_id, n AS n_words, removed AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k"""

OP9 = rf"""WITH d AS (SELECT doc_id, coalesce(source, chr(1)) AS source, coalesce(text, '') AS text, {WORDS} AS ws, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
v AS (SELECT doc_id, unnest(range(1, len(ws) - 6)) AS i, ws FROM d WHERE len(ws) >= 8),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS g FROM v) QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
again AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS j FROM r) GROUP BY 1),
l AS (SELECT doc_id, source, regexp_replace(lower(trim(x, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), '[\x20\x09-\x0D]+', ' ', 'g') AS line, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS w FROM (SELECT doc_id, source, unnest(lines) AS x FROM d)),
f AS (SELECT source, line FROM l JOIN (SELECT source, count(*) AS docs FROM d GROUP BY 1) h USING (source) GROUP BY source, line HAVING count(DISTINCT doc_id) > 20 AND count(DISTINCT doc_id) > 0.001 * any_value(docs)),
t AS (SELECT doc_id, sum(w) AS n FROM l SEMI JOIN f USING (source, line) GROUP BY 1),
m AS (SELECT d.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(again.n, 0) AS n_repeat_words, coalesce(t.n, 0)::BIGINT AS n_line_words
 FROM d LEFT JOIN again USING (doc_id) LEFT JOIN t USING (doc_id)), b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND n_words - n_line_words >= 20 AND n_words - n_line_words >= 0.5 * n_words AS kept FROM b"""

OP11 = r"""WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (SELECT lang, unnest(flatten(list_transform([1, 2, 3, 4], lambda m: list_transform(range(1, len(ws) - m + 2), lambda i: ws[i:i + m - 1])))) AS g FROM w WHERE len(ws) > 0),
f AS (SELECT lang, g, len(g) AS m, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY 1),
c AS (SELECT lang, g, f AS a, unnest(range(1, m)) AS k FROM f WHERE m > 1),
s AS (SELECT c.lang, c.g, c.a, c.k, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a // (x.f + y.f))::BIGINT AS score FROM c JOIN f x ON x.lang = c.lang AND x.g = c.g[1:c.k] JOIN f y ON y.lang = c.lang AND y.g = c.g[c.k + 1:]),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
i AS (SELECT lang, f, unnest(flatten(list_transform(range(2, m), lambda z: list_transform(range(1, m - z + 2), lambda q: g[q:q + z - 1])))) AS g FROM f WHERE m > 2),
o AS (SELECT lang, g, max(f) AS longer FROM i GROUP BY 1, 2),
r AS (SELECT b.lang, array_to_string(b.g, ' ') AS phrase, b.a, b.l, b.r, n.n, b.score FROM b JOIN n USING (lang) LEFT JOIN o ON o.lang = b.lang AND o.g = b.g WHERE o.longer IS NULL OR 100 * o.longer::HUGEINT < 80 * b.a::HUGEINT)
SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM r QUALIFY rank <= 2000"""

#: For pages with one article element; on others the tree decides. Character references: those that the given tables use.
OP12 = r"""WITH a AS (SELECT page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(?:</article>|$)', 1), '(?s)<[a-zA-Z/!?][^>]*$', '') AS body FROM pages),
b AS (SELECT page_id, url, list_transform(string_split_regex(regexp_replace(body, '<br>', ' ', 'g'), '</?(?:p|h1)>'), lambda x: trim(regexp_replace(replace(replace(regexp_replace(regexp_replace(x, '<[^>]*>', '', 'g'), '&quot;?', '"', 'g'), '&amp;', '&'), '&amp', '&'), '[\s\x{00A0}]+', ' ', 'g'))) AS bs FROM a),
t AS (SELECT page_id, url, array_to_string(list_filter(bs, lambda x: x <> ''), chr(10) || chr(10)) AS text FROM b)
SELECT page_id, url, text, length(text) AS n_chars FROM t"""

OP13 = r"""WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tk, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT *, len(tk) AS n, list_transform([1, 9, 17, 25], lambda i: ('0x' || substr(h, i, 8))::BIGINT) AS d FROM t),
c AS (SELECT *, least(d[1] % (n + 1), d[2] % (n + 1)) AS x, greatest(d[1] % (n + 1), d[2] % (n + 1)) AS y, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR d[3] % 100 >= 50 THEN 'plain' WHEN d[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
s AS (SELECT *, array_to_string(list_slice(tk, 1, x), '') AS p, array_to_string(list_slice(tk, x + 1, y), '') AS m, array_to_string(list_slice(tk, y + 1, n), '') AS z FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
 sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || z || '<M>' || m ELSE '<S>' || z || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256 FROM s"""

ORACLES = {"op1_ngram_join": OP1, "op3_substrings": OP3, "op9_rules": OP9, "op11_collocations": OP11, "op12_html_text": OP12, "op13_fim": OP13}
