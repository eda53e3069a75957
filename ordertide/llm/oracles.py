"""DuckDB SQL of the queries that SQL can express."""

_DIGIT = """substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
 1 + ((('0x' || substr(sha1(payload), {at}, 10))::BIGINT >> {shift}) & 31)::INT, 1)"""
_BASE32 = " || ".join(
    _DIGIT.format(at=1 + 10 * k, shift=shift) for k in range(4) for shift in range(35, -1, -5))

WARC = f"""
WITH p AS (SELECT page_id, url, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, url, payload, octet_length(payload)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
 min(page_id) OVER (PARTITION BY payload) AS first_id FROM p),
r AS (SELECT *, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
 CASE WHEN page_id <> first_id THEN first_id END AS refers_to,
 CASE WHEN page_id = first_id THEN payload ELSE ''::BLOB END AS block, chr(13) || chr(10) AS nl FROM d)
SELECT page_id, payload_bytes, payload_digest, record_type, refers_to, sha256(encode(
 'WARC/1.1' || nl || 'WARC-Type: ' || record_type || nl || 'WARC-Record-ID: <urn:record:' || page_id || '>' || nl
 || coalesce('WARC-Target-URI: ' || regexp_replace(url, '[\r\n]', ' ', 'g') || nl, '')
 || 'WARC-Date: 1970-01-01T00:00:00Z' || nl || 'WARC-Payload-Digest: sha1:' || payload_digest || nl
 || coalesce('WARC-Refers-To: <urn:record:' || refers_to || '>' || nl, '')
 || 'Content-Length: ' || octet_length(block) || nl || nl) || block || encode(nl || nl)) AS record_sha256 FROM r
"""

HOST_RULES = r"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text,
 regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
m AS (SELECT doc_id, source, len(ws)::BIGINT AS n_words,
 coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0)::BIGINT AS word_chars,
 (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
 list_filter(string_split(text, chr(10)),
  lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines, ws FROM t),
windows AS (SELECT doc_id, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c
 FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM m)),
twice AS (SELECT doc_id, i FROM windows
 QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n
 FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
b AS (SELECT m.doc_id, source, n_words, word_chars, n_symbols,
 (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
 coalesce(n, 0)::BIGINT AS n_repeat_words FROM m LEFT JOIN covered USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b),
r AS (SELECT source, rule, count(*) AS n, sum(failed::INT) AS x FROM
 (SELECT source, unnest(['base', 'symbols', 'dup_lines', 'word_length']) AS rule,
  unnest([base_failed, 10 * n_symbols > n_words, n_dup_lines >= 5 AND 5 * n_dup_lines > n_lines,
   n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 12 * n_words)]) AS failed
  FROM f WHERE source IS NOT NULL) GROUP BY source, rule),
p AS (SELECT rule, avg(x / n) AS mean, var_pop(x / n) AS v, sum(n) / count(*) AS mean_docs
 FROM r GROUP BY rule),
w AS (SELECT rule, mean, CASE WHEN v > 0 AND v < mean * (1 - mean)
 THEN mean * (1 - mean) / v - 1 ELSE mean_docs END AS weight FROM p),
h AS (SELECT source, max((x + mean * weight) / (n + weight)) > 0.5 AS rejected
 FROM r JOIN w USING (rule) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
 NOT base_failed AND NOT coalesce(rejected, false) AS kept
FROM f LEFT JOIN h ON f.source = h.source
"""

JACCARD = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3
 THEN [array_to_string(ws, ' ')] ELSE [ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]
  FOR i IN range(1, len(ws) - 1)] END)) AS g FROM w),
classes AS (SELECT g, min(doc_id) AS c, len(g) AS n FROM s WHERE len(g) > 0 GROUP BY g),
e AS (SELECT c, n, unnest(g) AS x FROM classes),
links AS (SELECT a.c AS a, b.c AS b FROM e a JOIN e b ON a.x = b.x AND a.c < b.c
 AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n
 GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
both_ AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT c AS a, c AS b FROM classes UNION SELECT r.a, l.b FROM reach r JOIN both_ l ON r.b = l.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, len(s.g)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM s LEFT JOIN classes ON s.g = classes.g LEFT JOIN least ON c = a
"""

LINE_DEDUP = r"""
WITH l AS (SELECT doc_id, i, lines[i + 1] AS line, len(lines) AS n,
 len(regexp_extract_all(lines[i + 1], '[^\x20\x09-\x0D]+')) AS w
 FROM (SELECT doc_id, lines, unnest(range(0, len(lines))) AS i
  FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL))),
c AS (SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM l),
need AS (SELECT a.doc_id, a.i, min(b.i) AS j FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.i >= a.i
 AND b.upto - a.upto + a.w >= 50 GROUP BY a.doc_id, a.i),
runs AS (SELECT need.doc_id, need.i, need.j, list(line ORDER BY c.i) AS run
 FROM need JOIN c ON c.doc_id = need.doc_id AND c.i BETWEEN need.i AND need.j GROUP BY ALL),
later AS (SELECT doc_id, i, j FROM runs
 QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, j + 1)) AS i FROM later),
stretches AS (SELECT doc_id, min(i) AS a, max(i) AS b FROM (SELECT doc_id, i,
 i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM gone) GROUP BY doc_id, k),
cuts AS (SELECT doc_id, sum(b - a + 1)::BIGINT AS n_removed,
 string_agg(a || '-' || b, ',' ORDER BY a) AS removed FROM stretches GROUP BY doc_id),
kept AS (SELECT doc_id, count(*) AS n_lines, coalesce(string_agg(line, chr(10) ORDER BY l.i)
 FILTER (WHERE gone.i IS NULL), '') AS text FROM l LEFT JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
 coalesce(removed, '') AS removed, kept.text
FROM documents d LEFT JOIN kept USING (doc_id) LEFT JOIN cuts USING (doc_id)
"""

COLLOCATIONS = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
s AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
f AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f
 FROM s, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE i + k - 1 <= len(ws) GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, k AS size, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
x AS (SELECT lang, size, phrase, a, ws, unnest(range(1, size)) AS k FROM c),
y AS (SELECT x.lang, x.size, x.phrase, a, x.k, l.f AS l, r.f AS r, n,
 (1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS score FROM x
 JOIN f l ON l.lang = x.lang AND l.phrase = array_to_string(x.ws[1:x.k], ' ')
 JOIN f r ON r.lang = x.lang AND r.phrase = array_to_string(x.ws[x.k + 1:], ' ') JOIN n ON n.lang = x.lang),
b AS (SELECT * FROM y QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.lang = b.lang AND c.size > b.size
 AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' ') AND 100 * c.a >= 100 * b.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""

FILL_MIDDLE = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS d,
 regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u FROM documents),
h AS (SELECT doc_id, text, u, len(u)::BIGINT AS n, ('0x' || substr(d, 1, 8))::BIGINT AS h1,
 ('0x' || substr(d, 9, 8))::BIGINT AS h2, ('0x' || substr(d, 25, 8))::BIGINT AS h4 FROM t),
c AS (SELECT doc_id, text, n, u, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
 CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
 WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT doc_id, text, n, form, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m,
 array_to_string(u[b + 1:], '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
 CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
 sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
  ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256 FROM p
"""

ORACLES = {
    "op5_jaccard_components": JACCARD, "op6_line_dedup": LINE_DEDUP,
    "op7_warc_archive": WARC, "op8_host_rules": HOST_RULES,
    "op12_collocations": COLLOCATIONS, "op13_fill_in_middle": FILL_MIDDLE,
}
