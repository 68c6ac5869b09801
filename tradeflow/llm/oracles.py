"""DuckDB SQL for the queries that SQL can express."""

ORACLES: dict[str, str] = {}

ORACLES["op5_top_k"] = """
WITH v AS (
    SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)
), s AS (
    SELECT q.row, q.vec_id AS query_id, c.vec_id,
           list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.row <> c.row
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 10
"""

_BLANK = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLES["op6_site_lines"] = f"""
WITH d AS (
    SELECT doc_id, coalesce('h' || source, 'n') AS host, text, string_split(text, chr(10)) AS ls
    FROM documents
), l AS (
    SELECT host, doc_id, unnest(list_distinct(list_transform(ls, lambda x: trim(x, {_BLANK})))) AS line FROM d
), often AS (
    SELECT l.host, line FROM l JOIN (SELECT host, count(*) AS pages FROM d GROUP BY host) USING (host)
    WHERE line <> '' GROUP BY l.host, line, pages HAVING count(*) >= 2 AND count(*) > 0.1 * pages
), flagged AS (
    SELECT host, list(line) AS bad FROM often GROUP BY host
), k AS (
    SELECT doc_id, text, ls, coalesce(list_filter(ls, lambda x: NOT list_contains(coalesce(bad, []), trim(x, {_BLANK}))), []) AS kept
    FROM d LEFT JOIN flagged USING (host)
), r AS (
    SELECT doc_id, text, ls,
           CASE WHEN len(list_filter(kept, lambda x: trim(x, {_BLANK}) <> '')) > 0 THEN kept ELSE ls END AS kept
    FROM k
)
SELECT doc_id, coalesce(len(ls), 0)::BIGINT AS n_lines, coalesce(len(ls) - len(kept), 0)::BIGINT AS n_dropped,
       CASE WHEN text IS NOT NULL THEN md5(array_to_string(kept, chr(10))) END AS kept_md5
FROM r
"""

_HOST = r"""coalesce(translate(regexp_extract({u}, '(?s)^.*?://([^/?#]*)', 1),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '')"""
_PATH = r"coalesce(regexp_extract({u}, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '')"
_QUERY = r"""regexp_replace(regexp_replace('&' || regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1),
    '&(?:utm_[a-z]+|ref|gclid|fbclid)=[^&]*', '', 'g'), '^&+', '')"""

ORACLES["op10_urls"] = rf"""
WITH p AS (
    SELECT page_id, html, {_HOST.format(u="url")} AS host, {_PATH.format(u="url")} AS path, {_QUERY} AS q
    FROM pages
), c AS (
    SELECT *, CASE WHEN regexp_replace(host, '^(www|m)\.', '') <> '' THEN
        regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '/+$', '')
        || CASE WHEN q = '' THEN '' ELSE '?' || q END END AS canonical
    FROM p
), bad AS (
    SELECT DISTINCT canonical FROM c
    WHERE regexp_matches(html, '(?s)<title>[^<]*[#*$%]{{3}}') AND canonical IS NOT NULL
), rules AS (
    SELECT * FROM (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
        ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')) AS t(h, start, decision)
), best AS (
    SELECT page_id, arg_max(h || start, length(h || start)) AS rule, arg_max(decision, length(h || start)) AS decision
    FROM c JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, start)
    GROUP BY page_id
)
SELECT c.page_id, host, path, rule,
       coalesce(decision, CASE WHEN bad.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
       rule IS NULL AND bad.canonical IS NOT NULL AS listed
FROM c LEFT JOIN best USING (page_id) LEFT JOIN bad ON c.canonical = bad.canonical
"""

ORACLES["op3_jaccard"] = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g
    FROM d WHERE len(w) > 0
), n AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id
), l AS (
    SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)
), r AS (
    SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.y FROM r JOIN l ON r.b = l.x
), m AS (
    SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id FROM m LEFT JOIN n USING (doc_id)
"""

# Texts as hexadecimal digits, two for each byte; substr counts from 1.
ORACLES["op8_suffixes"] = """
WITH t AS (
    SELECT row_number() OVER () AS i, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), b AS (
    SELECT *, length(h) // 2 AS n FROM t
), s AS (
    SELECT i, p, md5_number(substr(h, 2 * p + 1, 800)) AS k FROM b, unnest(range(0, n - 399)) AS u(p) WHERE n >= 400
), again AS (
    SELECT k FROM s GROUP BY k HAVING count(*) > 1
), hits AS (
    SELECT i, p, p - lag(p) OVER (PARTITION BY i ORDER BY p) AS gap FROM s JOIN again USING (k)
), numbered AS (
    SELECT i, p, count(*) FILTER (WHERE gap IS NULL OR gap > 400) OVER (PARTITION BY i ORDER BY p) AS run FROM hits
), spans AS (
    SELECT i, min(p) AS a, max(p) + 400 AS z FROM numbered GROUP BY i, run
), kept AS (
    SELECT i, substr(h, 2 * coalesce(lag(z) OVER w, 0) + 1, 2 * (a - coalesce(lag(z) OVER w, 0))) AS part, a,
           z - a AS gone, substr(h, 2 * z + 1) AS tail
    FROM spans JOIN b USING (i) WINDOW w AS (PARTITION BY i ORDER BY a)
), cut AS (
    SELECT i, sum(gone)::BIGINT AS gone, count(*) AS runs,
           coalesce(string_agg(part, '' ORDER BY a), '') || arg_max(tail, a) AS rest
    FROM kept GROUP BY i
)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(runs, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(rest, h))) AS kept_sha256
FROM b LEFT JOIN cut USING (i)
"""

_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

ORACLES["op12_lexical"] = f"""
WITH t AS (
    SELECT row, doc_id, unnest({_TERMS}) AS term FROM (SELECT *, row_number() OVER () AS row FROM documents)
), p AS (
    SELECT row, doc_id, term, count(*)::BIGINT AS tf FROM t GROUP BY row, doc_id, term
), l AS (
    SELECT row, sum(tf)::BIGINT AS n FROM p GROUP BY row
), g AS (
    SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM l
), f AS (
    SELECT term, count(*)::BIGINT AS df FROM p GROUP BY term
), w AS (
    SELECT item_id, term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS w
    FROM (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark) JOIN f USING (term), g
), s AS (
    SELECT item_id, row, doc_id,
           sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))))::BIGINT AS score
    FROM w JOIN p USING (term) JOIN l USING (row), g GROUP BY item_id, row, doc_id
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0
) WHERE rank <= 50
"""

# The table of the 32-bit checksum follows from its polynomial.
ORACLES["op11_variants"] = r"""
WITH RECURSIVE tab AS (
    SELECT list(c ORDER BY b) AS t FROM (
        SELECT b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x:
            CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
        FROM (SELECT unnest(range(256))::BIGINT AS b))
), r AS (
    SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS h FROM (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents
    ) WHERE length(run) >= 5 GROUP BY doc_id, run
), c AS (
    SELECT run, n, xor(list_reduce([4294967295::BIGINT] || list_transform(range(0, length(h) // 2),
        lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT),
        lambda s, b: xor(s // 256, t[(xor(s, b) & 255) + 1])), 4294967295) AS crc
    FROM r, tab
), v AS (
    SELECT word, sum(n)::BIGINT AS n FROM (
        SELECT CASE WHEN crc % 97 = 0 THEN left(run, (crc % length(run))::INT) || substr(run, (crc % length(run))::INT + 2)
               ELSE run END AS word, n FROM c
    ) WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), k AS (
    SELECT word, left(word, i::INT) || '*' || substr(word, i::INT + 2) AS masked,
           left(word, i::INT) || substr(word, i::INT + 2) AS shorter
    FROM v, unnest(range(length(word))) AS u(i)
), near AS (
    SELECT a.word AS x, b.word AS y FROM k a JOIN k b ON a.masked = b.masked AND a.word <> b.word
    UNION SELECT k.word, v.word FROM k JOIN v ON k.shorter = v.word
    UNION SELECT v.word, k.word FROM k JOIN v ON k.shorter = v.word
), best AS (
    SELECT x, y, n AS form_n, count(*) OVER (PARTITION BY x) AS n_near,
           row_number() OVER (PARTITION BY x ORDER BY n DESC, encode(y)) AS place
    FROM near JOIN v ON v.word = y
), f AS (
    SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near,
           CASE WHEN form_n >= 2 * n THEN y END AS form, CASE WHEN form_n >= 2 * n THEN form_n END AS form_n
    FROM v LEFT JOIN best ON x = word AND place = 1
), way AS (
    SELECT word, word AS here FROM f UNION SELECT way.word, f.form FROM way JOIN f ON f.word = way.here WHERE f.form IS NOT NULL
), ends AS (
    SELECT way.word, here AS root FROM way JOIN f ON f.word = way.here WHERE f.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM f JOIN ends USING (word)
"""
