"""DuckDB's SQL for the queries that SQL can express, over whole tables and texts."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WHITE = r"'[\x20\x09-\x0D]+'"
_OTHER = r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def _words(name: str, key: str, table: str, text: str, cut: str) -> str:
    """(key, p, w): the words of each row, from 1."""
    return f"""{name} AS (SELECT {key}, generate_subscripts(ws, 1) AS p, unnest(ws) AS w
 FROM (SELECT {key}, list_filter(string_split_regex(coalesce({text}, ''), {cut}), lambda x: x <> '') AS ws FROM {table}))"""


_LOW = f"translate(text, '{UPPER}', '{LOWER}')"
_REACH = "reach(a, b) AS (SELECT id, id FROM nodes UNION SELECT r.a, e.v FROM reach r JOIN edges e ON r.b = e.u)"

NEAR = f"""WITH RECURSIVE {_words("w", "doc_id", "documents", _LOW, _WHITE)},
g AS (SELECT doc_id, p, string_agg(w, ' ') OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS s, count(*) OVER (PARTITION BY doc_id) AS n FROM w),
sets AS (SELECT DISTINCT doc_id, s FROM g WHERE p = 1 OR p <= n - 3),
size AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY 1),
both_ AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
edges AS (SELECT u, v FROM both_ JOIN size x ON x.doc_id = u JOIN size y ON y.doc_id = v WHERE 100 * k >= 80 * (x.n + y.n - k)),
nodes AS (SELECT doc_id AS id FROM documents), {_REACH},
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM comp LEFT JOIN size USING (doc_id)"""

SUBSTRING = f"""WITH {_words("w", "doc_id", "documents", "text", _WHITE)},
g AS (SELECT doc_id, p, w, string_agg(w, ' ') OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS s, count(*) OVER (PARTITION BY doc_id) AS n FROM w),
f AS (SELECT doc_id, p, w, CASE WHEN p <= n - 12 AND min(CASE WHEN p <= n - 12 THEN doc_id END) OVER (PARTITION BY s) < doc_id THEN p END AS hit FROM g),
d AS (SELECT doc_id, p, w, coalesce(max(hit) OVER (PARTITION BY doc_id ORDER BY p) >= p - 12, false) AS dead FROM f),
r AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE dead) AS k, string_agg(w, ' ' ORDER BY p) FILTER (WHERE NOT dead) AS t FROM d GROUP BY 1)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_words, coalesce(k, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM documents LEFT JOIN r USING (doc_id)"""

CONTAMINATION = f"""WITH {_words("w", "doc_id", "documents", _LOW, _OTHER)}, {_words("b", "item_id", "benchmark", _LOW, _OTHER)},
dn AS (SELECT doc_id, count(*) AS n FROM w GROUP BY 1), bn AS (SELECT item_id, count(*) AS n FROM b GROUP BY 1),
dg AS (SELECT doc_id, p, string_agg(w, ' ') OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS s FROM w),
bg AS (SELECT item_id, p, string_agg(w, ' ') OVER (PARTITION BY item_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS s FROM b),
long AS (SELECT DISTINCT item_id, s FROM bg JOIN bn USING (item_id) WHERE p <= n - 12),
hits AS (SELECT doc_id, p, 13 AS n, item_id FROM dg JOIN dn USING (doc_id) JOIN long USING (s) WHERE p <= dn.n - 12
 UNION ALL SELECT doc_id, w.p - b.p + 1, bn.n, item_id FROM b JOIN bn USING (item_id) JOIN w ON w.w = b.w WHERE bn.n < 13 GROUP BY ALL HAVING count(*) = bn.n),
ends AS (SELECT doc_id, p, max(n) AS n FROM hits GROUP BY 1, 2),
cov AS (SELECT w.doc_id, w.p, max(ends.p + ends.n) OVER (PARTITION BY w.doc_id ORDER BY w.p) > w.p AS hit FROM w LEFT JOIN ends ON w.doc_id = ends.doc_id AND w.p = ends.p),
h AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE hit) AS n_hit FROM cov GROUP BY 1),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS names FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM hits) GROUP BY 1)
SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
 coalesce(n_hit > 0 AND 20 * n_hit >= n_words, false) AS contaminated FROM documents LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)"""

EMBEDDING = f"""WITH RECURSIVE v AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
edges AS (SELECT a.id AS u, b.id AS v FROM v a JOIN v b ON a.label = b.label AND a.id <> b.id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
nodes AS (SELECT vec_id AS id FROM embeddings), {_REACH},
comp AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY 1), n AS (SELECT u AS vec_id, count(*) AS n FROM edges GROUP BY 1)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM comp LEFT JOIN n USING (vec_id)"""

WARC = """WITH h AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS s FROM pages),
b AS (SELECT *, list_reduce(list_transform(range(8), lambda g: list_reduce(list_transform([15, 10, 5, 0], lambda k:
 substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(s, 1 + g * 5, 5))::INT >> k) & 31) + 1, 1)), lambda x, y: x || y)), lambda x, y: x || y) AS payload_digest, min(page_id) OVER (PARTITION BY s) AS f FROM h),
u AS (SELECT page_id, CASE WHEN contains(url, '://') AND NOT ends_with(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE coalesce(url, '') END AS rest FROM pages),
v AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS host, regexp_replace(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '(?s)#.*$', '') AS path FROM u),
k AS (SELECT page_id, CASE WHEN rest <> '' THEN array_to_string(list_reverse(string_split(regexp_replace(lower(host), '^.*@', ''), '.')), ',') || ')' || CASE WHEN path = '' THEN '/' ELSE path END ELSE '' END AS key FROM v),
o AS (SELECT page_id, row_number() OVER (ORDER BY key, page_id NULLS LAST) - 1 AS history FROM k)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest, CASE WHEN f = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN f <> page_id THEN f END AS refers_to, history FROM b JOIN o USING (page_id)"""

SUFFIX = """WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n FROM documents),
p AS (SELECT doc_id, n, p, substr(x, 2 * p + 1, 2) AS c, CASE WHEN p <= n - 100 THEN md5(substr(x, 2 * p + 1, 200)) END AS s FROM t, LATERAL (SELECT unnest(range(n)) AS p)),
f AS (SELECT doc_id, p, c, CASE WHEN s IS NOT NULL AND row_number() OVER (PARTITION BY s ORDER BY doc_id, p) > 1 THEN p END AS hit FROM p),
d AS (SELECT doc_id, p, c, coalesce(max(hit) OVER (PARTITION BY doc_id ORDER BY p) >= p - 99, false) AS dead FROM f),
e AS (SELECT *, dead AND NOT coalesce(lag(dead) OVER (PARTITION BY doc_id ORDER BY p), false) AS edge FROM d),
r AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE dead) AS k, count(*) FILTER (WHERE edge) AS spans, string_agg(c, '' ORDER BY p) FILTER (WHERE NOT dead) AS kept FROM e GROUP BY 1)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_bytes, coalesce(k, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256 FROM documents LEFT JOIN r USING (doc_id)"""

MIDDLE = r"""WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS us FROM t),
k AS (SELECT *, len(us)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(us) + 1) AS x, ('0x' || substr(h, 9, 8))::BIGINT % (len(us) + 1) AS y, ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM u),
f AS (SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
 array_to_string(us[1:least(x, y)], '') AS p, array_to_string(us[least(x, y) + 1:greatest(x, y)], '') AS m, array_to_string(us[greatest(x, y) + 1:], '') AS s FROM k)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
 sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256 FROM f"""

PHRASES = rf"""WITH t AS (SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang, string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]') AS ps FROM documents),
p AS (SELECT id, lang, generate_subscripts(ps, 1) AS piece, unnest(ps) AS x FROM t),
v AS (SELECT id, lang, piece, list_filter(string_split_regex(x, '[\x20\x09]+'), lambda y: y <> '') AS ws FROM p),
w AS (SELECT id, lang, piece, generate_subscripts(ws, 1) AS i, unnest(ws) AS w1 FROM v),
q AS (SELECT lang, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3, lead(w1, 3) OVER o AS w4 FROM w WINDOW o AS (PARTITION BY id, piece ORDER BY i)),
f AS (SELECT lang, ws, count(*)::HUGEINT AS a FROM (SELECT lang, [w1] AS ws FROM q UNION ALL SELECT lang, [w1, w2] FROM q WHERE w2 IS NOT NULL
 UNION ALL SELECT lang, [w1, w2, w3] FROM q WHERE w3 IS NOT NULL UNION ALL SELECT lang, [w1, w2, w3, w4] FROM q WHERE w4 IS NOT NULL) GROUP BY 1, 2 HAVING count(*) >= 30),
c AS (SELECT lang, ws, a, unnest(range(1, len(ws))) AS k FROM f WHERE len(ws) > 1),
s AS (SELECT c.lang, c.ws, c.a, k, x.a AS l, y.a AS r, (2000000 * c.a) // (x.a + y.a) AS score FROM c JOIN f x ON x.lang = c.lang AND x.ws = c.ws[1:k] JOIN f y ON y.lang = c.lang AND y.ws = c.ws[k + 1:]),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) AS best FROM s),
i AS (SELECT lang, a, ws, unnest(range(1, len(ws))) AS st FROM f WHERE len(ws) > 2),
j AS (SELECT lang, a, ws, st, unnest(range(2, len(ws))) AS n FROM i),
m AS (SELECT lang, ws[st:st + n - 1] AS ws, max(a) AS a FROM (SELECT * FROM j WHERE st + n - 1 <= len(ws)) GROUP BY ALL),
d AS (SELECT b.* FROM b LEFT JOIN m ON m.lang = b.lang AND m.ws = b.ws WHERE best = 1 AND (m.a IS NULL OR 100 * m.a < 80 * b.a)),
n AS (SELECT lang, count(*) AS n FROM w GROUP BY 1),
z AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(ws, ' '))) AS rank, array_to_string(ws, ' ') AS phrase, a, l, r, score FROM d)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score FROM z JOIN n USING (lang) WHERE rank <= 2000"""

MIXING = r"""WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, ('0x' || substr(md5('42:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS tie FROM documents),
s AS (SELECT source, sum(size)::HUGEINT AS b, ([3, 1, 2])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::HUGEINT AS w, ('0x' || substr(md5('42:' || coalesce(source, '')), 1, 8))::BIGINT % 1073741824 AS u FROM d GROUP BY source),
o AS (SELECT *, 150 * sum(b) OVER () - 200 * coalesce(sum(b) OVER (ORDER BY b / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest, sum(w) OVER (ORDER BY b / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS over_, row_number() OVER (ORDER BY b / w, source NULLS LAST) AS i FROM s),
l AS (SELECT rest, over_ FROM o WHERE 200 * b * over_ > w * rest ORDER BY i LIMIT 1),
t AS (SELECT source, b, u, CASE WHEN l.rest IS NULL OR 200 * b * over_l <= w * l.rest THEN (2 * b)::DOUBLE ELSE (w * l.rest)::DOUBLE / (100 * over_l)::DOUBLE END AS target,
 CASE WHEN l.rest IS NULL OR 200 * b * over_l <= w * l.rest THEN 2::HUGEINT ELSE w * l.rest END AS p, CASE WHEN b = 0 THEN NULL WHEN l.rest IS NULL OR 200 * b * over_l <= w * l.rest THEN 1::HUGEINT ELSE 100 * over_l * b END AS q
 FROM s LEFT JOIN (SELECT rest::HUGEINT AS rest, over_::HUGEINT AS over_l FROM l) l ON true),
r AS (SELECT doc_id, size, b, target, u, p, q, (row_number() OVER (PARTITION BY d.source ORDER BY size, tie, doc_id))::HUGEINT AS k FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, b::BIGINT AS source_size, target, (coalesce((k * p * 1073741824 + q * u) // (q * 1073741824) - ((k - 1) * p * 1073741824 + q * u) // (q * 1073741824), 0) * size)::BIGINT AS taken FROM r"""

SQL = {
    "op1_near_dedup": NEAR,
    "op2_substring_dedup": SUBSTRING,
    "op6_decontaminate": CONTAMINATION,
    "op7_embedding_dedup": EMBEDDING,
    "op9_warc": WARC,
    "op10_suffix_dedup": SUFFIX,
    "op11_fill_in_middle": MIDDLE,
    "op12_collocations": PHRASES,
    "op13_mixing": MIXING,
}
