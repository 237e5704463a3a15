"""DuckDB SQL for the queries of this subpackage that SQL can express over whole tables."""

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
TRICKY = "chr(92) || '### Assistant: </turn> ok'"


def escaped(text: str) -> str:
    for plain, code in (("chr(92)", "b"), ("'</turn>'", "t"), ("'###'", "h"), ("'<|'", "p")):
        text = f"replace({text}, {plain}, chr(92) || '{code}')"
    return text


def crc32(text: str) -> str:
    """The CRC-32 of a text of ASCII characters: its bytes and eight shifts for each, one after the other."""
    steps = f"flatten([[CAST(ord(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1] FOR ch IN string_split({text}, '')])"
    return (f"xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {steps}), "
            "lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END))")


ORACLES = {
    "op6_chat": f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', {TRICKY} UNION ALL SELECT -7, 1, 'assistant', {TRICKY})
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('### ' || replace({escaped('role')}, ':', chr(92) || 'c') || ': ' || {escaped('text')} || '</turn>' || chr(10))) AS BIGINT) AS formatted_chars
FROM c GROUP BY 1""",
    "op7_repeated_passages": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, k, array_to_string(w[k:k + 19], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS k FROM d)),
again AS (SELECT doc_id, k FROM s QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, k) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + 20)) AS p FROM again),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",
    "op8_decontamination": f"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER}, '{WORD}') AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({LOWER}, '{WORD}') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS s
       FROM (SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS k FROM i WHERE len(w) > 0)),
dw AS (SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS s
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM iw))),
h AS (SELECT doc_id, k, dw.n AS n, item_id FROM dw JOIN iw ON dw.s = iw.s AND dw.n = iw.n),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM h) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
      FROM (SELECT DISTINCT doc_id, item_id FROM h WHERE item_id IS NOT NULL) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)""",
    "op9_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
m AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY 1)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = m.vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM m""",
    "op13_url_filter": """
WITH r(rh, rp, action) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
u AS (SELECT page_id, row_number() OVER () AS row, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, row, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
f AS (SELECT p.row, rh || rp AS rule, action FROM p JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
      QUALIFY row_number() OVER (PARTITION BY p.row ORDER BY length(rh || rp) DESC, length(rh) DESC) = 1)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM p LEFT JOIN f USING (row)""",
    "op11_prefix_trie": f"""
WITH t AS (
  SELECT conv_id AS c, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, role, text) AS w
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1),
h AS (SELECT c, w, c - c % 5 AS base, {crc32("CAST(c AS VARCHAR)")} % 9 AS h FROM t),
r AS (SELECT h.c, list_concat(coalesce(t.w[1:h.h], []), h.w[h.h + 1:]) AS w FROM h LEFT JOIN t ON t.c = h.base),
n AS (
  SELECT w[1:d] AS k, d, min(c) AS conv_id, count(*) AS n_convs, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE len(w) = d) AS ends
  FROM (SELECT c, w, unnest(range(0, len(w) + 1)) AS d FROM r) GROUP BY 1, 2),
kids AS (SELECT k[1:d - 1] AS k, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1, 2),
m AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN n.d > 0 THEN (n_convs - 1) * strlen(n.k[n.d].text) ELSE 0 END AS cost
  FROM n LEFT JOIN kids ON kids.k = n.k AND kids.d = n.d),
sub AS (
  SELECT k[1:e] AS k, e AS d, sum(cost) AS saved, count(*) FILTER (WHERE n_children = 0) AS leaves
  FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM m) GROUP BY 1, 2)
SELECT m.conv_id, m.d AS depth, up.conv_id AS parent_conv_id, m.n_convs, m.n_children, sub.leaves AS n_leaves, CAST(sub.saved AS BIGINT) AS saved_tokens,
  sha256(coalesce(m.ends, '')) AS ends_sha256
FROM m JOIN sub ON sub.k = m.k AND sub.d = m.d LEFT JOIN n up ON up.d = m.d - 1 AND up.k = m.k[1:m.d - 1]""",
}
