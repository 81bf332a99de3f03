"""DuckDB SQL for the operators of this folder that plain SQL can express."""

from __future__ import annotations

WS = r"[\x20\x09-\x0D]"
LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: smallest node reachable over the pairs (x, y) of ``links``, for every id of ``nodes``
REACH = """
    both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
    reach AS (SELECT id AS a, id AS b FROM nodes UNION SELECT r.a, w.y FROM reach r JOIN both_ways w ON r.b = w.x),
    comp AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)"""

NEAR_DOCUMENTS = f"""WITH RECURSIVE
    t AS (SELECT doc_id, list_filter(regexp_split_to_array({LOWER}, '{WS}+'), lambda w: w <> '') AS w FROM documents),
    sets AS (SELECT doc_id, list_distinct(CASE
                 WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
                 WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM t),
    n AS (SELECT doc_id, len(s) AS n FROM sets),
    each AS (SELECT doc_id, unnest(s) AS g FROM sets),
    common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
               FROM each a JOIN each b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
    links AS (SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)),
    nodes AS (SELECT doc_id AS id FROM n),{REACH}
    SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, component_id, n.doc_id = component_id AS kept
    FROM n JOIN comp ON comp.a = n.doc_id"""

NEAR_VECTORS = f"""WITH RECURSIVE
    v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id < b.vec_id
              WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
    nodes AS (SELECT vec_id AS id FROM v),{REACH},
    degree AS (SELECT x, count(*) AS n FROM both_ways GROUP BY x)
    SELECT a AS vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, a = component_id AS kept
    FROM comp LEFT JOIN degree ON degree.x = comp.a"""


def _masked(line: str) -> str:
    field = r"[^\x09-\x0D\x20]*[0-9][^\x09-\x0D\x20]*"
    return rf"trim(regexp_replace(regexp_replace({line}, '{field}', '<*>', 'g'), '[\x09-\x0D\x20]+', ' ', 'g'))"


LINE_TEMPLATES = f"""WITH
    d AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
    u AS (SELECT row_number() OVER () AS doc, text FROM (SELECT DISTINCT text FROM documents WHERE text IS NOT NULL)),
    m AS (SELECT DISTINCT doc, {_masked('raw')} AS line FROM (SELECT doc, unnest(string_split(text, chr(10))) AS raw FROM u)),
    l AS (SELECT doc, line, len(string_split(line, ' ')) AS n, array_to_string(string_split(line, ' ')[1:3], ' ') AS lead FROM m WHERE line <> ''),
    longest AS (SELECT doc, n, lead, min({{'k': -length(line), 'line': line}}) AS top FROM l GROUP BY ALL),
    tops AS (SELECT doc, n, lead, row_number() OVER (PARTITION BY doc ORDER BY top, n, lead) AS r FROM longest QUALIFY r <= 6),
    mains AS (SELECT o.doc, o.n, o.lead, list_slice(list(t.lead ORDER BY t.r) FILTER (WHERE t.lead IS NOT NULL), 1, 5) AS mains
              FROM longest o LEFT JOIN tops t ON t.doc = o.doc AND (t.n <> o.n OR t.lead <> o.lead) GROUP BY ALL),
    seen AS (SELECT l.*, coalesce(mains, []) AS mains, coalesce(mains[1], '') AS family FROM l JOIN mains USING (doc, n, lead)),
    each AS (SELECT n, lead, line, count(DISTINCT family) AS f, count(DISTINCT doc) AS docs FROM seen GROUP BY ALL),
    leaves AS (SELECT n, lead FROM each GROUP BY ALL HAVING count(*) > 1 AND sum(f) >= 3),
    tokens AS (SELECT n, lead, line, f, generate_subscripts(string_split(line, ' '), 1) AS pos, unnest(string_split(line, ' ')) AS token
               FROM each JOIN leaves USING (n, lead)),
    fixed AS (SELECT n, lead, pos, token FROM tokens WHERE token <> '<*>' GROUP BY ALL HAVING sum(f) >= 3),
    form AS (SELECT n, lead, line, string_agg(coalesce(fixed.token, '<*>'), ' ' ORDER BY pos) AS form
             FROM tokens LEFT JOIN fixed USING (n, lead, pos, token) GROUP BY ALL HAVING count(fixed.token) >= 0.7::DOUBLE * count(*)),
    groups AS (SELECT 'line' AS kind, n, lead, line AS form, doc, family, mains FROM seen
               UNION ALL SELECT 'form', n, lead, form.form, doc, family, mains FROM seen JOIN form USING (n, lead, line)),
    spread AS (SELECT kind, n, lead, form, count(DISTINCT family) AS f, count(DISTINCT doc) AS docs FROM groups GROUP BY ALL),
    openings AS (SELECT DISTINCT kind, n, lead, form, doc, len(mains) AS m, unnest(mains) AS opening FROM groups),
    single AS (SELECT kind, n, lead, form, opening, min(doc) AS doc, min(m) AS m FROM openings GROUP BY ALL HAVING count(*) = 1),
    alone AS (SELECT kind, n, lead, form, doc FROM single GROUP BY ALL HAVING count(*) = min(m) AND min(m) >= 3),
    own AS (SELECT kind, n, lead, form, count(*) AS own FROM alone GROUP BY ALL),
    recurring AS (SELECT kind, n, lead, form FROM spread LEFT JOIN own USING (kind, n, lead, form)
                  WHERE (f >= 3 AND 2 * f >= docs) OR own >= 3 OR (own = 2 AND docs > 2)),
    dropped AS (SELECT form AS line FROM recurring WHERE kind = 'line'
                UNION SELECT line FROM form JOIN recurring USING (n, lead, form) WHERE kind = 'form'),
    split AS (SELECT rid, generate_subscripts(ls, 1) AS k, unnest(ls) AS raw FROM (SELECT rid, string_split(text, chr(10)) AS ls FROM d WHERE text IS NOT NULL)),
    judged AS (SELECT rid, k, raw, {_masked('raw')} <> '' AND {_masked('raw')} IN (SELECT line FROM dropped) AS gone FROM split),
    rebuilt AS (SELECT rid, coalesce(string_agg(raw, chr(10) ORDER BY k) FILTER (WHERE NOT gone), '') AS text,
                       count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped FROM judged GROUP BY rid)
    SELECT d.doc_id, r.text, coalesce(r.n_lines, 0) AS n_lines, coalesce(r.n_dropped, 0) AS n_dropped
    FROM d LEFT JOIN rebuilt r USING (rid)"""

#: unsigned crc32 of the ASCII text of an integer, bit by bit
CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), CAST(range(8) AS BIGINT[])),
        lambda a, i: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)))"""

PREFIX_TRIE = f"""WITH
    t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                 row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
          FROM conversations WHERE conv_id IS NOT NULL),
    c AS (SELECT conv_id AS c, conv_id - conv_id % 5 AS donor, {CRC32.format("conv_id")} % 9 AS h FROM t GROUP BY conv_id),
    r AS (SELECT c, 0 AS own, p, role, text FROM c JOIN t ON t.conv_id = donor AND p <= h
          UNION ALL SELECT c, 1, p, role, text FROM c JOIN t ON t.conv_id = c AND p > h),
    q AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, p) AS d, role, text FROM r),
    paths AS (SELECT c, d, sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (PARTITION BY c ORDER BY d)) AS path,
                     octet_length(encode(text)) AS bytes FROM q
              UNION ALL SELECT c, 0, '', 0 FROM c),
    lined AS (SELECT *, lag(path) OVER (PARTITION BY c ORDER BY d) AS parent, max(d) OVER (PARTITION BY c) AS len FROM paths),
    nodes AS (SELECT path, any_value(d) AS depth, any_value(parent) AS parent, min(c) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes, max(len) = any_value(d) AS leaf,
                     sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE d = len), '')) AS ends_sha256 FROM lined GROUP BY path),
    below AS (SELECT DISTINCT a.path AS top, b.path AS path FROM paths a JOIN paths b ON a.c = b.c AND b.d >= a.d),
    sums AS (SELECT top, count(*) FILTER (WHERE leaf) AS n_leaves, sum((n_convs - 1) * bytes) AS saved_tokens FROM below JOIN nodes USING (path) GROUP BY top),
    children AS (SELECT parent, count(*) AS n_children FROM nodes GROUP BY parent)
    SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
           CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
    FROM nodes n JOIN sums ON sums.top = n.path LEFT JOIN nodes u ON u.path = n.parent LEFT JOIN children ON children.parent = n.path"""

HARD_NEGATIVES = """WITH
    v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                 list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
          FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
          FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
    p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
    SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) QUALIFY row_number() OVER best <= 10"""

ORACLE: dict[str, str] = {
    "op2_minhash_near_dedup": NEAR_DOCUMENTS,
    "op5_kmeans_embedding_dedup": NEAR_VECTORS,
    "op9_line_template_dedup": LINE_TEMPLATES,
    "op11_one_bit_hard_negatives": HARD_NEGATIVES,
    "op12_conversation_prefix_trie": PREFIX_TRIE,
}
