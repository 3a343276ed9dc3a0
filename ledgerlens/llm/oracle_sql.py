"""SQL for the queries that SQL can express, for an engine with lists and recursion."""

from __future__ import annotations

from .parameters import URL_RULES

_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


# (kind, pattern, least and most length of group 2, what it is, what it needs)
_SECRET_KINDS = [
    ("assign", r"((?i:password|passwd|secret|token|api_?key))[\"\']?\x20*[:=]\x20*[\"\']?([A-Za-z0-9+/_.=-]+)", 12, None, "secret", None),
    ("access", r"(AKIA)([A-Z0-9]+)", 14, None, "identifier", None),
    ("hex", r"()([0-9a-f]+)", 16, None, "secret", None),
    ("short_access", r"(AKIA)([A-Z0-9]+)", 8, 13, "identifier", "secret"),
    ("account", r"((?i:client_id|username|user|login|account))[\"\']?\x20*[:=]\x20*[\"\']?([A-Za-z0-9_.@-]+)", 3, None, "identifier", "secret"),
    ("mixed_token", r"()([A-Za-z0-9+/]{24,})", 24, None, "secret", "identifier"),
    ("endpoint", r"(https?://|s3://)([A-Za-z0-9._:/-]+)", 4, None, "endpoint", "secret"),
]


def _secret_scan() -> str:
    quoted = lambda s: "NULL" if s is None else "'" + s.replace("'", "''") + "'"
    scans = []
    for rank, (kind, pattern, least, most, part, needs) in enumerate(_SECRET_KINDS):
        plain = ""
        if kind == "mixed_token":
            plain = " AND regexp_matches(v, '[A-Z]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[0-9]')"
        fits = f"length(v) >= {least}" + (f" AND length(v) <= {most}" if most else "") + plain
        scans.append(f"""
            SELECT doc_id, '{kind}' AS kind, {rank} AS rank, s AS low, s + length(m) AS high, {quoted(part)} AS part, {quoted(needs)} AS needs FROM (
              SELECT doc_id, ms[i] AS m, vs[i] AS v,
                     list_sum([length(x) for x in gs[1:i]]) + coalesce(list_sum([length(x) for x in ms[1:i - 1]]), 0) AS s
              FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM (
                SELECT doc_id, string_split_regex(t, {quoted(pattern)}) AS gs, regexp_extract_all(t, {quoted(pattern)}, 0) AS ms,
                       regexp_extract_all(t, {quoted(pattern)}, 2) AS vs
                FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)))) WHERE {fits}""")
    line = "kind || ':' || low || ':' || high"
    order = "ORDER BY low, rank, high"
    return f"""
        WITH found AS ({" UNION ALL ".join(scans)}),
        parts AS (
          SELECT * FROM found t WHERE kind <> 'mixed_token' OR NOT EXISTS (
            SELECT 1 FROM found o WHERE o.doc_id = t.doc_id AND o.kind IN ('endpoint', 'account') AND o.low <= t.low AND t.high <= o.high)),
        kept AS (
          SELECT DISTINCT doc_id, kind, rank, low, high FROM parts p
          WHERE needs IS NULL OR EXISTS (
            SELECT 1 FROM parts c WHERE c.doc_id = p.doc_id AND c.part = p.needs AND abs(c.low - p.low) <= 200 AND (c.high <= p.low OR c.low >= p.high))),
        joined AS (
          SELECT doc_id,
                 count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
                 count(*) FILTER (kind = 'hex') AS n_hex,
                 string_agg({line}, ',' {order}) FILTER (rank < 3) AS base, string_agg({line}, ',' {order}) AS spans
          FROM kept GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM documents d LEFT JOIN joined j ON j.doc_id = d.doc_id"""


NGRAM_JACCARD_JOIN = f"""
    WITH RECURSIVE words AS (
      SELECT doc_id, regexp_extract_all({_FOLD}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
    sets AS (
      SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                                          ELSE [array_to_string(ws[i:i + 4], ' ') for i in range(1, len(ws) - 3)] END) AS g
      FROM words),
    sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
    common AS (
      SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c
      FROM sets a JOIN sets b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
    links AS (
      SELECT u, v FROM common JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v
      WHERE 100 * c >= 80 * (x.n + y.n - c)),
    edges AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
    reach AS (
      SELECT doc_id, doc_id AS root FROM documents
      UNION
      SELECT e.v, r.root FROM reach r JOIN edges e ON e.u = r.doc_id WHERE r.root < e.v)
    SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
    FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
    JOIN (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id) r ON r.doc_id = d.doc_id"""


def _url_filter() -> str:
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
    return f"""
        WITH rules(verdict, h, p) AS (VALUES {rules}),
        parts AS (
          SELECT page_id,
                 coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                 coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
          FROM pages),
        met AS (
          SELECT page_id, max_by(h || p, length(h || p)) AS rule, max_by(verdict, length(h || p)) AS verdict
          FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
        SELECT x.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts x LEFT JOIN met m ON m.page_id = x.page_id"""


EXACT_TOP_K = """
    WITH v AS (
      SELECT vec_id, [floor(256 * x::DOUBLE) for x in embedding] AS q FROM embeddings
      WHERE len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
    scored AS (
      SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""

DECONTAMINATION = f"""
    WITH words AS (SELECT doc_id, regexp_extract_all({_FOLD}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
    items AS (SELECT item_id, regexp_extract_all({_FOLD}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
    windows AS (
      SELECT DISTINCT item_id, array_to_string(ws[i:i + 9], ' ') AS g, least(10, len(ws)) AS k
      FROM (SELECT *, unnest(range(1, greatest(1, len(ws) - 9) + 1)) AS i FROM items WHERE len(ws) > 0)),
    grams AS (
      SELECT doc_id, i, k, array_to_string(ws[i:i + k - 1], ' ') AS g
      FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM words, (SELECT DISTINCT k FROM windows))),
    found AS (SELECT doc_id, i, grams.k, item_id FROM grams JOIN windows USING (g, k)),
    hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY doc_id),
    own AS (
      SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
      FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
    SELECT w.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM words w LEFT JOIN hits h ON h.doc_id = w.doc_id LEFT JOIN own o ON o.doc_id = w.doc_id"""

# the streams of a source in shuffled order; a target by the level to which all sources are filled
SOURCE_MIX = """
    WITH sized AS (
      SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
             md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS k
      FROM documents),
    sources AS (
      SELECT source, words, 2 * words AS most, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS w
      FROM (SELECT source, sum(size)::HUGEINT AS words FROM sized GROUP BY source)),
    judged AS (
      SELECT s.*, 2 * (SELECT sum(least(t.most * s.w, s.most * t.w)) FROM sources t)
                  <= 3 * (SELECT sum(words) FROM sources) * s.w AS full
      FROM sources s),
    level AS (
      SELECT 3 * sum(words) - 2 * coalesce(sum(most) FILTER ("full"), 0) AS rest, 2 * sum(w) FILTER (NOT "full") AS share FROM judged),
    targets AS (
      SELECT source, words::BIGINT AS words, CASE WHEN "full" THEN most::DOUBLE ELSE (w * rest)::DOUBLE / share::DOUBLE END AS target
      FROM judged, level),
    streams AS (
      SELECT doc_id, size, s.source, words, target, floor(target)::BIGINT AS due,
             (sum(size) OVER (PARTITION BY s.source ORDER BY k, size ROWS UNBOUNDED PRECEDING))::BIGINT - size AS low
      FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, words AS source_size, target,
           CASE WHEN words = 0 THEN 0 ELSE (due // words) * size + greatest(0, least(low + size, due % words) - low) END::BIGINT AS taken
    FROM streams"""

_CRC_TABLE = """
    crc(bits) AS (
      SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
               CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END, i::BIGINT)))"""


def _crc32(text: str) -> str:
    """crc32 of a text of code points below U+0800; ``bits`` is in scope."""
    octets = (
        f"flatten(list_transform(regexp_extract_all({text}, '(?s).'), lambda c:"
        " CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [(192 + (unicode(c) >> 6))::BIGINT, (128 + (unicode(c) & 63))::BIGINT] END))"
    )
    return f"xor(4294967295::BIGINT, list_reduce({octets}, lambda c, o: xor(c >> 8, bits[(xor(c, o) & 255) + 1]), 4294967295::BIGINT))"


SPELLING_VARIANTS = f"""
    WITH RECURSIVE {_CRC_TABLE},
    runs AS (
      SELECT doc_id, r, count(*) AS m FROM (
        SELECT doc_id, unnest(regexp_extract_all({_FOLD}, '[a-z\u00C0-\u00FF]+')) AS r FROM documents)
      WHERE length(r) >= 5 GROUP BY ALL),
    hashed AS (SELECT *, {_crc32("doc_id::VARCHAR || ':' || r")} AS h FROM runs, crc),
    thinned AS (
      SELECT CASE WHEN h % 97 = 0 THEN r[:(h % length(r))] || r[(h % length(r)) + 2:] ELSE r END AS word, m FROM hashed),
    words AS (SELECT word, sum(m)::BIGINT AS n FROM thinned WHERE length(word) >= 5 GROUP BY word HAVING sum(m) >= 3),
    forms AS (SELECT word, n, i, word[:i] || word[i + 2:] AS f FROM (SELECT *, unnest(range(length(word))) AS i FROM words)),
    shorter AS (SELECT DISTINCT f.word AS u, w.word AS v, w.n FROM forms f JOIN words w ON w.word = f.f),
    longer AS (SELECT DISTINCT w.word AS u, f.word AS v, f.n FROM forms f JOIN words w ON w.word = f.f),
    near AS (
      SELECT a.word AS u, b.word AS v, b.n FROM forms a JOIN forms b ON a.f = b.f AND a.i = b.i AND a.word <> b.word
      UNION ALL SELECT * FROM shorter UNION ALL SELECT * FROM longer),
    best AS (SELECT u, count(*) AS n_near, max(n) AS most, first(v ORDER BY n DESC, v) AS v FROM near GROUP BY u),
    judged AS (
      SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 2 * n THEN v END AS form, CASE WHEN most >= 2 * n THEN most END AS form_n
      FROM words LEFT JOIN best ON u = word),
    steps AS (
      SELECT word, word AS at, form AS next FROM judged
      UNION ALL SELECT s.word, j.word, j.form FROM steps s JOIN judged j ON j.word = s.next)
    SELECT j.word, j.form, s.at AS root, j.n, j.n_near, j.form_n FROM judged j JOIN steps s ON s.word = j.word AND s.next IS NULL"""

CONVERSATION_TRIE = f"""
    WITH {_CRC_TABLE},
    lists AS (
      SELECT conv_id, list({{'r': coalesce(role, ''), 'x': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS ts
      FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
    headed AS (SELECT conv_id, ts, {_crc32("conv_id::VARCHAR")} % 9 AS h FROM lists, crc),
    rebuilt AS (
      SELECT a.conv_id, list_concat(CASE WHEN b.ts IS NULL THEN [] ELSE b.ts[1:a.h] END, a.ts[a.h + 1:]) AS ts
      FROM headed a LEFT JOIN lists b ON b.conv_id = a.conv_id - a.conv_id % 5),
    paths AS (SELECT conv_id AS c, ts, unnest(range(len(ts) + 1)) AS depth FROM rebuilt),
    nodes AS (
      SELECT ts[1:depth] AS k, depth, min(c) AS conv_id, count(*) AS n_convs,
             sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(ts) = depth), '')) AS ends_sha256
      FROM paths GROUP BY ALL),
    own AS (SELECT *, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * strlen(k[depth].x) END AS saved FROM nodes),
    children AS (SELECT k[1:depth - 1] AS k, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
    up AS (SELECT k[1:d] AS k, saved, leaf FROM (
      SELECT o.k, saved, (c.k IS NULL)::INTEGER AS leaf, unnest(range(depth + 1)) AS d FROM own o LEFT JOIN children c ON c.k = o.k)),
    totals AS (SELECT k, sum(saved) AS saved, sum(leaf) AS leaves FROM up GROUP BY k)
    SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children,
           t.leaves::BIGINT AS n_leaves, t.saved::BIGINT AS saved_tokens, n.ends_sha256
    FROM nodes n JOIN totals t ON t.k = n.k LEFT JOIN children c ON c.k = n.k
    LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.k = n.k[1:n.depth - 1]"""

ORACLE_SQL: dict[str, str] = {
    "op1_secret_scan": _secret_scan(),
    "op5_ngram_jaccard_join": NGRAM_JACCARD_JOIN,
    "op7_url_filter": _url_filter(),
    "op9_exact_top_k": EXACT_TOP_K,
    "op10_decontamination": DECONTAMINATION,
    "op11_source_mix": SOURCE_MIX,
    "op12_spelling_variants": SPELLING_VARIANTS,
    "op13_conversation_trie": CONVERSATION_TRIE,
}
