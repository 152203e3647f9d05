"""SQL twins (DuckDB) of the operators that SQL can express, over the same tables."""

from __future__ import annotations

from wayloom.llm import codes, decontaminate, secrets, url_filter

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def secret_scan() -> str:
    """Matches and what lies between them give the positions; parts meet by the gap between them."""
    found = " UNION ALL ".join(
        f"""SELECT row_no, {rank} AS rank, unnest(range(len(whole))) AS i, unnest(list_resize(gap, len(whole))) AS gap,
        unnest(whole) AS whole, unnest(judged) AS judged FROM (SELECT row_no,
        list_transform(string_split_regex(text, {_text(k.pattern)}), lambda x: length(x)) AS gap,
        list_transform(regexp_extract_all(text, {_text(k.pattern)}), lambda x: length(x)) AS whole,
        list_transform(regexp_extract_all(text, {_text(k.pattern)}, {k.group}), lambda x: length(x)) AS judged FROM d)"""
        for rank, k in enumerate(secrets.KINDS)
    )
    kinds = ", ".join(f"({i}, '{k.name}', '{k.role}', {k.strong}, {k.least})" for i, k in enumerate(secrets.KINDS))
    return f"""
    WITH d AS (SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text FROM documents),
    kinds(rank, kind, role, strong, least) AS (VALUES {kinds}),
    found AS ({found}),
    placed AS (SELECT row_no, rank, whole, judged, sum(gap + whole) OVER (PARTITION BY row_no, rank ORDER BY i) AS stop FROM found),
    parts AS (SELECT row_no, rank, kind, role, strong, stop - whole AS start, stop
      FROM placed JOIN kinds USING (rank) WHERE judged >= least),
    kept AS (SELECT * FROM parts p WHERE strong OR EXISTS (SELECT 1 FROM parts q
      WHERE q.row_no = p.row_no AND (q.role = 'secret') <> (p.role = 'secret')
      AND q.start <= p.stop + {secrets.SCOPE} AND q.stop >= p.start - {secrets.SCOPE})),
    listed AS (SELECT row_no, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
      count(*) FILTER (kind = 'hex') AS n_hex,
      string_agg(concat(kind, ':', start, ':', stop), ',' ORDER BY start, rank) FILTER (strong) AS base,
      string_agg(concat(kind, ':', start, ':', stop), ',' ORDER BY start, rank) AS spans FROM kept GROUP BY row_no)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
      sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN listed USING (row_no)"""


def jaccard_join() -> str:
    return f"""
    WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex({_LOWER.format("coalesce(text, '')")},
      '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
    s AS (SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3),
      lambda i: array_to_string(w[i:i + 4], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS g FROM d),
    e AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s),
    pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared, any_value(a.n) AS na, any_value(b.n) AS nb
      FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
    links AS (SELECT a, b FROM pairs WHERE 100 * shared >= 80 * (na + nb - shared)),
    near AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reached(a, b) AS (SELECT a, b FROM near UNION SELECT r.a, n.b FROM reached r JOIN near n ON r.b = n.a)
    SELECT s.doc_id, len(g) AS n_shingles, least(s.doc_id, coalesce(min(r.b), s.doc_id)) AS component_id
    FROM s LEFT JOIN reached r ON r.a = s.doc_id GROUP BY s.doc_id, g"""


def line_dedup() -> str:
    return f"""
    WITH d AS (SELECT row_number() OVER () AS row_no, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    l AS (SELECT row_no, unnest(range(len(lines))) AS i, unnest(lines) AS line FROM d),
    k AS (SELECT *, {_LOWER.format(f"trim(line, {_BLANKS})")} AS key FROM l),
    f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT row_no) >= 10),
    kept AS (SELECT row_no, string_agg(line, chr(10) ORDER BY i) AS text, count(*) AS n FROM k
      WHERE key NOT IN (SELECT key FROM f) GROUP BY row_no)
    SELECT doc_id, len(lines) AS n_lines, len(lines) - coalesce(n, 0) AS n_dropped, sha256(coalesce(text, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (row_no)"""


def exact_top_k() -> str:
    return """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
      WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
    FROM s QUALIFY rank <= 20"""


def decontamination() -> str:
    name, number, unit, plain = (f"chr({i})" for i in (1, 2, 3, 4))
    units = "|".join(decontaminate.UNITS)
    marked = f"regexp_replace(coalesce(text, ''), '[\\x01-\\x04]', ' ', 'g')"
    marked = f"regexp_replace({marked}, '([\\p{{L}}\\p{{N}},;] )(\\p{{Lu}})', '\\1' || {name} || '\\2', 'g')"
    marked = f"regexp_replace(lower({marked}), '([0-9]+(?:[.,][0-9]+)*)', ' ' || {number} || '\\1 ', 'g')"
    # RE2 looks at no next character: a sign that ends every word stands for it.
    marked = f"regexp_replace({marked}, '([^\\p{{L}}\\p{{N}}]|$)', '\\1' || chr(5), 'g')"
    marked = f"regexp_replace({marked}, '(\\x02\\x05?[0-9.,\\x05]+[ \\x05]+)({units})([^\\p{{L}}\\p{{N}}]|$)', '\\1' || {unit} || '\\2\\3', 'g')"
    marked = f"regexp_replace({marked}, '\\x05', '', 'g')"
    marked = f"regexp_replace({marked}, '[.,]+([^0-9]|$)', ' \\1', 'g')"
    tokens = f"list_filter(string_split_regex({marked}, '[^\\p{{L}}\\p{{N}}.,\\x01-\\x03]+'), lambda x: x <> '')"
    size, least = decontaminate.WINDOW, decontaminate.LEAST_LITERAL
    template = f"array_to_string(list_transform(t[i:i + {size - 1}], lambda x: CASE WHEN x < {plain} THEN x[1] ELSE x END), ' ')"
    return f"""
    WITH docs AS (SELECT DISTINCT doc_id, text, {tokens} AS t FROM documents),
    items AS (SELECT DISTINCT item_id, {tokens} AS t FROM benchmark WHERE item_id IS NOT NULL),
    dw AS (SELECT doc_id, text, t, unnest(range(1, CASE WHEN len(t) = 0 THEN 1 ELSE greatest(len(t) - {size - 2}, 2) END)) AS i FROM docs),
    iw AS (SELECT item_id, t, greatest(len(t) - {size - 1}, 0) + (len(t) < {size})::INT AS item_windows,
      unnest(range(1, CASE WHEN len(t) = 0 THEN 1 ELSE greatest(len(t) - {size - 2}, 2) END)) AS i FROM items),
    dh AS (SELECT doc_id, text, i, t[i:i + {size - 1}] AS raw, {template} AS w FROM dw),
    ih AS (SELECT item_id, item_windows, i, t[i:i + {size - 1}] AS raw, {template} AS w FROM iw),
    met AS (SELECT doc_id, text, item_id, item_windows, ih.i AS place, dh.i - ih.i AS shift,
      list_filter(list_zip(ih.raw, dh.raw), lambda p: p[1] < {plain}) AS slots
      FROM dh JOIN ih USING (w) WHERE len(list_filter(ih.raw, lambda x: x >= {plain})) >= least({least}, len(ih.raw))),
    aligned AS (SELECT doc_id, text, item_id, item_windows, shift, list(DISTINCT place) AS found,
      list_distinct(flatten(list(slots))) AS slots FROM met GROUP BY ALL),
    good AS (SELECT * FROM aligned WHERE len(slots) = len(list_distinct(list_transform(slots, lambda p: p[1])))),
    per AS (SELECT doc_id, text, item_id, item_windows, len(list_distinct(flatten(list(found)))) AS windows,
      max(len(list_filter(slots, lambda p: p[1] <> p[2])) > 0) AS reparameterised FROM good GROUP BY ALL)
    SELECT doc_id, item_id, windows, item_windows, windows / item_windows AS coverage, reparameterised
    FROM per WHERE windows / item_windows >= {decontaminate.LEAST_COVERAGE}"""


def url_filters() -> str:
    rules = ", ".join(
        f"('{r.action}', '{r.text.partition('/')[0]}', '/{r.text.partition('/')[2]}', '{r.text}')" for r in url_filter.PREFIX_RULES
    )
    loose = " OR ".join(f"concat(host, path) LIKE {_text(r.text.replace('*', '%'))}" for r in url_filter.PATTERN_RULES)
    return f"""
    WITH u AS (SELECT row_number() OVER () AS row_no, page_id, coalesce(url, '') AS url FROM pages),
    r AS (SELECT row_no, page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM u),
    h AS (SELECT row_no, page_id, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
      regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM r),
    rules(action, rule_host, rule_path, rule) AS (VALUES {rules}),
    fits AS (SELECT row_no, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action FROM h JOIN rules
      ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY row_no)
    SELECT page_id, host, path, rule, coalesce(action, CASE WHEN {loose} THEN 'block' ELSE 'allow' END) AS verdict
    FROM h LEFT JOIN fits USING (row_no)"""


def prefix_trie() -> str:
    """Every prefix spelled out as a list of its turns; a crc32 bit by bit."""
    crc = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda a, b: list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda x: x::BIGINT)),
        lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""
    return f"""
    WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
    c AS (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role, sha256(concat(length(role), ':', role, text))) AS own
      FROM t GROUP BY conv_id),
    h AS (SELECT conv_id, own, {crc} % 9 AS h FROM c),
    r AS MATERIALIZED (SELECT h.conv_id, list_concat(coalesce(b.own[1:h.h], []), h.own[h.h + 1:]) AS turns
      FROM h LEFT JOIN c b ON b.conv_id = h.conv_id - h.conv_id % 5),
    p AS (SELECT conv_id, len(turns) AS n, unnest(range(len(turns) + 1)) AS depth, turns FROM r),
    m AS MATERIALIZED (SELECT conv_id, n, depth, turns[1:depth] AS prefix FROM p),
    nodes AS MATERIALIZED (SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
      coalesce(sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth)), sha256('')) AS ends_sha256,
      CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * strlen(prefix[depth].text) END AS saved FROM m GROUP BY prefix, depth),
    kids AS (SELECT prefix[1:depth - 1] AS prefix, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2),
    k AS MATERIALIZED (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (prefix, depth)),
    below AS (SELECT prefix[1:up] AS prefix, up AS depth, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
      FROM (SELECT *, unnest(range(depth + 1)) AS up FROM k) GROUP BY 1, 2)
    SELECT k.conv_id, k.depth, a.conv_id AS parent_conv_id, k.n_convs, k.n_children, n_leaves, saved_tokens, k.ends_sha256
    FROM k JOIN below USING (prefix, depth) LEFT JOIN nodes a ON a.depth = k.depth - 1 AND a.prefix = k.prefix[1:k.depth - 1]"""


def vector_codes() -> str:
    """Plain rounds: every part against every entry, then the floor of the mean."""
    n, k = codes.PARTS, codes.ENTRIES
    steps = []
    for turn in range(codes.ROUNDS + 1):
        steps.append(f"""a{turn} AS MATERIALIZED (SELECT row_no, part, x, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM
      (SELECT row_no, part, x, entry, list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
       FROM parts JOIN b{turn} USING (part)) GROUP BY ALL)""")
        if turn < codes.ROUNDS:
            steps.append(f"""s{turn} AS (SELECT part, entry, i, floor(sum(v)::DOUBLE / count(*))::BIGINT AS v FROM
      (SELECT part, entry, unnest(range(len(x))) AS i, unnest(x) AS v FROM a{turn}) GROUP BY ALL),
    b{turn + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.c, b.c) AS c FROM b{turn} b LEFT JOIN
      (SELECT part, entry, list(v ORDER BY i) AS c FROM s{turn} GROUP BY ALL) m USING (part, entry))""")
    last = codes.ROUNDS
    return f"""
    WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS row_no, vec_id, label,
      list_transform(embedding, lambda x: floor({codes.SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
      WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS MATERIALIZED (SELECT row_no, part, v[part * len(v) // {n} + 1:(part + 1) * len(v) // {n}] AS x
      FROM kept, (SELECT unnest(range({n})) AS part)),
    b0 AS MATERIALIZED (SELECT part, row_no AS entry, x AS c FROM parts WHERE row_no < {k}),
    {", ".join(steps)},
    per AS (SELECT row_no, string_agg(lower(lpad(to_hex(entry), 2, '0')), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
      FROM a{last} GROUP BY row_no),
    book AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS sha FROM b{last})
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, sha AS codebooks_sha256
    FROM kept JOIN per USING (row_no) CROSS JOIN book"""
