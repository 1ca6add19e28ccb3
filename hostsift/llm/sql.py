"""DuckDB SQL of the operators' queries, where SQL can express them."""

from __future__ import annotations

from .license_scan import LEAST, TEMPLATES, template_bigrams
from .secret_scan import KINDS

EXACT = r"""
    WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
    SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
    FROM n WINDOW w AS (PARTITION BY norm)
"""

#: Adds "reach" (node, other) to a query with "links" (a, b) in both directions.
_REACH = """reach AS (SELECT a AS node, b AS other FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other)"""

VECTORS = f"""
    WITH RECURSIVE v AS (
        SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
    links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.95),
    {_REACH},
    n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a), c AS (SELECT node AS vec_id, min(other) AS low FROM reach GROUP BY node)
    SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(low, vec_id)) AS kept
    FROM embeddings LEFT JOIN n USING (vec_id) LEFT JOIN c USING (vec_id)
"""

JACCARD = rf"""
    WITH RECURSIVE w AS (
        SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
        FROM documents),
    s AS (
        SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
                            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE []::VARCHAR[] END AS s FROM w),
    g AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
    c AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS common FROM g a JOIN g b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM c WHERE 100 * common >= 90 * (na + nb - common)),
    {_REACH},
    m AS (SELECT node AS doc_id, min(other) AS low FROM reach GROUP BY node)
    SELECT doc_id, len(s) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id FROM s LEFT JOIN m USING (doc_id)
"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _secrets() -> str:
    finds = " UNION ALL ".join(
        f"""SELECT doc_id, source, {k} AS kind, string_split_regex(t, {_text(p)}) AS gaps, regexp_extract_all(t, {_text(p)}, 0) AS whole,
            regexp_extract_all(t, {_text(p)}, 1) AS value FROM d"""
        for k, (_, p) in enumerate(KINDS)
    )
    names = "[" + ", ".join(_text(k) for k, _ in KINDS) + "]"
    listed = f"string_agg({names}[kind + 1] || ':' || a || ':' || b, ',' ORDER BY a, kind)"
    return f"""
        WITH d AS (SELECT doc_id, coalesce(source, chr(1)) AS source, coalesce(text, '') AS t FROM documents),
        f AS (SELECT * FROM ({finds}) WHERE len(whole) > 0),
        p AS (SELECT doc_id, source, kind, unnest(range(1, len(whole) + 1)) AS i, gaps, whole, value FROM f),
        s AS (SELECT doc_id, source, kind, value[i] AS v, length(array_to_string(gaps[1:i], '')) + length(array_to_string(whole[1:i - 1], '')) AS a, length(whole[i]) AS n FROM p),
        k AS (SELECT doc_id, source, kind, v, a, a + n AS b FROM s WHERE kind <> 0 OR length(v) >= 6),
        o AS (SELECT v, count(DISTINCT source) < 3 AS live FROM k GROUP BY v),
        r AS (SELECT * FROM k JOIN o USING (v) WHERE kind < 3 OR live),
        x AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
                     {listed} FILTER (kind < 3) AS base, {listed} AS spans, count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_copied
              FROM r GROUP BY doc_id)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
               coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
        FROM documents LEFT JOIN x USING (doc_id)
    """


def _licenses() -> str:
    rows = ", ".join(f"({n}, {_text(name)}, {size}, {_text(gram)})" for n, name, size, gram in template_bigrams(TEMPLATES))
    return rf"""
        WITH t(template, license, size, g) AS (VALUES {rows}),
        l AS (SELECT doc_id, unnest(list_prepend(coalesce(text, ''), string_split(coalesce(text, ''), chr(10)))) AS line, generate_subscripts(list_prepend('', string_split(coalesce(text, ''), chr(10))), 1) AS segment FROM documents),
        w AS (SELECT doc_id, segment, list_filter(regexp_split_to_array(lower(line), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w FROM l),
        g AS (SELECT doc_id, segment, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS gs FROM w WHERE len(w) > 1),
        u AS (SELECT doc_id, segment, len(gs) AS n, unnest(gs) AS g FROM g),
        c AS (SELECT doc_id, segment, template, license, 2.0::DOUBLE * count(*) / (n + size) AS dice FROM u JOIN t USING (g) GROUP BY doc_id, segment, template, license, n, size),
        m AS (SELECT doc_id, arg_max(license, (dice, -template)) AS license, round(max(dice), 6) AS dice, count(DISTINCT segment) AS n_matches FROM c WHERE dice >= {LEAST} GROUP BY doc_id)
        SELECT doc_id, license, dice, coalesce(n_matches, 0) AS n_matches FROM documents LEFT JOIN m USING (doc_id)
    """


MIXING = r"""
    WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size, coalesce(doc_id::VARCHAR, 'text:' || md5(coalesce(text, ''))) AS key FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS weight FROM d GROUP BY source),
    o AS (SELECT *, 3 * source_size AS bound, row_number() OVER (ORDER BY 3 * source_size / weight, source) AS place FROM s),
    b AS (SELECT *, sum(source_size) OVER () - coalesce(sum(bound) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
                 sum(weight) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS shared FROM o),
    level AS (SELECT arg_min(rest, place) AS rest, arg_min(shared, place) AS shared, min(place) AS place FROM b WHERE rest * weight <= bound * shared),
    t AS (SELECT b.source, source_size, CASE WHEN b.place < level.place THEN bound::DOUBLE ELSE (level.rest * weight)::DOUBLE / level.shared::DOUBLE END AS target FROM b, level),
    r AS (SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
                 ('0x' || substr(md5('11:' || key), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
    c AS (SELECT *, floor(rate)::BIGINT + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS copies FROM r)
    SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken, copies::BIGINT AS copies FROM c
"""

COLLOCATIONS = r"""
    WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
    w AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM d)),
    c AS (SELECT lang, k, phrase, count(*) AS f FROM (
              SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM w, range(1, 6) x(k) WHERE len(w) >= k)
          GROUP BY ALL),
    n AS (SELECT lang, sum(f)::BIGINT AS n FROM c WHERE k = 1 GROUP BY lang),
    q AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM c WHERE k > 1 AND f >= 100),
    longer AS (SELECT lang, inside, max(a) AS most FROM (
                   SELECT lang, k, a, m, unnest(list_transform(range(1, k - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS inside FROM q, range(2, 5) x(m) WHERE m < k)
               GROUP BY ALL),
    cut AS (SELECT lang, phrase, a, i, array_to_string(w[:i], ' ') AS first, array_to_string(w[i + 1:], ' ') AS rest FROM q, range(1, 5) x(i) WHERE i < k),
    s AS (SELECT cut.lang, cut.phrase, a, n, i, l.f AS l, r.f AS r, (1000::HUGEINT * a * n // (l.f::HUGEINT * r.f))::BIGINT AS score
          FROM cut JOIN n USING (lang) JOIN c l ON l.lang = cut.lang AND l.phrase = first JOIN c r ON r.lang = cut.lang AND r.phrase = rest),
    m AS (SELECT lang, phrase, any_value(a) AS a, any_value(n) AS n, arg_min(l, (score, i)) AS l, arg_min(r, (score, i)) AS r, min(score) AS score FROM s GROUP BY lang, phrase),
    k AS (SELECT m.* FROM m LEFT JOIN longer ON longer.lang = m.lang AND inside = phrase WHERE most IS NULL OR 100 * most < 100 * a)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM k
    QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""

#: Unsigned CRC-32 of a whole number's digits, bit by bit.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, unused: xor(v // 2, 3988292384 * (v % 2)))), 4294967295::BIGINT)"""

TRIE = rf"""
    WITH y AS (SELECT conv_id AS c, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS key, octet_length(encode(coalesce(text, ''))) AS bytes FROM conversations WHERE conv_id IS NOT NULL),
    t AS (SELECT c, key, bytes, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, key) AS pos FROM y),
    z AS (SELECT c, count(*) AS n FROM t GROUP BY c),
    x AS (SELECT z.c, {_CRC.replace("c::VARCHAR", "z.c::VARCHAR")} % 9 AS h, b.c AS base, coalesce(b.n, 0) AS base_n, z.n FROM z LEFT JOIN z b ON b.c = z.c - z.c % 5),
    r AS (SELECT x.c, t.pos AS d, key, bytes FROM x JOIN t ON t.c = base AND t.pos <= h UNION ALL SELECT c, least(h, base_n) + pos - h, key, bytes FROM x JOIN t USING (c) WHERE pos > h),
    len AS (SELECT x.c, coalesce(max(d), 0) AS len FROM x LEFT JOIN r USING (c) GROUP BY x.c),
    p AS (SELECT c, d, bytes, string_agg(key, '') OVER (PARTITION BY c ORDER BY d) AS path FROM r UNION ALL SELECT c, 0, 0, '' FROM x),
    g AS (SELECT path, d, min(p.c) AS conv, count(*) AS n_convs, any_value(bytes) AS bytes, string_agg(p.c::VARCHAR, ',' ORDER BY p.c) FILTER (len = d) AS ended FROM p JOIN len USING (c) GROUP BY path, d),
    k AS (SELECT path[:-65] AS path, d - 1 AS d, count(*) AS n_children FROM g WHERE d > 0 GROUP BY ALL),
    u AS (SELECT g.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * bytes AS saved FROM g LEFT JOIN k USING (path, d)),
    a AS (SELECT p.path, p.d, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM u JOIN p ON p.c = conv AND p.d <= u.d GROUP BY ALL)
    SELECT u.conv AS conv_id, u.d::BIGINT AS depth, o.conv AS parent_conv_id, u.n_convs, u.n_children, n_leaves, saved_tokens, sha256(coalesce(u.ended, '')) AS ends_sha256
    FROM u JOIN a USING (path, d) LEFT JOIN u o ON u.d > 0 AND o.path = u.path[:-65] AND o.d = u.d - 1
"""

SQL: dict[str, str] = {
    "op1_exact_dedup": EXACT,
    "op3_embedding_dedup": VECTORS,
    "op7_license_scan": _licenses(),
    "op8_secret_scan": _secrets(),
    "op9_jaccard_join": JACCARD,
    "op11_mixing": MIXING,
    "op12_collocations": COLLOCATIONS,
    "op13_conversation_trie": TRIE,
}
