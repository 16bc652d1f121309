"""SQL counterparts of the corpus queries that SQL can express, for DuckDB over the same tables.

Licenses, secrets, toxicity, packing and the pipeline have none: they depend on hashing schemes,
trained models, a tokenizer or a sequential plan, and are tested against plain versions instead.
"""

from __future__ import annotations

from punctua.llm import centroids, line_dedup, mixing, personal_data

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_QUALITY = " ".join(f"WHEN {label} THEN {weight}" for label, weight in mixing.QUALITY_WEIGHT.items())
MIXING = f"""
WITH d AS (
    SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size FROM documents
), q AS (
    SELECT doc_id, CASE max(quality) {_QUALITY} ELSE 1.0 END AS quality_weight FROM labels GROUP BY doc_id
), s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1 AS weight
    FROM d GROUP BY source
), t AS (
    SELECT *, {mixing.LIMIT} * source_size AS most, CAST({mixing.LIMIT} * source_size AS DOUBLE) / weight AS ratio FROM s
), o AS (
    SELECT *, sum(most) OVER (ORDER BY ratio, source NULLS LAST ROWS UNBOUNDED PRECEDING) - most AS settled,
        sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
    FROM t
), level AS (
    SELECT min_by(share, ratio) AS level
    FROM (SELECT ratio, CAST((SELECT sum(size) FROM d) - settled AS DOUBLE) / CAST(free AS DOUBLE) AS share FROM o)
    WHERE ratio > share
), target AS (
    SELECT source, source_size, CASE WHEN most > level * weight THEN level * weight ELSE CAST(most AS DOUBLE) END AS target
    FROM t, level
), k AS (
    SELECT d.*, g.source_size, g.target,
        CASE WHEN g.source_size > 0 THEN floor(g.target / g.source_size) ELSE 1 END AS epochs,
        -ln((CAST('0x' || substr(md5(CAST(d.doc_id AS VARCHAR)), 1, 12) AS BIGINT) + 0.5) / CAST(281474976710656 AS DOUBLE))
            / CAST(coalesce(q.quality_weight, 1.0) AS DOUBLE) AS key
    FROM d JOIN target g ON d.source IS NOT DISTINCT FROM g.source LEFT JOIN q ON d.doc_id = q.doc_id
), r AS (
    SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM k
)
SELECT doc_id, size, source_size, target,
    CAST(size * (epochs + CASE WHEN size > 0 AND 2 * upto - size <= 2 * (target - epochs * source_size) THEN 1 ELSE 0 END)
        AS BIGINT) AS taken
FROM r
"""


def _lines() -> str:
    text = "coalesce(html, '')"
    for pattern, by in ((line_dedup.HIDDEN, "' '"), (line_dedup.BREAKS, "chr(10)"), (line_dedup.TAGS, "''"), (line_dedup.SPACES, "' '")):
        text = f"regexp_replace({text}, '{pattern}', {by}, 'g')"
    return f"list_filter(list_transform(string_split({text}, chr(10)), lambda x: trim(x)), lambda x: x <> '')"


LINE_DEDUP = f"""
WITH p AS (
    SELECT page_id, coalesce(regexp_extract(lower(url), '{line_dedup.HOST}', 1), '') AS host, {_lines()} AS lines FROM pages
), l AS (
    SELECT host, unnest(list_distinct(lines)) AS line FROM p
), c AS (
    SELECT host, line, count(*) AS pages FROM l GROUP BY host, line
), t AS (
    SELECT host, count(*) AS total FROM p GROUP BY host
), dropped AS (
    SELECT host, list(line) AS dropped FROM c JOIN t USING (host)
    WHERE pages >= {line_dedup.LEAST_PAGES} AND pages > CAST({line_dedup.RATIO} AS DOUBLE) * total GROUP BY host
), k AS (
    SELECT p.*, CASE WHEN dropped IS NULL THEN lines ELSE list_filter(lines, lambda x: NOT list_contains(dropped, x)) END AS kept
    FROM p LEFT JOIN dropped USING (host)
)
SELECT page_id, host, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(kept) AS BIGINT) AS n_dropped,
    array_to_string(kept, chr(10)) AS kept_text
FROM k
"""

EXACT_DEDUP = r"""
WITH n AS (
    SELECT doc_id, length(coalesce(text, '')) AS size, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS plain
    FROM documents
), g AS (
    SELECT doc_id, plain, first_value(doc_id) OVER (PARTITION BY plain ORDER BY size DESC, doc_id) AS keep_id,
        count(*) OVER (PARTITION BY plain) AS group_size
    FROM n
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(plain) AS text_sha256 FROM g
"""

_COMPONENTS = """
reach AS (
    SELECT node AS a, node AS b FROM nodes
    UNION
    SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a
), least AS (
    SELECT a AS node, min(b) AS component_id FROM reach GROUP BY a
)
"""

NEAR_DEDUP = f"""
WITH RECURSIVE w AS MATERIALIZED (
    SELECT doc_id, {_WORDS.replace("text", f"translate(text, '{_CAPITALS}', '{_SMALL}')")} AS words FROM documents
), z AS (
    SELECT DISTINCT doc_id, hash(array_to_string(words[i:i + 4], ' ')) AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM w WHERE len(words) > 0)
), nodes AS (
    SELECT w.doc_id AS node, count(shingle) AS n_shingles FROM w LEFT JOIN z ON w.doc_id = z.doc_id GROUP BY w.doc_id
), s AS MATERIALIZED (
    SELECT doc_id, shingle FROM z
), common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
    GROUP BY x.doc_id, y.doc_id
), edges AS MATERIALIZED (
    SELECT a, b FROM common JOIN nodes m ON a = m.node JOIN nodes n ON b = n.node
    WHERE 100 * common >= 85 * (m.n_shingles + n.n_shingles - common)
), {_COMPONENTS}
SELECT n.node AS doc_id, n_shingles, component_id, n.node = component_id AS kept FROM nodes n JOIN least USING (node)
"""

SUBSTRING_DEDUP = f"""
WITH w AS (
    SELECT doc_id, {_WORDS} AS words FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(words[i:i + 34], ' ') AS passage
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i FROM w WHERE len(words) >= 35)
), again AS (
    SELECT passage FROM windows GROUP BY passage HAVING count(*) > 1
), covered AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS place FROM windows JOIN again USING (passage)
), placed AS (
    SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM w
), kept AS (
    SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.place) AS kept, count(*) AS n_kept
    FROM placed p LEFT JOIN covered c ON p.doc_id = c.doc_id AND p.place = c.place WHERE c.place IS NULL GROUP BY p.doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""

EMBEDDING_DEDUP = f"""
WITH RECURSIVE v AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), nodes AS (
    SELECT vec_id AS node FROM v
), edges AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id
    WHERE list_dot_product(x.v, y.v) >= 0.9 * sqrt(list_dot_product(x.v, x.v)) * sqrt(list_dot_product(y.v, y.v))
), {_COMPONENTS}
SELECT n.node AS vec_id, (SELECT count(*) FROM edges e WHERE e.a = n.node) AS n_links, component_id, n.node = component_id AS kept
FROM nodes n JOIN least USING (node)
"""

_MOST = centroids.LARGEST


def _round(number: int) -> str:
    """The vectors of every centroid in a round, and the centroids after it."""
    return f"""
a{number} AS MATERIALIZED (
    SELECT row, min({{'distance': distance, 'c': c}}) AS best FROM (
        SELECT x.row, c, list_sum(list_transform(list_zip(x.v, g.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS distance
        FROM x, c{number} g) GROUP BY row
), m{number} AS (
    SELECT c, list((total - (total % n + n) % n) // n ORDER BY i) AS v FROM (
        SELECT best.c AS c, i, sum(value) AS total, count(*) AS n
        FROM (SELECT best, unnest(v) AS value, unnest(range(64)) AS i FROM x JOIN a{number} USING (row)) GROUP BY best.c, i) GROUP BY c
), c{number + 1} AS MATERIALIZED (
    SELECT c, CAST(coalesce(m.v, g.v) AS BIGINT[]) AS v FROM c{number} g LEFT JOIN m{number} m USING (c)
)"""


CENTROIDS = f"""
WITH raw AS (
    SELECT row_number() OVER () AS row, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), x AS MATERIALIZED (
    SELECT row, vec_id, list_transform(v, lambda c: CAST(greatest(least(floor({centroids.SCALE} * c), {_MOST}), -{_MOST}) AS BIGINT)) AS v
    FROM raw WHERE len(v) = {centroids.SIZE} AND len(list_filter(v, lambda c: c IS NOT NULL AND isfinite(c))) = {centroids.SIZE}
), c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('{centroids.SEED}:' || vec_id) NULLS LAST) - 1 AS c, v FROM x
    ORDER BY c LIMIT {centroids.CLUSTERS}
), {",".join(map(_round, range(centroids.ROUNDS + 1)))}, i AS (
    SELECT best.c AS c, sum(best.distance) AS cluster_inertia FROM a{centroids.ROUNDS} GROUP BY best.c
)
SELECT vec_id, CAST(best.c AS INT) AS cluster, CAST(best.distance AS BIGINT) AS distance, CAST(cluster_inertia AS BIGINT) AS cluster_inertia,
    CAST((SELECT sum(cluster_inertia) FROM i) AS BIGINT) AS inertia, sha256(array_to_string(g.v, ',')) AS centroid_sha256
FROM x JOIN a{centroids.ROUNDS} USING (row) JOIN i ON best.c = i.c JOIN c{centroids.ROUNDS} g ON best.c = g.c
"""

_PII_PATTERNS = ", ".join(
    f"({number}, '{kind}', '{pattern}', '{personal_data.words_pattern(personal_data.FOR[kind])}', "
    f"'{personal_data.words_pattern(personal_data.AGAINST[kind])}', {personal_data.PRIOR[kind]})"
    for number, (kind, pattern) in enumerate(zip(personal_data.KINDS, (
        personal_data.EMAIL, personal_data.IP, personal_data.CARD, personal_data.PHONE, personal_data.IBAN,
        personal_data.SSN, personal_data.NATIONAL, personal_data.HIDDEN)))
)
_IBAN_LENGTH = ", ".join(f"'{country}': {length}" for country, length in personal_data.IBAN_LENGTH.items())
_PII_KINDS = ", ".join(
    f"CAST(count(*) FILTER (WHERE name = '{kind}') AS BIGINT) AS n_{kind}" for kind in personal_data.KINDS)

PERSONAL_DATA = f"""
WITH d AS (
    SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents
), p(kind, name, pattern, words_for, words_against, prior) AS (
    VALUES {_PII_PATTERNS}
), f AS (
    SELECT row, t, p.*, regexp_extract_all(t, pattern) AS found, string_split_regex(t, pattern) AS gaps FROM d, p
), l AS (
    SELECT * EXCLUDE (found, gaps), found[i] AS m, CAST(list_sum(list_transform(gaps[1:i], lambda x: len(x)))
        + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: len(x))), 0) AS BIGINT) AS start
    FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM f)
), c AS (
    SELECT * EXCLUDE (m), CASE WHEN name <> 'iban' THEN m ELSE substr(m, 1, CAST(list_min(list_filter(range(1, len(m) + 1),
        lambda i: len(replace(substr(m, 1, i), ' ', '')) = coalesce(MAP {{{_IBAN_LENGTH}}}[substr(m, 1, 2)], 0))) AS BIGINT)) END AS m
    FROM l
), v AS (
    SELECT *, start + len(m) AS stop, replace(m, ' ', '') AS plain, regexp_replace(m, '[^0-9]', '', 'g') AS digits,
        CASE WHEN start = 0 THEN '' ELSE substr(t, start, 1) END AS left_sign, substr(t, start + len(m) + 1, 1) AS right_sign
    FROM c WHERE m IS NOT NULL
), s AS (
    SELECT * FROM v WHERE CASE name
        WHEN 'ip' THEN len(list_filter(string_split(m, '.'), lambda x: len(ltrim(x, '0')) > 3 OR coalesce(TRY_CAST(x AS BIGINT), 999) > 255)) = 0
        WHEN 'card' THEN len(digits) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, len(digits) + 1), lambda i: CASE
            WHEN (len(digits) - i) % 2 = 0 THEN CAST(substr(digits, i, 1) AS INT)
            ELSE CAST(substr(digits, i, 1) AS INT) * 2 - CASE WHEN substr(digits, i, 1) > '4' THEN 9 ELSE 0 END END)) % 10 = 0
        WHEN 'phone' THEN len(digits) BETWEEN 9 AND 15
        WHEN 'iban' THEN NOT regexp_matches(left_sign, '[A-Za-z0-9]') AND list_reduce(list_prepend(0, list_transform(
            string_split(substr(plain, 5) || substr(plain, 1, 4), ''), lambda x: CASE WHEN x <= '9' THEN ascii(x) - 48 ELSE ascii(x) - 55 END)),
            lambda a, x: (a * (CASE WHEN x > 9 THEN 100 ELSE 10 END) + x) % 97) = 1
        WHEN 'ssn' THEN regexp_full_match(m, '[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}') AND NOT regexp_matches(m, '^(000|666|9)|-00-|-0000$')
        ELSE TRUE END
    AND (name NOT IN ('ssn', 'national') OR NOT regexp_matches(left_sign, '[A-Za-z0-9+.-]') AND NOT regexp_matches(right_sign, '[A-Za-z0-9+-]'))
), near AS (
    SELECT *, translate(substr(t, greatest(start - {personal_data.BEFORE}, 0) + 1, least(start, {personal_data.BEFORE})),
            '{_CAPITALS}', '{_SMALL}') AS before,
        translate(substr(t, stop + 1, {personal_data.AFTER}), '{_CAPITALS}', '{_SMALL}') AS after
    FROM s x WHERE name <> 'national' OR NOT EXISTS (
        SELECT 1 FROM s y WHERE y.name = 'phone' AND y.row = x.row AND y.start <= x.start AND x.stop <= y.stop)
), scored AS (
    SELECT *, kind || ':' || start AS place, name || ':' || start || ':' || stop AS span, prior
        + CASE WHEN regexp_matches(before, words_for) OR regexp_matches(after, words_for) THEN {personal_data.STEP} ELSE 0 END
        - CASE WHEN regexp_matches(before, words_against) OR regexp_matches(after, words_against) THEN {personal_data.STEP} ELSE 0 END AS score
    FROM near
), k AS (
    SELECT * FROM scored WHERE kind < {len(personal_data.BASE)} OR score >= {personal_data.KEEP}
), g AS (
    SELECT row, {_PII_KINDS}, coalesce(string_agg(span, ',' ORDER BY kind, start) FILTER (WHERE kind < {len(personal_data.BASE)}), '') AS base,
        string_agg(span, ',' ORDER BY kind, start) AS spans
    FROM k GROUP BY row
)
SELECT doc_id, {", ".join(f"coalesce(n_{kind}, 0) AS n_{kind}" for kind in personal_data.KINDS)},
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (row)
"""

_FIELD = "coalesce(CAST(strlen(CAST({0} AS VARCHAR)) AS VARCHAR) || ':' || CAST({0} AS VARCHAR), '-')"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(_FIELD.format(name) for name in ('doc_id', 'source', 'lang', n_chars, 'text'))})"


# CRC-32 of the decimal id: eight shifts for every character.
_CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
        lambda a, c: list_reduce(list_prepend(xor(a, c), [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]),
            lambda t, z: CASE WHEN t % 2 = 1 THEN xor(t // 2, 3988292384) ELSE t // 2 END)), 4294967295)"""

MERKLE = f"""
WITH RECURSIVE leaves AS MATERIALIZED (
    SELECT row_number() OVER () AS row, doc_id, coalesce(':' || lang, '') AS tree, {_leaf("n_chars")} AS leaf,
        CASE WHEN doc_id IS NOT NULL AND {_CRC} % 7 = 0 THEN {_leaf("n_chars + 1")} ELSE {_leaf("n_chars")} END AS checked
    FROM documents
), placed AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS LAST, leaf, row) - 1 AS place, count(*) OVER (PARTITION BY tree) AS width
    FROM leaves
), n AS (
    SELECT tree, 0 AS level, place, width, leaf AS digest FROM placed
    UNION ALL
    SELECT tree, level + 1, place // 2, (width + 1) // 2, sha256(string_agg(digest, '' ORDER BY place))
    FROM n WHERE width > 1 GROUP BY tree, level, place // 2, width
), subroots AS MATERIALIZED (
    SELECT tree, level AS height, digest, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS width FROM n WHERE width = 1
), m AS (
    SELECT 0 AS level, place, width, digest FROM subroots
    UNION ALL
    SELECT level + 1, place // 2, (width + 1) // 2, sha256(string_agg(digest, '' ORDER BY place))
    FROM m WHERE width > 1 GROUP BY level, place // 2, width
), steps AS MATERIALIZED (
    SELECT p.row, h.level AS step, (p.place >> h.level) % 2 AS slot, coalesce(s.digest, '') AS digest
    FROM placed p JOIN (SELECT DISTINCT tree, level FROM n WHERE width > 1) h ON p.tree = h.tree
    LEFT JOIN n s ON s.tree = p.tree AND s.level = h.level AND s.place = xor(p.place >> h.level, 1)
    UNION ALL
    SELECT p.row, r.height + h.level, (r.place >> h.level) % 2, coalesce(s.digest, '')
    FROM placed p JOIN subroots r ON p.tree = r.tree CROSS JOIN (SELECT DISTINCT level FROM m WHERE width > 1) h
    LEFT JOIN m s ON s.level = h.level AND s.place = xor(r.place >> h.level, 1)
), folded AS (
    SELECT row, 0 AS step, checked AS digest FROM placed
    UNION ALL
    SELECT f.row, f.step + 1, CASE WHEN slot = 0 THEN sha256(f.digest || s.digest) ELSE sha256(s.digest || f.digest) END
    FROM folded f JOIN steps s ON f.row = s.row AND f.step = s.step
), ends AS (
    SELECT row, arg_max(digest, step) AS folded_root FROM folded GROUP BY row
), proofs AS (
    SELECT row, sha256(string_agg(digest, '' ORDER BY step)) AS proof_sha256 FROM steps GROUP BY row
)
SELECT p.doc_id, p.leaf, r.digest AS subroot, (SELECT digest FROM m WHERE width = 1) AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256,
    folded_root, folded_root = (SELECT digest FROM m WHERE width = 1) AS verified
FROM placed p JOIN subroots r ON p.tree = r.tree JOIN ends USING (row) LEFT JOIN proofs USING (row)
"""

ORACLES = {
    "op1_mixing": MIXING,
    "op2_line_dedup": LINE_DEDUP,
    "op3_exact_dedup": EXACT_DEDUP,
    "op4_near_dedup": NEAR_DEDUP,
    "op9_substring_dedup": SUBSTRING_DEDUP,
    "op10_embedding_dedup": EMBEDDING_DEDUP,
    "op11_centroids": CENTROIDS,
    "op12_merkle_manifest": MERKLE,
    "op13_personal_data": PERSONAL_DATA,
}
