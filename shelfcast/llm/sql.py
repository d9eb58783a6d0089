"""DuckDB SQL for the queries that SQL can express, written independently of the Spark code."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

# Reaches every id from every id by links(a, b), both directions given.
COMPONENTS = """
    reached(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
    smallest AS (SELECT a, least(a, min(b)) AS component_id FROM reached GROUP BY a)"""

VECTORS = f"""
    WITH RECURSIVE usable AS (
        SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
          AND list_sum(list_transform(embedding, lambda x: CASE WHEN x IS NULL OR NOT isfinite(x) THEN 1 ELSE 0 END)) = 0
          AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0),
    links AS (
        SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y
          ON x.label = y.label AND len(x.v) = len(y.v) AND x.vec_id <> y.vec_id
        WHERE list_cosine_similarity(x.v, y.v) >= 0.98),
    {COMPONENTS},
    degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
    SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
           coalesce(component_id, vec_id) = vec_id AS kept
    FROM embeddings LEFT JOIN smallest ON smallest.a = vec_id LEFT JOIN degrees ON degrees.a = vec_id"""


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# Rules, the part that must be long enough, and its least length.
_KEYS = "|".join(map(_any_case, ["password", "passwd", "secret", "token", "api_?key"]))
_SIGN = r"""["'']?\x20*[:=]\x20*["'']?"""
SECRET_RULES = [
    ("assign", rf"(?:{_KEYS}){_SIGN}[A-Za-z0-9+/_.=-]+", rf"(?:{_KEYS}){_SIGN}([A-Za-z0-9+/_.=-]+)", 8),
    ("access", "AKIA[A-Z0-9]+", "(AKIA[A-Z0-9]+)", 16),
    ("hex", "[0-9a-f]+", "([0-9a-f]+)", 32),
    ("github", "gh[pousr]_[A-Za-z0-9]+", "(gh[pousr]_[A-Za-z0-9]+)", 40),
    ("slack", "xox[abprs]-[A-Za-z0-9-]+", "(xox[abprs]-[A-Za-z0-9-]+)", 15),
    ("private_key", r"-----BEGIN\x20[A-Z\x20]*PRIVATE\x20KEY-----", r"(-----BEGIN\x20[A-Z\x20]*PRIVATE\x20KEY-----)", 1),
]

# A text is its matches and what stands between them, so places follow from lengths.
_SPANS = " UNION ALL ".join(
    f"""
    SELECT doc_id, '{kind}' AS kind, {number} AS turn, place AS span_start, place + length(m) AS span_end
    FROM (SELECT doc_id, m, coalesce(sum(length(m)) OVER w, 0) - length(m) + sum(length(gap)) OVER w AS place
          FROM (SELECT doc_id, unnest(regexp_extract_all(body, '{pattern}')) AS m,
                       unnest(string_split_regex(body, '{pattern}')[:-2]) AS gap,
                       generate_subscripts(regexp_extract_all(body, '{pattern}'), 1) AS i
                FROM texts WHERE regexp_matches(body, '{pattern}'))
          WINDOW w AS (PARTITION BY doc_id ORDER BY i))
    WHERE length(regexp_extract(m, '^{long}$', 1)) >= {least}"""
    for number, (kind, pattern, long, least) in enumerate(SECRET_RULES)
)
SECRETS = f"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
    spans AS ({_SPANS}),
    listed AS (
        SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
               count(*) FILTER (kind = 'hex') AS n_hex,
               string_agg(concat(kind, ':', CAST(span_start AS BIGINT), ':', CAST(span_end AS BIGINT)), ',' ORDER BY span_start, turn)
                   FILTER (turn < 3) AS base,
               string_agg(concat(kind, ':', CAST(span_start AS BIGINT), ':', CAST(span_end AS BIGINT)), ',' ORDER BY span_start, turn) AS spans
        FROM spans GROUP BY doc_id)
    SELECT texts.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM texts LEFT JOIN listed USING (doc_id)"""

BACKOFF = f"""
    WITH split AS (
        SELECT doc_id, unnest(list) AS w, generate_subscripts(list, 1) AS i
        FROM (SELECT doc_id, regexp_extract_all(text, '{WORD}') AS list FROM documents)),
    grams AS (
        SELECT doc_id, i, w AS g1, CASE WHEN i > 1 THEN lag(w) OVER d || ' ' || w END AS g2,
               CASE WHEN i > 2 THEN lag(w, 2) OVER d || ' ' || lag(w) OVER d || ' ' || w END AS g3
        FROM split WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
    others AS (
        SELECT doc_id, i, g2, g3, count(*) OVER () - count(*) OVER (PARTITION BY doc_id) AS rest,
               count(*) OVER (PARTITION BY g1) - count(*) OVER (PARTITION BY g1, doc_id) AS n1,
               count(*) OVER (PARTITION BY g2) - count(*) OVER (PARTITION BY g2, doc_id) AS n2,
               count(*) OVER (PARTITION BY g3) - count(*) OVER (PARTITION BY g3, doc_id) AS n3
        FROM grams),
    contexts AS (
        SELECT *, lag(n1) OVER d AS c1, lag(n2) OVER d AS c2 FROM others WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
    one AS (
        SELECT *, CASE WHEN n1 = 0 THEN 0.4::DOUBLE ELSE 1 END * greatest(n1, 1) / greatest(rest, 1) AS s1 FROM contexts),
    two AS (SELECT *, CASE WHEN g2 IS NULL THEN s1 WHEN n2 > 0 THEN n2 / c1 ELSE 0.4::DOUBLE * s1 END AS s2 FROM one),
    three AS (
        SELECT doc_id, count(*) AS n, sum(ln(CASE WHEN g3 IS NULL THEN s2 WHEN n3 > 0 THEN n3 / c2 ELSE 0.4::DOUBLE * s2 END)) AS total
        FROM two GROUP BY doc_id)
    SELECT doc_id, coalesce(n, 0) AS n_words, round(coalesce(total, 0), 4) AS log_score,
           round(coalesce(total / n, 0), 4) AS mean_log_score
    FROM documents LEFT JOIN three USING (doc_id)"""

MIXING = f"""
    WITH RECURSIVE rows AS (
        SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS size,
               CAST('0x' || substr(md5('mix-1:' || doc_id), 1, 15) AS BIGINT) AS draw
        FROM documents),
    sources AS (
        SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(2 * sum(size) AS BIGINT) AS cap,
               [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
        FROM rows GROUP BY source),
    budget AS (SELECT 1.5::DOUBLE * sum(source_size) AS words FROM sources),
    levels(level) AS (
        SELECT (SELECT words FROM budget) / (SELECT sum(weight) FROM sources)
        UNION
        SELECT ((SELECT words FROM budget) - (SELECT coalesce(sum(cap), 0) FROM sources WHERE weight * l.level > cap))
               / (SELECT sum(weight) FROM sources WHERE weight * l.level <= cap)
        FROM levels l WHERE EXISTS (SELECT 1 FROM sources WHERE weight * l.level <= cap)),
    targets AS (
        SELECT source, source_size, least(weight * (SELECT max(level) FROM levels), cap) AS target FROM sources),
    plan AS (
        SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM targets),
    -- One walk over each source in the order of the draw: what does not fit is passed over.
    queue AS (
        SELECT r.doc_id, r.source, r.size, p.target - p.whole * p.source_size AS quota,
               row_number() OVER (PARTITION BY r.source ORDER BY draw % 4096, draw, r.doc_id) AS i
        FROM rows r JOIN plan p ON p.source IS NOT DISTINCT FROM r.source
        WHERE r.size > 0 AND r.size <= p.target - p.whole * p.source_size),
    walk(source, i, doc_id, took, words_left) AS (
        SELECT source, i, doc_id, true, quota - size FROM queue WHERE i = 1
        UNION ALL
        SELECT q.source, q.i, q.doc_id, q.size <= w.words_left,
               w.words_left - CASE WHEN q.size <= w.words_left THEN q.size ELSE 0 END
        FROM walk w JOIN queue q ON q.source IS NOT DISTINCT FROM w.source AND q.i = w.i + 1)
    SELECT r.doc_id, r.size, p.source_size, p.target,
           CAST(r.size * (p.whole + CASE WHEN t.doc_id IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS taken
    FROM rows r JOIN plan p ON p.source IS NOT DISTINCT FROM r.source
    LEFT JOIN (FROM walk WHERE took) t ON t.doc_id = r.doc_id"""

NEAR = f"""
    WITH RECURSIVE split AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS list
        FROM documents),
    sets AS (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(list) = 1 THEN list
                   ELSE list_transform(range(1, len(list)), lambda i: list[i] || ' ' || list[i + 1]) END) AS shingle
        FROM split WHERE len(list) > 0),
    sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
    shared AS (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM sets x JOIN sets y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
        GROUP BY 1, 2),
    links AS (
        SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
        WHERE 100 * s.n >= 80 * (x.n + y.n - s.n)),
    {COMPONENTS}
    SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
           coalesce(component_id, doc_id) = doc_id AS kept
    FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN smallest ON smallest.a = doc_id"""


# A checksum of a list of bytes: each byte, then eight shifts (marked -1).
def _crc32(text: str) -> str:
    steps = f"flatten(list_transform(range(1, length({text}) + 1), lambda i: [ascii({text}[i])::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), lambda c, x: {step}), 4294967295)"


TRIE = f"""
    WITH given AS (
        SELECT conv_id, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
               strlen(coalesce(text, '')) AS n_bytes, turn
        FROM conversations WHERE conv_id IS NOT NULL),
    turns AS (
        SELECT conv_id, k, n_bytes, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS i FROM given),
    heads AS (
        SELECT conv_id, conv_id - conv_id % 5 AS base, {_crc32("CAST(conv_id AS VARCHAR)")} % 9 AS h
        FROM (SELECT DISTINCT conv_id FROM given)),
    joined AS (
        SELECT c.conv_id, 0 AS part, t.i, t.k, t.n_bytes FROM heads c JOIN turns t ON t.conv_id = c.base AND t.i <= c.h
        UNION ALL
        SELECT c.conv_id, 1, t.i, t.k, t.n_bytes FROM heads c JOIN turns t ON t.conv_id = c.conv_id AND t.i > c.h),
    paths AS (
        SELECT conv_id, row_number() OVER w AS depth, n_bytes, string_agg(k, '') OVER w AS path
        FROM joined WINDOW w AS (PARTITION BY conv_id ORDER BY part, i ROWS UNBOUNDED PRECEDING)),
    members AS (
        SELECT conv_id, depth, n_bytes, path, CASE WHEN depth = 1 THEN '' ELSE left(path, length(path) - 64) END AS parent FROM paths
        UNION ALL SELECT conv_id, 0, 0, '', NULL FROM heads),
    lengths AS (SELECT conv_id, max(depth) AS last FROM members GROUP BY conv_id),
    nodes AS (
        SELECT path, any_value(parent) AS parent, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
               any_value(n_bytes) AS n_bytes, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = last), '')) AS ends
        FROM members JOIN lengths USING (conv_id) GROUP BY path),
    families AS (SELECT parent, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
    below AS (
        SELECT m.path, sum((u.n_convs - 1) * u.n_bytes) AS saved, count(*) FILTER (f.n IS NULL) AS leaves
        FROM nodes u JOIN members m ON m.conv_id = u.conv_id AND m.depth <= u.depth LEFT JOIN families f ON f.parent = u.path
        GROUP BY m.path)
    SELECT v.conv_id, v.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, v.n_convs, coalesce(f.n, 0) AS n_children,
           b.leaves AS n_leaves, b.saved::BIGINT AS saved_tokens, v.ends AS ends_sha256
    FROM nodes v LEFT JOIN nodes p ON p.path = v.parent LEFT JOIN families f ON f.parent = v.path JOIN below b ON b.path = v.path"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_near_vectors": VECTORS,
        "op2_secret_scan": SECRETS,
        "op4_backoff_scores": BACKOFF,
        "op6_mixing": MIXING,
        "op7_minhash": NEAR,
        "op11_prefix_trie": TRIE,
    }
