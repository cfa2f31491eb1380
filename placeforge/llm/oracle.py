"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

from placeforge.llm.quality_rules import FALSE_REJECTION, LEAST_WORDS, MOST_REPEATED, RISK, RULES

EXACT_DEDUP = """
    WITH texts AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
        FROM documents)
    SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
           doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
    FROM texts"""

RANKED_SEARCH = r"""
    WITH terms AS (
        SELECT doc_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM documents),
    tf AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM terms GROUP BY ALL),
    df AS (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY ALL),
    lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY ALL),
    totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM lengths),
    wanted AS (
        SELECT DISTINCT item_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark),
    weights AS (
        SELECT item_id, term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
        FROM wanted JOIN df USING (term) CROSS JOIN totals),
    scores AS (
        SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // words))))::BIGINT AS score
        FROM weights JOIN tf USING (term) JOIN lengths USING (doc_id) CROSS JOIN totals GROUP BY ALL),
    ranked AS (
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
        FROM scores WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50"""

_LADDERS = " UNION ALL ".join(
    f"SELECT '{name}' AS rule, '{'>' if above else '<'}' AS side, {at} AS rung, {cutoff}::DOUBLE AS cutoff"
    for name, _, above, cutoffs in RULES
    for at, cutoff in enumerate(cutoffs)
)
_VALUES = " ".join(f"WHEN '{name}' THEN {statistic.replace(' / ', '::DOUBLE / ')}" for name, statistic, _, _ in RULES)
_RATE = FALSE_REJECTION / len(RULES)

QUALITY_RULES = rf"""
    WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '-') AS stratum, coalesce(text, '') AS t FROM documents),
    words AS (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM texts),
    singles AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM words),
    windows AS (
        SELECT r, i, w || ' ' || lead(w) OVER o || ' ' || lead(w, 2) OVER o AS win FROM singles WINDOW o AS (PARTITION BY r ORDER BY i)),
    repeats AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM windows WHERE win IS NOT NULL) WHERE c > 1),
    repeated AS (SELECT r, count(DISTINCT i + j) AS n FROM repeats, range(3) AS steps(j) GROUP BY r),
    lines AS (
        SELECT r, count(*) AS n, count(*) - count(DISTINCT line) AS dup
        FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM texts) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
    stats AS (
        SELECT doc_id, stratum, t, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
               (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
               coalesce(lines.n, 0)::BIGINT AS n_lines, coalesce(lines.dup, 0)::BIGINT AS n_dup_lines, coalesce(repeated.n, 0)::BIGINT AS n_repeat_words
        FROM texts JOIN words USING (r) LEFT JOIN lines USING (r) LEFT JOIN repeated USING (r)),
    judged AS (
        SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM stats),
    holdouts AS (
        SELECT stratum, max(quality) = 1 AS good, any_value(n_words) AS n_words, any_value(word_chars) AS word_chars, any_value(n_symbols) AS n_symbols,
               any_value(n_lines) AS n_lines, any_value(n_dup_lines) AS n_dup_lines, any_value(n_repeat_words) AS n_repeat_words
        FROM judged JOIN labels USING (doc_id) WHERE NOT base_failed AND quality IS NOT NULL GROUP BY stratum, t),
    ladder AS ({_LADDERS}),
    counted AS (
        SELECT stratum, rule, side, rung, cutoff, count_if(good)::BIGINT AS good,
               count_if(good AND CASE side WHEN '>' THEN v > cutoff ELSE v < cutoff END)::BIGINT AS k,
               count_if(NOT good AND CASE side WHEN '>' THEN v > cutoff ELSE v < cutoff END)::BIGINT AS b
        FROM (SELECT *, CASE rule {_VALUES} END AS v FROM holdouts CROSS JOIN ladder) GROUP BY ALL HAVING count_if(good) > 0),
    tests AS (SELECT count(DISTINCT (stratum, rule)) AS n FROM counted),
    tested AS (
        SELECT *, CASE WHEN k >= good * {_RATE}::DOUBLE THEN 1.0 ELSE (
            SELECT sum(exp(lgamma(good + 1) - lgamma(i + 1) - lgamma(good - i + 1) + i * ln({_RATE}::DOUBLE) + (good - i) * ln(1 - {_RATE}::DOUBLE)))
            FROM range(k + 1) AS tail(i)) END AS p
        FROM counted),
    taken AS (
        SELECT stratum, rule, any_value(side) AS side, arg_max(cutoff, (b, -rung)) AS cutoff
        FROM tested, tests WHERE p <= {RISK}::DOUBLE / n AND b > 0 GROUP BY stratum, rule),
    broken AS (
        SELECT DISTINCT t FROM (SELECT judged.*, rule, side, cutoff, CASE rule {_VALUES} END AS v FROM judged JOIN taken USING (stratum) WHERE n_words > 0)
        WHERE CASE side WHEN '>' THEN v > cutoff ELSE v < cutoff END)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT EXISTS (
        SELECT 1 FROM broken WHERE broken.t = judged.t) AS kept
    FROM judged"""

#: the checksum of a decimal number, bit by bit
_CRC = """
    digits AS (SELECT DISTINCT doc_id AS id, doc_id::VARCHAR AS d FROM documents WHERE doc_id IS NOT NULL),
    crc(id, d, k, c) AS (
        SELECT id, d, 0, 4294967295::BIGINT FROM digits
        UNION ALL
        SELECT id, d, k + 1,
               list_reduce([xor(c, ascii(d[k + 1])::BIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)
        FROM crc WHERE k < length(d)),
    checksums AS (SELECT id, xor(c, 4294967295) AS crc32 FROM crc WHERE k = length(d)),"""


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR))::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_field(f) for f in ('doc_id', 'source', 'lang', 'n_chars', text))})"


MERKLE = f"""
    WITH RECURSIVE {_CRC}
    leaves AS (
        SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '-') AS g, {_leaf("text")} AS leaf,
               CASE WHEN crc32 % 3 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS other
        FROM documents LEFT JOIN checksums ON doc_id = id),
    placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos FROM leaves),
    nodes(g, lvl, pos, h, n) AS (
        SELECT g, 0, pos, leaf, count(*) OVER (PARTITION BY g) FROM placed
        UNION ALL
        SELECT g, any_value(lvl) + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 7) // 8
        FROM nodes WHERE n > 1 GROUP BY g, pos // 8),
    subroots AS (SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS pos FROM nodes WHERE n = 1),
    above(g, lvl, pos, h, n) AS (
        SELECT '', 1000, pos, h, count(*) OVER () FROM subroots
        UNION ALL
        SELECT '', any_value(lvl) + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 7) // 8
        FROM above WHERE n > 1 GROUP BY pos // 8),
    tree AS (SELECT * FROM nodes WHERE n > 1 UNION ALL SELECT * FROM above WHERE n > 1),
    runs AS (SELECT g, lvl, pos // 8 AS run, list(h ORDER BY pos) AS hs FROM tree GROUP BY ALL),
    steps AS (
        SELECT r, lvl, hs[1 : k] AS before, hs[k + 2 :] AS after
        FROM (
            SELECT r, lvl, hs, (placed.pos // (8 ** lvl)::BIGINT) % 8 AS k
            FROM placed JOIN runs ON runs.g = placed.g AND lvl < 1000 AND run = placed.pos // (8 ** (lvl + 1))::BIGINT
            UNION ALL
            SELECT r, lvl, hs, (s.pos // (8 ** (lvl - 1000))::BIGINT) % 8
            FROM placed JOIN subroots s USING (g) JOIN runs ON lvl >= 1000 AND run = s.pos // (8 ** (lvl - 999))::BIGINT)),
    paths AS (
        SELECT r, list({{'b': array_to_string(before, ''), 'a': array_to_string(after, '')}} ORDER BY lvl) AS path FROM steps GROUP BY r),
    whole AS (SELECT placed.*, coalesce(path, []) AS path FROM placed LEFT JOIN paths USING (r)),
    folds(r, k, path, h) AS (
        SELECT r, 0, path, coalesce(other, leaf) FROM whole
        UNION ALL
        SELECT r, k + 1, path, sha256(path[k + 1].b || h || path[k + 1].a) FROM folds WHERE k < len(path)),
    folded AS (SELECT r, h FROM folds WHERE k = len(path)),
    root AS (SELECT h AS root FROM above WHERE n = 1)
    SELECT doc_id, leaf, subroots.h AS subroot, root, sha256(array_to_string(list_transform(path, lambda s: s.b || s.a), '')) AS proof_sha256,
           folded.h AS folded_root, folded.h = root AS verified
    FROM whole JOIN subroots USING (g) JOIN folded USING (r) CROSS JOIN root"""

ORACLE_SQL = {
    "op8_exact_dedup": EXACT_DEDUP,
    "op11_ranked_search": RANKED_SEARCH,
    "op12_quality_rules": QUALITY_RULES,
    "op13_merkle": MERKLE,
}
