"""DuckDB equivalents of the training-data queries that SQL can express, written from the definitions."""

from __future__ import annotations

from itertools import permutations

_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_ORDERS = ", ".join(f"('{''.join(order)}')" for order in permutations("ABCDE"))

ORACLES = {
    "op11_lexical_search": rf"""
        WITH tokens AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
        postings AS (SELECT doc_id, term, count(*) AS tf FROM tokens GROUP BY ALL),
        lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM postings GROUP BY ALL),
        totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM lengths),
        weights AS (
            SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM postings, totals GROUP BY term),
        impacts AS (
            SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * docs) // words)))) AS impact
            FROM postings JOIN lengths USING (doc_id) JOIN weights USING (term), totals),
        asked AS (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark),
        scores AS (
            SELECT item_id, doc_id, CAST(sum(impact) AS BIGINT) AS score FROM asked JOIN impacts USING (term) GROUP BY ALL)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
               doc_id, score
        FROM scores WHERE score > 0 QUALIFY rank <= 10""",
    "op12_filter_audit": rf"""
        WITH texts AS (
            SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents),
        judged AS (
            SELECT part, len(words) < 100 AS a, 100 * len(list_distinct(words)) < 80 * len(words) AS b,
                   100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) AS c,
                   regexp_matches(text, '[#$%&*|]') AS d,
                   doc_id > min(doc_id) OVER (PARTITION BY text) AS e,
                   coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic
            FROM texts LEFT JOIN labels USING (doc_id)),
        masks AS (
            SELECT part, [a, b, c, d, e] AS fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
            FROM judged GROUP BY ALL),
        steps AS (
            SELECT part, filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS letter, n, good, toxic,
                   fails[instr('ABCDE', filter_order[step])] AS failing,
                   coalesce(list_bool_or(list_transform(
                       range(1, step), lambda s: fails[instr('ABCDE', filter_order[s])])), false) AS gone,
                   len(list_filter(fails, lambda f: f)) AS n_failing
            FROM masks, (VALUES {_ORDERS}) o(filter_order), range(1, 6) r(step)),
        counted AS (
            SELECT part, filter_order, step, letter,
                   CAST(coalesce(sum(n) FILTER (NOT gone AND NOT failing), 0) AS BIGINT) AS kept,
                   CAST(coalesce(sum(n) FILTER (NOT gone AND failing), 0) AS BIGINT) AS removed,
                   CAST(coalesce(sum(n) FILTER (gone AND failing), 0) AS BIGINT) AS redundant,
                   CAST(coalesce(sum(n) FILTER (failing AND n_failing = 1), 0) AS BIGINT) AS unique_fails,
                   CAST(coalesce(sum(good) FILTER (NOT gone AND failing), 0) AS BIGINT) AS good_lost,
                   CAST(coalesce(sum(toxic) FILTER (NOT gone AND failing), 0) AS BIGINT) AS toxic_lost
            FROM steps GROUP BY ALL)
        SELECT * EXCLUDE (letter), CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM counted""",
}
