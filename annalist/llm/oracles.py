"""DuckDB SQL for the rows of the queries that SQL can express."""

from annalist.llm.line_dedup import BLANKS, BLOCK, ENTITIES, HIDDEN, LEAST_PAGES, RATIO
from annalist.llm.quality_rules import RULES, STOP_WORDS


def _quality_bounds() -> str:
    """The limits of the quality rules as a condition on the counts."""
    out = []
    for rule in RULES:
        value = f"CASE WHEN {rule.per} = 0 THEN 0.0 ELSE {rule.measure}::DOUBLE / {rule.per} END" if rule.per else rule.measure
        out += [f"{value} >= {rule.least}"] if rule.least is not None else []
        out += [f"{value} <= {rule.most}"] if rule.most is not None else []
    return " AND ".join(out)


def quality_counts(source: str) -> str:
    """The counts of the quality rules per row of ``source (row_key, text)``, as SQL of a relation."""
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    return rf"""
        SELECT row_key, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
               (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
               (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l)::BIGINT AS n_lines,
               coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
               len(list_filter(w, lambda x: lower(x) IN ({stop})))::BIGINT AS n_stop_words
        FROM (
            SELECT row_key, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                   list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
            FROM {source}
        ) LEFT JOIN (
            SELECT row_key, count(DISTINCT place + step) AS n_repeat_words
            FROM (
                SELECT row_key, place, count(*) OVER (PARTITION BY row_key, a, b, c) AS n
                FROM (
                    SELECT row_key, place, w[place] AS a, w[place + 1] AS b, w[place + 2] AS c
                    FROM (
                        SELECT row_key, w, unnest(range(1, len(w) - 1)) AS place
                        FROM (SELECT row_key, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM {source})
                    )
                )
            ), range(3) AS s(step)
            WHERE n > 1 GROUP BY row_key
        ) USING (row_key)
    """


def _line_dedup() -> str:
    text = f"regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '{HIDDEN}', '', 'g'), '{BLOCK}', chr(10), 'g'), '<[^>]*>', '', 'g')"
    for entity, char in ENTITIES.items():
        text = f"replace({text}, '{entity}', '{char.replace("'", "''")}')"
    blanks = " || ".join(f"chr({ord(c)})" for c in BLANKS)
    return rf"""
        WITH p AS (
            SELECT page_id, lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)', 1)) AS host,
                   string_split({text}, chr(10)) AS raw
            FROM pages
        ), l AS (
            SELECT page_id, host, place, trim(raw[place], {blanks}) AS line
            FROM (SELECT page_id, host, raw, unnest(range(1, len(raw) + 1)) AS place FROM p)
        ), b AS (
            SELECT host, line
            FROM (SELECT host, line, count(DISTINCT page_id) AS n FROM l WHERE line <> '' GROUP BY ALL)
            JOIN (SELECT host, count(*) AS total FROM p GROUP BY host) USING (host)
            WHERE n >= {LEAST_PAGES} AND n / total > {RATIO}
        )
        SELECT p.page_id, p.host, count(line) FILTER (line <> '') AS n_lines,
               count(line) FILTER (line <> '' AND b_line IS NOT NULL) AS n_dropped,
               coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (line <> '' AND b_line IS NULL), '') AS kept_text
        FROM p LEFT JOIN (SELECT l.*, b.line AS b_line FROM l LEFT JOIN b ON b.host = l.host AND b.line = l.line) l USING (page_id)
        GROUP BY p.page_id, p.host
    """


QUALITY_KEPT = _quality_bounds()

SQL: dict[str, str] = {
    "op8_quality_rules": f"""
        WITH d AS (SELECT doc_id AS row_key, text FROM documents)
        SELECT row_key AS doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
               n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {QUALITY_KEPT} AS kept
        FROM ({quality_counts("d")})
    """,
    "op6_line_dedup": _line_dedup(),
    "op4_chat_formatting": r"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), m AS (
            SELECT *, regexp_replace(text, '(<|\[)(\\*)(\|[A-Za-z0-9_]+\|>|/?s>|</?SYS>>|/?INST\])', '\1\\\2\3', 'g') AS held
            FROM c
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(length('<|turn|><|text|><|end|>') + length(role) + length(held))::BIGINT AS formatted_chars
        FROM m GROUP BY conv_id
    """,
    "op1_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id, length(coalesce(text, '')) AS points,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents
        ), r AS (
            SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST) AS place,
                   count(*) OVER (PARTITION BY text_sha256) AS group_size
            FROM n
        )
        SELECT r.doc_id, k.doc_id AS keep_id, r.group_size, r.place = 1 AS kept, r.text_sha256
        FROM r JOIN r AS k ON k.text_sha256 = r.text_sha256 AND k.place = 1
    """,
}
