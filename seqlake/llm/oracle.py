"""DuckDB SQL of the queries that it can express, written apart from the operators."""

CONFLICT = r"'<\||</s>|\[/?INST\]|\\[\\|/I]'"


def _escaped_length(column: str) -> str:
    # one more character for each backslash and for each control string
    return (f"length(regexp_replace(regexp_replace(replace({column}, '\\', '\\\\'), "
            f"'<(\\||/s>)', '<\\\\\\1', 'g'), '\\[(/?INST\\])', '[\\\\\\1', 'g'))")


CHAT = rf"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
    SELECT *, CASE WHEN regexp_matches(role, {CONFLICT}) OR regexp_matches(text, {CONFLICT})
        THEN {_escaped_length('role')} + {_escaped_length('text')}
        ELSE length(role) + length(text) END AS content
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
        AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
        FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(content + length('<|im_start|>') + length('<|im_sep|>') + length('<|im_end|>') + 1)::BIGINT
        AS formatted_chars
FROM sized GROUP BY conv_id
"""

QUALITY = r"""
WITH texts AS (
    SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents
), parts AS (
    SELECT rid, doc_id, source, text,
        list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
        list_filter(string_split(text, chr(10)),
            lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM texts
), windows AS (
    SELECT rid, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
    FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM parts)
), repeated AS (
    SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, a, b, c) > 1
), covered AS (
    SELECT rid, count(DISTINCT i + k) AS n FROM repeated, range(3) AS r(k) GROUP BY rid
), measured AS (
    SELECT p.rid, doc_id, source, len(w) AS n_words,
        length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
    FROM parts p LEFT JOIN covered c USING (rid)
), based AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
), judged AS (
    SELECT *, base_failed OR n_symbols > 0.1::DOUBLE * word_chars
        OR n_dup_lines > 0.3::DOUBLE * n_lines
        OR NOT word_chars::DOUBLE / greatest(n_words, 1) BETWEEN 2 AND 14 AS failed
    FROM based
), hosts AS (
    SELECT source, count(*)::DOUBLE AS n, sum(failed::INT)::DOUBLE AS f, f / n AS rate
    FROM judged GROUP BY source
), prior AS (
    SELECT avg(rate) AS mean,
        greatest(var_pop(rate) - avg(rate * (1 - rate) / n), 1e-4) AS var FROM hosts
), strength AS (
    SELECT mean, greatest(mean * (1 - mean) / var - 1, 2.0) AS s FROM prior
), verdicts AS (
    SELECT source, (f + mean * s) / (n + s) > 0.5 AS bad FROM hosts, strength
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
    n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
    n_repeat_words::BIGINT AS n_repeat_words, base_failed,
    NOT base_failed AND NOT (bad AND failed) AS kept
FROM judged j JOIN verdicts v ON j.source IS NOT DISTINCT FROM v.source
"""

DIVERGENCE = r"""
WITH docs AS (
    SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
    FROM documents
), words AS (
    SELECT rid, lang, source, unnest(words) AS term FROM docs
), kept AS (
    SELECT lang, term, count(*) AS n FROM words GROUP BY ALL HAVING count(DISTINCT rid) >= 30
), groups AS (
    SELECT DISTINCT lang, source FROM docs
), counted AS (
    SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL
), sizes AS (
    SELECT lang, sum(n) AS lang_n, count(*) AS v FROM kept GROUP BY lang
), dense AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n
    FROM groups g JOIN kept k USING (lang) LEFT JOIN counted c USING (lang, source, term)
), shares AS (
    SELECT d.lang, d.source, d.term, d.n,
        1 + (1000000000 * (d.n + 5)::HUGEINT) // (sum(d.n) OVER (PARTITION BY d.lang, d.source) + 5 * v) AS p,
        1 + (1000000000 * (d.lang_n + 5)::HUGEINT) // (s.lang_n + 5 * v) AS q
    FROM dense d JOIN sizes s USING (lang)
), found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (
        SELECT x.lang, x.source AS s1, y.source AS s2, sum(abs(x.p - y.p)) AS f
        FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL
    ) d ON d.lang = a.lang AND d.s1 = a.source AND d.s2 = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value,
    row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
FROM found QUALIFY part = 'pair' OR rank <= 50
"""


def clusters(centroids: int = 16, rounds: int = 3) -> str:
    """The rounds written out one after another."""
    parts = [f"""vectors AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, vec_id,
        list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE len(embedding) = 64
        AND len(list_filter(embedding, lambda x: coalesce(isfinite(x::DOUBLE), false))) = 64
), c0 AS MATERIALIZED (
    SELECT (row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), v) - 1)::INT AS k,
        v AS c
    FROM vectors QUALIFY k < {centroids}
)"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
    SELECT rid, any_value(vec_id) AS vec_id, any_value(v) AS v, arg_min(k, d * {centroids} + k) AS k,
        min(d)::BIGINT AS d
    FROM (SELECT rid, vec_id, v, k, list_sum(list_transform(
            list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM vectors, c{i})
    GROUP BY rid
)""")
        if i < rounds:
            parts.append(f"""m{i} AS (
    SELECT k, j, sum(v[j]) AS s, count(*) AS n FROM a{i}, range(1, 65) AS r(j) GROUP BY k, j
), c{i + 1} AS MATERIALIZED (
    SELECT k, coalesce(m, c) AS c FROM c{i} LEFT JOIN (
        SELECT k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS m FROM m{i} GROUP BY k
    ) USING (k)
)""")
    return "WITH " + ", ".join(parts) + f"""
SELECT vec_id, a.k AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a.k))::BIGINT AS cluster_inertia,
    (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON a.k = c.k
"""
