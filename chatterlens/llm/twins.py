"""SQL of the queries that SQL can express."""

from __future__ import annotations

from chatterlens.llm.vector_codes import ENTRIES, PARTS, ROUNDS, SCALE


def trie_codes() -> str:
    """Codebooks round by round, all distances spelled out."""
    square = "list_sum(list_transform(list_zip(part, entry_part), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = [
        f"""kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {SCALE}) AS BIGINT)) AS v
        FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""parts AS MATERIALIZED (SELECT vec_id, label, p, v[p * len(v) // {PARTS} + 1 : (p + 1) * len(v) // {PARTS}] AS part
        FROM kept, range({PARTS}) AS t(p))""",
        f"""book0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS entry, part AS entry_part
        FROM parts QUALIFY entry < {ENTRIES})""",
    ]
    for r in range(ROUNDS + 1):
        steps.append(
            f"""near{r} AS MATERIALIZED (SELECT vec_id, any_value(label) AS label, p, any_value(part) AS part,
            min({square} * {ENTRIES} + entry) AS best FROM parts JOIN book{r} USING (p) GROUP BY vec_id, p)"""
        )
        if r < ROUNDS:
            steps.append(
                f"""sums{r} AS (SELECT p, entry, list(CAST(floor(total / n) AS BIGINT) ORDER BY i) AS entry_part FROM (
                SELECT p, entry, i, sum(x) AS total, count(*) AS n FROM (
                SELECT p, best % {ENTRIES} AS entry, unnest(part) AS x, generate_subscripts(part, 1) AS i FROM near{r}) GROUP BY ALL) GROUP BY ALL)"""
            )
            steps.append(
                f"""book{r + 1} AS MATERIALIZED (SELECT p, entry, coalesce(s.entry_part, b.entry_part) AS entry_part
                FROM book{r} b LEFT JOIN sums{r} s USING (p, entry))"""
            )
    return f"""WITH {", ".join(steps)},
    codes AS (SELECT vec_id, any_value(label) AS label, string_agg(format('{{:02x}}', best % {ENTRIES}), '' ORDER BY p) AS code,
        CAST(sum(best // {ENTRIES}) AS BIGINT) AS error FROM near{ROUNDS} GROUP BY vec_id),
    told AS (SELECT sha256(string_agg(array_to_string(entry_part, ','), ',' ORDER BY p, entry)) AS codebooks_sha256 FROM book{ROUNDS})
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM codes, told"""


def branching_tandems() -> str:
    """Pairs of equal words give a document's repeats by period; consecutive ones make its runs."""
    step = "xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))"
    octets = "flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: [CAST(ascii(s) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))"
    return f"""WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
        xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {octets}), lambda c, b: {step}), 4294967295) AS h FROM documents),
    placed AS (SELECT doc_id, w, h, h // 10 AS g, len(w) AS n FROM docs),
    begun AS (SELECT *, CASE WHEN n > 0 THEN g % n ELSE 0 END AS a FROM placed),
    shaped AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM begun),
    words AS MATERIALIZED (SELECT doc_id, n, i, w[CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END + 1] AS word
        FROM (SELECT *, unnest(range(n)) AS i FROM shaped)),
    pairs AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM words x JOIN words y
        ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
    stretches AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length
        FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS block FROM pairs) GROUP BY doc_id, q, block),
    runs AS MATERIALIZED (SELECT doc_id, start, length, min(q) AS period FROM stretches
        WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length),
    told AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS said
        FROM runs GROUP BY doc_id),
    best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed FROM words w WHERE NOT EXISTS (
        SELECT 1 FROM runs r WHERE r.doc_id = w.doc_id AND w.i >= r.start + r.period AND w.i < r.start + r.length) GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
        sha256(coalesce(said, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
    FROM docs d LEFT JOIN told USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)"""


def oracle_sql() -> dict[str, str]:
    return {"op11_trie_codes": trie_codes(), "op12_branching_tandems": branching_tandems()}
