"""DuckDB SQL for the queries that SQL can express, written for the same tables."""

from eventweir.llm.quality import ERROR, RISK, RULES


def _marks() -> str:
    """A row per document and rule with the number of the first cutoff that rejects it."""
    parts = []
    for number, rule in enumerate(RULES):
        value = f"{rule.count} * 1000000 / nullif({rule.of}, 0)" if rule.of else rule.count
        sign = "<" if rule.below else ">"
        failed = " + ".join(f"coalesce(({value} {sign} {c})::INT, 0)" for c in rule.cutoffs)
        last = len(rule.cutoffs)
        parts.append(
            f"SELECT k, {number} AS rule, {last} AS last, {last + 1} - ({failed}) AS mark FROM c"
        )
    return " UNION ALL ".join(parts)


def _tail(first: str, end: str, n: str) -> str:
    """The chance that a binomial count of ``n`` trials lies from ``first`` up to before ``end``."""
    return f"""list_sum(list_transform(range({first}, {end}), lambda i: exp(
        lgamma({n} + 1) - lgamma(i + 1) - lgamma({n} - i + 1)
        + i * ln({RISK}) + ({n} - i) * ln(1 - {RISK}))))"""


ORACLES = {
    "op2_content_sort": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS whole,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS normal
            FROM documents),
        r AS (
            SELECT doc_id, normal,
                   first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS place,
                   count(*) OVER (PARTITION BY normal) AS group_size
            FROM d
            WINDOW w AS (PARTITION BY normal ORDER BY length(whole) DESC, doc_id NULLS LAST))
        SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(normal) AS text_sha256
        FROM r""",
    "op4_warc_index": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS payload FROM pages),
        g AS (
            SELECT page_id, strlen(payload) AS payload_bytes, sha256(payload) AS payload_digest,
                   min(page_id) OVER (PARTITION BY payload) AS first
            FROM p),
        t AS (SELECT *, payload_bytes >= 100 AND page_id <> first AS again FROM g)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN again THEN first END AS refers_to
        FROM t""",
    "op9_wu_manber": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM documents),
        b AS (
            SELECT item_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM benchmark),
        w AS (
            SELECT DISTINCT item_id, least(13, len(words)) AS k,
                   array_to_string(words[i : i + least(13, len(words)) - 1], ' ') AS piece
            FROM (SELECT item_id, words, unnest(generate_series(
                      1, greatest(1, len(words) - 12))) AS i
                  FROM b WHERE len(words) > 0)),
        p AS (
            SELECT r, k, i, array_to_string(words[i : i + k - 1], ' ') AS piece
            FROM (SELECT r, words, k, unnest(generate_series(1, len(words) - k + 1)) AS i
                  FROM d, (SELECT DISTINCT k FROM w) WHERE len(words) >= k)),
        m AS (SELECT DISTINCT r, item_id, i, p.k AS k FROM p JOIN w USING (k, piece)),
        h AS (
            SELECT r, count(*) AS n_hit
            FROM (SELECT DISTINCT r, unnest(generate_series(i, i + k - 1)) AS word FROM m)
            GROUP BY r),
        t AS (
            SELECT r, count(DISTINCT item_id) AS n_items,
                   string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
            FROM m GROUP BY r)
        SELECT doc_id, coalesce(len(words), 0)::BIGINT AS n_words,
               coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
        FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)""",
    "op11_ball_tree": r"""
        WITH d AS (
            SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents),
        b AS (
            SELECT row_number() OVER () AS i, item_id, list_distinct(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS terms
            FROM benchmark),
        a AS (
            SELECT count(*)::BIGINT AS docs, sum(len(terms))::BIGINT AS terms
            FROM d WHERE len(terms) > 0),
        tf AS (
            SELECT k, doc_id, n, term, count(*)::BIGINT AS tf
            FROM (SELECT k, doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM d)
            GROUP BY ALL),
        w AS (
            SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
            FROM (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term), a),
        q AS (SELECT i, item_id, unnest(terms) AS term FROM b),
        s AS (
            SELECT i, item_id, k, doc_id, sum(w.w * (
                (1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * a.docs) // a.terms))
                ))::BIGINT AS score
            FROM q JOIN tf USING (term) JOIN w USING (term), a
            GROUP BY ALL),
        r AS (
            SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id, k) AS place
            FROM s WHERE score > 0)
        SELECT item_id, place::INTEGER AS rank, doc_id, score FROM r WHERE place <= 50""",
    "op12_certified_rules": rf"""
        WITH d AS (
            SELECT row_number() OVER () AS k, doc_id, lang, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents),
        p AS (
            SELECT k, i, array_to_string(words[i : i + 2], ' ') AS piece
            FROM (SELECT k, words, unnest(generate_series(1, len(words) - 2)) AS i
                  FROM d WHERE len(words) > 2)),
        r AS (
            SELECT k, count(DISTINCT word) AS n_repeat_words
            FROM (SELECT k, unnest([i, i + 1, i + 2]) AS word
                  FROM (SELECT *, count(*) OVER (PARTITION BY k, piece) AS n FROM p) WHERE n > 1)
            GROUP BY k),
        l AS (
            SELECT k, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
            FROM (SELECT k, unnest(string_split(t, chr(10))) AS line FROM d)
            WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY k),
        c AS (
            SELECT k, doc_id, lang, len(words) AS n_words,
                   length(array_to_string(words, '')) AS word_chars,
                   length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
                   coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines,
                   coalesce(n_repeat_words, 0) AS n_repeat_words,
                   len(words) < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * len(words)
                       AS base_failed
            FROM d LEFT JOIN r USING (k) LEFT JOIN l USING (k)),
        m AS ({_marks()}),
        a AS (
            SELECT doc_id, min(quality) = 1 AS good FROM labels
            GROUP BY doc_id HAVING min(quality) = max(quality)),
        h AS (
            SELECT k, lang, good, md5(doc_id::VARCHAR) < '8' AS proposes
            FROM c JOIN a USING (doc_id) WHERE NOT base_failed),
        strata AS (SELECT greatest(1, count(*)) AS n FROM (SELECT DISTINCT lang FROM h)),
        cells AS (
            SELECT lang, rule, last, mark, count(*) FILTER (good) AS good,
                   count(*) FILTER (NOT good) AS bad
            FROM h JOIN m USING (k) WHERE proposes GROUP BY ALL),
        sums AS (
            SELECT lang, rule, last, mark,
                   sum(good) OVER w AS good, sum(bad) OVER w AS bad,
                   sum(good) OVER v AS all_good, sum(bad) OVER v AS all_bad
            FROM cells
            WINDOW v AS (PARTITION BY lang, rule), w AS (PARTITION BY lang, rule ORDER BY mark)),
        gains AS (
            SELECT *, bad / nullif(all_bad, 0) - coalesce(good / nullif(all_good, 0), 0) AS gain,
                   {_tail("bad::BIGINT", "all_bad::BIGINT + 1", "all_bad")} AS chance
            FROM sums),
        best AS (
            SELECT gains.*, row_number() OVER (
                       PARTITION BY lang, rule ORDER BY gain DESC, mark) AS place
            FROM gains, strata
            WHERE mark <= last AND good * 2.0 <= all_good * {RISK} AND gain > 0
              AND chance <= {ERROR} / strata.n / {len(RULES)}),
        steps AS (
            SELECT lang, rule, mark AS cut,
                   row_number() OVER (PARTITION BY lang ORDER BY gain DESC, rule) AS step
            FROM best WHERE place = 1),
        held AS (
            SELECT k, lang, min(step) FILTER (m.mark <= cut) AS first
            FROM h JOIN steps USING (lang) JOIN m USING (k, rule)
            WHERE good AND NOT proposes GROUP BY ALL),
        tested AS (
            SELECT lang, step, rule, cut, count(*) AS n, count(*) FILTER (first <= step) AS x
            FROM held JOIN steps USING (lang) GROUP BY ALL),
        certified AS (
            SELECT lang, rule, cut FROM tested, strata
            WHERE {_tail("0", "x + 1", "tested.n")} <= {ERROR} / strata.n),
        failed AS (
            SELECT DISTINCT k
            FROM c JOIN m USING (k) JOIN certified s ON c.lang IS NOT DISTINCT FROM s.lang
                 AND m.rule = s.rule
            WHERE m.mark <= s.cut)
        SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
               n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
               n_repeat_words::BIGINT AS n_repeat_words, base_failed,
               NOT base_failed AND failed.k IS NULL AS kept
        FROM c LEFT JOIN failed USING (k)""",
    "op13_threshold_negatives": """
        WITH v AS (
            SELECT row_number() OVER () AS k, vec_id,
                   CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT a.k AS ak, b.k AS bk, a.vec_id AS anchor_id, b.vec_id AS other,
                   a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score
            FROM v a JOIN v b ON a.k <> b.k WHERE a.vec_id % 100 = 0),
        p AS (
            SELECT *, row_number() OVER (PARTITION BY ak ORDER BY score DESC, other, bk) AS place
            FROM s WHERE same),
        n AS (
            SELECT p.anchor_id, p.other AS positive_id, n.other AS negative_id,
                   p.score AS positive_score, n.score AS negative_score,
                   row_number() OVER (
                       PARTITION BY p.ak, p.bk ORDER BY n.score DESC, n.other, n.bk
                   )::INTEGER AS rank
            FROM p JOIN s n ON p.ak = n.ak AND NOT n.same
            WHERE p.place <= 5 AND 80 * p.score <= 100 * n.score AND n.score <= p.score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
        FROM n WHERE rank <= 5""",
}
