"""DuckDB statements for the corpus queries that SQL can express."""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_LEDGER = rf"""
d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
             {_WORDS} AS w,
             list_filter(string_split(coalesce(text, ''), chr(10)),
                         lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
      FROM documents),
win AS (SELECT rid, i, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] AS k
        FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM win)
        WHERE c > 1),
cov AS (SELECT rid, count(*) AS n FROM (SELECT DISTINCT rid, unnest([i, i + 1, i + 2]) AS p FROM dup)
        GROUP BY rid),
m AS (SELECT d.rid, doc_id, t, len(w)::BIGINT AS n_words,
             length(array_to_string(w, ''))::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             len(lines)::BIGINT AS n_lines,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
             (length(t) - length(regexp_replace(t, '\p{{Lu}}', '', 'g')))::BIGINT AS n_upper
      FROM d LEFT JOIN cov ON cov.rid = d.rid),
ledger AS (SELECT *,
             (CASE WHEN n_words < 50 THEN 1 ELSE 0 END
              + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
              + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
              + CASE WHEN 100 * n_upper > 30 * word_chars THEN 8 ELSE 0 END
              + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 16 ELSE 0 END
              + CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END
              + CASE WHEN word_chars < 2 * n_words THEN 64 ELSE 0 END)::BIGINT AS fail_bits
           FROM m)
"""

_MIX = rf"""
d AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS size FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS n FROM s0),
s2 AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][1 + n % 3] AS w,
              source_size * 2.0::DOUBLE AS lim FROM s1),
s3 AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
                  - coalesce(sum(lim) OVER (ORDER BY lim / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                 / sum(w) OVER (ORDER BY lim / w, n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev
       FROM s2),
s4 AS (SELECT *, max(CASE WHEN lev * w <= lim THEN lev END) OVER () AS common FROM s3),
t AS (SELECT source, source_size, least(lim, coalesce(common * w, lim)) AS target,
             CAST('0x' || substr(md5(coalesce('mix:' || source, '')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u
      FROM s4),
r AS (SELECT d.*, t.source_size, t.target, t.u,
             CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
             row_number() OVER (PARTITION BY d.source ORDER BY size, md5(coalesce(doc_id::VARCHAR, '')), doc_id) AS k
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
mix AS (SELECT *, (floor(rate * k + u) - floor(rate * (k - 1) + u))::BIGINT AS copies FROM r)
"""

_TERM = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

_SEARCH = rf"""
d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERM} AS w FROM documents),
i AS (SELECT row_number() OVER () AS iid, item_id, unnest({_TERM}) AS term FROM benchmark),
it AS (SELECT iid, item_id, term, count(*)::BIGINT AS mult FROM i GROUP BY ALL),
s AS (SELECT count(*)::BIGINT AS docs, sum(len(w))::BIGINT AS total FROM d WHERE len(w) > 0),
tf AS (SELECT rid, doc_id, n, term, count(*)::BIGINT AS tf
       FROM (SELECT rid, doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM d)
       WHERE term IN (SELECT term FROM it) GROUP BY ALL),
wt AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
       FROM (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term), s),
c AS (SELECT rid, doc_id, tf.term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total))) AS v
      FROM tf JOIN wt ON wt.term = tf.term, s),
sc AS (SELECT iid, item_id, rid, doc_id, sum(v * mult)::BIGINT AS score FROM c JOIN it ON it.term = c.term
       GROUP BY ALL HAVING sum(v * mult) > 0)
"""

ORACLE_SQL = {
    "op12_lexical_search": f"""WITH {_SEARCH}
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM sc)
WHERE rank <= 20""",
    "op10_quality_rules": f"""WITH {_LEDGER}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept, n_lines, n_upper, fail_bits
FROM ledger""",
    "op8_systematic_mix": f"""WITH {_MIX}
SELECT doc_id, size, source_size, target, copies * size AS taken, copies, source FROM mix""",
}
