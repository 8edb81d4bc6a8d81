"""SQL that says what the event clustering computes, for checking it on the same tables.

The subsequence ratio is bit-parallel in 128-bit numbers, the greedy pass over articles in time order a recursion of one row.
"""

from __future__ import annotations

from lontar.functions import text

_LIST = "({})".format(", ".join(f"'{w}'" for w in text.GENERIC_ANCHORS))
_STOP = "({})".format(", ".join(f"'{w}'" for w in text.STOPWORDS))


def _words(column: str) -> str:
    return f"list_filter(string_split(trim(regexp_replace(lower(strip_accents(coalesce({column}, ''))), '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: len(w) >= 3 AND w NOT IN {_STOP})"


def _first(column: str) -> str:
    return f"list_filter({column}, lambda x, i: list_position({column}, x) = i)"


def pairs(hours: int) -> str:
    """The common table expressions up to ``pairs`` (later, earlier, a, p, first_pos, wj, accepted, score), ``docs`` and ``marks``."""
    return f"""WITH RECURSIVE w AS (SELECT article_id AS id, source_id, title, epoch_us(collected_at) // 1000 AS ms, CAST(article_id AS VARCHAR) AS sid, {_words("title")} AS t0, {_words("summary")} AS s0 FROM articles WHERE collected_at >= (SELECT max(collected_at) FROM articles) - INTERVAL {hours} HOUR),
 d1 AS (SELECT *, {_first("t0")} AS t, list_concat(t0, s0) AS c FROM w), docs AS (SELECT id, source_id, title, ms, sid, t, {_first("c")} AS every, array_to_string(t, ' ') AS joined FROM d1),
 tok AS (SELECT id, unnest(every) AS token, generate_subscripts(every, 1) - 1 AS pos FROM docs), df AS (SELECT token, count(*) AS df FROM tok GROUP BY token),
 marks AS (SELECT tok.id, tok.token, tok.pos FROM tok JOIN df USING (token) WHERE df <= greatest(40, floor((SELECT count(*) FROM docs) * 0.025)) AND token NOT IN {_LIST}),
 ph AS (SELECT DISTINCT id, unnest(list_transform(list_zip(t[:-2], t[2:]), lambda z: z[1] || ' ' || z[2])) AS token FROM docs WHERE len(t) >= 2), pf AS (SELECT token FROM ph GROUP BY token HAVING count(*) <= 12),
 phrases AS (SELECT id, token FROM ph JOIN pf USING (token) WHERE len(list_filter(string_split(token, ' '), lambda x: x IN {_LIST})) = 0),
 near AS (SELECT x.id AS later, y.id AS earlier FROM docs x JOIN docs y ON (y.ms < x.ms OR (y.ms = x.ms AND y.sid < x.sid)) AND x.ms - y.ms <= 36 * 3600000),
 sa AS (SELECT later, earlier, count(*) AS a, min(x.pos) AS first_pos FROM near JOIN marks x ON x.id = later JOIN marks y ON y.id = earlier AND y.token = x.token GROUP BY 1, 2),
 sp AS (SELECT later, earlier, count(*) AS p FROM near JOIN phrases x ON x.id = later JOIN phrases y ON y.id = earlier AND y.token = x.token GROUP BY 1, 2),
 tw AS (SELECT tok.id, token, 1.0::DOUBLE / log2(df + 1.0) AS w FROM tok JOIN df USING (token)), tot AS (SELECT id, sum(w) AS s FROM tw GROUP BY id),
 cm AS (SELECT later, earlier, sum(x.w) AS common FROM sa JOIN tw x ON x.id = later JOIN tw y ON y.id = earlier AND y.token = x.token GROUP BY 1, 2),
 j AS (SELECT sa.later, sa.earlier, a, coalesce(p, 0) AS p, first_pos, round(common / (t1.s + t2.s - common), 12) AS wj, dx.joined AS jx, dy.joined AS jy FROM sa JOIN cm ON cm.later = sa.later AND cm.earlier = sa.earlier LEFT JOIN sp ON sp.later = sa.later AND sp.earlier = sa.earlier
 JOIN tot t1 ON t1.id = sa.later JOIN tot t2 ON t2.id = sa.earlier JOIN docs dx ON dx.id = sa.later JOIN docs dy ON dy.id = sa.earlier),
 b AS (SELECT *, ((a >= 2 AND wj >= 0.35) OR (p >= 1 AND wj >= 0.22)) AS by_words FROM j),
 bits AS (SELECT later, earlier, len(jx) AS n, list_transform(string_split(jy, ''), lambda c: list_sum(list_transform(range(len(jx)), lambda i: CASE WHEN substr(jx, CAST(i + 1 AS INTEGER), 1) = c THEN 1::HUGEINT << CAST(i AS INTEGER) ELSE 0::HUGEINT END))::HUGEINT) AS masks, (1::HUGEINT << CAST(len(jx) AS INTEGER)) - 1 AS whole FROM b WHERE (by_words OR a >= 3) AND jx <> '' AND jy <> ''),
 l AS (SELECT later, earlier, n - bit_count(list_reduce(masks, lambda v, m: (((v + (v & m)) | (v - (v & m))) & whole), whole)) AS common_letters FROM bits),
 r AS (SELECT b.*, CASE WHEN by_words OR a >= 3 THEN CASE WHEN jx = jy THEN 1.0 ELSE coalesce(2.0::DOUBLE * common_letters / (len(jx) + len(jy)), 0.0) END END AS lcs FROM b LEFT JOIN l ON l.later = b.later AND l.earlier = b.earlier),
 pairs AS (SELECT later, earlier, a, p, first_pos, wj, lcs, coalesce(by_words OR (a >= 3 AND lcs >= 0.72), false) AS accepted, CASE WHEN by_words OR (a >= 3 AND lcs >= 0.72) THEN round(least(1.0, 0.55 * wj + 0.25 * lcs + 0.20 * least(a, 5) / 5), 10) END AS score FROM r)"""


def assigned(hours: int) -> str:
    """``pairs``, then ``assigned`` (id, seed, score): every article with its seed."""
    return pairs(hours) + """, o AS (SELECT d.id, row_number() OVER (ORDER BY d.ms, d.sid) AS k, coalesce(list(e.earlier) FILTER (e.earlier IS NOT NULL), []) AS before FROM docs d LEFT JOIN (SELECT later, earlier FROM pairs WHERE accepted) e ON e.later = d.id GROUP BY d.id, d.ms, d.sid),
 pass AS (SELECT 0::BIGINT AS k, []::BIGINT[] AS seeds UNION ALL SELECT pass.k + 1, CASE WHEN list_has_any(o.before, pass.seeds) THEN pass.seeds ELSE list_append(pass.seeds, o.id) END FROM pass JOIN o ON o.k = pass.k + 1),
 seeds AS (SELECT unnest(seeds) AS id FROM pass WHERE k = (SELECT max(k) FROM pass)),
 best AS (SELECT p.later AS id, p.earlier AS seed, p.score, row_number() OVER (PARTITION BY p.later ORDER BY p.score DESC, p.first_pos, d.ms, d.sid) AS n FROM pairs p JOIN seeds s ON s.id = p.earlier JOIN docs d ON d.id = p.earlier WHERE p.accepted AND p.later NOT IN (SELECT id FROM seeds)),
 assigned AS (SELECT id, id AS seed, 1.0::DOUBLE AS score FROM seeds UNION ALL SELECT id, seed, score FROM best WHERE n = 1)"""


def events(hours: int) -> str:
    """``assigned``, then ``events``: one row for each cluster of two sources and more."""
    return assigned(hours) + """, m AS (SELECT a.seed, d.* FROM assigned a JOIN docs d USING (id)),
 roll AS (SELECT seed, count(*) AS article_count, count(DISTINCT source_id) AS media_count, min(ms) AS first_ms, max(ms) AS last_ms FROM m GROUP BY seed HAVING count(DISTINCT source_id) >= 2),
 tt AS (SELECT m.seed, m.id, unnest(m.t) AS token FROM m JOIN roll USING (seed)), tc AS (SELECT seed, token, count(*) - 1 AS others FROM tt GROUP BY 1, 2),
 central AS (SELECT m.seed, m.id, m.title, m.ms, m.sid, coalesce(sum(others), 0) AS c FROM m JOIN roll USING (seed) LEFT JOIN tt ON tt.seed = m.seed AND tt.id = m.id LEFT JOIN tc ON tc.seed = tt.seed AND tc.token = tt.token GROUP BY ALL),
 title AS (SELECT seed, title AS representative_title FROM (SELECT *, row_number() OVER (PARTITION BY seed ORDER BY c DESC, ms, sid) AS n FROM central) WHERE n = 1),
 firsts AS (SELECT m.seed, k.token, row_number() OVER (PARTITION BY m.seed, k.token ORDER BY m.ms, m.sid, k.pos) AS n, m.ms, m.sid, k.pos FROM marks k JOIN m ON m.id = k.id),
 ranked AS (SELECT seed, token, row_number() OVER (PARTITION BY seed ORDER BY ms, sid, pos, token) AS n FROM firsts WHERE n = 1),
 terms AS (SELECT seed, string_agg(token, ' ' ORDER BY n) AS anchor_terms FROM ranked WHERE n <= 12 GROUP BY seed),
 events AS (SELECT roll.*, representative_title, coalesce(anchor_terms, '') AS anchor_terms, round(10 * media_count + log2(greatest(1, article_count)), 4) AS coverage_score FROM roll JOIN title USING (seed) LEFT JOIN terms USING (seed))"""
