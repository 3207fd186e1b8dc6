"""The operators that SQL can express, as DuckDB statements over the same tables, written apart from the operators."""

from __future__ import annotations

OP3 = r"""
WITH docs AS MATERIALIZED (
    SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text, coalesce(source, '') AS owner,
           concat_ws('/', source, lang) AS repository
    FROM documents
), patterns(rank, pattern, part, least) AS (
    VALUES (0, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]'
            || '|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
           (1, 'AKIA[A-Z0-9]+', 0, 20),
           (2, '[0-9a-f]+', 0, 24),
           (3, '[A-Za-z0-9+/_=-]{20,}', 0, 20)
), pieces AS (
    SELECT row, rank, least,
           CASE rank WHEN 0 THEN string_split_regex(text, (SELECT pattern FROM patterns WHERE rank = 0))
                     WHEN 1 THEN string_split_regex(text, 'AKIA[A-Z0-9]+')
                     WHEN 2 THEN string_split_regex(text, '[0-9a-f]{24,}')
                     ELSE string_split_regex(text, '[A-Za-z0-9+/_=-]{20,}') END AS gaps,
           CASE rank WHEN 0 THEN regexp_extract_all(text, (SELECT pattern FROM patterns WHERE rank = 0), 0)
                     WHEN 1 THEN regexp_extract_all(text, 'AKIA[A-Z0-9]+')
                     WHEN 2 THEN regexp_extract_all(text, '[0-9a-f]{24,}')
                     ELSE regexp_extract_all(text, '[A-Za-z0-9+/_=-]{20,}') END AS hits,
           CASE rank WHEN 0 THEN regexp_extract_all(text, (SELECT pattern FROM patterns WHERE rank = 0), 2) END AS vals
    FROM docs, patterns
), numbered AS (
    SELECT row, rank, least, gaps, hits, vals, unnest(range(1, len(hits) + 1)) AS i FROM pieces
), placed AS (
    SELECT row, rank, least, coalesce(vals[i], hits[i]) AS value, length(hits[i]) AS size,
           list_sum(list_transform(gaps[1:i], lambda x: length(x))) + list_sum(list_transform(hits[1:i], lambda x: length(x)))
               AS stop
    FROM numbered
), likely AS (
    SELECT *, stop - size AS start,
           len(list_distinct(regexp_extract_all(value, '(?s).'))) >= 8 AND regexp_matches(value, '[0-9]')
               AND regexp_matches(value, '[A-Za-z]') AS random
    FROM placed WHERE length(value) >= least
), candidates AS (
    SELECT * FROM likely WHERE rank < 3 OR (random AND NOT regexp_full_match(value, '[0-9a-f]+'))
), owned AS (
    SELECT value, count(DISTINCT owner) AS owners, count(DISTINCT repository) AS repositories,
           count(DISTINCT owner) >= 3 OR (count(DISTINCT owner) = 2 AND count(DISTINCT repository) >= 5) AS copied
    FROM candidates JOIN docs USING (row) GROUP BY value
), judged AS (
    SELECT row, rank, start, stop, owners, repositories, copied, random AND NOT copied AS live,
           (['assign', 'access', 'hex', 'live'])[rank + 1] || ':' || start || ':' || stop AS span
    FROM candidates JOIN owned USING (value)
), kept AS (
    SELECT * FROM judged WHERE rank < 3 OR live
), per_row AS (
    SELECT row, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access,
           count(*) FILTER (rank = 2) AS n_hex,
           string_agg(span, ',' ORDER BY start, rank) FILTER (rank < 3) AS base,
           string_agg(span, ',' ORDER BY start, rank) AS spans,
           count(*) FILTER (live) AS n_live, count(*) FILTER (copied) AS n_copied,
           string_agg(owners, ',' ORDER BY start, rank) AS span_owners,
           string_agg(repositories, ',' ORDER BY start, rank) AS span_repositories
    FROM kept GROUP BY row
)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_live, 0)::BIGINT AS n_live, coalesce(n_copied, 0)::BIGINT AS n_copied,
       coalesce(span_owners, '') AS span_owners, coalesce(span_repositories, '') AS span_repositories
FROM docs LEFT JOIN per_row USING (row)
"""

OP4 = r"""
WITH rests AS (
    SELECT page_id, CASE WHEN coalesce(strpos(url, '://'), 0) = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest
    FROM pages
), split AS (
    SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw_host,
           regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
    FROM rests
), parts AS (
    SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM split
), ruled AS (
    SELECT *, CASE
        WHEN ends_with('.' || host, '.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
        WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
        WHEN ends_with('.' || host, '.net') AND starts_with(path, '/es/') THEN 'net/es/'
        WHEN ends_with('.' || host, '.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
        WHEN ends_with('.' || host, '.com') AND starts_with(path, '/') THEN 'com/' END AS rule
    FROM parts
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN (contains(host, 'spam') OR contains(host, 'casino') OR contains(host, 'pills')) AND starts_with(path, '/') THEN 'block'
    WHEN ends_with(path, '/wp-login.php') OR contains(path, '/cgi-bin/') THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
"""

OP6 = r"""
WITH sizes AS MATERIALIZED (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), by_source AS (
    SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_docs,
           row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
    FROM sizes GROUP BY source
), weighed AS (
    SELECT *, ([5, 2, 1])[rank % 3 + 1] AS weight, 2 * source_size AS cap,
           sum(source_size) OVER ()::BIGINT AS total
    FROM by_source
), ordered AS (
    SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
               ::BIGINT AS used,
           sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS open
    FROM weighed
), levels AS (
    SELECT rank, cap / weight AS reach, (1.5::DOUBLE * total - used) / open AS level FROM ordered
), chosen AS (
    SELECT coalesce(first(level ORDER BY reach, rank) FILTER (level <= reach), 0)::DOUBLE AS level FROM levels
), sources AS MATERIALIZED (
    SELECT w.*, least(cap::DOUBLE, level * weight) AS target,
           ceil((source_size + n_docs) / 4000000)::BIGINT AS shards
    FROM weighed w, chosen
), seats AS (
    SELECT rank, row_number() OVER (ORDER BY target / (2 * seat - 1) DESC, rank) AS place, total
    FROM (SELECT rank, target, total, unnest(range(1, (target / 8)::BIGINT + 3)) AS seat FROM sources WHERE target > 0)
), blocks AS (
    SELECT rank, count(*) AS blocks FROM seats WHERE place <= round(total * 1.5::DOUBLE / 8) GROUP BY rank
), placed AS MATERIALIZED (
    SELECT doc_id, size, source_size, target, rank,
           ('0x' || substr(md5('20|shard|' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT % shards AS shard,
           ('0x' || substr(md5('20|order|' || coalesce(doc_id::VARCHAR, 'null') || '|' || size), 1, 15))::BIGINT AS place
    FROM sizes JOIN sources ON sizes.source IS NOT DISTINCT FROM sources.source
), shard_sizes AS (
    SELECT p.rank, p.shard, sum(p.size)::BIGINT AS shard_size, any_value(coalesce(b.blocks, 0)) AS blocks
    FROM placed p LEFT JOIN blocks b USING (rank) GROUP BY p.rank, p.shard
), shard_seats AS (
    SELECT rank, shard, blocks, row_number() OVER (PARTITION BY rank ORDER BY shard_size / (2 * seat - 1) DESC, shard) AS place
    FROM (SELECT *, unnest(range(1, blocks + 1)) AS seat FROM shard_sizes WHERE shard_size > 0)
), quotas AS (
    SELECT rank, shard, count(*) AS quota FROM shard_seats WHERE place <= blocks GROUP BY rank, shard
), parts AS (
    SELECT rank, shard, ceil(shard_size / 8)::BIGINT AS held, greatest(ceil(shard_size / 8)::BIGINT, 1) AS d,
           least(coalesce(quota, 0), 2 * ceil(shard_size / 8)::BIGINT) AS quota,
           ('0x' || substr(md5('20|start|' || rank || '|' || shard), 1, 15))::BIGINT % greatest(ceil(shard_size / 8)::BIGINT, 1)
               AS start
    FROM shard_sizes LEFT JOIN quotas USING (rank, shard)
), laid AS (
    SELECT *, sum(size) OVER (PARTITION BY rank, shard ORDER BY place, doc_id ROWS UNBOUNDED PRECEDING)::BIGINT AS stop
    FROM placed
), counted AS (
    SELECT doc_id, size, source_size, target,
           ((stop // 8) * quota + start) // d * 8
               + (stop % 8) * (((stop // 8 + 1) * quota + start) // d - ((stop // 8) * quota + start) // d)
           - ((stop - size) // 8 * quota + start) // d * 8
               - ((stop - size) % 8)
                   * ((((stop - size) // 8 + 1) * quota + start) // d - ((stop - size) // 8 * quota + start) // d) AS taken
    FROM laid JOIN parts USING (rank, shard)
)
SELECT doc_id, size, source_size, target, CASE WHEN size > 0 THEN taken ELSE 0 END::BIGINT AS taken FROM counted
"""


OP12 = r"""
WITH pieces AS MATERIALIZED (
    SELECT row_number() OVER () AS piece, lang, regexp_extract_all(text, '[^\x20\x09]+') AS words
    FROM (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[.,;:!?\x0A-\x0D]')) AS text
        FROM documents
    )
), sized AS MATERIALIZED (
    SELECT lang, words, unnest([1, 2, 3, 4]) AS k FROM pieces WHERE len(words) > 0
), phrases AS MATERIALIZED (
    SELECT lang, k, phrase, count(*)::BIGINT AS f
    FROM (
        SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase
        FROM (SELECT lang, k, words, unnest(range(1, len(words) - k + 2)) AS i FROM sized)
    )
    GROUP BY lang, k, phrase
), totals AS (
    SELECT lang, sum(f)::BIGINT AS n FROM phrases WHERE k = 1 GROUP BY lang
), candidates AS MATERIALIZED (
    SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS words FROM phrases WHERE k > 1 AND f >= 30
), cuts AS (
    SELECT lang, k, phrase, a, array_to_string(words[1:c], ' ') AS head, array_to_string(words[c + 1:k], ' ') AS rest, c
    FROM (SELECT *, unnest(range(1, k)) AS c FROM candidates)
), scored AS (
    SELECT c.lang, c.phrase, c.a, h.f AS l, t.f AS r, c.c,
           ((2000000::HUGEINT * c.a) // (h.f::HUGEINT + t.f))::BIGINT AS score
    FROM cuts c JOIN phrases h ON h.lang = c.lang AND h.phrase = c.head AND h.k = c.c
                JOIN phrases t ON t.lang = c.lang AND t.phrase = c.rest AND t.k = c.k - c.c
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
), inside AS (
    SELECT lang, array_to_string(words[i:i + m - 1], ' ') AS phrase, max(a) AS longer
    FROM (
        SELECT lang, a, words, m, unnest(range(1, k - m + 2)) AS i
        FROM (SELECT lang, a, words, k, unnest(range(2, k)) AS m FROM candidates WHERE k > 2)
    )
    GROUP BY 1, 2
), ranked AS (
    SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase) AS rank,
           s.phrase, s.a, s.l, s.r, t.n, s.score
    FROM lowest s JOIN totals t ON t.lang = s.lang LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase
    WHERE i.longer IS NULL OR 100::HUGEINT * i.longer < 80::HUGEINT * s.a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""

OP13 = r"""
WITH docs AS MATERIALIZED (
    SELECT row_number() OVER () AS doc, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), corpus AS (
    SELECT count(*)::BIGINT AS docs, sum(len(terms))::BIGINT AS length FROM docs WHERE len(terms) > 0
), counts AS MATERIALIZED (
    SELECT doc, term, count(*)::BIGINT AS tf FROM (SELECT doc, unnest(terms) AS term FROM docs) GROUP BY doc, term
), weights AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM counts, corpus GROUP BY term, docs
), asked AS (
    SELECT item, item_id, term, count(*)::BIGINT AS times
    FROM (
        SELECT row_number() OVER () AS item, item_id,
               unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark
    )
    GROUP BY ALL
), scores AS (
    SELECT a.item, a.item_id, c.doc, d.doc_id,
           sum(a.times * w.w * ((1000000000 * c.tf) // (1000 * c.tf + 12 * (100 - 25 + ((25 * len(d.terms) * docs) // length)))))::BIGINT
               AS score
    FROM asked a JOIN weights w USING (term) JOIN counts c USING (term) JOIN docs d ON d.doc = c.doc, corpus
    GROUP BY ALL
)
SELECT item_id, rank, doc_id, score
FROM (
    SELECT item_id, doc_id, score,
           row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
    FROM scores WHERE score > 0
)
WHERE rank <= 20
"""


def llm_statements() -> dict[str, str]:
    return {
        "op3_secret_scans": OP3,
        "op4_url_filters": OP4,
        "op6_mixing": OP6,
        "op12_collocations": OP12,
        "op13_ranked_search": OP13,
    }
