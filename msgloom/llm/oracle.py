"""DuckDB SQL of the queries that SQL can express, written from the contracts, not from the operators."""

from __future__ import annotations

from msgloom.llm.licenses import TEMPLATES

LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORD = r"[^\x20\x09-\x0D]+"

WARC = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS payload FROM pages
), q AS (
    SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, sha1(payload) AS payload_digest,
           max(page_id) OVER (PARTITION BY payload) AS last
    FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to
FROM q
"""

MIX = rf"""
WITH s AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
           ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 15))::BIGINT AS h
    FROM documents
), t AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM s GROUP BY source
), r AS (
    SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS w, 3 * source_size AS top FROM t
), l AS (
    SELECT *, row_number() OVER o AS turn,
        (sum(source_size) OVER () - coalesce(sum(top) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
        / (sum(w) OVER () - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS level
    FROM r WINDOW o AS (ORDER BY top::DOUBLE / w, source NULLS LAST)
), f AS (
    SELECT arg_min(level, turn) AS level FROM l WHERE level * w <= top
), g AS (
    SELECT source, source_size, least(top::DOUBLE, f.level * w) AS target FROM l, f
), b AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS passes FROM g
), c AS (
    SELECT s.*, b.source_size, b.target, b.passes, b.target - b.passes * b.source_size AS budget,
        sum(size) OVER (PARTITION BY s.source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS upto,
        sum(size) OVER (PARTITION BY s.source, h)::BIGINT AS own
    FROM s JOIN b ON s.source IS NOT DISTINCT FROM b.source
), k AS (
    SELECT *, CASE WHEN upto <= budget THEN TRUE
                   WHEN upto - own < budget THEN budget - (upto - own) > upto - budget ELSE FALSE END AS extra
    FROM c
)
SELECT doc_id, size, source_size, target, (size * (passes + extra::BIGINT))::BIGINT AS taken FROM k
"""

CONTAMINATION = rf"""
WITH d AS (
    SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), i AS (
    SELECT item_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), ia AS (
    SELECT item_id, w, least(10, len(w)) AS m, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS p
    FROM i WHERE len(w) > 0
), iw AS (
    SELECT DISTINCT item_id, m, array_to_string(list_slice(w, p, p + m - 1), ' ') AS win FROM ia
), da AS (
    SELECT doc_id, w, m, unnest(generate_series(1, len(w) - m + 1)) AS p
    FROM d, (SELECT DISTINCT m FROM ia) WHERE len(w) >= m
), dw AS (
    SELECT doc_id, m, p, array_to_string(list_slice(w, p, p + m - 1), ' ') AS win FROM da
), hit AS (
    SELECT dw.doc_id, dw.p, dw.m, iw.item_id FROM dw JOIN iw ON dw.m = iw.m AND dw.win = iw.win
), covered AS (
    SELECT doc_id, count(DISTINCT place) AS n
    FROM (SELECT doc_id, unnest(generate_series(p, p + m - 1)) AS place FROM hit) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(covered.n, 0)::BIGINT AS n_hit,
       coalesce(named.n, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(covered.n, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

QUALITY = rf"""
WITH a AS (
    SELECT doc_id, lang, source, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), g AS (
    SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM (
        SELECT doc_id, p, array_to_string(list_slice(w, p, p + 7), ' ') AS gram
        FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 7)) AS p FROM a WHERE len(w) >= 8))
), rep AS (
    SELECT doc_id, count(DISTINCT place) AS n
    FROM (SELECT doc_id, unnest(generate_series(p, p + 7)) AS place FROM g WHERE n > 1) GROUP BY doc_id
), b AS (
    SELECT a.doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
           (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
           len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
           coalesce(rep.n, 0)::BIGINT AS n_repeat_words
    FROM a LEFT JOIN rep USING (doc_id)
), m AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
           n_symbols * 10000 // greatest(word_chars, 1) AS symbols, n_dup_lines * 10000 // greatest(n_lines, 1) AS dup_lines,
           n_repeat_words * 10000 // greatest(n_words, 1) AS repeats, word_chars * 100 // greatest(n_words, 1) AS mean_length
    FROM b
), e AS (
    SELECT lang, source, measure, v - v % (1::BIGINT << greatest(length(bin(v)) - 7, 0)) AS bin
    FROM (SELECT lang, source, unnest(['symbols', 'dup_lines', 'repeats', 'mean_length']) AS measure,
                 unnest([symbols, dup_lines, repeats, mean_length]) AS v FROM m WHERE NOT base_failed)
), q1 AS (
    SELECT lang, source, measure, max(n) AS n, min(bin) FILTER (4 * i >= n) AS q1, min(bin) FILTER (4 * i >= 3 * n) AS q3,
           min(bin) FILTER (100 * i >= 99 * n) AS top
    FROM (SELECT *, row_number() OVER (w ORDER BY bin) AS i, count(*) OVER w AS n FROM e WINDOW w AS (PARTITION BY lang, source, measure))
    GROUP BY ALL
), q2 AS (
    SELECT lang, measure, max(n) AS n, min(bin) FILTER (4 * i >= n) AS q1, min(bin) FILTER (4 * i >= 3 * n) AS q3,
           min(bin) FILTER (100 * i >= 99 * n) AS top
    FROM (SELECT *, row_number() OVER (w ORDER BY bin) AS i, count(*) OVER w AS n FROM e WINDOW w AS (PARTITION BY lang, measure))
    GROUP BY ALL
), q3 AS (
    SELECT measure, max(n) AS n, min(bin) FILTER (4 * i >= n) AS q1, min(bin) FILTER (4 * i >= 3 * n) AS q3,
           min(bin) FILTER (100 * i >= 99 * n) AS top
    FROM (SELECT *, row_number() OVER (w ORDER BY bin) AS i, count(*) OVER w AS n FROM e WINDOW w AS (PARTITION BY measure))
    GROUP BY ALL
), f AS (
    SELECT q1.lang, q1.source, q1.measure,
           CASE WHEN q1.n >= 100 THEN q1.q1 WHEN q2.n >= 100 THEN q2.q1 ELSE q3.q1 END AS low,
           CASE WHEN q1.n >= 100 THEN q1.q3 WHEN q2.n >= 100 THEN q2.q3 ELSE q3.q3 END AS high,
           CASE WHEN q1.n >= 100 THEN q1.top WHEN q2.n >= 100 THEN q2.top ELSE q3.top END AS top
    FROM q1 JOIN q2 ON q1.lang IS NOT DISTINCT FROM q2.lang AND q1.measure = q2.measure JOIN q3 ON q1.measure = q3.measure
), h AS (
    SELECT lang, source,
           max(CASE measure WHEN 'symbols' THEN high + greatest(3 * (high - low), 300) END) AS top_symbols,
           max(CASE measure WHEN 'dup_lines' THEN top + 1000 END) AS top_dup_lines,
           max(CASE measure WHEN 'repeats' THEN top + 500 END) AS top_repeats,
           max(CASE measure WHEN 'mean_length' THEN high + greatest(3 * (high - low), 400) END) AS top_length,
           max(CASE measure WHEN 'mean_length' THEN low - greatest(3 * (high - low), 150) END) AS low_length
    FROM f GROUP BY lang, source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(symbols <= top_symbols AND (dup_lines <= top_dup_lines OR n_dup_lines <= 3) AND (repeats <= top_repeats OR n_repeat_words <= 16)
           AND mean_length BETWEEN low_length AND top_length, TRUE) AS kept
FROM m LEFT JOIN h ON m.lang IS NOT DISTINCT FROM h.lang AND m.source IS NOT DISTINCT FROM h.source
"""


def _notices() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    return ", ".join(f"({quoted(name)}, {quoted(text)})" for name, texts in TEMPLATES.items() for text in texts)


LICENSES = f"""
WITH n AS (
    SELECT license, row_number() OVER () AS notice, regexp_extract_all({LOWER.format("text")}, '[0-9a-z]+') AS w
    FROM (VALUES {_notices()}) AS v(license, text)
), ns AS (
    SELECT DISTINCT license, notice, array_to_string(list_slice(w, p, p + 4), ' ') AS s
    FROM (SELECT *, unnest(generate_series(1, len(w) - 4)) AS p FROM n WHERE len(w) >= 5)
), d AS (
    SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[0-9a-z]+') AS w FROM documents
), dg AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(w, p, p + 4), ' ') AS s
    FROM (SELECT *, unnest(generate_series(1, len(w) - 4)) AS p FROM d WHERE len(w) >= 5)
), size AS (
    SELECT notice, count(*) AS n FROM ns GROUP BY notice
), met AS (
    SELECT doc_id, license, count(*)::DOUBLE / any_value(n) AS share
    FROM dg JOIN ns USING (s) JOIN size USING (notice) GROUP BY doc_id, license, notice
), found AS (
    SELECT doc_id, count(DISTINCT license) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS names, max(share) AS share
    FROM met WHERE share >= 0.8 GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_licenses, coalesce(names, '') AS licenses, share AS containment
FROM d LEFT JOIN found USING (doc_id)
"""

PHRASES = rf"""
WITH p AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), w AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p
), t AS (
    SELECT lang, sum(len(w))::HUGEINT AS n FROM w GROUP BY lang
), g AS (
    SELECT lang, m::INT AS m, array_to_string(list_slice(w, pos, pos + m - 1), ' ') AS phrase
    FROM (SELECT lang, w, m, unnest(generate_series(1, len(w) - m + 1)) AS pos FROM w, range(1, 6) AS r(m) WHERE len(w) >= m)
), f AS (
    SELECT lang, m, phrase, string_split(phrase, ' ') AS w, count(*)::HUGEINT AS f FROM g GROUP BY lang, m, phrase HAVING count(*) >= 100
), c AS (
    SELECT lang, m, phrase, w, f AS a, unnest(generate_series(1, m - 1)) AS k FROM f WHERE m > 1
), s AS (
    SELECT c.lang, c.m, c.phrase, c.a, c.k, x.f AS l, y.f AS r, t.n, (1000 * c.a * t.n) // (x.f * y.f) AS score
    FROM c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(list_slice(c.w, 1, k), ' ')
    JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(list_slice(c.w, k + 1, c.m), ' ')
    JOIN t ON t.lang = c.lang
), b AS (
    SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
    SELECT DISTINCT lang, f, array_to_string(list_slice(w, pos, pos + size - 1), ' ') AS phrase
    FROM (SELECT lang, f, w, size, unnest(generate_series(1, m - size + 1)) AS pos FROM f, range(2, 5) AS q(size) WHERE m > size)
), kept AS (
    SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = b.lang AND i.phrase = b.phrase AND 100 * i.f >= 100 * b.a)
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""

#: crc32 byte by byte from its table, which follows from the polynomial.
SPELLING = rf"""
WITH RECURSIVE step AS (
    SELECT i, i AS v, 0 AS round FROM range(256) AS t(i)
    UNION ALL
    SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, round + 1 FROM step WHERE round < 8
), crc AS (
    SELECT list(v ORDER BY i) AS tab FROM step WHERE round = 8
), runs AS (
    SELECT doc_id, unnest(regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents
), each AS (
    SELECT doc_id, run, count(*) AS n, encode(coalesce(doc_id::VARCHAR, '') || ':' || run) AS bytes FROM runs GROUP BY doc_id, run
), hexed AS (
    SELECT run, n, hex(bytes) AS x, octet_length(bytes) AS size FROM each
), hashed AS (
    SELECT run, n, xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(range(0, size), lambda i: ('0x' || substr(x, (2 * i + 1)::INT, 2))::BIGINT)),
        lambda h, b: xor(h >> 8, tab[(xor(h, b) & 255) + 1])), 4294967295) AS h
    FROM hexed, crc
), dropped AS (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n
    FROM hashed
), words AS (
    SELECT word, sum(n)::BIGINT AS n FROM dropped WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), less AS (
    SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
    FROM (SELECT word, n, unnest(generate_series(1, length(word)))::INT AS i FROM words)
), near AS (
    SELECT a.word, b.word AS other, b.n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND length(a.word) = length(b.word) AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
), best AS (
    SELECT word, count(*) AS n_near, max(n) AS n FROM near GROUP BY word
), formed AS (
    SELECT w.word, w.n, coalesce(b.n_near, 0)::BIGINT AS n_near,
           CASE WHEN b.n >= 2 * w.n THEN (SELECT min(other) FROM near x WHERE x.word = w.word AND x.n = b.n) END AS form,
           CASE WHEN b.n >= 2 * w.n THEN b.n END AS form_n
    FROM words w LEFT JOIN best b USING (word)
), way AS (
    SELECT word, form AS last FROM formed WHERE form IS NOT NULL
    UNION ALL
    SELECT way.word, f.form FROM way JOIN formed f ON f.word = way.last WHERE f.form IS NOT NULL
), ends AS (
    SELECT way.word, way.last FROM way JOIN formed f ON f.word = way.last WHERE f.form IS NULL
)
SELECT f.word, f.form, coalesce(ends.last, f.word) AS root, f.n, f.n_near, f.form_n FROM formed f LEFT JOIN ends USING (word)
"""

ORACLE: dict[str, str] = {
    "op4_warc": WARC,
    "op5_licenses": LICENSES,
    "op6_quality": QUALITY,
    "op7_decontamination": CONTAMINATION,
    "op8_source_mix": MIX,
    "op11_phrases": PHRASES,
    "op12_spelling": SPELLING,
}
