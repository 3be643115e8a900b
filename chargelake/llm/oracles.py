"""DuckDB SQL of the queries that SQL can express on whole tables.

Not expressed: 3 and 12 (tokenizers), 4 (XXH64), 5 and 9 (learned models), the pipeline. Tests
hold brute-force versions of those.
"""

from html import unescape
from html.entities import html5
from itertools import chain

_WORD = r"'[^\x20\x09-\x0D]+'"

_OP1 = rf"""
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(text, {_WORD}), []) AS words FROM documents),
starts AS (SELECT doc_id, unnest(generate_series(1, len(words) - 34)) AS i, words FROM w
           WHERE len(words) >= 35),
keyed AS (SELECT doc_id, i, md5(array_to_string(words[i:i + 34], ' ')) AS k FROM starts),
again AS (SELECT k FROM keyed GROUP BY k HAVING count(*) > 1),
hits AS (SELECT doc_id, i FROM keyed WHERE k IN (SELECT k FROM again)),
each AS (SELECT doc_id, unnest(words) AS word, unnest(generate_series(1, len(words))) AS i FROM w),
marked AS (SELECT e.doc_id, e.word, e.i, coalesce(max(CASE WHEN h.i IS NULL THEN 0 ELSE 1 END) OVER (
             PARTITION BY e.doc_id ORDER BY e.i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW), 0) AS gone
           FROM each e LEFT JOIN hits h ON e.doc_id = h.doc_id AND e.i = h.i),
kept AS (SELECT doc_id, sum(gone)::BIGINT AS n_removed,
                coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0), '') AS rest
         FROM marked GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(rest, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""

_OP2 = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
good AS (SELECT * FROM v WHERE e IS NOT NULL
         AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
         AND len(list_filter(e, lambda x: x <> 0)) > 0),
pairs AS MATERIALIZED (SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b
          ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach(x, y) AS (SELECT vec_id, vec_id FROM v
                UNION SELECT r.x, p.y FROM reach r JOIN pairs p ON r.y = p.x),
low AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
degree AS (SELECT x, count(*) AS n FROM pairs GROUP BY x)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN low ON v.vec_id = low.x LEFT JOIN degree ON degree.x = v.vec_id
"""


def _tidy(text: str) -> str:
    text = rf"regexp_replace({text}, '[ \t\r\f]+', ' ', 'g')"
    text = rf"regexp_replace({text}, ' ?\n[ \n]*', chr(10), 'g')"
    return rf"regexp_replace({text}, '^[ \n]+|[ \n]+$', '', 'g')"


def _record_id(kind: str, *parts: str) -> str:
    digest = f"md5(concat_ws('|', {kind}, {', '.join(parts)}))"
    cuts = ", ".join(f"substr({digest}, {at}, {n})"
                     for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"('<urn:uuid:' || concat_ws('-', {cuts}) || '>')"


_HIDDEN = r"(?is)<(?:script|style)\b[^>]*>.*?</(?:script|style)\s*>|<!--.*?-->|<!doctype[^>]*>"
_UNCLOSED = r"(?is)<(?:script|style)\b[^>]*>.*|<!--.*"
_BREAKS = (r"(?i)</?(?:p|br|div|h[1-6]|li|ul|ol|tr|table|article|section|nav|header|footer|title"
           r"|head|body|html|blockquote|pre)\b[^>]*>")
_text = rf"regexp_replace(regexp_replace(html, '{_HIDDEN}', ' ', 'g'), '{_UNCLOSED}', ' ', 'g')"
_text = rf"regexp_replace({_text}, '\n', ' ', 'g')"
_text = f"regexp_replace({_text}, '{_BREAKS}', chr(10), 'g')"
_text = f"regexp_replace({_text}, '<[^>]*>', '', 'g')"
_title = r"regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title', 1), '\n', ' ', 'g')"
_links = r"""regexp_extract_all(html, '(?i)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["'']', 1)"""
_NL = "(chr(13) || chr(10))"


def _values(pairs) -> str:
    quoted = lambda x: str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'"
    return ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in pairs)


# the public table of names, and the numbers that do not stand for their own character
_NAMES = _values(sorted(html5.items()))
_ODD = _values((n, unescape(f"&#{n};")) for n in chain(
    range(1, 0xA0), range(0xFDD0, 0xFDF0), *[(p + 0xFFFE, p + 0xFFFF) for p in range(0, 0x110000, 0x10000)])
    if unescape(f"&#{n};") != chr(n))

_OP6 = rf"""
WITH names(name, value) AS (VALUES {_NAMES}),
odd(number, value) AS (VALUES {_ODD}),
r AS (SELECT row_number() OVER () AS page, coalesce(html, '') AS html,
       coalesce(url, '') AS target_uri,
       {_record_id("'response'", "coalesce(page_id::VARCHAR, '')", "coalesce(url, '')")} AS refers_to,
       strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(coalesce(page_id, 0)),
                '%Y-%m-%dT%H:%M:%SZ') AS warc_date,
       'Content-Length: ' || strlen(coalesce(html, '')) AS length_line
  FROM pages),
written AS MATERIALIZED (
  SELECT page, 'title' AS kind, 1 AS n, {_title} AS t FROM r
  UNION ALL SELECT page, 'text', 1, {_text} FROM r
  UNION ALL SELECT page, 'link', unnest(generate_series(1, len({_links}))), unnest({_links}) FROM r),
pieces AS MATERIALIZED (
  SELECT page, kind, n, unnest(generate_series(1, len(string_split(t, '&')))) AS i,
         unnest(string_split(t, '&')) AS p FROM written),
numbered AS (
  SELECT *, CASE WHEN regexp_matches(p, '^#[xX][0-9a-fA-F]')
                 THEN ('0x' || regexp_extract(p, '^#[xX]([0-9a-fA-F]+)', 1))::BIGINT
                 ELSE regexp_extract(p, '^#([0-9]+)', 1)::BIGINT END AS number,
         length(regexp_extract(p, '^#(?:[0-9]+|[xX][0-9a-fA-F]+);?')) AS size
  FROM pieces WHERE i > 1 AND regexp_matches(p, '^#(?:[0-9]|[xX][0-9a-fA-F])')),
by_number AS (
  SELECT page, kind, n, i, size, coalesce(odd.value, CASE WHEN numbered.number = 0
         OR numbered.number BETWEEN 55296 AND 57343 OR numbered.number > 1114111
         THEN chr(65533) ELSE chr(numbered.number::INT) END) AS value
  FROM numbered LEFT JOIN odd ON odd.number = numbered.number),
starts AS (SELECT page, kind, n, i, p, unnest(generate_series(2, least(length(p), 33))) AS size
           FROM pieces WHERE i > 1 AND regexp_matches(p, '^[a-zA-Z]')),
by_name AS (
  SELECT page, kind, n, i, max(size) AS size, max_by(value, size) AS value
  FROM starts JOIN names ON names.name = p[1:size]
  -- in an attribute a name is whole, and ends with its semicolon or before neither = nor letters
  WHERE kind <> 'link' OR p[size] = ';' OR NOT regexp_matches(p[size + 1:size + 1], '[a-zA-Z0-9=]')
  GROUP BY page, kind, n, i),
known AS (SELECT * FROM by_number UNION ALL SELECT * FROM by_name),
decoded AS (
  SELECT p.page, p.kind, p.n, string_agg(CASE WHEN p.i = 1 THEN p.p
      WHEN k.size IS NULL THEN '&' || p.p
      ELSE regexp_replace(k.value, '^[\x{{a0}}\t\n\r\f]', ' ') || p.p[k.size + 1:] END, '' ORDER BY p.i) AS t
  FROM pieces p LEFT JOIN known k USING (page, kind, n, i) GROUP BY p.page, p.kind, p.n),
links AS (SELECT page, string_agg('outlink: ' || t || {_NL}, '' ORDER BY n) AS listed
          FROM decoded WHERE kind = 'link' GROUP BY page),
d AS (SELECT r.*, title.t AS title, body.t AS body, coalesce(listed, '') AS listed,
       'sha256:' || sha256(html) AS source_payload_digest,
       'sha256:' || sha256('HTTP/1.1 200 OK' || {_NL} || 'Content-Type: text/html; charset=utf-8'
         || {_NL} || length_line || {_NL} || {_NL} || html) AS source_block_digest
  FROM r JOIN decoded title ON title.page = r.page AND title.kind = 'title'
  JOIN decoded body ON body.page = r.page AND body.kind = 'text'
  LEFT JOIN links ON links.page = r.page),
made AS (
  SELECT *, 'metadata' AS record_type, 'application/warc-fields' AS content_type,
    'title: ' || {_tidy('title')} || {_NL} || listed
    || 'source-payload-digest: ' || source_payload_digest || {_NL}
    || 'source-block-digest: ' || source_block_digest || {_NL}
    || 'source-header: HTTP/1.1 200 OK' || {_NL}
    || 'source-header: Content-Type: text/html; charset=utf-8' || {_NL}
    || 'source-header: ' || length_line || {_NL} AS block FROM d
  UNION ALL
  SELECT *, 'conversion', 'text/plain; charset=utf-8', {_tidy('body')} FROM d),
named AS (SELECT {_record_id('record_type', 'refers_to')} AS record_id, record_type, refers_to,
    target_uri, warc_date, content_type, strlen(block)::BIGINT AS content_length,
    'sha256:' || sha256(block) AS block_digest, source_payload_digest, source_block_digest, block
  FROM made)
SELECT *, 'WARC/1.1' || {_NL} || 'WARC-Type: ' || record_type || {_NL}
  || 'WARC-Record-ID: ' || record_id || {_NL} || 'WARC-Refers-To: ' || refers_to || {_NL}
  || 'WARC-Target-URI: ' || target_uri || {_NL} || 'WARC-Date: ' || warc_date || {_NL}
  || 'WARC-Block-Digest: ' || block_digest || {_NL} || 'Content-Type: ' || content_type || {_NL}
  || 'Content-Length: ' || content_length || {_NL} || {_NL} AS warc_header
FROM named
"""

def _sections(print_: str) -> str:
    return f"list_filter(string_split(split_part({print_}, ':', 2), ';'), lambda x: x <> '')"


def _leaves(sections: str) -> str:
    return f"regexp_extract_all(array_to_string({sections}, ';'), '[0-9a-f]{{6}}[0-9]{{2}}')"


def _chars(leaves: str) -> str:
    return f"coalesce(list_sum(list_transform({leaves}, lambda x: x[7:8]::BIGINT)), 0)::BIGINT"


def _alike(a: str, b: str) -> str:
    """How many elements two lists have alike from the front."""
    return (f"(coalesce(list_position(list_transform(list_zip({a}, {b}), lambda z: "
            f"z[1] IS NOT DISTINCT FROM z[2]), false), len({a}) + 1) - 1)")


def _near(a: str, b: str) -> str:
    # sections of each, the sections alike, and the distinct leaves of those that are not
    return f"""(SELECT CASE WHEN substr({a}, 1, 32) = substr({b}, 1, 32) THEN 1.0::DOUBLE
       WHEN 2 * s + {_chars('la')} + {_chars('lb')} = 0 THEN 0.0::DOUBLE
       ELSE (2 * (s + {_chars('list_intersect(la, lb)')}))::DOUBLE
            / (2 * s + {_chars('la')} + {_chars('lb')}) END
  FROM (SELECT {_chars(_leaves('list_intersect(sa, sb)'))} AS s,
         list_distinct({_leaves('list_filter(sa, lambda x: NOT list_contains(sb, x))')}) AS la,
         list_distinct({_leaves('list_filter(sb, lambda x: NOT list_contains(sa, x))')}) AS lb
    FROM (SELECT list_distinct({_sections(a)}) AS sa, list_distinct({_sections(b)}) AS sb)))"""


def _ahead(a: str, b: str) -> str:
    one, two = (_leaves(f"{x}[n + 1:n + 1]") for x in ("sa", "sb"))
    return f"""(SELECT {_chars(_leaves('sa[1:n]'))} + {_chars(f"({one})[1:{_alike(one, two)}]")}
  FROM (SELECT sa, sb, {_alike('sa', 'sb')} AS n FROM (SELECT {a} AS sa, {b} AS sb)))"""


def _backwards(sections: str) -> str:
    return (f"list_transform(list_reverse({sections}), lambda x: array_to_string(list_reverse("
            f"regexp_extract_all(x, '[0-9a-f]{{6}}[0-9]{{2}}')), ''))")


def _cut(width: int) -> str:
    return rf"regexp_extract_all(s, '[^.!?\n]{{1,{width}}}[.!?\n]{{0,3}}|[.!?\n]{{1,99}}')"


_OP7 = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT doc_id, text, length(text) AS n_chars, coalesce(
        lead(text) OVER (ORDER BY doc_id),
        first_value(text) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING
                                AND UNBOUNDED FOLLOWING)) AS next FROM t),
e AS (SELECT *, substr(text, 1, n_chars - n_chars // 4) || substr(next, 1, n_chars // 4) AS edited
      FROM n),
texts AS (SELECT doc_id, 'own' AS kind, text AS s FROM e UNION ALL
          SELECT doc_id, 'edited', edited FROM e UNION ALL SELECT doc_id, 'next', next FROM e),
hashed AS (SELECT doc_id, kind, list_filter(string_split(coalesce(array_to_string(list_transform(
             CASE WHEN length(s) < 32 THEN {_cut(1)} WHEN length(s) < 512 THEN {_cut(8)}
                  ELSE {_cut(96)} END, lambda p: md5(p) || lpad(length(p)::VARCHAR, 2, '0')
               || CASE WHEN substr(md5(p), 32, 1) IN ('0', '8') THEN ';' ELSE '' END), ''), ''),
             ';'), lambda x: x <> '') AS branches FROM texts),
prints AS (SELECT doc_id, kind, substr(sha256(coalesce(array_to_string(list_transform(branches,
             lambda x: md5(x)), ''), '')), 1, 32) || ':' || coalesce(array_to_string(
             list_transform(branches, lambda x: 'n' || substr(md5(x), 1, 7) || '='
               || regexp_replace(x, '([0-9a-f]{{6}})[0-9a-f]{{26}}([0-9]{{2}})', '\1\2', 'g')),
             ';'), '') AS print FROM hashed),
wide AS (SELECT doc_id, max(print) FILTER (WHERE kind = 'own') AS own,
                max(print) FILTER (WHERE kind = 'edited') AS edited_print,
                max(print) FILTER (WHERE kind = 'next') AS next_print FROM prints GROUP BY doc_id),
places AS (SELECT *, {_ahead(_sections('own'), _sections('edited_print'))} AS ahead,
    {_chars(_leaves(_sections('own')))} - {_ahead(_backwards(_sections('own')),
                                                  _backwards(_sections('edited_print')))} AS behind,
    substr(own, 1, 32) <> substr(edited_print, 1, 32) AS differ FROM wide)
SELECT doc_id, n_chars::BIGINT AS n_chars, sha256(edited) AS edited_sha256, own AS fingerprint,
       edited_print AS edited_fingerprint, {_near('own', 'edited_print')} AS near_edited,
       {_near('own', 'next_print')} AS near_next,
       CASE WHEN differ THEN ahead END AS edit_start,
       CASE WHEN differ THEN greatest(ahead, behind) END AS edit_end
FROM places JOIN e USING (doc_id)
"""

_OP8 = rf"""
WITH s AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, {_WORD})), 0)::BIGINT AS size
           FROM documents),
t AS (SELECT source, sum(size)::BIGINT AS total, row_number() OVER (ORDER BY source NULLS LAST) - 1
        AS place FROM s GROUP BY source),
w AS (SELECT *, [5, 2, 1][(place % 3 + 1)::INT] AS weight, total * 3 AS stop FROM t),
l AS (SELECT *, (sum(total) OVER () - coalesce(sum(stop) OVER (ORDER BY stop / weight, place
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (
        ORDER BY stop / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev
      FROM w),
f AS (SELECT *, (SELECT lev FROM l x WHERE stop / weight > lev ORDER BY stop / weight, place LIMIT 1)
        AS final FROM l),
g AS (SELECT source, total, least(stop::DOUBLE, coalesce(final * weight, stop::DOUBLE)) AS target
      FROM f),
p AS (SELECT s.doc_id, s.size, total, floor(target + 0.5)::BIGINT AS quota, coalesce(sum(size) OVER (
        PARTITION BY s.source ORDER BY md5(concat_ws(':', doc_id::VARCHAR, 'mix')), doc_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS a
      FROM s JOIN g ON s.source IS NOT DISTINCT FROM g.source WHERE size > 0),
k AS (SELECT doc_id, sum(greatest(least(a + size + e * total, quota) - (a + e * total), 0))::BIGINT
        AS taken FROM p, (VALUES (0), (1), (2)) epochs(e) GROUP BY doc_id)
SELECT s.doc_id, s.source, s.size, g.total AS source_size, g.target,
       coalesce(k.taken, 0)::BIGINT AS taken
FROM s JOIN g ON s.source IS NOT DISTINCT FROM g.source LEFT JOIN k ON s.doc_id = k.doc_id
"""

_HEX = "(instr('0123456789abcdef', substr(md5(pattern), {0}, 1)) - 1)"
_first, _off = f"({_HEX.format(2)} * 2)", f"({_HEX.format(2)} * 2 + 1 + {_HEX.format(3)})"
_start = "TIMESTAMP '2024-01-01 00:00:00'"
_host = r"regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)"

_OP10 = rf"""
WITH c AS (SELECT page_id, url, {_start} + to_seconds((page_id * 7919) % 2592000) AS fetched,
             coalesce({_host}, '') AS host,
             string_split({_host}, '.') AS labels,
             list_filter(string_split(regexp_extract(url,
               '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), '/'), lambda x: x <> '') AS parts
           FROM pages),
asked AS (SELECT page_id, fetched, unnest(list_distinct(list_concat(
            list_transform(generate_series(1, greatest(len(labels) - 1, 1)),
                           lambda i: array_to_string(labels[i:], '.')),
            list_transform(generate_series(1, len(parts)),
                           lambda i: host || '/' || array_to_string(parts[1:i], '/'))))) AS pattern
          FROM c WHERE host <> ''),
named AS (SELECT DISTINCT pattern, len(pattern) - len(replace(pattern, '/', '')) AS slashes,
            len(split_part(pattern, '/', 1)) - len(replace(split_part(pattern, '/', 1), '.', '')) AS dots
          FROM asked),
hosts AS (SELECT pattern FROM named WHERE slashes = 0 AND dots > 1 AND {_HEX.format(1)} < 8),
entries AS (
  SELECT 'hosts' AS list, pattern, 'block' AS action, {_start} + to_days({_first}::INT) AS dated
    FROM hosts
  UNION ALL SELECT 'hosts', pattern, 'remove', {_start} + to_days({_off}::INT) FROM hosts
    WHERE {_HEX.format(4)} < 8
  UNION ALL SELECT 'hosts', pattern, 'block', {_start} + to_days(({_off} + 3)::INT) FROM hosts
    WHERE {_HEX.format(4)} < 8 AND {_HEX.format(5)} < 8
  UNION ALL SELECT 'sections', pattern, 'allow', {_start} + to_days({_first}::INT) FROM named
    WHERE slashes = 1 AND {_HEX.format(1)} < 4
  UNION ALL SELECT 'domains', pattern, 'review', {_start} + to_days({_first}::INT) FROM named
    WHERE slashes = 0 AND dots = 1 AND {_HEX.format(1)} < 12),
spans AS (SELECT list, pattern, action, dated AS valid_from,
            lead(dated) OVER (PARTITION BY list, pattern ORDER BY dated) AS valid_to FROM entries),
active AS (SELECT a.page_id, s.* FROM asked a JOIN spans s ON a.pattern = s.pattern
             AND s.action <> 'remove' AND a.fetched >= s.valid_from
             AND (s.valid_to IS NULL OR a.fetched < s.valid_to)),
ranked AS (SELECT *, count(*) OVER (PARTITION BY page_id) AS n, row_number() OVER (
             PARTITION BY page_id ORDER BY length(pattern) DESC, valid_from DESC, action, list) AS r
           FROM active)
SELECT c.page_id, c.url, c.fetched, c.host, coalesce(n, 0)::BIGINT AS n_active,
       coalesce(action, 'unlisted') AS verdict, list, pattern, valid_from, valid_to
FROM c LEFT JOIN ranked ON c.page_id = ranked.page_id AND r = 1
"""

_GRAM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_OP11 = rf"""
WITH RECURSIVE steps(i, done, c) AS (
  SELECT i, 0, i FROM range(256) r(i)
  UNION ALL SELECT i, done + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
  FROM steps WHERE done < 8),
crc AS MATERIALIZED (SELECT list(c::BIGINT ORDER BY i) AS table_ FROM steps WHERE done = 8),
own AS MATERIALIZED (SELECT doc_id, coalesce(regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_GRAM}), []) AS words
  FROM documents),
wanted AS (SELECT unnest(regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_GRAM})) AS word FROM benchmark),
each AS MATERIALIZED (SELECT doc_id, unnest(words) AS word FROM own),
counts AS (SELECT word, sum(s)::BIGINT AS s, sum(t)::BIGINT AS t FROM (
    SELECT word, count(*) AS s, 0 AS t FROM each GROUP BY word
    UNION ALL SELECT word, 0, count(*) FROM wanted GROUP BY word) GROUP BY word),
bytes AS (SELECT word, s, t, list_concat([4294967295::BIGINT], list_transform(
    generate_series(1, strlen(word)), lambda i: ('0x' || hex(word)[2 * i - 1:2 * i])::BIGINT)) AS b
  FROM counts),
bucketed AS MATERIALIZED (SELECT word, s, t, xor(list_reduce(b, lambda c, x:
    xor(c >> 8, table_[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket FROM bytes, crc),
sums AS (SELECT bucket, sum(s) AS s, sum(t) AS t FROM bucketed GROUP BY bucket),
gains AS (SELECT bucket, floor(1000 * ln(
    ((t + 1)::DOUBLE * ((SELECT sum(s) FROM counts) + 10000)::DOUBLE)
    / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM counts) + 10000)::DOUBLE)))::BIGINT AS gain FROM sums),
words AS (SELECT word, gain FROM bucketed JOIN gains USING (bucket)),
weights AS (SELECT doc_id, sum(gain)::BIGINT AS total FROM each JOIN words USING (word)
            GROUP BY doc_id),
scored AS (SELECT o.doc_id, len(words)::BIGINT AS n_features,
    floor(coalesce(total, 0)::DOUBLE / greatest(len(words), 1))::BIGINT AS weight,
    ('0x' || substr(sha256('2024:' || o.doc_id), 1, 8))::BIGINT AS h
  FROM own o LEFT JOIN weights w ON o.doc_id = w.doc_id),
summed AS (SELECT doc_id, n_features, weight,
    weight + floor(-1000 * ln(-ln((h + 0.5)::DOUBLE / 4294967296::DOUBLE)))::BIGINT AS score
  FROM scored),
placed AS (SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (
    PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS place FROM summed)
SELECT doc_id, n_features AS n_words, n_features, weight, score,
  CASE WHEN place <= 10 * (SELECT count(*) FROM summed WHERE n_features >= 20) // 100
       THEN place END AS rank
FROM placed
"""

_OP13 = r"""
WITH units AS (SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || doc_id) AS s FROM documents),
drawn AS (SELECT *, len(u)::BIGINT AS n, ('0x' || substr(s, 1, 8))::BIGINT % (len(u) + 1) AS a,
    ('0x' || substr(s, 9, 8))::BIGINT % (len(u) + 1) AS b, ('0x' || substr(s, 17, 8))::BIGINT AS h3,
    ('0x' || substr(s, 25, 8))::BIGINT AS h4 FROM units),
cut AS (SELECT *, array_to_string(u[1:least(a, b)], '') AS p,
    array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m,
    array_to_string(u[greatest(a, b) + 1:], '') AS x,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
      OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || x || '<M>' || m
         ELSE '<S>' || x || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM cut
"""

ORACLES: dict[str, str] = {
    "op1_substring_dedup": _OP1,
    "op2_embedding_dedup": _OP2,
    "op6_warc": _OP6,
    "op7_fingerprints": _OP7,
    "op8_mixing": _OP8,
    "op10_url_lists": _OP10,
    "op11_resampling": _OP11,
    "op13_infill": _OP13,
}
