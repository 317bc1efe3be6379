"""DuckDB SQL of the queries of operators 11 and 12, over the same tables."""

URL_REPUTATION = r"""
WITH urls AS (
  SELECT page_id, html, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, html, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM urls
), judged AS (
  SELECT *, len(regexp_extract_all(html, '[^\x00-\x20<>]+')) AS words,
         len(regexp_extract_all(html, '%%%|\*\*\*|###|\$\$\$|&amp;&amp;&amp;')) AS runs FROM parts
), hosts AS (
  SELECT host, count(html) AS n, coalesce(sum(CASE WHEN html IS NULL THEN 0 WHEN words > 0 AND runs >= words * 0.1::DOUBLE THEN 1 ELSE 0 END), 0)::BIGINT AS y,
         string_split(regexp_replace(regexp_replace(host, '^.*@', ''), '(:[0-9]*|\.)+$', ''), '.') AS labels
  FROM judged GROUP BY host
), named AS (
  SELECT host, n, y, array_to_string(labels, '.') AS bare, regexp_matches(bare, '^([0-9.]+|\[.*)$') AS address,
         CASE WHEN array_to_string(labels[-2:], '.') IN ('ac.uk', 'co.in', 'co.jp', 'co.kr', 'co.nz', 'co.uk', 'co.za', 'com.au', 'com.br', 'com.cn',
              'com.mx', 'com.tr', 'com.tw', 'gov.uk', 'net.au', 'or.jp', 'org.au', 'org.uk') THEN 2 ELSE 1 END AS depth,
         CASE WHEN address THEN bare ELSE array_to_string(labels[-depth - 1:], '.') END AS domain,
         CASE WHEN address THEN '' ELSE array_to_string(labels[-depth:], '.') END AS suffix
  FROM hosts
), suffixes AS (
  SELECT suffix, sum(n) AS n, sum(y) AS y, coalesce(sum(sum(y)) OVER () / nullif(sum(sum(n)) OVER (), 0), 0)::DOUBLE AS p FROM named GROUP BY suffix
), s1 AS (
  SELECT sum(n * (y / n - p) * (y / n - p)) FILTER (WHERE n > 0) AS squares, sum(p * (1 - p)) FILTER (WHERE n > 0) AS noise,
         sum(p * (1 - p) * (n - 1)) FILTER (WHERE n > 0) AS room FROM suffixes
), m1 AS (SELECT CASE WHEN coalesce(room, 0) = 0 OR squares <= noise THEN 1000.0::DOUBLE ELSE least(1000.0, greatest(1.0, room / (squares - noise) - 1)) END AS m FROM s1
), domains AS (
  SELECT domain, suffix, sum(d.n) AS n, sum(d.y) AS y, any_value((s.y + p * m) / (s.n + m)) AS p FROM named d JOIN suffixes s USING (suffix), m1 GROUP BY domain, suffix
), s2 AS (
  SELECT sum(n * (y / n - p) * (y / n - p)) FILTER (WHERE n > 0) AS squares, sum(p * (1 - p)) FILTER (WHERE n > 0) AS noise,
         sum(p * (1 - p) * (n - 1)) FILTER (WHERE n > 0) AS room FROM domains
), m2 AS (SELECT CASE WHEN coalesce(room, 0) = 0 OR squares <= noise THEN 1000.0::DOUBLE ELSE least(1000.0, greatest(1.0, room / (squares - noise) - 1)) END AS m FROM s2
), placed AS (
  SELECT host, h.n, h.y, (d.y + p * m) / (d.n + m) AS p FROM named h JOIN domains d USING (domain), m2
), s3 AS (
  SELECT sum(n * (y / n - p) * (y / n - p)) FILTER (WHERE n > 0) AS squares, sum(p * (1 - p)) FILTER (WHERE n > 0) AS noise,
         sum(p * (1 - p) * (n - 1)) FILTER (WHERE n > 0) AS room FROM placed
), m3 AS (SELECT CASE WHEN coalesce(room, 0) = 0 OR squares <= noise THEN 1000.0::DOUBLE ELSE least(1000.0, greatest(1.0, room / (squares - noise) - 1)) END AS m FROM s3
), posterior AS (SELECT host, n, y, y + p * m AS a, n - y + (1 - p) * m AS b FROM placed, m3
), bounds AS (SELECT host, n, y, a / (a + b) - 3 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS bound FROM posterior
), ruled AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM parts
)
SELECT page_id, host, path, rule,
       CASE rule WHEN 'net/' THEN 'block' WHEN 'example.com/de/' THEN 'block' WHEN 'example.net/en/' THEN 'allow' WHEN 'org/fr/' THEN 'allow'
            ELSE CASE WHEN bound > 0.2 THEN 'block' ELSE 'allow' END END AS verdict, n AS labelled, y AS junk, round(bound, 6) AS bound
FROM ruled JOIN bounds USING (host)
"""

CONVERSATION_REPAIR = r"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')) AS key FROM conversations
), marked AS (  -- crc32: each byte, then eight steps of one bit
  SELECT *, xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(range(octet_length(key)),
         lambda i: [('0x' || substr(hex(key), 2 * i + 1, 2))::BIGINT] || list_resize([-1::BIGINT], 8, -1::BIGINT))),
         lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295) % 20 AS fault FROM given
), damaged AS (
  SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE fault WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM marked WHERE fault <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
         regexp_extract(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '(?s).$') AS last
  FROM damaged
), faulty AS (
  SELECT *, left(role, 1) AS initial, CASE WHEN last = '' THEN 'b' WHEN nth > 1 THEN 'd' WHEN last IN ('.', '!', '?') THEN '-' ELSE 't' END AS kind,
         lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS following
  FROM numbered
), opens AS (  -- a state and the inserts before a row: state they lead to, cost, letters
  SELECT * FROM (VALUES ('0','0',0,''), ('0','u',2,'I'), ('0','a',4,'II'), ('s','s',0,''), ('s','u',2,'I'), ('s','a',4,'II'),
                        ('u','u',0,''), ('u','a',2,'I'), ('u','u',4,'II'), ('a','a',0,''), ('a','u',2,'I'), ('a','a',4,'II')) AS v(state, stop, cost, letters)
), steps AS (  -- a state before a row and its edit
  SELECT * FROM (VALUES ('0','s','s','K'), ('0','u','u','K'), ('s','u','u','K'), ('u','a','a','K'), ('a','u','u','K'),
                        ('0','','u','R'), ('s','','u','R'), ('u','','a','R'), ('a','','u','R'),
                        ('0','','0','D'), ('s','','s','D'), ('u','','u','D'), ('a','','a','D')) AS v(start, initial, state, letter)
), conversation_ids AS (SELECT DISTINCT conv_id FROM conversations
), best AS (
  SELECT conv_id, 0::BIGINT AS i, '0' AS state, {'cost': 0, 'audit': ''} AS least FROM conversation_ids
  UNION ALL
  SELECT conv_id, i, state, min(path) FROM (
    SELECT b.conv_id, b.i + 1 AS i, s.state, {'cost': b.least.cost + o.cost + CASE s.letter WHEN 'D' THEN 3 WHEN 'R' THEN 2 ELSE 0 END
             + CASE WHEN f.kind = 't' AND s.letter <> 'D' THEN 1 ELSE 0 END, 'audit': b.least.audit || o.letters || s.letter} AS path
    FROM best b JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.i = b.i + 1 JOIN opens o ON o.state = b.state
    JOIN steps s ON s.start = o.stop AND (s.letter <> 'K' OR s.initial = f.initial) AND (s.letter = 'D' OR f.kind IN ('t', '-')))
  GROUP BY conv_id, i, state
), ends AS (
  SELECT b.conv_id, min({'cost': b.least.cost + o.cost, 'audit': b.least.audit || o.letters}) AS least
  FROM best b JOIN opens o ON o.state = b.state AND o.stop IN ('0', 'a')
  LEFT JOIN (SELECT conv_id, max(i) AS n FROM faulty GROUP BY conv_id) z ON z.conv_id IS NOT DISTINCT FROM b.conv_id
  WHERE b.i = coalesce(z.n, 0) GROUP BY b.conv_id
), edits AS (
  SELECT conv_id, k, substr(least.audit, k, 1) AS letter, substr(least.audit, 1, k) AS sofar
  FROM (SELECT *, unnest(range(1, length(least.audit) + 1)) AS k FROM ends)
), roles AS (  -- the row of each edit and its place among the turns that stay, which alternate behind a system row
  SELECT e.*, f.role, f.text, count(*) FILTER (WHERE letter <> 'D') OVER w AS place,
         max(CASE WHEN letter = 'K' AND f.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS system_row
  FROM edits e LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM e.conv_id AND letter <> 'I' AND f.i = length(replace(sofar, 'I', ''))
  WINDOW w AS (PARTITION BY e.conv_id ORDER BY k)
), repaired AS (
  SELECT conv_id, string_agg(CASE letter WHEN 'K' THEN role ELSE CASE WHEN (place - system_row) % 2 = 1 THEN 'user' ELSE 'assistant' END END
         || ':' || CASE letter WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS shown
  FROM roles WHERE letter <> 'D' GROUP BY conv_id
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE kind = 'b') AS blank,
         count(*) FILTER (WHERE kind = 'd') AS duplicate, count(*) FILTER (WHERE kind = 't') AS truncated,
         count(*) FILTER (WHERE following IS NOT NULL AND initial || following NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, e.least.cost::BIGINT AS cost, e.least.audit AS audit, sha256(coalesce(shown, '')) AS repaired_sha256
FROM ends e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM e.conv_id
"""
