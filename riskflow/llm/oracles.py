"""DuckDB SQL of the queries that SQL can express."""

ORACLES: dict[str, str] = {}

#: White space of a line's ends in a bracket, for patterns.
_SPACE = r"[\x20\x09-\x0D]"

ORACLES["op2_line_dedup"] = rf"""
WITH docs AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM docs
), keyed AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^{_SPACE}+', ''), '{_SPACE}+$', ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key FROM lines
), shared AS (
  SELECT line_key, max(doc_id) AS keeper FROM keyed
  WHERE length(line_key) >= 20 GROUP BY line_key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT k.doc_id, k.line, k.place, coalesce(k.doc_id <> s.keeper, false) AS gone
  FROM keyed k LEFT JOIN shared s USING (line_key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

#: Base 32 of a SHA-1: four characters from each five hexadecimal digits.
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(digest, {5 * i + 1}, 5))::BIGINT >> {n}) & 31) + 1)::BIGINT, 1)"
    for i in range(8)
    for n in (15, 10, 5, 0)
)

ORACLES["op7_warc"] = f"""
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS digest FROM pages
), ranked AS (
  SELECT *, min(page_id) OVER (PARTITION BY digest) AS first_id FROM payloads
)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM ranked
"""


#: CRC-32 of a text's bytes, with `tab` from CRC_TABLE in the same row.
CRC_TABLE = """crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS tab)"""


def _crc32(text: str) -> str:
    digits = f"hex(encode({text}))"
    octets = f"list_transform(range(1, strlen({text}) * 2, 2), lambda i: ('0x' || substr({digits}, i, 2))::BIGINT)"
    return f"xor(list_reduce([4294967295] || {octets}, lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)"


ORACLES["op11_spelling_variants"] = rf"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL
), hashed AS (
  SELECT run, times, {_crc32("(doc_id::VARCHAR || ':' || run)")} AS h FROM runs, crc
), written AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times FROM hashed
), words AS (
  SELECT word, sum(times)::BIGINT AS n FROM written WHERE length(word) >= 6 GROUP BY 1 HAVING n >= 5
), shorter AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
  SELECT a.word AS word, b.word AS near FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT w.word, s.word FROM words w JOIN shorter s ON s.rest = w.word
  UNION SELECT s.word, w.word FROM words w JOIN shorter s ON s.rest = w.word
), ranked AS (
  SELECT p.word, p.near, v.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near,
         row_number() OVER (PARTITION BY p.word ORDER BY v.n DESC, p.near) AS place
  FROM pairs p JOIN words v ON v.word = p.near
), forms AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near,
         CASE WHEN r.near_n >= 5 * w.n THEN r.near END AS form, CASE WHEN r.near_n >= 5 * w.n THEN r.near_n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1
), follow(word, spot, step) AS (
  SELECT word, word, 0 FROM words
  UNION ALL
  SELECT follow.word, forms.form, step + 1 FROM follow JOIN forms ON forms.word = follow.spot WHERE forms.form IS NOT NULL
)
SELECT f.word, f.form, arg_max(follow.spot, follow.step) AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN follow ON follow.word = f.word GROUP BY ALL
"""

ORACLES["op12_conversation_repair"] = rf"""
WITH RECURSIVE {CRC_TABLE},
given AS (
  SELECT dense_rank() OVER (ORDER BY conv_id) AS c, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS id
  FROM conversations
), hashed AS (
  SELECT *, {_crc32("id")} % 20 AS kind FROM given, crc
), broken AS (
  SELECT c, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy FROM hashed) WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS place,
         regexp_replace(text, '{_SPACE}+$', '') AS body
  FROM broken
), faulty AS (
  SELECT *, CASE WHEN body = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY place) > 1 THEN 'duplicate'
                 WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY c ORDER BY place) || left(role, 1) AS pair
  FROM placed
), inserted(p, q, cost, letters) AS (
  VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 5, 'I'), (0, 3, 10, 'II'),
         (1, 2, 5, 'I'), (1, 3, 10, 'II'), (2, 3, 5, 'I'), (3, 2, 5, 'I')
), moves(p, q, role, cost, letter) AS (
  VALUES (0, 0, NULL, 2, 'D'), (1, 1, NULL, 2, 'D'), (2, 2, NULL, 2, 'D'), (3, 3, NULL, 2, 'D'),
         (0, 1, 's', 0, 'K'), (0, 2, 'u', 0, 'K'), (1, 2, 'u', 0, 'K'), (3, 2, 'u', 0, 'K'), (2, 3, 'a', 0, 'K'),
         (0, 2, NULL, 1, 'R'), (1, 2, NULL, 1, 'R'), (3, 2, NULL, 1, 'R'), (2, 3, NULL, 1, 'R')
), cells(c, place, state, cost, audit) AS (
  SELECT DISTINCT c, 0::BIGINT, 0, 0, '' FROM faulty
  UNION ALL
  SELECT c, place, state, cost, audit FROM (
    SELECT cells.c, cells.place + 1 AS place, m.q AS state, cells.audit || i.letters || m.letter AS audit,
           cells.cost + i.cost + m.cost + CASE WHEN m.letter <> 'D' AND f.fault = 'truncated' THEN 5 ELSE 0 END AS cost,
           row_number() OVER (PARTITION BY cells.c, m.q ORDER BY
             cells.cost + i.cost + m.cost + CASE WHEN m.letter <> 'D' AND f.fault = 'truncated' THEN 5 ELSE 0 END,
             cells.audit || i.letters || m.letter) AS best
    FROM cells JOIN faulty f ON f.c = cells.c AND f.place = cells.place + 1
    JOIN inserted i ON i.p = cells.state JOIN moves m ON m.p = i.q
    WHERE (m.role IS NULL OR m.role = left(f.role, 1))
      AND (m.letter = 'D' OR f.fault IS NULL OR f.fault NOT IN ('blank', 'duplicate'))
  ) WHERE best = 1
), ended AS (
  SELECT cells.c, cells.cost + i.cost AS cost, cells.audit || i.letters AS audit,
         row_number() OVER (PARTITION BY cells.c ORDER BY cells.cost + i.cost, cells.audit || i.letters) AS best
  FROM cells JOIN (SELECT c, max(place) AS place FROM faulty GROUP BY 1) l USING (c, place)
  JOIN inserted i ON i.p = cells.state WHERE i.q IN (0, 3)
), edits AS (
  SELECT c, spot, audit[spot] AS letter, len(replace(audit[1:spot], 'I', '')) AS place
  FROM (SELECT *, unnest(range(1, length(audit) + 1)) AS spot FROM ended WHERE best = 1)
), left_over AS (
  SELECT e.c, e.spot, e.letter, f.role, f.text, e.letter = 'K' AND left(f.role, 1) = 's' AS system
  FROM edits e LEFT JOIN faulty f ON f.c = e.c AND f.place = e.place AND e.letter <> 'I' WHERE e.letter <> 'D'
), spoken AS (
  SELECT *, sum((NOT system)::INT) OVER (PARTITION BY c ORDER BY spot) % 2 AS odd FROM left_over
), repaired AS (
  SELECT c, string_agg(CASE WHEN letter = 'K' THEN role WHEN odd = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY spot) AS body
  FROM spoken GROUP BY c
), counts AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
         count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY c
)
SELECT g.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT c, conv_id FROM given) g LEFT JOIN counts USING (c) LEFT JOIN (SELECT * FROM ended WHERE best = 1) USING (c) LEFT JOIN repaired USING (c)
"""

_WORDS = r"[^\x20\x09-\x0D]"
ORACLES["op13_quality_rules"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORDS}+') AS w FROM documents
), lines AS (
  SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d
), line_counts AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines WHERE regexp_matches(line, '{_WORDS}') GROUP BY 1
), windows AS (
  SELECT rid, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS words, unnest(range(1, len(w) - 3)) AS i FROM d
), again AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, words) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT rid, count(DISTINCT place) AS n_repeat_words FROM (SELECT rid, unnest(range(i, i + 5)) AS place FROM again) GROUP BY 1
), m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
         len(regexp_extract_all(text, '[\p{{L}}\p{{Nl}}\p{{No}}]{_WORDS}*')) AS n_lettered
  FROM d LEFT JOIN line_counts USING (rid) LEFT JOIN covered USING (rid)
), f AS (
  SELECT *, (n_words < 10)::BIGINT AS few, (100 * n_repeat_words > 20 * n_words)::BIGINT AS repeated, (10 * n_symbols > n_words)::BIGINT AS symbols,
         (word_chars < 3 * n_words)::BIGINT AS short, (word_chars > 10 * n_words)::BIGINT AS long,
         (10 * n_dup_lines > 3 * n_lines)::BIGINT AS dup, (10 * n_lettered < 8 * n_words)::BIGINT AS letters
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, few + repeated > 0 AS base_failed,
       few + repeated + symbols = 0 AND short + long + dup + letters <= 1 AS kept,
       few + 2 * repeated + 4 * symbols + 8 * short + 16 * long + 32 * dup + 64 * letters AS failures
FROM f
"""
