"""DuckDB SQL for the operators that SQL can express, over whole tables."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = f"""
WITH words AS (SELECT doc_id, {WORDS} AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words WHERE len(w) >= 50)),
earliest AS (SELECT h, min(doc_id) AS first_doc FROM windows GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p
  FROM windows JOIN earliest USING (h) WHERE doc_id > first_doc),
counts AS (
  SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE p - 1 IS DISTINCT FROM before) AS n_spans
  FROM (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM gone)
  GROUP BY doc_id),
every AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM words),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text
  FROM every ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256, coalesce(n_spans, 0) AS n_spans
FROM words LEFT JOIN counts USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

_ESCAPED = "replace(replace({x}, '\\', '\\0'), '<', '\\1')"
# the three markers of a turn have 9, 8 and 7 characters
OP2 = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
talks AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
         coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (WHERE role = 'assistant'), '') AS loss,
         sum(24 + length({_ESCAPED.format(x="role")}) + length({_ESCAPED.format(x="text")})) AS chars
  FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars
FROM talks
"""

# base32: ten hex digits are eight groups of five bits
OP3 = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS digest FROM pages),
kept AS (SELECT html, max(page_id) AS page FROM payloads GROUP BY html)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
       array_to_string([
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
           (CAST('0x' || substr(digest, 1 + 10 * (i // 8), 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31
           AS INTEGER), 1)
         FOR i IN range(0, 32)], '') AS payload_digest,
       CASE WHEN page_id = page THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> page THEN page END AS refers_to
FROM payloads JOIN kept USING (html)
"""

# a space stands for a variable field: no token holds one
OP4 = """
WITH split_lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS number FROM documents),
lines AS (
  SELECT doc_id, number, line,
         list_transform(regexp_extract_all(line, '[^\x20\x09-\x0D]+'),
                        lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN ' ' ELSE x END) AS tokens
  FROM split_lines),
placed AS (
  SELECT doc_id, number, tokens, len(tokens) AS size, tokens[1:3] AS lead
  FROM lines WHERE len(tokens) > 0),
leaves AS (
  SELECT size, lead FROM placed GROUP BY size, lead HAVING count(DISTINCT doc_id) >= 10),
shared AS (SELECT * FROM placed SEMI JOIN leaves USING (size, lead)),
forms AS (SELECT size, lead, tokens, count(*) AS n FROM shared GROUP BY size, lead, tokens),
cells AS (
  SELECT size, lead, tokens, n, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS place
  FROM forms),
constants AS (
  SELECT size, lead, place, token FROM cells WHERE place > 3 AND token <> ' '
  GROUP BY size, lead, place, token HAVING sum(n) >= 10),
fixed AS (
  SELECT size, lead, tokens, count(*) AS n_fixed,
         string_agg(place || ':' || token, ' ' ORDER BY place) AS constant
  FROM cells SEMI JOIN constants USING (size, lead, place, token) GROUP BY size, lead, tokens),
templates AS (
  SELECT size, lead, tokens, coalesce(constant, '') AS constant
  FROM forms LEFT JOIN fixed USING (size, lead, tokens)
  WHERE coalesce(n_fixed, 0) + len(list_filter(lead, lambda x: x <> ' ')) >= size * CAST(0.6 AS DOUBLE)),
held AS (SELECT doc_id, number, size, lead, constant FROM shared JOIN templates USING (size, lead, tokens)),
recurring AS (
  SELECT size, lead, constant, min(doc_id) AS keeper FROM held
  GROUP BY size, lead, constant HAVING count(DISTINCT doc_id) >= 10),
words AS (
  SELECT doc_id, number, array_to_string(said, ' ') AS said, len(said) AS size
  FROM (SELECT doc_id, number, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS said FROM split_lines)
  WHERE len(said) > 0),
flanked AS (
  SELECT doc_id, number, said, size,
         lag(said) OVER (PARTITION BY doc_id ORDER BY number) AS before,
         lead(said) OVER (PARTITION BY doc_id ORDER BY number) AS after FROM words),
longs AS (
  SELECT doc_id, number, said,
         CASE WHEN before IS NULL AND after IS NULL THEN '' ELSE coalesce(before, chr(10) || doc_id) END AS before,
         CASE WHEN before IS NULL AND after IS NULL THEN '' ELSE coalesce(after, chr(10) || doc_id) END AS after
  FROM flanked WHERE size >= 10),
repeated AS (
  SELECT said, min(doc_id) AS keeper FROM longs GROUP BY said
  HAVING count(DISTINCT doc_id) > 1 AND count(DISTINCT before) > 1 AND count(DISTINCT after) > 1),
dropped AS (
  SELECT doc_id, number FROM held JOIN recurring USING (size, lead, constant) WHERE doc_id <> keeper
  UNION SELECT doc_id, number FROM longs JOIN repeated USING (said) WHERE doc_id <> keeper)
SELECT doc_id, greatest(count(*) FILTER (WHERE d.number IS NULL), 1) AS n_kept,
       count(d.number) AS n_dropped,
       coalesce(string_agg(line, chr(10) ORDER BY l.number) FILTER (WHERE d.number IS NULL), '') AS text
FROM lines l LEFT JOIN dropped d USING (doc_id, number) GROUP BY doc_id
"""

# two hex digits are a byte; a block holds the strings that start at 400 neighbouring bytes
OP10 = """
WITH texts AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
blocks AS (
  SELECT doc_id, b, substr(x, CAST(800 * b + 1 AS BIGINT), 1600) AS y
  FROM (SELECT doc_id, x, unnest(range(0, len(x) // 800)) AS b FROM texts WHERE len(x) >= 800)),
starts AS (
  SELECT doc_id, 400 * b + j AS i, md5_number(substr(y, CAST(2 * j + 1 AS BIGINT), 800)) AS h
  FROM (SELECT doc_id, b, y, unnest(range(0, least(400, len(y) // 2 - 399))) AS j FROM blocks)),
again AS (SELECT h FROM starts GROUP BY h HAVING count(*) > 1),
marked AS (SELECT doc_id, i FROM starts SEMI JOIN again USING (h)),
edges AS (
  SELECT doc_id, i, i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 400 AS apart FROM marked),
numbered AS (
  SELECT doc_id, i, sum(CASE WHEN apart THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run
  FROM edges),
spans AS (SELECT doc_id, run, min(i) AS a, max(i) + 400 AS b FROM numbered GROUP BY doc_id, run),
holes AS (
  SELECT doc_id, run, b AS kept_from,
         coalesce(lead(a) OVER (PARTITION BY doc_id ORDER BY a), 1000000000) AS kept_to FROM spans
  UNION ALL SELECT doc_id, -1, 0, min(a) FROM spans GROUP BY doc_id),
kept AS (
  SELECT doc_id,
         string_agg(substr(x, 2 * kept_from + 1, 2 * (kept_to - kept_from)), '' ORDER BY run) AS k
  FROM holes JOIN texts USING (doc_id) GROUP BY doc_id),
counts AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(k, x))) AS kept_sha256
FROM texts LEFT JOIN counts USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

# windows of eight words found twice in one text cover the repeated words
OP11 = f"""
WITH words AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
every AS (SELECT doc_id, unnest(w) AS word FROM words),
windows AS (
  SELECT doc_id, i, md5_number(array_to_string(w[i:i + 7], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM words WHERE len(w) >= 8)),
again AS (SELECT doc_id, h FROM windows GROUP BY doc_id, h HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM windows SEMI JOIN again USING (doc_id, h))
  GROUP BY doc_id),
lines AS (
  SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM words)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
per_line AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines,
         count(*) FILTER (WHERE regexp_matches(line, '^[\x20\x09-\x0D]*[-*]')) AS n_bullets,
         count(*) FILTER (WHERE regexp_matches(line, '[.][.][.][\x20\x09-\x0D]*$')) AS n_ellipses
  FROM lines GROUP BY doc_id),
per_word AS (
  SELECT doc_id, sum(length(word)) AS word_chars,
         count(*) FILTER (WHERE regexp_matches(word, '[A-Za-z]') OR NOT regexp_full_match(word, '[\x00-\x7F]*')) AS n_letter
  FROM every GROUP BY doc_id),
common AS (
  SELECT doc_id, max(n) AS n_common FROM (SELECT doc_id, word, count(*) AS n FROM every GROUP BY doc_id, word)
  GROUP BY doc_id),
counts AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_bullets, 0) AS n_bullets,
         coalesce(n_ellipses, 0) AS n_ellipses, coalesce(n_letter, 0) AS n_letter, coalesce(n_common, 0) AS n_common
  FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN per_line USING (doc_id)
       LEFT JOIN per_word USING (doc_id) LEFT JOIN common USING (doc_id)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 10 * n_symbols > 3 * n_words OR 10 * n_dup_lines > 3 * n_lines
            OR 10 * n_letter < 6 * n_words OR 10 * n_bullets > 9 * n_lines
            OR 10 * n_ellipses > 3 * n_lines OR 10 * n_common > 4 * n_words) AS kept
FROM judged
"""

# every order is walked through: what a filter removes fails it and no filter before it
OP12 = rf"""
WITH marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
         max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
firsts AS (SELECT text, min(doc_id) AS first_id FROM texts GROUP BY text),
fails AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (CASE WHEN len(w) < 200 THEN 'A' ELSE '' END)
         || (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END)
         || (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 'C' ELSE '' END)
         || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END)
         || (CASE WHEN doc_id > first_id THEN 'E' ELSE '' END) AS failed
  FROM texts JOIN firsts USING (text) LEFT JOIN marks USING (doc_id)),
cells AS (
  SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY ALL),
parts AS (SELECT part, sum(n) AS n FROM cells GROUP BY part),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM letters a JOIN letters b ON b.f <> a.f JOIN letters c ON c.f NOT IN (a.f, b.f)
       JOIN letters d ON d.f NOT IN (a.f, b.f, c.f) JOIN letters e ON e.f NOT IN (a.f, b.f, c.f, d.f)),
steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS f,
         substr(filter_order, 1, step - 1) AS earlier
  FROM orders, (SELECT unnest(range(1, 6)) AS step)),
counted AS (
  SELECT part, filter_order, step, f,
         sum(CASE WHEN fresh THEN n ELSE 0 END) AS removed, sum(CASE WHEN fresh THEN 0 ELSE n END) AS redundant,
         sum(CASE WHEN failed = f THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN fresh THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN fresh THEN toxic ELSE 0 END) AS toxic_lost
  FROM (SELECT *, translate(failed, earlier, '') = failed AS fresh
        FROM cells JOIN steps ON contains(failed, f))
  GROUP BY part, filter_order, step, f),
whole AS (
  SELECT part, n, filter_order, step, f, coalesce(removed, 0) AS removed, coalesce(redundant, 0) AS redundant,
         coalesce(unique_fails, 0) AS unique_fails, coalesce(good_lost, 0) AS good_lost,
         coalesce(toxic_lost, 0) AS toxic_lost
  FROM parts CROSS JOIN steps LEFT JOIN counted USING (part, filter_order, step, f))
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
       CAST(n - sum(removed) OVER (PARTITION BY part, filter_order ORDER BY step) AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM whole
"""

ORACLES = {
    "op1_substring_dedup": OP1,
    "op2_chat_format": OP2,
    "op3_warc": OP3,
    "op4_line_templates": OP4,
    "op10_suffix_dedup": OP10,
    "op11_quality_cascade": OP11,
    "op12_filter_audit": OP12,
}
