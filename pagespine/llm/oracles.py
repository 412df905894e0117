"""The queries that plain SQL can express, for a single-node engine."""

from pagespine.llm import quality

LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

CONTAMINATION = rf"""
WITH doc AS (SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{WORD}') AS w FROM documents),
item AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{WORD}') AS w FROM benchmark),
test AS (SELECT item_id, i AS place, least(10, len(w)) AS size, w[i : i + least(10, len(w)) - 1] AS run
         FROM item, unnest(range(1, len(w) - least(10, len(w)) + 2)) t(i) WHERE len(w) > 0),
place AS (SELECT doc_id, i AS start, size, w[i : i + size - 1] AS run
          FROM doc, (SELECT DISTINCT size FROM test) s, unnest(range(1, len(w) - size + 2)) t(i)),
hit AS (SELECT doc_id, item_id, start, place, size FROM place JOIN test USING (size, run)),
words_hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM hit, unnest(range(start, start + size)) t(j) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
          FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id),
islands AS (SELECT doc_id, max(start) - min(start) + any_value(size) AS length FROM (
              SELECT *, start - row_number() OVER (PARTITION BY doc_id, item_id, start - place ORDER BY start) AS island FROM hit)
            GROUP BY doc_id, item_id, start - place, island),
longest AS (SELECT doc_id, max(length) AS longest FROM islands GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, CAST(longest AS BIGINT) AS longest
FROM doc LEFT JOIN words_hit USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN longest USING (doc_id)
"""

ARCHIVES = r"""
WITH page AS (SELECT page_id, url, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS size FROM pages),
first AS (SELECT html, max(page_id) AS first_id FROM page WHERE size >= 1000 GROUP BY html),
host AS (SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]*)', 1)), '^www\.', '') AS host FROM page)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to,
       array_to_string(list_reverse(string_split(host, '.')), ',') || ')'
         || lower(coalesce(nullif(regexp_extract(url, '^[a-zA-Z]+://[^/?#]*(/[^?#]*)', 1), ''), '/'))
         || lower(regexp_extract(url, '^[^?#]*(\?[^#]+)', 1)) AS urlkey,
       strftime(make_timestamp((1500000000 + page_id % 1000000000) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS captured
FROM page JOIN host USING (page_id) LEFT JOIN first USING (html)
"""

QUALITY = r"""
WITH doc AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, i, w[i : i + 2] AS run FROM doc, unnest(range(1, len(w) - 1)) t(i)),
again AS (SELECT doc_id, run FROM windows GROUP BY doc_id, run HAVING count(*) > 1),
repeated AS (SELECT doc_id, count(DISTINCT j) AS n_repeat_words FROM windows JOIN again USING (doc_id, run), unnest([i, i + 1, i + 2]) t(j) GROUP BY doc_id),
line AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM doc),
measured AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n_letters,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(text, '[^0-9]', '', 'g')) AS n_digits,
         length(regexp_replace(text, '[^\p{L}]', '', 'g')) AS n_all_letters,
         length(regexp_replace(regexp_replace(text, '[^\p{L}]', '', 'g'), '[^UNSPACED]', '', 'g')) AS n_unspaced
  FROM doc JOIN line USING (doc_id) LEFT JOIN repeated USING (doc_id)),
judged AS (
  SELECT *, CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
            + CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
            + CASE WHEN 2 * n_upper > n_all_letters AND n_letters >= 20 THEN 16 ELSE 0 END
            + CASE WHEN (word_chars < 2 * n_words OR word_chars > 20 * n_words) AND 2 * n_unspaced <= n_all_letters THEN 32 ELSE 0 END
            + CASE WHEN 10 * n_digits > 6 * word_chars THEN 64 ELSE 0 END AS bits
  FROM measured)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       bits % 4 > 0 AS base_failed, bits = 0 AS kept, CAST(bits AS BIGINT) AS failures
FROM judged
""".replace("UNSPACED", quality.UNSPACED)

AUDIT = r"""
WITH doc AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
                    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
first AS (SELECT text, min(doc_id) AS least FROM doc GROUP BY text),
label AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
          FROM labels GROUP BY doc_id),
failed AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                  CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
                  || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 'C' ELSE '' END
                  || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN doc_id > least THEN 'E' ELSE '' END AS f
           FROM doc JOIN first USING (text) LEFT JOIN label USING (doc_id)),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letter a, letter b, letter c, letter d, letter e
           WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, CAST(s AS INTEGER) AS step, filter_order[s] AS own, filter_order[1 : s - 1] AS earlier FROM orders, unnest(range(1, 6)) t(s)),
kind AS (SELECT part, good, toxic, f, count(*) AS n FROM failed GROUP BY ALL),
told AS (SELECT part, filter_order, step, own, n, good, toxic, f, contains(f, own) AS fails,
                length(regexp_replace('.' || f, '[.' || earlier || ']', '', 'g')) < length(f) AS gone FROM kind, steps),
counted AS (SELECT part, filter_order, step, own, sum(n) FILTER (NOT gone AND NOT fails) AS kept, sum(n) FILTER (NOT gone AND fails) AS removed,
                   sum(n) FILTER (gone AND fails) AS redundant, sum(n) FILTER (f = own) AS unique_fails,
                   sum(n * good) FILTER (NOT gone AND fails) AS good_lost, sum(n * toxic) FILTER (NOT gone AND fails) AS toxic_lost
            FROM told GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counted
"""

ORACLES = {"op13_filter_audit": AUDIT, "op6_contamination": CONTAMINATION, "op9_warc": ARCHIVES, "op10_quality_rules": QUALITY}
