"""DuckDB SQL for the llm queries that SQL can express; constants are stated here, not imported."""

REPETITION_RULES = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), lines AS (
  SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY k) AS seen
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS k FROM t)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), dup_lines AS (
  SELECT doc_id, count(*) AS n_dup_lines,
         sum(length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g'))) AS dup_line_chars
  FROM lines WHERE seen > 1 GROUP BY doc_id
), windows AS (
  SELECT doc_id, n, i, array_to_string(words[i:i + n - 1], ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM t)
  CROSS JOIN (VALUES (3), (5), (7), (10)) AS sizes(n)
  WHERE i + n - 1 <= len(words)
), ranked AS (
  SELECT doc_id, n, i, row_number() OVER (PARTITION BY doc_id, n, w ORDER BY i) AS seen,
         count(*) OVER (PARTITION BY doc_id, n, w) AS times
  FROM windows
), covered AS (
  SELECT DISTINCT doc_id, n, i + k AS pos
  FROM ranked, (SELECT unnest(range(0, 10)) AS k) AS shift
  WHERE k < n AND ((n = 3 AND times > 1) OR (n > 3 AND seen > 1))
), cover AS (
  SELECT c.doc_id, count(*) FILTER (n = 3) AS n_repeat_words,
         sum(length(t.words[pos])) FILTER (n = 5) AS c5,
         sum(length(t.words[pos])) FILTER (n = 7) AS c7,
         sum(length(t.words[pos])) FILTER (n = 10) AS c10
  FROM covered c JOIN t USING (doc_id) GROUP BY c.doc_id
), m AS (
  SELECT t.doc_id, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         coalesce(dup_line_chars, 0) AS line_chars,
         coalesce(c5, 0) AS c5, coalesce(c7, 0) AS c7, coalesce(c10, 0) AS c10
  FROM t LEFT JOIN dup_lines USING (doc_id) LEFT JOIN cover USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND line_chars <= 0.20 * word_chars
         AND c5 <= 0.15 * word_chars AND c7 <= 0.13 * word_chars AND c10 <= 0.10 * word_chars AS kept
FROM m
"""

MIX_SOURCES = r"""
WITH d AS (
  SELECT doc_id, source,
         sum(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0))::BIGINT AS size
  FROM documents GROUP BY doc_id, source
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS r FROM d GROUP BY source
), w AS (
  SELECT *, CASE (r - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
         (2 * source_size)::DOUBLE AS cap FROM s
), f AS (
  SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM s)
             - coalesce(sum(cap) OVER before, 0.0::DOUBLE))
            / ((SELECT sum(weight) FROM w) - coalesce(sum(weight) OVER before, 0.0::DOUBLE)) AS level
  FROM w WINDOW before AS (ORDER BY cap / weight, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), g AS (
  SELECT *, CASE WHEN cap / weight <= level THEN cap
                 ELSE weight * (SELECT arg_min(level, (cap / weight, r)) FROM f WHERE cap / weight > level) END AS target
  FROM f
), t AS (
  SELECT source, source_size, target, r, round(target)::BIGINT AS words,
         ceil(round(target) / 1024)::BIGINT AS blocks FROM g
), k AS (SELECT sum(blocks)::BIGINT AS n FROM t
), reach AS (
  SELECT *, coalesce(lag(hi) OVER (ORDER BY r), 0) AS lo FROM (
    SELECT *, floor(sum(blocks) OVER (ORDER BY r) * 2147483648.0::DOUBLE / (SELECT greatest(n, 1)::DOUBLE FROM k))::BIGINT AS hi
    FROM t WHERE blocks > 0)
), slots AS (
  SELECT i AS slot, (i % 2147483648) * 1327217885 % 2147483648 AS u
  FROM (SELECT unnest(range(0, (SELECT coalesce(n, 0) FROM k))) AS i)
), dealt AS (
  SELECT source, blocks, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS block
  FROM slots JOIN reach ON u >= lo AND u < hi
), schedule AS (
  SELECT source, block FROM dealt WHERE block < blocks
  UNION ALL
  SELECT source, unnest(range(least(coalesce(n, 0), blocks), blocks)) AS block
  FROM t LEFT JOIN (SELECT source AS s2, count(*) AS n FROM dealt GROUP BY source) q ON source IS NOT DISTINCT FROM s2
), streams AS (
  SELECT d.doc_id, d.source, d.size, words, e * source_size + coalesce(sum(d.size) OVER (
           PARTITION BY d.source, e ORDER BY md5(coalesce(doc_id::VARCHAR, '') || ':' || e::VARCHAR), doc_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source CROSS JOIN (VALUES (0), (1)) AS epochs(e)
  WHERE d.size > 0 AND e * source_size < words
), pieces AS (
  SELECT doc_id, source, a, least(a + size, words) AS b,
         unnest(range((a // 1024)::BIGINT, ((least(a + size, words) - 1) // 1024 + 1)::BIGINT)) AS block
  FROM streams WHERE a < words
), taken AS (
  SELECT p.doc_id, p.source,
         sum(least(b, (p.block + 1) * 1024) - greatest(a, p.block * 1024)) AS taken
  FROM pieces p JOIN schedule s ON p.source IS NOT DISTINCT FROM s.source AND p.block = s.block
  GROUP BY p.doc_id, p.source
)
SELECT d.doc_id, d.source, d.size, t.source_size, t.target, coalesce(k.taken, 0)::BIGINT AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
LEFT JOIN taken k ON d.doc_id IS NOT DISTINCT FROM k.doc_id AND d.source IS NOT DISTINCT FROM k.source
"""

URL_FILTERS = r"""
WITH p AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(((page_id % 366) + 366) % 366 AS INTEGER) AS fetched,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
         list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'), lambda s: s <> '') AS seg
  FROM pages
), rules AS (
  SELECT host AS rule FROM p UNION SELECT regexp_extract(host, '[^.]+\.[^.]+$') FROM p
  UNION SELECT host || '/' || seg[1] FROM p WHERE len(seg) > 0
), log AS (
  SELECT 'list' || (('0x' || substr(md5(rule), 1, 4))::INTEGER % 3) AS list, rule,
         n % 2 = 0 AS adds, DATE '2024-01-01' + ('0x' || substr(md5(rule || '#' || n), 5, 4))::INTEGER % 366 AS day
  FROM rules CROSS JOIN (SELECT unnest(range(0, 4)) AS n) AS numbers
  WHERE rule IS NOT NULL AND rule <> '' AND ('0x' || substr(md5(rule || '#' || n), 1, 4))::INTEGER % 2 = 0
), states AS (
  SELECT list, rule, day, bool_and(adds) AS on_list FROM log GROUP BY list, rule, day
), keys AS (
  SELECT DISTINCT page_id, url, fetched, array_to_string(list_slice(l, len(l) - n + 1, len(l)), '.') AS key
  FROM (SELECT *, string_split(host, '.') AS l FROM p WHERE host <> '') CROSS JOIN (SELECT unnest(range(1, 5)) AS n) AS numbers
  WHERE n <= len(l)
  UNION SELECT page_id, url, fetched, host || '/' || seg[1] FROM p WHERE host <> '' AND len(seg) > 0
), asof_state AS (
  SELECT k.page_id, k.url, k.fetched, s.list, s.rule, s.on_list
  FROM keys k ASOF JOIN states s ON k.key = s.rule AND k.fetched >= s.day
), active AS (
  SELECT a.page_id, a.url, a.fetched, a.list, a.rule,
         (SELECT min(s.day) FROM states s WHERE s.rule = a.rule AND s.list = a.list AND s.on_list AND s.day <= a.fetched
            AND s.day > coalesce((SELECT max(o.day) FROM states o WHERE o.rule = a.rule AND o.list = a.list
                                  AND NOT o.on_list AND o.day <= a.fetched), DATE '1900-01-01')) AS since
  FROM asof_state a WHERE on_list
), best AS (
  SELECT page_id, url, fetched, count(*) AS n, arg_min({'list': list, 'rule': rule, 'since': since},
         (-length(rule), list, rule)) AS b
  FROM active GROUP BY page_id, url, fetched
)
SELECT p.page_id, p.url, p.fetched, coalesce(n, 0)::BIGINT AS n_rules, n IS NOT NULL AS blocked,
       b.list AS list, b.rule AS rule, b.since AS since
FROM p LEFT JOIN best USING (page_id, url, fetched)
"""

LICENSE_SCAN = r"""
WITH templates(license, wording) AS (VALUES
  ('Apache-2.0', 'Licensed under the Apache License, Version 2.0'),
  ('Apache-2.0', 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
  ('BSD-3-Clause', 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met'),
  ('CC-BY-4.0', 'This work is licensed under a Creative Commons Attribution 4.0 International License'),
  ('CC-BY-NC-4.0', 'Licensed under CC BY-NC 4.0'),
  ('CC-BY-SA-4.0', 'Licensed under CC BY-SA 4.0'),
  ('GPL-2.0', 'This work is licensed under the GNU General Public License, version 2'),
  ('GPL-3.0', 'This work is licensed under the GNU General Public License, version 3'),
  ('ISC', 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.'),
  ('LGPL-3.0', 'This library is licensed under the GNU Lesser General Public License, version 3'),
  ('MIT', 'Released under the MIT License'),
  ('MIT', 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction'),
  ('MPL-2.0', 'This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.'),
  ('Unlicense', 'This is free and unencumbered software released into the public domain.')
), units AS (
  SELECT doc_id, 0 AS line, text AS unit FROM documents WHERE contains(text, chr(10))
  UNION ALL
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS line, unnest(string_split(text, chr(10))) AS unit
  FROM documents WHERE text IS NOT NULL
), words AS (
  SELECT doc_id, line, list_filter(string_split(regexp_replace(lower(unit), '[^\p{L}\p{N}]+', ' ', 'g'), ' '), lambda w: w <> '') AS w
  FROM units
), sets AS (
  SELECT doc_id, line, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b FROM words WHERE len(w) > 1
), tw AS (
  SELECT license, list_filter(string_split(regexp_replace(lower(wording), '[^\p{L}\p{N}]+', ' ', 'g'), ' '), lambda w: w <> '') AS w FROM templates
), tsets AS (
  SELECT license, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS t FROM tw
), scored AS (
  SELECT doc_id, line, license, len(list_intersect(b, t))::BIGINT AS shared,
         2.0::DOUBLE * len(list_intersect(b, t)) / (len(b) + len(t)) AS dice
  FROM sets JOIN tsets ON len(b) <= 1.5 * len(t) + 0.001 AND len(t) <= 1.5 * len(b) + 0.001
)
SELECT doc_id, line::BIGINT AS line, license, shared, dice
FROM scored WHERE dice >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, line ORDER BY dice DESC, license, shared) = 1
"""

FILTER_AUDIT = r"""
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), l AS (
  SELECT doc_id, max((quality = 1)::INTEGER) AS good, max((toxic = 1)::INTEGER) AS toxic FROM labels GROUP BY doc_id
), f AS (
  SELECT w.doc_id, part, coalesce(good, 0) = 1 AS good, coalesce(toxic, 0) = 1 AS toxic,
         [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
          100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
          regexp_matches(text, '[#$%&*|]'),
          coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY text), false)] AS fails
  FROM w LEFT JOIN l ON l.doc_id = w.doc_id
), m AS (
  SELECT part, good, toxic, fails, list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: fails[ascii(x) - 64]) AS bad,
         count(*) AS n
  FROM (SELECT part, good, toxic, fails FROM f) GROUP BY ALL
), letters(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT filter_order, step, filter_order[step] AS own, string_split(substr(filter_order, 1, step - 1), '') AS before
  FROM orders CROSS JOIN (SELECT unnest(range(1, 6))::INTEGER AS step) AS s
), counted AS (
  SELECT part, filter_order, step, own,
         sum(CASE WHEN NOT list_contains(bad, own) AND NOT list_has_any(bad, before) THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN list_contains(bad, own) AND NOT list_has_any(bad, before) THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN list_contains(bad, own) AND list_has_any(bad, before) THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN bad = [own] THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN good AND list_contains(bad, own) AND NOT list_has_any(bad, before) THEN n ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN toxic AND list_contains(bad, own) AND NOT list_has_any(bad, before) THEN n ELSE 0 END)::BIGINT AS toxic_lost
  FROM m CROSS JOIN steps GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM counted
"""
