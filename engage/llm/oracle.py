"""DuckDB SQL for the registered queries that SQL can express.

The others hash shingles, encode tokens, align or train; they are tested
against brute force in ``tests/llm``.
"""

SQL: dict[str, str] = {
    "op6_chat": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, length('<|turn|><|text|><|end|>') + 1
            + length(regexp_replace(role, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g'))
            + length(regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g')) AS chars
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id""",
    "op11_url_filter": r"""
WITH cut AS (
  SELECT page_id, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') AS sep FROM pages),
parts AS (
  SELECT page_id, CASE WHEN sep > 0 THEN substr(url, sep + 3) ELSE '' END AS rest,
         translate(CASE WHEN sep > 0 THEN substr(url, sep + 3) ELSE url END,
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS s
  FROM cut),
split AS (
  SELECT page_id, s,
         translate(regexp_extract(rest, '^([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts),
ruled AS (
  SELECT page_id, s, host, path,
         CASE WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
              WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
              WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
              WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
              WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM split),
tried(pattern, regex) AS (VALUES
  ('||spam-farm.', '^([^/?#]*[.])?spam-farm[.]'), ('cheap-pills.', 'cheap-pills[.]'), ('-pills.', '-pills[.]'),
  ('^viagra^', '[^a-z0-9_.%-]viagra([^a-z0-9_.%-]|$)'), ('^casino^', '[^a-z0-9_.%-]casino([^a-z0-9_.%-]|$)'),
  ('^poker^', '[^a-z0-9_.%-]poker([^a-z0-9_.%-]|$)'), ('^betting^', '[^a-z0-9_.%-]betting([^a-z0-9_.%-]|$)'),
  ('^porn^', '[^a-z0-9_.%-]porn([^a-z0-9_.%-]|$)'), ('^xxx^', '[^a-z0-9_.%-]xxx([^a-z0-9_.%-]|$)'),
  ('^escort^', '[^a-z0-9_.%-]escort([^a-z0-9_.%-]|$)'), ('^torrent^', '[^a-z0-9_.%-]torrent([^a-z0-9_.%-]|$)'),
  ('^warez^', '[^a-z0-9_.%-]warez([^a-z0-9_.%-]|$)'), ('||ads.', '^([^/?#]*[.])?ads[.]'),
  ('||adserver.', '^([^/?#]*[.])?adserver[.]'), ('^adclick^', '[^a-z0-9_.%-]adclick([^a-z0-9_.%-]|$)'),
  ('^popunder^', '[^a-z0-9_.%-]popunder([^a-z0-9_.%-]|$)'),
  ('/track/*/pixel^', '(?s)/track/.*/pixel([^a-z0-9_.%-]|$)'),
  ('^payday^*^loan^', '(?s)[^a-z0-9_.%-]payday[^a-z0-9_.%-].*[^a-z0-9_.%-]loan([^a-z0-9_.%-]|$)'),
  ('link-farm', 'link-farm'), ('free-followers', 'free-followers'), ('.exe|', '[.]exe$'), ('.apk|', '[.]apk$'),
  ('.torrent|', '[.]torrent$'), ('@@||example.org/en/9*.html|', '(?s)^([^/?#]*[.])?example[.]org/en/9.*[.]html$'))
SELECT page_id, host, path, rule, pattern,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN pattern IS NULL OR starts_with(pattern, '@@') THEN 'allow' ELSE 'block' END AS verdict
FROM (SELECT page_id, host, path, rule, CASE WHEN rule IS NULL THEN
         (SELECT first(pattern ORDER BY CASE WHEN starts_with(pattern, '@@') THEN 0 ELSE 1 END, -length(pattern), pattern)
          FROM tried WHERE regexp_matches(s, regex)) END AS pattern FROM ruled)""",
    "op12_ranked_search": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY r, term),
q AS (
  SELECT i, item_id, term, count(*) AS times FROM (
    SELECT i, item_id, unnest(regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark)) GROUP BY i, item_id, term),
total AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d WHERE len(terms) > 0),
m AS (SELECT r, doc_id, 100 - 25 + (25 * len(terms) * n_docs) // n_terms AS m FROM d, total WHERE len(terms) > 0),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total),
scored AS (
  SELECT i, item_id, doc_id, r, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (r) GROUP BY i, item_id, doc_id, r)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
WHERE rank <= 20""",
    "op13_filter_audit": r"""
WITH letters(f, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (
  SELECT filter_order, step, (SELECT bit FROM letters WHERE f = substr(filter_order, step, 1)) AS own,
         (SELECT coalesce(sum(bit), 0)::INTEGER FROM letters WHERE contains(substr(filter_order, 1, step - 1), f)) AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5])::INTEGER AS step)),
words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
masks AS (
  SELECT doc_id, part,
         (len(w) < 100)::INTEGER + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INTEGER
         + 4 * (100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text))::INTEGER
         + 8 * regexp_matches(text, '[#$%&*|]')::INTEGER
         + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INTEGER AS mask
  FROM words),
said AS (SELECT doc_id, max((quality = 1)::INTEGER) AS good, max((toxic = 1)::INTEGER) AS toxic FROM labels GROUP BY doc_id),
counts AS (
  SELECT part, mask, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, count(*) AS n
  FROM masks LEFT JOIN said USING (doc_id) GROUP BY ALL),
rows AS (
  SELECT part, filter_order, step, substr(filter_order, step, 1) AS f,
         coalesce(sum(n) FILTER ((mask & (before | own)) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER ((mask & own) > 0 AND (mask & before) = 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER ((mask & own) > 0 AND (mask & before) > 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (mask = own), 0)::BIGINT AS unique_fails,
         coalesce(sum(n) FILTER ((mask & own) > 0 AND (mask & before) = 0 AND good = 1), 0)::BIGINT AS good_lost,
         coalesce(sum(n) FILTER ((mask & own) > 0 AND (mask & before) = 0 AND toxic = 1), 0)::BIGINT AS toxic_lost
  FROM counts, steps GROUP BY part, filter_order, step)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM rows""",
}
