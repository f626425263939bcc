"""DuckDB SQL for the queries of the subpackage that SQL can express."""

from __future__ import annotations

WORDS = r"""
{name}_words AS (
  SELECT {key}, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{M}}\p{{N}}]+') AS words FROM {table})"""
# an item of fewer than five words is one shingle of its own length; documents list the lengths that items have
SHINGLES = """
{name}_shingles AS (
  SELECT DISTINCT {key}, array_to_string(list_slice(words, i, i + n - 1), ' ') AS shingle
  FROM (SELECT {key}, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM {name}_words JOIN lengths ON {on}))"""

OP1 = "WITH" + WORDS.format(name="doc", key="doc_id", table="documents") + "," \
    + WORDS.format(name="item", key="item_id", table="benchmark") + """,
lengths AS (SELECT DISTINCT least(5, len(words)) AS n FROM item_words WHERE len(words) > 0),""" \
    + SHINGLES.format(name="doc", key="doc_id", on="n <= len(words)") + "," \
    + SHINGLES.format(name="item", key="item_id", on="n = least(5, len(words))") + """,
sizes AS (SELECT item_id, count(*) AS item_shingles FROM item_shingles GROUP BY item_id),
found AS (
  SELECT doc_id, item_id, count(*) AS shared FROM doc_shingles JOIN item_shingles USING (shingle) GROUP BY ALL)
SELECT doc_id, item_id, shared, item_shingles, shared / item_shingles::DOUBLE AS containment
FROM found JOIN sizes USING (item_id) WHERE shared / item_shingles::DOUBLE >= 0.8
"""

OP10 = """
WITH told AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages),
digested AS (
  SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, sha1(payload) AS hexed FROM told),
records AS (
  SELECT page_id, payload_bytes, array_to_string([
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(hexed, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)
    FOR i IN range(32)], '') AS payload_digest
  FROM digested),
originals AS (
  SELECT payload_digest, payload_bytes, min(page_id) AS original FROM records GROUP BY ALL)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id > original THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > original THEN original END AS refers_to
FROM records JOIN originals USING (payload_digest, payload_bytes)
"""

# the checksum goes over the hexadecimal digits of a text, the lower one of a byte first; the table holds the 16 remainders
OP11 = """
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(doc_id::VARCHAR, '') AS told FROM documents),
rows AS (
  SELECT doc_id, text, strlen(text)::BIGINT + 16 AS size, ('0x' || substr(md5(text), 1, 15))::BIGINT AS key,
    ('0x' || substr(md5(told), 1, 15))::BIGINT AS tie, row_number() OVER () AS row FROM texts),
ordered AS (
  SELECT *, sum(size) OVER (ORDER BY key, tie, row) AS top, sum(size) OVER () AS total FROM rows),
ends AS (
  SELECT key, top, total, top - size AS bottom, min(top - size) OVER (PARTITION BY key) AS key_bottom,
    max(top) OVER (PARTITION BY key) AS key_top FROM ordered),
goals AS (SELECT unnest(range(1, 40)) AS goal),
held AS (
  SELECT goal, total, bottom, top, key_bottom, key_top FROM goals JOIN ends
  ON bottom * 40 < goal * total AND top * 40 >= goal * total),
cuts AS (
  SELECT goal, CASE
      WHEN 100 * least(abs(40 * key_bottom - goal * total), abs(40 * key_top - goal * total)) <= total
      THEN CASE WHEN abs(40 * key_bottom - goal * total) <= abs(40 * key_top - goal * total) THEN key_bottom ELSE key_top END
      WHEN abs(40 * bottom - goal * total) <= abs(40 * top - goal * total) THEN bottom ELSE top END AS cut
  FROM held),
digits AS (
  SELECT doc_id, size, key, tie, row, top - size AS bottom,
    [('0x' || d)::UINTEGER FOR d IN string_split(hex(encode(text)), '') IF d <> ''] AS found,
    [0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, 3988292384, 4027552580,
     3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]::UINTEGER[] AS remainders
  FROM ordered),
summed AS (
  SELECT doc_id, size, key, tie, row, bottom, list_reduce(
    flatten([[found[2 * i], found[2 * i - 1]] FOR i IN range(1, len(found) // 2 + 1)]),
    lambda crc, d: xor(remainders[1 + (xor(crc, d) & 15)], crc >> 4), 4294967295::UINTEGER) AS crc
  FROM digits),
placed AS (
  SELECT doc_id, size, key, tie, row, xor(crc, 4294967295::UINTEGER)::BIGINT AS text_crc32,
    (SELECT count(*) FROM cuts WHERE cut <= bottom)::INT AS shard
  FROM summed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY key, tie, row) - 1 AS slot,
  NULL::INT AS grown_shard
FROM placed
"""

OP12 = r"""
WITH told AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
worded AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    min(doc_id) OVER (PARTITION BY text) AS least FROM texts),
docs AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, map {
    'A': len(words) < 200,
    'B': 100 * len(list_distinct(words)) < 50 * len(words),
    'C': 100 * len(regexp_extract_all(text, '[A-Z]')) > 3 * length(text),
    'D': regexp_matches(text, '[#$%&*|]'),
    'E': coalesce(doc_id > least, false)} AS fails
  FROM worded LEFT JOIN told USING (doc_id)),
cells AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM docs GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS letter,
    string_split(substr(filter_order, 1, step - 1), '') AS before
  FROM orders, (SELECT unnest(range(1, 6))::INT AS step)),
judged AS (
  SELECT part, filter_order, step, letter, n, good, toxic, fails[letter] AS failing,
    len([x FOR x IN before IF fails[x]]) > 0 AS gone,
    len([x FOR x IN ['A', 'B', 'C', 'D', 'E'] IF fails[x]]) = 1 AS alone
  FROM cells, steps),
summed AS (
  SELECT part, filter_order, step, letter,
    coalesce(sum(n) FILTER (NOT failing AND NOT gone), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (failing AND NOT gone), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (failing AND gone), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (failing AND alone), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (failing AND NOT gone), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (failing AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM judged GROUP BY ALL)
SELECT * EXCLUDE (letter), (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM summed
"""


def all_sql() -> dict[str, str]:
    return {"op1_minhash_containment": OP1, "op10_warc_revisits": OP10, "op11_histogram_sort": OP11, "op12_filter_folds": OP12}
