"""DuckDB SQL for the operators that it can express, as the registered queries return them."""

from __future__ import annotations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def crc32(hexed: str) -> str:
    """The unsigned crc32 of the bytes that `hexed` spells. A byte's table entry is the xor of those of its set bits."""
    entries, entry = [], 0xEDB88320
    for _ in range(8):
        entries.append(entry)
        entry = (entry >> 1) ^ (0xEDB88320 if entry & 1 else 0)
    low = "xor(c, b) & 255"
    mixed = "c >> 8"
    for k, entry in enumerate(entries):
        mixed = f"xor({mixed}, ((({low}) >> {7 - k}) & 1) * {entry})"
    values = f"list_transform(range(1, length({hexed}), 2), lambda i: ('0x' || {hexed}[i:i + 1])::BIGINT)"
    return f"xor(list_reduce({values}, lambda c, b: {mixed}, 4294967295::BIGINT), 4294967295)"


OP13 = f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w, target
  FROM (SELECT doc_id, text, false AS target FROM documents UNION ALL SELECT item_id, text, true FROM benchmark)
), grams AS (
  SELECT target, doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM words
), counted AS (SELECT target, doc_id, f, count(*) AS n FROM grams GROUP BY ALL
), named AS MATERIALIZED (SELECT f, {crc32("h")} % 10000 AS bucket FROM (SELECT DISTINCT f, hex(encode(f)) AS h FROM counted)
), held AS MATERIALIZED (SELECT target, doc_id, bucket, sum(n)::BIGINT AS n FROM counted JOIN named USING (f) GROUP BY ALL
), sums AS (
  SELECT b.bucket, coalesce(sum(n) FILTER (NOT target), 0)::BIGINT AS s, coalesce(sum(n) FILTER (target), 0)::BIGINT AS t
  FROM range(10000) AS b(bucket) LEFT JOIN held USING (bucket) GROUP BY b.bucket
), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM sums
), weights AS (
  SELECT doc_id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS total FROM held JOIN gains USING (bucket) WHERE NOT target GROUP BY doc_id
), scored AS (
  SELECT w.doc_id, len(w.w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features,
    coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0)::BIGINT AS weight,
    ('0x' || substr(sha256('7:' || w.doc_id), 1, 8))::BIGINT AS h
  FROM words w LEFT JOIN weights USING (doc_id) WHERE NOT w.target
), drawn AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM scored
), placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, 25 * count(*) OVER () // 100 AS wanted FROM drawn WHERE n_words >= 20
)
SELECT d.doc_id, n_features, weight, score, CASE WHEN place <= wanted THEN place END::BIGINT AS rank FROM drawn d LEFT JOIN placed USING (doc_id)
"""

OP12 = f"""
WITH own AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS p, role, text
  FROM (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
), ids AS (
  SELECT c, c - c % 20 AS donor, {crc32("name")} % 4 AS h FROM (SELECT DISTINCT c, hex(encode(c::VARCHAR)) AS name FROM own)
), turns AS (
  SELECT i.c, o.p, role, text FROM ids i JOIN own o ON o.c = i.donor AND o.p <= i.h
  UNION ALL SELECT i.c, o.p, role, text FROM ids i JOIN own o ON o.c = i.c AND o.p > i.h
), whole AS (
  SELECT c, coalesce(list({{'role': role, 'text': text}} ORDER BY p) FILTER (p IS NOT NULL), []) AS s FROM ids LEFT JOIN turns USING (c) GROUP BY c
), steps AS MATERIALIZED (
  SELECT c, d, sha256(to_json(s[1:d])::VARCHAR) AS key, d = len(s) AS last,
    CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(s[d].text, '[^\\x20\\x09-\\x0D]+')) END AS words
  FROM (SELECT c, s, unnest(range(len(s) + 1)) AS d FROM whole)
), nodes AS (
  SELECT d, key, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last), '')) AS ends_sha256
  FROM steps GROUP BY d, key
), path AS (SELECT s.c, s.d, n.conv_id AS node FROM steps s JOIN nodes n USING (d, key)
), tree AS (
  SELECT n.*, p.node AS parent_conv_id, (SELECT count(*) FROM nodes k JOIN path q ON q.c = k.conv_id AND q.d = k.d - 1 WHERE q.node = n.conv_id AND q.d = n.d) AS n_children
  FROM nodes n LEFT JOIN path p ON p.c = n.conv_id AND p.d = n.d - 1
), sums AS (
  SELECT p.node AS conv_id, p.d, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * words)::BIGINT AS saved_tokens
  FROM tree t JOIN path p ON p.c = t.conv_id AND p.d <= t.d GROUP BY ALL
)
SELECT t.conv_id, t.d AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 FROM tree t JOIN sums USING (conv_id, d)
"""

ORACLES = {"op12_euler_trie": OP12, "op13_target_resampling": OP13}
