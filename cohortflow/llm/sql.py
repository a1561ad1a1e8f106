"""SQL of the operators that SQL can express, as DuckDB runs it over the same tables."""

from __future__ import annotations

from cohortflow.llm import quality

#: crc_table (crc_bytes: the crc32 of each byte), for crc32() below.
CRC_TABLE = """crc_table AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, b::BIGINT)) AS crc_bytes)"""


def crc32(text: str) -> str:
    """SQL of the crc32 of a text expression's UTF-8 bytes, in a query that also selects from crc_table."""
    octets = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), 2 * i::INT + 1, 2))::BIGINT)"
    return f"xor(4294967295, list_reduce({octets}, lambda c, b: xor(c >> 8, crc_bytes[(xor(c, b) & 255) + 1]), 4294967295::BIGINT))"


OP2_SQL = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS x FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY x ORDER BY n DESC, doc_id NULLS LAST) AS keep_id,
       count(*) OVER (PARTITION BY x) AS group_size,
       doc_id IS NOT DISTINCT FROM first_value(doc_id) OVER (PARTITION BY x ORDER BY n DESC, doc_id NULLS LAST) AS kept,
       sha256(x) AS text_sha256
FROM t
"""

OP13_SQL = rf"""
WITH {CRC_TABLE},
d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
tokens AS (SELECT row, doc_id, regexp_extract_all(text, '[!-/:-@\[-`{{-~]+|[^!-/:-@\[-`{{-~\x20\x09-\x0D]+') AS t FROM d),
token AS (SELECT row, doc_id, unnest(t) AS x, generate_subscripts(t, 1) AS i FROM tokens),
crc AS (SELECT x, {crc32("x")} AS c FROM (SELECT DISTINCT x FROM token), crc_table),
coded AS (SELECT row, doc_id, c, lead(c) OVER (PARTITION BY row ORDER BY i) AS c2 FROM token JOIN crc USING (x)),
gram AS (SELECT row, doc_id, c % {quality.BUCKETS} AS bucket FROM coded UNION ALL
         SELECT row, doc_id, ({quality.PAIR} * c + c2) % {quality.BUCKETS} FROM coded WHERE c2 IS NOT NULL),
raw AS (SELECT bucket, count(*) AS r FROM gram GROUP BY 1),
target AS (SELECT bucket, count(*) AS t FROM gram WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) GROUP BY 1),
total AS (SELECT (SELECT sum(r) FROM raw) AS nr, (SELECT coalesce(sum(t), 0) FROM target) AS nt),
weight AS (SELECT bucket, CASE WHEN nt = 0 THEN 0 ELSE
             round((ln((coalesce(t, 0) + 1) / (nt + {quality.BUCKETS})) - ln((r + 1) / (nr + {quality.BUCKETS}))) * 1000000) END::BIGINT AS w
           FROM raw LEFT JOIN target USING (bucket), total),
verdict AS (SELECT row, count(*) AS n_grams, sum(w)::BIGINT AS llr_sum FROM gram JOIN weight USING (bucket) GROUP BY 1),
word AS (SELECT row, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
win AS (SELECT row, i, w[i:i + 2] AS g FROM (SELECT row, w, unnest(range(1, len(w) - 1)) AS i FROM word)),
twice AS (SELECT row, i FROM win QUALIFY count(*) OVER (PARTITION BY row, g) > 1),
covered AS (SELECT row, count(DISTINCT p) AS n FROM (SELECT row, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY 1),
line AS (SELECT row, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS x FROM d),
base AS (SELECT d.row, doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
                (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
                (len(x) - len(list_distinct(x)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
         FROM d JOIN word USING (row) JOIN line USING (row) LEFT JOIN covered c USING (row)),
ruled AS (SELECT *, n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(n_grams, 0)::BIGINT AS n_grams, coalesce(llr_sum, 0)::BIGINT AS llr_sum,
       NOT base_failed AND coalesce(llr_sum, 0) >= {quality.THRESHOLD} * coalesce(n_grams, 0) AS kept
FROM ruled LEFT JOIN verdict USING (row)
"""

_FIELDS = "concat({})".format(", ".join(
    f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", "text")))
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP12_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
doc AS (SELECT doc_id, lang, sha256({_FIELDS}) AS leaf,
               CASE WHEN {crc32("doc_id::VARCHAR")} % 3 = 0 THEN sha256({_FIELDS.replace("text::VARCHAR", _LOWER)}) END AS tampered
        FROM documents, crc_table),
leaves AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS LAST, leaf) - 1 AS i,
                  count(*) OVER (PARTITION BY lang) AS n FROM doc),
up AS (SELECT tree, 0 AS level, i, leaf AS h, n FROM leaves
       UNION ALL
       SELECT tree, level + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (n + 7) // 8 FROM up WHERE n > 1 GROUP BY tree, level, i // 8, n),
sub AS (SELECT tree, level, h FROM up WHERE n = 1),
top AS (SELECT 0 AS level, tree AS i, h, (SELECT count(*) FROM sub) AS n FROM sub
        UNION ALL
        SELECT level + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (n + 7) // 8 FROM top WHERE n > 1 GROUP BY level, i // 8, n),
-- every node of a leaf's path but the root, numbered from the leaf up
path AS (SELECT l.tree, l.i AS leaf_i, u.level AS step, u.tree AS t, u.level, l.i // (8 ** u.level)::BIGINT AS at
         FROM leaves l JOIN (SELECT DISTINCT tree, level FROM up WHERE n > 1) u ON u.tree = l.tree
         UNION ALL
         SELECT l.tree, l.i, s.level + x.level, -1, x.level, l.tree // (8 ** x.level)::BIGINT
         FROM leaves l JOIN sub s ON s.tree = l.tree, (SELECT DISTINCT level FROM top WHERE n > 1) x),
node AS (SELECT tree, level, i, h FROM up UNION ALL SELECT -1, level, i, h FROM top),
step AS (SELECT p.tree, p.leaf_i, p.step, coalesce(string_agg(n.h, '' ORDER BY n.i) FILTER (n.i < p.at), '') AS l,
                coalesce(string_agg(n.h, '' ORDER BY n.i) FILTER (n.i > p.at), '') AS r
         FROM path p JOIN node n ON n.tree = p.t AND n.level = p.level AND n.i // 8 = p.at // 8 GROUP BY ALL),
fold AS (SELECT tree, i, 0 AS step, coalesce(tampered, leaf) AS h FROM leaves
         UNION ALL
         SELECT f.tree, f.i, f.step + 1, sha256(s.l || f.h || s.r) FROM fold f JOIN step s ON s.tree = f.tree AND s.leaf_i = f.i AND s.step = f.step),
folded AS (SELECT tree, i, arg_max(h, step) AS h FROM fold GROUP BY ALL),
proof AS (SELECT tree, leaf_i AS i, string_agg(l || r, '' ORDER BY step) AS siblings FROM step GROUP BY ALL)
SELECT doc_id, leaf, s.h AS subroot, (SELECT h FROM top WHERE n = 1) AS root, sha256(coalesce(siblings, '')) AS proof_sha256, f.h AS folded_root,
       f.h = (SELECT h FROM top WHERE n = 1) AS verified
FROM leaves JOIN sub s USING (tree) JOIN folded f USING (tree, i) LEFT JOIN proof USING (tree, i)
"""

OP11_SQL = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents),
piece AS (SELECT lang, unnest(regexp_split_to_array(x, '[.,;:!?\x0A-\x0D]')) AS p FROM t),
run AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM run GROUP BY 1),
size AS (SELECT unnest([1, 2, 3, 4]) AS m),
gram AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
         FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM run, size)),
freq AS (SELECT lang, phrase, m, count(*) AS f FROM gram GROUP BY ALL HAVING count(*) >= 30),
cut AS (SELECT lang, phrase, f AS a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS head, array_to_string(string_split(phrase, ' ')[k + 1:m], ' ') AS rest
        FROM (SELECT *, unnest(range(1, m)) AS k FROM freq WHERE m > 1)),
best AS (SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a) // (x.f + y.f) AS score
         FROM cut c JOIN freq x ON x.lang = c.lang AND x.phrase = c.head JOIN freq y ON y.lang = c.lang AND y.phrase = c.rest
         QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY (2000000::HUGEINT * c.a) // (x.f + y.f), k) = 1),
longer AS (SELECT lang, array_to_string(string_split(phrase, ' ')[i:i + s - 1], ' ') AS phrase, max(f) AS top
           FROM (SELECT *, unnest(range(1, m - s + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS s FROM freq WHERE m > 2)) GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN longer o USING (lang, phrase) WHERE o.top IS NULL OR 100::HUGEINT * o.top < 80::HUGEINT * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""
