"""SQL twins of importance resampling, prefix tries and secret scans."""

from __future__ import annotations

#: ``crc(t)``: one row with the 256 entries of CRC-32's table, from its rule.
CRC_TABLE = """
crc AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_concat([i::ubigint], [0::ubigint FOR x IN range(8)]), lambda c, x:
             CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::ubigint) ELSE c >> 1 END) AS v
    FROM range(256) r(i))
)"""


def crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes; the query also reads ``crc``."""
    digits = f"hex(encode({text}))"
    octets = f"[('0x' || substr({digits}, 2 * i - 1, 2))::ubigint FOR i IN range(1, length({digits}) // 2 + 1)]"
    step = "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::bigint + 1])"
    return f"xor(list_reduce(list_concat([4294967295::ubigint], {octets}), {step}), 4294967295::ubigint)::bigint"


def features(name: str, table: str, key: str) -> str:
    """CTEs with the words of every text and the runs of one and two of them."""
    return f"""
{name}_words AS (
  SELECT {key} AS id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM {table}
),
{name}_features AS (
  SELECT id, unnest(list_concat(w, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))])) AS f FROM {name}_words
)"""


RESAMPLING = f"""
WITH {CRC_TABLE},
{features('source', 'documents', 'doc_id')},
{features('target', 'benchmark', 'item_id')},
bucket_of AS (
  SELECT f, {crc32('f')} % 10000 AS bucket
  FROM (SELECT f FROM source_features UNION SELECT f FROM target_features), crc
),
s AS (SELECT bucket, count(*) AS n FROM source_features JOIN bucket_of USING (f) GROUP BY 1),
t AS (SELECT bucket, count(*) AS n FROM target_features JOIN bucket_of USING (f) GROUP BY 1),
totals AS (
  SELECT (SELECT count(*) FROM source_features)::double AS s, (SELECT count(*) FROM target_features)::double AS t
),
gains AS (
  SELECT b AS bucket, floor(1000 * ln(((coalesce(t.n, 0) + 1)::double * (totals.s + 10000))
                                      / ((coalesce(s.n, 0) + 1)::double * (totals.t + 10000))))::bigint AS gain
  FROM totals, range(10000) r(b) LEFT JOIN s ON s.bucket = b LEFT JOIN t ON t.bucket = b
),
summed AS (
  SELECT id, count(*) AS n, floor(sum(gain) / count(*))::bigint AS weight
  FROM source_features JOIN bucket_of USING (f) JOIN gains USING (bucket) GROUP BY id
),
scored AS (
  SELECT id AS doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) >= 20 AS able,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((
           ('0x' || substr(sha256('7:' || coalesce(id::varchar, '')), 1, 8))::bigint + 0.5::double) / 4294967296)))::bigint AS score
  FROM source_words LEFT JOIN summed USING (id)
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) AS place,
         25 * count(*) FILTER (WHERE able) OVER () // 100 AS most
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= most THEN place END AS rank FROM ranked"""

PREFIX_TRIE = f"""
WITH {CRC_TABLE},
placed AS (
  SELECT conv_id, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS said,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS first, {crc32('conv_id::varchar')} % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM placed), crc
),
turns AS (
  SELECT c.conv_id, 0 AS part, place, said FROM convs c JOIN placed p ON p.conv_id = c.first AND p.place <= c.h
  UNION ALL
  SELECT c.conv_id, 1, place, said FROM convs c JOIN placed p ON p.conv_id = c.conv_id AND p.place > c.h
),
paths AS (
  SELECT conv_id, coalesce(list(said ORDER BY part, place) FILTER (WHERE said IS NOT NULL), []) AS path
  FROM convs LEFT JOIN turns USING (conv_id) GROUP BY conv_id
),
prefixes AS (
  SELECT conv_id, d AS depth, md5(path[:d]::varchar) AS key, CASE WHEN d > 0 THEN md5(path[:d - 1]::varchar) END AS parent,
         CASE WHEN d > 0 THEN strlen(path[d].text) ELSE 0 END AS size, d = len(path) AS is_end
  FROM (SELECT conv_id, path, unnest(range(len(path) + 1)) AS d FROM paths)
),
nodes AS (
  SELECT depth, key, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
         sha256(coalesce(string_agg(conv_id::varchar, ',' ORDER BY conv_id) FILTER (WHERE is_end), '')) AS ends_sha256
  FROM prefixes GROUP BY depth, key
),
children AS (SELECT depth - 1 AS depth, parent AS key, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1, 2),
counted AS (
  SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (depth, key)
),
below AS (
  SELECT DISTINCT a.depth, a.key, b.depth AS lower_depth, b.key AS lower_key
  FROM prefixes a JOIN prefixes b ON a.conv_id = b.conv_id AND a.depth <= b.depth
),
sums AS (
  SELECT below.depth, below.key, sum((n_convs - 1) * size)::bigint AS saved_tokens,
         count(*) FILTER (WHERE n_children = 0) AS n_leaves
  FROM below JOIN counted ON counted.depth = lower_depth AND counted.key = lower_key GROUP BY 1, 2
)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves, saved_tokens, c.ends_sha256
FROM counted c JOIN sums USING (depth, key) LEFT JOIN counted p ON p.depth = c.depth - 1 AND p.key = c.parent"""

ASSIGN = (
    "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
    "|[aA][pP][iI]_?[kK][eE][yY])[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
)


def spans(kind: str, place: int, pattern: str, group: int, shortest: int) -> str:
    """Spans of one kind: lengths of the texts between the matches and of the matches, added up."""
    return f"""
  SELECT doc, '{kind}' AS kind, {place} AS place, finish - length(found) AS start, finish
  FROM (
    SELECT doc, found, sum(length(gap) + length(found)) OVER (PARTITION BY doc ORDER BY k ROWS UNBOUNDED PRECEDING) AS finish
    FROM (
      SELECT doc, unnest(range(len(m))) AS k, unnest(m) AS found, unnest(string_split_regex(text, '{pattern}')[:len(m)]) AS gap
      FROM (SELECT doc, text, regexp_extract_all(text, '{pattern}') AS m FROM texts) WHERE len(m) > 0
    )
  ) WHERE length(regexp_extract(found, '{pattern}', {group})) >= {shortest}"""


BLOB_LEDGER = f"""
WITH texts AS (SELECT row_number() OVER () AS doc, doc_id, coalesce(text, '') AS text FROM documents),
found AS (
  {spans('assign', 0, ASSIGN, 2, 8)}
  UNION ALL {spans('access', 1, 'AKIA[A-Z0-9]+', 0, 16)}
  UNION ALL {spans('hex', 2, '[0-9a-f]+', 0, 32)}
  UNION ALL {spans('pem', 3, '-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----', 0, 1)}
),
joined AS (
  SELECT doc, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
         count(*) FILTER (WHERE kind = 'hex') AS n_hex,
         string_agg(kind || ':' || start::bigint || ':' || finish::bigint, ',' ORDER BY start, place) FILTER (WHERE place < 3) AS base,
         string_agg(kind || ':' || start::bigint || ':' || finish::bigint, ',' ORDER BY start, place) AS spans
  FROM found GROUP BY doc
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN joined USING (doc)"""

ORACLE: dict[str, str] = {
    "op11_resampling": RESAMPLING,
    "op12_prefix_trie": PREFIX_TRIE,
    "op13_blob_ledger": BLOB_LEDGER,
}
