"""DuckDB SQL for the operators that SQL can express.

The statements follow the contracts, not the operators: full shingle sets, all
windows, all pairs. They are meant for small tables.
"""

from __future__ import annotations

import string

_WORDS = r"'[^\x20\x09-\x0D]+'"

_COMPONENTS = """reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b)"""

JACCARD = f"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), {_WORDS}) AS w FROM documents),
 n AS (SELECT doc_id, len(w) AS n FROM d), w AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d),
 g AS (SELECT doc_id, i, string_agg(x, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS g FROM w),
 s AS (SELECT DISTINCT doc_id, g FROM g JOIN n USING (doc_id) WHERE i <= greatest(n - 3, 1)),
 c AS (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id),
 p AS (SELECT s.doc_id AS a, t.doc_id AS b, count(*) AS k FROM s JOIN s t ON s.g = t.g AND s.doc_id <> t.doc_id GROUP BY ALL),
 link AS MATERIALIZED (SELECT a, b FROM p JOIN c x ON x.doc_id = a JOIN c y ON y.doc_id = b WHERE 100 * k >= 85 * (x.c + y.c - k)),
 {_COMPONENTS}, m AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, coalesce(c, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(m.b, doc_id)) AS component_id FROM documents LEFT JOIN c USING (doc_id) LEFT JOIN m ON m.a = doc_id"""

#: 32 digits of five bits from the 40 of four that sha1() gives.
_BASE32 = "list_aggregate(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(h, j // 4 * 5 + 1, 5))::BIGINT >> (15 - 5 * (j % 4))) & 31) + 1)::BIGINT, 1)), 'string_agg', '')"

WARC = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages), q AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS h, max(page_id) OVER (PARTITION BY html) AS newest FROM p)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest, CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> newest THEN newest END AS refers_to FROM q"""

EMBEDDINGS = f"""WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
 link AS MATERIALIZED (SELECT s.vec_id AS a, t.vec_id AS b FROM v s JOIN v t ON s.vec_id <> t.vec_id AND list_cosine_similarity(s.v, t.v) >= 0.9),
 {_COMPONENTS}, m AS (SELECT a, min(b) AS b FROM reach GROUP BY a), n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(m.b, vec_id)) AS component_id, vec_id <= coalesce(m.b, vec_id) AS kept FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN m ON m.a = vec_id"""

SUBSTRING = f"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS w FROM documents),
 w AS (SELECT doc_id, len(w) AS n, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d),
 k AS (SELECT doc_id, n, i, x, string_agg(x, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS k FROM w),
 r AS (SELECT doc_id, i, x, i <= n - 19 AND row_number() OVER (PARTITION BY i <= n - 19, k ORDER BY doc_id, i) > 1 AS again FROM k),
 c AS (SELECT doc_id, i, x, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM r),
 a AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, string_agg(x, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM c GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN a USING (doc_id)"""

_MASK = "18446744073709551615::UHUGEINT"


def _times(x: str, y: int) -> str:
    """x * y modulo 2**64; the product of two 64-bit numbers fits an UHUGEINT."""
    return f"(({x}) * {y}::UHUGEINT & {_MASK})"


def _plus(x: str, y: int) -> str:
    return f"(({x}) + {y}::UHUGEINT & {_MASK})"


#: xxHash64 of one long with seed 42, which keys are hashed with before they jump: constants of its definition.
_XX1, _XX2, _XX3, _XX4, _XX5 = 11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261
#: The reversed polynomial of CRC-32.
_CRC = 3988292384

SHARDS = f"""WITH RECURSIVE b AS (SELECT doc_id, coalesce(strlen(text), 0)::BIGINT + 1 AS size,
 xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::UBIGINT)),
  lambda c, y: list_reduce([xor(c, y), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], lambda a, z: xor(a >> 1, {_CRC}::UBIGINT * (a & 1)))))::BIGINT AS text_crc32 FROM documents),
 h0 AS (SELECT doc_id, {_times("CASE WHEN doc_id < 0 THEN doc_id::HUGEINT + 18446744073709551616 ELSE doc_id::HUGEINT END::UHUGEINT", _XX2)} AS k FROM b),
 h1 AS (SELECT doc_id, xor({_times(f"((k << 31) | (k >> 33)) & {_MASK}", _XX1)}, {42 + _XX5 + 8}::UHUGEINT) AS h FROM h0),
 h2 AS (SELECT doc_id, {_plus(_times(f"((h << 27) | (h >> 37)) & {_MASK}", _XX1), _XX4)} AS h FROM h1),
 h3 AS (SELECT doc_id, {_times("xor(h, h >> 33)", _XX2)} AS h FROM h2), h4 AS (SELECT doc_id, {_times("xor(h, h >> 29)", _XX3)} AS h FROM h3),
 j AS (SELECT doc_id, xor(h, h >> 32) AS state, -1::BIGINT AS at, 0::BIGINT AS next FROM h4
  UNION ALL SELECT doc_id, s, next, floor((next + 1)::DOUBLE * (2147483648::DOUBLE / ((s >> 33) + 1)::DOUBLE))::BIGINT FROM (SELECT doc_id, next, {_plus(_times("state", 2862933555777941757), 1)} AS s FROM j WHERE next < 17)),
 t AS (SELECT doc_id, max(next) FILTER (WHERE next < 16)::INT AS shard, max(next) FILTER (WHERE next < 17)::INT AS grown_shard FROM j GROUP BY doc_id)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id, size, text_crc32) - 1 AS slot, grown_shard FROM b JOIN t USING (doc_id)"""

ORACLES = {"op2_jaccard_join": JACCARD, "op3_warc_round_trip": WARC, "op5_jump_shards": SHARDS, "op7_rotation_codes": EMBEDDINGS, "op9_relative_lz": SUBSTRING}
