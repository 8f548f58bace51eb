"""SQL for DuckDB of the registered queries that SQL can express."""

WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

OP7 = rf"""
WITH RECURSIVE rows AS (
  SELECT doc_id, source, {WORDS}::BIGINT AS size,
         md5('mix' || coalesce(doc_id::VARCHAR, '')) AS k
  FROM documents
), sources AS (
  SELECT source, source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
           WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source)
), levels AS (
  SELECT 0 AS step, -1::BIGINT AS clamped, 0.0::DOUBLE AS level
  UNION ALL
  SELECT step + 1, now.clamped,
         ((SELECT sum(source_size) FROM sources) - now.used) / now.free
  FROM levels, LATERAL (
    SELECT count(*) FILTER (WHERE 3 * source_size <= weight * levels.level) AS clamped,
           coalesce(sum(3 * source_size) FILTER (WHERE 3 * source_size <= weight * levels.level), 0)::DOUBLE AS used,
           coalesce(sum(weight) FILTER (WHERE NOT 3 * source_size <= weight * levels.level), 0) AS free
    FROM sources) now
  WHERE now.clamped <> levels.clamped AND now.free > 0
), targets AS (
  SELECT source, source_size,
         least((3 * source_size)::DOUBLE, weight * (SELECT level FROM levels ORDER BY step DESC LIMIT 1)) AS target
  FROM sources
), placed AS (
  SELECT doc_id, source, size,
         coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id NULLS FIRST, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
  FROM rows
), whole AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS times
  FROM targets
)
SELECT p.doc_id, p.size, w.source_size, w.target,
       (w.times + CASE WHEN p.ahead + p.size / 2.0::DOUBLE <= w.target - w.times * w.source_size THEN 1 ELSE 0 END)::BIGINT * p.size AS taken
FROM placed p JOIN whole w ON p.source IS NOT DISTINCT FROM w.source
"""

DIGEST = " || ".join(
    f"to_base(('0x' || substr(h, {5 * i + 1}, 5))::BIGINT, 32, 4)" for i in range(8)
)

OP8 = f"""
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h
  FROM pages
), digests AS (
  SELECT page_id, payload_bytes,
         translate({DIGEST}, '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
         min(page_id) OVER (PARTITION BY h) AS first_id
  FROM hashed
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM digests
"""

OP6 = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reached AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), counts AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
), lowest AS (
  SELECT a, min(b) AS component_id FROM reached GROUP BY a
)
SELECT v.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, l.component_id, v.vec_id = l.component_id AS kept
FROM embeddings v JOIN lowest l ON l.a = v.vec_id LEFT JOIN counts c ON c.a = v.vec_id
"""

def _crc_step(value: str) -> str:
    return f"xor({value} >> 1, CASE WHEN {value} & 1 = 1 THEN 3988292384 ELSE 0 END)"


def crc_table() -> str:
    """The 256 remainders of CRC-32 (polynomial edb88320, reflected), as a list ``t``."""
    steps = "SELECT i, i::BIGINT AS c FROM range(256) r(i)"
    for _ in range(8):
        steps = f"SELECT i, {_crc_step('c')} AS c FROM ({steps})"
    return f"crc_table AS (SELECT list(c ORDER BY i) AS t FROM ({steps}))"


def crc32(codes: str) -> str:
    """CRC-32 of a list of byte values, beside ``crc_table``."""
    step = "xor(c >> 8, t[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {step}), 4294967295)"


def bytes_of(text: str) -> str:
    """The values of a text's UTF-8 bytes."""
    return f"list_transform(regexp_extract_all(hex({text}), '..'), lambda x: ('0x' || x)::BIGINT)"


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    fields = [_field(c) for c in ("doc_id", "source", "lang", "n_chars")] + [_field(text)]
    return f"sha256({' || '.join(fields)})"


OP12 = f"""
WITH RECURSIVE {crc_table()}, leaves AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || source, '-') AS grp, {_leaf('text')} AS leaf,
    CASE WHEN {crc32(bytes_of('doc_id::VARCHAR'))} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS altered
  FROM documents, crc_table
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY grp) AS n
  FROM leaves
), tree AS (
  SELECT 0 AS level, grp, idx, n, leaf AS h FROM placed
  UNION ALL
  SELECT level + 1, grp, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx))
  FROM tree WHERE n > 1 GROUP BY level, grp, idx // 3, n
), subroots AS (
  SELECT grp, level AS height, h AS subroot, row_number() OVER (ORDER BY grp) - 1 AS place, count(*) OVER () AS n
  FROM tree WHERE n = 1
), top AS (
  SELECT 0 AS level, place AS idx, n, subroot AS h FROM subroots
  UNION ALL
  SELECT level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx))
  FROM top WHERE n > 1 GROUP BY level, idx // 3, n
), runs AS (  -- the steps of all paths: a level's runs of up to three nodes, of which the path takes one
  SELECT grp, level, idx // 3 AS run, list(h ORDER BY idx) AS nodes FROM tree WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT s.grp, s.height + t.level, t.run, t.nodes
  FROM subroots s, (SELECT level, idx // 3 AS run, list(h ORDER BY idx) AS nodes FROM top WHERE n > 1 GROUP BY ALL) t
  WHERE t.run = s.place // (3 ** (t.level + 1))::BIGINT
), folds AS (
  SELECT p.rid, p.grp, 0 AS level, p.idx, p.altered AS h, '' AS proof FROM placed p
  UNION ALL
  SELECT f.rid, f.grp, f.level + 1, i // 3,
    sha256(list_aggregate(list_concat(r.nodes[1:i % 3], [f.h], r.nodes[i % 3 + 2:3]), 'string_agg', '')),
    f.proof || coalesce(list_aggregate(list_concat(r.nodes[1:i % 3], r.nodes[i % 3 + 2:3]), 'string_agg', ''), '')
  FROM (SELECT x.*, CASE WHEN x.level = s.height THEN s.place ELSE x.idx END AS i
        FROM folds x JOIN subroots s USING (grp)) f
  JOIN runs r ON r.grp = f.grp AND r.level = f.level AND r.run = f.i // 3
), folded AS (
  SELECT rid, arg_max(h, level) AS folded_root, arg_max(proof, level) AS proof FROM folds GROUP BY rid
)
SELECT p.doc_id, p.leaf, s.subroot, t.h AS root, sha256(f.proof) AS proof_sha256, f.folded_root,
  f.folded_root = t.h AS verified
FROM placed p JOIN subroots s USING (grp) JOIN folded f USING (rid), (SELECT h FROM top WHERE n = 1) t
"""

OP10 = f"""
WITH {crc_table()}, rows AS (
  SELECT doc_id, source, strlen(coalesce(text, '')) + 8 AS size, md5('shard' || coalesce(doc_id::VARCHAR, '')) AS key,
    {crc32(bytes_of("coalesce(text, '')"))} AS text_crc32
  FROM documents, crc_table
), ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY source ORDER BY key, doc_id NULLS FIRST, size, text_crc32) - 1 + 0.5e0)
    / count(*) OVER (PARTITION BY source) AS rank
  FROM rows
), placed AS (
  SELECT *, count(*) OVER () AS total,
    row_number() OVER (ORDER BY rank, source NULLS LAST, key, doc_id NULLS FIRST, size, text_crc32) - 1 AS place
  FROM ranked
), cut AS (SELECT *, place * 24 // total AS shard FROM placed)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, shard::INTEGER AS shard,
  (place - (shard * total + 23) // 24)::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM cut
"""

ORACLE = {"op6_embeddings": OP6, "op7_mixing": OP7, "op8_warc": OP8, "op10_sharding": OP10, "op12_merkle": OP12}
