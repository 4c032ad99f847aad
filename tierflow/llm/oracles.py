"""SQL counterparts of the queries that SQL can express, for the same tables."""

# Running words per source in shuffle order, the water level over the sources
# ordered by how early they fill up, and the words that either copy still gets.
MIX = r"""
WITH sized AS (
  SELECT doc_id, source,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    md5('mix' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key
  FROM documents
), placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
      - coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / weight, source NULLS LAST
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY 2 * source_size / weight, source NULLS LAST
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources
), targets AS (
  SELECT source, source_size,
    least(CAST(2 * source_size AS DOUBLE), max(level) OVER () * weight) AS target
  FROM levels
)
SELECT p.doc_id, p.source, p.size, t.source_size, t.target,
  CAST(greatest(0, least(p.size, floor(t.target) - p.before))
     + greatest(0, least(p.size, floor(t.target) - p.before - t.source_size)) AS BIGINT) AS taken
FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source
"""

# Every phrase of up to four words inside a piece, by language; the weakest cut of each
# candidate, and the most frequent candidate that is a word longer.
PHRASES = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), places AS (
  SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM worded WHERE len(w) > 0
), grams AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM places, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE i + m - 1 <= len(w)
), f AS (
  SELECT lang, phrase, any_value(m) AS m, count(*) AS f FROM grams GROUP BY lang, phrase
), sizes AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang
), candidates AS (
  SELECT lang, phrase, m, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m >= 2 AND f >= 30
), longer AS (
  SELECT lang, array_to_string(w[2:m], ' ') AS phrase, a FROM candidates WHERE m >= 3
  UNION ALL SELECT lang, array_to_string(w[1:m - 1], ' '), a FROM candidates WHERE m >= 3
), covering AS (
  SELECT lang, phrase, max(a) AS most FROM longer GROUP BY lang, phrase
), cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:m], ' ') AS rest
  FROM candidates, (SELECT unnest([1, 2, 3]) AS k) WHERE k < m
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
    CAST((CAST(2000000 AS HUGEINT) * c.a) // (x.f + y.f) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.first
  JOIN f y ON y.lang = c.lang AND y.phrase = c.rest
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, c.k) = 1
), ranked AS (
  SELECT s.lang, CAST(row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase) AS INTEGER) AS rank,
    s.phrase, s.a, s.l, s.r, s.score
  FROM scored s LEFT JOIN covering v ON v.lang = s.lang AND v.phrase = s.phrase
  WHERE coalesce(v.most, 0) * 100 < s.a * 80
)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, z.n, r.score
FROM ranked r JOIN sizes z ON z.lang = r.lang WHERE r.rank <= 2000
"""

# The digests of the turns themselves; the formatted length is that of the template
# with a backslash before each place that reads as a control string.
CHATS = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), shown AS (
  SELECT *, len(text) + len(regexp_extract_all(text, '\\|</?s>|\[/?INST\]|\[/?SYS\]|\[ROLE |\[/ROLE\]')) + 2 + CASE role
    WHEN 'user' THEN 13 WHEN 'system' THEN 11 WHEN 'assistant' THEN 4
    ELSE 14 + len(role) + len(regexp_extract_all(role, '\\|\]')) END AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(len(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(chars) AS BIGINT) AS formatted_chars
FROM shown GROUP BY conv_id
"""


def _clusters(rounds: int) -> str:
    """Rounds of assignment and floored means, each a pair of common tables."""
    distance = "list_sum(list_transform(list_zip(v.q, c.c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    steps = []
    for step in range(rounds + 1):
        steps.append(f"""near{step} AS (
  SELECT v.row, v.vec_id, v.q, c.cluster, CAST({distance} AS BIGINT) AS distance FROM kept v, centroids{step} c
  QUALIFY row_number() OVER (PARTITION BY v.row ORDER BY distance, c.cluster) = 1
)""")
        if step < rounds:
            steps.append(f"""parts{step} AS (
  SELECT cluster, i, sum(q[i]) AS s, count(*) AS n FROM near{step}, (SELECT unnest(generate_series(1, 64)) AS i)
  GROUP BY cluster, i
), centroids{step + 1} AS (
  SELECT c.cluster, coalesce(m.c, c.c) AS c FROM centroids{step} c LEFT JOIN (
    SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM parts{step} GROUP BY cluster
  ) m ON m.cluster = c.cluster
)""")
    return f"""
WITH kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q,
    row_number() OVER (ORDER BY vec_id, embedding) AS row
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), centroids0 AS (
  SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)) NULLS LAST, q) - 1 AS INTEGER) AS cluster, q AS c
  FROM kept QUALIFY cluster < 16
), {", ".join(steps)}
SELECT n.vec_id, n.cluster, n.distance,
  CAST(sum(n.distance) OVER (PARTITION BY n.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(n.distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM near{rounds} n JOIN centroids{rounds} c ON c.cluster = n.cluster
"""


ORACLES = {
    "op5_mix_sources": MIX,
    "op11_collocations": PHRASES,
    "op12_chat_format": CHATS,
    "op13_clusters": _clusters(3),
}
