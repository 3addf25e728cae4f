"""DuckDB SQL for the queries of this folder that SQL can express."""

ORACLES = {}

#: Conversations: CRC-32 by a table, then a recursion over rows and states that keeps
#: the least (cost, letters) per state. The letters here are plain strings.
ORACLES["op11_conversation_repair"] = r"""
WITH RECURSIVE bits AS (
  SELECT i, 0 AS k, i AS c FROM range(256) r(i)
  UNION ALL
  SELECT i, k + 1,
         CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
  FROM bits WHERE k < 8
), crc AS (SELECT list(c ORDER BY i) AS steps FROM bits WHERE k = 8),
hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(
             string_split(coalesce(conv_id::VARCHAR, ' ') || ':'
                          || coalesce(turn::VARCHAR, ' '), ''),
             lambda x: ascii(x)::BIGINT)),
           lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))) % 20 AS kind
  FROM conversations, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g')
              ELSE text END AS text,
         unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM hashed
), flagged AS (
  SELECT *, left(role, 1) AS initial,
         rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))
           AS stripped,
         row_number() OVER (PARTITION BY conv_id
           ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS n
  FROM damaged
), judged AS (
  SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY n) AS before,
         CASE WHEN stripped = '' THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1
                THEN 'duplicate'
              WHEN right(stripped, 1) NOT IN ('.', '!', '?') THEN 'truncated'
              ELSE 'none' END AS fault
  FROM flagged
), counts AS (
  SELECT conv_id,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (n > 1 AND before || initial NOT IN ('su', 'ua', 'au'))
           AS illegal,
         count(*) AS rows_left
  FROM judged GROUP BY conv_id
), moves(state, initial, target) AS (
  VALUES ('e', 's', 's'), ('e', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'),
         ('a', 'u', 'u')
), inserts(state, landed, letters, cost) AS (
  SELECT state, state, '', 0 FROM (VALUES ('e'), ('s'), ('u'), ('a')) v(state)
  UNION ALL SELECT state, target, 'I', 5 FROM moves WHERE initial <> 's'
  UNION ALL SELECT m.state, k.target, 'II', 10 FROM moves m
  JOIN moves k ON k.state = m.target AND k.initial <> 's' WHERE m.initial <> 's'
), search AS (
  SELECT conv_id, 0::BIGINT AS n, 'e' AS state, {'cost': 0, 'letters': ''} AS path
  FROM counts
  UNION ALL
  SELECT s.conv_id, s.n + 1, e.target,
         min({'cost': s.path.cost + e.cost, 'letters': s.path.letters || e.letters})
  FROM search s JOIN judged j ON j.conv_id IS NOT DISTINCT FROM s.conv_id
                             AND j.n = s.n + 1,
  LATERAL (
    SELECT i.landed AS target, i.cost + 2 AS cost, i.letters || 'D' AS letters
    FROM inserts i WHERE i.state = s.state
    UNION ALL
    SELECT m.target, i.cost + CASE WHEN o.letter = 'R' THEN 1 ELSE 0 END
             + CASE WHEN j.fault = 'truncated' THEN 5 ELSE 0 END,
           i.letters || o.letter
    FROM inserts i JOIN moves m ON m.state = i.landed,
         (VALUES ('K'), ('R')) o(letter)
    WHERE i.state = s.state AND j.fault NOT IN ('blank', 'duplicate')
      AND CASE WHEN o.letter = 'K' THEN m.initial = j.initial
               ELSE m.initial <> 's' END
  ) e
  GROUP BY s.conv_id, s.n + 1, e.target
), best AS (
  SELECT c.conv_id,
         min({'cost': s.path.cost + i.cost, 'letters': s.path.letters || i.letters})
           AS path
  FROM search s JOIN counts c ON c.conv_id IS NOT DISTINCT FROM s.conv_id
                             AND c.rows_left = s.n
  JOIN inserts i ON i.state = s.state AND i.landed IN ('e', 'a')
  GROUP BY c.conv_id
), letters AS (
  SELECT conv_id, p AS place, substr(path.letters, p::INT, 1) AS letter,
         len(replace(left(path.letters, p::INT), 'I', '')) AS n
  FROM best, LATERAL (SELECT unnest(range(1, len(path.letters) + 1)) AS p)
), left_rows AS (
  SELECT l.conv_id, l.place, l.letter, j.role, j.initial,
         CASE WHEN l.letter = 'I' THEN '' ELSE j.text END AS text,
         row_number() OVER (PARTITION BY l.conv_id ORDER BY l.place) AS spot
  FROM letters l LEFT JOIN judged j
    ON j.conv_id IS NOT DISTINCT FROM l.conv_id AND j.n = l.n AND l.letter <> 'I'
  WHERE l.letter <> 'D'
), starts AS (
  SELECT *, max(CASE WHEN spot = 1 AND letter = 'K' AND initial = 's' THEN 1 ELSE 0 END)
              OVER (PARTITION BY conv_id) AS shift
  FROM left_rows
), digests AS (
  SELECT conv_id, sha256(string_agg(
           CASE WHEN letter = 'K' THEN role
                WHEN (spot - shift) % 2 = 1 THEN 'user' ELSE 'assistant' END
           || ':' || text, chr(10) ORDER BY spot)) AS digest
  FROM starts GROUP BY conv_id
)
SELECT o.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank,
       coalesce(c.duplicate, 0) AS duplicate, coalesce(c.truncated, 0) AS truncated,
       coalesce(c.illegal, 0) AS illegal, coalesce(b.path.cost, 0)::BIGINT AS cost,
       coalesce(b.path.letters, '') AS audit,
       coalesce(d.digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN digests d ON d.conv_id IS NOT DISTINCT FROM o.conv_id
"""

#: Mixing: one window over each source in place of buckets, and the level of the
#: targets found among the sources in order of their cap for each weight.
ORACLES["op12_source_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::DOUBLE AS size
  FROM documents
), drawn AS (
  SELECT doc_id, source, size, md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(text)) AS h,
         greatest(0.05::DOUBLE, size / (size + 20.0::DOUBLE) * (size / greatest(
           1, size + length(text)
             - length(regexp_replace(text, '[#*$%&|<>]', '', 'g'))))) AS quality
  FROM sized
), keyed AS (
  SELECT *, -ln((('0x' || substr(h, 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496)
            / quality AS key
  FROM drawn
), sources AS (
  SELECT source, sum(size) AS words,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM keyed GROUP BY source
), levels AS (
  SELECT *, sum(words) OVER () AS everything, sum(weight) OVER () AS weights,
         coalesce(sum(3 * words) OVER below, 0) AS held,
         coalesce(sum(weight) OVER below, 0) AS gone
  FROM sources
  WINDOW below AS (ORDER BY words / weight, source NULLS LAST
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), share AS (
  SELECT (everything - held) AS rest, weights - gone AS among FROM levels
  WHERE 3 * words >= (everything - held) * weight / (weights - gone)
  ORDER BY words / weight, source NULLS LAST LIMIT 1
), planned AS (
  SELECT source, words,
         least(3 * words, rest * weight / among) AS target
  FROM sources, share
), placed AS (
  SELECT k.doc_id, k.size, p.words, p.target, floor(p.target + 0.5) AS budget,
         coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY key, doc_id, h
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
  FROM keyed k JOIN planned p ON p.source IS NOT DISTINCT FROM k.source
)
SELECT doc_id, size::BIGINT AS size, words::BIGINT AS source_size, target,
       (size * floor(budget / greatest(words, 1))
        + greatest(0, least(size, budget % greatest(words, 1)::DOUBLE - earlier)))::BIGINT
         AS taken
FROM placed
"""


def _clustering(rounds: int, centroids: int) -> str:
    """Rounds written out one after the other, every distance computed in full."""
    text = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding,
           lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings
  WHERE len(embedding) = 64 AND list_count(embedding) = 64
    AND len(list_filter(embedding, lambda x: isfinite(x))) = 64
), c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id::VARCHAR), e) - 1 AS cluster, e
  FROM v QUALIFY cluster < {centroids}
)"""
    for r in range(rounds + 1):
        text += f""",
a{r} AS (
  SELECT v.vec_id, min({{
      'distance': list_sum(list_transform(list_zip(v.e, c.e),
                    lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT,
      'cluster': c.cluster}}) AS found, any_value(v.e) AS e
  FROM v CROSS JOIN c{r} c GROUP BY v.vec_id
)"""
        if r < rounds:
            text += f""",
c{r + 1} AS (
  SELECT c.cluster, coalesce(m.e, c.e) AS e
  FROM c{r} c LEFT JOIN (
    SELECT cluster, list((total - ((total % n) + n) % n) // n ORDER BY place)::BIGINT[] AS e
    FROM (SELECT cluster, place, sum(x) AS total, count(*) AS n
          FROM (SELECT found.cluster AS cluster, unnest(e) AS x,
                       unnest(range(64)) AS place FROM a{r})
          GROUP BY ALL) GROUP BY cluster
  ) m ON m.cluster = c.cluster
)"""
    return text + f"""
SELECT a.vec_id, c.cluster::INT AS cluster, found.distance AS distance,
       sum(found.distance) OVER (PARTITION BY c.cluster)::BIGINT AS cluster_inertia,
       sum(found.distance) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.cluster = a.found.cluster
"""


ORACLES["op13_centroid_clustering"] = _clustering(rounds=5, centroids=40)
