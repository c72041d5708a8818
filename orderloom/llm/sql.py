"""SQL of the queries that it can express."""

from __future__ import annotations

from orderloom.llm import chat, mixing, topk, trie

_WORD = r"[^\x20\x09-\x0D]+"


def _mixing(rounds: int = mixing.ROUNDS) -> str:
    """Running sums over all documents of a source, in hash order, where the query
    refines histograms."""
    parts = [
        f"""
sizes AS (
  SELECT doc_id, coalesce('=' || source, '') AS key, source,
         len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size,
         substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, {mixing.ALL_DIGITS}) AS hash
  FROM documents),
totals AS (SELECT key, source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY ALL),
weighed AS (
  SELECT key, source_size, 3 * source_size AS most,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1 AS weight
  FROM totals),
shared AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER before, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS heft
  FROM weighed
  WINDOW before AS (ORDER BY most / weight, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goals AS (
  SELECT key, source_size,
         least(most::DOUBLE, coalesce((SELECT arg_max(level, heft) FROM shared WHERE level * weight <= most) * weight, 0)) AS target
  FROM shared),
wholes AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM goals),
state0 AS (
  SELECT key, '' AS floor, {(1 << 63) - 1} AS most, target - whole * source_size AS goal
  FROM wholes WHERE target - whole * source_size > 0)"""
    ]
    for turn in range(rounds):
        near = f"{'TRUE' if turn + 1 == rounds else 'FALSE'} AND 2 * (goal - (upto - words)) >= words"
        parts.append(f"""
rows{turn} AS (
  SELECT key, hash, any_value(s.goal) AS goal, sum(d.size) AS words
  FROM sizes d JOIN state{turn} s USING (key)
  WHERE d.size > 0 AND d.size <= s.most AND d.hash > s.floor GROUP BY ALL),
sums{turn} AS (
  SELECT *, sum(words) OVER (PARTITION BY key ORDER BY hash ROWS UNBOUNDED PRECEDING) AS upto FROM rows{turn}),
cut{turn} AS (
  SELECT key, hash AS cut, {near} AS with_it, goal - (upto - words) AS rest
  FROM sums{turn} WHERE upto >= goal AND upto - words < goal),
range{turn} AS (
  SELECT s.key, s.floor, s.most, c.cut, c.with_it, c.rest FROM state{turn} s LEFT JOIN cut{turn} c USING (key)),
state{turn + 1} AS (
  SELECT key, cut AS floor, floor(rest)::BIGINT AS most, rest AS goal FROM range{turn} WHERE cut IS NOT NULL AND rest > 0)""")
    ranges = " UNION ALL ".join(f"SELECT * FROM range{turn}" for turn in range(rounds))
    parts.append(f"""
ranges AS ({ranges})""")
    return (
        "WITH "
        + ",".join(parts)
        + """
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN EXISTS (
          SELECT 1 FROM ranges r
          WHERE r.key = d.key AND d.hash > r.floor AND d.size <= r.most
            AND (r.cut IS NULL OR d.hash < r.cut OR (d.hash = r.cut AND r.with_it))) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sizes d JOIN wholes USING (key)"""
    )


def _chat(part_turns: int = chat.PART_TURNS) -> str:
    """Turns joined to speakers, then text and spans gathered in order."""
    return f"""
WITH turns AS (
  SELECT conv_id, floor(turn / {part_turns}.0)::BIGINT AS part, turn, coalesce(role, '{chat.UNNAMED}') AS role,
         replace(coalesce(text, ''), '<|', '<\\|') AS text
  FROM conversations),
speakers AS (SELECT DISTINCT conv_id, role AS speaker FROM turns WHERE role <> '{chat.SYSTEM}'),
seen AS (
  SELECT t.conv_id, s.speaker, t.part, t.turn, t.role, t.text, t.role = s.speaker AS own,
         '{chat.OPEN}' || CASE WHEN t.role = s.speaker THEN 'assistant' WHEN t.role = '{chat.SYSTEM}' THEN t.role
                          ELSE 'user name=' || translate(replace(t.role, '<|', '<\\|'), chr(13) || chr(10), '  ') END || chr(10) AS head,
         t.text || '{chat.CLOSE}' AS body,
         row_number() OVER (PARTITION BY t.conv_id, s.speaker, t.part ORDER BY t.turn NULLS LAST, t.role, t.text) AS place
  FROM turns t JOIN speakers s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
placed AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (
    PARTITION BY conv_id, speaker, part ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS begun
  FROM seen),
parts AS (
  SELECT conv_id, speaker, part, count(*) AS turns, string_agg(head || body || chr(10), '' ORDER BY place) AS text,
         coalesce(string_agg(begun::BIGINT::VARCHAR || ':' || (begun + length(body))::BIGINT::VARCHAR, ',' ORDER BY place)
                  FILTER (own), '') AS mask
  FROM placed GROUP BY ALL)
SELECT conv_id, speaker, part, turns, text, mask, coalesce(sum(length(text)) OVER (
  PARTITION BY conv_id, speaker ORDER BY part NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
FROM parts"""


def _top_products() -> str:
    """All products of queries and rows, ranked."""
    return f"""
WITH usable AS (
  SELECT DISTINCT vec_id, [floor({topk.SCALE} * x::DOUBLE)::BIGINT FOR x IN embedding] AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, q.vector AS asked, c.vec_id,
         list_inner_product(q.vector::DOUBLE[], c.vector::DOUBLE[])::BIGINT AS score
  FROM usable q JOIN usable c ON (q.vec_id <> c.vec_id OR q.vector <> c.vector) AND len(q.vector) = len(c.vector)
  WHERE q.vec_id % {topk.QUERY_STRIDE} = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id, asked ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= {topk.K}"""


def _trie(family: int = trie.FAMILY, most: int = trie.SHARED_TURNS) -> str:
    """Every prefix of every rebuilt conversation, grouped; sums over all nodes above a node."""
    crc32 = (
        "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: unicode(c)::BIGINT)), "
        "lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), "
        "lambda a, _: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295)"
    )
    return f"""
WITH keyed AS (
  SELECT conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS key,
         len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS words
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({{'key': key, 'words': words}} ORDER BY turn NULLS FIRST, key) AS turns, {crc32} % {most} AS shared
  FROM keyed GROUP BY conv_id),
rebuilt AS (
  SELECT o.conv_id, list_concat(
           CASE WHEN o.shared = 0 OR f.turns IS NULL THEN [] ELSE f.turns[1:o.shared] END,
           CASE WHEN len(o.turns) > o.shared THEN o.turns[o.shared + 1:] ELSE [] END) AS path
  FROM own o LEFT JOIN own f ON f.conv_id = o.conv_id - o.conv_id % {family}),
members AS (
  SELECT conv_id, len(path) AS size, depth, list_transform(CASE WHEN depth = 0 THEN [] ELSE path[1:depth] END, lambda t: t.key) AS node,
         CASE WHEN depth = 0 THEN 0 ELSE path[depth].words END AS words
  FROM (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS depth FROM rebuilt)),
nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends_sha256
  FROM members GROUP BY node, depth),
above AS (
  SELECT node, conv_id, depth, n_convs, words, unnest(range(0, depth + 1)) AS at FROM nodes),
kids AS (
  SELECT CASE WHEN depth = 1 THEN [] ELSE node[1:depth - 1] END AS node, depth - 1 AS depth, count(*) AS n_children
  FROM nodes WHERE depth > 0 GROUP BY ALL),
sums AS (
  SELECT CASE WHEN a.at = 0 THEN [] ELSE a.node[1:a.at] END AS node, a.at AS depth,
         sum((a.n_convs - 1) * a.words) AS saved, count(*) FILTER (k.n_children IS NULL) AS n_leaves
  FROM above a LEFT JOIN kids k ON k.node = a.node AND k.depth = a.depth GROUP BY ALL)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves,
       s.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n
JOIN sums s ON s.node = n.node AND s.depth = n.depth
LEFT JOIN kids k ON k.node = n.node AND k.depth = n.depth
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.node = CASE WHEN n.depth = 1 THEN [] ELSE n.node[1:n.depth - 1] END"""


ORACLE: dict[str, str] = {
    "op3_exact_topk": _top_products(),
    "op4_chat_rotation": _chat(),
    "op9_mixing": _mixing(),
    "op12_prefix_trie": _trie(),
}
