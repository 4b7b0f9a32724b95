"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

#: Unsigned CRC-32 (reflected polynomial 0xEDB88320) of a text's UTF-8 bytes, byte by byte over a table of 256 entries.
CRC_TABLE = """
crc_table AS (
  SELECT list(c ORDER BY n) AS t FROM (
    SELECT n, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n) AS c
    FROM range(256) AS r(n)))
"""


def crc32(text: str) -> str:
    return (
        f"xor(list_reduce(list_transform(range(strlen({text})), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT),"
        " lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295)"
    )


def shard(shards: int = 8) -> str:
    return f"""
WITH {CRC_TABLE},
sized AS (
  SELECT doc_id, coalesce(strlen(text), 0) + 1 AS size, {crc32("text")} AS text_crc32,
    coalesce(('0x' || substr(md5(text), 1, 15))::BIGINT, -1) AS k
  FROM documents, crc_table),
placed AS (
  SELECT *, coalesce(sum(size) OVER w, 0) AS before, sum(size) OVER () AS total FROM sized
  WINDOW w AS (ORDER BY k, doc_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
cut AS (
  SELECT *, least(floor((2 * before + size) * {shards} / (2 * total)), {shards} - 1)::INTEGER AS shard FROM placed)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
  (row_number() OVER (PARTITION BY shard ORDER BY k, doc_id NULLS FIRST) - 1)::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM cut
"""


MIX = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
    coalesce(('0x' || substr(md5('mix-1' || doc_id), 1, 15))::BIGINT, -1) AS turn
  FROM documents),
per_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM per_source),
weighed AS (
  SELECT *, [5, 2, 1][rank % 3 + 1] AS weight, 2 * source_size AS cap,
    (2 * source_size)::DOUBLE / [5, 2, 1][rank % 3 + 1] AS full_at FROM ranked),
budget AS (SELECT sum(source_size)::BIGINT * 150 // 100 AS words, sum(weight) AS weights FROM weighed),
levels AS (
  SELECT full_at, rank, (words - coalesce(sum(cap) OVER w, 0))::DOUBLE / (weights - coalesce(sum(weight) OVER w, 0)) AS level
  FROM weighed, budget WINDOW w AS (ORDER BY full_at, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
found AS (SELECT level FROM levels WHERE full_at >= level ORDER BY full_at, rank LIMIT 1),
queue AS (
  SELECT d.*, s.source_size, s.rank, s.weight, s.cap,
    sum(d.size) OVER (PARTITION BY s.rank ORDER BY d.turn, d.doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) AS ahead
  FROM sized d JOIN weighed s ON d.source IS NOT DISTINCT FROM s.source),
copies AS (
  SELECT *, (e * source_size + ahead)::DOUBLE / weight AS finish FROM queue, range(2) AS r(e)),
lined AS (
  SELECT *, sum(size) OVER (ORDER BY finish, rank, turn, doc_id NULLS FIRST, e ROWS UNBOUNDED PRECEDING) AS upto FROM copies)
SELECT doc_id, source, size::BIGINT AS size, source_size,
  CASE WHEN (SELECT count(*) FROM found) = 0 THEN cap::DOUBLE ELSE least(cap::DOUBLE, weight * (SELECT level FROM found)) END AS target,
  (size * count_if(upto <= (SELECT words FROM budget)))::BIGINT AS taken,
  count_if(upto <= (SELECT words FROM budget))::INTEGER AS copies
FROM lined GROUP BY ALL
"""
MIX = MIX.replace("FROM lined GROUP BY ALL", "FROM lined GROUP BY doc_id, source, size, source_size, cap, weight")


def licenses(templates: dict[str, tuple[str, ...]], least: float) -> str:
    rows = ", ".join(f"('{name}', {i}, '{wording}')" for name, wordings in sorted(templates.items()) for i, wording in enumerate(wordings))
    norm = "string_split(trim(regexp_replace(lower({}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ')"
    pairs = "list_transform(range(1, len({0})), lambda i: ({0})[i] || ' ' || ({0})[i + 1])"
    return f"""
WITH given AS (SELECT name, row_number() OVER (ORDER BY name, i) AS k, {norm.format("wording")} AS w FROM (VALUES {rows}) AS v(name, i, wording)),
templates AS (SELECT name, k, len(w) AS words, {pairs.format("w")} AS l, list_distinct({pairs.format("w")}) AS t FROM given),
ranked AS (
  SELECT k, len(t) AS m, b, row_number() OVER (PARTITION BY k ORDER BY instr(b, ' ') DESC, b) AS r FROM (SELECT k, t, unnest(t) AS b FROM templates)),
anchors AS (SELECT k, b FROM ranked WHERE r <= m - ceil(m * {least} / (2 - {least}) - 1e-9) + 1),
places AS (
  SELECT k, j, b FROM (SELECT k, unnest(l) AS b, generate_subscripts(l, 1) - 1 AS j FROM templates) JOIN anchors USING (k, b)),
texts AS (SELECT row_number() OVER () AS id, doc_id, {norm.format("coalesce(text, '')")} AS w FROM documents),
said AS (SELECT id, unnest({pairs.format("w")}) AS b, generate_subscripts({pairs.format("w")}, 1) - 1 AS i FROM texts),
starts AS (SELECT DISTINCT id, k, greatest(0, i - j) AS s FROM said JOIN places USING (b)),
windows AS (SELECT id, k, s, name, words, t, w[s + 1 : s + words] AS v FROM starts JOIN texts USING (id) JOIN templates USING (k)),
sets AS (SELECT id, k, s, name, words, t, list_distinct({pairs.format("v")}) AS p FROM windows),
hits AS (
  SELECT id, k, s, name, words, 2 * len(list_intersect(p, t))::DOUBLE / (len(p) + len(t)) AS dice
  FROM sets WHERE 2 * len(list_intersect(p, t))::DOUBLE / (len(p) + len(t)) >= {least}),
kept AS (
  SELECT * FROM hits AS h WHERE NOT EXISTS (
    SELECT 1 FROM hits AS g WHERE g.id = h.id AND g.name <> h.name AND g.s < h.s + h.words AND h.s < g.s + g.words
      AND (g.dice, g.words, -g.k) > (h.dice, h.words, -h.k))),
found AS (
  SELECT id, array_to_string(list_sort(list_distinct(list(name))), ';') AS licenses, arg_max(name, (dice, words, -k)) AS best_license,
    round(max(dice), 6) AS best_dice FROM kept GROUP BY id)
SELECT doc_id, coalesce(licenses, '') AS licenses, best_license, best_dice FROM texts LEFT JOIN found USING (id)
"""


URLS = r"""
WITH split AS (
  SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM split),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule FROM parts),
said AS (
  SELECT *, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS says FROM ruled),
hosts AS (
  SELECT host, count(*) FILTER (says = 'allow') / count(*)::DOUBLE AS allowed,
    count(*) FILTER (says = 'block') / count(*)::DOUBLE AS blocked FROM said WHERE host <> '' GROUP BY host),
links AS (
  SELECT DISTINCT host AS src, translate(regexp_extract(link, '^(?:[a-zA-Z]+:)?//([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst
  FROM (SELECT host, unnest(regexp_extract_all(html, '(?i)<(?:a|area|link|iframe)\s[^>]*?(?:href|src)\s*=\s*["'']?((?:https?:)?//[^"''\s>]+)', 1)) AS link FROM parts)),
edges AS (SELECT * FROM links WHERE src <> '' AND dst <> '' AND src <> dst),
trust_edges AS (SELECT src, dst, 0.85::DOUBLE / count(*) OVER (PARTITION BY src) AS part FROM edges),
against_edges AS (SELECT dst AS src, src AS dst, 0.85::DOUBLE / count(*) OVER (PARTITION BY dst) AS part FROM edges),
steps AS (
  WITH RECURSIVE wave AS (
    SELECT 0 AS step, 't' AS kind, host, allowed AS amount FROM hosts WHERE allowed > 0
    UNION ALL SELECT 0, 'd', host, blocked FROM hosts WHERE blocked > 0
    UNION ALL (
      SELECT step + 1, kind, dst, sum(amount * part) FROM (
        SELECT step, kind, dst, amount, part FROM wave JOIN trust_edges ON kind = 't' AND host = src
        UNION ALL SELECT step, kind, dst, amount, part FROM wave JOIN against_edges ON kind = 'd' AND host = src)
      WHERE step < 60 GROUP BY step, kind, dst))
  SELECT host, coalesce(sum(amount) FILTER (kind = 't'), 0) AS trust, coalesce(sum(amount) FILTER (kind = 'd'), 0) AS distrust FROM wave GROUP BY host)
SELECT page_id, host, path, rule,
  coalesce(says, CASE WHEN distrust - trust >= 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
  coalesce(trust, 0)::DOUBLE AS trust, coalesce(distrust, 0)::DOUBLE AS distrust
FROM said LEFT JOIN steps USING (host)
"""


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _leaf(text: str) -> str:
    fields = ("doc_id", "source", "lang", "n_chars", text)
    return "sha256(" + " || ".join(f"CASE WHEN {f} IS NULL THEN '-' ELSE strlen(({f})::VARCHAR) || ':' || ({f})::VARCHAR END" for f in fields) + ")"


def _tree(name: str, leaves: str) -> str:
    """Nodes (level, k, i, h, n) over ``leaves`` (k, i, h, n), and of each run's nodes what stands left and right of them."""
    return f"""
{name} AS (
  SELECT 0 AS level, k, i, h, n FROM {leaves}
  UNION ALL SELECT level + 1, k, i // 8, sha256(string_agg(h, '' ORDER BY i)), (n + 7) // 8 FROM {name} WHERE n > 1 GROUP BY level, k, i // 8, n),
{name}_runs AS (
  SELECT level, k, i, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name} WHERE n > 1 WINDOW w AS (PARTITION BY level, k, i // 8 ORDER BY i))"""


def merkle() -> str:
    lower = f"translate(text, '{_UPPER}', '{_UPPER.lower()}')"
    return f"""
WITH RECURSIVE {CRC_TABLE},
hashed AS (
  SELECT doc_id, coalesce('=' || lang, '') AS k, {_leaf("text")} AS h,
    CASE WHEN {crc32("doc_id::VARCHAR")} % 3 = 0 THEN {_leaf(lower)} ELSE {_leaf("text")} END AS claimed
  FROM documents, crc_table),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY k) AS n FROM hashed),
{_tree("nodes", "leaves")},
tops AS (
  SELECT k AS name, '' AS k, row_number() OVER (ORDER BY k) - 1 AS i, h, count(*) OVER () AS n FROM nodes WHERE n = 1),
{_tree("crown", "tops")},
climb AS (
  SELECT doc_id, k, h AS leaf, i AS id, 0 AS level, i, claimed AS folded, '' AS proof FROM leaves
  UNION ALL SELECT doc_id, k, leaf, id, c.level + 1, c.i // 8, sha256(l || folded || r), proof || l || r
  FROM climb c JOIN nodes_runs USING (level, k, i)),
up AS (
  SELECT doc_id, leaf, id, c.k AS name, 0 AS level, t.i, t.h AS subroot, folded, proof
  FROM (SELECT * FROM climb QUALIFY level = max(level) OVER (PARTITION BY k, id)) c JOIN tops t ON t.name = c.k
  UNION ALL SELECT doc_id, leaf, id, name, c.level + 1, c.i // 8, subroot, sha256(l || folded || r), proof || l || r
  FROM up c JOIN crown_runs s ON s.level = c.level AND s.i = c.i)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM (SELECT * FROM up QUALIFY level = max(level) OVER (PARTITION BY name, id)), (SELECT h AS root FROM crown WHERE n = 1)
"""


TRIE = rf"""
WITH {CRC_TABLE},
turns AS (
  SELECT conv_id AS c, md5(strlen(role) || ':' || role || text) AS name, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(role) || ':' || role || text)) - 1 AS r
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
sizes AS (SELECT c, count(*) AS own, {crc32("c::VARCHAR")} % 4 AS h FROM turns, crc_table GROUP BY c, t),
convs AS (
  SELECT a.c, a.h, a.c - a.c % 20 AS first, least(a.h, coalesce(b.own, 0)) AS taken FROM sizes a LEFT JOIN sizes b ON b.c = a.c - a.c % 20),
rebuilt AS (
  SELECT v.c, r + 1 AS d, name, words FROM convs v JOIN turns ON turns.c = first AND r < h
  UNION ALL SELECT v.c, taken + r - h + 1, name, words FROM convs v JOIN turns ON turns.c = v.c AND r >= h),
members AS (
  SELECT c, d, words, string_agg(name, '') OVER (PARTITION BY c ORDER BY d) AS key FROM rebuilt
  UNION ALL SELECT c, 0, 0, '' FROM convs),
nodes AS (SELECT d, key, min(c) AS c, count(*) AS n, min(words) AS words FROM members GROUP BY d, key),
kids AS (SELECT d - 1 AS d, left(key, 32 * (d - 1)) AS key, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
weighed AS (
  SELECT nodes.*, coalesce(kids.n, 0) AS children, p.c AS parent FROM nodes LEFT JOIN kids USING (d, key)
  LEFT JOIN nodes p ON p.d = nodes.d - 1 AND p.key = left(nodes.key, 32 * (nodes.d - 1))),
sums AS (
  SELECT m.d, m.key, count(*) FILTER (children = 0) AS leaves, sum((w.n - 1) * w.words) AS saved
  FROM weighed w JOIN members m ON m.c = w.c AND m.d <= w.d GROUP BY m.d, m.key),
ends AS (
  SELECT d, key, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends FROM (SELECT * FROM members QUALIFY d = max(d) OVER (PARTITION BY c)) GROUP BY d, key)
SELECT c AS conv_id, d::BIGINT AS depth, parent AS parent_conv_id, n AS n_convs, children AS n_children, leaves AS n_leaves, saved::BIGINT AS saved_tokens,
  coalesce(ends, sha256('')) AS ends_sha256
FROM weighed JOIN sums USING (d, key) LEFT JOIN ends USING (d, key)
"""
