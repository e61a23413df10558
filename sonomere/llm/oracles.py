"""The queries that SQL can express, as DuckDB SQL over the tables."""

from sonomere.llm.line_dedup import LONG, WINDOW


def deleted_runs(documents: str) -> str:
    """Common table expressions up to ``cut(doc_id, text, n_lines, kept)`` over a documents table."""
    return f"""
texts AS (SELECT doc_id, text, md5(text) AS text_key, string_split(text, chr(10)) AS lines
          FROM {documents} WHERE text IS NOT NULL),
one AS (SELECT DISTINCT * FROM texts),
every AS (SELECT doc_id, text_key, unnest(lines) AS x, generate_subscripts(lines, 1) - 1 AS line FROM one),
filled AS (SELECT doc_id, text_key, line, md5(x) AS hash, CASE WHEN length(x) >= {LONG} THEN 0 ELSE 1 END AS rank,
                  row_number() OVER (PARTITION BY doc_id, text_key ORDER BY line) - 1 AS pos,
                  count(*) OVER (PARTITION BY doc_id, text_key) AS n
           FROM every WHERE regexp_matches(x, '[^ \\t-\\r]')),
windows AS (SELECT doc_id, text_key, pos AS first, n,
                   min({{'rank': rank, 'hash': hash, 'pos': pos}}) OVER (PARTITION BY doc_id, text_key ORDER BY pos
                       ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS p
            FROM filled),
places AS (SELECT doc_id, text_key, p.hash AS hash, p.pos AS pos FROM windows WHERE first <= greatest(n - {WINDOW}, 0)
           UNION SELECT doc_id, text_key, hash, pos FROM filled WHERE rank = 0),
homes AS (SELECT hash, min({{'d': doc_id, 'k': text_key, 'p': pos}}) AS home FROM places GROUP BY hash),
diagonals AS (SELECT DISTINCT doc_id, text_key, home.d AS home_id, home.k AS home_key, pos - home.p AS shift
              FROM places JOIN homes USING (hash)
              WHERE {{'d': doc_id, 'k': text_key, 'p': pos}} > home),
equal AS (SELECT g.*, a.line, a.rank, a.pos
                 - row_number() OVER (PARTITION BY g.doc_id, g.text_key, home_id, home_key, shift ORDER BY a.pos) AS stretch
          FROM diagonals g
          JOIN filled a ON a.doc_id = g.doc_id AND a.text_key = g.text_key
          JOIN filled b ON b.doc_id = g.home_id AND b.text_key = g.home_key AND b.pos = a.pos - g.shift AND b.hash = a.hash),
runs AS (SELECT DISTINCT doc_id, text_key, first_line, last_line FROM (
           SELECT doc_id, text_key, home_id, home_key, shift, stretch,
                  min(line) AS first_line, max(line) AS last_line, count(*) AS n, min(rank) AS rank
           FROM equal GROUP BY ALL) WHERE n >= {WINDOW} OR rank = 0),
gone AS (SELECT DISTINCT doc_id, text_key, unnest(generate_series(first_line, last_line)) AS line FROM runs),
kept AS (SELECT e.doc_id, e.text_key, string_agg(x, chr(10) ORDER BY e.line) AS kept_text, count(*) AS n_kept
         FROM every e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.text_key = g.text_key AND e.line = g.line
         GROUP BY ALL),
cut AS (SELECT d.doc_id,
               CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept_text, '') END AS text,
               CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END AS n_lines,
               coalesce(n_kept, 0) AS n_kept
        FROM {documents} d LEFT JOIN kept k ON k.doc_id = d.doc_id AND k.text_key = md5(d.text))"""


# Base 32 from the hexadecimal form: five digits are four letters.
BASE32 = """array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr({hex}, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1)::BIGINT, 1)), '')"""

# CRC-32 of a text of ASCII characters, bit by bit: a byte is put in, then shifted out eight times.
CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split({text}, ''),
    lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295)"""


def leaf(values: list[str]) -> str:
    """Hash of some columns, given as text."""
    parts = " || ".join(f"coalesce(strlen({v})::VARCHAR || ':' || {v}, '-')" for v in values)
    return f"sha256({parts})"


def tree(name: str, source: str, key: str) -> str:
    """All nodes of the trees of ``source(key, pos, h, n)``: ``(key, level, place, h, n)``."""
    return f"""{name} AS (
  SELECT {key}, 0 AS level, pos AS place, h, n FROM {source}
  UNION ALL
  SELECT {key}, level + 1, place // 2, sha256(string_agg(h, '' ORDER BY place)), (n + 1) // 2
  FROM {name} WHERE n > 1 GROUP BY {key}, level, place // 2, n)"""


def steps(nodes: str, rows: str, key: str, out: str) -> str:
    """Siblings of every row of ``rows(key, pos)`` level by level, as side and digest."""
    return f"""{out} AS (
  SELECT r.{key} AS {key}, r.pos, list(CASE WHEN s.h IS NULL THEN '0' WHEN s.place % 2 = 0 THEN '1' || s.h
      ELSE '2' || s.h END ORDER BY o.level) FILTER (WHERE o.n > 1) AS steps
  FROM {rows} r JOIN {nodes} o ON r.{key} = o.{key} AND o.place = r.pos >> o.level
  LEFT JOIN {nodes} s ON s.{key} = o.{key} AND s.level = o.level AND s.place = xor(o.place, 1)
  GROUP BY r.{key}, r.pos)"""


ORACLES = {
    "op11_warc": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT page_id, strlen(html) AS size, sha1(html) AS h, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, size::BIGINT AS payload_bytes, {BASE32.format(hex="h")} AS payload_digest,
  CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first < page_id THEN first END AS refers_to
FROM g
""",
    "op12_merkle_manifest": f"""
WITH RECURSIVE d AS (
  SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE '1' || lang END AS tree,
    {leaf(["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", "text"])} AS h,
    {leaf(["doc_id::VARCHAR", "source", "lang", "(n_chars + 1)::VARCHAR", "text"])} AS changed,
    {CRC32.format(text="doc_id::VARCHAR")} % 7 = 0 AS tampered FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS pos,
    count(*) OVER (PARTITION BY tree) AS n FROM d),
{tree("nodes", "leaves", "tree")},
subroots AS (
  SELECT 1 AS one, tree, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
{tree("top", "subroots", "one")},
{steps("nodes", "leaves", "tree", "inner_steps")},
{steps("top", "subroots", "one", "outer_steps")},
paths AS (
  SELECT l.doc_id, l.h, CASE WHEN tampered THEN changed ELSE l.h END AS claimed, r.h AS subroot,
    list_concat(coalesce(i.steps, []), coalesce(o.steps, [])) AS path
  FROM leaves l JOIN inner_steps i ON i.tree = l.tree AND i.pos = l.pos
  JOIN subroots r ON r.tree = l.tree JOIN outer_steps o ON o.pos = r.pos),
folded AS (
  SELECT *, (SELECT h FROM top WHERE n = 1) AS root,
    list_reduce(list_concat([claimed], path), lambda a, b: CASE WHEN b[1] = '1' THEN sha256(b[2:] || a)
      ELSE sha256(a || b[2:]) END) AS folded_root FROM paths)
SELECT doc_id, h AS leaf, subroot, root,
  sha256(array_to_string(list_transform(path, lambda s: s[2:]), '')) AS proof_sha256,
  folded_root, folded_root = root AS verified
FROM folded
""",
    "op9_line_winnowing": f"""
WITH {deleted_runs("documents")}
SELECT doc_id, n_lines::BIGINT AS n_lines, (n_lines - n_kept)::BIGINT AS n_deleted, md5(text) AS text_md5 FROM cut
""",
}
