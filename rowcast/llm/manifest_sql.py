"""DuckDB SQL for the Merkle manifest: the tree level by level, a climb per leaf.

A level's nodes are the pairs of the level below while more than one remains; a
climb joins the sibling of its node at each level, in its language's tree and then
in the tree over the subroots.  CRC-32 is folded bit by bit (polynomial
0xEDB88320)."""


def _field(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(length(doc_id::VARCHAR)),
    lambda i: [ascii((doc_id::VARCHAR)[i + 1])::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END) END),
  4294967295)"""


def _climb(name: str, start: str, nodes: str, same: str) -> str:
    return f"""
{name}(row, tree, idx, n, lvl, proof, folded) AS (
  {start}
  UNION ALL
  SELECT c.row, c.tree, c.idx // 2, (c.n + 1) // 2, c.lvl + 1, c.proof || coalesce(s.h, ''),
         sha256(CASE WHEN c.idx % 2 = 1 THEN s.h || c.folded ELSE c.folded || coalesce(s.h, '') END)
  FROM {name} c LEFT JOIN {nodes} s ON {same} s.lvl = c.lvl AND s.idx = c.idx + 1 - 2 * (c.idx % 2)
  WHERE c.n > 1)"""


MERKLE = f"""
WITH RECURSIVE
d AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf('n_chars')} AS leaf,
         CASE WHEN n_chars IS NOT NULL AND {_CRC} % 7 = 0 THEN {_leaf('n_chars + 1')} END AS bad
  FROM documents),
r AS (
  SELECT *, row_number() OVER () AS row, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
         count(*) OVER (PARTITION BY tree) AS n
  FROM d),
low(tree, lvl, idx, n, h) AS (
  SELECT tree, 0, idx, n, leaf FROM r
  UNION ALL
  SELECT tree, lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM low WHERE n > 1
  GROUP BY tree, lvl, idx // 2, (n + 1) // 2),
sub AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM low WHERE n = 1),
high(lvl, idx, n, h) AS (
  SELECT 0, idx, n, h FROM sub
  UNION ALL
  SELECT lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM high WHERE n > 1
  GROUP BY lvl, idx // 2, (n + 1) // 2),
{_climb('own', "SELECT row, tree, idx, n, 0, '', coalesce(bad, leaf) FROM r", 'low', 's.tree = c.tree AND')},
{_climb('all_up', '''SELECT o.row, o.tree, s.idx, s.n, 0, o.proof, o.folded FROM own o JOIN sub s ON s.tree = o.tree WHERE o.n = 1''', 'high', '')}
SELECT r.doc_id, r.leaf, sub.h AS subroot, top.h AS root, sha256(a.proof) AS proof_sha256, a.folded AS folded_root,
       a.folded = top.h AS verified
FROM all_up a JOIN r ON r.row = a.row JOIN sub ON sub.tree = r.tree, (SELECT h FROM high WHERE n = 1) top WHERE a.n = 1"""
