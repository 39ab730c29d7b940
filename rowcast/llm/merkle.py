"""Merkle manifest of a dataset, its proofs climbed by a recursive query.

Every row is a leaf; per language the leaves, by ascending doc_id, are hashed two
by two up to a subroot, and the subroots, by language, up to the root.  The built
levels are stored as node rows with a link to the node above.  A ``WITH
RECURSIVE`` query starts at every leaf, follows the links, appends the siblings
that it passes and folds the leaf's (perhaps tampered) hash with them; the leaf is
verified if the fold ends in the root.

A stored link spans ``SPAN`` levels: the row carries the siblings on the way, so a
climb of a billion leaves takes five steps, and the rows that a step shuffles are
few.  A node that many leaves climb to is stored in one copy per ``SHARE`` leaves
below it, and a leaf asks for the copy of its number, so no join key stands for
more rows than that, the root's included.

Positions come from a range sort (ties by the leaf's hash) with one summary row
per partition and language; blocks of ``2 ** SPAN`` nodes are hashed in a task
each.  Texts are read once and only digests move.

Defined cases: null fields are ``-``; a null language is the first; a null doc_id
is the first of its language, its leaf has ``-``, and is never tampered; repeated
rows are leaves of their own; an empty table gives an empty result; columns beside
the five hashed ones are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ranked, written

#: Levels that a stored link spans; a block has 2 ** SPAN nodes.
SPAN = 8
WIDTH = 1 << SPAN
#: Leaves that climb to one copy of a node.
SHARE = 4096
TAMPER_MOD = 7

STRIP_DDL = ("id string, tree string, idx long, n long, doc_id long, hash binary, start binary, path array<struct<l:binary,r:binary>>, "
             "up string, copies long, top binary, below long")


def field(value: Column) -> Column:
    """``-`` if null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(n_chars: Column) -> Column:
    """The leaf of a row of documents with that n_chars, 32 bytes."""
    parts = [F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text")]
    return F.unhex(F.sha2(F.concat(*map(field, parts)).cast("binary"), 256))


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, hash, start): a row's leaf, and that of the row as it is
    after tampering (the same for most).  ``tree`` orders as the language does."""
    n = F.col("n_chars").cast("long")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_MOD == 0
    return docs.select(F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("tree"),
                       F.col("doc_id").cast("long").alias("doc_id"), leaf_hash(n).alias("hash"),
                       F.when(tampered & n.isNotNull(), leaf_hash(n + 1)).alias("start"))


def _block(hashes: list[str], levels: int) -> tuple[list[list[tuple[bytes, bytes]]], str]:
    """Per node the siblings (left, right) on its way up, and the block's top."""
    paths: list[list[tuple[bytes, bytes]]] = [[] for _ in hashes]
    for k in range(levels):
        raw = [bytes.fromhex(h) for h in hashes]
        for i, path in enumerate(paths):
            at = i >> k
            path.append((raw[at - 1], b"") if at & 1 else (b"", raw[at + 1] if at + 1 < len(raw) else b""))
        hashes = [hashlib.sha256("".join(hashes[i:i + 2]).encode()).hexdigest() for i in range(0, len(hashes), 2)]
    return paths, hashes[0]


def strip(nodes: DataFrame, level: int, top: bool) -> DataFrame:
    """SPAN levels over ``nodes`` (id, tree, idx, n, doc_id, hash, start, below):
    each with the siblings on its way and its link to the node above."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            out: list[list] = [[] for _ in range(11)]
            left, right, cuts = [], [], [0]
            for tree, n, block, kids in zip(*(b.column(c).to_pylist() for c in ("tree", "n", "block", "kids")), strict=True):
                last = n <= WIDTH
                levels = (n - 1).bit_length() if last else SPAN
                paths, head = _block([k["hash"].hex() for k in kids], levels)
                below = sum(k["below"] for k in kids)
                up = f"{'top/' if top else ''}{level + 1}/{block}{tree}" if not last else None if top else f"top{tree}"
                for k, path in zip(kids, paths, strict=True):
                    left += [x for x, _ in path]
                    right += [x for _, x in path]
                    cuts.append(len(left))
                    for column, value in zip(out, (k["id"], tree, k["idx"], n, k["doc_id"], k["hash"], k["start"] or k["hash"],
                                                   up, -(-below // SHARE), bytes.fromhex(head), below), strict=True):
                        column.append(value)
            path = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["l", "r"]))
            text, number, raw = pa.string(), pa.int64(), pa.binary()
            kinds = (text, text, number, number, number, raw, raw, text, number, raw, number)
            c = [pa.array(x, t) for x, t in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*c[:7], path, *c[7:]], names=[x.split()[0] for x in STRIP_DDL.split(", ")])

    kids = F.sort_array(F.collect_list(F.struct("idx", "id", "doc_id", "hash", "start", "below")))
    blocks = nodes.groupBy("tree", "n", F.expr(f"idx div {WIDTH}").alias("block")).agg(kids.alias("kids"))
    return written(blocks.mapInArrow(run, STRIP_DDL), f"merkle-level-{level}")


def _levels(nodes: DataFrame, top: bool) -> list[DataFrame]:
    """All strips from ``nodes`` up, lowest first."""
    out = [strip(nodes, 0, top)]
    most = out[0].agg(F.max("n")).first()[0] or 0
    while most > WIDTH:
        none = F.lit(None)
        above = out[-1].where((F.col("n") > WIDTH) & (F.col("idx") % WIDTH == 0)).select(
            F.col("up").alias("id"), "tree", F.expr(f"idx div {WIDTH}").alias("idx"), F.expr(f"(n + {WIDTH - 1}) div {WIDTH}").alias("n"),
            none.cast("long").alias("doc_id"), F.col("top").alias("hash"), none.cast("binary").alias("start"), "below")
        out.append(strip(above, len(out), top))
        most = -(-most // WIDTH)
    return out


def manifest(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(leaf rows, node rows above them): the built tree, linked upwards.  Node
    rows stand in as many copies (``salt``) as leaves below them ask for."""
    own = ranked(written(leaves(docs), "merkle-leaves"), "tree", ["doc_id", "hash"], "merkle-order")
    low = _levels(own.withColumns({"id": F.lit(None).cast("string"), "below": F.lit(1).cast("long")}), False)
    ends = [s.where(f"n <= {WIDTH} and idx = 0").select("tree", F.col("top").alias("hash"), "below") for s in low]
    subroots = ends[0]
    for e in ends[1:]:
        subroots = subroots.unionByName(e)
    subroots = subroots.withColumns({"id": F.concat(F.lit("top"), F.col("tree")), "key": F.col("tree"), "tree": F.lit("")})
    high = _levels(ranked(subroots, "tree", ["key"], "merkle-subroots").drop("key").withColumns(
        {"doc_id": F.lit(None).cast("long"), "start": F.lit(None).cast("binary")}), True)
    # a leaf of the upper tree is a subroot; of a node's rows below the link is `below` of its block
    def linked(s: DataFrame, size: Column, subroot: bool) -> DataFrame:
        copies = F.ceil(size / SHARE)
        return s.select("id", "hash", "path", "up", "copies", "top", F.lit(subroot).alias("subroot"),
                        F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)).alias("salt"))

    sizes = {}
    for k, s in enumerate([*low, *high]):
        sizes[k] = s.where("up is not null").groupBy(F.col("up").alias("id")).agg(F.max("below").alias("size"))
    nodes = None
    for k, s in enumerate([*low, *high]):
        if k == 0:
            continue
        first_high = k == len(low)
        size = subroots.select("id", F.col("below").alias("size")) if first_high else sizes[k - 1]
        rows = linked(s.join(size, "id"), F.col("size"), first_high)
        nodes = rows if nodes is None else nodes.unionByName(rows)
    return low[0], written(nodes, "merkle-nodes")


CLIMB = """
WITH RECURSIVE climb AS (
  SELECT idx AS pos, doc_id, hash AS leaf,
         aggregate(path, start, (h, s) -> unhex(sha2(concat(lower(hex(s.l)), lower(hex(h)), lower(hex(s.r))), 256))) AS folded,
         aggregate(path, X'', (p, s) -> concat(p, s.l, s.r)) AS proof,
         CAST(NULL AS BINARY) AS subroot, top, up, copies
  FROM {leaves}
  UNION ALL
  SELECT c.pos, c.doc_id, c.leaf,
         aggregate(n.path, c.folded, (h, s) -> unhex(sha2(concat(lower(hex(s.l)), lower(hex(h)), lower(hex(s.r))), 256))),
         aggregate(n.path, c.proof, (p, s) -> concat(p, s.l, s.r)),
         CASE WHEN n.subroot THEN n.hash ELSE c.subroot END, n.top, n.up, n.copies
  FROM climb c JOIN {nodes} n ON n.id = c.up AND n.salt = pmod(c.pos, c.copies))
SELECT doc_id, lower(hex(leaf)) AS leaf, lower(hex(subroot)) AS subroot, lower(hex(top)) AS root,
       sha2(lower(hex(proof)), 256) AS proof_sha256, lower(hex(folded)) AS folded_root, folded = top AS verified
FROM climb WHERE up IS NULL"""

_ROWS = "spark.sql.cteRecursionRowLimit"


def climbed(spark: SparkSession, leaf_rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """One row per leaf: what its climb to the root has gathered.  The recursion
    runs here, once, without Spark's limit on its rows (a setting of the session
    that is put back)."""
    before = spark.conf.get(_ROWS, None)
    spark.conf.set(_ROWS, "-1")
    try:
        return written(spark.sql(CLIMB, leaves=leaf_rows, nodes=nodes), "merkle-proofs")
    finally:
        spark.conf.unset(_ROWS) if before is None else spark.conf.set(_ROWS, before)


def proofs(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    return climbed(docs.sparkSession, *manifest(docs))
