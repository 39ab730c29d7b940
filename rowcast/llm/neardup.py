"""Near-duplicates by a chosen-path set similarity join.

A document is the set of its distinct five-word shingles, embedded as a vector
of minwise tokens.  Independent trees branch the documents: at a node the path
alone chooses a few coordinates, and a document goes to one child for each,
named by its minwise token there, so similar documents share many paths and
others few.  Small nodes are compared exhaustively.

Groups of copies don't make a node large for ever.  Equal sets are one vertex
from the start.  Each node of a tree's first level links its rows to one of
them by an exact test: the pivot, the row whose own nodes are the fullest, which
is a group's centre.  Only rows that are still in different components matter
below: a node of one component is done, and one in which few rows are outside
its largest component compares those with all others, in blocks.  What remains
of a large node branches again, up to ``DEPTH`` levels; what is then still large
is compared in blocks, every block with every other, so nothing is dropped.

Sketches only choose what is compared; every link is confirmed on the full sets
(100 * intersection >= 75 * union).  With ``TREES`` * ``BRANCHES`` first-level
coordinates a pair at similarity 0.75 shares none with probability
0.25 ** 12, about 6e-8; the sketch test passes it with probability 1 - 1e-5.

Defined cases: a text without words, or null, is an empty set linked with
nothing; a text of fewer words is one shingle; repeated rows are equal sets; a
null doc_id names no component unless all ids of the component are null; an
empty table gives an empty result; only doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import texthash
from .common import binary_rows, written
from .components import components

WORDS = 5
#: Similarity as a fraction: NUM / DEN.
NUM, DEN = 75, 100
TOKENS = 128
TREES, BRANCHES = 6, 2
#: Rows that a node may hold to be compared exhaustively in one task.
LEAF = 4096
DEPTH = 5
#: Share of equal minwise tokens below which a pair isn't confirmed on its sets.
SKETCH = 0.58

SET_DDL = "doc_id long, text_key long, set_id binary, n int, sketch binary, nodes array<long>"


def _sketch(g: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(rows, TOKENS) minwise tokens of 32 bits; rows keep the low 16 of each."""
    rows = len(bounds) - 1
    out = np.empty((rows, TOKENS), np.uint32)
    flip, times = texthash.seeds(TOKENS, 31), texthash.seeds(TOKENS, 37) | np.uint64(1)
    for k in range(TOKENS):
        v = ((g ^ flip[k]) * times[k] >> np.uint64(32)).astype(np.uint32)
        out[:, k] = texthash.per_row(np.minimum, v, bounds, np.uint32(0))
    return out


def _children(path: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """(rows, BRANCHES) child paths: the path chooses the coordinates, the row's
    tokens there name the children."""
    out = np.empty((len(path), BRANCHES), np.uint64)
    for b in range(BRANCHES):
        at = (texthash.mix(path + np.uint64(b + 1)) % np.uint64(TOKENS)).astype(np.int64)
        if b:  # another coordinate than the first one's
            at = np.where(at == first, (at + 1) % TOKENS, at)
        first = at if not b else first
        token = sketch[np.arange(len(path)), at].astype(np.uint64)
        out[:, b] = texthash.mix(texthash.mix(path ^ at.astype(np.uint64)) + token)
    return out


def _roots(sketch: np.ndarray) -> np.ndarray:
    """First-level paths: TREES * BRANCHES different coordinates."""
    at = np.random.RandomState(7).permutation(TOKENS)[:TREES * BRANCHES]
    return texthash.mix((sketch[:, at].astype(np.uint64) << np.uint64(8)) + at.astype(np.uint64))


def _text_key():
    """Which row it is, up to rows of equal doc_id and text."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("text_key")


def sets(docs: DataFrame) -> DataFrame:
    """One row per document: its set's id (a 128-bit digest; null if empty),
    size, sketch and first-level nodes (SET_DDL)."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            body, offsets = binary_rows(b.column("text"))
            for i, j in texthash.ranges(offsets):
                g, bounds = texthash.shingle_sets(body[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], WORDS)
                n = np.diff(bounds)
                halves = [texthash.per_row(np.add, texthash.mix(g + s), bounds, np.uint64(0)) for s in texthash.seeds(2, 41)]
                ids = np.stack(halves, 1).astype("<u8").tobytes()
                sk = _sketch(g, bounds)
                full = n > 0
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, j - i), b.column("text_key").slice(i, j - i),
                     pa.array([ids[16 * r:16 * r + 16] if full[r] else None for r in range(j - i)], pa.binary()),
                     pa.array(n, pa.int32()),
                     pa.array([sk[r].astype("<u2").tobytes() if full[r] else None for r in range(j - i)], pa.binary()),
                     pa.array([x if full[r] else None for r, x in enumerate(_roots(sk).view(np.int64))], pa.list_(pa.int64()))],
                    names=["doc_id", "text_key", "set_id", "n", "sketch", "nodes"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       _text_key()).mapInArrow(run, SET_DDL)


def _size_fits(a: str, b: str):
    return F.least(a, b) * DEN >= F.greatest(a, b) * NUM


def _likely(pairs: DataFrame) -> DataFrame:
    """Pairs (u, v, n_u, n_v, key_u, key_v, sketch_u, sketch_v) whose sketches agree."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                x, y = (np.frombuffer(binary_rows(b.column(c))[0].tobytes(), "<u2").reshape(-1, TOKENS)
                        for c in ("sketch_u", "sketch_v"))
                keep = (x == y).sum(1) >= SKETCH * TOKENS
                import pyarrow as pa
                yield b.filter(pa.array(keep)).select(["u", "v", "key_u", "key_v"])
    return (pairs.where(_size_fits("n_u", "n_v")).select("u", "v", "key_u", "key_v", "sketch_u", "sketch_v")
            .mapInArrow(run, "u binary, v binary, key_u long, key_v long"))


def _similar(a: np.ndarray, b: np.ndarray) -> bool:
    if min(len(a), len(b)) * DEN < max(len(a), len(b)) * NUM:
        return False
    at = np.searchsorted(a, b)
    both = int((a[np.minimum(at, len(a) - 1)] == b).sum())
    return both * DEN >= (len(a) + len(b) - both) * NUM


def _column_sets(column) -> list[np.ndarray]:
    body, offsets = binary_rows(column)
    out = []
    for i, j in texthash.ranges(offsets):
        g, bounds = texthash.shingle_sets(body[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], WORDS)
        out += [g[bounds[r]:bounds[r + 1]] for r in range(j - i)]
    return out


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of ``pairs`` (u, v, key_u, key_v) that are links on their full sets."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            if b.num_rows:
                keep = [_similar(x, y) for x, y in zip(_column_sets(b.column("text_u")), _column_sets(b.column("text_v")),
                                                       strict=True)]
                yield b.filter(pa.array(keep, pa.bool_())).select(["u", "v"])
    full = (pairs.join(texts.select(F.col("text_key").alias("key_u"), F.col("text").alias("text_u")), "key_u")
            .join(texts.select(F.col("text_key").alias("key_v"), F.col("text").alias("text_v")), "key_v"))
    return full.select("u", "v", "text_u", "text_v").mapInArrow(run, "u binary, v binary")


class _Forest:
    """Union-find over the rows of a node."""

    def __init__(self, labels: list):
        self.up = list(range(len(labels)))
        first: dict = {}
        for i, label in enumerate(labels):
            self.join(i, first.setdefault(label, i))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> None:
        self.up[self.find(i)] = self.find(j)


def _groups(batches, key: str):
    """(rows) of each key of a stream sorted by it, as Arrow tables."""
    import pyarrow as pa

    held = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1), b.num_rows]
        for i, j in zip(cuts, cuts[1:], strict=False):
            if held and k[i] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(i, j - i))
            last = k[i]
    if held:
        yield pa.Table.from_batches(held)


def _by_node(rows: DataFrame, key: str) -> DataFrame:
    return rows.repartition(key).sortWithinPartitions(key)


def _clusters(rows: DataFrame) -> DataFrame:
    """Small nodes (node, set_id, label, n, sketch) to the clusters of rows that
    sketches join across labels: (cluster, set_id, label).  Equal clusters of
    different nodes have one name."""
    def run(batches):
        import pyarrow as pa

        for t in _groups(batches, "node"):
            m = t.num_rows
            t = t.combine_chunks()
            sk = np.frombuffer(b"".join(t.column("sketch").to_pylist()), "<u2").reshape(m, TOKENS)
            n = t.column("n").to_numpy().astype(np.int64)
            labels, ids = t.column("label").to_pylist(), t.column("set_id").to_pylist()
            code = np.unique(np.array(labels, object), return_inverse=True)[1]
            forest, hit = _Forest(list(range(m))), np.zeros(m, bool)
            for i in range(m - 1):
                near = ((sk[i + 1:] == sk[i]).sum(1) >= SKETCH * TOKENS) & (code[i + 1:] != code[i])
                near &= np.minimum(n[i + 1:], n[i]) * DEN >= np.maximum(n[i + 1:], n[i]) * NUM
                for j in np.flatnonzero(near) + i + 1:
                    forest.join(i, int(j))
                    hit[i] = hit[j] = True
            parts: dict[int, list[int]] = {}
            for i in np.flatnonzero(hit):
                parts.setdefault(forest.find(int(i)), []).append(int(i))
            for own in parts.values():
                own.sort(key=ids.__getitem__)
                name = texthash.mix(np.frombuffer(b"".join(ids[i] for i in own), np.uint64)
                                    * texthash.seeds(2 * len(own), 43)).sum(dtype=np.uint64).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(name)] * len(own), pa.int64()), pa.array([ids[i] for i in own], pa.binary()),
                     pa.array([labels[i] for i in own], pa.binary())], names=["cluster", "set_id", "label"])

    return _by_node(rows.select("node", "set_id", "label", "n", "sketch"), "node").mapInArrow(
        run, "cluster long, set_id binary, label binary").dropDuplicates(["cluster", "set_id"])


def _exhaustive(rows: DataFrame) -> DataFrame:
    """Links (u, v) within each cluster (cluster, set_id, label, sketch, text),
    on full sets.  A row meets the likeliest others first, and a pair that is
    connected already isn't compared."""
    def run(batches):
        import pyarrow as pa

        for t in _groups(batches, "cluster"):
            t = t.combine_chunks()
            own = [s for c in t.column("text").chunks for s in _column_sets(c)]
            ids, forest, links = t.column("set_id").to_pylist(), _Forest(t.column("label").to_pylist()), []
            sk = np.frombuffer(b"".join(t.column("sketch").to_pylist()), "<u2").reshape(len(own), TOKENS)
            n = np.array([len(x) for x in own])
            for i in range(len(own) - 1):
                agree = (sk[i + 1:] == sk[i]).sum(1)
                fits = np.minimum(n[i + 1:], n[i]) * DEN >= np.maximum(n[i + 1:], n[i]) * NUM
                near = np.flatnonzero(fits & (agree >= SKETCH * TOKENS))
                for j in (near[np.argsort(-agree[near], kind="stable")] + i + 1).tolist():
                    if forest.find(i) != forest.find(j) and _similar(own[i], own[j]):
                        forest.join(i, j)
                        links.append((ids[i], ids[j]))
            if links:
                u, v = zip(*links, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary())], names=["u", "v"])

    return _by_node(rows, "cluster").mapInArrow(run, "u binary, v binary")


def _branch(rows: DataFrame) -> DataFrame:
    """Rows of large nodes, one level down."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            if b.num_rows:
                sk = np.frombuffer(binary_rows(b.column("sketch"))[0].tobytes(), "<u2").reshape(-1, TOKENS)
                kids = _children(b.column("node").to_numpy().view(np.uint64), sk).view(np.int64)
                for k in range(BRANCHES):
                    yield pa.RecordBatch.from_arrays([pa.array(kids[:, k].copy(), pa.int64()),
                                                      *(b.column(c) for c in ("set_id", "label", "n", "sketch"))],
                                                     names=["node", "set_id", "label", "n", "sketch"])

    ddl = "node long, set_id binary, label binary, n int, sketch binary"
    return rows.select("node", "set_id", "label", "n", "sketch").mapInArrow(run, ddl)


def _open_nodes(rows: DataFrame) -> DataFrame:
    """Rows of nodes that hold more than one component, with the node's size."""
    size = (rows.groupBy("node").agg(F.count(F.lit(1)).alias("rows"), F.min("label").alias("a"), F.max("label").alias("b"))
            .where("a <> b").select("node", "rows"))
    return rows.join(size, "node")


def _dominated(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Large nodes in two: (those with at most LEAF rows outside their largest
    component, as blocks of that component with all the others; the rest)."""
    size = rows.groupBy("node", "label").agg(F.count(F.lit(1)).alias("n"))
    most = size.groupBy("node").agg(F.max(F.struct("n", "label")).alias("most"), F.sum("n").alias("all"))
    most = most.select("node", F.col("most.label").alias("main"), F.ceil(F.col("most.n") / LEAF).alias("blocks"),
                       (F.col("all") - F.col("most.n") <= LEAF).alias("few"))
    told = written(rows.join(most, "node"), "large-nodes")
    block = F.when(F.col("label") == F.col("main"), F.array(F.pmod(F.xxhash64("set_id"), F.col("blocks")))).otherwise(
        F.sequence(F.lit(0), F.col("blocks") - 1))
    cut = told.where("few").withColumn("block", F.explode(block))
    return (cut.select(F.xxhash64("node", "block").alias("node"), "set_id", "label", "n", "sketch"),
            told.where("not few").drop("main", "blocks", "few"))


def _blocks(rows: DataFrame) -> DataFrame:
    """What is still large: every block of LEAF / 2 rows with every other."""
    n = F.ceil(F.col("rows") / F.lit(LEAF // 2))
    own = F.pmod(F.xxhash64("set_id"), n)
    pair = F.transform(F.sequence(F.lit(0), n - 1), lambda x: F.xxhash64("node", F.least(x, own), F.greatest(x, own)))
    return rows.select(F.explode(pair).alias("node"), "set_id", "label", "n", "sketch")


def links(base: DataFrame, texts: DataFrame) -> DataFrame:
    """All links needed for the components: (u, v) of set ids."""
    nodes = base.select("set_id", F.explode("nodes").alias("node"))
    sizes = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    full = written(nodes.join(sizes, "node"), "full-nodes")
    weight = full.groupBy("set_id").agg(F.sum("rows").alias("weight"))
    weighed = full.join(weight, "set_id")
    pivots = weighed.groupBy("node").agg(F.max(F.struct("weight", "set_id")).alias("p")).select("node", F.col("p.set_id").alias("pivot"))
    shared = written(full.join(pivots, "node").drop("rows"), "shared-nodes")
    side = base.select("set_id", "n", "sketch", "text_key")
    stars = (shared.where("set_id <> pivot").select(F.col("set_id").alias("u"), F.col("pivot").alias("v")).distinct()
             .join(side.toDF("u", "n_u", "sketch_u", "key_u"), "u").join(side.toDF("v", "n_v", "sketch_v", "key_v"), "v"))
    star_links = written(_confirmed(written(_likely(stars), "star-pairs"), texts), "star-links")

    roots = components(star_links).withColumnRenamed("v", "set_id")
    labels = base.select("set_id", "n", "sketch").join(roots, "set_id", "left").select(
        "set_id", F.coalesce("root", "set_id").alias("label"), "n", "sketch")
    few = shared.select("node", "set_id").join(labels.select("set_id", "label"), "set_id")
    level = written(_open_nodes(few).drop("label").join(labels, "set_id"), "open-nodes")
    found = []
    for depth in range(DEPTH + 1):
        found.append(written(_clusters(level.where(F.col("rows") <= LEAF)), "clusters"))
        big = level.where(F.col("rows") > LEAF)
        if big.isEmpty():
            break
        cut, big = _dominated(big)
        if depth == DEPTH:
            cut = cut.unionByName(_blocks(big))
        found.append(written(_clusters(cut), "clusters"))
        if depth == DEPTH or big.isEmpty():
            break
        level = written(_open_nodes(_branch(big).dropDuplicates(["node", "set_id"])), "open-nodes")
    clusters = found[0]
    for x in found[1:]:
        clusters = clusters.unionByName(x)
    clusters = clusters.dropDuplicates(["cluster", "set_id"])
    with_text = clusters.join(base.select("set_id", "text_key", "sketch"), "set_id").join(texts, "text_key")
    late = written(_exhaustive(with_text.select("cluster", "set_id", "label", "sketch", "text")), "leaf-links")
    return star_links.unionByName(late)


def _linked(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, n, set_id, component_id) of every row; the component
    of an empty set is null."""
    rows = written(sets(docs), "shingle-sets")
    base = written(rows.where("set_id is not null").groupBy("set_id").agg(
        F.min("doc_id").alias("least"), F.min("text_key").alias("text_key"), F.first("n").alias("n"),
        F.first("sketch").alias("sketch"), F.first("nodes").alias("nodes")), "sets")
    texts = (docs.select(_text_key(), F.col("text").cast("string").alias("text"))
             .join(base.select("text_key"), "text_key", "left_semi").dropDuplicates(["text_key"]))
    roots = components(links(base, texts)).withColumnRenamed("v", "set_id")
    joined = base.select("set_id", "least").join(roots, "set_id")
    least = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = joined.join(least, "root").select("set_id", "component_id")
    named = written(base.select("set_id", "least").join(linked, "set_id", "left")
                    .select("set_id", F.coalesce("component_id", "least").alias("component_id")), "set-components")
    return rows.select("doc_id", "text_key", "n", "set_id").join(named, "set_id", "left")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    own = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return _linked(docs).select("doc_id", F.col("n").cast("long").alias("n_shingles"), own.alias("component_id"),
                                F.col("doc_id").eqNullSafe(own).alias("kept"))


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id names their component, as they are, and
    all rows without shingles.  What goes is joined away, so rows that tie on
    doc_id and text stay or go together."""
    gone = _linked(docs).where("set_id is not null and not (doc_id <=> component_id)").select(
        F.col("text_key").alias("_gone")).distinct()
    return docs.join(gone, _text_key() == F.col("_gone"), "left_anti")
