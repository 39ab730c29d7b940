"""Exact top-k inner-product search: a ball tree per shard, branch and bound.

Vectors are dealt to shards by a hash of their row.  A task builds the ball tree
of its shard (nodes halved along their widest direction, each with its centre and
radius) and searches it for a block of queries: the inner product of a query with
any point of a node is at most ``q . centre + |q| * radius``, so a node whose bound
lies below the query's k-th score is never opened.  Queries take their leaves by
falling bound, in portions that double; after each the k-th score is raised.

That score is shared between shards: shards are searched in rounds (1, 7, 56, ...),
and a round starts from the k-th scores of all rounds before it, so later shards
open only the nodes that can still change a result.

Queries are never one set: they are cut into blocks of ``BLOCK_VALUES`` components,
shards hold ``SHARD_VALUES``, and a task has one of each.  Bounds are compared with
a slack far above rounding and scores are whole numbers, in doubles while these are
exact, else in 64-bit integers, else in Python's.

Defined cases: vectors that are null or hold null, NaN or infinity take no part;
vectors of different lengths aren't compared; a null vec_id is no query, and counts
as the largest id among equal scores; repeated rows are rows of their own, and a
query leaves out its own row alone; a score beyond 64 bits counts as the nearest
that fits; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

SCALE = 1024
TOP = 10
#: Points of a leaf, at most.
LEAF = 64
#: Components (points x length) of a shard, and of a block of queries.
SHARD_VALUES = 1 << 18
BLOCK_VALUES = 1 << 18
#: A round searches so many times the shards of all rounds before it.
GROWTH = 8
#: Candidates that are held before they are merged into the best.
PENDING = 1 << 20
SLACK = 1e-9

FOUND_DDL = "q_row long, query_id long, row long, vec_id long, score long"
_LAST = np.iinfo(np.int64).max


class BallTree:
    """Nodes over ``points`` (a matrix of doubles), halved down to LEAF points."""

    def __init__(self, points: np.ndarray):
        self.order = np.arange(len(points))
        self.spans: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        centres, radii = [], []
        todo = [(0, len(points))]
        self.spans.append(todo[0])
        at = 0
        while at < len(self.spans):
            lo, hi = self.spans[at]
            own = points[self.order[lo:hi]]
            centre = own.mean(axis=0)
            away = np.linalg.norm(own - centre, axis=1)
            centres.append(centre)
            radii.append(away.max())
            if hi - lo <= LEAF:
                self.children.append(None)
            else:
                far = own[away.argmax()]
                other = own[np.linalg.norm(own - far, axis=1).argmax()]
                half = (hi - lo) // 2
                self.order[lo:hi] = self.order[lo:hi][np.argpartition(own @ (other - far), half)]
                self.children.append((len(self.spans), len(self.spans) + 1))
                self.spans += [(lo, lo + half), (lo + half, hi)]
            at += 1
        self.centres, self.radii = np.array(centres), np.array(radii)
        self.sizes = np.linalg.norm(self.centres, axis=1) + self.radii
        self.leaves = np.array([i for i, c in enumerate(self.children) if c is None])

    def bounds(self, queries: np.ndarray, norms: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Upper bounds of the inner products, [query][node]."""
        top = queries @ self.centres[nodes].T + norms[:, None] * self.radii[nodes]
        return top + SLACK * norms[:, None] * self.sizes[nodes] + 1e-6

    def open_leaves(self, queries: np.ndarray, norms: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Bounds of the leaves, [query][leaf]; -inf below a node that can't hold
        a score of ``least``."""
        out = np.full((len(queries), len(self.spans)), -np.inf)
        todo = [(0, np.arange(len(queries)))]
        while todo:
            node, who = todo.pop()
            got = self.bounds(queries[who], norms[who], np.array([node]))[:, 0]
            stay = got >= least[who]
            who = who[stay]
            if not len(who):
                continue
            if self.children[node] is None:
                out[who, node] = got[stay]
            else:
                todo += [(c, who) for c in self.children[node]]
        return out[:, self.leaves]


class Best:
    """The best ``k`` points of each query here, and the (score, id) that a point
    has to beat: the k-th of all that is known."""

    def __init__(self, k: int, scores: np.ndarray, ids: np.ndarray):
        self.k = k
        self.score, self.id = scores.copy(), ids.copy()  # shared by earlier rounds; the lowest where there are none
        self.rows = tuple(np.empty(0, np.int64) for _ in range(4))  # query, score, id, point

    def merge(self, new: list[tuple]) -> None:
        who, score, ids, point = rows = [np.concatenate(x) for x in zip(self.rows, *new, strict=True)]
        order = np.lexsort((point, ids, -score, who))
        sorted_who = who[order]
        starts = np.flatnonzero(np.r_[True, sorted_who[1:] != sorted_who[:-1]])
        place = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
        self.rows = tuple(x[order[place < self.k]] for x in rows)
        last = order[place == self.k - 1]
        last = last[(score[last] > self.score[who[last]]) | ((score[last] == self.score[who[last]]) & (ids[last] < self.id[who[last]]))]
        self.score[who[last]], self.id[who[last]] = score[last], ids[last]


def search(points: np.ndarray, ids: np.ndarray, rows: np.ndarray, queries: np.ndarray, own: np.ndarray, scores: np.ndarray,
           least_ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query, score, id, point) of up to ``k`` points for each query that beat its
    shared (score, id); ``own`` is a query's row among ``rows``, if it is one."""
    most = float(np.abs(points.astype(float)).max(initial=0)) * float(np.abs(queries.astype(float)).max(initial=0)) * max(1, points.shape[1])
    if most >= 2.0 ** 62:
        return _big(points, ids, rows, queries, own, scores, least_ids, k)
    exact = float if most < 2.0 ** 52 else np.int64
    x, q = points.astype(exact), queries.astype(exact)
    plain = queries.astype(float)
    norms = np.linalg.norm(plain, axis=1)
    tree = BallTree(points.astype(float))
    best = Best(k, scores, least_ids)
    bounds = tree.open_leaves(plain, norms, best.score.astype(float))
    by_bound = np.argsort(-bounds, axis=1, kind="stable")
    width, at = 1, 0
    while at < len(tree.leaves):
        picks = by_bound[:, at:at + width]
        who = np.repeat(np.arange(len(queries)), picks.shape[1])
        leaf = picks.ravel()
        open_ = bounds[who, leaf] >= best.score[who].astype(float)  # by the k-th score of now
        if not open_.any():
            break  # later leaves have lower bounds
        who, leaf = who[open_], leaf[open_]
        order = np.argsort(leaf, kind="stable")
        who, leaf = who[order], leaf[order]
        cuts = np.flatnonzero(np.r_[True, leaf[1:] != leaf[:-1], True])
        new, held = [], 0
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            lo, hi = tree.spans[tree.leaves[leaf[a]]]
            inside, asking = tree.order[lo:hi], who[a:b]
            got = (q[asking] @ x[inside].T).astype(np.int64)
            least, i = best.score[asking, None], ids[inside][None, :]
            better = (got > least) | ((got == least) & (i < best.id[asking, None]))
            better &= rows[inside][None, :] != own[asking, None]
            r, c = np.nonzero(better)
            new.append((asking[r], got[r, c], ids[inside][c], inside[c]))
            held += len(r)
            if held > PENDING:
                best.merge(new)
                new, held = [], 0
        if held:
            best.merge(new)
        at, width = at + width, 2 * width
    return best.rows


def _big(points, ids, rows, queries, own, scores, least_ids, k):
    """The same where products leave 64 bits: by Python's integers, one by one."""
    out: list[list] = [[], [], [], []]
    low, high = -(1 << 63), (1 << 63) - 1
    xs = [list(map(int, p)) for p in points]
    for n, q in enumerate(queries):
        v = list(map(int, q))
        got = ((-min(high, max(low, sum(a * b for a, b in zip(v, x, strict=True)))), int(ids[j]), j)
               for j, x in enumerate(xs) if rows[j] != own[n])
        for s, i, j in sorted(t for t in got if (t[0], t[1]) < (-int(scores[n]), int(least_ids[n])))[:k]:
            for column, value in zip(out, (n, -s, i, j), strict=True):
                column.append(value)
    return tuple(np.array(x, np.int64) for x in out)


# -- on Spark ----------------------------------------------------------------------

def vectors(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """(row, vec_id, v, dim): the vectors that take part, in whole numbers."""
    def odd(x: Column) -> Column:
        d = x.cast("double")
        return x.isNull() | F.isnan(d) | (F.abs(d) == float("inf"))

    own = rows.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
                      F.col(vector).alias("v")).where(F.col("v").isNotNull() & ~F.exists("v", odd))
    return own.select("row", "vec_id", F.transform("v", lambda x: F.floor(x.cast("double") * SCALE)).alias("v"),
                      F.size("v").alias("dim"))


def _matrix(column, dim: int) -> np.ndarray:
    flat = column.combine_chunks().flatten() if hasattr(column, "combine_chunks") else column.flatten()
    return np.asarray(flat).reshape(-1, dim) if dim else np.zeros((len(column), 0), np.int64)


def _searched(points: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Both sides dealt by (dim, shard, block); queries with (least, least_id)."""
    def run(key, own, asked):
        import pyarrow as pa

        def whole(t, name, null=None):
            c = t.column(name)
            return np.asarray(c.fill_null(null) if null is not None else c, np.int64)

        dim = key[0].as_py()
        if not own.num_rows or not asked.num_rows:
            return pa.table([pa.array([], pa.int64())] * 5, names=["q_row", "query_id", "row", "vec_id", "score"])
        rows = whole(own, "row")
        q_rows = whole(asked, "q_row")
        who, score, _, point = search(_matrix(own.column("v"), dim), whole(own, "vec_id", _LAST), rows, _matrix(asked.column("q_v"), dim),
                                      q_rows, whole(asked, "q_least", -_LAST - 1), whole(asked, "q_least_id", _LAST), k)
        return pa.table([pa.array(q_rows[who]), pa.array(whole(asked, "q_vec_id")[who]), pa.array(rows[point]),
                         own.column("vec_id").take(pa.array(point)), pa.array(score)],
                        names=["q_row", "query_id", "row", "vec_id", "score"])

    deal = ["dim", "shard", "block"]
    again = queries.select(*[F.col(c).alias(f"q_{c}") for c in queries.columns])  # both sides come from one table
    return points.groupBy(*deal).cogroup(again.groupBy(*[f"q_{c}" for c in deal])).applyInArrow(run, FOUND_DDL)


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` rows of ``found`` per query, with their rank."""
    return found.withColumn("rank", F.expr(
        "row_number() over (partition by q_row order by score desc, vec_id asc nulls last, row)")).where(F.col("rank") <= k)


def nearest(rows: DataFrame, queries: Column, k: int = TOP, vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``queries`` (a condition
    on vec_id) marks, the ``k`` other rows of highest inner product."""
    own = written(vectors(rows, vector), "ball-vectors")
    marked = own.withColumn("asks", F.coalesce(queries, F.lit(False)))
    plan = marked.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("asks"), 1)).alias("asking")).select(
        "dim", F.greatest(F.lit(1), F.ceil(F.col("n") * F.col("dim") / SHARD_VALUES)).alias("shards"),
        F.greatest(F.lit(1), F.ceil(F.col("asking") * F.col("dim") / BLOCK_VALUES)).alias("blocks"))
    plan = written(plan, "ball-plan")  # one row per length
    shards = plan.agg(F.max("shards")).first()[0] or 0
    dealt = marked.join(plan, "dim")
    points = dealt.withColumn("shard", F.pmod(F.xxhash64("row"), "shards"))
    asked = dealt.where("asks").withColumn("block", F.pmod(F.xxhash64(F.lit(7), "row"), "blocks"))
    best, lo, hi = None, 0, 1
    while lo < shards or best is None:
        here = points.where((F.col("shard") >= lo) & (F.col("shard") < hi)).withColumn(
            "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        own_least = asked.withColumns({"least": F.lit(None).cast("long"), "least_id": F.lit(None).cast("long")}) if best is None else \
            asked.join(best.where(F.col("rank") == k).select(F.col("q_row").alias("row"), F.col("score").alias("least"),
                                                             F.col("vec_id").alias("least_id")), "row", "left")
        asking = own_least.where(F.col("shards") > lo).withColumn("shard", F.explode(F.sequence(
            F.lit(lo).cast("long"), F.least(F.lit(hi).cast("long"), "shards") - 1)))
        found = _searched(here.select("dim", "shard", "block", "row", "vec_id", "v"),
                          asking.select("dim", "shard", "block", "row", "vec_id", "v", "least", "least_id"), k)
        if best is not None:
            found = found.unionByName(best.drop("rank"))
        best = written(ranked(found, k), "ball-best")
        lo, hi = hi, hi * GROWTH
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
