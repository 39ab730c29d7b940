"""URL filter by a cascade of Bloom filters, in DataFrame operations alone.

A cascade stores exact membership for a known universe of keys: level 0 holds
the listed keys; level 1 the keys of the universe that level 0 takes for listed
by mistake; level 2 the listed keys that level 1 takes for mistakes, and so on
until a level has no false positive.  A key is listed if the first level that
lacks it is an odd one (or all hold it and their number is odd).  As the levels
are built over the corpus's complete key universe, the answer is exact for each
of its urls, and no url is ever joined to a list.

The keys of a url are suffixes of its host with beginnings of its path, one for
each shape (labels, length) that rules have, so one pass over a url's few keys
finds the longest rule.  Where no rule fits, the method decides: hosts that carry a label
of ``BLOCKED_LABELS`` are listed in a second cascade and blocked; others pass.

A level is an array of longs, sized from the count of its keys and inlined as a
scalar subquery.  ``MAX_BITS`` bounds what a task holds of one level; above it
the keys are cut into more segments by their hash, each with an array of its
own below the bound.

Defined cases: a null url or one without ``://`` has empty host and path, no
rule, and is allowed; repeated rows are judged one by one; an empty table gives
an empty result; only page_id and url are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Fixed values: (host suffix, path beginning, verdict).
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

#: Labels of hosts that the method's own list blocks.
BLOCKED_LABELS = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")

BITS_PER_KEY = 12
HASHES = 4
MAX_BITS = 1 << 26
MAX_LEVELS = 40


def host(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(rest, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def key_shapes(rules) -> list[tuple[int, int]]:
    """(labels of the host suffix, length of the path beginning) that rules have."""
    return sorted({(h.count(".") + 1, len(p)) for h, p, _ in rules})


def url_key(h: Column, p: Column, labels: int, length: int) -> Column:
    """The url's key of one shape; null if its host or path is too short."""
    enough = (F.size(F.split(h, r"\.", -1)) >= labels) & (F.length(p) >= length)
    return F.when(enough, F.concat(F.substring_index(h, ".", -labels), F.substring(p, 1, length)))


class Cascade:
    """Levels of (segment -> words) over a universe; ``levels`` holds one-row
    frames whose column ``words`` is array<array<long>> by segment."""

    def __init__(self, levels: list[tuple[DataFrame, int, int]]):
        self.levels = levels

    @staticmethod
    def _slots(key: Column, level: int, bits: int, segments: int) -> tuple[Column, list[Column]]:
        segment = F.pmod(F.xxhash64(key, F.lit(f"segment{level}")), F.lit(segments)).cast("int")
        return segment, [F.pmod(F.xxhash64(key, F.lit(HASHES * level + i)), F.lit(bits)) for i in range(HASHES)]

    @classmethod
    def _level(cls, keys: DataFrame, level: int) -> tuple[DataFrame, int, int]:
        n = keys.count()
        bits = max(64, -(-n * BITS_PER_KEY // 64) * 64)
        segments = -(-bits // MAX_BITS)
        bits = -(-bits // segments // 64) * 64
        segment, slots = cls._slots(F.col("key"), level, bits, segments)
        n_words = bits // 64
        words = keys.select(segment.alias("segment"), F.explode(F.array(*slots)).alias("slot")).select(
            "segment", F.expr("cast(slot div 64 as int)").alias("word"), F.expr("shiftleft(1L, cast(slot % 64 as int))").alias("bits"))
        # every word is there once, so a segment's words are one sorted list
        none = keys.sparkSession.range(segments * n_words).select(
            F.expr(f"cast(id div {n_words} as int)").alias("segment"), F.expr(f"cast(id % {n_words} as int)").alias("word"),
            F.lit(0).cast("long").alias("bits"))
        whole = words.unionByName(none).groupBy("segment", "word").agg(F.bit_or("bits").alias("bits"))
        filled = whole.groupBy("segment").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("w")).select(
            "segment", F.transform("w", lambda x: x["bits"]).alias("words"))
        return written(filled, f"cascade-level{level}"), bits, segments

    def has(self, key: Column, level: int) -> Column:
        """Whether one level holds the key (all its bits set)."""
        frame, bits, segments = self.levels[level]
        segment, slots = self._slots(key, level, bits, segments)

        def test(words: Column) -> Column:
            out = F.lit(True)
            for s in slots:
                word = F.get(words, F.floor(s / 64).cast("int"))
                out = out & (F.call_function("shiftrightunsigned", word, F.pmod(s, F.lit(64)).cast("int")).bitwiseAND(F.lit(1)) == 1)
            return F.coalesce(out, F.lit(False))

        out = F.lit(False)
        for k in range(segments):
            words = frame.where(F.col("segment") == k).select("words").scalar()
            out = F.when(segment == k, test(words)).otherwise(out)
        return out

    def contains(self, key: Column) -> Column:
        """Exact for every key of the universe that the cascade was built on."""
        out = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            out = F.when(~self.has(key, i), F.lit(i % 2 == 1)).otherwise(out)
        return out

    @classmethod
    def build(cls, universe: DataFrame) -> Cascade:
        """``universe``: distinct ``key`` with boolean ``listed``."""
        made = cls([])
        inside, outside = universe.where("listed").select("key"), universe.where("not listed").select("key")
        for level in range(MAX_LEVELS):
            if inside.isEmpty():
                return made
            made.levels.append(cls._level(inside, level))
            wrong = written(outside.where(made.has(F.col("key"), level)), f"cascade-wrong{level}")
            inside, outside = wrong, inside
        raise RuntimeError("the cascade doesn't end; raise BITS_PER_KEY")


def judge(pages: DataFrame, rules=RULES, blocked_labels=BLOCKED_LABELS) -> DataFrame:
    """page_id, host, path, rule, verdict of every row."""
    urls = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    shapes = key_shapes(rules)
    keys = [url_key(F.col("host"), F.col("path"), *x) for x in shapes]
    by = {v: [h + p for h, p, w in rules if w == v] for v in ("allow", "block")}
    # the corpus's complete key universe: every key that any of its urls has
    universe = written(urls.select(F.explode(F.array(*keys)).alias("key")).where("key is not null")
                       .groupBy("key").agg(F.count(F.lit(1)).alias("urls")), "url-keys")
    hosts = urls.groupBy(F.col("host").alias("key")).agg(F.count(F.lit(1)).alias("urls"))
    carries = F.arrays_overlap(F.split("key", r"\."), F.array(*[F.lit(x) for x in blocked_labels]))
    cascades = {v: Cascade.build(universe.select("key", F.col("key").isin(by[v]).alias("listed"))) for v in by}
    listed_hosts = Cascade.build(written(hosts.select("key", carries.alias("listed")), "url-hosts"))

    out = urls.withColumns({f"key{i}": k for i, k in enumerate(keys)})
    none = F.struct(F.lit(-1).alias("n"), F.lit(None).cast("string").alias("verdict"), F.lit(None).cast("string").alias("rule"))
    hits = [F.when(F.col(f"key{i}").isNotNull() & cascades[v].contains(F.col(f"key{i}")), F.struct(
        F.length(f"key{i}").alias("n"), F.lit(v).alias("verdict"), F.col(f"key{i}").alias("rule")))
        for i in range(len(shapes)) for v in by]
    own = F.when(listed_hosts.contains(F.col("host")), "block").otherwise("allow")
    best = out.select("page_id", "host", "path", F.greatest(none, *hits).alias("best"), own.alias("own"))
    return best.select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                       F.coalesce("best.verdict", "own").alias("verdict"))
