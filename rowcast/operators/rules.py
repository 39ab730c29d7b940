"""Rule chain: regex guards, ordered fold, verdicts, source filters.

A :class:`Rule` is declarative: a guard on ``schema``/``table`` (unanchored
regexes, empty matches all), a verdict Column and a map of assignments.  Both
are evaluated on the event **as it entered the rule**; a rule that must test a
value it has just written is split in two.

Fold over rules r1..rn, starting from verdict 0 (CONT)::

    rule without verdict and assignments  -> verdict 0 (no-op)
    guard false                           -> verdict 0 (a non-matching rule resets it)
    guard true                            -> apply assignments, verdict = rule's verdict
    verdict 1 (DROP)                      -> event removed, later rules never see it
    after the last rule                   -> only verdict 0 is kept (2, 3, ... are dropped)

Each rule is one ``select`` plus one ``filter``: a narrow plan, no shuffle, and
later rules see only surviving rows.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowcast.model import ACTION_CONT, ACTION_DROP, VERDICT_COL
from rowcast.session import save_shared

VERDICT_POLICIES = ("fail", "drop", "pass")


def _plan_barrier(verdict: Column) -> Column:
    """Keep each rule's filter right above its own projection.

    Catalyst pushes a filter through a projection by inlining the aliases it
    reads; a rule's verdict reads the previous rule's outputs, which read
    theirs, each more than once, so pushing every rule's filter to the bottom
    of a long chain inlines an expression that doubles with every rule.  A
    projection holding a non-deterministic expression is not pushed through,
    so the verdict carries one that is always 0 (and the same on a retried
    task).  Filters placed before the rules (source filters) still reach the
    scan.
    """
    return verdict + F.spark_partition_id() * F.lit(0)


def java_regex(pattern: str) -> str:
    """Accept RE2/Go-style named groups ``(?P<n>...)`` (Java wants ``(?<n>...)``)."""
    return re.sub(r"\(\?P<", "(?<", pattern)


def matches(col: str | Column, pattern: str | None) -> Column:
    """Unanchored regex match; an empty pattern matches everything."""
    if pattern is None or pattern == "":
        return F.lit(True)
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.rlike(java_regex(pattern)), F.lit(False))


@dataclass
class Rule:
    """One transformation rule.

    ``verdict``: Column (or int) giving 0 = CONT, 1 = DROP, other = keep going
    but not delivered if last; ``None`` with assignments means CONT.
    ``set``: ``{"after": col, "kafka.topic": col, "meta.pipeline": col, ...}``;
    dotted names update one struct field; ``"after[].text_col"`` updates a
    field in every row of an image (value: SQL over the row ``r``, or a
    function of the row Column).  A rule with neither is a no-op.
    """

    name: str
    match_schema: str = ""
    match_table: str = ""
    verdict: Column | int | None = None
    set: Mapping[str, Column] = field(default_factory=dict)

    def __post_init__(self):
        if self.verdict is not None and not isinstance(self.verdict, (int, Column)):
            raise TypeError(f"rule {self.name!r}: verdict must be an int or a Column, not {type(self.verdict).__name__}")
        for target, expr in dict(self.set).items():
            row_level = isinstance(target, str) and "[]." in target
            ok = isinstance(expr, Column) or (row_level and (isinstance(expr, str) or callable(expr)))
            if not isinstance(target, str) or not ok:
                raise TypeError(f"rule {self.name!r}: assignments map a column name to a Column "
                                f"(or, for 'image[].field', SQL over the row `r` or a function of the row): {target!r}")

    @property
    def guard_only(self) -> bool:
        """A literal verdict and no assignments: the outcome depends on the guard alone."""
        return isinstance(self.verdict, int) and not self.set

    @property
    def can_drop(self) -> bool:
        """False when the verdict is known not to be DROP (no verdict, or a literal other than 1)."""
        return not (self.verdict is None or (isinstance(self.verdict, int) and self.verdict != ACTION_DROP))


    @property
    def matches_all(self) -> bool:
        return not self.match_schema and not self.match_table

    @property
    def is_noop(self) -> bool:
        return self.verdict is None and not self.set

    def guard(self) -> Column:
        """Schema AND table match (never null)."""
        return matches("schema", self.match_schema) & matches("table", self.match_table)


def drop_rule(name: str, match_schema: str = "", match_table: str = "") -> Rule:
    """Drop every event of the matched tables.

    Its filter depends on ``schema``/``table`` only, so Catalyst may push it
    down; placed before other rules on a log partitioned by schema and table,
    it prunes whole folders.
    """
    return Rule(name, match_schema, match_table, verdict=ACTION_DROP)


def _assignments(df: DataFrame, sets: Mapping[str, Column], g: Column | None) -> dict[str, Column]:
    """Top-level column -> new expression, guarded (unmatched rows keep their value).

    ``g=None`` means the rule matches every event: the new value is used as
    is, so a rule may then change a column's type (add or drop image columns).
    Under a real guard the type must stay, since the typed layout has one
    schema per column; split the frame per table or use the mixed layout.
    """
    grouped: dict[str, list[tuple[str | None, Column]]] = {}
    rows: dict[str, dict] = {}
    for target, expr in sets.items():
        if "[]." in target:
            image, fld = target.split("[].", 1)
            if image not in df.columns:
                raise ValueError(f"rule assigns unknown column {image!r}")
            rows.setdefault(image, {})[fld] = expr
            continue
        top, _, sub = target.partition(".")
        if top not in df.columns:
            raise ValueError(f"rule assigns unknown column {top!r}")
        grouped.setdefault(top, []).append((sub or None, expr))
    for image, fields in rows.items():
        if image in grouped:
            raise ValueError(f"rule assigns {image!r} both whole and per row")
        grouped[image] = [(None, _row_assignment(df, image, fields))]
    out = {}
    for top, items in grouped.items():
        new = F.col(top)
        for sub, expr in items:
            new = expr if sub is None else new.withField(sub, expr)
        out[top] = new if g is None else F.when(g, new).otherwise(F.col(top))
    return out


def _row_assignment(df: DataFrame, image: str, fields: dict) -> Column:
    """``image[].f = expr`` for every row, all fields in one ``transform``.

    Each ``expr`` is SQL over the row ``r`` or a function of the row Column,
    all evaluated on the row as it entered the rule (one kind per image).
    """
    from pyspark.sql import types as T

    et = df.schema[image].dataType.elementType
    is_map = isinstance(et, T.MapType)
    kinds = {isinstance(e, str) for e in fields.values()}
    if len(kinds) > 1:
        raise ValueError(f"per-row assignments to {image!r} mix SQL text and functions")
    if not kinds.pop():
        if is_map:
            def upd(r):
                out = F.map_filter(r, lambda k, v: ~k.isin(*fields))
                return F.map_concat(out, F.map_from_arrays(F.array(*[F.lit(f) for f in fields]),
                                                           F.array(*[fn(r).cast("variant") for fn in fields.values()])))
            return F.transform(image, upd)

        def upd(r):
            new = {f: fn(r) for f, fn in fields.items()}
            for f, v in new.items():
                r = r.withField(f, v)
            return r
        return F.transform(image, upd)
    if is_map:
        keys = ", ".join(f"'{f}'" for f in fields)
        vals = ", ".join(f"cast(({e}) AS variant)" for e in fields.values())
        return F.expr(f"transform(`{image}`, r -> map_concat(map_filter(r, (k, v) -> NOT array_contains(array({keys}), k)), "
                      f"map_from_arrays(array({keys}), array({vals}))))")
    names = list(et.names) + [f for f in fields if f not in et.names]
    parts = ", ".join(f"'{n}', " + (f"({fields[n]})" if n in fields else f"r.`{n}`") for n in names)
    return F.expr(f"transform(`{image}`, r -> named_struct({parts}))")


class GuardMatrix:
    """T1-T3 for many rules: all guards evaluated once per distinct (schema,
    table) instead of once per event.

    The pairs are one partial aggregate over two columns; their guards are bits in
    an array of longs (``_guards``), written as a small table that events are
    joined to.  A rule tests its bit, and rules that match no pair leave the plan
    (:meth:`needed`).  Guards after a rule that rewrites ``schema`` or ``table``
    see the new names, so they stay expressions.
    """

    COLUMN = "_guards"

    def __init__(self, log: DataFrame, rules: Sequence[Rule]):
        self.rules = list(rules)
        moved = next((i for i, r in enumerate(self.rules) if {"schema", "table"} & set(r.set)), len(self.rules))
        self.bits = {i: n for n, i in enumerate(i for i, r in enumerate(self.rules[:moved + 1]) if not r.is_noop and not r.matches_all)}
        guards = [self.rules[i].guard() for i in self.bits]
        words = [F.lit(0).cast("bigint")] if not guards else [
            sum((F.when(g, F.lit(1 << k)).otherwise(F.lit(0)) for k, g in enumerate(guards[at:at + 63])),
                F.lit(0).cast("bigint")) for at in range(0, len(guards), 63)]
        pairs = log.groupBy("schema", "table").agg(F.lit(1).alias("_one"))
        self.table = save_shared(pairs.select(F.col("schema").alias("_gs"), F.col("table").alias("_gt"), F.array(*words).alias(self.COLUMN)),
                                 "guard-matrix")
        seen = self.table.agg(*[F.bit_or(F.get(F.col(self.COLUMN), F.lit(w))).alias(f"w{w}") for w in range(len(words))]).first()
        self.any = [seen[w] or 0 for w in range(len(words))]

    def join(self, events: DataFrame) -> DataFrame:
        """``events`` with their guard bits, by the names before any rule."""
        t = self.table
        return events.join(t, events["schema"].eqNullSafe(t["_gs"]) & events["table"].eqNullSafe(t["_gt"]), "left").drop("_gs", "_gt")

    def needed(self, i: int) -> bool:
        """False for a rule that no event matches."""
        return i not in self.bits or bool(self.any[self.bits[i] // 63] >> (self.bits[i] % 63) & 1)

    def guard(self, i: int) -> Column:
        if i not in self.bits:
            return self.rules[i].guard()
        return F.getbit(F.get(F.col(self.COLUMN), F.lit(self.bits[i] // 63)), F.lit(self.bits[i] % 63)) == 1


def apply_rule(df: DataFrame, rule: Rule, on_null_verdict: str = "fail", short_circuit: bool = True,
               active: Column | None = None, guard: Column | None = None) -> DataFrame:
    """Apply one rule to events carrying the ``_verdict`` column.

    ``active``: optional condition; inactive rows keep their columns and verdict.
    ``guard``: what stands for the rule's own guard (a bit of a GuardMatrix).
    """
    keep_v = F.col(VERDICT_COL)
    if rule.is_noop:
        v0 = F.lit(ACTION_CONT) if active is None else F.when(active, F.lit(ACTION_CONT)).otherwise(keep_v)
        return df.withColumn(VERDICT_COL, _plan_barrier(v0))
    g = rule.guard() if guard is None else guard
    g = g if active is None else (g & active)
    v = F.lit(ACTION_CONT) if rule.verdict is None else (
        rule.verdict if isinstance(rule.verdict, Column) else F.lit(int(rule.verdict)))
    v = v.cast("int")
    if on_null_verdict == "fail":
        v = F.coalesce(v, F.raise_error(F.lit(f"rule {rule.name!r} returned no verdict")).cast("int"))
    elif on_null_verdict == "drop":
        v = F.coalesce(v, F.lit(ACTION_DROP))
    else:
        v = F.coalesce(v, F.lit(ACTION_CONT))
    new = _assignments(df, rule.set, None if (rule.matches_all and active is None) else g)
    cols = [new.get(c, F.col(c)).alias(c) for c in df.columns if c != VERDICT_COL]
    verdict = F.when(g, v).otherwise(F.lit(ACTION_CONT))
    if active is not None:
        verdict = F.when(~active, keep_v).otherwise(verdict)
    # guard-only rules reference nothing costly: their filter may travel down to the scan
    # (not under ``active``, whose verdict reads the previous verdict twice)
    verdict = verdict if (rule.guard_only and active is None) else _plan_barrier(verdict)
    out = df.select(*cols, verdict.alias(VERDICT_COL))
    if short_circuit and rule.can_drop:
        out = out.filter(F.col(VERDICT_COL) != ACTION_DROP)
    return out


def apply_beside(df: DataFrame, branches: Sequence[tuple[Rule, str, Column]]) -> DataFrame:
    """Rules of different events in one projection: ``(rule, on_null_verdict, which
    events)``, of which at most one holds for an event; the other events, and those
    with verdict DROP, keep their columns and verdict.

    Equal to :func:`apply_rule` with ``active`` for one branch after the other, but
    an event meets one projection, and a field that many branches set is one choice
    among their values."""
    kept = F.col(VERDICT_COL)
    going = kept != ACTION_DROP
    verdict, drops = None, False
    whole: dict[str, list[tuple[Column, Column]]] = {}
    fields: dict[str, dict[str, list[tuple[Column, Column]]]] = {}
    for rule, policy, mine in branches:
        mine = mine & going
        hit = mine if rule.matches_all else mine & rule.guard()
        plain = not rule.is_noop and all("[]." not in t for t in rule.set)
        tops = {t.partition(".")[0] for t in rule.set}
        if plain and tops <= set(df.columns) and all("." in t for t in rule.set):
            for target, expr in rule.set.items():
                top, _, sub = target.partition(".")
                fields.setdefault(top, {}).setdefault(sub, []).append((hit, expr))
        elif not rule.is_noop:
            for top, new in _assignments(df, rule.set, None).items():
                whole.setdefault(top, []).append((hit, new))
        v = F.lit(ACTION_CONT) if rule.verdict is None else rule.verdict if isinstance(rule.verdict, Column) else F.lit(int(rule.verdict))
        v = v.cast("int")
        if isinstance(rule.verdict, Column):
            v = F.coalesce(v, F.raise_error(F.lit(f"rule {rule.name!r} returned no verdict")).cast("int") if policy == "fail" else
                           F.lit(ACTION_DROP if policy == "drop" else ACTION_CONT))
        drops = drops or rule.can_drop
        if rule.verdict is not None:
            verdict = F.when(hit, v) if verdict is None else verdict.when(hit, v)
        verdict = F.when(mine, F.lit(ACTION_CONT)) if verdict is None else verdict.when(mine, F.lit(ACTION_CONT))

    def chosen(old, cases):
        out = F
        for hit, new in cases:
            out = out.when(hit, new)
        return out.otherwise(old)

    def column(top):
        new = F.col(top)
        for sub, cases in fields.get(top, {}).items():
            new = new.withField(sub, chosen(F.col(f"{top}.{sub}"), cases))
        return chosen(new, whole[top]) if top in whole else new

    cols = [column(c).alias(c) if c in fields or c in whole else F.col(c) for c in df.columns if c != VERDICT_COL]
    out = df.select(*cols, _plan_barrier(kept if verdict is None else verdict.otherwise(kept)).alias(VERDICT_COL))
    return out.filter(F.col(VERDICT_COL) != ACTION_DROP) if drops else out


def apply_rules(events: DataFrame, rules: Sequence[Rule], on_null_verdict: str = "fail",
                keep_verdict: bool = False, guards: GuardMatrix | None = None) -> DataFrame:
    """The ordered fold; returns the events to deliver.  With ``guards``
    (of these rules) events carry guard bits and rules that match nothing are
    left out: a rule's verdict replaces the one before, so leaving it out only
    matters after the last rule, where it resets the verdict."""
    if on_null_verdict not in VERDICT_POLICIES:
        raise ValueError(f"on_null_verdict must be one of {VERDICT_POLICIES}")
    df = (events if guards is None else guards.join(events)).withColumn(VERDICT_COL, F.lit(ACTION_CONT))
    kept = [i for i in range(len(rules)) if guards is None or guards.needed(i)]
    for i in kept:
        df = apply_rule(df, rules[i], on_null_verdict, guard=None if guards is None else guards.guard(i))
    if guards is not None:
        if rules and (not kept or kept[-1] != len(rules) - 1):
            df = df.withColumn(VERDICT_COL, F.lit(ACTION_CONT))
        df = df.drop(GuardMatrix.COLUMN)
    df = df.filter(F.col(VERDICT_COL) == ACTION_CONT)
    return df if keep_verdict else df.drop(VERDICT_COL)


def verdicts(events: DataFrame, rules: Sequence[Rule], on_null_verdict: str = "pass") -> DataFrame:
    """The fold without removing anything, for audits and drop metrics.

    Every event keeps its final ``_verdict`` (1 for events a DROP stopped;
    later rules do not change them) and ``_dropped_by``, the name of the rule
    that dropped it.  ``groupBy("_dropped_by").count()`` gives in / dropped /
    delivered counts per rule.
    """
    df = events.withColumn(VERDICT_COL, F.lit(ACTION_CONT)).withColumn("_dropped_by", F.lit(None).cast("string"))
    for r in rules:
        df = apply_rule(df, r, on_null_verdict, short_circuit=False,
                        active=F.col(VERDICT_COL) != ACTION_DROP)
        df = df.withColumn("_dropped_by", F.when(F.col("_dropped_by").isNull() & (F.col(VERDICT_COL) == ACTION_DROP),
                                                 F.lit(r.name)).otherwise(F.col("_dropped_by")))
    return df


def validate_rules(spark, rules: Sequence, source_filter: "SourceFilter | None" = None) -> None:
    """Compile every guard pattern once, before any event is processed.

    Column references are resolved when the plan is built; a bad regular
    expression would otherwise only fail at execution.  This evaluates all
    patterns against one empty string in a local relation (no cluster job)
    and names the rule at fault.
    """
    checks = []
    for r in rules:
        for field_name in ("match_schema", "match_table"):
            p = getattr(r, field_name, "")
            if p:
                checks.append((f"rule {getattr(r, 'name', '?')!r} {field_name}", java_regex(p)))
    if source_filter is not None:
        for field_name in ("include_schemas", "exclude_schemas", "include_tables", "exclude_tables"):
            for p in getattr(source_filter, field_name):
                if p and p.strip():
                    checks.append((f"source filter {field_name}", java_regex(p)))
    if not checks:
        return
    base = spark.createDataFrame([("",)], "s string")
    try:    # all patterns in one local query; on failure find the culprit
        base.select(*[F.col("s").rlike(p).alias(f"p{i}") for i, (_, p) in enumerate(checks)]).collect()
        return
    except Exception:  # noqa: BLE001
        pass
    for what, p in checks:
        try:
            base.select(F.col("s").rlike(p)).collect()
        except Exception as e:  # noqa: BLE001 - report which rule carries the pattern
            raise ValueError(f"{what}: invalid pattern {p!r}: {str(e).splitlines()[0][:200]}") from e


# ---------------------------------------------------------------- source filters

@dataclass
class SourceFilter:
    """Schema/table include and exclude lists (unanchored regexes).

    Include first (an empty list includes all), then exclude.  Blank patterns
    are ignored.
    """

    include_schemas: Sequence[str] = ()
    exclude_schemas: Sequence[str] = ()
    include_tables: Sequence[str] = ()
    exclude_tables: Sequence[str] = ()

    @staticmethod
    def _any(col: str, patterns: Sequence[str]) -> Column | None:
        ps = [p for p in patterns if p and p.strip()]
        if not ps:
            return None
        out = None
        for p in ps:
            m = matches(col, p)
            out = m if out is None else (out | m)
        return out

    def condition(self) -> Column:
        cond = F.lit(True)
        for col, inc, exc in (("schema", self.include_schemas, self.exclude_schemas),
                              ("table", self.include_tables, self.exclude_tables)):
            i = self._any(col, inc)
            e = self._any(col, exc)
            if i is not None:
                cond = cond & i
            if e is not None:
                cond = cond & ~e
        return cond

    def apply(self, df: DataFrame) -> DataFrame:
        return df.filter(self.condition())
