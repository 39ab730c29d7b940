"""Pipelines: source filter -> envelope -> rule chain -> encoded records.

A pipeline is plain data (:class:`PipelineSpec`); :func:`run_batch` turns it
into one narrow DataFrame plan.  Streaming runs the same plan per micro-batch
(:mod:`rowcast.streaming`).  Several pipelines are several plans; in batch
they can be unioned into one job (P9).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowcast.operators.codec import encode
from rowcast.operators.envelope import apply_error_policy, build_events, event_key
from rowcast.operators.rules import GuardMatrix, Rule, SourceFilter, apply_beside, apply_rule, apply_rules


@dataclass
class PipelineSpec:
    """What one pipeline does.  ``rules`` may mix expression rules
    (:class:`Rule`), Python rules (:class:`rowcast.operators.pyrule.PythonRule`)
    and stateful rules (:class:`rowcast.streaming.stateful.StatefulRule`, or
    ``WindowRule`` in batch).  ``guard_matrix`` evaluates the guards of a batch's
    expression rules once per table (many rules, most for other tables)."""

    name: str
    rules: Sequence = field(default_factory=list)
    source_filter: SourceFilter | None = None
    pk: Sequence[str] | None = None
    on_error: str = "fail"
    on_null_verdict: str = "fail"
    timestamp: Column | None = None
    string_columns: Sequence[str] = ()
    guard_matrix: bool = False


def apply_chain(events: DataFrame, rules: Sequence, on_null_verdict: str = "fail") -> DataFrame:
    """Run a mixed list of rules in order and keep the events to deliver.

    Consecutive expression rules stay one narrow JVM plan; a Python rule is a
    ``mapInArrow`` stage in between, a stateful rule a grouped one (all with the
    same fold semantics).
    """
    from rowcast.model import ACTION_CONT, VERDICT_COL

    df = events.withColumn(VERDICT_COL, F.lit(ACTION_CONT))
    return finished(fold(df, rules, on_null_verdict))


def fold(df: DataFrame, rules: Sequence, on_null_verdict: str = "fail", keep_dropped: bool = False) -> DataFrame:
    """Rules over events that carry ``_verdict``.  With ``keep_dropped`` events
    with verdict DROP go on to the end (no later rule touches them)."""
    from rowcast.model import ACTION_DROP, VERDICT_COL
    from rowcast.operators.pyrule import PythonRule, apply_python_rule
    from rowcast.operators.rules import apply_rule
    from rowcast.streaming.stateful import StatefulRule, WindowRule, apply_state_rule, apply_window_rule

    for r in rules:
        if isinstance(r, PythonRule):
            df = apply_python_rule(df, r, on_null_verdict, keep_dropped)
        elif isinstance(r, (StatefulRule, WindowRule)):
            df = (apply_window_rule if isinstance(r, WindowRule) else apply_state_rule)(df, r, on_null_verdict)
            if not keep_dropped:
                df = df.filter(F.col(VERDICT_COL) != ACTION_DROP)
        elif isinstance(r, Rule):
            df = (apply_rule(df, r, on_null_verdict, short_circuit=False, active=F.col(VERDICT_COL) != ACTION_DROP)
                  if keep_dropped else apply_rule(df, r, on_null_verdict))
        else:
            raise TypeError(f"not a rule: {r!r}")
    return df


def finished(df: DataFrame) -> DataFrame:
    """What the last verdict lets through."""
    from rowcast.model import ACTION_CONT, VERDICT_COL

    return df.filter(F.col(VERDICT_COL) == ACTION_CONT).drop(VERDICT_COL)


def split_at_state(rules: Sequence) -> tuple[list, list]:
    """(rules up to the last stateful one, the others)."""
    from rowcast.streaming.stateful import StatefulRule

    cut = max((i + 1 for i, r in enumerate(rules) if isinstance(r, StatefulRule)), default=0)
    return list(rules[:cut]), list(rules[cut:])


def run_events(spec: PipelineSpec, log: DataFrame) -> DataFrame:
    """Filtered, enveloped and transformed events (typed, not yet encoded).  A
    batch log with ``guard_matrix`` has its guards evaluated once per table."""
    from rowcast.operators.rules import validate_rules

    validate_rules(log.sparkSession, spec.rules, spec.source_filter)
    if spec.source_filter is not None:
        log = spec.source_filter.apply(log)
    events = build_events(log, pipeline=spec.name, timestamp=spec.timestamp, pk=spec.pk,
                          on_error=spec.on_error, string_columns=spec.string_columns)
    if all(isinstance(r, Rule) for r in spec.rules):
        guards = GuardMatrix(log, spec.rules) if spec.guard_matrix and not log.isStreaming else None
        return apply_rules(events, spec.rules, spec.on_null_verdict, guards=guards)
    return apply_chain(events, spec.rules, spec.on_null_verdict)


def run_batch(spec: PipelineSpec, log: DataFrame) -> DataFrame:
    """Delivery records ``(pipeline, topic, key, value, gtid_uuid, gtid_seq, pos)``."""
    return encode(run_events(spec, log))


def run_many(specs: Sequence[PipelineSpec], logs: Sequence[DataFrame] | DataFrame) -> DataFrame:
    """Several independent pipelines as one batch job.

    Over one log, pipelines of expression rules share its scan and envelope
    (:func:`run_routed`); pipelines with Python or stateful rules, with rules that
    change a column's type, or with a log of their own are a plan each.  Each
    pipeline keeps its own name in ``pipeline``; positions stay per pipeline
    (group state by ``pipeline``).
    """
    if isinstance(logs, DataFrame):
        routed: dict[tuple, list[PipelineSpec]] = {}
        for spec in specs:
            routed.setdefault(_envelope_options(spec), []).append(spec)
        parts = []
        for group in routed.values():
            together = [s for s in group if all(isinstance(r, Rule) for r in s.rules)]
            one = run_routed(together, logs) if len(together) > 1 else None
            parts += [run_batch(s, logs) for s in group if one is None or s not in together]
            parts += [one] if one is not None else []
    else:
        parts = [run_batch(spec, log) for spec, log in zip(specs, logs, strict=True)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def _envelope_options(spec: PipelineSpec) -> tuple:
    """Pipelines with the same options can share one envelope.  Key columns may
    differ: the key is added per pipeline."""
    return (spec.on_error, tuple(spec.string_columns), None if spec.timestamp is None else str(spec.timestamp))


def run_routed(specs: Sequence[PipelineSpec], log: DataFrame) -> DataFrame | None:
    """Many pipelines of expression rules over one scan.

    Each event is routed once: the pipelines whose source filters admit it are an
    array of numbers, and an event that none admits goes no further.  The envelope
    is built once per event, then the event is exploded into its pipelines, and
    each chain works on its own copies: the first rules of all chains in one
    projection, then the second ones, so a copy passes as many projections as the
    longest chain has rules (a shared rule object is one branch).  None if a rule can't work beside others,
    because it changes a column's type.
    """
    from pyspark.errors import AnalysisException

    from rowcast.model import ACTION_CONT, ERROR_COL, VERDICT_COL
    from rowcast.operators.rules import validate_rules

    for spec in specs:
        validate_rules(log.sparkSession, spec.rules, spec.source_filter)
    # filters that are equal are evaluated once per event
    filters: list[SourceFilter] = []
    for spec in specs:
        if spec.source_filter is not None and spec.source_filter not in filters:
            filters.append(spec.source_filter)
    log = log.withColumn("_admits", F.array(*[f.condition() for f in filters]).cast("array<boolean>"))
    admits = [F.lit(True) if s.source_filter is None else F.get("_admits", F.lit(filters.index(s.source_filter))) for s in specs]
    to = F.filter(F.array(*[F.when(c, F.lit(k)) for k, c in enumerate(admits)]), lambda k: k.isNotNull())
    admitted = log.withColumn("_to", to).filter(F.size("_to") > 0).drop("_admits")
    options: list = []  # the different key columns
    which = []
    for spec in specs:
        pk = None if spec.pk is None else tuple(spec.pk)
        if pk not in options:
            options.append(pk)
        which.append(options.index(pk))
    by_option = [event_key(log, pk, specs[0].string_columns) for pk in options]
    keyed = admitted.withColumn("_keys", F.array(*[F.struct(key.alias("key"), bad.alias("bad")) for key, bad in by_option]))
    ev = build_events(keyed, pipeline="", timestamp=specs[0].timestamp, pk=(), on_error="mark", string_columns=specs[0].string_columns)

    def copy(k):
        own = F.get("_keys", F.get(F.array(*[F.lit(w) for w in which]), k))
        return F.struct(k.alias("k"), own["key"].alias("key"),
                        F.coalesce(F.col(ERROR_COL), F.when(own["bad"], F.lit("null key value"))).alias("error"))
    ev = ev.withColumn("_r", F.explode(F.transform("_to", copy)))
    names = F.array(*[F.lit(s.name) for s in specs])
    ev = ev.withColumns({"_k": F.col("_r.k"), "kafka": F.col("kafka").withField("key", F.col("_r.key")),
                         ERROR_COL: F.col("_r.error"), "meta": F.col("meta").withField("pipeline", F.get(names, F.col("_r.k")))}
                        ).drop("_r", "_to", "_keys")
    df = apply_error_policy(ev, specs[0].on_error).withColumn(VERDICT_COL, F.lit(ACTION_CONT))
    try:
        for at in range(max(len(spec.rules) for spec in specs)):
            # the rules that stand at this place of their chains, each with the pipelines that have it there
            here: dict[tuple, tuple[Rule, str, list[int]]] = {}
            for k, spec in enumerate(specs):
                if at < len(spec.rules):
                    rule = spec.rules[at]
                    here.setdefault((spec.on_null_verdict, id(rule)), (rule, spec.on_null_verdict, []))[2].append(k)
            df = apply_beside(df, [(rule, policy, F.col("_k").isin(*ks)) for rule, policy, ks in here.values()])
    except AnalysisException:
        return None
    return encode(finished(df.drop("_k")))

