"""Python rules (U1): arbitrary per-event Python with the same fold semantics.

The guard is evaluated in the JVM.  Each partition's events travel to Python
as Arrow batches (``mapInArrow``) and pass through unchanged; only matched
events are encoded to JSON (the payload's own encoder), decoded into a dict
and handed to the function.  The function may change any field in place and
returns the verdict, an integer (0 CONT, 1 DROP, other: kept going, dropped if
last).  Decimals and numbers with a fraction arrive as ``Decimal``.

Only the envelope fields that the function changed are written back; all others
keep their column, so no value loses precision on the way.  A changed field is
parsed with the frame's schema, and a value of another type is an error.
Fields added to a typed image are not kept (add columns with an expression rule
first).

``on_error`` says what an exception in the function, a wrong verdict or a wrong
type does: ``fail`` the job, ``drop`` the event or ``pass`` it on unchanged.

Use expression rules where possible; this path costs a JSON round trip per
matched event.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowcast.model import ACTION_CONT, ACTION_DROP, ENVELOPE_FIELDS, VERDICT_COL
from rowcast.operators.codec import JSON_OPTIONS, TIME_FORMAT, payload_parts
from rowcast.operators.rules import matches


ON_ERROR = ("fail", "drop", "pass")
_DECIMAL = "\x00decimal:"


@dataclass
class PythonRule:
    name: str
    match_schema: str = ""
    match_table: str = ""
    fn: Callable[[dict], int] | None = None
    on_error: str = "fail"

    def __post_init__(self):
        if self.fn is not None and not callable(self.fn):
            raise TypeError(f"python rule {self.name!r}: fn must be callable")
        if self.on_error not in ON_ERROR:
            raise ValueError(f"python rule {self.name!r}: on_error must be one of {ON_ERROR}")

    def guard(self):
        return matches("schema", self.match_schema) & matches("table", self.match_table)


def _dump(value) -> str:
    """JSON text; a Decimal is written with all its digits."""
    def other(x):
        if isinstance(x, Decimal):
            return f"{_DECIMAL}{x}"
        raise TypeError(f"not a JSON value: {x!r}")

    text = json.dumps(value, separators=(",", ":"), ensure_ascii=False, default=other)
    return re.sub(r'"\\u0000decimal:([^"]*)"', r"\1", text) if "\\u0000decimal:" in text else text


def checked_verdict(v, on_null_verdict: str, rule_name: str) -> int:
    """The verdict as an integer; anything else but null is an error."""
    if v is None:
        if on_null_verdict == "fail":
            raise ValueError(f"rule {rule_name!r} returned no verdict")
        return ACTION_DROP if on_null_verdict == "drop" else ACTION_CONT
    if isinstance(v, bool) or not isinstance(v, int):
        raise TypeError(f"rule {rule_name!r}: the verdict must be an integer, not {v!r}")
    return v


def call_rule(fn, text: str, on_null_verdict: str, rule_name: str):
    """(verdict, {field: JSON text} of the changed envelope fields)."""
    e, was = json.loads(text, parse_float=Decimal), json.loads(text, parse_float=Decimal)
    v = checked_verdict(fn(e), on_null_verdict, rule_name)
    return v, {f: _dump({f: e.get(f)}) for f in ENVELOPE_FIELDS if e.get(f) != was.get(f)}


def _runner(rule: PythonRule, keep: list[str], on_null_verdict: str):
    def run(batches):
        import pyarrow as pa

        for rb in batches:
            texts = rb.column("_evt").to_pylist()
            out = {f: [None] * rb.num_rows for f in ENVELOPE_FIELDS}
            verdict = [ACTION_CONT] * rb.num_rows
            for i, text in enumerate(texts):
                if text is None:
                    continue
                try:
                    verdict[i], changed = call_rule(rule.fn, text, on_null_verdict, rule.name)
                except Exception:
                    if rule.on_error == "fail":
                        raise
                    verdict[i], changed = ACTION_DROP if rule.on_error == "drop" else ACTION_CONT, {}
                for f, t in changed.items():
                    out[f][i] = t
            yield pa.RecordBatch.from_arrays(
                [*(rb.column(c) for c in keep), *(pa.array(out[f], pa.string()) for f in ENVELOPE_FIELDS),
                 pa.array(verdict, pa.int32())], names=[*keep, *(f"_out_{f}" for f in ENVELOPE_FIELDS), VERDICT_COL])
    return run


def written_back(fields: dict[str, T.DataType], on_error: str = "fail") -> tuple[dict, Column]:
    """(columns of the envelope after a rule: the parsed text of ``_out_<field>``
    where there is one, else the column as it was; whether any text held a value
    that its column's type can't take, which is an error, or leaves the column)."""
    cols, any_bad = {}, F.lit(False)
    for f, dt in fields.items():
        text = F.col(f"_out_{f}")
        schema = T.StructType([T.StructField(f, dt), T.StructField("_bad", T.StringType())])
        parsed = F.from_json(text, schema, {"timestampFormat": TIME_FORMAT, "timestampNTZFormat": TIME_FORMAT,
                                            "columnNameOfCorruptRecord": "_bad"})
        value, bad = parsed[f], F.coalesce(parsed["_bad"].isNotNull(), F.lit(False))
        if on_error == "fail":
            value = F.when(bad, F.raise_error(F.concat(F.lit("a rule changed a value to another type: "), text))).otherwise(value)
            cols[f] = F.when(text.isNotNull(), value).otherwise(F.col(f))
        else:
            cols[f] = F.when(text.isNotNull() & ~bad, value).otherwise(F.col(f))
        any_bad = any_bad | bad
    return cols, any_bad


def encoded(df: DataFrame):
    """The payload text of an event, as it is delivered."""
    return F.to_json(F.struct(*payload_parts(df)), JSON_OPTIONS)


def apply_python_rule(df: DataFrame, rule: PythonRule, on_null_verdict: str = "fail", keep_dropped: bool = False) -> DataFrame:
    """One Python rule over events that carry ``_verdict`` (see rules.apply_rule).

    ``mapInArrow``: every column passes through as the same Arrow arrays; only
    events the guard matches are encoded, handed to the function and written
    back where it changed them.  Unmatched events are untouched.  With
    ``keep_dropped`` events that a rule has dropped, this one or an earlier, stay
    with their verdict and don't reach the function.
    """
    gone = F.col(VERDICT_COL) == ACTION_DROP
    if rule.fn is None:
        return df.withColumn(VERDICT_COL, F.when(gone, ACTION_DROP).otherwise(ACTION_CONT) if keep_dropped else F.lit(ACTION_CONT))
    own = [c for c in df.columns if c != VERDICT_COL]
    guard = rule.guard() & ~gone if keep_dropped else rule.guard()
    was = [gone.alias("_gone")] if keep_dropped else []
    packed = df.select(*own, *was, F.when(guard, encoded(df)).alias("_evt"))
    keep = [c for c in packed.columns if c != "_evt"]
    out_schema = T.StructType([packed.schema[c] for c in keep]
                              + [T.StructField(f"_out_{f}", T.StringType()) for f in ENVELOPE_FIELDS]
                              + [T.StructField(VERDICT_COL, T.IntegerType())])
    res = packed.mapInArrow(_runner(rule, keep, on_null_verdict), out_schema)
    back, bad = written_back({f: df.schema[f].dataType for f in ENVELOPE_FIELDS}, rule.on_error)
    verdict = F.col(VERDICT_COL)
    if keep_dropped:
        stays = (F.col("_gone") | bad) if rule.on_error == "drop" else F.col("_gone")
        verdict = F.when(stays, ACTION_DROP).otherwise(verdict)
    elif rule.on_error == "drop":
        res = res.filter(~bad)
    out = res.select(*[back[c].alias(c) if c in back else F.col(c) for c in own], verdict.alias(VERDICT_COL))
    return out if keep_dropped else out.filter(F.col(VERDICT_COL) != ACTION_DROP)
