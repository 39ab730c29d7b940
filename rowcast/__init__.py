"""rowcast: change-data-capture event processing on Spark DataFrames."""

import sys as _sys

# Python code that runs in tasks (Python rules, stateful rules) is shipped by
# value, so executors need no installed copy of this package.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # pragma: no cover
    pass

from rowcast.model import ACTION_CONT, ACTION_DROP
from rowcast.operators.codec import decode, encode, payload
from rowcast.operators.envelope import build_events
from rowcast.operators.position import resume_filter, start_from, state_from_batch
from rowcast.operators.pyrule import PythonRule
from rowcast.operators.rules import Rule, SourceFilter, apply_rules, drop_rule, verdicts
from rowcast.plans.pipeline import PipelineSpec, run_batch, run_events, run_many

__all__ = ["ACTION_CONT", "ACTION_DROP", "PipelineSpec", "PythonRule", "Rule", "SourceFilter", "apply_rules",
           "build_events", "decode", "drop_rule", "encode", "payload", "resume_filter", "run_batch", "run_events",
           "run_many", "start_from", "state_from_batch", "verdicts"]
