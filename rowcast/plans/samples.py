"""The upstream sample rules, written as expression rules.

* ``generic``: on ``test_.*``/``test_.*`` drop an event when any ``after`` row
  has ``text_col == "ignore"``, reroute it when one has ``"change-kafka"``
  and mask ``text_col`` values longer than three characters.
* ``another-rule``: drop every event of ``tenant_.*``/``entity_1``.
* ``keep_should_continue``: on ``test_.*``/``test_.*`` deliver only events
  whose first ``after`` row has ``text_col == "should-continue"``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from rowcast import functions as RF
from rowcast.model import ACTION_CONT, ACTION_DROP, MASK_TEXT
from rowcast.operators.rules import Rule, drop_rule

# Fixed values of the upstream sample configuration (must stay equal to it).
GENERIC_SCHEMA = "test_.*"
GENERIC_TABLE = "test_.*"
IGNORE_TEXT = "ignore"
REROUTE_TEXT = "change-kafka"
REROUTE_TOPIC = "another-topic"
REROUTE_KEY = "another-msg-key"
MASK_MIN_LENGTH = 3
TENANT_SCHEMA = "tenant_.*"
TENANT_TABLE = "entity_1"
KEEP_TEXT = "should-continue"


def generic_rule() -> Rule:
    hit = RF.any_row_eq("after", "text_col", REROUTE_TEXT)
    return Rule(
        name="generic", match_schema=GENERIC_SCHEMA, match_table=GENERIC_TABLE,
        verdict=F.when(RF.any_row_eq("after", "text_col", IGNORE_TEXT), ACTION_DROP).otherwise(ACTION_CONT),
        set={
            "kafka.topic": F.when(hit, F.lit(REROUTE_TOPIC)).otherwise(F.col("kafka.topic")),
            "kafka.key": F.when(hit, F.lit(REROUTE_KEY)).otherwise(F.col("kafka.key")),
            "after": RF.mask_field("after", "text_col", MASK_MIN_LENGTH),
        },
    )


def tenant_drop_rule() -> Rule:
    return drop_rule("another-rule", match_schema=TENANT_SCHEMA, match_table=TENANT_TABLE)


def sample_rules() -> list[Rule]:
    return [generic_rule(), tenant_drop_rule()]


def keep_should_continue_rule() -> Rule:
    first = RF.first_row("after")
    return Rule(name="generic-test-1", match_schema=GENERIC_SCHEMA, match_table=GENERIC_TABLE,
                verdict=F.when(first["text_col"] == KEEP_TEXT, ACTION_CONT).otherwise(ACTION_DROP))


def empty_rule() -> Rule:
    """A rule with no function: a no-op that resets the verdict."""
    return Rule(name="")


# ---------------------------------------------------------------- the same rules as Python functions

def utf16_length(s: str) -> int:
    """A script's ``.length``: UTF-16 code units."""
    return len(s.encode("utf-16-le")) // 2


def generic_script(event: dict) -> int:
    verdict = ACTION_CONT
    for row in event.get("after") or []:  # a null image is a no-op, as for expression rules
        text = row.get("text_col")
        if text == IGNORE_TEXT:
            verdict = ACTION_DROP
        if text == REROUTE_TEXT:
            event["kafka"]["topic"] = REROUTE_TOPIC
            event["kafka"]["key"] = REROUTE_KEY
        if text is not None and utf16_length(text) > MASK_MIN_LENGTH:
            row["text_col"] = MASK_TEXT
    return verdict


def drop_script(event: dict) -> int:
    return ACTION_DROP


def sample_python_rules():
    from rowcast.operators.pyrule import PythonRule
    return [PythonRule("generic", GENERIC_SCHEMA, GENERIC_TABLE, generic_script),
            PythonRule("another-rule", TENANT_SCHEMA, TENANT_TABLE, drop_script)]


# ---------------------------------------------------------------- the same rules for the mixed layout

def generic_rule_mixed() -> Rule:
    from rowcast.functions import mixed as MF

    hit = MF.any_row("after", "text_col", lambda v: v == REROUTE_TEXT)
    return Rule(
        name="generic", match_schema=GENERIC_SCHEMA, match_table=GENERIC_TABLE,
        verdict=F.when(MF.any_row("after", "text_col", lambda v: v == IGNORE_TEXT), ACTION_DROP).otherwise(ACTION_CONT),
        set={
            "kafka.topic": F.when(hit, F.lit(REROUTE_TOPIC)).otherwise(F.col("kafka.topic")),
            "kafka.key": F.when(hit, F.lit(REROUTE_KEY)).otherwise(F.col("kafka.key")),
            "after": MF.mask_field("after", "text_col", MASK_MIN_LENGTH),
        },
    )


def sample_rules_mixed() -> list[Rule]:
    return [generic_rule_mixed(), tenant_drop_rule()]
