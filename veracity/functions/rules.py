"""Stage-2 rule, decision reasons and the two-stage cascade."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veracity.schema import (
    DEFAULT_EMOTION_HIGH,
    REASON_DOMINANT,
    REASON_EMOTION_ONLY,
    REASON_JOINT,
    REASON_OTHER,
    REASON_STAGE1,
)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _v(v) -> Column:
    return v if isinstance(v, Column) else F.lit(float(v))


def rule_parts(e, x, i, rule: dict):
    """(joint, dominant, emotion_only) boolean columns.  ``rule`` values are floats or
    Columns (e.g. from a broadcast one-row rule table)."""
    e, x, i = _c(e), _c(x), _c(i)
    xt, it = _v(rule["exaggeration_threshold"]), _v(rule["irony_threshold"])
    ht, m = _v(rule["irony_high_threshold"]), _v(rule["irony_dominance_margin"])
    eh = _v(rule.get("emotion_high_threshold", DEFAULT_EMOTION_HIGH))
    joint = (x >= xt) & (i >= it)
    dominant = (i >= ht) & (i >= e + m) & (i >= x + m)
    emotion_only = (e >= eh) & (x < xt) & (i < it)
    return joint, dominant, emotion_only


def stage2_rule(e, x, i, rule: dict) -> Column:
    """1 = satire, 0 = fake."""
    joint, dominant, _ = rule_parts(e, x, i, rule)
    return F.when(joint | dominant, F.lit(1)).otherwise(F.lit(0))


def stage2_reason(e, x, i, rule: dict) -> Column:
    """first of joint, dominant, emotion-only, other."""
    joint, dominant, emotion_only = rule_parts(e, x, i, rule)
    return (F.when(joint, F.lit(REASON_JOINT)).when(dominant, F.lit(REASON_DOMINANT))
            .when(emotion_only, F.lit(REASON_EMOTION_ONLY)).otherwise(F.lit(REASON_OTHER)))


def decide(p, threshold, e, x, i, rule: dict) -> Column:
    """``p < threshold`` → real; else satire / fake by the rule."""
    return F.when(_c(p) < _v(threshold), F.lit("real")).when(
        stage2_rule(e, x, i, rule) == 1, F.lit("satire")).otherwise(F.lit("fake"))


def decision_reason(p, threshold, e, x, i, rule: dict) -> Column:
    return F.when(_c(p) < _v(threshold), F.lit(REASON_STAGE1)).otherwise(stage2_reason(e, x, i, rule))


def suspicious_target(label) -> Column:
    """fake, satire → 1; real → 0; an unknown or NULL label has no target."""
    return F.when(_c(label).isin("fake", "satire"), F.lit(1)).when(_c(label) == "real", F.lit(0))


def stage2_target(label) -> Column:
    """satire → 1, fake → 0, other → -1."""
    lab = _c(label)
    return F.when(lab == "satire", F.lit(1)).when(lab == "fake", F.lit(0)).otherwise(F.lit(-1))
