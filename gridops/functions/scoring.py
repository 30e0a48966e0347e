"""Scores, levels and the sentences that explain them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridops.schema import ANOMALY_PERCENT, RISK_HIGH, RISK_MEDIUM


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def share(part, whole) -> Column:
    """part / whole, NULL when the whole is zero or missing."""
    return F.try_divide(_col(part), _col(whole))


def deviation(actual, baseline) -> Column:
    return _col(actual) - _col(baseline)


def anomaly_score(actual, baseline) -> Column:
    """Percent away from the baseline; 0.0 without a positive baseline."""
    actual, baseline = _col(actual), _col(baseline)
    return F.when(baseline > 0, (actual - baseline) / baseline * 100).otherwise(0.0)


def percent_score(current, baseline) -> Column:
    """Like :func:`anomaly_score`, but NULL without a positive baseline; NULL inputs count as 0."""
    current, baseline = F.coalesce(_col(current), F.lit(0.0)), F.coalesce(_col(baseline), F.lit(0.0))
    return F.when(baseline > 0, (current - baseline) / baseline * 100)


def anomaly_direction(score, threshold: float = ANOMALY_PERCENT) -> Column:
    score = _col(score)
    return F.when(score >= threshold, "HIGH").when(score <= -threshold, "LOW").otherwise("NORMAL")


def anomaly_flag(score, threshold: float = ANOMALY_PERCENT) -> Column:
    return F.when(F.abs(_col(score)) >= threshold, 1).otherwise(0)


def anomaly_reason(score, direction) -> Column:
    """Sentence naming the distance from the baseline."""
    size = F.round(F.abs(_col(score)), 2)
    side = F.when(_col(direction) == "HIGH", "above").when(_col(direction) == "LOW", "below")
    # Fixed wording.
    return F.coalesce(
        F.concat(F.lit("Activity is "), size, F.lit("% "), side, F.lit(" the historical baseline")),
        F.lit("Activity is within the historical baseline range"),
    )


def ratio_text(current, base) -> Column:
    """current / base with two decimals; ``inf`` or ``nan`` over a zero base."""
    current, base = _col(current), _col(base)
    return (
        F.when(base != 0, F.call_function("format_number", current / base, F.lit("0.00")))
        .when(current == 0, "nan")
        .when(base == 0, "inf")
    )


def alert_reason(current, base, ending: str) -> Column:
    """``ending`` follows the ratio, e.g. ``times the within baseline``."""
    # Fixed wording: the ratio is later parsed back from the text before "x times".
    return F.concat(F.lit("Current activity is "), ratio_text(current, base), F.lit("x times " + ending))


def reason_score(reason) -> Column:
    """Percent above the base encoded in an alert sentence; NULL if there is no number."""
    ratio = F.regexp_extract(_col(reason), r"(?s)(\S+?)\s*x times", 1)
    number = r"(?i)^[+-]?(inf|infinity|nan|(\d+\.?\d*|\.\d+)(e[+-]?\d+)?)$"
    ratio = F.when(ratio.rlike(number), ratio).try_cast("double")
    return F.round((ratio - 1.0) * 100.0, 4)


def risk_level(score) -> Column:
    score = _col(score)
    return F.when(score >= RISK_HIGH, "high").when(score >= RISK_MEDIUM, "medium").otherwise("low")


def apply_threshold(score, threshold: float = 0.5) -> Column:
    return F.when(_col(score) >= threshold, 1).otherwise(0)


def prediction_label(prediction) -> Column:
    return F.when(_col(prediction) == 1, "RISK").otherwise("NO RISK")


def status_label(text) -> Column:
    """HIGH, ATTENTION or NORMAL from free status text."""
    upper = F.upper(F.coalesce(_col(text), F.lit("")))
    attention = F.lit(False)
    for word in ("ATTENTION", "MEDIUM", "ALERT"):
        attention = attention | upper.contains(word)
    return F.when(upper.contains("HIGH"), "HIGH").when(attention, "ATTENTION").otherwise("NORMAL")
