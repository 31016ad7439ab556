"""Column expressions shared by the operators. All of them stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowlake import schema as S

_WHITESPACE = " \t\n\r\x0b\x0c"


def strip(col: Column) -> Column:
    """Remove every kind of leading and trailing whitespace (``trim`` only removes spaces)."""
    return F.btrim(col, F.lit(_WHITESPACE))


def finite(col: Column) -> Column:
    """NaN and both infinities become null."""
    return F.when(F.isnan(col) | (F.abs(col) == float("inf")), None).otherwise(col)


def to_number(col: Column) -> Column:
    """Text to double; what is not a number becomes null instead of an error.

    A trailing type letter ("1.5d") would pass the JVM's number parser, so it is refused.
    """
    text = strip(col.cast("string"))
    lower = F.lower(text)
    suffixed = F.right(lower, F.lit(1)).isin("d", "f") & ~lower.isin("inf", "+inf", "-inf")
    return F.when(~suffixed, text.try_cast("double"))


def binary_label(col: Column, numeric: bool = False) -> Column:
    """0 for benign, 1 for anything else, null included. Numeric labels are kept as they are."""
    if numeric:
        return col.cast("int")
    return (~strip(col).eqNullSafe(S.BENIGN)).cast("int")


def severity(confidence: Column, critical: float = S.CRITICAL_CUT, medium: float = S.MEDIUM_CUT) -> Column:
    return (
        F.when(confidence >= critical, "critical").when(confidence >= medium, "medium").otherwise("low")
    )


def is_alert(
    confidence: Column,
    threshold: float | Column = S.ALERT_THRESHOLD,
    rule: str = "ge",
    label: Column | None = None,
) -> Column:
    """Alert decision. ``ge``: at the threshold counts; ``gt``: it does not;
    ``label_and_gt``: the hard label must say attack as well."""
    if rule == "ge":
        return confidence >= threshold
    if rule == "gt":
        return confidence > threshold
    if rule == "label_and_gt":
        if label is None:
            raise ValueError("rule 'label_and_gt' needs the label column")
        return (label == 1) & (confidence > threshold)
    raise ValueError(f"unknown alert rule {rule!r}")


def protocol_name(protocol: Column, unknown_as: str = "ICMP") -> Column:
    """Counters file unknown numbers under ICMP, alert records under TCP: pass ``unknown_as``."""
    return (
        F.when(protocol == 6, "TCP")
        .when(protocol == 17, "UDP")
        .when(protocol == 1, "ICMP")
        .otherwise(unknown_as)
    )


def clamp(col: Column, low, high) -> Column:
    return F.least(F.greatest(col, F.lit(low)), F.lit(high))


def align_vector(values: Column, width: int) -> Column:
    """Pad an array of doubles with zeros, or cut it, to ``width`` elements."""
    return F.slice(F.concat(values, F.array_repeat(F.lit(0.0), width)), 1, width)


def logistic(logit: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def probability_pair(p_attack: Column) -> Column:
    return F.array(F.lit(1.0) - p_attack, p_attack)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, 0 when the denominator is 0 or there are no rows."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def weekday_index(ts: Column) -> Column:
    """0 = Monday."""
    return F.weekday(ts)


def text_digest(cols: list[Column], seed: int = S.SEED) -> Column:
    """A repeatable pseudo-random order key: the same on every run and every partitioning."""
    parts = [F.coalesce(c.cast("string"), F.lit("\x00")) for c in cols]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
