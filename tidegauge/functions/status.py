"""Status rules as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegauge.model import CRITICAL_VIOLATIONS

# Statuses from harmless to worst.
SEVERITY = ("idle", "ok", "warning", "alarm")


def status_severity(value: Column, lo: Column, hi: Column) -> Column:
    """Position in ``SEVERITY`` of one reading against its limits (RUL-1).

    Outside the limits is an alarm, within a tenth of the range of a limit a
    warning, all comparisons strict; no value is idle. NaN sorts above every
    number in Spark and so is an alarm.
    """
    margin = (hi - lo) * F.lit(0.1)
    return (
        F.when(value.isNull(), 0)
        .when((value < lo) | (value > hi), 3)
        .when((value < lo + margin) | (value > hi - margin), 2)
        .otherwise(1)
    )


def severity_name(severity: Column) -> Column:
    names = F.array(*[F.lit(s) for s in SEVERITY])
    return F.element_at(names, severity + 1)


def compliance_level(
    violations: Column, critical_at: int | Column = CRITICAL_VIOLATIONS
) -> Column:
    """OK / WARNING / CRITICAL from a number of violations (RUL-4)."""
    return (
        F.when(violations == 0, "OK")
        .when(violations < critical_at, "WARNING")
        .otherwise("CRITICAL")
    )
