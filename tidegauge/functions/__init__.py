from tidegauge.functions.status import (
    SEVERITY,
    compliance_level,
    severity_name,
    status_severity,
)
from tidegauge.functions.times import (
    as_type,
    clock,
    iso,
    micros,
    parse_iso,
    round_half_even,
    seconds_between,
)

__all__ = [
    "SEVERITY",
    "as_type",
    "clock",
    "compliance_level",
    "iso",
    "micros",
    "parse_iso",
    "round_half_even",
    "seconds_between",
    "severity_name",
    "status_severity",
]
