"""Labelling rules as native Column expressions (no UDFs).

Each rule is a ``CASE WHEN`` chain Catalyst folds into one projection.
Nulls fall through to the final label, which is observable behaviour of the
rules: an unknown magnitude reads NEGLIGIBLE, an unknown depth DEEP, an
unknown position Pacific/Other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must match the published rules exactly) ----------------
# Severity: lowest magnitude (inclusive) for each label, checked top-down.
SEVERITY_THRESHOLDS = [
    (7.0, "CATASTROPHIC"),
    (6.0, "MAJOR"),
    (5.0, "STRONG"),
    (4.0, "MODERATE"),
    (3.0, "MINOR"),
    (2.0, "MICRO"),
]
SEVERITY_DEFAULT = "NEGLIGIBLE"

# Depth class: greatest depth in km (inclusive) for each label.
DEPTH_LIMITS = [
    (70, "SHALLOW"),
    (300, "INTERMEDIATE"),
]
DEPTH_DEFAULT = "DEEP"

# Region boxes, first match wins:
# (label, lat_min, lat_max, lon_min, lon_max), all bounds inclusive.
REGION_BOXES = [
    ("North America", 24, 49, -125, -66),
    ("Europe", 35, 72, -10, 40),
    ("Asia", -10, 55, 60, 150),
    ("South America", -55, 15, -82, -34),
    ("Africa", -35, 37, -18, 52),
    ("Oceania", -50, -10, 110, 180),
    ("Alaska/Arctic", 51, 72, -168, -130),
]
REGION_DEFAULT = "Pacific/Other"

ALERT_DEFAULT = "none"

# Severities counted as critical in the report layer.
CRITICAL_SEVERITIES = ["MAJOR", "STRONG", "CATASTROPHIC"]
# ---------------------------------------------------------------------------

SEVERITY_LABELS = [label for _, label in SEVERITY_THRESHOLDS] + [SEVERITY_DEFAULT]
REGION_LABELS = [b[0] for b in REGION_BOXES] + [REGION_DEFAULT]


def _chain(cases, default: str) -> Column:
    """Fold ``[(condition, label), ...]`` into one CASE WHEN expression."""
    first, *rest = cases
    expr = F.when(first[0], F.lit(first[1]))
    expr = reduce(lambda acc, c: acc.when(c[0], F.lit(c[1])), rest, expr)
    return expr.otherwise(F.lit(default))


def severity(magnitude: Column | str = "magnitude") -> Column:
    m = F.col(magnitude) if isinstance(magnitude, str) else magnitude
    return _chain([(m >= t, label) for t, label in SEVERITY_THRESHOLDS], SEVERITY_DEFAULT)


def depth_category(depth: Column | str = "depth_km") -> Column:
    d = F.col(depth) if isinstance(depth, str) else depth
    return _chain([(d <= t, label) for t, label in DEPTH_LIMITS], DEPTH_DEFAULT)


def region(lat: Column | str = "latitude", lon: Column | str = "longitude") -> Column:
    la = F.col(lat) if isinstance(lat, str) else lat
    lo = F.col(lon) if isinstance(lon, str) else lon
    cases = [
        (la.between(a, b) & lo.between(c, d), label)
        for label, a, b, c, d in REGION_BOXES
    ]
    return _chain(cases, REGION_DEFAULT)


def alert_level(alert: Column | str = "alert_level") -> Column:
    a = F.col(alert) if isinstance(alert, str) else alert
    return F.coalesce(a, F.lit(ALERT_DEFAULT))


def is_critical(sev: Column | str = "severity") -> Column:
    s = F.col(sev) if isinstance(sev, str) else sev
    return s.isin(*CRITICAL_SEVERITIES)
