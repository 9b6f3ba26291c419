"""Status buckets, colors and lookups used by the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ROAS thresholds, best first, with status, direction and color.
ROAS_LEVELS = [
    (2.0, "Excellent", "up", "#22c55e"),
    (1.5, "Good", "up", "#fbbf24"),
    (1.0, "Break-even", "neutral", "#f97316"),
]
ROAS_LOWEST = ("Poor", "down", "#ef4444")
ROAS_BENCHMARK = 1.5
ROAS_AXIS = (0.0, 4.0)
# Gauge bands by their lower end; the top band is open.
ROAS_BANDS = [(2.0, "2-4"), (1.5, "1.5-2"), (1.0, "1-1.5")]
ROAS_LOWEST_BAND = "0-1"

# Channel colors.
CHANNEL_COLORS = {
    "Meta": "#1877f2",
    "Google": "#34a853",
    "TikTok": "#ff0050",
    "Other": "#64748b",
}
DEFAULT_CHANNEL_COLOR = "#64748b"


def _at_least(value: str, levels: list[tuple[float, str]], otherwise: str) -> Column:
    """The label of the first level reached; a missing value reaches none."""
    steps = " ".join(f"when {value} >= {level}D then '{label}'" for level, label in levels)
    return F.expr(f"case {steps} else '{otherwise}' end")


def roas_status(roas: str) -> Column:
    return _at_least(roas, [(level, status) for level, status, _, _ in ROAS_LEVELS], ROAS_LOWEST[0])


def roas_direction(roas: str) -> Column:
    return _at_least(roas, [(level, way) for level, _, way, _ in ROAS_LEVELS], ROAS_LOWEST[1])


def roas_color(roas: str) -> Column:
    return _at_least(roas, [(level, color) for level, _, _, color in ROAS_LEVELS], ROAS_LOWEST[2])


def roas_verdict(roas: str) -> Column:
    """good from the benchmark up, bad otherwise."""
    return _at_least(roas, [(ROAS_BENCHMARK, "good")], "bad")


def roas_band(roas: str) -> Column:
    """The band of the gauge."""
    return _at_least(roas, ROAS_BANDS, ROAS_LOWEST_BAND)


def channel_color(channel: str) -> Column:
    steps = " ".join(f"when '{name}' then '{color}'" for name, color in CHANNEL_COLORS.items())
    return F.expr(f"case {channel} {steps} else '{DEFAULT_CHANNEL_COLOR}' end")


def pick(values: list, position: str) -> str:
    """SQL of the value at ``position`` modulo the length of ``values``."""
    items = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    return f"element_at(array({items}), cast(pmod({position}, {len(values)}) as int) + 1)"
