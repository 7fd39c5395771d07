"""Business rules as column expressions. Thresholds, patterns and labels are parameters with the usual defaults."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from couponlens.functions.dates import MICROS_PER_HOUR

# Bucket bounds in hours, half open, with their labels.
LEAD_BOUNDS = (1, 24, 72, 168, 336, 672)
LEAD_LABELS = ("<1h", "1h-1d", "1-3d", "3d-1w", "1-2w", "2-4w", "4w+")
DURATION_BOUNDS = (4, 8, 24, 48, 72)
DURATION_LABELS = ("<4h", "4-8h", "8-24h", "1 night", "2 nights", "3d+")
USE_TIME_BOUNDS = (4, 8, 24)
USE_TIME_LABELS = ("~4h", "4~8h", "8~24h", "24h+")

# Start-hour blocks [from, to); the last one wraps around midnight.
TIME_BLOCKS = (("06-10", 6, 10), ("10-14", 10, 14), ("14-18", 14, 18), ("18-22", 18, 22), ("22-06", 22, 6))

# Weekday names, Sunday first.
WEEKDAYS = ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")

GPM_TARGET = 25.0


@dataclass(frozen=True)
class ClassRule:
    """One step of a first-match-wins classification: a name pattern or a list of divisions."""

    label: str
    contains: str | None = None
    divisions: tuple[str, ...] = ()

    def condition(self, name: Column, division: Column) -> Column:
        return name.contains(self.contains) if self.contains is not None else division.isin(*self.divisions)


def classify(name: Column, division: Column, rules: Sequence[ClassRule], default: str = "other") -> Column:
    """First rule that holds gives the class. A null name or division makes its rule not hold."""
    chain = None
    for rule in rules:
        hit = rule.condition(name, division)
        chain = F.when(hit, rule.label) if chain is None else chain.when(hit, rule.label)
    return F.lit(default) if chain is None else chain.otherwise(default)


def contains_any(name: Column, patterns: Sequence[str]) -> Column:
    return reduce(or_, [name.contains(p) for p in patterns], F.lit(False))


def bucket(value: Column, bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """Half-open buckets: below the first bound, ``[bounds[i], bounds[i+1])``, then the rest. Null stays null."""
    if len(labels) != len(bounds) + 1:
        raise ValueError("one label more than bounds is needed")
    chain = F.when(value.isNull(), F.lit(None).cast("string"))
    for bound, label in zip(bounds, labels):
        chain = chain.when(value < F.lit(bound), label)
    return chain.otherwise(labels[-1])


def hour_bucket(micros: Column, bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """``bucket`` on a time span in microseconds with bounds in hours."""
    return bucket(micros, [int(b * MICROS_PER_HOUR) for b in bounds], labels)


def label_position(label: Column, labels: Sequence[str]) -> Column:
    """1-based place of a label in its list, for ordering rows."""
    return F.array_position(F.array(*[F.lit(x) for x in labels]), label).cast("int")


def time_block(hour: Column, blocks: Sequence[tuple[str, int, int]] = TIME_BLOCKS) -> Column:
    chain = None
    for label, start, end in blocks:
        inside = (hour >= start) & (hour < end) if start < end else (hour >= start) | (hour < end)
        chain = F.when(inside, label) if chain is None else chain.when(inside, label)
    return chain


def weekday_name(dow: Column, names: Sequence[str] = WEEKDAYS) -> Column:
    """Name of Spark's ``dayofweek`` value (1 = Sunday)."""
    return F.element_at(F.array(*[F.lit(x) for x in names]), dow)


def gpm_band_target(gpm: Column, target: float = GPM_TARGET) -> Column:
    """Colour against the target: no value yet is new, a loss red, below target yellow, else green."""
    return F.when(gpm.isNull(), "new").when(gpm < 0, "red").when(gpm < target, "yellow").otherwise("green")


def gpm_band_abs(gpm: Column, cuts: tuple[float, float] = (25.0, 10.0)) -> Column:
    """Colour by level alone: green from the upper cut, yellow from the lower one, else red."""
    return F.when(gpm >= cuts[0], "green").when(gpm >= cuts[1], "yellow").otherwise("red")


def delta_direction(delta: Column) -> Column:
    """up / down / flat, and ``-`` for a missing or non-finite change."""
    finite = ~F.isnan(delta) & (F.abs(delta) != F.lit(float("inf")))
    return (
        F.when(delta.isNull() | ~finite, "-").when(delta > 0, "up").when(delta < 0, "down").otherwise("flat")
    )


def signed_text(delta: Column, decimals: int = 1, suffix: str = "") -> Column:
    """Change with an explicit plus sign; ``-`` when there is none."""
    body = F.concat(
        F.when(delta > 0, "+").otherwise(""), F.format_number(delta, decimals), F.lit(suffix)
    )
    return F.when(delta_direction(delta) == "-", "-").otherwise(body)


def volume_tier(count: Column, cuts: tuple[int, int] = (100, 30)) -> Column:
    return F.when(count >= cuts[0], "high").when(count >= cuts[1], "mid").otherwise("low")


def change_status(prev: Column, cur: Column) -> Column:
    """State of an item between two periods, by volume."""
    p, c = F.coalesce(prev, F.lit(0)), F.coalesce(cur, F.lit(0))
    return (
        F.when((p == 0) & (c == 0), "absent").when(c == 0, "ended").when(p == 0, "new")
        .when(c > p, "grew").when(c < p, "shrank").otherwise("same")
    )


def target_verdict(gpm: Column, target: float = GPM_TARGET, margin: float = 10.0) -> Column:
    """Below target the discount is excessive, up to ``margin`` above it adequate, beyond that excellent."""
    return (
        F.when(gpm.isNull(), F.lit(None).cast("string")).when(gpm < target, "excessive")
        .when(gpm < target + margin, "adequate").otherwise("excellent")
    )


def level_of(ratio: Column, cuts: Sequence[float], levels: Sequence[str]) -> Column:
    """First level whose cut the ratio exceeds; a null ratio exceeds none and gets the last level."""
    if len(levels) != len(cuts) + 1:
        raise ValueError("one level more than cuts is needed")
    chain = None
    for cut, level in zip(cuts, levels):
        chain = F.when(ratio > cut, level) if chain is None else chain.when(ratio > cut, level)
    return F.lit(levels[0]) if chain is None else chain.otherwise(levels[-1])
