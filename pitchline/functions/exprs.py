"""Column helpers shared by every mart. All are built-in Spark expressions (codegen, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

# Match-clock offsets in seconds for periods 1-4 (0, 45, 90 and 105 minutes).
PERIOD_OFFSETS_SECONDS = {1: 0, 2: 45 * 60, 3: 90 * 60, 4: 105 * 60}

# Play-pattern buckets.
OPEN_PLAY_PATTERNS = ("Regular Play", "From Counter", "From Kick Off")
SET_PIECE_PATTERNS = ("From Corner", "From Free Kick")
SET_PIECE_CHAIN_PATTERNS = ("From Corner", "From Free Kick", "From Throw In")

# Pitch thresholds (x runs 0..120 towards the acting team's attacking goal).
FINAL_THIRD_X = 80.0
HALFWAY_X = 60.0
PROGRESSIVE_GAIN = 10.0
PPDA_OWN_MIN_X = 48.0
PPDA_OPP_MAX_X = 72.0


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dbl(x) -> Column:
    """Cast to double before arithmetic (integer * 1.0 is decimal in Spark, double elsewhere)."""
    return c(x).cast("double")


def ratio(num, den) -> Column:
    """num / den as double, NULL when den is 0 or NULL (never raises under ANSI mode)."""
    return dbl(num) / F.nullif(dbl(den), F.lit(0.0))


def round_half_away(x, n: int) -> Column:
    """Round a double to n places as ``round(x * 10^n) / 10^n``, half away from zero.

    Spark's ``round(double, n)`` rounds the shortest decimal text of the value (0.285 -> 0.29),
    whereas scaling first rounds the binary value (0.285 -> 0.28), which is what the SQL oracle
    does. Both agree on every exactly representable half.
    """
    scale = float(10 ** n)
    return F.round(dbl(x) * F.lit(scale), 0) / F.lit(scale)


def exact_mean(x, digits: int = 6) -> Column:
    """Mean of values that carry at most ``digits`` decimals, independent of summation order:
    each value is scaled to an integer (exact in a double below 2**53), the integers are summed
    exactly in any order, and the total is divided once. A plain ``avg`` of doubles can differ in
    the last bit between plans, which flips a later rounding at a half (0.63375 -> 0.6337/0.6338).
    """
    scale = float(10 ** digits)
    return F.sum(F.round(dbl(x) * F.lit(scale), 0)) / F.count(c(x)) / F.lit(scale)


def per90(metric, minutes) -> Column:
    """Rate per 90 minutes; NULL for zero minutes."""
    return dbl(metric) * F.lit(90.0) / F.nullif(dbl(minutes), F.lit(0.0))


def count_when(cond: Column) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END) as bigint; NULL conditions count as 0."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long")


def sum_when(cond: Column, value) -> Column:
    """SUM(CASE WHEN cond THEN value ELSE 0 END) for a double value."""
    return F.sum(F.when(cond, dbl(value)).otherwise(F.lit(0.0)))


def any_flag(cond: Column) -> Column:
    """MAX(CASE WHEN cond THEN 1 ELSE 0 END): 0/1 'any row matched' flag as int."""
    return F.max(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def mmss_to_seconds(x) -> Column:
    """'MM:SS' -> seconds as int; minutes may exceed 59 ('120:00')."""
    s = c(x)
    return (F.split_part(s, F.lit(":"), F.lit(1)).cast("int") * F.lit(60)
            + F.split_part(s, F.lit(":"), F.lit(2)).cast("int"))


def array_at(arr, i: int) -> Column:
    """1-based array index, NULL when out of range or the array is NULL (never raises)."""
    return F.get(c(arr), i - 1)


def team_key(team, competition, season) -> Column:
    """Composite business key 'team|competition|season'; NULL if any part is NULL (never concat_ws)."""
    return F.concat(c(team), F.lit("|"), c(competition), F.lit("|"), c(season).cast("string"))


def period_clock(period="period", minute="minute", second="second",
                 convention: str = "per_period") -> Column:
    """Absolute match second.

    ``per_period``: minute restarts each period, so add 0/45/90/105 minute offsets.
    ``cumulative``: minute already counts from kick-off; no offset.
    Periods outside 1..4 give NULL under per_period.
    """
    base = c(minute).cast("long") * F.lit(60) + c(second).cast("long")
    if convention == "cumulative":
        return base
    if convention != "per_period":
        raise ValueError(f"unknown clock convention {convention!r}")
    offset = None
    for p, off in PERIOD_OFFSETS_SECONDS.items():
        offset = (F.when(c(period) == p, F.lit(off)) if offset is None
                  else offset.when(c(period) == p, F.lit(off)))
    return offset + base


def measured_offsets(periods, match="match_id", period="period", last="last_second"):
    """Second at which each period of a match begins on the measured clock: the running sum of the
    periods before it, each as long as its last event's second and one more, so that stoppage time
    never overlaps the next period. ``periods`` has one row per (match, period)."""
    before = Window.partitionBy(match).orderBy(period).rowsBetween(Window.unboundedPreceding, -1)
    return periods.withColumn("period_start", F.coalesce(F.sum(c(last) + 1).over(before), F.lit(0)))


def is_progressive(start_x, end_x, gain: float = PROGRESSIVE_GAIN,
                   line: float = FINAL_THIRD_X) -> Column:
    """Forward gain >= gain and ending at or beyond the final-third line."""
    return ((c(end_x) - c(start_x)) >= gain) & (c(end_x) >= line)


def is_zone_entry(start_x, end_x, line: float = FINAL_THIRD_X) -> Column:
    """Start before the line and end at or beyond it."""
    return (c(start_x) < line) & (c(end_x) >= line)
