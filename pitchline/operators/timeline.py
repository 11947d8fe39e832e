"""Score timeline, constant-state segments and event -> game-state attribution.

Scale design
------------
Every window here is partitioned by ``match_id`` but runs over data whose size per match is
bounded by the match clock, not by the event volume:

* scoring rows are first reduced to one row per (match, scoring second);
* events are first reduced (partial, map-side aggregation) to one row per (match, team, second)
  before their state is looked up.

So even a match holding a third of all events yields at most ~2 x (match length in seconds) rows
in any window partition. Per-event attribution (``attribute_events``) is an equi-join on
(match, team, second) against that bounded state table, which AQE can split when one key is hot.
No inequality self-join is used anywhere (the SQL original joins goals to goals and segments to
events on ranges, which is quadratic per match).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchline.functions.exprs import measured_offsets, period_clock

col = F.col

def goal_pred() -> Column:
    """A scoring event: a shot whose outcome is Goal (penalties included)."""
    return (col("event_type") == "Shot") & (col("shot_outcome") == "Goal")


def events_clock(ev: DataFrame, convention: str = "per_period") -> DataFrame:
    """Add ``abs_seconds`` (absolute match second); keep periods 1-4 with a known clock."""
    return (ev.where(col("period").between(1, 4) & col("minute").isNotNull()
                     & col("second").isNotNull())
            .withColumn("abs_seconds", period_clock("period", "minute", "second", convention)))


def measured_clock(ev: DataFrame) -> DataFrame:
    """Events of periods 1-4 with a known clock and ``measured_seconds``, which never lets a period's
    stoppage time run into the next one (T14): a period begins when all events of the one before are
    over. The offsets are one row per (match, period); only they are numbered per match."""
    timed = events_clock(ev, "cumulative").withColumnRenamed("abs_seconds", "_in_period")
    periods = timed.groupBy("match_id", "period").agg(F.max("_in_period").alias("last_second"))
    starts = measured_offsets(periods).select("match_id", "period", "period_start")
    return timed.join(starts, ["match_id", "period"]).withColumn("measured_seconds", col("_in_period") + col("period_start")).drop(
        "_in_period", "period_start")


def home_away(matches: DataFrame) -> DataFrame:
    return matches.select("match_id", col("home_team_name").alias("home_team"),
                          col("away_team_name").alias("away_team"))


def events_timed(ev: DataFrame, matches: DataFrame, convention: str = "per_period") -> DataFrame:
    """Per-event clock joined to its match's home/away teams (inner: unknown matches drop)."""
    base = events_clock(ev, convention).drop("home_team", "away_team")
    return base.join(home_away(matches), "match_id", "inner")


SECOND_KEYS = ["match_id", "team", "competition", "season", "abs_seconds"]


def per_second(timed: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    """Additive event ``metrics`` pre-aggregated to one row per (match, team, second): the
    only full shuffle of the events in the game-state mart (partial aggregation runs map-side)."""
    return timed.groupBy(*SECOND_KEYS).agg(*[e.alias(n) for n, e in metrics.items()])


def anchored(sec: DataFrame, matches: DataFrame) -> DataFrame:
    """The per-second rows of ``sec`` and one anchor row a match at second 0 (``_o`` 0) with its teams."""
    anchor = home_away(matches).select("match_id", F.lit(0).cast("long").alias("abs_seconds"), F.lit(0).alias("_o"),
                                       "home_team", "away_team")
    return sec.withColumn("_o", F.lit(1)).unionByName(anchor, allowMissingColumns=True)


def match_seconds(sec: DataFrame, matches: DataFrame | None) -> DataFrame:
    """The per-second rows of ``sec`` (with ``_goals``, the goals of that team in that second) and one
    anchor row a match at second 0 (``_o`` 0), each with its match's teams and last second and the
    running score up to and including its second.

    One scan, one exchange and one sort by (match, second) give all of it: scores are plain running
    sums (all rows of a second see all its goals, each goal once), teams come from the anchor.
    Matches without events and events of unknown matches drop out. Without ``matches``, ``sec`` holds
    the anchors already; a table of them bucketed by match needs no exchange here.
    """
    rows = sec if matches is None else anchored(sec, matches)
    order = Window.partitionBy("match_id").orderBy("abs_seconds")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns({"home_team": F.max("home_team").over(whole), "away_team": F.max("away_team").over(whole),
                             "match_end_seconds": F.max(F.when(col("_o") == 1, col("abs_seconds"))).over(whole)})
    goals = lambda side: F.sum(F.when(col("team") == col(side), col("_goals")).otherwise(0)).over(order)
    return (rows.where("home_team IS NOT NULL AND match_end_seconds IS NOT NULL")
            .withColumns({"home_score": goals("home_team").cast("long"), "away_score": goals("away_team").cast("long")}))


def score_segments(seconds: DataFrame) -> DataFrame:
    """Half-open constant-score segments tiling [0, match_end): a 0-0 anchor at second 0 (``_o`` 0),
    then one segment per scoring second with the score after it, each ending at the next change or
    at match end.

    The anchor sorts before a goal at second 0, which yields the zero-length [0, 0) 0-0 segment
    followed by [0, next) -- never a doubled interval; goals of both teams in one second give one
    segment.
    """
    nothing = F.lit(0).cast("long")
    rows = seconds.where("_o = 0 OR _goals > 0").select(
        "match_id", "_o", "abs_seconds", "match_end_seconds", "home_team", "away_team",
        *[F.when(col("_o") == 0, nothing).otherwise(col(c)).alias(c) for c in ("home_score", "away_score")])
    following = F.struct("abs_seconds", "_o")
    w = Window.partitionBy("match_id").orderBy("abs_seconds", "_o")
    rows = rows.withColumn("_next", F.lead(following).over(w)).where("_next IS NULL OR _next > struct(abs_seconds, _o)")
    return rows.select(
        "match_id", "_o", "match_end_seconds", "home_team", "away_team", col("abs_seconds").cast("double").alias("seg_start"),
        F.coalesce("_next.abs_seconds", "match_end_seconds").cast("double").alias("seg_end"), "home_score", "away_score")


def score_timeline(segments: DataFrame) -> DataFrame:
    """Cumulative (home_score, away_score) after each scoring second."""
    return segments.where("_o = 1").select("match_id", col("seg_start").cast("long").alias("goal_seconds"), "home_score", "away_score")


def match_frame(segments: DataFrame) -> DataFrame:
    """One row per match: (match_id, match_end_seconds, home_team, away_team)."""
    return segments.where("_o = 0").select("match_id", "match_end_seconds", "home_team", "away_team")


def game_state(for_score: Column, against_score: Column) -> Column:
    return (F.when(for_score > against_score, F.lit("Winning"))
            .when(for_score < against_score, F.lit("Losing")).otherwise(F.lit("Drawing")))


def mirror_segments(segments: DataFrame) -> DataFrame:
    """Each segment -> one row per team with its own game state (Winning/Losing swapped).

    ``explode(array(home, away))`` reads the segments once instead of a UNION ALL of two scans.
    """
    home = F.struct(col("home_team").alias("team"),
                    game_state(col("home_score"), col("away_score")).alias("game_state"))
    away = F.struct(col("away_team").alias("team"),
                    game_state(col("away_score"), col("home_score")).alias("game_state"))
    return (segments.select("match_id", "seg_start", "seg_end",
                            ((col("seg_end") - col("seg_start")) / F.lit(60.0)).alias("duration_minutes"),
                            F.explode(F.array(home, away)).alias("p"))
            .select("match_id", "seg_start", "seg_end", "duration_minutes", "p.team", "p.game_state"))


def state_durations(per_team: DataFrame) -> DataFrame:
    """Minutes per (match, team, state): whole seconds are summed exactly, then divided once."""
    return (per_team.groupBy("match_id", "team", "game_state")
            .agg((F.sum(col("seg_end") - col("seg_start")) / F.lit(60.0)).alias("minutes_in_state")))


def attribute_seconds(sec_rows: DataFrame, timeline: DataFrame, frame: DataFrame,
                      attribute: str = "after") -> DataFrame:
    """Game state of every (match, team, second) row of ``sec_rows``.

    ``attribute='after'`` (default): an event in the same second as a goal sees the score the goal
    creates (half-open [goal, next) segments). ``'before'`` sees the score before it.
    Rows at or after match end are dropped, as is a team that is neither home nor away.
    A running ``last(..., ignorenulls)`` over the union of scoring seconds and event seconds gives
    the score in force; both inputs are bounded per match by the clock domain.
    """
    goal_order = 0 if attribute == "after" else 2
    goals = timeline.select("match_id", col("goal_seconds").alias("abs_seconds"),
                            F.lit(goal_order).alias("_o"), col("home_score").alias("_hs"),
                            col("away_score").alias("_as"))
    rows = sec_rows.withColumn("_o", F.lit(1))
    w = (Window.partitionBy("match_id").orderBy("abs_seconds", "_o")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    scored = (rows.unionByName(goals, allowMissingColumns=True)
              .withColumn("hs", F.coalesce(F.last("_hs", ignorenulls=True).over(w), F.lit(0)))
              .withColumn("as_", F.coalesce(F.last("_as", ignorenulls=True).over(w), F.lit(0)))
              .where(col("_o") == 1).drop("_o", "_hs", "_as"))
    j = scored.join(frame, "match_id", "inner")
    j = j.where((col("abs_seconds") < col("match_end_seconds"))
                & ((col("team") == col("home_team")) | (col("team") == col("away_team"))))
    state = F.when(col("team") == col("home_team"), game_state(col("hs"), col("as_"))) \
        .otherwise(game_state(col("as_"), col("hs")))
    return j.withColumn("game_state", state).drop("hs", "as_", "match_end_seconds",
                                                  "home_team", "away_team")


def own_state(team: str = "team") -> Column:
    """Game state of a row's team by the row's score."""
    return F.when(col(team) == col("home_team"), game_state(col("home_score"), col("away_score"))).when(
        col(team) == col("away_team"), game_state(col("away_score"), col("home_score")))


def state_of_events(timed: DataFrame, matches: DataFrame, goal: Column | None = None) -> DataFrame:
    """Per-event game state, an event in a goal's second seeing the score after it: the states of
    all (match, team, second) come from one scan, the events of a second one are joined to them."""
    goals = F.count_if(goal_pred() if goal is None else goal)
    seconds = match_seconds(timed.groupBy("match_id", "team", "abs_seconds").agg(goals.alias("_goals")), matches)
    states = seconds.where("_o = 1 AND abs_seconds < match_end_seconds").select(
        "match_id", "team", "abs_seconds", own_state().alias("game_state")).where("game_state IS NOT NULL")
    return timed.join(states.hint("merge"), ["match_id", "team", "abs_seconds"])  # neither side fits a broadcast


def attribute_events(timed: DataFrame, timeline: DataFrame, frame: DataFrame,
                     attribute: str = "after") -> DataFrame:
    """Per-event game state from a given timeline: resolve the state once per distinct (match, team,
    second) -- a table bounded per match by the clock -- then equi-join the events back on those three
    keys. The join is an equi-join, so a hot match is split by AQE's skew handling, and the window
    never sees raw events."""
    secs = timed.select("match_id", "team", "abs_seconds").distinct()
    states = attribute_seconds(secs, timeline, frame, attribute)
    return timed.join(states.hint("merge"), ["match_id", "team", "abs_seconds"], "inner")


#: Children of a node of the tree that intervals are laid out on.
FAN = 8


def _nodes(low: Column, high: Column, levels: int, fan: int) -> Column:
    """The fewest nodes (level, number) of a tree of cells that cover the cells from ``low`` up to,
    but without, ``high``: at each level those that no node above covers."""
    def at_level(k: Column) -> Column:
        width = F.pow(F.lit(fan), k).cast("long")
        first, last = F.ceil(low / width), F.floor(high / width)  # whole nodes of this level
        up_first, up_last = F.ceil(first / F.lit(fan)) * fan, F.floor(last / F.lit(fan)) * fan  # what the next level takes
        run = lambda a, b: F.when(a < b, F.sequence(a, b - 1)).otherwise(F.array().cast("array<bigint>"))
        own = F.when((up_first < up_last) & (k < levels - 1), F.concat(run(first, up_first), run(up_last, last))).otherwise(run(first, last))
        return F.transform(own, lambda n: F.struct(k.alias("level"), n.alias("node")))
    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels - 1)), at_level))


def interval_join(points: DataFrame, intervals: DataFrame, keys: list[str], at: str, start: str = "seg_start", end: str = "seg_end",
                  cell: float = 1.0, fan: int = FAN) -> DataFrame:
    """General half-open interval containment join: equi keys plus ``start <= at < end``.

    The line is cut into cells of width ``cell``, and ``fan`` neighbours make a node of the level
    above. An interval is laid out on the few nodes that cover its cells; a point looks up its own
    node on each level in use. So the join is an equi join on (keys, level, node), every containing
    interval meets a point exactly once, and the work is bounded by the points, the intervals' nodes
    and the result, however many intervals a key has. The range itself is checked only for the
    interval's first and last cell, which it may cover in part.

    Rows with a NULL or NaN bound, point or key, empty intervals (``end <= start``) and points
    outside all intervals give nothing; bounds beyond 2**53 cells aren't supported.

    The nodes are many times their intervals, which the planner's estimate doesn't see, so the join is
    merged by name: neither side ever passes through the driver as a broadcast.
    """
    usable = intervals.where(f"`{start}` < `{end}` AND NOT isnan(`{start}`) AND NOT isnan(`{end}`)").withColumns({
        "_low": F.floor(col(start).cast("double") / cell), "_high": F.ceil(col(end).cast("double") / cell)})
    longest = usable.agg(F.max(col("_high") - col("_low"))).first()[0] or 1
    levels = 1
    while fan**levels <= longest:
        levels += 1
    laid = usable.withColumn("_n", F.explode(_nodes(col("_low"), col("_high"), levels, fan))).select(
        *[c for c in intervals.columns if c in keys or c in (start, end) or c not in points.columns], "_n.level", "_n.node")
    cells = F.floor(col(at).cast("double") / cell)
    looked = points.where(col(at).isNotNull() & ~F.isnan(col(at).cast("double"))).withColumn("_n", F.explode(F.array(*[
        F.struct(F.lit(k).alias("level"), F.floor(cells / F.lit(fan**k)).alias("node")) for k in range(levels)])))
    p, i = looked.alias("p"), laid.alias("i").hint("merge")
    cond = [col(f"p.{k}") == col(f"i.{k}") for k in keys]
    cond += [col("p._n.level") == col("i.level"), col("p._n.node") == col("i.node"),
             col(f"p.{at}") >= col(f"i.{start}"), col(f"p.{at}") < col(f"i.{end}")]
    extra = [col(f"i.{c}") for c in intervals.columns if c not in keys and c not in points.columns]
    return p.join(i, cond, "inner").select(*[col(f"p.{c}") for c in points.columns], *extra)


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], start: str = "seg_start", end: str = "seg_end",
                 cell: float = 1.0) -> DataFrame:
    """Pairs of overlapping half-open intervals of equal keys, as (keys, ``left``, ``right`` structs
    of the other columns). Two intervals overlap if the later start lies in the other one: each pair
    comes from that containment once, so the work is bounded as in ``interval_join``."""
    def packed(df: DataFrame, name: str) -> DataFrame:
        rest = F.struct(*[col(c) for c in df.columns if c not in keys]).alias(name)
        return df.where(f"`{start}` < `{end}`").select(*keys, rest, col(start).alias(f"{name}_start"), col(end).alias(f"{name}_end"))

    a, b = packed(left, "left"), packed(right, "right")
    inside_right = interval_join(a, b, keys, "left_start", "right_start", "right_end", cell)
    inside_left = interval_join(b, a, keys, "right_start", "left_start", "left_end", cell).where("left_start < right_start")
    return inside_right.select(*keys, "left", "right").unionByName(inside_left.select(*keys, "left", "right"))
