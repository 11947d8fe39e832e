"""M6: team behaviour by game state, grain (team, match, game_state)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitchline.functions.exprs import (
    FINAL_THIRD_X, count_when, ratio, round_half_away as rnd, team_key,
)
from pitchline.operators import timeline as tl

col = F.col
MIN_STATE_MINUTES = 3.0


def timeline_parts(ev: DataFrame, matches: DataFrame, convention: str = "per_period",
                   metrics: dict | None = None, goal=None):
    """(timed events, per-second metrics or None, match frame, score timeline, per-team segments).

    Frame, timeline and segments are each one scan of the events, reduced to one row per (match,
    team, second). ``goal`` overrides what counts as a scoring event (default: a shot whose
    outcome is Goal, penalties included -- e.g. to add own goals when the feed has them, T12)."""
    timed = tl.events_clock(ev, convention)
    goals = count_when(tl.goal_pred() if goal is None else goal)
    seconds = tl.match_seconds(timed.groupBy("match_id", "team", "abs_seconds").agg(goals.alias("_goals")), matches)
    segments = tl.score_segments(seconds)
    sec = tl.per_second(timed, metrics) if metrics else None
    return timed, sec, tl.match_frame(segments), tl.score_timeline(segments), tl.mirror_segments(segments)


def state_metrics() -> dict:
    """Event metrics of the game-state mart; every one is additive over seconds."""
    et = col("event_type")
    ex = F.when(et.isin("Pass", "Carry"), col("end_x"))
    return {
        "xg_generated": F.sum(F.when((et == "Shot") & (col("shot_type") != "Penalty"), col("xg"))
                              .otherwise(F.lit(0.0))),
        "pressures": count_when(et == "Pressure"),
        "passes_attempted": count_when(et == "Pass"),
        "passes_completed": count_when((et == "Pass") & col("pass_outcome").isNull()),
        "sum_x": F.sum("start_x"),
        "n_x": F.count("start_x"),
        "final_third_entries": count_when(et.isin("Pass", "Carry") & (col("start_x") < FINAL_THIRD_X)
                                          & (ex >= FINAL_THIRD_X)),
    }


def mart_gamestate(ev: DataFrame, matches: DataFrame, comps: DataFrame,
                   convention: str = "per_period", attribute: str = "after",
                   min_minutes: float = MIN_STATE_MINUTES, goal=None) -> DataFrame:
    """M6, grain (team, match, game_state): minutes in each state and the team's event rates
    while in it. States with under ``min_minutes`` (unrounded) are dropped; competition labels
    come from the events, so a state without events keeps NULL labels.

    The events are read once. Reduced to one row per (match, team, second), which the clock bounds,
    they get the running score by one window over the match (``timeline.match_seconds``). A row's
    score stands until the next row's second, so time by lead is a plain difference of neighbours;
    metrics of both teams and the time are then summed by (match, lead), with no further exchange."""
    return mart_from_seconds(mart_seconds(ev, convention, goal), matches, comps, attribute, min_minutes)


def mart_seconds(ev: DataFrame, convention: str = "per_period", goal=None) -> DataFrame:
    """The events reduced to what M6 needs of each (match, team, second)."""
    goals = count_when(tl.goal_pred() if goal is None else goal)
    return tl.per_second(tl.events_clock(ev, convention), {**state_metrics(), "_goals": goals})


def mart_from_seconds(seconds: DataFrame, matches: DataFrame | None, comps: DataFrame, attribute: str = "after",
                      min_minutes: float = MIN_STATE_MINUTES) -> DataFrame:
    """M6 from ``mart_seconds``, or without ``matches`` from its anchored, bucketed table."""
    sec = tl.match_seconds(seconds, matches)
    order = Window.partitionBy("match_id").orderBy("abs_seconds")
    own = F.when(col("_o") == 1, F.lit(1))  # the anchor has time only
    sec = sec.withColumn("_time", F.lead("abs_seconds").over(order) - col("abs_seconds"))
    lead = F.signum(col("home_score") - col("away_score")).cast("int")
    metric_cols, labels = list(state_metrics()), ["competition", "season"]
    if attribute == "after":
        rows = sec.withColumn("lead", lead)
    else:  # events see the score before their second's goals, time the one after them
        until = order.rangeBetween(Window.unboundedPreceding, -1)
        before = [F.coalesce(F.sum(F.when(col("team") == col(t), col("_goals"))).over(until), F.lit(0)) for t in ("home_team", "away_team")]
        sec = sec.withColumn("_before", F.signum(before[0] - before[1]).cast("int"))
        rows = sec.withColumn("_part", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn(
            "lead", F.when(col("_part") == 0, lead).otherwise(col("_before"))).withColumn(
            "_time", F.when(col("_part") == 0, col("_time"))).withColumn("_o", F.when(col("_part") == 1, col("_o")))
    inside = own.isNotNull() & (col("abs_seconds") < col("match_end_seconds"))
    sides = {"home": 1, "away": -1}
    sums = [(F.max if c in labels else F.sum)(F.when(inside & (col("team") == col(f"{side}_team")), col(c))).alias(f"{side}_{c}")
            for side in sides for c in (*labels, *metric_cols)]
    by_lead = rows.groupBy("match_id", "lead").agg(
        F.first("home_team").alias("home"), F.first("away_team").alias("away"),
        (F.sum("_time").cast("double") / F.lit(60.0)).alias("minutes_in_state"), *sums)
    names = F.create_map(*[F.lit(x) for x in (1, "Winning", 0, "Drawing", -1, "Losing")])
    of_team = [F.struct(col(side).alias("team"), names[col("lead") * sign].alias("game_state"),
                        *[col(f"{side}_{c}").alias(c) for c in (*labels, *metric_cols)]) for side, sign in sides.items()]
    both = (by_lead.where(col("minutes_in_state") >= min_minutes)  # NULL minutes fail the gate too
            .select("match_id", "minutes_in_state", F.explode(F.array(*of_team)).alias("r"))
            .select("match_id", "minutes_in_state", "r.*"))
    j = both.join(comps, (col("competition") == col("competition_folder_name"))
                  & (col("season") == col("season_year")), "left")
    mins = col("minutes_in_state")
    z = lambda c: F.coalesce(col(c), F.lit(0))
    return j.select(
        team_key(col("team"), col("competition_folder_name"), col("season_year")).alias("team_comp_key"),
        col("team").alias("team_name"), "competition_name", "competition_folder_name", "season_year",
        "match_id", "game_state",
        rnd(mins, 1).alias("minutes_in_state"),
        rnd(ratio(F.coalesce(col("xg_generated"), F.lit(0.0)), mins), 4).alias("xg_per_minute"),
        rnd(ratio(z("pressures"), mins), 3).alias("pressures_per_minute"),
        rnd(ratio(z("final_third_entries"), mins), 3).alias("f3_entries_per_minute"),
        rnd(ratio(z("passes_completed"), z("passes_attempted")), 3).alias("pass_completion_rate"),
        rnd(ratio("sum_x", "n_x"), 1).alias("avg_field_position_x"),
        F.coalesce(col("xg_generated"), F.lit(0.0)).alias("xg_raw"),
        z("pressures").cast("long").alias("pressures_raw"),
        z("passes_attempted").cast("long").alias("passes_attempted"),
        z("passes_completed").cast("long").alias("passes_completed"),
        z("final_third_entries").cast("long").alias("f3_entries_raw"),
    )


def check_symmetry(mart: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """Invariant test on the built mart: per match, the total Winning minutes must equal the total
    Losing minutes within ``tolerance``; returns only the matches that break it (empty = pass).

    Each side is summed per match BEFORE the full outer join on match_id, so the join is one row
    to one row (a join of the raw state rows would multiply each side by the other's row count).
    """
    def side(state: str, name: str) -> DataFrame:
        return (mart.where(col("game_state") == state).groupBy("match_id")
                .agg(F.sum("minutes_in_state").alias(name)).alias(name))
    j = side("Winning", "w").join(side("Losing", "l"), col("w.match_id") == col("l.match_id"), "full")
    tw = F.coalesce(col("w.w"), F.lit(0.0))
    tl_ = F.coalesce(col("l.l"), F.lit(0.0))
    return (j.select(F.coalesce(col("w.match_id"), col("l.match_id")).alias("match_id"),
                     tw.alias("total_winning_minutes"), tl_.alias("total_losing_minutes"),
                     F.abs(tw - tl_).alias("diff"))
            .where(col("diff") > tolerance))


def check_symmetry_strict(durations: DataFrame, sides: DataFrame) -> DataFrame:
    """Per (match, team): own Winning minutes vs the opponent's Losing minutes.
    One row per team-match; ``win_lose_diff`` is 0 when the invariant holds."""
    d = durations.groupBy("match_id", "team").agg(
        F.sum(F.when(col("game_state") == "Winning", col("minutes_in_state")).otherwise(0.0)).alias("win"),
        F.sum(F.when(col("game_state") == "Losing", col("minutes_in_state")).otherwise(0.0)).alias("lose"))
    o = d.select("match_id", col("team").alias("opponent"), col("lose").alias("opp_lose"))
    j = sides.select("match_id", "team", "opponent").join(d, ["match_id", "team"]).join(
        o, ["match_id", "opponent"])
    return j.select("match_id", "team", "opponent",
                    col("win").alias("winning_minutes"),
                    col("opp_lose").alias("opponent_losing_minutes"),
                    F.abs(col("win") - col("opp_lose")).alias("win_lose_diff"))
