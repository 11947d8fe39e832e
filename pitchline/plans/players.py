"""M5: player impact, grain (player, team, competition, season), per-90 rates gated by minutes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchline.functions.exprs import (
    count_when, is_progressive, mmss_to_seconds, per90, round_half_away as rnd, team_key,
)

col = F.col
PLAYER_KEYS = ["player_id", "team", "competition", "season"]
MIN_MINUTES = 270.0
OPEN_SEGMENT_END = "120:00"


def _lineup_keys(lineups: DataFrame) -> list[Column]:
    return [col("match_id"), col("player_id"), col("team_name").alias("team"),
            col("competition_folder_name").alias("competition"), col("season_year").alias("season")]


def lineup_segments(lineups: DataFrame, open_end: str = OPEN_SEGMENT_END) -> DataFrame:
    """One row per position segment (an empty or NULL array contributes no row, as an inner
    UNNEST); an open segment ends at ``open_end``."""
    return (lineups.select(*_lineup_keys(lineups), F.explode("positions").alias("seg"))
            .select("match_id", "player_id", "team", "competition", "season",
                    col("seg.from_period").alias("from_period"), col("seg.to_period").alias("to_period"),
                    col("seg.from").alias("from_ts"),
                    F.coalesce(col("seg.to"), F.lit(open_end)).alias("to_ts"))
            .withColumn("seg_seconds", mmss_to_seconds("to_ts") - mmss_to_seconds("from_ts")))


def lineup_minutes(lineups: DataFrame, open_end: str = OPEN_SEGMENT_END,
                   match_end: DataFrame | None = None) -> DataFrame:
    """Minutes per lineup row, summed over its segments with a higher-order ``aggregate`` --
    no explode and no shuffle; rows without segments are dropped like an inner UNNEST.

    An open segment (NULL ``to``) ends at ``open_end`` ('120:00', as the original), or -- when
    ``match_end`` (match_id, match_end_seconds) is given -- at that match's last recorded second,
    which avoids crediting 120 minutes to a 90-minute starter (T10). ``match_end`` has one row per
    match and is joined before the per-row sum.
    """
    if match_end is not None:
        lineups = lineups.join(match_end.select("match_id", "match_end_seconds"), "match_id", "left")
        end_secs = F.coalesce(col("match_end_seconds").cast("int"), mmss_to_seconds(F.lit(open_end)))
    else:
        end_secs = mmss_to_seconds(F.lit(open_end))

    def seg_secs(s):
        return F.coalesce(mmss_to_seconds(s["to"]), end_secs) - mmss_to_seconds(s["from"])

    # SUM semantics: NULL segment lengths are skipped; all-NULL gives NULL
    secs = F.aggregate("positions", F.lit(None).cast("long"),
                       lambda acc, s: F.when(seg_secs(s).isNull(), acc)
                       .otherwise(F.coalesce(acc, F.lit(0).cast("long")) + seg_secs(s)))
    return (lineups.where(F.size("positions") > 0)
            .select(*_lineup_keys(lineups), (secs.cast("double") / F.lit(60.0)).alias("minutes_in_match")))


def player_minutes(lineups: DataFrame, match_end: DataFrame | None = None) -> DataFrame:
    """Matches and total minutes per (player, team, competition, season)."""
    return (lineup_minutes(lineups, match_end=match_end).groupBy(*PLAYER_KEYS)
            .agg(F.count_distinct("match_id").alias("matches_played"),
                 F.sum("minutes_in_match").alias("total_minutes")))


def player_event_stats(ev: DataFrame) -> DataFrame:
    """Name, modal position and event counts per player, from one scan.

    Plain sums by (player, position) first, which combine map-side in a hash aggregate, then one
    row per player; the modal position is the smallest of the most frequent ones, NULL left out.
    """
    et = col("event_type")
    np_shot = (et == "Shot") & (col("shot_type") != "Penalty")
    by_position = (ev.where(col("player_id").isNotNull()).groupBy(*PLAYER_KEYS, "player_position")
            .agg(F.min("player_name").alias("player_name"), F.count(F.lit(1)).alias("_n"),
                 count_when(np_shot & (col("shot_outcome") == "Goal")).alias("np_goals"),
                 F.sum(F.when(np_shot, col("xg")).otherwise(F.lit(0.0))).alias("np_xg"),
                 count_when((et == "Carry") & is_progressive(col("start_x"), col("end_x")))
                 .alias("progressive_carries"),
                 count_when((et == "Dribble") & (col("dribble_outcome") == "Complete"))
                 .alias("successful_dribbles"),
                 count_when(et == "Pressure").alias("pressures"),
                 count_when(et == "Ball Recovery").alias("ball_recoveries")))
    known = col("player_position").isNotNull()
    sums = [c for c in by_position.columns if c not in (*PLAYER_KEYS, "player_position", "player_name", "_n")]
    return by_position.groupBy(*PLAYER_KEYS).agg(
        F.min("player_name").alias("player_name"),
        F.min_by("player_position", F.when(known, F.struct(-col("_n"), col("player_position")))).alias("primary_position"),
        *[F.sum(c).alias(c) for c in sums])


def _assist_links(ev: DataFrame) -> DataFrame:
    """One row a shot that counts or an assisting pass, keyed by (match, shot): the shot's xG or the
    passer. A pass whose shot isn't there, or is a penalty, stays without xG."""
    assist = (col("event_type") == "Pass") & col("pass_shot_assist") & col("pass_assisted_shot_id").isNotNull() & col("player_id").isNotNull()
    shot = col("shot_type") != "Penalty"
    return ev.where(assist | shot).select(
        "match_id", F.when(shot, col("event_id")).otherwise(col("pass_assisted_shot_id")).alias("shot_event_id"),
        F.when(shot, F.struct(col("xg"))).alias("shot"), F.when(~F.coalesce(shot, F.lit(False)), F.struct(*PLAYER_KEYS)).alias("passer"))


def expected_assists(ev: DataFrame) -> DataFrame:
    """xA: xG of the non-penalty shot a pass assisted, credited to the passer.

    Shots and assisting passes meet in one aggregate keyed by (match, shot event id) instead of a
    self-join, so the events are read once; the key is a shot's, so no key is hot however skewed
    matches are. The passes of a shot (one, as a rule) share its xG each.
    """
    met = _assist_links(ev).groupBy("match_id", "shot_event_id").agg(
        F.count("shot").alias("shots"), F.sum("shot.xg").alias("xg"), F.collect_list("passer").alias("passers"))
    return (met.where("shots > 0").select("xg", F.explode("passers").alias("p")).groupBy(*[col(f"p.{k}").alias(k) for k in PLAYER_KEYS])
            .agg(F.sum("xg").alias("total_xa")))


def player_facts(ev: DataFrame) -> DataFrame:
    """``player_event_stats`` with ``total_xa`` (NULL without any assisted shot), from one scan.

    An event gives one row to its player's counts and, if it is a shot or an assisting pass, one to
    the shot's key. Both kinds are first summed by (player and position) or (match, shot); what the
    shots' keys then know of passers is summed into the players' rows."""
    et = col("event_type")
    np_shot = (et == "Shot") & (col("shot_type") != "Penalty")
    assist = (et == "Pass") & col("pass_shot_assist") & col("pass_assisted_shot_id").isNotNull() & col("player_id").isNotNull()
    shot = F.coalesce(col("shot_type") != "Penalty", F.lit(False))
    nothing = lambda *names: [F.lit(None).cast(ev.schema[n].dataType).alias(n) for n in names]
    own = F.struct(*PLAYER_KEYS, "player_position", *[x.alias(n) for n, x in (("_match", F.lit(None).cast("long")), ("_shot", F.lit(None).cast("long")))])
    link = F.struct(*nothing(*PLAYER_KEYS, "player_position"), col("match_id").cast("long").alias("_match"),
                    F.when(shot, col("event_id")).otherwise(col("pass_assisted_shot_id")).cast("long").alias("_shot"))
    keys = F.concat(F.when(col("player_id").isNotNull(), F.array(own)).otherwise(F.array().cast(f"array<{ev.select(own).schema[0].dataType.simpleString()}>")),
                    F.when(shot | F.coalesce(assist, F.lit(False)), F.array(link)).otherwise(
                        F.array().cast(f"array<{ev.select(link).schema[0].dataType.simpleString()}>")))
    rows = ev.withColumn("_k", F.explode(keys))
    mine = col("_k._match").isNull()
    count = lambda cond: F.count_if(mine & cond)
    by_key = rows.groupBy("_k").agg(
        F.min(F.when(mine, col("player_name"))).alias("player_name"), F.count_if(mine).alias("_n"),
        count(np_shot & (col("shot_outcome") == "Goal")).alias("np_goals"),
        F.sum(F.when(mine & np_shot, col("xg")).otherwise(F.lit(0.0))).alias("np_xg"),
        count((et == "Carry") & is_progressive(col("start_x"), col("end_x"))).alias("progressive_carries"),
        count((et == "Dribble") & (col("dribble_outcome") == "Complete")).alias("successful_dribbles"),
        count(et == "Pressure").alias("pressures"), count(et == "Ball Recovery").alias("ball_recoveries"),
        F.count_if(~mine & shot).alias("_shots"), F.sum(F.when(~mine & shot, col("xg"))).alias("_xg"),
        F.collect_list(F.when(~mine & ~shot, F.struct(*PLAYER_KEYS))).alias("_passers"))
    credited = F.when(col("_shots") > 0, col("_passers"))
    who = F.when(col("_k._match").isNull(), F.array(F.struct(*[col(f"_k.{k}").alias(k) for k in PLAYER_KEYS]))).otherwise(credited)
    sums = ["np_goals", "np_xg", "progressive_carries", "successful_dribbles", "pressures", "ball_recoveries"]
    known = col("_k._match").isNull() & col("_k.player_position").isNotNull()
    out = by_key.withColumn("p", F.explode(who)).groupBy(*[col(f"p.{k}").alias(k) for k in PLAYER_KEYS]).agg(
        F.min("player_name").alias("player_name"),
        F.min_by(col("_k.player_position"), F.when(known, F.struct(-col("_n"), col("_k.player_position")))).alias("primary_position"),
        *[F.sum(c).alias(c) for c in sums], F.sum("_n").alias("_events"), F.sum("_xg").alias("total_xa"))
    return out.where("_events > 0").drop("_events")


def mart_player_impact(ev: DataFrame, lineups: DataFrame, comps: DataFrame,
                       min_minutes: float = MIN_MINUTES) -> DataFrame:
    """M5, grain (player, team, competition, season): per-90 rates for players with at least
    ``min_minutes`` from their lineup segments; xA is 0 when absent. The events are read once."""
    pm = player_minutes(lineups).where(col("total_minutes") >= min_minutes)
    j = (pm.join(player_facts(ev), PLAYER_KEYS, "inner")
         .join(comps, (col("competition") == col("competition_folder_name"))
               & (col("season") == col("season_year")), "inner"))
    mins = col("total_minutes")
    xa = F.coalesce(col("total_xa"), F.lit(0.0))
    return j.select(
        team_key(col("team"), col("competition_folder_name"), col("season_year")).alias("team_comp_key"),
        "player_id", "player_name", "primary_position", col("team").alias("team_name"),
        "competition_name", "competition_folder_name", "season_year", "matches_played",
        rnd(mins, 0).alias("minutes_played"),
        rnd(per90("np_goals", mins), 2).alias("np_goals_per_90"),
        rnd(per90("np_xg", mins), 2).alias("np_xg_per_90"),
        rnd(per90(xa, mins), 2).alias("xa_per_90"),
        rnd(per90("progressive_carries", mins), 2).alias("prog_carries_per_90"),
        rnd(per90("successful_dribbles", mins), 2).alias("successful_dribbles_per_90"),
        rnd(per90("pressures", mins), 2).alias("pressures_per_90"),
        rnd(per90("ball_recoveries", mins), 2).alias("ball_recoveries_per_90"),
        "np_goals",
        rnd("np_xg", 2).alias("np_xg_total"),
        rnd(xa, 2).alias("xa_total"),
        "progressive_carries", "successful_dribbles", "pressures", "ball_recoveries",
    )
