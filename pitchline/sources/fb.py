"""Football-shaped ("FB") view over the driver's ``events`` table, and the tables derived from it.

The rules are the fixed deterministic mapping from FIXTURES.md section 2: 250 consecutive events
form a match, ten form a possession, and ``event_type``/``props.k``/``value`` decide the football
event kind and its attributes. Every column is a narrow projection, so the view adds no shuffle
and Catalyst prunes it to the columns a mart reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The football event kinds, positions, play patterns and stages of the FB view.
POSITIONS = ["Goalkeeper", "Right Center Back", "Left Wing Back", "Center Attacking Midfield",
             "Center Forward"]
PLAY_PATTERNS = ["Regular Play", "From Counter", "From Kick Off", "From Corner", "From Free Kick",
                 "From Throw In", "From Goal Kick"]
STAGES = ["Group Stage", "Round of 16", "Quarter-finals", "Semi-finals", "3rd Place Final", "Final"]
EVENTS_PER_MATCH = 250
EVENTS_PER_POSSESSION = 10

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(index: Column, values: list) -> Column:
    """CASE index WHEN 0 THEN values[0] ... ELSE values[-1] END."""
    out = None
    for i, v in enumerate(values[:-1]):
        out = F.when(index == i, F.lit(v)) if out is None else out.when(index == i, F.lit(v))
    return out.otherwise(F.lit(values[-1]))


def fb_events(events: DataFrame) -> DataFrame:
    """Map raw ``events`` rows to one football event each (26 columns + ``ts``)."""
    col = F.col
    b = events.select(
        "event_id", "ts", "user_id", col("event_type").alias("et"), "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.expr(f"event_id div {EVENTS_PER_MATCH}").alias("match_id"),
        (col("event_id") % EVENTS_PER_MATCH).alias("i"),
    )
    i, k, et, m = col("i"), col("k"), col("et"), col("match_id")
    hi = (m * 5) % 8
    ai = ((m * 5) % 8 + 1 + m % 7) % 8
    kind = (F.when(et == "error", "Pressure").when(et == "click", "Pass").when(et == "view", "Carry")
            .when(et == "purchase", F.when(k < 40, "Shot").otherwise("Duel"))
            .when(k % 3 == 0, "Ball Recovery").when(k % 3 == 1, "Foul Committed")
            .otherwise("Dribble"))
    c1 = b.select(
        "*", hi.alias("hi"), ai.alias("ai"),
        F.expr(f"i div {EVENTS_PER_POSSESSION}").alias("poss"),
        F.when(i < 240, (i % 120) * 23).otherwise(2737 + (i - 239) * 5).alias("sip"),
        kind.alias("kind"),
        F.when(k == 99, F.lit(None)).otherwise(
            ((col("event_id") * 37 + k * 11) % 121).cast("double")).alias("sx"),
    )
    d = c1.withColumn("ti", F.when(col("user_id") % 2 == 0, col("hi")).otherwise(col("ai")))
    kind, sx, ti, user = col("kind"), col("sx"), col("ti"), col("user_id")
    pid = ti * 100 + F.expr("user_id div 2") % 5
    pos_idx = (F.expr("user_id div 2") + F.when(k >= 90, 1).otherwise(0)) % 5
    is_shot = kind == "Shot"
    return d.select(
        "event_id", "match_id", "ts",
        F.concat(F.lit("comp_"), (m % 3).cast("string")).alias("competition"),
        F.when(m % 3 == 0, 2022).otherwise(2024).alias("season"),
        F.when(i < 120, 1).when((i < 240) | (m % 10 != 0), 2).otherwise(5).alias("period"),
        F.expr("sip div 60").alias("minute"),
        (col("sip") % 60).alias("second"),
        kind.alias("event_type"),
        col("poss").alias("possession_sequence"),
        F.concat(F.lit("team_"), ti.cast("string")).alias("team"),
        F.concat(F.lit("team_"), col("hi").cast("string")).alias("home_team"),
        F.concat(F.lit("team_"), col("ai").cast("string")).alias("away_team"),
        F.when(user == 0, F.lit(None)).otherwise(pid).alias("player_id"),
        F.when(user == 0, F.lit(None)).otherwise(
            F.concat(F.lit("P"), pid.cast("string"))).alias("player_name"),
        _pick(pos_idx, POSITIONS).alias("player_position"),
        _pick((m * 7 + col("poss")) % 7, PLAY_PATTERNS).alias("play_pattern"),
        sx.alias("start_x"),
        F.when(kind.isin("Pass", "Carry") & sx.isNotNull(),
               F.greatest(F.lit(0.0), F.least(F.lit(120.0), sx + (k % 40) - 8))).alias("end_x"),
        F.when((kind == "Pass") & (k % 4 == 0), F.lit("Incomplete")).alias("pass_outcome"),
        F.when((kind == "Pass") & (k % 5 == 0), col("event_id") + 1).alias("pass_assisted_shot_id"),
        F.coalesce((kind == "Pass") & (k % 10 == 0), F.lit(False)).alias("pass_shot_assist"),
        F.when(is_shot, F.floor(col("value") * 2) / 1024).alias("xg"),
        F.when(is_shot, F.when(k % 13 == 0, "Penalty").when(k % 13 == 1, "Free Kick")
               .when(k % 13 == 12, F.lit(None)).otherwise("Open Play")).alias("shot_type"),
        F.when(is_shot, F.when(col("value") >= 100, "Goal").otherwise("Saved")).alias("shot_outcome"),
        F.coalesce((kind == "Pressure") & (k % 5 == 0), F.lit(False)).alias("counterpress"),
        F.when(kind == "Duel", F.when(k % 2 == 0, "Tackle").otherwise("Aerial Lost")).alias("duel_type"),
        F.when(kind == "Dribble", F.when(k % 2 == 0, "Complete").otherwise("Incomplete"))
        .alias("dribble_outcome"),
    )


def load_fb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fb_events(read_table(spark, sf_dir, "events"))


def is_goal() -> Column:
    """A shot whose outcome is Goal."""
    return (F.col("event_type") == "Shot") & (F.col("shot_outcome") == "Goal")


def fb_matches(ev: DataFrame) -> DataFrame:
    """One row per match: teams, stage, date and the score counted from shot goals in periods 1-4.

    Partial aggregation: each task pre-aggregates its rows, so even a match holding a large share of
    all events is combined map-side before the shuffle. The least of texts would sort every task's
    events; so they are grouped by first, in a hash table, and few rows a match are left to sort.
    """
    col = F.col
    goal_in_play = is_goal() & col("period").between(1, 4)
    texts = (ev.groupBy("match_id", "competition", "home_team", "away_team")
             .agg(F.min("season").alias("season"), F.min("ts").alias("ts"),
                  F.sum(F.when(goal_in_play & (col("team") == col("home_team")), 1).otherwise(0)).alias("home"),
                  F.sum(F.when(goal_in_play & (col("team") == col("away_team")), 1).otherwise(0)).alias("away")))
    return (texts.groupBy("match_id")
            .agg(F.min("competition").alias("competition_folder_name"),
                 F.min("season").alias("season_year"),
                 F.min("home_team").alias("home_team_name"),
                 F.min("away_team").alias("away_team_name"),
                 F.to_date(F.min("ts")).alias("match_date"),
                 F.sum("home").cast("int").alias("home_score"),
                 F.sum("away").cast("int").alias("away_score"))
            .withColumn("competition_stage_name",
                        _pick(F.expr("match_id div 3") % 6, STAGES)))


def fb_competitions(ev: DataFrame) -> DataFrame:
    """Distinct (competition, season) with a display name; at most a few dozen rows in practice."""
    return (ev.select(F.col("competition").alias("competition_folder_name"),
                      F.col("season").alias("season_year"))
            .distinct()
            .withColumn("competition_name", F.upper("competition_folder_name")))


def competitions_from_matches(matches: DataFrame) -> DataFrame:
    """The same dimension from the one-row-per-match table (every event belongs to a match), so
    building it does not read the events again."""
    return (matches.select("competition_folder_name", "season_year").distinct()
            .withColumn("competition_name", F.upper("competition_folder_name")))


SEGMENT_TYPE = "array<struct<from:string,to:string,from_period:int,to_period:int>>"


def fb_lineups(ev: DataFrame) -> DataFrame:
    """Distinct player-match rows with a ``positions`` array of clock segments.

    player_id % 7 == 0 -> empty array; % 3 == 0 -> two segments [00:00, 60:00) and [60:00, open);
    otherwise one open segment from 00:00.
    """
    col = F.col
    seg = lambda a, b, p1, p2: F.struct(
        F.lit(a).alias("from"), F.lit(b).cast("string").alias("to"),
        F.lit(p1).cast("int").alias("from_period"), F.lit(p2).cast("int").alias("to_period"))
    positions = (F.when(col("player_id") % 7 == 0, F.array().cast(SEGMENT_TYPE))
                 .when(col("player_id") % 3 == 0,
                       F.array(seg("00:00", "60:00", 1, 2), seg("60:00", None, 2, None)))
                 .otherwise(F.array(seg("00:00", None, 1, None))))
    return (ev.where(col("player_id").isNotNull())
            .select("match_id", col("competition").alias("competition_folder_name"),
                    col("season").alias("season_year"), col("team").alias("team_name"),
                    "player_id")
            .distinct()
            .withColumn("player_name", F.concat(F.lit("P"), col("player_id").cast("string")))
            .withColumn("positions", positions))
