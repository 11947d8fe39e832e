"""Registered queries for the player-impact mart (M5) and its building blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitchline.plans import players as pl
from pitchline.plans.catalog import Tables, query

col = F.col


@query("lineup_segments")
def q_lineup_segments(spark, sf):
    return pl.lineup_segments(Tables(spark, sf).lineups)


@query("player_minutes")
def q_player_minutes(spark, sf):
    return pl.player_minutes(Tables(spark, sf).lineups)


@query("player_meta")
def q_player_meta(spark, sf):
    return pl.player_event_stats(Tables(spark, sf).ev).select(
        *pl.PLAYER_KEYS, "player_name", "primary_position")


@query("player_counts")
def q_player_counts(spark, sf):
    return pl.player_event_stats(Tables(spark, sf).ev).drop("player_name", "primary_position")


@query("xa_self_join")
def q_xa_self_join(spark, sf):
    return pl.expected_assists(Tables(spark, sf).ev)


@query("mart_player_impact")
def q_mart_player_impact(spark, sf):
    t = Tables(spark, sf)
    return pl.mart_player_impact(t.ev, t.lineups, t.comps)
