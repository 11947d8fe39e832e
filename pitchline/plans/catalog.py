"""Registry of named queries: ``key -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables under ``sf_dir`` (or data Spark derives from them) in
full; nothing is capped, sampled or subset.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pitchline.sources import fb as fbsrc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        return fn
    return deco


class Tables:
    """The staging models for one (spark, sf_dir), read from their materialised Parquet copies
    (see ``sources.warehouse``); each accessor returns a DataFrame plan, not data.

    Setting ``_ev`` to an event DataFrame (tests) derives matches, competitions and lineups from
    it instead.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._ev = None
        self._silver = None

    def raw(self, name: str) -> DataFrame:
        return fbsrc.read_table(self.spark, self.sf_dir, name)

    def _s(self, name: str) -> DataFrame:
        if self._silver is None:
            from pitchline.sources.warehouse import StagedTables
            self._silver = StagedTables(self.spark, self.sf_dir)
        return self._silver[name]

    @property
    def ev(self) -> DataFrame:
        return self._ev if self._ev is not None else self._s("events")

    @property
    def matches(self) -> DataFrame:
        return fbsrc.fb_matches(self._ev) if self._ev is not None else self._s("matches")

    @property
    def comps(self) -> DataFrame:
        return fbsrc.fb_competitions(self._ev) if self._ev is not None else self._s("competitions")

    @property
    def lineups(self) -> DataFrame:
        return fbsrc.fb_lineups(self._ev) if self._ev is not None else self._s("lineups")

    # marts: ``build_mN`` returns the plan that computes mart N from the Silver tables;
    # ``mN`` reads it materialised (built on first use per input), as consumers of a mart do
    def build_m1(self) -> DataFrame:
        from pitchline.plans.team_marts import mart_attack_quality
        return mart_attack_quality(self.ev, self.comps)

    def build_m2(self) -> DataFrame:
        from pitchline.plans.team_marts import mart_ball_progression
        return mart_ball_progression(self.ev, self.comps)

    def build_m3(self) -> DataFrame:
        from pitchline.plans.team_marts import mart_defensive_pressure
        return mart_defensive_pressure(self.ev, self.matches, self.comps)

    def build_m4(self) -> DataFrame:
        from pitchline.plans.team_marts import mart_set_piece
        return mart_set_piece(self.ev, self.comps)

    def build_m5(self) -> DataFrame:
        from pitchline.plans.players import mart_player_impact
        return mart_player_impact(self.ev, self.lineups, self.comps)

    def build_m6(self) -> DataFrame:
        from pitchline.plans.gamestate import mart_gamestate
        return mart_gamestate(self.ev, self.matches, self.comps)

    def _gold(self, name: str) -> DataFrame:
        build = getattr(self, f"build_{name}")
        if self._ev is not None:           # injected events (tests): no materialisation
            return build()
        from pitchline.sources.warehouse import gold_table
        return gold_table(self.spark, self.sf_dir, name, build)

    def m1(self) -> DataFrame:
        return self._gold("m1")

    def m2(self) -> DataFrame:
        return self._gold("m2")

    def m3(self) -> DataFrame:
        return self._gold("m3")

    def m4(self) -> DataFrame:
        return self._gold("m4")

    def m5(self) -> DataFrame:
        return self._gold("m5")

    def m6(self) -> DataFrame:
        return self._gold("m6")

    def reused(self, name: str) -> DataFrame:
        """A mart one query reads several times: the materialised table (read, never recomputed)."""
        return getattr(self, name)()

    def marts(self) -> dict[str, DataFrame]:
        return {"m1": self.m1(), "m2": self.m2(), "m3": self.m3(), "m4": self.m4(),
                "m5": self.m5(), "m6": self.m6()}


def load_all() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    # importing the query modules registers their queries
    from pitchline.plans import (  # noqa: F401
        queries_bronze, queries_gamestate, queries_players, queries_products, queries_serving,
        queries_streaming, queries_team,
    )
    return dict(QUERIES)
