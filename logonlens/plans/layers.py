"""Lazy wiring of the silver and gold layers over a pair of raw logs.

``Layers`` builds every table as a DataFrame plan on demand; nothing runs until an
action. The same wiring serves the registered queries (raw logs derived from the
driver's ``events`` table) and the medallion run (raw logs from bronze parquet).

With ``shared_scan=True`` the log-derived silver tables are rollups of one
:func:`~logonlens.operators.silver.activity_cube`: the medallion run writes the cube
once, so the log is read once instead of seven times. For a standalone query the
direct one-groupBy-per-table forms (default) are better: their scans run as concurrent
stages and each plan is one shuffle shallower; there the features come from one rollup
of the per-day aggregate (dimension and activity profile at once). Both give identical
results (tested).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from logonlens.functions.normalize import normalize_auth
from logonlens.operators import gold, silver


class Layers:
    def __init__(self, auth: DataFrame, redteam: DataFrame, shared_scan: bool = False,
                 cube: DataFrame | None = None):
        self.auth = auth
        self.redteam = redteam
        self.shared_scan = shared_scan or cube is not None
        self._cube = cube

    @cached_property
    def norm(self) -> DataFrame:
        return normalize_auth(self.auth)

    @cached_property
    def cube(self) -> DataFrame:
        return self._cube if self._cube is not None else silver.activity_cube(self.norm)

    def _pick(self, shared, direct) -> DataFrame:
        return shared(self.cube) if self.shared_scan else direct(self.norm)

    # silver
    @cached_property
    def users(self) -> DataFrame:
        return self._pick(silver.users_from_cube, silver.users_dim)

    @cached_property
    def computers(self) -> DataFrame:
        return self._pick(silver.computers_from_cube, silver.computers_dim)

    @cached_property
    def user_computers(self) -> DataFrame:
        return self._pick(silver.user_computers_from_cube, silver.user_computers)

    @cached_property
    def redteam_events(self) -> DataFrame:
        return silver.redteam_events(self.redteam)

    @cached_property
    def daily_activity(self) -> DataFrame:
        return self._pick(silver.daily_from_cube, silver.daily_activity)

    @cached_property
    def daily_user_activity(self) -> DataFrame:
        return self._pick(silver.daily_user_from_cube, silver.daily_user_activity)

    @cached_property
    def daily_computer_activity(self) -> DataFrame:
        return self._pick(silver.daily_computer_from_cube, silver.daily_computer_activity)

    @cached_property
    def hourly_activity(self) -> DataFrame:
        return self._pick(silver.hourly_from_cube, silver.hourly_activity)

    @cached_property
    def user_features(self) -> DataFrame:
        if self.shared_scan:
            return silver.user_features(self.users, self.daily_user_activity, self.user_computers,
                                        self.redteam_events)
        return silver.user_features_from_daily(silver.daily_user_extended(self.norm),
                                               self.user_computers, self.redteam_events)

    @cached_property
    def computer_features(self) -> DataFrame:
        if self.shared_scan:
            return silver.computer_features(self.computers, self.daily_computer_activity,
                                            self.user_computers, self.redteam_events)
        return silver.computer_features_from_daily(silver.daily_computer_extended(self.norm),
                                                   self.user_computers, self.redteam_events)

    # gold
    @cached_property
    def risk_scores(self) -> DataFrame:
        return gold.percentile_risk_scores(self.user_features)

    @cached_property
    def user_risk(self) -> DataFrame:
        return gold.risk_from_scores(self.risk_scores)
