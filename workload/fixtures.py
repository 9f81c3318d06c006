"""Inputs of the star schema's shape, derived from the given tables.

The SQL of a fixture runs unchanged on Spark (as DataFrames) and in the oracle
(as common table expressions).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stargrain.operators.ordered import next_within
from stargrain.session import stored
from workload.bronze import B

BASE = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()

SQL: dict[str, str] = {}

SQL["fx_team"] = """
SELECT n_nationkey AS team_id, n_name AS name, r_regionkey AS confederation_id, r_name AS confederation_name
FROM {nation} LEFT JOIN {region} ON n_regionkey = r_regionkey"""

# The flag is compared by its code (82 is R): a number is aggregated by hashing,
# a text would be by sorting.
SQL["fx_match"] = """
SELECT o.o_orderkey AS match_id, CAST(year(o.o_orderdate) AS INT) AS tournament_id, o.o_orderpriority AS stage_id,
       CAST(o.o_orderdate AS DATE) AS match_date, c.c_nationkey AS home_team_id, s.s_nationkey AS away_team_id,
       l.q % 5 AS home_score, CAST(l.pk % 5 AS INT) AS away_score,
       CASE WHEN l.rf = 82 THEN CAST(l.sk % 4 AS INT) END AS home_penalties,
       CASE WHEN l.rf = 82 THEN CAST(o.o_custkey % 4 AS INT) END AS away_penalties,
       CASE WHEN year(o.o_orderdate) >= 1996 THEN CAST(l.d AS DECIMAL(9,4)) * 20 END AS home_xg,
       CASE WHEN year(o.o_orderdate) >= 1996 THEN CAST(l.t AS DECIMAL(9,4)) * 20 END AS away_xg
FROM {orders} o
JOIN (SELECT l_orderkey, min(l_suppkey) AS sk, min(l_partkey) AS pk, CAST(sum(l_quantity) AS INT) AS q,
             max(l_discount) AS d, max(l_tax) AS t, max(ascii(l_returnflag)) AS rf
      FROM {lineitem} GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey
JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {supplier} s ON l.sk = s.s_suppkey
WHERE c.c_nationkey <> s.s_nationkey"""

SQL["fx_match_team"] = """
SELECT match_id, home_team_id AS team_id, CAST(match_id % 17 AS INT) AS shots,
       CAST(match_id % 5 AS INT) AS shots_on_target, CAST(match_id % 101 AS DOUBLE) AS possession_pct
FROM {fx_match} WHERE tournament_id >= 1996 AND match_id % 10 <> 0"""

SQL["fx_prediction"] = """
SELECT match_id, home_team_id, away_team_id, CAST(match_id % 61 AS INT) AS home_win_probability,
       CAST(match_id % 37 AS INT) AS draw_probability,
       CAST(100 - match_id % 61 - match_id % 37 AS INT) AS away_win_probability
FROM {fx_match}"""

SQL["fx_stat_eav"] = """
SELECT user_id AS entity_id, CAST(ts AS DATE) AS d, event_type AS metric, value FROM {events}"""

SQL["fx_player_match"] = """
SELECT event_id AS match_player_id, CAST(ts AS DATE) AS match_date, event_type AS team_id, user_id AS player_id,
       event_id % 2 = 0 AS started, CAST(event_id % 3 AS INT) AS goals, CAST(event_id % 7 AS INT) AS shots,
       CAST(event_id % 11 + event_id % 13 AS INT) AS passes, CAST(event_id % 13 AS INT) AS passes_completed,
       CASE WHEN event_id % 5 <> 0 THEN value END AS top_speed_kmh
FROM {events}"""

SQL["fx_goalkeeper_match"] = """
SELECT event_id AS match_goalkeeper_id, CAST(ts AS DATE) AS match_date, event_type AS team_id, user_id AS player_id,
       CAST(event_id % 11 AS INT) AS shots_faced, CAST(event_id % 11 % 6 AS INT) AS saves
FROM {events} WHERE event_id % 4 = 0"""

# In Spark this fixture is built by next_within, see Inputs.
SQL["fx_passing_edge"] = """
SELECT d AS match_date, event_type AS team_id, user_id AS passer_id, nxt AS receiver_id, count(*) AS passes
FROM (SELECT CAST(ts AS DATE) AS d, event_type, user_id,
             lead(user_id) OVER (PARTITION BY CAST(ts AS DATE), event_type ORDER BY ts, event_id) AS nxt
      FROM {events}) e
WHERE nxt IS NOT NULL AND nxt <> user_id
GROUP BY d, event_type, user_id, nxt"""

SQL |= B

PLACEHOLDER = re.compile(r"\{(\w+)\}")


class Inputs:
    """Tables and fixtures of one data folder as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self._known: dict[str, DataFrame] = {}
        self._kept: set[str] = set()

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE or name in SQL:
            return self.table(name)
        raise AttributeError(name)

    def table(self, name: str) -> DataFrame:
        if name not in self._known:
            if name in BASE:
                df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                df = self.derived(name)
            self._known[name] = stored(df, name) if name in self._kept else df
        return self._known[name]

    def derived(self, name: str) -> DataFrame:
        return self._passing_edges() if name == "fx_passing_edge" else self.sql(SQL[name])

    def keep(self, *names: str) -> None:
        """Fixtures that a query reads more than once are written on first use."""
        self._kept.update(names)

    def sql(self, template: str) -> DataFrame:
        used = {name: self.table(name) for name in set(PLACEHOLDER.findall(template))}
        return self.spark.sql(template, **used)

    def _passing_edges(self) -> DataFrame:
        rows = self.table("events").select(
            F.col("ts").cast("date").alias("match_date"), F.col("event_type").alias("team_id"),
            "ts", "event_id", F.col("user_id").alias("passer_id"),
        )
        linked = next_within(
            rows,
            ["match_date", "team_id"],
            [F.date_trunc("minute", "ts")],
            ["ts", "event_id"],
            "passer_id",
            "receiver_id",
        )
        linked = linked.where(F.col("receiver_id").isNotNull() & (F.col("receiver_id") != F.col("passer_id")))
        return linked.groupBy("match_date", "team_id", "passer_id", "receiver_id").agg(
            F.count(F.lit(1)).alias("passes")
        )


def oracle(sql: str, ctes: dict[str, str]) -> str:
    """Prefix ``sql`` with the common table expressions it needs."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in PLACEHOLDER.findall(text):
            if name in ctes and name not in order:
                need(ctes[name])
                order.append(name)

    need(sql)
    plain = PLACEHOLDER.sub(r"\1", sql).strip()
    if not order:
        return plain
    parts = ",\n".join(
        f"{name} AS MATERIALIZED ({PLACEHOLDER.sub(r'\1', ctes[name]).strip()})" for name in order
    )
    return f"WITH {parts}\n{plain}"
