"""The A/B readout."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.bindings import base_table, star
from marketloom.functions.stats import binomial_z
from marketloom.operators import experiment as x
from marketloom.plans import reports, views
from marketloom.rules import AB_DEVICES
from queries import query
from queries import sql as s

AB = f"""ab AS (
    SELECT experiment_group, device_type, is_bot, COUNT(*) AS sessions, {s.big('SUM(completed_order)')} AS orders,
           {s.dbl('SUM(order_value)')} AS revenue FROM sessions GROUP BY ALL)"""


def _side(group, column):
    return f"{s.big(f'''COALESCE(SUM({column}) FILTER (experiment_group = '{group}'), 0)''')} AS {group}_{column}"


_COUNTS = ", ".join(_side(g, c) for g in ("control", "treatment") for c in ("sessions", "orders"))
SEGMENTS = (AB, f"""segments AS (
    SELECT 'All devices' AS segment, {_COUNTS} FROM ab WHERE NOT is_bot
    UNION ALL SELECT device_type, {_COUNTS} FROM ab WHERE NOT is_bot GROUP BY device_type
    UNION ALL SELECT 'All devices, bots included', {_COUNTS} FROM ab)""", """rates AS (
    SELECT *, CAST(control_orders AS DOUBLE) / control_sessions AS pc, CAST(treatment_orders AS DOUBLE) / treatment_sessions AS pt,
           CAST(control_orders + treatment_orders AS DOUBLE) / (control_sessions + treatment_sessions) AS pool FROM segments)""",
            """tested AS (
    SELECT *, (pt - pc) / SQRT(pool * (1 - pool) * (1.0 / control_sessions + 1.0 / treatment_sessions)) AS z,
           1.96 * SQRT(pc * (1 - pc) / control_sessions + pt * (1 - pt) / treatment_sessions) AS margin FROM rates)""")
SRM = (AB, """srm AS (
    SELECT *, POWER(control_sessions - treatment_sessions, 2) / (control_sessions + treatment_sessions) AS chi2 FROM (
        SELECT 'all sessions, bots included' AS population, CAST(SUM(sessions) FILTER (experiment_group = 'control') AS BIGINT) AS control_sessions,
               CAST(SUM(sessions) FILTER (experiment_group = 'treatment') AS BIGINT) AS treatment_sessions FROM ab
        UNION ALL SELECT 'bots removed', CAST(SUM(sessions) FILTER (experiment_group = 'control') AS BIGINT),
               CAST(SUM(sessions) FILTER (experiment_group = 'treatment') AS BIGINT) FROM ab WHERE NOT is_bot))""")


def two_sided_p(z: str) -> str:
    """Two-sided normal tail by Simpson's rule, since DuckDB has no error function."""
    steps = 400
    weight = f"CASE WHEN i IN (0, {steps}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    density = f"EXP(-POWER(i * ABS({z}) / {steps}, 2) / 2) / SQRT(2 * PI())"
    return f"1 - 2 * ABS({z}) / {3 * steps} * (SELECT SUM({weight} * {density}) FROM RANGE(0, {steps + 1}) t(i))"


def rounded(df, *columns, places=6):
    return df.withColumns({c: F.round(c, places) for c in columns})


def ab(spark, folder):
    return views.ab_test(star.table(spark, folder, "sessions"))


query("ab_test", "E18", s.on_star("SELECT * FROM ab", "sessions", extra=[AB]))(ab)

query("ab_segments", "G5", s.on_star(
    "SELECT segment, control_sessions, treatment_sessions, control_orders, treatment_orders FROM segments", "sessions",
    extra=SEGMENTS))(lambda spark, folder: x.segment_counts(ab(spark, folder), AB_DEVICES))

query("two_proportion", "G3 G4 G6", s.on_star(f"""
    SELECT segment, control_sessions, treatment_sessions, ROUND(100 * pc, 6) AS control_rate_pct,
           ROUND(100 * pt, 6) AS treatment_rate_pct, ROUND(100 * (pt - pc), 6) AS lift_pts,
           ROUND(100 * (pt - pc - margin), 6) AS ci_low_pts, ROUND(100 * (pt - pc + margin), 6) AS ci_high_pts,
           ROUND(z, 6) AS z, ROUND({two_sided_p('z')}, 6) AS p_value FROM tested""", "sessions", extra=SEGMENTS))(
    lambda spark, folder: rounded(reports.ab_results(ab(spark, folder)), "control_rate_pct", "treatment_rate_pct",
                                  "lift_pts", "ci_low_pts", "ci_high_pts", "z", "p_value"))

query("srm_test", "G1 G2 G6", s.on_star(f"""
    SELECT population, control_sessions, treatment_sessions, ROUND(chi2, 6) AS chi2, ROUND(p, 6) AS p_value,
           CASE WHEN p < 0.001 THEN 'split is broken, investigate' ELSE 'split holds' END AS verdict
    FROM (SELECT *, {two_sided_p('SQRT(chi2)')} AS p FROM srm)""", "sessions", extra=SRM))(
    lambda spark, folder: rounded(reports.sample_ratio(ab(spark, folder)), "chi2", "p_value"))


@query("binomial_z", "G7", """
    SELECT l_suppkey AS supplier, COUNT(*) AS lines, COUNT(*) FILTER (l_returnflag = 'R') AS returned,
           ROUND((CAST(COUNT(*) FILTER (l_returnflag = 'R') AS DOUBLE) / COUNT(*) - 0.25) / SQRT(0.25 * 0.75 / COUNT(*)), 6) AS z
    FROM lineitem GROUP BY l_suppkey""")
def _(spark, folder):
    lines = base_table(spark, folder, "lineitem")
    counted = lines.groupBy(F.col("l_suppkey").alias("supplier")).agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(F.col("l_returnflag") == "R").alias("returned"))
    return rounded(counted.withColumn("z", binomial_z("returned", "lines", F.lit(0.25))), "z")
