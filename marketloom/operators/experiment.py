"""Two-group experiment readout on aggregated session counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions import stats

CONTROL, TREATMENT = "control", "treatment"
ALL_DEVICES = "All devices"
WITH_BOTS = "All devices, bots included"


def _two_columns(df: DataFrame, by: str) -> DataFrame:
    """Group counts side by side: n_/x_ for control and treatment."""
    def total(group, column):
        return F.coalesce(F.sum(F.when(F.col("experiment_group") == group, F.col(column))), F.lit(0)).cast("bigint")

    return df.groupBy(by).agg(
        total(CONTROL, "sessions").alias("control_sessions"), total(TREATMENT, "sessions").alias("treatment_sessions"),
        total(CONTROL, "orders").alias("control_orders"), total(TREATMENT, "orders").alias("treatment_orders"))


def segment_counts(ab: DataFrame, devices: Sequence[str]) -> DataFrame:
    """One row per segment: all humans, humans per device, everyone including bots."""
    human = ~F.col("is_bot").cast("boolean")
    labels = F.array_compact(F.array(
        F.when(human, F.lit(ALL_DEVICES)),
        F.when(human & F.col("device_type").isin(*devices), F.col("device_type")),
        F.lit(WITH_BOTS)))
    # ab is one row per group, device and bot flag, so naming each row's segments is cheap.
    return _two_columns(ab.withColumn("segment", F.explode(labels)), "segment")


def two_proportion_test(counts: DataFrame) -> DataFrame:
    """Rates, lift with interval, z and two-sided p per segment."""
    args = ("control_orders", "control_sessions", "treatment_orders", "treatment_sessions")
    lift, low, high = stats.lift_interval(*args)
    return counts.select(
        "segment", "control_sessions", "treatment_sessions",
        (100 * F.col("control_orders") / F.col("control_sessions")).alias("control_rate_pct"),
        (100 * F.col("treatment_orders") / F.col("treatment_sessions")).alias("treatment_rate_pct"),
        lift.alias("lift_pts"), low.alias("ci_low_pts"), high.alias("ci_high_pts"),
        stats.pooled_z(*args).alias("z")).withColumn("p_value", 2 * stats.normal_sf(F.abs("z")))


def srm_counts(ab: DataFrame) -> DataFrame:
    """Sessions per group for all sessions and with bots removed."""
    human = ~F.col("is_bot").cast("boolean")
    labels = F.array_compact(F.array(F.lit("all sessions, bots included"), F.when(human, F.lit("bots removed"))))
    return (_two_columns(ab.withColumn("population", F.explode(labels)), "population")
            .drop("control_orders", "treatment_orders"))


def srm_test(counts: DataFrame, ratio: float = 0.5) -> DataFrame:
    """G1: sample-ratio test per population."""
    chi2 = stats.srm_chi_square("control_sessions", "treatment_sessions", ratio)
    return counts.withColumn("chi2", chi2).withColumn("p_value", stats.chi_square_p("chi2"))


def srm_verdict(tested: DataFrame, alpha: float = 0.001) -> DataFrame:
    """G2."""
    return tested.withColumn("verdict", F.when(F.col("p_value") < alpha, "split is broken, investigate")
                             .otherwise("split holds"))
