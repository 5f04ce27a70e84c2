"""Completion ledger and readiness of steps."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.merge import upsert_by_key
from millrace.operators.skew import join_unique
from millrace.schemas import DAG_LOG

LEDGER_KEYS = ["dag_id", "completion_date"]


def completion_row(ledger: DataFrame, step: str, on: date, at: datetime) -> DataFrame:
    """One ledger row."""
    return ledger.sparkSession.createDataFrame([(step, on, at)], DAG_LOG)


def record_completion(ledger: DataFrame, step: str, on: date, at: datetime) -> DataFrame:
    """The ledger after a step has finished: one row per step and business date, the last time counts."""
    return upsert_by_key(ledger, completion_row(ledger, step, on, at), LEDGER_KEYS)


def readiness(
    dependencies: DataFrame,
    ledger: DataFrame,
    on: date,
    targets: DataFrame | None = None,
    hot: Sequence[int] | None = None,
) -> DataFrame:
    """For every target step: number of edges, number of finished edges, and whether it may start.

    A double edge counts twice on both sides. ``targets`` (column tobe_dag) adds steps without any edge;
    they are not ready. ``hot`` goes to ``join_unique``; give an empty list for a few edges.
    """
    done = (
        ledger.where(F.col("completion_date") == F.lit(on))
        .select(F.col("dag_id").alias("asis_dag"))
        .distinct()
        .withColumn("__done", F.lit(1))
    )
    counts = (
        join_unique(dependencies.select("asis_dag", "tobe_dag"), done, "asis_dag", "left", hot, unique=True)
        .groupBy("tobe_dag")
        .agg(F.count("*").alias("target_cnt"), F.count("__done").alias("check_cnt"))
    )
    if targets is not None:
        counts = (
            targets.select("tobe_dag")
            .distinct()
            .join(counts, "tobe_dag", "left")
            .fillna(0, ["target_cnt", "check_cnt"])
        )
    ready = (F.col("target_cnt") > 0) & (F.col("target_cnt") == F.col("check_cnt"))
    return counts.select("tobe_dag", "target_cnt", "check_cnt", ready.alias("ready"))
