"""Cohort selection: first stay per patient, minimum length, unit entry
within a window of the start; then every table restricted to the cohort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from timeloom.operators.relational import first_per_group
from timeloom.sources.io import subset_tables

__all__ = ["first_stays", "first_unit_entry", "cohort_select", "cohort_apply"]


def first_stays(stays: DataFrame, patient: str = "patient_id", stay: str = "stay_id",
                start: str = "start_time") -> DataFrame:
    """Earliest stay per patient, chosen *before* any filter (S1); a null start
    sorts first and wins (S2); ties go to the smaller stay key (S3)."""
    return first_per_group(stays, patient, [F.col(start).asc_nulls_first(), F.col(stay).asc()])


def first_unit_entry(units: DataFrame, stay: str = "stay_id", location: str = "location",
                     unit: str = "icu", time: str = "in_time") -> DataFrame:
    """First entry time into the unit per stay (case-insensitive match)."""
    return (units.filter(F.lower(F.col(location)) == unit)
            .groupBy(stay).agg(F.min(time).alias("first_unit_in")))


def cohort_select(stays: DataFrame, units: DataFrame, min_stay_days: int = 1,
                  unit_within_days: int = 1, patient: str = "patient_id",
                  stay: str = "stay_id", start: str = "start_time",
                  end: str = "end_time") -> DataFrame:
    """(patient, stay, first_unit_in) of the cohort: first stay per patient,
    stay ≥ ``min_stay_days``, unit entry no later than start + window."""
    first = first_stays(stays, patient, stay, start)
    long_enough = first.filter(F.col(end) - F.col(start) >= F.expr(f"INTERVAL {min_stay_days} DAYS"))
    entry = first_unit_entry(units, stay)
    # 1:1 by promise: the entry side is grouped, the stay side is checked in the plan
    twice = F.count(F.lit(1)).over(Window.partitionBy(stay)) > 1
    j = long_enough.withColumn("_twice", twice).join(entry, stay)
    j = j.withColumn(patient, F.when(F.col("_twice"), F.raise_error(F.lit("a stay belongs to two patients")).cast(j.schema[patient].dataType))
                     .otherwise(F.col(patient)))
    return (j.filter(F.col("first_unit_in") <= F.col(start) + F.expr(f"INTERVAL {unit_within_days} DAYS"))
            .select(patient, stay, "first_unit_in"))


def cohort_apply(tables: dict, cohort: DataFrame, stay: str, patient: str) -> dict:
    """Every table restricted to the cohort (by stay key, else patient key,
    else copied)."""
    return subset_tables(tables, cohort, stay, patient)
