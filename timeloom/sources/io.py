"""Reading and writing tables.

Reads are lazy (``spark.read``); Catalyst pushes filters and prunes columns
into the parquet scan, so callers just ``select``/``filter``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = [
    "DRIVER_TABLES", "scan_parquet", "scan_glob", "scan_optional", "scan_projected",
    "schema_discover", "sink_parquet", "sink_csv", "scan_csv_grid", "load_vocab",
    "vocab_inverse", "drop_optional", "cast_key", "subset_tables", "combine_sites",
]

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()


def scan_parquet(spark: SparkSession, base: str, name: str | None = None) -> DataFrame:
    """Lazy parquet scan of ``base/name.parquet`` (or of ``base`` itself)."""
    path = f"{base.rstrip('/')}/{name}.parquet" if name else base
    return spark.read.parquet(path)


def scan_glob(spark: SparkSession, pattern: str) -> DataFrame:
    """All part files that match a glob, read as one table."""
    return spark.read.parquet(pattern)


def scan_optional(spark: SparkSession, paths: dict) -> dict:
    """Read the inputs that exist; a missing one is left out, so the cell it
    would fill stays null after a join to the full grid."""
    out = {}
    for key, path in paths.items():
        try:
            out[key] = spark.read.parquet(path)
        except AnalysisException as e:  # path not found
            if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
                raise
    return out


def scan_projected(spark: SparkSession, base: str, name: str, columns) -> DataFrame:
    return scan_parquet(spark, base, name).select(*columns)


def schema_discover(df: DataFrame, suffix: str = "_past") -> list[str]:
    """Outcome names: boolean columns whose name ends with the suffix."""
    return [f.name[: -len(suffix)] for f in df.schema.fields
            if f.name.endswith(suffix) and isinstance(f.dataType, T.BooleanType)]


def sink_parquet(df: DataFrame, path: str, partition_by=None, mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(path)


def sink_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Result grids are small; one file keeps them readable."""
    df.coalesce(1).write.mode(mode).option("header", True).csv(path)


def scan_csv_grid(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def load_vocab(spark: SparkSession, source) -> DataFrame:
    """(token, token_id) from a ``lookup`` mapping: a dict, or a YAML file with
    a ``lookup`` key. Small by construction (one row per token)."""
    if isinstance(source, str):
        import yaml
        with open(source) as fh:
            source = yaml.safe_load(fh)["lookup"]
    rows = sorted(source.items(), key=lambda kv: kv[1])
    return spark.createDataFrame(rows, "token string, token_id int")


def vocab_inverse(vocab: DataFrame) -> DataFrame:
    return vocab.select("token_id", "token")


def drop_optional(df: DataFrame, *cols) -> DataFrame:
    return df.drop(*cols)  # lenient: absent names are ignored


def cast_key(df: DataFrame, key: str, to: str = "string") -> DataFrame:
    return df.withColumn(key, F.col(key).cast(to)) if key in df.columns else df


def _semi_by_text(df: DataFrame, cohort: DataFrame, key: str) -> DataFrame:
    """Rows whose key, as text, is a cohort key, as text; equal types compare
    as they are (the text of equal values is equal)."""
    if df.schema[key].dataType == cohort.schema[key].dataType:
        return df.join(cohort.select(key), key, "left_semi")
    keys = cohort.select(F.col(key).cast("string").alias("_key"))
    return df.join(keys, F.col(key).cast("string") == F.col("_key"), "left_semi")


def subset_tables(tables: dict, cohort: DataFrame, subject_key: str, group_key: str) -> dict:
    """Restrict every table to the cohort: by subject key when the table has
    it, else by group key, else unchanged (a lookup table).

    Left-semi joins: the cohort side is deduplicated by the join itself and
    only keys cross the shuffle."""
    out = {}
    for name, df in tables.items():
        if subject_key in df.columns:
            out[name] = _semi_by_text(df, cohort, subject_key)
        elif group_key in df.columns:
            out[name] = _semi_by_text(df, cohort, group_key)
        else:
            out[name] = df
    return out


def combine_sites(frames: dict, site_col: str = "site") -> DataFrame:
    """Stack per-site frames into one, labelled by site."""
    parts = [df.withColumn(site_col, F.lit(site)) for site, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
