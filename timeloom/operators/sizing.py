"""Joins against fitted artifacts (vocabulary, quantile breaks).

A fitted table is materialized once (Parquet in the shared checkpoint
folder), its row count is known, and it is broadcast only when
that count is under the bound; otherwise the join is left to the planner
(sort-merge, or AQE's runtime broadcast)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeloom.session import stage_table

# Fixed bound: at most this many rows of a fitted table are broadcast.
BROADCAST_MAX_ROWS = 2_000_000


@dataclass
class Fitted:
    """A small learned table plus its row count."""
    df: DataFrame
    n_rows: int

    @classmethod
    def materialize(cls, df: DataFrame, checkpoint: bool = True) -> "Fitted":
        if checkpoint:
            df = stage_table(df, "fitted")
        return cls(df, df.count())

    def join_to(self, big: DataFrame, on, how: str = "left") -> DataFrame:
        small = F.broadcast(self.df) if self.n_rows <= BROADCAST_MAX_ROWS else self.df
        return big.join(small, on, how)
