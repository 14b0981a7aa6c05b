"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is broadcast only when its row count is checked to be at most this.
BROADCAST_MAX_ROWS = 1_000_000


class EngineError(ValueError):
    """Raised when input data breaks an operator's contract."""


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast ``df`` only after counting it; larger sides are joined by shuffle.

    The count is one cheap job over a dimension-sized input.  Above the bound
    the plain DataFrame comes back and Catalyst / AQE pick a shuffle join.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def require_columns(df: DataFrame, required: tuple[str, ...] | list[str], what: str = "input") -> None:
    """Column contract on the analysed schema (metadata only, no job)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise EngineError(
            f"{what}: missing required column(s) {missing}. "
            f"Expected at least {list(required)}; got {list(df.columns)}."
        )


def checked_dimension(df: DataFrame, key: str, what: str = "dimension", max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """One job checks both the key uniqueness and the size bound of a
    dimension; it comes back broadcast when within the bound."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.col(key)).alias("k"),
                 F.count_if(F.col(key).isNull()).alias("z")).first()
    if row["n"] != row["k"] + row["z"] or row["z"] > 1:
        assert_unique_key(df, key, what)
    return F.broadcast(df) if row["n"] <= max_rows else df


def assert_unique_key(df: DataFrame, key: str, what: str = "dimension") -> None:
    """Fail when a dimension key repeats (it would fan fact rows out)."""
    dup = df.groupBy(key).count().filter(F.col("count") > 1).limit(5).collect()
    if dup:
        raise EngineError(f"{what}: key {key!r} is not unique, e.g. {[r[key] for r in dup]}")


def spread(df: DataFrame, num_partitions: int | None = None, key: str | None = None) -> DataFrame:
    """Rebalance before CPU-heavy text work only when the input is too coarse.

    A large scan already has far more splits than cores and is left alone (no
    extra shuffle).  A small input, or one stored as a single row group,
    yields fewer partitions than the session's parallelism and would run its
    regexes on one or two cores: it is spread by a hash of ``key`` instead
    (round-robin without a key, which sorts rows first to stay deterministic).
    ``num_partitions`` forces a given partition count.
    """
    spark = df.sparkSession
    target = num_partitions or spark.sparkContext.defaultParallelism
    if num_partitions or df.rdd.getNumPartitions() < target:
        return df.repartition(target, F.col(key)) if key else df.repartition(target)
    return df
