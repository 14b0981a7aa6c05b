"""Data-quality checks returned as DataFrames (one scan each, no driver loop)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prioritext.constants import (
    DISPLAY_NAMES,
    MAX_TEXT_CHARS,
    MIN_TEXT_CHARS,
    VALID_LABELS,
)
from prioritext.functions.text import blank_text, non_ascii
from prioritext.operators.common import EngineError


def contract_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row per required column: ``(column, present)``; supersets pass.

    Metadata only: reads the analysed schema, runs no job.
    """
    spark = df.sparkSession
    have = set(df.columns)
    rows = [(c, c in have) for c in required]
    return spark.createDataFrame(rows, "column STRING, present BOOLEAN")


def check_contract(df: DataFrame, required: Sequence[str], what: str = "input") -> None:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise EngineError(f"{what}: missing column(s) {missing}; has {list(df.columns)}")


def validate_text(df: DataFrame, id_col: str, text_col: str = "text", first_n: int = 5) -> DataFrame:
    """1 row ``(n_checked, n_bad, first_bad)``: null / blank texts and the first ids.

    Counts come from one aggregate pass; the first ids from a TakeOrdered over
    the bad rows only (bounded by ``first_n``).  The two one-row results are
    merged by a union and a 2-row aggregate, not by a join.
    """
    bad = blank_text(F.col(text_col))
    counts = df.agg(
        F.count(F.lit(1)).alias("n_checked"),
        F.count_if(bad).alias("n_bad"),
    ).withColumn("_ids", F.lit(None).cast("array<string>"))
    first = (
        df.filter(bad)
        .select(F.col(id_col).alias("_id"))
        .orderBy("_id")
        .limit(first_n)
        .agg(F.array_sort(F.collect_list("_id")).alias("_ids"))
        .select(
            F.lit(None).cast("bigint").alias("n_checked"),
            F.lit(None).cast("bigint").alias("n_bad"),
            F.transform(F.col("_ids"), lambda x: x.cast("string")).alias("_ids"),
        )
    )
    return counts.unionByName(first).agg(
        F.max("n_checked").cast("bigint").alias("n_checked"),
        F.max("n_bad").cast("bigint").alias("n_bad"),
        F.coalesce(F.concat_ws(",", F.first("_ids", ignorenulls=True)), F.lit("")).alias("first_bad"),
    )


def validate_labels(df: DataFrame, label_col: str = "label", allowed: Sequence[str] = VALID_LABELS) -> DataFrame:
    """Every distinct label value (null read as the string ``'null'``) with its
    count and whether it lies in the allowed domain, sorted by value."""
    value = F.coalesce(F.col(label_col).cast("string"), F.lit("null"))
    return (
        df.groupBy(value.alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("valid", F.col("label").isin(list(allowed)))
        .orderBy("label")
    )


def invalid_labels(df: DataFrame, label_col: str = "label", allowed: Sequence[str] = VALID_LABELS) -> DataFrame:
    return validate_labels(df, label_col, allowed).filter(~F.col("valid")).select("label", "n")


def admission(
    df: DataFrame,
    text_col: str = "text",
    min_len: int = MIN_TEXT_CHARS,
    max_len: int = MAX_TEXT_CHARS,
) -> DataFrame:
    """Add ``admitted`` and ``reason``: character length within [min, max], no trim."""
    n = F.char_length(F.col(text_col))
    reason = (
        F.when(F.col(text_col).isNull(), F.lit("missing"))
        .when(n < min_len, F.lit("too_short"))
        .when(n > max_len, F.lit("too_long"))
    )
    return df.withColumn("n_chars_checked", n.cast("bigint")).withColumn("reason", reason).withColumn(
        "admitted", F.col("reason").isNull()
    )


def display_labels(df: DataFrame, label_col: str = "label", names: dict[str, str] = DISPLAY_NAMES) -> DataFrame:
    """Display name per class through a literal map (no join)."""
    mapping = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return df.withColumn("display_name", mapping[F.col(label_col)])


def class_balance(
    df: DataFrame, label_col: str = "label", min_rows: int = 2000, min_share: float = 0.15
) -> DataFrame:
    """Per class ``(label, n, share, share_ok)`` plus the volume flag ``rows_ok``."""
    per = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
    # the window runs over the per-class table (one row per class), not the data
    return (
        per.withColumn("total", F.sum("n").over(Window.partitionBy()))
        .select(
            F.col(label_col).alias("label"),
            F.col("n"),
            F.col("total"),
            (F.col("n") / F.col("total")).alias("share"),
            (F.col("n") / F.col("total") >= F.lit(min_share)).alias("share_ok"),
            (F.col("total") >= F.lit(min_rows)).alias("rows_ok"),
        )
    )


def non_ascii_profile(df: DataFrame, group_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Rows and rows holding any non-ASCII character, per group."""
    return df.groupBy(group_col).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(non_ascii(F.col(text_col))).alias("n_non_ascii"),
    )


def table_fingerprint(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Order-insensitive fingerprint: row count, XOR and sum of 60 bits of row digests.

    Equal tables give equal fingerprints whatever their partitioning or row
    order; it is one aggregate pass with map-side partial aggregation.  Null
    differs from an empty text; doubles count to six decimals.
    """
    fields = []
    for c in cols or df.columns:
        v = F.col(c)
        if isinstance(df.schema[c].dataType, T.DoubleType):
            v = v.cast("decimal(38,6)")
        fields.append(F.coalesce(F.concat(F.lit("="), v.cast("string")), F.lit("null")))
    h = F.conv(F.substring(F.md5(F.concat_ws("\x1f", *fields)), 1, 15), 16, 10).cast("bigint")
    return df.select(h.alias("h")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.bit_xor("h"), F.lit(0).cast("bigint")).alias("xor_hash"),
        F.coalesce(F.sum(F.col("h").cast("decimal(38,0)")), F.lit(0)).cast("string").alias("sum_hash"),
    )
