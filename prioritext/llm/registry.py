"""The queries of this subpackage and their DuckDB twins; the entry script adds the pipeline, which is a script too."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from prioritext.llm import (
    alignment,
    chat,
    near_duplicates,
    packing,
    piecewise,
    quality,
    secret_scan,
    sharding,
    substrings,
    topk,
    toxicity,
    warc,
    whitening,
)
from prioritext.llm.tables import ship_code

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    found = (
        toxicity.op1_classifier_chain,
        quality.op2_quality_cascade,
        topk.op3_uniform_threshold,
        piecewise.op4_transducer,
        substrings.op5_substring_dedup,
        near_duplicates.op6_superminhash,
        sharding.op7_external_shuffle,
        warc.op8_revisits,
        chat.op9_snapshot_collapse,
        packing.op10_nnls_packing,
        whitening.op11_jacobi_davidson,
        secret_scan.op12_secret_scan,
        alignment.op13_token_alignment,
    )
    return {f.__name__: shipping(f) for f in found}


def shipping(query: Query) -> Query:
    """The query, which sends this package to the executors first."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_code(spark)
        return query(spark, sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


def oracle_sql() -> dict[str, str]:
    return {
        "op2_quality_cascade": quality.OP2_SQL,
        "op3_uniform_threshold": topk.OP3_SQL,
        "op5_substring_dedup": substrings.OP5_SQL,
        "op6_superminhash": near_duplicates.OP6_SQL,
        "op8_revisits": warc.OP8_SQL,
        "op9_snapshot_collapse": chat.OP9_SQL,
    }
