"""A ledger of finished stages, so that a job that stopped can be run again.

A stage's record is one JSON row written after everything the stage writes.
It holds the key of the stage: a digest of its settings and of the key before
it, so a change of the input or of a setting redoes that stage and all behind
it.  A stage is kept when its record carries the same key and its outputs are
still whole; otherwise the record goes first and the stage is done anew.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from prioritext.sources.files import path_exists, remove_path

RECORD = "stage STRING, key STRING, rows BIGINT, detail STRING"


def stage_key(*parts: object) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


@dataclass
class StageLedger:
    """``entries`` collects ``(stage, status, rows, detail)`` in the order of the run."""

    spark: SparkSession
    base: str
    resume: bool = True
    entries: list[tuple[str, str, int | None, str]] = field(default_factory=list)

    def _record(self, stage: str) -> str:
        return f"{self.base.rstrip('/')}/{stage}"

    def _whole(self, outputs: Sequence[str], counted: str | None, rows: int) -> bool:
        for path in outputs:
            # a table carries its mark at the top, a saved pipeline below its metadata
            if not any(path_exists(self.spark, f"{path}/{m}") for m in ("_SUCCESS", "metadata/_SUCCESS")):
                return False
        return counted is None or self.spark.read.parquet(counted).count() == rows  # from the files' footers

    def kept(self, stage: str, key: str, outputs: Sequence[str] = (), counted: str | None = None) -> bool:
        """Whether the stage need not run; if so it is entered as ``kept``."""
        record = self._record(stage)
        if not (self.resume and path_exists(self.spark, f"{record}/_SUCCESS")):
            return False
        row = self.spark.read.schema(RECORD).json(record).first()
        if row is None or row["key"] != key or not self._whole(outputs, counted, row["rows"]):
            return False
        self.entries.append((stage, "kept", row["rows"], row["detail"]))
        return True

    def run(
        self,
        stage: str,
        key: str,
        work: Callable[[], tuple[int, str]],
        outputs: Sequence[str] = (),
        counted: str | None = None,
    ) -> bool:
        """Do a stage unless it is kept; returns whether it ran.

        ``work`` writes ``outputs`` and returns ``(rows, detail)``; ``counted``
        names the output that must still hold so many rows to be kept.
        """
        if self.kept(stage, key, outputs, counted):
            return False
        remove_path(self.spark, self._record(stage))
        rows, detail = work()
        if self.resume:
            record = self.spark.createDataFrame([(stage, key, rows, detail)], RECORD)
            record.write.mode("overwrite").json(self._record(stage))
        self.entries.append((stage, "ok", rows, detail))
        return True
