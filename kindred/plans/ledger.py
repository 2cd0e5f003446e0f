"""The ledger of runs: what started, succeeded or failed, written by every runner."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from kindred.operators import state
from kindred.sources import tables

#: Length of an error message in the ledger.
MESSAGE = 2_000


@dataclass(frozen=True)
class Ledger:
    """Where a runner writes its rows, and under which names."""

    root: str
    as_of: int
    source: str
    workflow: str

    def load(self, spark: SparkSession) -> DataFrame:
        tables.create_if_absent(spark, self.root, state.LEDGER_SCHEMA)
        return tables.load(spark, self.root)

    def log(self, spark: SparkSession, kind: str, run_id: str, table: str, records: int = 0, source: str | None = None, **fields) -> None:
        """One row under its own run id, so that a repeated run does not write it twice."""
        counted = spark.createDataFrame([(records,)], "records bigint")
        row = state.ledger_row(counted, kind, self.as_of, source or self.source, self.workflow, table, **fields)
        tables.append(row, self.root, f"{run_id}-{table}-{kind}")


@dataclass
class Done:
    records: int = 0


@contextmanager
def logged(ledger: Ledger | None, run_id: str, table: str, spark: SparkSession) -> Iterator[Done]:
    """STARTED, then SUCCESS with the records, or ERROR with the message; nothing without a ledger."""
    done = Done()
    if ledger is None:
        yield done
        return
    ledger.log(spark, "started", run_id, table)
    try:
        yield done
    except Exception as fault:
        ledger.log(spark, "error", run_id, table, error=str(fault)[:MESSAGE])
        raise
    ledger.log(spark, "success_no_window", run_id, table, done.records)
