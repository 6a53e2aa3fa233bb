"""How many rows each step of a preparation saw, counted by the job that runs anyway.

A ``RowAccount`` marks places of a plan.  Spark's observed metrics count the rows
that pass there while the plan runs for its own sake, so no extra scan is made:

    account = RowAccount("social")
    raw = account.mark(raw, "read")
    kept = account.mark(normalise(raw), "kept")
    kept.write.parquet(path)              # the job
    account.counts()                      # {"read": 1000, "kept": 990}

Counts are those of the first job that runs the plan to its end; a job that stops
early (``head``, ``limit``) saw fewer rows.  A stage that is repeated after a lost
executor counts its repeated rows again, as all of Spark's accumulators do.
"""
from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

ACCOUNT_SCHEMA = "dataset string, step string, position int, rows bigint, dropped bigint"


class RowAccount:
    def __init__(self, name: str):
        self.name = name
        self._steps: list[tuple[str, Observation]] = []

    def mark(self, df: DataFrame, step: str, where: Column | None = None) -> DataFrame:
        """``df``, its rows (those where ``where`` holds) counted as ``step``."""
        if step in [s for s, _ in self._steps]:
            raise ValueError(f"step {step!r} is marked already")
        seen = Observation()
        self._steps.append((step, seen))
        count = F.count(F.lit(1)) if where is None else F.count_if(where)
        return df.observe(seen, count.alias("rows"))

    def counts(self, wait_s: float = 10.0) -> dict[str, int]:
        """Rows of each step.  A job's counts arrive a moment after its end; without a
        job there are none after ``wait_s``, which raises."""
        found, until = {}, time.monotonic() + wait_s
        for step, seen in self._steps:
            while not seen._jo.future().isCompleted():
                if time.monotonic() > until:
                    raise RuntimeError(f"no job has run through {step!r} of {self.name!r} yet")
                time.sleep(0.02)
            found[step] = seen.get["rows"]
        return found


def account_frame(spark: SparkSession, accounts: list[RowAccount]) -> DataFrame:
    """(dataset, step, position, rows, dropped): a row a marked step; ``dropped`` is
    what the step before had more, NULL for the first."""
    rows = []
    for account in accounts:
        before = None
        for i, (step, n) in enumerate(account.counts().items()):
            rows.append((account.name, step, i, n, None if before is None else before - n))
            before = n
    return spark.createDataFrame(rows, ACCOUNT_SCHEMA)
