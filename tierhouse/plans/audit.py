"""Step log of a run: recorded in the driver, one row per step, appended once."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierhouse.functions.text import template
from tierhouse.schemas import LOAD_LOGS
from tierhouse.scratch import scratch_scope
from tierhouse.sources.warehouse import Warehouse

INFO, SUCCESS, FAILED = "INFO", "SUCCESS", "FAILED"
STEP_WIDTH = 22


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


@dataclass
class Audit:
    """Collects the steps of one run; `flush` appends them in one write."""

    procedure: str
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    rows: list[dict] = field(default_factory=list)

    def record(
        self,
        step: str,
        status: str,
        records_loaded: int | None = None,
        error_message: str | None = None,
        error_state: str | None = None,
        table: str | None = None,
        start: dt.datetime | None = None,
        seconds: float | None = None,
    ) -> dict:
        now = utc_now()
        row = {
            "log_id": str(uuid.uuid4()),
            "run_id": self.run_id,
            "seq": len(self.rows),
            "procedure_name": self.procedure,
            "step_name": step,
            "table_name": table,
            "status": status,
            "records_loaded": 0 if records_loaded is None else records_loaded,
            "error_message": error_message,
            "error_state": error_state,
            "start_time": start,
            "end_time": now if start else None,
            "elapsed_seconds": None if seconds is None else int(seconds),
            "logged_at": now,
        }
        self.rows.append(row)
        return row

    def to_frame(self, warehouse: Warehouse) -> DataFrame:
        values = [tuple(r[c] for c in LOAD_LOGS.columns) for r in self.rows]
        return warehouse.spark.createDataFrame(values, LOAD_LOGS.schema)

    def flush(self, warehouse: Warehouse) -> None:
        warehouse.create(LOAD_LOGS)
        warehouse.append(LOAD_LOGS, self.to_frame(warehouse), utc_now())
        self.rows = []


@dataclass(frozen=True)
class Step:
    """A named unit of work that returns the rows it loaded."""

    name: str
    work: Callable[[], int]
    table: str | None = None


def _timed(step: Step) -> tuple[int, dt.datetime, float, Exception | None]:
    start, clock = utc_now(), time.monotonic()
    try:
        rows, error = step.work(), None
    except Exception as caught:  # recorded, and raised again unless the step is isolated
        rows, error = 0, caught
    return rows, start, time.monotonic() - clock, error


def _record(audit: Audit, step: Step, outcome) -> Exception | None:
    rows, start, seconds, error = outcome
    if error is None:
        audit.record(step.name, SUCCESS, rows, table=step.table, start=start, seconds=seconds)
    else:
        audit.record(
            step.name,
            FAILED,
            error_message=str(error),
            error_state=type(error).__name__,
            table=step.table,
            start=start,
            seconds=seconds,
        )
    return error


def run_step(audit: Audit, step: Step, isolate: bool = False) -> int | None:
    """Run one step and record it. A failure is raised again, or with `isolate` only recorded."""
    outcome = _timed(step)
    error = _record(audit, step, outcome)
    if error is not None and not isolate:
        raise error
    return None if error is not None else outcome[0]


def run_independent(audit: Audit, steps: list[Step], at_once: int = 4) -> None:
    """Steps that do not read each other's output, as concurrent Spark jobs.

    Recorded in list order; the first failure is raised after all have ended.
    """
    if at_once <= 1:
        for step in steps:
            run_step(audit, step)
        return
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        timed = inheritable_thread_target(SparkSession.active())(_timed)
        outcomes = list(pool.map(timed, steps))
    errors = [_record(audit, s, o) for s, o in zip(steps, outcomes)]
    first = next((e for e in errors if e is not None), None)
    if first is not None:
        raise first


@contextmanager
def logged(warehouse: Warehouse, procedure: str, audit: Audit | None) -> Iterator[Audit]:
    """The caller's audit, or one of its own that is written at the end, also after a failure.

    The load that owns the audit also drops its intermediate tables.
    """
    if audit is not None:
        yield audit
        return
    own = Audit(procedure)
    try:
        with scratch_scope(warehouse.spark):
            yield own
    finally:
        rows = list(own.rows)
        own.flush(warehouse)
        own.rows = rows


def summary_line() -> Column:
    """One text line per log row, worded by status."""
    head = template(">> STEP: %s | STATUS: %s", F.rpad("step_name", STEP_WIDTH, " "), F.col("status"))
    loaded = template(" | RECORDS LOADED: %s", F.col("records_loaded"))
    failed = template(" | ERROR: %s", F.col("error_message"))
    other = template(" | %s", F.col("error_message"))
    tail = F.when(F.col("status") == SUCCESS, loaded).when(F.col("status") == FAILED, failed).otherwise(other)
    return F.concat(head, tail)


def load_summary(logs: DataFrame, run_id: str | None = None, since: Column | None = None) -> DataFrame:
    """Summary lines of one run, or of everything logged since a time, in log order."""
    rows = logs
    if run_id is not None:
        rows = rows.where(F.col("run_id") == run_id)
    if since is not None:
        rows = rows.where(F.col("logged_at") >= since)
    return rows.select("logged_at", "seq", summary_line().alias("log_message")).orderBy("logged_at", "seq")
