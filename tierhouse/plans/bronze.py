"""Landing files into bronze."""

from __future__ import annotations

from collections.abc import Iterable

from tierhouse.plans.audit import Audit, Step, logged, run_independent, utc_now
from tierhouse.schemas import BRONZE
from tierhouse.sources.csv import MANIFEST, Landing, read_csv
from tierhouse.sources.warehouse import Warehouse


def prepare(warehouse: Warehouse) -> None:
    """Create the bronze tables if absent and empty them."""
    warehouse.create(*BRONZE.values())
    warehouse.truncate(*BRONZE.values())


def load(
    warehouse: Warehouse,
    folder: str,
    manifest: Iterable[Landing] = MANIFEST,
    append: bool = False,
    audit: Audit | None = None,
    at_once: int = 4,
) -> Audit:
    """Every manifest file into its table, replaced or appended; the first failure ends the load."""
    run_ts = utc_now()
    write = warehouse.append if append else warehouse.overwrite

    def step(entry: Landing) -> Step:
        warehouse.create(entry.table)
        path = f"{folder.rstrip('/')}/{entry.path}"
        work = lambda: write(entry.table, read_csv(warehouse.spark, path, entry.table.schema), run_ts)
        return Step(f"LOAD_{entry.table.name.upper()}", work, warehouse.name(entry.table))

    with logged(warehouse, "bronze.load", audit) as log:
        run_independent(log, [step(e) for e in manifest], at_once)
    return log
