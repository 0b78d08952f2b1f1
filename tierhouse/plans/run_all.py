"""The nightly run: bronze, then silver, then gold."""

from __future__ import annotations

import datetime as dt

from tierhouse.plans import bronze, gold, silver
from tierhouse.plans.audit import Audit, logged, utc_now
from tierhouse.sources.warehouse import Warehouse


def run_all(
    warehouse: Warehouse,
    landing: str,
    run_ts: dt.datetime | None = None,
    as_of: dt.date | None = None,
    silver_options: silver.SilverOptions = silver.SCHEDULED,
    gold_options: gold.GoldOptions = gold.FULL,
) -> Audit:
    """Each layer reads what the one before wrote; the log is kept also when a layer fails."""
    run_ts = run_ts or utc_now()
    as_of = as_of or run_ts.date()
    with logged(warehouse, "warehouse.run_all", None) as audit:
        bronze.load(warehouse, landing, audit=audit)
        silver.load(warehouse, run_ts, as_of, silver_options, audit)
        gold.load(warehouse, run_ts, as_of, gold_options, audit)
    return audit
