"""Warehouse refresh: run every loader and write each warehouse table.

One Spark job per table (full refresh, ``overwrite``); the target folder is
the caller's (on a cluster a shared path).  Tables are clustered by
``patient_id`` inside files, since every read of the warehouse is by patient.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalulu.plans.loaders import art, lab, register, wide
from kalulu.sources.fixtures import Warehouse
from kalulu.sources.normalise import NormalisedWarehouse
from kalulu.session import checkpoint
from kalulu.sources.commit import Commits, CommittedWarehouse
from kalulu.sources.schema import accepted, rejects, validated
from kalulu.sources.tables import write_table

LOADERS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "mw_patient": register.load_patient,
    "mw_art_initial": art.load_art_initial,
    "mw_art_followup": art.load_art_followup,
    "mw_art_visits": art.load_art_visits,
    "mw_art_followup_testing": wide.load_art_followup_testing,
    "mw_art_viral_load": wide.load_art_viral_load,
    "mw_art_regimen": art.load_art_regimen,
    "mw_lab_tests": lab.load_lab_tests,
    "mw_pre_art_visits": wide.load_pre_art_visits,
    "mw_eid_initial": wide.load_eid_initial,
    "mw_eid_followup": wide.load_eid_followup,
    "mw_eid_visits": wide.load_eid_visits,
    "mw_eid_lab_tests": wide.load_eid_lab_tests,
    "mw_art_register": register.load_art_register,
    "mw_pre_art_register": register.load_pre_art_register,
    "mw_eid_register": register.load_eid_register,
}


#: source tables that reports read beside the loaded ones
SOURCE_TABLES = ["omrs_program_state", "omrs_program_enrollment", "omrs_patient_identifier", "lookup_location"]


def copy_sources(wh, target: str) -> None:
    """Write the source tables that reports read, in one spelling."""
    wh = NormalisedWarehouse(wh)
    for name in SOURCE_TABLES:
        write_table(getattr(wh, name), f"{target.rstrip('/')}/{name}")


#: id column of a table, and the columns of other tables that hold its ids
IDS = {"mw_art_visits": "art_visit_id", "mw_eid_visits": "eid_visit_id", "mw_lab_tests": "lab_test_id"}
REFERENCES = {
    "mw_art_register": {"last_art_visit_id": "mw_art_visits", "last_viral_load_test_id": "mw_lab_tests", "last_viral_load_result_id": "mw_lab_tests"},
    "mw_eid_register": {"last_eid_visit_id": "mw_eid_visits"},
}


def refresh_warehouse(wh: Warehouse, target: str, tables: list[str] | None = None, mode: str = "overwrite",
                      keep_rejects: bool = True) -> dict[str, str]:
    """Load the named (default: all) warehouse tables into ``target/<table>``.

    ``mode="append"`` adds to what is there, at each call; :func:`commit_batch`
    adds a batch once.  Rows with faults are written to
    ``target/rejects/<table>`` (``kalulu.sources.schema.rejects``); a load is computed once.
    Coded text is stored in one spelling, so reports compare and push down plain
    literals.  ``StoredWarehouse(spark, target)`` reads the result back, also the
    source tables that reports need when they are copied there (``SOURCE_TABLES``).
    """
    out = {}
    wh = NormalisedWarehouse(wh)
    for name in tables or list(LOADERS):
        path = f"{target.rstrip('/')}/{name}"
        rows = checkpoint(validated(LOADERS[name](wh), name))
        write_table(accepted(rows), path, mode=mode, sort_within=["patient_id"])
        if keep_rejects:
            write_table(rejects(rows), f"{target.rstrip('/')}/rejects/{name}", mode=mode)
        out[name] = path
    return out


def commit_batch(wh: Warehouse, target: str, batch: str, tables: list[str] | None = None, replace: bool = False) -> bool:
    """Load the tables from ``wh`` as one commit named ``batch``: all of them or none, and once however often it is run.

    Without ``replace`` rows are added; their ids go on from the largest id
    committed so far, and so do the register's references to them.  Rejected
    rows are committed with their tables as ``rejects_<table>``.  Read the
    result with ``kalulu.sources.commit.CommittedWarehouse``.
    """
    source = NormalisedWarehouse(wh)
    log, old = Commits(wh.spark, target), CommittedWarehouse(wh.spark, target)
    if batch in old.batches:
        return False
    last = {} if replace else {t: getattr(old, t).agg(F.max(c)).first()[0] or 0 for t, c in IDS.items()}
    parts: dict[str, DataFrame] = {}
    for name in tables or list(LOADERS):
        rows = LOADERS[name](source)
        shift = {IDS[name]: name} if name in IDS else REFERENCES.get(name, {})
        rows = rows.withColumns({c: F.col(c) + last.get(t, 0) for c, t in shift.items()}) if shift else rows
        rows = checkpoint(validated(rows, name))
        parts[name], parts[f"rejects_{name}"] = accepted(rows), rejects(rows)
    return log.commit(batch, parts, replace)
