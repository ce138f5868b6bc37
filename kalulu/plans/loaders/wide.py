"""Generic wide loaders: an encounter spine LEFT JOINed to one EAV pivot.

The EID, pre-ART, viral-load screening and follow-up testing loads all have
the shape "distinct (patient, date, location) of some encounter types" plus
"one column per concept".  One aggregate over the observations replaces the
per-concept inputs and their merge joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalulu import constants as K
from kalulu.operators.ids import dense_ids
from kalulu.operators.latest import latest_per_key
from kalulu.operators.pivot import eav_pivot_encounters, eav_pivot_paired
from kalulu.plans.loaders import concepts as C
from kalulu.plans.loaders.art import KEYS, encounter_spine, visit_encounters
from kalulu.sources.fixtures import Warehouse


def _raw_obs_with_group(wh: Warehouse) -> DataFrame:
    grp = wh.omrs_obs_group.select("obs_group_id", F.col("concept").alias("group_concept"))
    return wh.omrs_obs.join(grp, "obs_group_id", "left")


def wide_load(wh: Warehouse, spine_types: list[str], spec: list[tuple], with_groups: bool = False) -> DataFrame:
    obs = _raw_obs_with_group(wh) if with_groups else wh.omrs_obs
    wide = eav_pivot_encounters(obs, visit_encounters(wh), KEYS, spec)
    return encounter_spine(wh, spine_types).join(wide, KEYS, "left").select(*KEYS, *[e[0] for e in spec])


def load_eid_initial(wh: Warehouse) -> DataFrame:
    """mw_eid_initial: nevirapine age and duration with the unit of their own observation group."""
    wide = eav_pivot_paired(_raw_obs_with_group(wh), visit_encounters(wh), KEYS, C.EID_INITIAL, C.EID_INITIAL_PAIRS)
    return encounter_spine(wh, [K.EXPOSED_CHILD_INITIAL]).join(wide, KEYS, "left").select(*KEYS, *[e[0] for e in C.EID_INITIAL])


def load_eid_followup(wh: Warehouse) -> DataFrame:
    return wide_load(wh, [K.EXPOSED_CHILD_FOLLOWUP], C.EID_FOLLOWUP)


def load_eid_visits(wh: Warehouse) -> DataFrame:
    out = wide_load(wh, [K.EXPOSED_CHILD_INITIAL, K.EXPOSED_CHILD_FOLLOWUP], C.EID_VISITS)
    return dense_ids(out, "eid_visit_id", KEYS)


def load_eid_lab_tests(wh: Warehouse) -> DataFrame:
    return wide_load(wh, [K.EID_SCREENING], C.EID_LAB_TESTS)


def load_pre_art_visits(wh: Warehouse) -> DataFrame:
    return wide_load(wh, [K.PART_INITIAL, K.PART_FOLLOWUP], C.PRE_ART_VISITS)


def load_art_followup_testing(wh: Warehouse) -> DataFrame:
    """Follow-up testing visits that have a CD4 count (inner), with the other
    tests of the visit attached.  The inputs keep every observation, so a visit
    with several results of one kind has a row for each combination."""
    enc = visit_encounters(wh)
    spec = [C.FOLLOWUP_TESTING_REQUIRED, *C.FOLLOWUP_TESTING]
    concepts = [concept for _, concept, _, _ in spec]
    obs = wh.omrs_obs.where(F.col("concept").isin(concepts)).join(
        enc.where(F.col("encounter_type") == K.ART_FOLLOWUP_TESTING), "encounter_id")
    out = encounter_spine(wh, [K.ART_FOLLOWUP_TESTING])
    for i, (column, concept, kind, _) in enumerate(spec):
        rows = obs.where(F.col("concept") == concept).select(*KEYS, F.col(kind).alias(column))
        out = out.join(rows, KEYS, "inner" if i == 0 else "left")
    return out.select(*KEYS, *[e[0] for e in spec])


def load_art_viral_load(wh: Warehouse) -> DataFrame:
    """One row per viral-load screening visit: the reason-for-test obs anchors
    an observation group and the other results are read from that group."""
    gkeys = [*KEYS, "obs_group_id"]
    cols = [e[0] for e in C.ART_VIRAL_LOAD]
    per_group = eav_pivot_encounters(wh.omrs_obs, visit_encounters(wh), gkeys,
                                     [C.ART_VIRAL_LOAD_ANCHOR, *C.ART_VIRAL_LOAD],
                                     obs_keys=["obs_group_id"]).where(F.col("reason_for_test").isNotNull())
    # one reason per visit (the lowest group id), read with its group's results
    per_visit = latest_per_key(per_group, KEYS, ["obs_group_id"], ["reason_for_test", *cols], newest=False)
    return encounter_spine(wh, [K.VIRAL_LOAD_SCREENING]).join(per_visit, KEYS, "left").select(
        *KEYS, "obs_group_id", "reason_for_test", *cols)
