"""ART warehouse loaders (follow-up, initial, visits) and the viral-load lab load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalulu import constants as K
from kalulu.functions.sqltext import quoted
from kalulu.operators.ids import dense_ids
from kalulu.operators.pivot import eav_pivot_encounters
from kalulu.plans.loaders import concepts as C
from kalulu.sources.fixtures import Warehouse

KEYS = ["patient_id", "visit_date", "location"]


def visit_encounters(wh: Warehouse) -> DataFrame:
    """Encounters with their visit keys and type."""
    return wh.omrs_encounter.select("encounter_id", "patient_id", F.col("encounter_date").alias("visit_date"),
                                    "location", "encounter_type")


def _obs_with_visit(wh: Warehouse) -> DataFrame:
    """Observations with the (patient, visit date, location, type) of their encounter."""
    enc = wh.omrs_encounter.select("encounter_id", "patient_id", F.col("encounter_date").alias("visit_date"),
                                   "location", "encounter_type")
    return wh.omrs_obs.join(enc, "encounter_id")


def encounter_spine(wh: Warehouse, types: list[str]) -> DataFrame:
    """Distinct (patient, visit date, location) of the given encounter types."""
    return (wh.omrs_encounter.where(F.col("encounter_type").isin(types))
            .select("patient_id", F.col("encounter_date").alias("visit_date"), "location").distinct())


def load_art_followup(wh: Warehouse) -> DataFrame:
    """mw_art_followup: one row per ART follow-up visit."""
    obs = _obs_with_visit(wh)
    # a side effect's column holds the answer that names it
    side = [(col, C.SIDE_EFFECTS_CONCEPT, f"if(value_coded = {quoted(v)}, value_coded, null)", None) for col, v in C.SIDE_EFFECTS]
    wide = eav_pivot_encounters(wh.omrs_obs, visit_encounters(wh), KEYS, [*C.ART_FOLLOWUP, *side])
    # drug obs paired with its "Amount Dispensed" obs of the same group
    drugs = obs.where(F.col("concept") == C.TPT_CONCEPT).select(*KEYS, "obs_group_id", "value_coded")
    pills = obs.where((F.col("concept") == C.PILLS_CONCEPT) & (F.col("encounter_type") == K.ART_FOLLOWUP)).select(
        "obs_group_id", F.col("value_numeric").alias("pills"))
    paired = drugs.join(pills, "obs_group_id", "left")
    tpt = paired.groupBy(*KEYS).agg(*[
        agg for col, drug in C.TPT_DRUGS for agg in (
            F.min(F.when(F.col("value_coded") == drug, F.col("value_coded"))).alias(col),
            F.min(F.when(F.col("value_coded") == drug, F.col("pills"))).alias(f"{col}_pills"))])
    spine = encounter_spine(wh, [K.ART_FOLLOWUP])
    out = spine.join(wide, KEYS, "left").join(tpt, KEYS, "left")
    return out.select(*KEYS, *[c for c, _, _, _ in C.ART_FOLLOWUP],
                      *[x for c, _ in C.TPT_DRUGS for x in (c, f"{c}_pills")], *[c for c, _ in C.SIDE_EFFECTS])


def load_art_initial(wh: Warehouse) -> DataFrame:
    """mw_art_initial: one row per ART initial visit."""
    wide = eav_pivot_encounters(wh.omrs_obs, visit_encounters(wh), KEYS, C.ART_INITIAL)
    return encounter_spine(wh, [K.ART_INITIAL]).join(wide, KEYS, "left").select(
        *KEYS, *[c for c, _, _, _ in C.ART_INITIAL])


def load_art_visits(wh: Warehouse) -> DataFrame:
    """mw_art_visits: initial and follow-up visits with regimen and appointment."""
    wide = eav_pivot_encounters(wh.omrs_obs, visit_encounters(wh), KEYS, C.ART_VISITS)
    rows = encounter_spine(wh, [K.ART_INITIAL, K.ART_FOLLOWUP]).join(wide, KEYS, "left").select(*KEYS, *[c for c, _, _, _ in C.ART_VISITS])
    return dense_ids(rows, "art_visit_id", KEYS)


def load_art_regimen(wh: Warehouse) -> DataFrame:
    """mw_art_regimen: one row per regimen-line observation with the start date
    recorded in the same encounter; the line number is the count of previous
    regimens (0, 1, 2).  All lines in one pass: the six concepts are filtered
    once, start dates are a partial aggregate by (encounter, line).  The table's
    ``regimen_end_date`` and ``line`` are never known: null."""
    line = F.lit(None).cast("int")
    for n_prev, regimen_concept, date_concept in C.REGIMEN_LINES:
        line = F.when(F.col("concept").isin(regimen_concept, date_concept), F.lit(n_prev)).otherwise(line)
    obs = wh.omrs_obs.select("encounter_id", "concept", "value_coded", "value_date", line.alias("num_of_prev_regimens"))
    regimens = obs.where(F.col("concept").isin([c for _, c, _ in C.REGIMEN_LINES]))
    starts = obs.where(F.col("concept").isin([c for _, _, c in C.REGIMEN_LINES])).groupBy(
        "encounter_id", "num_of_prev_regimens").agg(F.min("value_date").alias("regimen_init_date"))
    return (regimens.join(starts, ["encounter_id", "num_of_prev_regimens"], "left")
            .join(wh.omrs_encounter.select("encounter_id", "patient_id"), "encounter_id")
            .select("patient_id", F.col("value_coded").alias("regimen"), "regimen_init_date", "num_of_prev_regimens",
                    F.expr("cast(null as date) as regimen_end_date"), F.expr("cast(null as string) as line")))
