"""

Every registered query reads the driver tables of ``sf_dir`` (directly or
through the deterministic projection in ``kalulu.sources.fixtures``) and runs
over the whole tables.  Report parameters: end 2000-06-30, start 2000-04-01,
all facilities in one job.
"""

from __future__ import annotations

import datetime as _dt
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kalulu import constants as K
from kalulu.sources.fixtures import Warehouse
from kalulu.sources.normalise import NormalisedWarehouse

SF_SMOKE = "/root/testdata/sf0.001"
START = _dt.date(2000, 4, 1)
END = _dt.date(2000, 6, 30)
BOUNDS = (_dt.date(1996, 1, 1), _dt.date(1998, 12, 31))   # of the bounded test lookups


def _wh(spark: SparkSession, sf_dir: str) -> NormalisedWarehouse:
    return NormalisedWarehouse(Warehouse(spark, sf_dir))


def _q_moh_tx_mmd(spark, sf_dir):
    from kalulu.plans.reports.mmd import tx_mmd
    return tx_mmd(_wh(spark, sf_dir), END, cutoff=K.MOH_CUTOFF_DAYS)


def _q_pepfar_tx_mmd(spark, sf_dir):
    from kalulu.plans.reports.mmd import tx_mmd
    return tx_mmd(_wh(spark, sf_dir), END, cutoff=K.PEPFAR_CUTOFF_DAYS)


def _q_moh_cohort(spark, sf_dir):
    from kalulu.plans.reports.cohort_disaggregated import cohort_disaggregated
    return cohort_disaggregated(_wh(spark, sf_dir), START, END, cutoff=K.MOH_CUTOFF_DAYS)


def _q_pepfar_cohort(spark, sf_dir):
    from kalulu.plans.reports.cohort_disaggregated import cohort_disaggregated
    return cohort_disaggregated(_wh(spark, sf_dir), START, END, cutoff=K.PEPFAR_CUTOFF_DAYS)


def _q_tx_new(spark, sf_dir):
    from kalulu.plans.reports.tx_new import tx_new
    return tx_new(_wh(spark, sf_dir), START, END)


def _q_pepfar_tx_new(spark, sf_dir):
    # the PEPFAR twin differs only by its (unused) cutoff
    from kalulu.plans.reports.tx_new import tx_new
    return tx_new(_wh(spark, sf_dir), START, END, cutoff=K.PEPFAR_CUTOFF_DAYS)


def _q_tpt(spark, sf_dir):
    from kalulu.plans.reports.tpt import tpt_initiation
    return tpt_initiation(_wh(spark, sf_dir), START, END)


def _q_tb_prev(spark, sf_dir):
    from kalulu.plans.reports.tpt import tb_prev
    return tb_prev(_wh(spark, sf_dir), END)


def _q_tx_tb(spark, sf_dir):
    from kalulu.plans.reports.screening import tx_tb
    return tx_tb(_wh(spark, sf_dir), END)


def _q_htn(spark, sf_dir):
    from kalulu.plans.reports.screening import tx_hiv_htn
    return tx_hiv_htn(_wh(spark, sf_dir), END)


def _q_tx_ml(spark, sf_dir):
    from kalulu.plans.reports.tx_ml import tx_ml
    return tx_ml(_wh(spark, sf_dir), START, END)


def _q_pvls(spark, sf_dir):
    from kalulu.plans.reports.viral_load import tx_pvls
    return tx_pvls(_wh(spark, sf_dir), END)


def _q_rtt(spark, sf_dir):
    from kalulu.plans.reports.rtt import tx_rtt
    return tx_rtt(_wh(spark, sf_dir), START, END)


def _q_dispensation(spark, sf_dir):
    from kalulu.plans.reports.viral_load import regimen_dispensation
    return regimen_dispensation(_wh(spark, sf_dir), END)


def _q_by_weight(spark, sf_dir):
    from kalulu.plans.reports.viral_load import regimen_by_weight
    return regimen_by_weight(_wh(spark, sf_dir), END)


def _q_switch(spark, sf_dir):
    from kalulu.plans.reports.regimen_switch import regimen_switch
    return regimen_switch(_wh(spark, sf_dir), START)


def _q_survival_general(spark, sf_dir):
    from kalulu.plans.reports.survival import survival
    return survival(_wh(spark, sf_dir), START, END, age_limit_years=200, subgroup="General")


def _q_survival_children(spark, sf_dir):
    from kalulu.plans.reports.survival import survival
    return survival(_wh(spark, sf_dir), START, END, age_limit_years=14, subgroup="Children")


def _q_survival_women(spark, sf_dir):
    from kalulu.plans.reports.survival import survival
    return survival(_wh(spark, sf_dir), START, END, subgroup="Option B+", option_b=True)


def _loader(fn_name, module="art"):
    def run(spark, sf_dir):
        import importlib
        mod = importlib.import_module(f"kalulu.plans.loaders.{module}")
        return getattr(mod, fn_name)(_wh(spark, sf_dir))
    return run


def _q_register(spark, sf_dir):
    from kalulu.plans.loaders.register import load_art_register
    return load_art_register(_wh(spark, sf_dir))


def _q_parent(spark, sf_dir):
    from kalulu.plans.functions_queries import parent_facilities
    return parent_facilities(_wh(spark, sf_dir))


def _q_ident(spark, sf_dir):
    from kalulu.plans.functions_queries import formatted_identifiers
    return formatted_identifiers(_wh(spark, sf_dir))


def _tests(fn_name, **kw):
    """A lookup over the one lab-test table, for a test type and bounds."""
    def run(spark, sf_dir):
        from kalulu.plans import functions_queries
        from kalulu.plans.loaders.lab import load_lab_tests
        return getattr(functions_queries, fn_name)(load_lab_tests(_wh(spark, sf_dir)), **kw)
    return run


def _loaded(spark, sf_dir):
    """The warehouse that the loaders make of the observations."""
    from kalulu.sources.warehouse import LoadedWarehouse
    return LoadedWarehouse(_wh(spark, sf_dir))


def _q_loaded_mmd(spark, sf_dir):
    from kalulu.plans.reports.mmd import tx_mmd
    return tx_mmd(_loaded(spark, sf_dir), END, cutoff=K.MOH_CUTOFF_DAYS)


def _q_loaded_cohort(spark, sf_dir):
    from kalulu.plans.reports.cohort_disaggregated import cohort_disaggregated
    return cohort_disaggregated(_loaded(spark, sf_dir), START, END, cutoff=K.MOH_CUTOFF_DAYS)


def _q_loaded_tx_new(spark, sf_dir):
    from kalulu.plans.reports.tx_new import tx_new
    return tx_new(_loaded(spark, sf_dir), START, END)


def _q_regimen(offset):
    def run(spark, sf_dir):
        from kalulu.plans.functions_queries import regimen_at_offset
        from kalulu.plans.loaders.art import load_art_regimen
        return regimen_at_offset(load_art_regimen(_wh(spark, sf_dir)), offset)
    return run


def _q_breastfeeding(spark, sf_dir):
    from kalulu.plans.functions_queries import first_date_no_breastfeeding
    from kalulu.plans.loaders.wide import load_eid_visits
    return first_date_no_breastfeeding(load_eid_visits(_wh(spark, sf_dir)), END)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "moh_tx_mmd": _q_moh_tx_mmd,
    "pepfar_tx_mmd": _q_pepfar_tx_mmd,
    "moh_cohort_disaggregated": _q_moh_cohort,
    "pepfar_cohort_disaggregated": _q_pepfar_cohort,
    "moh_tx_new": _q_tx_new,
    "pepfar_tx_new": _q_pepfar_tx_new,
    "moh_tpt_initiation": _q_tpt,
    "pepfar_tb_prev": _q_tb_prev,
    "pepfar_tx_tb": _q_tx_tb,
    "pepfar_tx_hiv_htn": _q_htn,
    "pepfar_tx_ml": _q_tx_ml,
    "pepfar_tx_pvls": _q_pvls,
    "pepfar_tx_rtt": _q_rtt,
    "moh_regimen_dispensation": _q_dispensation,
    "moh_regimen_by_weight": _q_by_weight,
    "moh_regimen_switch": _q_switch,
    "moh_survival_general": _q_survival_general,
    "moh_survival_children": _q_survival_children,
    "moh_survival_women": _q_survival_women,
    "load_art_followup": _loader("load_art_followup"),
    "load_art_initial": _loader("load_art_initial"),
    "load_art_visits": _loader("load_art_visits"),
    "load_lab_tests": _loader("load_lab_tests", "lab"),
    "load_lab_tests_vl": _loader("load_lab_tests_vl", "lab"),
    "load_art_register": _q_register,
    "load_pre_art_register": _loader("load_pre_art_register", "register"),
    "load_eid_register": _loader("load_eid_register", "register"),
    "load_patient": _loader("load_patient", "register"),
    "load_art_regimen": _loader("load_art_regimen"),
    "load_eid_initial": _loader("load_eid_initial", "wide"),
    "load_eid_followup": _loader("load_eid_followup", "wide"),
    "load_eid_visits": _loader("load_eid_visits", "wide"),
    "load_eid_lab_tests": _loader("load_eid_lab_tests", "wide"),
    "load_pre_art_visits": _loader("load_pre_art_visits", "wide"),
    "load_art_followup_testing": _loader("load_art_followup_testing", "wide"),
    "load_art_viral_load": _loader("load_art_viral_load", "wide"),
    "load_lab_tests_hiv": _loader("load_lab_tests_hiv", "lab"),
    "fn_parent_health_facility": _q_parent,
    "fn_identifier_format": _q_ident,
    "fn_latest_test_result_offset0": _tests("latest_test_result", test_type="Viral Load"),
    "fn_latest_test_result_offset1": _tests("latest_test_result", test_type="Viral Load", offset=1),
    "fn_latest_test_result_hiv_bounded": _tests("latest_test_result", test_type="HIV test", date_from=BOUNDS[0], date_to=BOUNDS[1]),
    "fn_first_test_result_by_date_entered": _tests("first_test_result", test_type="Viral Load", end=END),
    "fn_first_test_result_hiv_unbounded": _tests("first_test_result", test_type="HIV test"),
    "fn_latest_test_result_by_sample_date": _tests("latest_test_by_sample_date", test_type="Viral Load"),
    "fn_latest_test_by_sample_date_hiv_bounded": _tests("latest_test_by_sample_date", test_type="HIV test", date_from=BOUNDS[0], date_to=BOUNDS[1]),
    "pipeline_moh_tx_mmd": _q_loaded_mmd,
    "pipeline_moh_cohort_disaggregated": _q_loaded_cohort,
    "pipeline_pepfar_tx_new": _q_loaded_tx_new,
    "fn_get_regimen_offset0": _q_regimen(0),
    "fn_get_regimen_offset1": _q_regimen(1),
    "fn_first_date_no_breastfeeding": _q_breastfeeding,
}


try:  # the training-data operators are optional: their folders may be absent
    import corpus_pipeline as _pipeline
    from kalulu.llm import queries as _llm
except ImportError as missing:
    logging.getLogger(__name__).warning("the training-data operators are left out: %s", missing)
    _pipeline = _llm = None


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: MOH multi-month dispensing report on sf0.001, all facilities."""
    return _q_moh_tx_mmd(spark, SF_SMOKE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    more = {**_llm.QUERIES, "pipeline": _pipeline.run} if _llm else {}
    return {**_QUERIES, **more}


def oracle_sql() -> dict[str, str]:
    from oracle import loaders_sql as L
    from oracle import reports_sql as R

    more = dict(_llm.ORACLE_SQL) if _llm else {}
    if _llm and _pipeline.ORACLE_SQL:
        more["pipeline"] = _pipeline.ORACLE_SQL
    return more | {
        "moh_tx_mmd": R.tx_mmd_sql(END, K.MOH_CUTOFF_DAYS),
        "pepfar_tx_mmd": R.tx_mmd_sql(END, K.PEPFAR_CUTOFF_DAYS),
        "moh_cohort_disaggregated": R.cohort_disaggregated_sql(START, END, K.MOH_CUTOFF_DAYS),
        "pepfar_cohort_disaggregated": R.cohort_disaggregated_sql(START, END, K.PEPFAR_CUTOFF_DAYS),
        "moh_tx_new": R.tx_new_sql(START, END),
        "pepfar_tx_new": R.tx_new_sql(START, END),
        "moh_tpt_initiation": R.tpt_initiation_sql(START, END),
        "pepfar_tb_prev": R.tb_prev_sql(END),
        "pepfar_tx_tb": R.tx_tb_sql(END, K.PEPFAR_CUTOFF_DAYS),
        "pepfar_tx_hiv_htn": R.tx_hiv_htn_sql(END, K.PEPFAR_CUTOFF_DAYS),
        "pepfar_tx_ml": R.tx_ml_sql(START, END, K.PEPFAR_CUTOFF_DAYS),
        "pepfar_tx_pvls": R.tx_pvls_sql(END),
        "pepfar_tx_rtt": R.tx_rtt_sql(START, END, K.PEPFAR_CUTOFF_DAYS),
        "moh_regimen_dispensation": R.regimen_dispensation_sql(END, K.MOH_CUTOFF_DAYS),
        "moh_regimen_by_weight": R.regimen_by_weight_sql(END, K.MOH_CUTOFF_DAYS),
        "moh_regimen_switch": R.regimen_switch_sql(START),
        "moh_survival_general": R.survival_sql(START, END, 200, "General", False),
        "moh_survival_children": R.survival_sql(START, END, 14, "Children", False),
        "moh_survival_women": R.survival_sql(START, END, 200, "Option B+", True),
        "load_art_followup": L.art_followup_sql(),
        "load_art_initial": L.art_initial_sql(),
        "load_art_visits": L.art_visits_sql(),
        "load_lab_tests": L.lab_tests_sql(),
        "load_lab_tests_vl": L.lab_tests_vl_sql(),
        "load_art_register": L.art_register_sql(),
        "load_pre_art_register": L.pre_art_register_sql(),
        "load_eid_register": L.eid_register_sql(),
        "load_patient": L.patient_sql(),
        "load_art_regimen": L.art_regimen_sql(),
        "load_eid_initial": L.eid_initial_sql(),
        "load_eid_followup": L.eid_followup_sql(),
        "load_eid_visits": L.eid_visits_sql(),
        "load_eid_lab_tests": L.eid_lab_tests_sql(),
        "load_pre_art_visits": L.pre_art_visits_sql(),
        "load_art_followup_testing": L.art_followup_testing_sql(),
        "load_art_viral_load": L.art_viral_load_sql(),
        "load_lab_tests_hiv": L.lab_tests_hiv_sql(),
        "fn_parent_health_facility": L.parent_facilities_sql(),
        "fn_identifier_format": L.formatted_identifiers_sql(),
        "fn_latest_test_result_offset0": L.test_lookup_sql("date_result_entered", "Viral Load", True),
        "fn_latest_test_result_offset1": L.test_lookup_sql("date_result_entered", "Viral Load", True, offset=1),
        "fn_latest_test_result_hiv_bounded": L.test_lookup_sql("date_result_entered", "HIV test", True, bounds=BOUNDS),
        "fn_first_test_result_by_date_entered": L.test_lookup_sql("date_result_entered", "Viral Load", True, newest=False, bounds=(None, END)),
        "fn_first_test_result_hiv_unbounded": L.test_lookup_sql("date_result_entered", "HIV test", True, newest=False),
        "fn_latest_test_result_by_sample_date": L.test_lookup_sql("date_collected", "Viral Load", False),
        "fn_latest_test_by_sample_date_hiv_bounded": L.test_lookup_sql("date_collected", "HIV test", False, bounds=BOUNDS),
        "pipeline_moh_tx_mmd": R.tx_mmd_sql(END, K.MOH_CUTOFF_DAYS, L.loaded_tables()),
        "pipeline_moh_cohort_disaggregated": R.cohort_disaggregated_sql(START, END, K.MOH_CUTOFF_DAYS, L.loaded_tables()),
        "pipeline_pepfar_tx_new": R.tx_new_sql(START, END, L.loaded_tables()),
        "fn_get_regimen_offset0": L.regimen_at_offset_sql(0),
        "fn_get_regimen_offset1": L.regimen_at_offset_sql(1),
        "fn_first_date_no_breastfeeding": L.first_date_no_breastfeeding_sql(END),
    }
