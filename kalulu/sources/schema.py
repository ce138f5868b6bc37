"""Declared schemas of the warehouse tables (types of the source DDL).

Loaders compute in the types of the observations (e.g. every numeric obs is
decimal(16,4)); the sink casts to the declared type with ``try_cast`` (a value
that does not fit becomes NULL instead of failing the load, as the
string-typed blood-pressure columns of the source require).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

_KEYS = [("patient_id", "bigint"), ("visit_date", "date"), ("location", "string")]

WAREHOUSE: dict[str, list[tuple[str, str]]] = {
    "mw_patient": [("patient_id", "bigint"), ("identifier", "string"), ("gender", "string"),
                   ("birthdate", "date"), ("birthdate_estimated", "boolean"), ("district", "string"),
                   ("traditional_authority", "string"), ("village", "string"), ("chw", "string"),
                   ("dead", "boolean"), ("death_date", "date"), ("patient_uuid", "string")],
    "mw_art_followup": _KEYS + [
        ("art_regimen", "string"), ("art_drugs_received", "string"), ("arvs_given_to", "string"), ("next_appointment_date", "date"),
        ("condoms_given", "string"), ("depo_given", "string"), ("diastolic_bp", "int"), ("doses_missed", "decimal(10,2)"),
        ("height", "decimal(10,2)"), ("arvs_given", "int"), ("pill_count", "int"),
        ("pregnant_or_lactating", "string"), ("systolic_bp", "int"), ("tb_status", "string"),
        ("weight", "decimal(10,2)"), ("ctx_960", "string"), ("ctx_960_pills", "decimal(10,2)"),
        ("inh_300", "string"), ("inh_300_pills", "decimal(10,2)"), ("pyridoxine", "string"),
        ("pyridoxine_pills", "decimal(10,2)"), ("rfp_150", "string"), ("rfp_150_pills", "decimal(10,2)"),
        ("rfp_inh", "string"), ("rfp_inh_pills", "decimal(10,2)"), ("no_side_effect", "string"),
        ("peripheral_neuropathy_side_effect", "string"), ("hepatitis_side_effect", "string"),
        ("skin_rash_side_effect", "string"), ("lipodystrophy_side_effect", "string"), ("other_side_effect", "string")],
    "mw_art_initial": _KEYS + [
        ("art_first_line_regimen", "string"), ("art_first_line_regimen_start_date", "date"),
        ("art_alternative_first_line_regimen", "string"), ("art_alternative_first_line_regimen_date", "date"),
        ("art_second_line_regimen", "string"), ("art_second_line_regimen_start_date", "date"),
        ("age_at_initiation", "int"), ("cd4_count", "int"), ("cd4_date", "date"), ("clinical_stage", "string"),
        ("confirmatory_test_date", "date"), ("ever_taken_arvs", "string"), ("height", "decimal(10,2)"),
        ("pregnant_or_lactating", "string"), ("tb_status", "string"), ("transfer_in_date", "date"),
        ("weight", "decimal(10,2)"), ("child_hcc_no", "string"), ("art_education_date", "date"),
        ("art_education_done", "string"), ("cd4_percentage", "decimal(6,2)"), ("confirmatory_test_location", "string"),
        ("confirmatory_test_type", "string"), ("ks_side_effects_worsening_on_arvs", "string"),
        ("last_arvs_taken", "string"), ("last_arvs_taken_date", "string"), ("presumed_hiv_severe_present", "string"),
        ("tb_registration_number", "string"), ("tb_treatment_start_date", "date"),
        ("who_clinical_conditions", "string"), ("tb_xpert", "string"), ("tb_xpert_date", "date"),
        ("urine_lam", "string"), ("urine_lam_date", "date"), ("crag", "string"), ("crag_date", "date")],
    "mw_art_visits": [("art_visit_id", "bigint")] + _KEYS + [("next_appointment_date", "date"), ("art_drug_regimen", "string")],
    "mw_art_followup_testing": _KEYS + [("cd4_count", "int"), ("cd4_pct", "int"), ("phq_nine_score", "int"),
                                        ("serum_glucose", "int"), ("test_type", "string")],
    "mw_art_viral_load": _KEYS + [("obs_group_id", "bigint"), ("reason_for_test", "string"), ("ldl", "string"),
                                  ("bled", "string"), ("lab_location", "string"), ("less_than_limit", "int"),
                                  ("other_results", "string"), ("sample_id", "string"),
                                  ("viral_load_result", "int")],
    "mw_art_regimen": [("patient_id", "bigint"), ("regimen", "string"), ("regimen_init_date", "date"),
                       ("num_of_prev_regimens", "int"), ("regimen_end_date", "date"), ("line", "string")],
    "mw_lab_tests": [("lab_test_id", "bigint"), ("patient_id", "bigint"), ("encounter_id", "bigint"),
                     ("date_collected", "date"), ("test_type", "string"), ("date_result_received", "date"),
                     ("date_result_entered", "date"), ("result_coded", "string"),
                     ("result_numeric", "decimal(10,2)"), ("result_exception", "string")],
    "mw_pre_art_visits": _KEYS + [("next_appointment_date", "date")],
    "mw_eid_initial": _KEYS + [("age", "int"), ("age_when_starting_nvp", "int"), ("birth_weight", "decimal(10,2)"),
                               ("duration_type_when_starting_nvp", "string"), ("mother_art_reg_no", "string"),
                               ("mother_art_start_date", "date"), ("mother_hiv_status", "string"),
                               ("nvp_duration", "int"), ("nvp_duration_type", "string")],
    "mw_eid_followup": _KEYS + [("breast_feeding", "string"), ("clinical_monitoring", "string"),
                                ("height", "decimal(10,2)"), ("mother_status", "string"),
                                ("next_appointment_date", "date"), ("wasting_or_malnutrition", "string"),
                                ("weight", "int"), ("cpt", "int"), ("hiv_infection", "string"),
                                ("muac", "decimal(16,4)")],
    "mw_eid_visits": [("eid_visit_id", "bigint")] + _KEYS + [("next_appointment_date", "date"), ("breastfeeding_status", "string"),
                              ("mother_status", "string")],
    "mw_eid_lab_tests": _KEYS + [("result_date", "date"), ("test_type", "string"), ("lab_laboratory", "string"),
                                 ("reasons_for_testing", "string"), ("hiv_result", "string"),
                                 ("sample_id", "string")],
    "mw_art_register": [("enrollment_id", "bigint"), ("patient_id", "bigint"), ("location", "string"), ("art_number", "string"),
                        ("start_date", "date"), ("end_date", "date"), ("outcome", "string"),
                        ("last_art_visit_id", "bigint"), ("last_viral_load_test_id", "bigint"),
                        ("last_viral_load_result_id", "bigint")],
    "mw_pre_art_register": [("enrollment_id", "bigint"), ("patient_id", "bigint"), ("location", "string"), ("pre_art_number", "string"),
                            ("start_date", "date"), ("end_date", "date"), ("outcome", "string")],
    "mw_eid_register": [("enrollment_id", "bigint"), ("patient_id", "bigint"), ("location", "string"), ("eid_number", "string"),
                        ("start_date", "date"), ("end_date", "date"), ("outcome", "string"),
                        ("last_eid_visit_id", "bigint"), ("mother_art_number", "string")],
}


#: the source system's tables that loaders and reports read
SOURCES: dict[str, list[tuple[str, str]]] = {
    "omrs_patient": [("patient_id", "bigint"), ("identifier", "string"), ("gender", "string"), ("birthdate", "date"),
                     ("birthdate_estimated", "boolean"), ("state_province", "string"), ("county_district", "string"),
                     ("city_village", "string"), ("dead", "boolean"), ("death_date", "date"), ("patient_uuid", "string")],
    "omrs_relationship": [("relationship_id", "bigint"), ("patient_id", "bigint"), ("related_person", "string"),
                          ("related_person_role", "string"), ("start_date", "date"), ("end_date", "date"),
                          ("date_created", "date")],
    "omrs_encounter": [("encounter_id", "bigint"), ("patient_id", "bigint"), ("encounter_date", "date"),
                       ("encounter_type", "string"), ("location", "string")],
    "omrs_obs": [("encounter_id", "bigint"), ("obs_group_id", "bigint"), ("concept", "string"), ("obs_date", "date"),
                 ("value_coded", "string"), ("value_numeric", "decimal(16,4)"), ("value_date", "date"),
                 ("value_text", "string"), ("date_created", "date")],
    "omrs_obs_group": [("obs_group_id", "bigint"), ("encounter_id", "bigint"), ("concept", "string")],
    "omrs_program_state": [("program_state_id", "bigint"), ("program_enrollment_id", "bigint"), ("patient_id", "bigint"),
                           ("program", "string"), ("workflow", "string"), ("state", "string"), ("location", "string"),
                           ("start_date", "date"), ("end_date", "date")],
    "omrs_program_enrollment": [("program_enrollment_id", "bigint"), ("patient_id", "bigint"),
                                ("completion_date", "date"), ("outcome", "string")],
    "omrs_patient_identifier": [("patient_identifier_id", "bigint"), ("patient_id", "bigint"), ("type", "string"),
                                ("identifier", "string"), ("location", "string"), ("date_created", "date")],
    "lookup_location": [("target_value", "string"), ("source_key", "int")],
}


def struct_type(table: str) -> StructType:
    from pyspark.sql.types import _parse_datatype_string

    return StructType([StructField(n, _parse_datatype_string(t), True) for n, t in (WAREHOUSE.get(table) or SOURCES[table])])


def conform(df: DataFrame, table: str) -> DataFrame:
    """Project to the declared columns (the sink's explicit column map) and
    cast each with ``try_cast``; a missing column is an error."""
    cols = WAREHOUSE[table]
    missing = [n for n, _ in cols if n not in df.columns]
    if missing:
        raise ValueError(f"{table}: loader output lacks {missing}")
    return df.selectExpr(*[f"try_cast(`{n}` as {t}) as `{n}`" for n, t in cols])


# fixed values: declared lengths other than the usual 255
LENGTHS: dict[str, dict[str, int]] = {
    "mw_art_regimen": {"line": 100},
    "mw_patient": {"identifier": 50, "gender": 1, "chw": 100, "patient_uuid": 38},
    "mw_lab_tests": {"test_type": 100, "result_coded": 100, "result_exception": 100},
    "mw_eid_visits": {"breastfeeding_status": 100, "mother_status": 100},
    "mw_art_register": {"art_number": 50, "outcome": 100},
    "mw_pre_art_register": {"pre_art_number": 50, "outcome": 100},
    "mw_eid_register": {"eid_number": 50, "mother_art_number": 100, "outcome": 100},
}
LENGTH = 255
NOT_NULL = {"patient_id", "enrollment_id", "lab_test_id", "art_visit_id", "eid_visit_id"}


def validated(df: DataFrame, table: str) -> DataFrame:
    """The declared columns, cast, with ``__faults`` (what is wrong with the row) and ``__row`` (a faulty row as JSON).

    Faults: ``null: c`` and ``length: c`` keep the row out of the table;
    ``type: c`` (a value that is none of the declared type becomes null) and
    ``fraction: c`` (it is cut to a whole number) do not.
    """
    given = dict(df.dtypes)
    missing = [n for n, _ in WAREHOUSE[table] if n not in given]
    if missing:
        raise ValueError(f"{table}: loader output lacks {missing}")
    faults = []
    for n, t in WAREHOUSE[table]:
        if n in NOT_NULL:
            faults.append(f"if(`{n}` is null, 'null: {n}', null)")
        if given[n] != t:
            faults.append(f"if(`{n}` is not null and try_cast(`{n}` as {t}) is null, 'type: {n}', null)")
            if given[n].startswith("decimal") and t in ("int", "bigint"):
                faults.append(f"if(try_cast(`{n}` as {t}) <> `{n}`, 'fraction: {n}', null)")
        if t == "string":
            faults.append(f"if(length(`{n}`) > {LENGTHS.get(table, {}).get(n, LENGTH)}, 'length: {n}', null)")
    found = f"filter(array({', '.join(faults)}), x -> x is not null)"
    checked = df.selectExpr(*[f"`{n}`" for n, _ in WAREHOUSE[table]], f"{found} as __faults")
    row = ", ".join(f"`{n}`" for n, _ in WAREHOUSE[table])
    return checked.selectExpr(*[f"try_cast(`{n}` as {t}) as `{n}`" for n, t in WAREHOUSE[table]], "__faults",
                              f"if(size(__faults) > 0, to_json(struct({row})), null) as __row")


_OUT = "exists(__faults, x -> x like 'null:%' or x like 'length:%')"


def accepted(rows: DataFrame) -> DataFrame:
    """Of validated rows, those that the table takes."""
    return rows.where(f"not {_OUT}").drop("__faults", "__row")


def rejects(rows: DataFrame) -> DataFrame:
    """Of validated rows, the faulty ones: faults, kept (the row is in the table), row (JSON, as loaded)."""
    return rows.where("size(__faults) > 0").selectExpr("__faults as faults", f"not {_OUT} as kept", "__row as `row`")
