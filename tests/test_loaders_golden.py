"""Loaders on hand-made observations: every row kept, in any spelling."""

import datetime as dt
import json
from decimal import Decimal

import pytest

from kalulu import constants as K
from kalulu.plans.loaders import concepts as C
from kalulu.plans.loaders import art, lab, register, wide
from kalulu.plans.refresh import LOADERS
from kalulu.sources.normalise import NormalisedWarehouse
from kalulu.sources.schema import SOURCES, WAREHOUSE, accepted, conform, rejects, struct_type, validated

D = dt.date


class Tables:
    def __init__(self, spark, **rows):
        self.spark = spark
        for name in SOURCES:
            schema = struct_type(name)
            data = [tuple(r.get(f.name) for f in schema) for r in rows.get(name, [])]
            setattr(self, name, spark.createDataFrame(data, schema))


def enc(i, patient, kind, day=D(2000, 1, 1), place=K.FACILITIES[0]):
    return {"encounter_id": i, "patient_id": patient, "encounter_type": kind, "encounter_date": day, "location": place}


def obs(e, concept, group=None, **values):
    if "value_numeric" in values:
        values["value_numeric"] = Decimal(values["value_numeric"])
    return {"encounter_id": e, "concept": concept, "obs_group_id": group, "obs_date": D(2000, 1, 2), "date_created": D(2000, 1, 3), **values}


def wh(spark, **rows):
    return NormalisedWarehouse(Tables(spark, **rows))


def test_hiv_tests_keep_results_and_constructs_without_a_partner(spark):
    w = wh(spark, omrs_encounter=[enc(1, 7, "x"), enc(2, 8, "x")],
           omrs_obs_group=[{"obs_group_id": 10, "encounter_id": 1, "concept": C.SEROLOGY_CONSTRUCT},
                           {"obs_group_id": 11, "encounter_id": 1, "concept": "CHILD hiv serology construct "},
                           {"obs_group_id": 12, "encounter_id": 2, "concept": "Other construct"}],
           omrs_obs=[obs(1, C.HIV_RESULT, 10, value_coded="Positive"), obs(1, C.HIV_RESULT, 10, value_coded="Negative"),
                     obs(2, C.HIV_RESULT, 12, value_coded="Positive"),                  # outside a serology construct
                     obs(1, C.HIV_SAMPLE_DATE, 10, value_date=D(1999, 5, 5)),
                     obs(2, C.HIV_SAMPLE_DATE, 12, value_date=D(1999, 6, 6)),           # a sample date outside one is no input
                     obs(2, "hiv TEST type ", 12, value_coded="DNA-PCR")])
    rows = sorted((r.patient_id, r.encounter_id or 0, str(r.date_collected), r.test_type, r.result_coded or "")
                  for r in lab.load_lab_tests_hiv(w).collect())
    assert rows == [(7, 1, "1999-05-05", "HIV test", "Negative"), (7, 1, "1999-05-05", "HIV test", "Positive"),
                    (7, 1, "2000-01-01", "HIV test", ""),                               # a construct without results
                    (8, 0, "None", "DNA-PCR", "Positive")]
    ids = [r.lab_test_id for r in lab.load_lab_tests(w).collect()]
    assert len(set(ids)) == len(ids) == 4


def test_viral_loads_keep_every_result(spark):
    w = wh(spark, omrs_encounter=[enc(1, 7, "x"), enc(2, 7, "x")],
           omrs_obs=[obs(1, C.VL_RESULT, value_numeric=100), obs(1, C.VL_RESULT, value_numeric=200),
                     obs(1, C.VL_SAMPLE, value_coded="TRUE "), obs(2, C.VL_LESS_THAN, value_numeric=40),
                     obs(2, C.VL_LDL, value_coded="False")])
    rows = sorted((r.encounter_id, str(r.result_numeric), r.result_exception) for r in lab.load_lab_tests_vl(w).collect())
    assert rows == [(1, "100.00", None), (1, "200.00", None), (2, "None", "<40.0000")]


def test_follow_up_testing_fans_out_and_filters_the_type(spark):
    w = wh(spark, omrs_encounter=[enc(1, 7, K.ART_FOLLOWUP_TESTING.lower()), enc(2, 7, K.ART_FOLLOWUP)],
           omrs_obs=[obs(1, "CD4 count", value_numeric=5), obs(1, "CD4 count", value_numeric=6),
                     obs(1, "Cd4%", value_numeric=1), obs(1, "Cd4%", value_numeric=2),
                     obs(2, "CD4 count", value_numeric=9)])                             # another encounter that day
    rows = sorted((int(r.cd4_count), int(r.cd4_pct)) for r in wide.load_art_followup_testing(w).collect())
    assert rows == [(5, 1), (5, 2), (6, 1), (6, 2)]


def test_register_ranks_undated_last_and_uses_loaded_visits(spark):
    state = {"program_state_id": 1, "program_enrollment_id": 4, "patient_id": 7, "program": "hiv PROGRAM", "workflow": "Treatment status ",
             "state": "ON antiretrovirals", "location": "neno district hospital ", "start_date": D(2000, 1, 1)}
    w = wh(spark, omrs_program_state=[state], omrs_program_enrollment=[{"program_enrollment_id": 4, "patient_id": 7}],
           omrs_patient_identifier=[{"patient_identifier_id": 1, "patient_id": 7, "type": "arv number", "identifier": "NNO 1",
                                     "location": K.FACILITIES[0]}],                     # no date_created: still the number
           omrs_encounter=[enc(1, 7, K.ART_INITIAL, D(1999, 1, 1)), enc(2, 7, K.ART_FOLLOWUP, D(2000, 2, 2))],
           omrs_obs=[obs(1, C.VL_RESULT, value_numeric=100)])
    got = register.load_art_register(w).collect()
    visits = {r.visit_date: r.art_visit_id for r in art.load_art_visits(w).collect()}
    tests = {r.lab_test_id for r in lab.load_lab_tests_vl(w).collect()}
    assert [(r.enrollment_id, r.art_number, r.location) for r in got] == [(4, "NNO-0001", K.FACILITIES[0])]
    assert got[0].last_art_visit_id == visits[D(2000, 2, 2)] and {got[0].last_viral_load_test_id} == tests


def test_lookups(spark):
    from kalulu.plans.functions_queries import first_test_result, latest_test_by_sample_date, latest_test_result
    rows = [(1, 7, None, None, "HIV test", None, None, "Positive", None, None), (2, 7, None, D(2000, 1, 1), "HIV test", None, D(2000, 1, 5), "Negative", None, None),
            (3, 7, None, D(2000, 3, 1), "HIV test", None, D(2000, 3, 5), None, None, None), (4, 7, None, D(2000, 4, 1), "Viral Load", None, D(2000, 4, 5), None, None, "<40")]
    df = spark.createDataFrame(rows, struct_type("mw_lab_tests"))
    pick = lambda x: [r.lab_test_id for r in x.collect()]
    assert pick(latest_test_result(df, "HIV test")) == [2] and pick(latest_test_result(df, "HIV test", 1)) == [1]   # undated last
    assert pick(first_test_result(df, "HIV test")) == [1] and pick(first_test_result(df, "HIV test", D(2000, 2, 1))) == [2]
    assert pick(latest_test_by_sample_date(df, "HIV test")) == [3] and pick(latest_test_result(df, "Viral Load")) == [4]
    assert pick(latest_test_result(df, "HIV test", 0, D(2000, 2, 1))) == []


def test_units_come_from_the_group_of_their_value(spark):
    age, unit = "Patient age when result to guardian", "Units of age of child"
    groups = [{"obs_group_id": g, "encounter_id": 1, "concept": C.NVP_CONSTRUCT} for g in (10, 11)]
    w = wh(spark, omrs_encounter=[enc(1, 7, K.EXPOSED_CHILD_INITIAL), enc(2, 8, K.EXPOSED_CHILD_INITIAL)], omrs_obs_group=groups,
           omrs_obs=[obs(1, age, 10, value_numeric=6), obs(1, unit, 10, value_coded="Weeks"), obs(1, age, 11, value_numeric=9), obs(1, unit, 11, value_coded="Days"),
                     obs(1, "Medication duration", 12, value_numeric=3), obs(1, "Time units", 13, value_coded="Months"),
                     obs(2, "Medication duration", value_numeric=4), obs(2, "Time units", value_coded="Years"),
                     obs(2, "Birth weight", value_numeric=3)])
    got = {r.patient_id: r for r in wide.load_eid_initial(w).collect()}
    one, two = got[7], got[8]
    assert (one.age_when_starting_nvp, one.duration_type_when_starting_nvp) == (6, "Weeks")      # not 6 "Days"
    assert (one.nvp_duration, one.nvp_duration_type) == (3, None)                                # the unit is of another group
    assert (two.nvp_duration, two.nvp_duration_type, two.birth_weight) == (4, "Years", 3)        # both outside groups


def test_equal_lab_rows_get_ids_of_their_own(spark):
    w = wh(spark, omrs_encounter=[enc(i, 7, "x") for i in (1, 2)],
           omrs_obs=[obs(1, C.VL_RESULT, value_numeric=100)] * 3 + [obs(2, C.VL_LESS_THAN, value_numeric=40)] + [obs(1, C.HIV_RESULT, 5, value_coded="Positive")] * 2)
    rows = lab.load_lab_tests(w).collect()
    assert sorted(r.lab_test_id for r in rows) == [1, 2, 3, 4, 5, 6]
    assert {r.lab_test_id for r in rows if r.test_type == "Viral Load"} == {r.lab_test_id for r in lab.load_lab_tests_vl(w).collect()} == {1, 2, 3, 4}


def test_dense_ids_number_a_whole_table_in_order(spark):
    from pyspark.sql import functions as F
    from kalulu.operators.ids import dense_ids
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 37 % 101).alias("a"), F.when(F.col("id") % 3 > 0, F.lit("hot")).alias("b"))
    rows = dense_ids(df, "n", ["b", "a"]).collect()
    assert sorted(r.n for r in rows) == list(range(1, 5001))
    by_id = [(r.b or "", r.a) for r in sorted(rows, key=lambda r: r.n)]
    assert by_id == sorted(by_id)
    assert dense_ids(df.where("false"), "n", ["a"]).collect() == []


def test_spelling_of_regimens_and_places(spark):
    w = wh(spark, omrs_encounter=[enc(1, 7, "art_followup ", place="NENO district hospital")],
           omrs_obs=[obs(1, "malawi antiretroviral drugs RECEIVED ", value_coded="5a: tdf / 3tc / efv ")])
    r = art.load_art_followup(w).first()
    assert (r.location, r.art_regimen, r.art_drugs_received) == (K.FACILITIES[0], "5A: TDF / 3TC / EFV", "5A: TDF / 3TC / EFV")


def test_every_mapped_column_is_loaded(spark):
    """The 114 inputs of the column map: each output column stands in a declared table."""
    from oracle import values as V
    tables = {"ART_VIRAL_LOAD": "mw_art_viral_load", "FOLLOWUP_TESTING": "mw_art_followup_testing", "ART_FOLLOWUP": "mw_art_followup",
              "ART_INITIAL": "mw_art_initial", "ART_VISITS": "mw_art_visits", "EID_FOLLOWUP": "mw_eid_followup", "EID_INITIAL": "mw_eid_initial",
              "EID_LAB_TESTS": "mw_eid_lab_tests", "EID_VISITS": "mw_eid_visits", "PRE_ART_VISITS": "mw_pre_art_visits"}
    for spec, table in tables.items():
        declared = {n for n, _ in WAREHOUSE[table]}
        assert {e[0] for e in getattr(V, spec)} <= declared, table
        # and comes from the same concept, value and encounter type in the library
        mine = {tuple(e[:4]) + ((e[4],) if len(e) > 4 else (None,)) for e in getattr(C, spec, [])}
        if spec == "ART_VIRAL_LOAD":
            mine.add((*C.ART_VIRAL_LOAD_ANCHOR, None))
        if spec == "FOLLOWUP_TESTING":
            mine.add((*C.FOLLOWUP_TESTING_REQUIRED, None))
        assert mine == set(getattr(V, spec)), spec
    assert len(V.ART_INITIAL) == 36 and set(LOADERS) == set(WAREHOUSE)


def test_faulty_rows_go_to_the_rejects_with_their_reasons(spark):
    from pyspark.sql import functions as F
    columns = "patient_id bigint, visit_date date, location string, cd4_count string, cd4_pct decimal(16,4)"
    rows = [(1, D(2000, 1, 1), "x", "abc", None), (2, D(2000, 1, 1), "x", "7", Decimal("2.5")), (None, D(2000, 1, 1), "y", "8", None),
            (3, None, "z" * 256, "9", None), (4, None, None, None, Decimal("3"))]
    df = spark.createDataFrame(rows, columns)
    for n, t in WAREHOUSE["mw_art_followup_testing"]:
        if n not in df.columns:
            df = df.withColumn(n, F.lit(None).cast(t))
    checked = validated(df, "mw_art_followup_testing")
    table = accepted(checked).orderBy("patient_id").collect()
    assert [(r.patient_id, r.cd4_count, r.cd4_pct) for r in table] == [(1, None, None), (2, 7, 2), (4, None, 3)]
    assert [f.dataType for f in accepted(checked).schema] == [f.dataType for f in struct_type("mw_art_followup_testing")]
    bad = sorted((r.faults, r.kept) for r in rejects(checked).collect())
    assert bad == [(["fraction: cd4_pct"], True), (["length: location"], False), (["null: patient_id"], False), (["type: cd4_count"], True)]
    assert any(json.loads(r.row).get("cd4_count") == "abc" for r in rejects(checked).collect())
    with pytest.raises(ValueError):
        validated(df.drop("test_type"), "mw_art_followup_testing")
    assert [r.cd4_count for r in conform(df, "mw_art_followup_testing").where("patient_id < 3").orderBy("patient_id").collect()] == [None, 7]


def test_a_batch_is_committed_once_and_whole(spark, tmp_path, monkeypatch):
    from kalulu.plans import refresh
    from kalulu.sources.commit import CommittedWarehouse, Commits
    names = ["mw_art_visits", "mw_lab_tests", "mw_art_register", "mw_patient"]
    state = {"program_state_id": 1, "program_enrollment_id": 4, "patient_id": 7, "program": K.HIV_PROGRAM, "workflow": K.TREATMENT_WORKFLOW,
             "state": K.ON_ART, "location": K.FACILITIES[0], "start_date": D(2000, 1, 1)}

    def source(patient):
        return Tables(spark, omrs_encounter=[enc(1, patient, K.ART_INITIAL), enc(2, patient, K.ART_FOLLOWUP, D(2000, 2, 2))],
                      omrs_obs=[obs(1, C.VL_RESULT, value_numeric=100)] * 2, omrs_program_state=[state | {"patient_id": patient}],
                      omrs_program_enrollment=[{"program_enrollment_id": 4, "patient_id": patient}])
    read = lambda: CommittedWarehouse(spark, str(tmp_path))
    assert read().mw_art_visits.count() == 0 and read().version == 0
    assert refresh.commit_batch(source(7), str(tmp_path), "day 1", names)
    assert not refresh.commit_batch(source(7), str(tmp_path), "day 1", names)                # run again: nothing is added
    assert read().mw_art_visits.count() == 2 and read().batches == ["day 1"]
    assert refresh.commit_batch(source(8), str(tmp_path), "day 2", names)
    now = read()
    assert sorted(r.art_visit_id for r in now.mw_art_visits.collect()) == [1, 2, 3, 4]       # ids go on
    assert sorted(r.lab_test_id for r in now.mw_lab_tests.collect()) == [1, 2, 3, 4]
    visits = {(r.patient_id, r.visit_date): r.art_visit_id for r in now.mw_art_visits.collect()}
    assert {r.patient_id: r.last_art_visit_id for r in now.mw_art_register.collect()} == {p: visits[p, D(2000, 2, 2)] for p in (7, 8)}

    # a run that dies between its tables leaves the old state
    def broken(_):
        raise RuntimeError("lost")
    log, old = Commits(spark, str(tmp_path)), now.mw_art_visits.count()
    with pytest.raises(RuntimeError):
        log.commit("day 3", {"mw_art_visits": now.mw_art_visits, "mw_lab_tests": lambda: broken(0)})
    assert read().version == 2 and read().mw_art_visits.count() == old
    monkeypatch.setitem(refresh.LOADERS, "mw_lab_tests", broken)
    with pytest.raises(RuntimeError):
        refresh.commit_batch(source(9), str(tmp_path), "day 3", names)
    assert read().batches == ["day 1", "day 2"]
    monkeypatch.undo()
    assert refresh.commit_batch(source(9), str(tmp_path), "day 3", names) and read().mw_art_visits.count() == 6
    assert refresh.commit_batch(source(9), str(tmp_path), "anew", names, replace=True) and read().mw_art_visits.count() == 2
    assert now.mw_art_visits.count() == 4                                                    # an open reader keeps its state


@pytest.mark.parametrize("mode,times", [("overwrite", 1), ("append", 2)])
def test_append_and_overwrite(spark, tmp_path, mode, times):
    from kalulu.plans.refresh import refresh_warehouse
    w = Tables(spark, omrs_encounter=[enc(1, 7, K.ART_INITIAL)])
    for _ in range(2):
        refresh_warehouse(w, str(tmp_path), ["mw_art_visits"], mode=mode)
    assert spark.read.parquet(f"{tmp_path}/mw_art_visits").count() == times
