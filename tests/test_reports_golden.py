"""Golden edge cases on hand-made rows (thresholds +-1, ties, fan-outs).

A ``TableWarehouse`` serves hand-made DataFrames in the warehouse schemas, so
each case checks the report semantics directly, independent of the oracle SQL.
"""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql.types import StructField, StructType

from kalulu import constants as K
from kalulu.sources.fixtures import Warehouse
from kalulu.sources.normalise import NormalisedWarehouse

D = dt.date
END = D(2000, 6, 30)
START = D(2000, 4, 1)
F0 = K.FACILITIES[0]
F1 = K.FACILITIES[1]

TABLES = ["mw_patient", "omrs_program_state", "omrs_patient_identifier", "mw_art_followup", "mw_art_initial",
          "mw_art_viral_load", "mw_art_visits", "mw_art_followup_testing"]


class TableWarehouse:
    """A warehouse whose tables are given DataFrames."""

    def __init__(self, spark, tables):
        self.spark = spark
        self.__dict__.update(tables)
        self.lookup_location = Warehouse(spark, "").lookup_location


@pytest.fixture(scope="module")
def schemas(spark):
    ref = Warehouse(spark, "/root/testdata/sf0.001")
    return {t: StructType([StructField(f.name, f.dataType) for f in getattr(ref, t).schema]) for t in TABLES}


def make(spark, schemas, **rows):
    tables = {}
    for t in TABLES:
        sch = schemas[t]
        data = [tuple(r.get(f.name) for f in sch.fields) for r in rows.get(t, [])]
        tables[t] = spark.createDataFrame(data, sch)
    return NormalisedWarehouse(TableWarehouse(spark, tables))


def patient(pid, gender="F", age_days=10000):
    return {"patient_id": pid, "gender": gender, "birthdate": END - dt.timedelta(days=age_days),
            "birthdate_estimated": False, "dead": False}


def state(pid, sid, st=K.ON_ART, loc=F0, start=D(2000, 1, 1)):
    return {"program_state_id": sid, "program_enrollment_id": pid, "patient_id": pid, "program": "HIV program",
            "workflow": "Treatment status", "state": st, "location": loc, "start_date": start}


def arv(pid, ident, loc=F0, typ="ARV Number"):
    return {"patient_identifier_id": hash((pid, ident)) % 100000, "patient_id": pid, "type": typ,
            "identifier": ident, "location": loc, "date_created": D(1999, 1, 1)}


def fu(pid, visit, appt, **kw):
    return {"patient_id": pid, "visit_date": visit, "location": F0, "next_appointment_date": appt, **kw}


def _row(df, age_group, gender, location=F0):
    return [r for r in df.collect() if r.location == location and r.age_group == age_group
            and r.gender == gender][0]


def test_mmd_thresholds_ties_and_cutoff(spark, schemas):
    from kalulu.plans.reports.mmd import tx_mmd

    v = D(2000, 6, 1)
    wh = make(spark, schemas,
              mw_patient=[patient(i) for i in range(1, 8)],
              omrs_program_state=[state(i, i) for i in range(1, 8)],
              omrs_patient_identifier=[arv(i, f"NNO {i}") for i in range(1, 8)],
              mw_art_followup=[
                  fu(1, v, v + dt.timedelta(days=79)),    # < 3 months
                  fu(2, v, v + dt.timedelta(days=80)),    # 3-5
                  fu(3, D(2000, 1, 1), D(2000, 6, 17)),   # 168 days -> 3-5
                  fu(4, D(2000, 1, 1), D(2000, 6, 18)),   # 169 days -> 6+
                  fu(5, v, END - dt.timedelta(days=60)),  # appointment exactly at cutoff: active (9 days -> <3)
                  fu(6, v, END - dt.timedelta(days=61)),  # one day late: not counted
                  fu(7, v, v + dt.timedelta(days=10)), fu(7, v, v + dt.timedelta(days=11)),  # tie: counted twice
              ])
    out = tx_mmd(wh, END, cutoff=60)
    r = _row(out, "25-29 years", "Female")
    assert (r.less_than_three_months, r.three_to_five_months, r.six_months_plus) == (4, 2, 1)


def test_cohort_infants_two_numbers_and_groups(spark, schemas):
    from kalulu.plans.reports.cohort_disaggregated import cohort_disaggregated

    text_5a = dict(K.REGIMENS)["5A"]
    v = D(2000, 6, 1)
    wh = make(spark, schemas,
              mw_patient=[patient(1, "F", 359), patient(2, "M", 360), patient(3, "F", 10000)],
              omrs_program_state=[state(1, 1), state(2, 2), state(3, 3)],
              omrs_patient_identifier=[arv(1, "NNO 1"), arv(2, "NNO 2"), arv(3, "NNO 3"), arv(3, "NNO 3 2")],
              mw_art_followup=[fu(1, v, v, art_regimen=text_5a), fu(2, v, v, art_regimen=text_5a),
                               fu(3, v, v, art_regimen=text_5a, pregnant_or_lactating=K.PREGNANT)])
    out = cohort_disaggregated(wh, START, END, cutoff=60)
    assert _row(out, "<1 year", "Female").tx_curr == 1      # 11 months: infant band, counted
    assert _row(out, "1-4 years", "Male").tx_curr == 1      # 12 months
    r3 = _row(out, "25-29 years", "Female")
    assert r3.tx_curr == 2 and r3["5A"] == 2                # two ARV Numbers: counted per number
    assert _row(out, "All", "FP").tx_curr == 2
    assert _row(out, "All", "Male").tx_curr == 1


def test_tx_new_number_elsewhere_and_transfer_in(spark, schemas):
    from kalulu.plans.reports.tx_new import tx_new

    ini = D(2000, 5, 1)
    wh = make(spark, schemas,
              mw_patient=[patient(i) for i in (1, 2, 3)],
              omrs_program_state=[state(i, i, start=ini) for i in (1, 2, 3)],
              omrs_patient_identifier=[arv(1, "NNO 1"), arv(2, "NNO 2"), arv(2, "ALT 2", loc=F1), arv(3, "NNO 3")],
              mw_art_initial=[{"patient_id": 1, "visit_date": ini, "location": F0, "cd4_count": 150},
                              {"patient_id": 2, "visit_date": ini, "location": F0, "cd4_count": 150},
                              {"patient_id": 3, "visit_date": ini, "location": F0, "cd4_count": 500,
                               "transfer_in_date": ini}])
    r = _row(tx_new(wh, START, END), "25-29 years", "Female")
    assert r.tx_new_cd4_less_than_two_hundred == 1          # patient 2 has a number elsewhere
    assert r.tx_new_cd4_equal_to_or_greater_than_two_hundred == 0  # patient 3 is a transfer-in
    assert r.transfer_ins == 1


def test_pvls_thresholds(spark, schemas):
    from kalulu.plans.reports.viral_load import tx_pvls

    test, visit = D(1999, 3, 1), D(1999, 6, 1)
    appt = D(2000, 3, 2)  # > 365 days after the test, inside [year start, end]
    vls = [(1, 999), (2, 1000), (3, 1001)]
    wh = make(spark, schemas,
              mw_patient=[patient(i) for i, _ in vls],
              omrs_program_state=[state(i, i) for i, _ in vls],
              omrs_patient_identifier=[arv(i, f"NNO {i}") for i, _ in vls],
              mw_art_followup=[fu(i, visit, appt) for i, _ in vls],
              mw_art_viral_load=[{"patient_id": i, "visit_date": test, "location": F0, "reason_for_test": "Routine",
                                  "viral_load_result": v} for i, v in vls])
    r = _row(tx_pvls(wh, END), "25-29 years", "Female")
    assert (r.routine_samples_drawn, r.routine_low_vl_less_than_1000_copies,
            r.routine_high_vl_more_than_1000_copies) == (3, 1, 1)   # exactly 1000 is neither


def test_htn_thresholds(spark, schemas):
    from kalulu.plans.reports.screening import tx_hiv_htn

    v = D(2000, 6, 1)
    bps = [(1, 140, 89), (2, 139, 90), (3, 139, 89), (4, None, None)]
    wh = make(spark, schemas,
              mw_patient=[patient(i) for i, *_ in bps],
              omrs_program_state=[state(i, i) for i, *_ in bps],
              omrs_patient_identifier=[arv(i, f"NNO {i}") for i, *_ in bps],
              mw_art_followup=[fu(i, v, v, systolic_bp=s, diastolic_bp=d_) for i, s, d_ in bps])
    r = _row(tx_hiv_htn(wh, END), "25-29 years", "Female")
    assert (r.diagnosed_htn, r.controlled_htn, r.screened_for_htn) == (2, 1, 3)


def test_tx_ml_iit_exactly_90_days_counts_in_two_buckets(spark, schemas):
    from kalulu.plans.reports.tx_ml import tx_ml

    appt = D(2000, 5, 1)  # end - appt = 60 >= 30: interrupted
    wh = make(spark, schemas,
              mw_patient=[patient(1)],
              omrs_program_state=[state(1, 1)],
              omrs_patient_identifier=[arv(1, "NNO 1")],
              mw_art_followup=[fu(1, D(2000, 4, 1), appt)],
              mw_art_initial=[{"patient_id": 1, "visit_date": appt + dt.timedelta(days=30 - 90), "location": F0}])
    r = _row(tx_ml(wh, START, END, cutoff=30), "25-29 years", "Female")
    assert (r.IIT_3mo_or_less_mo, r.IIT_3to5_mo, r.IIT_6plus_mo) == (1, 1, 0)


def test_tb_prev_completion_thresholds(spark, schemas):
    from kalulu.plans.reports.tpt import tb_prev

    ini = D(2000, 2, 1)  # initiated after the six-month start (2000-01-01): "new"

    def tpt(pid, visit, **kw):
        return fu(pid, visit, visit + dt.timedelta(days=28), **kw)

    wh = make(spark, schemas,
              mw_patient=[patient(i) for i in (1, 2, 3, 4)],
              omrs_program_state=[state(i, i, start=D(1999, 1, 1)) for i in (1, 2, 3, 4)],
              omrs_patient_identifier=[arv(i, f"NNO {i}") for i in (1, 2, 3, 4)],
              mw_art_initial=[{"patient_id": i, "visit_date": ini, "location": F0} for i in (1, 2, 3, 4)],
              mw_art_followup=[
                  tpt(1, D(2000, 3, 1), inh_300="Isoniazid", rfp_150="Rifapentine", rfp_150_pills=Decimal(20)),
                  tpt(1, D(2000, 4, 1), rfp_inh="3HP (Rifapentine and Isoniazid)", rfp_inh_pills=Decimal(13)),  # 33
                  tpt(2, D(2000, 3, 1), inh_300="Isoniazid", rfp_150="Rifapentine", rfp_150_pills=Decimal(32)),  # 32
                  tpt(3, D(2000, 3, 1), inh_300="Isoniazid", inh_300_pills=Decimal(144)),                        # 144
                  tpt(4, D(2000, 3, 1), inh_300="Isoniazid", inh_300_pills=Decimal(143)),                        # 143
              ])
    r = _row(tb_prev(wh, END), "25-29 years", "Female")
    assert r.new_start_three_hp == 2 and r.new_start_six_h == 2
    assert r.completed_new_start_three_hp == 1 and r.completed_new_start_six_h == 1


def test_weight_bands_rounding(spark, schemas):
    from decimal import Decimal

    from kalulu.plans.reports.viral_load import regimen_by_weight

    text_5a = dict(K.REGIMENS)["5A"]
    v = D(2000, 6, 1)
    ws = [(1, "2.4"), (2, "2.5"), (3, "3.49"), (4, "3.5"), (5, "49.5"), (6, None)]
    wh = make(spark, schemas,
              mw_patient=[patient(i) for i, _ in ws],
              omrs_program_state=[state(i, i) for i, _ in ws],
              omrs_patient_identifier=[arv(i, f"NNO {i}") for i, _ in ws],
              mw_art_followup=[fu(i, v, v, art_regimen=text_5a, weight=Decimal(w) if w else None) for i, w in ws])
    out = {r.weight_group: r["5A"] for r in regimen_by_weight(wh, END).collect()
           if r.location == F0 and r.gender == "Female"}
    assert out["3 - 3.9 Kg"] == 2 and out["4 - 4.9 Kg"] == 1 and out["50 Kg +"] == 1 and out["Unknown"] == 1
    assert sum(out.values()) == 5  # 2.4 rounds to 2: no band, not counted


def test_switch_at_outreach_clinic_uses_parent_number(spark, schemas):
    from kalulu.plans.reports.regimen_switch import regimen_switch

    a, b = dict(K.REGIMENS)["5A"], dict(K.REGIMENS)["13A"]
    before, first = D(2000, 3, 10), D(2000, 4, 5)
    visits = [{"art_visit_id": 1, "patient_id": 1, "visit_date": before, "location": "Midzemba HC"},
              {"art_visit_id": 2, "patient_id": 1, "visit_date": first, "location": "Kasamba Outreach Clinic"}]
    wh = make(spark, schemas,
              mw_patient=[patient(1)],
              omrs_patient_identifier=[arv(1, "NNO 1", loc="Midzemba HC")],
              mw_art_visits=visits,
              mw_art_initial=[{"patient_id": 1, "visit_date": D(1998, 1, 1), "location": "Midzemba HC"}],
              mw_art_followup=[
                  {"patient_id": 1, "visit_date": before, "location": "Midzemba HC", "art_regimen": a, "arvs_given": 60},
                  {"patient_id": 1, "visit_date": first, "location": "Kasamba Outreach Clinic", "art_regimen": b,
                   "arvs_given": 90}])
    rows = regimen_switch(wh, START).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.previous_regimen, r.current_regimen, r.report_location, r.dispense_date) == \
        ("5A", "13A", "Midzemba HC", "05-Apr-00")
    assert r.arvs == " TDF / 3TC / DTG (90)"


def test_followup_loader_pairs_pills_by_obs_group(spark):
    from decimal import Decimal as Dec

    from kalulu.plans.loaders.art import load_art_followup
    from kalulu.plans.loaders.lab import load_lab_tests_vl

    ref = Warehouse(spark, "/root/testdata/sf0.001")
    from pyspark.sql.types import StructField, StructType

    def nullable(sch):
        return StructType([StructField(f.name, f.dataType, True) for f in sch.fields])

    enc_s, obs_s = nullable(ref.omrs_encounter.schema), nullable(ref.omrs_obs.schema)
    v = D(2000, 5, 1)
    enc = [(10, 1, v, K.ART_FOLLOWUP, F0), (11, 1, v, "Viral Load Screening", F0)]
    obs = [  # (encounter, group, concept, obs_date, coded, numeric, date, text, created)
        (10, 100, "HIV Preventive Therapy", v, "Isoniazid", None, None, None, v),
        (10, 100, "Amount Dispensed", v, None, Dec(56), None, None, v),
        (10, 200, "HIV Preventive Therapy", v, "Rifapentine", None, None, None, v),
        (10, 200, "Amount Dispensed", v, None, Dec(12), None, None, v),
        (10, 300, "Malawi ART side effects", v, "Skin rash", None, None, None, v),
        (10, 301, "Weight (kg)", v, None, Dec("61.5"), None, None, v),
        (11, 400, "Less than limit", v, None, Dec(40), None, None, D(2000, 5, 9)),
        (11, 401, "HIV viral load", v, None, Dec(35), None, None, D(2000, 5, 9)),
    ]
    wh = TableWarehouse(spark, {"omrs_encounter": spark.createDataFrame(enc, enc_s),
                                "omrs_obs": spark.createDataFrame(obs, obs_s)})
    r = load_art_followup(wh).collect()
    assert len(r) == 1
    r = r[0]
    assert (r.inh_300, float(r.inh_300_pills), r.rfp_150, float(r.rfp_150_pills)) == ("Isoniazid", 56.0, "Rifapentine", 12.0)
    assert (r.skin_rash_side_effect, r.hepatitis_side_effect, r.no_side_effect) == ("Skin rash", None, None) and float(r.weight) == 61.5
    lab = load_lab_tests_vl(wh).collect()
    assert len(lab) == 1 and lab[0].result_exception == "<40.0000" and float(lab[0].result_numeric) == 35.0


def test_optional_switches(spark, schemas):
    from kalulu.plans.cohort import last_outcome_at_facility
    from kalulu.plans.functions_queries import first_date_no_breastfeeding
    from kalulu.plans.loaders.concepts import BREASTFEEDING_STOPPED

    wh = make(spark, schemas, mw_patient=[patient(1)], omrs_program_state=[state(1, 1)],
              omrs_patient_identifier=[arv(1, "NNO 1"), arv(1, "NNO 1 2")])
    assert last_outcome_at_facility(wh, END).count() == 2
    assert last_outcome_at_facility(wh, END, dedupe=True).count() == 1
    visits = spark.createDataFrame(
        [(1, D(2000, 1, 1), BREASTFEEDING_STOPPED), (1, D(2000, 2, 1), "Breastfeeding"),
         (1, D(2000, 3, 1), BREASTFEEDING_STOPPED)], "patient_id long, visit_date date, breastfeeding_status string")
    as_coded = first_date_no_breastfeeding(visits, END).first()[1]
    as_documented = first_date_no_breastfeeding(visits, END, after_invalid=True).first()[1]
    assert (as_coded, as_documented) == (D(2000, 1, 1), D(2000, 3, 1))


def test_group_rows_count_cohort_rows_by_weight(spark, schemas):
    """Tied follow-up rows of two pregnancy statuses and two ARV Numbers: a dispensing row counts once for its band
    and once per cohort row for the groups; so does a screening row."""
    from kalulu.plans.reports.cohort_disaggregated import cohort_disaggregated
    from kalulu.plans.reports.mmd import tx_mmd
    from kalulu.plans.reports.screening import tx_hiv_htn

    seen = {"patient_id": 1, "visit_date": D(2000, 6, 1), "location": F0, "next_appointment_date": D(2000, 7, 1),
            "systolic_bp": 150, "diastolic_bp": 80}
    wh = make(spark, schemas, mw_patient=[patient(1), patient(2, gender=None)], omrs_program_state=[state(1, 1), state(2, 2)],
              omrs_patient_identifier=[arv(1, "NNO 1"), arv(1, "NNO 1 2"), arv(2, "NNO 2")],
              mw_art_followup=[{**seen, "pregnant_or_lactating": K.PREGNANT}, {**seen, "pregnant_or_lactating": K.BREASTFEEDING},
                               {**seen, "patient_id": 2, "pregnant_or_lactating": None}])

    def counts(report, column):
        rows = [r for r in report.collect() if r.location == F0]
        assert [r.sort_value for r in rows] == list(range(1, 45))
        return sum(r[column] for r in rows[:40]), {r.gender: r[column] for r in rows[40:]}

    # two tied visits x (detail: patient; groups: two numbers x one cohort row of the status each), the patient without a sex nowhere
    assert counts(tx_mmd(wh, END), "less_than_three_months") == (2, {"Male": 0, "FP": 4, "FNP": 0, "FBF": 4})
    assert counts(cohort_disaggregated(wh, START, END), "tx_curr") == (4, {"Male": 0, "FP": 2, "FNP": 0, "FBF": 2})
    assert counts(tx_hiv_htn(wh, END), "diagnosed_htn") == (4, {"Male": 0, "FP": 2, "FNP": 0, "FBF": 2})


def test_regimens_outside_the_dictionary_differ_whatever_their_case(spark, schemas):
    from kalulu.plans.reports.regimen_switch import regimen_switch

    before, first = D(2000, 3, 10), D(2000, 4, 5)

    def switches(old, new):
        row = {"patient_id": 1, "location": F0, "arvs_given": 60}
        wh = make(spark, schemas, mw_patient=[patient(1)], omrs_patient_identifier=[arv(1, "NNO 1")],
                  mw_art_visits=[{"art_visit_id": i, "patient_id": 1, "visit_date": d, "location": F0} for i, d in ((1, before), (2, first))],
                  mw_art_initial=[{"patient_id": 1, "visit_date": D(1998, 1, 1), "location": F0}],
                  mw_art_followup=[{**row, "visit_date": before, "art_regimen": old}, {**row, "visit_date": first, "art_regimen": new}])
        return [(r.previous_regimen, r.current_regimen) for r in regimen_switch(wh, START).collect()]

    assert switches("99X: New / Drug", "99x: new / DRUG ") == []
    assert switches("99X: New / Drug", "98X: New / Drug") == [("99X", "98X")]
    assert switches("99X: New / Drug", None) == []
