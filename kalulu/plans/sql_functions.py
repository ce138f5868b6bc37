"""The lookups and reports as functions that are called in SQL.

    register_functions(wh)                                # temporary, over any warehouse
    register_functions(BucketedWarehouse(spark, "mw"))    # kept in the database, over its tables

    select * from latest_test_result('HIV test', null, null, 0)
    select * from tx_mmd(date'2000-06-30', 60) where location = 'Neno District Hospital'

Every function is one ``create function`` statement: a body of joins and
aggregates that Spark puts into the calling query, so constant arguments and the
caller's filters reach the scans and the plan is that of the set-based query
(nothing runs per row).  A null bound is no bound.
"""

from __future__ import annotations

from kalulu import constants as K
from kalulu.functions.sqltext import quoted
from kalulu.operators.bands import age_case, age_labels
from kalulu.operators.counts import WEIGHTED, group_label, report_dimension
from kalulu.params import _PAD_BY_DAY
from kalulu.plans.cohort import COHORT_COLUMNS, TPT_COLS
from kalulu.plans.loaders import concepts as C
from kalulu.sources.bucketed import BucketedWarehouse

#: tables that the functions read
TABLES = ["mw_lab_tests", "mw_art_regimen", "mw_eid_visits", "mw_patient", "mw_art_followup", "mw_art_initial", "omrs_program_state",
          "omrs_patient_identifier", "lookup_location"]

_RESULT = "coalesce(cast(result_numeric as string), result_coded, result_exception) is not null"


def _tests(at: str, date: str, with_result: bool, since: str | None, until: str | None) -> str:
    terms = ["test_type = of_type", *([_RESULT] if with_result else []), *([f"({since} is null or {date} >= {since})"] if since else []),
             *([f"({until} is null or {date} <= {until})"] if until else [])]
    return f"(select patient_id, {date}, lab_test_id from {at}mw_lab_tests where {' and '.join(terms)})"


def _nth_latest(rows: str, columns: list[str]) -> str:
    """The (skip + 1)-th newest row per patient, nulls last; a row's rank is limited in each task before the shuffle."""
    by = ", ".join(f"{c} desc nulls last" for c in columns)
    return (f"select patient_id, {', '.join(columns)} from (select *, row_number() over (partition by patient_id order by {by}) as nth from {rows}) "
            "where nth = skip + 1")


def _outcome(at: str) -> str:
    """Newest HIV-programme state per patient and facility with start on or before ``as_of``."""
    return f"""select patient_id, location, r.state, r.program, r.program_state_id, r.start_date, r.end_date
        from (select patient_id, location, max(struct(start_date, program_state_id, state, program, end_date)) as r
              from {at}omrs_program_state where program = {quoted(K.HIV_PROGRAM)} and start_date <= as_of group by patient_id, location)
        where location in (select target_value from {at}lookup_location)"""


def _numbers(at: str) -> str:
    return f"select patient_id, identifier, location from {at}omrs_patient_identifier where type = {quoted(K.ARV_NUMBER)}"


def _cohort_steps(at: str, since: str) -> str:
    """Steps up to ``cohort``: the distinct cohort rows of ``plans.cohort.hiv_cohort``."""
    tpt = "(" + " or ".join(f"{c} is not null" for c in TPT_COLS) + ")"
    dates = {"latest": "max(visit_date)", "last": "max(in_period)", "first": "min(in_period)", "previous": "max(before_period)"}
    fields = {"latest": ["visit_date", "next_appointment_date", "art_regimen", "pregnant_or_lactating", "systolic_bp", "diastolic_bp"],
              **{k: ["visit_date", *TPT_COLS] for k in ("last", "previous", "first")}}
    names = {"latest": "followup_visit_date, last_appt_date, current_regimen, pregnant_or_lactating, systolic_bp, diastolic_bp",
             **{k: ", ".join([f"{k}_ipt_date", *[f"{k}_{c}" for c in TPT_COLS]]) for k in ("last", "previous", "first")}}
    packed = ", ".join(f"collect_list(if(visit_date = d_{k}, struct({', '.join(f)}), null)) as v_{k}" for k, f in fields.items())
    on_a_date = " or ".join(f"visit_date = d_{k}" for k in fields)
    views = "\n".join(f"lateral view outer inline(v_{k}) i_{k} as {n}" for k, n in names.items())
    return f"""seen as (select *, if(visit_date between {since} and as_of and {tpt}, visit_date, null) as in_period,
                    if(visit_date <= date_sub({since}, 1) and {tpt}, visit_date, null) as before_period
             from {at}mw_art_followup where visit_date <= as_of),
    dates as (select patient_id, {', '.join(f'{v} as d_{k}' for k, v in dates.items())} from seen group by patient_id),
    packed as (select patient_id, {packed} from seen join dates using (patient_id) where {on_a_date} group by patient_id),
    begun as (select patient_id, visit_date as initial_visit_date, pregnant_or_lactating as initial_pregnant_or_lactating, transfer_in_date
              from {at}mw_art_initial join (select patient_id, max(visit_date) as visit_date from {at}mw_art_initial
                                            where visit_date <= as_of group by patient_id) using (patient_id, visit_date)),
    numbers as ({_numbers(at)}),
    held as (select patient_id, identifier, location, state, start_date, gender, birthdate
             from numbers join ({_outcome(at)}) using (patient_id, location) join (select patient_id, gender, birthdate from {at}mw_patient) using (patient_id)),
    snapshots as (select * from held left join packed using (patient_id) {views}),
    cohort as (select distinct {', '.join(COHORT_COLUMNS)} from (
        select snapshots.*, begun.* except (patient_id),
               cast(floor(datediff(if(state = {quoted(K.ON_ART)}, as_of, start_date), birthdate) / {K.BIRTHDATE_DIVIDER}) as int) as age
        from snapshots left join begun using (patient_id)))"""


def _counted(at: str, rows: str, indicators: dict[str, str], groups: dict[str, str]) -> str:
    """Detail and group rows of ``rows`` in one aggregate, as ``operators.counts.report_counts``."""
    slots = ", ".join([
        "named_struct('band', band, 'sex', case gender when 'F' then 'Female' when 'M' then 'Male' end, 'n', 1L)",
        *[f"named_struct('band', 'All', 'sex', {label}, 'n', cast({n} as bigint))" for label, n in groups.items()]])
    tests = ", ".join(f"{p} as p_{n}" for n, p in indicators.items())
    sums = ", ".join(f"sum(if(p_{n}, n, 0L)) as {n}" for n in indicators)
    filled = ", ".join(f"coalesce(c.{n}, 0L) as {n}" for n in indicators)
    return f"""select d.location, d.sort_value, d.age_group, d.gender, {filled}
        from (select target_value as location, inline(array({report_dimension(tuple(age_labels()), 'age_group')})) from {at}lookup_location) d
        left join (select location, band, sex, {sums}
                   from (select location, {', '.join(f'p_{n}' for n in indicators)}, inline(array({slots}))
                         from (select *, {tests}, if(gender in ('M', 'F'), {age_case('age')}, null) as band from {rows}))
                   where band is not null and sex is not null and n > 0 group by location, band, sex) c
        on c.location = d.location and c.band = d.age_group and c.sex = d.gender"""


_REPORT = "location string, sort_value int, age_group string, gender string"
_ACTIVE = f"state = {quoted(K.ON_ART)} and datediff(as_of, last_appt_date) <= cutoff"
_WEIGHTS = ", ".join(f"count_if({group_label('gender', 'pregnant_or_lactating')} = '{g}') as w_{g}" for g in K.GROUPS)


def _types(columns: dict[str, str] | list[str], kind: str = "bigint") -> str:
    return ", ".join(f"{c} {kind}" for c in columns)


def _cohort_disaggregated(at: str) -> tuple[str, str, str]:
    ind = {"tx_curr": _ACTIVE, **{f"`{code}`": f"{_ACTIVE} and current_regimen = {quoted(text)}" for code, text in K.REGIMENS}}
    plain = {n.strip("`"): p for n, p in ind.items()}
    names = {n: f"i{k}" for k, n in enumerate(plain)}
    body = _counted(at, "cohort", {names[n]: p for n, p in plain.items()}, {group_label("gender", "pregnant_or_lactating"): "1"})
    out = ", ".join(f"{names[n]} as `{n}`" for n in plain)
    return ("since date, as_of date, cutoff int", f"{_REPORT}, {_types([f'`{n}`' for n in plain])}",
            f"with {_cohort_steps(at, 'since')} select location, sort_value, age_group, gender, {out} from ({body})")


def _tx_mmd(at: str) -> tuple[str, str, str]:
    arms = " ".join(f"when {day} then date_add(as_of, {pad - 90})" for day, pad in _PAD_BY_DAY.items())
    since = f"case day(as_of) {arms} else as_of end"
    ind = {"less_than_three_months": f"days < {K.MMD_LOW_DAYS}", "three_to_five_months": f"days between {K.MMD_LOW_DAYS} and {K.MMD_HIGH_DAYS}",
           "six_months_plus": f"days > {K.MMD_HIGH_DAYS}"}
    rows = f"""(select * from (select patient_id, datediff(next_appointment_date, visit_date) as days
                 from seen join (select patient_id, d_latest as visit_date from dates) using (patient_id, visit_date)
                 where datediff(as_of, next_appointment_date) <= cutoff)
        join (select patient_id, location, gender, age, {_WEIGHTS} from cohort where state = {quoted(K.ON_ART)}
              group by patient_id, location, gender, age) using (patient_id))"""
    return "as_of date, cutoff int", f"{_REPORT}, {_types(ind)}", f"with {_cohort_steps(at, since)} {_counted(at, rows, ind, WEIGHTED)}"


def _tx_hiv_htn(at: str) -> tuple[str, str, str]:
    arms = " ".join(f"when {day} then date_add(add_months(as_of, -6), {pad})" for day, pad in _PAD_BY_DAY.items())
    since = f"case day(as_of) {arms} else as_of end"
    high = f"(systolic_bp >= {K.HTN_SYSTOLIC} or diastolic_bp >= {K.HTN_DIASTOLIC})"
    seen = f"followup_visit_date between {since} and as_of and only_here"
    ind = {
        "tx_curr": _ACTIVE, "diagnosed_htn": f"{high} and only_here",
        "screened_for_htn": f"{seen} and coalesce(systolic_bp, diastolic_bp) is not null",
        "newly_diagnosed": f"initial_visit_date between {since} and as_of and transfer_in_date is null and only_here and {high}",
        "controlled_htn": f"{seen} and systolic_bp < {K.HTN_SYSTOLIC} and diastolic_bp < {K.HTN_DIASTOLIC}",
    }
    own = ("patient_id, identifier, state, start_date, gender, age, location, last_appt_date, current_regimen, pregnant_or_lactating, "
           "initial_pregnant_or_lactating, followup_visit_date, initial_visit_date, transfer_in_date, systolic_bp, diastolic_bp")
    rows = f"""(select * from (select {own}, {_WEIGHTS} from cohort group by {own})
        join (select patient_id, count(distinct location) = 1 as only_here from numbers group by patient_id) using (patient_id))"""
    return "as_of date, cutoff int", f"{_REPORT}, {_types(ind)}", f"with {_cohort_steps(at, since)} {_counted(at, rows, ind, WEIGHTED)}"


def table_functions(at: str = "") -> dict[str, tuple[str, str, str]]:
    """name -> (parameters, columns returned, body); ``at`` is put before table names."""
    invalid = (f"select patient_id, max(visit_date) as last_invalid from {at}mw_eid_visits where breastfeeding_status <> {quoted(C.BREASTFEEDING_STOPPED)} "
               "and visit_date <= as_of group by patient_id")
    regimens = f"(select patient_id, regimen_init_date, num_of_prev_regimens, regimen from {at}mw_art_regimen)"
    cohort_types = {**dict.fromkeys(COHORT_COLUMNS, "string"), "patient_id": "bigint", "age": "int", "systolic_bp": "int", "diastolic_bp": "int",
                    **{c: "date" for c in COHORT_COLUMNS if c.endswith("_date")}, **{c: "decimal(10,2)" for c in COHORT_COLUMNS if c.endswith("_pills")}}
    return {
        "latest_test_result": ("of_type string, since date, until date, skip int", "patient_id bigint, date_result_entered date, lab_test_id bigint",
                               _nth_latest(_tests(at, "date_result_entered", True, "since", "until"), ["date_result_entered", "lab_test_id"])),
        "first_test_result": ("of_type string, until date", "patient_id bigint, date_result_entered date, lab_test_id bigint",
                              "select patient_id, r.* from (select patient_id, min(struct(date_result_entered, lab_test_id)) as r from "
                              f"{_tests(at, 'date_result_entered', True, None, 'until')} group by patient_id)"),
        "latest_test_by_sample_date": ("of_type string, since date, until date, skip int", "patient_id bigint, date_collected date, lab_test_id bigint",
                                       _nth_latest(_tests(at, "date_collected", False, "since", "until"), ["date_collected", "lab_test_id"])),
        "regimen_line": ("skip int", "patient_id bigint, regimen string, regimen_start date",
                         f"select patient_id, regimen, regimen_init_date from ({_nth_latest(regimens, ['regimen_init_date', 'num_of_prev_regimens', 'regimen'])})"),
        "first_date_no_breastfeeding": (
            "as_of date", "patient_id bigint, first_date_no_breastfeeding date",
            f"select patient_id, min(visit_date) from {at}mw_eid_visits left join ({invalid}) using (patient_id) "
            f"where breastfeeding_status = {quoted(C.BREASTFEEDING_STOPPED)} and (last_invalid is null or (visit_date <= as_of and visit_date <= last_invalid)) "
            "group by patient_id"),
        "last_outcome_at_facility": (
            "as_of date", "patient_id bigint, identifier string, state string, program string, program_state_id bigint, start_date date, end_date date, location string",
            f"select patient_id, identifier, state, program, program_state_id, start_date, end_date, location from ({_outcome(at)}) join ({_numbers(at)}) using (patient_id, location)"),
        "hiv_cohort": ("since date, as_of date", ", ".join(f"{c} {t}" for c, t in cohort_types.items()),
                       f"with {_cohort_steps(at, 'since')} select {', '.join(COHORT_COLUMNS)} from cohort"),
        "cohort_disaggregated": _cohort_disaggregated(at),
        "tx_mmd": _tx_mmd(at),
        "tx_hiv_htn": _tx_hiv_htn(at),
    }


def scalar_functions() -> dict[str, tuple[str, str, str]]:
    parents = " ".join(f"when {quoted(clinic.rstrip())} then {quoted(parent)}" for clinic, parent in K.OUTREACH_PARENT)
    return {
        "parent_health_facility": ("place string", "string", f"case rtrim(place) {parents} else place end"),
        "formatted_identifier": ("number string", "string", "array_join(transform(split(number, ' '), "
                                 "x -> if(x rlike '^[0-9]' and length(x) < 4, lpad(x, 4, '0'), x)), '-')"),
    }


def register_functions(wh) -> list[str]:
    """Make the functions callable in SQL and return their names.

    Over a :class:`BucketedWarehouse` they are kept in its database (call them
    after ``use database``) for those tables that it has; over any other warehouse
    they are temporary, and its tables become temporary views of their names.
    """
    spark = wh.spark
    kept = isinstance(wh, BucketedWarehouse)
    at, make = (f"`{wh.database}`.", "create or replace function") if kept else ("", "create or replace temporary function")
    if kept:
        there = {t.name for t in spark.catalog.listTables(wh.database) if not t.isTemporary}
    else:
        there = set(TABLES)
        for name in TABLES:
            getattr(wh, name).createOrReplaceTempView(name)
    done = []
    for name, (given, columns, body) in table_functions(at).items():
        if any(f"{at}{t}" in body and t not in there for t in TABLES):
            continue
        spark.sql(f"{make} {at}{name}({given}) returns table({columns}) return {body}")
        done.append(name)
    for name, (given, kind, body) in scalar_functions().items():
        spark.sql(f"{make} {at}{name}({given}) returns {kind} return {body}")
        done.append(name)
    return done
