"""

Every report is one statement over all facilities; ``replace`` puts loaded
tables in the place of the projected ones.
"""

from __future__ import annotations

import datetime as dt

from oracle import values as V
from oracle.blocks import (Steps, by_band, by_group, day, months, period_from, quoted, same, shifted,
                           weight_label)


def _on_art(column: str = "state") -> str:
    return same(column, "On antiretrovirals")


def _days(since: str, until: str) -> str:
    return f"date_diff('day', {since}, {until})"


def _within(column: str, start: dt.date, end: dt.date) -> str:
    return f"({column} >= {day(start)} AND {column} <= {day(end)})"


ONLY_HERE = "(patient_id, location) IN (SELECT (patient_id, location) FROM settled)"


def _active(end: dt.date, cutoff: int) -> str:
    return f"({_on_art()} AND {_days('last_appt_date', day(end))} <= {cutoff})"


def _both(q: Steps, rows: str, indicators: dict, groups: str | None = None, **kw) -> str:
    return q.select(f"{by_band(rows, indicators)}\nUNION ALL\n{by_group(groups or rows, indicators, **kw)}")


def tx_mmd_sql(end: dt.date, cutoff: int, replace=None) -> str:
    q = Steps(replace)
    start = period_from(end, days=90)
    v, o, c = q.latest_visits(end), q.outcome(end), q.cohort(start, end)
    q.add("rows", f"""
        SELECT v.patient_id, a.location, p.gender, {months('p.birthdate', day(end))} AS age,
               {_days('v.visit_date', 'v.next_appointment_date')} AS supply
        FROM {v} v JOIN mw_patient p USING (patient_id)
        JOIN (SELECT DISTINCT patient_id, location FROM {o} WHERE {_on_art()}) a ON a.patient_id = v.patient_id
        WHERE {_days('v.next_appointment_date', day(end))} <= {cutoff}""")
    q.add("grouped", f"""SELECT r.patient_id, r.location, r.age, r.supply, c.gender, c.pregnant_or_lactating
                         FROM rows r JOIN {c} c USING (patient_id, location)""")
    return _both(q, "rows", {"less_than_three_months": "supply < 80", "three_to_five_months": "supply >= 80 AND supply <= 168",
                             "six_months_plus": "supply > 168"}, "grouped")


def cohort_disaggregated_sql(start: dt.date, end: dt.date, cutoff: int, replace=None) -> str:
    q = Steps(replace)
    c, active = q.cohort(start, end), _active(end, cutoff)
    ind = {"tx_curr": active} | {code: f"{active} AND {same('current_regimen', text)}" for code, text in V.REGIMENS}
    return _both(q, c, ind)


def tx_new_sql(start: dt.date, end: dt.date, replace=None) -> str:
    q = Steps(replace)
    o, i, c = q.outcome(end), q.latest_visits(end, "mw_art_initial"), q.cohort(start, end)
    until = f"CASE WHEN {_on_art('o.state')} THEN {day(end)} ELSE o.start_date END"
    q.add("rows", f"""
        SELECT DISTINCT o.*, p.gender, {months('p.birthdate', until)} AS age, i.visit_date AS initial_visit_date,
               i.transfer_in_date, i.cd4_count
        FROM {o} o JOIN mw_patient p USING (patient_id) LEFT JOIN {i} i USING (patient_id)""")
    q.add("grouped", f"""
        SELECT c.patient_id, c.location, c.gender, c.pregnant_or_lactating, c.initial_visit_date, i.transfer_in_date, i.cd4_count
        FROM {c} c JOIN mw_art_initial i USING (patient_id)""")
    here = f"{_within('initial_visit_date', start, end)} AND {ONLY_HERE}"
    new = f"transfer_in_date IS NULL AND {here}"
    return _both(q, "rows", {
        "tx_new_cd4_less_than_two_hundred": f"cd4_count < 200 AND {new}",
        "tx_new_cd4_equal_to_or_greater_than_two_hundred": f"cd4_count >= 200 AND {new}",
        "tx_new_cd4_equal_unknown_or_not_done": f"cd4_count IS NULL AND {new}",
        "transfer_ins": f"transfer_in_date IS NOT NULL AND {here}"}, "grouped")


THREE_HP = "(first_rfp_inh IS NOT NULL OR (first_inh_300 IS NOT NULL AND first_rfp_150 IS NOT NULL))"
SIX_H = "(first_inh_300 IS NOT NULL AND first_rfp_150 IS NULL)"


def _started(since: dt.date) -> str:
    return f"(start_date >= {day(since)} OR (initial_visit_date >= {day(since)} AND transfer_in_date IS NULL))"


def tpt_initiation_sql(start: dt.date, end: dt.date) -> str:
    q = Steps()
    c = q.cohort(start, end)
    q.add("rows", f"""SELECT * FROM {c} WHERE first_ipt_date >= {day(start)}
                      AND coalesce(first_inh_300, first_rfp_150, first_rfp_inh) IS NOT NULL""")
    before = f"initial_visit_date < {day(start)} AND previous_ipt_date <"
    ind = {
        "new_start_three_hp": f"{_started(start)} AND {THREE_HP}",
        "previous_start_three_hp": f"{before} {day(shifted(start, -1))} AND {THREE_HP}",
        "new_start_six_h": f"{_started(start)} AND {SIX_H}",
        "previous_start_six_h": f"{before} {day(shifted(start, -2))} AND {SIX_H}",
    }
    return q.select(f"SELECT *, 'Neno' AS district FROM ({by_band('rows', ind)}\nUNION ALL\n{by_group(c, ind)}) t")


def tb_prev_sql(end: dt.date) -> str:
    q = Steps()
    six, seven, thirteen = (period_from(end, months=m) for m in (6, 7, 13))
    c, now = q.cohort(six, end), q.cohort(period_from(end, days=90), end)
    q.add("pills", f"""
        SELECT patient_id, sum(inh_300_pills) FILTER (WHERE visit_date >= {day(thirteen)}) AS isoniazid,
               sum(rfp_150_pills) FILTER (WHERE visit_date >= {day(seven)}) AS rifapentine,
               sum(rfp_inh_pills) FILTER (WHERE visit_date >= {day(seven)}) AS combined
        FROM mw_art_followup WHERE visit_date <= {day(end)} GROUP BY patient_id""")
    q.add("rows", f"""SELECT c.*, s.isoniazid, coalesce(s.rifapentine, 0) + coalesce(s.combined, 0) AS weekly
                      FROM (SELECT DISTINCT * EXCLUDE (systolic_bp, diastolic_bp) FROM {c}) c LEFT JOIN pills s USING (patient_id)
                      WHERE c.first_ipt_date >= {day(six)}""")
    q.add("grouped", f"""SELECT r.* EXCLUDE (gender, pregnant_or_lactating), n.gender, n.pregnant_or_lactating
                         FROM rows r JOIN {now} n ON n.patient_id = r.patient_id AND n.location = r.location""")
    new, old = _started(six), f"initial_visit_date < {day(six)}"
    return _both(q, "rows", {
        "new_start_three_hp": f"{new} AND {THREE_HP}", "new_start_six_h": f"{new} AND {SIX_H}",
        "previous_start_three_hp": f"{old} AND {THREE_HP}", "previous_start_six_h": f"{old} AND {SIX_H}",
        "completed_new_start_three_hp": f"{new} AND weekly >= 33", "completed_new_start_six_h": f"{new} AND isoniazid >= 144",
        "completed_old_three_hp": f"{old} AND weekly >= 33", "completed_old_six_h": f"{old} AND isoniazid >= 144"}, "grouped")


def _new_here(start: dt.date, end: dt.date) -> str:
    return f"({_within('initial_visit_date', start, end)} AND transfer_in_date IS NULL AND {ONLY_HERE})"


def tx_tb_sql(end: dt.date, cutoff: int) -> str:
    q = Steps()
    start = period_from(end, days=90)
    c, o = q.cohort(start, end, extra="v.tb_status,"), q.outcome(end)
    q.add("rows", f"""
        SELECT DISTINCT c.patient_id, c.identifier, o.program, c.state, c.start_date, o.program_state_id, c.gender, c.age,
               c.location, c.last_appt_date, c.followup_visit_date, c.initial_visit_date, c.transfer_in_date, c.tb_status
        FROM {c} c JOIN {o} o USING (patient_id, location)""")
    is_ = [same("tb_status", s) for s in V.TB_STATUSES]
    new, old = _new_here(start, end), f"initial_visit_date < {day(start)}"
    return _both(q, "rows", {
        "tx_curr": _active(end, cutoff), "symptom_screen_alone": "(" + " OR ".join(is_) + ")",
        "cxr_screen": "FALSE", "mwrd_screen": "FALSE",
        "screened_for_tb_tx_new_pos": f"{is_[0]} AND {new}", "screened_for_tb_tx_new_neg": f"{is_[1]} AND {new}",
        "screened_for_tb_tx_prev_pos": f"{is_[0]} AND {old}", "screened_for_tb_tx_prev_neg": f"{is_[1]} AND {old}",
        "tb_rx_new": f"{is_[2]} AND {new}", "tb_rx_prev": f"{is_[3]} AND {old}"}, c)


def tx_hiv_htn_sql(end: dt.date, cutoff: int) -> str:
    q = Steps()
    start = period_from(end, months=6)
    c, o = q.cohort(start, end), q.outcome(end)
    q.add("rows", f"""
        SELECT DISTINCT c.patient_id, c.identifier, o.program, c.state, c.start_date, o.program_state_id, c.gender, c.age,
               c.location, c.last_appt_date, c.current_regimen, c.pregnant_or_lactating, c.initial_pregnant_or_lactating,
               c.followup_visit_date, c.initial_visit_date, c.transfer_in_date, c.systolic_bp, c.diastolic_bp
        FROM {c} c JOIN {o} o USING (patient_id, location)""")
    high = "(systolic_bp >= 140 OR diastolic_bp >= 90)"
    seen = f"{_within('followup_visit_date', start, end)} AND {ONLY_HERE}"
    return _both(q, "rows", {
        "tx_curr": _active(end, cutoff), "diagnosed_htn": f"{high} AND {ONLY_HERE}",
        "screened_for_htn": f"{seen} AND coalesce(systolic_bp, diastolic_bp) IS NOT NULL",
        "newly_diagnosed": f"{high} AND {_new_here(start, end)}",
        "controlled_htn": f"{seen} AND systolic_bp < 140 AND diastolic_bp < 90"}, c)


def tx_ml_sql(start: dt.date, end: dt.date, cutoff: int) -> str:
    q = Steps()
    c = q.cohort(start, end)
    q.add("gaps", f"""
        SELECT k.patient_id, k.last_appt_date, list({_days('i.visit_date', f'k.last_appt_date + {cutoff}')}) AS gap
        FROM (SELECT DISTINCT patient_id, last_appt_date FROM {c}) k JOIN mw_art_initial i USING (patient_id) GROUP BY ALL""")
    q.add("members", f"SELECT c.*, g.gap FROM {c} c LEFT JOIN gaps g USING (patient_id, last_appt_date)")
    q.add("rows", """SELECT DISTINCT patient_id, identifier, state, start_date, gender, age, location, last_appt_date, gap
                     FROM members""")
    during = _within("start_date", start, end)
    lost = (f"(({same('state', 'Patient defaulted')} AND {during}) OR "
            f"({_on_art()} AND {_days('last_appt_date', day(end))} >= {cutoff}))")
    some = "coalesce(len(list_filter(gap, lambda x: {})), 0) > 0"
    return _both(q, "rows", {
        "Died": f"{same('state', 'Patient died')} AND {during}",
        "IIT_3mo_or_less_mo": f"{lost} AND {some.format('x <= 90')}",
        "IIT_3to5_mo": f"{lost} AND {some.format('x >= 90 AND x < 180')}",
        "IIT_6plus_mo": f"{lost} AND {some.format('x >= 180')}",
        "Transferred_out": f"{same('state', 'Patient transferred out')} AND {during}",
        "Refused_Stopped": f"{same('state', 'Treatment stopped')} AND {during}"}, "members")


def tx_pvls_sql(end: dt.date) -> str:
    q = Steps()
    year = period_from(end, months=12)
    t, v, o = q.latest_visits(year, "mw_art_viral_load"), q.latest_visits(year), q.outcome(end)
    c = q.cohort(year, end)
    routine, target = same("reason_for_test", "Routine"), same("reason_for_test", "Target")
    q.add("rows", f"""
        SELECT t.patient_id, t.location, p.gender, {months('p.birthdate', day(end))} AS age, o.state, t.reason_for_test,
               t.viral_load_result, t.less_than_limit, t.ldl, {_days('t.visit_date', 'v.next_appointment_date')} AS test_age
        FROM {t} t JOIN {v} v USING (patient_id) JOIN mw_patient p USING (patient_id) JOIN numbers n USING (patient_id)
        LEFT JOIN {o} o ON o.patient_id = t.patient_id AND o.location = t.location
        WHERE ({routine} OR {target}) AND {_within('v.next_appointment_date', year, end)}
          AND {_days('t.visit_date', 'v.next_appointment_date')} > 365""")
    q.add("grouped", f"""SELECT r.* EXCLUDE (gender), c.gender, c.pregnant_or_lactating
                         FROM rows r JOIN {c} c ON c.patient_id = r.patient_id AND c.location = r.location""")
    low = f"(viral_load_result < 1000 OR less_than_limit < 1000 OR {same('ldl', 'True')})"
    high = "(viral_load_result > 1000 OR less_than_limit > 1000)"
    return _both(q, "rows", {
        "tx_curr": _on_art(), "due_for_vl": "test_age > 365", "routine_samples_drawn": routine, "target_samples_drawn": target,
        "routine_low_vl_less_than_1000_copies": f"{routine} AND {low}",
        "routine_high_vl_more_than_1000_copies": f"{routine} AND {high}",
        "targeted_low_vl_less_than_1000_copies": f"{target} AND {low}",
        "targeted_high_vl_more_than_1000_copies": f"{target} AND {high}"}, "grouped")


def _whole_months(a: str, b: str) -> str:
    """Completed months from a to b; negative when b lies before a."""
    gap = f"(12 * (year({b}) - year({a})) + month({b}) - month({a}))"
    return f"({gap} - CASE WHEN {b} >= {a} THEN CAST(day({b}) < day({a}) AS INTEGER) ELSE -CAST(day({b}) > day({a}) AS INTEGER) END)"


def tx_rtt_sql(start: dt.date, end: dt.date, cutoff: int) -> str:
    q = Steps()
    before, after, v = q.outcome(start, strict=True), q.outcome(end), q.latest_visits(end)
    q.add("last_planned", f"SELECT patient_id, max(next_appointment_date) AS planned FROM mw_art_visits WHERE visit_date < {day(start)} GROUP BY 1")
    q.add("first_seen", f"""SELECT patient_id, visit_date FROM mw_art_followup WHERE {_within('visit_date', start, end)}
                            QUALIFY visit_date = min(visit_date) OVER (PARTITION BY patient_id)""")
    q.add("returned", f"""
        SELECT a.patient_id, a.location, f.visit_date AS back, t.cd4_count
        FROM {after} a JOIN {v} v USING (patient_id) JOIN first_seen f USING (patient_id)
        LEFT JOIN mw_art_followup_testing t ON t.patient_id = a.patient_id AND t.visit_date = f.visit_date
        WHERE {_on_art('a.state')} AND {_within('a.start_date', start, end)}
          AND {_days('v.next_appointment_date', day(end))} < {cutoff}""")
    q.add("absent", f"""
        SELECT n.patient_id, n.location, b.state, l.planned
        FROM (SELECT patient_id, location, state FROM {before}) b JOIN numbers n USING (patient_id, location)
        LEFT JOIN last_planned l ON l.patient_id = n.patient_id
        WHERE {same('b.state', 'Patient defaulted')} OR {same('b.state', 'Treatment stopped')}
           OR ({_on_art('b.state')} AND {_days('l.planned', day(start - dt.timedelta(days=1)))} > {cutoff})""")
    q.add("rows", f"""
        SELECT a.location, p.gender, {months('p.birthdate', day(end))} AS age, r.cd4_count AS cd4,
               {_whole_months('(a.planned + 28)', 'r.back')} AS away
        FROM absent a JOIN returned r USING (patient_id, location) JOIN mw_patient p USING (patient_id)""")
    return q.select(by_band("rows", {
        "cd4_less_than_two_hundred": "away IS NOT NULL AND cd4 < 200",
        "cd4_equal_to_or_greater_than_two_hundred": "away >= 3 AND away <= 5 AND cd4 >= 200",
        "cd4_unknown_or_not_done": "away IS NOT NULL AND cd4 IS NULL", "not_eligible_for_cd4": "FALSE",
        "returned_less_than_three_months": "away < 3", "returned_three_to_five_months": "away >= 3 AND away <= 5",
        "returned_six_months_plus": "away >= 6"}))


def _code(column: str) -> str:
    return f"split_part({column}, ':', 1)"


def _name(column: str) -> str:
    return f"string_split({column}, ':')[-1]"


def _sex(column: str) -> str:
    return f"CASE {column} WHEN 'F' THEN 'Female' ELSE 'Male' END"


def _dispensed(q: Steps, end: dt.date, cutoff: int) -> str:
    v, o = q.latest_visits(end), q.outcome(end)
    q.add("known_weight", """SELECT patient_id, max({'d': visit_date, 'w': weight}).w AS weight FROM mw_art_followup
                             WHERE weight IS NOT NULL GROUP BY patient_id""")
    return q.add("dispensed", f"""
        SELECT n.identifier, n.location, p.gender, p.birthdate, v.patient_id, v.visit_date, v.art_regimen, v.arvs_given,
               coalesce(v.weight, k.weight) AS weight
        FROM {v} v JOIN mw_patient p USING (patient_id)
        JOIN (SELECT DISTINCT patient_id, location FROM {o} WHERE {_on_art()}) a ON a.patient_id = v.patient_id
        JOIN numbers n ON n.patient_id = a.patient_id AND n.location = a.location
        LEFT JOIN known_weight k ON k.patient_id = v.patient_id
        WHERE {_days('v.next_appointment_date', day(end))} <= {cutoff}""")


def regimen_dispensation_sql(end: dt.date, cutoff: int) -> str:
    q = Steps()
    d, t = _dispensed(q, end, cutoff), q.latest_visits(end, "mw_art_viral_load")
    return q.select(f"""
        SELECT d.identifier, {_sex('d.gender')} AS gender, d.birthdate AS dob, i.visit_date AS art_start_date, d.weight,
               {_code('d.art_regimen')} AS art_regimen, {_name('d.art_regimen')} || '(' || d.arvs_given || ')' AS arvs_given,
               d.visit_date AS dispense_date, d.location,
               coalesce(CASE WHEN t.ldl IS NOT NULL THEN 'LDL' END, t.other_results, CAST(t.viral_load_result AS VARCHAR),
                        CAST(t.less_than_limit AS VARCHAR)) AS vl_result, t.visit_date AS date_of_vl_result
        FROM {d} d JOIN mw_art_initial i USING (patient_id) LEFT JOIN {t} t USING (patient_id)""")


def regimen_by_weight_sql(end: dt.date, cutoff: int) -> str:
    q = Steps()
    d = _dispensed(q, end, cutoff)
    ind = {code: same("art_regimen", text) for code, text in V.REGIMENS + V.WEIGHT_REGIMENS[:1]}
    return q.select(by_band(d, ind, weight_label(), V.WEIGHT_LABELS, "weight_group"))


def regimen_switch_sql(start: dt.date) -> str:
    q = Steps()
    parent = "CASE " + " ".join(f"WHEN {same('n.location', c)} THEN {quoted(V.FACILITIES[p])}" for c, p in V.PARENTS) + " ELSE n.location END"
    firsts = ", ".join(f"({day(shifted(start, k))}, {day(shifted(start, k + 1))})" for k in range(3))
    q.add("spans", f"SELECT * FROM (VALUES {firsts}) s(first_day, next_first)")
    q.add("turns", """
        SELECT s.first_day, v.patient_id, max(v.visit_date) FILTER (WHERE v.visit_date < s.first_day) AS before,
               min(v.visit_date) FILTER (WHERE v.visit_date >= s.first_day AND v.visit_date < s.next_first) AS seen
        FROM spans s, mw_art_visits v GROUP BY ALL""")
    q.add("switches", f"""
        SELECT t.patient_id, o.art_regimen AS old, n.art_regimen AS new, n.visit_date, n.arvs_given, n.location, n.weight,
               {parent} AS home
        FROM turns t JOIN mw_art_followup o ON o.patient_id = t.patient_id AND o.visit_date = t.before
        JOIN mw_art_followup n ON n.patient_id = t.patient_id AND n.visit_date = t.seen
        WHERE lower(rtrim(o.art_regimen)) <> lower(rtrim(n.art_regimen))""")
    label = "strftime({}, '%d-%b-%y')"
    return q.select(f"""
        SELECT m.identifier, {_sex('p.gender')} AS gender, {label.format('p.birthdate')} AS dob,
               {label.format('i.visit_date')} AS art_start_date, CAST(s.weight AS DECIMAL(12,0)) AS weight,
               {_code('s.old')} AS previous_regimen, {_code('s.new')} AS current_regimen,
               {label.format('s.visit_date')} AS dispense_date, {_name('s.new')} || ' (' || s.arvs_given || ')' AS arvs,
               s.arvs_given, s.location, s.home AS report_location
        FROM switches s JOIN numbers m ON m.patient_id = s.patient_id AND m.location = s.home
        JOIN mw_patient p ON p.patient_id = s.patient_id JOIN mw_art_initial i ON i.patient_id = s.patient_id""")


def survival_sql(start: dt.date, end: dt.date, age_limit: int, subgroup: str, option_b: bool, cutoff: int = 60,
                 as_of: dt.date | None = None) -> str:
    q = Steps()
    years = ", ".join(f"({day(shifted(start, -12 * i))}, {day(shifted(end, -12 * i))})" for i in range(21))
    q.add("years", f"SELECT * FROM (VALUES {years}) y(a, z)")
    q.add("registered", "SELECT DISTINCT y.a, y.z, i.patient_id FROM years y JOIN mw_art_initial i ON i.visit_date BETWEEN y.a AND y.z")
    q.add("states", f"""
        SELECT r.z, s.patient_id, s.location, max({{'d': s.start_date, 'i': s.program_state_id, 'state': s.state}}) AS top
        FROM registered r JOIN omrs_program_state s ON s.patient_id = r.patient_id AND s.start_date <= r.z
        WHERE {same('s.program', 'HIV program')} GROUP BY ALL""")
    q.add("seen", """
        SELECT r.z, f.patient_id, f.next_appointment_date AS planned
        FROM registered r JOIN mw_art_followup f ON f.patient_id = r.patient_id AND f.visit_date <= r.z
        QUALIFY f.visit_date = max(f.visit_date) OVER (PARTITION BY r.z, f.patient_id)""")
    only = ""
    if option_b:
        feeding = " OR ".join(same("i.pregnant_or_lactating", x) for x in V.PREGNANCY[:2])
        only = f"AND ({feeding}) AND r.patient_id IN (SELECT patient_id FROM numbers GROUP BY 1 HAVING count(*) = 1)"
    q.add("rows", f"""
        SELECT n.location, r.z, s.top.state AS state, s.top.d BETWEEN r.a AND r.z AS during, v.planned,
               {_days('v.planned', 'r.z')} AS overdue
        FROM registered r JOIN states s ON s.z = r.z AND s.patient_id = r.patient_id
        JOIN numbers n ON n.patient_id = s.patient_id AND n.location = s.location
        JOIN lookup_location l ON l.target_value = n.location
        JOIN seen v ON v.z = r.z AND v.patient_id = r.patient_id
        JOIN mw_art_initial i ON i.patient_id = r.patient_id JOIN mw_patient p ON p.patient_id = r.patient_id
        WHERE i.transfer_in_date IS NULL AND floor({_days('p.birthdate', 'r.z')} / 365) <= {age_limit} {only}""")
    q.add("counted", f"""
        SELECT location, z, count(*) FILTER (WHERE {_on_art()} AND overdue <= {cutoff}) AS alive,
               count(*) FILTER (WHERE during AND {same('state', 'Patient died')}) AS died,
               count(*) FILTER (WHERE (during AND {same('state', 'Patient defaulted')})
                                OR ({_on_art()} AND (planned IS NULL OR overdue > {cutoff}))) AS defaulted,
               count(*) FILTER (WHERE during AND {same('state', 'Treatment stopped')}) AS stopped,
               count(*) FILTER (WHERE during AND {same('state', 'Patient transferred out')}) AS moved
        FROM rows GROUP BY ALL""")
    filled = {n: f"coalesce(c.{n}, 0)" for n in ("alive", "died", "defaulted", "stopped", "moved")}
    return q.select(f"""
        SELECT l.target_value AS location, year(y.z) AS reporting_year, quarter(y.z) AS reporting_quarter,
               'Q' || {(end.month + 2) // 3} || ' ' || year(y.z) AS reg_cohort,
               ({(as_of or end).year} - year(y.z)) * 12 AS interval_year, {quoted(subgroup)} AS subgroup,
               {' + '.join(filled.values())} AS total_reg_database, {filled['alive']} AS alive, {filled['died']} AS died,
               {filled['defaulted']} AS defaulted, {filled['stopped']} AS stopped, {filled['moved']} AS "to", 0 AS unknown
        FROM lookup_location l CROSS JOIN years y LEFT JOIN counted c ON c.location = l.target_value AND c.z = y.z
        WHERE year(y.z) > coalesce((SELECT min(year(visit_date)) FROM mw_art_initial i WHERE i.location = l.target_value), 0)""")
