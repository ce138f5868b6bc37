"""Oracle SQL of the warehouse loaders: per-concept inputs LEFT JOINed to the spine."""

from __future__ import annotations

from oracle import values as V
from oracle.fixtures_sql import quoted, with_fixtures

_q = quoted

OBS = """(SELECT o.*, e.patient_id, e.encounter_date AS visit_date, e.location, e.encounter_type,
                 g.concept AS group_concept
          FROM omrs_obs o JOIN omrs_encounter e ON e.encounter_id = o.encounter_id
          LEFT JOIN omrs_obs_group g ON g.obs_group_id = o.obs_group_id)"""
KEYS = "patient_id, visit_date, location"


def _spine(types):
    return (f"(SELECT DISTINCT patient_id, encounter_date AS visit_date, location FROM omrs_encounter "
            f"WHERE encounter_type IN ({', '.join(_q(t) for t in types)}))")


def _concept_inputs(spec):
    """One grouped input per concept (the shape of the source: one SQL per column)."""
    joins, cols = [], []
    for i, (col, concept, kind, etype, group) in enumerate(spec):
        flt = f" AND encounter_type = {_q(etype)}" if etype else ""
        if group:
            flt += f" AND group_concept = {_q(group)}"
        joins.append(f"LEFT JOIN (SELECT {KEYS}, MIN({kind}) AS v FROM {OBS} x WHERE concept = {_q(concept)}{flt} "
                     f"GROUP BY {KEYS}) c{i} ON c{i}.patient_id = s.patient_id AND c{i}.visit_date = s.visit_date "
                     f"AND c{i}.location = s.location")
        cols.append(f"c{i}.v AS {col}")
    return joins, cols


def art_followup_sql() -> str:
    joins, cols = _concept_inputs(V.ART_FOLLOWUP)
    for j, (col, drug) in enumerate(V.DRUGS):
        joins.append(f"""LEFT JOIN (SELECT d.patient_id, d.visit_date, d.location, MIN(d.value_coded) AS v,
                                  MIN(p.value_numeric) AS pills
                           FROM {OBS} d LEFT JOIN (SELECT obs_group_id, value_numeric FROM {OBS} y
                                                  WHERE concept = {_q(V.PILLS_CONCEPT)}
                                                    AND encounter_type = 'ART_FOLLOWUP') p
                             ON p.obs_group_id = d.obs_group_id
                           WHERE d.concept = {_q(V.DRUG_CONCEPT)} AND d.value_coded = {_q(drug)}
                           GROUP BY d.patient_id, d.visit_date, d.location) t{j}
                   ON t{j}.patient_id = s.patient_id AND t{j}.visit_date = s.visit_date AND t{j}.location = s.location""")
        cols += [f"t{j}.v AS {col}", f"t{j}.pills AS {col}_pills"]
    for j, (col, value) in enumerate(V.SIDE_EFFECTS):
        joins.append(f"""LEFT JOIN (SELECT DISTINCT {KEYS} FROM {OBS} z WHERE concept = {_q(V.SIDE_EFFECT_CONCEPT)}
                                  AND value_coded = {_q(value)}) se{j}
                   ON se{j}.patient_id = s.patient_id AND se{j}.visit_date = s.visit_date AND se{j}.location = s.location""")
        cols.append(f"CASE WHEN se{j}.patient_id IS NOT NULL THEN {_q(value)} END AS {col}")
    body = f"SELECT s.patient_id, s.visit_date, s.location, {', '.join(cols)} FROM {_spine(["ART_FOLLOWUP"])} s\n" + \
        "\n".join(joins)
    return with_fixtures(body)


def _simple(spec, types) -> str:
    joins, cols = _concept_inputs(spec)
    body = f"SELECT s.patient_id, s.visit_date, s.location, {', '.join(cols)} FROM {_spine(types)} s\n" + \
        "\n".join(joins)
    return with_fixtures(body)


def art_initial_sql() -> str:
    return _simple(V.ART_INITIAL, ["ART_INITIAL"])


def row_id(*columns: str) -> str:
    """1, 2, ... in the order of the natural key."""
    return f"row_number() OVER (ORDER BY {', '.join(f'{c} NULLS FIRST' for c in columns)})"


def _visit_rows(spec, types, name: str) -> str:
    joins, cols = _concept_inputs(spec)
    return (f"SELECT {row_id('s.patient_id', 's.visit_date', 's.location')} AS {name}, s.patient_id, s.visit_date, "
            f"s.location, {', '.join(cols)} FROM {_spine(types)} s\n" + "\n".join(joins))


def _art_visit_rows() -> str:
    return _visit_rows(V.ART_VISITS, ["ART_INITIAL", "ART_FOLLOWUP"], "art_visit_id")


def _eid_visit_rows() -> str:
    return _visit_rows(V.EID_VISITS, ["EXPOSED_CHILD_INITIAL", "EXPOSED_CHILD_FOLLOWUP"], "eid_visit_id")


def art_visits_sql() -> str:
    return with_fixtures(_art_visit_rows())


LAB = ["patient_id", "encounter_id", "date_collected", "test_type", "date_result_received", "date_result_entered",
       "result_coded", "result_numeric", "result_exception"]


def _vl_rows() -> str:
    """Four inputs of all observations, matched per encounter; what has no match stays."""
    def kind(name, concept, true=False):
        only = " AND o.value_coded = 'True'" if true else ""
        return (f"(SELECT e.patient_id, o.encounter_id, o.obs_date AS {name}d, o.date_created AS {name}e, o.value_numeric AS {name}v "
                f"FROM omrs_obs o JOIN omrs_encounter e USING (encounter_id) WHERE o.concept = {_q(concept)}{only})")
    on = "USING (patient_id, encounter_id)"
    rows = f"""SELECT patient_id, encounter_id, coalesce(sd, ld, td, rd) AS date_collected, 'Viral Load' AS test_type,
                      CAST(NULL AS DATE) AS date_result_received, coalesce(le, te, re) AS date_result_entered,
                      CAST(NULL AS VARCHAR) AS result_coded, CAST(rv AS DECIMAL(10,2)) AS result_numeric,
                      CASE WHEN ld IS NOT NULL THEN 'Lower than Detection Limit' ELSE '<' || CAST(tv AS VARCHAR) END AS result_exception
               FROM {kind('s', 'Sample taken for Viral Load', True)} s
               FULL JOIN {kind('l', 'Lower than Detection Limit', True)} l {on}
               FULL JOIN {kind('t', 'Less than limit')} t {on} FULL JOIN {kind('r', 'HIV viral load')} r {on}"""
    return f"SELECT {row_id(*LAB)} AS lab_test_id, {', '.join(LAB)} FROM ({rows}) x"


def _hiv_rows() -> str:
    """Constructs, all results and sample dates matched per patient and group; then type and date received."""
    def of(concept, cols):
        return (f"(SELECT e.patient_id, o.obs_group_id, {cols} FROM omrs_obs o JOIN omrs_encounter e USING (encounter_id) "
                f"WHERE o.concept = {_q(concept)})")
    on = "USING (patient_id, obs_group_id)"
    groups = f"(SELECT obs_group_id, encounter_id FROM omrs_obs_group WHERE concept = {_q(V.SEROLOGY)})"
    rows = f"""SELECT patient_id, obs_group_id, encounter_id, coalesce(sampled, encounter_date) AS date_collected,
                      coalesce(kind, 'HIV test') AS test_type, received AS date_result_received, entered AS date_result_entered,
                      result AS result_coded, CAST(NULL AS DECIMAL(10,2)) AS result_numeric, CAST(NULL AS VARCHAR) AS result_exception
               FROM (SELECT e.patient_id, g.obs_group_id, g.encounter_id, e.encounter_date
                     FROM {groups} g JOIN omrs_encounter e USING (encounter_id)) c
               FULL JOIN {of('Result of HIV test', 'o.value_coded AS result, o.date_created AS entered')} r {on}
               FULL JOIN (SELECT * FROM {of('Date of blood sample', 'o.value_date AS sampled')} a
                          WHERE obs_group_id IN (SELECT obs_group_id FROM {groups} g2)) s {on}
               LEFT JOIN {of('HIV test type', 'o.value_coded AS kind')} t {on}
               LEFT JOIN {of('Date of returned result', 'o.value_date AS received')} d {on}"""
    return f"SELECT {row_id(*LAB, 'obs_group_id')} AS lab_test_id, {', '.join(LAB)} FROM ({rows}) x"


def lab_tests_vl_sql() -> str:
    return with_fixtures(_vl_rows())


def lab_tests_hiv_sql() -> str:
    return with_fixtures(_hiv_rows())


def lab_tests_sql() -> str:
    return with_fixtures(_lab_rows())


def _lab_rows() -> str:
    """Viral loads first, then HIV tests, numbered on."""
    return (f"{_vl_rows()}\nUNION ALL\nSELECT lab_test_id + (SELECT count(*) FROM ({_vl_rows()}) v) AS lab_test_id, "
            f"{', '.join(LAB)} FROM ({_hiv_rows()}) h")


HAS_RESULT = "coalesce(result_coded, CAST(result_numeric AS VARCHAR), result_exception) IS NOT NULL"


def test_lookup_sql(date: str, test_type: str, with_result: bool, offset: int = 0, newest: bool = True, bounds=(None, None)) -> str:
    where = [f"test_type = {_q(test_type)}"] + [HAS_RESULT] * with_result
    where += [f"{date} {op} DATE '{b}'" for op, b in zip((">=", "<="), bounds) if b]
    order = f"{date} DESC NULLS LAST, lab_test_id DESC" if newest else f"{date} ASC NULLS FIRST, lab_test_id"
    return with_fixtures(f"""lab AS ({_lab_rows()})
        SELECT patient_id, {date}, lab_test_id FROM lab WHERE {' AND '.join(where)}
        QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY {order}) = {offset + 1}""", more_steps=True)


def _intervals_sql(state: str) -> str:
    return f"""(SELECT s.program_state_id, s.program_enrollment_id, s.patient_id, s.location, s.start_date,
                   COALESCE(s.end_date, e.completion_date) AS end_date, COALESCE(s.next_state, e.outcome) AS outcome
        FROM (SELECT x.*, (SELECT n.state FROM omrs_program_state n
                           WHERE n.program_enrollment_id = x.program_enrollment_id AND n.start_date = x.end_date
                             AND n.program_state_id <> x.program_state_id
                             AND lower(n.program) = 'hiv program' AND lower(n.workflow) = 'treatment status'
                           ORDER BY n.program_state_id LIMIT 1) AS next_state
              FROM omrs_program_state x
              WHERE lower(x.program) = 'hiv program' AND lower(x.workflow) = 'treatment status') s
        JOIN omrs_program_enrollment e ON e.program_enrollment_id = s.program_enrollment_id
        WHERE lower(rtrim(s.state)) = {_q(state.lower())})"""


def _newest_number_sql(id_type: str) -> str:
    return f"""(SELECT patient_id, location,
                   array_to_string(list_transform(string_split(identifier, ' '),
                       lambda x: CASE WHEN regexp_matches(x, '^[0-9]') AND length(x) < 4 THEN lpad(x, 4, '0')
                                      ELSE x END), '-') AS num
        FROM (SELECT *, row_number() OVER (PARTITION BY patient_id, location
                                           ORDER BY date_created DESC, patient_identifier_id DESC) AS rn
              FROM omrs_patient_identifier WHERE lower(rtrim(type)) = {_q(id_type.lower())}) z WHERE rn = 1)"""


def _newest(source: str, by: str, pick: str) -> str:
    return (f"(SELECT patient_id, {pick} AS picked FROM {source} "
            f"QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY {by}) = 1)")


def _register(state: str, id_type: str, number: str, more: str = "", joins: str = "", steps: str = "") -> str:
    body = f"""SELECT s.program_enrollment_id AS enrollment_id, s.patient_id, s.location, n.num AS {number}, s.start_date,
                      s.end_date, s.outcome{more}
               FROM {_intervals_sql(state)} s
               LEFT JOIN {_newest_number_sql(id_type)} n ON n.patient_id = s.patient_id AND n.location = s.location {joins}"""
    return with_fixtures(f"{steps}\n{body}", more_steps=bool(steps))


def art_register_sql() -> str:
    tested = "coalesce(date_collected, date_result_received, date_result_entered) DESC NULLS LAST, lab_test_id DESC"
    return _register(
        "On antiretrovirals", "ARV Number", "art_number",
        ", v.picked AS last_art_visit_id, t.picked AS last_viral_load_test_id, r.picked AS last_viral_load_result_id",
        f"""LEFT JOIN {_newest('visits', 'visit_date DESC NULLS LAST, art_visit_id DESC', 'art_visit_id')} v ON v.patient_id = s.patient_id
            LEFT JOIN {_newest('lab', tested, 'lab_test_id')} t ON t.patient_id = s.patient_id
            LEFT JOIN {_newest(f'(SELECT * FROM lab WHERE {HAS_RESULT}) w', tested, 'lab_test_id')} r ON r.patient_id = s.patient_id""",
        f"visits AS ({_art_visit_rows()}), lab AS ({_vl_rows()})")


def pre_art_register_sql() -> str:
    return _register("Pre-ART (Continue)", "HCC Number", "pre_art_number")


def eid_register_sql() -> str:
    return _register(
        "Exposed Child (Continue)", "HCC Number", "eid_number", ", v.picked AS last_eid_visit_id, m.mother_art_number",
        f"""LEFT JOIN {_newest('visits', 'visit_date DESC NULLS LAST, eid_visit_id DESC', 'eid_visit_id')} v ON v.patient_id = s.patient_id
            LEFT JOIN (SELECT e.patient_id, left(string_agg(o.value_text, ',' ORDER BY o.value_text), 1024) AS mother_art_number
                       FROM omrs_obs o JOIN omrs_encounter e USING (encounter_id)
                       WHERE o.concept = {_q(V.MOTHER_NUMBER)} GROUP BY 1) m ON m.patient_id = s.patient_id""",
        f"visits AS ({_eid_visit_rows()})")


def patient_sql() -> str:
    return with_fixtures("""
    SELECT p.patient_id, p.identifier, p.gender, p.birthdate, p.birthdate_estimated, p.state_province AS district,
           p.county_district AS traditional_authority, p.city_village AS village, p.dead, p.death_date,
           p.patient_uuid, c.related_person AS chw
    FROM omrs_patient p
    LEFT JOIN (SELECT patient_id, related_person, row_number() OVER (PARTITION BY patient_id
                   ORDER BY CASE WHEN end_date IS NULL THEN 1 ELSE 0 END DESC,
                            CASE WHEN start_date IS NULL THEN 0 ELSE 1 END DESC,
                            date_created DESC, relationship_id DESC) AS rn
               FROM omrs_relationship WHERE related_person_role = 'Community Health Worker') c
      ON c.patient_id = p.patient_id AND c.rn = 1""")


def parent_facilities_sql() -> str:
    case = "CASE " + " ".join(f"WHEN lower(rtrim(location)) = {_q(c.lower())} THEN {_q(V.FACILITIES[p])}"
                              for c, p in V.PARENTS) + " ELSE location END"
    return with_fixtures(f"SELECT DISTINCT location, {case} AS parent_facility FROM mw_art_followup")


def formatted_identifiers_sql() -> str:
    return with_fixtures("""SELECT patient_identifier_id, identifier,
        array_to_string(list_transform(string_split(identifier, ' '),
            lambda x: CASE WHEN regexp_matches(x, '^[0-9]') AND length(x) < 4 THEN lpad(x, 4, '0') ELSE x END), '-')
            AS formatted
        FROM omrs_patient_identifier""")


def _regimen_rows() -> str:
    lines = ", ".join(f"({n}, {_q(a)}, {_q(b)})" for n, a, b in V.REGIMEN_LINES)
    return f"""SELECT e.patient_id, o.value_coded AS regimen, l.num_of_prev_regimens,
                      (SELECT min(s.value_date) FROM omrs_obs s WHERE s.encounter_id = o.encounter_id AND s.concept = l.started)
                          AS regimen_init_date
               FROM omrs_obs o JOIN omrs_encounter e USING (encounter_id)
               JOIN (VALUES {lines}) l(num_of_prev_regimens, given, started) ON l.given = o.concept"""


def art_regimen_sql() -> str:
    return with_fixtures(f"SELECT *, CAST(NULL AS DATE) AS regimen_end_date, CAST(NULL AS VARCHAR) AS line FROM ({_regimen_rows()})")


def eid_initial_sql() -> str:
    """Value and unit of the nevirapine age and duration: joined on the visit and the observation group of the value."""
    pairs = [("age_when_starting_nvp", "duration_type_when_starting_nvp"), ("nvp_duration", "nvp_duration_type")]
    by_name = {e[0]: e for e in V.EID_INITIAL}
    joins, cols = _concept_inputs([e for e in V.EID_INITIAL if e[0] not in {c for p in pairs for c in p}])
    for n, (value, unit) in enumerate(pairs):
        def of(name):
            _, concept, kind, etype, group = by_name[name]
            only = f" AND group_concept = {_q(group)}" if group else ""
            return (f"(SELECT {KEYS}, obs_group_id, MIN({kind}) AS v FROM {OBS} x WHERE concept = {_q(concept)} "
                    f"AND encounter_type = {_q(etype)}{only} GROUP BY ALL)")
        chosen = (f"(SELECT * FROM {of(value)} y WHERE v IS NOT NULL "
                  f"QUALIFY row_number() OVER (PARTITION BY {KEYS} ORDER BY v, obs_group_id NULLS FIRST) = 1)")
        same_visit = lambda a, b: " AND ".join(f"{a}.{k} = {b}.{k}" for k in KEYS.split(", "))
        joins += [f"LEFT JOIN {chosen} a{n} ON {same_visit(f'a{n}', 's')}",
                  f"LEFT JOIN {of(unit)} b{n} ON {same_visit(f'b{n}', 's')} AND b{n}.obs_group_id IS NOT DISTINCT FROM a{n}.obs_group_id AND a{n}.v IS NOT NULL"]
        cols += [f"a{n}.v AS {value}", f"b{n}.v AS {unit}"]
    spine = _spine(["EXPOSED_CHILD_INITIAL"])
    return with_fixtures(f"SELECT s.patient_id, s.visit_date, s.location, {', '.join(cols)} FROM {spine} s " + " ".join(joins))


def eid_followup_sql() -> str:
    return _simple(V.EID_FOLLOWUP, ["EXPOSED_CHILD_FOLLOWUP"])


def eid_visits_sql() -> str:
    return with_fixtures(_eid_visit_rows())


def eid_lab_tests_sql() -> str:
    return _simple(V.EID_LAB_TESTS, ["EID Screening"])


def pre_art_visits_sql() -> str:
    return _simple(V.PRE_ART_VISITS, ["PART_INITIAL", "PART_FOLLOWUP"])


def art_followup_testing_sql() -> str:
    """All observations of the visit's kind: a row for each combination; CD4 is required."""
    joins = []
    for i, (col, concept, kind, etype, _) in enumerate(V.FOLLOWUP_TESTING):
        joins.append(f"{'LEFT ' if i else ''}JOIN (SELECT {KEYS}, {kind} AS {col} FROM {OBS} x WHERE concept = {_q(concept)} "
                     f"AND encounter_type = {_q(etype)}) c{i} USING ({KEYS})")
    cols = ", ".join(e[0] for e in V.FOLLOWUP_TESTING)
    return with_fixtures(f"SELECT {KEYS}, {cols} FROM {_spine(['ART_FOLLOWUP_UP_TESTING'])} s " + " ".join(joins))


def art_viral_load_sql() -> str:
    anchor = next(e for e in V.ART_VIRAL_LOAD if e[0] == "reason_for_test")
    cols = []
    joins = []
    for i, (col, concept, kind, etype, _) in enumerate(e for e in V.ART_VIRAL_LOAD if e is not anchor):
        joins.append(f"""LEFT JOIN (SELECT {KEYS}, obs_group_id, MIN({kind}) AS v FROM {OBS} x
                                   WHERE concept = {_q(concept)} AND encounter_type = {_q(etype)}
                                   GROUP BY {KEYS}, obs_group_id) c{i}
                    ON c{i}.patient_id = r.patient_id AND c{i}.visit_date = r.visit_date
                   AND c{i}.location = r.location AND c{i}.obs_group_id = r.obs_group_id""")
        cols.append(f"c{i}.v AS {col}")
    body = f"""SELECT s.patient_id, s.visit_date, s.location, r.obs_group_id, r.reason_for_test,
                      {', '.join(cols)}
        FROM {_spine(["Viral Load Screening"])} s
        LEFT JOIN (SELECT * FROM (SELECT {KEYS}, obs_group_id, MIN({anchor[2]}) AS reason_for_test,
                                         row_number() OVER (PARTITION BY {KEYS} ORDER BY obs_group_id) AS rn
                                  FROM {OBS} a WHERE concept = {_q(anchor[1])} AND encounter_type = {_q(anchor[3])}
                                  GROUP BY {KEYS}, obs_group_id) z WHERE rn = 1) r
          ON r.patient_id = s.patient_id AND r.visit_date = s.visit_date AND r.location = s.location
        {' '.join(joins)}"""
    return with_fixtures(body)


def regimen_at_offset_sql(offset: int) -> str:
    return with_fixtures(f"""regimens AS ({_regimen_rows()})
        SELECT patient_id, regimen, regimen_init_date AS regimen_start FROM regimens
        QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY regimen_init_date DESC NULLS LAST,
                                   num_of_prev_regimens DESC, regimen DESC NULLS LAST) = {offset + 1}""", more_steps=True)


def first_date_no_breastfeeding_sql(end) -> str:
    e, stopped = f"DATE '{end.isoformat()}'", _q(V.STOPPED_FEEDING)
    return with_fixtures(f"""visits AS ({_eid_visit_rows()}),
        other AS (SELECT patient_id, max(visit_date) AS d FROM visits
                  WHERE breastfeeding_status <> {stopped} AND visit_date <= {e} GROUP BY 1)
        SELECT v.patient_id, min(v.visit_date) AS first_date_no_breastfeeding
        FROM visits v LEFT JOIN other o USING (patient_id)
        WHERE v.breastfeeding_status = {stopped} AND (o.d IS NULL OR (v.visit_date <= {e} AND v.visit_date <= o.d))
        GROUP BY 1""", more_steps=True)


def _bare(sql: str) -> str:
    """A loader's statement without the fixtures in front of it."""
    return sql[len(with_fixtures("")):]


def loaded_tables() -> dict[str, str]:
    """The warehouse tables that the cohort reports read, as their loaders make them, in the declared types."""
    followup = _bare(art_followup_sql())
    whole = lambda c: f"TRY_CAST({c} AS INTEGER) AS {c}"
    decimal = lambda c: f"TRY_CAST({c} AS DECIMAL(10,2)) AS {c}"
    numbers = [whole(c) for c in ("diastolic_bp", "systolic_bp", "arvs_given")]
    numbers += [decimal(c) for c in ("height", "weight", "inh_300_pills", "rfp_150_pills", "rfp_inh_pills")]
    return {
        "mw_patient": _bare(patient_sql()),
        "mw_art_followup": f"SELECT * REPLACE ({', '.join(numbers)}) FROM ({followup}) x",
        "mw_art_initial": f"SELECT * REPLACE ({whole('cd4_count')}) FROM ({_bare(art_initial_sql())}) x",
        "mw_art_visits": _art_visit_rows(),
    }
