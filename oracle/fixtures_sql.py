"""The fixture projection written as DuckDB SQL CTEs (the oracle side).

Independent second statement of the formulas of the fixture projection.
Lists are 1-based in DuckDB, so ``list[i + 1]`` picks the i-th (0-based) item.
"""

from __future__ import annotations

from oracle import values as V

# the projection's own numbers
LATER_DAYS, LATER_ID = 7300, 1_000_000_000


def quoted(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def quoted_list(values) -> str:
    return "[" + ", ".join(quoted(v) for v in values) + "]"


_q, _lst = quoted, quoted_list
FAC = _lst(V.FACILITIES)
NENO_CLINICS = _lst([c for c, parent in V.PARENTS if parent == 0])
REGIMEN_CYCLE = [t for _, t in V.REGIMENS + V.WEIGHT_REGIMENS]
PREGNANCY_CYCLE = V.PREGNANCY
GROUP_CONCEPTS = [V.NEVIRAPINE, V.SEROLOGY, "Other construct"]

CTES: dict[str, str] = {
    "o_": """SELECT o_orderkey AS k, o_custkey AS p, CAST(o_orderdate AS DATE) AS d FROM orders""",
    "mw_patient": """
        SELECT c_custkey AS patient_id, 'NNO ' || CAST(c_custkey AS VARCHAR) AS identifier,
               CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
               DATE '2000-06-30' - CAST((c_custkey * 7919) % 33000 AS INTEGER) AS birthdate
        FROM customer""",
    "omrs_program_state": f"""
        SELECT program_state_id, patient_id AS program_enrollment_id, patient_id, 'HIV program' AS program,
               'Treatment status' AS workflow, state, location, start_date, end_date
        FROM (SELECT k AS program_state_id, p AS patient_id,
                     CASE WHEN k % 10 <= 5 THEN 'On antiretrovirals' WHEN k % 10 = 6 THEN 'Patient died'
                          WHEN k % 10 = 7 THEN 'Patient defaulted' WHEN k % 10 = 8 THEN 'Treatment stopped'
                          ELSE 'Patient transferred out' END AS state,
                     ({FAC})[CAST((p + CASE WHEN k % 7 = 0 THEN 1 ELSE 0 END) % 5 AS INTEGER) + 1] AS location,
                     d AS start_date,
                     CASE k % 3 WHEN 0 THEN d + {LATER_DAYS} WHEN 1 THEN d + CAST(k % 90 + 30 AS INTEGER) END AS end_date
              FROM o_
              UNION ALL
              SELECT k + {LATER_ID}, p,
                     CASE WHEN k % 2 = 0 THEN 'Pre-ART (Continue)' ELSE 'Exposed Child (Continue)' END,
                     ({FAC})[CAST((p + CASE WHEN k % 7 = 0 THEN 1 ELSE 0 END) % 5 AS INTEGER) + 1],
                     d + {LATER_DAYS}, NULL
              FROM o_) s""",
    "omrs_program_enrollment": """
        SELECT c_custkey AS program_enrollment_id, c_custkey AS patient_id,
               CASE WHEN c_custkey % 3 = 0 THEN DATE '2001-12-31' END AS completion_date,
               CASE WHEN c_custkey % 3 = 0 THEN 'Patient transferred out' END AS outcome
        FROM customer""",
    "omrs_patient_identifier": f"""
        SELECT c_custkey * 10 + v AS patient_identifier_id, c_custkey AS patient_id,
               CASE WHEN v = 3 THEN 'HCC Number' WHEN c_custkey % 17 = 0 THEN 'ARV number' ELSE 'ARV Number' END AS type,
               CASE v WHEN 0 THEN 'NNO ' || CAST(c_custkey AS VARCHAR)
                      WHEN 1 THEN 'ALT ' || CAST(c_custkey AS VARCHAR)
                      WHEN 2 THEN 'NNO ' || CAST(c_custkey AS VARCHAR) || ' 2'
                      ELSE 'HCC ' || CAST(c_custkey AS VARCHAR) END AS identifier,
               ({FAC})[CAST((c_custkey + CASE WHEN v = 1 THEN 1 ELSE 0 END) % 5 AS INTEGER) + 1] AS location,
               DATE '1995-01-01' + CAST(c_custkey % 97 + v AS INTEGER) AS date_created
        FROM customer, (VALUES (0), (1), (2), (3)) AS t(v)
        WHERE v = 0 OR (v = 1 AND c_custkey % 11 = 0) OR (v = 2 AND c_custkey % 29 = 0)
              OR (v = 3 AND c_custkey % 4 = 0)""",
    "lookup_location": "SELECT * FROM (VALUES " + ", ".join(
        f"({_q(n)}, {i})" for i, n in enumerate(V.FACILITIES)) + ") AS t(target_value, source_key)",
    "mw_art_initial": f"""
        SELECT p AS patient_id, d AS visit_date, ({FAC})[CAST(p % 5 AS INTEGER) + 1] AS location,
               CAST(CASE WHEN k % 5 <> 0 THEN (k * 37) % 600 END AS INTEGER) AS cd4_count,
               CASE WHEN k % 6 = 0 THEN d END AS transfer_in_date,
               CASE WHEN p % 2 = 0 THEN ({_lst(PREGNANCY_CYCLE)})[CAST((k // 8) % 4 AS INTEGER) + 1] END
                   AS pregnant_or_lactating,
               k AS k_
        FROM o_""",
    "mw_art_followup": f"""
        SELECT p AS patient_id, d AS visit_date,
               CASE WHEN k % 13 = 1 AND p % 5 <= 2 THEN
                    CASE p % 5 WHEN 0 THEN ({NENO_CLINICS})[CAST((k // 13) % 3 AS INTEGER) + 1]
                               WHEN 1 THEN 'Felemu Outreach Clinic' ELSE 'Kasamba Outreach Clinic' END
                    ELSE ({FAC})[CAST(p % 5 AS INTEGER) + 1] END AS location,
               CASE WHEN k % 23 <> 0 THEN d + CAST(28 * (k % 7 + 1) AS INTEGER) END AS next_appointment_date,
               ({_lst(REGIMEN_CYCLE)})[CAST((k * 31 + p) % {len(REGIMEN_CYCLE)} AS INTEGER) + 1] AS art_regimen,
               CAST(CASE WHEN k % 17 <> 0 THEN CAST((k * 13) % 900 AS DECIMAL(10,2)) / 10 END AS DECIMAL(10,2)) AS weight,
               CAST(30 * (k % 6 + 1) AS INTEGER) AS arvs_given,
               CAST(CASE WHEN k % 5 <> 0 THEN 100 + k % 70 END AS INTEGER) AS systolic_bp,
               CAST(CASE WHEN k % 5 <> 0 THEN 60 + k % 50 END AS INTEGER) AS diastolic_bp,
               ({_lst(V.TB_STATUSES)})[CAST((k // 4) % 4 AS INTEGER) + 1] AS tb_status,
               CASE WHEN k % 4 IN (0, 1) THEN 'Isoniazid' END AS inh_300,
               CASE WHEN k % 4 IN (0, 1) THEN CAST(12 * (k % 4 + 1) AS DECIMAL(10,2)) END AS inh_300_pills,
               CASE WHEN k % 4 = 1 THEN 'Rifapentine' END AS rfp_150,
               CASE WHEN k % 4 = 1 THEN CAST(12 * (k % 4 + 1) AS DECIMAL(10,2)) END AS rfp_150_pills,
               CASE WHEN k % 12 = 2 THEN '3HP (Rifapentine and Isoniazid)' END AS rfp_inh,
               CASE WHEN k % 12 = 2 THEN CAST(12 * (k % 4 + 1) AS DECIMAL(10,2)) END AS rfp_inh_pills,
               CASE WHEN p % 2 = 0 THEN ({_lst(PREGNANCY_CYCLE)})[CAST((k // 2) % 4 AS INTEGER) + 1] END
                   AS pregnant_or_lactating,
               k AS k_
        FROM o_""",
    "mw_art_visits": """
        SELECT k_ * 2 + 1 AS art_visit_id, patient_id, visit_date, location,
               art_regimen AS art_drug_regimen, next_appointment_date FROM mw_art_followup
        UNION ALL
        SELECT k_ * 2, patient_id, visit_date, location, NULL, NULL FROM mw_art_initial""",
    "mw_art_viral_load": f"""
        SELECT p AS patient_id, d AS visit_date, ({FAC})[CAST(p % 5 AS INTEGER) + 1] AS location,
               CASE WHEN k % 2 = 0 THEN 'Routine' ELSE 'Target' END AS reason_for_test,
               CAST(CASE WHEN k % 4 = 0 THEN (k * 97) % 3000 END AS INTEGER) AS viral_load_result,
               CAST(CASE WHEN k % 4 = 1 THEN 400 END AS INTEGER) AS less_than_limit,
               CASE WHEN k % 4 = 2 THEN 'True' END AS ldl,
               CASE WHEN k % 4 = 3 THEN 'Sample rejected' END AS other_results
        FROM o_""",
    "mw_art_followup_testing": f"""
        SELECT p AS patient_id, d AS visit_date, ({FAC})[CAST(p % 5 AS INTEGER) + 1] AS location,
               CAST((k * 53) % 800 AS INTEGER) AS cd4_count
        FROM o_""",
    "omrs_encounter": f"""
        SELECT k AS encounter_id, p AS patient_id, d AS encounter_date,
               ({_lst(V.ENCOUNTER_TYPES)})[CAST(k % {len(V.ENCOUNTER_TYPES)} AS INTEGER) + 1] AS encounter_type,
               ({FAC})[CAST(p % 5 AS INTEGER) + 1] AS location
        FROM o_""",
    "omrs_obs": f"""
        SELECT l_orderkey AS encounter_id, l_orderkey * 10 + l_linenumber AS obs_group_id,
               ({_lst(V.CONCEPTS)})[CAST((l_partkey + l_linenumber) % {len(V.CONCEPTS)} AS INTEGER) + 1] AS concept,
               CAST(l_shipdate AS DATE) AS obs_date,
               ({_lst(V.ANSWERS)})[CAST((l_partkey * 3 + l_suppkey) % {len(V.ANSWERS)} AS INTEGER) + 1] AS value_coded,
               CAST(l_quantity AS DECIMAL(16,4)) AS value_numeric, CAST(l_shipdate AS DATE) AS value_date,
               'T' || CAST(l_partkey AS VARCHAR) AS value_text,
               CAST(l_shipdate AS DATE) + CAST(l_suppkey % 30 AS INTEGER) AS date_created
        FROM lineitem""",
    "omrs_patient": """
        SELECT c_custkey AS patient_id, c_name AS identifier,
               CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
               DATE '2000-06-30' - CAST((c_custkey * 7919) % 33000 AS INTEGER) AS birthdate,
               c_custkey % 9 = 0 AS birthdate_estimated, 'Neno' AS state_province,
               'TA ' || CAST(c_nationkey AS VARCHAR) AS county_district,
               'Village ' || CAST(c_custkey % 40 AS VARCHAR) AS city_village,
               c_custkey % 23 = 0 AS dead, CASE WHEN c_custkey % 23 = 0 THEN DATE '2001-01-01' END AS death_date,
               'uuid-' || CAST(c_custkey AS VARCHAR) AS patient_uuid
        FROM customer""",
    "omrs_relationship": """
        SELECT k AS relationship_id, p AS patient_id, 'CHW ' || CAST(k % 50 AS VARCHAR) AS related_person,
               CASE WHEN k % 3 <> 0 THEN 'Community Health Worker' ELSE 'Guardian' END AS related_person_role,
               CASE WHEN k % 4 <> 0 THEN d END AS start_date, CASE WHEN k % 5 = 0 THEN d + 365 END AS end_date,
               d + CAST(k % 11 AS INTEGER) AS date_created
        FROM o_""",
    "omrs_obs_group": f"""
        SELECT DISTINCT l_orderkey * 10 + l_linenumber AS obs_group_id, l_orderkey AS encounter_id,
               ({_lst(GROUP_CONCEPTS)})[CAST((l_orderkey + l_linenumber) % {len(GROUP_CONCEPTS)} AS INTEGER) + 1]
                   AS concept
        FROM lineitem""",
}


def with_fixtures(body: str, replace: dict[str, str] | None = None, more_steps: bool = False) -> str:
    """Prefix a body with every fixture CTE (DuckDB drops unused ones).

    ``replace`` gives other SQL for some tables; it comes last, so that it can
    read the source tables.  ``more_steps``: the body begins with further CTEs.
    """
    replace = replace or {}
    tables = {n: q for n, q in CTES.items() if n not in replace} | replace
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in tables.items())
    return f"WITH {ctes}{',' if more_steps else ''}\n{body}"
