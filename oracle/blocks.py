"""Building blocks of the oracle's SQL (DuckDB): named steps in front of one select."""

from __future__ import annotations

import datetime as dt

from oracle import values as V
from oracle.fixtures_sql import quoted, quoted_list, with_fixtures

DRUG_COLUMNS = ["inh_300", "inh_300_pills", "rfp_150", "rfp_150_pills", "rfp_inh", "rfp_inh_pills"]


def day(d: dt.date) -> str:
    return f"DATE '{d.isoformat()}'"


def same(column: str, value: str) -> str:
    """Equality as the source compares text: case and trailing blanks do not count."""
    return f"lower(rtrim({column})) = {quoted(value.lower())}"


def shifted(d: dt.date, months: int) -> dt.date:
    m = d.year * 12 + d.month - 1 + months
    y, m = divmod(m, 12)
    last = (dt.date(y + m // 11, (m + 1) % 12 + 1, 1) - dt.timedelta(days=1)).day
    return dt.date(y, m + 1, min(d.day, last))


def period_from(end: dt.date, days: int = 0, months: int = 0) -> dt.date:
    """Start of a period that ends on one of the last days of a month; else the end itself."""
    if end.day < 28:
        return end
    return shifted(end, -months) - dt.timedelta(days=days) + dt.timedelta(days=32 - end.day)


class Steps:
    """Collects named steps; ``select`` puts the fixtures and the steps in front of a body."""

    def __init__(self, replace: dict[str, str] | None = None):
        self.steps: dict[str, str] = {}
        self.replace = replace or {}
        self.add("numbers", f"SELECT patient_id, identifier, location FROM omrs_patient_identifier WHERE {same('type', 'ARV Number')}")
        self.add("settled", "SELECT patient_id, min(location) AS location FROM numbers GROUP BY patient_id HAVING count(DISTINCT location) = 1")

    def add(self, name: str, sql: str) -> str:
        self.steps.setdefault(name, sql)
        return name

    def select(self, body: str) -> str:
        chain = ",\n".join(f"{n} AS ({s})" for n, s in self.steps.items())
        return with_fixtures(f"{chain}\n{body}", self.replace, more_steps=True)

    # -- steps of the reports --------------------------------------------------
    def outcome(self, end: dt.date, strict: bool = False) -> str:
        """Per patient and facility the state that began last, once per ARV Number held there."""
        name = f"outcome_{end:%Y%m%d}{'_before' if strict else ''}"
        return self.add(name, f"""
            SELECT n.patient_id, n.location, n.identifier, s.top.state AS state, s.top.program AS program,
                   s.top.program_state_id AS program_state_id, s.top.start_date AS start_date
            FROM (SELECT patient_id, location, max({{'start_date': start_date, 'program_state_id': program_state_id,
                                                    'state': state, 'program': program}}) AS top
                  FROM omrs_program_state
                  WHERE {same('program', 'HIV program')} AND start_date {'<' if strict else '<='} {day(end)}
                  GROUP BY ALL) s
            JOIN numbers n ON n.patient_id = s.patient_id AND n.location = s.location
            WHERE n.location IN (SELECT target_value FROM lookup_location)""")

    def visits(self, start: dt.date, end: dt.date) -> str:
        """Follow-up visits up to the end, each with the patient's four reference days."""
        name = f"visits_{start:%Y%m%d}_{end:%Y%m%d}"
        given = "coalesce(" + ", ".join(f"CAST({c} AS VARCHAR)" for c in DRUG_COLUMNS) + ") IS NOT NULL"
        return self.add(name, f"""
            SELECT *, max(visit_date) OVER w AS latest_day,
                   max(visit_date) FILTER (WHERE given AND visit_date >= {day(start)}) OVER w AS last_day,
                   max(visit_date) FILTER (WHERE given AND visit_date < {day(start)}) OVER w AS previous_day,
                   min(visit_date) FILTER (WHERE given AND visit_date >= {day(start)}) OVER w AS first_day
            FROM (SELECT *, {given} AS given FROM mw_art_followup WHERE visit_date <= {day(end)}) v
            WINDOW w AS (PARTITION BY patient_id)""")

    def latest_visits(self, end: dt.date, table: str = "mw_art_followup") -> str:
        return self.add(f"latest_{table}_{end:%Y%m%d}", f"""
            SELECT * FROM {table} WHERE visit_date <= {day(end)}
            QUALIFY visit_date = max(visit_date) OVER (PARTITION BY patient_id)""")

    def cohort(self, start: dt.date, end: dt.date, extra: str = "") -> str:
        """Distinct rows: who, where, state, age, latest visit, therapy visits, latest initial visit."""
        name = f"cohort_{start:%Y%m%d}_{end:%Y%m%d}{'_x' if extra else ''}"
        v, o, i = self.visits(start, end), self.outcome(end), self.latest_visits(end, "mw_art_initial")
        drugs = ", ".join(f"{a}.{c} AS {p}_{c}" for a, p in (("f", "first"), ("t", "last"), ("b", "previous")) for c in DRUG_COLUMNS)
        until = f"CASE WHEN {same('o.state', 'On antiretrovirals')} THEN {day(end)} ELSE o.start_date END"
        return self.add(name, f"""
            SELECT DISTINCT o.patient_id, o.identifier, o.location, o.state, o.start_date, p.gender,
                   {months('p.birthdate', until)} AS age,
                   v.next_appointment_date AS last_appt_date, v.art_regimen AS current_regimen, v.pregnant_or_lactating,
                   v.visit_date AS followup_visit_date, v.systolic_bp, v.diastolic_bp, {extra}
                   i.visit_date AS initial_visit_date, i.transfer_in_date,
                   i.pregnant_or_lactating AS initial_pregnant_or_lactating,
                   f.visit_date AS first_ipt_date, t.visit_date AS last_ipt_date, b.visit_date AS previous_ipt_date, {drugs}
            FROM {o} o JOIN mw_patient p USING (patient_id)
            LEFT JOIN {v} v ON v.patient_id = o.patient_id AND v.visit_date = v.latest_day
            LEFT JOIN {v} f ON f.patient_id = o.patient_id AND f.visit_date = f.first_day
            LEFT JOIN {v} t ON t.patient_id = o.patient_id AND t.visit_date = t.last_day
            LEFT JOIN {v} b ON b.patient_id = o.patient_id AND b.visit_date = b.previous_day
            LEFT JOIN {i} i ON i.patient_id = o.patient_id""")


def months(since: str, until: str) -> str:
    """Age in months of 30 days."""
    return f"CAST(floor(date_diff('day', {since}, {until}) / 30) AS INTEGER)"


def age_label() -> str:
    """The band of ``age`` for the sexes M and F."""
    place = "CASE WHEN age < 12 THEN 1 WHEN age < 60 THEN 2 ELSE least(20, 2 + age // 60) END"
    return f"CASE WHEN upper(gender) IN ('F', 'M') THEN ({quoted_list(V.AGE_LABELS)})[{place}] END"


def weight_label() -> str:
    kilos = "CAST(weight AS DECIMAL(10,0))"
    place = f"len(list_filter({V.WEIGHT_FROM}, lambda x: x <= {kilos}))"
    return f"CASE WHEN weight IS NULL THEN 'Unknown' ELSE nullif(({quoted_list(['', *V.WEIGHT_LABELS[:-1]])})[{place} + 1], '') END"


def _counts(indicators: dict[str, str]) -> str:
    return ", ".join(f'count(*) FILTER (WHERE {p}) AS "{n}"' for n, p in indicators.items())


def _filled(indicators: dict[str, str]) -> str:
    return ", ".join(f'coalesce(c."{n}", 0) AS "{n}"' for n in indicators)


def by_band(rows: str, indicators: dict[str, str], label: str | None = None, labels=None, column: str = "age_group") -> str:
    """Counts per facility, sex and band; each combination has a row, women first."""
    labels = labels or V.AGE_LABELS
    n = len(labels)
    return f"""
        SELECT g.location, g.sort_value, g.band AS {column}, CASE g.sex WHEN 'F' THEN 'Female' ELSE 'Male' END AS gender,
               {_filled(indicators)}
        FROM (SELECT target_value AS location, s.k * {n} + b.k AS sort_value, ({quoted_list(labels)})[b.k] AS band, s.sex
              FROM lookup_location, (VALUES ('F', 0), ('M', 1)) s(sex, k), (SELECT unnest(range(1, {n + 1})) AS k) b) g
        LEFT JOIN (SELECT location, {label or age_label()} AS band, upper(gender) AS sex, {_counts(indicators)}
                   FROM {rows} r GROUP BY 1, 2, 3) c
          ON c.location = g.location AND c.band = g.band AND c.sex = g.sex"""


def by_group(rows: str, indicators: dict[str, str], gender: str = "gender", pregnancy: str = "pregnant_or_lactating",
             column: str = "age_group", after: int = 40) -> str:
    """Counts per facility and population group (the groups are disjoint)."""
    group = f"""CASE upper({gender}) WHEN 'M' THEN 'Male' WHEN 'F' THEN
                CASE WHEN {same(pregnancy, 'Patient Pregnant')} THEN 'FP'
                     WHEN {same(pregnancy, 'Currently breastfeeding child')} THEN 'FBF'
                     WHEN {pregnancy} IS NULL OR {same(pregnancy, 'No')} THEN 'FNP' END END"""
    return f"""
        SELECT l.target_value AS location, {after} + k.place AS sort_value, 'All' AS {column}, k.name AS gender, {_filled(indicators)}
        FROM lookup_location l CROSS JOIN (VALUES (1, 'Male'), (2, 'FP'), (3, 'FNP'), (4, 'FBF')) k(place, name)
        LEFT JOIN (SELECT location, {group} AS name, {_counts(indicators)} FROM {rows} r GROUP BY 1, 2) c
          ON c.location = l.target_value AND c.name = k.name"""
