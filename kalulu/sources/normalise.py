"""Text normalised once, where tables enter the library.

The source compares text without regard to case and trailing blanks.  Here the
coded columns of every table are brought to one spelling (the dictionary's where
it knows the value, else without trailing blanks), so that plans compare with
plain literals and joins, and filters on stored tables reach the scan.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame

from kalulu import constants as K
from kalulu.functions.sqltext import column as quoted_name
from kalulu.functions.sqltext import listed
from kalulu.plans.loaders import concepts as C

_STATES = [K.ON_ART, K.DIED, K.DEFAULTED, K.STOPPED, K.TRANSFERRED_OUT, K.PRE_ART_CONTINUE, K.EXPOSED_CHILD_CONTINUE]
_PLACES = [*K.FACILITIES, *[c.rstrip() for c, _ in K.OUTREACH_PARENT]]
_REGIMENS = [t for _, t in K.REGIMENS + K.WEIGHT_REPORT_EXTRA_REGIMENS]
_PREGNANCY = [K.PREGNANT, K.BREASTFEEDING, K.NOT_PREGNANT]
_ANSWERS = list(dict.fromkeys([*C.ALL_CODED, *_REGIMENS, *K.TB_STATUSES, *_PREGNANCY, K.LDL_TRUE, C.HIV_DEFAULT_TEST_TYPE]))
_TYPES = [C.VL_TEST_TYPE, C.HIV_DEFAULT_TEST_TYPE]

#: table -> column -> its dictionary
COLUMNS: dict[str, dict[str, list[str]]] = {
    "omrs_patient": {"gender": ["F", "M"]},
    "omrs_relationship": {"related_person_role": ["Community Health Worker"]},
    "omrs_encounter": {"encounter_type": K.ENCOUNTER_TYPES, "location": _PLACES},
    "omrs_obs": {"concept": [*C.ALL_CONCEPTS], "value_coded": _ANSWERS},
    "omrs_obs_group": {"concept": C.GROUP_CONCEPTS},
    "omrs_program_state": {"program": [K.HIV_PROGRAM], "workflow": [K.TREATMENT_WORKFLOW], "state": _STATES, "location": _PLACES},
    "omrs_program_enrollment": {"outcome": _STATES},
    "omrs_patient_identifier": {"type": [K.ARV_NUMBER, K.HCC_NUMBER], "location": _PLACES},
    "lookup_location": {"target_value": _PLACES},
    "mw_patient": {"gender": ["F", "M"]},
    "mw_art_followup": {"location": _PLACES, "art_regimen": _REGIMENS, "tb_status": K.TB_STATUSES, "pregnant_or_lactating": _PREGNANCY},
    "mw_art_initial": {"location": _PLACES, "pregnant_or_lactating": _PREGNANCY},
    "mw_art_visits": {"location": _PLACES, "art_drug_regimen": _REGIMENS},
    "mw_art_viral_load": {"location": _PLACES, "reason_for_test": [K.ROUTINE, K.TARGET], "ldl": [K.LDL_TRUE]},
    "mw_art_followup_testing": {"location": _PLACES},
    "mw_lab_tests": {"test_type": _TYPES},
}


@functools.cache
def one_spelling(column: str, known: tuple[str, ...]) -> str:
    """SQL text: the dictionary's spelling of a value it knows, else the value without trailing blanks."""
    pairs = listed(x for v in dict.fromkeys(known) for x in (v.rstrip().lower(), v.rstrip()))
    return f"coalesce(map({pairs})[lower(rtrim({column}))], rtrim({column}))"


def normalise(df: DataFrame, table: str) -> DataFrame:
    known = COLUMNS.get(table, {})
    if not known:
        return df
    return df.selectExpr(*[f"{one_spelling(quoted_name(c), tuple(known[c]))} as {quoted_name(c)}" if c in known else quoted_name(c) for c in df.columns])


class NormalisedWarehouse:
    """Any warehouse with the coded columns of its tables in one spelling; a table is read once per object."""

    def __init__(self, base):
        self.base, self.spark = base, base.spark

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("__") or name in ("base", "spark"):
            raise AttributeError(name)
        table = normalise(getattr(self.base, name), name)
        self.__dict__[name] = table
        return table
