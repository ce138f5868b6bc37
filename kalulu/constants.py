"""Fixed domain values.

FIXED VALUES: every string below must equal the clinical system's stored
values exactly (states, encounter types, identifier types, regimen texts,
band labels, facility names).  They are listed plainly, in their natural
order, so a reader can check them against the source data dictionary.
String comparison in the source system is case-insensitive and ignores
trailing blanks; predicates therefore compare through ``functions.text.ci``.
"""

from __future__ import annotations

# --- FIXED VALUES: programme, workflow and states -------------------------
HIV_PROGRAM = "HIV program"
TREATMENT_WORKFLOW = "Treatment status"
ON_ART = "On antiretrovirals"
DIED = "Patient died"
DEFAULTED = "Patient defaulted"
STOPPED = "Treatment stopped"
TRANSFERRED_OUT = "Patient transferred out"
PRE_ART_CONTINUE = "Pre-ART (Continue)"
EXPOSED_CHILD_CONTINUE = "Exposed Child (Continue)"

# --- FIXED VALUES: identifier types ----------------------------------------
ARV_NUMBER = "ARV Number"
HCC_NUMBER = "HCC Number"

# --- FIXED VALUES: encounter types -----------------------------------------
ART_INITIAL = "ART_INITIAL"
ART_FOLLOWUP = "ART_FOLLOWUP"
ART_FOLLOWUP_TESTING = "ART_FOLLOWUP_UP_TESTING"
VIRAL_LOAD_SCREENING = "Viral Load Screening"
PART_INITIAL = "PART_INITIAL"
PART_FOLLOWUP = "PART_FOLLOWUP"
EXPOSED_CHILD_INITIAL = "EXPOSED_CHILD_INITIAL"
EXPOSED_CHILD_FOLLOWUP = "EXPOSED_CHILD_FOLLOWUP"
EID_SCREENING = "EID Screening"
ENCOUNTER_TYPES = [
    ART_INITIAL, ART_FOLLOWUP, ART_FOLLOWUP_TESTING, VIRAL_LOAD_SCREENING,
    PART_INITIAL, PART_FOLLOWUP, EXPOSED_CHILD_INITIAL, EXPOSED_CHILD_FOLLOWUP,
    EID_SCREENING,
]

# --- FIXED VALUES: population groups and their labels ----------------------
PREGNANT = "Patient Pregnant"
BREASTFEEDING = "Currently breastfeeding child"
NOT_PREGNANT = "No"
GROUPS = ["Male", "FP", "FNP", "FBF"]  # order of the appended "All" rows

# --- FIXED VALUES: TB screening statuses ------------------------------------
TB_SUSPECTED = "TB suspected"
TB_NOT_SUSPECTED = "TB NOT suspected"
TB_ON_TREATMENT = "Confirmed TB on treatment"
TB_NOT_ON_TREATMENT = "Confirmed TB NOT on treatment"
TB_STATUSES = [TB_SUSPECTED, TB_NOT_SUSPECTED, TB_ON_TREATMENT, TB_NOT_ON_TREATMENT]

# --- FIXED VALUES: TB preventive therapy drugs (coded values) --------------
ISONIAZID = "Isoniazid"
RIFAPENTINE = "Rifapentine"
RFP_INH = "3HP (Rifapentine and Isoniazid)"
COTRIMOXAZOLE = "Trimethoprim and sulfamethoxazole"
PYRIDOXINE = "Pyridoxine"

# --- FIXED VALUES: viral-load reasons and results ---------------------------
ROUTINE = "Routine"
TARGET = "Target"
LDL_TRUE = "True"

# --- FIXED VALUES: age bands (30-day months, lower bound inclusive) --------
# "<1 year" is used for the infant band everywhere (one label; see README).
AGE_BANDS = [
    ("<1 year", 0), ("1-4 years", 12), ("5-9 years", 60), ("10-14 years", 120),
    ("15-19 years", 180), ("20-24 years", 240), ("25-29 years", 300),
    ("30-34 years", 360), ("35-39 years", 420), ("40-44 years", 480),
    ("45-49 years", 540), ("50-54 years", 600), ("55-59 years", 660),
    ("60-64 years", 720), ("65-69 years", 780), ("70-74 years", 840),
    ("75-79 years", 900), ("80-84 years", 960), ("85-89 years", 1020),
    ("90 plus years", 1080),
]

# --- FIXED VALUES: weight bands (kg rounded half-up to an integer) ---------
WEIGHT_BANDS = [
    ("3 - 3.9 Kg", 3), ("4 - 4.9 Kg", 4), ("5 - 9.9 Kg", 5), ("10 - 13.9 Kg", 10),
    ("14 - 19.9 Kg", 14), ("20 - 24.9 Kg", 20), ("25 - 29.9 Kg", 25),
    ("30 - 34.9 Kg", 30), ("35 - 39.9 Kg", 35), ("40 - 49.9 Kg", 40),
    ("50 Kg +", 50),
]
WEIGHT_UNKNOWN = "Unknown"

# --- FIXED VALUES: regimen codes and texts ----------------------------------
REGIMENS = [
    ("0A", "0A: ABC/3TC + NVP"),
    ("2A", "2A: AZT / 3TC / NVP (previous AZT)"),
    ("4A", "4A: AZT / 3TC + EFV (previous AZTEFV)"),
    ("5A", "5A: TDF / 3TC / EFV"),
    ("6A", "6A: TDF / 3TC + NVP"),
    ("7A", "7A: TDF / 3TC + ATV/r"),
    ("8A", "8A: AZT / 3TC + ATV/r"),
    ("9A", "9A: ABC / 3TC + LPV/r"),
    ("10A", "10A: TDF / 3TC + LPV/r"),
    ("11A", "11A: AZT / 3TC + LPV"),
    ("12A", "12A: DRV + r + DTG"),
    ("13A", "13A: TDF / 3TC / DTG"),
    ("14A", "14A: AZT / 3TC + DTG"),
    ("15A", "15A: ABC / 3TC + DTG"),
    ("16A", "16A: ABC / 3TC + RAL"),
    ("17A", "17A: ABC / 3TC + EFV"),
    ("0P", "0P: ABC/3TC + NVP"),
    ("2P", "2P: AZT / 3TC / NVP"),
    ("4PP", "4PP: AZT 60 / 3TC 30 + EFV 200"),
    ("4PA", "4PA: AZT 300 / 3TC 150 + EFV 200"),
    ("9PP", "9PP: ABC 120 / 3TC 60 + LPV/r 100/25"),
    ("9PA", "9PA: ABC 600 / 3TC 300 + LPV/r 100/25"),
    ("11PP", "11PP: AZT 60 / 3TC 30 + LPV/r 100/25"),
    ("11PA", "11PA: AZT 300 / 3TC 150 + LPV/r 100/25"),
    ("12PP", "12PP: DRV 150 + r 50 + DTG 10 (± NRTIs)"),
    ("12PA", "12PA: DRV 150 + r 50 + DTG 50"),
    ("14PP", "14PP: AZT 60 / 3TC 30 + DTG 10"),
    ("14PA", "14PA: AZT 60 / 3TC 30 + DTG 50"),
    ("15P", "15P: ABC / 3TC + DTG"),
    ("15PP", "15PP: ABC / 3TC + DTG"),
    ("15PA", "15PA: ABC 120 / 3TC 60 + DTG 50"),
    ("16P", "16P: ABC / 3TC + RAL"),
    ("17PP", "17PP: ABC 120 / 3TC 60 + EFV 200"),
    ("17PA", "17PA: ABC 600 / 3TC 300 + EFV 200"),
    ("non_standard", "Non standard"),
]
# Two extra codes counted only by the weight-band dispensation report.
WEIGHT_REPORT_EXTRA_REGIMENS = [
    ("4P", "4P: AZT / 3TC + EFV"),
    ("11P", "11P: AZT / 3TC + LPV/r (previous AZT3TCLPV)"),
]

# --- FIXED VALUES: facilities and outreach clinics --------------------------
FACILITIES = [
    "Neno District Hospital", "Chifunga HC", "Midzemba HC", "Facility D", "Facility E",
]
# outreach clinic -> parent facility (the stored name of one clinic carries a
# trailing blank; comparisons ignore trailing blanks)
OUTREACH_PARENT = [
    ("Binje Outreach Clinic", "Neno District Hospital"),
    ("Ntaja Outreach Clinic", "Neno District Hospital"),
    ("Golden Outreach Clinic", "Neno District Hospital"),
    ("Felemu Outreach Clinic", "Chifunga HC"),
    ("Kasamba Outreach Clinic ", "Midzemba HC"),
]

# --- FIXED VALUES: report thresholds ----------------------------------------
MOH_CUTOFF_DAYS = 60
PEPFAR_CUTOFF_DAYS = 30
BIRTHDATE_DIVIDER = 30          # age is counted in 30-day months
MMD_LOW_DAYS = 80               # dispensing < 80 days -> "<3 months"
MMD_HIGH_DAYS = 168             # 80..168 -> "3-5 months", > 168 -> "6+"
HTN_SYSTOLIC = 140
HTN_DIASTOLIC = 90
VL_SUPPRESSED_BELOW = 1000
VL_TEST_AGE_DAYS = 365
TPT_3HP_PILLS = 33
TPT_6H_PILLS = 144
IIT_SHORT_DAYS = 90
IIT_LONG_DAYS = 180
RTT_APPT_GRACE_DAYS = 28
CD4_THRESHOLD = 200
