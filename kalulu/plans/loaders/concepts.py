"""Concept -> column maps of the wide warehouse loaders.

FIXED VALUES: concept names, coded answers and encounter types must equal the
clinical dictionary's stored strings; they are listed plainly, per loader,
in the order of the warehouse table's columns.
Each entry: (output column, concept, value kind, encounter-type filter or None).
"""

from __future__ import annotations

from kalulu import constants as K

NUMERIC, CODED, DATE, TEXT = "value_numeric", "value_coded", "value_date", "value_text"

# --- FIXED VALUES: ART follow-up visit (spine: ART_FOLLOWUP encounters) ----
ART_FOLLOWUP = [
    ("art_regimen", "Malawi Antiretroviral drugs received", CODED, None),
    ("art_drugs_received", "Malawi Antiretroviral drugs received", CODED, None),
    ("arvs_given_to", "Responsible person present", CODED, None),
    ("next_appointment_date", "Appointment date", DATE, K.ART_FOLLOWUP),
    ("condoms_given", "Number of Condoms dispensed", NUMERIC, None),
    ("depo_given", "Depo-Provera given", CODED, None),
    ("diastolic_bp", "Diastolic blood pressure", NUMERIC, None),
    ("doses_missed", "Number of HIV drug doses missed", NUMERIC, None),
    ("height", "Height (cm)", NUMERIC, None),
    ("arvs_given", "Number of antiretrovirals given", NUMERIC, None),
    ("pill_count", "Amount of drug brought to clinic", NUMERIC, None),
    ("pregnant_or_lactating", "Pregnant/Lactating", CODED, None),
    ("systolic_bp", "Systolic blood pressure", NUMERIC, None),
    ("tb_status", "TB status", CODED, None),
    ("weight", "Weight (kg)", NUMERIC, None),
]
# preventive drugs: drug obs (coded answer) paired with its "Amount Dispensed"
# obs through the observation group
TPT_CONCEPT = "HIV Preventive Therapy"
PILLS_CONCEPT = "Amount Dispensed"
TPT_DRUGS = [
    ("ctx_960", K.COTRIMOXAZOLE),
    ("inh_300", K.ISONIAZID),
    ("pyridoxine", K.PYRIDOXINE),
    ("rfp_150", K.RIFAPENTINE),
    ("rfp_inh", K.RFP_INH),
]
SIDE_EFFECTS_CONCEPT = "Malawi ART side effects"
SIDE_EFFECTS = [
    ("no_side_effect", "No"),
    ("peripheral_neuropathy_side_effect", "Peripheral neuropathy"),
    ("hepatitis_side_effect", "Hepatitis"),
    ("skin_rash_side_effect", "Skin rash"),
    ("lipodystrophy_side_effect", "Lipodystrophy"),
    ("other_side_effect", "Other"),
]

# --- FIXED VALUES: ART initial visit (spine: ART_INITIAL encounters) -------
ART_INITIAL = [
    ("art_first_line_regimen", "Malawi Antiretroviral drugs change 1", CODED, None),
    ("art_first_line_regimen_start_date", "Start date 1st line ARV", DATE, None),
    ("art_alternative_first_line_regimen", "Malawi Antiretroviral drugs change 2", CODED, None),
    ("art_alternative_first_line_regimen_date", "Date of starting alternative 1st line ARV regimen", DATE, None),
    ("art_second_line_regimen", "Malawi Antiretroviral drugs change 3", CODED, None),
    ("art_second_line_regimen_start_date", "Date of starting 2nd line ARV regimen", DATE, None),
    ("age_at_initiation", "Age", NUMERIC, None),
    ("cd4_count", "CD4 count", NUMERIC, None),
    ("cd4_date", "Date of CD4 count", DATE, None),
    ("clinical_stage", "WHO stage", CODED, None),
    ("confirmatory_test_date", "Date of HIV diagnosis", DATE, None),
    ("ever_taken_arvs", "Ever received ART?", CODED, None),
    ("height", "Height (cm)", NUMERIC, None),
    ("pregnant_or_lactating", "Pregnant/Lactating", CODED, None),
    ("tb_status", "Tuberculosis treatment status", CODED, None),
    ("transfer_in_date", "Transfer in date", DATE, None),
    ("weight", "Weight (kg)", NUMERIC, None),
    ("child_hcc_no", "Child HCC Registration Number", TEXT, None),
    ("art_education_date", "ART education date", DATE, None),
    ("art_education_done", "ARV education done", CODED, None),
    ("cd4_percentage", "Cd4%", NUMERIC, None),
    ("confirmatory_test_location", "Confirmatory HIV test location", TEXT, None),
    ("confirmatory_test_type", "First positive HIV test type", CODED, None),
    ("ks_side_effects_worsening_on_arvs", "Kaposis sarcoma side effects worsening while on ARVs?", CODED, None),
    ("last_arvs_taken", "Last antiretroviral drugs taken", TEXT, None),
    ("last_arvs_taken_date", "Date ART last taken", DATE, None),
    ("presumed_hiv_severe_present", "Presumed severe HIV criteria present", CODED, None),
    ("tb_registration_number", "TB registration number", TEXT, None),
    ("tb_treatment_start_date", "Tuberculosis drug treatment start date", DATE, None),
    ("who_clinical_conditions", "Clinical Conditions Text", TEXT, None),
    ("tb_xpert", "TB Xpert", CODED, None),
    ("tb_xpert_date", "Date of TB Xpert test", DATE, None),
    ("urine_lam", "Urine LAM / CrAg Result", CODED, None),
    ("urine_lam_date", "DNA-PCR Testing Result received Date 2", DATE, None),
    ("crag", "CrAg Results", CODED, None),
    ("crag_date", "Date of CrAg test", DATE, None),
]

# --- FIXED VALUES: ART visits (spine: ART_INITIAL and ART_FOLLOWUP) ---------
ART_VISITS = [
    ("next_appointment_date", "Appointment date", DATE, K.ART_FOLLOWUP),
    ("art_drug_regimen", "Malawi Antiretroviral drugs received", CODED, None),
]

# --- FIXED VALUES: viral-load lab results -----------------------------------
VL_SAMPLE = "Sample taken for Viral Load"
VL_LDL = "Lower than Detection Limit"
VL_LESS_THAN = "Less than limit"
VL_RESULT = "HIV viral load"
VL_TEST_TYPE = "Viral Load"
VL_LDL_TEXT = "Lower than Detection Limit"

# --- FIXED VALUES: observation-group (construct) concepts ------------------
NVP_CONSTRUCT = "Age at start of Neviripine construct"
SEROLOGY_CONSTRUCT = "Child HIV serology construct"
GROUP_CONCEPTS = [NVP_CONSTRUCT, SEROLOGY_CONSTRUCT, "Other construct"]

# --- FIXED VALUES: exposed-child follow-up (spine: EXPOSED_CHILD_FOLLOWUP) --
_ECF, _ECI = K.EXPOSED_CHILD_FOLLOWUP, K.EXPOSED_CHILD_INITIAL
EID_FOLLOWUP = [
    ("breast_feeding", "Breast feeding", CODED, _ECF),
    ("clinical_monitoring", "Clinical Monitoring Exposed Child", CODED, _ECF),
    ("height", "Height (cm)", NUMERIC, None),
    ("mother_status", "Mother HIV Status", CODED, _ECF),
    ("next_appointment_date", "Appointment date", DATE, _ECF),
    ("wasting_or_malnutrition", "Wasting/malnutrition", CODED, _ECF),
    ("weight", "Weight (kg)", NUMERIC, None),
    ("cpt", "Number of CPT tablets dispensed", NUMERIC, _ECF),
    ("hiv_infection", "Childs current HIV status", CODED, _ECF),
    ("muac", "Middle upper arm circumference (cm)", NUMERIC, _ECF),
]

# --- FIXED VALUES: exposed-child initial visit (spine: EXPOSED_CHILD_INITIAL)
# 5th element: the concept of the observation group the obs must belong to
EID_INITIAL = [
    ("age", "Age", NUMERIC, _ECI),
    ("age_when_starting_nvp", "Patient age when result to guardian", NUMERIC, _ECI, NVP_CONSTRUCT),
    ("birth_weight", "Birth weight", NUMERIC, _ECI),
    ("duration_type_when_starting_nvp", "Units of age of child", CODED, _ECI, NVP_CONSTRUCT),
    ("mother_art_reg_no", "Mother ART registration number", TEXT, _ECI),
    ("mother_art_start_date", "Mother art start date", DATE, _ECI),
    ("mother_hiv_status", "Mother HIV Status", CODED, _ECI),
    ("nvp_duration", "Medication duration", NUMERIC, _ECI),
    ("nvp_duration_type", "Time units", CODED, _ECI),
]

# value and unit recorded in one observation group
EID_INITIAL_PAIRS = [("age_when_starting_nvp", "duration_type_when_starting_nvp"), ("nvp_duration", "nvp_duration_type")]

# --- FIXED VALUES: exposed-child visits (spine: both child encounter types) -
EID_VISITS = [
    ("next_appointment_date", "Appointment date", DATE, _ECF),
    ("breastfeeding_status", "Breast feeding", CODED, None),
    ("mother_status", "Mother HIV Status", CODED, None),
]

# --- FIXED VALUES: EID laboratory tests (spine: EID Screening) --------------
_EID = K.EID_SCREENING
EID_LAB_TESTS = [
    ("result_date", "Date of returned result", DATE, _EID),
    ("test_type", "HIV test type", CODED, _EID),
    ("lab_laboratory", "Location of laboratory", CODED, _EID),
    ("reasons_for_testing", "Reason for testing (coded)", CODED, _EID),
    ("hiv_result", "Result of HIV test", CODED, _EID),
    ("sample_id", "Lab test serial number", TEXT, _EID),
]

# --- FIXED VALUES: pre-ART visits (spine: PART_INITIAL and PART_FOLLOWUP) ---
PRE_ART_VISITS = [
    ("next_appointment_date", "Appointment date", DATE, None),
]

# --- FIXED VALUES: viral-load screening (spine: Viral Load Screening) -------
# reason_for_test anchors the observation group; the others must share it
_VLS = K.VIRAL_LOAD_SCREENING
ART_VIRAL_LOAD_ANCHOR = ("reason_for_test", "Reason for testing (coded)", CODED, _VLS)
ART_VIRAL_LOAD = [
    ("ldl", "Lower than Detection Limit", CODED, _VLS),
    ("bled", "Sample taken for Viral Load", CODED, _VLS),
    ("lab_location", "Location of laboratory", CODED, _VLS),
    ("less_than_limit", "Less than limit", NUMERIC, _VLS),
    ("other_results", "Reason for no result", CODED, _VLS),
    ("sample_id", "Viral Load Sample ID", TEXT, _VLS),
    ("viral_load_result", "HIV viral load", NUMERIC, _VLS),
]

# --- FIXED VALUES: ART follow-up testing (spine: ART_FOLLOWUP_UP_TESTING) ---
_AFT = K.ART_FOLLOWUP_TESTING
FOLLOWUP_TESTING_REQUIRED = ("cd4_count", "CD4 count", NUMERIC, _AFT)
FOLLOWUP_TESTING = [
    ("cd4_pct", "Cd4%", NUMERIC, _AFT),
    ("phq_nine_score", "PHQ 9 Score", NUMERIC, _AFT),
    ("serum_glucose", "Serum glucose", NUMERIC, _AFT),
    ("test_type", "Blood sugar test type", CODED, _AFT),
]

# --- FIXED VALUES: child HIV serology (lab tests, HIV) ----------------------
HIV_SAMPLE_DATE = "Date of blood sample"
HIV_RESULT_DATE = "Date of returned result"
HIV_RESULT = "Result of HIV test"
HIV_TEST_TYPE = "HIV test type"
HIV_DEFAULT_TEST_TYPE = "HIV test"
BREASTFEEDING_STOPPED = "Breastfeeding stopped over 6 weeks ago"
MOTHER_ART_NUMBER = "Mother ART registration number"

# Every concept the fixture cycles through (fixture only; built from the maps).
ALL_CONCEPTS = sorted({e[1] for e in ART_FOLLOWUP + ART_INITIAL + ART_VISITS + EID_FOLLOWUP + EID_INITIAL
                       + EID_VISITS + EID_LAB_TESTS + PRE_ART_VISITS + ART_VIRAL_LOAD + FOLLOWUP_TESTING
                       + [ART_VIRAL_LOAD_ANCHOR, FOLLOWUP_TESTING_REQUIRED]}
                      | {TPT_CONCEPT, PILLS_CONCEPT, SIDE_EFFECTS_CONCEPT,
                         VL_SAMPLE, VL_LDL, VL_LESS_THAN, VL_RESULT, HIV_SAMPLE_DATE})
ALL_CODED = sorted({v for _, v in TPT_DRUGS} | {v for _, v in SIDE_EFFECTS}
                   | {"Yes", "True", K.PREGNANT, K.BREASTFEEDING, K.ROUTINE, K.TARGET, "Positive", "Negative",
                      BREASTFEEDING_STOPPED}
                   | set(K.TB_STATUSES) | {t for _, t in K.REGIMENS[:6]})

# --- FIXED VALUES: regimen lines (coded regimen concept, its start-date concept)
REGIMEN_LINES = [
    (0, "Malawi Antiretroviral drugs change 1", "Start date 1st line ARV"),
    (1, "Malawi Antiretroviral drugs change 2", "Date of starting alternative 1st line ARV regimen"),
    (2, "Malawi Antiretroviral drugs change 3", "Date of starting 2nd line ARV regimen"),
]
