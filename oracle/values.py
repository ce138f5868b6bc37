"""

FIXED VALUES: concepts, answers, types, states and texts as the source stores them.
"""

# (column, concept, kind of value, encounter type or None, concept of the observation group or None)
ART_VIRAL_LOAD = [
    ('ldl', 'Lower than Detection Limit', 'value_coded', 'Viral Load Screening', None),
    ('bled', 'Sample taken for Viral Load', 'value_coded', 'Viral Load Screening', None),
    ('lab_location', 'Location of laboratory', 'value_coded', 'Viral Load Screening', None),
    ('less_than_limit', 'Less than limit', 'value_numeric', 'Viral Load Screening', None),
    ('other_results', 'Reason for no result', 'value_coded', 'Viral Load Screening', None),
    ('reason_for_test', 'Reason for testing (coded)', 'value_coded', 'Viral Load Screening', None),
    ('sample_id', 'Viral Load Sample ID', 'value_text', 'Viral Load Screening', None),
    ('viral_load_result', 'HIV viral load', 'value_numeric', 'Viral Load Screening', None),
]
FOLLOWUP_TESTING = [
    ('cd4_count', 'CD4 count', 'value_numeric', 'ART_FOLLOWUP_UP_TESTING', None),
    ('cd4_pct', 'Cd4%', 'value_numeric', 'ART_FOLLOWUP_UP_TESTING', None),
    ('phq_nine_score', 'PHQ 9 Score', 'value_numeric', 'ART_FOLLOWUP_UP_TESTING', None),
    ('serum_glucose', 'Serum glucose', 'value_numeric', 'ART_FOLLOWUP_UP_TESTING', None),
    ('test_type', 'Blood sugar test type', 'value_coded', 'ART_FOLLOWUP_UP_TESTING', None),
]
ART_FOLLOWUP = [
    ('art_regimen', 'Malawi Antiretroviral drugs received', 'value_coded', None, None),
    ('arvs_given_to', 'Responsible person present', 'value_coded', None, None),
    ('next_appointment_date', 'Appointment date', 'value_date', 'ART_FOLLOWUP', None),
    ('condoms_given', 'Number of Condoms dispensed', 'value_numeric', None, None),
    ('depo_given', 'Depo-Provera given', 'value_coded', None, None),
    ('diastolic_bp', 'Diastolic blood pressure', 'value_numeric', None, None),
    ('doses_missed', 'Number of HIV drug doses missed', 'value_numeric', None, None),
    ('height', 'Height (cm)', 'value_numeric', None, None),
    ('art_drugs_received', 'Malawi Antiretroviral drugs received', 'value_coded', None, None),
    ('arvs_given', 'Number of antiretrovirals given', 'value_numeric', None, None),
    ('pill_count', 'Amount of drug brought to clinic', 'value_numeric', None, None),
    ('pregnant_or_lactating', 'Pregnant/Lactating', 'value_coded', None, None),
    ('systolic_bp', 'Systolic blood pressure', 'value_numeric', None, None),
    ('tb_status', 'TB status', 'value_coded', None, None),
    ('weight', 'Weight (kg)', 'value_numeric', None, None),
]
ART_INITIAL = [
    ('art_second_line_regimen_start_date', 'Date of starting 2nd line ARV regimen', 'value_date', None, None),
    ('art_alternative_first_line_regimen_date', 'Date of starting alternative 1st line ARV regimen', 'value_date', None, None),
    ('art_alternative_first_line_regimen', 'Malawi Antiretroviral drugs change 2', 'value_coded', None, None),
    ('art_first_line_regimen', 'Malawi Antiretroviral drugs change 1', 'value_coded', None, None),
    ('art_first_line_regimen_start_date', 'Start date 1st line ARV', 'value_date', None, None),
    ('art_second_line_regimen', 'Malawi Antiretroviral drugs change 3', 'value_coded', None, None),
    ('art_education_date', 'ART education date', 'value_date', None, None),
    ('art_education_done', 'ARV education done', 'value_coded', None, None),
    ('age_at_initiation', 'Age', 'value_numeric', None, None),
    ('cd4_count', 'CD4 count', 'value_numeric', None, None),
    ('cd4_date', 'Date of CD4 count', 'value_date', None, None),
    ('cd4_percentage', 'Cd4%', 'value_numeric', None, None),
    ('child_hcc_no', 'Child HCC Registration Number', 'value_text', None, None),
    ('clinical_stage', 'WHO stage', 'value_coded', None, None),
    ('confirmatory_test_date', 'Date of HIV diagnosis', 'value_date', None, None),
    ('confirmatory_test_location', 'Confirmatory HIV test location', 'value_text', None, None),
    ('confirmatory_test_type', 'First positive HIV test type', 'value_coded', None, None),
    ('ever_taken_arvs', 'Ever received ART?', 'value_coded', None, None),
    ('height', 'Height (cm)', 'value_numeric', None, None),
    ('ks_side_effects_worsening_on_arvs', 'Kaposis sarcoma side effects worsening while on ARVs?', 'value_coded', None, None),
    ('last_arvs_taken', 'Last antiretroviral drugs taken', 'value_text', None, None),
    ('last_arvs_taken_date', 'Date ART last taken', 'value_date', None, None),
    ('pregnant_or_lactating', 'Pregnant/Lactating', 'value_coded', None, None),
    ('presumed_hiv_severe_present', 'Presumed severe HIV criteria present', 'value_coded', None, None),
    ('tb_registration_number', 'TB registration number', 'value_text', None, None),
    ('tb_status', 'Tuberculosis treatment status', 'value_coded', None, None),
    ('tb_treatment_start_date', 'Tuberculosis drug treatment start date', 'value_date', None, None),
    ('transfer_in_date', 'Transfer in date', 'value_date', None, None),
    ('who_clinical_conditions', 'Clinical Conditions Text', 'value_text', None, None),
    ('weight', 'Weight (kg)', 'value_numeric', None, None),
    ('tb_xpert', 'TB Xpert', 'value_coded', None, None),
    ('tb_xpert_date', 'Date of TB Xpert test', 'value_date', None, None),
    ('urine_lam', 'Urine LAM / CrAg Result', 'value_coded', None, None),
    ('urine_lam_date', 'DNA-PCR Testing Result received Date 2', 'value_date', None, None),
    ('crag', 'CrAg Results', 'value_coded', None, None),
    ('crag_date', 'Date of CrAg test', 'value_date', None, None),
]
ART_VISITS = [
    ('next_appointment_date', 'Appointment date', 'value_date', 'ART_FOLLOWUP', None),
    ('art_drug_regimen', 'Malawi Antiretroviral drugs received', 'value_coded', None, None),
]
EID_FOLLOWUP = [
    ('breast_feeding', 'Breast feeding', 'value_coded', 'EXPOSED_CHILD_FOLLOWUP', None),
    ('clinical_monitoring', 'Clinical Monitoring Exposed Child', 'value_coded', 'EXPOSED_CHILD_FOLLOWUP', None),
    ('height', 'Height (cm)', 'value_numeric', None, None),
    ('mother_status', 'Mother HIV Status', 'value_coded', 'EXPOSED_CHILD_FOLLOWUP', None),
    ('next_appointment_date', 'Appointment date', 'value_date', 'EXPOSED_CHILD_FOLLOWUP', None),
    ('wasting_or_malnutrition', 'Wasting/malnutrition', 'value_coded', 'EXPOSED_CHILD_FOLLOWUP', None),
    ('weight', 'Weight (kg)', 'value_numeric', None, None),
    ('cpt', 'Number of CPT tablets dispensed', 'value_numeric', 'EXPOSED_CHILD_FOLLOWUP', None),
    ('hiv_infection', 'Childs current HIV status', 'value_coded', 'EXPOSED_CHILD_FOLLOWUP', None),
    ('muac', 'Middle upper arm circumference (cm)', 'value_numeric', 'EXPOSED_CHILD_FOLLOWUP', None),
]
EID_INITIAL = [
    ('age', 'Age', 'value_numeric', 'EXPOSED_CHILD_INITIAL', None),
    ('age_when_starting_nvp', 'Patient age when result to guardian', 'value_numeric', 'EXPOSED_CHILD_INITIAL', 'Age at start of Neviripine construct'),
    ('birth_weight', 'Birth weight', 'value_numeric', 'EXPOSED_CHILD_INITIAL', None),
    ('duration_type_when_starting_nvp', 'Units of age of child', 'value_coded', 'EXPOSED_CHILD_INITIAL', 'Age at start of Neviripine construct'),
    ('mother_art_reg_no', 'Mother ART registration number', 'value_text', 'EXPOSED_CHILD_INITIAL', None),
    ('mother_art_start_date', 'Mother art start date', 'value_date', 'EXPOSED_CHILD_INITIAL', None),
    ('mother_hiv_status', 'Mother HIV Status', 'value_coded', 'EXPOSED_CHILD_INITIAL', None),
    ('nvp_duration', 'Medication duration', 'value_numeric', 'EXPOSED_CHILD_INITIAL', None),
    ('nvp_duration_type', 'Time units', 'value_coded', 'EXPOSED_CHILD_INITIAL', None),
]
EID_LAB_TESTS = [
    ('result_date', 'Date of returned result', 'value_date', 'EID Screening', None),
    ('test_type', 'HIV test type', 'value_coded', 'EID Screening', None),
    ('lab_laboratory', 'Location of laboratory', 'value_coded', 'EID Screening', None),
    ('reasons_for_testing', 'Reason for testing (coded)', 'value_coded', 'EID Screening', None),
    ('hiv_result', 'Result of HIV test', 'value_coded', 'EID Screening', None),
    ('sample_id', 'Lab test serial number', 'value_text', 'EID Screening', None),
]
EID_VISITS = [
    ('next_appointment_date', 'Appointment date', 'value_date', 'EXPOSED_CHILD_FOLLOWUP', None),
    ('breastfeeding_status', 'Breast feeding', 'value_coded', None, None),
    ('mother_status', 'Mother HIV Status', 'value_coded', None, None),
]
PRE_ART_VISITS = [
    ('next_appointment_date', 'Appointment date', 'value_date', None, None),
]
DRUG_CONCEPT, PILLS_CONCEPT = "HIV Preventive Therapy", "Amount Dispensed"
DRUGS = [
    ('ctx_960', 'Trimethoprim and sulfamethoxazole'),
    ('inh_300', 'Isoniazid'),
    ('pyridoxine', 'Pyridoxine'),
    ('rfp_150', 'Rifapentine'),
    ('rfp_inh', '3HP (Rifapentine and Isoniazid)'),
]
REGIMENS = [
    ('0A', '0A: ABC/3TC + NVP'),
    ('2A', '2A: AZT / 3TC / NVP (previous AZT)'),
    ('4A', '4A: AZT / 3TC + EFV (previous AZTEFV)'),
    ('5A', '5A: TDF / 3TC / EFV'),
    ('6A', '6A: TDF / 3TC + NVP'),
    ('7A', '7A: TDF / 3TC + ATV/r'),
    ('8A', '8A: AZT / 3TC + ATV/r'),
    ('9A', '9A: ABC / 3TC + LPV/r'),
    ('10A', '10A: TDF / 3TC + LPV/r'),
    ('11A', '11A: AZT / 3TC + LPV'),
    ('12A', '12A: DRV + r + DTG'),
    ('13A', '13A: TDF / 3TC / DTG'),
    ('14A', '14A: AZT / 3TC + DTG'),
    ('15A', '15A: ABC / 3TC + DTG'),
    ('16A', '16A: ABC / 3TC + RAL'),
    ('17A', '17A: ABC / 3TC + EFV'),
    ('0P', '0P: ABC/3TC + NVP'),
    ('2P', '2P: AZT / 3TC / NVP'),
    ('4PP', '4PP: AZT 60 / 3TC 30 + EFV 200'),
    ('4PA', '4PA: AZT 300 / 3TC 150 + EFV 200'),
    ('9PP', '9PP: ABC 120 / 3TC 60 + LPV/r 100/25'),
    ('9PA', '9PA: ABC 600 / 3TC 300 + LPV/r 100/25'),
    ('11PP', '11PP: AZT 60 / 3TC 30 + LPV/r 100/25'),
    ('11PA', '11PA: AZT 300 / 3TC 150 + LPV/r 100/25'),
    ('12PP', '12PP: DRV 150 + r 50 + DTG 10 (± NRTIs)'),
    ('12PA', '12PA: DRV 150 + r 50 + DTG 50'),
    ('14PP', '14PP: AZT 60 / 3TC 30 + DTG 10'),
    ('14PA', '14PA: AZT 60 / 3TC 30 + DTG 50'),
    ('15P', '15P: ABC / 3TC + DTG'),
    ('15PP', '15PP: ABC / 3TC + DTG'),
    ('15PA', '15PA: ABC 120 / 3TC 60 + DTG 50'),
    ('16P', '16P: ABC / 3TC + RAL'),
    ('17PP', '17PP: ABC 120 / 3TC 60 + EFV 200'),
    ('17PA', '17PA: ABC 600 / 3TC 300 + EFV 200'),
    ('non_standard', 'Non standard'),
]
WEIGHT_REGIMENS = [
    ('4P', '4P: AZT / 3TC + EFV'),
    ('11P', '11P: AZT / 3TC + LPV/r (previous AZT3TCLPV)'),
]
SIDE_EFFECT_CONCEPT = "Malawi ART side effects"
SIDE_EFFECTS = [("no_side_effect", "No"), ("peripheral_neuropathy_side_effect", "Peripheral neuropathy"), ("hepatitis_side_effect", "Hepatitis"),
                ("skin_rash_side_effect", "Skin rash"), ("lipodystrophy_side_effect", "Lipodystrophy"), ("other_side_effect", "Other")]
REGIMEN_LINES = [
    (0, "Malawi Antiretroviral drugs change 1", "Start date 1st line ARV"),
    (1, "Malawi Antiretroviral drugs change 2", "Date of starting alternative 1st line ARV regimen"),
    (2, "Malawi Antiretroviral drugs change 3", "Date of starting 2nd line ARV regimen"),
]
SEROLOGY, NEVIRAPINE = "Child HIV serology construct", "Age at start of Neviripine construct"
MOTHER_NUMBER = "Mother ART registration number"
STOPPED_FEEDING = "Breastfeeding stopped over 6 weeks ago"
TB_STATUSES = ["TB suspected", "TB NOT suspected", "Confirmed TB on treatment", "Confirmed TB NOT on treatment"]
ENCOUNTER_TYPES = ["ART_INITIAL", "ART_FOLLOWUP", "ART_FOLLOWUP_UP_TESTING", "Viral Load Screening", "PART_INITIAL",
                   "PART_FOLLOWUP", "EXPOSED_CHILD_INITIAL", "EXPOSED_CHILD_FOLLOWUP", "EID Screening"]
FACILITIES = ["Neno District Hospital", "Chifunga HC", "Midzemba HC", "Facility D", "Facility E"]
PARENTS = [("Binje Outreach Clinic", 0), ("Ntaja Outreach Clinic", 0), ("Golden Outreach Clinic", 0),
           ("Felemu Outreach Clinic", 1), ("Kasamba Outreach Clinic", 2)]
AGE_LABELS = ["<1 year", "1-4 years", *[f"{a}-{a + 4} years" for a in range(5, 90, 5)], "90 plus years"]
WEIGHT_FROM = [3, 4, 5, 10, 14, 20, 25, 30, 35, 40, 50]
WEIGHT_LABELS = ["3 - 3.9 Kg", "4 - 4.9 Kg", "5 - 9.9 Kg", "10 - 13.9 Kg", "14 - 19.9 Kg", "20 - 24.9 Kg", "25 - 29.9 Kg",
                 "30 - 34.9 Kg", "35 - 39.9 Kg", "40 - 49.9 Kg", "50 Kg +", "Unknown"]
PREGNANCY = ["Patient Pregnant", "Currently breastfeeding child", "No", None]

# what the fixture cycles through: every concept that some loader reads, and answers
CONCEPTS = sorted(
    {e[1] for t in (ART_VIRAL_LOAD, FOLLOWUP_TESTING, ART_FOLLOWUP, ART_INITIAL, ART_VISITS, EID_FOLLOWUP, EID_INITIAL,
                    EID_LAB_TESTS, EID_VISITS, PRE_ART_VISITS) for e in t}
    | {DRUG_CONCEPT, PILLS_CONCEPT, SIDE_EFFECT_CONCEPT, "Date of blood sample"})
ANSWERS = sorted(
    {v for _, v in DRUGS} | {v for _, v in SIDE_EFFECTS} | set(TB_STATUSES) | {t for _, t in REGIMENS[:6]}
    | {"Yes", "True", "Positive", "Negative", "Routine", "Target", "Patient Pregnant", "Currently breastfeeding child",
       STOPPED_FEEDING})
