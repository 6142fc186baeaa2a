"""Label tables, weights and constants that results depend on, stated as they are."""

# Published imaging labels -> canonical modality.
MODALITY_ALIASES = {
    "computed tomography": "CT",
    "ct": "CT",
    "magnetic resonance imaging": "MRI",
    "mri": "MRI",
    "ultrasound": "Ultrasound",
    "plain radiography": "Plain Radiography",
    "x-ray": "Plain Radiography",
    "fluoroscopy": "Fluoroscopy",
    "nuclear medicine": "Nuclear Medicine",
}

# Published activity labels -> canonical activity type.
ACTIVITY_ALIASES = {
    "total elective admissions": "elective",
    "elective": "elective",
    "total outpatient attendances": "outpatient",
    "outpatient": "outpatient",
    "a&e attendances": "ae_attendance",
    "accident and emergency": "ae_attendance",
}

# Procedure chapter -> treatment function whose waiting list presses on it.
CHAPTER_TO_FUNCTION = {
    "W": "Trauma & Orthopaedics",
    "H": "Gastroenterology",
    "G": "Gastroenterology",
    "K": "Cardiology",
    "M": "Urology",
    "C": "Ophthalmology",
}

# Age bands counted as older population.
OLDER_BANDS = ("65-79", "80+")

# Unit cost per equipment category, used by the quarterly spend roll-up.
UNIT_COST_GBP = {
    "endoscope": 1800.0,
    "ortho_implant": 950.0,
    "cardiac_device": 4200.0,
    "imaging_consumable": 60.0,
    "surgical_kit": 120.0,
}

# Default code -> equipment weights (code, equipment, weight, map type, source).
PROCEDURE_EQUIPMENT = [
    ("W37", "ortho_implant", 1.0, "rule", "clinical_coding_W37_hip_replacement"),
    ("W37", "surgical_kit", 1.0, "rule", "theatre_standard"),
    ("W93", "ortho_implant", 0.8, "probabilistic", "revision_vs_primary_split"),
    ("W93", "surgical_kit", 1.0, "rule", "theatre_standard"),
    ("W40", "ortho_implant", 0.6, "probabilistic", "partial_joint_procedures"),
    ("H22", "endoscope", 1.0, "rule", "lower_GI_colonoscopy"),
    ("H22", "imaging_consumable", 0.2, "probabilistic", "biopsy_consumables"),
    ("H25", "endoscope", 1.0, "rule", "lower_GI_endoscopy"),
    ("G45", "endoscope", 1.0, "rule", "upper_GI_endoscopy"),
    ("G16", "endoscope", 1.0, "rule", "upper_GI_endoscopy"),
    ("K49", "cardiac_device", 0.35, "probabilistic", "pci_stent_subset"),
    ("K49", "imaging_consumable", 1.0, "rule", "cath_lab_contrast_kit"),
    ("K63", "cardiac_device", 0.9, "probabilistic", "pacing_device_implant"),
    ("C71", "surgical_kit", 1.0, "rule", "cataract_phaco_pack"),
    ("C71", "ortho_implant", 0.0, "rule", "not_applicable"),
    ("C75", "surgical_kit", 1.0, "rule", "ophthalmic_pack"),
    ("M47", "endoscope", 1.0, "rule", "cystoscopy"),
    ("M65", "endoscope", 0.7, "probabilistic", "diagnostic_vs_therapeutic"),
]

# Default equipment dimension (equipment, category, unit cost, reusable).
EQUIPMENT = [
    ("ortho_implant", "implant", 950.0, False),
    ("endoscope", "surgical", 1800.0, True),
    ("cardiac_device", "device", 4200.0, False),
    ("imaging_consumable", "consumable", 60.0, False),
    ("surgical_kit", "consumable", 120.0, False),
    ("ct_scanner_hours", "imaging", 0.0, True),
    ("mri_scanner_hours", "imaging", 0.0, True),
]

# Monthly feature windows.
MONTHLY_LAGS = (1, 2, 3, 6, 12)
MONTHLY_WINDOWS = (3, 6, 12)

# Device-day feature windows.
DAILY_LAGS = (1, 7, 14)
DAILY_WINDOWS = (7, 28)

# z of the 80 % band in demand propagation, and the rounder one of the window forecaster.
Z80 = 1.2816
Z80_WINDOW = 1.28

# Contract and pricing constants.
MIN_BILLABLE_SECONDS = 180.0
DAYS_PER_MONTH = 30.4
CV_LOADING = 0.5
BETA_LOADING = 0.3
EXPOSURE_FLOOR_HOURS = 0.5
WEEKEND_EXPOSURE_HOURS = 4.0
WEEKDAY_EXPOSURE_HOURS = 10.0
DEFAULT_CAP = 99
