"""Fixed vocabularies.

FIXED VALUES. The canonical denial reasons, their synonyms, the action per
reason, the risk cut points and the care-gap/fraud thresholds below are
values that must match the reference's outputs; they are stated here once,
in their natural order. The name lists, specialty list and payer list are
this repo's own choices used to give the driver tables a healthcare shape.
"""

# --- fixed values that must equal the reference's --------------------------

# Canonical denial reasons, in the order the deterministic bucket assigns them.
DENIAL_REASONS = [
    "Prior Authorization Required",
    "Not Medically Necessary",
    "Coding Error",
    "Coverage Expired",
    "Duplicate Claim",
    "Out of Network",
    "Missing Documentation",
]

# Label variants folded onto the canonical reason; unknown labels pass through.
DENIAL_REASON_SYNONYMS = {
    "Prior Auth Required": "Prior Authorization Required",
    "Prior Authorization": "Prior Authorization Required",
    "Invalid Code": "Coding Error",
    "Coding": "Coding Error",
    "Not Medically Nec": "Not Medically Necessary",
    "Duplicate": "Duplicate Claim",
    "Out-of-Network": "Out of Network",
    "OON": "Out of Network",
    "Missing Docs": "Missing Documentation",
}

# Next step per canonical reason; anything else gets DEFAULT_DENIAL_ACTION.
DENIAL_ACTIONS = {
    "Prior Authorization Required": "Obtain prior authorization and resubmit",
    "Not Medically Necessary": "Submit additional clinical documentation",
    "Coding Error": "Correct coding and resubmit",
    "Coverage Expired": "Verify eligibility and resubmit",
    "Duplicate Claim": "Verify not a duplicate claim",
    "Out of Network": "Verify network status or obtain authorization",
    "Missing Documentation": "Gather missing documentation and resubmit",
}
DEFAULT_DENIAL_ACTION = "Review denial and resubmit"

ACUTE_ENCOUNTER_TYPES = ["inpatient", "emergency"]

# Clinical risk (E4): high-risk primary diagnoses and post-acute dispositions.
HIGH_RISK_ICD = ["I50.9", "J44.9", "N18.3"]
POST_ACUTE_DISPOSITIONS = ["SNF", "Rehab", "Home Health"]

# Risk tier cut points: (high, medium).
ENCOUNTER_RISK_CUTS = (0.7, 0.3)
CLAIM_RISK_CUTS = (0.6, 0.3)

# Adherence categories by PDC.
PDC_ADHERENT = 0.80
PDC_PARTIAL = 0.50

# --- this repo's own label choices for the driver-table bindings ------------

FIRST_NAMES = ["james", "mary", "robert", "patricia", "john", "jennifer",
               "michael", "linda"]
LAST_NAMES = ["smith", "johnson", "williams", "brown", "jones", "garcia",
              "miller", "davis", "rodriguez", "martinez", "hernandez", "lopez",
              "gonzalez", "wilson", "anderson", "thomas"]
SPECIALTIES = ["Cardiology", "Internal Medicine", "Orthopedics", "Pulmonology",
               "Emergency Medicine"]
DEPARTMENTS = ["Inpatient Services", "Outpatient Services", "Emergency Services"]
PAYER_NAMES = ["Medicare", "Medicaid", "Blue Cross Blue Shield", "Aetna",
               "UnitedHealthcare"]
PAYER_TYPES = ["Government", "Government", "Commercial", "Commercial",
               "Commercial"]
# orders.o_orderpriority -> encounter type
ENCOUNTER_TYPE_BY_PRIORITY = {
    "1-URGENT": "Emergency",
    "2-HIGH": "Inpatient",
    "3-MEDIUM": "Outpatient",
    "4-NOT SPECIFIED": "Observation",
    "5-LOW": "Telehealth",
}
# Standard codes that the part keys stand for in turn.
STANDARD_ICD = ["I10", "E11.9", "E78.5", "I25.10", "I50.9", "J44.9", "N18.3", "S72.001A", "Z00.00", "J06.9"]
DISCHARGE_DISPOSITIONS = ["Home", "Home Health", "SNF", "Rehab", "AMA"]
# Raw denial labels carried by some source claims (variants and one unknown).
RAW_DENIAL_LABELS = ["Prior Auth Required", "OON", "Missing Docs", "Coding",
                     "Timely Filing", "Not Medically Nec"]
