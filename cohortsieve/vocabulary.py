"""Values the data and the results are fixed to.

Everything in this module is a fixed value: it has to equal, character for character, what the
source tables hold or what readers of the result tables expect.
"""

# Attribute names in the measurement table, keyed by the column they become.
MARKERS = {
    "her2_status": "HER2/neu",
    "er_status": "Estrogen receptor",
    "pr_status": "Progesterone receptor",
}
MARKER_LABELS = {"her2_status": "HER2", "er_status": "ER", "pr_status": "PR"}

# Statuses.
POSITIVE, NEGATIVE, UNKNOWN = "Positive", "Negative", "Unknown"
STATUSES = [POSITIVE, NEGATIVE, UNKNOWN]

# Diagnosis, drugs, observations and note kinds.
DIAGNOSIS = "Malignant neoplasm of breast"
THERAPIES = {
    "had_anti_her2_therapy": ["Trastuzumab", "Pertuzumab"],
    "had_endocrine_therapy": ["Letrozole", "Tamoxifen"],
}
OBSERVATIONS = {"menopausal_status": "Menopausal status", "ajcc_stage": "AJCC stage"}
POSTMENOPAUSAL = "Postmenopausal"
PATHOLOGY_REPORT = "PATHOLOGY_REPORT"

# Where a status came from.
FROM_FACTS, FROM_NOTES, FROM_BOTH = "structured", "nlp", "both"

# The three seeded trials. None means the trial leaves that field open.
TRIAL_COLUMNS = (
    "trial_id string, trial_name string, status string, req_sex string, age_min int, age_max int, "
    "req_her2 string, req_er string, req_pr string, req_menopausal string, "
    "req_no_prior_anti_her2 boolean, min_ecog int, eligibility_text string"
)
TRIALS = [
    ("A", "HER2-Positive Breast Cancer Study", "Recruiting", "Female", 18, 75,
     "Positive", None, None, None, True, 1,
     "HER2-positive breast cancer, age 18-75, no prior anti-HER2 therapy."),
    ("B", "ER-Positive / HER2-Negative Study", "Recruiting", "Female", 18, 75,
     "Negative", "Positive", None, "Postmenopausal", None, None,
     "ER-positive, HER2-negative, postmenopausal breast cancer, age 18-75."),
    ("C", "Triple-Negative Breast Cancer Study", "Recruiting", "Female", 18, 75,
     "Negative", "Negative", "Negative", None, None, None,
     "Triple-negative breast cancer (HER2-, ER-, PR-), age 18-75."),
]
