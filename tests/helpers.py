"""Small frames for tests."""


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


PATIENT = ("person_id bigint, gender string, age_at_dx_years int, her2_status string, er_status string, "
           "pr_status string, menopausal_status string, ajcc_stage string, biomarker_source string, "
           "prior_anti_her2 boolean")


def patient(person_id, gender="FEMALE", age=50, her2="Positive", er="Positive", pr="Positive",
            meno="Postmenopausal", stage="Stage I", source="structured", prior=False):
    return (person_id, gender, age, her2, er, pr, meno, stage, source, prior)
