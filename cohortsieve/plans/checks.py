"""Independent SQL definitions of the build's frames, for checking results in another engine.

Written from the meaning of each table, not from the Spark code: the two must agree. What a note says about a marker follows from how the
note was made up (``reports``), so no pattern of the rules is read here.
"""

from __future__ import annotations

from cohortsieve import vocabulary as v
from cohortsieve.sources import fixtures, reports

# Answers set by hand for the report lines of the note view.
HER2_CAREFUL, ER_CAREFUL, PR_CAREFUL = (reports.answer_sql(m, "careful", "note_id") for m in reports.MARKERS)
HER2_TERSE, ER_TERSE, PR_TERSE = (reports.answer_sql(m, "terse", "note_id") for m in reports.MARKERS)


def _literal(value) -> str:
    if value is None:
        return "NULL"
    return str(value).lower() if isinstance(value, (bool, int)) else "'" + value.replace("'", "''") + "'"


_TRIAL_NAMES = ", ".join(c.split()[0].replace("status", "trial_status") for c in v.TRIAL_COLUMNS.split(", "))
_TRIAL_ROWS = ", ".join(f"({', '.join(map(_literal, row))})" for row in v.TRIALS)

# Per criterion, in the order failures are reported in: name, what a trial asks for, what a patient has (both as text), and whether that is met.
_SAME = "({asked} IS NULL) OR {has} = {asked}"
CRITERIA = [(name, asked, has, _SAME.format(asked=asked, has=has)) for name, asked, has in (
    ("her2", "req_her2", "her2_status"), ("er", "req_er", "er_status"), ("pr", "req_pr", "pr_status"), ("menopausal", "req_menopausal", "menopausal_status"))]
CRITERIA += [
    ("age", "age_min || ' to ' || age_max", "CAST(age_at_dx_years AS VARCHAR)", "age_at_dx_years BETWEEN age_min AND age_max"),
    # A stored false can never be met.
    ("prior_anti_her2", "CAST(req_no_prior_anti_her2 AS VARCHAR)", "CAST(prior_anti_her2 AS VARCHAR)",
     "CASE WHEN req_no_prior_anti_her2 IS NULL THEN true WHEN req_no_prior_anti_her2 THEN NOT prior_anti_her2 ELSE false END"),
    ("sex", "req_sex", "gender", "(req_sex IS NULL) OR upper(req_sex) = upper(gender)"),
]
# Wording of reasons.
_STATUS_WORDS = {"her2": "HER2", "er": "ER", "pr": "PR"}
_SUMMARY = " ".join(f"WHEN '{c}' THEN '{w} ' || has" for c, w in _STATUS_WORDS.items()) + " WHEN 'menopausal' THEN has WHEN 'age' THEN 'age ' || has"
_EXCLUDED = " ".join(f"WHEN '{c}' THEN '{w} is ' || coalesce(has, 'Unknown') || ' (need ' || asked || ')'" for c, w in _STATUS_WORDS.items()) + """
  WHEN 'menopausal' THEN coalesce(has, 'menopausal status unknown') || ' (need ' || asked || ')'
  WHEN 'age' THEN 'age ' || has || ' outside ' || asked WHEN 'prior_anti_her2' THEN 'prior anti-HER2 therapy'
  WHEN 'sex' THEN 'sex ' || has || ' (need ' || asked || ')'"""

# name -> (names it reads, SQL)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    name: ((), sql.format(**{i: i for i in fixtures.INPUTS[name]}))
    for name, sql in fixtures.VIEWS.items()
}
VIEWS |= {
    "profile": (("measurement",), """
SELECT person_id,
  max(value_source_value) FILTER (WHERE measurement_source_value = 'HER2/neu') AS her2_status,
  max(value_source_value) FILTER (WHERE measurement_source_value = 'Estrogen receptor') AS er_status,
  max(value_source_value) FILTER (WHERE measurement_source_value = 'Progesterone receptor') AS pr_status
FROM measurement
WHERE measurement_source_value IN ('Estrogen receptor', 'Progesterone receptor', 'HER2/neu')
GROUP BY person_id"""),
    "therapy": (("drug_exposure",), """
SELECT person_id,
  bool_or(drug_source_value IN ('Trastuzumab', 'Pertuzumab')) AS had_anti_her2_therapy,
  bool_or(drug_source_value IN ('Letrozole', 'Tamoxifen')) AS had_endocrine_therapy
FROM drug_exposure GROUP BY person_id"""),
    "demographics": (("person", "condition_occurrence", "observation"), """
SELECT person_id, gender_source_value,
  CAST(year(dx_date) - year_of_birth AS INT) AS age_at_dx_years, dx_date,
  (SELECT max(value_source_value) FROM observation o
   WHERE o.person_id = p.person_id AND o.observation_source_value = 'Menopausal status') AS menopausal_status,
  (SELECT max(value_source_value) FROM observation o
   WHERE o.person_id = p.person_id AND o.observation_source_value = 'AJCC stage') AS ajcc_stage
FROM person p JOIN (
  SELECT person_id, min(condition_start_date) AS dx_date FROM condition_occurrence
  WHERE condition_source_value = 'Malignant neoplasm of breast' GROUP BY person_id) USING (person_id)"""),
    "read_careful": (("note",), f"""
SELECT note_id, person_id, note_source_value, note_text, {HER2_CAREFUL} AS her2_status,
  {ER_CAREFUL} AS er_status, {PR_CAREFUL} AS pr_status FROM note"""),
    "read_terse": (("note",), f"""
SELECT note_id, person_id, note_source_value, note_text, {HER2_TERSE} AS her2_status,
  {ER_TERSE} AS er_status, {PR_TERSE} AS pr_status FROM note"""),
    "extracted": (("read_careful",), """
SELECT person_id, note_id, her2_status, er_status, pr_status, 'nlp' AS biomarker_source
FROM read_careful WHERE note_source_value = 'PATHOLOGY_REPORT'
QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY note_id DESC) = 1"""),
    "unified": (("profile", "extracted"), """
SELECT person_id, ifnull(s.her2_status, x.her2_status) AS her2_status,
  ifnull(s.er_status, x.er_status) AS er_status, ifnull(s.pr_status, x.pr_status) AS pr_status,
  'structured' AS biomarker_source
FROM profile s LEFT JOIN extracted x USING (person_id)
UNION ALL
SELECT person_id, her2_status, er_status, pr_status, 'nlp' FROM extracted
WHERE person_id NOT IN (SELECT person_id FROM profile WHERE person_id IS NOT NULL)"""),
    "trials": ((), f"SELECT * FROM (VALUES {_TRIAL_ROWS}) AS t({_TRIAL_NAMES})"),
    "patients": (("unified", "demographics", "therapy"), """
SELECT u.person_id, d.gender_source_value AS gender, d.age_at_dx_years, u.her2_status, u.er_status,
  u.pr_status, d.menopausal_status, d.ajcc_stage, u.biomarker_source,
  u.person_id IN (SELECT person_id FROM therapy WHERE had_anti_her2_therapy) AS prior_anti_her2
FROM unified u JOIN demographics d ON u.person_id = d.person_id"""),
    # One row per patient, trial and criterion: what the trial asks for, what the patient has, and whether that is enough. NULL asks for nothing.
    "tested": (("patients", "trials"), " UNION ALL ".join(
        f"SELECT person_id, trial_id, {place} AS place, '{name}' AS criterion, {asked} AS asked, {has} AS has, {met} AS met FROM patients, trials"
        for place, (name, asked, has, met) in enumerate(CRITERIA))),
    "outcome": (("tested",), """
SELECT person_id, trial_id, min(place) FILTER (WHERE met IS NOT TRUE) AS failed_place,
  min_by(criterion, place) FILTER (WHERE met IS NOT TRUE) AS first_failure
FROM tested GROUP BY person_id, trial_id"""),
    "flagged": (("tested", "patients", "trials"), """
SELECT p.*, t.*, f.* EXCLUDE (person_id, trial_id) FROM (SELECT person_id, trial_id, """ + ", ".join(
        f"bool_and(met) FILTER (WHERE criterion = '{name}') AS ok_{name}" for name, *_ in CRITERIA) + """
  FROM tested GROUP BY person_id, trial_id) f JOIN patients p ON p.person_id = f.person_id JOIN trials t ON t.trial_id = f.trial_id"""),
    "judged": (("flagged", "outcome"), """
SELECT f.*, o.first_failure FROM flagged f JOIN outcome o ON o.person_id = f.person_id AND o.trial_id = f.trial_id"""),
    # What is met is summed up in the order of the criteria; only statuses, menopause and age are named.
    "met_summary": (("tested", "outcome"), f"""
SELECT t.person_id, t.trial_id, string_agg(CASE criterion {_SUMMARY} END, ', ' ORDER BY place) AS met_list
FROM tested t JOIN outcome o ON o.person_id = t.person_id AND o.trial_id = t.trial_id
WHERE o.failed_place IS NULL AND asked IS NOT NULL GROUP BY t.person_id, t.trial_id"""),
    "prescreen": (("judged", "tested", "met_summary"), f"""
SELECT j.person_id, j.trial_id, trial_name, trial_status, gender, age_at_dx_years, her2_status, er_status,
  pr_status, menopausal_status, ajcc_stage, prior_anti_her2, biomarker_source, min_ecog,
  eligibility_text, first_failure IS NULL AS eligible,
  CASE WHEN first_failure IS NULL THEN 'Eligible: ' || met_list || ' (' || biomarker_source || ')'
    ELSE 'Excluded: ' || CASE first_failure {_EXCLUDED} END END AS reason
FROM judged j LEFT JOIN tested t ON t.person_id = j.person_id AND t.trial_id = j.trial_id AND t.criterion = j.first_failure
LEFT JOIN met_summary m ON m.person_id = j.person_id AND m.trial_id = j.trial_id"""),
    "goldset": (("note", "profile"), """
SELECT g.person_id, t.note_text, g.her2_status AS gold_her2, g.er_status AS gold_er, g.pr_status AS gold_pr
FROM profile g JOIN (SELECT person_id, max(note_text) AS note_text FROM note
  WHERE note_source_value = 'PATHOLOGY_REPORT' GROUP BY person_id) t ON t.person_id = g.person_id
WHERE NOT (g.her2_status IS NULL AND g.er_status IS NULL AND g.pr_status IS NULL)"""),
    # The number of the report that the gold set took; equal texts have equal answers.
    "numbered_gold": (("goldset", "note"), """
SELECT g.*, n.note_id FROM goldset g JOIN (SELECT person_id, arg_max(note_id, note_text) AS note_id FROM note
  WHERE note_source_value = 'PATHOLOGY_REPORT' GROUP BY person_id) n ON n.person_id = g.person_id"""),
    "preds": (("numbered_gold",), f"""
SELECT person_id, note_text, gold_her2, gold_er, gold_pr, 'careful' AS config, {HER2_CAREFUL} AS pred_her2,
  {ER_CAREFUL} AS pred_er, {PR_CAREFUL} AS pred_pr FROM numbered_gold
UNION ALL
SELECT person_id, note_text, gold_her2, gold_er, gold_pr, 'terse', {HER2_TERSE}, {ER_TERSE}, {PR_TERSE}
FROM numbered_gold"""),
    "pairs": (("preds",), """
SELECT person_id, note_text, config, 'HER2' AS marker, gold_her2 AS actual, pred_her2 AS predicted FROM preds
UNION ALL SELECT person_id, note_text, config, 'ER', gold_er, pred_er FROM preds
UNION ALL SELECT person_id, note_text, config, 'PR', gold_pr, pred_pr FROM preds"""),
    "latest_review": (("review",), """
SELECT * FROM review
QUALIFY row_number() OVER (PARTITION BY person_id, trial_id ORDER BY reviewed_at DESC, review_id DESC) = 1"""),
    "evidence": (("person", "profile", "extracted"), """
SELECT p.person_id, CASE
   WHEN p.person_id IN (SELECT person_id FROM profile) AND p.person_id IN (SELECT person_id FROM extracted) THEN 'both'
   WHEN p.person_id IN (SELECT person_id FROM profile) THEN 'structured-only'
   WHEN p.person_id IN (SELECT person_id FROM extracted) THEN 'notes-only'
   ELSE 'neither' END AS evidence
FROM person p"""),
    "timeline": (("measurement",), """
SELECT person_id, ifnull(measurement_date, CAST(measurement_datetime AS DATE)) AS measurement_date,
  measurement_source_value AS test_name,
  ifnull(value_source_value, CAST(value_as_number AS VARCHAR)) AS value, unit_source_value AS unit
FROM measurement WHERE person_id IS NOT NULL"""),
    "similarities": ((), """
SELECT a.vec_id, b.vec_id AS neighbour_id,
  round(list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[])
    / (greatest(sqrt(list_inner_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[])), 1e-9)
     * greatest(sqrt(list_inner_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[])), 1e-9)), 6) AS similarity
FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id"""),
    # A note's vector counts eight letters; patients are compared by their most similar notes.
    "note_vectors": (("note",), "SELECT person_id, [" + ", ".join(
        f"CAST(length(note_text) - length(replace(note_text, '{c}', '')) AS DOUBLE)" for c in "etaoinsr") + """] AS e
FROM note WHERE note_source_value = 'PATHOLOGY_REPORT'"""),
    "patients_alike": (("note_vectors",), """
SELECT person_id, neighbour_id, similarity, row_number() OVER (PARTITION BY person_id ORDER BY similarity DESC, neighbour_id) AS rank
FROM (SELECT a.person_id, b.person_id AS neighbour_id, max(round(list_inner_product(a.e, b.e)
    / (greatest(sqrt(list_inner_product(a.e, a.e)), 1e-9) * greatest(sqrt(list_inner_product(b.e, b.e)), 1e-9)), 6)) AS similarity
  FROM note_vectors a JOIN note_vectors b ON a.person_id <> b.person_id GROUP BY a.person_id, b.person_id)
QUALIFY rank <= 5"""),
    "neighbours": (("similarities",), """
SELECT vec_id, neighbour_id, similarity,
  row_number() OVER (PARTITION BY vec_id ORDER BY similarity DESC, neighbour_id) AS rank
FROM similarities QUALIFY rank <= 5"""),
}


def with_views(body: str, *names: str) -> str:
    """``body`` with the named definitions, and what they read, in front."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for need in VIEWS[name][0]:
                add(need)
            ordered.append(name)

    for name in names:
        add(name)
    if not ordered:
        return body.strip()
    head = ",\n".join(f"{n} AS ({VIEWS[n][1].strip()})" for n in ordered)
    return f"WITH {head}\nSELECT * FROM (\n{body.strip()}\n)"
