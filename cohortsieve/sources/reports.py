"""Report sentences for the test notes, with the answers of both rule sets set by hand.

Each entry: text, then HER2, ER and PR as the careful rules should read them, then as the terse ones should
(P, N, U: Positive, Negative, Unknown). Both engines read the texts and the answers; no pattern of the rules is used here.
"""

from __future__ import annotations

# Phrases that reports use and that must be read verbatim.
FIXED_PHRASES = [
    ("HER2: negative (2+ by IHC; FISH: ratio 1.4, non-amplified)", "NUU", "UUU"),
    ("HER2: Negative (1+ by IHC, FISH not performed)", "NUU", "NUU"),
    ("HER2/neu: Positive by FISH (HER2/CEP17 ratio 2.4)", "PUU", "PUU"),
    ("HER2/neu amplification: NOT detected (FISH ratio 1.4)", "NUU", "NUU"),
    ("HER2 (c-erbB-2): 2+ (equivocal by IHC; FISH reflex testing recommended)", "UUU", "UUU"),
    ("Estrogen receptor: weak nuclear staining in 4% of cells, Allred 3/8", "UPU", "UUU"),
    ("ER: Negative — no significant nuclear reactivity observed", "UNU", "UNU"),
    ("PR: Negative — no progesterone receptor expression detected", "UUN", "UUN"),
]

SENTENCES = [
    ("Patient with prior lumpectomy. HER2: Positive (3+), ER: 95%", "PPU", "PUU"),
    ("ER positive 90%, unchanged from prior biopsy", "UPU", "UPU"),
    ("HER2 IHC 1+; previously 3+", "NUU", "UUU"),
    ("The HER2 result of this patient was not positive", "NUU", "NUU"),
    ("HER2: 2+ equivocal\nReflex dual-probe FISH:\nratio 2.1, copy number 4.6", "PUU", "UUU"),
    ("HER2: 2+ equivocal\nADDENDUM\nHER2 FISH:\n  ratio 1.6,\n  copy number 3.1", "NUU", "UUU"),
    ("The earlier biopsy was HER2-negative.", "UUU", "UUU"),
    ("Prior biopsy HER2 negative, now 3+ by IHC", "PUU", "UUU"),
    ("Prior HER2: positive (3+). Current HER2: negative (1+).", "NUU", "NUU"),
    ("CLINICAL HISTORY: mass found in 2015. HER2 positive.\nHER2: 1+", "NUU", "UUU"),
    ("No evidence of HER2 amplification by FISH", "NUU", "NUU"),
    ("FISH failed to show HER2 amplification", "NUU", "NUU"),
    ("HER2 was not overexpressed (1+)", "NUU", "NUU"),
    ("HER2 is not negative", "UUU", "UUU"),
    ("The tumor is positive for ER and PR, negative for HER2", "NPP", "NPP"),
    ("ER and PR were both negative", "UNN", "UNN"),
    ("Estrogen and progesterone receptors: negative", "UNN", "UNN"),
    ("Estrogen receptor: not reactive", "UNU", "UNU"),
    ("ER: no significant staining", "UNU", "UNU"),
    ("If HER2 is positive, trastuzumab is planned", "UUU", "UUU"),
    ("Her mother had an ER positive tumor. ER: negative", "UNU", "UNU"),
    ("HER2 status pending, ER: 80% of nuclei", "UPU", "UUU"),
    ("HER2: not positive by IHC (2+); FISH ratio 2.6, copy number 5.0", "PUU", "UUU"),
    ("ER: positive (95%) although PR: negative", "UPN", "UPN"),
    ("Compared with the previous specimen (HER2 3+), HER2 is now 1+", "NUU", "UUU"),
    ("PR positive in 40% of nuclei, formerly negative", "UUP", "UUP"),
    ("PR: negative, formerly positive (60%)", "UUN", "UUN"),
    ("ER weakly positive (3%)", "UPU", "UPU"),
    ("Sister: HER2 positive cancer\nHER2: 0 (negative)", "NUU", "NUU"),
    ("HER2 cannot be called positive: 1+ in most cells", "NUU", "NUU"),
    ("Specimen insufficient for HER2, ER: Positive", "UPU", "UPU"),
    ("HER2 testing was requested.\nER: 0% of nuclei", "UNU", "UUU"),
]

# What follows the sentence in a note; a result here comes later and holds.
PANELS = [
    ("End of report.", "UUU", "UUU"),
    ("Receptors: ER 85% of nuclei, PR 40%.", "UPP", "UUU"),
    ("ER: negative\nPR: negative", "UNN", "UNN"),
    ("HER2: negative (1+). ER: positive (70%)", "NPU", "NPU"),
    ("HER2 3+ in all tumor cells", "PUU", "UUU"),
    ("ER: 0.5% of nuclei\nPR: 2% of nuclei", "UNP", "UUU"),
    ("HER2: negative\nER: negative\nPR: negative", "NNN", "NNN"),
]

REPORTS = SENTENCES + FIXED_PHRASES
STATUS = {"P": "Positive", "N": "Negative", "U": "Unknown"}
MARKERS, RULES = ("her2", "er", "pr"), ("careful", "terse")


def _literal(text: str) -> str:
    return " || chr(10) || ".join("'" + line.replace("'", "''") + "'" for line in text.split("\n"))


def text_sql(key: str) -> str:
    """The report that belongs to a whole number."""
    def pick(entries: list) -> str:
        cases = " ".join(f"WHEN {i} THEN {_literal(e[0])}" for i, e in enumerate(entries))
        return f"CASE {key} % {len(entries)} {cases} END"

    return f"{pick(REPORTS)} || chr(10) || {pick(PANELS)}"


def answer_sql(marker: str, rules: str, key: str) -> str:
    """The status that was set by hand for the report that belongs to a whole number."""
    m, r = MARKERS.index(marker), RULES.index(rules)

    def pick(entries: list) -> str:
        by_answer = {a: [str(i) for i, e in enumerate(entries) if e[1 + r][m] == a] for a in "PN"}
        cases = " ".join(f"WHEN {key} % {len(entries)} IN ({', '.join(ids)}) THEN '{STATUS[a]}'" for a, ids in by_answer.items() if ids)
        return f"CASE {cases} END"

    return f"coalesce({pick(PANELS)}, {pick(REPORTS)}, 'Unknown')"
