"""Reading marker statuses out of report text with ordered rules, all native Columns.

Every mention of a marker counts. Lines that cannot name a marker are set aside first by plain substring tests, which run far faster over
long reports than the patterns do; lines that go on from a marker's line are joined to it. Of each line only clauses
that assert a result are read (``clauses``). A *statement* is what follows a marker's name up to the next marker. Negated findings are written
out as negative before a rule set turns each statement (lower-cased) into a status. The last statement that is a result holds; requests
and equivocal grades are none, so a later FISH result settles an earlier 2+.
Two sets exist so that evaluation has something to tell apart: ``CAREFUL`` applies the clinical
cut-offs, ``TERSE`` only looks for literal words.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, functions as F

from cohortsieve.functions import clauses as C
from cohortsieve.vocabulary import NEGATIVE, POSITIVE, UNKNOWN

# Patterns.
_RECEPTOR_TAIL = (
    r"([ \t]*(?:[:=(/+-]|immunostain|status|(?:is|are|was|were)\b|(?:weakly |strongly )?(?:[Pp]ositive|POSITIVE)|[Nn]egative|NEGATIVE|[0-9.]+\s?%)[^\n]*)"
)
STATEMENT = {
    "her2_status": r"\b(?:HER|Her|her)-?2(?:/neu)?([^\n]*)",
    "er_status": r"(?:[Ee]strogen [Rr]eceptor|ESTROGEN RECEPTOR|\bER)" + _RECEPTOR_TAIL,
    "pr_status": r"(?:[Pp]rogesterone [Rr]eceptor|PROGESTERONE RECEPTOR|\bPR)" + _RECEPTOR_TAIL,
}
NEXT_MARKER = {
    "her2_status": r"[\s;,.](?:[Ee]strogen|ESTROGEN|ER\b|[Pp]rogesterone|PROGESTERONE|PR\b|Ki-67)[^\n]*",
    "er_status": r"[\s;,.](?:[Pp]rogesterone|PROGESTERONE|PR\b|(?:HER|Her|her)-?2|Ki-67)[^\n]*",
    "pr_status": r"[\s;,.](?:[Ee]strogen|ESTROGEN|ER\b|(?:HER|Her|her)-?2|Ki-67)[^\n]*",
}
# A line that names a marker holds one of these; they cover every way the patterns above can start.
NAMES_A_MARKER = ("ER", "er2", "er-2", "PR", "strogen", "STROGEN", "rogesterone")
IHC_STRONG = r"(^|[^0-9.])3\s?\+"
IHC_WEAK = r"(^|[^0-9.])[01]\s?\+|score 0|negative|^-($|[^a-z])"
EQUIVOCAL = r"2\s?\+|equivocal"
NOT_AMPLIFIED = r"not detected|non-?amplified|not amplified"
FISH_RATIO = r"ratio[ :=of]*([0-9]+(?:\.[0-9]+)?)"
FISH_COPIES = r"copy number[ :=of]*([0-9]+(?:\.[0-9]+)?)"
AMPLIFIED = r"^\+|positive|overexpress|amplified|detected"
# The first percentage of a statement is the marker's; background staining comes after it.
FIRST_PERCENT = r"([<>]?)\s*([0-9]+(?:\.[0-9]+)?)\s*%"
NEGATED_GRADE = r"\b(?:not|no|without)\s+[0-3]\s?\+"
FISH_AMPLIFIED = r"\bamplified"
# A marker's name, as it is left of a clause that is no result, and in the two rewritings below.
MARKER = r"\b(?:HER|Her|her)-?2(?:/neu)?|[Ee]strogen [Rr]eceptors?|ESTROGEN RECEPTOR|\bER\b(?:/PR\b)?|[Pp]rogesterone [Rr]eceptors?|PROGESTERONE RECEPTOR|\bPR\b"
# Two receptors named together share what is said; "negative for ER" and "no HER2 amplification" say it before the name.
BOTH_RECEPTORS = r"\b(?:ER|[Ee]strogen(?: [Rr]eceptors?)?)(?: \(ER\))?(?:,| and| &|, and) (?:PR\b|[Pp]rogesterone(?: [Rr]eceptors?)?(?: \(PR\))?)"
SAID_BEFORE = r"\b([Pp]ositive|POSITIVE|[Nn]egative|NEGATIVE) for (" + MARKER + r")(?:/neu)?"
DENIED_BEFORE = (r"(?i:\b(?:no evidence of|no sign of|without|no|lacks|lacking|absence of|(?:failed|fails) to (?:show|demonstrate|detect|reveal)"
                 r"|did not (?:show|demonstrate|reveal))) (" + MARKER + r")[ -](?i:(?:gene )?(?:amplification|over-?expression|positivity|reactivity|expression|staining))")
_NOT = r"\b(?:not|no|without|never|lack(?:s|ed|ing)?|absen(?:t|ce of)|fail(?:s|ed)? to|neither|cannot be called)\b"
NEGATES = r"\b(?:not|no|without|never|lack|lacks|lacked|lacking|absent|absence|fail|fails|failed|neither|cannot)\b"
NEGATED_AMPLIFIED, NEGATED_DETECTED = (_NOT + r"[^.;,()0-9]{0,30}?\b" + word for word in (r"amplif\w*", r"detect\w*"))
NEGATED_POSITIVE = _NOT + r"[^.;,()0-9]{0,30}?\b(?:positiv\w*|over-?express\w*|reactiv\w*|staining|elevated|present)"
NEGATED_NEGATIVE = r"\b(?:not|never)\s+(?:\w+\s+){0,2}?negative"
# How a line goes on with the statement of the line before it.
GOES_ON = r"[ \t]*(?:\(|I?SH\b|FISH\b|[Rr]eflex|[Dd]ual-probe|[Aa]verage|[Rr]atio|[Cc]op(?:y|ies)\b|[Ss]core|[Aa]llred|<?\s?[0-9.]+\s?%|by (?:IHC|FISH))"
NOT_REACTIVE = r"negative|non-?reactive|not detected|no significant|^-($|[^a-z])"
REACTIVE = r"^\+|positive|reactive"
TERSE_NEGATIVE = r"negative|not detected"
TERSE_POSITIVE = r"positive|detected"

# Cut-offs for FISH (ratio and copies per nucleus) and for stained nuclei in percent.
FISH_RATIO_CUT, FISH_COPIES_CUT, STAIN_CUT = 2.0, 4.0, 1.0

Ladder = Callable[[Column], Column]


def _number(statement: Column, pattern: str) -> Column:
    return F.regexp_extract(statement, pattern, 1).try_cast("double")


def _her2_careful(s: Column) -> Column:
    s = F.regexp_replace(s, NEGATED_GRADE, "")
    ratio, copies = _number(s, FISH_RATIO), _number(s, FISH_COPIES)
    enough_copies = F.coalesce(copies >= FISH_COPIES_CUT, F.lit(True))
    return (
        F.when(s.rlike(IHC_STRONG), POSITIVE)
        .when(s.rlike(NOT_AMPLIFIED), NEGATIVE)
        .when((ratio >= FISH_RATIO_CUT) & enough_copies, POSITIVE)
        .when(ratio.isNotNull(), NEGATIVE)
        .when(s.rlike(FISH_AMPLIFIED), POSITIVE)
        .when(s.rlike(EQUIVOCAL), UNKNOWN)
        .when(s.rlike(IHC_WEAK), NEGATIVE)
        .when(s.rlike(AMPLIFIED), POSITIVE)
        .otherwise(UNKNOWN)
    )


def _receptor_careful(s: Column) -> Column:
    stained = F.regexp_extract(s, FIRST_PERCENT, 2).try_cast("double")
    below = F.regexp_extract(s, FIRST_PERCENT, 1) == "<"
    return (
        F.when(below & (stained <= STAIN_CUT), NEGATIVE)
        .when(stained >= STAIN_CUT, POSITIVE)
        .when(stained.isNotNull(), NEGATIVE)
        .when(s.rlike(NOT_REACTIVE), NEGATIVE)
        .when(s.rlike(REACTIVE), POSITIVE)
        .otherwise(UNKNOWN)
    )


def _her2_terse(s: Column) -> Column:
    return F.when(s.rlike(EQUIVOCAL), UNKNOWN).otherwise(_receptor_terse(s))


def _receptor_terse(s: Column) -> Column:
    return (
        F.when(s.rlike(TERSE_NEGATIVE), NEGATIVE)
        .when(s.rlike(TERSE_POSITIVE), POSITIVE)
        .otherwise(UNKNOWN)
    )


@dataclass(frozen=True)
class RuleSet:
    """A name and, per status column, the ladder of rules that reads its statement."""

    name: str
    ladders: dict[str, Ladder]

    def statuses(self, statements_of: Callable[[str], Column]) -> dict[str, Column]:
        """Per status column, the last result among the marker's statements."""
        def last_result(col: str, ladder: Ladder) -> Column:
            results = F.filter(F.transform(statements_of(col), ladder), lambda x: x != UNKNOWN)
            return F.coalesce(F.try_element_at(results, F.lit(-1)), F.lit(UNKNOWN))

        return {col: last_result(col, ladder) for col, ladder in self.ladders.items()}


CAREFUL = RuleSet("careful", {
    "her2_status": _her2_careful, "er_status": _receptor_careful, "pr_status": _receptor_careful,
})
TERSE = RuleSet("terse", {
    "her2_status": _her2_terse, "er_status": _receptor_terse, "pr_status": _receptor_terse,
})


def may_name(line: Column) -> Column:
    """Whether a line can name a marker, by plain substrings."""
    return reduce(lambda a, b: a | b, (line.contains(n) for n in NAMES_A_MARKER))


def marker_lines(text: Column) -> Column:
    """What a report asserts as found on the lines that may name a marker, each with all lines that go on from it."""
    def read(line: Column) -> Column:
        line = F.regexp_replace(F.regexp_replace(line, BOTH_RECEPTORS, "ER/PR"), SAID_BEFORE, "$2: $1")
        line = F.regexp_replace(line, DENIED_BEFORE, "$1: negative")
        return F.transform(F.array(line), lambda x: C.results(x, MARKER, may_name))[0]

    return F.array_join(F.transform(C.joined(text, may_name, GOES_ON), read), "\n")


def affirmed(statement: Column) -> Column:
    """A lower-cased statement with negated findings written out: "not positive" is negative, "not negative" says nothing."""
    plain = F.regexp_replace(F.regexp_replace(statement, NEGATED_NEGATIVE, ""), NEGATED_AMPLIFIED, "not amplified")
    plain = F.regexp_replace(plain, NEGATED_DETECTED, "not detected")
    return F.when(statement.rlike(NEGATES), F.regexp_replace(plain, NEGATED_POSITIVE, "negative")).otherwise(statement)


def statements(lines: Column, marker: str) -> Column:
    """What a report says about one marker: its statements in order, lower-cased; none if it is not named."""
    tails = F.regexp_extract_all(F.coalesce(lines, F.lit("")), F.lit(STATEMENT[marker]), F.lit(1))
    return F.transform(F.transform(tails, lambda t: F.lower(F.regexp_replace(t, NEXT_MARKER[marker], ""))), affirmed)
