"""Lines, sentences and clauses of a report, and what a clause asserts, all native Columns.

A clause asserts one of ``RESULT`` (found now), ``HISTORY`` (earlier findings, other people, comparisons with them) and ``REQUEST`` (tests ordered,
pending or not done, conditions). Only results may be read as findings; of the others the names of markers stay, so that a result
that follows in the next clause still has its subject: in "prior biopsy HER2 negative, now 3+" the grade is HER2's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

RESULT, HISTORY, REQUEST = "result", "history", "request"

# Cue words.
HISTORY_CUE = (r"(?i)\b(?:history|historical|historically|prior|previous|previously|formerly|earlier|past|outside (?:slides?|report|hospital)"
               r"|years? ago|months? ago|in (?:19|20)[0-9]{2}|mother|father|sister|brother|aunt|grandmother|family)\b")
REQUEST_CUE = (r"(?i)\b(?:requested|ordered|recommended|suggested|pending|awaited|to follow|to be|will be|sent for|if|in case of|cannot exclude|rule out|planned"
               r"|not (?:yet )?(?:performed|done|assessed|available|reported|evaluable|tested)|insufficient)\b")
_ENDS = r"(?<=[.;!?,])\s+|\s+(?=(?:but|although|whereas|while|however|now|currently)\b)"
_HEADING = r"^\s*([^:.;,\n]{1,60}):"


def assertion(clause: Column) -> Column:
    """What a clause asserts. A test that was not done is a request even where it is told as history."""
    return (F.when(clause.rlike(REQUEST_CUE), REQUEST).when(clause.rlike(HISTORY_CUE), HISTORY).otherwise(RESULT))


def clauses(line: Column) -> Column:
    """The clauses of a line, in order: cut after full stops, semicolons and commas, and before words that turn to something else."""
    return F.split(line, _ENDS)


def under_history(line: Column, names_a_subject: Callable[[Column], Column]) -> Column:
    """Whether a line stands under a heading that tells a history ("CLINICAL HISTORY: ..."); "Prior HER2: ..." heads its own clause only."""
    heading = F.regexp_extract(line, _HEADING, 1)
    return heading.rlike(HISTORY_CUE) & ~names_a_subject(heading)


def results(line: Column, subject: str, names_a_subject: Callable[[Column], Column]) -> Column:
    """A line without what it does not assert as found; clauses that are no results keep the names that match ``subject``."""
    def cut(clause: Column) -> Column:
        left = F.regexp_extract_all(clause, F.lit(f"({subject})"), F.lit(1))
        return F.when(assertion(clause) == RESULT, clause).otherwise(F.array_join(F.transform(left, lambda name: F.concat(name, F.lit(":"))), " "))

    whole = F.array_join(F.transform(clauses(line), cut), " ")
    told = line.rlike(HISTORY_CUE) | line.rlike(REQUEST_CUE)
    return F.when(~told, line).when(under_history(line, names_a_subject), F.lit("")).otherwise(whole)


def joined(text: Column, opens: Callable[[Column], Column], goes_on: str) -> Column:
    """The lines of a text that ``opens`` accepts, each with all following lines that go on from it (pattern ``goes_on``)."""
    def step(acc: Column, line: Column) -> Column:
        last = F.concat(F.element_at(acc["out"], -1), F.lit(" "), F.trim(line))
        return (F.when(acc["open"] & line.rlike("^" + goes_on), F.struct(
                    F.lit(True).alias("open"), F.concat(F.slice(acc["out"], 1, F.size(acc["out"]) - 1), F.array(last)).alias("out")))
                .when(opens(line), F.struct(F.lit(True).alias("open"), F.concat(acc["out"], F.array(line)).alias("out")))
                .otherwise(F.struct(F.lit(False).alias("open"), acc["out"].alias("out"))))

    start = F.struct(F.lit(False).alias("open"), F.expr("cast(array() as array<string>)").alias("out"))
    return F.aggregate(F.split(text, "\n"), start, step, lambda acc: acc["out"])
