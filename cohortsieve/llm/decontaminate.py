"""Operator 9, benchmark decontamination by pigeonhole edit matching.

Texts and benchmark items are compared lower-cased, with white space as single spaces. An item is read in windows of ``WINDOW`` characters that
start at every piece of a window (``STEP`` characters) and at its end; an item of fewer is one window. So a part of an item is certain to be found from ``CERTAIN`` characters on,
wherever it was cut out, and shorter items as a whole. A window may differ from a passage of a text by ``RATE`` edits per
character (k in all): cut into k + 1 pieces, one piece must then occur unchanged. One automaton finds all pieces of all windows in one
pass over a text; around each hit the window is verified with Myers' bit-parallel distance, on integers as wide as the window. A document is
contaminated if any window of any item is found.

Scale: map passes without a shuffle. Items come to the tasks in blocks of ``BLOCK`` windows at most, each one more map pass, so a
benchmark of any size fits. A worker holds one Arrow batch and one automaton.

Defined cases: a NULL or empty text is clean. NULL and blank items match nothing. Items of fewer than ``LEAST`` characters match exactly, as whole words: no letter or digit may
stand next to them.
Texts are read whole. Repeated rows are judged alike, repeated items each count under their item_id, an empty table or benchmark gives
clean rows. All columns stay; the column of item_ids gets underscores appended while its name is taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cohortsieve.llm.registry import query
from cohortsieve.llm.texts import free_name, table

WINDOW, RATE, LEAST, BLOCK = 100, 0.04, 25, 50_000
#: The length of a full window's pieces; windows that start so far apart share most of them.
STEP = WINDOW // (int(WINDOW * RATE) + 1)
#: A part of an item of so many characters holds a whole window.
CERTAIN = WINDOW + STEP - 1


@dataclass(frozen=True)
class Window:
    item_id: int
    text: str

    @property
    def budget(self) -> int:
        return int(len(self.text) * RATE) if len(self.text) >= LEAST else 0

    def at(self, t: str, begin: int) -> bool:
        """Whether the window is found around the place ``begin`` of a text."""
        size, k = len(self.text), self.budget
        if size < LEAST:
            return not any(c.isalnum() for c in t[max(0, begin - 1):begin] + t[begin + size:begin + size + 1])
        return myers(self.text, t[max(0, begin - k):begin + size + k], k) is not None

    def pieces(self) -> list[tuple[int, str]]:
        """(offset, piece): budget + 1 pieces of nearly equal length."""
        n, size = self.budget + 1, len(self.text)
        cuts = [size * i // n for i in range(n + 1)]
        return [(a, self.text[a:b]) for a, b in zip(cuts, cuts[1:])]


def plain(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def windows(item_id: int | None, text: str | None) -> list[Window]:
    t = plain(text)
    if item_id is None or not t:
        return []
    if len(t) <= WINDOW:
        return [Window(item_id, t)]
    starts = [*range(0, len(t) - WINDOW, STEP), len(t) - WINDOW]
    return [Window(item_id, t[s:s + WINDOW]) for s in starts]


def myers(pattern: str, text: str, most: int) -> int | None:
    """The least edit distance between ``pattern`` and any stretch of ``text``, or None above ``most``."""
    m = len(pattern)
    full, last = (1 << m) - 1, 1 << (m - 1)
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    up, down, score, best = full, 0, m, m
    for c in text:
        eq = peq.get(c, 0)
        across = (((eq & up) + up) ^ up) | eq | down
        plus, minus = down | (full & ~(across | up)), up & across
        if plus & last:
            score += 1
        elif minus & last:
            score -= 1
        # A stretch may begin anywhere: no carry into the lowest bit.
        plus, minus = (plus << 1) & full, (minus << 1) & full
        vertical = eq | down
        up, down = minus | (full & ~(vertical | plus)), plus & vertical
        best = min(best, score)
    return best if best <= most else None


class Finder:
    def __init__(self, block: list[Window]):
        import ahocorasick

        self.block, places = block, {}
        for i, w in enumerate(block):
            for offset, piece in w.pieces():
                places.setdefault(piece, []).append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, at in places.items():
            self.automaton.add_word(piece, (len(piece), at))
        self.automaton.make_automaton()

    def items(self, text: str | None) -> list[int]:
        """The item_ids that the text contains, in order."""
        t, found, tried = plain(text), set(), set()
        for end, (size, at) in self.automaton.iter(t):
            for i, offset in at:
                w = self.block[i]
                begin = end + 1 - size - offset
                if w.item_id in found or (i, begin) in tried:
                    continue
                tried.add((i, begin))
                if w.at(t, begin):
                    found.add(w.item_id)
        return sorted(found)


def blocks(benchmark: DataFrame) -> Iterator[list[Window]]:
    """The windows of all items, in blocks; items arrive one partition at a time."""
    held: list[Window] = []
    for r in benchmark.select("item_id", "text").toLocalIterator():
        held += windows(r["item_id"], r["text"])
        if len(held) >= BLOCK:
            yield held
            held = []
    if held:
        yield held


def with_items(docs: DataFrame, benchmark: DataFrame, out: str = "item_ids") -> tuple[DataFrame, str]:
    """``docs`` with the sorted item_ids found in each text, and the name of that column."""
    name = free_name(docs, out)
    df = docs.withColumn(name, F.expr("cast(array() as array<bigint>)"))
    for block in blocks(benchmark):
        df = _one_pass(df, block, name)
    return df, name


def _one_pass(df: DataFrame, block: list[Window], name: str) -> DataFrame:
    shipped = df.sparkSession.sparkContext.broadcast(block)
    text, found = df.columns.index("text"), df.columns.index(name)

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(shipped.value)
        for b in batches:
            new = pa.array([sorted({*(old.as_py() or []), *finder.items(t.as_py())})
                            for t, old in zip(b.column(text), b.column(found))], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*b.columns[:found], new, *b.columns[found + 1:]], b.schema.names)

    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
    return df.mapInArrow(per_batch, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item, with their columns."""
    df, name = with_items(docs, benchmark)
    return df.filter(F.size(name) == 0).drop(name)


@query("op9_decontaminate")
def op9_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, contaminated, and the item_ids found, per document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    df, name = with_items(docs, table(spark, folder, "benchmark"))
    return df.select("doc_id", (F.size(name) > 0).alias("contaminated"), F.col(name).alias("item_ids"))
