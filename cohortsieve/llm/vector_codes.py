"""Operator 13, vector code compression (product quantisation) with a trie over distinct parts.

Components become integers, floor(256 * x). Vectors are cut into consecutive parts; each part position has a codebook, learnt in rounds: every part goes to
its nearest entry (squared Euclidean distance, ties to the lower index), then every entry becomes the componentwise floor of the mean of its parts.

The parts of a slice of vectors that stand at one position are sorted and made distinct, which is a lexicographic trie: parts with a common prefix share its nodes. A depth-first
traversal carries the distances from each node's prefix to all entries, so that a prefix shared by many parts is measured once; at a leaf the
least distance names the code, and the part enters the entry's sum with the number of vectors that hold it. Subtrees of up to ``LEAVES`` leaves
are expanded in one numpy step, level by level.

Scale: vectors are never shuffled to learn. Per round a task sends parts * entries rows of whole-number sums, which Spark adds up; the driver gets that many rows, whatever the
data. Coding is one map pass, codes do not depend on slices. Equal vectors, however many, are one leaf of a slice. Labels that hold over a thousandth of the rows (fewer
than 1,000) get their error by a broadcast, all others by a join in which no key can be hot.

Defined cases: a NULL vector, or one with a NULL, NaN or infinite component, is left out, and so are vectors of another length than most have (ties: the longer one). A
length that the parts do not divide gives the first parts one component more. Integers stop at +-``bound(length)`` (2^27 for 64 components), so that every distance fits in a long.
First entries are taken by ascending vec_id (NULL last, equal ids by vector); with fewer vectors than entries the codebooks are shorter. NULL labels are one label. Rows that
repeat are coded one by one, alike. An empty table gives no rows. ``compress`` keeps all rows and columns and renames its own if they clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortsieve.llm.registry import query
from cohortsieve.llm.steps import written
from cohortsieve.llm.texts import free_name, table
from cohortsieve.llm.vectors import matrix, usable, usual_length

STEPS = 256
PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Vectors of a task whose tries are built at once, and leaves expanded in one step.
SLICE, LEAVES = 1 << 15, 1 << 12
#: A label is hot if it holds more than one in so many rows.
HOT = 1000


def bound(length: int) -> int:
    """The largest integer of a component: a power of two for which all squared differences of a vector add up within a long."""
    return 1 << (isqrt((1 << 62) // max(length, 1)).bit_length() - 2)


def integers(vectors: np.ndarray) -> np.ndarray:
    most = bound(vectors.shape[1])
    return np.clip(np.floor(vectors * STEPS), -most, most).astype(np.int64)


def cuts(length: int, parts: int) -> list[slice]:
    """Where the parts of a vector lie."""
    base, more = divmod(length, parts)
    starts = [p * base + min(p, more) for p in range(parts + 1)]
    return [slice(a, b) for a, b in zip(starts, starts[1:])]


def distinct(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows in lexicographic order, and for each row the place of its equal."""
    if not parts.shape[1]:
        return parts[:1], np.zeros(len(parts), np.int64)
    order = np.lexsort(parts.T[::-1])
    ordered = parts[order]
    first = np.ones(len(parts), bool)
    first[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
    place = np.empty(len(parts), np.int64)
    place[order] = np.cumsum(first) - 1
    return ordered[first], place


def nearest(leaves: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For distinct parts in lexicographic order the nearest entry, ties to the lower index, and its squared distance."""
    many, depth_of_leaf = leaves.shape
    code, distance = np.zeros(many, np.int64), np.zeros(many, np.int64)
    stack = [(0, many, 0, np.zeros(len(entries), np.int64))] if many else []
    while stack:
        start, end, depth, carried = stack.pop()
        below = leaves[start:end]
        if end - start > LEAVES:
            ends = [*(np.flatnonzero(below[1:, depth] != below[:-1, depth]) + 1).tolist(), end - start]
            for a, b in zip([0, *ends], ends):
                stack.append((start + a, start + b, depth + 1, carried + (entries[:, depth] - below[a, depth]) ** 2))
            continue
        node, at_node = np.zeros(end - start, np.int64), carried[None, :]
        for d in range(depth, depth_of_leaf):
            opens = np.ones(end - start, bool)
            opens[1:] = (node[1:] != node[:-1]) | (below[1:, d] != below[:-1, d])
            heads = np.flatnonzero(opens)
            at_node = at_node[node[heads]] + (below[heads, d][:, None] - entries[:, d]) ** 2
            node = np.cumsum(opens) - 1
        best = at_node.argmin(axis=1)
        code[start:end], distance[start:end] = best[node], at_node[np.arange(len(best)), best][node]
    return code, distance


@dataclass(frozen=True)
class Codebooks:
    """Per part position its entries, as rows of integers."""

    length: int
    entries: list[np.ndarray]

    def code(self, x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Per part position: the distinct parts, their codes and distances, and each row's place among them."""
        for cut, entries in zip(cuts(self.length, len(self.entries)), self.entries):
            leaves, place = distinct(x[:, cut])
            yield leaves, *nearest(leaves, entries), place

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(v) for e in self.entries for row in e.tolist() for v in row).encode()).hexdigest()


def _moved(df: DataFrame, column: str, books: Codebooks) -> Codebooks:
    """The codebooks after one round over all usable vectors."""
    width = max(e.shape[1] for e in books.entries)

    def add(x: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> None:
        for p, (leaves, codes, _, place) in enumerate(books.code(x)):
            weight = np.bincount(place, minlength=len(leaves))
            np.add.at(counts[p], codes, weight)
            np.add.at(sums[p][:, :leaves.shape[1]], codes, weight[:, None] * leaves)

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = (len(books.entries), max(len(e) for e in books.entries))
        sums, counts = np.zeros((*shape, width), np.int64), np.zeros(shape, np.int64)
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(integers(matrix(batch.column(0), books.length)))
            if sum(map(len, held)) >= SLICE:
                add(np.concatenate(held), sums, counts)
                held = []
        if held:
            add(np.concatenate(held), sums, counts)
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry]),
             *(pa.array(sums[part, entry, d]) for d in range(width))], ["part", "entry", "n", *(f"s{d}" for d in range(width))])

    partial = df.filter(usable(column, books.length)).select(column).mapInArrow(
        per_task, "part int, entry int, n long" + "".join(f", s{d} long" for d in range(width)))
    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    rows = partial.groupBy("part", "entry").agg(total("n"), *[total(f"s{d}") for d in range(width)]).collect()
    entries = [e.copy() for e in books.entries]
    for r in rows:
        row = entries[r["part"]][r["entry"]]
        row[:] = [int(r[f"s{d}"]) // int(r["n"]) for d in range(len(row))]
    return Codebooks(books.length, entries)


def fit(df: DataFrame, key: str = "vec_id", column: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of at most 256 entries, learnt from all usable vectors; None without any."""
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits, so a codebook has 1 to 256 entries")
    length = usual_length(df, column)
    if not length:
        return None
    first = df.filter(usable(column, length)).select(key, column).orderBy(F.asc_nulls_last(key), column).limit(entries).collect()
    x = integers(np.array([r[1] for r in first], np.float64).reshape(len(first), length))
    books = Codebooks(length, [x[:, cut].copy() for cut in cuts(length, parts)])
    for _ in range(rounds):
        books = _moved(df, column, books)
    return books


def compress(df: DataFrame, books: Codebooks, column: str = "embedding") -> DataFrame:
    """``df`` with a struct of ``code`` (two hex digits a part) and ``error``, NULL for vectors that cannot be coded."""
    @F.arrow_udf("struct<code: string, error: bigint>")
    def coded(vectors: pa.Array) -> pa.Array:
        x = integers(matrix(vectors, books.length))
        codes, error = np.empty((len(x), len(books.entries)), np.uint8), np.zeros(len(x), np.int64)
        for p, (_, code, distance, place) in enumerate(books.code(x)):
            codes[:, p] = code[place]
            error += distance[place]
        return pa.StructArray.from_arrays([pa.array([row.tobytes().hex() for row in codes], pa.string()), pa.array(error)], ["code", "error"])

    known, zeros = usable(column, books.length), F.array_repeat(F.lit(0.0), books.length)
    return df.withColumn(free_name(df, "coded"), F.when(
        known, coded(F.when(known, F.col(column).cast("array<double>")).otherwise(zeros))))


def with_group_error(coded: DataFrame, group: str, error: str, out: str) -> DataFrame:
    """``coded`` (a written table) with the sum of ``error`` over rows of equal ``group``, NULLs together; NULL if it does not fit in a long."""
    sums = coded.groupBy(F.col(group).alias("_group")).agg(
        F.sum(F.col(error).cast("decimal(38,0)")).try_cast("long").alias(out), F.count("*").alias("_n"))
    sums = written(sums, "group-errors")
    many = coded.count()
    hot = F.broadcast(sums.filter(F.col("_n") * HOT > many).drop("_n"))
    cold = sums.filter(F.col("_n") * HOT <= many).drop("_n")
    of_hot = coded.join(hot, coded[group].eqNullSafe(hot["_group"])).drop("_group")
    rest = coded.join(hot, coded[group].eqNullSafe(hot["_group"]), "left_anti")
    return of_hot.unionByName(rest.join(cold, rest[group].eqNullSafe(cold["_group"])).drop("_group"))


@query("op13_vector_codes")
def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    books = fit(df)
    if books is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    rows = compress(df.filter(usable("embedding", books.length)), books).select("vec_id", "label", "coded.code", "coded.error")
    rows = with_group_error(written(rows, "codes"), "label", "error", "label_error")
    return rows.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
