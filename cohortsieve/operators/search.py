"""Exact nearest neighbours by a metric index, and approximate ones by random projections.

The index divides unit vectors into cells around pivots and cuts each cell into shells by the distance to its pivot: the groups. Every vector first searches its own
group; the similarity reached there tells which other groups can hold a nearer one, by their bounding boxes, and it
goes to those only. Within a group both searches go by leaves of a k-d tree that the task builds: each point visits the leaves whose box and ball it
cannot rule out, best leaf first.

There are about ``GROUPS`` groups, whatever the number of vectors, until one would exceed ``GROUP_ROWS`` or ``GROUP_BYTES``: a vector is shuffled once per group it goes to and once
per slice of those that come to its own, so the bytes shuffled grow with the vectors. The driver holds pivots and one box per group.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortsieve.session import cut_lineage

# Least vectors of a group, and most of a leaf; most cells, and most shells of a cell.
BLOCK_ROWS, LEAF_ROWS = 2048, 512
MAX_CELLS, MAX_SHELLS = 512, 64
# Groups that are aimed at, and what none of them exceeds; least rows of a group where there are many.
GROUPS, GROUP_ROWS, GROUP_BYTES, LEAST_ROWS = 16, 1 << 17, 1 << 25, 256
# Parts of a group that search their own group at once.
HOME_SLICES = 4
# Similarities are compared at this many decimals, so that rounding decides ties alike everywhere.
DECIMALS = 6
_UNIT = 10.0 ** DECIMALS
#: How far apart, in units of the last decimal, values are that may round alike, and a little for floating point.
_SLACK = 0.51


@dataclass(frozen=True)
class Share:
    """How many pairs of vectors met, out of how many."""

    met: int
    pairs: int

    @property
    def share(self) -> float:
        return self.met / self.pairs if self.pairs else 0.0


def _points(units: pd.Series) -> np.ndarray:
    return np.stack(units.to_numpy())


def group_rows(n: int, dim: int) -> int:
    """Vectors of a group."""
    most = max(1, min(GROUP_ROWS, GROUP_BYTES // (8 * max(dim, 1))))
    return min(most, max(-(-n // GROUPS), min(BLOCK_ROWS, LEAST_ROWS)))


def _leaves(points: np.ndarray) -> list[np.ndarray]:
    """The rows of each leaf of a k-d tree: halves at the median of the widest dimension."""
    most, done, todo = min(BLOCK_ROWS, LEAF_ROWS), [], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        if len(rows) <= most:
            done.append(rows)
            continue
        values = points[rows, np.argmax(points[rows].std(axis=0))]
        order, half = np.argpartition(values, len(rows) // 2), len(rows) // 2
        todo += [rows[order[:half]], rows[order[half:]]]
    return done


def _most(points: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The highest similarity that each point may have to a vector in each box (a row of ``lo`` and ``hi``), in units of the last decimal."""
    # x . y = (|x|^2 + |y|^2 - d^2) / 2, with |y| at most 1.
    length, found = (points ** 2).sum(axis=1), np.empty((len(points), len(lo)))
    for j in range(len(lo)):
        apart = points - np.clip(points, lo[j], hi[j])
        found[:, j] = (length + 1 - np.einsum("ij,ij->i", apart, apart)) / 2
    return found * _UNIT + _SLACK


class _Held:
    """A group's vectors in leaves, to be searched by any points.

    A key is a whole number that orders what is found by similarity, then by id: similarity in units of the last decimal, times the number of others, less the other's place.
    """

    def __init__(self, points: np.ndarray, owner: np.ndarray, at: np.ndarray, keep: int):
        """``owner`` and ``at``: who has the vector in which row of ``points``, a vector may have several owners and the reverse."""
        self.keep, self.leaves = keep, []
        self.others, place = np.unique(owner, return_inverse=True)
        self.base, self.twice = float(len(self.others) + 1), len(owner) > len(self.others)
        by_row = np.argsort(at, kind="stable")
        first = np.searchsorted(at[by_row], np.arange(len(points) + 1))
        lo, hi, centre, far = [], [], [], []
        for rows in _leaves(points):
            own = points[rows]
            pairs = np.concatenate([by_row[first[r]:first[r + 1]] for r in rows])
            column = np.repeat(np.arange(len(rows)), first[rows + 1] - first[rows])
            order = np.argsort(place[pairs], kind="stable")
            places, begins = np.unique(place[pairs][order], return_index=True)
            self.leaves.append((own, column[order], places.astype("float64"), begins))
            lo.append(own.min(axis=0)), hi.append(own.max(axis=0)), centre.append(own.mean(axis=0))
            far.append(np.sqrt(((own - centre[-1]) ** 2).sum(axis=1).max()))
        self.lo, self.hi, self.centre, self.far = np.array(lo), np.array(hi), np.array(centre), np.array(far)

    def bounds(self, points: np.ndarray) -> np.ndarray:
        length = (points ** 2).sum(axis=1)[:, None]
        square = np.maximum(length + (self.centre ** 2).sum(axis=1) - 2 * points @ self.centre.T, 0.0)
        apart = np.maximum(np.sqrt(square) - self.far - 1e-7, 0.0)
        return np.minimum(_most(points, self.lo, self.hi), (length + 1 - apart ** 2) / 2 * _UNIT + _SLACK)

    def _keys(self, points: np.ndarray, leaf: int) -> np.ndarray:
        own, column, places, begins = self.leaves[leaf]
        keys = points @ own.T
        keys *= _UNIT
        np.rint(keys, out=keys)
        keys = keys[:, column]
        if len(places) < len(column):
            keys = np.maximum.reduceat(keys, begins, axis=1)
        keys *= self.base
        keys -= places
        if keys.shape[1] > self.keep:
            keys.partition(keys.shape[1] - self.keep, axis=1)
            keys = keys[:, -self.keep:]
        return keys

    def _merged(self, best: np.ndarray, keys: np.ndarray) -> np.ndarray:
        both = np.concatenate([best, keys], axis=1)
        if self.twice:
            # An entity found in several leaves keeps its best.
            place = np.where(np.isfinite(both), self.places(both), -1.0 - np.arange(both.shape[1]))
            order = np.lexsort((both, place), axis=1)
            both, place = np.take_along_axis(both, order, axis=1), np.take_along_axis(place, order, axis=1)
            both[:, :-1][place[:, :-1] == place[:, 1:]] = -np.inf
        both.partition(both.shape[1] - self.keep, axis=1)
        return both[:, -self.keep:]

    def places(self, keys: np.ndarray) -> np.ndarray:
        keys = np.where(np.isfinite(keys), keys, 0.0)
        return np.ceil(keys / self.base) * self.base - keys

    def search(self, points: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(keys, met): each point's best keys, -inf where there are fewer, and how many vectors it was compared with.

        Only similarities of ``floor`` (in units of the last decimal) and more are sought.
        """
        best, met = np.full((len(points), self.keep), -np.inf), np.zeros(len(points), dtype="int64")
        most = self.bounds(points)
        nearest = most.argmax(axis=1)

        def visit(leaf: int, rows: np.ndarray) -> None:
            for at in range(0, len(rows), 1024):
                some = rows[at:at + 1024]
                best[some] = self._merged(best[some], self._keys(points[some], leaf))
                met[some] += len(self.leaves[leaf][0])
                floor[some] = np.maximum(floor[some], np.ceil(best[some].min(axis=1) / self.base))

        for first in (True, False):
            for leaf in range(len(self.leaves)):
                visit(leaf, np.flatnonzero(((nearest == leaf) == first) & (most[:, leaf] >= floor)))
        best[np.ceil(best / self.base) < floor[:, None]] = -np.inf
        return best, met


def _pivots(vectors: DataFrame, n: int, dim: int) -> np.ndarray:
    """Vectors to build cells around: about four times the root of the number of groups.

    They are drawn from eight times as many, each with a chance that grows with its squared distance to those drawn before, so that far clusters get one.
    """
    groups = n // group_rows(n, dim)
    cells = max(1, min(MAX_CELLS, groups, round(4 * groups ** 0.5)))
    if cells == 1:
        return np.zeros((1, dim))
    some = vectors.orderBy(F.xxhash64("rep"), "rep").limit(8 * cells).select("unit").collect()
    points, rng, drawn = np.array([r["unit"] for r in some], dtype="float64"), np.random.default_rng(0), [0]
    near = ((points - points[0]) ** 2).sum(axis=1)
    while len(drawn) < cells and near.sum() > 0:
        drawn.append(int(rng.choice(len(points), p=near / near.sum())))
        near = np.minimum(near, ((points - points[drawn[-1]]) ** 2).sum(axis=1))
    return points[drawn]


def _celled(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(rep, unit, ids, cell, away): the nearest pivot of each vector and the distance to it."""
    def to_cell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                points = _points(pdf["unit"])
                cell = np.argmax(points @ pivots.T - (pivots ** 2).sum(axis=1) / 2, axis=1)
                yield pdf.assign(cell=cell.astype("int32"), away=np.linalg.norm(points - pivots[cell], axis=1))

    kinds = {c: vectors.schema[c].dataType.simpleString() for c in ("rep", "ids")}
    return vectors.select("rep", "unit", "ids").mapInPandas(
        to_cell, f"rep {kinds['rep']}, unit array<double>, ids {kinds['ids']}, cell int, away double")


def _shelled(celled: DataFrame, rows: int) -> DataFrame:
    """``celled`` with (shell, part): groups of about ``rows``."""
    wanted = F.least(F.ceil(F.count(F.lit(1)) / rows), F.lit(MAX_SHELLS)).cast("int")
    cut_at = [i / MAX_SHELLS for i in range(1, MAX_SHELLS)]
    cells = celled.groupBy("cell").agg(wanted.alias("shells"), F.percentile_approx("away", cut_at, 1000).alias("cuts"))
    # Of the cuts, those that divide the cell into the number of shells it needs; one row per cell.
    inner = F.transform(F.sequence(F.lit(1), F.col("shells") - 1), lambda i: F.element_at(
        "cuts", F.greatest(F.floor(i * MAX_SHELLS / F.col("shells")).cast("int"), F.lit(1))))
    cells = cells.select("cell", F.when(F.col("shells") > 1, inner).otherwise(F.expr("cast(array() as array<double>)")).alias("at"))
    marked = celled.join(F.broadcast(cells), "cell").withColumn("shell", F.size(F.filter("at", lambda x: x < F.col("away")))).drop("at")
    marked = cut_lineage(marked, "shells")
    shells = marked.groupBy("cell", "shell").agg(F.count(F.lit(1)).alias("n")) \
        .orderBy("cell", "shell").toPandas()
    shells["parts"] = -(-shells["n"] // rows)
    number = {(c, s): p for c, s, p in zip(shells["cell"], shells["shell"], shells["parts"])}
    parts = F.element_at(F.lit([number.get((c, s), 1) for c in range(int(shells["cell"].max()) + 1) for s in range(MAX_SHELLS)]),
                         (F.col("cell") * MAX_SHELLS + F.col("shell") + 1).cast("int"))
    return marked.withColumn("part", F.pmod(F.xxhash64("rep"), parts).cast("int")).drop("away")


def _boxes(grouped: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(groups, lo, hi): the bounding box of each group's vectors."""
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                points, (at, first) = _points(pdf["unit"]), np.unique(pdf["group"].to_numpy(), return_inverse=True)
                inside = [points[first == i] for i in range(len(at))]
                yield pd.DataFrame({"group": at, "lo": [p.min(axis=0) for p in inside], "hi": [p.max(axis=0) for p in inside]})

    some = grouped.select("group", "unit").mapInPandas(partial, "group long, lo array<double>, hi array<double>")
    sides = some.select("group", F.posexplode(F.arrays_zip("lo", "hi")).alias("at", "x"))
    boxes = sides.groupBy("group", "at").agg(F.min("x.lo").alias("lo"), F.max("x.hi").alias("hi")).toPandas().sort_values(["group", "at"])
    groups, n = np.unique(boxes["group"].to_numpy(), return_counts=True)
    side = lambda c: boxes[c].to_numpy().reshape(len(groups), n[0])
    return groups, side("lo"), side("hi")


def block_search(vectors: DataFrame, keep: int, n: int, dim: int, *, per_entity: bool = False, asks: Column | None = None) -> tuple[DataFrame, Share]:
    """(rep, other, similarity): a superset of every vector's ``keep`` nearest, itself included, and the share of pairs that met.

    ``vectors`` has one row per distinct unit vector: rep, unit and ids, the entities that have it. With ``per_entity`` others are
    entities, each with the best of its vectors; else they are vectors, by rep. With ``asks`` only those vectors search; all are searched.
    """
    rows = group_rows(n, dim)
    keyed = _shelled(_celled(vectors, _pivots(vectors, n, dim)), rows)
    parts = F.lit(1 << 32) * (F.col("cell") * MAX_SHELLS + F.col("shell"))
    keyed = keyed.select("rep", "unit", "ids", (parts + F.col("part")).alias("group"))
    groups, lo, hi = _boxes(keyed)
    kind = vectors.schema["rep"].dataType.simpleString()
    other = vectors.schema["ids"].dataType.elementType.simpleString() if per_entity else kind
    answer = f"rep {kind}, unit array<double>, own long, others array<{other}>, near array<double>, met long"

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame(columns=[c.split()[0] for c in answer.split(", ")], dtype="object")
        at = np.arange(len(right))
        owner = np.concatenate([np.asarray(x) for x in right["ids"]]) if per_entity else right["other"].to_numpy()
        held = _Held(_points(right["other_unit"]), owner, np.repeat(at, [len(x) for x in right["ids"]]) if per_entity else at, keep)
        found, met = held.search(_points(left["unit"]), left["floor"].to_numpy(dtype="float64", copy=True))
        places, near = held.places(found), np.ceil(found / held.base) / _UNIT + 0.0
        some = [np.isfinite(f) for f in found]
        return pd.DataFrame({
            "rep": left["rep"], "unit": left["unit"], "own": left["own"],
            "others": [held.others[p[s].astype("int64")] for p, s in zip(places, some)], "near": [x[s] for x, s in zip(near, some)], "met": met})

    def meet(asking: DataFrame, purpose: str, least: int) -> DataFrame:
        """Each of (rep, unit, own, floor, group) against the group, as a written table; no task has more than ``rows`` of them at once, about."""
        counted = {r["group"]: r["count"] for r in asking.groupBy("group").count().collect()}
        times = F.create_map(*[F.lit(int(x)).cast(t) for g in groups for x, t in ((g, "long"), (max(least, -(-counted.get(g, 0) // rows)), "int"))])
        slices = F.element_at(times, F.col("group"))
        mine = asking.withColumn("slice", F.pmod(F.xxhash64("rep", "own"), slices).cast("int"))
        theirs = keyed.filter(F.col("group").isin([int(g) for g in counted])).select(
            F.col("rep").alias("other"), F.col("unit").alias("other_unit"), "ids", "group", F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice"))
        met = mine.groupBy("group", "slice").cogroup(theirs.groupBy("group", "slice")).applyInPandas(compare, answer)
        return cut_lineage(met, purpose)

    def elsewhere(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The other groups that may hold a vector as near as the last one found in the own."""
        for pdf in batches:
            if len(pdf):
                floor = np.array([np.rint(min(x) * _UNIT) if len(x) >= keep else -np.inf for x in pdf["near"]])
                at, g = np.nonzero((_most(_points(pdf["unit"]), lo, hi) >= floor[:, None]) & (groups != pdf["own"].to_numpy()[:, None]))
                yield pd.DataFrame({"rep": pdf["rep"].to_numpy()[at], "unit": pdf["unit"].to_numpy()[at], "own": pdf["own"].to_numpy()[at],
                                    "floor": floor[at], "group": groups[g]})

    asking = keyed if asks is None else cut_lineage(keyed.drop("ids").join(vectors.filter(asks).select("rep"), "rep", "left_semi"), "asking")
    home = meet(asking.select("rep", "unit", F.col("group").alias("own"), F.lit(float("-inf")).alias("floor"), "group"), "home", HOME_SLICES)
    away = home.select("rep", "unit", "own", "near").mapInPandas(elsewhere, f"rep {kind}, unit array<double>, own long, floor double, group long")
    away = meet(away, "away", 1)
    every = home.unionByName(away)
    found = every.select("rep", F.inline(F.arrays_zip("others", "near"))).select("rep", F.col("others").alias("other"), F.col("near").alias("similarity"))
    compared = every.agg(F.sum("met")).first()[0] or 0
    return found, Share(int(compared), n * n)


def projected_buckets(vectors: DataFrame, dim: int, tables: int, bits: int, seed: int = 7) -> DataFrame:
    """(rep, unit, table, bucket): random-projection buckets; vectors at a small angle share one in some table with high probability.

    A bucket is the signs of ``bits`` random projections. The projections are a rule of the seed, no data.
    """
    planes = np.random.default_rng(seed).normal(size=(tables * bits, dim))

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = 1 << np.arange(bits, dtype=np.int64)
        for pdf in batches:
            if len(pdf):
                signs = (_points(pdf["unit"]) @ planes.T > 0).reshape(len(pdf), tables, bits)
                yield pdf.assign(buckets=list((signs * weights).sum(axis=2)))

    kind = vectors.schema["rep"].dataType.simpleString()
    marked = vectors.select("rep", "unit").mapInPandas(hashed, f"rep {kind}, unit array<double>, buckets array<long>")
    return marked.select("rep", "unit", F.posexplode("buckets").alias("table", "bucket"))


def limit_per(df: DataFrame, by: list[str], order: list, keep: int) -> DataFrame:
    """The first ``keep`` rows per key; groups are cut before the shuffle as well."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("_n") <= keep).drop("_n")


def bucket_search(asks: DataFrame, held: DataFrame, by: list[str], keep: int) -> DataFrame:
    """(asker, rep, similarity): of the rows of ``held`` (rep, unit, bucket) that share ``by`` and the bucket with a row of ``asks`` (asker, asked, bucket), the ``keep`` most similar others."""
    kind = held.schema["rep"].dataType.simpleString()

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame(columns=["asker", "rep", "similarity"], dtype="object")]
        inside = {b: rows.sort_values("rep", kind="stable") for b, rows in right.groupby("bucket")}
        for bucket, asking in left.groupby("bucket"):
            if bucket not in inside:
                continue
            points, asker, rep = _points(inside[bucket]["unit"]), asking["asker"].to_numpy(), inside[bucket]["rep"].to_numpy()
            place, base = np.arange(len(rep), dtype="float64"), float(len(rep) + 1)
            for at in range(0, len(asking), 256):
                keys = np.rint(_points(asking["asked"].iloc[at:at + 256]) @ points.T * _UNIT) * base - place
                keys[asker[at:at + 256, None] == rep] = -np.inf
                keys.partition(max(keys.shape[1] - keep, 0), axis=1)
                keys = keys[:, -keep:]
                row, col = np.nonzero(np.isfinite(keys))
                near = np.ceil(keys[row, col] / base)
                found.append(pd.DataFrame({"asker": asker[at + row], "rep": rep[(near * base - keys[row, col]).astype("int64")], "similarity": near / _UNIT + 0.0}))
        return pd.concat(found[1:] or found)

    return asks.groupBy(*by).cogroup(held.groupBy(*by)).applyInPandas(compare, f"asker {kind}, rep {kind}, similarity double")
