"""Operator 12, mixing sources to target weights, with built-in functions only.

The words of a source, document after document in a hashed order, are packed into blocks of ``BLOCK`` words. Every source gets a target (``targets``): the size of the whole
corpus shared by weight, no source above ``MOST`` times its own size. A target is cut into slots of one block each; all slots are dealt to the
output's shards by a pseudorandom permutation, so the number of slots a shard draws per source is a multinomial draw under the condition that
all shards together meet the targets (free draws would miss them by chance, and could take a block more often than allowed). The
slots of a source run through its blocks in a pseudorandom permutation of their indexes, a new one for each epoch, and meet the blocks by an equi-join on
(source, index). The last slot of a source takes only the words still missing, so a source gives its target to the word (rounded down).

Permutations are swap-or-not networks: bijections of 0 .. m - 1 for any m, computed per index, without sorting.

Scale: texts are read once, for their sizes, and never shuffled. What is shuffled are rows of numbers: one per document, one per document and block it touches, one per slot.
Positions in a source's stream come from running sums on three levels (documents of a hashed bucket of about ``BUCKET``, ``FAN`` buckets, all of those), so no task holds a source.
Equal rows (doc_id, source and text) are counted on the map side and unfolded at the end in chunks that are dealt out. The driver holds one row per source; more than
``SOURCES`` of them are refused with an error, as they are shipped to all executors.

Defined cases: a NULL text has no words; a document without words takes none. NULL is a source of its own, the last; an empty name is another. Rows equal in doc_id, source and
text share what their words take evenly (rounded); rows equal in doc_id alone are documents of their own. Without any word all targets are 0. An empty table gives no rows.
Further columns are not read.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cohortsieve.llm.registry import query
from cohortsieve.llm.steps import written
from cohortsieve.llm.texts import table, text_of, words_of

BLOCK, SHARD = 256, 1024
WEIGHTS, MOST = (5, 2, 1), 3
BUCKET, FAN, CHUNK = 512, 512, 4096
SOURCES = 100_000
ROUNDS, SEED = 24, 20
_WORD = r"[^\x20\x09-\x0D]+"
_SOURCE = ("sid int, source string, source_size long, target double, full long, tail long, per long, epochs long, partial long, cut long, "
           "slots long, first long, buckets long")


def permuted(index: Column, size: Column, *key: Column) -> Column:
    """The image of ``index`` under the pseudorandom permutation of 0 .. size - 1 that belongs to ``key``."""
    def swap(x: Column, i: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(F.lit(SEED), i, *key), size) - x, size)
        return F.when(F.xxhash64(F.lit(SEED), i, F.greatest(x, other), *key) % 2 == 0, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index.cast("long"), swap)


def targets(sizes: list[int], weights: list[int], most: int = MOST) -> list[Fraction]:
    """All sizes shared by weight; what is above ``most`` times a size goes to the others by weight, until none is above."""
    out, rest, still = [Fraction(0)] * len(sizes), sum(sizes), list(range(len(sizes)))
    while still:
        share = Fraction(rest, sum(weights[i] for i in still))
        above = [i for i in still if share * weights[i] > most * sizes[i]]
        for i in above or still:
            out[i] = Fraction(most * sizes[i]) if above else share * weights[i]
        rest -= sum(most * sizes[i] for i in above)
        still = [i for i in still if i not in set(above)] if above else []
    return out


def source_rows(found: list[tuple[str | None, int, int]], weights: tuple[int, ...], most: int, block: int) -> list[dict]:
    """What the mix takes of each (source, words, documents), by code point and NULL last."""
    found = sorted(found, key=lambda r: (r[0] is None, r[0] or ""))
    wanted = targets([n for _, n, _ in found], [weights[i % len(weights)] for i in range(len(found))], most)
    out, first = [], 0
    for sid, ((name, words, documents), target) in enumerate(zip(found, wanted)):
        full, tail = divmod(words, block)
        epochs, rest = divmod(int(target), words) if words else (0, 0)
        partial = min(rest // block, full)
        per, cut = full + (tail > 0), rest - partial * block
        slots = epochs * per + partial + (cut > 0)
        out.append(dict(sid=sid, source=name, source_size=words, target=float(target), full=full, tail=tail, per=per, epochs=epochs,
                        partial=partial, cut=cut, slots=slots, first=first, buckets=-(-documents // BUCKET)))
        first += slots
    return out


def sized(docs: DataFrame) -> DataFrame:
    """(source, doc_id, h, size, copies): distinct documents with their number of words."""
    size = F.size(F.split(text_of(), _WORD, -1)).cast("long") - 1
    return (docs.select("source", "doc_id", F.xxhash64(text_of()).alias("h"), size.alias("size"))
            .groupBy("source", "doc_id", "h", "size").agg(F.count("*").alias("copies")))


def unfold(df: DataFrame, first: Column, last: Column, out: str, deal: bool = False) -> DataFrame:
    """A row for each whole number from ``first`` to ``last``; long ranges are dealt out in chunks, with ``deal`` all of them."""
    marked = df.withColumns({"_first": first, "_last": last})
    inner = lambda d: d.withColumn(out, F.explode(F.sequence("_first", "_last"))).drop("_first", "_last")
    long = marked if deal else marked.filter(F.col("_last") - F.col("_first") >= CHUNK)
    chunks = (long.withColumn("_first", F.explode(F.sequence("_first", "_last", F.lit(CHUNK).cast("long"))))
              .withColumn("_last", F.least(F.col("_last"), F.col("_first") + CHUNK - 1)))
    # A given number of partitions: the few rows dealt out here become many.
    chunks = inner(chunks.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("_first", *df.columns)))
    return chunks if deal else inner(marked.filter(F.col("_last") - F.col("_first") < CHUNK)).unionByName(chunks)


def placed(groups: DataFrame) -> DataFrame:
    """``groups`` (sid, key, words, buckets, ...) with ``start``, the place of their first word in their source's stream."""
    cells = groups.withColumn("bucket", F.pmod("key", "buckets")).withColumn("fan", F.floor(F.col("bucket") / FAN).cast("long"))
    per_bucket = cells.groupBy("sid", "fan", "bucket").agg(F.sum("words").alias("w"))
    per_fan = per_bucket.groupBy("sid", "fan").agg(F.sum("w").alias("w"))
    before = lambda amount, *keys: F.coalesce(F.sum(amount).over(
        Window.partitionBy(*keys[0]).orderBy(*keys[1]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    fans = per_fan.select("sid", "fan", before("w", ["sid"], ["fan"]).alias("of_fan"))
    buckets = per_bucket.select("sid", "fan", "bucket", before("w", ["sid", "fan"], ["bucket"]).alias("of_bucket")).join(fans, ["sid", "fan"])
    inside = cells.withColumn("start", before("words", ["sid", "bucket"], ["key", "doc_id", "h"])).drop("fan")
    return inside.join(buckets.drop("fan"), ["sid", "bucket"]).withColumn(
        "start", F.col("start") + F.col("of_bucket") + F.col("of_fan")).drop("bucket", "of_bucket", "of_fan")


@dataclass(frozen=True)
class Mix:
    """``sources``: one row each (see ``source_rows``). ``groups``: distinct documents with the place of their words in their source's stream. ``slots``: the output."""

    sources: DataFrame
    groups: DataFrame
    slots: DataFrame
    block: int

    def pieces(self) -> DataFrame:
        """(sid, block, from, to, ...): the words of a block that are a document's."""
        have = self.groups.filter("words > 0")
        end, size = F.col("start") + F.col("words"), F.lit(self.block).cast("long")
        whole = lambda c: F.floor(c / size).cast("long")
        rows = unfold(have, whole(F.col("start")), whole(end - 1), "block")
        return rows.withColumns({"from": F.greatest(F.col("start") - F.col("block") * size, F.lit(0)),
                                 "to": F.least(F.col("start") + F.col("words") - F.col("block") * size, size)})

    def taken(self) -> DataFrame:
        """``groups`` with ``taken``: the words that the mix takes of all copies of a document, repeats counted."""
        often = self.slots.groupBy("sid", "block", "words").agg(F.count("*").alias("times")).withColumnRenamed("words", "used")
        # Spark takes the unfolded slots for a few rows, as their sources are; they must not be broadcast.
        often = often.hint("merge")
        met = self.pieces().join(often, ["sid", "block"], "left")
        words = F.coalesce(F.col("times") * F.greatest(F.least("to", "used") - F.col("from"), F.lit(0)), F.lit(0))
        keys = ["sid", "doc_id", "h", "size", "copies"]
        some = met.groupBy(*keys).agg(F.sum(words).alias("taken"))
        return some.unionByName(self.groups.filter("words = 0").select(*keys, F.lit(0).cast("long").alias("taken")))

    def shard_counts(self) -> DataFrame:
        """(shard, sid, n): the slots that each output shard draws of each source."""
        return self.slots.groupBy("shard", "sid").agg(F.count("*").alias("n"))

    def texts(self, docs: DataFrame) -> DataFrame:
        """(shard, position, from, doc_id, words): the mixed corpus itself, each row the words that a document gives to a slot."""
        used = self.pieces().join(self.slots.withColumnRenamed("words", "used").hint("merge"), ["sid", "block"]).filter("from < used")
        used = used.withColumn("to", F.least("to", "used")).join(F.broadcast(self.sources.select("sid", "source")), "sid")
        bodies = docs.select(F.col("source").alias("s"), F.col("doc_id").alias("d"), F.xxhash64(text_of()).alias("k"), text_of().alias("text")).dropDuplicates(["s", "d", "k"])
        met = used.join(bodies, F.col("source").eqNullSafe(F.col("s")) & F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("k")))
        offset = F.col("block") * self.block - F.col("start")
        places = F.sequence(F.col("from") + offset, F.col("to") + offset - 1)
        words = F.transform(F.array(words_of(F.col("text"))), lambda w: F.array_join(
            F.transform(places, lambda i: w[F.pmod(i, F.col("size")).cast("int")]), " "))[0]
        return met.select("shard", "position", "from", "doc_id", words.alias("words"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, block: int = BLOCK, shard: int = SHARD) -> Mix:
    """The mix of all ``docs`` (doc_id, source, text)."""
    spark = docs.sparkSession
    counted = written(sized(docs), "mix-sizes")
    found = counted.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("words"), F.count("*").alias("n")).limit(SOURCES + 1).collect()
    if len(found) > SOURCES:
        raise ValueError(f"more than {SOURCES} sources")
    rows = source_rows([(r["source"], r["words"], r["n"]) for r in found], weights, most, block)
    sources = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{_SOURCE.replace(' ', ':').replace(',:', ',')}>>")))
    known = counted.join(F.broadcast(sources.select("sid", F.col("source").alias("name"), "buckets")), F.col("source").eqNullSafe(F.col("name")))
    groups = placed(known.select("sid", "doc_id", "h", "size", "copies", (F.col("size") * F.col("copies")).alias("words"),
                                 F.xxhash64("doc_id", "h").alias("key"), "buckets")).drop("key", "buckets")

    total = sum(r["slots"] for r in rows)
    every = unfold(sources.filter("slots > 0"), F.lit(0).cast("long"), F.col("slots") - 1, "i", deal=True)
    every = every.withColumns({"epoch": F.floor(F.col("i") / F.col("per")).cast("long"), "k": F.col("i") % F.col("per")})
    last = (F.col("epoch") == F.col("epochs")) & (F.col("k") == F.col("partial"))
    inner = F.col("k") < F.col("full")
    spot = F.when(inner, permuted(F.col("k"), F.greatest("full", F.lit(1)), F.col("source"), F.col("epoch"))).otherwise(F.col("full"))
    words = F.when(last, F.col("cut")).when(inner, F.lit(block)).otherwise(F.col("tail"))
    place = permuted(F.col("first") + F.col("i"), F.lit(max(total, 1)).cast("long"))
    slots = every.select("sid", "epoch", spot.alias("block"), words.cast("long").alias("words"), place.alias("position"))
    return Mix(sources, groups, slots.withColumn("shard", F.floor(F.col("position") / shard).cast("long")), block)


@query("op12_source_mixing")
def op12_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mix(table(spark, folder, "documents"))
    each = F.floor((2 * F.col("taken") + F.col("copies")) / (2 * F.col("copies"))).cast("long")
    rows = unfold(mixed.taken(), F.lit(1).cast("long"), F.col("copies"), "copy")
    return rows.join(F.broadcast(mixed.sources.select("sid", "source_size", "target")), "sid").select(
        "doc_id", "size", "source_size", "target", each.alias("taken"))
