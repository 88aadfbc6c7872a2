"""Operator 8, n-gram Jaccard join: the size-aware heavy-light join.

A document is the set of its four-word shingles (A-Z lower-cased); sets are told apart, and shingles compared, by 64-bit hashes. Equal sets are one node. Sets up to a
boundary are light: they enumerate, for each size a light partner can have, all subsets of the overlap that the threshold asks for, and two
light sets that link share a subset. Larger sets are heavy: they stand in the inverted lists of their first n - ceil(0.85 n) + 1 shingles, frequent shingles
last; light sets large enough to link with a heavy one stand in the lists too. The boundary minimises subsets enumerated plus list entries,
over the sizes of all documents.

Each list (of a subset or a shingle) is scanned in rounds. First every member meets one leader, namely the one it shares most lists with; lists whose members are in one component by
then are done, and the others take new leaders, up to ``ROUNDS`` times or until no link is added. Then members that are still in different components meet in the first list they share. A pair that never meets is in one component already, so components are exact, and a list of thousands of near copies
costs thousands of tests, not millions. Pairs pass size, parity and histogram bounds on the symmetric difference before their whole sets are compared.

Scale: sets are sketched in map passes and go to the shared folder; lists are grouped with partial aggregates; joins are equi-joins whose hot keys Spark's skew join
splits. The order of shingles names at most ``FREQUENT`` frequent ones (a broadcast of that size); which ones it names changes list lengths, never
results. Whole sets are shuffled for pairs that pass the bounds only, chosen by a bit map, sized by their number, that merely prefilters. Components come from star contraction
on tables; links never reach the driver.

Defined cases: a NULL or empty text has no shingles and links with nothing; with fewer than four words the whole sequence is the one shingle. A row
with NULL doc_id links with nothing and has no component. Rows with the same doc_id are one document as far as links go. Texts are read whole, an empty table gives no
rows, further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortsieve.llm.registry import query
from cohortsieve.llm.steps import maybe_of, release, written
from cohortsieve.llm.texts import LOWER, SPACES, UPPER, table, text_of

GRAM, PERCENT = 4, 85
FREQUENT, LONG_LIST = 1 << 17, 40
MOST_LIGHT = 24
BUCKETS = 64
#: What a map pass works on at a time.
PART_ROWS, PART_BYTES = 500, 1 << 23
#: Large sets (and those that may link with one) have a finer histogram as well.
FINE, FINE_FROM = 512, 1000
#: Leader rounds at most; what they leave is joined pair by pair.
ROUNDS = 4
#: So many of a node's lists, the first ones, are looked through for an earlier meeting of a pair.
FIRST_LISTS = 64
_P = np.uint64(0x9E3779B97F4A7C15)


#: Per byte: whether it separates words, and its lower case. Per number of bytes: the mask that keeps so many of eight.
_SPACE = np.isin(np.arange(256), [ord(c) for c in SPACES])
_LOWER = np.array([b + 32 if ord("A") <= b <= ord("Z") else b for b in range(256)], np.uint8)
_KEPT = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64 bits evenly (a public finaliser)."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _fold(parts: list[np.ndarray]) -> np.ndarray:
    h = np.full_like(parts[0], np.uint64(len(parts)))
    for p in parts:
        h = h * _P + p
    return _mix(h)


def word_hashes(text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of many texts (UTF-8 bytes, end to end), A-Z lower-cased, and where each text's words begin among them.

    A word is read in pieces of eight bytes; their mixed values and the word's length make its hash.
    """
    inside = np.zeros(len(text) + 2, bool)
    inside[1:-1] = ~_SPACE[text]
    # A word ends where its text does.
    starts = inside[1:-1] & ~inside[:-2]
    edges = offsets[:-1][np.diff(offsets) > 0]
    starts[edges] = inside[1:-1][edges]
    stops = inside[1:-1] & ~inside[2:]
    lasts = offsets[1:][np.diff(offsets) > 0] - 1
    stops[lasts] = inside[1:-1][lasts]
    begin, end = np.flatnonzero(starts), np.flatnonzero(stops) + 1
    size = end - begin
    padded = np.concatenate((_LOWER[text], np.zeros(8, np.uint8)))
    eights = np.ndarray(len(text) + 1, "<u8", padded, strides=(1,))
    h = _mix(size.astype(np.uint64) * _P)
    rest, at, turn = np.arange(len(begin)), begin, 0
    while len(rest):
        left = size[rest] - 8 * turn
        piece = eights[at] & _KEPT[np.minimum(left, 8)]
        h[rest] = _mix(h[rest] * _P + _mix(piece + np.uint64(turn)))
        on = left > 8
        rest, at, turn = rest[on], at[on] + 8, turn + 1
    return h, np.searchsorted(begin, offsets)


def shingle_sets(words: np.ndarray, offsets: np.ndarray, gram: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each document, from hashes of its words."""
    words = words.view(np.uint64)
    whole = _fold([words[i:len(words) - gram + 1 + i] for i in range(gram)]) if len(words) >= gram else words[:0]
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= gram:
            yield np.unique(whole[a:b - gram + 1])
        elif b > a:
            yield _fold([words[i:i + 1] for i in range(a, b)])
        else:
            yield words[:0]


def needed(n: int, m: int, percent: int) -> int:
    """The least overlap of linked sets of n and m."""
    return -(-percent * (n + m) // (100 + percent))


def partners(n: int, percent: int) -> range:
    """Sizes that a linked set can have."""
    return range(-(-percent * n // 100), 100 * n // percent + 1)


def _overlaps(n: int, light: int, percent: int) -> list[tuple[int, int]]:
    """(partner's size, overlap) for which a light set of n enumerates subsets; equal sets are one node already."""
    found = [(m, needed(n, m, percent)) for m in partners(n, percent) if m <= light]
    return [(m, c) for m, c in found if c <= min(n, m) and not m == n == c]


def subset_counts(n: int, light: int, percent: int) -> int:
    """How many subsets a light set of n enumerates."""
    return sum(comb(n, c) for _, c in _overlaps(n, light, percent))


def subsets(s: np.ndarray, light: int, percent: int) -> np.ndarray:
    """Keys of all subsets that a linked light set must share, per size of the partner."""
    n, out = len(s), []
    for m, c in _overlaps(n, light, percent):
        rows = np.array(list(combinations(range(n), c)))
        tag = np.full(len(rows), min(n, m) * 64 + max(n, m), np.uint64) * _P
        out.append(_fold([tag, *(s[rows[:, i]] for i in range(c))]))
    return np.concatenate(out) if out else s[:0]


def boundary(sizes: dict[int, int], percent: int) -> int:
    """The largest light size: the one with the fewest subsets and list entries in all."""
    def prefix(n: int) -> int:
        return n - (-(-percent * n // 100)) + 1

    def cost(light: int) -> int:
        bridging = min(partners(light + 1, percent))
        return sum(many * ((subset_counts(n, light, percent) if n <= light else 0) + (prefix(n) if n > light or n >= bridging else 0))
                   for n, many in sizes.items())

    return min(range(MOST_LIGHT + 1), key=lambda x: (cost(x), x))


NODE = "doc_id long, n int, k long, coarse long, hist array<smallint>, fine array<smallint>, p0 long, p1 long, p2 long, p3 long, keys array<bigint>"


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", text_of().alias("text"))


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices of some rows and, where there are two or more, of some bytes of text."""
    ends = np.cumsum([0] + [len(t.as_buffer()) for t in batch.column("text")])
    at = 0
    while at < batch.num_rows:
        most = int(np.searchsorted(ends, ends[at] + PART_BYTES, "right")) - 1
        rows = max(min(most - at, PART_ROWS), 1)
        yield batch.slice(at, rows)
        at += rows


def _sets(batch: pa.RecordBatch, gram: int) -> list[np.ndarray]:
    if not batch.num_rows:
        return []
    texts = batch.column("text").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    text = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return list(shingle_sets(*word_hashes(text, offsets - offsets[0]), gram))


def _list(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows], dtype=np.int64)))
    values = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values).cast(kind))


def node_key(s: np.ndarray) -> int:
    """A 64-bit hash of a set, as a signed number."""
    places = np.arange(1, len(s) + 1, dtype=np.uint64)
    total = _mix(s + places * _P).sum(keepdims=True, dtype=np.uint64)
    return int(_mix(total + np.array([len(s)], np.uint64)).view(np.int64)[0])


def _keys(s: np.ndarray, often: np.ndarray, light: int, percent: int) -> np.ndarray:
    """The lists that a set stands in; ``often`` are the frequent shingles, sorted."""
    n, out = len(s), []
    if not n:
        return s
    if n <= light:
        out.append(subsets(s, light, percent))
    if n > light or n >= min(partners(light + 1, percent)):
        if len(often):
            late = often[np.minimum(np.searchsorted(often, s), len(often) - 1)] == s
            s = np.concatenate((s[~late], s[late]))
        out.append(s[:n - (-(-percent * n // 100)) + 1])
    return np.concatenate(out) if out else s[:0]


def plain_lists(docs: DataFrame, percent: int, gram: int) -> DataFrame:
    """(n, keys) per row: size of its set, and the lists it stands in if all sets are heavy and no shingle is frequent."""
    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in _parts(whole):
                sets = _sets(b, gram)
                yield pa.RecordBatch.from_arrays([
                    pa.array([len(s) for s in sets], pa.int32()), _list([_keys(s, s[:0], 0, percent).view(np.int64) for s in sets], pa.int64())], ["n", "keys"])

    return _texts(docs).mapInArrow(per_batch, "n int, keys array<bigint>")


def sketches(docs: DataFrame, light: int, frequent: np.ndarray, percent: int, gram: int) -> DataFrame:
    """(doc_id, n, k, coarse, hist, keys) per row: size and node of its set, histograms, and the lists it stands in."""
    shipped = docs.sparkSession.sparkContext.broadcast(frequent)

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = shipped.value
        for whole in batches:
            for b in _parts(whole):
                sets = _sets(b, gram)
                hist = [np.minimum(np.bincount((s >> np.uint64(58)).astype(np.int64), minlength=BUCKETS), 32767).astype(np.int16) for s in sets]
                fine = [np.minimum(np.bincount((s >> np.uint64(55)).astype(np.int64), minlength=FINE), 32767).astype(np.int16)
                        if 100 * len(s) >= percent * FINE_FROM else np.zeros(0, np.int16) for s in sets]
                parity = np.array([np.packbits((np.bincount((s >> np.uint64(56)).astype(np.int64), minlength=256) & 1).astype(np.uint8)).view(np.int64)
                                   for s in sets]).reshape(-1, 4)
                coarse = [int((np.minimum(h.reshape(8, -1).sum(1, dtype=np.int64), 127) << (8 * np.arange(8))).sum()) for h in hist]
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_id"), pa.array([len(s) for s in sets], pa.int32()), pa.array([node_key(s) for s in sets], pa.int64()),
                    pa.array(coarse, pa.int64()), _list(list(hist), pa.int16()), _list(fine, pa.int16()),
                    *(pa.array(parity[:, i], pa.int64()) for i in range(4)),
                    _list([_keys(s, often, light, percent).view(np.int64) for s in sets], pa.int64())],
                    ["doc_id", "n", "k", "coarse", "hist", "fine", "p0", "p1", "p2", "p3", "keys"])

    return _texts(docs).mapInArrow(per_batch, NODE)


def whole_sets(docs: DataFrame, gram: int) -> DataFrame:
    """(doc_id, k, s): the whole set of each row."""
    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in _parts(whole):
                sets = _sets(b, gram)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([node_key(s) for s in sets], pa.int64()),
                                                  _list([s.view(np.int64) for s in sets], pa.int64())], ["doc_id", "k", "s"])

    return _texts(docs).mapInArrow(per_batch, "doc_id long, k long, s array<bigint>")


def _fits(na: str, nb: str, percent: int):
    return (F.least(na, nb) * 100 >= F.greatest(na, nb) * percent)


def _coarse(a: str, b: str, percent: int):
    part = lambda x, i: F.shiftright(x, 8 * i).bitwiseAND(F.lit(127))
    apart = sum((F.abs(part(a, i) - part(b, i)) for i in range(8)), F.lit(0))
    return apart * (100 + percent) <= (100 - percent) * (F.col("na") + F.col("nb"))


def _parity(percent: int):
    """Sets differ in at least as many elements as in buckets with an odd number of them."""
    apart = sum((F.bit_count(F.col(f"p{i}a").bitwiseXOR(F.col(f"p{i}b"))) for i in range(4)), F.lit(0))
    return apart * (100 + percent) <= (100 - percent) * (F.col("na") + F.col("nb"))


def verified(docs: DataFrame, pairs: DataFrame, nodes: DataFrame, percent: int, gram: int) -> DataFrame:
    """The pairs (a, b) of nodes that link: histogram bound first, then the whole sets."""
    side = lambda x: nodes.select(F.col("k").alias(x), F.col("n").alias(f"n{x}"), F.col("hist").alias(f"h{x}"), F.col("fine").alias(f"f{x}"), F.col("rep").alias(f"r{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    def bound(x: str, y: str):
        apart = F.aggregate(F.zip_with(x, y, lambda p, q: F.abs(p - q).cast("int")), F.lit(0), lambda p, q: p + q)
        return apart * (100 + percent) <= (100 - percent) * (F.col("na") + F.col("nb"))

    fine = F.when((F.size("fa") > 0) & (F.size("fb") > 0), bound("fa", "fb")).otherwise(True)
    likely = both.filter(_fits("na", "nb", percent)).filter(bound("ha", "hb")).filter(fine).select("a", "b", "ra", "rb")
    likely = written(likely, "set-pairs")
    wanted = written(likely.select(F.col("a").alias("k"), F.col("ra").alias("doc_id")).unionAll(
        likely.select(F.col("b").alias("k"), F.col("rb").alias("doc_id"))).distinct(), "set-ids")
    some = docs.filter(maybe_of("doc_id", wanted))
    sets = whole_sets(some.select("doc_id", "text"), gram).join(wanted, ["doc_id", "k"], "left_semi").dropDuplicates(["k"]).select("k", "s")
    met = (likely.select("a", "b").join(sets.select(F.col("k").alias("a"), F.col("s").alias("sa")), "a")
           .join(sets.select(F.col("k").alias("b"), F.col("s").alias("sb")), "b"))
    common = F.size(F.array_intersect("sa", "sb"))
    links = written(met.filter(common * 100 >= percent * (F.size("sa") + F.size("sb") - common)).select("a", "b"), "links")
    release(likely, wanted)
    return links


def components(links: DataFrame) -> DataFrame:
    """(k, root) of every node in ``links`` (a, b): star contraction until nothing changes; the root is the least node."""
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "star")
    seen = None
    while True:
        # Large star: larger neighbours go to the least neighbour; small star: smaller ones do.
        two_way = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = two_way.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = two_way.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        before, edges = edges, written(small, "star")
        release(before)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return edges.select(F.col("u").alias("k"), F.col("v").alias("root")).unionAll(
        edges.select(F.col("v").alias("k"), F.col("v").alias("root")).distinct())


def _open(members: DataFrame, comps: DataFrame | None) -> DataFrame:
    """``members`` with their component (root) of those lists that hold nodes of two components or more."""
    if comps is None:
        return members.withColumn("root", F.col("b"))
    placed = members.join(comps.withColumnRenamed("k", "b"), "b", "left").withColumn("root", F.coalesce("root", "b"))
    still = placed.groupBy("e").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x < y").select("e")
    return placed.join(still, "e", "left_semi")


def meeting_once(mixed: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes of ``mixed`` (k, root, in, n, coarse, p0 to p3) in different components that share a list and may link.

    ``in`` holds a node's lists as (place, e), in order. Near copies share many lists; they meet in the first one only, as far as it is among the
    ``FIRST_LISTS`` first ones of both.
    """
    rows = mixed.select("*", F.posexplode("in").alias("pos", "list"))
    rows = rows.withColumn("before", F.slice(F.col("in.e"), F.lit(1), F.least("pos", F.lit(FIRST_LISTS))))
    side = lambda x, y: rows.select(F.col("list.e").alias("e"), F.col("k").alias(x), F.col("n").alias(f"n{x}"), F.col("coarse").alias(f"c{x}"), F.col("root").alias(y),
                                    F.col("list.place").alias(f"at{x}"), F.col("before").alias(f"before{x}"), *[F.col(f"p{i}").alias(f"p{i}{x}") for i in range(4)])
    left, right = side("a", "xa"), side("b", "xb")
    # At the first shingle that two sets share, in the order of all lists, what follows must be enough for the overlap.
    rest = F.least(F.col("na") - F.col("ata"), F.col("nb") - F.col("atb"))
    return left.join(right, (left["e"] == right["e"]) & (F.col("xa") != F.col("xb")) & (F.col("a") < F.col("b"))
                     & _fits("na", "nb", percent) & (rest * (100 + percent) >= percent * (F.col("na") + F.col("nb")))
                     & _parity(percent) & _coarse("ca", "cb", percent) & ~F.arrays_overlap("beforea", "beforeb")).select("a", "b")


def with_components(docs: DataFrame, percent: int = PERCENT, gram: int = GRAM) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``: the least doc_id reachable by links."""
    docs = docs.select("doc_id", "text")
    named = docs.filter("doc_id is not null")
    # First pass: sizes for the boundary, and shingles whose lists are long in plain hash order.
    plain = written(plain_lists(named, percent, gram), "plain-lists")
    sizes = {r["n"]: r["c"] for r in plain.filter(F.col("n") <= 2 * MOST_LIGHT).groupBy("n").agg(F.count("*").alias("c")).collect()}
    light = boundary(sizes, percent)
    often = (plain.select(F.explode("keys").alias("e")).groupBy("e").agg(F.count("*").alias("c"))
             .filter(F.col("c") > LONG_LIST).orderBy(F.desc("c"), "e").limit(FREQUENT).select("e").collect())
    release(plain)
    frequent = np.sort(np.array([r["e"] for r in often], np.int64).view(np.uint64))

    heavy = written(sketches(docs, light, frequent, percent, gram), "sketches")
    table_ = written(heavy.select("doc_id", "n", "k"), "sizes")
    linkable = table_.filter("n > 0 and doc_id is not null")
    reps = linkable.groupBy("k").agg(F.min("doc_id").alias("rep"))
    of_doc = linkable.groupBy("doc_id").agg(F.min("k").alias("a"), F.max("k").alias("last")).filter("a < last").select("doc_id", "a")
    same_doc = linkable.select("doc_id", F.col("k").alias("b")).join(of_doc, "doc_id").select("a", "b")
    nodes = written(heavy.filter("n > 0 and doc_id is not null").join(reps.select("k", F.col("rep").alias("doc_id")), ["k", "doc_id"], "left_semi")
                        .dropDuplicates(["k", "doc_id"]).withColumnRenamed("doc_id", "rep"), "nodes")
    release(heavy)
    # A shingle's place in its set's order; subsets, which come first among the keys, have none.
    listed = F.when((F.col("n") > light) | (F.col("n") >= min(partners(light + 1, percent))), F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).otherwise(0)
    entries = nodes.select("k", (F.size("keys") - listed).alias("others"), F.posexplode("keys").alias("at", "e")).select(
        "k", "e", F.greatest(F.col("at") - F.col("others"), F.lit(0)).cast("int").alias("place"))
    lists = entries.groupBy("e").agg(F.min("k").alias("a"), F.max("k").alias("last")).filter("a < last").select("e")
    members = written(entries.withColumnRenamed("k", "b").join(lists, "e"), "lists")
    # Leader rounds: each node meets one leader of its open lists, the one it shares most of them with. Every round takes other leaders.
    links, comps = written(same_doc, "links"), None
    for turn in range(ROUNDS):
        open_ = _open(members, comps)
        rank = F.xxhash64("b", F.lit(turn))
        leaders = open_.groupBy("e").agg(F.min_by("b", rank).alias("a"), F.min_by("root", rank).alias("ra"))
        first = (open_.join(leaders, "e").filter("root <> ra").groupBy("a", "b").agg(F.count("*").alias("c"))
                 .groupBy("b").agg(F.max_by("a", F.struct("c", "a")).alias("a")))
        pairs = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        more = verified(named, pairs, nodes, percent, gram)
        before, links = links, written(links.unionAll(more), "links")
        found = not more.isEmpty()
        release(before, more)
        if found or comps is None:
            comps = written(components(links), "components")
        if not found:
            break

    # Then members of one list that are still in different components, all of them.
    mine = _open(members, comps).withColumnRenamed("b", "k").groupBy("k", "root").agg(F.sort_array(F.collect_list(F.struct("place", "e"))).alias("in"))
    mixed = written(mine.join(nodes.select("k", "n", "coarse", "p0", "p1", "p2", "p3"), "k"), "open-lists")
    met = meeting_once(mixed, percent)
    more = verified(named, met.distinct(), nodes, percent, gram)
    if not more.isEmpty():
        comps = components(links.unionAll(more))
    comps = written(comps, "components")
    release(members, mixed, links, more)
    named_nodes = nodes.select("k", "rep").join(comps, "k", "left").withColumn("root", F.coalesce("root", "k"))
    least = named_nodes.groupBy("root").agg(F.min("rep").alias("component_id"))
    of_node = named_nodes.join(least, "root").select("k", "component_id")
    key = F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.col("k")).alias("k")
    return table_.select("doc_id", F.col("n").cast("long").alias("n_shingles"), key).join(of_node, "k", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + {GRAM - 1}], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {GRAM - 2}, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM o JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * o >= {PERCENT} * (a.n + b.n - o)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id, doc_id AS root FROM w UNION SELECT e.y, root FROM r JOIN e ON r.doc_id = e.x AND root < e.y)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id) LEFT JOIN n USING (doc_id)
"""


@query("op8_jaccard_join", SQL)
def op8_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return with_components(table(spark, folder, "documents"))
