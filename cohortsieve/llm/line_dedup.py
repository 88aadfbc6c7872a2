"""Operator 7, line dedup by a segment-partition edit join, with built-in functions only.

Every line that is not blank is judged (trimmed). An occurrence stays if it is the first of its line by (doc_id, line number, hash of the text),
and no line with an earlier first occurrence is near. Two lines are near if they are within ``budget`` edits of the shorter one's length n: one edit for each
``CHARS_PER_EDIT`` characters, floor(n / 100), from zero for short lines (which are only compared exactly) up to ``MOST_EDITS``, where the bit-parallel band fills a
64-bit word.

Near lines are joined by segments. A line with a budget of k edits has k + 1 segments of ``SEGMENT`` characters: half of them count from its start, half from its
end. k edits leave a segment j unchanged with exactly j edits before it (counted from the start) or after it (from the end), so that a longer line
holds it moved by j places at most: it probes 2j + 1 substrings for that segment, in the index of its own length class and of those that
a shorter partner may be in. Lines of thousands of characters cost (k + 1)^2 / 2 probes, whatever their length.

The result needs to know only whether an earlier near line exists, so all pairs of a list are not made. First every line meets the earliest holder of each
of its segments. Lines that are answered stop asking. Then, in lists with someone still asking, lines meet by list and exact length, and pairs whose letter counts differ by more than
the budget can explain (first in Gray code, one bit for each step of a count), or that share an earlier list, never leave the join. What meets is verified with Hyyro's banded bit-parallel distance, after equal beginnings and ends are cut off.

Scale: documents are read once for the join. Equal lines are combined on the map side, so a line that a third of all documents hold is one row; each distinct line is
shuffled once and written, and all later steps read that table. Segment keys meet their list's leader in a join whose hot keys Spark can split. Texts are fetched
for lines that met another only (``rows_of``). Written steps are released when they are done.

Defined cases: a NULL text has no lines; a NULL doc_id comes first. Rows equal in doc_id and text are one document and get one answer each. Texts and
lines are read whole. An empty table gives no rows. ``drop_lines`` keeps all rows and columns and sets n_chars where there is such a column; the pipeline
leaves out documents of which no word is left.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortsieve.llm.registry import query
from cohortsieve.llm.steps import HASHED_PARTITION, release, rows_of, written
from cohortsieve.llm.texts import LOWER, SPACES, let, table, text_of

CHARS_PER_EDIT, MOST_EDITS = 100, 30
SEGMENT = 50
#: So many of a line's lists, the first ones, are looked through for an earlier meeting of a pair.
FIRST_LISTS = 64
#: An occurrence as one whole number: doc_id, line number (31 bits), hash of the text (30 bits).
_LINE, _HASH = 1 << 31, 1 << 30
#: Letter counts in a long.
_LANES = 7
_COUNTS = [f"c{i}" for i in range(-(-len(LOWER) // _LANES))]
#: Marks of a matching place and of what lies beyond a line's ends: code points that are no characters.
_MARK, _EDGE = "\ufdd0", "\ufdd1"


def _counts(line: Column) -> Column:
    """Whether a line is judged: it is not blank."""
    return F.ltrim(line, F.lit(SPACES)) != ""


def _trimmed(line: Column) -> Column:
    """The line without SPACES at its ends. ``trim`` with a set of characters takes apart the whole line, so it is asked only where one is at the end."""
    at_end = reduce(lambda a, b: a | b, [F.endswith(line, F.lit(c)) for c in SPACES])
    return F.when(at_end, F.trim(line, F.lit(SPACES))).otherwise(F.ltrim(line, F.lit(SPACES)))


def _lines(docs: DataFrame) -> DataFrame:
    """(at, h, line) of every line that counts; ``at`` orders all occurrences."""
    whole = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), F.lit(str(-(1 << 63) - 1)).cast("decimal(20,0)"))
    rows = docs.select("doc_id", F.xxhash64(text_of()).alias("h"), text_of().alias("text"))
    low = F.pmod("h", F.lit(_HASH)).cast("decimal(20,0)")
    rows = rows.select("h", (whole * F.lit(_LINE * _HASH).cast("decimal(20,0)") + low).cast("decimal(38,0)").alias("base"),
                       F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    at = (F.col("base") + (F.col("line_no").cast("long") * F.lit(_HASH)).cast("decimal(20,0)")).cast("decimal(38,0)")
    return rows.filter(_counts(F.col("line"))).select(at.alias("at"), "h", _trimmed(F.col("line")).alias("line"))


def distinct_lines(docs: DataFrame) -> DataFrame:
    """(id, line, size, at, h), a written table: every distinct line with its first occurrence. ``line`` is NULL where the budget is 0."""
    firsts = _lines(docs).groupBy("line").agg(F.min("at").alias("at"), F.min_by("h", "at").alias("h"))
    size = F.length("line")
    return written(firsts.select(F.monotonically_increasing_id().alias("id"), F.when(size >= CHARS_PER_EDIT, F.col("line")).alias("line"),
                                     size.alias("size"), "at", "h"), "lines")


def budget(size: Column) -> Column:
    """Edits that a line of ``size`` characters and a longer one may be apart."""
    return F.least(F.floor(size / CHARS_PER_EDIT).cast("int"), F.lit(MOST_EDITS))


def _cut(text: Column, start: Column, n: Column, narrow: Column) -> Column:
    """``n`` characters from ``start`` on. Where every character is one byte (``narrow``), bytes are cut, which walks over no characters."""
    return F.when(narrow, F.substring(text.cast("binary"), start, n).cast("string")).otherwise(F.substring(text, start, n))


def segment_keys(lines: DataFrame, probes: bool, *columns: str) -> DataFrame:
    """(key, *columns): a row for each of a line's own segments; with ``probes`` for each substring that a shorter line, or one as long, may have as a segment."""
    size, k, reach = F.col("size"), budget(F.col("size")), SEGMENT + 1
    left, right = F.floor(k / 2).cast("int") + 1, F.floor((k + 1) / 2).cast("int")
    # Segments from the start are numbered from 0, those from the end from -1 down; both ends are within a line of 100 characters for each edit.
    rows = lines.select(*columns, "line", "size", (F.octet_length("line") == size).alias("narrow"), (left * reach).alias("of_head"), (right * reach).alias("of_tail"),
                        k.alias("class"), F.greatest(budget(size - k), F.lit(1)).alias("low"), F.sequence(-right, left - 1).alias("segments"))
    rows = rows.select(*columns, "narrow", "class", "low", "of_tail", _cut(F.col("line"), F.lit(1), F.col("of_head"), F.col("narrow")).alias("head"),
                       _cut(F.col("line"), size - F.col("of_tail") + 1, F.col("of_tail"), F.col("narrow")).alias("tail"), F.explode("segments").alias("j"))
    first = F.when(F.col("j") >= 0, F.col("j") * SEGMENT).otherwise(F.col("of_tail") + F.col("j") * SEGMENT) + 1
    most = F.when(F.col("j") >= 0, F.col("j")).otherwise(-1 - F.col("j")) if probes else F.lit(0)
    # What all moves of a segment reach is cut out first, so that a probe walks over few characters.
    rows = rows.select(*columns, "narrow", "class", "low", "j", most.alias("most"), F.when(F.col("j") >= 0, F.col("head")).otherwise(F.col("tail")).alias("end"), first.alias("first"))
    rows = rows.withColumn("text", _cut(F.col("end"), F.col("first") - F.col("most"), SEGMENT + 2 * F.col("most"), F.col("narrow")))
    if probes:
        rows = rows.withColumn("from", F.explode(F.sequence(F.lit(1), 2 * F.col("most") + 1)))
        rows = rows.withColumn("text", _cut(F.col("text"), F.col("from"), F.lit(SEGMENT), F.col("narrow")))
        rows = rows.withColumn("hash", F.xxhash64("text", "j"))
        rows = rows.withColumn("class", F.explode(F.sequence("low", "class")))
        return rows.select(F.xxhash64("hash", "class").alias("key"), *columns)
    return rows.select(F.xxhash64(F.xxhash64("text", "j"), "class").alias("key"), *columns)


def _letter_counts(line: Column) -> Column:
    """Counts of the letters a to z, seven to a long, eight bits apart, up to 127 each; an edit raises one of them at most and lowers one."""
    count = lambda c: F.least(F.octet_length(line) - F.octet_length(F.replace(line, F.lit(c), F.lit(""))), F.lit(127)).cast("long")
    pack = lambda letters: reduce(lambda a, b: a.bitwiseOR(b), [F.shiftleft(count(c), 8 * i) for i, c in enumerate(letters)])
    return F.struct(*[pack(LOWER[i:i + _LANES]).alias(f"c{i // _LANES}") for i in range(0, len(LOWER), _LANES)])


def _counts_above(a: Column, b: Column) -> Column:
    """By how much the counts of ``a`` are above those of ``b``, in all, seven counts at a time."""
    every = lambda v: F.lit(sum(v << 8 * i for i in range(_LANES)))
    pairs = F.lit(0x00FF00FF00FF00FF)

    def above(c: str) -> Column:
        # The eighth bit of a count stays where it is at least the other's.
        apart = a[c].bitwiseOR(every(128)) - b[c]
        kept = apart.bitwiseAND(F.shiftright(apart, 7).bitwiseAND(every(1)) * 127)
        return kept.bitwiseAND(pairs) + F.shiftright(kept, 8).bitwiseAND(pairs)

    total = reduce(lambda x, y: x + y, [above(f"c{i}") for i in range(-(-len(LOWER) // _LANES))])
    half = total + F.shiftright(total, 32)
    return (half + F.shiftright(half, 16)).bitwiseAND(F.lit(0xFFFF))


def _marks(letters: Column) -> Column:
    """Letter counts in Gray code: a count that goes up or down by one changes one bit."""
    low = F.lit(sum(63 << 8 * i for i in range(_LANES)))
    return F.struct(*[letters[c].bitwiseXOR(F.shiftright(letters[c], 1).bitwiseAND(low)).alias(c) for c in _COUNTS])


def _marks_allow(a: Column, b: Column, k: Column, moved: Column) -> Column:
    """Whether ``k`` edits, ``moved`` of which at least add or drop a character, can explain the marks: a replaced character changes two counts, another edit one."""
    return reduce(lambda x, y: x + y, [F.bit_count(a[c].bitwiseXOR(b[c])) for c in _COUNTS]) <= 2 * k - moved


def _shared(a: Column, b: Column, part, most: Column) -> Column:
    """How many characters two strings have in common at one end (``part`` takes that many), up to ``most``, by halving."""
    def longer(p: Column, i: Column) -> Column:
        step = F.call_function("shiftleft", F.lit(1), 30 - i)
        return F.when((step <= most - p) & (part(a, p + step) == part(b, p + step)), p + step).otherwise(p)

    return F.aggregate(F.sequence(F.lit(0), F.lit(30)), F.lit(0), longer)


def within(a: Column, b: Column, k: Column) -> Column:
    """Whether two strings differ by at most ``k`` edits (0 to MOST_EDITS): the banded bit-parallel recurrence, one long per step.

    Equal beginnings and ends are cut off first. Rests no longer than the band are compared cell by cell, and so are those that hold the two characters (no Unicode characters) that
    mark places here. Bit t of a step stands for the place i + t - k - 1 of the longer rest; the band moves along the diagonal.
    """
    num = lambda v: F.lit(v).cast("long")
    up = lambda v, n: F.call_function("shiftleft", v, n)
    down = lambda v, n: F.call_function("shiftright", v, n)

    def cut(p: Column) -> Column:
        n, m = F.length(p["a"]), F.length(p["b"])
        begin = _shared(p["a"], p["b"], lambda s, c: F.substring(s, F.lit(1), c), F.least(n, m))
        rest = F.transform(F.array(begin), lambda c: F.struct(
            F.substring(p["a"], c + 1, n - c).alias("a"), F.substring(p["b"], c + 1, m - c).alias("b"), p["k"].alias("k")))[0]
        return let(rest, lambda q: let(
            _shared(q["a"], q["b"], F.right, F.least(F.length(q["a"]), F.length(q["b"]))),
            lambda c: F.struct(F.substring(q["a"], F.lit(1), F.length(q["a"]) - c).alias("a"),
                               F.substring(q["b"], F.lit(1), F.length(q["b"]) - c).alias("b"), q["k"].alias("k"))))

    def run(s: Column) -> Column:
        n, k, full, width = F.size(s["y"]), s["k"], s["full"], s["width"]
        rest = s["m"] - k  # while i is below this, the band's lowest place moves down the diagonal

        def step(acc: Column, i: Column) -> Column:
            # The tracked place is k - (m - n) places from the last one's diagonal, along which distances never fall.
            return F.when(acc["d"] > 2 * k - s["m"] + n, acc).otherwise(move(acc, i))

        def move(acc: Column, i: Column) -> Column:
            at = s["m"] - i
            seen = F.substring(s["x"][F.shiftright(at, 6)], at.bitwiseAND(F.lit(63)) + 1, width)
            marked = F.call_function("translate", F.replace(seen, s["y"][i], F.lit(_MARK)), s["chars"], s["bits"])
            return F.transform(F.transform(F.array(F.conv(marked, 2, 10).cast("long")), lambda eq: F.struct(
                acc["vp"].alias("vp"), acc["vn"].alias("vn"),
                ((eq.bitwiseAND(acc["vp"]) + acc["vp"]).bitwiseXOR(acc["vp"]).bitwiseOR(eq).bitwiseOR(acc["vn"])).bitwiseAND(full).alias("d0"))),
                lambda t: moved(acc["d"], t, i))[0]

        def moved(d: Column, t: Column, i: Column) -> Column:
            hp = t["vn"].bitwiseOR(F.bitwise_not(t["d0"].bitwiseOR(t["vp"])).bitwiseAND(full))
            hn, diagonal = t["d0"].bitwiseAND(t["vp"]), F.shiftrightunsigned(t["d0"], 1)
            bottom = width - 2 + rest - i  # from i = rest on, the last row comes up in the band
            bit = lambda v, at: down(v, at).bitwiseAND(num(1))
            return F.struct(
                hn.bitwiseOR(F.bitwise_not(diagonal.bitwiseOR(hp)).bitwiseAND(full)).alias("vp"), diagonal.bitwiseAND(hp).alias("vn"),
                (d + F.when(i < rest, 1 - bit(t["d0"], width - 1)).otherwise(bit(hp, bottom) - bit(hn, bottom))).alias("d"))

        start = F.struct(full.bitwiseAND(up(full, width - k - 1)).alias("vp"), num(0).alias("vn"), k.cast("long").alias("d"))
        return F.aggregate(F.sequence(F.lit(0), n - 1), start, step)["d"] <= k

    def compare(p: Column) -> Column:
        longer = F.length(p["a"]) >= F.length(p["b"])
        x, y, width = F.when(longer, p["a"]).otherwise(p["b"]), F.when(longer, p["b"]).otherwise(p["a"]), 2 * p["k"] + 2
        # The longer rest backwards, in overlapping blocks: what a step sees of it reads as a binary number once the step's character is marked.
        edge, chars = F.repeat(F.lit(_EDGE), p["k"] + 1), F.array_join(F.array_distinct(F.split(x, "")), "")
        blocks = let(F.concat(edge, F.reverse(x), edge), lambda t: F.transform(
            F.sequence(F.lit(0), F.shiftright(F.length(x), 6)), lambda b: F.substring(t, b * 64 + 1, 64 + width)))
        band = F.struct(blocks.alias("x"), F.split(y, "").alias("y"), F.length(x).alias("m"), p["k"].alias("k"),
                        width.alias("width"), (up(num(1), width) - 1).alias("full"), F.concat(F.lit(_MARK + _EDGE), chars).alias("chars"),
                        F.concat(F.lit("10"), F.repeat(F.lit("0"), F.length(chars))).alias("bits"))
        return (F.when(F.abs(F.length(p["a"]) - F.length(p["b"])) > p["k"], False)
                .when(F.length(y) == 0, F.length(x) <= p["k"]).when(p["k"] == 0, False)
                .when((F.length(x) <= width) | F.concat(x, y).rlike(f"[{_MARK}{_EDGE}]"), F.levenshtein(x, y) <= p["k"]).otherwise(let(band, run)))

    whole = F.struct(a.alias("a"), b.alias("b"), k.cast("int").alias("k"))
    return F.when(a == b, True).when(F.abs(F.length(a) - F.length(b)) > k, False).otherwise(let(let(whole, cut), compare))


def _cells_left(a: Column, b: Column, k: Column) -> Column:
    """Whether enough pieces of SEGMENT characters of ``a`` are anywhere in ``b``: an edit spoils one of them at most."""
    cells = F.sequence(F.lit(0), F.floor(F.length(a) / SEGMENT).cast("int") - 1)
    found = F.size(F.filter(cells, lambda j: F.contains(b, F.substring(a, j * SEGMENT + 1, F.lit(SEGMENT)))))
    return found >= F.floor(F.length(a) / SEGMENT) - k


def near(a: Column, b: Column) -> Column:
    """Whether two strings are within the budget of the shorter one."""
    k = budget(F.least(F.length(a), F.length(b)))
    # What the first characters of one became is among as many of the other, and k more.
    begin = let(CHARS_PER_EDIT * (k + 1), lambda n: F.struct(F.substring(a, F.lit(1), n).alias("a"), F.substring(b, F.lit(1), n + k).alias("b"), k.alias("k")))
    return F.when(k == 0, a == b).when(~let(begin, lambda p: _cells_left(p["a"], p["b"], p["k"])), False).otherwise(within(a, b, k))


def meetings(lines: DataFrame) -> DataFrame:
    """(key, id, leader), a written table: lines that find a segment of another line, and that segment's earliest holder."""
    some = lines.filter(F.col("size") >= CHARS_PER_EDIT)
    # A double orders occurrences well enough to choose leaders by, and takes less room than the exact number.
    early = some.withColumn("about", F.col("at").cast("double"))
    leaders = segment_keys(early, False, "id", "about").groupBy("key").agg(F.min_by("id", "about").alias("leader"))
    # Under a new name and value the keys are dealt anew, so that Spark can split those that many lines probe.
    leaders = leaders.select(F.bitwise_not("key").alias("at_key"), "leader")
    probes = segment_keys(some, True, "id").select(F.bitwise_not("key").alias("key"), "id")
    met = probes.join(leaders, F.col("key") == F.col("at_key")).filter("id <> leader").select("key", "id", "leader")
    # Leaders are one row per key and small: while all their partitions are, they are hashed and the many probes need no sort.
    return written(met, "line-meetings", {HASHED_PARTITION: "64m"})


def _texts(lines: DataFrame, met: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, line, size, at, letters) of the lines that met, and their ids; written tables."""
    ids = written(met.select(F.explode(F.array("id", "leader")).alias("id")).distinct(), "line-ids")
    found = rows_of(lines.select("id", "line", "size", "at"), "id", ids)
    return written(found.withColumn("letters", _letter_counts(F.col("line"))), "line-texts"), ids


def _likely(short: str, long: str) -> Column:
    """Whether lengths and letter counts of two lines (size_x, letters_x) allow them to be near."""
    k = budget(F.least(f"size_{short}", f"size_{long}"))
    longer = F.col(f"size_{long}") - F.col(f"size_{short}")
    # Edits that add (or drop) characters until the lengths agree raise counts of one line only.
    both = F.struct(F.col(f"letters_{short}").alias("a"), F.col(f"letters_{long}").alias("b"),
                    (k - F.greatest(longer, F.lit(0))).alias("most_a"), (k + F.least(longer, F.lit(0))).alias("most_b"))
    # Inside a lambda, as the code of a join with all of this in one method is too long for Java to compile.
    alike = let(both, lambda p: (_counts_above(p["a"], p["b"]) <= p["most_a"]) & (_counts_above(p["b"], p["a"]) <= p["most_b"]))
    return (F.abs(longer) <= k) & alike


def _side(texts: DataFrame, name: str, *columns: str) -> DataFrame:
    return texts.select(*[F.col(c).alias(f"{c}_{name}") for c in ("id", *columns)])


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(id): of the pairs (id_a, id_b) that are near, the line that comes later."""
    narrow = pairs.join(_side(texts, "a", "size", "letters"), "id_a").join(_side(texts, "b", "size", "letters"), "id_b")
    likely = narrow.filter(_likely("a", "b")).select("id_a", "id_b").distinct()
    both = likely.join(_side(texts, "a", "line", "at"), "id_a").join(_side(texts, "b", "line", "at"), "id_b")
    linked = both.filter(near(F.col("line_a"), F.col("line_b")))
    return linked.select(F.when(F.col("at_a") > F.col("at_b"), F.col("id_a")).otherwise(F.col("id_b")).alias("id")).distinct()


def meeting_once(members: DataFrame) -> DataFrame:
    """Pairs (id_a, id_b) of ``members`` (id, asks, keys, size, at, letters) that share a list, may be near, and whose later line asks.

    Near copies share many lists. They meet in the first one only, as far as it is among the ``FIRST_LISTS`` first ones of both.
    """
    about = F.col("at").cast("double")
    rows = members.select("id", "asks", "size", about.alias("about"), "letters", "keys", F.posexplode("keys").alias("pos", "key"))
    rows = rows.withColumn("before", F.slice("keys", F.lit(1), F.least("pos", F.lit(FIRST_LISTS))))
    side = lambda x: [F.col(c).alias(f"{c}_{x}") for c in ("id", "asks", "size", "about", "letters", "before")]
    short = rows.select("key", F.col("size").alias("length"), *side("a"))
    long = rows.select("key", F.explode(F.sequence(F.col("size") - budget(F.col("size")), "size")).alias("length"), *side("b"))
    # Where doubles do not tell which line is later, either may be.
    later = (F.when(F.col("about_a") > F.col("about_b"), F.col("asks_a")).when(F.col("about_a") < F.col("about_b"), F.col("asks_b"))
             .otherwise(F.col("asks_a") | F.col("asks_b")))
    k, longer = budget(F.col("size_a")), F.col("size_b") - F.col("size_a")
    return short.join(long, (short["key"] == long["key"]) & (short["length"] == long["length"]) & (F.col("id_a") != F.col("id_b"))
                      & ((longer > 0) | (F.col("id_a") < F.col("id_b"))) & (longer <= k) & later
                      # The exact counts are asked last: Spark interprets their lambda.
                      & _marks_allow(_marks(F.col("letters_a")), _marks(F.col("letters_b")), k, longer)
                      & ~F.arrays_overlap("before_a", "before_b") & _likely("a", "b")).select("id_a", "id_b")


def near_earlier(lines: DataFrame) -> DataFrame:
    """(id), a written table: the lines that are near to one with an earlier first occurrence."""
    met = meetings(lines)
    texts, ids = _texts(lines, met)
    # First every line and the leader of each of its lists.
    pairs = met.select(F.least("id", "leader").alias("id_a"), F.greatest("id", "leader").alias("id_b")).distinct()
    answered = written(verified(pairs, texts), "near-lines")
    # Then, in lists with three lines or more, the others among themselves, as far as the later one still asks.
    asking = met.join(answered.withColumn("done", F.lit(True)), "id", "left").select("key", "id", F.col("done").isNull().alias("asks"))
    open_ = asking.groupBy("key").agg(F.min("id").alias("x"), F.max("id").alias("y"), F.max("asks").alias("asks")).filter("x < y and asks").select("key")
    lists = asking.join(open_, "key", "left_semi").groupBy("id", "asks").agg(F.sort_array(F.collect_set("key")).alias("keys"))
    members = written(lists.join(texts.select("id", "size", "at", "letters"), "id"), "open-lists")
    among = meeting_once(members)
    more = verified(among.distinct(), texts)
    every = written(answered.union(more).distinct(), "near-lines")
    release(met, texts, ids, answered, members)
    return every


def line_decisions(docs: DataFrame) -> DataFrame:
    """(doc_id, h, kept_lines, n_near): per document with lines that count, the numbers of those that stay."""
    lines = distinct_lines(docs)
    near = near_earlier(lines)
    judged = lines.select("id", "at", "h").join(near.withColumn("near", F.lit(True)), "id", "left")
    step = F.lit(_LINE * _HASH).cast("decimal(20,0)")
    low = F.pmod(F.col("at"), step)
    whole = judged.select((F.col("at") - low).cast("decimal(38,0)").alias("start"), "h",
                          F.shiftright(low.cast("long"), 30).cast("int").alias("line_no"), F.coalesce("near", F.lit(False)).alias("near"))
    found = whole.groupBy("start", "h").agg(
        F.sort_array(F.collect_list(F.when(~F.col("near"), F.col("line_no")))).alias("kept_lines"),
        F.sum(F.col("near").cast("long")).alias("n_near"))
    base = (F.col("start") / step).cast("decimal(20,0)")
    found = found.select(F.when(base >= F.lit(-(1 << 63)).cast("decimal(20,0)"), base.cast("long")).alias("doc_id"), "h", "kept_lines", "n_near")
    found = written(found, "line-decisions")
    release(lines, near)
    return found


def _with_decisions(docs: DataFrame, extra: list[Column]) -> DataFrame:
    """``extra`` columns of ``docs`` with (kept_lines, n_near)."""
    rows, d = docs.select(*extra, docs["doc_id"].alias("key_id"), F.xxhash64(text_of()).alias("key_h")), line_decisions(docs)
    return rows.join(d, rows["key_id"].eqNullSafe(d["doc_id"]) & (rows["key_h"] == d["h"]), "left").drop("key_id", "key_h", "doc_id", "h")


def drop_lines(docs: DataFrame) -> DataFrame:
    """``docs`` without repeated lines."""
    df = _with_decisions(docs, [F.struct(*[docs[c] for c in docs.columns]).alias("row")])
    kept = F.coalesce("kept_lines", F.expr("cast(array() as array<int>)"))

    def remain(lines: Column) -> Column:
        others = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: ~_counts(lines[i]))
        return let(F.array_sort(F.array_union(others, kept)), lambda stay: F.struct(
            (F.size(stay) == F.size(lines)).alias("whole"), F.array_join(F.transform(stay, lambda i: lines[i]), "\n").alias("rest")))

    rest = let(F.split(F.coalesce("row.text", F.lit("")), "\n"), remain)
    # A generator computes the rest once; a filter is not moved below it.
    df = df.select("row", F.inline(F.array(rest)))
    new = F.col("row").withField("text", F.when(F.col("whole"), F.col("row.text")).otherwise(F.col("rest")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new = new.withField("n_chars", F.when(F.col("whole"), F.col("row.n_chars")).otherwise(F.length("rest").cast(kind)))
    return df.select(new.alias("row")).select("row.*")


@query("op7_line_dedup")
def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: its lines that count, how many repeat an earlier line exactly or nearly, and the numbers of those that stay."""
    docs = table(spark, folder, "documents")
    n_lines = F.size(F.filter(F.split(text_of(), "\n"), _counts)).cast("long")
    df = _with_decisions(docs, [docs["doc_id"].alias("id"), n_lines.alias("n_lines")])
    kept = F.coalesce("kept_lines", F.expr("cast(array() as array<int>)"))
    near = F.coalesce("n_near", F.lit(0)).cast("long")
    return df.select(F.col("id").alias("doc_id"), "n_lines", (F.col("n_lines") - F.size(kept) - near).alias("n_exact"),
                     near.alias("n_near"), kept.alias("kept_lines"))
