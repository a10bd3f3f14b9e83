"""Line deduplication by a segment-partition edit join, in DataFrame functions only.

Lines within `threshold` edits (insertions, deletions, substitutions of a character) of each other are linked; linked lines
form a class and its first line, by document and line number, stays. Equal lines are one line before anything else.

- Every line is cut into threshold + 1 even segments. Of two lines within the threshold one shares a whole segment with the
  other, near the same place. A line is indexed under (its length, segment number, segment), and it probes the indexes of all
  lengths from its own down to threshold less with the substrings that can be that segment there (the shift of a substring is
  bounded from the left by the segments before it and from the right by those after it).
- Candidates must also agree in a sketch of letter counts, which one edit changes by at most two. It rides along with the
  keys, so that lines which only share a segment never leave the join.
- Candidates are verified by a banded bit-parallel edit distance: the band of 2 * threshold + 1 diagonals lies in one long, and
  each character of one line moves it by a few bit operations. Common beginnings and ends are cut off first.

A line is known by the 64-bit hash of its text while links are sought; distances are measured on the texts.

Lines of fewer than `least_chars` characters are not compared by edits. With `short_equal` they form classes of equal lines, so that
their later copies go too; without it they take no part and stay. Blank lines (white space only) take no part either way, unless they
have `least_chars` characters. Null and empty texts stay. Null ids are kept. Rows
that repeat id and text count as one document. Only the named columns are read; an empty table gives no rows. Lines of any
length take part whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from epigrid.llm.common import WHITE, fresh, let
from epigrid.llm.components import connected_components
from epigrid.session import cut_lineage

THRESHOLD = 2
LEAST_CHARS = 20
#: Letters whose counts, modulo 128, make the sketch, with the count of all other bytes, modulo 256.
LETTERS = "etnaiorh"
#: So many line hashes are broadcast to fetch their texts; beyond that the texts are joined by a shuffle.
BROADCAST_IDS = 500_000
_TOP = 60  # bit of the band's last row
_ALL = (1 << _TOP + 1) - 1


def _lines(docs: DataFrame, id_column: str, text_column: str, least_chars: int, short_equal: bool = False) -> DataFrame:
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("mark"), F.posexplode(F.split(text, "\n")).alias("at", "line"))
    taken = F.char_length("line") >= least_chars
    if short_equal:
        taken = taken | (F.translate("line", WHITE, "") != "")
    return rows.where(taken).withColumn("line_id", F.xxhash64("line"))


def _keys(threshold: int) -> tuple[Column, int, int]:
    """Probe keys of `line`, hashes of (length, segment number, segment); the number of those that are its index keys, which
    come first, and of those for lines of its own length, which come before the others."""
    parts, line = threshold + 1, F.col("line")
    probes = [
        (shorter, i, shift)
        for shorter in range(parts)
        for i in range(parts)
        for shift in range(max(-i, shorter - (threshold - i)), min(i, shorter + threshold - i) + 1)
    ]
    probes.sort(key=lambda p: (p[0], p[2] != 0))

    def key(shorter: int, i: int, shift: int) -> Column:
        length = F.char_length(line) - shorter
        extra = length % parts  # the segments are even; the longer ones come last
        base, late = ((length - extra) / parts).cast("int"), extra - (parts - i)
        start, size = base * i + F.greatest(late, F.lit(0)), base + (late >= 0).cast("int")
        return F.xxhash64(length, F.lit(i), F.substring(line, start + shift + 1, size))

    # spelled out, not as a function over an array of probes: only so the keys are in generated code
    return F.array(*(key(*p) for p in probes)), parts, sum(p[0] == 0 for p in probes)


def _sketch() -> Column:
    left, rest = F.col("line"), F.octet_length("line")
    packed = F.lit(0).cast("long")
    for k, letter in enumerate(LETTERS):
        left, before = F.replace(left, F.lit(letter), F.lit("")), rest  # each letter from what the ones before left over
        rest = F.octet_length(left)
        packed = packed.bitwiseOR(F.shiftleft((before - rest).bitwiseAND(127).cast("long"), 7 * k))
    return packed.bitwiseOR(F.shiftleft(rest.bitwiseAND(255).cast("long"), 7 * len(LETTERS)))


def _sketch_gap(a: Column, b: Column) -> Column:
    """What one line has at least more of than the other, in the direction where that is more. An edit adds one letter at most
    and takes one at most; of the other bytes up to four, as a character may have so many."""
    more, less = F.lit(0).cast("long"), F.lit(0).cast("long")
    for k, values in enumerate([128] * len(LETTERS) + [256]):
        x, y = (F.shiftrightunsigned(v, 7 * k).bitwiseAND(values - 1) for v in (a, b))
        d = (x - y + values // 2).bitwiseAND(values - 1) - values // 2
        part = F.lit(4 if values == 256 else 1)
        more = more + F.ceil(F.greatest(d, F.lit(0)) / part)
        less = less + F.ceil(F.greatest(F.negative(d), F.lit(0)) / part)
    return F.greatest(more, less)


def candidates(lines: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(a, b): hashes of different lines that share a segment and agree in the sketch, a < b."""
    keys, own, level = _keys(threshold)
    keyed = lines.select("line_id", _sketch().alias("sketch"), keys.alias("keys")).distinct()
    keyed = cut_lineage(keyed, "line-keys")  # equal lines are one from here on; their texts are not shuffled
    index = keyed.select(F.explode(F.slice("keys", 1, own)).alias("key"), "line_id", "sketch").alias("i")
    offered = keyed.select(F.posexplode("keys").alias("probe", "key"), "line_id", "sketch")
    offered = offered.withColumn("same", F.col("probe") < level).drop("probe").alias("p")
    # lines of one length meet in one role, not in both
    other = F.when(F.col("p.same"), F.col("i.line_id") < F.col("p.line_id")).otherwise(F.col("i.line_id") != F.col("p.line_id"))
    near = _sketch_gap(F.col("i.sketch"), F.col("p.sketch")) <= threshold
    condition = (F.col("i.key") == F.col("p.key")) & other & near
    a, b = F.col("i.line_id"), F.col("p.line_id")
    return index.join(offered.hint("merge"), condition).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def _common(a: Column, b: Column, from_end: bool) -> Column:
    """Length of the common beginning (or end) of two texts, found bit by bit."""
    side = F.right if from_end else F.left
    shorter = F.least(F.char_length(a), F.char_length(b))

    def longer(seen: Column, step: Column) -> Column:
        reach = seen + step
        return F.when((reach <= shorter) & (side(a, reach) == side(b, reach)), reach).otherwise(seen)

    steps = F.array(*(F.lit(1 << k) for k in range(20, -1, -1)))
    return F.aggregate(steps, F.lit(0), longer)


def _bit_parallel(a: Column, b: Column, threshold: int) -> Column:
    """Edit distance of two arrays of characters of at least `threshold` elements, exact up to the threshold; above it, more."""
    m, n = F.size(a), F.size(b)

    def matches(i: Column) -> Column:
        bits = F.lit(0).cast("long")
        for k in range(2 * threshold + 1):
            same = F.get(a, i + (k - threshold)) == F.get(b, i)
            bits = bits + F.when(same, F.lit(1 << _TOP - 2 * threshold + k)).otherwise(F.lit(0).cast("long"))
        return bits

    def negated(x: Column) -> Column:
        return x.bitwiseXOR(F.lit(_ALL))

    def step(s: Column, x: Column) -> Column:
        vp, vn = s["vp"], s["vn"]
        zero = ((x.bitwiseAND(vp) + vp).bitwiseXOR(vp)).bitwiseOR(x).bitwiseOR(vn).bitwiseAND(F.lit(_ALL))

        def move(d0: Column) -> Column:
            hp, hn = vn.bitwiseOR(negated(d0.bitwiseOR(vp))), d0.bitwiseAND(vp)
            half = F.shiftrightunsigned(d0, 1)
            at = F.lit(_TOP - 1) + (m - threshold) - s["i"]  # once the band's last row is the last character
            bit = lambda v: F.call_function("getbit", v, at)
            down = 1 - F.call_function("getbit", d0, F.lit(_TOP))
            along = F.when(at >= 0, bit(hp) - bit(hn)).otherwise(F.lit(0).cast("byte"))
            return F.struct(
                hn.bitwiseOR(negated(half.bitwiseOR(hp))).alias("vp"),
                half.bitwiseAND(hp).alias("vn"),
                (s["d"] + F.when(s["i"] < m - threshold, down).otherwise(along)).cast("int").alias("d"),
                (s["i"] + 1).alias("i"),
            )

        return let(zero, move)

    start = F.struct(
        F.lit(_ALL ^ ((1 << _TOP - threshold) - 1)).alias("vp"), F.lit(0).cast("long").alias("vn"),
        F.lit(threshold).alias("d"), F.lit(0).alias("i"),
    )
    return F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), matches), start, step, lambda s: s["d"])


def edit_distance(a: Column, b: Column, threshold: int) -> Column:
    """Edit distance of two lines, exact up to the threshold; above it, some larger number."""
    def trimmed(pair: Column) -> Column:
        x, y = pair["x"], pair["y"]
        return let(_common(x, y, False), lambda k: F.struct(F.substring(x, k + 1, F.char_length(x)).alias("x"), F.substring(y, k + 1, F.char_length(y)).alias("y")))

    def chopped(pair: Column) -> Column:
        x, y = pair["x"], pair["y"]
        return let(_common(x, y, True), lambda k: F.struct(F.left(x, F.char_length(x) - k).alias("x"), F.left(y, F.char_length(y) - k).alias("y")))

    def measured(pair: Column) -> Column:
        # the same ending on both changes no distance and makes both long enough for the band
        letters = lambda t: F.filter(F.split(F.concat(t, F.lit("\n" * (threshold + 1))), ""), lambda c: c != "")
        both = F.struct(letters(pair["x"]).alias("x"), letters(pair["y"]).alias("y"))
        gap = F.abs(F.char_length(pair["x"]) - F.char_length(pair["y"]))
        return F.when(gap > threshold, gap).otherwise(let(both, lambda p: _bit_parallel(p["x"], p["y"], threshold)))

    return let(let(let(F.struct(a.alias("x"), b.alias("y")), trimmed), chopped), measured)


def links(lines: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(a, b): hashes of all different lines within the threshold, a < b, each once."""
    pairs = cut_lineage(candidates(lines, threshold), "candidates")
    ids = pairs.select(F.col("a").alias("line_id")).union(pairs.select("b")).distinct()
    wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    texts = cut_lineage(lines.select("line_id", "line").join(wanted, "line_id", "left_semi").distinct(), "candidate-lines")
    left, right = (texts.select(F.col("line_id").alias(n), F.col("line").alias(f"line_{n}")) for n in "ab")
    close = edit_distance(F.col("line_a"), F.col("line_b"), threshold) <= threshold
    return pairs.join(left, "a").join(right, "b").where(close).select("a", "b").distinct()


def classes(
    docs: DataFrame, threshold: int = THRESHOLD, least_chars: int = LEAST_CHARS, id_column: str = "doc_id", text_column: str = "text",
    short_equal: bool = False,
) -> DataFrame:
    """Every line that takes part: (id, mark, at, class_id, class_mark, class_at, n_links, kept).

    `mark` is the hash of the document's text, `at` the line number from 0; the class is named by its first line, which is kept.
    `n_links` counts the different lines within the threshold.
    """
    lines = _lines(docs, id_column, text_column, least_chars, short_equal)
    linked = cut_lineage(links(lines.where(F.char_length("line") >= least_chars), threshold), "line-links")
    member = connected_components(linked).select(F.col("node").alias("line_id"), "root")
    both = linked.select(F.col("a").alias("line_id")).unionAll(linked.select("b"))
    degree = both.groupBy("line_id").agg(F.count(F.lit(1)).alias("n_links"))
    known = member.join(degree, "line_id")
    rows = lines.select("id", "mark", "at", "line_id").join(known, "line_id", "left")
    rows = rows.select("id", "mark", "at", F.coalesce("root", "line_id").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    # stored, so that the join below has two shuffles of its own and can split a line that stands in very many documents
    first = cut_lineage(rows.groupBy("root").agg(F.min(F.struct("id", "mark", "at")).alias("first")), "first-lines")
    return rows.join(first, "root").select(
        "id", "mark", "at", F.col("first.id").alias("class_id"), F.col("first.mark").alias("class_mark"),
        F.col("first.at").alias("class_at"), F.col("n_links").cast("long").alias("n_links"),
        F.struct("id", "mark", "at").eqNullSafe(F.col("first")).alias("kept"),
    )


def clean(
    docs: DataFrame, threshold: int = THRESHOLD, least_chars: int = LEAST_CHARS, id_column: str = "doc_id", text_column: str = "text",
    short_equal: bool = False,
) -> DataFrame:
    """The rows without the lines that repeat an earlier one; a text that loses none stays byte for byte."""
    gone = classes(docs, threshold, least_chars, id_column, text_column, short_equal).where(~F.col("kept"))
    gone = gone.groupBy("id", "mark").agg(F.collect_set("at").alias("gone")).alias("g")
    mark, lost = fresh(docs, "__mark"), fresh(docs, "__gone")
    rows = docs.withColumn(mark, F.xxhash64(F.coalesce(F.col(text_column).cast("string"), F.lit("")))).alias("d")
    same = F.col(f"d.{id_column}").eqNullSafe(F.col("g.id")) & (F.col(f"d.{mark}") == F.col("g.mark"))
    joined = rows.join(gone, same, "left").select("d.*", F.col("g.gone").alias(lost))
    left = F.filter(F.split(text_column, "\n"), lambda line, i: ~F.array_contains(lost, i))
    text = F.when(F.col(lost).isNull(), F.col(text_column)).otherwise(F.array_join(left, "\n"))
    return joined.withColumn(text_column, text).drop(mark, lost)
