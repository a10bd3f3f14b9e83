"""Phrase collocation mining with counting quotient filters.

Texts are cut into pieces, pieces into words. A chunk of whole texts keeps its different words with their counts and its text as word
numbers. Words that are frequent in their language get a number across all chunks; a phrase with a rarer word is rare itself. Every
run of 2 to 4 numbers is packed into one key, and the keys of a chunk are counted in a quotient filter: an invertible permutation
spreads the packed key evenly, its leading bits are the quotient, by which the slots are ordered and of which only an occupancy
bitmap is stored, and all other bits stand in the slot. Nothing is hashed away, so equal keys are equal phrases and counts are exact.
The filters are dealt by the first bits of the quotient; those of one range are merged in key order and counts added. What is
frequent enough is turned back into its words.

A filter holds every phrase once per chunk, however often it occurs, and ranges follow the number of words of the table, so neither a
hot phrase nor a hot language makes a large group; what all tasks hold is bounded by the chunk or the range. The keys of a chunk are
made, sorted and counted for one block of them at a time, and open chunks count together, however many languages there are. Nothing
but numbers of rows goes through the driver, and no table is broadcast.

Null texts have no words; a null language counts as `und`. Ids are not read: repeated rows and documents count each for itself.
Further columns are not read either. A document longer than a chunk is a chunk of its own. An empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from epigrid.llm.common import giving_back, shards_for
from epigrid.session import cut_lineage, small_batches

LONGEST = 4
#: Bytes of text in a chunk; occurrences for each of which a range of keys is made; bits of the key by which one step splits ranges.
CHUNK_BYTES = 8 << 20
PER_RANGE = 1_000_000
STEP_BITS = 10
#: Chunks' worth of text in all open chunks of a task; different words of a chunk; keys of a chunk that are sorted at a time.
OPEN_CHUNKS = 4
CHUNK_WORDS = 400_000
PER_BLOCK = 1 << 19
#: Phrases of a language that are ranked among themselves first.
PER_RANKING = 100_000
#: Rows of a row group of the table of chunks; the size of a page is looked at after every row.
CHUNK_ROWS = {"parquet.block.row.count.limit": "4", "parquet.page.size.row.check.min": "1"}
BREAK = b"\xff"  # no byte of UTF-8
#: A-Z to lower case; signs that end a piece to the break; white space inside a piece to spaces.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else 255 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256)
)
#: Odd constants that the rounds of the permutation multiply by.
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)


def marked_words(raw: bytes) -> list[bytes]:
    """Words of a text, with a break before each further piece."""
    return raw.translate(_TABLE).replace(BREAK, b" " + BREAK + b" ").split()


def chunks(docs: DataFrame, lang_column: str, text_column: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(chunk, lang, words, counts, codes): words of some texts of one language, their counts, and the texts as the words'
    numbers from 1 on, 0 for a break, as little-endian 32-bit numbers.

    A chunk ends when it is full; if there are many languages, the largest one ends when all together hold too much.
    """

    def run(batches):
        numbers = count(TaskContext.get().partitionId() << 33)
        open_chunks: dict[str, _Chunk] = {}
        held = 0
        for batch in batches:
            langs = batch.column(0).to_pylist()
            texts = batch.column(1)
            for i, lang in enumerate(langs):
                raw = texts[i].as_buffer()
                if raw is None or not raw.size:
                    continue
                chunk = open_chunks.get(lang)
                if chunk is None:
                    chunk = open_chunks[lang] = _Chunk()
                chunk.add(raw.to_pybytes())
                held += raw.size
                if chunk.size >= chunk_bytes or len(chunk.number) > CHUNK_WORDS:
                    full = lang
                elif held > OPEN_CHUNKS * chunk_bytes:
                    full = max(open_chunks, key=lambda k: open_chunks[k].size)
                else:
                    continue
                held -= open_chunks[full].size
                yield open_chunks.pop(full).row(next(numbers), full)
        for lang, chunk in open_chunks.items():
            yield chunk.row(next(numbers), lang)

    picked = docs.select(F.coalesce(F.col(lang_column).cast("string"), F.lit("und")), F.col(text_column).cast("string"))
    return picked.mapInArrow(giving_back(run), "chunk long, lang string, words array<string>, counts array<long>, codes binary")


class _Chunk:
    def __init__(self):
        self.number: defaultdict[bytes, int] = defaultdict(count(1).__next__)
        self.number[BREAK] = 0
        self.codes = bytearray()
        self.size = 0

    def add(self, raw: bytes) -> None:
        words = marked_words(raw)
        self.codes += np.fromiter(map(self.number.__getitem__, words), np.int32, len(words)).tobytes()
        self.codes += bytes(4)
        self.size += len(raw)

    def row(self, number: int, lang: str) -> pa.RecordBatch:
        words = pa.array([w for w in self.number if w != BREAK], pa.binary()).cast(pa.string())  # by their numbers, without the break
        counts = np.bincount(np.frombuffer(self.codes, np.int32), minlength=len(words) + 1)[1:]
        ends = pa.array([0, len(words)], pa.int32())
        codes = pa.Array.from_buffers(pa.binary(), 1, [None, pa.array([0, len(self.codes)], pa.int32()).buffers()[1], pa.py_buffer(self.codes)])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()), pa.array([lang], pa.string()), pa.ListArray.from_arrays(ends, words),
                pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64())), codes,
            ],
            names=["chunk", "lang", "words", "counts", "codes"],
        )


def numbered_words(chunk_table: DataFrame, least: int) -> tuple[DataFrame, DataFrame, int, int]:
    """The frequent words (lang, word, f, g) with numbers g from 1 on, the words per language (lang, n), and both totals."""
    each = chunk_table.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w"))
    f = each.groupBy("lang", F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("f"))
    frequent = cut_lineage(f.where(F.col("f") >= least).withColumn("place", F.monotonically_increasing_id()), "frequent-words")
    part = F.shiftright("place", 33)
    # one row per partition of the stored table: how many words stand before it
    sizes = frequent.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    before = F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.withColumn("before", F.coalesce(before, F.lit(0))).drop("rows")
    inside = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    named = frequent.withColumn("part", part).join(offsets, "part").select("lang", "word", "f", (F.col("before") + inside + 1).alias("g"))
    named = cut_lineage(named, "numbered-words")
    sums = chunk_table.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x).alias("n")).groupBy("lang").agg(F.sum("n").alias("n"))
    lengths = cut_lineage(sums, "language-words")
    return named, lengths, frequent.count(), lengths.agg(F.sum("n")).first()[0] or 0


class Keys:
    """Packing of up to four word numbers of `bits` bits each into two halves, and the permutation of packed keys."""

    def __init__(self, words: int):
        self.bits = max(1, words.bit_length())
        if self.bits > 32:
            raise ValueError(f"{words} frequent words need more than 32 bits")
        self.half = 2 * self.bits
        self.mask = np.uint64((1 << self.half) - 1)

    def pack(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Halves of rows of four numbers; 0 stands for no word."""
        g, b = numbers.astype(np.uint64), np.uint64(self.bits)
        return g[0] << b | g[1], g[2] << b | g[3]

    def unpack(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        b, one = np.uint64(self.bits), np.uint64((1 << self.bits) - 1)
        return np.stack([high >> b, high & one, low >> b, low & one]).astype(np.int64)

    def _spread(self, x: np.ndarray, odd: int) -> np.ndarray:
        x = x * np.uint64(odd)
        x ^= x >> np.uint64(29)
        return x * np.uint64(odd) >> np.uint64(64 - self.half)

    def permute(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each round adds a mix of one half to the other, which `restore` takes away again."""
        for odd in _ODD:
            high, low = low, high ^ self._spread(low, odd)
        return high, low

    def restore(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for odd in reversed(_ODD):
            high, low = low ^ self._spread(high, odd), high
        return high, low

    def order(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Rows in key order; short keys are sorted as one number, of long ones only the few with a shared first half by both."""
        if 2 * self.half <= 64:
            return np.argsort(high << np.uint64(self.half) | low)
        order = np.argsort(high)
        first, second = high[order], low[order]
        mixed = (first[1:] == first[:-1]) & (second[1:] != second[:-1])
        if mixed.any():
            shared = np.zeros(len(first), bool)
            for half in np.unique(first[1:][mixed]):
                shared[np.searchsorted(first, half) : np.searchsorted(first, half, "right")] = True
            rows = order[shared]
            order[shared] = rows[np.lexsort((low[rows], high[rows]))]
        return order


class QuotientFilter:
    """Counting quotient filter of permuted keys whose first `lead` bits are known from elsewhere.

    The next `q` bits of the key are the quotient. Two bitmaps say which quotients occur and at which slots a run of equal quotients
    ends; the slots hold the remaining bits of the key, whole, as planes of bytes, and a count in one byte, with larger ones in a list.
    """

    def __init__(self, keys: Keys, lead: int, high: np.ndarray, low: np.ndarray, counts: np.ndarray):
        self.keys, self.lead, self.high, self.low, self.counts = keys, lead, high, low, counts

    @staticmethod
    def quotient_bits(keys: Keys, lead: int, size: int) -> int:
        return min(keys.half - lead, max(1, size.bit_length()))

    def pack(self) -> bytes:
        keys, n = self.keys, len(self.high)
        q = self.quotient_bits(keys, self.lead, n)
        rest = keys.half - self.lead - q
        quotient = (self.high >> np.uint64(rest)) & np.uint64((1 << q) - 1)
        occupied = np.zeros(1 << q, bool)
        occupied[quotient.astype(np.int64)] = True
        ends = np.append(quotient[1:] != quotient[:-1], True)
        planes = [self._planes(self.high & np.uint64((1 << rest) - 1), rest), self._planes(self.low, keys.half)]
        small = np.minimum(self.counts, 255).astype(np.uint8)
        large = self.counts[small == 255].astype("<i8")
        parts = [np.array([n, len(large)], "<i8"), np.packbits(occupied), np.packbits(ends), *planes, small, large]
        return b"".join(p.tobytes() for p in parts)

    @classmethod
    def unpack(cls, keys: Keys, lead: int, first: int, data: bytes) -> QuotientFilter:
        """`first`: the leading bits that are not stored."""
        n, m = np.frombuffer(data, "<i8", 2).tolist()
        q = cls.quotient_bits(keys, lead, n)
        rest = keys.half - lead - q
        raw, at = np.frombuffer(data, np.uint8), 16

        def take(size: int) -> np.ndarray:
            nonlocal at
            at += size
            return raw[at - size : at]

        occupied = np.flatnonzero(np.unpackbits(take(-(-(1 << q) // 8)), count=1 << q))
        ends = np.unpackbits(take(-(-n // 8)), count=n)
        run = np.cumsum(ends) - ends  # number of the run that each slot lies in
        high = (np.uint64(first) << np.uint64(q)) | occupied[run].astype(np.uint64)
        high = (high << np.uint64(rest)) | cls._from_planes(take(n * -(-rest // 8)), n)
        low = cls._from_planes(take(n * -(-keys.half // 8)), n)
        counts = take(n).astype(np.int64)
        counts[counts == 255] = np.frombuffer(data, "<i8", m, at)
        return cls(keys, lead, high, low, counts)

    @staticmethod
    def _planes(values: np.ndarray, bits: int) -> np.ndarray:
        size = -(-bits // 8)
        return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T)

    @staticmethod
    def _from_planes(planes: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros((n, 8), np.uint8)
        if n and len(planes):
            size = len(planes) // n
            out[:, :size] = planes.reshape(size, n).T
        return out.view("<u8").ravel().astype(np.uint64)

    @property
    def size(self) -> int:
        return len(self.high)

    def dealt(self, lead: int, shard: int) -> pa.RecordBatch:
        """Rows (first, shard, filter): the packed filters of the ranges that the first `lead` bits name."""
        first = (self.high >> np.uint64(self.keys.half - lead)).astype(np.int64) if lead else np.zeros(self.size, np.int64)
        heads = np.flatnonzero(np.append(self.size > 0, first[1:] != first[:-1]))
        tails = np.append(heads[1:], self.size)
        packed = [QuotientFilter(self.keys, lead, self.high[a:b], self.low[a:b], self.counts[a:b]).pack() for a, b in zip(heads, tails)]
        columns = [pa.array(first[heads], pa.int32()), pa.array(np.full(len(heads), shard), pa.int32()), pa.array(packed, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["first", "shard", "filter"])

    @classmethod
    def merged(cls, filters: list[QuotientFilter]) -> QuotientFilter:
        """One filter of the sorted filters' keys, counts added."""
        keys = filters[0].keys
        high, low, counts = (np.concatenate([getattr(f, name) for f in filters]) for name in ("high", "low", "counts"))
        order = keys.order(high, low)
        high, low = high[order], low[order]
        heads = np.flatnonzero(np.append(True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])))
        return cls(keys, filters[0].lead, high[heads], low[heads], np.add.reduceat(counts[order], heads))


def _phrase_keys(at: np.ndarray, start: np.ndarray, n: int, keys: Keys) -> tuple[np.ndarray, np.ndarray]:
    """Permuted keys of the runs of n words that begin at the given places."""
    rows = np.zeros((LONGEST, len(start)), np.uint64)
    for k in range(n):
        rows[k] = at[start + k]
    return keys.permute(*keys.pack(rows))


def chunk_filters(codes: np.ndarray, number: np.ndarray, keys: Keys, lead: int, shard: int) -> Iterator[pa.RecordBatch]:
    """Rows of `dealt` with every run of 2 to LONGEST frequent words of a chunk, from some ranges of keys at a time.

    codes: words of the chunk, 0 for breaks; number: of each word across all chunks, 0 if it is not frequent.
    """
    at = number.astype(np.uint32)[codes]
    good = at > 0
    long = good.astype(np.uint8)  # words of the longest such run from each place on
    for n in range(1, LONGEST):
        good = good[:-1] & (at[n:] > 0)
        long[: len(good)] += good
    lengths = range(2, LONGEST + 1)
    runs = sum(int(np.count_nonzero(long >= n)) for n in lengths)
    bits = min(lead, 8, (shards_for(runs, PER_BLOCK) - 1).bit_length())
    blocks = np.zeros((len(lengths), len(at) if bits else 0), np.uint8)  # the first bits of each run's key
    if bits:
        for n in lengths:
            for begin in range(0, len(at), PER_BLOCK):
                start = np.flatnonzero(long[begin : begin + PER_BLOCK] >= n) + begin
                blocks[n - 2, start] = _phrase_keys(at, start, n, keys)[0] >> np.uint64(keys.half - bits)
    for block in range(1 << bits):
        found = []
        for n in lengths:
            here = long >= n
            found.append(_phrase_keys(at, np.flatnonzero(here & (blocks[n - 2] == block) if bits else here), n, keys))
        high, low = (np.concatenate(halves) for halves in zip(*found))
        del found
        if len(high):
            whole = QuotientFilter.merged([QuotientFilter(keys, 0, high, low, np.ones(len(high), np.int64))])
            yield whole.dealt(lead, shard)


def range_steps(occurrences: int, keys: Keys) -> list[int]:
    """Bits by which the steps split the key: 2 ** sum ranges of about PER_RANGE occurrences in all."""
    left = min(keys.half - 1, 30, (shards_for(occurrences, PER_RANGE) - 1).bit_length())
    return [STEP_BITS] * (left // STEP_BITS) + [left % STEP_BITS] * (left % STEP_BITS > 0) or [0]


def filters(chunk_table: DataFrame, named: DataFrame, keys: Keys, lead: int, shards: int) -> DataFrame:
    """(first, shard, filter): a packed filter per chunk and range of keys; chunks are dealt to `shards` by a hash."""
    words = chunk_table.select("chunk", "lang", F.posexplode("words").alias("at", "word"))
    # one for each word of the chunk at most; place and number in one long, since the lists stand in the executor's heap
    placed = F.shiftleft(F.col("at").cast("long"), 32).bitwiseOR(F.col("g"))
    numbers = words.join(named, ["lang", "word"]).groupBy("chunk").agg(F.collect_list(placed).alias("numbers"))
    texts = chunk_table.select("chunk", F.size("words").alias("size"), "codes").join(numbers, "chunk")
    shard = F.pmod(F.xxhash64("chunk"), F.lit(shards)).cast("int").alias("shard")

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                number = np.zeros(batch.column("size")[i].as_py() + 1, np.int64)
                placed = batch.column("numbers")[i].values.to_numpy()
                number[(placed >> 32) + 1] = placed & 0xFFFFFFFF
                codes = np.frombuffer(batch.column("codes")[i].as_buffer(), np.int32)
                yield from chunk_filters(codes, number, keys, lead, batch.column("shard")[i].as_py())

    return texts.select("size", "codes", "numbers", shard).mapInArrow(giving_back(run), "first int, shard int, filter binary")


def _merged(rows: pa.Table, keys: Keys, lead: int) -> QuotientFilter:
    """One filter of all packed ones of a range; opened ones are merged whenever they outgrow what is merged already."""
    first, merged, held = rows["first"][0].as_py(), [], []
    for packed in rows["filter"]:
        held.append(QuotientFilter.unpack(keys, lead, first, packed.as_buffer()))
        if sum(f.size for f in held) > max(PER_RANGE, *(f.size for f in merged), 0):
            merged, held = [QuotientFilter.merged(merged + held)], []
    return QuotientFilter.merged(merged + held)


def frequent_phrases(chunk_table: DataFrame, named: DataFrame, keys: Keys, steps: list[int], least: int) -> DataFrame:
    """(g1, g2, g3, g4, f): the phrases that occur at least so often.

    With few ranges one step merges all filters of a range. With very many, a step merges the filters of some shards, splits the
    merged ones by further bits, and leaves fewer shards, so that a filter is never cut into crumbs.
    """
    lead, left = steps[0], sum(steps[1:])
    table = filters(chunk_table, named, keys, lead, 1 << left)
    for bits in steps[1:]:
        left -= bits
        table = table.groupBy("first", "shard").applyInArrow(_split(keys, lead, lead + bits, 1 << left), "first int, shard int, filter binary")
        lead += bits

    def often(rows: pa.Table) -> pa.Table:
        found = _merged(rows, keys, lead)
        kept = found.counts >= least
        numbers = keys.unpack(*keys.restore(found.high[kept], found.low[kept]))
        return pa.table([*map(pa.array, numbers), pa.array(found.counts[kept])], names=["g1", "g2", "g3", "g4", "f"])

    return table.groupBy("first").applyInArrow(often, "g1 long, g2 long, g3 long, g4 long, f long")


def _split(keys: Keys, lead: int, further: int, shards: int):
    def run(rows: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_merged(rows, keys, lead).dealt(further, rows["shard"][0].as_py() % shards)])

    return run


GRAM = ["g1", "g2", "g3", "g4"]


def _part(begin: int, end: int) -> Column:
    """Words begin .. end - 1 of a phrase, as a phrase."""
    return F.struct(*[(F.col(GRAM[begin + k]) if begin + k < end else F.lit(0).cast("long")).alias(g) for k, g in enumerate(GRAM)])


def _length() -> Column:
    return F.when(F.col("g3") == 0, 2).when(F.col("g4") == 0, 3).otherwise(4)


def _wide(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(20,0)")


def scored(phrases: DataFrame, counted: DataFrame, factor: int = 2_000_000) -> DataFrame:
    """(g1 .. g4, a, l, r, score) of every phrase by its lowest-scoring cut, the first one among equals.

    counted: (g1 .. g4, f) of all phrases and single words.
    """
    cuts = F.filter(
        F.array(*[
            F.struct(F.lit(k).alias("k"), F.lit(n).alias("n"), _part(0, k).alias("left"), _part(k, n).alias("right"))
            for n in (2, 3, 4) for k in range(1, n)
        ]),
        lambda c: c["n"] == _length(),
    )
    cut = phrases.select(*GRAM, F.col("f").alias("a"), F.explode(cuts).alias("c")).select(*GRAM, "a", "c.*")
    for side, name in (("left", "l"), ("right", "r")):
        known = counted.select(F.struct(*GRAM).alias(side), F.col("f").alias(name))
        cut = cut.join(known, side)
    points = F.expr(f"(CAST(a AS DECIMAL(20,0)) * {factor}) DIV (CAST(l AS DECIMAL(20,0)) + r)")
    best = F.min(F.struct(points.alias("score"), "k", "l", "r")).alias("best")
    return cut.groupBy(*GRAM, "a").agg(best).select(*GRAM, "a", "best.l", "best.r", "best.score")


def outshone(phrases: DataFrame, percent: int = 80) -> DataFrame:
    """(g1 .. g4, most): phrases inside longer ones, with the largest count of those."""
    inner = F.filter(
        F.array(*[
            F.struct(F.lit(n).alias("n"), _part(a, a + m).alias("part"))
            for n in (3, 4) for m in range(2, n) for a in range(n - m + 1)
        ]),
        lambda p: p["n"] == _length(),
    )
    parts = phrases.select("f", F.explode(inner).alias("p")).select("p.part.*", "f")
    return parts.groupBy(*GRAM).agg(F.max("f").alias("most"))


def mine(
    docs: DataFrame, least: int = 30, percent: int = 80, top: int = 2000, lang_column: str = "lang", text_column: str = "text"
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of each language."""
    small_batches(docs.sparkSession)
    # a row is a chunk: Parquet's writer and reader hold some of them at once, not as many as a task has
    chunk_table = cut_lineage(chunks(docs, lang_column, text_column), "word-chunks", CHUNK_ROWS)
    named, lengths, words, total = numbered_words(chunk_table, least)
    keys = Keys(words)
    steps = range_steps((LONGEST - 1) * total, keys)
    phrases = cut_lineage(frequent_phrases(chunk_table, named, keys, steps, least), "phrases")
    zero = F.lit(0).cast("long")
    singles = named.select(F.col("g").alias("g1"), zero.alias("g2"), zero.alias("g3"), zero.alias("g4"), "f")
    ranked = scored(phrases, phrases.unionByName(singles))
    longer = outshone(phrases)
    kept = ranked.join(longer, GRAM, "left").where(
        F.col("most").isNull() | (_wide("most") * 100 < _wide("a") * percent)
    ).drop("most")
    spelled = (
        kept.withColumn("w", F.explode(F.filter(F.array(*[F.struct(F.lit(i).alias("at"), F.col(g).alias("g")) for i, g in enumerate(GRAM)]), lambda w: w["g"] > 0)))
        .join(named.select("lang", "word", F.col("g").alias("w_g")), F.col("w.g") == F.col("w_g"))
        .groupBy(*GRAM, "lang", "a", "l", "r", "score")
        .agg(F.sort_array(F.collect_list(F.struct("w.at", "word"))).alias("ws"))
        .select("lang", F.array_join(F.col("ws.word"), " ").alias("phrase"), "a", "l", "r", "score")
    )
    # a language's phrases are ranked in parts first, so that no task sorts all of them
    parts = shards_for(phrases.count(), PER_RANKING)
    dealt = spelled.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    ahead = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    best = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    first = dealt.withColumn("rank", ahead).where(F.col("rank") <= top).withColumn("rank", best).where(F.col("rank") <= top)
    return first.join(lengths, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
