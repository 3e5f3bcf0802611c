"""Fuzzy dedup of lines: SimHash blocks and word pairs, edit similarity, one occurrence per connected group.

Lines are lower-cased and their white space collapsed. Candidates are lines that agree in two of four blocks of the
64-bit SimHash of their distinct words, and lines that share one of their first word pairs in a common order; the
latter are all lines within the edits allowed. Candidates are linked whose words are at an edit similarity of 0.8 or
more. Everything is DataFrame code.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from itertools import combinations
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ldspark.session import scratch_path, scratch_scope

from .common import SPACE, text_of, unpack, whole_row, write_scratch
from .components import components

SIMILARITY = 0.8
LEAST_WORDS = 5
BLOCKS = ((0, 16), (16, 16), (32, 16), (48, 16))
EQUAL_BLOCKS = 2
COUNTED_TOGETHER = 16_383
LOOKUP_BITS = 1 << 24
_LANES = 16
_PARITIES = [f"p{i}" for i in range(4)]
# Folding two parities by XOR still leaves one bit a word; less is shuffled then.
_FOLDED = [("p0", "p1"), ("p2", "p3")]
_ROUNDS = 4
# One character for each word when words are compared; 1920 of them take two bytes. A pair must be within the edits
# by two of them, each from other digits of the word's hash.
_ALPHABET = " ".join(map(chr, range(0x80, 0x800)))
_SYMBOLS = 0x800 - 0x80
_ALPHABETS = 2
_TURNED = 0x5DEECE66D
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What a step has shuffled leaves the disk when the step is written, not when the driver collects its garbage."""
    before = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREED)
        else:
            spark.conf.set(_FREED, before)


def _lines(docs: DataFrame, id_col: str, text_col: str, more: tuple[str, ...] = ()) -> DataFrame:
    """``id``, ``line_no`` (from 0) and normalised ``line`` of every line with a word, and ``more`` columns."""
    lower = F.lower(text_of(text_col))
    # Few texts have white space to collapse, and looking for it is many times cheaper than replacing it.
    uneven = reduce(or_, [lower.contains(mark) for mark in ("  ", "\t", "\x0b", "\x0c", "\r")])
    norm = F.when(uneven, F.regexp_replace(lower, r"[\x20\x09\x0B-\x0D]+", " ")).otherwise(lower)
    split = docs.select(F.col(id_col).alias("id"), *more, F.posexplode(F.split(norm, "\n")).alias("line_no", "line"))
    return split.where("line <> '' AND line <> ' '").select("id", *more, "line_no", F.trim("line").alias("line"))


def _digests() -> list[Column]:
    return [F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")]


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``line_no``, ``h1``, ``h2`` (digest of the line), ``n_words``, ``fp`` and the parities ``p0`` to ``p3``;
    one row per line with a word.

    A bit of the SimHash is set when over half of the line's distinct words have it set in their hash. Four counters
    share a long, so 16 sums count all 64 bits of a line of at most 16,383 words; longer lines, which only texts of
    twice as many bytes can hold, are counted bit by bit. A line's words are summed in the task that reads them,
    before the shuffle.

    Each distinct word flips one of the 256 parity bits.

    Rows that repeat an identifier, or have none, may repeat a line at its place. Such rows are summed each for
    itself, and one of equal lines is kept; all other rows need no such step.
    """
    ids = docs.select(F.col(id_col).alias("id")).groupBy("id").count().where("count > 1").select("id")
    several = write_scratch(ids, "repeated-ids")
    if several.isEmpty():
        return _summed(docs, id_col, text_col)
    same = F.col("_id").eqNullSafe(F.col("id"))
    named = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    again = named.join(several, same, "left_semi").withColumn("_row", F.monotonically_increasing_id())
    summed = _summed(again, "_id", "_text", ("_row",)).drop("_row").dropDuplicates(["id", "line_no", "h1", "h2"])
    return _summed(named.join(several, same, "left_anti"), "_id", "_text").union(summed)


def _summed(docs: DataFrame, id_col: str, text_col: str, row: tuple[str, ...] = ()) -> DataFrame:
    """:func:`fingerprints` of rows that ``row`` tells apart where their identifier does not."""
    parities = [
        F.bit_xor(F.expr(f"IF(((w >> 6) & 3) = {i}, shiftleft(1L, CAST(w & 63 AS INT)), 0L)")).alias(name)
        for i, name in enumerate(_PARITIES)
    ]

    def counted(some: DataFrame, least_bytes: int, sums: list[Column], chosen: Column, fp: Column) -> DataFrame:
        hashes = F.transform(F.split("line", " "), lambda w: F.xxhash64(w))
        found = _lines(some, id_col, text_col, row).where(F.octet_length("line") > least_bytes)
        lines = found.select(*row, "id", "line_no", *_digests(), hashes.alias("hashes")).where(chosen)
        told = [*row, "id", "line_no", "h1", "h2", "n_words"]
        words = lines.select(*told[:-1], F.size("hashes").alias("n_words"), F.explode(F.array_distinct("hashes")).alias("w"))
        return words.groupBy(*told).agg(F.count(F.lit(1)).alias("n"), *sums, *parities).select(*told, fp.alias("fp"), *_PARITIES)

    each_lane = sum(1 << 16 * i for i in range(4))
    tops = F.lit(each_lane << 14)
    lanes = [F.sum(F.shiftrightunsigned("w", k).bitwiseAND(F.lit(each_lane))).alias(f"s{k}") for k in range(_LANES)]
    # A bit set above each counter stays after the subtraction if the counter was over half.
    half = (F.floor(F.col("n") / 2) + 1) * F.lit(each_lane)

    def over_half(k: int) -> Column:
        kept = (F.col(f"s{k}").bitwiseOR(tops) - half).bitwiseAND(tops)
        return F.shiftleft(F.shiftrightunsigned(kept, 14), k)

    singles = [F.sum(F.shiftrightunsigned("w", k).bitwiseAND(F.lit(1))).alias(f"s{k}") for k in range(64)]
    zero = F.lit(0).cast("long")
    one_by_one = [F.when(F.col(f"s{k}") * 2 > F.col("n"), F.lit(_signed(1 << k)).cast("long")).otherwise(zero) for k in range(64)]
    short = F.size("hashes") <= COUNTED_TOGETHER
    bytes_of_long = 2 * COUNTED_TOGETHER
    large = docs.where(F.octet_length(text_of(text_col)) > bytes_of_long)
    return counted(docs, 0, lanes, short, reduce(Column.bitwiseOR, [over_half(k) for k in range(_LANES)])).union(
        counted(large, bytes_of_long, singles, ~short, reduce(Column.bitwiseOR, one_by_one))
    )


def _block_keys() -> Column:
    """A key for every choice of two blocks: the choice and the bits of both."""
    keys = []
    for i, choice in enumerate(combinations(BLOCKS, EQUAL_BLOCKS)):
        key = F.lit(i).cast("long")
        for at, width in choice:
            bits = F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << width) - 1))
            key = F.shiftleft(key, width).bitwiseOR(bits)
        keys.append(key)
    return F.array(*keys)


def _pair_keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``h1``, ``key`` for the first word pairs of every line of enough words; repeated lines repeat their rows.

    All lines order their distinct pairs of neighbouring words alike: longer pairs first, which are rarer, then by
    hash. Of two lines within the edits allowed, each of n words loses at most 2n/5 pairs to the other: an edit of
    a word takes two pairs and one between words takes one. So the first pair that they share is among the first
    floor(2n/5) + 1 of both, and there is one, since n - 1 is more.
    """
    # A word's code is its length, longest first, above its hash; the sum of two codes ranks a pair by both lengths.
    # Turning some bits of the second tells "a b" from "b a".
    code = "shiftleft(CAST(31 - least(octet_length(w), 31) AS BIGINT), 57) | shiftrightunsigned(xxhash64(w), 7)"
    words = _lines(docs, id_col, text_col).select(F.xxhash64("line").alias("h1"), F.expr(f"transform(split(line, ' '), w -> {code})").alias("c"))
    words = words.select("h1", F.size("c").alias("n"), "c").where(F.col("n") >= LEAST_WORDS)
    pairs = F.expr(f"zip_with(slice(c, 1, n - 1), slice(c, 2, n - 1), (a, b) -> a + (b ^ {_TURNED}L))")
    first = F.slice(F.sort_array(F.array_distinct("pairs")), F.lit(1), F.floor(F.col("n") * 2 / 5).cast("int") + 1)
    return words.select("h1", "n", pairs.alias("pairs")).select("h1", F.explode(first).alias("key"))


def _near(a: str, b: str, parities: list[str] = _PARITIES) -> Column:
    """Lengths and parities that a pair at the edit similarity can have: an edit changes at most two parity bits."""
    short, long = F.least(f"{a}_words", f"{b}_words"), F.greatest(f"{a}_words", f"{b}_words")
    edits = F.floor(long * (1 - SIMILARITY) + 1e-9)
    changed = sum((F.bit_count(F.col(f"{a}_{p}").bitwiseXOR(F.col(f"{b}_{p}"))) for p in parities), F.lit(0))
    return (long - short <= edits) & (changed <= 2 * edits)


def _length_class(words: Column) -> Column:
    """By powers of two, so that a line has at most two classes within the similarity, and most have one."""
    return F.floor(F.log2(words.cast("double")))


def _words_of(nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``h1``, ``words`` of the lines listed by ``h1``: a text per alphabet with a symbol for each word, by its hash,
    so that lines are compared in native calls.

    The texts are read once more. A bit for each listed line, in a table of at most 16 million bits, is broadcast
    and leaves out most other lines before the join that settles it.
    """
    slot = F.pmod("h1", F.lit(LOOKUP_BITS))
    one = F.expr("shiftleft(1L, CAST(slot % 64 AS INT))")
    bits = (
        nodes.select(slot.alias("slot"))
        .groupBy(F.expr("slot div 64").alias("part"))
        .agg(F.bit_or(one).alias("bits"))
    )
    alphabet = F.split(F.lit(_ALPHABET), " ")

    def symbols(digit: int) -> Column:
        def of(w: Column) -> Column:
            rest = F.shiftrightunsigned(F.xxhash64(w), 32 * digit)
            return F.element_at(alphabet, (F.pmod(rest, F.lit(_SYMBOLS)) + 1).cast("int"))

        return F.array_join(F.transform(F.split("line", " "), of), "")

    texts = F.array(*[symbols(digit) for digit in range(_ALPHABETS)])
    hashed = _lines(docs, id_col, text_col).select(F.xxhash64("line").alias("h1"), "line").withColumn("slot", slot)
    likely = hashed.join(F.broadcast(bits), F.expr("slot div 64") == F.col("part")).where(F.col("bits").bitwiseAND(one) != 0)
    # An inner join: a semi join would be moved below the broadcast one, and shuffle all lines.
    return likely.select("h1", texts.alias("words")).join(nodes, "h1").dropDuplicates(["h1"])


def _verified(candidates: DataFrame, words: DataFrame) -> DataFrame:
    """Of the pairs ``a``, ``b`` of line digests those at the edit similarity, counted in words.

    Symbols never tell more edits than the words. They tell fewer only where two words that differ have one symbol in
    every alphabet, about once in 3.7 million pairs of words.
    """
    first = words.select(F.col("h1").alias("a"), F.col("words").alias("left"))
    second = words.select(F.col("h1").alias("b"), F.col("words").alias("right"))
    edits = f"CAST(FLOOR({1 - SIMILARITY:.6f}D * GREATEST(LENGTH(left[0]), LENGTH(right[0])) + 1e-9D) AS INT)"
    within = " AND ".join(f"LEVENSHTEIN(left[{k}], right[{k}], {edits}) >= 0" for k in range(_ALPHABETS))
    pairs = candidates.distinct().join(first, "a").join(second, "b")
    return write_scratch(pairs.where(F.expr(within)).select("a", "b"), "line-links")


def line_links(distinct: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Verified links ``a``, ``b`` between line digests that give the groups of all verified pairs.

    Lines that share a key are first compared with its smallest only. Where a line ends up in another group than
    that one, it is then compared with every line of the key that is in another group than its own. A key full of
    variants of one line so costs one comparison a line, and no pair of different groups is left out.
    """
    long = distinct.where(F.col("n_words") >= LEAST_WORDS)
    blocks = long.select("h1", F.explode(_block_keys()).alias("key"))
    # Dealt by key once for both uses.
    keyed = blocks.union(_pair_keys(docs, id_col, text_col)).repartition("key")
    leaders = (
        keyed.groupBy("key")
        .agg(F.min("h1").alias("leader"), F.max("h1").alias("last"), (F.count(F.lit(1)) > 2).alias("more"))
        .where("leader <> last")
        .drop("last")
    )
    shared = write_scratch(keyed.join(leaders.hint("shuffle_hash"), "key").distinct(), "shared-keys")

    def ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("h1")).union(pairs.select(F.col("b").alias("h1"))).distinct()

    def spelt(nodes: DataFrame) -> DataFrame:
        return write_scratch(_words_of(nodes, docs, id_col, text_col), "line-words")

    pairs = shared.where("h1 <> leader").select(F.col("leader").alias("a"), F.col("h1").alias("b")).distinct()
    # Words are read for lines of pairs that lengths and parities leave, which are few.
    near = write_scratch(_told_near(pairs, long), "near-pairs")
    words = spelt(ends(near))
    stars = _verified(near, words)
    groups = components(stars)
    others = write_scratch(_apart(shared, long, groups), "near-pairs")
    if not others.isEmpty():
        more = spelt(ends(others).join(words.select("h1"), "h1", "left_anti"))
        stars = stars.union(_verified(others, words.union(more)))
    return stars


def _apart(shared: DataFrame, long: DataFrame, groups: DataFrame) -> DataFrame:
    """Pairs ``a`` < ``b`` of one key and two groups, one of which is not that of the key's smallest line, as far as lengths
    and parities allow.

    The pairs are found in rounds by hash of the key, so what is shuffled at a time is a share of the rows.
    """
    # Two lines that alone share a key have been compared.
    led = shared.where("more").select("key", "h1", "leader").join(
        groups.select(F.col("node").alias("leader"), F.col("root").alias("led")), "leader", "left"
    )
    folded = [F.col(p).bitwiseXOR(F.col(q)).alias(p) for p, q in _FOLDED]
    told = long.select("h1", F.col("n_words").alias("words"), *folded).join(
        groups.select(F.col("node").alias("h1"), F.col("root").alias("own")), "h1", "left"
    )
    own = F.coalesce("own", "h1")
    members = write_scratch(
        led.where("h1 <> leader")
        .join(told, "h1")
        .select("key", "h1", own.alias("own"), (own != F.coalesce("led", "leader")).alias("apart"), "words", *[p for p, _ in _FOLDED]),
        "key-members",
    )
    found = []
    for turn in range(_ROUNDS):
        some = members.where(F.pmod(F.xxhash64("key"), F.lit(_ROUNDS)) == turn)
        first, second = (some.select("key", *[F.col(c).alias(f"{side}_{c}") for c in some.columns[1:]]) for side in "ab")
        first = first.where("a_apart").withColumn("class", _length_class(F.col("a_words")))
        least, most = F.col("b_words") * (SIMILARITY - 1e-6), F.col("b_words") / (SIMILARITY - 1e-6)
        second = second.withColumn("class", F.explode(F.sequence(_length_class(least), _length_class(most))))
        met = first.join(second, ["key", "class"]).where((F.col("a_own") != F.col("b_own")) & _near("a", "b", [p for p, _ in _FOLDED]))
        met = met.select(F.least("a_h1", "b_h1").alias("a"), F.greatest("a_h1", "b_h1").alias("b")).distinct()
        found.append(write_scratch(met, "met-pairs"))
    return _told_near(reduce(DataFrame.union, found).distinct(), long)


def _told_near(pairs: DataFrame, long: DataFrame) -> DataFrame:
    """The pairs ``a``, ``b`` that lengths and all parities allow."""

    def told(side: str) -> DataFrame:
        return long.select(
            F.col("h1").alias(side), F.col("n_words").alias(f"{side}_words"), *[F.col(p).alias(f"{side}_{p}") for p in _PARITIES]
        )

    return pairs.join(told("a"), "a").join(told("b"), "b").where(_near("a", "b")).select("a", "b")


def _stored_lines(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The place and digest of every line, and one row per digest with what is compared; all else leaves the disk."""
    spark = docs.sparkSession
    paths = scratch_path(spark, "lines"), scratch_path(spark, "distinct-lines")
    with scratch_scope(spark):
        lines = write_scratch(fingerprints(docs, id_col, text_col), "fingerprints")
        place = F.struct(F.col("id").isNull().alias("none"), "id", "line_no")
        distinct = lines.groupBy("h1", "h2").agg(
            F.min("fp").alias("fp"), F.min("n_words").alias("n_words"), *[F.min(p).alias(p) for p in _PARITIES], F.min(place).alias("first"), F.count(F.lit(1)).alias("n")
        )
        found = lines.select("id", "line_no", "h1", "h2"), distinct
        for df, path in zip(found, paths):
            df.write.parquet(path)
    return tuple(spark.read.schema(df.schema).parquet(path) for df, path in zip(found, paths))


def _stored_links(distinct: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """:func:`line_links`, without the keys and words they were made from."""
    path = scratch_path(docs.sparkSession, "line-links")
    with scratch_scope(docs.sparkSession):
        links = line_links(distinct, docs, id_col, text_col)
        links.write.parquet(path)
    return docs.sparkSession.read.schema(links.schema).parquet(path)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``line_no``, ``keep_id``, ``keep_line_no``, ``group_lines``, ``kept``: one row per line with a word
    that a document has at a place.

    Lines of a group are linked directly or through others; the occurrence with the smallest identifier and then
    line number stays. Lines of fewer than five words are only grouped with equal ones, since one other word is
    below the similarity. Blank lines are not listed and stay.

    Null text counts as empty; an empty table gives no rows; other columns are not read. Rows that repeat an
    identifier, or have none, are one document: the same line at the same place is listed once. Null identifiers
    sort last. Equal lines meet before any are compared, so copies cost one row each.
    Links name lines by 64 bits of their digest, groups of equal lines by all 128.
    """
    with _shuffles_freed(docs.sparkSession):
        lines, distinct = _stored_lines(docs, id_col, text_col)
        links = _stored_links(distinct, docs, id_col, text_col)
        groups = components(links)
        linked = distinct.join(groups.withColumnRenamed("node", "h1"), "h1")
        least = linked.groupBy("root").agg(F.min("first").alias("keep"), F.sum("n").alias("group_lines"))
        equal_only = distinct.where("n > 1").join(groups.select(F.col("node").alias("h1")), "h1", "left_anti")
        classes = linked.join(least, "root").select("h1", "h2", "keep", "group_lines").union(
            equal_only.select("h1", "h2", F.col("first").alias("keep"), F.col("n").alias("group_lines"))
        )
        classes = write_scratch(classes, "line-classes")
    grouped = F.col("keep").isNotNull()
    keep_id = F.when(grouped, F.col("keep.id")).otherwise(F.col("id"))
    keep_line = F.when(grouped, F.col("keep.line_no")).otherwise(F.col("line_no"))
    # Most lines are alone; only groups of two or more meet the lines.
    return lines.join(classes, ["h1", "h2"], "left").select(
        "id",
        "line_no",
        keep_id.alias("keep_id"),
        keep_line.alias("keep_line_no"),
        F.coalesce("group_lines", F.lit(1).cast("long")).alias("group_lines"),
        (F.col("id").eqNullSafe(keep_id) & (F.col("line_no") == keep_line)).alias("kept"),
    )


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the lines taken out that another occurrence stands for; a null text stays null."""
    gone = (
        dedup_lines(docs, id_col, text_col)
        .where("NOT kept")
        .select(F.col("id").alias("gone_id"), "line_no")
        .distinct()
        .groupBy("gone_id")
        .agg(F.collect_list("line_no").alias("gone"))
    )
    rows = docs.select(whole_row(docs).alias("row"), F.col(id_col).alias("id"))
    joined = rows.join(gone, F.col("id").eqNullSafe(F.col("gone_id")), "left")
    kept = F.array_join(
        F.filter(F.split(F.col(f"row.{text_col}"), "\n"), lambda _, i: ~F.array_contains(F.col("gone"), i)), "\n"
    )
    text = F.when(F.col("gone").isNull(), F.col(f"row.{text_col}")).otherwise(kept)
    return unpack(joined.select(F.col("row").withField(text_col, text).alias("row")), "row", docs.columns)
