"""Benchmark decontamination by template canonicalisation, in DataFrame operations only.

Numbers, units after numbers and names become typed placeholders. Names are told in two ways, and a leak in either counts:
capitalised words inside a sentence, and all capitalised words (a name may begin a text, a sentence, a line or a quotation; other
words there become placeholders on both sides alike). Of texts all in capitals only such beginnings are marked, since names can't
be told there. Windows of five template words of documents and items meet in a hash join. An item is leaked into a document that holds at least 0.8 of
the item's distinct windows and whose slot values map consistently onto the item's: a re-parameterised question has other
values, but each value of the item is always replaced by the same one. Where the values of the whole document are mixed (a
template that it holds several times), one occurrence is enough: a stretch that holds 0.8 of the windows, consistent in itself.
slots and slot_consistency are then the occurrence's.

Defined results: null or wordless texts match nothing; an item of fewer words is one window; repeated rows and items give
one row per pair of ids; an empty table gives no rows; a null doc_id or item_id is carried as an id of its own; further
columns are ignored here and stay in ``decontaminate``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.llm.common import KeyFilter, materialize, numbered, text_or_empty, without

WORDS, SIMILARITY, CONSISTENCY = 5, 0.8, 0.5
#: Words that count as units when a number stands before them.
UNITS = "km|cm|mm|m|kg|g|mg|t|lb|oz|l|ml|s|ms|h|min|hours?|minutes?|seconds?|days?|weeks?|months?|years?|metres?|meters?|miles?|dollars?|euros?|percent|degrees?"
#: Item windows up to this number are broadcast (about 64 MB); more are joined by shuffling.
BROADCAST_WINDOWS = 1_000_000


def with_slots(text: Column, starts: bool = False) -> Column:
    """Text whose numbers, units and names are marked 0n, 0u and 0a; their values follow the mark. starts also marks capitalised words at the start of texts, sentences, lines and quotations."""
    numbers = F.regexp_replace(text, r"[0-9]+(?:[.,][0-9]+)*", "0n$0 ")
    units = F.regexp_replace(numbers, rf"(0n[0-9.,]+[ ]+)((?:{UNITS})\b)", "$10u$2")
    marked = F.when(text.rlike("[0-9]"), units).otherwise(text)
    # With starts, a capital that begins a word, except in a run of words in capitals.
    return F.regexp_replace(marked, r"(?<![\p{L}\p{N}])(?!(?<=\p{Lu} )\p{Lu}{2})(\p{Lu})", "0a$1") if starts else F.regexp_replace(marked, r"([\p{Ll}0-9,;][ ])(\p{Lu})", "$10a$2")


def without_values(slotted: Column) -> Column:
    return F.lower(F.regexp_replace(slotted, r"0([anu])[\p{L}0-9.,]*", "0$1 "))


def template_words(slotted: Column) -> Column:
    return F.filter(F.split(without_values(slotted), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def value_words(slotted: Column) -> Column:
    """The words with their values, in the positions of template_words."""
    return F.regexp_extract_all(F.lower(slotted), F.lit(r"(0[anu][\p{L}0-9.,]*|[\p{L}\p{N}]+)"), F.lit(1))


def window_starts(words: Column) -> Column:
    return F.when(F.size(words) > 0, F.sequence(F.lit(1), F.greatest(F.size(words) - (WORDS - 1), F.lit(1)))).otherwise(F.array().cast("array<int>"))


def windows(words: Column) -> Column:
    return F.array_distinct(F.transform(window_starts(words), lambda i: F.xxhash64(F.slice(words, i, WORDS))))


def _windowed(df: DataFrame, starts: bool) -> DataFrame:
    """df with the column windows. The words are a column of their own: inside a lambda they would be made again for each window."""
    return df.withColumn("_words", template_words(with_slots(F.col("text"), starts))).withColumn("windows", windows(F.col("_words"))).drop("_words")


def _slot_windows(df: DataFrame, starts: bool, *ids: str) -> DataFrame:
    """(ids, at, window, values): the windows by position and their slots' values in order.

    explode_outer, here and below: for explode the optimizer would add a filter on the array's size, push it below the
    column of words and so make the words anew for each window.
    """
    rows = df.select(*ids, with_slots(text_or_empty(), starts).alias("slotted"))
    rows = rows.select(*ids, F.arrays_zip(template_words(F.col("slotted")).alias("t"), value_words(F.col("slotted")).alias("v")).alias("tv"))
    # tv is used more than once below, so it stays a column and is not made again for each window.
    rows = rows.select(*ids, F.posexplode_outer(F.transform(window_starts(F.col("tv")), lambda i: F.slice("tv", i, WORDS))).alias("at", "w"))
    return rows.select(*ids, "at", F.xxhash64(F.transform("w", lambda x: x["t"])).alias("window"), F.transform(F.filter("w", lambda x: x["v"].rlike("^0[anu]")), lambda x: x["v"]).alias("values"))


def _consistency(slots: DataFrame, *keys: str) -> DataFrame:
    """(keys, slots, slot_consistency) of slots (keys, n, s): the share of slots whose value is the one that most often replaces the item's."""
    mapped = slots.groupBy(*keys, F.col("s.item_values").alias("was"), F.col("s.values").alias("now")).agg(F.sum("n").alias("n"))
    return mapped.groupBy(*keys, "was").agg(F.max("n").alias("top"), F.sum("n").alias("n")).groupBy(*keys).agg(F.sum("n").alias("slots"), (F.sum("top") / F.sum("n")).alias("slot_consistency"))


def _occurrences(pairs: DataFrame, ours: DataFrame, theirs: DataFrame, similarity: float, consistency: float) -> DataFrame:
    """(doc_key, item_key, slots, slot_consistency) of the most consistent occurrence of each pair that has one.

    Matched windows of one occurrence have one offset between document and item, or, around inserted and lost words, nearly
    one. So they meet by offset, and by two divisions of the offsets in stretches of about half an item: offsets within a
    quarter of an item share a stretch of one of them.
    """
    quarter = F.greatest(F.ceil(F.col("item_windows") / 4), F.lit(1))
    met = pairs.join(ours, "item_key").join(theirs, ["doc_key", "window"]).withColumn("offset", (F.col("at") - F.col("item_at")).cast("long"))
    stretch = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.cast("long").alias("value"))
    stretches = F.array(stretch(0, F.col("offset")), *(stretch(k + 1, F.floor((F.col("offset") + k * quarter) / (2 * quarter))) for k in range(2)))
    met = met.withColumn("stretch", F.explode(stretches))
    keys = ["doc_key", "item_key", "stretch"]
    whole = met.groupBy(*keys, "item_windows").agg(F.count_distinct("window").alias("held")).filter(F.col("held") / F.col("item_windows") >= similarity)
    slots = met.select(*keys, F.lit(1).alias("n"), F.explode(F.arrays_zip("item_values", "values")).alias("s"))
    found = whole.join(_consistency(slots, *keys), keys).filter(F.col("slot_consistency") >= consistency)
    best = found.groupBy("doc_key", "item_key").agg(F.max(F.struct("slot_consistency", "slots")).alias("best"))
    return best.select("doc_key", "item_key", "best.slots", "best.slot_consistency")


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, consistency: float = CONSISTENCY) -> DataFrame:
    """(doc_id, item_id, item_windows, matched, containment, slots, slot_consistency) for each leaked item of each document.

    Figures are those of the names inside sentences where these show the leak, and of all capitalised words elsewhere.
    """
    inside = materialize(_leaks(docs, benchmark, similarity, consistency, False), "leaks")
    starts = _leaks(docs, benchmark, similarity, consistency, True)
    known = inside.select(F.col("doc_id").alias("_doc"), F.col("item_id").alias("_item"))
    return inside.union(starts.join(known, F.col("doc_id").eqNullSafe(F.col("_doc")) & F.col("item_id").eqNullSafe(F.col("_item")), "left_anti"))


def _leaks(docs: DataFrame, benchmark: DataFrame, similarity: float, consistency: float, starts: bool) -> DataFrame:
    """leaks() by one way to tell names."""
    items = benchmark.select("item_id", text_or_empty().alias("text")).distinct()
    items = _windowed(items.select("item_id", F.xxhash64("text").alias("item_key"), "text"), starts)
    wanted = materialize(items.select("item_id", "item_key", F.size("windows").alias("item_windows"), F.explode_outer("windows").alias("window")), "item-windows")
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    found = _windowed(rows.select("doc_id", F.xxhash64("text").alias("doc_key"), F.monotonically_increasing_id().alias("row"), "text"), starts)
    found = found.select("doc_id", "doc_key", "row", F.explode_outer("windows").alias("window"))
    small = wanted.count() <= BROADCAST_WINDOWS
    # Beyond that size the filter keeps windows of no item from being shuffled.
    matched = found.join(F.broadcast(wanted), "window") if small else KeyFilter(wanted, F.col("window")).maybe_in(found, F.col("window")).join(wanted, "window")
    # windows() gives each of a document's windows once, so a count is enough; equal rows count apart by row.
    pairs = matched.groupBy("doc_id", "doc_key", "item_id", "item_key", "item_windows", "row").agg(F.count(F.lit(1)).alias("matched"))
    pairs = pairs.withColumn("containment", F.col("matched") / F.col("item_windows")).filter(F.col("containment") >= similarity)
    pairs = materialize(pairs.select("doc_id", "doc_key", "item_id", "item_key", "item_windows", "matched", "containment"), "leak-pairs")
    hits = KeyFilter(pairs, F.col("doc_key")).maybe_in(rows.withColumn("doc_key", F.xxhash64("text")), F.col("doc_key")).dropDuplicates(["doc_key"])
    placed = _slot_windows(items.select("item_key", "text").dropDuplicates(["item_key"]), starts, "item_key").withColumnsRenamed({"values": "item_values", "at": "item_at"})
    theirs = _slot_windows(hits, starts, "doc_key").filter(F.size("values") > 0).groupBy("doc_key", "window", "values").agg(F.count(F.lit(1)).alias("n"))
    ours = placed.filter(F.size("item_values") > 0).drop("item_at").distinct()
    candidates = pairs.select("doc_key", "item_key").distinct().join(ours, "item_key")
    slots = candidates.join(theirs, ["doc_key", "window"]).select("doc_key", "item_key", "n", F.explode(F.arrays_zip("item_values", "values")).alias("s"))
    out = pairs.join(_consistency(slots, "doc_key", "item_key"), ["doc_key", "item_key"], "left")
    out = materialize(out.withColumns({"slots": F.coalesce("slots", F.lit(0)), "slot_consistency": F.coalesce("slot_consistency", F.lit(1.0))}), "leak-slots")
    mixed = out.filter(F.col("slot_consistency") < consistency).drop("slots", "slot_consistency")
    out = out.filter(F.col("slot_consistency") >= consistency)
    if not mixed.isEmpty():
        again = KeyFilter(mixed, F.col("doc_key")).maybe_in(hits, F.col("doc_key"))
        single = _occurrences(mixed.select("doc_key", "item_key", "item_windows").distinct(), placed, _slot_windows(again, starts, "doc_key"), similarity, consistency)
        out = out.unionByName(mixed.join(single, ["doc_key", "item_key"]))
    return out.groupBy("doc_id", "item_id").agg(*(F.max(c).alias(c) for c in ("item_windows", "matched", "containment", "slots", "slot_consistency")))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs with no leaked item, with all their columns. Rows are told apart by their place, so ids may be null or repeat."""
    rows, row = numbered(docs)
    gone = materialize(leaks(rows.select(F.col(row).alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias(row)).distinct(), "leaked")
    return without(rows, gone, row).select(*docs.columns)
