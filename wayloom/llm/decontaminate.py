"""Benchmark passages in documents, also re-parameterised ones, with DataFrame functions alone.

Texts become templates: names (capitalised words inside a sentence), numbers and units after numbers
turn into typed placeholders, everything else is lower-cased. Windows of WINDOW template tokens of
documents and items are hash-joined. Slot consistency then tells a re-parameterised question from a
chance: along one alignment of document and item, each value of the item must always have been
replaced by the same value.

Windows that are nearly all placeholders (titles, tables, sums) would meet by chance; they are joined by
their values. Items shorter than a window are looked for as windows of their own length.

The hash of a window is built by doubling (1, 2, 4, 8 tokens), so its cost does not grow with the
window. The windows of the benchmark are broadcast if they have at most BROADCAST_WINDOWS rows. A larger
benchmark is joined by shuffling: a Bloom filter of its windows drops nearly all windows of documents before, the
others carry their own tokens alone, never the text, and windows that many documents share are dealt out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayloom.llm.common import scratch, stored, text_of
from wayloom.operators.bloom import bits_for, bloom_filter, may_be_in
from wayloom.operators.skew import salted_join

#: Tokens of a window, a power of two.
WINDOW = 8
#: Windows with fewer tokens that are no placeholders are compared with their values.
LEAST_LITERAL = 4
#: Share of an item's windows that must be found in a document.
LEAST_COVERAGE = 0.25
#: So many windows of one alignment are enough whatever the item's length: 50 tokens in a row have as many.
LONG_RUN = 50 - WINDOW + 1
#: About 40 MB.
BROADCAST_WINDOWS = 200_000
_NAME, _NUMBER, _UNIT, _PLAIN = "\x01", "\x02", "\x03", "\x04"
#: Units that are replaced when they follow a number.
UNITS = (
    "kg g mg t lb lbs oz km m cm mm mi ft in l ml s ms min h hour hours minute minutes second seconds day days week weeks "
    "month months year years meter meters metre metres mile miles kilometer kilometers kilometre kilometres gram grams "
    "kilogram kilograms liter liters litre litres degree degrees percent dollar dollars euro euros cent cents"
).split()


def template_tokens(text: Column) -> Column:
    """Lower-cased words; names, numbers and units begin with a mark of their type and keep their value."""
    clean = F.regexp_replace(text, "[\x01-\x04]", " ")
    names = F.regexp_replace(clean, r"([\p{L}\p{N},;] )(\p{Lu})", f"$1{_NAME}$2")
    numbers = F.regexp_replace(F.lower(names), r"[0-9]+(?:[.,][0-9]+)*", f" {_NUMBER}$0 ")
    units = rf"({_NUMBER}[0-9.,]+ +)({'|'.join(UNITS)})(?![\p{{L}}\p{{N}}])"
    marked = F.regexp_replace(numbers, units, f"$1{_UNIT}$2")
    tokens = F.split(marked, rf"(?:[^\p{{L}}\p{{N}}.,{_NAME}{_NUMBER}{_UNIT}]|[.,](?![0-9]))+")
    return F.array_remove(tokens, "")


def _doubled(rows: DataFrame, name: str, combine: Callable[[Column, Column], Column]) -> DataFrame:
    """`rows` with {name}1, one value for each token, gets {name}2, {name}4, ...: combined over so many tokens from each place on."""
    size = 1
    while size < WINDOW:
        there = F.slice(f"{name}{size}", F.lit(size + 1), F.size("_tokens"))
        rows = rows.withColumn(f"{name}{2 * size}", F.zip_with(f"{name}{size}", there, combine))
        size *= 2
    return rows


def _of_length(name: str, length: int, combine: Callable[[Column, Column], Column]) -> Column:
    """What `_doubled` made, put together for windows of `length` tokens."""
    whole, at = None, 0
    for size in (1 << i for i in reversed(range(WINDOW.bit_length()))):
        if length & size:
            part = F.slice(f"{name}{size}", F.lit(at + 1), F.size("_tokens"))
            whole = part if whole is None else F.zip_with(whole, part, combine)
            at += size
    return F.slice(whole, F.lit(1), _count(F.lit(length)))


def _count(length: Column) -> Column:
    """Windows of `length` tokens in _tokens."""
    return F.greatest(F.size("_tokens") - length + 1, F.lit(0))


def _windows(rows: DataFrame, lengths: list[int]) -> DataFrame:
    """`rows` with _tokens gets _windows: a hash for each window of each of the lengths, one length after the other.

    It is the template's hash if the template has enough literal tokens; otherwise the values count as well.
    """
    plain = lambda t: F.when(t < _PLAIN, F.substring(t, 1, 1)).otherwise(t)
    mixed, added = lambda a, b: F.xxhash64(a, b), lambda a, b: a + b
    rows = rows.withColumn("_h1", F.transform("_tokens", lambda t: F.xxhash64(plain(t))))
    literal = F.transform("_tokens", lambda t: (t >= _PLAIN).cast("int"))
    rows = rows.withColumn("_literal", literal)
    # Null where there are too few placeholders for a window with few literal tokens.
    most = min(length - _least_literal(length) for length in lengths)
    rows = rows.withColumn("_l1", F.when(F.size(F.array_remove("_literal", 1)) > most, F.col("_literal")))
    rows = _doubled(_doubled(rows, "_h", mixed), "_l", added)

    def hashes(length: int) -> Column:
        whole = _of_length("_h", length, mixed)
        each = F.arrays_zip(whole.alias("w"), _of_length("_l", length, added).alias("l"))
        valued = lambda i: F.xxhash64(F.slice("_tokens", i + 1, F.lit(length)))
        told = F.transform(each, lambda p, i: F.when(p["l"] >= _least_literal(length), p["w"]).otherwise(valued(i)))
        return F.when(F.col("_l1").isNull(), whole).otherwise(told)

    made = [f"_{name}{1 << i}" for name in "hl" for i in range(WINDOW.bit_length())]
    return rows.withColumn("_windows", F.concat(*map(hashes, lengths))).drop("_literal", *made)


def _least_literal(length: int) -> int:
    return min(LEAST_LITERAL, length)


def _place(position: str, lengths: list[int]) -> Column:
    """Where the window at a position of _windows begins, by its `length`; lengths descend."""
    before = [F.when(F.col("length") < at, _count(F.lit(at))).otherwise(0) for at in lengths]
    return F.col(position) - sum(before, F.lit(0))


def _own_tokens(position: str, lengths: list[int]) -> Column:
    """Where the window at a position of _windows begins, and its tokens; lengths descend."""
    found, before = F.lit(None), F.lit(0)
    for length in lengths:
        at, before = F.col(position) - before, before + _count(F.lit(length))
        window = F.struct(at.alias("at"), F.slice("_tokens", at + 1, F.lit(length)).alias("tokens"))
        found = F.coalesce(found, F.when(F.col(position) < before, window))
    return found


def _shuffled(each: DataFrame, windows: DataFrame, lengths: list[int], count: int, base: str) -> DataFrame:
    """The windows of documents that are windows of items as well, each with `_window`, its place and tokens."""
    bits = bits_for(count)
    maybe = each.where(may_be_in(bloom_filter(windows, ["w"], bits), [F.col("w")], bits))
    maybe = stored(maybe.select("doc_id", "text_hash", "w", _own_tokens("_position", lengths).alias("_window")), f"{base}/maybe")
    return salted_join(maybe, windows, ["w"], "inner", [F.col("text_hash"), F.col("_window.at")])


def _benchmark_windows(benchmark: DataFrame) -> tuple[DataFrame, list[int]]:
    """Windows of the items, and their lengths in tokens; items of fewer than WINDOW tokens are one window.

    Columns: w, item_id, length, item_at, item_windows, item_tokens (the window's), literal (it has enough
    literal tokens) and literal_windows (so many of the item's have).
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), template_tokens(text_of()).alias("_tokens"))
    items = items.where(F.col("item_id").isNotNull() & (F.size("_tokens") > 0)).distinct()
    items = items.withColumn("length", F.least(F.size("_tokens"), F.lit(WINDOW)))
    lengths = sorted((r["length"] for r in items.select("length").distinct().collect()), reverse=True) or [WINDOW]
    count = _count(F.col("length"))
    each = _windows(items, lengths).select(
        "item_id", "_tokens", "length", count.alias("item_windows"), F.posexplode_outer("_windows").alias("_position", "w")
    )
    each = each.withColumn("item_at", _place("_position", lengths)).where(F.col("item_at").between(0, F.col("item_windows") - 1))
    window = F.slice("_tokens", F.col("item_at") + 1, F.col("length"))
    each = each.select("w", "item_id", "_tokens", "length", "item_at", "item_windows", window.alias("item_tokens"))
    enough = F.size(F.filter("item_tokens", lambda t: t >= _PLAIN)) >= F.least(F.lit(LEAST_LITERAL), F.col("length"))
    each = each.withColumn("literal", enough)
    # An item id may have several texts.
    total = F.sum(F.col("literal").cast("int")).over(Window.partitionBy("item_id", "_tokens"))
    return each.withColumn("literal_windows", total).drop("_tokens"), lengths


def find_contaminated(docs: DataFrame, benchmark: DataFrame, least_coverage: float = LEAST_COVERAGE) -> DataFrame:
    """doc_id, text_hash, item_id, windows (found), item_windows, coverage and reparameterised, by document and item.

    One row for each document and item of which `least_coverage` of the windows occur in the document with
    consistent slots; windows with few literal tokens occur where the values are the same too. Since those
    can't occur in a re-parameterised copy, `least_coverage` of the other windows is enough as well,
    and so are LONG_RUN windows of one alignment, since a passage may be a small share of a long item. coverage
    is windows / item_windows. An item of fewer than WINDOW tokens is one window, looked for at every place, so a
    one-word item is found in every document with that word. Documents are told apart by doc_id and text, so
    repeated rows are reported once; a null id stays null. Null or empty texts and items contain nothing. Items
    with a null id are left out. Other columns are not looked at.
    """
    windows, lengths = _benchmark_windows(benchmark)
    base = scratch(docs.sparkSession)
    windows = stored(windows, f"{base}/windows")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text_of()).alias("text_hash"),
        template_tokens(text_of()).alias("_tokens"),
    )
    # The outer form: for the inner one Spark pushes a filter on the size of _windows down to the scan, and
    # with it copies of all that _windows is made of.
    each = _windows(rows, lengths).select("doc_id", "text_hash", "_tokens", F.posexplode_outer("_windows").alias("_position", "w"))
    if (count := windows.count()) <= BROADCAST_WINDOWS:
        met = each.join(F.broadcast(windows), "w").withColumn("_at", _place("_position", lengths))
        own = F.slice("_tokens", F.col("_at") + 1, F.col("length"))
    else:
        met = _shuffled(each, windows, lengths, count, base).withColumn("_at", F.col("_window.at"))
        own = F.col("_window.tokens")
    # Values of the slots: of the item, and of the document at the same place.
    values = F.arrays_zip(F.col("item_tokens").alias("i"), own.alias("d"))
    met = met.select(
        "doc_id",
        "text_hash",
        "item_id",
        "item_at",
        "item_windows",
        "literal",
        "literal_windows",
        (F.col("_at") - F.col("item_at")).alias("_shift"),
        # Windows found by their values say nothing of what other places replace.
        F.filter(values, lambda p: F.col("literal") & (p["i"] < _PLAIN)).alias("_slots"),
    )
    slots = F.array_distinct(F.flatten(F.collect_set("_slots")))
    item = ["doc_id", "text_hash", "item_id", "item_windows", "literal_windows"]
    aligned = met.groupBy(*item, "_shift").agg(
        F.collect_set("item_at").alias("_found"),
        F.collect_set(F.when(F.col("literal"), F.col("item_at"))).alias("_literal"),
        slots.alias("_slots"),
    )
    consistent = F.size("_slots") == F.size(F.array_distinct(F.transform("_slots", lambda p: p["i"])))
    changed = F.exists("_slots", lambda p: p["i"] != p["d"])
    places = lambda c: F.size(F.array_distinct(F.flatten(F.collect_list(c)))).cast("long")
    per_item = aligned.where(consistent).groupBy(*item).agg(
        places("_found").alias("windows"), places("_literal").alias("_literal"), F.max(changed).alias("reparameterised"),
        F.max(F.size("_found")).alias("_longest"),
    )
    coverage = F.col("windows") / F.col("item_windows")
    literal = (F.col("_literal") > 0) & (F.col("_literal") >= least_coverage * F.col("literal_windows"))
    long = F.col("_longest") >= LONG_RUN
    return per_item.where((coverage >= least_coverage) | literal | long).select(
        "doc_id", "text_hash", "item_id", "windows", "item_windows", coverage.alias("coverage"), "reparameterised"
    )
