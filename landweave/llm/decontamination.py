"""Benchmark decontamination by template windows. DataFrame functions only.

Texts become templates: numbers, names and units are replaced by typed placeholders, the rest is lower-cased words. Windows of templates are
joined by hash with those of the benchmark; windows that follow one another in both make runs. In a run the fillers of placeholders must fit:
each value of the item stands for one value of the document throughout, and the other way round, so a question with other numbers or names is
found and a text that only looks alike is not. Windows of the plain lower-cased words are joined the same way, so an exact copy is found
whatever its capitals and layout, which names depend on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import fresh, text_key, written

WINDOW, RUN = 8, 6
BROADCAST_ROWS = 1 << 20

# Units of measure, times and money.
UNITS = "km|kg|cm|mm|mg|ml|m|g|l|lb|oz|ft|mph|kmh|miles?|metres?|meters?|inch(?:es)?|feet|pounds?|dollars?|cents?|euros?|usd|eur|hours?|hrs?|minutes?|mins?|seconds?|days?|weeks?|months?|years?|percent|%"

NUMBER = r"(?<![\p{L}\p{N}])\d+(?:[.,:/]\d+)*"
NAME = r"(?<=[^.!?:;\s] [\p{Ps}\p{Pi}\"']?)\p{Lu}\p{Ll}++(?![\p{L}\p{N}])"
UNIT = rf"(?<=\d ?)\x01?({UNITS})(?![\p{{L}}\p{{N}}])"
#: What stands before a name and before a unit in a token; a number begins with a digit.
NAMED, UNITED = "\x01", "\x03"
#: White space and control characters, but for single spaces.
LAYOUT = r"[\p{Z}\p{Cc}]{2,}|[\p{Z}\p{Cc}&&[^ ]]"
TOKEN = rf"{NUMBER}|[\x01\x03]?[\p{{L}}\p{{N}}]+|\x03%"


def tokens(text: Column) -> Column:
    """Lower-cased words, numbers, names and units, each with what it stands for: template words and fillers come from one array and can't shift."""
    marked = F.regexp_replace(F.regexp_replace(text, LAYOUT, " "), NAME, NAMED + "$0")
    marked = F.regexp_replace(F.lower(marked), UNIT, UNITED + "$1")
    return F.regexp_extract_all(marked, F.lit(TOKEN), F.lit(0))


def holds_place(token: Column) -> Column:
    """Whether a token is a filler of a placeholder."""
    return F.substring(token, 1, 1).isin(NAMED, UNITED, *"0123456789")


def template(token: Column) -> Column:
    """The template word of a token."""
    first = F.substring(token, 1, 1)
    return F.when(first == NAMED, "<name>").when(first == UNITED, "<unit>").when(first.isin(*"0123456789"), "<num>").otherwise(token)


def hashed(text: Column) -> Column:
    """The tokens of a text as hashes: (t, p) of the template word and of the plain word of each."""
    return F.transform(tokens(text), lambda x: F.struct(F.xxhash64(template(x)).alias("t"), F.xxhash64(F.translate(x, NAMED + UNITED, "")).alias("p")))


def windows(words: Column, size: int, step: int = 1) -> Column:
    """(t, p) of the windows at every ``step``-th place: a hash of the template words and one of the plain words. Fewer words are one window."""
    places = F.when(F.size(words) >= size, F.sequence(F.lit(0), F.size(words) - size, F.lit(step))).otherwise(F.array().cast("array<int>"))
    # Words are taken one by one: a slice would copy the whole array for each window.
    full = F.transform(places, lambda i: F.struct(*(F.xxhash64(*(F.get(words, i + k)[x] for k in range(size))).alias(x) for x in "tp")))
    short = F.array(F.struct(*(F.xxhash64(F.transform(words, lambda y: y[x])).alias(x) for x in "tp")))  # noqa: B023
    return F.when((F.size(words) > 0) & (F.size(words) < size), short).otherwise(full)


def kinds(window: Column) -> Column:
    """A window's hashes as (plain, w); windows without placeholders have the same twice."""
    return F.array(F.struct(F.lit(False).alias("plain"), window["t"].alias("w")), F.struct(F.lit(True).alias("plain"), window["p"].alias("w")))


def consistent(pairs: Column) -> Column:
    """Whether pairs (item's filler, document's filler) are one to one."""
    n = F.size(F.array_distinct(pairs))
    return (F.size(F.array_distinct(F.transform(pairs, lambda p: p["b"]))) == n) & (F.size(F.array_distinct(F.transform(pairs, lambda p: p["d"]))) == n)


def contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, run: int = RUN) -> DataFrame:
    """(doc_id, h, items): documents (h: hash of the text) that hold a run of ``run`` windows of an item (all its windows, if it has fewer; of short items the whole text)."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("h"), "text").filter("text IS NOT NULL")
    bench = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("item")).filter("item IS NOT NULL").distinct()
    bench = bench.withColumn("b", F.xxhash64("item")).withColumn("tokens", tokens(F.col("item")))
    pieces = bench.select("item_id", "b", hashed(F.col("item")).alias("words")).select("item_id", "b", F.size("words").alias("n"), F.posexplode(windows(F.col("words"), size)).alias("at", "x"))
    pieces = pieces.select("item_id", "b", (F.col("n") - size + 1).alias("n"), "at", F.inline(kinds(F.col("x"))))
    # An item of fewer words is found as a whole text in plain words: a few placeholders are no evidence.
    pieces = pieces.filter("n > 0 OR plain").withColumn("n", F.greatest("n", F.lit(1)))
    pieces = written(pieces, "benchmark-windows")
    hashes = pieces.select("w").distinct()
    # Broadcast only behind a check of the size (8 bytes a row); larger benchmarks are shuffled.
    hashes = F.broadcast(hashes) if hashes.count() <= BROADCAST_ROWS else hashes
    # Runs of so many windows have one at a multiple of it, so texts without a hit there hold none.
    step = min(run, pieces.join(bench.filter(F.size("tokens") >= size), ["item_id", "b"], "left_semi").agg(F.min("n")).first()[0] or run)
    # Hashes of the words are a column of their own, or each window would work them out again.
    worded = keyed.select("doc_id", "h", hashed(F.col("text")).alias("words"))
    probes = worded.select("doc_id", "h", F.explode(windows(F.col("words"), size, step)).alias("x")).select("doc_id", "h", F.explode(F.array_distinct(F.array("x.t", "x.p"))).alias("w"))
    likely = written(probes.join(hashes, "w", "left_semi").select(F.col("doc_id").alias("d"), F.col("h").alias("g")).distinct(), "likely-texts")
    likely = keyed.join(likely, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g")), "left_semi")
    found = likely.select("doc_id", "h", hashed(F.col("text")).alias("words")).select("doc_id", "h", F.posexplode(windows(F.col("words"), size)).alias("place", "x"))
    hits = written(found.select("doc_id", "h", "place", F.inline(kinds(F.col("x")))).join(hashes, "w", "left_semi"), "window-hits")
    met = hits.join(pieces, ["w", "plain"]).select("doc_id", "h", "item_id", "b", "n", "plain", "at", "place").distinct()
    line = ["doc_id", "h", "item_id", "b", "n", "plain", (F.col("place") - F.col("at")).alias("shift")]
    # A run is counted by its first window: the ones that follow it in both texts have equal ``at`` less their rank.
    ranked = met.select(*line, "at").withColumn("run", F.col("at") - F.row_number().over(Window.partitionBy("doc_id", "h", "item_id", "b", "plain", "shift").orderBy("at")))
    runs = ranked.groupBy("doc_id", "h", "item_id", "b", "n", "plain", "shift", "run").agg(F.min("at").alias("at"), F.count("*").cast("int").alias("long"))
    runs = written(runs.filter(F.col("long") >= F.least(F.lit(run), F.col("n"))), "runs")
    # Runs of an item and a text stay together as places; words are sliced for one run at a time.
    spots = F.collect_list(F.struct("at", (F.col("at") + F.col("shift")).alias("place"), (F.col("long") + size - 1).alias("span"))).alias("spots")
    runs = runs.groupBy("doc_id", "h", "item_id", "b", "plain").agg(spots).join(bench.select("item_id", "b", "tokens"), ["item_id", "b"])
    marked = F.exists("spots", lambda s: F.exists(F.slice("tokens", s["at"] + 1, s["span"]), holds_place))
    unmarked = F.exists("spots", lambda s: ~F.exists(F.slice("tokens", s["at"] + 1, s["span"]), holds_place))
    runs = written(runs.withColumn("clear", F.col("plain") | unmarked).withColumn("marked", ~F.col("plain") & marked), "filled-runs")
    plain = runs.filter("clear").select("doc_id", "h", "item_id")
    asked = runs.filter("marked AND NOT clear")
    if not asked.isEmpty():
        asked = asked.select(F.col("doc_id").alias("d"), F.col("h").alias("g"), "item_id", "tokens", "spots")
        same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g"))
        texts = keyed.join(asked.select("d", "g").distinct(), same, "left_semi").dropDuplicates(["doc_id", "h"]).select("doc_id", "h", tokens(F.col("text")).alias("mine"))
        texts = texts.join(asked, same)

        def fits(spot: Column) -> Column:
            both = F.zip_with(F.slice("tokens", spot["at"] + 1, spot["span"]), F.slice("mine", spot["place"] + 1, spot["span"]), lambda b, d: F.struct(b.alias("b"), d.alias("d")))
            return consistent(F.filter(both, lambda p: holds_place(p["b"])))

        plain = plain.unionByName(texts.filter(F.exists("spots", fits)).select("doc_id", "h", "item_id"))
    return plain.groupBy("doc_id", "h").agg(F.sort_array(F.collect_set("item_id")).alias("items"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, run: int = RUN) -> DataFrame:
    """The rows and columns of ``docs`` that hold no benchmark item.

    Null and empty texts are clean, as are all where the benchmark is empty. An item of fewer than ``size`` words is held by texts that are
    that item as a whole, whatever their capitals and layout. Repeated rows stay or go together. Null doc_ids are matched as such. Columns
    may have any names.
    """
    d, g, k, h = (fresh(docs, x) for x in ("bad_id", "bad_hash", "own_id", "own_hash"))
    bad = contaminated(docs, benchmark, size, run).select(F.col("doc_id").alias(d), F.col("h").alias(g))
    keyed = docs.withColumn(k, F.col("doc_id").cast("long")).withColumn(h, text_key())
    return keyed.join(bad, F.col(k).eqNullSafe(F.col(d)) & (F.col(h) == F.col(g)), "left_anti").drop(k, h)


def report(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, run: int = RUN) -> DataFrame:
    """Per row: doc_id, ``contaminated`` and ``items``, the benchmark items found (else empty)."""
    bad = contaminated(docs, benchmark, size, run).select(F.col("doc_id").alias("d"), F.col("h").alias("g"), "items")
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("h"))
    return keyed.join(bad, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g")), "left").select(
        "doc_id", F.col("items").isNotNull().alias("contaminated"), F.coalesce("items", F.array().cast("array<bigint>")).alias("items")
    )
