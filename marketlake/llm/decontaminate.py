"""Benchmark decontamination: short test items inside long documents.

A document leaks an item if it holds at least `threshold` of the item's distinct five-word shingles
(words: runs of letters and digits, lower case). The search is asymmetric, since a sketch
of a long document would not keep the few shingles of a short item: items are partitioned by size into
powers of two, and of every item the smallest shingle hashes make its sketch, so many that by
the size limit of its partition no document can hold `threshold` of the item without one of them.
Every shingle of every document probes the sketches, as bands of one row; a
document of fewer shingles than the item's share is no candidate. Candidates are verified on
the shingles' words. The search therefore misses nothing.

Shingles that many items share come last in the sketches, so a phrase that all items begin with
does not make every document a candidate. An item of fewer words than a shingle is one run of all its
words, and a document leaks it that holds the run. Items without words, null and empty texts match nothing. Rows of one doc_id are one document each, of which the fullest match is
reported; null ids are an id like any other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlake.llm.rows import row_key, unused
from marketlake.llm.stored import stored

WIDTH = 5
THRESHOLD = 0.8
#: Up to so many rows (of some 16 to 100 bytes) a counted side is broadcast, else both sides are shuffled.
BROADCAST_ROWS = 500_000


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _runs(column: str, width: int, of) -> Column:
    """`of` the words of every run of `width` words; no run where there are fewer."""
    starts = F.sequence(F.lit(0), F.size(column) - width)
    made = F.transform(starts, lambda i: of(*[F.get(F.col(column), i + j) for j in range(width)]))
    return F.when(F.size(column) >= width, made)


def _shingles(width: Column, widths) -> Column:
    """The distinct shingles of `__words`, of a width among `widths`."""
    made = [F.when(width == w, F.array_distinct(_runs("__words", w, lambda *words: F.concat_ws(" ", *words)))) for w in widths]
    return F.coalesce(*made, F.array().cast("array<string>"))


def _bounded(frame: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(frame) if rows <= BROADCAST_ROWS else frame


def _items(benchmark: DataFrame, width: int) -> DataFrame:
    """(item, item_id, width, shingles): distinct items by id and text that have words, and the words of a shingle of theirs."""
    size = F.size("__words")
    return (
        benchmark.select("item_id", F.col("text").alias("__text"))
        .distinct()
        .select(F.xxhash64("item_id", "__text").alias("item"), "item_id", words(F.col("__text")).alias("__words"))
        .where(size > 0)
        .select("item", "item_id", F.least(size, F.lit(width)).alias("width"), _shingles(F.least(size, F.lit(width)), range(1, width + 1)).alias("shingles"))
    )


def _sketches(items: DataFrame, threshold: float) -> DataFrame:
    """(item, least, hash): the hashes that may show an item, and the least shingles of a document that holds it."""
    size = F.size("shingles")
    upper = F.pow(F.lit(2.0), F.floor(F.log2(size)) + 1) - 1
    spread = items.select(
        "item",
        F.ceil(size * threshold - 1e-9).alias("least"),
        (F.floor(upper * (1 - threshold) + 1e-9) + 1).alias("length"),
        F.explode("shingles").alias("shingle"),
    )
    # nulls leave a hash as it is, so shorter shingles hash as their words alone
    hashed = spread.withColumn("hash", F.xxhash64(*[F.get(F.split("shingle", " "), F.lit(j)) for j in range(WIDTH)]))
    common = hashed.groupBy("hash").agg(F.count(F.lit(1)).alias("items"))
    order = Window.partitionBy("item").orderBy("items", "hash")
    return (
        hashed.join(common, "hash")
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= F.col("length"))
        .select("item", "least", "hash")
    )


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, shared, n_item, containment) of every leak."""
    items = stored(_items(benchmark, WIDTH), "decontaminate_items")
    sketches = stored(_sketches(items, threshold), "decontaminate_sketches")
    n_items, n_sketches = items.count(), sketches.count()
    widths = [r["width"] for r in items.select("width").distinct().orderBy("width").collect()] or [WIDTH]
    texts = docs.select("doc_id", F.col("text").alias("__text"))
    worded = texts.select("doc_id", words(F.col("__text")).alias("__words"))
    probes = reduce(
        DataFrame.unionAll,
        [
            worded.where(F.size("__words") >= w)
            .select("doc_id", (F.size("__words") - w + 1).alias("n"), F.explode(_runs("__words", w, F.xxhash64)).alias("hash"))
            for w in widths
        ],
    )
    found = (
        probes.join(_bounded(sketches, n_sketches), "hash")
        .where(F.col("n") >= F.col("least"))
        .groupBy("doc_id", "item")
        .agg(F.count(F.lit(1)).alias("hits"))
        .select(F.col("doc_id").alias("__doc"), "item")
    )
    candidates = stored(found, "decontaminate_candidates")
    n_candidates = candidates.count()
    pairs = texts.join(_bounded(candidates, n_candidates), F.col("doc_id").eqNullSafe(F.col("__doc")))
    return (
        pairs.select("doc_id", "item", words(F.col("__text")).alias("__words"))
        .join(_bounded(items, n_items), "item")
        .select("doc_id", "item_id", "shingles", _shingles(F.col("width"), widths).alias("held"))
        .select("doc_id", "item_id", F.size(F.array_intersect("held", "shingles")).cast("long").alias("shared"), F.size("shingles").cast("long").alias("n_item"))
        .where(F.col("shared") >= F.ceil(F.col("n_item") * threshold - 1e-9))
        .groupBy("doc_id", "item_id")
        .agg(F.max(F.struct((F.col("shared") / F.col("n_item")).alias("containment"), "shared", "n_item")).alias("m"))
        .select("doc_id", "item_id", "m.shared", "m.n_item", "m.containment")
    )


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that leak no item, with all their columns; rows are decided by id and text."""
    key = unused(docs.columns, "row_key")
    keyed = docs.withColumn(key, row_key("doc_id", "text"))
    found = leaks(keyed.select(F.col(key).alias("doc_id"), "text"), benchmark, threshold)
    bad = stored(found.select(F.col("doc_id").alias(key + "_")).distinct(), "decontaminate_leaks")
    return keyed.join(_bounded(bad, bad.count()), F.col(key) == F.col(key + "_"), "left_anti").select(*docs.columns)
