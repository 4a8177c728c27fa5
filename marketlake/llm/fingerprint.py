"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A fingerprint holds the `k` smallest distinct 48-bit hashes of a text's shingles, ascending,
six bytes each, in base64. Fingerprints of parts merge into the fingerprint of the whole;
two of them estimate resemblance and containment, one the number of distinct shingles. A text
without words has the empty fingerprint. Null texts count as empty; a text of fewer than `width`
words has one shingle, the whole sequence.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlake.llm.shipping import ship
from marketlake.llm.words import filled, shingle_sets

K = 128
WIDTH = 5
_SHIFT = np.uint64(16)
_SPACE = float(1 << 48)
_FIRST_KEY = -(1 << 63)


def sketches(column: pa.Array, k: int = K, width: int = WIDTH) -> list[np.ndarray]:
    """The smallest `k` distinct hashes of each row."""
    return [np.unique(shingles >> _SHIFT)[:k] for shingles in shingle_sets(filled(column), width)]


def pack(sketch: np.ndarray) -> str:
    wide = sketch.astype(">u8").view(np.uint8).reshape(-1, 8)
    return base64.b64encode(wide[:, 2:].tobytes()).decode("ascii")


def unpack(fingerprint: str | None) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(fingerprint or ""), dtype=np.uint8).reshape(-1, 6)
    wide = np.zeros((len(raw), 8), dtype=np.uint8)
    wide[:, 2:] = raw
    return wide.view(">u8").reshape(-1).astype(np.uint64)


def likeness(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Share of the union's smallest `k` hashes that both hold; two empty sketches are alike."""
    union = np.union1d(a, b)[:k]
    if not len(union):
        return 1.0
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.count_nonzero(both <= union[-1])) / len(union)


def distinct(sketch: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact below `k`."""
    return float(len(sketch)) if len(sketch) < k else (k - 1) * _SPACE / float(sketch[-1])


def covered(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has; 1 for an empty a."""
    if not len(a):
        return 1.0
    union = np.union1d(a, b)[:k]
    return min(1.0, likeness(a, b, k) * distinct(union, k) / distinct(a, k))


def fingerprint(text: Column, k: int = K, width: int = WIDTH) -> Column:
    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([pack(s) for s in sketches(pa.array(texts, type=pa.string(), from_pandas=True), k, width)], dtype=object)

    return of(text)


def _measured(measure, a: Column, b: Column, k: int) -> Column:
    @F.pandas_udf("double")
    def of(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([measure(unpack(x), unpack(y), k) for x, y in zip(left, right)], dtype=float)

    return of(a, b)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    return _measured(likeness, a, b, k)


def containment(a: Column, b: Column, k: int = K) -> Column:
    return _measured(covered, a, b, k)


def distinct_shingles(a: Column, k: int = K) -> Column:
    @F.pandas_udf("double")
    def of(values: pd.Series) -> pd.Series:
        return pd.Series([distinct(unpack(x), k) for x in values], dtype=float)

    return of(a)


def merge(parts: DataFrame, key: str, column: str = "fingerprint", k: int = K) -> DataFrame:
    """One fingerprint per key, of everything that the key's parts hold.

    Every task sends at most `k` hashes of a key on, so a key may have any number of parts.
    Keys whose parts are all empty get the empty fingerprint.
    """

    ship(parts.sparkSession)

    @F.pandas_udf("array<long>")
    def hashes(values: pd.Series) -> pd.Series:
        return pd.Series([unpack(x).astype(np.int64) for x in values])

    @F.pandas_udf("string")
    def packed(values: pd.Series) -> pd.Series:
        return pd.Series([pack(np.sort(np.asarray(x, dtype=np.uint64))) for x in values], dtype=object)

    spread = parts.select(F.col(key), F.explode_outer(hashes(F.col(column))).alias("__hash"))
    ranked = spread.groupBy(key, "__hash").agg(F.count(F.lit(1)).alias("__n")).withColumn(
        "__rank", F.row_number().over(Window.partitionBy(key).orderBy(F.col("__hash").asc_nulls_last()))
    )
    few = ranked.where(F.col("__rank") <= k).groupBy(key).agg(F.collect_list("__hash").alias("__hashes"))
    return few.select(key, packed(F.col("__hashes")).alias(column))


def _neighbours(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Rows (part, extra, key, doc_id, text): every part in key order ends with the first row of the next.

    Parts are ranges of doc_id between quantiles. Only their limits, a few for each shuffle
    partition, come to the driver.
    """
    ship(spark)
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST_KEY)).alias("key"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    at = [i / parts for i in range(1, parts)]
    limits = keyed.agg(F.percentile_approx("key", at, 20 * parts)).first()[0]
    limits = sorted(set(limits or []))
    if limits:
        listed = F.array(*[F.lit(x).cast("long") for x in limits])
        part = F.size(F.filter(listed, lambda x: x <= F.col("key")))
    else:
        part = F.lit(0)
    keyed = keyed.withColumn("part", part)
    heads = [tuple(r) for r in keyed.groupBy("part").agg(F.min("key")).orderBy("part").collect()]
    before = [(head, heads[i - 1][0]) for i, (_, head) in enumerate(heads)]
    firsts = spark.createDataFrame(before or [(0, 0)], "head long, before int")
    return (
        keyed.join(F.broadcast(firsts), F.col("key") == F.col("head"), "left")
        .withColumn(
            "at",
            F.explode(
                F.filter(
                    F.array(
                        F.struct(F.col("part").alias("part"), F.lit(0).alias("extra")),
                        F.struct(F.col("before").alias("part"), F.lit(1).alias("extra")),
                    ),
                    lambda x: x["part"].isNotNull(),
                )
            ),
        )
        .select("at.part", "at.extra", "key", "doc_id", "text")
    )


def fingerprint_pairs(spark: SparkSession, docs: DataFrame, k: int = K, width: int = WIDTH) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how near they and the next one are.

    The next document is the next in ascending doc_id, after the last one the first. In the edited
    text the last quarter of the code points gives way to as many (or all) of the first of the next
    document. Texts move once, into ranges of doc_id. A null doc_id sorts first; rows of one doc_id
    are in the order of their texts; of a single row the next is the row itself.
    """

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry: tuple | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            extra, ids, texts = batch.column("extra").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            own = sketches(batch.column("text"), k, width)
            rows = list(zip(extra, ids, texts, own))
            if carry is not None:
                rows.insert(0, carry)
            carry = rows[-1]
            out: list[tuple] = []
            edited: list[str] = []
            for (kind, doc, text, sketch), (_, _, following, next_sketch) in zip(rows, rows[1:]):
                if kind:
                    continue
                cut = len(text) // 4
                edited.append(text[: len(text) - cut] + following[:cut])
                out.append((doc, len(text), sketch, next_sketch))
            if not out:
                continue
            changed = sketches(pa.array(edited, type=pa.large_string()), k, width)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in out], type=pa.int64()),
                    pa.array([r[1] for r in out], type=pa.int64()),
                    pa.array([hashlib.sha256(e.encode("utf-8")).hexdigest() for e in edited], type=pa.string()),
                    pa.array([pack(r[2]) for r in out], type=pa.string()),
                    pa.array([pack(c) for c in changed], type=pa.string()),
                    pa.array([likeness(r[2], c, k) for r, c in zip(out, changed)], type=pa.float64()),
                    pa.array([likeness(r[2], r[3], k) for r in out], type=pa.float64()),
                ],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )
        if carry is not None and not carry[0]:
            raise ValueError("a range of documents does not end with the first of the next")

    return (
        _neighbours(spark, docs)
        .repartition("part")
        .sortWithinPartitions("part", "extra", "key", "text")
        .mapInArrow(
            pairs,
            "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
            "near_edited double, near_next double",
        )
    )
