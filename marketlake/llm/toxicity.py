"""Toxicity by noisy-channel restoration.

A disguised word (symbols for letters, drawn-out letters, letters set apart by spaces or points) is a
lattice of letters that its characters may stand for, in which a word may end at a gap. The Viterbi
path under a character trigram model, counted over all documents, holds the restored words; what all
surviving paths begin with is written out as the pass goes on, so no length is too long. Documents are scored by a logistic
model on restored words and their beginnings.

The model learns from labelled rows whose crc32(doc_id) mod 5 is not 0, at most `SAMPLE_ROWS` of them,
those of smallest hash of their ids. Labels with a null class or id are left out; of several for
one id the toxic one counts. Without both classes every text gets the smoothed share
of toxic rows. Null and empty texts score as texts without words.
"""

from __future__ import annotations

import math
import re
from os.path import commonprefix
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.memory import Recent, give_back
from marketlake.llm.shipping import ship
from marketlake.llm.stored import stored
from marketlake.llm.words import filled, slices

SAMPLE_ROWS = 6_000
SUPPORT = 3
#: Symbols after which the pass writes out what is settled.
SETTLE = 64
FEATURES = 400
#: Words that a task remembers, in each of two halves.
REMEMBERED = 150_000
RIDGE = 0.2
BEGINNINGS = range(3, 8)

#: Fixed: letters that symbols may stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
#: Between letters these may stand for nothing.
BETWEEN = set(".-_*~'`´,:;/\\^= ")
SWAP, DROP, REPEAT, SKIP_SYMBOL, SKIP_LETTER = -1.0, -0.7, -1.5, -3.0, -9.0
#: These may end a word as well, at this cost.
GAPS = set(".-_,:;/\\= ")
END = -1.0

_SIGNS = re.compile(r"[^\W\d_][^\w\s]+[^\W_]|[^\W_][^\w\s]+[^\W\d_]|[^\W\d_][\d_]|[\d_][^\W\d_]|(.)\1\1|^[@$][^\W\d_]")
_ENDS = re.compile(r"^[^\w@$]+|[^\w]+$|[@$]+(?=[^\w]|$)")
_SPACED = re.compile("1{3,}")
_GLUED = re.compile(r"[^\W\d_]{2,}[-._,;:/\\=]+(?=[^\W\d_]{2})")
_GAP = re.compile(r"[-._,;:/\\=]+")

LETTERS = 28  # 0: outside a word, 1 to 26: a to z, 27: any other
_FOLD = np.full(256, 27, dtype=np.int64)
_FOLD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
_FOLD[[*b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"]] = 0
_FOLD[65:91] = _FOLD[97:123] = np.arange(1, 27)


def folded(letter: str) -> int:
    return ord(letter) - 96 if "a" <= letter <= "z" else 27


def letter_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Counts of letter triples over all texts; the table's size is fixed."""
    ship(docs.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LETTERS**3, dtype=np.int64)
        for batch in batches:
            column = filled(batch.column(0))
            for start, stop in slices(column):
                part = column.slice(start, stop - start)
                offsets = np.frombuffer(part.buffers()[1], dtype=np.int64)[part.offset : part.offset + len(part) + 1]
                if offsets[0] == offsets[-1]:
                    continue
                at = _FOLD[np.frombuffer(part.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]]
                at = np.concatenate(([0, 0], at, [0]))
                total += np.bincount(at[:-2] * (LETTERS * LETTERS) + at[1:-1] * LETTERS + at[2:], minlength=LETTERS**3)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["cell", "n"])

    rows = docs.select(text).mapInArrow(counted, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(LETTERS**3, dtype=np.int64)
    for cell, n in rows:
        counts[cell] = n
    return counts.reshape(LETTERS, LETTERS, LETTERS)


def letter_model(counts: np.ndarray) -> np.ndarray:
    """Log probabilities of a letter after two others, smoothed by those after one and alone."""
    one = counts.sum(axis=(0, 1)) + 1.0
    one = one / one.sum()
    two = counts.sum(axis=0) + 50.0 * one
    two = two / two.sum(axis=1, keepdims=True)
    three = counts + 10.0 * two[None]
    return np.log(three / three.sum(axis=2, keepdims=True))


class Restorer:
    def __init__(self, model: np.ndarray) -> None:
        self.model = model
        self.known = Recent(REMEMBERED)

    def options(self, symbol: str, before: str) -> list[tuple[str, float]]:
        if symbol.isalpha():
            found = [(symbol, 0.0)]
        else:
            found = [(letter, SWAP) for letter in STANDS_FOR.get(symbol, "")]
            found.append(("", DROP if symbol in BETWEEN else SKIP_LETTER if found else SKIP_SYMBOL))
            if symbol in GAPS:
                found.append((" ", END))
        if symbol == before:
            found.append(("", REPEAT if symbol.isalpha() else DROP))
        return found

    def decode(self, word: str) -> str:
        """The letters that most likely stand behind a word, with a space between words."""
        model = self.model
        settled: list[str] = []
        paths: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
        before = ""
        for at, symbol in enumerate(word, 1):
            new: dict[tuple[int, int], tuple[float, str]] = {}
            for letter, cost in self.options(symbol, before):
                code = folded(letter) if letter and letter != " " else 0
                for (a, b), (score, text) in paths.items():
                    if letter == " " and not b:
                        continue
                    if letter:
                        key, value = (b, code), (score + cost + model[a, b, code], text + letter)
                    else:
                        key, value = (a, b), (score + cost, text)
                    if key not in new or value > new[key]:
                        new[key] = value
            paths, before = new, symbol
            if at % SETTLE == 0:
                same = commonprefix([text for _, text in paths.values()])
                settled.append(same)
                paths = {key: (score, text[len(same) :]) for key, (score, text) in paths.items()}
        settled.append(max((score + (model[a, b, 0] if b else 0.0), text) for (a, b), (score, text) in paths.items())[1])
        return "".join(settled).strip()

    def restore(self, word: str) -> str:
        """A lower-case word without its outer marks, and without its disguise; gaps in it may part words."""
        found = self.known.new.get(word) or self.known.get(word)
        if found is None:
            bare = _ENDS.sub("", word)
            found = self.decode(bare) if _SIGNS.search(bare) and any(c.isalpha() for c in bare) else bare
            if len(word) <= 64:
                self.known.put(word, found)
        return found

    def words(self, text: str) -> set[str]:
        """The distinct restored words of a text, those of letters set apart by spaces as well."""
        parts = text.lower().split()
        found: set[str] = set()
        for part in set(parts):
            found.update(self.restore(part).split() or [""])
            if _GLUED.search(part):
                # whichever gaps the path closed, what stands between gaps may be a word
                found.update(w for piece in _GAP.split(part) if len(piece) > 1 for w in self.restore(piece).split())
        single = ["1" if len(p) == 1 or (len(p) == 2 and not p[1].isalnum()) else "0" for p in parts]
        for run in _SPACED.finditer("".join(single)):
            found.update(self.decode(_ENDS.sub("", " ".join(parts[run.start() : run.end()]))).split() or [""])
        return found


def features(word: str) -> list[str]:
    """A word and its beginnings."""
    return [word, *(word[:n] + "-" for n in BEGINNINGS if len(word) > n)]


def document_features(words: set[str]) -> set[str]:
    return {f for word in words for f in features(word)}


class Model:
    """Scores texts: a restorer, weights by feature and an intercept."""

    def __init__(self, letters: np.ndarray, weights: dict[str, float], intercept: float) -> None:
        self.letters, self.weights, self.intercept = letters, weights, intercept

    def scorer(self):
        restorer, weights, known = Restorer(self.letters), self.weights, Recent(REMEMBERED)

        def score(text: str | None) -> float:
            total = self.intercept
            if text:
                hits: set[str] = set()
                for word in restorer.words(text):
                    found = known.new.get(word)
                    if found is None:
                        found = known.get(word)
                    if found is None:
                        found = tuple([f for f in features(word) if f in weights])
                        known.put(word, found)
                    hits.update(found)
                total += sum([weights[f] for f in sorted(hits)])
            return 1.0 / (1.0 + math.exp(-min(500.0, max(-500.0, total))))

        return score


def training_row(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn letters from all documents and weights from the labelled sample."""
    letters = letter_model(letter_counts(docs))
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & training_row(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("__doc"))
        .agg(F.max("toxic").cast("int").alias("__toxic"))
        .orderBy(F.xxhash64("__doc"), "__doc")
        .limit(sample_rows)
    )
    sample = stored(
        docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("__doc")).select("doc_id", "text", "__toxic"),
        "toxicity_sample",
    ).repartition(12)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer, seen, bad = Restorer(letters), Counter(), Counter()
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["__toxic"]):
                found = document_features(restorer.words(text or ""))
                seen.update(found)
                if toxic:
                    bad.update(found)
        names = list(seen)
        yield pd.DataFrame({"feature": names, "seen": [seen[f] for f in names], "bad": [bad[f] for f in names]}).astype(
            {"feature": "object", "seen": "int64", "bad": "int64"}
        )

    often = stored(
        sample.select("text", "__toxic")
        .mapInPandas(counted, "feature string, seen long, bad long")
        .groupBy("feature")
        .agg(F.sum("seen").alias("seen"), F.sum("bad").alias("bad"))
        .where(F.col("bad") >= SUPPORT),
        "toxicity_features",
    )
    tried = often.count()
    # only features that mostly stand in toxic texts come to the driver
    names = sorted(r[0] for r in often.where(2 * F.col("bad") >= F.col("seen")).select("feature").collect())
    place = {f: i for i, f in enumerate(names)}

    def matrix(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer = Restorer(letters)
        for batch in batches:
            hits = [sorted(place[f] for f in document_features(restorer.words(t or "")) if f in place) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "toxic": batch["__toxic"], "hits": hits})

    rows = sample.mapInPandas(matrix, "doc_id long, toxic int, hits array<int>").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["hits"]))
    toxic = np.array([r["toxic"] for r in rows], dtype=float)
    share = (toxic.sum() + 1.0) / (len(toxic) + 2.0)
    flat = math.log(share / (1.0 - share))
    if not 0 < toxic.sum() < len(toxic):
        return Model(letters, {}, flat)
    return _weighted(letters, names, tried, [r["hits"] for r in rows], toxic, flat)


def _weighted(letters: np.ndarray, names: list[str], tried: int, hits: list[list[int]], toxic: np.ndarray, start: float) -> Model:
    """Choose the features that go with the toxic class and fit the logistic weights."""
    n, positive = len(toxic), toxic.sum()
    seen, bad = np.zeros(len(names)), np.zeros(len(names))
    for row, t in zip(hits, toxic):
        seen[row] += 1
        bad[row] += t
    expected = seen * positive / n
    with np.errstate(divide="ignore", invalid="ignore"):
        cells = [(bad, expected), (seen - bad, seen - expected), (positive - bad, positive - expected), (n - seen - positive + bad, n - seen - positive + expected)]
        gain = 2 * sum(np.where(o > 0, o * np.log(o / e), 0.0) for o, e in cells)
    good = np.flatnonzero((bad > expected) & (gain >= 2.0 * math.log(max(2, tried))) & (bad / np.maximum(seen, 1) >= 0.5))
    good = good[np.lexsort((good, -gain[good]))]
    rows_of: dict[int, list[int]] = {int(f): [] for f in good}
    for i, row in enumerate(hits):
        for f in row:
            if f in rows_of:
                rows_of[f].append(i)
    alike: dict[tuple[int, ...], list[int]] = {}  # features of the same rows share one weight
    for f, rows in rows_of.items():
        alike.setdefault(tuple(rows), []).append(f)
    groups = list(alike.items())[:FEATURES]
    x = np.zeros((n, len(groups) + 1))
    x[:, -1] = 1.0
    for i, (rows, _) in enumerate(groups):
        x[list(rows), i] = 1.0
    # what is toxic wherever it occurs is so on its own as well: a text of that one word
    sure = [i for i, (rows, group) in enumerate(groups) if bad[group[0]] / (seen[group[0]] + 1.0) >= 0.9]
    of_feature = {names[f]: i for i, (_, group) in enumerate(groups) for f in group}
    alone = np.zeros((len(sure), len(groups) + 1))
    alone[:, -1] = 1.0
    for row, i in zip(alone, sure):
        for f in groups[i][1]:
            row[[of_feature[g] for g in features(names[f]) if g in of_feature]] = 1.0
        row[i] = 1.0
    x, toxic = np.vstack([x, alone]), np.concatenate([toxic, np.ones(len(sure))])
    ridge = np.full(len(groups) + 1, RIDGE)
    ridge[-1] = 0.0
    weights = np.zeros(len(groups) + 1)
    weights[-1] = start
    for _ in range(30):  # Newton steps
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ weights, -500, 500)))
        curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge + 1e-9)
        move = np.linalg.solve(curve, x.T @ (toxic - p) - ridge * weights)
        weights += np.clip(move, -2.0, 2.0)
        if np.abs(move).max() < 1e-6:
            break
    found = {names[f]: float(w) / len(group) for w, (_, group) in zip(weights, groups) for f in group}
    return Model(letters, found, float(weights[-1]))


def toxicity(text: Column, model: Model) -> Column:
    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        score = model.scorer()
        try:
            for part in texts:
                yield pd.Series([score(t) for t in part], dtype=float)
        finally:
            del score
            give_back()

    return scored(text)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted class of every row."""
    model = fit(docs, labels)
    ship(docs.sparkSession)
    scored = docs.select(F.col("doc_id").cast("long"), toxicity(F.col("text"), model).alias("score"))
    return scored.select("doc_id", (~training_row(F.col("doc_id"))).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the model does not reject, with all their columns."""
    return docs.where(toxicity(F.col("text"), fit(docs, labels)) < 0.5)
