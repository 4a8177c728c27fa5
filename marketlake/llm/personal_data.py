"""Personal data: fixed patterns as seeds, contexts learned from them, and what those contexts show.

Every match of a fixed pattern is a seed of its kind. The words around seeds are candidate
patterns; the same words around other identifier-like strings (with an @ or three digits) connect
these to the seeds. On this graph of contexts and strings scores go back and forth: a context
is as sure of a kind as the share of its distinct strings that are of the kind, a string is of the
kind unless all its contexts err. After `ROUNDS` rounds a string that is no seed is reported where
it stands in a sure context. Only strings and their contexts move, counted once for each pair.

Null and empty texts hold nothing. Added spans never overlap the seeds' spans or each other.
"""

from __future__ import annotations

import re
import string
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.memory import give_back
from marketlake.llm.rows import row_key, unused
from marketlake.llm.shipping import ship
from marketlake.llm.stored import stored

KINDS = ["email", "ip", "card", "phone"]
#: Fixed patterns of the kinds; runs are read once, so that time grows with the length of a text. For emails see `_emails`.
_LOCAL = string.ascii_letters + string.digits + "._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
PATTERNS = {
    # a match never begins inside a run of digits: from its beginning there is one as well
    "ip": re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}

ROUNDS = 3
SUPPORT = 3.0
SURE = 0.75
ACCEPT = 0.75
#: A counted side of at most so many rows is broadcast.
BROADCAST_ROWS = 200_000
#: Texts that a task holds as strings at once.
ROWS = 500

_MAYBE = re.compile("[0-9@]")
_DIGITS = re.compile("[0-9]+")
_RUN = re.compile(r"[^\s\"'<>()\[\]{},;]++")
_TRIM = ".:!?#$%&*|=+-"


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[str, int, int]]:
    """Matches of `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`, looked for outwards from each @."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = free + len(text[free:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield "email", start, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def _holds(kind: str, found: str) -> bool:
    parts = _DIGITS.findall(found)
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts)
    digits = "".join(parts)
    if kind == "card":
        return 12 <= len(digits) <= 19 and _luhn(digits)
    return 9 <= len(digits) <= 15


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, by start and then by kind."""
    if not text or not _MAYBE.search(text):
        return []
    marks = {"ip": ".", "phone": "+"}
    spans = list(_emails(text))
    spans += [
        (kind, m.start(), m.end())
        for kind in PATTERNS
        if marks.get(kind, "") in text
        for m in PATTERNS[kind].finditer(text)
        if _holds(kind, m.group())
    ]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def contexts(text: str, start: int, end: int) -> list[str]:
    """The words around a span, as patterns: two before it, one on either side, a label before it."""
    left = [_DIGITS.sub("0", w.lower()) for w in text[max(0, start - 80) : start].split()[-2:]]
    right = [_DIGITS.sub("0", w.lower()) for w in text[end : end + 40].split()[:1]]
    found = []
    if len(left) == 2:
        found.append("before " + " ".join(left))
    if left and right:
        found.append(f"between {left[-1]} {right[0]}")
    if left and left[-1][-1] in ":=":
        found.append("label " + left[-1])
    return found


def occurrences(text: str | None) -> list[tuple[str | None, int, int, str, list[str]]]:
    """(kind or None, start, end, string, contexts) of seeds and of other identifier-like strings."""
    seeds = base_spans(text)
    found = [(kind, s, e, text[s:e].lower(), contexts(text, s, e)) for kind, s, e in seeds]
    if not text or not _MAYBE.search(text):
        return found
    at = 0
    for m in _RUN.finditer(text):
        start, end = m.start(), m.end()
        if not _MAYBE.search(text, start, end):
            continue
        while start < end and text[start] in _TRIM:
            start += 1
        while end > start and text[end - 1] in _TRIM:
            end -= 1
        word = text[start:end]
        if len(word) < 5 or not ("@" in word or sum(map(str.isdigit, word)) >= 3):
            continue
        while at < len(seeds) and seeds[at][2] <= start:
            at += 1
        if any(s < end and start < e for _, s, e in seeds[at : at + 8]):
            continue
        found.append((None, start, end, word.lower(), contexts(text, start, end)))
    return found


_OCCURRENCES = "array<struct<kind:string,start:int,end:int,word:string,contexts:array<string>>>"
_FOUND = pa.list_(
    pa.struct({"kind": pa.string(), "start": pa.int32(), "end": pa.int32(), "word": pa.string(), "contexts": pa.list_(pa.string())})
)


def _sliced(batches: Iterator[pa.RecordBatch], made: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is made of a task's rows, `ROWS` at a time; what is freed goes back to the system when the task ends."""
    try:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                yield made(batch.slice(start, ROWS))
    finally:
        batch = None
        give_back()


def scanned_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The columns of a task's rows but the last, its texts, and what is found in them."""
    names = ("kind", "start", "end", "word", "contexts")

    def scanned(part: pa.RecordBatch) -> pa.RecordBatch:
        *columns, texts = part.columns
        found = [[dict(zip(names, o)) for o in occurrences(t)] for t in texts.to_pylist()]
        return pa.RecordBatch.from_arrays([*columns, pa.array(found, type=_FOUND)], names=[*part.schema.names[:-1], "found"])

    return _sliced(batches, scanned)


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, row_key, found): the occurrences of every row."""
    ship(docs.sparkSession)
    keyed = docs.select("doc_id", row_key("doc_id", "text").alias("row_key"), "text")
    schema = keyed.withColumn("text", F.lit(None).cast(_OCCURRENCES)).withColumnRenamed("text", "found").schema
    return keyed.mapInArrow(scanned_batches, schema)


def _few(frame: DataFrame) -> DataFrame:
    return F.broadcast(frame) if frame.count() <= BROADCAST_ROWS else frame


def discovered(scanned: DataFrame) -> DataFrame:
    """(row_key, start, end, kind): spans that the learned contexts add."""
    each = scanned.select("row_key", F.explode("found").alias("o")).select("row_key", "o.*")
    spread = each.select("kind", "word", F.explode("contexts").alias("context"))
    edges = stored(spread.groupBy("context", "word").agg(F.count(F.lit(1)).alias("n")), "pii_edges")
    sizes = edges.groupBy("context").agg(F.count(F.lit(1)).alias("words"))
    seeds = stored(each.where(F.col("kind").isNotNull()).groupBy("word", "kind").agg(F.lit(1.0).alias("score")), "pii_seeds")
    scores = seeds
    for _ in range(ROUNDS):
        sums = edges.join(scores, "word").groupBy("context", "kind").agg(F.sum("score").alias("kin"))
        strong = sums.where(F.col("kin") >= SUPPORT).join(sizes, "context")
        sure = stored(
            strong.select("context", "kind", (F.col("kin") / F.col("words")).alias("trust")).where(F.col("trust") >= SURE),
            "pii_contexts",
        )
        doubt = F.sum(F.log(1.0 - F.least(F.col("trust"), F.lit(0.999))))
        found = (
            edges.join(_few(sure), "context")
            .groupBy("word", "kind")
            .agg((1.0 - F.exp(doubt)).alias("score"))
            .join(seeds.select("word").distinct(), "word", "left_anti")
        )
        scores = stored(seeds.unionByName(found), "pii_scores")
    accepted = scores.where(F.col("score") >= ACCEPT).join(seeds.select("word").distinct(), "word", "left_anti")
    unknown = each.where(F.col("kind").isNull()).select("row_key", "start", "end", "word", F.explode("contexts").alias("context"))
    return (
        unknown.join(_few(sure), "context")
        .join(_few(stored(accepted, "pii_accepted")), ["word", "kind"])
        .groupBy("row_key", "start", "end")
        .agg(F.max(F.struct("score", "kind")).alias("best"))
        .select("row_key", "start", "end", "best.kind")
    )


def _listed(spans: DataFrame) -> DataFrame:
    """The added spans of a row as one array, by start."""
    return spans.groupBy("row_key").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("added"))


def _is(kind: str):
    return lambda x: F.when(x["kind"] == kind, 1)


def span_digests(docs: DataFrame) -> DataFrame:
    """Counts and digest of the fixed patterns' spans, and all spans, for every row."""
    scanned = stored(scan(docs), "pii_scan")
    added = _listed(discovered(scanned))

    def line(array: str) -> Column:
        ordered = F.array_sort(F.transform(array, lambda x: F.struct(x["start"], F.array_position(F.array(*map(F.lit, KINDS)), x["kind"]).alias("place"), x["end"], x["kind"].alias("kind"))))
        return F.array_join(F.transform(ordered, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    bare = lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))
    rows = (
        scanned.join(added, "row_key", "left")
        .withColumn("base", F.transform(F.filter("found", lambda x: x["kind"].isNotNull()), bare))
        .withColumn("every", F.concat("base", F.coalesce("added", F.array().cast("array<struct<start:int,end:int,kind:string>>"))))
    )
    counts = [F.size(F.array_compact(F.transform("base", _is(k)))).cast("long").alias(f"n_{k}") for k in KINDS]
    return rows.select(F.col("doc_id").cast("long"), *counts, F.sha2(line("base"), 256).alias("base_sha256"), line("every").alias("spans"))


def redacted_text(text: str, added: list | None) -> str:
    """The text with every span named by its kind; of overlapping spans the first, then the longest."""
    spans = base_spans(text) + [(a["kind"], a["start"], a["end"]) for a in (added if added is not None else [])]
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2], KINDS.index(s[0]))):
        if end <= at:
            continue
        out += [text[at : max(at, start)], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]]) if out else text


def redacted_batches(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """The columns of a task's rows but the last, the added spans; the texts, at place `text`, name personal data by its kind."""

    def redacted(part: pa.RecordBatch) -> pa.RecordBatch:
        *columns, added = part.columns
        pairs = zip(columns[text].to_pylist(), added.to_pylist())
        columns[text] = pa.array([t if t is None else redacted_text(t, s) for t, s in pairs], type=pa.string())
        return pa.RecordBatch.from_arrays(columns, names=part.schema.names[:-1])

    return _sliced(batches, redacted)


def redact(docs: DataFrame) -> DataFrame:
    """The documents with all their columns, their texts without personal data; null texts stay.

    A column n_chars is counted anew.
    """
    added = stored(_listed(discovered(stored(scan(docs), "pii_scan"))), "pii_added")

    names = docs.columns
    place = names.index("text")
    key, other = (unused(names, c) for c in ("row_key", "added"))
    found = added.select(F.col("row_key").alias(key + "_"), F.col("added").alias(other))
    joined = docs.withColumn(key, row_key("doc_id", "text")).join(_few(found), F.col(key) == F.col(key + "_"), "left")
    new = joined.select(*names, other).mapInArrow(lambda batches: redacted_batches(batches, place), docs.schema)
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        new = new.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast(kind)))
    return new.select(*names)
