"""Phrase collocations by sorting suffix pointers.

A suffix is a pointer to a word; it reads up to four words, to the end of its piece of text. Phrases that occur
often are equal beginnings of many suffixes, so a multikey three-way quicksort finds them with their
counts: the part that equals the pivot goes on to the next word, and its size is a count; the other two stay
at the same word (`quicksort`). Parts below the least count are abandoned.

**Routing.** A part may only be abandoned where all its suffixes are, so suffixes are routed by their leading
words, one word more at a time. First words: counted by name (`_words`). First two: counted by a hash of
both (`_pairs`), which may take two pairs for one and so never counts too few. What is frequent is marked in a
bitmap of fixed size (`BITS`) that every task gets; a bit too many costs a few rows more, never a phrase. At
last the suffixes that begin with frequent pairs move to the task of their first word, equal ones of a chunk
once and those of one task's bucket together, and are sorted there. A word that holds more than its share of a task
is dealt out by the second word, such a pair by all words; only the parts of pairs are added up afterwards.

**Names.** A word is a 64-bit hash of language and word. If two words that matter share one, all is done anew
with another seed, so counts are exact.

Null texts are empty, null languages `und`. Words are runs of bytes outside blanks and tabs, pieces end at
``.,;:!?`` and line ends, A-Z count as a-z. A task holds some 60 bytes for each byte of a slice of
`words.SLICE_BYTES`, or of one longer text. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.shipping import ship
from marketlake.llm.stored import stored
from marketlake.llm.words import _LOWER, _Powers, filled, mix, slices

DEPTH = 4
LEAST = 30
TOP = 2000
#: A phrase goes if a longer one has this many hundredths of its occurrences.
SHARE = 80

BITS = 1 << 26
#: Words, pairs or suffixes that a task puts together before it sends them.
CHUNK = 1 << 21
#: Hashes of pairs and counts in a chunk share one number.
COUNT_BITS = 22
PAIR_BITS = 41
#: Words of the corpus for each task that sorts suffixes.
SHARD_WORDS = 2_000_000

#: Buckets of suffixes for each such task, so that tasks get about the same.
BUCKETS = 8

_BLANK, _BREAK = 1, 2
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[[0x20, 0x09]] = _BLANK
_CLASS[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = _BREAK

_PAIR = np.uint64(0xD6E8FEB86659FD93)
_LOWER_BYTE = (_LOWER - np.uint64(1)).astype(np.uint8)


def _key(lang: str, seed: int) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode("utf-8"), digest_size=8, key=str(seed).encode()).digest(), "little")


class _Text:
    """The words of some rows: names, where they stand, and whether the next word follows in the same piece."""

    def __init__(self, column: pa.Array, keys: np.ndarray) -> None:
        rows = len(column)
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + rows + 1]
        first, last = int(offsets[0]), int(offsets[-1])
        edges = offsets - first
        self.data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[first:last] if last > first else np.zeros(0, np.uint8)
        kinds = _CLASS[self.data]
        solid = kinds == 0
        opens, closes = solid.copy(), solid.copy()
        opens[1:] &= ~solid[:-1]
        closes[:-1] &= ~solid[1:]
        inner = edges[(edges > 0) & (edges < len(self.data))]
        opens[inner] = solid[inner]
        closes[inner - 1] = solid[inner - 1]
        self.starts, self.ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        self.row = np.searchsorted(edges, self.starts, side="right") - 1
        up, down = _Powers.upto(max(1, len(self.data)))
        sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
        np.cumsum(_LOWER[self.data] * up[: len(self.data)], out=sums[1:])
        names = mix(mix((sums[self.ends] - sums[self.starts]) * down[self.starts]) ^ keys[self.row])
        _Powers.trim()
        self.names = np.maximum(names, np.uint64(1))
        breaks = np.cumsum(kinds == _BREAK)
        piece = breaks[self.starts] if len(self.starts) else breaks[:0]
        self.next = np.zeros(len(self.names), dtype=bool)
        self.next[:-1] = (piece[1:] == piece[:-1]) & (self.row[1:] == self.row[:-1])

    def spelled(self, at: np.ndarray) -> pa.Array:
        """The words at some places, in lower case."""
        sizes = (self.ends - self.starts)[at]
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        places = np.arange(bounds[-1]) + np.repeat(self.starts[at] - bounds[:-1], sizes)
        data = _LOWER_BYTE[self.data[places]]
        return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes()))


def _texts(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[tuple[_Text, pa.Array, np.ndarray]]:
    """Slices of the rows with their languages: each one's text, distinct languages, and which of them a row has."""
    for batch in batches:
        column = filled(batch.column(0))
        langs = batch.column(1).dictionary_encode()
        names = langs.dictionary.cast(pa.large_string())
        code = np.asarray(langs.indices.to_numpy(zero_copy_only=False), dtype=np.int64)
        keys = np.array([_key(name, seed) for name in names.to_pylist()], dtype=np.uint64)
        for start, stop in slices(column):
            yield _Text(column.slice(start, stop - start), keys[code[start:stop]]), names, code[start:stop]


def _summed(names: np.ndarray, counts: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct names, the place of one of each, and their counts."""
    order = np.argsort(names, kind="stable")
    ranked = names[order]
    first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(names) else np.zeros(0, np.int64)
    totals = np.diff(np.append(first, len(names))) if counts is None else np.add.reduceat(counts[order], first) if len(names) else counts
    return ranked[first], order[first], totals


def _read(docs: DataFrame) -> DataFrame:
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    return docs.select(F.col("text").cast("string").alias("text"), lang.alias("lang"))


def _words(docs: DataFrame, seed: int, least: int) -> DataFrame:
    """name, lang, word, f of the frequent words; for each language one row with an empty word and the number of all."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]] = []
        size = 0

        def merged() -> pa.RecordBatch:
            names, at, totals = _summed(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
            langs, words = (pa.concat_arrays([h[n] for h in held]).take(pa.array(at)) for n in (2, 3))
            columns = [pa.array(names.view(np.int64)), langs.cast(pa.string()), words.cast(pa.string()), pa.array(totals)]
            return pa.RecordBatch.from_arrays(columns, names=["name", "lang", "word", "f"])

        for text, langs, code in _texts(batches, seed):
            names, at, totals = _summed(text.names, None)
            held.append((names, totals, langs.take(pa.array(code[text.row[at]])), text.spelled(at)))
            n_words = np.bincount(code[text.row], minlength=len(langs))
            empty = [_key(f"all words of {lang}", seed) for lang in langs.to_pylist()]
            held.append((np.array(empty, np.uint64), n_words, langs, pa.array([""] * len(langs), type=pa.large_string())))
            size += len(names)
            if size >= CHUNK:
                yield merged()
                held, size = [], 0
        if held:
            yield merged()

    rows = _read(docs).mapInArrow(counted, "name long, lang string, word string, f long")
    spelled = rows.repartition("name").groupBy("name", "lang", "word").agg(F.sum("f").alias("f"))
    named = spelled.groupBy("name").agg(
        F.first("lang").alias("lang"), F.first("word").alias("word"), F.sum("f").alias("f"), F.count(F.lit(1)).alias("spellings")
    )
    return named.where((F.col("f") >= least) | (F.col("word") == ""))


def _bitmap(names: DataFrame) -> np.ndarray:
    """A bit for the low bits of each number in the column `name`; its size does not depend on the data."""
    slot = F.col("name").bitwiseAND(F.lit(BITS - 1)) + 1
    rows = names.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    out = np.zeros(BITS // 8, dtype=np.uint8)
    for row in rows.collect():
        bits = np.frombuffer(row["bits"], dtype=np.uint8)
        out[(row["bucket"] - 1) * len(bits) :][: len(bits)] = bits
    return out


def _marked(bits: np.ndarray, names: np.ndarray) -> np.ndarray:
    slot = names & np.uint64(BITS - 1)
    return (bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _pair_names(names: np.ndarray, at: np.ndarray) -> np.ndarray:
    return mix(names[at] * _PAIR + names[at + 1]) >> np.uint64(64 - PAIR_BITS)


def _leads(text: _Text, words: np.ndarray) -> np.ndarray:
    """Places where two neighbouring words of a piece are both marked."""
    known = _marked(words, text.names)
    both = text.next.copy()
    both[:-1] &= known[:-1] & known[1:]
    return np.flatnonzero(both)


def _pairs(docs: DataFrame, seed: int, words, least: int) -> DataFrame:
    """name, f: hashes of neighbouring frequent words that occur often; f is at least each pair's count."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = words.value
        held: list[np.ndarray] = []
        size = 0

        def packed() -> Iterator[pa.RecordBatch]:
            for part in np.array_split(np.concatenate(held), max(1, -(-size // CHUNK))):
                names, _, totals = _summed(part, None)
                both = names << np.uint64(COUNT_BITS) | totals.astype(np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(both.view(np.int64))], names=["both"])

        for text, _, _ in _texts(batches, seed):
            held.append(_pair_names(text.names, _leads(text, bits)))
            size += len(held[-1])
            if size >= CHUNK:
                yield from packed()
                held, size = [], 0
        if size:
            yield from packed()

    rows = _read(docs).mapInArrow(counted, "both long")
    name, f = F.shiftrightunsigned("both", COUNT_BITS), F.col("both").bitwiseAND(F.lit((1 << COUNT_BITS) - 1))
    counts = rows.select(name.alias("name"), f.alias("f")).repartition("name").groupBy("name").agg(F.sum("f").alias("f"))
    return counts.where(F.col("f") >= least)


def _suffixes(docs: DataFrame, seed: int, words, pairs, heavy_words: dict[int, int], heavy_pairs: dict[int, int], buckets: int) -> DataFrame:
    """bucket, part, lead, rest, times: a chunk's suffixes that go to a bucket, as their first words, their further words
    (three each, 0 behind the end) and how often each occurs.

    The first word gives the bucket; for a heavy word, with the second; for a heavy pair, with all words: only then is
    what reaches a bucket a `part` of a pair.
    """

    def looked_up(heavy: dict[int, int]):
        names = np.array([*sorted(heavy), (1 << 64) - 1], dtype=np.uint64)
        parts = np.array([*(heavy[n] for n in sorted(heavy)), 1], dtype=np.uint64)

        def parts_of(keys: np.ndarray) -> np.ndarray:
            at = np.searchsorted(names, keys)
            return np.where(names[at] == keys, parts[at], np.uint64(1))

        return parts_of

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_bits, pair_bits = words.value, pairs.value
        word_parts, pair_parts = looked_up(heavy_words), looked_up(heavy_pairs)
        held: list[np.ndarray] = []
        size = 0

        def merged() -> pa.RecordBatch:
            read = np.concatenate(held)
            whole = read[:, 0]
            for n in range(1, DEPTH):
                whole = mix(whole * _PAIR + read[:, n])
            order = np.lexsort((whole, read[:, 1], read[:, 0]))
            read = read[order]
            first = np.flatnonzero(np.append(True, (read[1:] != read[:-1]).any(axis=1)))
            times = np.diff(np.append(first, len(read)))
            read, whole = read[first], whole[order][first]
            deal = mix(read[:, 1]) % word_parts(read[:, 0])
            parts = pair_parts(mix(read[:, 0] * _PAIR + read[:, 1]) >> np.uint64(64 - PAIR_BITS))
            part = parts > 1
            deal = np.where(part, whole % parts + (deal << np.uint64(32)), deal)
            bucket = (mix(read[:, 0] + deal * _PAIR) % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((part, bucket))
            read, times, bucket, part = read[order], times[order], bucket[order], part[order]
            leads = np.flatnonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (part[1:] != part[:-1])))
            bounds = np.append(leads, len(read)).astype(np.int32)

            def lists(values: np.ndarray, width: int) -> pa.Array:
                return pa.ListArray.from_arrays(pa.array(bounds * np.int32(width)), pa.array(np.ascontiguousarray(values).view(np.int64).ravel()))

            columns = [pa.array(bucket[leads]), pa.array(part[leads]), lists(read[:, 0], 1), lists(read[:, 1:], DEPTH - 1), lists(times, 1)]
            return pa.RecordBatch.from_arrays(columns, names=["bucket", "part", "lead", "rest", "times"])

        for text, _, _ in _texts(batches, seed):
            at = _leads(text, word_bits)
            at = at[_marked(pair_bits, _pair_names(text.names, at))]
            if not len(at):
                continue
            goes_on = np.zeros(len(text.names) + DEPTH, dtype=bool)
            goes_on[at] = True
            names = np.append(text.names, np.zeros(DEPTH, dtype=np.uint64))
            read = np.zeros((len(at), DEPTH), dtype=np.uint64)
            still = np.ones(len(at), dtype=bool)
            read[:, 0] = names[at]
            for n in range(1, DEPTH):
                still &= goes_on[at + n - 1]
                read[still, n] = names[at[still] + n]
            held.append(read)
            size += len(read)
            if size >= CHUNK // 2:
                yield merged()
                held, size = [], 0
        if held:
            yield merged()

    return _read(docs).mapInArrow(routed, "bucket long, part boolean, lead array<long>, rest array<long>, times array<long>")


def quicksort(read: np.ndarray, times: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Multikey three-way quicksort of suffixes, all open parts at a time.

    `read` has a suffix in each row, 0 behind its end; `times` says how often it occurs. Yields length, pointers
    and counts of the phrases of two words or more that occur at least `least` times. Each round splits every
    open part around the median of three of its keys at the part's depth.
    """
    pointers = np.arange(len(read))
    sizes = np.array([len(read)])
    depths = np.zeros(1, dtype=np.int64)
    while len(pointers):
        parts = len(sizes)
        starts = np.cumsum(sizes) - sizes
        part = np.repeat(np.arange(parts), sizes)
        key = read[pointers, depths[part]]
        a, b, c = key[starts], key[starts + sizes // 2], key[starts + sizes - 1]
        pivot = np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))
        own = pivot[part]
        side = (key >= own).astype(np.int64) + (key > own)
        slot = part * 3 + side
        new_sizes = np.bincount(slot, minlength=3 * parts)
        counts = np.zeros(3 * parts, dtype=np.int64)
        np.add.at(counts, slot, times[pointers])
        new_starts = np.cumsum(new_sizes) - new_sizes
        moved = np.empty_like(pointers)
        for n in range(3):
            here = np.flatnonzero(side == n)
            before = np.cumsum(new_sizes[n::3]) - new_sizes[n::3]
            moved[new_starts[slot[here]] + np.arange(len(here)) - before[part[here]]] = pointers[here]
        equal = np.arange(3 * parts) % 3 == 1
        new_depths = np.repeat(depths, 3) + equal
        ended = equal & (np.repeat(pivot, 3) == 0)
        frequent = (counts >= least) & (new_sizes > 0) & ~ended
        for depth in range(2, read.shape[1] + 1):
            found = np.flatnonzero(frequent & equal & (new_depths == depth))
            if len(found):
                yield depth, moved[new_starts[found]], counts[found]
        open_parts = frequent & (new_depths < read.shape[1])
        pointers = moved[np.repeat(open_parts, new_sizes)]
        sizes, depths = new_sizes[open_parts], new_depths[open_parts]


def _sorted(suffixes: DataFrame, shards: int, least: int) -> DataFrame:
    """phrase (names of its words) and a: the frequent phrases of two to four words with their counts."""

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            _, part, lead, rest, times = batch.columns
            sizes = np.diff(times.offsets.to_numpy())
            words = [lead.flatten().to_numpy().view(np.uint64)[:, None], rest.flatten().to_numpy().view(np.uint64).reshape(-1, DEPTH - 1)]
            part = np.repeat(part.to_numpy(zero_copy_only=False).astype(bool), sizes)
            held.append((np.concatenate(words, axis=1), times.flatten().to_numpy(), part))
        if not held:
            return
        whole, times, dealt = (np.concatenate(c) for c in zip(*held))
        del held
        for part in (False, True):
            kept = dealt == part
            read = whole[kept]
            # of a heavy pair only some suffixes are here, so nothing of it is abandoned yet
            for depth, at, counts in quicksort(read, times[kept], 1 if part else least):
                names = np.ascontiguousarray(read[at][:, :depth]).view(np.int64).ravel()
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(names) + 1, depth, dtype=np.int32)), pa.array(names))
                yield pa.RecordBatch.from_arrays([lists, pa.array(counts)], names=["phrase", "a"])

    here = suffixes.repartition(shards, "bucket").mapInArrow(phrases, "phrase array<long>, a long")
    return here.groupBy("phrase").agg(F.sum("a").alias("a")).where(F.col("a") >= least)


def candidates(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Frequent words (name, lang, word, f; an empty word has the number of all words of its language) and
    frequent phrases (phrase, a), both written to the shared folder."""
    spark = docs.sparkSession
    ship(spark)
    seed = 0
    while True:
        words = stored(_words(docs, seed, least), "phrase_words")
        totals = words.agg(F.max("spellings"), F.sum(F.when(F.col("word") == "", F.col("f")))).first()
        if totals[0] is None or totals[0] == 1:
            break
        seed += 1
    n_words = totals[1] or 0
    context = spark.sparkContext
    word_bits = context.broadcast(_bitmap(words.where("word <> ''")))
    pairs = stored(_pairs(docs, seed, word_bits, least), "phrase_pairs")
    pair_bits = context.broadcast(_bitmap(pairs))
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_words // SHARD_WORDS))
    # at most four times as many words or pairs as shards hold more than a fourth of a shard's share
    limit = max(1, n_words // (4 * shards), 16 * least)
    heavy_words, heavy_pairs = (
        {r["name"] % (1 << 64): -(-r["f"] // limit) for r in names.where(F.col("f") > limit).select("name", "f").collect()}
        for names in (words.where("word <> ''"), pairs)
    )
    suffixes = _suffixes(docs, seed, word_bits, pair_bits, heavy_words, heavy_pairs, BUCKETS * shards)
    return words, stored(_sorted(suffixes, shards, least), "phrases")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, share: int = SHARE) -> DataFrame:
    """Each language's `top` phrases: lang, rank, phrase, a, l, r, n, score.

    a counts the phrase, l and r its two parts at the cut with the lowest score, floor(2000000 a / (l + r)), n all
    words of the language. A phrase inside a longer frequent one with `share` hundredths of its count goes. Order:
    score and a descending, then the phrase's bytes.
    """
    words, phrases = candidates(docs, least)
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    counts = phrases.select(F.col("phrase").alias("part"), F.col("a").alias("f")).unionByName(
        words.where("word <> ''").select(F.array("name").alias("part"), "f")
    )
    cuts = phrases.select("phrase", "a", F.explode(F.sequence(F.lit(1), F.size("phrase") - 1)).alias("k")).select(
        "*", F.expr("slice(phrase, 1, k)").alias("head"), F.expr("slice(phrase, k + 1, size(phrase) - k)").alias("rest")
    )
    cuts = cuts.join(counts.select(F.col("part").alias("head"), F.col("f").alias("l")), "head")
    cuts = cuts.join(counts.select(F.col("part").alias("rest"), F.col("f").alias("r")), "rest")
    scored = cuts.withColumn("score", F.expr("cast(cast(a as decimal(20,0)) * 2000000 div (cast(l as decimal(20,0)) + cast(r as decimal(20,0))) as bigint)"))
    lowest = scored.groupBy("phrase").agg(F.max("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = F.expr("flatten(transform(sequence(2, size(phrase) - 1), n -> transform(sequence(1, size(phrase) - n + 1), i -> slice(phrase, i, n))))")
    longer = phrases.where(F.size("phrase") > 2).select(F.explode(inner).alias("phrase"), F.col("a").alias("longer"))
    longer = longer.groupBy("phrase").agg(F.max("longer").alias("longer"))
    kept = lowest.join(longer, "phrase", "left").where(
        F.col("longer").isNull() | (exact("longer") * 100 < exact("a") * share)
    )
    first = words.select(F.col("name").alias("lead"), "lang")
    ranked = kept.select("phrase", "a", "cut.score", "cut.l", "cut.r", F.col("phrase")[0].alias("lead")).join(first, "lead")
    # ties at the last place stay until the phrases are spelled
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    best = ranked.withColumn("place", F.rank().over(order)).where(F.col("place") <= top)
    best = stored(best.select("phrase", "lang", "a", "l", "r", "score"), "phrase_best")
    names = words.where("word <> ''").select("name", "word")
    spelled = best.select("phrase", F.posexplode("phrase").alias("at", "name")).join(names, "name").groupBy("phrase").agg(
        F.sort_array(F.collect_list(F.struct("at", "word"))).alias("words")
    )
    totals = words.where("word = ''").select("lang", F.col("f").alias("n"))
    rows = best.join(spelled, "phrase").join(totals, "lang").withColumn("spelled", F.array_join(F.col("words")["word"], " "))
    final = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "spelled")
    return rows.withColumn("rank", F.row_number().over(final).cast("long")).where(F.col("rank") <= top).select(
        "lang", "rank", F.col("spelled").alias("phrase"), "a", "l", "r", "n", "score"
    )
