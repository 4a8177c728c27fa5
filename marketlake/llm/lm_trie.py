"""Language-model scores from an Elias-Fano n-gram trie.

**Counting.** Documents are taken in blocks of some megabytes as they are read. Every block sends its
distinct n-grams, as sorted hashes with the counts of its training documents, to shards by hash
range; a shard adds the counts of all blocks up and answers each block in the order of its request. So
every n-gram of the corpus is counted, a frequent one crosses the network once for each block, and a
block, whose texts move as word numbers, receives just the part of the model that it needs. No task
holds more than a block or a shard.

**The trie.** A block lays its part out as levels in one memory-mapped file: words, then the
successors of every word, then of every pair. Pointers from a level to the next and the successors of
a level are monotone sequences in Elias-Fano code; the third word of a triple is named by its place
among the successors of the second. Probabilities and back-off weights are smoothed, and quantised to
1/1024 of a decade. A lookup finds a successor's place within its context's range, and drops
the first word of the context where there is none.

**The model.** P(w) = (c(w)+1) / (N+V+1); P(w | context) = (c(context w) + mu P(w | shorter context)) /
(c(context) + mu), with `MU` by order. Over the known words and one unknown word it sums to 1.

Words are runs outside white space, A-Z lower-cased; every document has one end, which counts as a
token, and begins behind two marks that don't. Null and empty texts are the end alone. A null id is not
held out. Words are told apart by 64-bit hashes, longer n-grams by 48.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.elias_fano import EliasFano
from marketlake.llm.packed import pack, pack_sorted, unpack, unpack_sorted
from marketlake.llm.shipping import ship
from marketlake.llm.words import filled, mix, slices, word_hashes

BLOCK_BYTES = 6 << 20
SHARD_BYTES = 8 << 20
ORDERS = 3
MU = {2: 1000.0, 3: 10.0}
STEP = 1024.0

_BEGIN, _END = np.uint64(0x5BD1E9955BD1E995), np.uint64(0x27D4EB2F165667C5)
_JOIN = np.uint64(0x9FB21C651E98DF25)


class Block:
    """The distinct n-grams of some documents, and where their tokens are among them."""

    def __init__(self, words: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        """`ids` are places among `words`, line after line: two begin marks, the words, one end; `lengths` count words and end."""
        self.words, self.ids, self.lengths = words, ids, lengths
        n_docs, n = len(lengths), len(words)
        starts = np.concatenate(([0], np.cumsum(lengths + 2)))[:-1].astype(np.int64)
        token = np.ones(len(ids), dtype=bool)
        token[starts] = token[starts + 1] = False
        at = np.flatnonzero(token)
        self.doc_starts = np.concatenate(([0], np.cumsum(lengths)))[:-1].astype(np.int64)
        now, one, two = ids[at], ids[at - 1], ids[at - 2]
        self.begin = int(np.searchsorted(words, _BEGIN)) if n_docs else 0
        # the pair of begin marks is a context as well, though no token ends it
        pairs = np.concatenate((ids[starts] * n + ids[starts], one * n + now))
        self.pairs, pair = np.unique(pairs, return_inverse=True)
        context = np.searchsorted(self.pairs, two * n + one)
        self.triples, triple = np.unique(context * n + now, return_inverse=True)
        self.tokens = [now.astype(np.int32), pair[n_docs:].astype(np.int32), triple.astype(np.int32)]
        self.n = n

    @classmethod
    def of_texts(cls, texts: pa.Array) -> Block:
        hashes, lengths = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
        for start, stop in slices(texts):
            h, bounds = word_hashes(texts.slice(start, stop - start), lower=True)
            hashes.append(h)
            lengths.append(np.diff(bounds) + 1)
        lengths = np.concatenate(lengths)
        line = np.full(int(lengths.sum()) + 2 * len(lengths), _BEGIN, dtype=np.uint64)
        starts = np.concatenate(([0], np.cumsum(lengths + 2)))[:-1].astype(np.int64)
        word = np.ones(len(line), dtype=bool)
        word[starts] = word[starts + 1] = word[starts + lengths + 1] = False
        line[starts + lengths + 1] = _END
        line[word] = np.concatenate(hashes)
        return cls(*np.unique(line, return_inverse=True), lengths)

    def state(self) -> tuple[bytes, bytes, bytes]:
        return pack_sorted(self.words), pack(self.ids), pack(self.lengths)

    @classmethod
    def of_state(cls, words: bytes, ids: bytes, lengths: bytes) -> Block:
        return cls(unpack_sorted(words), unpack(ids).astype(np.int64), unpack(lengths).astype(np.int64))

    def keys(self) -> list[np.ndarray]:
        """A hash for each distinct n-gram, by order."""
        n = self.n
        words = self.words
        first, second = words[self.pairs // n], words[self.pairs % n]
        pairs = mix(first * _JOIN + second + np.uint64(2))
        parent, last = self.triples // n, self.triples % n
        triples = mix((first[parent] * _JOIN + second[parent]) * _JOIN + words[last] + np.uint64(3))
        low = np.uint64(0xFFFF)
        return [mix(words + np.uint64(1)), pairs & ~low, triples & ~low]

    def counts(self, counted: np.ndarray) -> list[np.ndarray]:
        """Occurrences in the documents that are counted."""
        weight = np.repeat(counted, self.lengths)
        return [
            np.bincount(tokens[weight], minlength=size)
            for tokens, size in zip(self.tokens, (len(self.words), len(self.pairs), len(self.triples)))
        ]


_DROP = [0, 16, 16]


def _limits(shards: int) -> np.ndarray:
    """The first hash of every shard but the first."""
    return np.array([(i << 64) // shards for i in range(1, shards)], dtype=np.uint64)


def _blocks(batch: pa.RecordBatch, limit: int) -> Iterator[tuple[int, pa.RecordBatch, Block]]:
    """The blocks of a batch of documents, each with a number that follows from its ids and texts."""
    texts = filled(batch.column("text"))
    for start, stop in slices(texts, limit):
        part, own = batch.slice(start, stop - start), texts.slice(start, stop - start)
        offsets = np.frombuffer(own.buffers()[1], dtype=np.int64)[own.offset : own.offset + len(own) + 1]
        mark = xxhash.xxh64(repr(part.column("doc_id").to_pylist()).encode("ascii"))
        mark.update((offsets - offsets[0]).tobytes())
        if offsets[-1] > offsets[0]:
            mark.update(memoryview(own.buffers()[2])[offsets[0] : offsets[-1]])
        yield mark.intdigest() - (1 << 63), part, Block.of_texts(own)


def _requests(batches: Iterator[pa.RecordBatch], shards: int, limit: int) -> Iterator[pa.RecordBatch]:
    limits = _limits(shards)
    for batch in batches:
        for number, part, block in _blocks(batch, limit):
            counted = np.array(part.column("counted").to_pylist(), dtype=bool)
            rows: list[tuple] = []
            for order, (keys, counts) in enumerate(zip(block.keys(), block.counts(counted))):
                by = np.argsort(keys, kind="stable")
                keys, counts = keys[by], counts[by]
                cuts = [0, *np.searchsorted(keys, limits, side="left"), len(keys)]
                rows += [
                    (shard, number, order, pack_sorted(keys[a:b], _DROP[order]), pack(counts[a:b]))
                    for shard, (a, b) in enumerate(zip(cuts, cuts[1:]))
                ]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), _REQUEST)], schema=_REQUEST)


def _states(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for number, part, block in _blocks(batch, limit):
            row = (number, *block.state(), part.column("doc_id").to_pylist(), part.column("counted").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(row, _STATE)], schema=_STATE)


_REQUEST = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("ngram", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
_STATE = pa.schema(
    [("block", pa.int64()), ("words", pa.binary()), ("ids", pa.binary()), ("lengths", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("counted", pa.list_(pa.bool_()))]
)
_ANSWER = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("ngram", pa.int32()), ("counts", pa.binary()), ("tokens", pa.int64()), ("types", pa.int64())])


def _answers(table: pa.Table) -> pa.Table:
    """Add up a shard's counts; every request is answered in its own order."""
    shard = table.column("shard")[0].as_py()
    blocks, ngrams = table.column("block").to_pylist(), table.column("ngram").to_pylist()
    keys, counts = table.column("keys"), table.column("counts")
    rows: list[tuple] = []
    for order in range(ORDERS):
        chosen = [i for i, o in enumerate(ngrams) if o == order]
        asked = [unpack_sorted(keys[i].as_py(), _DROP[order]) for i in chosen]
        given = [unpack(counts[i].as_py()) for i in chosen]
        _, place = np.unique(np.concatenate(asked), return_inverse=True)
        sums = np.bincount(place, weights=np.concatenate(given).astype(np.float64)).astype(np.int64)
        tokens, types = (int(sums.sum()), int(np.count_nonzero(sums))) if order == 0 else (0, 0)
        at = 0
        for i, part in zip(chosen, asked):
            rows.append((blocks[i], shard, order, pack(sums[place[at : at + len(part)]]), tokens, types))
            at += len(part)
    return pa.Table.from_arrays([pa.array(c) for c in zip(*rows)], names=_ANSWER.names).cast(_ANSWER)


class Trie:
    """Levels of words, their successors, and the successors of pairs, memory-mapped from one file."""

    def __init__(self, path: Path, layout: dict, words: int) -> None:
        self._path, self._layout, self.words = path, layout, words

    def __getitem__(self, name: str):
        """An array of the file, or a sequence in Elias-Fano code."""
        if name in self._layout:
            kind, offset, length = self._layout[name]
            return np.memmap(self._path, dtype=kind, mode="r", offset=offset, shape=(length,)) if length else np.zeros(0, dtype=kind)
        size, low_bits = self._layout[name + ".size"]
        return EliasFano(size, low_bits, self[name + ".low"], self[name + ".high"], self[name + ".directory"])

    @classmethod
    def build(cls, path: Path, block: Block, counts: list[np.ndarray], tokens: int, types: int, mu: dict[int, float] = MU) -> Trie:
        """From a block's n-grams and their counts in the training documents."""
        n = block.n
        ones, twos, threes = (c.astype(np.float64) for c in counts)
        documents = float(ones[int(np.searchsorted(block.words, _END))]) if n else 0.0
        contexts = ones.copy()
        if n:
            contexts[block.begin] = documents
        p1 = (ones + 1.0) / (tokens + types + 1.0)
        first, second = block.pairs // n if n else block.pairs, block.pairs % n if n else block.pairs
        p2_all = (twos + mu[2] * p1[second]) / (contexts[first] + mu[2])
        # the marks' pair is the context of first words
        of_pair = twos.copy()
        if n:
            of_pair[np.searchsorted(block.pairs, block.begin * n + block.begin)] = documents
        parent, last = (block.triples // n, block.triples % n) if n else (block.triples, block.triples)
        shorter = np.searchsorted(block.pairs, second[parent] * n + last)
        p3_all = threes
        p3_all += mu[3] * p2_all[shorter]
        p3_all /= of_pair[parent] + mu[3]
        known3 = counts[2] > 0
        # nodes of the second level: seen pairs, and the marks' pair where there are documents
        level2 = np.flatnonzero((twos > 0) | ((of_pair > 0) & (first == second) & (first == block.begin)))
        node2 = np.full(len(block.pairs), -1, dtype=np.int64)
        node2[level2] = np.arange(len(level2))
        starts2 = np.searchsorted(first[level2], np.arange(n + 1))
        # a triple that only another's equal hash has counted is left out: its pairs are not there
        level3 = np.flatnonzero(known3 & (node2[parent] >= 0) & (node2[shorter] >= 0))
        parents3 = node2[parent[level3]]
        starts3 = np.searchsorted(parents3, np.arange(len(level2) + 1))
        relative = node2[shorter[level3]] - starts2[second[parent[level3]]]

        parts: dict[str, np.ndarray | EliasFano] = {
            "p1": _quantised(p1),
            "b1": _quantised(mu[2] / (contexts + mu[2])),
            "p2": _quantised(p2_all[level2]),
            "b2": _quantised(mu[3] / (of_pair[level2] + mu[3])),
            "p3": _quantised(p3_all[level3]),
            "starts2": EliasFano.encode(starts2),
            "starts3": EliasFano.encode(starts3),
            "next2": EliasFano.encode(_climbing(second[level2], starts2)),
            "next3": EliasFano.encode(_climbing(relative, starts3)),
        }
        layout: dict = {}
        with open(path, "wb") as f:
            for name, part in parts.items():
                arrays = {name: part}
                if isinstance(part, EliasFano):
                    layout[name + ".size"] = (part.size, part.low_bits)
                    arrays = {f"{name}.low": part.low, f"{name}.high": part.high, f"{name}.directory": part.directory}
                for key, array in arrays.items():
                    f.write(b"\0" * (-f.tell() % 8))
                    layout[key] = (array.dtype.str, f.tell(), len(array))
                    f.write(np.ascontiguousarray(array).tobytes())
        return cls(path, layout, n)

    def log10(self, first: np.ndarray, second: np.ndarray, third: np.ndarray) -> np.ndarray:
        """Log probabilities of third words after the two before them, all by their places among the words."""
        starts2, starts3 = self["starts2"].values().astype(np.int64), self["starts3"].values().astype(np.int64)
        next2, next3 = self["next2"].values(), self["next3"].values()
        shorter = _successors(next2, starts2, second, third)
        context = _successors(next2, starts2, first, second)
        del next2
        known = (context >= 0) & (shorter >= 0)
        found = np.full(len(third), -1, dtype=np.int64)
        found[known] = _successors(next3, starts3, context[known], shorter[known] - starts2[second[known]])
        del next3, starts3
        p1, b1, p2, b2, p3 = (self[name] for name in ("p1", "b1", "p2", "b2", "p3"))
        out = np.where(shorter >= 0, _taken(p2, shorter), p1[third].astype(np.int64) + b1[second])
        out = out + np.where(context >= 0, _taken(b2, context), 0)
        out = np.where(found >= 0, _taken(p3, found), out)
        return out / -STEP


def _taken(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Values at places, 0 for the place -1."""
    if not len(values):
        return np.zeros(len(at), dtype=np.int64)
    return np.where(at >= 0, values[np.maximum(at, 0)].astype(np.int64), 0)


def _quantised(p: np.ndarray) -> np.ndarray:
    return np.minimum(np.rint(-np.log10(p) * STEP), 65535).astype(np.uint16)


def _climbing(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Ascending runs made one ascending sequence: each run goes on above the last value of the one before."""
    if not len(values):
        return values.astype(np.uint64)
    return (values + np.repeat(_bases(values, starts), np.diff(starts))).astype(np.uint64)


def _bases(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """What every run is raised by: the sum of the last values before it, one more for each run."""
    lengths = np.diff(starts)
    lasts = np.where(lengths > 0, values[np.minimum(np.maximum(starts[1:] - 1, 0), len(values) - 1)] + 1, 0)
    return np.concatenate(([0], np.cumsum(lasts)[:-1]))


def _successors(sequence: np.ndarray, starts: np.ndarray, context: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The places of values among their contexts' successors, -1 where they are not."""
    if not len(sequence) or not len(context):
        return np.full(len(context), -1, dtype=np.int64)
    start, stop = starts[context], starts[context + 1]
    # a run is raised to just above the value before it
    base = np.where(start > 0, sequence[np.maximum(start - 1, 0)] + np.uint64(1), np.uint64(0))
    wanted = base + value.astype(np.uint64)
    place = np.searchsorted(sequence, wanted)
    hit = (place >= start) & (place < stop)
    hit &= sequence[np.minimum(place, len(sequence) - 1)] == wanted
    return np.where(hit, place, -1)


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
_SCORED = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
)


def _scores(states: pa.Table, answers: pa.Table) -> pa.Table:
    """Score the documents of a block; blocks that repeat each other have the same answers, once each."""
    made = [_score(state, answers) for state in states.to_pylist()]
    return pa.concat_tables(made) if made else _SCORED.empty_table()


def _score(state: dict, answers: pa.Table) -> pa.Table:
    block = Block.of_state(state["words"], state["ids"], state["lengths"])
    place = {(o, s): i for i, (o, s) in enumerate(zip(answers.column("ngram").to_pylist(), answers.column("shard").to_pylist()))}
    raw, sums, kinds = answers.column("counts"), answers.column("tokens"), answers.column("types")
    parts: list[list[np.ndarray]] = [[] for _ in range(ORDERS)]
    tokens = types = 0
    for (order, _), i in sorted(place.items()):
        parts[order].append(unpack(raw[i].as_py()))
        # a shard's sums stand in its answer to the single words, of which every block has one from each shard
        tokens, types = tokens + sums[i].as_py(), types + kinds[i].as_py()
    counts = []
    for keys, part in zip(block.keys(), parts):
        by = np.argsort(keys, kind="stable")
        found = np.empty(len(keys), dtype=np.int64)
        found[by] = np.concatenate(part).astype(np.int64)
        counts.append(found)
    n = block.n
    first, second, third = block.pairs[block.triples // n] // n, block.pairs[block.triples // n] % n, block.triples % n
    with tempfile.TemporaryDirectory() as folder:
        trie = Trie.build(Path(folder, "levels"), block, counts, tokens, types)
        by_triple = trie.log10(first, second, third)
    now, _, triple = block.tokens
    seen = counts[0][now]
    add = lambda values: np.add.reduceat(values, block.doc_starts)
    base = np.log10((seen + 1.0) / (tokens + types + 1.0))
    ids = pa.array(state["doc_ids"], type=pa.int64())
    return pa.Table.from_arrays(
        [
            ids,
            pa.array([not c for c in state["counted"]]),
            pa.array(block.lengths),
            pa.array(add((seen > 0).astype(np.int64))),
            pa.array(np.full(len(ids), tokens, dtype=np.int64)),
            pa.array(add(base)),
            pa.array(add(by_triple[triple])),
        ],
        schema=_SCORED,
    )


def training_row(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 != 2, F.lit(True))


def score_documents(docs: DataFrame, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Base and model log10 probabilities of every text, learned from the training rows."""
    spark = docs.sparkSession
    ship(spark)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // shard_bytes))
    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        training_row(F.col("doc_id")).alias("counted"),
    )
    states = read.mapInArrow(
        lambda batches: _states(batches, block_bytes),
        "block long, words binary, ids binary, lengths binary, doc_ids array<long>, counted array<boolean>",
    )
    requests = read.mapInArrow(
        lambda batches: _requests(batches, shards, block_bytes), "shard int, block long, ngram int, keys binary, counts binary"
    )
    answers = requests.groupBy("shard").applyInArrow(_answers, "block long, shard int, ngram int, counts binary, tokens long, types long")
    return states.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_scores, _SCORES)
