"""Exact n-gram Jaccard join: groups and numbers of documents linked by similar shingle sets.

Equal sets are one class, so copies never meet in pairs. Two different sets are similar only if they
share a token among their first ones in a common order (prefix filter) and their sizes are of the same
level or of neighbouring ones, powers of 100 / `share`. Lists are those of a token and two neighbouring
levels; a set of a short list joins only if it may be linked with another there, by their sizes and positions, if
the token is the first that they share: any linked sets meet in the list of that one. The order
puts tokens that many documents hold last, by a count in a table of fixed size over all documents.

Every list has a centre, the set with most copies, and the lists of a centre are one group. All sets of a
group are tried against each other in a task by their sketches: a bit for each of some classes of
shingles, set if the set holds an odd number of them. Two sets differ in as many shingles at least as their sketches
differ in bits, so no linked pair is lost, and unlike sets, which only share a passage, are told apart by
a fiftieth of their bytes. What may be linked is connected into families, which share no link.

All sets of a family are compared with each other in a task: they are read once, as their differences from
one of them, and matrix products give all their overlaps. The sets of a large group or family are dealt into
parts, and every two parts meet in a block. So any two sets that may be linked meet once, and a
text moves once unless its family is large. Blocks return the number of linked
rows per set, and a forest that connects what they link, not the links themselves.

`share` is in hundredths: sets link when 100 * overlap >= share * union. Rows without words have
an empty set, link with nothing and are their own component. Null ids: such a row shares the component
of its equal sets; a class that only has null ids links with no other, and its component is
null. `n_links` is the number of other rows that a row is linked with, its copies included. Rows are told apart by their sets, so repeated ids do no harm. Sets, tokens and shingles are
64-bit hashes; overlaps are counted on 40 bits of them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlake.llm.components import components
from marketlake.llm.memory import give_back
from marketlake.llm.packed import pack, pack_sorted, unpack, unpack_sorted
from marketlake.llm.rows import row_key, unused
from marketlake.llm.shipping import ship
from marketlake.llm.stored import stored
from marketlake.llm.words import filled, forget, shingle_sets

WIDTH = 4
SHARE = 85
CELLS = 1 << 20
CHUNK = 1 << 12
#: Entries of tokens above this class are not shuffled.
SPLIT_CLASS = 8
#: In lists of at most so many sets each set is tried against the others before it joins a group.
BESIDE = 32
#: Sets of one group, and cells of its table of differences.
GROUP = 2_000
GROUP_CELLS = 20_000_000
#: Columns of a matrix product, and rows of overlaps that are judged at once.
COLUMNS = 4_096
STRIP = 256
#: Least bits of a sketch.
SKETCH = 64
BROADCAST_ROWS = 300_000

_CELL_SHIFT = np.uint64(44)
_CLASS_BITS = np.uint64(63)
_DROP = 24


def _cells(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> _CELL_SHIFT).astype(np.int64)


def token_classes(texts: DataFrame, width: int = WIDTH) -> np.ndarray:
    """For each cell of the hash space how often its shingles occur, as a power of two of the median."""
    ship(texts.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, dtype=np.int64)
        for batch in batches:
            for shingles in shingle_sets(filled(batch.column(0)), width, lower=True):
                np.add.at(total, _cells(shingles), 1)
        parts = total.reshape(-1, CHUNK)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), type=pa.int32()), pa.array([pack(p) for p in parts])], names=["chunk", "counts"])
        batch = shingles = total = parts = None
        forget()
        give_back()

    def added(table: pa.Table) -> pa.Table:
        total = sum(unpack(raw.as_py()) for raw in table.column("counts"))
        return pa.Table.from_arrays([table.column("chunk").slice(0, 1), pa.array([pack(total)])], names=["chunk", "counts"])

    schema = "chunk int, counts binary"
    rows = texts.select("text").mapInArrow(counted, schema).groupBy("chunk").applyInArrow(added, schema).collect()
    total = np.zeros((CELLS // CHUNK, CHUNK), dtype=np.int64)
    for chunk, counts in rows:
        total[chunk] = unpack(bytes(counts)).astype(np.int64)
    total = total.reshape(-1)
    median = max(1.0, float(np.median(total)))
    return np.clip(np.floor(np.log2(np.maximum(total / median, 1.0))), 0, 63).astype(np.uint8)


def set_id(shingles: np.ndarray) -> int | None:
    """One number for a set, None for the empty set."""
    return xxhash.xxh64_intdigest(shingles.tobytes(), len(shingles)) - (1 << 63) if len(shingles) else None


def prefix(shingles: np.ndarray, classes: np.ndarray, share: int = SHARE) -> np.ndarray:
    """The first tokens of a set in the common order, so many that similar sets share one; the class is in the low bits."""
    size = len(shingles)
    length = size - -(-share * size // 100) + 1 if size else 0
    tokens = (shingles & ~_CLASS_BITS) | classes[_cells(shingles)].astype(np.uint64)
    return tokens[np.lexsort((shingles, tokens & _CLASS_BITS))][:length].view(np.int64)


def sketch(shingles: np.ndarray, share: int = SHARE) -> bytes:
    """A bit for each class of shingles, set if the set holds an odd number of them.

    So many bits that unlike sets differ in more of them than linked sets in shingles.
    """
    bits = max(SKETCH, 1 << (8 * (100 - share) * len(shingles) // (100 + share)).bit_length())
    counts = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def _sets(texts: DataFrame, width: int, share: int, classes: np.ndarray | None = None) -> DataFrame:
    """(doc_id, n_shingles, set) for every row, and with token classes also its first tokens and its sketch."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ids, tokens, sketches = [], [], [], []
            for shingles in shingle_sets(filled(batch.column("text")), width, lower=True):
                sizes.append(len(shingles))
                ids.append(set_id(shingles))
                if classes is not None:
                    tokens.append(prefix(shingles, classes, share))
                    sketches.append(sketch(shingles, share))
            columns = {"doc_id": batch.column("doc_id"), "n_shingles": pa.array(sizes, type=pa.int64()), "set": pa.array(ids, type=pa.int64())}
            if classes is not None:
                columns["tokens"] = pa.array(tokens, type=pa.list_(pa.int64()))
                columns["sketch"] = pa.array(sketches, type=pa.binary())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
        batch = shingles = columns = sizes = ids = tokens = sketches = None
        forget()
        give_back()

    return texts.mapInArrow(made, "doc_id long, n_shingles long, set long" + ("" if classes is None else ", tokens array<long>, sketch binary"))


def _contents(texts: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(set, content) of the sets in `wanted` (set, rep), read again from the texts of their first rows."""
    ids = wanted.select(F.col("rep").alias("doc_id"), F.col("set").alias("wanted"))
    chosen = texts.join(F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids, "doc_id")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, contents = [], []
            for expected, shingles in zip(batch.column("wanted").to_pylist(), shingle_sets(filled(batch.column("text")), width, lower=True)):
                if set_id(shingles) == expected:
                    sets.append(expected)
                    contents.append(pack_sorted(np.unique(shingles >> np.uint64(_DROP))))
            yield pa.RecordBatch.from_arrays([pa.array(sets, type=pa.int64()), pa.array(contents, type=pa.binary())], names=["set", "content"])
        batch = shingles = sets = contents = None
        forget()
        give_back()

    return chosen.select("wanted", "text").mapInArrow(made, "set long, content binary")


def _sizes_fit(n: Column, other_n: Column, share: int) -> Column:
    return 100 * F.least(n, other_n) >= share * F.greatest(n, other_n)


def _most(n: Column, pos: Column, other_n: Column, other_pos: Column) -> Column:
    """The largest overlap of two sets whose first shared token is at these positions."""
    return F.least(n - pos, other_n - other_pos)


def _enough(overlap: Column, n: Column, other_n: Column, share: int) -> Column:
    return (100 + share) * overlap >= share * (n + other_n)


def _tidy(work: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """Return the memory of large blocks, since a worker goes on to other stages."""

    def tidied(table: pa.Table) -> pa.Table:
        found = work(table)
        if table.num_rows > STRIP:
            give_back()
        return found

    return tidied


def _trial(share: int):
    """Connect those sets of a block that may be linked, by their sketches."""

    def tried(table: pa.Table) -> pa.Table:
        names, low, high, side, sizes = (table.column(c).to_numpy() for c in ("set", "low", "high", "side", "n"))
        near = _alike([np.frombuffer(s.as_py(), dtype=np.uint8) for s in table.column("sketch")], sizes.astype(np.float64), share)
        near = _met(near, side, low[0] != high[0])
        at = np.flatnonzero(near.any(axis=0))
        found = [(names[at[i]], names[at[j]]) for i, j in _forest(near[np.ix_(at, at)])]
        return pa.Table.from_arrays([pa.array([x[i] for x in found], type=pa.int64()) for i in range(2)], names=["a", "b"])

    return tried


def _block(share: int):
    """Count the links of a block's sets, and connect what they link."""

    def compared(table: pa.Table) -> pa.Table:
        # a set comes more than once where rows repeat its first id and text
        names, at = np.unique(table.column("set").to_numpy(), return_index=True)
        low, high, side, copies = (table.column(c).to_numpy()[at] for c in ("low", "high", "side", "copies"))
        raw = table.column("content")
        core = unpack_sorted(raw[int(at[np.argmax(copies)])].as_py())
        near = _met(_near(core, (unpack_sorted(raw[int(i)].as_py()) for i in at), len(at), share), side, low[0] != high[0])
        kept = np.flatnonzero(near.any(axis=0))
        near, names, copies = near[np.ix_(kept, kept)], names[kept], copies[kept]
        links = [(name, name, int(copies[others].sum())) for name, others in zip(names, near)]
        links += [(names[i], names[j], 0) for i, j in _forest(near)]
        return pa.Table.from_arrays([pa.array([x[i] for x in links], type=pa.int64()) for i in range(3)], names=["a", "b", "n"])

    return compared


def _met(near: np.ndarray, side: np.ndarray, two: bool) -> np.ndarray:
    """Without what a block does not compare: a set with itself, and in blocks of two parts, those of one part."""
    np.fill_diagonal(near, False)
    if two:
        near &= side[:, None] != side[None, :]
    return near


def _reach(overlap: np.ndarray, ours: np.ndarray, theirs: np.ndarray, share: int) -> np.ndarray:
    """Where overlaps are large enough for sets of these sizes."""
    found = np.empty(overlap.shape, dtype=bool)
    for start in range(0, len(ours), STRIP):
        rows = slice(start, start + STRIP)
        found[rows] = (100 + share) * overlap[rows].astype(np.float64) >= share * (ours[rows, None] + theirs)
    return found


def _alike(sketches: list[np.ndarray], sizes: np.ndarray, share: int) -> np.ndarray:
    """Which sets may be linked; sketches of several widths meet in the narrower one, whose bits are sums of the wider one's."""
    near = np.zeros((len(sketches), len(sketches)), dtype=bool)
    widths = np.array([len(s) for s in sketches])
    for width in np.unique(widths):
        at = np.flatnonzero(widths >= width)
        folded = np.stack([np.bitwise_xor.reduce(sketches[i].reshape(-1, width), axis=0) for i in at])
        ours = np.flatnonzero(widths[at] == width)
        # the most that two sets share: half of what their sizes leave when they differ in that many shingles
        most = np.minimum(sizes[at[ours], None], sizes[at]).astype(np.float32)
        apart = np.zeros(most.shape, dtype=np.float32)
        for start in range(0, width, COLUMNS // 8):
            bits = np.unpackbits(folded[:, start : start + COLUMNS // 8], axis=1).astype(np.float32)
            held = bits.sum(axis=1)
            apart += held[ours, None] + held - 2.0 * (bits[ours] @ bits.T)
        for start in range(0, len(ours), STRIP):
            rows = slice(start, start + STRIP)
            most[rows] = np.minimum(most[rows], (sizes[at[ours[rows]], None] + sizes[at] - apart[rows]) / 2)
        fits = _reach(most, sizes[at[ours]], sizes[at], share)
        near[np.ix_(at[ours], at)] = fits
        near[np.ix_(at, at[ours])] = fits.T
    return near


def _shared(rows: np.ndarray, tokens: np.ndarray, n: int) -> np.ndarray:
    """How many tokens every two of `n` rows share."""
    overlap = np.zeros((n, n), dtype=np.float32)
    _, column, times = np.unique(tokens, return_inverse=True, return_counts=True)
    common = times[column] > 1
    order = np.argsort(column[common], kind="stable")
    rows, column = rows[common][order], column[common][order]
    _, column = np.unique(column, return_inverse=True)
    width = int(column[-1]) + 1 if len(column) else 0
    for start in range(0, width, COLUMNS):
        low, high = np.searchsorted(column, [start, start + COLUMNS])
        part = np.zeros((n, min(COLUMNS, width - start)), dtype=np.float32)
        part[rows[low:high], column[low:high] - start] = 1.0
        overlap += part @ part.T
    return overlap


def _near(core: np.ndarray, sets: Iterable[np.ndarray], n: int, share: int) -> np.ndarray:
    """Which of `n` sets are linked."""
    sizes, gained = np.zeros(n, dtype=np.float64), []
    held = np.zeros((n, len(core)), dtype=bool)
    for i, content in enumerate(sets):
        sizes[i] = len(content)
        place = np.minimum(np.searchsorted(core, content), len(core) - 1)
        inside = core[place] == content
        held[i, place[inside]] = True
        gained.append(content[~inside])
    overlap = _shared(np.repeat(np.arange(n), [len(g) for g in gained]), np.concatenate(gained), n)
    for start in range(0, len(core), COLUMNS):
        part = held[:, start : start + COLUMNS].astype(np.float32)
        overlap += part @ part.T
    return _reach(overlap, sizes, sizes, share)


def _forest(near: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of places that connect all linked sets."""
    found, waiting = [], np.ones(len(near), dtype=bool)
    for first in range(len(near)):
        if not waiting[first]:
            continue
        waiting[first] = False
        edge = np.array([first])
        while len(edge):
            edge = np.flatnonzero(near[edge].any(axis=0) & waiting)
            waiting[edge] = False
            found += [(first, int(i)) for i in edge]
    return found


def _bounded(frame: DataFrame) -> DataFrame:
    return F.broadcast(frame) if frame.count() <= BROADCAST_ROWS else frame


def _listed(classes: DataFrame, share: int) -> DataFrame:
    """(centre, set) of every set in a list with others, the centre included."""
    # a little less than whole levels, so that rounding cannot set linked sizes two levels apart
    level = F.floor(F.log(F.col("n").cast("double")) / (math.log(100 / share) + 1e-9))
    entries = classes.select("set", "n", "copies", F.posexplode("tokens").alias("pos", "token"))
    both = F.explode(F.array(level, level + 1)).alias("level")
    row = F.struct("copies", "set", "n", "pos")
    often = F.col("token").bitwiseAND(63) > SPLIT_CLASS

    def kept(lists: DataFrame) -> DataFrame:
        ours, theirs = ("top.n", "top.pos"), ("low.n", "low.pos")
        room = _enough(_most(*map(F.col, ours + theirs)), F.col("top.n"), F.col("low.n"), share)
        fits = _sizes_fit(F.col("top.n"), F.col("low.n"), share) & room
        return lists.where((F.col("sets") > 2) | ((F.col("sets") == 2) & fits))

    # short lists move once, as they are
    alone, of_list = Window.partitionBy("token"), Window.partitionBy("token", "level")
    short = entries.where(~often).withColumn("sets", F.count(F.lit(1)).over(alone)).where(F.col("sets") > 1).select("*", both)
    short = short.withColumn("sets", F.count(F.lit(1)).over(of_list)).where(F.col("sets") > 1)
    short = kept(short.withColumn("top", F.max(row).over(of_list)).withColumn("low", F.min(row).over(of_list)))
    # of other lists a set needs one with which this may be the first shared token
    beside = F.when(F.col("sets") <= BESIDE, F.collect_list(F.struct("set", "n", "pos")).over(of_list))

    def may_link(other: Column) -> Column:
        most = _most(F.col("n"), F.col("pos"), other["n"], other["pos"])
        return (other["set"] != F.col("set")) & _sizes_fit(F.col("n"), other["n"], share) & _enough(most, F.col("n"), other["n"], share)

    short = short.withColumn("beside", beside).where(F.col("beside").isNull() | F.exists("beside", may_link))
    # long ones, which are few, are only counted
    long = entries.where(often).select("*", both)
    lists = long.groupBy("token", "level").agg(F.count(F.lit(1)).alias("sets"), F.max(row).alias("top"), F.min(row).alias("low"))
    lists = stored(kept(lists).select("token", "level", F.col("top.set").alias("centre")), "jaccard_lists")
    found = long.select("token", "level", "set").join(_bounded(lists), ["token", "level"])
    return short.select(F.col("top.set").alias("centre"), "set").unionByName(found.select("centre", "set")).distinct()


def _blocks(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """(centre, low, high, side, set): groups as blocks of two parts, or of one part with itself. `sizes` has n by centre."""
    sized = pairs.groupBy("centre").agg(F.count(F.lit(1)).alias("sets")).join(sizes, "centre")
    room = F.least(F.lit(GROUP), F.greatest(F.lit(min(50, GROUP)), F.floor(F.lit(GROUP_CELLS) / F.col("n"))))
    # a block of two parts has no more sets than a whole group may have
    groups = F.when(F.col("sets") <= room, F.lit(1)).otherwise(F.ceil(2 * F.col("sets") / room)).cast("long")
    centres = stored(sized.select("centre", groups.alias("groups")), "jaccard_centres")
    dealt = pairs.join(_bounded(centres), "centre").withColumn("side", F.pmod(F.xxhash64("set"), F.col("groups")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)))
    return dealt.select("centre", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "set")


def linked(docs: DataFrame, width: int = WIDTH, share: int = SHARE) -> DataFrame:
    """doc_id, n_shingles, component_id and n_links of every row."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cells = token_classes(texts, width)
    classes = stored(
        _sets(texts, width, share, cells)
        .where(F.col("set").isNotNull())
        .groupBy("set")
        .agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.max("n_shingles").alias("n"), F.first("tokens").alias("tokens"), F.first("sketch").alias("sketch")),
        "jaccard_classes",
    )
    block = ["centre", "low", "high"]
    pairs = stored(_listed(classes, share), "jaccard_pairs")
    trials = stored(_blocks(pairs, classes.select(F.col("set").alias("centre"), "n")), "jaccard_trials")
    trials = trials.join(classes.where(F.col("rep").isNotNull()).select("set", "n", "sketch"), "set")
    maybe = stored(trials.groupBy(*block).applyInArrow(_tidy(_trial(share)), "a long, b long"), "jaccard_maybe")
    families = components(maybe).select(F.col("component").alias("centre"), F.col("node").alias("set"))
    wanted = stored(families.join(classes.select("set", "rep", "copies", "n"), "set"), "jaccard_wanted")
    blocks = _blocks(wanted.select("centre", "set"), wanted.groupBy("centre").agg(F.max("n").alias("n")))
    blocks = stored(blocks.join(wanted.select("set", "copies"), "set"), "jaccard_blocks")
    compared = _contents(texts, wanted.select("set", "rep"), width).join(_bounded(blocks), "set")
    links = stored(compared.groupBy(*block).applyInArrow(_tidy(_block(share)), "a long, b long, n long"), "jaccard_links")
    labels = components(links.where("a != b").select("a", "b"))
    counts = links.where("a = b").groupBy(F.col("a").alias("set")).agg(F.sum("n").alias("others"))
    named = labels.join(classes.select(F.col("set").alias("node"), "rep"), "node")
    smallest = named.groupBy("component").agg(F.min("rep").alias("least"))
    known = named.join(smallest, "component").select(F.col("node").alias("set"), F.col("least"))
    own = classes.select("set", "rep", "copies").join(known, "set", "left").join(counts, "set", "left")
    n_links = (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")
    own = stored(own.select("set", F.coalesce("least", "rep").alias("component_id"), n_links), "jaccard_named")
    return (
        _sets(texts, width, share)
        .join(own, "set", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("set").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        )
    )


def one_of_each(docs: DataFrame, width: int = WIDTH, share: int = SHARE) -> DataFrame:
    """One row of every component, of the smallest doc_id, with all its columns; rows without words stay.

    Rows are decided by id and text: a null id comes after all others, of rows that repeat both one stays, and
    of two texts under one id each is decided by itself.
    """
    key = unused(docs.columns, "row_key")
    keyed = docs.withColumn(key, row_key("doc_id", "text"))
    keys = keyed.select(F.col(key).alias("doc_id"), "text")
    found = linked(keys, width, share).where(F.col("n_shingles") > 0).groupBy("doc_id").agg(F.first("component_id").alias("component"), F.count(F.lit(1)).alias("rows"))
    found = stored(found.select(F.col("doc_id").alias("key"), "component", "rows"), "jaccard_rows")
    ids = keyed.select(F.col(key).alias("key"), F.col("doc_id").cast("long").alias("id")).distinct()
    first = F.min(F.struct(F.col("id").isNull(), "id", "key"))["key"]
    chosen = found.join(ids, "key").groupBy("component").agg(first.alias("key"))
    gone = stored(found.join(chosen, "key", "left_anti").select(F.col("key").alias(key + "_")), "jaccard_gone")
    left = keyed.join(_bounded(gone), F.col(key) == F.col(key + "_"), "left_anti")
    repeated = stored(found.where("rows > 1").join(chosen, "key", "left_semi").select(F.col("key").alias(key + "_")), "jaccard_repeated")
    marked = left.join(_bounded(repeated), F.col(key) == F.col(key + "_"), "left")
    once = marked.where(F.col(key + "_").isNotNull()).dropDuplicates([key])
    return marked.where(F.col(key + "_").isNull()).unionByName(once).select(*docs.columns)
