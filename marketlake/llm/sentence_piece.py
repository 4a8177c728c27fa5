"""Sentence-piece encoding that keeps, for every piece, the bytes of the text that it came from.

**Normalising.** The model file holds a compiled character map: a double-array trie over bytes, whose
values point at replacements. At each place of a text the longest key of the map that begins there is
replaced; elsewhere one character is copied. Every character of the normalised text remembers the byte
of the source at which its replacement began (`Normalised.source`). White space becomes a mark, and a
mark goes before the text, as the model's settings say. An empty map copies everything, so the places
follow from the lengths of the pieces and need no table.

**Encoding.** The normalised text is cut before marks that follow another symbol, which no piece
crosses, and merged by the pieces' scores, best first and from the left among equals. Symbols that
are no piece are spelled in byte pieces. The spans are projected back through `source`: neighbouring
pieces meet, the first begins at byte 0 and the last ends with the text, so that nothing of the text is
lost. Of a symbol spelled in bytes the last byte has the span, as in the library.

Null and empty texts have only the begin and end ids. Ids outside the vocabulary are refused.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType

from marketlake.llm.shipping import ship

MARK = "▁"
#: Bytes of remembered words and their ids, counted with `ENTRY` for each one's objects.
CACHE_BYTES = 48 << 20
ENTRY = 160
#: Longer runs are merged by a heap, and not remembered.
SHORT = 64

#: Characters of texts whose new words are merged together.
TOGETHER = 1 << 21

#: Fixed: kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)

# A byte that is no UTF-8 at its place gives one replacement character.
codecs.register_error("each_byte", lambda e: ("�", e.start + 1))


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol-buffer message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = raw[at]
            value |= (byte & 0x7F) << shift
            at, shift = at + 1, shift + 7
            if byte < 0x80:
                return value, at

    at = 0
    while at < len(raw):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        else:
            size = {1: 8, 5: 4}.get(kind)
            if size is None:
                size, at = varint(at)
            value, at = raw[at : at + size], at + size
        yield key >> 3, value


class CharacterMap:
    """A compiled map: the size of the trie, its units of 32 bits, and replacements that end in NUL."""

    def __init__(self, raw: bytes) -> None:
        size = struct.unpack_from("<I", raw)[0] if raw else 0
        self.units: list[int] = np.frombuffer(raw, dtype="<u4", count=size // 4, offset=4).tolist() if raw else []
        self.replacements = raw[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, str] | None:
        """Length in bytes of the longest key that begins at a byte, and what replaces it."""
        units = self.units
        if not units:
            return None
        found = None
        node = self._offset(units[0])
        for place in range(at, len(data)):
            byte = data[place]
            node ^= byte
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != byte:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = (place + 1 - at, units[node] & 0x7FFFFFFF)
        if found is None:
            return None
        length, start = found
        return length, self.replacements[start : self.replacements.index(b"\0", start)].decode("utf-8")

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)


class Normalised(NamedTuple):
    """`source[i]` is the byte of the text that character i came from; one more entry ends the text. It is
    None where all characters are copied: then the lengths say it."""

    text: str
    source: list[int] | None


class Settings(NamedTuple):
    dummy_prefix: bool = True
    remove_extra: bool = True
    escape: bool = True


class Normaliser:
    def __init__(self, charsmap: bytes, settings: Settings) -> None:
        self.map, self.settings = CharacterMap(charsmap), settings
        self.space = MARK if settings.escape else " "

    def normalise(self, text: str) -> Normalised:
        """An empty text gets no mark."""
        if self.map.units or self.settings.remove_extra or not self.settings.escape or MARK in text:
            return self.traced(text)
        return Normalised(MARK * (bool(text) and self.settings.dummy_prefix) + text.replace(" ", MARK), None)

    def _parts(self, text: str) -> Iterator[tuple[int, int, str]]:
        """Where a key or character begins, where it ends, and what stands for it."""
        data, at = text.encode("utf-8"), 0
        known: dict[bytes, str] = {}
        while at < len(data):
            found = self.map.longest(data, at)
            if found is None:
                lead = data[at]
                stop = at + (1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4)
                raw = data[at:stop]
                part = known.get(raw)
                if part is None:
                    part = known[raw] = raw.decode("utf-8")
            else:
                stop, part = at + found[0], found[1]
            yield at, stop, part
            at = stop

    def traced(self, text: str) -> Normalised:
        """Key by key, with the source of every character."""
        out: list[str] = []
        source: list[int] = []
        dummy, remove, _ = self.settings
        after_space = leading = remove
        end = 0
        for at, stop, part in self._parts(text):
            end = stop
            if leading and part == " ":
                continue
            if not out and (leading or not remove) and dummy:
                out.append(self.space)
                source.append(at)
                dummy = False
            leading = False
            kept = part.lstrip(" ") if after_space else part
            for c in kept:
                out.append(self.space if c == " " else c)
                source.append(at)
            if kept:
                after_space = remove and kept.endswith(" ")
        if remove:
            while out and out[-1] == self.space:
                out.pop()
                end = source.pop()
        if not out:
            end = 0
        return Normalised("".join(out), [*source, end])


class SentencePieces:
    """A byte-pair model file of the sentence-piece kind with byte pieces for unknown symbols."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            model = list(_fields(f.read()))
        pieces = [self._piece(raw) for field, raw in model if field == 1]
        trainer = dict(_fields(next((raw for field, raw in model if field == 2), b"")))
        normal = dict(_fields(next((raw for field, raw in model if field == 3), b"")))
        settings = Settings(*(bool(normal.get(n, 1)) for n in (3, 4, 5)))
        self.normaliser = Normaliser(normal.get(2, b""), settings)
        self.begin, self.end = trainer.get(41, 1), trainer.get(42, 2)
        kinds = {kind for _, _, kind in pieces}
        if trainer.get(3, 1) != 2 or BYTE not in kinds or trainer.get(24):
            raise ValueError("only byte-pair models with byte pieces and leading marks are read")
        if kinds & {USER_DEFINED, UNUSED}:
            raise ValueError("user-defined and unused pieces are not read")
        self.ids = {piece: i for i, (piece, _, kind) in enumerate(pieces) if kind == NORMAL}
        scores = {score: n for n, score in enumerate(sorted({s for _, s, k in pieces if k == NORMAL}, reverse=True))}
        self.rank = {piece: scores[score] for piece, score, kind in pieces if kind == NORMAL}
        self.bytes = [b""] * 256
        self.labels: list[bytes] = []
        lengths = []
        for i, (piece, _, kind) in enumerate(pieces):
            label = b""
            if kind == NORMAL:
                label = piece.replace(MARK, " ").encode("utf-8")
            elif kind == BYTE:
                value = int(piece[3:5], 16)
                self.bytes[value] = struct.pack("<I", i)
                label = bytes([value])
            elif kind == UNKNOWN:
                label = trainer.get(44, " ⁇ ".encode()) if isinstance(trainer.get(44, b""), bytes) else b""
                label = label or " ⁇ ".encode()
            self.labels.append(label)
            lengths.append(len(label) if kind in (NORMAL, BYTE) else 0)
        #: Bytes of the source that a piece stands for, where all is copied.
        self.lengths = np.array(lengths, dtype=np.int64)
        self.is_byte = np.array([kind == BYTE for _, _, kind in pieces])
        self.control = {i for i, (_, _, kind) in enumerate(pieces) if kind == CONTROL}
        crossing = re.compile(f"[^{MARK}]{MARK}").search
        if any(map(crossing, self.ids)):
            raise ValueError("the vocabulary has pieces over a word border")
        apart = "" if any("\n" in piece for piece in self.ids) else "\n"
        self._cut = re.compile(f"{MARK}+[^{MARK}{apart}]*|[^{MARK}{apart}]+" + ("|\n" if apart else "")).findall
        self._known: dict[str, bytes] = {}
        self._before: dict[str, bytes] = {}
        self._held = 0
        self._tabulate()

    def _tabulate(self) -> None:
        """Tables by piece ids: single symbols, and for pairs of pieces the rank and the id of what they make."""
        none = len(self.rank)
        self._symbol = np.full(0x110000, -1, dtype=np.int32)
        pairs: dict[int, tuple[int, int]] = {}
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self._symbol[ord(piece)] = i
            for n in range(1, len(piece)):
                left, right = self.ids.get(piece[:n]), self.ids.get(piece[n:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = (self.rank[piece], i)
        ordered = sorted(pairs)
        self._pairs = np.array([*ordered, 1 << 62], dtype=np.int64)
        self._pair_rank = np.array([*(pairs[k][0] for k in ordered), none], dtype=np.int64)
        self._pair_made = np.array([*(pairs[k][1] for k in ordered), 0], dtype=np.int32)
        self._none = none

    def _met(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of pairs and what they make."""
        keys = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self._pairs, keys)
        hit = self._pairs[at] == keys
        return np.where(hit, self._pair_rank[at], self._none), self._pair_made[at]

    @staticmethod
    def _piece(raw: bytes) -> tuple[str, float, int]:
        fields = dict(_fields(raw))
        score = fields.get(2)
        return fields[1].decode("utf-8"), struct.unpack("<f", score)[0] if score else 0.0, fields.get(3, NORMAL)

    def merge(self, run: str) -> list[str]:
        """The symbols of a run after all merges."""
        if len(run) > SHORT:
            return self._merge_long(run)
        rank, none = self.rank.get, len(self.rank)
        parts = list(run)
        ranks = [rank(a + b, none) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            joined = parts[i] + parts[i + 1]
            parts[i : i + 2] = [joined]
            del ranks[i]
            if i:
                ranks[i - 1] = rank(parts[i - 1] + joined, none)
            if i < len(ranks):
                ranks[i] = rank(joined + parts[i + 1], none)
        return parts

    def _merge_long(self, run: str) -> list[str]:
        """The same with a heap over linked symbols, for runs without a bound on their length."""
        rank, size = self.rank.get, len(run)
        parts: list[str | None] = list(run)
        before, after = list(range(-1, size - 1)), list(range(1, size + 1))
        heap: list[tuple[int, int, int]] = []

        def offer(left: int) -> None:
            right = after[left]
            if right < size:
                found = rank(parts[left] + parts[right])
                if found is not None:
                    heap.append((found, left, len(parts[left]) + len(parts[right])))

        for left in range(size - 1):
            offer(left)
        heapq.heapify(heap)
        while heap:
            _, left, length = heapq.heappop(heap)
            if parts[left] is None:
                continue
            right = after[left]
            if right >= size or len(parts[left]) + len(parts[right]) != length:
                continue
            parts[left] += parts[right]
            parts[right] = None
            after[left] = after[right]
            if after[right] < size:
                before[after[right]] = left
            for start in (before[left], left):
                if start >= 0:
                    found = len(heap)
                    offer(start)
                    if len(heap) > found:
                        heapq._siftdown(heap, 0, found)
        return [p for p in parts if p is not None]

    def merge_many(self, runs: list[str]) -> Iterator[tuple[str, bytes]]:
        """Runs of known symbols with their ids, 32 bits each: in every round each run makes its best merge."""
        symbols = np.frombuffer("".join(runs).encode("utf-32-le"), dtype="<u4")
        parts = self._symbol[symbols]
        sizes = np.fromiter(map(len, runs), dtype=np.int64, count=len(runs))
        starts = np.cumsum(sizes) - sizes
        names = np.arange(len(runs))
        ranks, made = self._met(parts, np.append(parts[1:], -1))
        ranks[starts + sizes - 1] = self._none
        while len(names):
            least = np.minimum.reduceat(ranks, starts)
            done = least == self._none
            if done.any():
                rest = np.repeat(~done, sizes)
                raw, at = parts[~rest].astype("<u4").tobytes(), 0
                for name, size in zip(names[done].tolist(), sizes[done].tolist()):
                    yield runs[name], raw[at : at + 4 * size]
                    at += 4 * size
                parts, ranks, made = parts[rest], ranks[rest], made[rest]
                names, sizes, least = names[~done], sizes[~done], least[~done]
                starts = np.cumsum(sizes) - sizes
                if not len(names):
                    return
            owner = np.repeat(np.arange(len(names)), sizes)
            best = np.flatnonzero(ranks == least[owner])
            best = best[np.append(True, np.diff(owner[best]) > 0)]
            parts[best] = made[best]
            kept = np.ones(len(parts), dtype=bool)
            kept[best + 1] = False
            parts, ranks, made = parts[kept], ranks[kept], made[kept]
            moved = np.arange(len(names))
            best, starts, sizes = best - moved, starts - moved, sizes - 1
            ends = starts + sizes - 1
            open_right, open_left = best < ends, best > starts
            ranks[best[~open_right]] = self._none
            for at in (best[open_right], best[open_left] - 1):
                ranks[at], made[at] = self._met(parts[at], parts[at + 1])

    def prepare(self, runs: set[str]) -> None:
        """Merge and remember the new short runs among those of many texts."""
        if self._held > CACHE_BYTES // 2:
            self._before, self._known, self._held = self._known, {}, 0
        symbol, before = self._symbol, self._before
        new, known = [], []
        for run in runs - self._known.keys():
            if run in before:
                self._remember(run, before[run])
            elif len(run) <= SHORT:
                new.append(run)
        if new:
            sizes = np.fromiter(map(len, new), dtype=np.int64, count=len(new))
            strange = symbol[np.frombuffer("".join(new).encode("utf-32-le"), dtype="<u4")] < 0
            plain = np.add.reduceat(strange, np.cumsum(sizes) - sizes) == 0
            known = [r for r, fine in zip(new, plain.tolist()) if fine]
        for run, found in self.merge_many(known) if known else ():
            self._remember(run, found)

    def _remember(self, run: str, found: bytes) -> None:
        self._known[run] = found
        self._held += ENTRY + len(run) + len(found)

    def _run(self, run: str) -> bytes:
        """The ids of a run, 32 bits each."""
        ids, out = self.ids, []
        for piece in self.merge(run):
            known = ids.get(piece)
            if known is not None:
                out.append(struct.pack("<I", known))
            else:
                out.extend(self.bytes[b] for b in piece.encode("utf-8"))
        found = b"".join(out)
        if len(run) <= SHORT:
            self._remember(run, found)
        return found

    def _found(self, run: str) -> bytes:
        return self._known.get(run) or self._before.get(run) or self._run(run)

    def _encoded(self, runs: list[str]) -> bytes:
        known = self._known
        try:
            return b"".join([known[r] for r in runs])
        except KeyError:
            return b"".join(map(self._found, runs))

    def encode_all(self, texts: list[str]) -> Iterator[tuple[bytes, np.ndarray]]:
        """`encode` for each of many texts; what they have in common is merged once, together."""
        start = 0
        while start < len(texts):
            stop, size, cut = start, 0, []
            while stop < len(texts) and size < TOGETHER:
                normalised = self.normaliser.normalise(texts[stop])
                cut.append((normalised, self._cut(normalised.text)))
                size += len(texts[stop])
                stop += 1
            self.prepare(set(chain.from_iterable(runs for _, runs in cut)))
            for normalised, runs in cut:
                raw = self._encoded(runs)
                yield raw, self._ends(normalised, np.frombuffer(raw, dtype="<u4"))
            start = stop

    def encode(self, text: str) -> tuple[bytes, np.ndarray]:
        """The ids, 32 bits each, without begin and end; and the byte of the text at which each piece ends."""
        return next(self.encode_all([text]))

    def _ends(self, normalised: Normalised, ids: np.ndarray) -> np.ndarray:
        if normalised.source is not None:
            return self._projected(normalised, ids)
        ends = np.cumsum(self.lengths[ids])
        if len(ends) and self.normaliser.settings.dummy_prefix:
            ends -= 1
        return self._whole_symbols(ids, ends)

    def _whole_symbols(self, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Bytes inside a symbol end where it begins; its last byte has all of it."""
        at = np.flatnonzero(self.is_byte[ids])
        if not len(at):
            return ends
        value = np.array([self.labels[i][0] for i in ids[at]], dtype=np.uint8)
        goes_on = (value & 0xC0) == 0x80
        leads = np.flatnonzero(~goes_on)
        first = leads[np.cumsum(~goes_on) - 1]
        last = np.append(~goes_on[1:], True)
        out = ends.copy()
        inside = ~last
        out[at[inside]] = ends[at[first[inside]]] - 1
        return out

    def _projected(self, normalised: Normalised, ids: np.ndarray) -> np.ndarray:
        """Ends of pieces through the source of every normalised character."""
        text, source = normalised
        ends = np.empty(len(ids), dtype=np.int64)
        place = left = 0
        for n, i in enumerate(ids.tolist()):
            label = self.labels[i]
            if not self.is_byte[i]:
                place += len(label.decode("utf-8"))
            elif left:
                left -= 1
                place += not left
            else:
                left = len(text[place].encode("utf-8")) - 1
                place += not left
            ends[n] = source[place]
        return ends

    def decode(self, ids: list[int] | np.ndarray) -> str:
        """Labels joined; begin and end ids say nothing, and the space of the mark before the text goes."""
        labels = self.labels
        text = b"".join([labels[i] for i in ids]).decode("utf-8", errors="each_byte")
        if self.normaliser.settings.dummy_prefix:
            first = next((i for i in ids if i not in self.control), None)
            if first is not None and labels[first][:1] == b" " and not self.is_byte[first] and first in self._marked:
                return text[1:]
        return text

    @property
    def _marked(self) -> set[int]:
        found = self.__dict__.get("_marked_ids")
        if found is None:
            found = self.__dict__["_marked_ids"] = {i for piece, i in self.ids.items() if piece.startswith(MARK)}
        return found


@lru_cache(maxsize=1)
def pieces(path: str) -> SentencePieces:
    return SentencePieces(path)


def encode_documents(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """All columns of `docs` but the text; `ids` with begin and end ids; and for each id `begins` and `ends`,
    the bytes of the text that it stands for (begin and end ids have empty spans). Nothing is shuffled."""
    ship(docs.sparkSession)
    made = ("ids", "begins", "ends")
    kept = [c for c in docs.columns if c not in (text, *made)]

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_pieces = pieces(model)
        for batch in batches:
            ids, begins, ends = [], [], []
            texts = [t or "" for t in batch.column(text).to_pylist()]
            for row, (raw, stops) in zip(texts, model_pieces.encode_all(texts)):
                size = len(row.encode("utf-8"))
                ids.append([model_pieces.begin, *np.frombuffer(raw, dtype="<u4").tolist(), model_pieces.end])
                begins.append([0, *[0, *stops.tolist()][: len(stops)], size])
                ends.append([0, *stops.tolist(), size])
            made_columns = [
                pa.array(ids, type=pa.list_(pa.int32())),
                pa.array(begins, type=pa.list_(pa.int64())),
                pa.array(ends, type=pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *made_columns], names=[*kept, *made])

    schema = docs.select(*kept).schema.add("ids", ArrayType(IntegerType()))
    schema = schema.add("begins", ArrayType(LongType())).add("ends", ArrayType(LongType()))
    return docs.select(*kept, text).mapInArrow(encoded, schema)


def decode_documents(tokens: DataFrame, model: str) -> DataFrame:
    """All columns of `tokens` but `ids`, `begins` and `ends`, and the decoded `text`; null ids give an empty text."""
    ship(tokens.sparkSession)
    kept = [c for c in tokens.columns if c not in ("ids", "begins", "ends", "text")]

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_pieces = pieces(model)
        for batch in batches:
            texts = pa.array([model_pieces.decode(ids or []) for ids in batch.column("ids").to_pylist()], type=pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), texts], names=[*kept, "text"])

    return tokens.select(*kept, "ids").mapInArrow(decoded, tokens.select(*kept).schema.add("text", StringType()))


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens with begin and end, digests of the ids, of the text that they decode to, and of the
    bytes at which the pieces end (unsigned 64 bits each), for every row."""
    ship(docs.sparkSession)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_pieces = pieces(model)
        begin, end = (struct.pack("<I", i) for i in (model_pieces.begin, model_pieces.end))
        for batch in batches:
            counts, ids_sha, text_sha, spans_sha = [], [], [], []
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for raw, ends in model_pieces.encode_all(texts):
                raw = b"".join((begin, raw, end))
                counts.append(len(raw) // 4)
                ids_sha.append(hashlib.sha256(raw).hexdigest())
                decoded = model_pieces.decode(np.frombuffer(raw, dtype="<u4").tolist())
                text_sha.append(hashlib.sha256(decoded.encode("utf-8")).hexdigest())
                spans_sha.append(hashlib.sha256(ends.astype("<u8").tobytes()).hexdigest())
            columns = [batch.column("doc_id"), pa.array(counts, type=pa.int64())]
            columns += [pa.array(c, type=pa.string()) for c in (ids_sha, text_sha, spans_sha)]
            yield pa.RecordBatch.from_arrays(
                columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"]
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string"
    )
