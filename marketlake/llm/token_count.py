"""Token counts of a sentence-piece vocabulary by a counting transducer.

The vocabulary's merges become a `MergeAutomaton`, whose transitions carry the change in the
number of tokens. A text is read in chunks. What a chunk does to the state that the chunk before
leaves is a `ChunkMap`: the text before its first border, the tokens between its borders, and
the text behind its last one. At a border the automaton is in its first state whatever came before,
so only the two ends depend on the neighbours, and the maps of neighbouring chunks compose to the
map of both, in any grouping.

Null and empty texts have no tokens.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.merge_automaton import MergeAutomaton
from marketlake.llm.shipping import ship

MARK = "▁"
CHUNK = 1 << 16
CACHE = 400_000
#: Texts that are prepared together.
ROWS = 2_000
LIMIT = 4096
_BORDER = re.compile(f"(?<=[^{MARK}]){MARK}")
_RUNS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class _Counts(dict):
    """Token counts of words by look-up; a full store starts anew."""

    def __init__(self, lead: str, count) -> None:
        super().__init__()
        self.lead, self.count = lead, count

    def __missing__(self, word: str) -> int:
        found = self.count(self.lead + word)
        if len(word) <= 64:
            if len(self) >= CACHE:
                self.clear()
            self[word] = found
        return found


class ChunkMap(NamedTuple):
    """A chunk without a border is all `head`."""

    head: str
    bordered: bool
    body: int
    tail: str


class TokenCounter:
    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [
            i
            for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        rank = {model.id_to_piece(i): -model.get_score(i) for i in plain}
        order = {score: n for n, score in enumerate(sorted(set(rank.values())))}
        self.rank = {piece: order[score] for piece, score in rank.items()}
        merges = (
            (piece[:n], piece[n:])
            for piece in sorted(self.rank, key=self.rank.get)
            for n in range(1, len(piece))
        )
        ranks = self.rank
        self.symbols = symbols = {c for piece in ranks for c in piece}
        self.automaton = MergeAutomaton(symbols, merges, lambda a, b: ranks.get(a + b))
        self._close()
        for piece in ranks:
            if _BORDER.search(piece):
                raise ValueError("the vocabulary has pieces over a word border")
        self.whole = _Counts(MARK, self._count)
        self.bare = _Counts("", self._count)
        self.line_border = "\n" not in symbols

    def _close(self) -> None:
        """Pieces whose parts rank behind them come about once those parts are there."""
        automaton = self.automaton
        before = 0
        while before < len(automaton.time):
            before = len(automaton.time)
            for piece in self.rank:
                if piece not in automaton.time:
                    for n in range(1, len(piece)):
                        automaton.add(piece[:n], piece[n:])
        automaton.close()

    def _count(self, word: str) -> int:
        total = self.automaton.count(word)
        if not self.symbols.issuperset(word):  # such a symbol is spelled in bytes, one token each
            total += sum(len(c.encode("utf-8")) - 1 for c in word if c not in self.symbols)
        return total

    def prepare(self, texts: list[str | None]) -> None:
        """Count the new words of many texts in one pass, in order, so that common beginnings are read once."""
        parts: set[str] = set()
        for text in texts:
            if text:
                parts.update(text.replace("\n", " ").split(" "))
        parts.difference_update(self.whole)
        new = sorted(p for p in parts if len(p) <= 64 and MARK not in p and self.symbols.issuperset(p))
        if len(self.whole) + len(new) > CACHE:
            self.whole.clear()
        whole = self.whole

        def keep(word: str, lasts: list, counts: list[int]) -> None:
            whole[word[1:]] = counts[-1]

        self.automaton.read_sorted((MARK + p for p in new), keep)

    def _line(self, line: str) -> int:
        """Tokens of a line that begins at a border; it may begin with a word's end or a mark."""
        if MARK + MARK in line or line.startswith(MARK):
            bare = self.bare
            return sum(bare[w] for w in _RUNS.findall(line))
        first, *rest = line.split(MARK)
        return (self.bare[first] if first else 0) + sum(map(self.whole.__getitem__, rest))

    def _between(self, text: str) -> int:
        if not self.line_border:
            return self._line(text)
        lines = text.split("\n")
        return len(lines) - 1 + sum(map(self._line, lines))

    def chunk(self, text: str) -> ChunkMap:
        """Split at the first and the last border inside: before a mark that follows another symbol."""
        found = _BORDER.search(text)
        if found is None:
            return ChunkMap(text, False, 0, "")
        first = last = found.start()
        at = text.rfind(MARK, first + 1)
        while at > 0:
            if text[at - 1] != MARK:
                last = at
                break
            at = text.rfind(MARK, first + 1, at)
        return ChunkMap(text[:first], True, self._between(text[first:last]), text[last:])

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        if not a.bordered and not b.bordered:
            return self.chunk(a.head + b.head)  # the seam itself may be a border
        if not a.bordered:
            seam = self.chunk(a.head + b.head)
            return ChunkMap(seam.head, True, seam.body + self._between(seam.tail) + b.body, b.tail)
        if not b.bordered:
            seam = self.chunk(a.tail + b.head)
            if not seam.bordered:
                return ChunkMap(a.head, True, a.body, seam.head)
            return ChunkMap(a.head, True, a.body + self._between(seam.head) + seam.body, seam.tail)
        return ChunkMap(a.head, True, a.body + self._between(a.tail + b.head) + b.body, b.tail)

    def finish(self, chunk: ChunkMap) -> int:
        return self._between(chunk.head) + (chunk.body + self._between(chunk.tail) if chunk.bordered else 0)

    def scan(self, maps: list[ChunkMap]) -> ChunkMap:
        """Compose neighbours pairwise until one map is left."""
        while len(maps) > 1:
            maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps[0]

    def tokens(self, text: str, size: int = CHUNK) -> int:
        if not text:
            return 0
        text = MARK + text.replace(" ", MARK)
        return self.finish(self.scan([self.chunk(text[i : i + size]) for i in range(0, len(text), size)]))


@lru_cache(maxsize=2)
def counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def count_tokens(docs: DataFrame, model: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether that is over the limit, for every row; nothing is shuffled."""
    ship(docs.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(model)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            n_tokens = []
            for start in range(0, len(texts), ROWS):
                tokens.prepare(texts[start : start + ROWS])
                n_tokens += [tokens.tokens(t) if t else 0 for t in texts[start : start + ROWS]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(t.encode("utf-8")) if t else 0 for t in texts], type=pa.int64()),
                    pa.array(n_tokens, type=pa.int64()),
                    pa.array([n > limit for n in n_tokens], type=pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        counted, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
