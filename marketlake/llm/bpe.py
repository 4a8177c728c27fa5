"""Byte-level pair encoding and decoding by the tokenization automaton.

The vocabulary file's merges become a `MergeAutomaton` over bytes. Text is split as the file's
pre-tokenizer does; each piece of text is encoded by table-driven transitions, remembered for the
next time, and decoding joins the labels of the arcs. Special strings inside a text are tokens
of their own. Null and empty texts have no tokens; ids outside the vocabulary decode to nothing.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from marketlake.llm.memory import give_back
from marketlake.llm.merge_automaton import MergeAutomaton, path
from marketlake.llm.shipping import ship

#: Words and parts of texts are remembered in halves of so many (and those of one group of texts).
WORDS = 300_000
PARTS = 200_000
#: Texts that are prepared together.
ROWS = 4_000
#: The same for `encode_documents`, a stage beside others: less is remembered, and some words are read again.
STAGE_ROWS, STAGE_WORDS, STAGE_PARTS = 250, 25_000, 15_000

#: Fixed: the pattern by which byte-level vocabularies split text.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


#: Fixed: marks that the pattern parts from the letters before them.
MARKS = frozenset(",.;:!?")


class Entangled(Exception):
    """A part of a text that can't be split apart from its neighbours."""


class _Store(dict):
    """What `make` gives for a string, remembered in two halves: the older one goes when the newer is full.

    Halves change between groups of texts only, so nothing that a group needs goes while it is read.
    """

    def __init__(self, make) -> None:
        super().__init__()
        self.make = make
        self.old: dict[str, tuple[int, ...]] = {}

    def turn(self, size: int) -> None:
        if len(self) >= size:
            self.old = dict(self)
            self.clear()

    def __missing__(self, key: str) -> tuple[int, ...]:
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        if len(key) <= 64:
            self[key] = found
        return found


class _Labels(dict):
    """The bytes of ids; ids outside the vocabulary have none."""

    def __missing__(self, key: int) -> bytes:
        return b""


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins of vocabulary files: bytes that print stand for themselves, others follow from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in set(plain))
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class ByteBpe:
    def __init__(self, path: str) -> None:
        import regex

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        letters = _byte_letters()
        spelled = lambda piece: "".join(chr(letters[c]) for c in piece)
        merges = [m.split(" ") if isinstance(m, str) else m for m in file["model"]["merges"]]
        pairs = [(spelled(a), spelled(b)) for a, b in merges]
        ranks = {pair: n for n, pair in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.ids = {spelled(p): i for p, i in file["model"]["vocab"].items() if p not in self.special}
        self.labels = _Labels((i, p.encode("latin-1")) for p, i in self.ids.items())
        self.labels.update((i, s.encode("utf-8")) for s, i in self.special.items())
        self.automaton = MergeAutomaton(map(chr, range(256)), pairs, lambda a, b: ranks.get((a, b)))
        self.split = regex.compile(PATTERN).findall
        longest = sorted(self.special, key=len, reverse=True)
        self.apart = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")").split if longest else None
        self.words = _Store(self._word)
        self.spaced = _Store(lambda part: self._part(" ", part))
        self.bare = _Store(lambda part: self._part("", part))

    def _word(self, word: str) -> tuple[int, ...]:
        return tuple([self.ids[p] for p in self.automaton.pieces(word.encode("utf-8").decode("latin-1"))])

    def _part(self, lead: str, part: str) -> tuple[int, ...]:
        if not part or part[0].isspace() or part[-1].isspace():
            raise Entangled
        words = self.split(lead + part)
        if len(words) == 1:
            return self.words[words[0]]  # one object for both stores
        return tuple([i for word in words for i in self.words[word]])

    def _behind_space(self, part: str) -> tuple[str, ...]:
        """The words of a part behind a space; the pattern is spared for plain letters, also before one mark."""
        if part.isascii():
            if part.isalpha():
                return (" " + part,)
            if part[-1:] in MARKS and part[:-1].isalpha():
                return (" " + part[:-1], part[-1])
        return tuple(self.split(" " + part))

    def prepare(self, texts: list[str | None], size: int = WORDS, n_parts: int = PARTS) -> None:
        """Encode the new words of many texts in one pass, in order, so that common beginnings are read once.

        Words are remembered in halves of `size`, parts in halves of `n_parts`; a new part is split once.
        """
        self.words.turn(size)
        self.spaced.turn(n_parts)
        if len(self.bare) >= n_parts:
            self.bare.clear()
        parts: set[str] = set()
        for text in texts:
            if text:
                parts.update(text.split(" "))
        parts.difference_update(self.spaced, self.spaced.old)
        split = {part: self._behind_space(part) for part in parts}
        new = set(chain.from_iterable(split.values()))
        new.difference_update(self.words, self.words.old)
        spelled = {word.encode("utf-8").decode("latin-1"): word for word in new if len(word) <= 64}
        ids, words = self.ids, self.words

        def keep(symbols: str, lasts: list, counts: list[int]) -> None:
            words[spelled[symbols]] = tuple([ids[p] for p in path(symbols, lasts)])

        self.automaton.read_sorted(sorted(spelled), keep)
        spaced = self.spaced
        for part, whole in split.items():
            if 0 < len(part) <= 64 and not (part[0].isspace() or part[-1].isspace()):
                spaced[part] = words[whole[0]] if len(whole) == 1 else tuple(chain.from_iterable(map(words.__getitem__, whole)))

    def _plain(self, text: str) -> list[int]:
        if not text:
            return []
        first, *rest = text.split(" ")
        try:
            ids = list(self.bare[first])
            ids.extend(chain.from_iterable(map(self.spaced.__getitem__, rest)))
            return ids
        except Entangled:
            return self._long(text)

    def _long(self, text: str) -> list[int]:
        """Word by word, for texts with white space beside spaces."""
        return list(chain.from_iterable(map(self.words.__getitem__, self.split(text))))

    def encode(self, text: str) -> list[int]:
        if self.apart is None or not any(s in text for s in self.special):
            return self._plain(text)
        out: list[int] = []
        for part in self.apart(text):
            out.extend([self.special[part]] if part in self.special else self._plain(part))
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def tokenizer(path: str) -> ByteBpe:
    return ByteBpe(path)


def encoded_batches(batches: Iterator[pa.RecordBatch], vocabulary: str, text: str, kept: list[str]) -> Iterator[pa.RecordBatch]:
    """The kept columns and `ids` of a task's rows; the tokenizer goes when the task ends, with all it remembers."""
    bpe = tokenizer(vocabulary)
    try:
        for batch in batches:
            for start in range(0, batch.num_rows, STAGE_ROWS):
                part = batch.slice(start, STAGE_ROWS)
                texts = part.column(text).to_pylist()
                bpe.prepare(texts, STAGE_WORDS, STAGE_PARTS)
                ids = pa.array([bpe.encode(t) if t else [] for t in texts], type=pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), ids], names=[*kept, "ids"])
    finally:
        bpe = batch = part = texts = ids = None
        tokenizer.cache_clear()
        give_back()


def encode_documents(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """All columns of `docs` but the text, and `ids`, the text's token ids; nothing is shuffled."""
    ship(docs.sparkSession)
    kept = [c for c in docs.columns if c not in (text, "ids")]

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return encoded_batches(batches, vocabulary, text, kept)

    schema = docs.select(*kept).schema.add("ids", ArrayType(IntegerType()))
    return docs.select(*kept, text).mapInArrow(encoded, schema)


def decode_documents(tokens: DataFrame, vocabulary: str) -> DataFrame:
    """All columns of `tokens` but `ids`, and the decoded `text`."""
    ship(tokens.sparkSession)
    kept = [c for c in tokens.columns if c not in ("ids", "text")]

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = tokenizer(vocabulary).decode
        for batch in batches:
            for start in range(0, batch.num_rows, STAGE_ROWS):
                part = batch.slice(start, STAGE_ROWS)
                texts = pa.array([decode(ids or []) for ids in part.column("ids").to_pylist()], type=pa.string())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), texts], names=[*kept, "text"])

    return tokens.select(*kept, "ids").mapInArrow(decoded, tokens.select(*kept).schema.add("text", StringType()))


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of what they decode to, for every row."""
    ship(docs.sparkSession)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(vocabulary)
        digit = {i: str(i) for i in bpe.labels}
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            texts = batch.column("text").to_pylist()
            for at, text in enumerate(texts):
                if at % ROWS == 0:
                    bpe.prepare(texts[at : at + ROWS])
                ids = bpe.encode(text) if text else []
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(",".join(map(digit.__getitem__, ids)).encode("ascii")).hexdigest())
                text_sha.append(hashlib.sha256(bpe.decode(ids).encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, type=pa.int64()), pa.array(ids_sha, type=pa.string()), pa.array(text_sha, type=pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
