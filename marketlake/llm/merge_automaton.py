"""Byte-pair merges as a deterministic automaton.

**Gadgets.** Begin with one state and an arc to itself for every symbol. The merge (a, b) -> ab,
in order of rank, takes the b-arc out of the state behind every a-arc and puts an ab-arc beside
it that leads where the b-arc led. What remains are exactly the sequences that merging leaves.
A state is named by the arc that leads to it, so the gadgets need no copies of states: the parts
and the time of every piece, and the taken arcs, say which arcs a state has (`follows`).

**Reading.** Of all pieces that end at a position of a word exactly one is the last arc of the path
that spells the word so far: the one that the last arc at its beginning leads on to. So a word is
read from the left, one look-up in the table of arcs for each candidate, and the path is read
back from the end (`pieces`).

**Counting.** For counting alone the reader is a finite transducer: its state is the longest end of
the text that begins a piece, with the last arc and the relative number of arcs at each of its
positions, and a transition carries the change in the number of arcs (`count`). Transitions are
filled in when first met, up to `max_states` states; words that lead beyond are counted from their arcs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import cached_property

MAX_STATES = 20_000
MAX_ARCS = 1_000_000

#: What a symbol outside the alphabet leaves behind: nothing merges with it.
APART = None


class _Rows(dict):
    """For every arc, which arcs the state behind it has, as far as known."""

    def __missing__(self, left: str) -> dict[str, bool]:
        row = self[left] = {}
        return row


class MergeAutomaton:
    """`symbols` are single characters; `merges` are ordered; `rank_of` ranks any pair, None if it never merges.

    `merges` may hold several pairs for one piece; equal ranks merge from the left.
    """

    def __init__(
        self,
        symbols: Iterable[str],
        merges: Iterable[tuple[str, str]],
        rank_of: Callable[[str, str], int | None],
        max_states: int = MAX_STATES,
    ) -> None:
        self.time: dict[str, int] = dict.fromkeys(symbols, -1)
        self.parts: dict[str, tuple[str, str]] = {}
        self.rank_of = rank_of
        self.max_states = max_states
        for a, b in merges:
            self.add(a, b)
        self.close()

    def close(self) -> None:
        """Empty tables for the merges so far."""
        self.__dict__.pop("prefixes", None)
        self.longest = max(map(len, self.time), default=1)
        self._arcs, self._n_arcs = _Rows(), 0
        self._ids: dict[tuple, int] = {}
        self._states: list[tuple[str, tuple, tuple]] = []
        self.table: list[dict[str, tuple[int, str | None, int]]] = []
        self._state("", (APART,), (0,))

    @cached_property
    def prefixes(self) -> set[str]:
        """The beginnings of pieces; reading by arcs does without them."""
        return {piece[:n] for piece in self.time for n in range(len(piece))}

    def add(self, a: str, b: str) -> None:
        """The merge's arc, if its parts can stand beside each other until then."""
        piece = a + b
        if piece in self.time or a not in self.time or b not in self.time:
            return
        rank = self.rank_of(a, b)
        if rank is not None and self._meet(a, b, rank):
            self.time[piece] = max(rank, self.time[a], self.time[b])
            self.parts[piece] = (a, b)

    def _meet(self, left: str, right: str, limit: float, from_right: bool = False) -> bool:
        """Whether no merge across the border of two pieces comes before `limit`.

        Takes the pieces apart, the latest merge first. Between two neighbours a merge comes about if
        its rank is below that of the merge that next takes one of them; the leftmost wins a draw.
        """
        time, parts, rank_of = self.time, self.parts, self.rank_of
        first = True
        while True:
            rank = rank_of(left, right)
            if rank is not None and not (first and limit == rank) and (rank < limit or (rank == limit and from_right)):
                return False
            first = False
            if time[left] > time[right]:
                limit, from_right = time[left], False
                left = parts[left][1]
            elif right in parts:
                limit, from_right = time[right], True
                right = parts[right][0]
            else:
                return True

    def follows(self, left: str, right: str) -> bool:
        """Whether the state behind the left arc has the right arc."""
        known = self._arcs[left].get(right)
        if known is None:
            if self._n_arcs >= MAX_ARCS:
                self._arcs.clear()
                self._n_arcs = 0
            known = self._arcs[left][right] = self._meet(left, right, float("inf"))
            self._n_arcs += 1
        return known

    def _state(self, suffix: str, lasts: tuple, counts: tuple) -> int:
        key = (suffix, lasts, counts)
        known = self._ids.get(key)
        if known is None:
            known = self._ids[key] = len(self._states)
            self._states.append(key)
            self.table.append({})
        return known

    def step(self, state: int, symbol: str) -> tuple[int, str | None, int]:
        """Fill in one transition: the next state, the arc that ends here, and the change in arcs."""
        if symbol not in self.time:
            found = (0, APART, 1)
            self.table[state][symbol] = found
            return found
        suffix, lasts, counts = self._states[state]
        longer = suffix + symbol
        for start in range(len(longer)):
            arc = longer[start:]
            if arc in self.time and (lasts[start] is APART or self.follows(lasts[start], arc)):
                break
        else:
            raise ValueError("no arc fits")
        change = counts[start] + 1
        cut = 0
        while longer[cut:] not in self.prefixes:
            cut += 1
        found = (
            self._state(longer[cut:], (*lasts, arc)[cut:], tuple(n - change for n in counts[cut:]) + (0,) if cut <= len(suffix) else (0,)),
            arc,
            change,
        )
        self.table[state][symbol] = found
        return found

    def count(self, word: str) -> int:
        """Number of pieces; a symbol outside the alphabet counts one."""
        table, state, total = self.table, 0, 0
        for at, symbol in enumerate(word):
            found = table[state].get(symbol)
            if found is None:
                if len(self._states) >= self.max_states:
                    return total + self._count_on(state, word, at)
                found = self.step(state, symbol)
            state, _, change = found
            total += change
        return total

    def _count_on(self, state: int, word: str, at: int) -> int:
        """What the symbols from `at` on add to the count, read from the arcs behind a state."""
        suffix, known_lasts, known_counts = self._states[state]
        word = suffix + word[at:]
        lasts, counts = list(known_lasts), list(known_counts)
        self._read(word, len(suffix), lasts, counts)
        return counts[-1]

    def _read(self, word: str, done: int, lasts: list, counts: list[int]) -> None:
        """Append the last arc and the number of arcs at each position of `word` behind `done`."""
        time, arcs, follows, longest = self.time, self._arcs, self.follows, self.longest
        apart = done
        while apart and lasts[apart] is not APART:
            apart -= 1
        for stop in range(done + 1, len(word) + 1):
            if word[stop - 1] not in time:
                apart = stop
                lasts.append(APART)
                counts.append(counts[-1] + 1)
                continue
            start = stop - 1
            low = max(apart, stop - longest)
            while start >= low:
                arc = word[start:stop]
                if arc in time:
                    last = lasts[start]
                    if last is APART:
                        break
                    known = arcs[last].get(arc)
                    if known or (known is None and follows(last, arc)):
                        break
                start -= 1
            else:
                raise ValueError("no arc fits")
            lasts.append(arc)
            counts.append(counts[start] + 1)

    def read_sorted(self, words: Iterable[str], found: Callable[[str, list, list[int]], None]) -> None:
        """Read words in ascending order, each from where it leaves the one before, and hand over its positions."""
        lasts, counts, before = [APART], [0], ""
        for word in words:
            same = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                same += 1
            del lasts[same + 1 :], counts[same + 1 :]
            self._read(word, same, lasts, counts)
            found(word, lasts, counts)
            before = word

    def pieces(self, word: str) -> list[str]:
        """The pieces of a word; a symbol outside the alphabet stands for itself."""
        lasts: list[str | None] = [APART]
        self._read(word, 0, lasts, [0])
        return path(word, lasts)


def path(word: str, lasts: list) -> list[str]:
    """The pieces of a word from the last arcs at its positions."""
    out: list[str] = []
    at = len(word)
    while at:
        out.append(lasts[at] or word[at - 1])
        at -= len(out[-1])
    out.reverse()
    return out
