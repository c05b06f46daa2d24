"""A lexicon's words and what is a few edits away, as one deterministic automaton.

The lexicon is a trie. A state of the automaton is a set of places in the trie, each with
the fewest edits that lead there: the intersection of the Levenshtein automata of what has
been read with the trie. States are built once, for the letters of the lexicon and one
column for all other signs; many words are then run through the table side by side.
"""
from collections.abc import Callable, Sequence

import numpy as np

_STEM = -1  # marks that the word began with a stem


class LexiconAutomaton:
    """``match`` gives for every word the nearest entry and its distance.

    ``terms`` match within ``edits(term)`` edits; ``stems`` match every word that begins
    with them, without an edit. Of several entries the one of fewer edits wins, terms before
    stems, then the first one of the list.
    """

    def __init__(self, terms: Sequence[str], stems: Sequence[str], edits: Callable[[str], int]) -> None:
        self.entries = [*terms, *stems]
        self._children: list[dict[str, int]] = [{}]
        self._allowed = [0]  # most edits of any term at or below a place
        self._term: list[int | None] = [None]
        self._stem: list[int | None] = [None]
        for k, entry in enumerate(self.entries):
            stem = k >= len(terms)
            place, most = 0, 0 if stem else edits(entry)
            self._allowed[0] = max(self._allowed[0], most)
            for letter in entry:
                if letter not in self._children[place]:
                    self._children[place][letter] = len(self._children)
                    self._children.append({})
                    self._allowed.append(0)
                    self._term.append(None)
                    self._stem.append(None)
                place = self._children[place][letter]
                self._allowed[place] = max(self._allowed[place], most)
            ends = self._stem if stem else self._term
            if ends[place] is None:
                ends[place] = k
        self._most = [0 if k >= len(terms) else edits(e) for k, e in enumerate(self.entries)]
        letters = sorted(set("".join(self.entries)))
        self._code_points = np.array([ord(c) for c in letters], np.int64)
        self._build(letters)
        # only the tables are needed to match, and sent to tasks
        del self._children, self._allowed, self._term, self._stem, self._most

    def _closed(self, places: dict[int, int]) -> frozenset:
        """With the places that leaving out letters of the lexicon leads to."""
        waiting = list(places)
        while waiting:
            place = waiting.pop()
            if place <= _STEM:
                continue
            edits = places[place] + 1
            if edits == 1 and self._stem[place] is not None:
                places.setdefault(_STEM - self._stem[place], 0)
            for child in self._children[place].values():
                if edits <= self._allowed[child] and places.get(child, edits + 1) > edits:
                    places[child] = edits
                    waiting.append(child)
        return frozenset(places.items())

    def _next(self, state: frozenset, letter: str | None) -> frozenset:
        places: dict[int, int] = {}

        def put(place: int, edits: int) -> None:
            if places.get(place, edits + 1) > edits:
                places[place] = edits

        for place, edits in state:
            if place <= _STEM:
                put(place, 0)
                continue
            child = self._children[place].get(letter)
            if child is not None:
                put(child, edits)
            if edits + 1 <= self._allowed[place]:
                put(place, edits + 1)  # a sign too many
                for child in self._children[place].values():  # a wrong sign
                    if edits + 1 <= self._allowed[child]:
                        put(child, edits + 1)
        return self._closed(places)

    def _found(self, state: frozenset) -> tuple[int, int]:
        """Entry and distance that a word ending here matches, or (-1, -1)."""
        ends = []
        for place, edits in state:
            if place <= _STEM:
                ends.append((0, _STEM - place))
            elif self._term[place] is not None and edits <= self._most[self._term[place]]:
                ends.append((edits, self._term[place]))
        distance, entry = min(ends, default=(-1, -1))
        return entry, distance

    def _build(self, letters: list[str]) -> None:
        start = self._closed({0: 0})
        numbers = {frozenset(): 0, start: 1}
        states = [frozenset(), start]
        rows = [[0] * (len(letters) + 1)]
        while len(rows) < len(states):
            state = states[len(rows)]
            relevant = set().union(*(self._children[p] for p, _ in state if p > _STEM))
            row = []
            other = None
            for letter in (None, *letters):
                if letter in relevant or other is None:
                    after = self._next(state, letter)
                    if after not in numbers:
                        numbers[after] = len(states)
                        states.append(after)
                    number = numbers[after]
                    if letter is None:
                        other = number
                else:
                    number = other
                row.append(number)
            rows.append(row)
        self.table = np.array(rows, np.int32)
        found = [self._found(state) for state in states]
        self._entry = np.array([entry for entry, _ in found], np.int32)
        self._distance = np.array([distance for _, distance in found], np.int32)

    def match(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Entry (its number, -1 for none) and distance of each word."""
        state = np.ones(len(words), np.int32)
        text = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        begins = np.cumsum(sizes) - sizes
        if len(self._code_points):
            place = np.searchsorted(self._code_points, text)
            place[place == len(self._code_points)] = 0
            column = np.where(self._code_points[place] == text, place + 1, 0)
        else:
            column = np.zeros(len(text), np.int64)
        alive = np.arange(len(words))
        step = 0
        while len(alive):
            alive = alive[sizes[alive] > step]
            state[alive] = self.table[state[alive], column[begins[alive] + step]]
            alive = alive[state[alive] != 0]
            step += 1
        return self._entry[state], self._distance[state]
