"""Re-Pair grammars over row symbols, and min-plus transfer matrices with audit ropes for their rules.

A symbol stands for one row of a conversation: which role begins it, and which fault it has. The
states of the repair are what the roles kept so far ask for next; a row's matrix holds, for each pair of
states, the least cost of editing the row (with insertions before it) and the letters of those edits. A
rule stands for two symbols, and its matrix is the min-plus product of theirs, so every repeated
run of rows is worked out once, whatever number of conversations holds it.

Letters are joined in ropes: a product joins two without copying, and letters are only spelled out for
ties and for the edits chosen in the end. Between the same two states, two ropes of the same rows and equal cost are never
the beginning of one another, because each ends with the letter of a row; so the least of both parts is the least of all.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

#: Costs of the edits, and of a truncated row that stays.
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1

#: States: nothing kept, after a system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = STATES = range(4)

#: Row symbols: must go; then roles that begin with s, u, a or otherwise, upper case for truncated rows.
GONE = "D"
ROWS = GONE + "suaoSUAO"

#: The first character that names a rule.
FIRST_RULE = 0xE000

Rope = str | tuple
Entry = tuple[int, Rope]
Matrix = list[list[Entry | None]]

_AFTER_USER = {START: USER, SYSTEM: USER, ASSISTANT: USER}
_AFTER_ASSISTANT = {USER: ASSISTANT}

#: The insertions that bring a conversation in each state to its end.
ENDING = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}


def letters(rope: Rope) -> Iterator[str]:
    """The pieces of a rope from left to right."""
    todo = [rope]
    while todo:
        part = todo.pop()
        if isinstance(part, str):
            yield part
        else:
            todo += part[1], part[0]


def spelled(rope: Rope) -> str:
    return rope if isinstance(rope, str) else "".join(letters(rope))


def _better(one: Entry, other: Entry | None) -> bool:
    if other is None or one[0] != other[0]:
        return other is None or one[0] < other[0]
    return one[1] is not other[1] and spelled(one[1]) < spelled(other[1])


def product(left: Matrix, right: Matrix) -> Matrix:
    """Min-plus product; of equal costs the least letters."""
    result: Matrix = [[None] * 4 for _ in STATES]
    for start in STATES:
        for middle in STATES:
            if (first := left[start][middle]) is None:
                continue
            for end in STATES:
                if (second := right[middle][end]) is not None:
                    entry = first[0] + second[0], (first[1], second[1])
                    if _better(entry, result[start][end]):
                        result[start][end] = entry
    return result


def row_matrix(symbol: str) -> Matrix:
    """Insertions and then the edit of one row."""
    result: Matrix = [[None] * 4 for _ in STATES]

    def offer(start: int, end: int, cost: int, text: str) -> None:
        if _better((cost, text), result[start][end]):
            result[start][end] = cost, text

    stays = TRUNCATED if symbol.isupper() else 0
    for start in STATES:
        state, inserted = start, 0
        while inserted < 3:
            before, paid = "I" * inserted, INSERT * inserted
            offer(start, state, paid + DELETE, before + "D")
            if symbol != GONE:
                for after, role in ((_AFTER_USER, "u"), (_AFTER_ASSISTANT, "a"), ({START: SYSTEM}, "s")):
                    if state in after:
                        if symbol.lower() == role:
                            offer(start, after[state], paid + stays, before + "K")
                        elif role != "s":
                            offer(start, after[state], paid + stays + REROLE, before + "R")
            state = after_insert(state)
            inserted += 1
    return result


def after_insert(state: int) -> int:
    return ASSISTANT if state == USER else USER


def pairs(text: str) -> Counter[str]:
    """Neighbours that can be replaced at the same time; of a run of one symbol every second pair."""
    found: Counter[str] = Counter()
    last, skip = "", False
    for pair in map("".join, zip(text, text[1:])):
        skip = pair == last and pair[0] == pair[1] and not skip
        if not skip:
            found[pair] += 1
        last = pair
    return found


@dataclass
class Grammar:
    """Rules in the order they are applied: each replaces a pair of symbols by one character."""

    rules: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.matrices: dict[str, Matrix] = {symbol: row_matrix(symbol) for symbol in ROWS}
        known, self.rules = self.rules, []
        for pair in known:
            self.add(pair)

    def __getstate__(self) -> list[str]:
        return self.rules

    def __setstate__(self, rules: list[str]) -> None:
        self.rules = rules
        self.__post_init__()

    def add(self, pair: str) -> None:
        self.matrices[chr(FIRST_RULE + len(self.rules))] = product(self.matrices[pair[0]], self.matrices[pair[1]])
        self.rules.append(pair)

    def compress(self, text: str) -> str:
        for number, pair in enumerate(self.rules):
            if len(text) < 2:
                break
            text = text.replace(pair, chr(FIRST_RULE + number))
        return text

    def costs(self, text: str) -> list[list[int | None]]:
        """The least cost between each pair of states over a run of rows."""
        rows: list[list[int | None]] = [[0 if a == b else None for b in STATES] for a in STATES]
        for symbol in self.compress(text):
            matrix = self.matrices[symbol]
            rows = [
                [
                    min((row[k] + matrix[k][end][0] for k in STATES if row[k] is not None and matrix[k][end]), default=None)
                    for end in STATES
                ]
                for row in rows
            ]
        return rows

    def solve(self, text: str, state: int, after: Iterable[int]) -> tuple[int, int, str]:
        """Cost with what follows, state at the end, and edits of a run of rows from `state`.

        `after` is the least cost of all that follows, by the state at the end of the run.
        """
        symbols = self.compress(text)
        ahead = [list(after)]
        for symbol in reversed(symbols):
            matrix, later = self.matrices[symbol], ahead[-1]
            ahead.append([min(e[0] + c for e, c in zip(row, later) if e is not None) for row in matrix])
        ahead.reverse()
        chosen = []
        total = ahead[0][state]
        for symbol, later in zip(symbols, ahead[1:]):
            best, end = None, state
            for number, entry in enumerate(self.matrices[symbol][state]):
                if entry is not None and _better((entry[0] + later[number], entry[1]), best):
                    best, end = (entry[0] + later[number], entry[1]), number
            chosen.append(spelled(best[1]))
            state = end
        return total, state, "".join(chosen)


#: What the ending costs, by state.
ENDING_COST = tuple(INSERT * len(ENDING[state]) for state in STATES)


def whole(grammar: Grammar) -> Callable[[str], tuple[int, str]]:
    """A function from the symbols of a conversation to its cost and edits; equal ones are solved once."""

    @lru_cache(100_000)
    def solved(text: str) -> tuple[int, str]:
        cost, state, edits = grammar.solve(text, START, ENDING_COST)
        return cost, edits + ENDING[state]

    return solved
