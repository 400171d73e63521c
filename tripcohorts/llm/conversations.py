"""Repair of conversation structure: faults, and the cheapest edits to a legal order of roles.

Rows are sorted by conversation and turn over all tasks, so a conversation of any size is cut into
parts of bounded size. Each row becomes a symbol for its role and fault; a Re-Pair grammar is learned from the counts
of all different symbol strings, and its rules carry min-plus transfer matrices (see `grammar`). Strings of whole
conversations are solved from these. Of a conversation that goes on over several tasks, the parts' matrices meet, which
gives the cost of all that follows each part; then its parts are gone through in order,
one at a time, for the edits and the hash of the repaired text.

Edge cases: a null conversation id is a conversation, whose id stays null; a null turn, role or text is
one space in the key of the damage, a null role or text also in the row. Null turns come first. Rows of one turn
are ordered by role and by the hash of their text; equal rows follow each other, and all but one of them are
duplicates. A role that begins with no known letter, or an empty one, can be changed or deleted. A conversation without
rows after the damage has zeros and the hash of an empty text. An empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripcohorts.llm.common import arrow_schema, written
from tripcohorts.llm.grammar import (
    ENDING,
    ENDING_COST,
    GONE,
    START,
    STATES,
    SYSTEM,
    USER,
    Grammar,
    after_insert,
    pairs,
    whole,
)

#: Bytes of text that are sorted and cut into parts by one task.
PART_BYTES = 16 << 20

#: Rounds of counting pairs, and rules that each round adds at most.
ROUNDS, RULES_A_ROUND = 6, 32

WHITE = " \t\n\x0b\f\r"


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies of every row; dropped rows stay with no copies and no text."""

    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    code = F.crc32(F.concat_ws(":", spaced("conv_id"), spaced("turn"))) % 20
    rows = conversations.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), code.alias("code"))
    text = F.when(F.col("code") <= 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("code") == 0, "").when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.when(F.col("code") == 0, 0).when(F.col("code") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


#: Without nulls, so that joins and shuffles agree on their keys.
CONVERSATION = ["has_id", "conv"]
ORDER = [*CONVERSATION, "has_turn", "turn", "role", "digest"]


def symbols(rows: DataFrame) -> DataFrame:
    """Equal rows as one, with ORDER, text, copies, first character, symbol of the first copy and its fault."""
    keyed = rows.select(
        F.col("conv_id").isNotNull().alias("has_id"),
        F.coalesce("conv_id", F.lit(0)).cast("long").alias("conv"),
        F.col("turn").isNotNull().alias("has_turn"),
        F.coalesce("turn", F.lit(0)).cast("long").alias("turn"),
        "role",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        "text",
        "copies",
    )
    rows = keyed.groupBy(*ORDER).agg(F.sum("copies").alias("copies"), F.first("text").alias("text"))
    # one row for each role and text of a conversation: the place where it comes first
    said = keyed.filter("copies > 0").groupBy(*CONVERSATION, "role", "digest")
    first = said.agg(F.min(F.struct("has_turn", "turn")).alias("at"))
    first = first.select(*CONVERSATION, "at.has_turn", "at.turn", "role", "digest", F.lit(True).alias("is_first"))
    rows = rows.join(first, ORDER, "left")
    trimmed = F.rtrim(F.col("text"), F.lit(WHITE))
    blank = F.length(trimmed) == 0
    new = F.coalesce("is_first", F.lit(False))
    whole_sentence = F.substring(trimmed, -1, 1).isin(".", "!", "?")
    initial = F.substring("role", 1, 1)
    kept = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    symbol = F.when(blank | ~new, GONE).when(whole_sentence, kept).otherwise(F.upper(kept))
    fault = F.when(blank, "b").when(~new, "d").when(~whole_sentence, "t").otherwise("")
    return rows.select(*ORDER, "text", "copies", initial.alias("initial"), symbol.alias("symbol"), fault.alias("fault"))


_PART = (
    "has_id boolean, conv long, part int, edge boolean, symbols string, roles array<string>, texts array<string>, copies array<long>, "
    "blank long, duplicate long, truncated long, illegal long, first_initial string, last_initial string, "
    "turns long, first_turn long, last_turn long, least_turn long"
)


class _Part:
    """Rows of one conversation within one task."""

    def __init__(self, has_id: bool, conv: int):
        self.key = has_id, conv
        self.symbols: list[str] = []
        self.roles, self.texts, self.copies = [], [], []
        self.faults = {"b": 0, "d": 0, "t": 0}
        self.illegal = self.turns = 0
        self.first_initial = self.last_initial = self.first_turn = self.last_turn = self.least_turn = None

    def add(self, turn: int | None, role: str, text: str, copies: int, initial: str, symbol: str, fault: str) -> None:
        if not copies:
            return
        if self.last_initial is None:
            self.first_initial, self.first_turn = initial, turn
        else:
            self.illegal += not legal(self.last_initial, initial)
        self.illegal += (copies - 1) * (not legal(initial, initial))
        self.turns += turn is not None and turn != self.last_turn
        self.least_turn = turn if self.least_turn is None else self.least_turn
        self.last_initial, self.last_turn = initial, turn
        self.symbols.append(symbol + GONE * (copies - 1))
        if fault:
            self.faults[fault] += 1
        self.faults["b" if fault == "b" else "d"] += copies - 1
        self.roles.append(role)
        self.texts.append(text)
        self.copies.append(copies)

    def row(self, part: int, edge: bool) -> tuple:
        return (
            *self.key, part, edge, "".join(self.symbols), self.roles, self.texts, self.copies,
            *self.faults.values(), self.illegal, self.first_initial, self.last_initial,
            self.turns, self.first_turn, self.last_turn, self.least_turn,
        )


def legal(before: str, after: str) -> bool:
    return before + after in ("su", "ua", "au")


def parts(rows: DataFrame, tasks: int) -> DataFrame:
    """The rows in order, gathered by conversation within each task.

    `edge` marks the first and the last conversation of a task, the only ones that may go on in others.
    """
    types = arrow_schema(rows.sparkSession, _PART)
    names = [*CONVERSATION, "has_turn", "turn", "role", "text", "copies", "initial", "symbol", "fault"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        current, first, done, held = None, True, [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), types)], schema=types)

        for some in batches:
            for has_id, conv, has_turn, turn, *row in zip(*(some.column(n).to_pylist() for n in names)):
                if current is None or current.key != (has_id, conv):
                    if current is not None:
                        done.append(current.row(number, first))
                        first = False
                    current = _Part(has_id, conv)
                current.add(turn if has_turn else None, *row)
                held += len(row[1])
                if held > PART_BYTES // 4 and done:
                    yield batch()
                    done, held = [], 0
        if current is not None:
            done.append(current.row(number, True))
        if done:
            yield batch()

    dealt = rows.repartitionByRange(tasks, *ORDER).sortWithinPartitions(*ORDER)
    return dealt.select(*names).mapInArrow(work, _PART)


def learn(texts: DataFrame, column: str = "symbols") -> Grammar:
    """A grammar by rounds of Re-Pair over all different strings of a column, weighted by how many rows hold them."""
    grammar = Grammar()
    strings = texts.filter(F.length(column) > 1).groupBy(F.col(column).alias("text")).agg(F.count("*").alias("times"))
    strings = written(strings, "strings")
    schema = "pair string, times long"
    types = arrow_schema(texts.sparkSession, schema)
    for _ in range(ROUNDS):

        def count(batches: Iterator[pa.RecordBatch], grammar: Grammar = grammar) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found: dict[str, int] = {}
                for text, times in zip(batch.column("text").to_pylist(), batch.column("times").to_pylist()):
                    for pair, here in pairs(grammar.compress(text)).items():
                        found[pair] = found.get(pair, 0) + here * times
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], schema=types)

        counted = strings.mapInArrow(count, schema).groupBy("pair").agg(F.sum("times").alias("times"))
        best = counted.filter("times > 1").orderBy(F.desc("times"), "pair").limit(RULES_A_ROUND).collect()
        if not best:
            break
        grammar = Grammar([*grammar.rules, *(row[0] for row in best)])
    return grammar


def repaired(edits: str, roles: list[str], texts: list[str], copies: list[int], state: int) -> tuple[list[str], int]:
    """The lines of the repaired rows, and the state after them."""
    lines = []
    rows = (row for row, times in enumerate(copies) for _ in range(times))
    for letter in edits:
        if letter != "I":
            row = next(rows)
        if letter == "D":
            continue
        if letter == "K" and state == START and roles[row][:1] == "s":
            role, state = roles[row], SYSTEM
        else:
            state = after_insert(state)
            role = roles[row] if letter == "K" else "user" if state == USER else "assistant"
        lines.append(f"{role}:{'' if letter == 'I' else texts[row]}")
    return lines, state


RESULT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)


def _inner(cut: DataFrame, grammar: Grammar) -> DataFrame:
    """Results of conversations that lie within one task."""
    types = arrow_schema(cut.sparkSession, RESULT)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solved = whole(grammar)
        for batch in batches:
            found = []
            for p in batch.to_pylist():
                cost, edits = solved(p["symbols"]) if p["symbols"] else (0, "")
                lines, _ = repaired(edits, p["roles"], p["texts"], p["copies"], START)
                digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
                found.append((p["conv"] if p["has_id"] else None, *_counts([p]), cost, edits, digest))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), types)], schema=types)

    return cut.mapInArrow(work, RESULT)


class _Tally:
    """Counts of a conversation over its parts in order."""

    def __init__(self) -> None:
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.least = self.last = self.initial = None

    def add(self, p: dict) -> None:
        if p["first_initial"] is None:  # all its rows were dropped
            return
        if self.initial is not None:
            self.illegal += not legal(self.initial, p["first_initial"])
        self.turns += p["turns"] - (p["first_turn"] is not None and p["first_turn"] == self.last)
        for name in ("blank", "duplicate", "truncated", "illegal"):
            setattr(self, name, getattr(self, name) + p[name])
        self.least = p["least_turn"] if self.least is None else self.least
        self.last, self.initial = p["last_turn"], p["last_initial"]

    def row(self) -> tuple[int, ...]:
        gaps = 0 if self.last is None else self.last - self.least + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal


def _counts(parts_in_order: list[dict]) -> tuple[int, ...]:
    tally = _Tally()
    for p in parts_in_order:
        tally.add(p)
    return tally.row()


def _costs_ahead(edges: DataFrame, grammar: Grammar) -> DataFrame:
    """By part: the least cost of all rows of the conversation after it, for each state.

    Sixteen numbers of each part meet, two parts of each task at most.
    """
    schema = "has_id boolean, conv long, part int, costs array<long>"
    types = arrow_schema(edges.sparkSession, schema)

    def costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[c for row in grammar.costs(text) for c in row] for text in batch.column("symbols").to_pylist()]
            columns = [*(batch.column(n) for n in ("has_id", "conv", "part")), pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, types)], schema=types)

    after = "has_id boolean, conv long, part int, after array<long>"
    after_types = arrow_schema(edges.sparkSession, after)

    def back(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda row: -row["part"])
        ahead, found = list(ENDING_COST), []
        for row in rows:
            found.append((row["has_id"], row["conv"], row["part"], ahead))
            cost = row["costs"]
            ahead = [min(cost[4 * a + b] + ahead[b] for b in STATES if cost[4 * a + b] is not None) for a in STATES]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), after_types)], schema=after_types)

    few = edges.select("has_id", "conv", "part", "symbols").mapInArrow(costs, schema)
    return few.groupBy(*CONVERSATION).applyInArrow(back, after)


class _Repair:
    """A conversation while its parts pass in order."""

    def __init__(self, grammar: Grammar, has_id: bool, conv: int):
        self.grammar, self.conv_id = grammar, conv if has_id else None
        self.tally, self.state, self.cost = _Tally(), START, None
        self.edits: list[str] = []
        self.digest = hashlib.sha256()
        self.separator = b""

    def _write(self, edits: str, roles: list[str], texts: list[str], copies: list[int]) -> None:
        lines, self.state = repaired(edits, roles, texts, copies, self.state)
        self.edits.append(edits)
        for line in lines:
            self.digest.update(self.separator + line.encode())
            self.separator = b"\n"

    def add(self, part: dict) -> None:
        self.tally.add(part)
        if part["symbols"]:
            total, _, edits = self.grammar.solve(part["symbols"], self.state, part["after"])
            self.cost = total if self.cost is None else self.cost
            self._write(edits, part["roles"], part["texts"], part["copies"])

    def row(self) -> tuple:
        self._write(ENDING[self.state], [], [], [])
        return self.conv_id, *self.tally.row(), self.cost or 0, "".join(self.edits), self.digest.hexdigest()


def _edges(edges: DataFrame, grammar: Grammar) -> DataFrame:
    """Results of conversations at the edges of tasks; one part is held at a time."""
    types = arrow_schema(edges.sparkSession, RESULT)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = current = None

        def result(done: _Repair) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(done.row(), types)], schema=types)

        for batch in batches:
            for row in range(batch.num_rows):
                (part,) = batch.slice(row, 1).to_pylist()
                if key != (part["has_id"], part["conv"]):
                    if current is not None:
                        yield result(current)
                    key = part["has_id"], part["conv"]
                    current = _Repair(grammar, *key)
                current.add(part)
        if current is not None:
            yield result(current)

    ahead = written(_costs_ahead(edges, grammar), "costs-ahead")
    rows = edges.join(ahead, [*CONVERSATION, "part"])
    return rows.repartition(*CONVERSATION).sortWithinPartitions(*CONVERSATION, "part").mapInArrow(work, RESULT)


def repair(conversations: DataFrame) -> DataFrame:
    """RESULT for every conversation of the damaged rows."""
    size = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)
    tasks = -(-(conversations.agg(size).first()[0] or 0) // PART_BYTES) or 1
    cut = written(parts(symbols(damaged(conversations)), tasks), "conversation-parts")
    grammar = learn(cut)
    return _inner(cut.filter("not edge"), grammar).unionByName(_edges(cut.filter("edge"), grammar))
