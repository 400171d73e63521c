"""Conversation repair against plain versions of the contract."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from tripcohorts.llm import conversations, grammar

SCHEMA = "conv_id long, turn long, role string, text string, part string, symbols long, key string"
WHITE = " \t\n\x0b\f\r"


def damage(rows):
    for conv, turn, role, text in rows:
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        role, text = (" " if v is None else v for v in (role, text))
        code = zlib.crc32(key.encode()) % 20
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        yield from [(conv, turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)


def faults(rows):
    said, found = set(), []
    for _, _, role, text in rows:
        shown = text.strip(WHITE)
        if not shown:
            found.append("blank")
        elif (role, text) in said:
            found.append("duplicate")
        else:
            found.append("" if shown[-1] in ".!?" else "truncated")
        said.add((role, text))
    return found


def cheapest(roles, marks):
    """(cost, letters, kept roles) by going over the rows with the best of each state; None means an inserted row."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def inserted(states):
        todo = dict(states)
        for _ in range(2):
            for state, (cost, text, out) in list(todo.items()):
                for role in ("user", "assistant"):
                    after = step.get((state, role[0]))
                    new = cost + 2, text + "I", [*out, (role, None)]
                    if after and (after not in todo or new[:2] < todo[after][:2]):
                        todo[after] = new
        return todo

    states = {"": (0, "", [])}
    for row, (role, mark) in enumerate(zip(roles, marks)):
        after = {}

        def offer(state, *new):
            if state is not None and (state not in after or new[:2] < after[state][:2]):
                after[state] = new

        for state, (cost, text, out) in inserted(states).items():
            offer(state, cost + 3, text + "D", out)
            if mark in ("blank", "duplicate"):
                continue
            cost += mark == "truncated"
            offer(step.get((state, role[:1])), cost, text + "K", [*out, (role, row)])
            for other in ("user", "assistant"):
                offer(step.get((state, other[0])), cost + 2, text + "R", [*out, (other, row)])
        states = after
    return min((v for s, v in inserted(states).items() if s in ("", "a")), key=lambda v: v[:2])


def wanted(rows):
    held = {row[0]: [] for row in rows}
    for row in damage(rows):
        held[row[0]].append(row)
    result = []
    for conv, said in held.items():
        said.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        marks, count = faults(said), Counter(faults(said))
        turns = [r[1] for r in said if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
        cost, audit, out = cheapest([r[2] for r in said], marks)
        text = "\n".join(f"{role}:{'' if row is None else said[row][3]}" for role, row in out)
        digest = hashlib.sha256(text.encode()).hexdigest()
        result.append((conv, gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, digest))
    return sorted(result, key=str)


def found(spark, rows):
    frame = spark.createDataFrame([(*row, "x", 1, "y") for row in rows], SCHEMA)
    return sorted(map(tuple, conversations.repair(frame).collect()), key=str)


def invented(seed, count, turns):
    random.seed(seed)
    texts = ["Fine.", "fine", "", " \n", "Is it?", "no end", "Yes!  ", "."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", "usher", "student"]
    return [(conv, turn, random.choice(roles), random.choice(texts) + random.choice(["", "", str(turn) + "."])) for conv in range(count) for turn in range(random.randint(1, turns))]


@pytest.fixture(params=[200, conversations.PART_BYTES])
def sizes(request, monkeypatch):
    monkeypatch.setattr(conversations, "PART_BYTES", request.param)


def test_short_conversations(spark):
    rows = invented(1, 600, 9)
    assert found(spark, rows) == wanted(rows)


def test_conversations_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(conversations, "PART_BYTES", 400)
    rows = invented(2, 4, 120) + [(9, turn, ("user", "assistant")[turn % 2], f"{turn}.") for turn in range(60)]
    assert found(spark, rows) == wanted(rows)


def test_odd_rows(spark, sizes):
    rows = [
        (None, None, None, None), (None, None, None, None), (None, 3, "user", "a."), (1, None, "user", "b."), (1, None, "assistant", "b."), (1, 5, "user", "b."),
        (2, 1, "user", "same."), (2, 1, "user", "same."), (2, 1, "assistant", "same."), (2, 900, "user", None), (3, 1, None, "x."),
        (4, 1, "user", "word. " * 50_000), (5, 0, "éa", "ü."), (5, 1, "system", "."), (5, -4, "assistant", "\x1c"),
    ]
    rows += [(7, 1, "user", "again.")] * 70 + [(8, turn, "user", "again.") for turn in range(40)]
    dropped = next(i for i in range(100, 300) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows.append((dropped, 0, "user", "gone."))
    result = found(spark, rows)
    assert result == wanted(rows)
    assert (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in result


def test_no_rows(spark):
    assert found(spark, []) == []


def test_whole_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    result = sorted(map(tuple, conversations.repair(frame).collect()), key=str)
    assert result == wanted([tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()])


def test_cheapest_edits_by_trying_all():
    """Every sequence of edits of three rows with up to two insertions anywhere."""
    legal = re.compile("(s?(ua)+)?")
    solved = grammar.whole(grammar.Grammar())
    for symbols in itertools.product(grammar.ROWS, repeat=3):
        best = None
        for edits in itertools.product(*[["D"] if s == "D" else ["D", "K", "Ru", "Ra"] for s in symbols]):
            for gaps in itertools.product(["", "u", "a", "ua", "au"], repeat=4):
                roles, letters, cost = gaps[0], "I" * len(gaps[0]), 2 * sum(map(len, gaps))
                for symbol, edit, gap in zip(symbols, edits, gaps[1:]):
                    roles += {"D": "", "K": symbol.lower()}.get(edit, edit[1:]) + gap
                    letters += edit[0] + "I" * len(gap)
                    cost += {"D": 3, "K": 0, "R": 2}[edit[0]] + (edit[0] != "D" and symbol.isupper())
                if (best is None or (cost, letters) < best) and legal.fullmatch(roles):
                    best = cost, letters
        assert solved("".join(symbols)) == best, symbols


def test_any_grammar_gives_the_same():
    random.seed(5)
    plain, coded = grammar.Grammar(), grammar.Grammar()
    texts = ["".join(random.choice("suaDuaUAo") for _ in range(random.randint(1, 40))) for _ in range(300)]
    for _ in range(60):
        counted = sum((grammar.pairs(coded.compress(t)) for t in texts), Counter())
        coded.add(max(counted, key=lambda p: (counted[p], p)))
    assert sum(len(coded.compress(t)) for t in texts) < 0.6 * sum(map(len, texts))
    for text in texts:
        assert grammar.whole(plain)(text) == grammar.whole(coded)(text)
        assert plain.costs(text) == coded.costs(text)


def test_pairs_do_not_overlap():
    assert grammar.pairs("aaaa") == {"aa": 2} and grammar.pairs("aaaab") == {"aa": 2, "ab": 1} and grammar.pairs("aabaaa") == {"aa": 2, "ab": 1, "ba": 1}


def test_rules_are_shared(spark):
    rows = spark.range(500).selectExpr("if(id % 3 = 0, 'uauaua', 'suaua') symbols")
    learned = conversations.learn(rows)
    assert learned.rules and max(len(learned.compress(t)) for t in ("uauaua", "suaua")) == 1
