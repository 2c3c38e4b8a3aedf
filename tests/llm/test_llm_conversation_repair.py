import functools
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourfold.llm import conversation_repair as cr

DDL = "conv_id bigint, turn bigint, role string, text string, who string, head string, digest string, number string, part string"
BLANK = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    out = []
    for conv_id, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv_id, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def cheapest(rows):
    """Cost, audit and repaired rows of (role, text, must go, truncated), by trying every edit."""
    goes = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    names = {2: "user", 3: "assistant"}

    @functools.cache
    def best(i, state, inserted):
        ways = []
        if i == len(rows) and state in (0, 3):
            ways.append((0, "", ()))
        if inserted < 2:
            for new in set(goes[state].values()) - {1}:
                cost, audit, left = best(i, new, inserted + 1)
                ways.append((2 + cost, "I" + audit, (f"{names[new]}:", *left)))
        if i < len(rows):
            role, text, must, late = rows[i]
            cost, audit, left = best(i + 1, state, 0)
            ways.append((3 + cost, "D" + audit, left))
            for initial, new in goes[state].items():
                if must:
                    continue
                cost, audit, left = best(i + 1, new, 0)
                if role[:1] == initial:
                    ways.append((late + cost, "K" + audit, (f"{role}:{text}", *left)))
                if new > 1:
                    ways.append((2 + late + cost, "R" + audit, (f"{names[new]}:{text}", *left)))
        return min(ways) if ways else (10**9, "", ())

    for i in range(len(rows), 0, -100):  # so that the recursion stays shallow
        for state in range(4):
            best(i, state, 0)
    return best(0, 0, 0)


def plain(rows, damage=True):
    """The contract, conversation by conversation."""
    out, digest = [], lambda t: hashlib.sha256(t.encode()).hexdigest()
    held = plain_damage(rows) if damage else rows
    for conv_id in {r[0] for r in rows}:
        own = [r[1:] for r in held if r[0] == conv_id]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][: cr.HEAD], hashlib.md5(r[2].encode()).hexdigest()))
        turns = [t for t, _, _ in own if t is not None]
        seen, faults, marked = set(), [], []
        for _, role, text in own:
            bare = text.strip(BLANK)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
            marked.append((role, text, fault in ("blank", "duplicate"), int(fault == "truncated")))
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, lines = cheapest(tuple(marked))
        out.append((
            conv_id, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest("\n".join(lines)),
        ))
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, *[""] * 5) for r in rows], DDL)


def repaired(df, **kinds):
    return sorted(map(tuple, cr.repair(df, **kinds).collect()), key=str)


def random_rows(seed, conversations, most, texts=("Yes.", "No!", "why", " ", "", "Well?\n", "end. ", "x:y.")):
    pick = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", "sys:tem", "u:s", None]
    rows = []
    for conv_id in range(conversations):
        for turn in range(pick.randrange(most)):
            text = pick.choice([*texts, None, f"text {pick.randrange(50)}."])
            rows.append((conv_id, pick.choice([turn] * 6 + [None, turn * 2]), pick.choice(roles), text))
    return rows


def test_block_tables_equal_single_steps():
    """Through random symbols the tables give the costs, vectors and states of one row at a time."""
    known, pick = cr.blocks(), np.random.default_rng(1)
    assert all(min(v) == 0 for v in known.vectors)
    for many in (0, 1, 3, 4, 9, 50):
        symbols = pick.integers(1, 10, many).tolist()
        codes = known.codes(symbols)
        ids, costs, exits = known.transition(codes)
        for start, vector in enumerate(known.vectors):
            behind, states = vector, []
            for symbol in reversed(symbols):
                states.append(behind)
                behind = cr._before(behind, symbol)
            assert behind == tuple(x + costs[start] for x in known.vectors[ids[start]])
            for state in range(4):
                at, audit = state, ""
                for symbol, own in zip(symbols, reversed(states)):
                    more, at = cr._edits(own, symbol, at)
                    audit += more
                assert (audit, at) == known.trace(codes, start, state) and at == exits[start][state]


@pytest.mark.parametrize("seed", range(3))
def test_random_conversations(spark, seed):
    rows = random_rows(seed, 60, 14)
    random.Random(seed).shuffle(rows)
    assert repaired(cr.damaged(table(spark, rows))) == plain(rows)
    assert repaired(cr.damaged(table(spark, rows)).repartition(5), size=3) == plain(rows)


def test_undamaged_texts(spark):
    """The repaired rows themselves."""
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Again."), (1, 2, "assistant", "cut off"), (2, 0, "system", "Be kind.")]
    got = cr.repair(table(spark, rows).withColumn("many", F.lit(1)), texts=True).collect()
    assert {r.conv_id: (r.audit, r.repaired) for r in got} == {
        1: ("KIKK", "user:Hi.\nassistant:\nuser:Again.\nassistant:cut off"), 2: ("D", ""),
    }


def test_one_long_conversation(spark):
    """A third of all rows in one conversation, another third equal rows: cut into many chunks."""
    rows = random_rows(7, 40, 12) + [(500, t, ("user", "assistant")[t % 2], f"row {t % 90}" + "." * (t % 3)) for t in range(600)]
    rows += [(501, 3, "user", "Same again.")] * 300 + [(501, 4, "assistant", "Answer.")]
    assert repaired(cr.damaged(table(spark, rows)), size=16) == plain(rows)


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "Hello."), (None, 2, "assistant", "Hi."), (None, None, None, None), (1, None, "user", "A."),
        (1, None, "user", "B."), (2, 5, "system", "S."), (3, 9, "assistant", "\x1c"), (3, 9, "assistant", " "),
        (2**53 + 1, 0, "user", "One."), (2**53 + 3, 0, "user", "One."), (4, -7, "user", "Q?"), (4, 2**40, "assistant", "A" * 50_000),
        *[(c, 0, "user", "dropped or not.") for c in range(100, 200)],
    ]
    got = plain(rows)
    assert repaired(cr.damaged(table(spark, rows))) == got
    assert any(r[7] == "" for r in got)
    assert repaired(cr.damaged(table(spark, []))) == []


def test_whole_table(spark):
    held = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert repaired(cr.damaged(held)) == plain([(r.conv_id, r.turn, r.role, r.text) for r in held.collect()])
