"""Faults of conversations, and the cheapest edits that make their turns alternate.

A conversation's rows are read as symbols: whether the row must go, else the initial of its role and whether
its text is truncated. Edits keep, rerole, delete or insert rows so that the roles' initials read
``(s?(ua)+)?``. What is left to pay from a row on, by the four states of that pattern, is a cost vector, and
each symbol turns the vector behind it into the one before it. Up to a constant only some dozen vectors
occur, so the transitions of every vector through every block of ``BLOCK`` symbols are computed once, and a
conversation is read backward block by block, by lookup. The edits are traced forward: each block is expanded
backward from the vector behind it, and of equally cheap edits the one with the least initial is taken, which
gives the least of all cheapest audits. Expanded blocks are remembered.

Rows are counted by their values first, sorted by range partitions and cut into chunks, so a conversation of
any length is spread over many tasks. One that lies within a partition is finished there. A chunk of another
one gives its transition (of every vector, and of every state through every vector); these few bytes a chunk
are put together per conversation, and the chunks are traced from there. Only the digest of a conversation,
which is a chain, is taken in one task, from a stream of chunks in order.

Defined results: rows go by turn, nulls first, then by role, the first ``HEAD`` characters of the text and
its digest; nulls in role and text are one space; rows without conv_id are one conversation; equal rows count
as often as they occur; an empty role or one with another initial fits nowhere; a conversation whose rows
are all dropped has zeros, an empty audit and the digest of an empty text; columns beyond conv_id, turn, role
and text are ignored; an empty table gives an empty table. An audit is one string, so a conversation can't
have more than about two thousand million edits.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..sinks.files import stored
from .tasks import arrow_schema, map_arrow, record_batch, ship

#: Symbols of a block.
BLOCK = 4
#: Rows and characters of a chunk of a conversation.
CHUNK, CHUNK_CHARS = 16_384, 4_000_000
#: Characters of a text that order rows of one turn and role.
HEAD = 100
#: Blocks that a task remembers expanded.
REMEMBERED = 200_000
_BLANK = " \t\n\x0b\x0c\r"  # fixed value: [\x20\x09-\x0D]
#: Costs of edits, and what an undeleted truncated row adds.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

# States: 0 at the start, 1 behind the system row, 2 behind a user's row, 3 behind an assistant's row.
_END = (0, 2 * INSERT, INSERT, 0)
#: The state behind an inserted or reroled row: a user's, behind a user's row an assistant's.
_WANTED = (2, 2, 3, 2)
_KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
# Symbols: 0 none (fills a block), 1 must go, 2-5 role initials s, u, a and others, 6-9 the same, truncated.
_NONE, _GONE, _SYMBOLS = 0, 1, 10

_SUMS = "blank bigint, duplicate bigint, truncated bigint, illegal bigint"
RESULT = f"conv_id bigint, gaps bigint, {_SUMS}, cost bigint, audit string, repaired_sha256 string, repaired string"
_PLACE = "who string, conv_id bigint, part int, number bigint"
_ENDS = "first_turn bigint, last_turn bigint, turns bigint, head string, tail string"
_MAPS = "ids binary, costs binary, exits binary"
_CHUNK = f"{_PLACE}, whole boolean, {_ENDS}, {_SUMS}, {_MAPS}, codes binary, roles array<string>, texts array<string>, cost bigint, audit string, repaired_sha256 string, repaired string"
_SOLVED = f"{_PLACE}, behind int, state int, last boolean, gaps bigint, {_SUMS}, cost bigint"


def _before(behind: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """Costs to the end from before a row, given those from behind it."""
    if symbol == _NONE:
        return behind
    late, initial = TRUNCATED * (symbol >= 6), "suao"[(symbol - 2) % 4]
    own = []
    for state in range(4):
        ways = [DELETE + behind[state]]
        if symbol != _GONE:
            ways.append(REROLE + late + behind[_WANTED[state]])
            if (state, initial) in _KEEP:
                ways.append(late + behind[_KEEP[state, initial]])
        own.append(min(ways))
    once = [INSERT + own[_WANTED[s]] for s in range(4)]
    twice = [INSERT + once[_WANTED[s]] for s in range(4)]
    return tuple(map(min, own, once, twice))


def _edits(behind: tuple[int, ...], symbol: int, state: int) -> tuple[str, int]:
    """The least initials of cheapest edits up to and with a row, and the state behind it."""
    if symbol == _NONE:
        return "", state
    before, late, initial, out = _before(behind, symbol), TRUNCATED * (symbol >= 6), "suao"[(symbol - 2) % 4], ""
    while True:
        if DELETE + behind[state] == before[state]:
            return out + "D", state
        if INSERT + before[_WANTED[state]] == before[state]:
            out, state = out + "I", _WANTED[state]
            continue
        kept = _KEEP.get((state, initial))
        if kept is not None and late + behind[kept] == before[state]:
            return out + "K", kept
        return out + "R", _WANTED[state]


class Blocks:
    """Transitions of every cost vector, less its least cost, through every symbol and every block."""

    def __init__(self) -> None:
        self.vectors = [_END]
        known, rows = {_END: 0}, []
        for vector in self.vectors:  # grows until no symbol gives a new one
            row = []
            for symbol in range(_SYMBOLS):
                before = _before(vector, symbol)
                least = min(before)
                bare = tuple(x - least for x in before)
                if bare not in known:
                    known[bare] = len(self.vectors)
                    self.vectors.append(bare)
                row.append((known[bare], least))
            rows.append(row)
        many = len(self.vectors)
        step = np.array(rows)
        self.edits = [[[_edits(v, c, s) for s in range(4)] for c in range(_SYMBOLS)] for v in self.vectors]
        exits = np.array([[[e[1] for e in own] for own in row] for row in self.edits])
        self.powers = _SYMBOLS ** np.arange(BLOCK - 1, -1, -1)
        self.digits = np.arange(_SYMBOLS**BLOCK)[:, None] // self.powers % _SYMBOLS
        ids = np.repeat(np.arange(many)[:, None], len(self.digits), 1)
        costs, behind = np.zeros_like(ids), []
        for symbols in self.digits.T[::-1]:
            behind.append(ids)
            ids, costs = step[ids, symbols, 0], costs + step[ids, symbols, 1]
        states = np.broadcast_to(np.arange(4), (*ids.shape, 4))
        for symbols, own in zip(self.digits.T, reversed(behind)):
            states = exits[own[..., None], symbols[None, :, None], states]
        #: By vector behind and block: the vector before, the cost, and by state before the state behind.
        self.ids, self.costs, self.exits = ids.astype(np.int16), costs.astype(np.int64), states.astype(np.int8)
        self.step = step[..., 0]
        self.expanded: dict[tuple[int, int, int], tuple[str, int]] = {}

    def codes(self, symbols: list[int]) -> np.ndarray:
        """The blocks of a row of symbols, filled up at the front."""
        return (np.array([_NONE] * (-len(symbols) % BLOCK) + symbols, np.int64).reshape(-1, BLOCK) @ self.powers).astype("<i2")

    def backward(self, codes: np.ndarray, behind: int) -> tuple[list[int], int, int]:
        """The vectors behind every block, the one before them all, and the cost, by lookup."""
        at, total = [0] * len(codes), 0
        for i in range(len(codes) - 1, -1, -1):
            at[i], code = behind, codes[i]
            total += int(self.costs[behind, code])
            behind = int(self.ids[behind, code])
        return at, behind, total

    def expand(self, code: int, behind: int, state: int) -> tuple[str, int]:
        """Edits of a block that begins in ``state``, its vectors computed backward."""
        key = code, behind, state
        if key not in self.expanded:
            inner = []
            for symbol in self.digits[code][::-1]:
                inner.append((behind, symbol))
                behind = int(self.step[behind, symbol])
            out = ""
            for own, symbol in reversed(inner):
                more, state = self.edits[own][symbol][state]
                out += more
            if len(self.expanded) >= REMEMBERED:
                self.expanded.clear()
            self.expanded[key] = out, state
        return self.expanded[key]

    def trace(self, codes: np.ndarray, behind: int, state: int) -> tuple[str, int]:
        """Audit of a chunk between a state and a vector behind it, and the state it ends in."""
        out = []
        for code, own in zip(codes.tolist(), self.backward(codes, behind)[0]):
            more, state = self.expand(code, own, state)
            out.append(more)
        return "".join(out), state

    def transition(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of a chunk, by every vector behind it: the vector before, the cost, and by state the state behind."""
        ids = np.arange(len(self.vectors), dtype=np.int16)
        costs, at = np.zeros(len(ids), np.int64), []
        for code in codes[::-1]:
            at.append(ids)
            costs = costs + self.costs[ids, code]
            ids = self.ids[ids, code]
        states = np.broadcast_to(np.arange(4, dtype=np.int8), (len(ids), 4))
        for code, own in zip(codes, reversed(at)):
            states = self.exits[own[:, None], code, states]
        return ids, costs, states

    def ending(self, state: int) -> str:
        return "I" * (_END[state] // INSERT)


@functools.cache
def blocks() -> Blocks:
    return Blocks()


class Writer:
    """Writes repaired rows from audits, chunk by chunk, into a digest and, if asked for, a text."""

    def __init__(self, texts: bool):
        self.sha, self.begun, self.parts = hashlib.sha256(), False, [] if texts else None

    def add(self, audit: str, gone: Iterator[bool], lines: Iterator[tuple[str, str]], state: int) -> None:
        """Follows ``audit`` from ``state``; ``gone`` says of each row whether it must go, ``lines`` has the others."""
        out = []
        for edit in audit:
            if edit != "I" and next(gone):
                continue
            role, text = next(lines) if edit != "I" else ("", "")
            if edit == "D":
                continue
            if edit == "K":
                state = _KEEP[state, role[0]]
            else:
                state = _WANTED[state]
                role = "assistant" if state == 3 else "user"
            out.append(f"{role}:{text}")
        if out:
            data = "\n".join(out)
            self.sha.update(("\n" * self.begun + data).encode())
            self.begun = True
            if self.parts is not None:
                self.parts.append(data)

    def columns(self) -> tuple[str, str | None]:
        return self.sha.hexdigest(), None if self.parts is None else "\n".join(self.parts)


class Chunk:
    """Consecutive rows of one conversation."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.symbols: list[int] = []
        self.roles: list[str] = []  # of the rows that needn't go
        self.texts: list[str] = []
        self.chars = self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first_turn = self.last_turn = None
        self.head = self.tail = ""

    def full(self) -> bool:
        return len(self.symbols) >= self.size or self.chars >= CHUNK_CHARS

    def add(self, turn: int | None, role: str, text: str, seen: bool, many: int) -> None:
        initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
        bare = text.rstrip(_BLANK)
        self.illegal += many - 1 + (bool(self.tail) and self.tail + initial not in ("su", "ua", "au"))
        self.head, self.tail = self.head or initial, initial
        if turn is not None and turn != self.last_turn:
            self.turns, self.last_turn = self.turns + 1, turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
        if not bare:
            self.blank += many
            self.symbols += [_GONE] * many
            return
        self.duplicate += many - (not seen)
        if not seen:
            late = bare[-1] not in ".!?"
            self.truncated += late
            self.symbols.append(2 + "suao".index(initial) + 4 * late)
            self.roles.append(role)
            self.texts.append(text)
            self.chars += len(text)
        self.symbols += [_GONE] * (many - (not seen))


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and how often the row occurs, after the damage that its place gives it."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    text = F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"), text.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("bigint").alias("many"),
    )


def counted(rows: DataFrame) -> DataFrame:
    """Different rows of each conversation, with how often they occur; of dropped ones one that occurs no times."""
    lives = F.col("many") > 0
    rows = rows.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("who"), "conv_id", F.when(lives, F.col("turn")).alias("turn"),
        *[F.when(lives, F.coalesce(c, F.lit(" "))).otherwise("").alias(c) for c in ("role", "text")], "many",
    )
    return rows.groupBy("who", "conv_id", "turn", "role", "text").agg(F.sum("many").alias("many")).withColumns({
        "head": F.substring("text", 1, HEAD), "digest": F.md5("text")
    })


def seen_before(held: DataFrame) -> DataFrame:
    """The rows of ``held`` whose role and text an earlier turn of the conversation has, without their text."""
    slim = held.filter((F.col("many") > 0) & (F.btrim("text", F.lit(_BLANK)) != ""))
    slim = slim.select("who", "conv_id", "turn", "role", "head", "digest")
    when = F.struct(F.col("turn").isNotNull(), "turn")
    keys = ["who", "role", "digest"]
    first = slim.groupBy(*keys).agg(F.count("*").alias("times"), F.min(when).alias("first")).filter("times > 1")
    return slim.join(first.drop("times"), keys).filter(when > F.col("first")).drop("first")


def chunks(held: DataFrame, texts: bool, size: int) -> DataFrame:
    """Conversations that lie within a sorted partition, repaired, and chunks of the others."""
    marks = seen_before(held).withColumns({"many": F.lit(0).cast("bigint"), "text": F.lit(None).cast("string"), "row": F.lit(0)})
    rows = held.withColumn("row", F.lit(1)).unionByName(marks)
    order = ["who", "turn", "role", "head", "digest"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order, "row")
    schema = arrow_schema(_CHUNK)

    def made(who: str, conv_id: int | None, number: int, whole: bool, chunk: Chunk) -> list:
        table, part = blocks(), TaskContext.get().partitionId()
        codes = table.codes(chunk.symbols)
        columns = [who, conv_id, part, number, whole, chunk.first_turn, chunk.last_turn, chunk.turns, chunk.head, chunk.tail,
                   chunk.blank, chunk.duplicate, chunk.truncated, chunk.illegal]
        if whole:
            audit, state = table.trace(codes, 0, 0)
            writer = Writer(texts)
            audit += table.ending(state)
            writer.add(audit, (s == _GONE for s in chunk.symbols), zip(chunk.roles, chunk.texts), 0)
            _, before, cost = table.backward(codes, 0)
            columns += [None, None, None, None, None, None, table.vectors[before][0] + cost, audit, *writer.columns()]
        else:
            columns += [*(a.tobytes() for a in table.transition(codes)), codes.tobytes(), chunk.roles, chunk.texts, None, None, None, None]
        return columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[list] = []

        def batch_of(some: list[list]) -> pa.RecordBatch:
            return record_batch(list(map(list, zip(*some, strict=True))), schema)

        who = conv_id = chunk = None
        number, opening, seen = 0, True, False
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != who:
                    if who is not None:
                        waiting.append(made(who, conv_id, number, number == 0 and not opening, chunk))
                        opening = False
                    who, conv_id, chunk, number, seen = row[0], row[1], Chunk(size), 0, False
                _, _, turn, role, text, many, mark = row
                if mark == 0:
                    seen = True
                    continue
                while many > 0:
                    if chunk.full():
                        waiting.append(made(who, conv_id, number, False, chunk))
                        chunk, number = Chunk(size), number + 1
                    some = min(many, size)
                    chunk.add(turn, role, text, seen, some)
                    many, seen = many - some, True
                seen = False
                if len(waiting) >= 1000:
                    yield batch_of(waiting)
                    waiting = []
                elif number:  # chunks of a long conversation
                    for one in waiting:
                        yield batch_of([one])
                    waiting = []
        if who is not None:
            waiting.append(made(who, conv_id, number, False, chunk))
        if waiting:
            yield batch_of(waiting)

    return map_arrow(ranged.select("who", "conv_id", "turn", "role", "text", "many", "row"), run, _CHUNK)


def _solve(table: pa.Table) -> pa.Table:
    """What lies behind each chunk of a conversation, the state it begins in, and the conversation's sums."""
    own = table.sort_by([("part", "ascending"), ("number", "ascending")]).to_pylist()
    known = blocks()
    behind, total = 0, 0
    for row in reversed(own):
        row["behind"] = behind
        total += int(np.frombuffer(row["costs"], np.int64)[behind])
        behind = int(np.frombuffer(row["ids"], np.int16)[behind])
    total += known.vectors[behind][0]
    state, tail, last, turns, first = 0, "", None, 0, None
    sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
    for row in own:
        row["state"] = state
        state = int(np.frombuffer(row["exits"], np.int8).reshape(-1, 4)[row["behind"], state])
        for name in sums:
            sums[name] += row[name]
        if row["head"]:
            sums["illegal"] += bool(tail) and tail + row["head"] not in ("su", "ua", "au")
            tail = row["tail"]
        if row["turns"]:
            turns += row["turns"] - (row["first_turn"] == last)
            first, last = row["first_turn"] if first is None else first, row["last_turn"]
    gaps = last - first + 1 - turns if turns else 0
    rows = [{**row, **sums, "last": row is own[-1], "gaps": gaps, "cost": total} for row in own]
    return pa.Table.from_pylist([{f.name: r[f.name] for f in arrow_schema(_SOLVED)} for r in rows], arrow_schema(_SOLVED))


def _joined(open_chunks: DataFrame, texts: bool) -> DataFrame:
    """Repaired conversations of several chunks."""
    ship(open_chunks.sparkSession)
    slim = open_chunks.drop("whole", "codes", "roles", "texts", "cost", "audit", "repaired_sha256", "repaired")
    solved = slim.groupBy("who").applyInArrow(_solve, _SOLVED).withColumn("row", F.lit(0))
    held = open_chunks.select("who", "conv_id", "part", "number", "codes", "roles", "texts", F.lit(1).alias("row"))
    order = ["who", "part", "number", "row"]
    rows = solved.unionByName(held, allowMissingColumns=True).repartition("who").sortWithinPartitions(*order)
    schema = arrow_schema(RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, known, writer, audits = blocks(), None, Writer(texts), []
        for batch in batches:
            for i in range(len(batch)):
                row = {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}
                if row["row"] == 0:  # what is known of the chunk that follows
                    known = row
                    continue
                codes = np.frombuffer(row["codes"], "<i2")
                audit, state = table.trace(codes, known["behind"], known["state"])
                symbols = table.digits[codes].ravel()
                gone = iter((symbols[symbols != _NONE] == _GONE).tolist())
                audit += table.ending(state) if known["last"] else ""
                writer.add(audit, gone, zip(row["roles"], row["texts"]), known["state"])
                audits.append(audit)
                if known["last"]:
                    sums = [known[c] for c in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
                    yield record_batch([[x] for x in (*sums, "".join(audits), *writer.columns())], schema)
                    writer, audits = Writer(texts), []

    return map_arrow(rows, run, RESULT)


def repair(rows: DataFrame, texts: bool = False, size: int = CHUNK) -> DataFrame:
    """A row per conversation of ``rows`` (conv_id, turn, role, text, and ``many``, how often a row occurs).

    gaps, counts of faults, cost and audit of the cheapest edits, and the digest of the repaired rows; with
    ``texts`` also the repaired rows as ``role:text`` lines. Chunks have at most ``size`` rows.
    """
    made = stored(chunks(stored(counted(rows), "turns"), texts, size), "chunks")
    columns = [c.split(" ")[0] for c in RESULT.split(", ")]
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0))
    whole = made.filter("whole").withColumn("gaps", gaps).select(columns)
    out = whole.unionByName(_joined(made.filter("not whole"), texts))
    return out if texts else out.drop("repaired")
