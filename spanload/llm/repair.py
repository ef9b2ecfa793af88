"""Conversation structure repair: the cheapest edits that make a dialogue well formed.

A dialogue is well formed if its role initials read ``(s?(ua)+)?``.  Edits in order of
turns: Keep, Rerole, Delete, and Insert before a row.  A way through the grammar's states is
weighed by one integer: its high digits are the cost, and each row owns two low digits, which
spell the edits made at that row (an insert first), an unused one being zero.  No row's
spelling is the beginning of another's, so the least integer is the least cost and, among
those, the audit that comes first; an ordinary shortest path over (row, state) finds it.

A dialogue of any length is cut into blocks of ``BLOCK`` rows.  A block's least weights from
each state to each state are a 4 by 4 table of costs and of ranks of spellings, and tables of
neighbouring blocks combine by the same integer minimum, ``FAN`` at a time; states are then
handed down again, and each block spells its own edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from spanload.llm.common import small_batches, stage

BLOCK, BLOCK_BYTES, FAN = 256, 1 << 16, 256
BLANKS = " \t\n\x0b\f\r"

# Grammar states: nothing yet, after the system turn, after a user, after an assistant.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {EMPTY: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
WRITTEN = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # by an insert or a rerole
ROLE = {USER: "user", ASSISTANT: "assistant"}
TAIL = {EMPTY: 0, ASSISTANT: 0, USER: 1, SYSTEM: 2}  # inserts after the last row
LETTERS = " DIKR"  # digits 1 to 4, in the order of the letters
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
DIGIT = 3  # bits
SLOT = 2 * DIGIT  # one insert at most: a second would only close a circle of the grammar


def _edges(letter: str, extra: int) -> list[list[tuple[int, int, int]]]:
    """From each state: (state after the row, cost, spelling), the least for each state."""
    out = []
    for q in range(4):
        least = {q: (DELETE, LETTERS.index("D") << DIGIT)}
        for inserts in (0, 1):
            at = WRITTEN[q] if inserts else q
            ways = [("R", WRITTEN[at], REROLE)]
            if letter in NEXT[at]:
                ways.append(("K", NEXT[at][letter], KEEP))
            for edit, end, cost in ways:
                digit = LETTERS.index(edit)
                spelling = LETTERS.index("I") << DIGIT | digit if inserts else digit << DIGIT
                way = (cost + extra + INSERT * inserts, spelling)
                least[end] = min(least.get(end, way), way)
        out.append([(end, *way) for end, way in sorted(least.items())])
    return out


#: Lower case: a row's initial; upper case: the same, truncated.  ``x``: any other initial.
EDGES = {c if not extra else c.upper(): _edges(c, extra) for c in "suax" for extra in (0, TRUNCATED)}


@lru_cache(maxsize=1 << 12)
def _least(codes: str, start: int) -> tuple[int | None, ...]:
    """The least weight of a way from ``start`` over all rows to each state."""
    high, best = SLOT * len(codes), [None] * 4
    best[start] = 0
    for i, code in enumerate(codes):
        shift, new = SLOT * (len(codes) - 1 - i), [None] * 4
        for q, weight in enumerate(best):
            if weight is not None:
                for end, cost, spelling in EDGES[code][q]:
                    w = weight + (cost << high) + (spelling << shift)
                    if new[end] is None or w < new[end]:
                        new[end] = w
        best = new
    return tuple(best)


def _spelling(codes: str, weight: int) -> list[str]:
    """The edits at each row."""
    out = []
    for i in range(len(codes)):
        slot = weight >> SLOT * (len(codes) - 1 - i)
        out.append((LETTERS[slot >> DIGIT & 7] + LETTERS[slot & 7]).strip())
    return out


def _ranked(ways: list[list[int | None]], high: int) -> tuple[list[int], list[int]]:
    """Costs (-1: no way) and ranks of spellings, of the sixteen ways from state to state."""
    flat = [w for row in ways for w in row]
    low = (1 << high) - 1
    place = {s: i for i, s in enumerate(sorted({w & low for w in flat if w is not None}))}
    return [-1 if w is None else w >> high for w in flat], [0 if w is None else place[w & low] for w in flat]


def _combine(costs: list[list[int]], ranks: list[list[int]], start: int) -> tuple[list[int | None], list[list[int]]]:
    """Least weights over neighbouring tables from ``start``, four bits of rank a table; for
    each table and state the state before."""
    high, best, before = 4 * len(costs), [None] * 4, []
    best[start] = 0
    for i, (cost, rank) in enumerate(zip(costs, ranks, strict=True)):
        shift, new, came = 4 * (len(costs) - 1 - i), [None] * 4, [0] * 4
        for q, weight in enumerate(best):
            if weight is not None:
                for end in range(4):
                    if cost[4 * q + end] >= 0:
                        w = weight + (cost[4 * q + end] << high) + (rank[4 * q + end] << shift)
                        if new[end] is None or w < new[end]:
                            new[end], came[end] = w, q
        best = new
        before.append(came)
    return best, before


def _finish(costs: list[int], ranks: list[int]) -> int:
    """The state in which a whole dialogue's rows end best, given its table's row for EMPTY."""
    return min((costs[q] + INSERT * TAIL[q], ranks[q], q) for q in range(4) if costs[q] >= 0)[2]


# ---- rows in order -------------------------------------------------------------------------


def _ordered(df: DataFrame) -> DataFrame:
    """Rows by dialogue and turn, those that must go without their texts and with a count.

    Of equal rows of one role and text in a dialogue the first in order keeps its text."""
    last = F.substring(F.rtrim(F.col("text"), F.lit(BLANKS)), -1, 1)
    rows = (df.withColumn("head", F.substring("text", 1, 64)).withColumn("digest", F.md5("text"))
            .withColumn("blank", last == "")
            .withColumn("cut", ~last.isin(".", "!", "?")))
    keys = ["key", "turn", "role", "head", "digest"]
    first = (rows.where("not blank").groupBy("key", "conv", "role", "text")
             .agg(F.min(F.struct(F.col("turn").isNotNull(), "turn")).alias("least"), F.first("head").alias("head"),
                  F.first("digest").alias("digest"), F.first("cut").alias("cut")))
    counted = rows.groupBy(*keys, "conv", "blank").agg(F.count("*").alias("n"))
    seen = (counted.where("not blank").groupBy("key", "role", "digest")
            .agg(F.min(F.struct(F.col("turn").isNotNull(), "turn")).alias("least"), F.sum("n").alias("all"))
            .where("all > 1").drop("all"))
    again = (counted.where("not blank").join(seen, ["key", "role", "digest"])
             .withColumn("n", F.col("n") - F.col("turn").eqNullSafe(F.col("least.turn")).cast("long")).where("n > 0"))
    put = lambda f, fault, text: f.select(
        *keys, "conv", fault.alias("fault"), F.col("n").cast("long").alias("n"), text.alias("text"))
    nothing = F.lit(None).cast("string")
    rest = [put(again, F.lit("d"), nothing), put(counted.where("blank"), F.lit("b"), nothing)]
    out = put(first.withColumn("turn", F.col("least.turn")).withColumn("n", F.lit(1)),
              F.when(F.col("cut"), "T").otherwise(""), F.col("text"))
    for r in rest:
        out = out.unionByName(r)
    order = [*keys, "fault"]  # "", "T" come before "b", "d"
    return out.repartitionByRange(*order).sortWithinPartitions(*order)


BLOCKS = pa.schema([
    ("key", pa.string()), ("pid", pa.int32()), ("seq", pa.int32()), ("whole", pa.bool_()), ("codes", pa.string()),
    ("rows", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string()), ("n", pa.int64())]))),
    ("costs", pa.list_(pa.int64())), ("ranks", pa.list_(pa.int32())),
    ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("turns", pa.int64()),
    ("first_role", pa.string()), ("last_role", pa.string()), ("illegal", pa.int64()),
    ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64())])


class _Block:
    """Rows of one dialogue that follow each other, and what its report needs of them."""

    def __init__(self, key: str, seq: int):
        self.key, self.seq, self.rows, self.codes, self.size = key, seq, [], [], 0
        self.first_turn = self.last_turn = None
        self.first_role = self.last_role = ""
        self.turns = self.illegal = 0
        self.counts = {"b": 0, "d": 0, "T": 0}

    def add(self, turn, role: str, fault: str, n: int, text: str | None) -> None:
        initial = role[:1] or " "
        if not self.rows:
            self.first_role = initial
        else:
            self.illegal += _illegal(self.last_role, initial)
        self.illegal += n - 1  # the same role twice
        self.last_role = initial
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.last_turn = turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
        if fault:
            self.counts[fault] += n
        forced = fault in ("b", "d")
        code = initial if initial in "sua" else "x"
        self.codes.append("-" if forced else code.upper() if fault == "T" else code)
        self.rows.append((role, text, n))
        self.size += len(text or "")

    def full(self, most: int) -> bool:
        return len(self.rows) >= most or self.size >= BLOCK_BYTES

    def row(self, pid: int, whole: bool) -> dict:
        codes = "".join(self.codes)
        free = codes.replace("-", "")
        starts = [EMPTY] if whole else range(4)
        costs, ranks = _ranked([_least(free, q) for q in starts], SLOT * len(free))
        return {"key": self.key, "pid": pid, "seq": self.seq, "whole": whole, "codes": codes,
                "rows": [{"role": r, "text": t, "n": n} for r, t, n in self.rows], "costs": costs, "ranks": ranks,
                "first_turn": self.first_turn, "last_turn": self.last_turn, "turns": self.turns,
                "first_role": self.first_role, "last_role": self.last_role, "illegal": self.illegal,
                "blank": self.counts["b"], "duplicate": self.counts["d"], "truncated": self.counts["T"]}


def _illegal(a: str, b: str) -> int:
    return int(a + b not in ("su", "ua", "au"))


def _cut(most: int):
    """Blocks of a task's ordered rows.  Its first and last dialogues may go on in other tasks,
    so only a block that is alone between two others is known to be ``whole``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, out, block, begun, alone = TaskContext.get().partitionId(), [], None, 0, False
        for batch in batches:
            for key, turn, role, fault, n, text in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if block is None or key != block.key:
                    if block is not None:
                        out.append(block.row(pid, alone))
                    begun += 1
                    block, alone = _Block(key, 0), begun > 1
                elif block.full(most):
                    out.append(block.row(pid, False))
                    block, alone = _Block(key, block.seq + 1), False
                block.add(turn, role, fault, n, text)
                if len(out) >= 512:
                    yield pa.RecordBatch.from_pylist(out, schema=BLOCKS)
                    out = []
        if block is not None:
            out.append(block.row(pid, False))
            yield pa.RecordBatch.from_pylist(out, schema=BLOCKS)

    return run


# ---- tables of neighbouring blocks ---------------------------------------------------------

_TABLE = "key string, at long, costs array<long>, ranks array<int>"
_STATES = "key string, at long, start int, end int"


def _combined(table: pa.Table) -> pa.Table:
    """One table for up to ``FAN`` neighbours of a dialogue; ``up`` is its place."""
    table = table.sort_by("at")
    costs, ranks = table["costs"].to_pylist(), table["ranks"].to_pylist()
    ways = [_combine(costs, ranks, q)[0] for q in range(4)]
    cost, rank = _ranked(ways, 4 * len(costs))
    return pa.table({"key": [table["key"][0].as_py()], "at": [table["up"][0].as_py()], "costs": [cost],
                     "ranks": [rank]}, schema=pa.schema([("key", pa.string()), ("at", pa.int64()),
                                                         ("costs", pa.list_(pa.int64())), ("ranks", pa.list_(pa.int32()))]))


def _handed_down(table: pa.Table) -> pa.Table:
    """The states before and after each neighbour, given those of all together."""
    table = table.sort_by("at")
    start, q = table["start"][0].as_py(), table["end"][0].as_py()
    _, before = _combine(table["costs"].to_pylist(), table["ranks"].to_pylist(), start)
    ends = []
    for came in reversed(before):
        ends.append((came[q], q))
        q = came[q]
    ends.reverse()
    return pa.table({"key": table["key"], "at": table["at"], "start": [a for a, _ in ends], "end": [b for _, b in ends]},
                    schema=pa.schema([("key", pa.string()), ("at", pa.int64()), ("start", pa.int32()), ("end", pa.int32())]))


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ends = [_finish(c[:4], r[:4]) for c, r in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([EMPTY] * len(ends), pa.int32()),
                                          pa.array(ends, pa.int32())], names=["key", "at", "start", "end"])


def _states(open_blocks: DataFrame, fan: int) -> DataFrame:
    """``key, at, start, end`` of each block: tables combine upwards, ``fan`` at a time, until one
    is left of each dialogue, then the best states are handed down level by level."""
    levels = [stage(open_blocks.select("key", "at", "costs", "ranks"), "repair-tables")]
    most = levels[0].agg(F.max("at")).first()[0] or 0
    while most > 0:
        up = levels[-1].withColumn("up", F.floor(F.col("at") / fan).cast("long"))
        levels.append(stage(up.groupBy("key", "up").applyInArrow(_combined, _TABLE), "repair-tables"))
        most //= fan
    states = levels.pop().mapInArrow(_roots, _STATES)
    while levels:
        below = levels.pop().withColumn("up", F.floor(F.col("at") / fan).cast("long"))
        above = states.select("key", F.col("at").alias("up"), "start", "end")
        states = below.join(above, ["key", "up"]).groupBy("key", "up").applyInArrow(_handed_down, _STATES)
    return states


# ---- edits ----------------------------------------------------------------------------------

_EDITS = ("key string, pid int, seq int, cost long, first_turn long, last_turn long, turns long, first_role string, "
          "last_role string, illegal long, blank long, duplicate long, truncated long, "
          "edits array<struct<edit:string,role:string,text:string,n:long>>")


def _spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept = ("key", "pid", "seq", "first_turn", "last_turn", "turns", "first_role", "last_role", "illegal", "blank",
            "duplicate", "truncated")
    edit = pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string()), ("n", pa.int64())])
    for batch in batches:
        costs, edits = [], []
        for row in batch.select(["codes", "rows", "whole", "costs", "ranks", "start", "end", "last"]).to_pylist():
            start, end = row["start"], row["end"]
            if row["whole"]:
                start, end = EMPTY, _finish(row["costs"], row["ranks"])
            codes, free = row["codes"], row["codes"].replace("-", "")
            weight = _least(free, start)[end]
            spelled, out, q, cost = iter(_spelling(free, weight)), [], start, weight >> SLOT * len(free)
            for code, r in zip(codes, row["rows"], strict=True):
                if code == "-":
                    cost += DELETE * r["n"]
                    out.append({"edit": "D", "role": None, "text": None, "n": r["n"]})
                    continue
                for letter in next(spelled):
                    if letter == "D":
                        out.append({"edit": "D", "role": None, "text": None, "n": 1})
                        continue
                    q = NEXT[q][code.lower()] if letter == "K" else WRITTEN[q]
                    out.append({"edit": letter, "role": r["role"] if letter == "K" else ROLE[q],
                                "text": "" if letter == "I" else r["text"], "n": 1})
            if row["last"]:
                for _ in range(TAIL[q]):
                    q = WRITTEN[q]
                    cost += INSERT
                    out.append({"edit": "I", "role": ROLE[q], "text": "", "n": 1})
            costs.append(cost)
            edits.append(out)
        cols = {c: batch.column(c) for c in kept} | {"cost": pa.array(costs, pa.int64()), "edits": pa.array(edits, pa.list_(edit))}
        names = [f.split()[0] for f in _EDITS.split(", ")]
        yield pa.RecordBatch.from_arrays([cols[n] for n in names], names=names)


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """Pieces of repaired dialogues in order of (``pid``, ``seq``), each with its edits.

    Columns ``conv_id, pid, seq, cost, edits`` (array of ``edit, role, text, n``: the letter, the
    role and text that stand after it, null for deleted rows, and for how many equal rows it
    stands) and what ``report`` adds up: turns, role initials and faults of the rows.

    Rows are in order of (turn, role, first 64 characters of the text, its digest), null turns
    first.  A row's first fault counts: blank, duplicate (role and text seen earlier in the
    dialogue), truncated.  Null roles and texts stand for one space, so null texts are blank
    and null roles are never kept.  A null id is a dialogue.  Equal rows of one turn are
    duplicates of the first.  An empty table gives no rows.  Other columns are not looked at.
    """
    small_batches(df.sparkSession)
    own = df.select(_key(F.col(f"`{conv}`")).alias("key"), F.col(f"`{conv}`").alias("conv"),
                    F.col(f"`{turn}`").cast("long").alias("turn"), F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
                    F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"))
    ordered = _ordered(own).select("key", "turn", "role", "fault", "n", "text")
    blocks = stage(ordered.mapInArrow(_cut(block), from_arrow_schema(BLOCKS)), "repair-blocks")
    per_task = (blocks.where("not whole").agg(F.max("seq")).first()[0] or 0) + 1
    at = F.col("pid").cast("long") * per_task + F.col("seq")
    states = stage(_states(blocks.where("not whole").withColumn("at", at), fan), "repair-states")
    last = states.groupBy("key").agg(F.max("at").alias("end_at"))
    known = (blocks.where("not whole").withColumn("at", at).join(states, ["key", "at"]).join(last, "key")
             .withColumn("last", F.col("at") == F.col("end_at")).drop("at", "end_at"))
    whole = (blocks.where("whole").withColumn("start", F.lit(0)).withColumn("end", F.lit(0))
             .withColumn("last", F.lit(True)))
    names = df.select(F.col(f"`{conv}`").alias("conv_id")).distinct().withColumn("key", _key(F.col("conv_id")))
    edits = known.unionByName(whole).mapInArrow(_spelled, _EDITS)
    return edits.join(names, "key")


def _key(conv):
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit(""))


_REPORT = ("key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "repaired_sha256 string")


def _reported(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, out, now = [f.split()[0] for f in _REPORT.split(", ")], [], None

    def closed() -> dict:
        first, last = now.pop("first"), now.pop("last_turn")
        now["gaps"] = 0 if first is None else last - first + 1 - now["turns"]
        now["audit"] = "".join(now["audit"])
        now["repaired_sha256"] = now["sha"].hexdigest()
        return {n: now[n] for n in names}

    schema = pa.schema([(n, pa.string() if n in ("key", "audit", "repaired_sha256") else pa.int64()) for n in names])
    for batch in batches:
        for row in batch.to_pylist():
            if now is None or row["key"] != now["key"]:
                if now is not None:
                    out.append(closed())
                now = {"key": row["key"], "first": None, "last_turn": None, "turns": 0, "illegal": 0, "cost": 0, "blank": 0,
                       "duplicate": 0, "truncated": 0, "audit": [], "sha": hashlib.sha256(), "role": None, "any": False}
            for c in ("illegal", "cost", "blank", "duplicate", "truncated"):
                now[c] += row[c]
            if now["role"] is not None:
                now["illegal"] += _illegal(now["role"], row["first_role"])
            now["role"] = row["last_role"]
            if row["first_turn"] is not None:
                now["turns"] += row["turns"] - (row["first_turn"] == now["last_turn"])
                now["first"] = row["first_turn"] if now["first"] is None else now["first"]
                now["last_turn"] = row["last_turn"]
            for e in row["edits"]:
                now["audit"].append(e["edit"] * e["n"])
                if e["edit"] != "D":
                    now["sha"].update(f"{chr(10) if now['any'] else ''}{e['role']}:{e['text']}".encode("utf-8", "surrogatepass"))
                    now["any"] = True
            now["audit"] = ["".join(now["audit"])]
            if len(out) >= 1024:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
    if now is not None:
        out.append(closed())
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def report(pieces: DataFrame) -> DataFrame:
    """One row a dialogue of ``repair``'s pieces: ``conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256``.

    A dialogue's pieces pass one task in order, for SHA-256 can't be put together from parts;
    held are the hash's state and the audit, never the texts."""
    names = pieces.select("key", "conv_id").distinct()
    order = pieces.drop("conv_id").repartition("key").sortWithinPartitions("key", "pid", "seq")
    return order.mapInArrow(_reported, _REPORT).join(names, "key").drop("key")


def damage(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with faults put in by the CRC-32 of ``conv:turn`` modulo 20 (nulls of any column are one
    space): 0 loses the row, 1 its text, 2 its ends of sentences, 3 doubles it, 4 makes it a user's."""
    space = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(space(conv), F.lit(":"), space(turn)).cast("binary")) % 20
    spoiled = F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, F.translate(space(text), ".!?", "")).otherwise(space(text))
    return (df.select(F.col(f"`{conv}`"), F.col(f"`{turn}`"), F.col(f"`{role}`"), F.col(f"`{text}`"), fault.alias("_fault"))
            .where("_fault <> 0")
            .withColumn("_times", F.explode(F.sequence(F.lit(1), F.when(F.col("_fault") == 3, 2).otherwise(1))))
            .select(F.col(f"`{conv}`"), F.col(f"`{turn}`"),
                    F.when(F.col("_fault") == 4, "user").otherwise(space(role)).alias(role), spoiled.alias(text)))
