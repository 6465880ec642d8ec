"""Conversation structure repair by generalised LR parsing with weighted edits.

The role grammar says which sequences of roles a conversation may have. A table-driven LR automaton is
built from it; a parse keeps a graph-structured stack, whose nodes (automaton state, node below) are shared between
all stacks that have the same rest. Each row may be kept, given another role or deleted, and empty
turns may be inserted; every such edit moves stack tops to new ones, and equal tops are merged by
the minimum of (cost, audit).

On Spark, rows are put in order by a range partitioning, so a long conversation is spread over several
tasks. Each task turns its part into paths from every top the part may begin with (only the first
conversation of a task can be a continuation) to every top that it may end with; a second, narrow
pass chains the parts. The grammar is left recursive, so its stacks are shallow and the number of tops is a constant.
A last pass streams the rows once more beside their audit and gives the repaired rows, or their digest,
in bounded memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from airlake.llm.common import prepare, written

# The role grammar over initials: an optional system turn, then pairs of user and assistant; or nothing.
GRAMMAR = (("talk", ""), ("talk", "T"), ("talk", "sT"), ("T", "ua"), ("T", "Tua"))
START, END = "talk", "$"
ROLES = {"u": "user", "a": "assistant"}
# What the edits cost.
KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
OK, TRUNCATED, DUPLICATE, BLANK = range(4)
PAIRS = ("su", "ua", "au")


# The automaton ------------------------------------------------------------------------


def _productions() -> list[tuple[str, tuple[str, ...]]]:
    return [(left, tuple(right)) for left, right in GRAMMAR]


def _closure(items: set[tuple[int, int]]) -> frozenset:
    rules, todo, found = _productions(), list(items), set(items)
    while todo:
        rule, dot = todo.pop()
        right = rules[rule][1]
        if dot < len(right):
            for k, (left, _) in enumerate(rules):
                if left == right[dot] and (k, 0) not in found:
                    found.add((k, 0))
                    todo.append((k, 0))
    return frozenset(found)


@lru_cache(maxsize=None)
def _goto(state: frozenset, symbol: str) -> frozenset:
    rules = _productions()
    moved = {(k, dot + 1) for k, dot in state if rules[k][1][dot : dot + 1] == (symbol,)}
    return _closure(moved)


@lru_cache(maxsize=None)
def _follow() -> dict[str, set[str]]:
    """Symbols that may come after each left side."""
    rules = _productions()
    lefts = {left for left, _ in rules}
    first = {left: set() for left in lefts}
    follow = {left: {END} if left == START else set() for left in lefts}
    size = -1
    while size != (size := sum(map(len, (*first.values(), *follow.values())))):
        for left, right in rules:
            if right:
                first[left] |= first.get(right[0], {right[0]})
            for here, after in zip(right, (*right[1:], None)):
                if here in lefts:
                    follow[here] |= follow[left] if after is None else first.get(after, {after})
    return follow


def _tops(node: tuple, ahead: str) -> set[tuple]:
    """The stacks that reductions under a lookahead make of a stack, itself included."""
    rules, found, todo = _productions(), {node}, [node]
    while todo:
        top = todo.pop()
        for k, dot in top[0]:
            left, right = rules[k]
            if dot != len(right) or ahead not in _follow()[left]:
                continue
            below = top
            for _ in right:
                below = below[1]
            if left == START:
                continue  # accepting, see _accepts
            new = (_goto(below[0], left), below)
            if new[0] and new not in found:
                found.add(new)
                todo.append(new)
    return found


def _accepts(node: tuple) -> bool:
    rules = _productions()
    return any(
        rules[k][0] == START and dot == len(rules[k][1]) for top in _tops(node, END) for k, dot in top[0]
    )


class Automaton:
    """All stack tops of the grammar by number, with their moves; 0 is the empty stack."""

    def __init__(self):
        root = (_closure({(k, 0) for k, (left, _) in enumerate(_productions()) if left == START}), None)
        symbols = sorted({s for _, right in GRAMMAR for s in right if s.islower()})
        nodes, self.shifts = [root], []
        for node in nodes:  # grows while new tops are found
            moves = {}
            for symbol in symbols:
                for top in _tops(node, symbol):
                    if state := _goto(top[0], symbol):
                        new = _settled((state, top))
                        if new not in nodes:
                            nodes.append(new)
                        moves.setdefault(symbol, []).append(nodes.index(new))
            self.shifts.append(moves)
        self.accepting = [_accepts(node) for node in nodes]
        self.size = len(nodes)
        self._steps: dict[tuple, list] = {}

    def inserted(self, node: int) -> dict[int, int]:
        """Tops that insertions reach from a top, with how many they take at least."""
        found, edge, count = {node: 0}, [node], 0
        while edge:
            count += 1
            edge = list(dict.fromkeys(
                new for top in edge for symbol in ROLES for new in self.shifts[top].get(symbol, ()) if new not in found
            ))
            found |= dict.fromkeys(edge, count)
        return found

    def steps(self, node: int, initial: str, fault: int) -> list[tuple[int, int, str]]:
        """(new top, cost, edits) of taking one row, with the insertions before it; the cheapest per new top.

        Edits end with the row's own, so no audit at a row's end is the beginning of another and the
        order of two audits never changes by what follows.
        """
        key = (node, initial, fault)
        if key not in self._steps:
            best: dict[int, tuple[int, str]] = {}

            def offer(new: int, cost: int, edits: str) -> None:
                if new not in best or (cost, edits) < best[new]:
                    best[new] = (cost, edits)

            for top, count in self.inserted(node).items():
                cost, before = INSERT * count, "I" * count
                offer(top, cost + DELETE, before + "D")
                if fault < DUPLICATE:
                    cost += CUT * (fault == TRUNCATED)
                    for new in self.shifts[top].get(initial, ()):
                        offer(new, cost + KEEP, before + "K")
                    for symbol in ROLES:
                        for new in self.shifts[top].get(symbol, ()):
                            offer(new, cost + REROLE, before + "R")
            self._steps[key] = [(new, cost, edits) for new, (cost, edits) in best.items()]
        return self._steps[key]


def _settled(node: tuple) -> tuple:
    """Reduce as long as a state can do nothing else, so that equal futures are equal tops."""
    rules = _productions()
    while len(node[0]) == 1:
        ((k, dot),) = node[0]
        left, right = rules[k]
        if dot != len(right) or left == START:
            break
        for _ in right:
            node = node[1]
        node = (_goto(node[0], left), node)
    return node


@lru_cache(maxsize=1)
def automaton() -> Automaton:
    return Automaton()


class Paths:
    """The merged stack tops after some rows, all begun at one top: (cost, rank, trail) per top.

    ``rank`` orders the audits of all tops. A trail is (trail before, edits): audits share their beginnings and
    those that no top needs any more are freed.
    """

    def __init__(self, entry: int):
        self.tops = {entry: (0, 0, None)}

    def take(self, initial: str, fault: int) -> None:
        table, best = automaton(), {}
        for node, (cost, rank, trail) in self.tops.items():
            for new, more, edits in table.steps(node, initial, fault):
                offer = (cost + more, rank, edits)
                if new not in best or offer < best[new][0]:
                    best[new] = (offer, trail)
        order = {key: i for i, key in enumerate(sorted({offer[1:] for offer, _ in best.values()}))}
        self.tops = {new: (o[0], order[o[1:]], (trail, o[2])) for new, (o, trail) in best.items()}

    def exits(self) -> Iterator[tuple[int, int, str]]:
        """(top, cost, audit)"""
        for node, (cost, _, trail) in self.tops.items():
            parts = []
            while trail is not None:
                trail, edits = trail
                parts.append(edits)
            yield node, cost, "".join(reversed(parts))


def finish(tops: dict[int, tuple[int, str]]) -> tuple[int, str]:
    """The cheapest accepted (cost, audit), after what is inserted at the end."""
    table = automaton()
    return min(
        (cost + INSERT * count, audit + "I" * count)
        for node, (cost, audit) in tops.items()
        for last, count in table.inserted(node).items()
        if table.accepting[last]
    )


# Faults -------------------------------------------------------------------------------

_VISIBLE = r"[^\x20\x09-\x0D]"
_ORDER = ("conv_id", "turn", "role", "digest")


def marked(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, text, n, fault): distinct rows with their number and the first one's fault.

    ``n`` equal rows of a turn are one row here, reduced before the shuffle. A row is a duplicate if its role and text
    come in an earlier turn; nulls come first.
    """
    blank = F.lit(" ")
    plain = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
    )
    distinct = plain.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n"))
    distinct = written(distinct.withColumn("digest", F.unhex(F.sha2("text", 256))), "turns")
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    again = distinct.groupBy("conv_id", "role", "digest").agg(F.count("*").alias("k"), F.min(place).alias("first"))
    again = written(again.where("k > 1").select(
        F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first"
    ), "repeats")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    earlier = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(place)
    # The last visible character decides; trailing white space is cut off first.
    end = F.substring(F.rtrim(F.translate("text", "\t\n\x0b\x0c\r", "     ")), -1, 1)
    fault = (
        F.when(end == "", BLANK).when(earlier, DUPLICATE).when(~end.isin(".", "!", "?"), TRUNCATED).otherwise(OK)
    )
    return distinct.join(again, same, "left").select(
        "conv_id", "turn", "role", "digest", "text", "n", fault.cast("int").alias("fault")
    )


# Passes over the rows -----------------------------------------------------------------

_PATH = pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
_SEGMENT = pa.schema(
    [
        ("conv_id", pa.int64()), ("part", pa.int32()), ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64()),
        ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
        ("first", pa.string()), ("last", pa.string()), ("paths", pa.list_(_PATH)),
    ]
)
SEGMENT = (
    "conv_id long, part int, low long, high long, turns long, blank long, duplicate long, truncated long, "
    "illegal long, first string, last string, paths array<struct<entry:int,exit:int,cost:long,audit:string>>"
)
REPAIR = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_REPAIR = pa.schema(
    [("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
     ("audit", pa.string())]
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


class _Segment:
    """What one task sees of one conversation, row by row in order."""

    def __init__(self, conv_id: int | None, continued: bool):
        self.conv_id = conv_id
        self.low = self.high = self.first = self.last = None
        self.turns = self.illegal = 0
        self.faults = [0] * 4
        self.paths = {entry: Paths(entry) for entry in (range(automaton().size) if continued else (0,))}

    def take(self, turn: int | None, initial: str, n: int, fault: int) -> None:
        if turn is not None:
            self.turns += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn
        for k in range(n):
            # Further equal rows are duplicates of the first.
            kind = max(fault, DUPLICATE) if k else fault
            self.faults[kind] += 1
            self.illegal += self.last is not None and self.last + initial not in PAIRS
            self.first = initial if self.first is None else self.first
            self.last = initial
            for paths in self.paths.values():
                paths.take(initial, kind)

    def row(self, part: int) -> tuple:
        paths = [
            {"entry": entry, "exit": node, "cost": cost, "audit": audit}
            for entry, p in self.paths.items()
            for node, cost, audit in p.exits()
        ]
        return (
            self.conv_id, part, self.low, self.high, self.turns, self.faults[BLANK], self.faults[DUPLICATE],
            self.faults[TRUNCATED], self.illegal, self.first, self.last, paths,
        )


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A segment per conversation and task; rows come in order."""
    from pyspark import TaskContext

    part, held = TaskContext.get().partitionId(), None
    for batch in batches:
        rows = []
        for conv_id, turn, initial, n, fault in zip(*(c.to_pylist() for c in batch.columns)):
            if held is None or held.conv_id != conv_id:
                if held is not None:
                    rows.append(held.row(part))
                held = _Segment(conv_id, continued=held is None)
            held.take(turn, initial, n, fault)
        yield _batch(rows, _SEGMENT)
    if held is not None:
        yield _batch([held.row(part)], _SEGMENT)


class _Chain:
    """Segments of one conversation, put together in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.low, self.high, self.last = conv_id, None, None, None
        self.counts = [0] * 5  # turns, blank, duplicate, truncated, illegal
        # Cost, order of the audit and its pieces, per top.
        self.tops = {0: (0, 0, ())}

    def add(self, low, high, turns, blank, duplicate, truncated, illegal, first, last, paths) -> None:
        if turns:
            turns -= low == self.high  # a turn on both sides of a cut
            self.low = low if self.low is None else self.low
            self.high = high
        illegal += self.last is not None and self.last + first not in PAIRS
        self.last = last
        self.counts = [a + b for a, b in zip(self.counts, (turns, blank, duplicate, truncated, illegal))]
        best: dict[int, tuple] = {}
        for path in paths:
            if path["entry"] in self.tops:
                cost, rank, pieces = self.tops[path["entry"]]
                offer = (cost + path["cost"], rank, path["audit"])
                if path["exit"] not in best or offer < best[path["exit"]][0]:
                    best[path["exit"]] = (offer, pieces)
        order = {key: i for i, key in enumerate(sorted({o[1:] for o, _ in best.values()}))}
        self.tops = {node: (o[0], order[o[1:]], (pieces, o[2])) for node, (o, pieces) in best.items()}

    def row(self) -> tuple:
        tops = {}
        for node, (cost, _, pieces) in self.tops.items():
            parts = []
            while pieces:
                pieces, audit = pieces
                parts.append(audit)
            tops[node] = (cost, "".join(reversed(parts)))
        cost, audit = finish(tops)
        turns, *counts = self.counts
        gaps = 0 if self.low is None else self.high - self.low + 1 - turns
        return (self.conv_id, gaps, *counts, cost, audit)


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None
    for batch in batches:
        rows = []
        for conv_id, _, *values in zip(*(c.to_pylist() for c in batch.columns)):
            if held is None or held.conv_id != conv_id:
                if held is not None:
                    rows.append(held.row())
                held = _Chain(conv_id)
            held.add(*values)
        yield _batch(rows, _REPAIR)
    if held is not None:
        yield _batch([held.row()], _REPAIR)


def plan_repairs(turns: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) from :func:`marked` rows."""
    partitions = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        turns.select(*_ORDER, F.substring("role", 1, 1).alias("initial"), "n", "fault")
        .repartitionByRange(partitions, *_ORDER)
        .sortWithinPartitions(*_ORDER)
        .select("conv_id", "turn", "initial", "n", "fault")
    )
    segments = written(ordered.mapInArrow(_segments, SEGMENT), "segments")
    chained = segments.repartition(partitions, "conv_id").sortWithinPartitions("conv_id", "part")
    return chained.mapInArrow(_chain, REPAIR)


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, None) before each conversation's first row, then (conv_id, (role, text, edit)) per repaired row.

    An audit comes before the rows of its conversation. Deleted rows give nothing.
    """
    conv_id, audit, at, out = None, "", 0, ""

    def insertions():
        nonlocal at, out
        while audit[at : at + 1] == "I":
            at += 1
            yield put("", "", "I")

    def put(role, text, edit):
        nonlocal out
        symbol = role[:1] if edit == "K" else "a" if out == "u" else "u"
        out = symbol
        return conv_id, (role if edit == "K" else ROLES[symbol], text, edit)

    for batch in batches:
        for conversation, is_row, role, text, n in zip(*(c.to_pylist() for c in batch.columns)):
            if not is_row:
                yield from insertions()  # at the end of the conversation before
                conv_id, audit, at, out = conversation, text, 0, ""
                yield conv_id, None
                continue
            for _ in range(n):
                yield from insertions()
                edit, at = audit[at], at + 1
                if edit != "D":
                    yield put(role, text, edit)
    yield from insertions()


_TURNS = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size, position = [], 0, 0
    for conv_id, turn in _applied(batches):
        if turn is None:
            position = 0
            continue
        held.append((conv_id, position, *turn))
        position, size = position + 1, size + len(turn[1])
        if len(held) >= 4096 or size > 1 << 20:
            yield _batch(held, _TURNS)
            held, size = [], 0
    if held:
        yield _batch(held, _TURNS)


_HASHES = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    done, held, digest, empty = [], None, None, True
    for conv_id, turn in _applied(batches):
        if turn is None:
            if digest is not None:
                done.append((held, digest.hexdigest()))
            held, digest, empty = conv_id, hashlib.sha256(), True
            if len(done) >= 4096:
                yield _batch(done, _HASHES)
                done = []
            continue
        digest.update(("" if empty else "\n").encode() + f"{turn[0]}:{turn[1]}".encode())
        empty = False
    if digest is not None:
        done.append((held, digest.hexdigest()))
    if done:
        yield _batch(done, _HASHES)


def _beside(turns: DataFrame, repairs: DataFrame) -> DataFrame:
    """Rows in order, each conversation after its audit. Only ordering needs a conversation together: it is streamed."""
    nothing = F.lit(None)
    audits = repairs.select(
        "conv_id", F.lit(0).alias("is_row"), nothing.cast("long").alias("turn"), F.lit("").alias("role"),
        nothing.cast("binary").alias("digest"), F.col("audit").alias("text"), F.lit(1).cast("long").alias("n"),
    )
    rows = turns.select("conv_id", F.lit(1).alias("is_row"), "turn", "role", "digest", "text", "n")
    partitions = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ("conv_id", "is_row", "turn", "role", "digest")
    return (
        audits.union(rows)
        .repartition(partitions, "conv_id")
        .sortWithinPartitions(*order)
        .select("conv_id", "is_row", "role", "text", "n")
    )


def repair_conversations(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(reports, turns, hashes) of a conversation table (conv_id, turn, role, text).

    ``reports``: (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit), one row per conversation.
    ``turns``: the repaired conversations (conv_id, position, role, text, edit), without what was deleted.
    ``hashes``: (conv_id, repaired_sha256) of ``role:text``, joined by newlines.

    Rows are taken by turn, nulls first; rows of one turn by role, then by the SHA-256 of the text.
    A null role or text is one space; rows with a null conv_id are one conversation. Repeated rows are
    duplicates of the first. A role whose initial is none of the grammar's, or an empty one, can be given another role or
    deleted. Other columns are not read; an empty table gives no rows. A conversation's hash and its repaired rows are made in one
    task, as SHA-256 runs over the text in order, but with one row in memory at a time beside the audit.
    """
    prepare(rows.sparkSession)
    turns = written(marked(rows), "marked")
    reports = written(plan_repairs(turns), "repairs")
    ordered = _beside(turns, reports)
    repaired = ordered.mapInArrow(_turns, "conv_id long, position long, role string, text string, edit string")
    return reports, repaired, ordered.mapInArrow(_hashes, "conv_id long, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """The conversations with planted faults, by crc32 of ``conv_id:turn`` modulo 20; nulls are one space.

    0 drops the row, 1 empties the text, 2 removes its full stops, exclamation and question marks, 3 repeats the
    row, 4 makes it the user's.
    """
    def filled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    spot = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    text = F.when(spot == 1, "").when(spot == 2, F.translate(filled("text"), ".!?", "")).otherwise(filled("text"))
    role = F.when(spot == 4, "user").otherwise(filled("role"))
    copies = F.explode(F.sequence(F.lit(1), F.when(spot == 3, 2).otherwise(1)))
    return conversations.where(spot != 0).select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")
    ).drop("copy")


# Damage, faults and repairs in DuckDB. States: 0 nothing, 1 after system, 2 after user, 3 after assistant.
REPAIR_SQL = r"""
with recursive keyed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key
  from {table}
), spotted as (
  select *, xor(4294967295::ubigint, list_reduce(
      list_transform(string_split(key, ''), lambda ch: ascii(ch)::ubigint),
      lambda crc, byte: list_reduce(
        [0, 0, 0, 0, 0, 0, 0, 0]::ubigint[],
        lambda c, b: xor(c >> 1, case when c & 1 = 1 then 3988292384::ubigint else 0::ubigint end),
        xor(crc, byte)),
      4294967295::ubigint)) % 20 as spot
  from keyed
), hurt as (
  select conv_id, turn, case when spot = 4 then 'user' else role end as role,
    case when spot = 1 then '' when spot = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(range(case when spot = 3 then 2 else 1 end)) as copy
  from spotted where spot <> 0
), placed as (
  select *, substr(role, 1, 1) as initial,
    row_number() over (partition by conv_id order by turn nulls first, role, sha256(text)) as i
  from hurt
), repeated as (
  select *, row_number() over (partition by conv_id, role, text order by i) as seen from placed
), faulted as (
  select *, lag(initial) over (partition by conv_id order by i) || initial as pair,
    case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 3 when seen > 1 then 2
      when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') then 1 else 0 end as fault
  from repeated
), pre(src, mid, ins, cost, said) as (
  values (0, 0, '', 0, ''), (0, 2, 'I', 3, chr(10) || 'user:'), (0, 3, 'II', 6, chr(10) || 'user:' || chr(10) || 'assistant:'),
    (1, 1, '', 0, ''), (1, 2, 'I', 3, chr(10) || 'user:'), (1, 3, 'II', 6, chr(10) || 'user:' || chr(10) || 'assistant:'),
    (2, 2, '', 0, ''), (2, 3, 'I', 3, chr(10) || 'assistant:'),
    (3, 3, '', 0, ''), (3, 2, 'I', 3, chr(10) || 'user:')
), shifts(mid, sym, dst, said_as) as (
  values (0, 's', 1, ''), (0, 'u', 2, 'user'), (1, 'u', 2, 'user'), (2, 'a', 3, 'assistant'), (3, 'u', 2, 'user')
), edits as (
  select src, mid as dst, ins || 'D' as edit, 'D' as kind, '' as sym, cost + 4 as cost, said, '' as said_as from pre
  union all select src, dst, ins || 'K', 'K', sym, cost, said, said_as from pre join shifts using (mid)
  union all select src, dst, ins || 'R', 'R', sym, cost + 3, said, said_as from pre join shifts using (mid) where sym <> 's'
), parse as (
  select distinct conv_id, 0::bigint as i, 0 as state, 0 as cost, '' as audit, '' as said from faulted
  union all
  select conv_id, i, state, cost, audit, said from (
    select f.conv_id, f.i, e.dst as state,
      p.cost + e.cost + case when e.kind <> 'D' and f.fault = 1 then 3 else 0 end as cost, p.audit || e.edit as audit,
      p.said || e.said || case e.kind when 'D' then '' when 'K' then chr(10) || f.role || ':' || f.text
        else chr(10) || e.said_as || ':' || f.text end as said
    from parse p join faulted f on f.conv_id is not distinct from p.conv_id and f.i = p.i + 1
      join edits e on e.src = p.state
        and (e.kind = 'D' or f.fault < 2 and (e.kind = 'R' or e.sym = f.initial))
  ) qualify row_number() over (partition by conv_id, state order by cost, audit) = 1
), ended as (
  select p.conv_id, p.cost + pre.cost as cost, p.audit || pre.ins as audit, p.said || pre.said as said
  from parse p join pre on pre.src = p.state and pre.mid in (0, 3)
  where p.i = (select max(f.i) from faulted f where f.conv_id is not distinct from p.conv_id)
  qualify row_number() over (partition by p.conv_id order by p.cost + pre.cost, p.audit || pre.ins) = 1
), counted as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
    count(*) filter (fault = 3)::bigint as blank, count(*) filter (fault = 2)::bigint as duplicate,
    count(*) filter (fault = 1)::bigint as truncated,
    count(*) filter (pair not in ('su', 'ua', 'au'))::bigint as illegal
  from faulted group by conv_id
)
select a.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank,
  coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
  coalesce(illegal, 0)::bigint as illegal, coalesce(cost, 0)::bigint as cost, coalesce(audit, '') as audit,
  sha256(coalesce(substr(said, 2), '')) as repaired_sha256
from (select distinct conv_id from {table}) a
  left join counted c on c.conv_id is not distinct from a.conv_id
  left join ended e on e.conv_id is not distinct from a.conv_id
"""
