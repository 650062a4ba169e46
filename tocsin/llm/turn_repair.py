"""Cheapest repair of damaged conversations by depth-first branch and bound.

A conversation's rows are taken by turn, nulls first; rows of one turn by role and then
by the MD5 of their text. Its edits, in order, spell an audit: Keep costs 0, Rerole (to
user or assistant) 2, Delete 3, Insert (an empty user or assistant row) 2. Blank rows and
repeats of a role and text must be deleted; a truncated row that stays costs 1 more. The
initials of the roles that result are ``(s?(ua)+)?``. Of the cheapest audits the least
in ASCII order is returned.

``search`` is the branch and bound: an explicit stack, for each row and role state a
lower bound of what the rows behind it cost, an incumbent (cost, audit), and a table of
the least cost at which each node was reached, which ends worse prefixes.

Rows are range-sorted without their texts and cut into segments of at most ``SEGMENT``
rows, so a conversation with a third of all rows is searched by many tasks. A segment's
costs from each state to each state, 16 numbers, give the bound behind the segment
before it; then each segment is searched on its own from every state, and the searches
are chained from the first. Only the replay of the edits on the texts takes a
conversation as one stream, since a digest of it is one; it holds a batch and the audit
of a segment, never the conversation.

Defined results: a null role or text is one space, so null texts are blank; a null
turn comes first; a null conversation id is a conversation; equal rows are repeats of
each other; roles other than those that begin with s, u and a can't be kept; texts have
no length limit; an empty table gives an empty result. Further columns are not looked at,
whatever their names.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tocsin.llm.common import bounded_batches, stored
from tocsin.llm.ranged import ranges

#: Fixed by the contract: blanks, ends of sentences, costs.
BLANKS = " \t\n\x0b\f\r"
ENDS = (".", "!", "?")
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Rows searched at a time.
SEGMENT = 50_000

#: Role states: nothing yet, after system, after user, after assistant; what an inserted
#: or reroled row leads to; where a conversation may end.
ADVANCE = (2, 2, 3, 2)
ACCEPTED = (True, False, False, True)
STATES = range(4)
#: A row's code is its role initial (0 other, 1 s, 2 u, 3 a), 4 if it must go, 8 if truncated.
MUST_GO, CUT = 4, 8
NEVER = 1 << 60
LEGAL = ((1, 2), (2, 3), (3, 2))


def kept_state(state: int, code: int) -> int | None:
    """The state after keeping a row, None if its role can't stand there."""
    initial = code & 3
    if code & MUST_GO or not initial:
        return None
    if initial == 1:
        return 1 if state == 0 else None
    return initial if ADVANCE[state] == initial else None


def with_inserts(after: list[int]) -> list[int]:
    """Costs of the states if rows may be inserted first."""
    user, assistant = min(after[2], INSERT + after[3]), min(after[3], INSERT + after[2])
    return [min(after[0], INSERT + user), min(after[1], INSERT + user), user, assistant]


def lower_bounds(codes: bytes, tail: list[int]) -> list[list[int]]:
    """For each row and state, what the rows from there on cost at least, audits aside.
    ``tail`` is the cost behind the last row."""
    bounds = [list(tail)]
    for code in reversed(codes):
        nxt, stay, now = bounds[-1], TRUNCATED if code & CUT else 0, []
        for state in STATES:
            cost = DELETE + nxt[state]
            if not code & MUST_GO:
                cost = min(cost, REROLE + stay + nxt[ADVANCE[state]])
                if (kept := kept_state(state, code)) is not None:
                    cost = min(cost, stay + nxt[kept])
            now.append(cost)
        bounds.append(with_inserts(now))
    return bounds[::-1]


@lru_cache(10_000)
def costs(codes: bytes) -> tuple[int, ...]:
    """Least cost from each state before the rows to each state behind them, row by row."""
    found = [lower_bounds(codes, [0 if state == end else NEVER for state in STATES])[0] for end in STATES]
    return tuple(min(found[end][start], NEVER) for start in STATES for end in STATES)


#: Behind the last row of a conversation, where rows may still be inserted.
END = with_inserts([0 if accepted else NEVER for accepted in ACCEPTED])


def search(codes: bytes, start: int, tail: tuple[int, ...], last: bool) -> tuple[str, int] | None:
    """The ASCII-least of the cheapest audits, and the state it ends in.

    Rows are inserted before a row, or behind the last one of a conversation. So no audit
    is a prefix of another one of equal cost, and among prefixes that reach a node at equal
    cost the first one, in ASCII order, stays the least with any ending.
    """
    bounds, n = lower_bounds(codes, list(tail)), len(codes)
    if bounds[0][start] >= NEVER:
        return None
    reached: dict[tuple[int, int], int] = {}
    best, incumbent, end = NEVER, "", start
    path: list[str] = []
    common = 0  # how far the path agrees with the incumbent
    stack = [(0, "", 0, start, 0)]
    while stack:
        depth, letter, row, state, cost = stack.pop()
        del path[max(depth - 1, 0) :]
        common = min(common, len(path))
        if letter:
            if common == len(path) < len(incumbent) and incumbent[common] == letter:
                common += 1
            path.append(letter)
        bound = cost + bounds[row][state]
        if bound > best or bound == best and not _less(path, incumbent, common):
            continue
        if reached.get((row, state), NEVER) <= cost:
            continue
        reached[row, state] = cost
        if row == n and (not last or ACCEPTED[state]):
            best, incumbent, end, common = bound, "".join(path), state, len(path)
            continue
        moves = []
        if row < n or last:
            moves.append((cost + INSERT, "I", row, ADVANCE[state]))
        if row < n:
            code = codes[row]
            stay = TRUNCATED if code & CUT else 0
            moves.append((cost + DELETE, "D", row + 1, state))
            if not code & MUST_GO:
                moves.append((cost + REROLE + stay, "R", row + 1, ADVANCE[state]))
                if (kept := kept_state(state, code)) is not None:
                    moves.append((cost + stay, "K", row + 1, kept))
        moves = [(c + bounds[r][s], move, c, r, s) for c, move, r, s in moves if c + bounds[r][s] < NEVER]
        for _, move, c, r, s in sorted(moves, reverse=True):
            stack.append((depth + 1, move, r, s, c))
    return incumbent, end


def _less(path: list[str], incumbent: str, common: int) -> bool:
    """Whether the path, or something that begins with it, may still be less than the incumbent."""
    return common == len(path) or common < len(incumbent) and path[common] < incumbent[common]


# Streams. Each takes rows in order and holds little more than a segment.

KEY = "c string, part int, seg int"
COUNTS = "blank long, duplicate long, truncated long, illegal long"
PLACE = "turn {turn}, role string, md string"


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _streamed(schema: list[tuple[str, pa.DataType]], rows: Iterator[tuple], each: int = 2000, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of the rows, by number and by the bytes of their texts."""
    held, size, shape = [], 0, pa.schema(schema)
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, str | bytes))
        if len(held) >= each or size >= most:
            yield _batch(held, shape)
            held, size = [], 0
    yield _batch(held, shape)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def _arrow(df: DataFrame) -> list[tuple[str, pa.DataType]]:
    from pyspark.sql.pandas.types import to_arrow_schema

    return [(f.name, f.type) for f in to_arrow_schema(df.schema)]


def _segments(rows: Iterator[tuple], most: int) -> Iterator[tuple]:
    """Sorted rows ``c, turn, role, md, code, blank, cut, first, copies, part`` to segments."""
    name, part, number, codes, keys, counts = None, 0, 0, bytearray(), None, [0, 0, 0]

    def ended() -> tuple:
        initials = [b & 3 for b in codes]
        illegal = sum(pair not in LEGAL for pair in zip(initials, initials[1:], strict=False))
        return (name, part, number, *keys, bytes(codes), *counts, illegal, initials[0], initials[-1], list(costs(bytes(codes))))

    for c, turn, role, md, code, blank, cut, first, copies, part_now in rows:
        if c != name:
            if codes:
                yield ended()
            name, part, number, codes, counts = c, part_now, 0, bytearray(), [0, 0, 0]
        new = 1 if first and not blank else 0
        while copies:
            if len(codes) >= most:
                yield ended()
                number, codes, counts = number + 1, bytearray(), [0, 0, 0]
            if not codes:
                keys = (turn, role, md)
            if new:
                codes.append(code + (CUT if cut else 0))
                counts[2] += cut
                new, copies = 0, copies - 1
                continue
            fill = min(copies, most - len(codes))
            codes += bytes([code + MUST_GO]) * fill
            counts[0 if blank else 1] += fill
            copies -= fill
    if codes:
        yield ended()


def _chain(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Sorted ``c, part, seg, costs, first, last``: for each segment what follows it costs from
    each state, whether it is the first and the last, and what the conversation costs."""

    def ended(name: str, held: list[tuple]) -> Iterator[tuple]:
        tails = [list(END)]
        for _, _, between, *_ in reversed(held):
            tails.append([min(between[4 * s + e] + tails[-1][e] for e in STATES) for s in STATES])
        tails.reverse()
        for k, (part, seg, _, first, _) in enumerate(held):
            broken = int(k > 0 and (held[k - 1][4], first) not in LEGAL)
            yield name, part, seg, tails[k + 1], k == 0, k == len(held) - 1, broken, tails[0][0]

    name, held = None, []
    for c, *row in rows:
        if c != name:
            yield from ended(name, held)
            name, held = c, []
        held.append(tuple(row))
    yield from ended(name, held)


def _solved(rows: Iterator[tuple]) -> Iterator[tuple]:
    """``..., codes, tail, head, last`` to audits and end states by start state."""
    for *kept, codes, tail, head, last in rows:
        found = [search(codes, state, tuple(tail), last) if state == 0 or not head else None for state in STATES]
        yield *kept, [f and f[0] for f in found], [f and f[1] for f in found]


def _composed(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Sorted ``c, ..., audits, ends``: the audit of each segment on the chosen path."""
    name, state = None, 0
    for c, *kept, audits, ends in rows:
        if c != name:
            name, state = c, 0
        yield c, *kept, audits[state]
        state = ends[state]


def _replayed(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Sorted ``c, audit, role, text``, a segment's audit before its rows, to edited rows
    ``c, edit, role, text``; deleted rows keep their role and text. Ends with ``c, None``."""
    name, state, edits = None, 0, deque()

    def inserted() -> Iterator[tuple]:
        nonlocal state
        while edits and edits[0] == "I":
            edits.popleft()
            state = ADVANCE[state]
            yield name, "I", "user" if state == 2 else "assistant", ""

    for c, audit, role, text in rows:
        if c != name:
            if name is not None:
                yield from inserted()
                yield name, None, None, None
            name, state = c, 0
            edits.clear()
        if audit is not None:
            edits.extend(audit)
            continue
        yield from inserted()
        edit = edits.popleft()
        if edit == "R":
            state = ADVANCE[state]
            role = "user" if state == 2 else "assistant"
        elif edit == "K":
            state = {"s": 1, "u": 2, "a": 3}[role[0]]
        yield name, edit, role, text
    if name is not None:
        yield from inserted()
        yield name, None, None, None


def _mapped(df: DataFrame, stream: Callable[[Iterator[tuple]], Iterator[tuple]], schema: str) -> DataFrame:
    empty = df.sparkSession.createDataFrame([], schema)
    shape = _arrow(empty)
    return df.mapInArrow(lambda batches: _streamed(shape, stream(_rows(batches))), empty.schema)


@dataclass
class Repair:
    """``pieces``: a row for each segment with its audit and counts. ``turns``: the rows
    with their texts. ``gaps``: turns missing between a conversation's first and last."""

    pieces: DataFrame
    turns: DataFrame
    gaps: DataFrame

    def summary(self) -> DataFrame:
        """A row for each conversation: ``c``, counts of faults, cost and audit."""
        parts = F.array_sort(F.collect_list(F.struct("part", "seg", "audit")))
        held = self.pieces.groupBy("c").agg(
            *[F.sum(n).alias(n) for n in ("blank", "duplicate", "truncated", "illegal")], F.max("cost").alias("cost"),
            F.array_join(F.transform(parts, lambda p: p["audit"]), "").alias("audit"),
        )
        return held.join(self.gaps, "c", "left").withColumn("gaps", F.coalesce("gaps", F.lit(0)).cast("long"))

    def _stream(self) -> DataFrame:
        """Pieces and turns, each conversation in order in one partition."""
        none = F.lit(None).cast("string")
        pieces = self.pieces.select("c", "turn", "role", "md", "part", "seg", "audit", none.alias("text"))
        turns = self.turns.select("c", "turn", "role", "md", F.lit(None).cast("int").alias("part"), F.lit(None).cast("int").alias("seg"), none.alias("audit"), "text")
        order = ["c", F.asc_nulls_first("turn"), "role", "md", F.col("audit").isNull(), "part", "seg"]
        return pieces.union(turns).repartition("c").sortWithinPartitions(*order).select("c", "audit", "role", "text")

    def rows(self) -> DataFrame:
        """The edited rows: ``c, place`` (from 0, deleted rows counted), ``edit, role, text``."""

        def placed(rows: Iterator[tuple]) -> Iterator[tuple]:
            name, place = None, 0
            for c, edit, role, text in _replayed(rows):
                if c != name:
                    name, place = c, 0
                if edit:
                    yield c, place, edit, role, text
                    place += 1

        return _mapped(self._stream(), placed, "c string, place long, edit string, role string, text string")

    def digests(self) -> DataFrame:
        """SHA-256 of each repaired conversation: ``role:text`` of its rows joined by newlines."""

        def hashed(rows: Iterator[tuple]) -> Iterator[tuple]:
            value, any_ = hashlib.sha256(), False
            for c, edit, role, text in _replayed(rows):
                if edit is None:
                    yield c, value.hexdigest()
                    value, any_ = hashlib.sha256(), False
                elif edit != "D":
                    value.update(("\n" * any_ + f"{role}:{text}").encode())
                    any_ = True

        return _mapped(self._stream(), hashed, "c string, repaired_sha256 string")


def conversation(conv_col: str = "conv_id") -> F.Column:
    """The key of a conversation as text; a null id has one of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(conv_col).cast("string")), F.lit(""))


def repair(
    convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", segment: int = SEGMENT
) -> Repair:
    """Find every conversation's faults and its cheapest edits."""
    bounded_batches(convs.sparkSession)
    space = F.lit(" ")
    turns = convs.select(
        conversation(conv_col).alias("c"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), space).alias("role"), F.coalesce(F.col(text_col), space).alias("text"),
    ).withColumn("md", F.md5("text"))
    trimmed = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(0)
    faults = turns.select("c", "turn", "role", "md", code.alias("code"), (trimmed == "").alias("blank"), (~F.right(trimmed, F.lit(1)).isin(*ENDS)).alias("cut"))
    faults = stored(faults.groupBy(*faults.columns).agg(F.count("*").alias("copies")), "turns")
    has = F.col("turn").isNotNull()
    firsts = faults.groupBy("c", "role", "md").agg(F.min(F.struct(has.alias("has"), "turn")).alias("least"))
    marked = faults.join(firsts, ["c", "role", "md"]).withColumn("first", (has == F.col("least.has")) & F.col("turn").eqNullSafe(F.col("least.turn")))
    order = ["c", F.asc_nulls_first("turn"), "role", "md"]
    dealt = marked.repartitionByRange(ranges(faults.count()), *order).sortWithinPartitions(*order)
    dealt = dealt.select("c", "turn", "role", "md", "code", "blank", "cut", "first", "copies", F.spark_partition_id().alias("part"))
    place = PLACE.format(turn=dict(turns.dtypes)["turn"])
    found = f"{KEY}, {place}, codes binary, {COUNTS}, first int, last int, costs array<long>"
    segments = stored(_mapped(dealt, lambda rows: _segments(rows, segment), found), "segments")

    def sorted_by_conversation(df: DataFrame) -> DataFrame:
        return df.repartition("c").sortWithinPartitions("c", "part", "seg")

    matrices = sorted_by_conversation(segments.select("c", "part", "seg", "costs", "first", "last")).select("c", "part", "seg", "costs", "first", "last")
    tails = _mapped(matrices, _chain, f"{KEY}, tail array<long>, head boolean, final boolean, broken long, cost long")
    both = segments.join(tails, ["c", "part", "seg"]).withColumn("illegal", F.col("illegal") + F.col("broken"))
    kept = ["c", "part", "seg", "turn", "role", "md", "blank", "duplicate", "truncated", "illegal", "cost"]
    shape = f"{KEY}, {place}, {COUNTS}, cost long"
    solved = _mapped(both.select(*kept, "codes", "tail", "head", "final"), _solved, f"{shape}, audits array<string>, ends array<int>")
    pieces = stored(_mapped(sorted_by_conversation(solved), _composed, f"{shape}, audit string"), "pieces")
    spans = faults.filter(has).select("c", "turn").distinct().groupBy("c")
    gaps = spans.agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps"))
    return Repair(pieces, turns, gaps)
