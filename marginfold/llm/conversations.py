"""Conversations repaired at least cost, by a Viterbi search that emits edits as soon as they are certain.

A repaired conversation has the roles ``(s?(ua)+)?`` by their initials: perhaps a system message, then user
and assistant in turn. Each row is kept (K), given the role user or assistant (R, cost 2) or deleted (D, cost 3;
blank and repeated rows must be), and an empty user or assistant message may be inserted anywhere (I, cost 2).
A truncated row that stays adds 1. Of equal costs the edits whose initials are least in ASCII order win.

The search holds one survivor per state of the grammar: its cost and its last edit. Edits form a tree by what
came before them, each counting what still leads on from it. Edits that nothing leads on from are freed; once
all survivors share an ancestor, the edits up to it are emitted. Equal costs are compared by the complete edits
after that ancestor.

Rows are range-partitioned by conversation and turn and read in order, one conversation at a time. One
that reaches the border of a part or is longer than a block is taken apart instead: for each block of its
rows and each state that it may be entered in the search gives cost and edits for each state it may be
left in, and the blocks of a conversation are then put together in their order. So a conversation of any
length is spread over tasks, and only one letter per row and way to go comes together in the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from marginfold.sources.scratch import written

BLOCK_ROWS = 1024
BLOCK_CHARS = 8 << 20
START, SYSTEM, USER, ASSISTANT = range(4)
_REROLE, _DELETE, _INSERT, _TRUNCATED = 2, 3, 2, 1
# The states from which each initial may come next.
_MAY_FOLLOW = {"s": (START,), "u": (START, SYSTEM, ASSISTANT), "a": (USER,)}
_STATE = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_NAMES = {USER: "user", ASSISTANT: "assistant"}
_LEGAL = {"su", "ua", "au"}
NO_FAULT, BLANK, TRUNCATED, DUPLICATE = range(4)
_WHITE = " \t\n\x0b\x0c\r"
_ROW_BITS = 40
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


class _Edit:
    """An edit in the tree: the one before it, those behind it, and how many survivors end in it."""

    __slots__ = ("before", "letter", "behind", "survivors")

    def __init__(self, before: _Edit | None, letter: str) -> None:
        self.before, self.letter, self.behind, self.survivors = before, letter, [], 0


class Search:
    """Survivors of the rows read so far, entered in one state; certain edits are in ``emitted``."""

    def __init__(self, entered: int = START, insert_first: bool = True) -> None:
        self.root = _Edit(None, "")
        self.emitted: list[str] = []
        self.states: list[tuple[int, _Edit] | None] = [None] * 4
        self.states[entered] = (0, self.root)
        self.root.survivors = 1
        if insert_first:
            self._inserted(self.states)

    def _letters(self, edit: _Edit) -> str:
        """The edits after the shared ancestor."""
        letters = []
        while edit is not self.root:
            letters.append(edit.letter)
            edit = edit.before
        return "".join(reversed(letters))

    def _offer(self, states: list, target: int, source: tuple[int, _Edit] | None, cost: int, letter: str) -> None:
        if source is None:
            return
        total, edit = source[0] + cost, source[1]
        held = states[target]
        if held is not None:
            if held[0] < total or held[0] == total and self._letters(held[1]) <= self._letters(edit) + letter:
                return
            self._leave(held[1])
        made = _Edit(edit, letter)
        made.survivors = 1
        edit.behind.append(made)
        states[target] = (total, made)

    def _leave(self, edit: _Edit) -> None:
        """One survivor less ends here; edits that nothing leads on from are freed."""
        edit.survivors -= 1
        while not edit.survivors and not edit.behind and edit is not self.root:
            edit.before.behind.remove(edit)
            edit = edit.before

    def _inserted(self, states: list) -> None:
        for source in (START, SYSTEM, ASSISTANT):
            self._offer(states, USER, states[source], _INSERT, "I")
        self._offer(states, ASSISTANT, states[USER], _INSERT, "I")

    def read(self, initial: str, fault: int) -> None:
        before, after = self.states, [None] * 4
        for state, source in enumerate(before):
            self._offer(after, state, source, _DELETE, "D")
        if fault in (NO_FAULT, TRUNCATED):
            stays = _TRUNCATED if fault == TRUNCATED else 0
            for state in _MAY_FOLLOW.get(initial, ()):
                self._offer(after, _STATE[initial], before[state], stays, "K")
            for state, source in enumerate(before):
                self._offer(after, _NEXT[state], source, _REROLE + stays, "R")
        self._inserted(after)
        for held in before:
            if held is not None:
                self._leave(held[1])
        self.states = after
        self._drop_beaten()
        while len(self.root.behind) == 1 and not self.root.survivors:
            self.root = self.root.behind[0]
            self.root.before = None
            self.emitted.append(self.root.letter)

    def _drop_beaten(self) -> None:
        """Drop survivors that one in state ASSISTANT beats whatever follows.

        Whatever leads on from SYSTEM leads on from ASSISTANT too; what leads on from START does, if a
        system message that could be kept is deleted instead.
        """
        best = self.states[ASSISTANT]
        for state, margin in ((START, _DELETE), (SYSTEM, 0)):
            held = self.states[state]
            if best is not None and held is not None and held[0] > best[0] + margin:
                self._leave(held[1])
                self.states[state] = None

    def ways(self) -> dict[int, tuple[int, str]]:
        """For each state that the rows may end in, the cost and all edits."""
        emitted = "".join(self.emitted)
        return {state: (held[0], emitted + self._letters(held[1])) for state, held in enumerate(self.states) if held is not None}


def least(ways: dict[int, tuple[int, str]]) -> tuple[int, str]:
    """Cost and edits of the best way that ends as a conversation may."""
    return min(ways[state] for state in (START, ASSISTANT) if state in ways)


def edited(state: int, rows: Iterable[tuple[str, str]], edits: str) -> tuple[list[tuple[str, str]], int]:
    """The messages that edits make of (role, text) rows from a state on, and the state they end in."""
    rows, messages = iter(rows), []
    for letter in edits:
        if letter == "D":
            next(rows)
        elif letter == "K":
            role, text = next(rows)
            state = _STATE[role[:1]]
            messages.append((role, text))
        else:
            state = _NEXT[state]
            messages.append((_NAMES[state], "" if letter == "I" else next(rows)[1]))
    return messages, state


@dataclass
class _Tally:
    """Counts over rows in order that can be added to those of the rows behind them."""

    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first: str | None = None
    last: str | None = None
    turns: int = 0
    low: int | None = None
    high: int | None = None

    def read(self, turn: int | None, initial: str, fault: int) -> None:
        self.add(_Tally(fault == BLANK, fault == DUPLICATE, fault == TRUNCATED, 0, initial, initial, turn is not None, turn, turn))

    def add(self, other: _Tally) -> None:
        if other.first is None:
            return
        if self.last is not None:
            self.illegal += self.last + other.first not in _LEGAL
        self.blank += other.blank
        self.duplicate += other.duplicate
        self.truncated += other.truncated
        self.illegal += other.illegal
        self.first = other.first if self.first is None else self.first
        self.last = other.last
        if other.low is not None:
            # Turns ascend, so only the last one here can be the first one there.
            self.turns += other.turns - (self.high == other.low)
            self.low = other.low if self.low is None else self.low
            self.high = other.high

    def counts(self, cost: int) -> tuple[int, ...]:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, int(self.blank), int(self.duplicate), int(self.truncated), self.illegal, cost


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, present): rows damaged by a hash of ``conv_id:turn``, a null being a space.

    Of 20 remainders 0 drops the row (present is false), 1 empties its text, 2 takes out its full stops,
    exclamation and question marks, 3 repeats it and 4 makes it the user's. Other columns are ignored.
    """
    space = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(name).cast("string"), space) for name in ("conv_id", "turn")])
    harm = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", space)
    return conversations.select(
        "conv_id",
        "turn",
        F.when(harm == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(harm == 1, "").when(harm == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (harm != 0).alias("present"),
        F.explode(F.when(harm == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _batches(rows: Iterable[dict], schema: pa.Schema, most: int = 512) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(len(value) for value in row.values() if isinstance(value, str)) + 64 * len(row.get("messages") or ())
        if len(held) >= most or chars > BLOCK_CHARS:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for start in range(0, batch.num_rows, 1024):
            yield from batch.slice(start, 1024).to_pylist()


def _as_messages(pairs: Iterable[tuple[str, str]]) -> list[dict]:
    return [{"role": role, "text": text} for role, text in pairs]


def _whole(conv_id, rows: list[dict]) -> dict:
    """Audit and messages of a conversation whose rows are all here."""
    search, tally, seen = Search(), _Tally(), set()
    present = [(row["turn"], row["role"], row["text"], row["fault"]) for row in rows if row["present"]]
    for turn, role, text, fault in present:
        if fault != BLANK and (role, text) in seen:
            fault = DUPLICATE
        seen.add((role, text))
        search.read(role[:1], fault)
        tally.read(turn, role[:1], fault)
    cost, audit = least(search.ways())
    messages, _ = edited(START, ((role, text) for _, role, text, _ in present), audit)
    return {"conv_id": conv_id, **dict(zip(COUNTS, tally.counts(cost))), "audit": audit, "messages": _as_messages(messages)}


def _in_order(schema: pa.Schema, block_rows: int):
    """Repairs the conversations inside a sorted part; rows of others are given back with their places."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held, chars, whole, first, place = [], 0, True, True, 0
        conv_id = part = None

        def apart() -> Iterator[dict]:
            nonlocal place
            for row in held:
                yield {**row, "place": (part << _ROW_BITS) + place}
                place += 1
            held.clear()

        for row in _rows(batches):
            part = row.pop("part")
            if held or not whole:
                if row["conv_id"] != conv_id:
                    if first or not whole:
                        yield from apart()
                    else:
                        yield _whole(conv_id, held)
                        held.clear()
                    first, whole, chars = False, True, 0
            conv_id = row["conv_id"]
            held.append(row)
            chars += len(row["text"])
            if len(held) >= block_rows or chars > BLOCK_CHARS:
                # Too long to be held: the rest of it goes the same way.
                whole, chars = False, 0
                yield from apart()
        yield from apart()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(found(batches), schema)

    return run


def _same(rows: Iterator[dict], *names: str) -> Iterator[tuple[tuple, Iterator[dict]]]:
    return groupby(rows, key=lambda row: tuple(row[name] for name in names))


def _block_ways(schema: pa.Schema):
    """Tally and ways of each block of a conversation, for every state it may be entered in."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for (conv_id, block), rows in _same(_rows(batches), "conv_id", "block"):
            tally, searches = _Tally(), {state: Search(state, False) for state in range(4)}
            for row in rows:
                if row["present"]:
                    fault = DUPLICATE if row["fault"] != BLANK and row["again"] else row["fault"]
                    tally.read(row["turn"], row["initial"], fault)
                    for search in searches.values():
                        search.read(row["initial"], fault)
            ways = [
                {"entered": entered, "left": left, "cost": cost, "edits": edits}
                for entered, search in searches.items()
                for left, (cost, edits) in search.ways().items()
            ]
            yield {"conv_id": conv_id, "block": block, "ways": ways, "tally": {name: value if value is None or isinstance(value, str) else int(value) for name, value in vars(tally).items()}}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(found(batches), schema, 16)

    return run


def _put_together(schema: pa.Schema):
    """The best way through a conversation's blocks in their order: its audit, and each block's edits."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for (conv_id,), blocks in _same(_rows(batches), "conv_id"):
            tally = _Tally()
            # For each state cost and edits block by block, each (block, state entered, edits).
            survivors = {state: (cost, ((None, START, edits),)) for state, (cost, edits) in Search().ways().items()}
            settled: list[tuple] = []
            for block in blocks:
                tally.add(_Tally(**block["tally"]))
                reached: dict[int, tuple[int, tuple]] = {}
                for way in block["ways"]:
                    if way["entered"] not in survivors:
                        continue
                    cost, steps = survivors[way["entered"]]
                    offered = (cost + way["cost"], (*steps, (block["block"], way["entered"], way["edits"])))
                    held = reached.get(way["left"])
                    if held is None or _order(offered) < _order(held):
                        reached[way["left"]] = offered
                survivors = reached
                # Blocks that all survivors passed alike are settled.
                alike = 0
                for steps in zip(*(steps for _, steps in survivors.values())):
                    if any(step != steps[0] for step in steps):
                        break
                    alike += 1
                settled += next(iter(survivors.values()))[1][:alike]
                survivors = {state: (cost, steps[alike:]) for state, (cost, steps) in survivors.items()}
            cost, steps = min((survivors[state] for state in (START, ASSISTANT) if state in survivors), key=_order)
            steps = [*settled, *steps]
            audit = "".join(edits for _, _, edits in steps)
            yield {"conv_id": conv_id, "block": None, **dict(zip(COUNTS, tally.counts(cost))), "edits": audit}
            # What is inserted before the first row belongs to the first block.
            first = steps[0][2]
            for number, (block, entered, edits) in enumerate(steps[1:]):
                yield {"conv_id": conv_id, "block": block, "entered": START if not number else entered, "edits": edits if number else first + edits}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(found(batches), schema, 64)

    return run


def _order(survivor: tuple[int, tuple]) -> tuple[int, str]:
    return survivor[0], "".join(edits for _, _, edits in survivor[1])


def _block_messages(schema: pa.Schema):
    """The messages of each block: its first row has its edits, its own rows follow."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for (conv_id, block), rows in _same(_rows(batches), "conv_id", "block"):
            head = next(rows)
            messages, _ = edited(head["entered"], ((row["role"], row["text"]) for row in rows), head["edits"])
            yield {"conv_id": conv_id, "block": block, "messages": _as_messages(messages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(found(batches), schema, 16)

    return run


@dataclass(frozen=True)
class Repaired:
    """Repaired conversations: ``whole`` with their messages, ``long`` with theirs in ``blocks``, in ascending order."""

    whole: DataFrame
    long: DataFrame
    blocks: DataFrame

    def audits(self) -> DataFrame:
        """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit), one row per conversation."""
        columns = ["conv_id", *COUNTS, "audit"]
        return self.whole.select(*columns).union(self.long.select(*columns))

    def messages(self) -> DataFrame:
        """(conv_id, block, place, role, text) of every message; block and place within it give the order."""
        whole = self.whole.select("conv_id", F.lit(0).cast("bigint").alias("block"), "messages")
        return whole.union(self.blocks.select("conv_id", "block", "messages")).select(
            "conv_id", "block", F.posexplode("messages").alias("place", "message")
        ).select("conv_id", "block", "place", "message.role", "message.text")


def repair(rows: DataFrame, present: Column | str = "present", block_rows: int = BLOCK_ROWS) -> Repaired:
    """Repair conversations given as rows (conv_id, turn, role, text).

    Rows are in order of turn, nulls first, rows of one turn by role and text. A null role or text is one
    space, null conv_ids are one conversation, and a row where ``present`` does not hold only tells that
    its conversation exists: one without other rows has zeros and no edits. A role's initial counts; roles
    other than s, u and a cannot be kept. Other columns are ignored, and no rows give no conversations.
    """
    conv = rows.schema["conv_id"]
    present = F.col(present) if isinstance(present, str) else present
    space = F.lit(" ")
    seen = rows.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        F.coalesce(present, F.lit(False)).alias("present"),
    )
    seen = seen.withColumn("end", F.substring(F.rtrim("text", F.lit(_WHITE)), -1, 1))
    seen = seen.withColumn("fault", F.when(F.col("end") == "", BLANK).when(F.col("end").isin(".", "!", "?"), NO_FAULT).otherwise(TRUNCATED)).drop("end")
    # Equal rows are in no order; the last key lets them be split all the same.
    order = ["conv_id", "turn", "role", "text", "present", "any"]
    dealt = (
        seen.withColumn("any", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(*seen.columns, F.spark_partition_id().alias("part"))
    )
    text, number, flag = T.StringType(), T.LongType(), T.BooleanType()
    message = T.StructType([T.StructField("role", text), T.StructField("text", text)])
    messages = T.StructField("messages", T.ArrayType(message))
    counts = [T.StructField(name, number) for name in COUNTS]
    apart_fields = [
        T.StructField("turn", number),
        T.StructField("role", text),
        T.StructField("text", text),
        T.StructField("present", flag),
        T.StructField("fault", T.IntegerType()),
        T.StructField("place", number),
    ]
    parted = T.StructType([conv, *counts, T.StructField("audit", text), messages, *apart_fields])
    # Written, as a second reading would draw other ranges.
    parts = written(dealt.mapInArrow(_in_order(_arrow(parted), block_rows), parted))
    whole = parts.where("place IS NULL").select("conv_id", *COUNTS, "audit", "messages")

    # The row bits leave the part in front: blocks are in the order of the rows.
    apart = parts.where("place IS NOT NULL").select("conv_id", *[field.name for field in apart_fields])
    apart = apart.withColumn("block", F.expr(f"place div {int(block_rows)}"))
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    firsts = apart.where("present").groupBy("conv_id", said.alias("said")).agg(F.min("place").alias("place"))
    slim = apart.select("conv_id", "block", "place", "turn", "present", "fault", F.substring("role", 1, 1).alias("initial"))
    flagged = slim.join(firsts.select("place", F.lit(False).alias("again")), "place", "left").withColumn("again", F.coalesce("again", F.lit(True)))
    way = T.StructType([T.StructField("entered", number), T.StructField("left", number), T.StructField("cost", number), T.StructField("edits", text)])
    tally = T.StructType([T.StructField(name, text if name in ("first", "last") else number) for name in vars(_Tally())])
    block_schema = T.StructType([conv, T.StructField("block", number), T.StructField("ways", T.ArrayType(way)), T.StructField("tally", tally)])
    ways = (
        flagged.repartition("conv_id", "block")
        .sortWithinPartitions("conv_id", "block", "place")
        .mapInArrow(_block_ways(_arrow(block_schema)), block_schema)
    )
    chosen_schema = T.StructType([conv, T.StructField("block", number), *counts, T.StructField("entered", number), T.StructField("edits", text)])
    chosen = written(
        ways.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(_put_together(_arrow(chosen_schema)), chosen_schema)
    )
    heads = chosen.where("block IS NOT NULL").select(
        "conv_id", "block", F.lit(-1).cast("bigint").alias("place"), "entered", "edits", *[F.lit(None).cast("string").alias(name) for name in ("role", "text")]
    )
    bodies = apart.where("present").select(
        "conv_id", "block", "place", F.lit(None).cast("bigint").alias("entered"), F.lit(None).cast("string").alias("edits"), "role", "text"
    )
    made = T.StructType([conv, T.StructField("block", number), messages])
    blocks = (
        heads.union(bodies)
        .repartition("conv_id", "block")
        .sortWithinPartitions("conv_id", "block", "place")
        .mapInArrow(_block_messages(_arrow(made)), made)
    )
    long = chosen.where("block IS NULL").select("conv_id", *COUNTS, F.col("edits").alias("audit"))
    return Repaired(whole, long, blocks)


def _streamed_digests(schema: pa.Schema):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for (conv_id,), blocks in _same(_rows(batches), "conv_id"):
            digest, before = hashlib.sha256(), ""
            for block in blocks:
                for message in block["messages"]:
                    digest.update(f"{before}{message['role']}:{message['text']}".encode())
                    before = "\n"
            yield {"conv_id": conv_id, "repaired_sha256": digest.hexdigest()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(found(batches), schema)

    return run


def digests(repaired: Repaired) -> DataFrame:
    """The audits with repaired_sha256: of ``role:text`` of the messages in order, joined by line ends.

    A hash is taken in order, so the messages of a long conversation pass through one task, block by block.
    """
    lines = F.array_join(F.transform("messages", lambda message: F.concat(message["role"], F.lit(":"), message["text"])), "\n")
    columns = ["conv_id", *COUNTS, "audit", "repaired_sha256"]
    whole = repaired.whole.withColumn("repaired_sha256", F.sha2(lines, 256)).select(*columns)
    schema = T.StructType([repaired.blocks.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())])
    streamed = repaired.blocks.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(_streamed_digests(_arrow(schema)), schema)
    streamed = streamed.withColumnRenamed("conv_id", "same")
    long = repaired.long.join(streamed, F.col("conv_id").eqNullSafe(F.col("same")), "left")
    return whole.union(long.select(*columns))
