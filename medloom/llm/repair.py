"""Repair of conversations: the cheapest edits after which roles read as an optional system turn and pairs of user and assistant.

A conversation is a lattice: a node is a number of rows read and a state (nothing yet, after a system turn, after a
user turn, after an assistant turn); an arc keeps, reroles or deletes the next row, or inserts a turn. Blank and
repeated rows are deleted anyway and need no node. The cheapest way is found by the auction algorithm for shortest
paths: every node has a price, never above the cost of an arc plus the price at its end; a path grows from its origin
over an arc that meets this bound, and where none does, the price of its last node is raised to the bound and the path
gives that node up. Long conversations are cut into slices of ``SLICE`` rows, whose origins are taken from the last slice to the
first, so each auction ends on prices that have converged. The arcs that meet the bound are then followed from the
start, in the order of their letters, which gives the least text among the cheapest ones (``D``, ``I``, ``K``, ``R``).

Rows that are equal in all columns become one row with a number. All rows are dealt by range of conversation, turn, role
and text, so a conversation of any size spreads over tasks. A task finishes the conversations that lie inside it.
Of others it returns, for each block of rows, the cost and letters from every state to every state; prices at the
block borders follow from the costs alone, and one pass over the blocks of a conversation joins the letters and hashes
the repaired text. (SHA-256 goes through a text from its beginning, so this pass is one task for each conversation that
spans tasks; it holds one block at a time.)
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.llm.mapping import arrow_map
from medloom.sources.shared import written

SLICE = 32
BLOCK_ROWS, BLOCK_CHARS = 4_096, 1 << 22
DELETE, INSERT, REROLE, CUT_OFF = 2, 5, 1, 5
#: States: 0 nothing yet, 1 after a system turn, 2 after a user turn, 3 after an assistant turn.
TURN = ("user", "user", "assistant", "user")
AFTER = (2, 2, 3, 2)
KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: What it costs to end in each state, and the inserts it takes.
ENDING = (0, 2 * INSERT, INSERT, 0)
LEGAL = ("su", "ua", "au")
NEVER = 1 << 60
LONG = (1 << 63) - 1
_HEAD = 32
_BLANK, _REPEATED, _CUT = 1, 2, 3
_DAMAGES = 20


def kept_state(state: int, initial: str) -> int | None:
    """The state after a kept row; a role without letters changes nothing."""
    return KEEP.get((state, initial)) if initial else state


def _arcs(node: int, rows: list[tuple[str, int]], price: list[int]) -> Iterator[tuple[str, int, int]]:
    """(letter, cost with the price at the end, end), in the order of the letters."""
    at, state = divmod(node, 4)
    initial, extra = rows[at]
    yield "D", DELETE + price[node + 4], node + 4
    turn = at * 4 + AFTER[state]
    yield "I", INSERT + price[turn], turn
    kept = kept_state(state, initial)
    if kept is not None:
        yield "K", extra + price[at * 4 + 4 + kept], at * 4 + 4 + kept
    yield "R", REROLE + extra + price[turn + 4], turn + 4


def auction(rows: list[tuple[str, int]], price: list[int], origin: int) -> None:
    """Raise prices until a path of tight arcs leads from ``origin`` past the last row; NEVER where there is no way."""
    path, last = [origin], 4 * len(rows)
    while path:
        node = path[-1]
        if node >= last and price[node] < NEVER:
            return
        best, end = NEVER, -1
        if node < last:
            for _, cost, to in _arcs(node, rows, price):
                if cost < best:
                    best, end = cost, to
        if price[node] < best:
            price[node] = best
            if len(path) > 1:
                path.pop()
        elif end < 0:
            path.pop()
        else:
            path.append(end)


class Lattice:
    """Converged prices of a run of rows, each given by the initial of its role and what keeping it costs extra.

    ``ending`` holds the prices after the last row; ``closed`` the states from which no wanted end can be reached.
    """

    def __init__(self, rows: list[tuple[str, int]], ending: tuple[int, ...], starts: tuple[int, ...], closed: tuple[int, ...] = ()):
        self.slices, self.ending = [], list(ending)
        after = list(ending)
        cuts = list(range(0, len(rows), SLICE))
        for first in reversed(cuts):
            own = rows[first : first + SLICE]
            floor = min(after)
            price = [NEVER if s in closed else floor for _ in own for s in range(4)] + after
            for s in starts if first == 0 else range(4):
                auction(own, price, s)
            self.slices.append((own, price))
            after = price[:4]
        self.slices.reverse()
        self.start = after

    def letters(self, state: int) -> tuple[list[str], int]:
        """The letters for each row on the least cheapest way from ``state``, and the state after the last row."""
        out = []
        for rows, price in self.slices:
            node, last, word = state, 4 * len(rows), ""
            while node < last:
                for letter, cost, to in _arcs(node, rows, price):
                    if cost == price[node]:
                        word += letter
                        if to // 4 > node // 4:
                            out.append(word)
                            word = ""
                        node = to
                        break
            state = node - last
        return out, state


class Stretch:
    """Rows of one conversation that follow each other: counts, and the rows that are neither blank nor repeated."""

    def __init__(self) -> None:
        self.blank = self.repeated = self.cut = self.illegal = self.rows = self.chars = self.turns = 0
        self.least = self.most = self.last_turn = self.first_turn = None
        self.first = self.last = None
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.free: list[tuple[str, int]] = []
        self.forced = [0]

    def add(self, turn: int | None, role: str, text: str | None, count: int, fault: int) -> None:
        initial = role[:1]
        if self.rows == 0:
            self.first, self.first_turn = initial, turn
        elif self.last + initial not in LEGAL:
            self.illegal += 1
        self.illegal += count - 1
        self.last = initial
        if turn is not None:
            self.turns += self.least is None or turn != self.last_turn
            self.least, self.most = turn if self.least is None else self.least, turn
        self.last_turn = turn
        self.rows += 1
        if fault == _BLANK:
            self.blank += count
            self.forced[-1] += count
        elif fault == _REPEATED:
            self.repeated += count
            self.forced[-1] += count
        else:
            self.cut += fault == _CUT
            self.repeated += count - 1
            self.roles.append(role)
            self.texts.append(text or "")
            self.chars += len(text or "")
            self.free.append((initial, CUT_OFF if fault == _CUT else 0))
            self.forced.append(count - 1)

    def audit(self, letters: list[str]) -> str:
        return "D" * self.forced[0] + "".join(x + "D" * n for x, n in zip(letters, self.forced[1:], strict=True))


def repaired(state: int, letters: str, roles: list[str], texts: list[str], forced: list[int]) -> Iterator[str]:
    """The rows left by the letters, as role:text."""
    at = forced[0]
    for role, text, gone in zip(roles, texts, forced[1:], strict=True):
        while letters[at] == "I":
            yield f"{TURN[state]}:"
            state, at = AFTER[state], at + 1
        if letters[at] == "K":
            yield f"{role}:{text}"
            state = kept_state(state, role[:1])
        elif letters[at] == "R":
            yield f"{TURN[state]}:{text}"
            state = AFTER[state]
        at += 1 + gone
    for _ in letters[at:]:
        yield f"{TURN[state]}:"
        state = AFTER[state]


class Lines:
    """SHA-256 of lines joined by line feeds."""

    def __init__(self) -> None:
        self.sum, self.empty = hashlib.sha256(), True

    def take(self, lines: Iterator[str]) -> None:
        for line in lines:
            self.sum.update((line if self.empty else "\n" + line).encode("utf-8", "replace"))
            self.empty = False


_FOUND = "c string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_BLOCK = (
    "part int, block int, first string, last string, first_turn long, last_turn long, least long, most long, turns long, forced array<long>, "
    "costs array<long>, ways array<string>, roles array<string>, texts array<string>"
)
_FOUND_NAMES = [x.split()[0] for x in _FOUND.split(", ")]
_BLOCK_NAMES = [x.split()[0] for x in _BLOCK.split(", ")]


def gaps(least: int | None, most: int | None, turns: int) -> int:
    return 0 if least is None else min(LONG, most - least + 1 - turns)


def _whole(name: str, s: Stretch) -> dict:
    lattice = Lattice(s.free, ENDING, (0,))
    letters, state = lattice.letters(0)
    audit = s.audit(letters) + "I" * (ENDING[state] // INSERT)
    lines = Lines()
    lines.take(repaired(0, audit, s.roles, s.texts, s.forced))
    cost = lattice.start[0] + DELETE * sum(s.forced)
    return {
        "c": name, "gaps": gaps(s.least, s.most, s.turns), "blank": s.blank, "duplicate": s.repeated, "truncated": s.cut,
        "illegal": s.illegal, "cost": cost, "audit": audit, "repaired_sha256": lines.sum.hexdigest(),
    }


def _part(name: str, s: Stretch, part: int, block: int) -> dict:
    """What a block tells the others: costs and letters from each state (four rows) to each state (four columns)."""
    costs, ways = [NEVER] * 16, [""] * 16
    for end in range(4):
        ending = tuple(0 if t == end else NEVER for t in range(4))
        lattice = Lattice(s.free, ending, (0, 1, 2, 3), ((1, 2, 3), (2, 3), (), ())[end])
        for start in range(4):
            if lattice.start[start] < NEVER:
                costs[4 * start + end] = lattice.start[start] + DELETE * sum(s.forced)
                ways[4 * start + end] = s.audit(lattice.letters(start)[0])
    return {
        "c": name, "blank": s.blank, "duplicate": s.repeated, "truncated": s.cut, "illegal": s.illegal, "part": part, "block": block,
        "first": s.first, "last": s.last, "first_turn": s.first_turn, "last_turn": s.last_turn, "least": s.least, "most": s.most,
        "turns": s.turns, "forced": s.forced, "costs": costs, "ways": ways, "roles": s.roles, "texts": s.texts,
    }


def _batch(rows: list[dict], names: list[str], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({n: [r.get(n) for r in rows] for n in names}, schema=schema)


_ARROW = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}


def _schema(text: str) -> pa.Schema:
    return pa.schema([(n, _ARROW[t]) for n, t in (x.split() for x in text.split(", "))])


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive in order, the judgement of each (without text) before the row itself."""
    part = TaskContext.get().partitionId()
    schema, names = _schema(f"{_FOUND}, {_BLOCK}"), _FOUND_NAMES + _BLOCK_NAMES
    out: list[dict] = []
    name, stretch, block, inner, judged = None, None, 0, False, None
    for batch in batches:
        columns = (batch.column(x).to_pylist() for x in ("c", "turn", "role", "k", "text", "n", "fault"))
        for c, turn, role, k, text, n, fault in zip(*columns, strict=True):
            if c != name:
                if stretch:  # a conversation that neither begins nor ends here with the task is whole
                    out.append(_whole(name, stretch) if inner and not block else _part(name, stretch, part, block))
                inner, name, stretch, block = name is not None, c, Stretch(), 0
            if fault is not None:
                judged = (turn, role, k, n, fault)
            elif judged and judged[:3] == (turn, role, k):
                if stretch.rows >= BLOCK_ROWS or stretch.chars >= BLOCK_CHARS:
                    out.append(_part(name, stretch, part, block))
                    stretch, block = Stretch(), block + 1
                stretch.add(turn, role, text, judged[3], judged[4])
                judged = None
            if len(out) >= 1_000 or out and "texts" in out[-1]:
                yield _batch(out, names, schema)
                out = []
    if stretch:
        out.append(_part(name, stretch, part, block))
    if out:
        yield _batch(out, names, schema)


def _prices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The prices after each block of a conversation, from its last block to its first."""
    schema = _schema("c string, part int, block int, ahead array<long>")
    for batch in batches:
        for row in batch.to_pylist():
            out, ahead = [], list(ENDING)
            for b in reversed(row["blocks"]):
                out.append({"c": row["c"], "part": b["part"], "block": b["block"], "ahead": ahead})
                ahead = [min(NEVER, min(b["costs"][4 * s + t] + ahead[t] for t in range(4))) for s in range(4)]
            yield _batch(out, ["c", "part", "block", "ahead"], schema)


class Join:
    """A conversation as far as its blocks have come."""

    def __init__(self, name: str):
        self.name, self.state, self.last, self.last_turn, self.lines, self.audit = name, 0, None, None, Lines(), []
        self.least = self.most = None
        self.cost = self.turns = 0
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)

    def take(self, row: dict, ahead: list[int]) -> None:
        costs, ways = row["costs"], row["ways"]
        choice = [(costs[4 * self.state + t] + ahead[t], ways[4 * self.state + t], t) for t in range(4)]
        _, letters, end = min(choice)
        self.lines.take(repaired(self.state, letters, row["roles"], row["texts"], row["forced"]))
        self.audit.append(letters)
        self.cost += costs[4 * self.state + end]
        self.state = end
        for n in self.counts:
            self.counts[n] += row[n]
        if self.last is not None:
            self.counts["illegal"] += self.last + row["first"] not in LEGAL
            self.turns -= row["first_turn"] is not None and row["first_turn"] == self.last_turn
        self.turns += row["turns"]
        self.last, self.last_turn = row["last"], row["last_turn"]
        if row["least"] is not None:
            self.least, self.most = row["least"] if self.least is None else self.least, row["most"]

    def found(self) -> dict:
        more = "I" * (ENDING[self.state] // INSERT)
        self.lines.take(repaired(self.state, more, [], [], [0]))
        return self.counts | {
            "c": self.name, "gaps": gaps(self.least, self.most, self.turns), "cost": self.cost + ENDING[self.state],
            "audit": "".join(self.audit) + more, "repaired_sha256": self.lines.sum.hexdigest(),
        }


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks arrive in order, the prices after each (without texts) before the block itself."""
    join, ahead, schema = None, None, _schema(_FOUND)
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if join is None or row["c"] != join.name:
                if join:
                    yield _batch([join.found()], _FOUND_NAMES, schema)
                join = Join(row["c"])
            if row["ahead"] is not None:
                ahead = row["ahead"]
            else:
                join.take(row, ahead)
    if join:
        yield _batch([join.found()], _FOUND_NAMES, schema)


def _name(conv: Column) -> Column:
    """A conversation's id as a text that is never missing."""
    return F.coalesce(F.concat(F.lit("v"), conv.cast("string")), F.lit(""))


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows with faults that follow from crc32 of ``conv:turn``: dropped, emptied, without [.!?], repeated, or of role user.

    Missing values count as one space, in the key too. Returns the four columns.
    """
    spaced = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(spaced(conv_col), F.lit(":"), spaced(turn_col))), F.lit(_DAMAGES))
    named = rows.select(
        F.col(f"`{conv_col}`").alias(conv_col), F.col(f"`{turn_col}`").alias(turn_col), spaced(role_col).alias(role_col), spaced(text_col).alias(text_col), kind.alias("_kind")
    )
    text, role = F.col(text_col), F.col(role_col)
    hurt = named.filter("_kind <> 0").select(
        conv_col,
        turn_col,
        F.when(F.col("_kind") == 4, F.lit("user")).otherwise(role).alias(role_col),
        F.when(F.col("_kind") == 1, F.lit("")).when(F.col("_kind") == 2, F.translate(text, ".!?", "")).otherwise(text).alias(text_col),
        F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    )
    return hurt.drop("_copy")


def repair(rows: DataFrame, every: DataFrame | None = None, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Faults of each conversation, its cheapest edits, and a digest of what they leave.

    Returns one row for each id in ``every`` (by default in ``rows``): the id, gaps, blank, duplicate, truncated,
    illegal, cost (longs), audit (letters of the edits, K keep, R rerole, D delete, I insert) and repaired_sha256.
    Ids without rows get zeros, an empty audit and the digest of an empty text.

    Rows go by turn, missing ones first; rows of one turn by role, the first 32 characters of the text and a hash of it.
    A missing role or text counts as one space; a missing id is an id of its own. A role without letters may be kept
    anywhere. Turns are longs; a gap beyond a long counts as the greatest one. Repeated rows are duplicates. Other columns are
    ignored; an empty table gives an empty table.
    """
    spaced = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    conv = F.col(f"`{conv_col}`")
    named = rows.select(_name(conv).alias("c"), F.col(f"`{turn_col}`").cast("long").alias("turn"), spaced(role_col).alias("role"), spaced(text_col).alias("text"))
    counted = written(named.groupBy("c", "turn", "role", "text").agg(F.count("*").alias("n")), "turns")
    k = F.concat_ws(" ", F.xxhash64("text"), F.xxhash64(F.lit(1), "text")).alias("k")
    head = F.substring("text", 1, _HEAD).alias("head")
    shown = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    own = F.when(shown == "", _BLANK).when(~shown.isin(".", "!", "?"), _CUT).otherwise(0)
    light = written(counted.select("c", "turn", "role", head, k, "n", own.alias("own")), "judged")
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = written(light.groupBy("c", "role", "k").agg(F.min(place).alias("first")), "firsts")
    fault = F.when(F.col("own") == _BLANK, _BLANK).when(F.col("first.turn").eqNullSafe(F.col("turn")), F.col("own")).otherwise(_REPEATED)
    judged = light.join(firsts, ["c", "role", "k"]).select("c", "turn", "role", "head", "k", F.lit(None).cast("string").alias("text"), "n", fault.alias("fault"))
    full = counted.select("c", "turn", "role", head, k, "text", "n", F.lit(None).cast("int").alias("fault"))
    order = ["c", "turn", "role", "head", "k"]
    both = written(judged, "faults").unionByName(full).repartitionByRange(*order).sortWithinPartitions(*order, F.col("fault").isNull())
    found = written(arrow_map(both, _stretches, f"{_FOUND}, {_BLOCK}"), "stretches")
    whole = found.filter("part is null").select(*_FOUND_NAMES)
    blocks = found.filter("part is not null").drop("gaps", "cost", "audit", "repaired_sha256")
    # 16 numbers for every 4096 rows of a conversation, whose letters must fit in one value
    listed = blocks.groupBy("c").agg(F.array_sort(F.collect_list(F.struct("part", "block", "costs"))).alias("blocks"))
    ahead = arrow_map(listed, _prices, "c string, part int, block int, ahead array<long>")
    parts = blocks.withColumn("ahead", F.lit(None).cast("array<long>")).unionByName(ahead, allowMissingColumns=True)
    parts = parts.repartition("c").sortWithinPartitions("c", "part", "block", F.col("ahead").isNull())
    result = written(whole.unionByName(arrow_map(parts, _joined, _FOUND)), "repaired")
    ids = (rows if every is None else every).select(conv.alias(conv_col)).distinct()
    joined = ids.join(result, _name(F.col(f"`{conv_col}`")) == result["c"], "left")
    numbers = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in _FOUND_NAMES[1:7]]
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return joined.select(conv_col, *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))
