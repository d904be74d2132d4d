"""Repair of conversations by the cheapest edits, the least audit among them by ranked paths.

A repaired conversation is empty, or alternates user and assistant, with a system message first or
not, and ends with the assistant. Its rows are kept, rerolled, deleted, or joined by inserted
empty messages; ``COSTS`` has the costs. The audit is the initials of the edits in order; of the
cheapest edits those with the ASCII-least audit are taken.

A node is a place between rows and a state: nothing yet, system, user or assistant last. Edits are
arcs between nodes. All rows are put in one order and cut into blocks of ``BLOCK_ROWS``:

1. Cost DP. A row is a 4 x 4 matrix of least costs between states; suffix products by doubling
   (least sum instead of sum of products) give the cost to go of each node. A conversation that
   runs over several blocks is a chain of pieces; their matrices are combined in rounds of joins
   that double the reach.
2. Arcs on cheapest paths are ranked by the first letter of the audit that begins with them, then
   by the first 2, 4, 8 ... letters: a rank joined with that of the arc that many steps on, found
   by doubled pointers. At a node the arc of least rank leads on. Of the arcs that leave a node
   no two have the same letter, so a pointer never has to be taken back.
3. The path from the first node is laid out by the doubled pointers, longest first. Chains of
   pieces combine their maps from state to state by joins in the same way.

No task holds more than a block of rows, however long a conversation is.

Roles and texts that are null count as one space. Of a row's faults the first counts: ``blank``
(nothing but blanks, or empty), ``duplicate`` (role and text seen before in the conversation),
``truncated`` (the last character that is not blank does not end a sentence). Rows go by turn, null
turns first, equal turns by role, then text. An empty role cannot be kept. Null conversation ids are
one conversation. Long texts are only read where faults are found. An empty table gives an empty
result; further columns are not carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from coursepulse.plans.ranks import global_row_number
from coursepulse.session import materialize

BLOCK_ROWS = 8192
COSTS = {"K": 0, "R": 3, "D": 4, "I": 3}
TRUNCATED_COST = 3  # of a truncated row that stays
FAULTS = ("", "blank", "duplicate", "truncated")
BLANKS = " \t\n\x0b\x0c\r"
FAR = 1 << 50

LETTERS = "DIKR"  # by ASCII
WHO = "sua"  # initials of the roles by number; any other is 3
START, SYSTEM, USER, ASSISTANT = range(4)
# The state after the message that may come next, and after a row that is kept: -1 if it may not.
NEXT = np.array([USER, USER, ASSISTANT, USER])
KEEP = np.array([[SYSTEM, USER, -1, -1], [-1, USER, -1, -1], [-1, -1, ASSISTANT, -1], [-1, USER, -1, -1]])
# Cost to go at the end of a conversation: what is left to insert.
AT_END = np.array([0, 2 * COSTS["I"], COSTS["I"], 0])


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Matrices of least costs: of the ways in ``a`` continued by those in ``b``."""
    return np.minimum((a[..., :, :, None] + b[..., None, :, :]).min(-2), FAR)


def _row_matrices() -> np.ndarray:
    """Least costs between states over inserts and one row, by 4 x initial + fault."""
    insert = np.full((4, 4), FAR)
    insert[range(4), range(4)] = 0
    insert[range(4), NEXT] = COSTS["I"]
    inserts = times(times(insert, insert), insert)
    out = np.full((16, 4, 4), FAR)
    for who in range(4):
        for fault in range(4):
            row = out[4 * who + fault]
            row[range(4), range(4)] = COSTS["D"]
            if fault not in (1, 2):
                more = TRUNCATED_COST * (fault == 3)
                for s in range(4):
                    row[s, NEXT[s]] = min(row[s, NEXT[s]], COSTS["R"] + more)
                    if KEEP[s, who] >= 0:
                        row[s, KEEP[s, who]] = min(row[s, KEEP[s, who]], COSTS["K"] + more)
    return times(inserts, out)


ROWS = _row_matrices()


def chained(kind: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """For each row the matrix of the rows from it to the end of its piece, by doubling."""
    n = len(kind)
    identity = np.where(np.eye(4, dtype=bool), 0, FAR)
    out = np.concatenate([ROWS[kind], identity[None]])
    after = np.append(np.where(np.append(piece[1:] != piece[:-1], True), n, np.arange(1, n + 1)), n)
    while (after < n).any():
        out = times(out, out[after])
        after = after[after]
    return out[:n]


class Paths:
    """Cheapest paths through some rows, and which of them is least."""

    def __init__(self, who: np.ndarray, fault: np.ndarray, piece: np.ndarray, ends: np.ndarray, open_: np.ndarray) -> None:
        """``ends``: the costs to go at the end of each piece; ``open_``: another piece follows."""
        n = len(who)
        self.piece = piece
        self.first = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
        self.last = np.append(self.first[1:], n) - 1
        cost = np.minimum((chained(4 * who + fault, piece) + ends[piece][:, None, :]).min(-1), FAR)
        after = np.concatenate([cost[1:], cost[:1]])
        after[self.last] = ends
        # Nodes: four states before each row and after the last row of each piece.
        place = np.arange(n) + piece
        arcs = []

        def add(letter: str, rows: np.ndarray, s: int, to: np.ndarray, price: np.ndarray) -> None:
            good = rows[price[rows] == cost[rows, s]]
            target = np.broadcast_to(to, n)[good]
            arcs.append((4 * place[good] + s, target, np.full(len(good), LETTERS.index(letter))))

        every = np.arange(n)
        stays = every[(fault != 1) & (fault != 2)]
        more = TRUNCATED_COST * (fault == 3)
        for s in range(4):
            to = NEXT[s]
            add("I", every, s, 4 * place + to, COSTS["I"] + cost[:, to])
            add("D", every, s, 4 * (place + 1) + s, COSTS["D"] + after[:, s])
            add("R", stays, s, 4 * (place + 1) + to, COSTS["R"] + more + after[:, to])
            kept = KEEP[s, who]
            may = stays[kept[stays] >= 0]
            add("K", may, s, 4 * (place + 1) + kept, COSTS["K"] + more + after[every, kept])
            if AT_END[s] and AT_END[s] == COSTS["I"] + AT_END[to]:
                end = 4 * (place[self.last[~open_]] + 1)
                arcs.append((end + s, end + to, np.full(len(end), LETTERS.index("I"))))
        self.source, self.target, self.letter = (np.concatenate(x) for x in zip(*arcs, strict=True))
        self.place = place
        self._rank(4 * (n + len(self.first)))

    def _least(self, rank: np.ndarray, nodes: int) -> np.ndarray:
        """For each node its arc of least rank; the last number stands for none."""
        order = np.lexsort((rank[:-1], self.source))
        own = self.source[order]
        first = order[np.append(True, own[1:] != own[:-1])]
        out = np.full(nodes, len(self.source))
        out[self.source[first]] = first
        return out

    def _rank(self, nodes: int) -> None:
        none = len(self.source)
        rank = np.append(self.letter + 1, 0)
        length = np.append(np.ones(none, np.int64), 0)
        end = np.append(self.target, -1)
        step = np.append(self._least(rank, nodes)[self.target], none)
        self.steps = [step]
        while (step < none).any():
            # Ranks of twice as many letters.
            rank = np.unique(rank * (rank.max() + 1) + rank[step], return_inverse=True)[1]
            length = length + length[step]
            end = np.where(step < none, end[step], end)
            step = step[step]
            self.steps.append(step)
        self.best = self._least(rank, nodes)
        self.length, self.end = length, end

    def exits(self) -> np.ndarray:
        """For each piece the state at its end by the state at its start."""
        start = 4 * self.place[self.first][:, None] + np.arange(4)
        return self.end[self.best[start]] % 4

    def edits(self, entry: np.ndarray) -> tuple[list[str], list[str]]:
        """For each row its edits' letters and the initials of what they make.

        ``entry`` is the state at each piece's start. A kept row is ``k`` in the second, a deleted
        one ``-``; what is inserted after a piece's last row is part of that row's edits.
        """
        on = np.zeros(len(self.source) + 1, bool)
        on[self.best[4 * self.place[self.first] + entry]] = True
        for step in reversed(self.steps):
            on[step[np.flatnonzero(on)]] = True
        arcs = np.flatnonzero(on[:-1])
        at = self.source[arcs] // 4
        piece = np.searchsorted(self.place[self.last] + 1, at)
        order = np.lexsort((-self.length[arcs], piece))
        arcs, at, piece = arcs[order], at[order], piece[order]
        row = np.minimum(at - piece, self.last[piece])
        letter = self.letter[arcs]
        made = np.where(self.source[arcs] % 4 == USER, ord("a"), ord("u"))
        made = np.where(letter == LETTERS.index("K"), ord("k"), made)
        made = np.where(letter == LETTERS.index("D"), ord("-"), made)
        letters = np.frombuffer(LETTERS.encode(), np.uint8)[letter].tobytes().decode()
        made = made.astype(np.uint8).tobytes().decode()
        ends = np.cumsum(np.bincount(row, minlength=len(self.piece))).tolist()
        spans = list(zip([0, *ends[:-1]], ends, strict=True))
        return [letters[s:e] for s, e in spans], [made[s:e] for s, e in spans]


class Block:
    """The rows of a block, in order, and its pieces."""

    def __init__(self, rows: pa.Table, told: pa.Table | None = None) -> None:
        self.at = rows.column("at").to_numpy()
        order = np.argsort(self.at)
        self.at = self.at[order]
        column = lambda name: rows.column(name).to_numpy(zero_copy_only=False)[order]
        self.who, self.fault = column("who").astype(np.int64), column("fault").astype(np.int64)
        fresh, final = column("fresh").astype(bool), column("final").astype(bool)
        self.number = rows.column("block")[0].as_py()
        self.piece = np.cumsum(fresh) - int(fresh[0])
        self.n = int(self.piece[-1]) + 1
        self.follows, self.goes_on = not fresh[0], not final[-1]
        self.told = told.to_pylist()[0] if told is not None and len(told) else {}

    def ids(self) -> dict[int, int]:
        """Number of each open piece to its id: twice the block, one more if it does not begin it."""
        out = {0: 2 * self.number} if self.follows else {}
        if self.goes_on:
            out[self.n - 1] = 2 * self.number + (self.n > 1 or not self.follows)
        return out

    def paths(self) -> Paths:
        ends = np.tile(AT_END, (self.n, 1))
        open_ = np.zeros(self.n, bool)
        if self.goes_on:
            ends[-1], open_[-1] = self.told["ends"], True
        return Paths(self.who, self.fault, self.piece, ends, open_)


def _open_pieces(rows: DataFrame) -> DataFrame:
    """(id, block, next, matrix, last): the pieces that go on in a neighbouring block."""

    def run(table):
        block = Block(table)
        out = {"id": [], "block": [], "next": [], "matrix": [], "last": []}
        for number, piece in block.ids().items():
            own = block.piece == number
            goes_on = block.goes_on and number == block.n - 1
            kind = 4 * block.who[own] + block.fault[own]
            matrix = chained(kind, np.zeros(len(kind), np.int64))[0]
            out["id"].append(piece)
            out["block"].append(block.number)
            out["next"].append(2 * block.number + 2 if goes_on else None)
            out["matrix"].append(matrix.ravel().tolist())
            out["last"].append(int(block.who[own][-1]))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32()]
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), kinds, strict=True)})

    return rows.groupBy("block").applyInArrow(
        run, "id bigint, block bigint, next bigint, matrix array<bigint>, last int"
    )


def _cells(n: int, cell) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), cell)


def _product(a: Column, b: Column) -> Column:
    """``times`` of two matrices, as arrays by row."""
    return _cells(
        16,
        lambda i: F.array_min(
            F.concat(
                F.array(F.lit(FAR)),
                _cells(4, lambda k: a[F.shiftright(i, 2) * 4 + k] + b[k * 4 + i % 4]),
            )
        ),
    )


def _doubled(chain: DataFrame, link: str, value: str, join) -> DataFrame:
    """Rows (id, link, value) with the values of all rows along their links joined.

    Each round joins the value of the row that the link leads to and takes over its link.
    """
    while not chain.filter(F.col(link).isNotNull()).isEmpty():
        other = chain.select(
            F.col("id").alias(link), F.col(link).alias("_link"), F.col(value).alias("_value")
        )
        longer = F.when(F.col("_value").isNull(), F.col(value)).otherwise(
            join(F.col(value), F.col("_value"))
        )
        chain = materialize(
            chain.join(other, link, "left").select(
                "id", F.col("_link").alias(link), longer.alias(value)
            ),
            "repair-chain",
        )
    return chain


def _ends(pieces: DataFrame) -> DataFrame:
    """(block, ends): the costs to go at the end of each piece that goes on."""
    chain = _doubled(pieces.select("id", "next", "matrix"), "next", "matrix", _product)
    end = F.array(*(F.lit(int(x)).cast("bigint") for x in AT_END))
    costs = _cells(4, lambda s: F.array_min(_cells(4, lambda t: F.col("matrix")[s * 4 + t] + end[t])))
    begins = chain.select(F.col("id").alias("next"), costs.alias("ends"))
    return pieces.join(begins, "next").select("block", "ends")


def _entries(pieces: DataFrame, maps: DataFrame) -> DataFrame:
    """(block, entry, before): the state and the initial before each piece that follows another."""
    before = pieces.filter("next IS NOT NULL").select(
        F.col("next").alias("id"), F.col("id").alias("prev"), F.col("last").alias("before")
    )
    held = materialize(
        before.join(maps.withColumnRenamed("id", "prev"), "prev").join(
            pieces.select("id", "block"), "id"
        ),
        "repair-maps",
    )
    # A first piece starts in START: it has no map of its own, its link ends the chain.
    linked = held.join(held.select(F.col("id").alias("prev"), F.lit(True).alias("_more")), "prev", "left")
    chain = linked.select("id", F.when(F.col("_more"), F.col("prev")).alias("prev"), "exits")
    chain = _doubled(chain, "prev", "exits", lambda own, first: F.transform(first, lambda s: own[s]))
    return held.select("id", "block", "before").join(
        chain.select("id", F.col("exits")[START].alias("entry")), "id"
    ).select("block", "entry", "before")


def _slim(placed: DataFrame, block_rows: int) -> DataFrame:
    """(at, block, who, fault, fresh, final) of each row, without its text."""
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    who = F.lit(3)
    for k, letter in enumerate(WHO):
        who = F.when(initial == letter, k).otherwise(who)
    fault = F.when(bare == "", 1).when(F.substring(bare, -1, 1).isin(".", "!", "?"), 0).otherwise(3)
    never = F.lit(False)
    rows = placed.select(
        "at", who.alias("who"), fault.alias("fault"), *(never.alias(n) for n in ("seen", "fresh", "final"))
    )
    mark = lambda name: [
        F.lit(None).cast("int").alias("who"),
        F.lit(None).cast("int").alias("fault"),
        *(F.lit(n == name).alias(n) for n in ("seen", "fresh", "final")),
    ]
    # Marks are joined by place, not by conversation or text, so that no key is hot.
    firsts = placed.groupBy("conv_id", "role", F.sha2("text", 256).alias("_text")).agg(
        F.min("at").alias("at")
    )
    ends = placed.groupBy("conv_id").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    rows = (
        rows.union(firsts.select("at", *mark("seen")))
        .union(ends.select(F.col("first").alias("at"), *mark("fresh")))
        .union(ends.select(F.col("last").alias("at"), *mark("final")))
        .groupBy("at")
        .agg(*(F.max(n).alias(n) for n in ("who", "fault", "seen", "fresh", "final")))
    )
    fault = F.when((F.col("fault") != 1) & ~F.col("seen"), 2).otherwise(F.col("fault"))
    block = F.floor(F.col("at") / block_rows).cast("bigint")
    return rows.select("at", block.alias("block"), "who", fault.alias("fault"), "fresh", "final")


def edits(rows: DataFrame) -> DataFrame:
    """(at, fault, edits, made, illegal) of each slim row."""
    pieces = materialize(_open_pieces(rows), "repair-pieces")
    ends = materialize(_ends(pieces), "repair-ends")

    def exits(key, rows, told):
        if not len(told) or not len(rows):
            return pa.table({"id": pa.array([], pa.int64()), "exits": pa.array([], pa.list_(pa.int32()))})
        block = Block(rows, told)
        found = block.paths().exits()[-1].tolist()
        return pa.table(
            {
                "id": pa.array([block.ids()[block.n - 1]], pa.int64()),
                "exits": pa.array([found], pa.list_(pa.int32())),
            }
        )

    maps = (
        rows.groupBy("block")
        .cogroup(ends.groupBy("block"))
        .applyInArrow(exits, "id bigint, exits array<int>")
    )
    entries = _entries(pieces, maps)
    told = ends.join(entries, "block", "full")

    def run(key, rows, told):
        block = Block(rows, told)
        entry = np.full(block.n, START)
        if block.follows:
            entry[0] = block.told["entry"]
        letters, made = block.paths().edits(entry)
        # Neighbours of one conversation: su, ua and au are as they should be.
        before = np.append(block.told.get("before") or 0, block.who[:-1])
        legal = ((block.who == 1) & ((before == 0) | (before == 2))) | ((block.who == 2) & (before == 1))
        inner = np.append(block.follows, block.piece[1:] == block.piece[:-1])
        return pa.table(
            {
                "at": pa.array(block.at, pa.int64()),
                "fault": pa.array([FAULTS[f] for f in block.fault.tolist()], pa.string()),
                "edits": pa.array(letters, pa.string()),
                "made": pa.array(made, pa.string()),
                "illegal": pa.array(inner & ~legal, pa.bool_()),
            }
        )

    return (
        rows.groupBy("block")
        .cogroup(told.groupBy("block"))
        .applyInArrow(run, "at bigint, fault string, edits string, made string, illegal boolean")
    )


def repair(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Each of ``rows`` (conv_id, turn, role, text) with its fault and edits.

    ``at`` orders all rows by conversation; ``edits`` has the letters of what is inserted before the
    row, then its own, and after a conversation's last row those inserted there. ``messages`` are
    the (role, text) that these make, ``cost`` is what they cost, and ``illegal`` says that the row
    may not follow the one before it.
    """
    one = F.lit(" ")
    order = ["conv_id", "turn", "role", "text"]
    said = rows.select(
        "conv_id", "turn", F.coalesce("role", one).alias("role"), F.coalesce("text", one).alias("text")
    ).withColumn("_same", F.monotonically_increasing_id())
    placed = global_row_number(said, [F.asc_nulls_first(c) for c in (*order, "_same")], "at", first=0)
    slim = materialize(_slim(placed, block_rows), "repair-rows")
    found = placed.drop("_same").join(edits(slim), "at")

    def message(at: Column) -> Column:
        letter = F.substr(F.col("edits"), at, F.lit(1))
        maker = F.substr(F.col("made"), at, F.lit(1))
        given = F.when(maker == "k", F.col("role")).when(maker == "u", "user").otherwise("assistant")
        said = F.when(letter == "I", "").otherwise(F.col("text"))
        return F.when(maker != "-", F.struct(given.alias("role"), said.alias("text")))

    count = lambda letter: F.length(F.regexp_replace("edits", f"[^{letter}]", ""))
    cost = sum((count(k) * price for k, price in COSTS.items() if price), F.lit(0))
    stays = (F.col("fault") == "truncated") & ~F.contains(F.col("edits"), F.lit("D"))
    places = F.sequence(F.lit(1), F.length("edits"))
    return found.withColumns(
        {
            "cost": (cost + F.when(stays, TRUNCATED_COST).otherwise(0)).cast("bigint"),
            "messages": F.filter(F.transform(places, message), lambda m: m.isNotNull()),
        }
    )
