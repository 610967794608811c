"""Conversation structure repair: the cheapest edits, and of those the least audit.

Edits form a graph of (rows behind, state of the role pattern). A cost program
leaves its optimal arcs; audits of 1, 2, 4, ... edits are ranked by prefix
doubling, and the least path is read off the doubled pointers. A conversation is
cut into pieces of bounded size: costs pass between them as min-plus matrices,
so that one of very many turns is not one task's work.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultsift.llm.common import WORD, importable, mapped, pick, staged, table

# Costs of edits.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

# States: nothing yet, after a system turn, after a user turn, after an assistant turn.
STATES = 4
# State after keeping a role initial (-1: not allowed), and the state and role of other edits.
KEPT = {"s": (1, -1, -1, -1), "u": (2, 2, -1, 2), "a": (-1, -1, 3, -1)}
FORCED = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
# What it costs a finished conversation to be in a state: empty, or after an assistant turn.
ENDS = (0, None, None, 0)
FAR = 1 << 40

# The letters of an audit, in their order.
LETTERS = "DIKR"

# Rows of a piece.
PIECE_ROWS = 20_000

_TABLE = np.full((4, STATES), -1)
for _k, _initial in enumerate("sua"):
    _TABLE[_k] = KEPT[_initial]
_FORCED = np.array(FORCED)


def _inserts(costs: np.ndarray) -> np.ndarray:
    """Least costs by state if turns may be inserted first."""
    out = costs.copy()
    out[:, 2] = np.minimum(costs[:, 2], INSERT + costs[:, 3])
    out[:, 3] = np.minimum(costs[:, 3], INSERT + costs[:, 2])
    out[:, :2] = np.minimum(costs[:, :2], INSERT + out[:, 2:3])
    return out


class Pieces:
    """The optimal arcs of pieces of conversations.

    ``sizes`` are their rows; ``initials`` (0 to 2 for s, u, a, else 3),
    ``deleted`` and ``truncated`` describe all rows in order. ``exits`` has the
    cost behind each piece by state, ``last`` tells which pieces end their
    conversation, where turns may be inserted after the last row. Node
    4 * layer + state, from a piece's base on, stands before row ``layer``.
    """

    def __init__(self, sizes, initials, deleted, truncated, exits, last):
        self.sizes = np.asarray(sizes, np.int64)
        rows = np.concatenate(([0], np.cumsum(self.sizes)))[:-1]
        self.base = STATES * np.concatenate(([0], np.cumsum(self.sizes + 1)))[:-1]
        n = int(STATES * (self.sizes + 1).sum())
        self.costs = np.zeros((n // STATES, STATES), np.int64)
        # The node that a letter leads to from a node, or -1 where the arc is not optimal.
        self.arcs = np.full((n // STATES, STATES, len(LETTERS)), -1)
        order = np.argsort(-self.sizes, kind="stable")
        costs = np.asarray(exits, np.int64)[order]
        layer = self.base[order] // STATES + self.sizes[order]
        ending = np.asarray(last, bool)[order]
        whole = np.where(ending[:, None], _inserts(costs), costs)
        self.costs[layer] = whole
        self._insert_arcs(layer, whole, ending[:, None] & (whole < costs))
        costs = whole
        for back in range(1, int(self.sizes.max(initial=0)) + 1):
            fit = int(np.searchsorted(-self.sizes[order], -back, "right"))
            own, costs = order[:fit], costs[:fit]
            row = rows[own] + self.sizes[own] - back
            layer = self.base[own] // STATES + self.sizes[own] - back
            more = TRUNCATED * truncated[row][:, None]
            free = ~deleted[row][:, None]
            to = _TABLE[initials[row]]
            keep = np.where(free & (to >= 0), more + np.take_along_axis(costs, np.maximum(to, 0), 1), FAR)
            rerole = np.where(free, REROLE + more + costs[:, _FORCED], FAR)
            delete = DELETE + costs
            least = np.minimum(np.minimum(keep, rerole), delete)
            whole = _inserts(least)
            self.costs[layer] = whole
            behind = STATES * (layer[:, None] + 1)
            open_ = whole < FAR
            for letter, cost, state in (
                ("D", delete, np.arange(STATES)),
                ("K", keep, to),
                ("R", rerole, _FORCED),
            ):
                best = open_ & (cost == whole)
                self.arcs[layer, :, LETTERS.index(letter)] = np.where(best, behind + state, -1)
            inserted = INSERT + whole[:, _FORCED]
            self._insert_arcs(layer, whole, open_ & (inserted == whole))
            costs = whole

    def _insert_arcs(self, layer: np.ndarray, costs: np.ndarray, wanted: np.ndarray) -> None:
        best = wanted & (INSERT + costs[:, _FORCED] == costs)
        to = np.where(best, STATES * layer[:, None] + _FORCED, -1)
        self.arcs[layer, :, LETTERS.index("I")] = to

    def entry_costs(self) -> np.ndarray:
        return self.costs[self.base // STATES]

    def rank(self) -> None:
        """Ranks the least audits of all nodes, doubling their length, and picks each node's arc.

        A letter leads from a node to one other node, so the rank of the first
        letter and that of the 2^k letters behind the first 2^k order audits of
        twice the length; a node without arcs ranks first and points at itself.
        """
        arcs = self.arcs.reshape(-1, len(LETTERS))
        nodes = np.arange(len(arcs))
        some = (arcs >= 0).any(axis=1)
        letter = np.where(some, (arcs >= 0).argmax(axis=1), -1)
        at = np.where(some, arcs[nodes, letter], nodes)
        ranks, steps = letter + 1, some.astype(np.int64)
        self.letter, self.jumps = letter, [at]
        while some[at].any():
            ranks = np.unique(ranks * (len(arcs) + 5) + ranks[at], return_inverse=True)[1]
            steps = steps + steps[at]
            at = at[at]
            self.jumps.append(at)
        # Of several arcs of a node the least (letter, rank of the audit behind it).
        order = np.where(arcs >= 0, np.arange(len(LETTERS)) * (len(arcs) + 5) + ranks[arcs], FAR)
        picked = order.argmin(axis=1)
        if not np.array_equal(picked[some], letter[some]):
            raise AssertionError("a letter leads to two nodes")
        self.ranks, self.steps, self.end = ranks, steps, at

    def exit_states(self) -> np.ndarray:
        """The state behind each piece that its least path reaches, by entry state."""
        return self.end[self.base[:, None] + np.arange(STATES)] % STATES

    def paths(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nodes that have an edit on the least path of each piece, and where each piece's begin."""
        start = self.base + entries
        counts = self.steps[start]
        cuts = np.concatenate(([0], np.cumsum(counts)))
        at = np.repeat(start, counts)
        nth = np.arange(cuts[-1]) - np.repeat(cuts[:-1], counts)
        for k, jump in enumerate(self.jumps):
            far = (nth >> k & 1).astype(bool)
            at[far] = jump[at[far]]
        return at, cuts


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


_SPACE = " \t\n\x0b\x0c\r"


def ordered_turns(rows: DataFrame, copies: Column | None = None) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) in order, with faults, staged.

    (conv_id, turn, role, text, fault, initial, piece, pos). Rows go by turn,
    null turns first, then role and text. ``copies`` repeats a row. ``fault``
    is blank, duplicate, truncated or null, the first that applies. The rows
    of ``piece`` are neighbours and at most PIECE_ROWS; ``pos`` orders all.
    Rows are dealt by range, so a conversation of very many is spread.
    """
    rows = rows.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text",
        (F.lit(1) if copies is None else copies).cast("long").alias("n"),
    )
    # Equal rows are counted before they are shuffled; only the first of them can be the first seen.
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))
    seen = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    rows = staged(rows.withColumn("seen", seen), "rows")
    place = F.struct(F.col("turn").isNotNull().alias("some"), "turn")
    first = rows.groupBy(F.col("conv_id").alias("own"), F.col("seen").alias("same")).agg(
        F.min(place).alias("first"), F.count("*").alias("times")
    )
    first = staged(first.where("times > 1").drop("times"), "first")
    match = F.col("conv_id").eqNullSafe(F.col("own")) & (F.col("seen") == F.col("same"))
    rows = rows.join(first, match, "left")
    later = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(place)
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    last = F.right(F.rtrim("text", F.lit(_SPACE)), F.lit(1))
    fault = (
        F.when(~F.rlike("text", F.lit(WORD)), "blank")
        .when(later | (F.col("copy") > 1), "duplicate")
        .when(~last.isin(".", "!", "?"), "truncated")
    )
    rows = rows.select(
        "conv_id", "turn", "role", "text", fault.alias("fault"), F.left("role", F.lit(1)).alias("initial"), "copy"
    )
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "copy"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.withColumn("pos", F.monotonically_increasing_id())
    nth = F.col("pos").bitwiseAND(F.lit((1 << 33) - 1))
    piece = F.shiftright("pos", 33) * (1 << 24) + F.floor(nth / PIECE_ROWS)
    return staged(rows.withColumn("piece", piece.cast("long")).drop("copy"), "turns")


_COLUMNS = ["conv_id", "role", "text", "fault", "initial", "piece", "exits", "entry", "ends"]


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    """Whole pieces, at least PIECE_ROWS rows at a time."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n < 2 * PIECE_ROWS:
            continue
        rows = pa.Table.from_batches(held).combine_chunks()
        piece = rows.column("piece").to_numpy()
        cut = int(np.searchsorted(piece != piece[-1], False)) if piece[0] != piece[-1] else 0
        if cut:
            yield rows.slice(0, cut)
            rows = rows.slice(cut)
        held, n = rows.to_batches(), len(rows)
    if held:
        yield pa.Table.from_batches(held)


class _Solved:
    """The pieces of a batch of rows: each is the rows of one conversation in one piece."""

    def __init__(self, rows: pa.Table):
        conv, piece = rows.column("conv_id"), rows.column("piece").to_numpy()
        ids = conv.fill_null(0).to_numpy()
        null = conv.is_null().to_numpy()
        new = np.ones(len(piece), bool)
        new[1:] = (piece[1:] != piece[:-1]) | (ids[1:] != ids[:-1]) | (null[1:] != null[:-1])
        self.first = np.flatnonzero(new)
        self.cuts = np.append(self.first, len(piece))
        self.conv = conv.take(pa.array(self.first))
        self.piece = piece[self.first]
        self.initial = rows.column("initial").to_pylist()
        fault = np.array([x or "" for x in rows.column("fault").to_pylist()], dtype=object)
        code = {"s": 0, "u": 1, "a": 2}
        kinds = np.array([code.get(x, 3) for x in self.initial], np.int64)
        self.ends = rows.column("ends").to_numpy(zero_copy_only=False)[self.first]
        exits = rows.column("exits").take(pa.array(self.first)).to_pylist()
        gone = (fault == "blank") | (fault == "duplicate")
        self.arguments = (np.diff(self.cuts), kinds, gone, fault == "truncated", exits, self.ends)

    def solve(self) -> Pieces:
        return Pieces(*self.arguments)


def _pieces(rows: DataFrame, run, schema: str) -> DataFrame:
    """Applies ``run`` to whole pieces."""
    importable(rows.sparkSession)
    rows = rows.repartition("piece").sortWithinPartitions("piece", "pos").select(*_COLUMNS)
    return mapped(rows, lambda batches: map(run, _batches(batches)), schema)


def _arrow(columns: dict, schema: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[name], kind) if not isinstance(columns[name], pa.ChunkedArray)
         else columns[name].combine_chunks() for name, kind in schema.items()],
        list(schema),
    )


_LONGS = pa.list_(pa.int64())


def _crossings(rows: pa.Table) -> pa.RecordBatch:
    """The cost of crossing each piece, from each state to each state."""
    solved = _Solved(rows)
    sizes, kinds, gone, truncated, _, _ = solved.arguments
    out = []
    for state in range(STATES):
        exits = np.full((len(sizes), STATES), FAR)
        exits[:, state] = 0
        inner = Pieces(sizes, kinds, gone, truncated, exits, np.zeros(len(sizes), bool))
        out.append(np.minimum(inner.entry_costs(), FAR))
    costs = np.stack(out, axis=2).reshape(len(sizes), -1)
    return _arrow(
        {"conv_id": solved.conv, "piece": solved.piece, "costs": costs.tolist()},
        {"conv_id": pa.int64(), "piece": pa.int64(), "costs": _LONGS},
    )


def _ways(rows: pa.Table) -> pa.RecordBatch:
    """The state behind each piece by entry state, on the least path."""
    solved = _Solved(rows)
    found = solved.solve()
    found.rank()
    return _arrow(
        {"conv_id": solved.conv, "piece": solved.piece, "ways": found.exit_states().tolist()},
        {"conv_id": pa.int64(), "piece": pa.int64(), "ways": _LONGS},
    )


END_COSTS = [FAR if cost is None else cost for cost in ENDS]


def _exits(pieces: pd.DataFrame) -> pd.DataFrame:
    """The costs behind each piece of a conversation, from its last piece back."""
    pieces = pieces.sort_values("piece")
    behind, out = None, []
    for costs in pieces["costs"][::-1]:
        if behind is None:
            out.append(END_COSTS)
            behind = _inserts(np.array([END_COSTS]))[0]
        else:
            out.append(behind.tolist())
        crossing = np.asarray(list(costs)).reshape(STATES, STATES)
        behind = np.minimum((crossing + behind).min(axis=1), FAR)
    ends = [False] * (len(out) - 1) + [True]
    return pd.DataFrame(
        {"conv_id": pieces["conv_id"], "piece": pieces["piece"], "exits": out[::-1], "ends": ends}
    )


def _entries(pieces: pd.DataFrame) -> pd.DataFrame:
    """The state before each piece of a conversation, from its first piece on."""
    pieces = pieces.sort_values("piece")
    state, out = 0, []
    for ways in pieces["ways"]:
        out.append(state)
        state = int(ways[state])
    return pd.DataFrame({"conv_id": pieces["conv_id"], "piece": pieces["piece"], "entry": out})


_REPAIRED = {
    "conv_id": pa.int64(), "piece": pa.int64(), "cost": pa.int64(), "audit": pa.string(),
    "illegal": pa.int64(), "first_initial": pa.string(), "last_initial": pa.string(),
    "n_lines": pa.int64(), "lines": pa.string(), "repaired_sha256": pa.string(),
}


def _repair(rows: pa.Table) -> pa.RecordBatch:
    """The least cheapest edits of each piece and what they make of it."""
    solved = _Solved(rows)
    found = solved.solve()
    found.rank()
    whole = rows.column("entry").is_null().to_numpy()[solved.first]
    entries = rows.column("entry").fill_null(0).to_numpy()[solved.first]
    nodes, cuts = found.paths(entries)
    letters = found.letter[nodes].tolist()
    layers = nodes // STATES - np.repeat(found.base // STATES, np.diff(cuts))
    layers, states = layers.tolist(), (nodes % STATES).tolist()
    roles, texts = rows.column("role").to_pylist(), rows.column("text").to_pylist()
    out: dict[str, list] = {name: [] for name in list(_REPAIRED)[2:]}
    costs = found.entry_costs()
    for k, (begin, end) in enumerate(zip(solved.cuts, solved.cuts[1:])):
        lines = []
        for at in range(cuts[k], cuts[k + 1]):
            letter, row = LETTERS[letters[at]], begin + layers[at]
            if letter == "K":
                lines.append(f"{roles[row]}:{texts[row]}")
            elif letter == "R":
                lines.append(f"{ROLE[FORCED[states[at]]]}:{texts[row]}")
            elif letter == "I":
                lines.append(f"{ROLE[FORCED[states[at]]]}:")
        initials = solved.initial[begin:end]
        body = "\n".join(lines)
        out["cost"].append(int(costs[k, entries[k]]))
        out["audit"].append("".join(LETTERS[n] for n in letters[cuts[k] : cuts[k + 1]]))
        out["illegal"].append(sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])))
        out["first_initial"].append(initials[0])
        out["last_initial"].append(initials[-1])
        out["n_lines"].append(len(lines))
        out["lines"].append(body)
        out["repaired_sha256"].append(hashlib.sha256(body.encode()).hexdigest() if whole[k] else None)
    return _arrow({"conv_id": solved.conv, "piece": solved.piece, **out}, _REPAIRED)


# Initials of two turns in a row that are in order.
LEGAL = ("su", "ua", "au")

_SCHEMA = (
    "conv_id long, piece long, cost long, audit string, illegal long, first_initial string, "
    "last_initial string, n_lines long, lines string, repaired_sha256 string"
)


def repaired_pieces(turns: DataFrame) -> DataFrame:
    """The repaired pieces of ``ordered_turns``, staged, with the edits' audit and the text lines.

    (conv_id, piece, cost, audit, illegal, first_initial, last_initial, n_lines,
    lines, repaired_sha256): pieces in order make their conversation; ``cost``
    is that of all edits from the piece on, and the hash is only given where
    the piece is a whole conversation. Conversations in several pieces are
    solved piece by piece in three rounds: crossing costs, ways, edits; between
    them one short row a piece meets in a task.
    """
    cut = turns.select("conv_id", "piece").distinct().groupBy("conv_id").agg(F.count("*").alias("n"))
    cut = staged(cut.where("n > 1").select(F.col("conv_id").alias("own")), "cut")
    long = turns.join(cut, F.col("conv_id").eqNullSafe(F.col("own")), "left_semi")
    empty = {
        "exits": F.lit(None).cast("array<long>"),
        "entry": F.lit(None).cast("long"),
        "ends": F.lit(False),
    }
    crossing = _pieces(long.withColumns(empty), _crossings, "conv_id long, piece long, costs array<long>")
    exits = crossing.groupBy("conv_id").applyInPandas(
        _exits, "conv_id long, piece long, exits array<long>, ends boolean"
    )
    exits = staged(exits, "exits")

    def with_pieces(rows: DataFrame, more: DataFrame, names: list[str], how: str) -> DataFrame:
        more = more.select(F.col("conv_id").alias("own"), F.col("piece").alias("at"), *names)
        same = F.col("conv_id").eqNullSafe(F.col("own")) & (F.col("piece") == F.col("at"))
        return rows.join(more, same, how).drop("own", "at")

    known = with_pieces(long, exits, ["exits", "ends"], "inner").withColumn("entry", empty["entry"])
    ways = _pieces(known, _ways, "conv_id long, piece long, ways array<long>")
    entry = ways.groupBy("conv_id").applyInPandas(_entries, "conv_id long, piece long, entry long")
    states = staged(with_pieces(exits, entry, ["entry"], "inner"), "states")
    rows = with_pieces(turns, states, ["exits", "entry", "ends"], "left")
    ends = F.array(*[F.lit(cost).cast("long") for cost in END_COSTS])
    rows = rows.withColumns(
        {"exits": F.coalesce("exits", ends), "ends": F.coalesce("ends", F.lit(True))}
    )
    return staged(_pieces(rows, _repair, _SCHEMA), "pieces")


def _joined(pieces: DataFrame) -> DataFrame:
    """Conversations in several pieces: a digest is sequential, so one task streams each."""
    importable(pieces.sparkSession)
    names = {"conv_id": pa.int64(), "cost": pa.int64(), "audit": pa.string(), "illegal": pa.int64(),
             "repaired_sha256": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, begun, held = None, False, None
        for batch in batches:
            done = []
            for conv, cost, audit, illegal, head, tail, n, lines in zip(*(c.to_pylist() for c in batch.columns)):
                if not begun or conv != at:
                    if begun:
                        done.append(held)
                    at, begun = conv, True
                    held = [conv, cost, [], 0, hashlib.sha256(), None, 0]
                held[2].append(audit)
                held[3] += illegal + (held[5] is not None and held[5] + head not in LEGAL)
                if n:
                    held[4].update((("\n" if held[6] else "") + lines).encode())
                held[5], held[6] = tail, held[6] + n
            yield out(done)
        if begun:
            yield out([held])

    def out(done: list) -> pa.RecordBatch:
        rows = [(c, cost, "".join(audit), illegal, sha.hexdigest()) for c, cost, audit, illegal, sha, *_ in done]
        columns = list(zip(*rows)) if rows else [[]] * len(names)
        return _arrow(dict(zip(names, columns)), names)

    order = [F.col("conv_id").asc_nulls_first(), F.col("piece")]
    rows = pieces.repartition("conv_id").sortWithinPartitions(*order)
    rows = rows.select(
        "conv_id", "cost", "audit", "illegal", "first_initial", "last_initial", "n_lines", "lines"
    )
    return mapped(rows,
        run, "conv_id long, cost long, audit string, illegal long, repaired_sha256 string"
    )


def repair_report(conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """One row a conv_id of ``conversations`` (conv_id): the faults and the repair of its ``ordered_turns``.

    (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256). A null id is a conversation like others. One without
    turns has zeros, an empty audit and the hash of an empty text; without
    conversations there is no row.
    """
    faults = {
        name: F.count(F.when(F.col("fault") == name, 1)).alias(name)
        for name in ("blank", "duplicate", "truncated")
    }
    # Counted by turn first, so that a conversation of very many rows is not one key.
    by_turn = turns.groupBy("conv_id", "turn").agg(*faults.values())
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    counts = by_turn.groupBy("conv_id").agg(
        F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"), *[F.sum(n).alias(n) for n in faults]
    )
    pieces = repaired_pieces(turns)
    names = ["conv_id", "cost", "audit", "illegal", "repaired_sha256"]
    whole = F.col("repaired_sha256").isNotNull()
    repaired = pieces.where(whole).select(*names).union(_joined(pieces.where(~whole)).select(*names))
    left = pick(conversations, "conv_id").select(F.col("conv_id").cast("long").alias("id")).distinct()
    own = F.col("id").eqNullSafe(F.col("conv_id"))
    rows = left.join(counts, own, "left").drop("conv_id").join(repaired, own, "left")
    zeros = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return rows.select(
        F.col("id").alias("conv_id"),
        *[F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in zeros],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """The contract's damage to ``rows`` (conv_id, turn, role, text): (conv_id, turn, role, text, copies).

    A null role or text counts as one space, as does a null id or turn in the
    checksum that selects the damage.
    """
    kind = F.crc32(F.concat(_text("conv_id"), F.lit(":"), _text("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    filled = pick(rows, "conv_id", "turn", "role", "text")
    filled = filled.select("conv_id", "turn", _text("role").alias("role"), _text("text").alias("text"))
    return filled.where(kind != 0).select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def repaired(rows: DataFrame) -> DataFrame:
    """(conv_id, piece, audit, lines) of ``rows`` (conv_id, turn, role, text) after repair.

    The pieces of a conversation in order have its repaired turns as
    ``role:text`` lines; nulls count as one space.
    """
    filled = pick(rows, "conv_id", "turn", "role", "text")
    filled = filled.select("conv_id", "turn", _text("role").alias("role"), _text("text").alias("text"))
    return repaired_pieces(ordered_turns(filled)).select("conv_id", "piece", "audit", "lines")


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    hurt = damaged(rows)
    return repair_report(rows, ordered_turns(hurt, F.col("copies")))


def _sql() -> str:
    """The audit program forwards, with the least (cost, audit, lines) of each state."""

    def edit(state: str, cost: str, letter: str, role: str = "", text: str = "") -> str:
        line = f" || chr(10) || {role} || ':' || {text}" if role else ""
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'r': {state}.r{line}}}"

    def least(*options: str) -> str:
        return f"list_sort([{', '.join(options)}])[1]"

    def when(allowed: str, option: str) -> str:
        return f"CASE WHEN {allowed} THEN {option} ELSE far END"

    steps: dict[int, list[str]] = {q: [edit(f"s{q}", str(DELETE), "D")] for q in range(STATES)}
    for initial, to in KEPT.items():
        for q, state in enumerate(to):
            if state >= 0:
                kept = edit(f"s{q}", "more", "K", "role", "text")
                steps[state].append(when(f"free AND initial = '{initial}'", kept))
    for q, state in enumerate(FORCED):
        rerole = edit(f"s{q}", f"{REROLE} + more", "R", f"'{ROLE[state]}'", "text")
        steps[state].append(when("free", rerole))
    user = [edit(f"p{q}", str(INSERT), "I", "'user'", "''") for q in (0, 1, 3)]
    two = least("p2", *user)
    three = least("p3", edit("t2", str(INSERT), "I", "'assistant'", "''"))
    crc = """xor(list_reduce(list_transform(string_split(key, ''), lambda x: ascii(x)::BIGINT), lambda crc, x:
        list_reduce(range(8), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)), xor(crc, x)), 4294967295), 4294967295)"""
    start = "{'c': 0, 'a': '', 'r': ''}"
    far = "{'c': 1000000000, 'a': '', 'r': ''}"
    space = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

    def relaxed(inner: str) -> str:
        return f"""SELECT conv_id, n, p0 AS s0, p1 AS s1, t2 AS s2, {three} AS s3
        FROM (SELECT *, {two} AS t2 FROM ({inner}))"""

    first = f"SELECT DISTINCT conv_id, 0::BIGINT AS n, {start} AS p0, {far} AS p1, {far} AS p2, {far} AS p3 FROM rows_in_order"
    moved = ", ".join(f"{least(*steps[q])} AS p{q}" for q in range(STATES))
    following = f"""SELECT s.conv_id, t.n, {moved} FROM states s JOIN rows_in_order t
        ON s.conv_id IS NOT DISTINCT FROM t.conv_id AND t.n = s.n + 1"""
    return f"""
WITH RECURSIVE keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
    FROM conversations
), dealt AS (
    SELECT *, {crc} % 20 AS kind FROM keyed
), hurt AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
    FROM dealt WHERE kind <> 0
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS n,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
        rtrim(text, {space}) AS body
    FROM hurt
), faulted AS (
    SELECT *, left(role, 1) AS initial, CASE WHEN body = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
        WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
    FROM numbered
), rows_in_order AS (
    SELECT *, fault NOT IN ('blank', 'duplicate') AS free, (fault = 'truncated')::INT AS more, {far} AS far,
        lag(initial) OVER (PARTITION BY conv_id ORDER BY n) || initial NOT IN {LEGAL} AS wrong
    FROM faulted
), states AS (
    {relaxed(first)}
    UNION ALL
    {relaxed(following)}
), ended AS (
    SELECT conv_id, arg_max({least("s0", "s3")}, n) AS best FROM states GROUP BY conv_id
), counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (WHERE fault = 'blank') AS blank,
        count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
        count(*) FILTER (WHERE fault = 'truncated') AS truncated,
        count(*) FILTER (WHERE wrong) AS illegal
    FROM rows_in_order GROUP BY conv_id
), ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
    coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit,
    sha256(coalesce(substr(best.r, 2), '')) AS repaired_sha256
FROM ids i LEFT JOIN counts c ON i.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ended e ON i.conv_id IS NOT DISTINCT FROM e.conv_id
"""


OP13_SQL = _sql()
