"""Conversation structure repair: cheapest edits, ties by prefix-doubling ranks of their audit strings.

The rows of a conversation, by turn, are edited until the initials of the roles read ``(s?(ua)+)?``. Keep (K)
costs 0, Rerole to user or assistant (R) 1, Delete (D) 2, Insert of an empty user or assistant row (I) 5. A
blank or duplicate row must be deleted; a truncated one costs 5 more unless it is. Of the cheapest edits those
whose initials, the *audit*, come first in ASCII order are made.

1. *Cost DP.* A node is (rows done, state); the states are: nothing yet, after s, after u, after a. Its cost is that
   of the cheapest edits that finish from there.
2. *Ranking.* An optimal arc is an edit that keeps to the cost of its node. The letters of a node's optimal
   arcs differ, so the least letter points to one next node. Nodes are ranked by the first letter of their
   least audit, then, in each round, by the ranks of themselves and of the node that the pointer reaches,
   while pointers double: ranks of the first 1, 2, 4, 8 ... letters.
3. *Path.* Each node takes the optimal arc that is least by letter and rank of its target. The least path
   from the start is read off the doubled pointers: the first 2^k nodes and the jump by 2^k give the first 2^(k+1).

Scale: a conversation is cut into blocks of ``block_rows`` rows, numbered across range partitions, so that one
with a third of all rows is many tasks. Blocks of longer conversations are tied together by exclusive products of small
matrices (cheapest cost from each state at a block's start to each at its end, from the back; then the state in which
the least path leaves the block, from the front), in groups of ``GROUP`` per level. Texts take no part in this
but for one hash; they join the edits by row number at the end.

Edge cases: a null role or text is one space (such a text is blank). A null conversation id is a conversation of
its own. Null turns come first; rows that tie in turn come by role and text hash, so repeated rows are neighbours.
Rows are duplicates if two 64-bit hashes of role and text agree. Very long texts are hashed whole, conversations of any
length are repaired whole. An empty table gives empty results. Other columns, of any name, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.ranking import distributed_row_number
from starloom.llm.common import WS_CHARS, written

BLOCK_ROWS = 1024
GROUP = 256

DELETE, INSERT, KEEP, REROLE = range(4)  # in ASCII order of their initials
LETTERS = "DIKR"
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 2, 5, 1, 5
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3

_INF = 1 << 40
#: Next state of an inserted or reroled row, and of a kept row by its initial (s, u, a, other); 4: not allowed.
_NEXT = np.array([2, 2, 3, 2])
_KEPT = np.array([[1, 4, 4, 4], [2, 2, 4, 2], [4, 4, 3, 4], [4, 4, 4, 4]])
_ROLE = {2: "user", 3: "assistant"}
_SLICE_ROWS = 1 << 16

_EDIT = pa.struct([("edit", pa.string()), ("row", pa.int64()), ("role", pa.string())])


def _inserted(cost: np.ndarray) -> np.ndarray:
    """Costs by state (last axis) when rows may be inserted first; two reach every state that can be reached."""
    return np.minimum(np.minimum(cost, INSERT_COST + cost[..., _NEXT]), 2 * INSERT_COST + cost[..., _NEXT[_NEXT]])


class Blocks:
    """Blocks of rows, all worked on together. ``codes`` has ``initial + 4 * fault`` of each row; block ``b``
    is ``codes[bounds[b] : bounds[b + 1]]``; ``last`` marks the conversations' last blocks."""

    def __init__(self, codes: np.ndarray, bounds: np.ndarray, last: np.ndarray):
        self.codes, self.bounds, self.last = codes, bounds, last
        self.n = np.diff(bounds)
        self.first = 4 * (bounds[:-1] + np.arange(len(self.n)))  # the node of state 0 before the first row
        self.nodes = 4 * (len(codes) + len(self.n))
        self.fault = codes >> 2
        self.free = (self.fault != BLANK) & (self.fault != DUPLICATE)
        self.extra = TRUNCATED_COST * (self.fault == TRUNCATED)

    def costs(self, ends: np.ndarray) -> np.ndarray:
        """The cost of every node, given those behind the last row of each block (by state)."""
        cost = np.full(self.nodes, _INF, np.int64)
        state = np.arange(4)
        cost[(self.first + 4 * self.n)[:, None] + state] = np.where(self.last[:, None], _inserted(ends), ends)
        order = np.argsort(-self.n, kind="stable")
        many = np.searchsorted(-self.n[order], -np.arange(int(self.n.max(initial=0)) + 1), side="right")
        for back in range(1, len(many)):
            b = order[: many[back]]
            i = self.n[b] - back
            node, row = (self.first[b] + 4 * i)[:, None] + state, self.bounds[b] + i
            after = np.concatenate([cost[node + 4], np.full((len(b), 1), _INF)], axis=1)
            kept = np.take_along_axis(after, _KEPT[self.codes[row] & 3], axis=1)
            edited = np.minimum(kept, REROLE_COST + after[:, _NEXT]) + self.extra[row][:, None]
            best = np.minimum(DELETE_COST + after[:, :4], np.where(self.free[row][:, None], edited, _INF))
            cost[node] = np.minimum(_inserted(best), _INF)
        return cost

    def arcs(self, cost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each letter and node: whether that edit is on a cheapest path, and the node it leads to."""
        block = np.repeat(np.arange(len(self.n)), 4 * (self.n + 1))
        node = np.arange(self.nodes)
        state = node % 4
        i = (node - self.first[block]) // 4
        end = i == self.n[block]
        row = np.minimum(self.bounds[block] + i, max(len(self.codes) - 1, 0))
        code = self.codes[row] if len(self.codes) else np.zeros(self.nodes, np.int64)
        free, extra = (x[row] if len(x) else np.zeros(self.nodes, np.int64) for x in (self.free, self.extra))
        kept = _KEPT[code & 3, state]
        here = node - state
        target = np.stack([node + 4, here + _NEXT[state], here + 4 + kept % 4, here + 4 + _NEXT[state]])
        price = np.stack([np.full(self.nodes, DELETE_COST), np.full(self.nodes, INSERT_COST), extra, REROLE_COST + extra])
        open_ = np.stack([~end, ~end | self.last[block], ~end & (kept < 4) & (free > 0), ~end & (free > 0)])
        target = np.where(open_, target, node)
        return open_ & (cost < _INF) & (cost[target] + price == cost), target


@dataclass
class Paths:
    """The least path of every node: its letters, and the pointers by 1, 2, 4 ... letters."""

    letter: np.ndarray  # of the arc taken, -1 at a path's end
    rank: np.ndarray  # of the node by its audit
    jumps: list[np.ndarray]

    def nodes(self, start: np.ndarray) -> np.ndarray:
        """The nodes from each start on, as rows; a path's last node is repeated."""
        path = start[:, None]
        for jump in self.jumps:
            path = np.concatenate([path, jump[path]], axis=1)
        return path


def _dense(key: np.ndarray) -> np.ndarray:
    return np.unique(key, return_inverse=True)[1]


def least_paths(optimal: np.ndarray, target: np.ndarray, longest: int) -> Paths:
    """Rank nodes by their least audits and take the least arcs. ``optimal`` and ``target`` are by letter
    (ascending) and node; no path is longer than ``longest`` letters."""
    node = np.arange(target.shape[1])
    open_ = optimal.any(axis=0)
    first = optimal.argmax(axis=0)
    rank = np.where(open_, first + 1, 0)  # an ended audit comes before any letter
    pointer = np.where(open_, target[first, node], node)
    length = 1
    while length < longest:
        rank = _dense(rank * (int(rank.max()) + 1) + rank[pointer])
        pointer, length = pointer[pointer], 2 * length
    order = np.where(optimal, np.arange(4)[:, None] * (len(node) + 1) + rank[target], np.iinfo(np.int64).max)
    letter = np.where(open_, order.argmin(axis=0), -1)
    pointer = np.where(open_, target[letter, node], node)
    jumps = [pointer]
    while 2 ** len(jumps) < longest + 1:
        pointer = pointer[pointer]
        jumps.append(pointer)
    return Paths(letter, rank, jumps)


_END = np.array([0, _INF, _INF, 0], np.int64)  # a conversation may end empty or after an assistant


def _sliced(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, Blocks]]:
    """The blocks of a batch in slices of similar length and at most _SLICE_ROWS rows (or one block)."""
    lists = batch.column("codes")
    sizes = lists.value_lengths().to_numpy()
    values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
    last = batch.column("last").to_numpy(zero_copy_only=False)
    order = np.argsort(sizes, kind="stable")
    kind = np.ceil(np.log2(np.maximum(sizes[order], 1)))
    at = 0
    while at < len(order):
        to = at + 1 + int(np.searchsorted(np.cumsum(sizes[order[at + 1 :]]) + sizes[order[at]], _SLICE_ROWS, side="right"))
        to = min(to, int(np.searchsorted(kind, kind[at], side="right")))
        rows = order[at:to]
        codes = np.concatenate([values[offsets[r] : offsets[r + 1]] for r in rows]).astype(np.int64)
        yield rows, Blocks(codes, np.concatenate([[0], np.cumsum(sizes[rows])]), last[rows])
        at = to


def _longest(blocks: Blocks) -> int:
    return 3 * (int(blocks.n.max(initial=0)) + 1)  # an edit and two insertions a row


def _cost_matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = np.zeros((batch.num_rows, 4, 4), np.int64)
        for rows, blocks in _sliced(batch):
            blocks.last = np.zeros(len(rows), bool)  # insertions behind the last block are part of its end costs
            for state in range(4):
                ends = np.full((len(rows), 4), _INF, np.int64)
                ends[:, state] = 0
                out[rows, :, state] = blocks.costs(ends)[blocks.first[:, None] + np.arange(4)]
        yield _with_matrix(batch, out)


def _with_matrix(batch: pa.RecordBatch, matrices: np.ndarray) -> pa.RecordBatch:
    m = pa.FixedSizeListArray.from_arrays(pa.array(matrices.reshape(-1), pa.int64()), 16).cast(pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([batch.column("c"), batch.column("block"), m], names=["c", "block", "m"])


def _ends(batch: pa.RecordBatch, rows: np.ndarray) -> np.ndarray:
    given = batch.column("after").take(pa.array(rows)).to_pylist()
    behind = _inserted(_END)
    return np.array([_END if m is None else _product(np.array(m).reshape(4, 4), behind[:, None])[:, 0] for m in given])


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), _INF)


def _state_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = np.full((batch.num_rows, 4, 4), _INF, np.int64)
        for rows, blocks in _sliced(batch):
            paths = least_paths(*blocks.arcs(blocks.costs(_ends(batch, rows))), _longest(blocks))
            start = (blocks.first[:, None] + np.arange(4)).reshape(-1)
            left = paths.nodes(start)[:, -1] % 4
            out[np.repeat(rows, 4), np.tile(np.arange(4), len(rows)), left] = 0
        yield _with_matrix(batch, out)


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, blocks in _sliced(batch):
            cost = blocks.costs(_ends(batch, rows))
            paths = least_paths(*blocks.arcs(cost), _longest(blocks))
            before = batch.column("before").take(pa.array(rows)).to_pylist()
            start = blocks.first + np.array([0 if m is None else int(np.argmin(m[:4])) for m in before])
            path = paths.nodes(start)
            letter = paths.letter[path]
            block, step = np.nonzero(letter >= 0)
            node, letter = path[block, step], letter[block, step]
            state = paths.jumps[0][node] % 4
            i = (node - blocks.first[block]) // 4
            numbers = batch.column("rows")
            values, offsets = numbers.values.to_numpy(), numbers.offsets.to_numpy()[rows]
            row = values[np.minimum(offsets[block] + i, len(values) - 1)]
            role = np.where(np.isin(letter, (INSERT, REROLE)), np.where(state == 2, _ROLE[2], _ROLE[3]), None)
            edits = pa.StructArray.from_arrays([
                pa.array(np.array(list(LETTERS))[letter], pa.string()), pa.array(row, pa.int64(), mask=letter == INSERT), pa.array(role, pa.string()),
            ], fields=list(_EDIT))
            bounds = np.searchsorted(block, np.arange(len(rows) + 1))
            text = np.array(list(LETTERS))[letter]
            audit = ["".join(text[a:b]) for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays([
                batch.column("c").take(pa.array(rows)), batch.column("block").take(pa.array(rows)), pa.array(cost[start], pa.int64()),
                pa.array(_illegal(batch, rows, blocks), pa.int64()), pa.array(audit, pa.string()), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), edits),
            ], names=["c", "block", "cost", "illegal", "audit", "edits"])


def _illegal(batch: pa.RecordBatch, rows: np.ndarray, blocks: Blocks) -> np.ndarray:
    """Neighbouring rows, the one before the block included, whose initials are not su, ua or au."""
    prior = batch.column("prior").take(pa.array(rows)).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    initial = np.where(blocks.codes < 0, 3, blocks.codes & 3)
    ahead = np.concatenate([[3], initial[:-1]])
    ahead[blocks.bounds[:-1]] = np.where(prior < 0, 9, prior & 3)
    fine = (ahead == 9) | np.isin(ahead * 4 + initial, (1, 6, 9))
    return np.add.reduceat(~fine, blocks.bounds[:-1]) if len(rows) else np.zeros(0, np.int64)


def _scanned(parts: DataFrame, backwards: bool, group: int) -> DataFrame:
    """``c, block, m`` (4 x 4, row by row) -> the (min, +) product of all matrices behind each block of its
    conversation (in front of it, in order, if not ``backwards``): groups of ``group`` blocks, level by level."""
    parts = written(parts, "block-matrices")
    identity = np.where(np.eye(4, dtype=bool), 0, _INF)
    if not parts.agg(F.max("block")).first()[0]:
        return parts.withColumn("m", F.lit(identity.reshape(-1)))
    grouped = parts.groupBy("c", F.expr(f"block div {group}").alias("block")).agg(F.array_sort(F.collect_list(F.struct("block", "m"))).alias("items"))
    grouped = written(grouped, "block-groups")
    key = grouped.schema["c"]

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((batch.num_rows, 4, 4), np.int64)
            for i, items in enumerate(batch.column("items").to_pylist()):
                out[i] = identity
                for item in items:
                    out[i] = _product(out[i], np.array(item["m"]).reshape(4, 4))
            yield _with_matrix(batch, out)

    schema = T.StructType([key, *T._parse_datatype_string("block bigint, m array<bigint>")])
    outer = _scanned(grouped.mapInArrow(total, schema), backwards, group).withColumnRenamed("m", "outer")

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (items, m) in enumerate(zip(batch.column("items").to_pylist(), batch.column("outer").to_pylist())):
                m, done = np.array(m).reshape(4, 4), []
                for item in reversed(items) if backwards else items:
                    done.append((item["block"], m.reshape(-1)))
                    here = np.array(item["m"]).reshape(4, 4)
                    m = _product(here, m) if backwards else _product(m, here)
                yield pa.RecordBatch.from_arrays([
                    pa.concat_arrays([batch.column("c").slice(i, 1)] * len(done)), pa.array([b for b, _ in done], pa.int64()),
                    pa.array([x for _, x in done], pa.list_(pa.int64())),
                ], names=["c", "block", "m"])

    return grouped.join(outer, ["c", "block"]).mapInArrow(within, schema)


def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)


@dataclass
class Repaired:
    """``conversations``: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost``. ``pieces``: ``conv_id, block,
    audit``, the audit of each block in order. ``edits``: ``conv_id, block, step, edit, role, text``, in order of
    (block, step); those other than D are the repaired conversation."""

    conversations: DataFrame
    pieces: DataFrame
    edits: DataFrame


def repair(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    block_rows: int = BLOCK_ROWS, group: int = GROUP,
) -> Repaired:
    """Repair every conversation of ``rows``."""
    if block_rows < 2:
        raise ValueError("block_rows must be at least 2")
    space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    base = rows.select(
        F.monotonically_increasing_id().alias("row"), F.struct(F.col(conv_col).alias("conv_id")).alias("c"), F.col(turn_col).cast("bigint").alias("turn"),
        space(role_col).alias("role"), space(text_col).alias("text"),
    )
    base = written(base, "conversation-rows")
    bare = F.rtrim(F.col("text"), F.lit(WS_CHARS))
    narrow = base.select(
        "row", "c", "turn", "role", F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(1), "role", "text").alias("h2"), _initial(F.col("role")).alias("initial"),
        F.when(bare == "", BLANK).when(~F.substring(bare, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(0).alias("fault"),
    )
    numbered = written(distributed_row_number(narrow, ["c"], ["turn", "role", "h1", "h2", "row"], out="seq").drop("role"), "numbered-rows")
    firsts = numbered.groupBy("c", "h1", "h2").agg(F.min("seq").alias("seq")).select("c", "seq", F.lit(True).alias("is_first"))
    fault = F.when(F.col("fault") == BLANK, BLANK).when(F.col("is_first").isNull(), DUPLICATE).otherwise(F.col("fault"))
    marked = written(numbered.join(firsts, ["c", "seq"], "left").select("c", "seq", "turn", "row", "initial", fault.alias("fault")), "marked-rows")

    # a block also has the row before it and knows whether another follows
    block, i = F.expr(f"(seq - 1) div {block_rows}"), F.expr(f"(seq - 1) % {block_rows}")
    code = (F.col("initial") + 4 * F.col("fault")).cast("int")
    entry = lambda b, k: F.struct(b.alias("block"), k.cast("int").alias("i"), code.alias("code"), F.col("row"))
    places = F.when(i == block_rows - 1, F.array(entry(block, i), entry(block + 1, F.lit(-1))))
    places = places.when((i == 0) & (block > 0), F.array(entry(block, i), entry(block - 1, F.lit(block_rows)))).otherwise(F.array(entry(block, i)))
    items = marked.select("c", F.inline(places)).groupBy("c", "block").agg(F.array_sort(F.collect_list(F.struct("i", "code", "row"))).alias("items"))
    own = F.filter("items", lambda x: (x["i"] >= 0) & (x["i"] < block_rows))
    blocks = items.select(
        "c", "block", F.get(F.filter("items", lambda x: x["i"] < 0), F.lit(0))["code"].alias("prior"), (~F.exists("items", lambda x: x["i"] == block_rows)).alias("last"),
        own["code"].alias("codes"), own["row"].alias("rows"),
    ).filter(F.size("codes") > 0)
    blocks = written(blocks, "conversation-blocks")

    key = blocks.schema["c"]
    matrix = T.StructType([key, *T._parse_datatype_string("block bigint, m array<bigint>")])
    of_long = blocks.filter(F.col("prior").isNotNull() | ~F.col("last"))
    after = _scanned(of_long.select("c", "block", "codes", "last").mapInArrow(_cost_matrices, matrix), True, group).withColumnRenamed("m", "after")
    after = written(after, "costs-after")
    left = of_long.select("c", "block", "codes", "last").join(after, ["c", "block"])
    # nothing follows a last block, whose end costs are those of the conversation
    left = left.withColumn("after", F.when(~F.col("last"), F.col("after")))
    before = written(_scanned(left.mapInArrow(_state_maps, matrix), False, group).withColumnRenamed("m", "before"), "states-before")
    whole = blocks.join(after, ["c", "block"], "left").join(before, ["c", "block"], "left")
    whole = whole.withColumn("after", F.when(~F.col("last"), F.col("after")))
    found = T.StructType([key, *T._parse_datatype_string("block bigint, cost bigint, illegal bigint, audit string, edits array<struct<edit:string,row:bigint,role:string>>")])
    done = written(whole.select("c", "block", "prior", "last", "codes", "rows", "after", "before").mapInArrow(_edits, found), "block-edits")

    count = lambda kind: F.count_if(F.col("fault") == kind).alias({BLANK: "blank", DUPLICATE: "duplicate", TRUNCATED: "truncated"}[kind])
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("bigint").alias("gaps")
    counts = marked.groupBy("c").agg(gaps, count(BLANK), count(DUPLICATE), count(TRUNCATED))
    sums = done.groupBy("c").agg(F.sum("illegal").alias("illegal"), F.max(F.when(F.col("block") == 0, F.col("cost"))).alias("cost"))
    conversations = counts.join(sums, "c").select("c.conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")

    listed = done.select("c", "block", F.posexplode("edits").alias("step", "e")).select("c", "block", "step", "e.*")
    kept = listed.join(base.select("row", F.col("role").alias("own"), "text"), "row", "left")
    edits = kept.select(
        "c.conv_id", "block", "step", "edit", F.coalesce("role", "own").alias("role"), F.when(F.col("edit") == "I", "").otherwise(F.col("text")).alias("text")
    )
    return Repaired(conversations, done.select("c.conv_id", "block", "audit"), edits)
