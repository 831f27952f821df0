"""Conversation structure repair: faults of each turn, and the cheapest edits to a legal order.

A conversation is a sequence of symbols, a turn's role and fault. Reading one is a
min-plus product of small matrices: the cheapest way from each state of the legal order to
each other, with the edits as a rope. Conversations resemble each other, so the symbols are
compressed by pairs (Re-Pair) over all distinct sequences, and each pair's matrix is
multiplied once, from those of its halves.

Of edits of one symbol or sequence, no text begins another: all end with the edit of the last row, and
insertions stand before rows. So texts of equal cost are compared by rank, half by
half, and no text is written out until the way is known. Ranks also let a conversation
longer than a task be cut: its pieces are ranked apart and joined by costs and ranks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starflow.llm.rows import saved

# States of the legal order: nothing yet, after a system turn, a user's, an assistant's.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
# The next state where a user or assistant is put in, and where an initial may stand.
_NEXT = (USER, USER, ASSISTANT, USER)
_KEPT = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
_LEGAL = {"su", "ua", "au"}
_CLASSES = "sua-"  # initials; the last is any other
WHOLE, TRUNCATED, GONE = range(3)
# What edits cost.
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
_NEVER = 1 << 40

# Symbols of a piece; longer conversations are several pieces.
PIECE = 1 << 15
_TERMINALS = len(_CLASSES) * 3
_FIRST_RULE = 0x100


def _terminal(code: int) -> str:
    return chr(ord("a") + code)


# ---------------------------------------------------------------------------
# Matrices. Entry (i, j) has the cheapest edits from state i to state j.


def _end(state: int) -> tuple[int, str]:
    """What has to be inserted after the last row: cost and edits."""
    edits = {NOTHING: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}[state]
    return INSERT * len(edits), edits


def _one_row(initial: str, fault: int) -> list[list[tuple[int, str]]]:
    """Entries of one row, insertions before it included."""
    best = [[(_NEVER, "")] * STATES for _ in range(STATES)]

    def offer(i: int, j: int, cost: int, edits: str) -> None:
        best[i][j] = min(best[i][j], (cost, edits))

    for i in range(STATES):
        state = i
        for put in range(3):
            cost, edits = INSERT * put, "I" * put
            offer(i, state, cost + DELETE, edits + "D")
            if fault != GONE:
                more = cost + (CUT if fault == TRUNCATED else 0)
                offer(i, _NEXT[state], more + REROLE, edits + "R")
                if (state, initial) in _KEPT:
                    offer(i, _KEPT[state, initial], more, edits + "K")
            state = _NEXT[state]
    return best


def _ranks(codes: np.ndarray) -> np.ndarray:
    """How many of a matrix's 16 codes are smaller than each; equal codes share a rank."""
    flat = codes.reshape(len(codes), -1)
    return (flat[:, None, :] < flat[:, :, None]).sum(axis=2).reshape(codes.shape)


def _product(left: tuple, right: tuple) -> tuple[tuple, np.ndarray]:
    """Entries of both matrices in a row: ((costs, ranks), state between the two)."""
    (cost_a, rank_a), (cost_b, rank_b) = left, right
    cost = cost_a[:, :, :, None] + cost_b[:, None, :, :]
    pair = rank_a[:, :, :, None] * 16 + rank_b[:, None, :, :]
    key = np.minimum(cost, _NEVER) * 256 + pair
    mid = key.argmin(axis=2)
    at = mid[:, :, None, :]
    costs = np.minimum(np.take_along_axis(cost, at, 2)[:, :, 0, :], _NEVER)
    pairs = np.take_along_axis(pair, at, 2)[:, :, 0, :]
    pairs[costs == _NEVER] = 256
    return (costs, _ranks(pairs)), mid


class Grammar:
    """Rules, each a pair of symbols, with a matrix and a rope of edits for every symbol."""

    def __init__(self, rules: list[str]) -> None:
        self.rules = rules
        n = _TERMINALS + len(rules) + 1
        self.cost = np.full((n, STATES, STATES), _NEVER, np.int64)
        self.rank = np.zeros((n, STATES, STATES), np.int64)
        self.mid = np.zeros((n, STATES, STATES), np.int64)
        self.texts: dict[tuple[int, int, int], str] = {}
        for code in range(_TERMINALS):
            entries = _one_row(_CLASSES[code // 3], code % 3)
            order = {text: k for k, text in enumerate(sorted({e[1] for row in entries for e in row}))}
            for i, row in enumerate(entries):
                for j, (cost, text) in enumerate(row):
                    self.cost[code, i, j], self.rank[code, i, j] = cost, order[text]
                    self.texts[code, i, j] = text
        self.halves: dict[int, tuple[int, int]] = {}
        for k, pair in enumerate(rules):  # a rule uses only symbols before it
            code = _TERMINALS + k
            a, b = self.halves[code] = tuple(self._codes(pair).tolist())
            (cost, rank), mid = _product(self._of([a]), self._of([b]))
            self.cost[code], self.rank[code], self.mid[code] = cost[0], rank[0], mid[0]
        self.none = n - 1  # stands where a sequence is shorter than its block
        self.cost[self.none][np.diag_indices(STATES)] = 0
        self.texts.update({(self.none, i, j): "" for i in range(STATES) for j in range(STATES)})

    def _of(self, codes) -> tuple[np.ndarray, np.ndarray]:
        return self.cost[codes], self.rank[codes]

    def _codes(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        return np.where(points < _FIRST_RULE, points - ord("a"), points - _FIRST_RULE + _TERMINALS)

    def compress(self, texts: list[str]) -> list[str]:
        joined = "\n".join(texts)
        for k, pair in enumerate(self.rules):
            joined = joined.replace(pair, chr(_FIRST_RULE + k))
        return joined.split("\n") if texts else []

    def text(self, code: int, i: int, j: int) -> str:
        """The edits of an entry: a rope's two halves, joined once a rule."""
        found = self.texts.get((code, i, j))
        if found is None:
            (a, b), mid = self.halves[code], int(self.mid[code, i, j])
            found = self.texts[code, i, j] = self.text(a, i, mid) + self.text(b, mid, j)
        return found

    def blocks(self, texts: list[str]) -> Iterator[tuple[np.ndarray, Block]]:
        """The sequences multiplied out, in blocks of like length, with their places in `texts`."""
        codes = [self._codes(t) for t in self.compress(texts)]
        width = np.array([1 << max(len(c) - 1, 0).bit_length() for c in codes], np.int64)
        for wide in np.unique(width).tolist():
            places = np.flatnonzero(width == wide)
            step = max(1, PIECE // wide)
            for at in range(0, len(places), step):
                part = places[at : at + step]
                table = np.full((len(part), wide), self.none, np.int64)
                for row, place in enumerate(part):
                    table[row, : len(codes[place])] = codes[place]
                yield part, Block(self, table)


class Block:
    """Sequences of one length, multiplied pair by pair like a tree."""

    def __init__(self, grammar: Grammar, table: np.ndarray) -> None:
        self.grammar, self.table, self.mids = grammar, table, []
        n, wide = table.shape
        here = grammar._of(table.ravel())
        while wide > 1:
            left = tuple(x.reshape(n, wide, STATES, STATES)[:, 0::2].reshape(-1, STATES, STATES) for x in here)
            right = tuple(x.reshape(n, wide, STATES, STATES)[:, 1::2].reshape(-1, STATES, STATES) for x in here)
            here, mid = _product(left, right)
            wide //= 2
            self.mids.append(mid.reshape(n, wide, STATES, STATES))
        self.cost, self.rank = here

    def texts(self, enter: np.ndarray, leave: np.ndarray) -> list[str]:
        """The edits of each sequence from the state it is entered in to the one it is left in."""
        enter, leave = enter[:, None], leave[:, None]
        for mids in reversed(self.mids):
            rows, nodes = np.indices(enter.shape)
            between = mids[rows, nodes, enter, leave]
            enter = np.stack([enter, between], 2).reshape(len(enter), -1)
            leave = np.stack([between, leave], 2).reshape(len(leave), -1)
        of = self.grammar.text
        return [
            "".join(map(of, codes, ins, outs))
            for codes, ins, outs in zip(self.table.tolist(), enter.tolist(), leave.tolist())
        ]


# ---------------------------------------------------------------------------
# The grammar: pairs counted by Spark over all distinct sequences.


def _pair_counts(rules: list[str]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar, found = Grammar(rules), Counter()
        for batch in batches:
            text = "\n".join(grammar.compress(batch.column("symbols").to_pylist()))
            points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
            left, right = points[:-1], points[1:]
            # Of a run of one symbol, only every other pair can be replaced.
            starts = np.flatnonzero(np.concatenate(([True], left != right))[: len(left)])
            offset = np.arange(len(left)) - np.repeat(starts, np.diff([*starts, len(left)]))
            fits = (left != 10) & (right != 10) & ((left != right) | (offset % 2 == 0))
            pairs, n = np.unique(left[fits] << 32 | right[fits], return_counts=True)
            found.update(dict(zip(pairs.tolist(), n.tolist())))
        yield pa.record_batch(
            {
                "pair": pa.array([chr(p >> 32) + chr(p & 0xFFFFFFFF) for p in found], pa.string()),
                "n": pa.array(list(found.values()), pa.int64()),
            }
        )

    return count


def learn_rules(sequences: DataFrame, rounds: int = 8, most: int = 24) -> list[str]:
    """Pairs of symbols to replace, in order, from `sequences` (symbols).

    Each round counts all pairs of neighbours in all sequences, combined in the tasks, and takes at most `most` of
    the commonest that share no symbol, so that none spoils another. A pair that occurs once
    is no rule. At most rounds * most short strings come to the driver and go to the tasks, whatever the data's size.
    """
    rules: list[str] = []
    for _ in range(rounds):
        counts = sequences.mapInArrow(_pair_counts(rules), "pair string, n long").groupBy("pair")
        common = counts.agg(F.sum("n").alias("n")).filter("n > 1").orderBy(F.desc("n"), "pair")
        taken: set[str] = set()
        fresh = []
        for row in common.limit(8 * most).collect():
            if len(fresh) < most and taken.isdisjoint(row.pair):
                taken.update(row.pair)
                fresh.append(row.pair)
        if not fresh:
            break
        rules += fresh
    return rules


# ---------------------------------------------------------------------------
# Faults and sequences.

def _turns(turns: DataFrame) -> DataFrame:
    """The columns read, NULL roles and texts as empty, with a digest that stands for the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        text.alias("text"),
        F.unhex(F.md5(text)).alias("digest"),
    )


# Order of a conversation's turns, NULL turns first.
_ORDER = ["conv_id", "turn", "role", "digest"]


def _class(role: Column) -> Column:
    found = F.lit(len(_CLASSES) - 1)
    for k, initial in enumerate(_CLASSES[:-1]):
        found = F.when(role.startswith(initial), k).otherwise(found)
    return found


def faults(turns: DataFrame) -> DataFrame:
    """Distinct turns (conv_id, turn, role, digest, copies, initial, blank, duplicate, truncated).

    Equal rows are counted before they are shuffled. `blank`, `duplicate` and `truncated` say what the first copy's
    first fault is; all others are blank or duplicates. A turn is a duplicate where an earlier one of its
    conversation has its role and text.
    """
    rows = _turns(turns)
    last = F.substring(F.rtrim(F.translate("text", "\t\n\x0b\x0c\r", "     ")), -1, 1)
    counted = (
        rows.select(*_ORDER, (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("open"))
        .groupBy(*_ORDER, "blank", "open")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    counted = saved(counted, "turns")
    at = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    firsts = (
        counted.filter(~F.col("blank"))
        .groupBy("conv_id", "role", "digest")
        .agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select(F.col("conv_id").alias("of_conv"), F.col("role").alias("of_role"), F.col("digest").alias("of_digest"), "first")
    )
    same = (
        F.col("conv_id").eqNullSafe(F.col("of_conv"))
        & (F.col("role") == F.col("of_role"))
        & (F.col("digest") == F.col("of_digest"))
        & ~F.col("blank")
    )
    seen = F.coalesce(at > F.col("first"), F.lit(False))
    return counted.join(firsts, same, "left").select(
        *_ORDER,
        "copies",
        _class(F.col("role")).alias("initial"),
        "blank",
        (~F.col("blank") & seen).alias("duplicate"),
        (~F.col("blank") & ~seen & F.col("open")).alias("truncated"),
    )


def _pieces(conv_type: str):
    """Runs of a conversation's symbols in a sorted partition, cut at PIECE symbols."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, key, symbols, piece, before, part, size = None, None, [], 0, "", 0, 0
        done: list[tuple] = []

        def close() -> None:
            nonlocal symbols, piece, before, size
            if symbols:
                text = "".join(symbols)
                initials = "".join(_CLASSES[(ord(c) - 97) // 3] for c in text)
                pairs = zip(before + initials, (before + initials)[1:])
                done.append((conv, *key, part, piece, text, sum(a + b not in _LEGAL for a, b in pairs), initials[0], initials[-1]))
                before, piece, symbols, size = initials[-1], piece + 1, [], 0

        def taken() -> pa.RecordBatch:
            rows = done.copy()
            done.clear()
            columns = list(zip(*rows)) or [()] * len(schema)
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema)

        schema, begun = None, False
        for batch in batches:
            if schema is None:
                kinds = {f.name: f.type for f in batch.schema}
                schema = pa.schema(
                    [(n, kinds[n]) for n in _ORDER]
                    + [("part", pa.int32()), ("piece", pa.int64()), ("symbols", pa.string())]
                    + [("illegal", pa.int64()), ("opens", pa.string()), ("closes", pa.string())]
                )
            columns = [batch.column(n).to_pylist() for n in (*_ORDER, "copies", "symbol", "part")]
            for own, turn, role, digest, copies, symbol, part_now in zip(*columns):
                if not begun or own != conv:
                    close()
                    conv, piece, before, begun, part = own, 0, "", True, part_now
                again = chr((ord(symbol) - 97) // 3 * 3 + GONE + 97)
                left = copies
                while left:
                    if size >= PIECE:
                        close()
                    if not symbols:
                        key = (turn, role, digest)
                    if left == copies:
                        symbols.append(symbol)
                        left, size = left - 1, size + 1
                    take = min(left, PIECE - size)
                    if take:
                        symbols.append(again * take)
                        left, size = left - take, size + take
            if len(done) >= 256:
                yield taken()
        close()
        if done:
            yield taken()

    return cut


def pieces(faulty: DataFrame) -> DataFrame:
    """Symbol sequences of `faults`' rows, in order: (conv_id, part, piece, symbols, illegal, opens, closes), with the
    place (turn, role, digest) of the first row. A conversation on several partitions, or of more than PIECE rows, is
    several pieces; `part`, then `piece` is their order."""
    fault = F.when(F.col("blank") | F.col("duplicate"), GONE).when(F.col("truncated"), TRUNCATED).otherwise(WHOLE)
    letters = F.lit("".join(map(_terminal, range(_TERMINALS))))
    symbol = F.substring(letters, F.col("initial") * 3 + fault + 1, F.lit(1))
    placed = (
        faulty.select(*_ORDER, "copies", symbol.alias("symbol"))
        .repartitionByRange(*_ORDER)
        .sortWithinPartitions(*_ORDER)
        .withColumn("part", F.spark_partition_id())
    )
    kind = dict(placed.dtypes)["conv_id"]
    return placed.mapInArrow(
        _pieces(kind),
        f"conv_id {kind}, turn long, role string, digest binary, part int, piece long, symbols string,"
        " illegal long, opens string, closes string",
    )


# ---------------------------------------------------------------------------
# The cheapest edits.


def _multiplied(rules: list[str]):
    """Each sequence's matrix; and, if it is a whole conversation, its cost and edits."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(rules)
        ends = np.array([_end(j)[0] for j in range(STATES)])
        for batch in batches:
            texts = batch.column("symbols").to_pylist()
            for at in range(0, len(texts), 2048):
                part = texts[at : at + 2048]
                for places, block in grammar.blocks(part):
                    total = block.cost[:, NOTHING, :] + ends
                    leave = (total * 16 + block.rank[:, NOTHING, :]).argmin(axis=1)
                    edits = block.texts(np.zeros(len(places), np.int64), leave)
                    yield pa.record_batch(
                        {
                            "symbols": pa.array([part[p] for p in places], pa.string()),
                            "costs": pa.array(block.cost.reshape(-1, 16).tolist(), pa.list_(pa.int64())),
                            "ranks": pa.array(block.rank.reshape(-1, 16).tolist(), pa.list_(pa.int64())),
                            "cost": pa.array(total[np.arange(len(places)), leave], pa.int64()),
                            "edits": pa.array([e + _end(j)[1] for e, j in zip(edits, leave)], pa.string()),
                        }
                    )

    return multiply


def route(matrices: list[tuple[list[int], list[int]]]) -> tuple[int, list[int]]:
    """The cost of pieces in a row and the states between them, from their costs and ranks.

    From the last piece to the first: of each state, the cheapest way on, and how the ways' edits rank.
    """
    ways = [(_end(j)[0], _end(j)[1]) for j in range(STATES)]
    cost = [c for c, _ in ways]
    order = [sorted({t for _, t in ways}).index(t) for _, t in ways]
    steps = []
    for costs, ranks in reversed(matrices):
        best = [
            min((costs[i * 4 + j] + cost[j], ranks[i * 4 + j], order[j], j) for j in range(STATES))
            for i in range(STATES)
        ]
        steps.append([b[3] for b in best])
        texts = sorted({b[1:3] for b in best})
        cost, order = [b[0] for b in best], [texts.index(b[1:3]) for b in best]
    states = [NOTHING]
    for step in reversed(steps):
        states.append(step[states[-1]])
    return cost[NOTHING], states


def _routed(conv_type: str):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                own = batch.column("matrices")[row].as_py()
                cost, states = route([(m["costs"], m["ranks"]) for m in own])
                yield pa.record_batch(
                    {
                        "conv_id": pa.array([batch.column("conv_id")[row].as_py()] * len(own), batch.column("conv_id").type),
                        "part": pa.array([m["part"] for m in own], pa.int32()),
                        "piece": pa.array([m["piece"] for m in own], pa.int64()),
                        "enter": pa.array(states[:-1], pa.int32()),
                        "leave": pa.array(states[1:], pa.int32()),
                        "closing": pa.array([""] * (len(own) - 1) + [_end(states[-1])[1]], pa.string()),
                        "cost": pa.array([0] * (len(own) - 1) + [cost], pa.int64()),
                    }
                )

    return find


def _written(rules: list[str], names: list[str]):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(rules)
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                (_, block), *_ = grammar.blocks([one.column("symbols")[0].as_py()])
                enter, leave = (one.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("enter", "leave"))
                edits = block.texts(enter, leave)[0] + one.column("closing")[0].as_py()
                yield pa.record_batch([*[one.column(n) for n in names], pa.array([edits])], [*names, "edits"])

    return write


def _null_safe(left: DataFrame, right: DataFrame, columns: list[str], how: str = "inner") -> DataFrame:
    """A join on columns of which NULLs are equal; `left`'s columns and the others of `right`."""
    renamed = right.withColumnsRenamed({c: f"of_{c}" for c in columns})
    on = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in columns]
    return left.join(renamed, on, how).drop(*[f"of_{c}" for c in columns])


def edits(cut: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, part, piece, cost, edits) of each piece: initials of the edits, and a conversation's cost at one of its pieces.

    Each distinct sequence is multiplied out once for all conversations. Only conversations of several
    pieces need their matrices: 16 costs and ranks a piece.
    """
    distinct = saved(cut.select("symbols").distinct(), "sequences")
    rules = learn_rules(distinct)
    matrices = saved(
        distinct.mapInArrow(
            _multiplied(rules), "symbols string, costs array<long>, ranks array<long>, cost long, edits string"
        ),
        "matrices",
    )
    place = ["conv_id", "turn", "role", "digest", "part", "piece"]
    several = saved(cut.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "several")
    alone = _null_safe(cut, several, ["conv_id"], "left_anti").join(matrices, "symbols").select(*place, "cost", "edits")
    if several.isEmpty():
        return alone
    shared = _null_safe(cut, several, ["conv_id"], "left_semi")
    kind = dict(cut.dtypes)["conv_id"]
    routes = (
        shared.join(matrices, "symbols")
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("part", "piece", "costs", "ranks"))).alias("matrices"))
        .mapInArrow(
            _routed(kind), f"conv_id {kind}, part int, piece long, enter int, leave int, closing string, cost long"
        )
    )
    names = [*place, "cost"]
    kinds = dict(shared.dtypes) | {"cost": "bigint"}
    written = _null_safe(shared, routes, ["conv_id", "part", "piece"]).select(
        *names, "symbols", "enter", "leave", "closing"
    )
    return alone.unionByName(
        written.mapInArrow(_written(rules, names), ", ".join(f"{n} {kinds[n]}" for n in names) + ", edits string")
    )


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Applies the edits to sorted rows; an edit row stands before the first row it is about."""
    roles = {USER: "user", ASSISTANT: "assistant"}
    conv, state, queue, at, begun, out, position = None, NOTHING, "", 0, False, [], 0
    kind = None

    def insert() -> None:
        nonlocal state, at, position
        while at < len(queue) and queue[at] == "I":
            state, at, position = _NEXT[state], at + 1, position + 1
            out.append((conv, position, "I", None, roles[state], ""))

    def taken() -> pa.RecordBatch:
        rows = out.copy()
        out.clear()
        kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
        names = ["conv_id", "position", "edit", "turn", "role", "text"]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    for batch in batches:
        kind, held = batch.column("conv_id").type, 0
        names = ("conv_id", "turn", "role", "text", "edits")
        for own, turn, role, text, edit in zip(*[batch.column(n).to_pylist() for n in names]):
            if not begun or own != conv:
                insert()
                conv, state, queue, at, begun, position = own, NOTHING, "", 0, True, 0
            if edit is not None:
                queue, at = queue[at:] + edit, 0
                continue
            insert()
            letter, at, position = queue[at], at + 1, position + 1
            if letter == "K":
                state = _KEPT[state, role[:1]]
            elif letter == "R":
                state = _NEXT[state]
                role = roles[state]
            out.append((conv, position, letter, turn, role, text))
            held += len(text)
            if held > 1 << 20 or len(out) > 4096:
                yield taken()
                held = 0
        if out:
            yield taken()
    insert()
    if out:
        yield taken()


def repaired(turns: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, position, edit, turn, role, text): every row of `turns` with its edit, and the rows put in.

    `found` is what `edits` gave. Rows of a conversation are in one partition, in order. Texts are shuffled
    once; edits travel as a row before the first they are about, so a task holds one piece's edits and a batch of rows.
    """
    rows = _turns(turns).select(*_ORDER, "text", F.lit(1).alias("kind"), F.lit(0).alias("part"), F.lit(0).cast("long").alias("piece"), F.lit(None).cast("string").alias("edits"))
    ways = found.select(*_ORDER, F.lit(None).cast("string").alias("text"), F.lit(0).alias("kind"), "part", "piece", "edits")
    order = [*_ORDER, "kind", "part", "piece"]
    kind = dict(rows.dtypes)["conv_id"]
    return (
        rows.unionByName(ways)
        .repartition("conv_id")
        .sortWithinPartitions(*order)
        .select("conv_id", "turn", "role", "text", "edits")
        .mapInArrow(_edited, f"conv_id {kind}, position long, edit string, turn long, role string, text string")
    )


def diagnose(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What ails each conversation of `turns` (conv_id, turn, role, text), and the edits that mend it.

    Returns (counts, edits). Counts: (conv_id, gaps, blank, duplicate, truncated, illegal, cost), one row a conversation;
    edits: pieces as `edits` gives them, for `repaired`.

    Turns are in order of `turn`, NULL first; of one turn, by role, then by the text's MD5. NULL roles and texts count as
    empty; NULL conv_ids are one conversation. Repeated rows are duplicates of each other. An empty table gives no rows.
    A conversation may be of any length up to the 2**31 edits that a string holds; no task holds one whole. Other columns are not read.
    """
    faulty = saved(faults(turns), "faults")
    cut = saved(pieces(faulty), "pieces")
    found = saved(edits(cut), "edits")
    spare = F.col("copies") - 1
    counts = (
        faulty.groupBy("conv_id", "turn")
        .agg(
            F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
            F.sum(F.when(F.col("duplicate"), F.col("copies")).when(F.col("blank"), 0).otherwise(spare)).alias("duplicate"),
            F.sum(F.col("truncated").cast("long")).alias("truncated"),
        )
        .groupBy("conv_id")
        .agg(
            F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
            *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        )
    )
    # Where a conversation goes on in the next partition, the pair of rows at the border is still to be judged.
    before = F.lag("closes").over(W.partitionBy("conv_id").orderBy("part", "piece"))
    border = cut.select("conv_id", "illegal", "piece", F.concat(before, "opens").alias("pair"))
    crossing = (F.col("piece") == 0) & F.col("pair").isNotNull() & ~F.col("pair").isin(*_LEGAL)
    illegal = border.groupBy("conv_id").agg(F.sum(F.col("illegal") + crossing.cast("long")).alias("illegal"))
    costs = found.groupBy("conv_id").agg(F.sum("cost").alias("cost"))
    return _null_safe(_null_safe(counts, illegal, ["conv_id"]), costs, ["conv_id"]), found
