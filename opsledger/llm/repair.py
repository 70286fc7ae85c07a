"""Repair the structure of conversations by the cheapest edits: an auction for shortest paths.

The rows of a conversation, in order of turn, and the four states of the wanted order of roles
(nothing yet, after system, after user, after assistant) span a lattice. Its arcs keep a row,
change its role, delete it or insert an empty one; a path from the start to the end is a repair.

1. Nodes have prices, from 0 up. A path grows from the entry along the arc with the least cost
   plus price. Where its last node's price is below that, the price rises to it and the path
   shrinks by the node. When the path reaches the end, the price of the entry is its distance.
2. Prices never exceed distances, so every arc of every cheapest path is tight: its cost is the
   difference of the prices. Of the tight arcs from which tight arcs lead to the end, the path with
   the least letters (D, I, K, R) is traced; each letter leads to one node only.
3. Costs are integers, and the auction runs in blocks of ``BLOCK`` rows, last block first: the prices of
   a block's entries are what leaving the block before it costs. So the work grows with the rows.
4. Conversations of more than ``LONG_ROWS`` rows or ``LONG_BYTES`` of text are cut into chunks that are
   priced apart: a table from entry to exit state each, composed along the conversation
   with one small row per chunk. Each chunk is then traced for all four entries, and the pieces
   that fit are taken. Only the checksum and the repaired text pass through one task, as a stream.

Nulls in role and text are one space; a null ``conv_id`` is a conversation of its own. Rows of one turn,
null turns first, are ordered by a hash of role and text, so repeated rows are adjacent. Blank and
repeated rows must go. Empty roles and those with another initial than s, u, a fit nowhere. A
conversation whose rows have all gone has zeros and empty texts. An empty table gives no
rows; other columns are ignored.
"""

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsledger.functions.joins import lookup_join
from opsledger.functions.workspace import stored
from opsledger.llm.mixing import source_key, with_positions

REROLE = 3
DELETE = 4
INSERT = 3
TRUNCATED = 3
BLOCK = 16
CHUNK = 4096
LONG_ROWS = 4096
LONG_BYTES = 1 << 26
_CACHED = 1 << 16
_CACHED_ROWS = 64
_SPACE = " \t\n\x0b\x0c\r"
_STATES = range(4)
_INF = float("inf")

#: state after a role with this initial; 0: nothing yet, 1: system, 2: user, 3: assistant
_AFTER = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_MISSING = (("user", 2), ("user", 2), ("assistant", 3), ("user", 2))
_LEGAL = {"su", "ua", "au"}


def _arcs_of(symbol: str) -> list[list[tuple[str, int, int, int]]]:
    """For each state the arcs (letter, next state, cost, rows used up) of a row.

    A row is the initial of its role, upper case if it is truncated; ``o`` is any other role, ``x`` a row
    that must go, and ``$`` the end, which only complete orders pass.
    """
    out = []
    for state in _STATES:
        filled = _MISSING[state][1]
        arcs = [("I", filled, INSERT, 0)]
        if symbol == "$":
            arcs += [("", state, 0, 1)] if state in (0, 3) else []
        else:
            arcs.append(("D", state, DELETE, 1))
        if symbol not in "x$":
            extra = TRUNCATED if symbol.isupper() else 0
            if (after := _AFTER[state].get(symbol.lower())) is not None:
                arcs.append(("K", after, extra, 1))
            arcs.append(("R", filled, REROLE + extra, 1))
        out.append(sorted(arcs))
    return out


_ARCS = {symbol: _arcs_of(symbol) for symbol in "uasoUASOx$"}


class Lattice:
    """A block of rows; ``exits`` is what each state still costs after them."""

    def __init__(self, signature: str, exits: list[float]):
        self.rows = len(signature)
        self.end = 4 * (self.rows + 1)
        self.price = [0] * (self.end + 1)
        open_ = [[e < _INF for e in exits]]
        for symbol in reversed(signature):
            ahead = open_[-1]
            now = [any(ahead[to] for _, to, _, step in arcs if step) for arcs in _ARCS[symbol]]
            for _ in range(2):  # at most two inserts lead on
                now = [ok or now[_MISSING[s][1]] for s, ok in enumerate(now)]
            open_.append(now)
        open_.reverse()
        #: (cost, node, letter) in order of letters, to nodes from which the end can be reached
        self.arcs = [
            [(cost, 4 * (i + step) + to, letter) for letter, to, cost, step in arcs if open_[i + step][to]]
            for i, symbol in enumerate(signature)
            for arcs in _ARCS[symbol]
        ] + [[(e, self.end, "")] if e < _INF else [] for e in exits]

    def distance(self, entry: int) -> float:
        """Price of an entry, by path extension and contraction until the path reaches the end."""
        price, arcs, end = self.price, self.arcs, self.end
        if not arcs[entry]:
            return _INF
        path = [entry]
        while path[-1] != end:
            node = path[-1]
            least, target = _INF, end
            for cost, to, _ in arcs[node]:
                if cost + price[to] < least:
                    least, target = cost + price[to], to
            if price[node] < least:
                price[node] = least
                if len(path) > 1:
                    path.pop()
            else:
                path.append(target)
        return price[entry]

    def tight(self) -> list[list[tuple[int, str]]]:
        """For each node its tight arcs (node, letter) that lead to the end over tight arcs."""
        price = self.price
        leads = [False] * self.end + [True]
        out = [[(to, letter) for cost, to, letter in arcs if cost + price[to] == price[node]]
               for node, arcs in enumerate(self.arcs)]
        for row in range(self.rows, -1, -1):
            for _ in range(3):  # inserts lead on within a row
                for node in range(4 * row, 4 * row + 4):
                    leads[node] = any(leads[to] for to, _ in out[node])
        return [[arc for arc in arcs if leads[arc[0]]] for arcs in out]

    def trace(self, entries: list[int]) -> dict[int, tuple[str, int]]:
        """For each entry the least letters of a cheapest path, and the state it leaves in."""
        tight, found = self.tight(), {}
        for entry in entries:
            node, letters = entry, []
            while node < self.end - 4:
                node, letter = tight[node][0]
                letters.append(letter)
            found[entry] = "".join(letters), node - (self.end - 4)
        return found


def _blocks(signature: str, exits: list[float], entries: list[int]) -> tuple[list[float], list[Lattice]]:
    """Costs of entering in each state, and the blocks in order."""
    starts = range(0, len(signature), BLOCK)
    found = []
    for at in reversed(starts):
        base = min(exits)  # prices start from 0, so only differences have to be climbed
        lattice = Lattice(signature[at : at + BLOCK], [e - base for e in exits])
        wanted = entries if at == 0 else _STATES
        exits = [base + lattice.distance(s) if s in wanted else _INF for s in _STATES]
        found.append(lattice)
    return exits, found[::-1]


def solve(signature: str) -> tuple[int, str]:
    """Least cost of a whole conversation, and its edits."""
    costs, blocks = _blocks(signature + "$", [0] * 4, [0])
    state, letters = 0, []
    for lattice in blocks:
        piece, state = lattice.trace([state])[state]
        letters.append(piece)
    return costs[0], "".join(letters)


@lru_cache(maxsize=_CACHED)
def _solve_often(signature: str) -> tuple[int, str]:
    return solve(signature)


def passage(signature: str) -> list[list[float]]:
    """Costs of a chunk from each entry state to each exit state."""
    each = [[0 if x == s else _INF for x in _STATES] for s in _STATES]
    columns = [_blocks(signature, exits, list(_STATES))[0] for exits in each]
    return [[columns[x][s] for x in _STATES] for s in _STATES]


def pieces(signature: str, exits: list[float]) -> list[tuple[str, int] | None]:
    """For each entry state the edits of a chunk and the state after it; None if none lead on."""
    costs, blocks = _blocks(signature, exits, list(_STATES))
    traced = [b.trace([s for s in _STATES if b.arcs[s]]) for b in blocks]
    out = []
    for state in _STATES:
        if costs[state] == _INF:
            out.append(None)
            continue
        letters = []
        for found in traced:
            piece, state = found[state]
            letters.append(piece)
        out.append(("".join(letters), state))
    return out


def symbol(role: str, fault: str) -> str:
    """A row of the lattice, see ``_arcs_of``."""
    if fault in "bd":
        return "x"
    initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return initial.upper() if fault == "t" else initial


class Record:
    """What is known of a conversation while its rows pass in order."""

    def __init__(self, conv, texts: bool):
        self.conv, self.edits, self.at, self.state = conv, "", 0, 0
        self.low = self.high = self.before = None
        self.distinct = self.illegal = 0
        self.faults = dict.fromkeys("bdt.", 0)
        self.sha, self.audit, self.first = hashlib.sha256(), [], True
        self.repaired = [] if texts else None

    def plan(self, edits: str) -> None:
        """The edits of the rows to come, after those of the rows before."""
        self.insert()
        self.edits, self.at = edits, 0
        self.audit.append(edits)

    def insert(self) -> None:
        while self.at < len(self.edits) and self.edits[self.at] == "I":
            self.at += 1
            self._put(None, "")

    def take(self, turn, role: str, text: str, fault: str) -> None:
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.distinct += turn != self.high
            self.high = turn
        if self.before is not None:
            self.illegal += self.before + role[:1] not in _LEGAL
        self.before = role[:1]
        self.faults[fault] += 1
        self.insert()
        letter = self.edits[self.at]
        self.at += 1
        if letter != "D":
            self._put(role if letter == "K" else None, text)

    def _put(self, role: str | None, text: str) -> None:
        if role is None:
            role, self.state = _MISSING[self.state]
        else:
            self.state = _AFTER[self.state][role[0]]
        line = f"{role}:{text}" if self.first else f"\n{role}:{text}"
        self.sha.update(line.encode("utf-8", "surrogatepass"))
        self.first = False
        if self.repaired is not None:
            self.repaired.append({"role": role, "text": text})

    def row(self, cost: int) -> tuple:
        self.insert()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        found = (self.conv, gaps, *(self.faults[f] for f in "bdt"), self.illegal, cost)
        end = ("".join(self.audit), self.sha.hexdigest())
        return found + end + (() if self.repaired is None else (self.repaired,))


_NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _schema(kind: str, texts: bool) -> str:
    counts = ", ".join(f"{name} long" for name in _NAMES[1:7])
    lines = ", repaired array<struct<role:string,text:string>>" if texts else ""
    return f"conv_id {kind}, {counts}, audit string, repaired_sha256 string{lines}"


def _table(rows: list[tuple], kind: pa.DataType, texts: bool) -> pa.RecordBatch:
    types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
    line = pa.struct([("role", pa.string()), ("text", pa.string())])
    names = _NAMES + ["repaired"] * texts
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types + [pa.list_(line)] * texts)], names)


def _lines(batches, names: list[str]):
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            yield from zip(*(part.column(name).to_pylist() for name in names))


def _emitted(rows, kind: pa.DataType, texts: bool):
    """Batches of finished rows, cut by the length of their texts too."""
    ready, size = [], 0
    for row in rows:
        ready.append(row)
        size += 200 + len(row[7]) + (sum(len(r["text"]) for r in row[9]) if texts else 0)
        if size > 1 << 22:
            yield _table(ready, kind, texts)
            ready, size = [], 0
    if ready:
        yield _table(ready, kind, texts)


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after the given damage, by checksum of ``conv_id:turn``; ``gone`` marks the dropped."""
    blank = F.lit(" ")
    conv, turn = (F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn"))
    mark = F.crc32(F.concat(conv, F.lit(":"), turn)) % 20
    text = F.coalesce("text", blank)
    return conversations.select(
        "conv_id",
        "turn",
        F.when(mark == 4, "user").otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(mark == 1, "").when(mark == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (mark == 0).alias("gone"),
        F.explode(F.sequence(F.lit(1), F.when(mark == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def _prepared(rows: DataFrame) -> DataFrame:
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    bare = F.rtrim(text, F.lit(_SPACE))
    fault = F.when(bare == "", "b").when(F.right(bare, F.lit(1)).isin(".", "!", "?"), ".").otherwise("t")
    gone = F.coalesce("gone", F.lit(False)) if "gone" in rows.columns else F.lit(False)
    return rows.select(
        source_key(F.col("conv_id").cast("string")).alias("group"),
        "conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
        fault.alias("fault"), F.xxhash64(role, text).alias("tie"), gone.alias("gone"),
    )


def _turn() -> Column:
    return F.col("turn").asc_nulls_first()


def _whole(rows: DataFrame, texts: bool) -> DataFrame:
    """Conversations that fit in a task's memory, one after the other."""
    names = ["group", "conv_id", "turn", "role", "text", "fault", "gone"]

    def solved(batches):
        group, held = None, []
        for line in _lines(batches, names):
            if line[0] != group:
                if held:
                    yield finish(held)
                group, held = line[0], []
            held.append(line)
        if held:
            yield finish(held)

    def finish(held):
        record, seen, faults = Record(held[0][1], texts), set(), []
        live = [line[2:6] for line in held if not line[6]]
        for _, role, text, fault in live:
            faults.append("d" if fault != "b" and (role, text) in seen else fault)
            seen.add((role, text))
        signature = "".join(symbol(line[1], f) for line, f in zip(live, faults))
        cost, edits = _solve_often(signature) if len(signature) <= _CACHED_ROWS else solve(signature)
        record.plan(edits)
        for (turn, role, text, _), fault in zip(live, faults):
            record.take(turn, role, text, fault)
        return record.row(cost)

    def run(batches):
        first = next(batches, None)
        if first is not None:
            kind = first.schema.field("conv_id").type
            yield from _emitted(solved(_chain(first, batches)), kind, texts)

    ordered = rows.select(*names, "tie").repartition("group").sortWithinPartitions("group", _turn(), "tie")
    return ordered.mapInArrow(run, _schema(rows.schema["conv_id"].dataType.simpleString(), texts))


def _chain(first, rest):
    yield first
    yield from rest


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows of long conversations with their place, and with repeated ones marked."""
    order = [F.col("group").asc(), _turn(), F.col("tie").asc(), F.col("id").asc()]
    rows = rows.drop("gone").withColumn("id", F.monotonically_increasing_id())
    placed = with_positions(rows, "group", order, "repair-rows").drop("id", "tie")
    placed = placed.withColumn("same", F.md5(F.concat(F.length("role"), F.lit(":"), "role", "text")))
    often = placed.groupBy("group", "same").agg(F.min("__pos").alias("first"), F.count("*").alias("n")).filter("n > 1")
    marked = lookup_join(placed, often.drop("n"), ["group", "same"], "left")
    late = (F.col("fault") != "b") & F.coalesce(F.col("__pos") > F.col("first"), F.lit(False))
    return stored(
        marked.withColumn("fault", F.when(late, "d").otherwise(F.col("fault"))).drop("same", "first"), "repair-marked"
    )


def _chunks(rows: DataFrame) -> DataFrame:
    """One row per chunk with its signature; the end is a chunk of its own."""
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    sign = F.when(F.col("fault").isin("b", "d"), "x").when(F.col("fault") == "t", F.upper(known)).otherwise(known)
    chunk = F.floor(F.col("__pos") / CHUNK).alias("chunk")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__pos", sign.alias("sign")))), lambda x: x["sign"]), "")
    parts = rows.groupBy("group", chunk).agg(joined.alias("signature"))
    ends = rows.groupBy("group").agg((F.floor(F.max("__pos") / CHUNK) + 1).alias("chunk"), F.lit("$").alias("signature"))
    return stored(parts.unionByName(ends), "repair-chunks")


def _exits(chunks: DataFrame) -> DataFrame:
    """For each chunk what each state costs after it, and before it."""

    def price(batches):
        for batch in batches:
            costs = [sum(passage(s), []) for s in batch.column("signature").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("group"), batch.column("chunk"), pa.array(costs, pa.list_(pa.float64()))],
                ["group", "chunk", "costs"],
            )

    def compose(table: pa.Table) -> pa.Table:  # one small row per chunk of a conversation
        table = table.sort_by([("chunk", "descending")])
        after, exits, entries = [0.0] * 4, [], []
        for costs in table.column("costs").to_pylist():
            exits.append(after)
            after = [min(costs[4 * s + x] + after[x] for x in _STATES) for s in _STATES]
            entries.append(after)
        kind = pa.list_(pa.float64())
        return pa.table(
            [table.column("group"), table.column("chunk"), pa.array(exits, kind), pa.array(entries, kind)],
            ["group", "chunk", "exits", "entries"],
        )

    priced = stored(chunks.mapInArrow(price, "group string, chunk long, costs array<double>"), "repair-costs")
    return priced.groupBy("group").applyInArrow(
        compose, "group string, chunk long, exits array<double>, entries array<double>"
    )


def _edits(chunks: DataFrame, exits: DataFrame) -> DataFrame:
    """The edits of each chunk."""

    def trace(batches):
        for batch in batches:
            found = [
                pieces(s, e) for s, e in zip(batch.column("signature").to_pylist(), batch.column("exits").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("group"), batch.column("chunk"),
                 pa.array([[p and p[0] for p in f] for f in found], pa.list_(pa.string())),
                 pa.array([[p and p[1] for p in f] for f in found], pa.list_(pa.int32()))],
                ["group", "chunk", "letters", "states"],
            )

    def enter(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        state, entries = 0, []
        for states in table.column("states").to_pylist():
            entries.append(state)
            state = states[state]
        return pa.table([table.column("group"), table.column("chunk"), pa.array(entries, pa.int32())], ["group", "chunk", "entry"])

    joined = chunks.join(exits.select("group", "chunk", "exits"), ["group", "chunk"])
    traced = stored(
        joined.mapInArrow(trace, "group string, chunk long, letters array<string>, states array<int>"), "repair-pieces"
    )
    entered = (
        traced.select("group", "chunk", "states").groupBy("group").applyInArrow(enter, "group string, chunk long, entry int")
    )
    return traced.join(entered, ["group", "chunk"]).select("group", "chunk", F.get("letters", F.col("entry")).alias("edits"))


def _split(rows: DataFrame, texts: bool) -> DataFrame:
    """Conversations beyond the bounds of a task."""
    numbered = _numbered(rows)
    chunks = _chunks(numbered)
    exits = stored(_exits(chunks), "repair-exits")
    costs = exits.filter("chunk = 0").select("group", F.col("entries")[0].cast("long").alias("cost"))
    plans = _edits(chunks, exits).join(costs, "group")
    names = ["group", "conv_id", "turn", "role", "text", "fault", "edits", "cost"]
    nothing = {f.name: F.lit(None).cast(f.dataType) for f in numbered.schema}
    lines = numbered.select(
        *names[:6], F.lit(None).cast("string").alias("edits"), F.lit(None).cast("long").alias("cost"),
        "__pos", F.lit(1).alias("kind"),
    ).unionByName(plans.select(
        "group", *(nothing[n].alias(n) for n in names[1:6]), "edits", "cost",
        (F.col("chunk") * CHUNK).alias("__pos"), F.lit(0).alias("kind"),
    ))

    def streamed(batches):
        group = record = cost = None
        for line in _lines(batches, names):
            if line[0] != group:
                if record is not None:
                    yield record.row(cost)
                group, record, cost = line[0], Record(None, texts), line[7]
            if line[6] is not None:
                record.plan(line[6])
            else:
                record.conv = line[1]
                record.take(*line[2:6])
        if record is not None:
            yield record.row(cost)

    def run(batches):
        first = next(batches, None)
        if first is not None:
            kind = first.schema.field("conv_id").type
            yield from _emitted(streamed(_chain(first, batches)), kind, texts)

    ordered = lines.repartition("group").sortWithinPartitions("group", "__pos", "kind")
    return ordered.mapInArrow(run, _schema(rows.schema["conv_id"].dataType.simpleString(), texts))


def repair(
    conversations: DataFrame, texts: bool = True, long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES
) -> DataFrame:
    """One row per conversation: counts of faults, least ``cost``, ``audit`` and checksum.

    ``conversations`` has ``conv_id``, ``turn``, ``role``, ``text`` and perhaps ``gone``, for rows that only say that
    their conversation exists. With ``texts`` the repaired rows come too, as the array ``repaired``;
    a conversation must then fit in a row. The bounds decide where the work is done, not the result.
    """
    rows = _prepared(conversations)
    live, gone = rows.filter("NOT gone"), rows.filter("gone")
    sizes = live.groupBy("group").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b"))
    long = stored(sizes.filter((F.col("n") > long_rows) | (F.col("b") > long_bytes)).select("group"), "repair-long")
    empty = gone.groupBy("group", "conv_id").agg(F.lit(True).alias("gone"))
    others = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema}
    for name in ("group", "conv_id", "gone"):
        others[name] = F.col(name)
    short = live.unionByName(empty.select(*others.values()))
    if long.isEmpty():
        return _whole(short, texts)
    whole = _whole(lookup_join(short, long, ["group"], "left_anti"), texts)
    return whole.unionByName(_split(lookup_join(live, long, ["group"], "left_semi"), texts))


def digests(conversations: DataFrame) -> DataFrame:
    """The repair of the damaged conversations, without their texts."""
    return repair(damaged(conversations), texts=False)
