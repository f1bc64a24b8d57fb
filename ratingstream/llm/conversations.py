"""Conversation structure repair with a suffix-shared automaton.

A conversation becomes a signature: one symbol per row, made of its role's initial and its first
fault. What an edit costs depends only on the signature that follows and on where the grammar
``(s?(ua)+)?`` stands, so equal signatures are one row, and signatures are sorted from their end:
neighbours in that order share a suffix, whose automaton nodes are kept on a stack and computed
once. Nodes whose four grammar states have the same relative costs-to-go and the same order of
best audit suffixes are one node (the automaton is minimal from the end), so every transition is
worked out once. A node keeps, per grammar state, its first edits and where they lead; audits are
read off forwards and never stored per node.

The order of a conversation's rows is a global sort by conversation and turn, so a long conversation
is spread over many tasks; each gives a piece of the signature (a byte a row). Texts move once, to be
hashed in order as a stream: a task holds one row and one audit at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import written

#: Symbols: 16 letters from A on, 4 * role + fault.
ROLES, FAULTS = "sua", ("none", "truncated", "blank", "duplicate")
BLANKS = "\t\n\x0b\x0c\r "
KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED = 5
#: Grammar states: start, after s, after u, after a. ``FOLLOWS``: the state after the one row that may be inserted there.
FOLLOWS = (2, 2, 3, 2)
NAMES = {2: "user", 3: "assistant"}
ACCEPTS = (0, 3)


def keeps(state: int, role: int) -> int | None:
    """The state after keeping a row with this role's number, or None where the grammar has no such row."""
    if role == 0:
        return 1 if state == 0 else None
    return role + 1 if role in (1, 2) and FOLLOWS[state] == role + 1 else None


@dataclass(frozen=True)
class Transition:
    """From a node backwards over one symbol: the node it leads to, and per grammar state the edits and the state after them."""

    node: int
    cost: int  # what all four states cost more than the node's own (relative) costs
    edits: tuple[str, str, str, str]
    after: tuple[int, int, int, int]


class Automaton:
    """Nodes are numbered by (relative costs-to-go, order of best audit suffixes) of the four grammar states."""

    def __init__(self):
        self.nodes: list[tuple[tuple, tuple]] = []
        self.number: dict[tuple, int] = {}
        self.steps: dict[tuple[int, str], Transition] = {}
        ways = []
        for q in range(4):
            k = 0
            s = q
            while s not in ACCEPTS:
                s, k = FOLLOWS[s], k + 1
            ways.append((COST[INSERT] * k, INSERT * k, 0, q))
        self.end = self._node(ways)

    def _node(self, ways: list[tuple[int, str, int, int]]) -> Transition:
        order = sorted({w[1:3] for w in ways})
        least = min(w[0] for w in ways)
        key = (tuple(w[0] - least for w in ways), tuple(order.index(w[1:3]) for w in ways))
        if key not in self.number:
            self.number[key] = len(self.nodes)
            self.nodes.append(key)
        return Transition(self.number[key], least, tuple(w[1] for w in ways), tuple(w[3] for w in ways))

    def step(self, node: int, symbol: str) -> Transition:
        """The node of a symbol and the suffix that ``node`` stands for.

        Two audits that begin with the same edits go on as their nodes' suffixes, whose order is known. Different
        beginnings (inserts, then one edit of the row) differ at some letter, as neither can begin the other.
        """
        found = self.steps.get((node, symbol))
        if found:
            return found
        costs, order = self.nodes[node]
        role, fault = divmod(ord(symbol) - 65, 4)
        own = []
        for q in range(4):
            ways = [(COST[DELETE] + costs[q], DELETE, order[q], q)]
            if fault < 2:
                extra = TRUNCATED * fault
                kept = keeps(q, role)
                if kept is not None:
                    ways.append((COST[KEEP] + extra + costs[kept], KEEP, order[kept], kept))
                s = FOLLOWS[q]
                ways.append((COST[REROLE] + extra + costs[s], REROLE, order[s], s))
            own.append(min(ways))
        ways = []
        for q in range(4):
            once = FOLLOWS[q]
            tries = (q, once, FOLLOWS[once])  # a third insert only repeats the state after the first
            ways.append(min((COST[INSERT] * k + own[s][0], INSERT * k + own[s][1], *own[s][2:]) for k, s in enumerate(tries)))
        found = self.steps[node, symbol] = self._node(ways)
        return found


class Suffixes:
    """The automaton's path for the last signature, from its end; the next one goes on where their suffixes part."""

    def __init__(self):
        self.automaton = Automaton()
        self.text = ""  # the last signature, reversed
        self.path: list[Transition] = []
        self.costs: list[int] = []

    def solve(self, signature: str) -> tuple[int, str]:
        """(cost, audit) of the cheapest edits; ties go to the least audit."""
        back = signature[::-1]
        shared = _common(self.text, back)
        self.text = back
        del self.path[shared:], self.costs[shared:]
        end = self.automaton.end
        for c in back[shared:]:
            t = self.automaton.step(self.path[-1].node if self.path else end.node, c)
            self.costs.append(t.cost + (self.costs[-1] if self.costs else end.cost))
            self.path.append(t)
        q, audit = 0, []
        for t in reversed(self.path):
            audit.append(t.edits[q])
            q = t.after[q]
        audit.append(end.edits[q])
        relative = self.automaton.nodes[self.path[-1].node if self.path else end.node][0][0]
        return (self.costs[-1] if self.costs else end.cost) + relative, "".join(audit)


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    x, y = (np.frombuffer(s[:n].encode("latin-1"), np.uint8) for s in (a, b))
    part = np.flatnonzero(x != y)
    return int(part[0]) if len(part) else n


def counts(signature: str) -> tuple[int, int, int, int]:
    """(blank, duplicate, truncated rows; neighbours whose initials aren't su, ua or au)."""
    v = np.frombuffer(signature.encode("latin-1"), np.uint8) - 65
    fault, role = v & 3, v >> 2
    a, b = role[:-1], role[1:]
    legal = ((a == 0) & (b == 1)) | ((a == 1) & (b == 2)) | ((a == 2) & (b == 1))
    return int((fault == 2).sum()), int((fault == 3).sum()), int((fault == 1).sum()), int((~legal).sum())


def damage(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turn, role, text`` with every row damaged by crc32(``conv_id:turn``) % 20 (nulls read as one blank there).

    0 drops the row, 1 empties its text, 2 removes its full stops, exclamation and question marks, 3 repeats it,
    4 makes its role ``user``. Null roles and texts become one blank.
    """
    c, t, r, x = (F.col(f"`{n}`") for n in (conv_id, turn, role, text))
    blank = F.lit(" ")
    key = F.concat(F.coalesce(c.cast("string"), blank), F.lit(":"), F.coalesce(t.cast("string"), blank))
    kind = F.crc32(key.cast("binary")) % 20
    r, x = F.coalesce(r, blank), F.coalesce(x, blank)
    src = rows.select(c.alias("conv_id"), t.alias("turn"), r.alias("role"), x.alias("text"), kind.alias("kind")).where("kind <> 0")
    return src.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _rows(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    blank = F.lit(" ")
    r, x = F.coalesce(F.col(f"`{role}`"), blank), F.coalesce(F.col(f"`{text}`"), blank)
    digest = F.unhex(F.sha2(x, 256)).alias("digest")
    return rows.select(F.col(f"`{conv_id}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"), r.alias("role"), digest, x.alias("text"))


def _order(first: str = "conv") -> list[Column]:
    return [F.col(first).asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]


def _symbols(rows: DataFrame) -> DataFrame:
    """``conv, turn, role, digest, symbol, again, n``: a row per different row; ``again`` is the symbol of its other n - 1 copies."""
    end = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    fault = F.when(end == "", 2).when(end.isin(".", "!", "?"), 0).otherwise(1)
    initial = F.position(F.substring("role", 1, 1), F.lit(ROLES))  # 1 to 3; 0: another
    kind = F.when((F.col("role") == "") | (initial == 0), 3).otherwise(initial - 1)
    each = rows.select("conv", "turn", "role", "digest", fault.alias("fault"), kind.alias("kind"))
    each = each.groupBy("conv", "turn", "role", "digest", "fault", "kind").agg(F.count(F.lit(1)).alias("n"))
    seen = F.row_number().over(Window.partitionBy("conv", "role", "digest").orderBy(F.col("turn").asc_nulls_first()))
    each = each.withColumn("now", F.when((F.col("fault") != 2) & (seen > 1), 3).otherwise(F.col("fault")))
    symbol = lambda f: F.char(65 + 4 * F.col("kind") + f)
    return each.select("conv", "turn", "role", "digest", symbol(F.col("now")).alias("symbol"), symbol(F.when(F.col("fault") == 2, 2).otherwise(3)).alias("again"), "n")


def _pieces(symbols: DataFrame, most: int = 1 << 20) -> DataFrame:
    """Pieces of signatures, in order of (part, piece), with the first, last and number of different turns in each."""
    kind = symbols.schema["conv"].dataType.simpleString()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, piece = TaskContext.get().partitionId(), 0
        names = ["conv", "part", "piece", "signature", "first", "last", "turns"]
        held: list | None = None  # conversation, symbols, their number, first, last, turns
        for b in it:
            done = []
            kinds = b.schema.field("conv").type
            for conv, turn, symbol, again, n in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in ("conv", "turn", "symbol", "again", "n"))):
                if held is None or held[0] != conv or held[2] >= most:
                    if held:
                        done.append((held[0], part, piece, "".join(held[1]), *held[3:]))
                        piece += 1
                    held = [conv, [], 0, None, None, 0]
                held[1].append(symbol + again * (n - 1))
                held[2] += n
                if turn is not None and turn != held[4]:
                    held[3] = turn if held[3] is None else held[3]
                    held[4] = turn
                    held[5] += 1
            if done:
                yield _batch(done, names, kinds)
        if held:
            yield _batch([(held[0], part, piece, "".join(held[1]), *held[3:])], names, kinds)

    return symbols.orderBy(*_order()).select("conv", "turn", "symbol", "again", "n").mapInArrow(
        run, f"conv {kind}, part int, piece int, signature string, first long, last long, turns long"
    )


def _batch(rows: list[tuple], names: list[str], conv: pa.DataType) -> pa.RecordBatch:
    kinds = [conv, pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def signatures(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """``rows`` (of ``_rows``) → ``conv, signature, gaps``; conversations of ``ids`` (``conv``) without a row have an empty signature."""
    pieces = _pieces(_symbols(rows))
    if ids is not None:
        none = {"part": "int", "piece": "int", "signature": "string", "first": "long", "last": "long", "turns": "long"}
        absent = ids.select("conv").distinct().select("conv", *[F.lit(None).cast(t).alias(c) for c, t in none.items()])
        pieces = pieces.unionByName(absent.withColumn("signature", F.lit("")).withColumn("turns", F.lit(0).cast("long")).withColumn("part", F.lit(-1)))
    one = pieces.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("part", "piece", "signature", "first", "last", "turns"))).alias("p"))
    known = F.filter("p", lambda x: x["first"].isNotNull())
    split = F.zip_with(F.slice("k", 1, F.greatest(F.size("k") - 1, F.lit(0))), F.slice("k", 2, F.greatest(F.size("k") - 1, F.lit(0))), lambda x, y: (x["last"] == y["first"]).cast("long"))
    add = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)
    turns = add(F.transform("p", lambda x: x["turns"])) - add(split)
    wide = lambda c: c.cast("decimal(20,0)")
    span = wide(F.element_at("k", -1)["last"]) - wide(F.element_at("k", 1)["first"]) + 1 - wide(turns)
    return one.withColumn("k", known).select(
        "conv",
        F.array_join(F.transform("p", lambda x: x["signature"]), "").alias("signature"),
        F.when(F.size("k") == 0, F.lit(0)).otherwise(span.try_cast("long")).cast("long").alias("gaps"),
    )


def solve(signatures: DataFrame) -> DataFrame:
    """Distinct ``signature`` rows → their ``cost``, ``audit`` and counts, in order from the end so that suffixes are shared."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suffixes = Suffixes()
        for b in it:
            for i in range(0, b.num_rows, 1000):
                sigs = b.column(0).slice(i, 1000).to_pylist()
                rows = [(s, *suffixes.solve(s), *counts(s)) for s in sigs]
                names = ["signature", "cost", "audit", "blank", "duplicate", "truncated", "illegal"]
                kinds = [pa.string(), pa.int64(), pa.string(), *[pa.int64()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    each = signatures.select("signature").distinct().orderBy(F.reverse("signature"))
    return each.mapInArrow(run, "signature string, cost long, audit string, blank long, duplicate long, truncated long, illegal long")


class Editor:
    """Applies an audit to a conversation's rows as they come; gives the repaired (role, text) rows."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, 0

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == INSERT:
            self.state = FOLLOWS[self.state]
            self.at += 1
            yield NAMES[self.state], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == DELETE:
            return
        if edit == REROLE:
            self.state = FOLLOWS[self.state]
            role = NAMES[self.state]
        else:
            self.state = keeps(self.state, ROLES.index(role[0]))
        yield role, text


def _audited(spark: SparkSession, rows: DataFrame, ids: DataFrame | None) -> DataFrame:
    """``conv, gaps, blank, duplicate, truncated, illegal, cost, audit`` per conversation, written."""
    sigs = written(spark, signatures(rows, ids), "signatures")
    solved = written(spark, solve(sigs), "audits")
    both = sigs.join(solved, "signature")
    return written(spark, both.select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"), "audited")


RESULT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _stream(audited: DataFrame, rows: DataFrame, run, schema: str) -> DataFrame:
    """Every conversation's audit, then its rows in order, through ``run``."""
    heads = audited.select("conv", F.lit(0).alias("tail"), "audit", *RESULT)
    tails = rows.select("conv", F.lit(1).alias("tail"), "turn", "role", "digest", "text")
    both = heads.unionByName(tails, allowMissingColumns=True)
    order = [F.col("conv").asc_nulls_first(), "tail", F.col("turn").asc_nulls_first(), "role", "digest"]
    dealt = both.repartition(F.col("conv")).sortWithinPartitions(*order)
    return dealt.drop("digest", "turn").mapInArrow(run, schema)


def repair(
    spark: SparkSession, rows: DataFrame, ids: DataFrame | None = None, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    Rows are taken by turn (nulls first; ties by role, then the text's SHA-256). Null roles and texts read
    as one blank; a null ``conv_id`` is a conversation of its own. A role that is empty or begins with another
    letter than s, u or a can't be kept. ``gaps``: last turn - first turn + 1 - different turns (0 without turns; null beyond 64
    bits). Conversations of ``ids`` without a row have zeros, an empty audit and the hash of nothing. Repeated
    rows are duplicates of each other. An empty table gives an empty result. One conversation's audit (a byte a
    row) must fit in a task.
    """
    src = _rows(rows, conv_id, turn, role, text)
    if ids is not None:
        ids = ids.select(F.col(f"`{conv_id}`").alias("conv"))
    audited = _audited(spark, src, ids)
    kind = src.schema["conv"].dataType.simpleString()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (conversation, result columns, audit), editor, hash, whether a row was hashed

        def add(pairs: Iterator[tuple[str, str]]) -> None:
            for r, x in pairs:
                held[2].update(b"\n" * held[3] + f"{r}:{x}".encode())
                held[3] = True

        def close() -> tuple:
            add(held[1].inserted())
            return (*held[0], held[2].hexdigest())

        names = ["conv", *RESULT, "audit", "sha"]
        for b in it:
            done = []
            col = {c: b.column(b.schema.get_field_index(c)).to_pylist() for c in ("conv", "tail", "audit", "role", "text", *RESULT)}
            types = [b.schema.field("conv").type, *[pa.int64()] * len(RESULT), pa.string(), pa.string()]
            for i, tail in enumerate(col["tail"]):
                if tail:
                    add(held[1].row(col["role"][i], col["text"][i]))
                    continue
                if held:
                    done.append(close())
                audit = col["audit"][i]
                held = [(col["conv"][i], *(col[c][i] for c in RESULT), audit), Editor(audit), hashlib.sha256(), False]
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(close(), types)], names)

    schema = f"conv {kind}, " + ", ".join(f"{c} long" for c in RESULT) + ", audit string, sha string"
    out = _stream(audited, src, run, schema)
    return out.select(F.col("conv").alias(conv_id), *RESULT, "audit", F.col("sha").alias("repaired_sha256"))


def repaired_rows(
    spark: SparkSession, rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The repaired conversations: ``conv_id, position (from 0), role, text``; inserted rows have an empty text."""
    src = _rows(rows, conv_id, turn, role, text)
    audited = _audited(spark, src, None)
    kind = src.schema["conv"].dataType.simpleString()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, editor, at = None, None, 0
        for b in it:
            out: list[tuple] = []
            col = {c: b.column(b.schema.get_field_index(c)).to_pylist() for c in ("conv", "tail", "audit", "role", "text")}
            types = [b.schema.field("conv").type, pa.int64(), pa.string(), pa.string()]
            for c, tail, audit, r, x in zip(*col.values()):
                got = list(editor.row(r, x) if tail else editor.inserted() if editor else ())
                out += [(conv, at + k, *p) for k, p in enumerate(got)]
                at += len(got)
                if not tail:
                    conv, editor, at = c, Editor(audit), 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), types)], ["conv", "position", "role", "text"])
        rest = list(editor.inserted()) if editor else []
        if rest:
            out = [(conv, at + k, *p) for k, p in enumerate(rest)]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), types)], ["conv", "position", "role", "text"])

    out = _stream(audited, src, run, f"conv {kind}, position long, role string, text string")
    return out.withColumnRenamed("conv", conv_id)
