"""Repair of the turn structure of conversations, by weighted interval parsing.

A repaired conversation reads ``(s?(ua)+)?`` in role initials. Each row is kept, given another role
or deleted, and rows without text may be inserted. The grammar in Chomsky normal form has one
nonterminal per kind of factor of that language: the empty one, and one for each pair of first and
last initials (``ua`` derives ``ua``, ``uaua``, ...); every rule joins two neighbouring factors. A
cell of the chart holds, for a span of rows, the cheapest ``(cost, audit)`` of each nonterminal, and
is closed under insertion on either side.

Any factor can be cut anywhere into two factors, so one split per span finds what all splits find.
Spans are therefore joined in pairs, bottom-up by span length: a conversation of n rows has 2n cells
and not n^2, and parts of a conversation that lie in different tasks join as any two spans do.

Equal costs are told apart by the audit, and that choice is safe inside a longer span: two audits
of one span and one cost cannot be prefixes of each other, as the longer one would hold all edits
of the shorter and paid insertions besides.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tarmaq.llm.common import WORD, stored, table

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
FOLLOWS = frozenset({"su", "ua", "au"})
ROLES = {"u": "user", "a": "assistant"}
_MUST_GO = ("blank", "duplicate")
#: So many products of short spans are remembered.
_REMEMBERED = 1 << 13

#: A nonterminal is the first and last initial of what it derives; "" derives nothing.
Cell = dict[str, tuple[int, str]]


def _put(cell: Cell, kind: str, cost: int, audit: str) -> bool:
    if kind in cell and cell[kind] <= (cost, audit):
        return False
    cell[kind] = cost, audit
    return True


def _joined(left: str, right: str) -> str | None:
    """The nonterminal of two neighbouring factors, or None where they may not meet."""
    if not left or not right:
        return left or right
    return left[0] + right[-1] if left[-1] + right[0] in FOLLOWS else None


def _closed(cell: Cell) -> Cell:
    """The cell with all that insertions on either side add to it."""
    todo = list(cell)
    while todo:
        kind = todo.pop()
        cost, audit = cell[kind]
        for role in ROLES:
            for new, told in ((_joined(role + role, kind), "I" + audit),
                              (_joined(kind, role + role), audit + "I")):
                if new is not None and _put(cell, new, cost + INSERT, told):
                    todo.append(new)
    return cell


NOTHING = _closed({"": (0, "")})


@lru_cache(_REMEMBERED)
def leaf(initial: str, fault: str) -> tuple:
    """The cell of one row, as the items of a dict."""
    cell: Cell = {"": (DELETE, "D")}
    if fault not in _MUST_GO:
        extra = TRUNCATED if fault == "truncated" else 0
        for role in ROLES:
            _put(cell, role + role, REROLE + extra, "R")
        if initial in ("s", "u", "a"):
            _put(cell, initial + initial, KEEP + extra, "K")
    return tuple(_closed(cell).items())


def _product(left: tuple, right: tuple) -> tuple:
    cell: Cell = {}
    for kind, (cost, audit) in left:
        for other, (more, told) in right:
            new = _joined(kind, other)
            if new is not None:
                _put(cell, new, cost + more, audit + told)
    return tuple(_closed(cell).items())


_short_product = lru_cache(_REMEMBERED)(_product)


def join_cells(left: tuple, right: tuple) -> tuple:
    """The cell of two neighbouring spans. Short spans recur in a corpus and are remembered."""
    short = len(left[0][1][1]) + len(right[0][1][1]) <= 16
    return _short_product(left, right) if short else _product(left, right)


class Chart:
    """Cells of growing spans, joined in pairs of equal length like the digits of a counter."""

    def __init__(self):
        self.spans: list[tuple[int, tuple]] = []

    def add(self, cell: tuple) -> None:
        size = 1
        while self.spans and self.spans[-1][0] == size:
            cell = join_cells(self.spans.pop()[1], cell)
            size *= 2
        self.spans.append((size, cell))

    def cell(self) -> tuple:
        """The cell of all rows so far."""
        if not self.spans:
            return tuple(NOTHING.items())
        spans = [cell for _, cell in self.spans]
        whole = spans.pop()
        while spans:
            whole = join_cells(spans.pop(), whole)
        return whole


def cheapest(cell: tuple) -> tuple[int, str]:
    """Cost and audit of the best whole conversation: nothing, or up to an assistant's turn from
    the system's or a user's."""
    return min(found for kind, found in cell if kind in ("", "ua", "sa"))


def role_initial(role: str) -> str:
    return role[:1]


class Summary:
    """What is known of a run of rows of one conversation: faults, borders and its cell."""

    schema = ("part int, rows bigint, first_initial string, last_initial string, "
              "first_turn bigint, last_turn bigint, turns bigint, blank bigint, "
              "duplicate bigint, truncated bigint, illegal bigint, kinds array<string>, "
              "costs array<bigint>, audits array<string>")

    def __init__(self, part: int):
        self.values = {"part": part, "rows": 0, "first_initial": None, "last_initial": None,
                       "first_turn": None, "last_turn": None, "turns": 0, "blank": 0,
                       "duplicate": 0, "truncated": 0, "illegal": 0}
        self.chart = Chart()

    def _meets(self, initial: str, turn: int | None) -> None:
        v = self.values
        if v["rows"]:
            v["illegal"] += v["last_initial"] + initial not in FOLLOWS
        else:
            v["first_initial"] = initial
        if turn is not None and turn != v["last_turn"]:
            v["turns"] += 1
            if v["first_turn"] is None:
                v["first_turn"] = turn

    def add(self, initial: str, turn: int | None, fault: str, copies: int) -> None:
        """The next row, and its copies: these are duplicates, or as blank as it is."""
        v = self.values
        self._meets(initial, turn)
        v["illegal"] += (copies - 1) * (initial + initial not in FOLLOWS)
        v["last_initial"] = initial
        v["last_turn"] = v["last_turn"] if turn is None else turn
        v["rows"] += copies
        again = fault if fault == "blank" else "duplicate"
        if fault:
            v[fault] += 1
        v[again] += copies - 1
        self.chart.add(leaf(initial, fault))
        for _ in range(copies - 1):
            self.chart.add(leaf(initial, again))

    def row(self) -> dict:
        cell = self.chart.cell()
        return self.values | {"kinds": [k for k, _ in cell], "costs": [c for _, (c, _) in cell],
                              "audits": [a for _, (_, a) in cell]}


def join_summaries(left: dict, right: dict) -> dict:
    """The summary of two runs of rows, one after the other."""
    out = dict(left)
    for name in ("rows", "turns", "blank", "duplicate", "truncated", "illegal"):
        out[name] = left[name] + right[name]
    out["illegal"] += left["last_initial"] + right["first_initial"] not in FOLLOWS
    out["last_initial"] = right["last_initial"]
    if left["last_turn"] is None:
        out["first_turn"] = right["first_turn"]
    elif left["last_turn"] == right["first_turn"]:
        out["turns"] -= 1
    if right["last_turn"] is not None:
        out["last_turn"] = right["last_turn"]
    cells = [tuple(zip(s["kinds"], zip(s["costs"], s["audits"], strict=True), strict=True))
             for s in (left, right)]
    cell = join_cells(*cells)
    return out | {"kinds": [k for k, _ in cell], "costs": [c for _, (c, _) in cell],
                  "audits": [a for _, (_, a) in cell]}


def faulty(rows: DataFrame) -> DataFrame:
    """Different rows with ``copies`` and their ``fault``: blank, duplicate, truncated or "".

    Rows that are equal in conversation, turn, role and text are one with a number of copies. A
    row repeats another if that has its role and text and comes earlier; null turns come first.
    """
    folded = rows.groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("copies"))
    keyed = stored(folded.withColumn("digest", F.sha2(F.concat_ws("\n", "role", "text"), 256)),
                   "turns")
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = stored(keyed.groupBy("conv", "digest").agg(
        F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").select(
        F.col("conv").alias("same_conv"), F.col("digest").alias("same_digest"), "first"), "first")
    known = keyed.join(first, keyed["conv"].eqNullSafe(first["same_conv"])
                       & (keyed["digest"] == first["same_digest"]), "left")
    last = F.substring(F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    return known.select(
        "conv", "turn", "role", "text", "copies",
        F.when(~F.col("text").rlike(WORD), "blank")
        .when(place > F.col("first"), "duplicate")
        .when(~last.isin(".", "!", "?"), "truncated").otherwise("").alias("fault"))


def repair_conversations(conversations: DataFrame, id_column: str = "conv_id",
                         turn_column: str = "turn", role_column: str = "role",
                         text_column: str = "text", initial=role_initial) -> DataFrame:
    """One row per conversation: its faults, the cheapest repair, and a digest of the result.

    Rows are taken by turn, null turns first, rows of one turn by role and text; a null role or
    text is one space, repeated rows repeat each other. A conversation's rows are sorted by range,
    so that a very long one is parsed in parts by many tasks, and the parts are joined. The digest
    of a repaired conversation has to read its texts in order, so there its rows stream through one
    task, which holds one audit and no texts. A null conversation is one of its own. An empty table
    gives an empty result; other columns are ignored.

    ``conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.
    """
    spaced = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")).alias(n)
              for c, n in ((role_column, "role"), (text_column, "text"))]
    rows = conversations.select(F.col(f"`{id_column}`").alias("conv"),
                                F.col(f"`{turn_column}`").cast("bigint").alias("turn"), *spaced)
    rows = stored(faulty(rows), "faults")
    kind = rows.schema["conv"].dataType.simpleString()
    order = ["conv", "turn", "role", "text"]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv", "turn", "role", "fault", "copies", F.spark_partition_id().alias("part"))
    columns = ("conv", "turn", "role", "fault", "copies", "part")
    fields = f"conv {kind}, {Summary.schema}"
    arrow = to_arrow_schema(StructType.fromDDL(fields))

    def summaries(batches):
        conv, summary, done = None, None, []
        for batch in batches:
            for now, turn, role, fault, copies, part in zip(
                    *(batch[c].to_pylist() for c in columns), strict=True):
                if summary is None or now != conv:
                    if summary is not None:
                        done.append({"conv": conv} | summary.row())
                    conv, summary = now, Summary(part)
                summary.add(initial(role), turn, fault, copies)
            yield from _batches(done, arrow)
            done = []
        if summary is not None:
            done.append({"conv": conv} | summary.row())
        yield from _batches(done, arrow)

    parts = stored(sorted_rows.mapInArrow(summaries, fields), "parts")

    def whole(group: pa.Table) -> pa.Table:
        found = sorted(group.to_pylist(), key=lambda r: r["part"])
        summary = found[0]
        for more in found[1:]:
            summary = join_summaries(summary, more)
        cost, audit = cheapest(tuple(zip(summary["kinds"], zip(
            summary["costs"], summary["audits"], strict=True), strict=True)))
        turns = summary["turns"]
        gaps = summary["last_turn"] - summary["first_turn"] + 1 - turns if turns else 0
        told = {c: [summary[c]] for c in ("blank", "duplicate", "truncated", "illegal")}
        return pa.table({"conv": group["conv"].slice(0, 1), "gaps": [gaps], **told,
                         "cost": [cost], "audit": [audit]})

    told = ("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
            "cost bigint, audit string")
    verdicts = parts.groupBy("conv").applyInArrow(whole, f"conv {kind}, {told}")
    return _with_digest(rows, verdicts, kind, told)


def _batches(done: list[dict], schema: pa.Schema):
    if done:
        yield pa.RecordBatch.from_pydict({n: [r[n] for r in done] for n in schema.names}, schema)


def _with_digest(rows: DataFrame, verdicts: DataFrame, kind: str, told: str) -> DataFrame:
    """The verdicts with the digest of each repaired conversation."""
    names = [field.split()[0] for field in told.split(", ")]
    nothing = [F.lit(None).cast(field.split()[1]).alias(field.split()[0])
               for field in told.split(", ")]
    no_row = [F.lit(None).cast(t).alias(n) for n, t in (
        ("turn", "bigint"), ("role", "string"), ("text", "string"), ("copies", "bigint"))]
    stream = verdicts.select("conv", F.lit(0).alias("rank"), *no_row, *names).unionByName(
        rows.select("conv", F.lit(1).alias("rank"), "turn", "role", "text", "copies", *nothing))
    dealt = stream.repartition("conv").sortWithinPartitions(
        "conv", "rank", "turn", "role", "text")

    fields = f"conv {kind}, {told}, repaired_sha256 string"
    arrow = to_arrow_schema(StructType.fromDDL(fields))

    def run(batches):
        state: _Digest | None = None
        for batch in batches:
            done = []
            verdict = {n: batch[n].to_pylist() for n in ("conv", *names)}
            for i, (rank, role, text, copies) in enumerate(zip(
                    *(batch[c].to_pylist() for c in ("rank", "role", "text", "copies")),
                    strict=True)):
                if rank == 0:
                    if state is not None:
                        done.append(state.row())
                    state = _Digest({n: verdict[n][i] for n in ("conv", *names)})
                else:
                    for _ in range(copies):
                        state.add(role, text)
            yield from _batches(done, arrow)
        if state is not None:
            yield from _batches([state.row()], arrow)

    return dealt.mapInArrow(run, fields)


class _Digest:
    """The digest of one repaired conversation, row by row."""

    def __init__(self, verdict: dict):
        self.verdict, self.at, self.ahead, self.started = verdict, 0, "u", False
        self.digest = hashlib.sha256()

    def _tell(self, role: str, text: str) -> None:
        self.digest.update(("\n" if self.started else "").encode() + f"{role}:{text}".encode())
        self.started = True
        self.ahead = "a" if role_initial(role) == "u" else "u"

    def _insert(self) -> None:
        audit = self.verdict["audit"]
        while self.at < len(audit) and audit[self.at] == "I":
            self._tell(ROLES[self.ahead], "")
            self.at += 1

    def add(self, role: str, text: str) -> None:
        self._insert()
        edit = self.verdict["audit"][self.at]
        self.at += 1
        if edit != "D":
            self._tell(role if edit == "K" else ROLES[self.ahead], text)

    def row(self) -> dict:
        self._insert()
        return self.verdict | {"repaired_sha256": self.digest.hexdigest()}


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with the damage that a checksum of their place decides; see the query's contract."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" "))
                              for c in ("conv_id", "turn")])
    spaced = {c: F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text")}
    rows = conversations.select("conv_id", "turn", "role", "text").withColumns(
        spaced | {"damage": F.crc32(F.encode(name, "UTF-8")) % 20})
    damage = F.col("damage")
    return rows.where(damage != 0).select(
        "conv_id", "turn", F.when(damage == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(damage == 1, "").when(damage == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(1), F.when(damage == 3, 2).otherwise(1))).alias("copy"))


def op12_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Damage all conversations, repair them, and report on every one, also those left empty."""
    conversations = table(spark, folder, "conversations")
    repaired = repair_conversations(damaged(conversations).drop("copy"))
    named = conversations.select("conv_id").distinct()
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    joined = named.join(repaired, named["conv_id"].eqNullSafe(repaired["conv"]), "left")
    return joined.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest()))
        .alias("repaired_sha256"))
