"""Repair of conversations by rank-compressed dynamic programming.

The cheapest edits that make the roles of a conversation read ``(system? (user assistant)+)?`` are found turn by turn. Each turn
takes one macro edit: a run of inserts, then Keep, Rerole or Delete. The macros' codes (``K``, ``R``, ``D``, ``IK``, ``IIR``, ...) are prefix-free,
so two audits of the same number of turns compare as their first differing macros do. A layer therefore needs no audit
strings: each state of the grammar has its cost, the rank of its audit among the layer's, and a pointer to its parent, and
the next layer's order follows from (parent's rank, code). Audits are written once, from the pointers, at the end. Costs and ranks relative to the layer
take few values, so a layer's step is looked up once it has been seen. No insert stands before a Delete: after it the cost is the same and the audit
smaller.

Rows are merged where they are equal, put into order by ranges of (conversation, turn, role, text), and packed into segments
of at most ``segment_rows`` rows. A conversation that lies in one segment is solved there. One of many segments (of any length) is
solved in parts: each segment gives, for each state it may be entered in, the cost and rank of each state it may be left in;
one pass over those few numbers per segment chooses the states, and each segment then writes its own piece. An audit determines its
state, so audits from different entry states always differ before the segment begins, and ranks are never compared across them.
Only the hash and the audit of a conversation are put together in one task, as a stream.

Defined cases: rows come by turn (null first), ties by role, then text; equal rows follow each other. An empty role, or one that begins with none of
the letters s, u, a, can't be kept. Null roles and texts count as one space. ``turn`` is integral. Bytes that are not UTF-8 are kept and hashed as they are. A conversation
without rows has zeros, an empty audit and the hash of nothing. Null conversation ids are one conversation. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.bytewords import release
from millrace.llm.workspace import Workspace

BLANKS = "\x20\t\n\x0b\x0c\r"
NOTHING = hashlib.sha256(b"").hexdigest()
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3

#: States of the grammar: nothing written, after system, after user, after assistant. A conversation may end in the first and the last.
START, SYSTEM, USER, ASSISTANT = range(4)
_AFTER = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
_NAMES = {USER: b"user", ASSISTANT: b"assistant"}
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
_TAILS = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}

Layer = tuple[tuple[int, int] | None, ...]


def made(state: int) -> int:
    """The state after a turn that is inserted or given the role that is wanted."""
    return ASSISTANT if state == USER else USER


def macros(state: int, initial: str) -> list[tuple[int, int, str]]:
    """(next state, cost, code) of each macro edit for a turn of that role."""
    out, cost, code = [(state, DELETE, "D")], 0, ""
    for _ in range(3):
        if initial in _AFTER[state]:
            out.append((_AFTER[state][initial], cost, code + "K"))
        out.append((made(state), cost + REROLE, code + "R"))
        state, cost, code = made(state), cost + INSERT, code + "I"
    return out


@lru_cache(maxsize=1 << 14)
def step(layer: Layer, initial: str, cut: bool) -> tuple[Layer, int, tuple[tuple[int, str] | None, ...]]:
    """(next layer, cost of all its states, the parent and code of each); a layer has (cost, rank) or None by state."""
    best: dict[int, tuple[int, int, str, int]] = {}
    for p, held in enumerate(layer):
        for q, cost, code in macros(p, initial) if held else ():
            found = (held[0] + cost + (CUT if cut and code != "D" else 0), held[1], code, p)
            if q not in best or found < best[q]:
                best[q] = found
    least, order = min(f[0] for f in best.values()), sorted({f[1:3] for f in best.values()})
    new = tuple((best[q][0] - least, order.index(best[q][1:3])) if q in best else None for q in range(4))
    return new, least, tuple((best[q][3], best[q][2]) if q in best else None for q in range(4))


class Turn:
    """A row of a segment: n equal turns, of which the first alone may be other than a duplicate."""

    __slots__ = ("cut", "duplicate", "initial", "blank", "n", "role", "text", "turn")

    def __init__(self, row: dict, duplicate: bool):
        self.turn, self.role, self.text, self.n, self.initial = row["turn"], row["role"], row["text"], row["n"], row["initial"]
        self.blank = row["fault"] == "blank"
        self.duplicate = duplicate and not self.blank
        self.cut = row["fault"] == "truncated" and not self.duplicate

    @property
    def dropped(self) -> bool:
        return self.blank or self.duplicate


def turns(rows: list[dict], again: list[int] | None = None) -> list[Turn]:
    """again: which rows are known to repeat earlier ones; found here if not given."""
    if again is None:
        seen: set[bytes] = set()
        return [Turn(r, r["digest"] in seen or bool(seen.add(r["digest"]))) for r in rows]
    known = set(again)
    return [Turn(r, k in known) for k, r in enumerate(rows)]


def forward(held: list[Turn], entry: int) -> tuple[Layer, int, list]:
    """The last layer, what all its costs lack, and for each turn the parents (None where all are deleted)."""
    layer: Layer = tuple((0, 0) if q == entry else None for q in range(4))
    total, back = 0, []
    for t in held:
        if t.dropped:
            total += DELETE * t.n
            back.append(None)
        else:
            layer, more, parents = step(layer, t.initial, t.cut)
            total += more + DELETE * (t.n - 1)
            back.append(parents)
    return layer, total, back


def ending(layer: Layer, total: int) -> tuple[int, int, str]:
    """(cost, state, last inserts) of the best end."""
    cost, _, tail, state = min((held[0] + INSERT * len(_TAILS[q]), held[1], _TAILS[q], q) for q, held in enumerate(layer) if held)
    return total + cost, state, tail


def edits(held: list[Turn], back: list, entry: int, leaving: int, tail: str) -> Iterator[tuple[str, Turn | None, bytes, bytes]]:
    """(edit, its turn, role, text) in order; deleted turns have their own role and text."""
    codes, state = [], leaving
    for parents in reversed(back):
        code = "D"
        if parents is not None:
            state, code = parents[state]
        codes.append(code)
    state = entry
    for t, code in zip([*held, None], [*reversed(codes), tail], strict=True):
        for c in code:
            if c == "D":
                yield c, t, t.role, t.text
            else:
                state = _AFTER[state][t.initial] if c == "K" else made(state)
                yield c, None if c == "I" else t, t.role if c == "K" else _NAMES[state], b"" if c == "I" else t.text
        for _ in range(t.n - 1 if t else 0):
            yield "D", t, t.role, t.text


def tallies(held: list[Turn]) -> dict:
    """Faults of a segment and what is needed to put its neighbours' beside them."""
    out = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "distinct": 0, "low": None, "high": None, "last": None, "before": None, "after": None}
    for t in held:
        out["blank"] += t.n * t.blank
        out["duplicate"] += t.n - 1 + t.duplicate if not t.blank else 0
        out["truncated"] += t.cut
        out["illegal"] += t.n - 1 + (out["after"] is not None and (out["after"], t.initial) not in _LEGAL)
        out["after"] = t.initial
        out["before"] = out["before"] if out["before"] is not None else t.initial
        if t.turn is not None:
            out["distinct"] += t.turn != out["last"]
            out["low"] = t.turn if out["low"] is None else out["low"]
            out["high"] = out["last"] = t.turn
    return out


class Digest:
    """What is returned of a conversation, from its segments in order."""

    FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

    def __init__(self) -> None:
        self.n = dict.fromkeys(self.FIELDS, 0)
        self.audit: list[str] = []
        self.hash, self.lines = hashlib.sha256(), 0
        self.low = self.high = self.after = None
        self.distinct = 0

    def add(self, t: dict, cost: int, audit: str, piece: bytes, lines: int) -> None:
        for k in ("blank", "duplicate", "truncated", "illegal"):
            self.n[k] += t[k]
        self.n["illegal"] += self.after is not None and t["before"] is not None and (self.after, t["before"]) not in _LEGAL
        self.after = t["after"] if t["after"] is not None else self.after
        if t["low"] is not None:
            self.distinct += t["distinct"] - (t["low"] == self.high)
            self.low, self.high = t["low"] if self.low is None else self.low, t["high"]
        self.n["cost"] += cost
        self.audit.append(audit)
        if lines:
            self.hash.update(b"\n" * bool(self.lines) + piece)
            self.lines += lines

    def row(self, conv: object) -> tuple:
        self.n["gaps"] = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return (conv, *[self.n[k] for k in self.FIELDS], "".join(self.audit), self.hash.hexdigest())


def _written(held: list[Turn], back: list, entry: int, leaving: int, tail: str) -> tuple[str, bytes, int]:
    """(audit, repaired lines, their number)."""
    done = list(edits(held, back, entry, leaving, tail))
    lines = [role + b":" + text for c, _, role, text in done if c != "D"]
    return "".join(c for c, *_ in done), b"\n".join(lines), len(lines)


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text with every twentieth row each dropped, emptied, cut, repeated or given to the user, by crc32."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", word("role").alias("role"), word("text").alias("text"), (F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn"))) % 20).alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def _fault(text: Column) -> Column:
    said = F.rtrim(text, F.lit(BLANKS))
    return F.when(said == "", "blank").when(~F.right(said, F.lit(1)).isin(".", "!", "?"), "truncated").otherwise("")


_ROW = "struct<turn:bigint,initial:string,fault:string,role:binary,text:binary,n:bigint,digest:binary>"
_ARROW_ROWS = pa.list_(pa.struct([("turn", pa.int64()), ("initial", pa.string()), ("fault", pa.string()), ("role", pa.binary()), ("text", pa.binary()), ("n", pa.int64()), ("digest", pa.binary())]))
_TALLIES = "struct<blank:bigint,duplicate:bigint,truncated:bigint,illegal:bigint,distinct:bigint,low:bigint,high:bigint,last:bigint,before:string,after:string>"


def _arrow(rows: list[tuple], columns: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    held = list(zip(*rows, strict=True)) if rows else [()] * len(columns)
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(held, columns, strict=True)], [n for n, _ in columns])


class _Packer:
    """Segments of a task's rows, which are in order. Of a conversation that is its first or last, other tasks may have rows."""

    def __init__(self, conv: object, part: int):
        self.conv, self.part, self.seg, self.cuts = conv, part, 0, 1
        self.held: list[dict] = []
        self.size, self.out = 0, []

    def add(self, row: dict) -> None:
        self.held.append(row)
        self.size += len(row["text"]) + len(row["role"])

    def cut(self, ended: bool = False) -> None:
        self.out.append((self.conv, self.part, self.seg, self.cuts > 0 or not ended, self.held))
        self.seg, self.cuts, self.held, self.size = self.seg + 1, self.cuts + 1, [], 0

    def close(self, following: object) -> None:
        self.cut(ended=True)
        self.conv, self.cuts = following, 0


def _segments(ws: Workspace, rows: DataFrame, segment_rows: int, segment_bytes: int) -> DataFrame:
    """(conv_id, part, seg, open, rows); by (part, seg) the segments of a conversation are in order. open: the conversation may have others."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    merged = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), word("role").alias("role"), word("text").alias("text")).groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n"))
    ordered = ws.save(merged, "merged").repartitionByRange("conv_id", "turn", F.left("role", F.lit(32)), F.left("text", F.lit(256))).sortWithinPartitions("conv_id", "turn", "role", "text")
    initial = F.left("role", F.lit(1))
    told = ordered.select(
        "conv_id",
        F.spark_partition_id().alias("part"),
        "turn",
        F.when(initial.isin("s", "u", "a"), initial).otherwise("").alias("initial"),
        _fault(F.col("text")).alias("fault"),
        F.col("role").cast("binary").alias("role"),
        F.col("text").cast("binary").alias("text"),
        "n",
        F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("digest"),
    )
    names = told.columns[2:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = None
        for batch in batches:
            columns = [("conv_id", batch.schema.field(0).type), ("part", pa.int32()), ("seg", pa.int64()), ("open", pa.bool_()), ("rows", _ARROW_ROWS)]
            for conv, part, *values in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                pack = pack or _Packer(conv, part)
                if conv != pack.conv:
                    pack.close(conv)
                elif len(pack.held) >= segment_rows or pack.size >= segment_bytes:
                    pack.cut()
                pack.add(dict(zip(names, values, strict=True)))
            if pack is not None and pack.out:
                yield _arrow(pack.out, columns)
                pack.out = []
        if pack is not None:
            pack.cut()
            yield _arrow(pack.out, columns)
        release()

    id_type = rows.schema["conv_id"].dataType.simpleString()
    return ws.save(told.mapInArrow(run, f"conv_id {id_type}, part int, seg long, open boolean, rows array<{_ROW}>"), "segments")


def _repeats(opened: DataFrame) -> DataFrame:
    """opened with again: which rows of a segment repeat rows of the conversation's earlier segments, or of its own."""
    narrow = opened.select("conv_id", "part", "seg", F.posexplode("rows.digest").alias("pos", "digest"))
    first = narrow.groupBy("conv_id", "digest").agg(F.min(F.struct("part", "seg", "pos")).alias("first"), F.count("*").alias("times")).where("times > 1")
    same = narrow["conv_id"].eqNullSafe(first["conv_id"]) & (narrow["digest"] == first["digest"])
    later = narrow.join(first, same).where(F.struct(narrow["part"], narrow["seg"], narrow["pos"]) > F.col("first"))
    lists = later.groupBy("part", "seg").agg(F.collect_list("pos").alias("again"))  # as long as a segment at most
    return opened.join(lists, ["part", "seg"], "left").select(*opened.columns, F.coalesce("again", F.array().cast("array<int>")).alias("again"))


def _ways(opened: DataFrame) -> DataFrame:
    """(conv_id, part, seg, ways): for each entry state, the cost and rank of each state in which a segment may be left (cost -1: none)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ways = []
            for rows, again in zip(batch.column(3), batch.column(4), strict=True):
                held, own = turns(rows.as_py(), again.as_py()), []
                for entry in range(4):
                    layer, total, _ = forward(held, entry)
                    own += [x for q in layer for x in ((q[0] + total, q[1]) if q else (-1, -1))]
                ways.append(own)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(ways, pa.list_(pa.int64()))], ["conv_id", "part", "seg", "ways"])

    id_type = opened.schema["conv_id"].dataType.simpleString()
    return opened.select("conv_id", "part", "seg", "rows", "again").mapInArrow(run, f"conv_id {id_type}, part int, seg long, ways array<bigint>")


def chosen(ways: list[list[int]]) -> list[tuple[int, int, str]]:
    """(entry, exit, last inserts) of each segment of a conversation."""
    layer: Layer = ((0, 0), None, None, None)
    back = []
    for own in ways:
        best: dict[int, tuple[int, int, int, int]] = {}
        for p, held in enumerate(layer):
            for q in range(4) if held else ():
                cost, rank = own[8 * p + 2 * q : 8 * p + 2 * q + 2]
                if cost >= 0 and (q not in best or (held[0] + cost, held[1]) < best[q][:2]):
                    best[q] = (held[0] + cost, held[1], rank, p)
        order = sorted({b[1:3] for b in best.values()})
        layer = tuple((best[q][0], order.index(best[q][1:3])) if q in best else None for q in range(4))
        back.append({q: b[3] for q, b in best.items()})
    _, state, tail = ending(layer, 0)
    out = []
    for parents in reversed(back):
        out.append((parents[state], state, tail))
        state, tail = parents[state], ""
    return out[::-1]


def _in_order(rows: DataFrame) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seg")


def _decisions(ways: DataFrame) -> DataFrame:
    """(part, seg, entry, leaving, tail): one pass over some numbers per segment, a conversation at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, at, held = None, [], []

        def done() -> Iterator[pa.RecordBatch]:
            found = chosen(held)
            for k in range(0, len(at), 4096):
                rows = [(*a, *d) for a, d in zip(at[k : k + 4096], found[k : k + 4096], strict=True)]
                yield _arrow(rows, [("part", pa.int32()), ("seg", pa.int64()), ("entry", pa.int32()), ("leaving", pa.int32()), ("tail", pa.string())])

        for batch in batches:
            for own, part, seg, way in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if at and own != conv:
                    yield from done()
                    at, held = [], []
                conv = own
                at.append((part, seg))
                held.append(way)
        if at:
            yield from done()

    return _in_order(ways).mapInArrow(run, "part int, seg long, entry int, leaving int, tail string")


class _Plan:
    """Segments, with the decisions for those of conversations of many segments."""

    def __init__(self, rows: DataFrame, segment_rows: int, segment_bytes: int):
        self.ws = Workspace(rows.sparkSession, "conversations")
        segments = _segments(self.ws, rows, segment_rows, segment_bytes)
        self.whole = segments.where("not open").drop("open")
        opened = self.ws.save(_repeats(segments.where("open").drop("open")), "opened")
        decided = self.ws.save(_decisions(_ways(opened)), "decided")
        self.opened = opened.join(decided, ["part", "seg"]).select(*opened.columns, "entry", "leaving", "tail")
        self.id_type = rows.schema["conv_id"].dataType.simpleString()


def repair(rows: DataFrame, every: DataFrame | None = None, *, segment_rows: int = 1024, segment_bytes: int = 4 << 20) -> DataFrame:
    """Per conversation of rows(conv_id, turn, role, text), and of every(conv_id), if given: faults, cost, audit and hash of the repaired text."""
    plan = _Plan(rows, segment_rows, segment_bytes)
    kinds = [(k, pa.int64()) for k in Digest.FIELDS] + [("audit", pa.string()), ("repaired_sha256", pa.string())]
    schema = f"conv_id {plan.id_type}, {', '.join(f'{k} bigint' for k in Digest.FIELDS)}, audit string, repaired_sha256 string"

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = []
            for conv, packed in zip(batch.column(0), batch.column(1), strict=True):
                held, digest = turns(packed.as_py()), Digest()
                layer, total, back = forward(held, START)
                cost, state, tail = ending(layer, total)
                digest.add(tallies(held), cost, *_written(held, back, START, state, tail))
                done.append(digest.row(conv.as_py()))
            yield _arrow(done, [("conv_id", batch.schema.field(0).type), *kinds])

    def piece(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                conv, part, seg, packed, again, entry, leaving, tail = (c[k].as_py() for c in batch.columns)
                held = turns(packed, again)
                layer, total, back = forward(held, entry)
                written = _written(held, back, entry, leaving, tail)
                row = (conv, part, seg, tallies(held), total + layer[leaving][0] + INSERT * len(tail), *written)
                told = pa.struct([(f, pa.string() if f in ("before", "after") else pa.int64()) for f in row[3]])
                yield _arrow([row], [("conv_id", batch.schema.field(0).type), ("part", pa.int32()), ("seg", pa.int64()), ("told", told), ("cost", pa.int64()), ("audit", pa.string()), ("piece", pa.binary()), ("lines", pa.int64())])

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest, kind = None, None, None
        for batch in batches:
            kind = batch.schema.field(0).type
            for k in range(batch.num_rows):
                own, _, _, told, cost, audit, text, lines = (c[k].as_py() for c in batch.columns)
                if digest is not None and own != conv:
                    yield _arrow([digest.row(conv)], [("conv_id", kind), *kinds])
                    digest = None
                conv, digest = own, digest or Digest()
                digest.add(told, cost, audit, text, lines)
        if digest is not None:
            yield _arrow([digest.row(conv)], [("conv_id", kind), *kinds])

    order = ["conv_id", "part", "seg", "rows", "again", "entry", "leaving", "tail"]
    pieces = plan.opened.select(order).mapInArrow(piece, f"conv_id {plan.id_type}, part int, seg long, told {_TALLIES}, cost bigint, audit string, piece binary, lines bigint")
    found = plan.whole.select("conv_id", "rows").mapInArrow(alone, schema).unionByName(_in_order(pieces).mapInArrow(together, schema))
    if every is not None:
        found = plan.ws.save(found, "found")
        ids = every.select(F.col("conv_id").alias("__id")).distinct()
        told = [F.coalesce(k, F.lit(0).cast("long")).alias(k) for k in Digest.FIELDS]
        found = ids.join(found, F.col("__id").eqNullSafe(F.col("conv_id")), "left").select(F.col("__id").alias("conv_id"), *told, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(NOTHING)).alias("repaired_sha256"))
    return plan.ws.keep(found)


def repaired(rows: DataFrame, *, segment_rows: int = 1024, segment_bytes: int = 4 << 20) -> DataFrame:
    """The repaired conversations turn by turn: conv_id, part, seg, position, edit, turn, role, text; in order of part, seg and position.

    Kept and reroled turns have their own ``turn``, inserted ones null. Deleted turns are left out.
    """
    plan = _Plan(rows, segment_rows, segment_bytes)
    kinds = [("part", pa.int32()), ("seg", pa.int64()), ("position", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()), ("role", pa.binary()), ("text", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                conv, part, seg, packed, again, entry, leaving, tail = (c[k].as_py() for c in batch.columns)
                held = turns(packed, again)
                layer, total, back = forward(held, entry if entry is not None else START)
                if entry is None:
                    entry, (_, leaving, tail) = START, ending(layer, total)
                done = [(c, t.turn if t else None, role, text) for c, t, role, text in edits(held, back, entry, leaving, tail) if c != "D"]
                yield _arrow([(conv, part, seg, n, *e) for n, e in enumerate(done)], [("conv_id", batch.schema.field(0).type), *kinds])

    order = ["conv_id", "part", "seg", "rows", "again", "entry", "leaving", "tail"]
    nothing = {"again": "array<int>", "entry": "int", "leaving": "int", "tail": "string"}
    both = plan.whole.withColumns({c: F.lit(None).cast(t) for c, t in nothing.items()}).select(order).unionByName(plan.opened.select(order))
    out = both.mapInArrow(run, f"conv_id {plan.id_type}, part int, seg long, position long, edit string, turn bigint, role binary, text binary")
    return plan.ws.keep(out.withColumns({c: F.col(c).cast("string") for c in ("role", "text")}))
