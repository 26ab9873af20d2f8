"""Repair of conversations: the cheapest edits after which the roles are a system turn at most, then pairs of turns.

A weighted grammar in Chomsky normal form describes repaired conversations by what a span of rows turns into. A
nonterminal ``pq`` is a span after which a conversation that had come to state p is in state q (nothing yet, after the
system turn, after a user, after an assistant), with the rules ``pq -> pr rq``; a row is a terminal that is kept, gets
another role or is deleted, each at its cost. Before a row, turns may be inserted: the closure of the empty span. Cells
hold the minimum of (cost, audit), the audit being the initials of the edits in order. As the rules only join adjacent
spans, every way to split a span gives the same cell, so cells are combined bottom-up over spans of doubling length.

Of two audits of a span with the same cost and state, neither begins with the other (the rest would be inserts, which
cost), so the smaller one stays smaller whatever follows, and cells may be combined in any order.

Conversations of up to ``most_rows`` rows and ``most_bytes`` of text are repaired where they are sorted. Longer ones are
dealt out by range of rows and worked on in pieces: a piece's cells go to the conversation's task without the rows, and
what is chosen there comes back to the piece.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfprice.sources.staging import write_through

BLANKS = " \t\n\v\f\r"
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
#: Costs of the edits. A truncated row that stays adds one.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
STATES = range(4)
_NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: The only role that may be put after each state.
_DUE = {p: next(r for r in ROLES if (p, r) in _NEXT) for p in STATES}
_ACCEPTED = (0, 3)

#: For each first state, the (last state, cost, audit) that can be reached.
Cell = list[list[tuple[int, int, str]]]

_REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_REPAIRED = "conv_id long, position long, edit string, role string, text string"
_PIECES = "conv_id long, task int, piece int, costs array<int>, audits array<string>, sizes array<int>, illegal long, first string, last string, roles array<string>, texts array<string>"
_CHOSEN = "task int, piece int, audit string, state int, start long, ends boolean, cost long, illegal long"


def combine(x: Cell, y: Cell) -> Cell:
    """The cell of a span from those of its two parts."""
    out = []
    for reached in x:
        best: dict[int, tuple[int, str]] = {}
        for r, cost, audit in reached:
            for q, more, rest in y[r]:
                total = cost + more
                if q not in best or total < best[q][0] or (total == best[q][0] and audit + rest < best[q][1]):
                    best[q] = (total, audit + rest)
        out.append([(q, *found) for q, found in best.items()])
    return out


def _closure() -> Cell:
    """What inserted turns alone lead to. More than two lead to no other state."""
    out = []
    for p in STATES:
        reached, state = {p: (0, "")}, p
        for n in (1, 2):
            state = _NEXT[state, _DUE[state]]
            reached.setdefault(state, (n * INSERT, "I" * n))
        out.append([(q, *found) for q, found in reached.items()])
    return out


INSERTED = _closure()
#: Of each state, the cheapest end: (cost, inserted turns).
ENDS = [min((cost, audit) for q, cost, audit in INSERTED[p] if q in _ACCEPTED) for p in STATES]


def row_cell(initial: str, gone: bool, truncated: bool) -> Cell:
    """Of one row, with turns inserted before it. ``gone``: it has to be deleted."""
    extra = TRUNCATED if truncated else 0
    out = []
    for p in STATES:
        reached = {p: (DELETE, "D")}
        if not gone:
            changed = [(_NEXT[p, _DUE[p]], REROLE + extra, "R")]
            kept = [(_NEXT[p, initial], KEEP + extra, "K")] if (p, initial) in _NEXT else []
            for q, cost, edit in changed + kept:
                reached[q] = min(reached.get(q, (cost, edit)), (cost, edit))
        out.append([(q, *found) for q, found in reached.items()])
    return combine(INSERTED, out)


#: The cells of all kinds of rows; an initial that is not in the grammar is "".
_CELLS = {(i, g, t): row_cell(i, g, t) for i in ("s", "u", "a", "") for g in (False, True) for t in (False, True)}


def span_cell(rows: list[tuple[str, bool, bool]]) -> Cell:
    """Of a span of rows (initial, gone, truncated), from spans of one row up."""
    cells = [_CELLS[i if i in ("s", "u", "a") else "", g, t and not g] for i, g, t in rows]
    while len(cells) > 1:
        pairs = [combine(a, b) for a, b in zip(cells[::2], cells[1::2], strict=False)]
        cells = pairs + cells[len(pairs) * 2 :]
    return cells[0]


def cheapest(rows: list[tuple[str, bool, bool]]) -> tuple[int, str]:
    """(cost, audit) of the best repair of a whole conversation."""
    if not rows:
        return 0, ""
    return min((cost + ENDS[q][0], audit + ENDS[q][1]) for q, cost, audit in span_cell(rows)[0])


def apply_edits(rows: list[tuple[str | None, str | None]], audit: str, state: int = 0) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the turns that the edits leave of the rows (role, text), from a state on."""
    left = iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(left)
        if edit == "D":
            continue
        due = role[:1] if edit == "K" else _DUE[state]
        state = _NEXT[state, due]
        yield edit, role if edit == "K" else ROLES[due], text


def fault(role: str, text: str, seen: bool) -> str:
    """The first fault of a row: blank, duplicate, truncated, or none."""
    visible = text.strip(BLANKS)
    return "blank" if not visible else "duplicate" if seen else "truncated" if visible[-1] not in ".!?" else ""


def n_illegal(initials: list[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials[:-1], initials[1:], strict=True))


@dataclass
class Conversation:
    """The rows of one conversation in order."""

    conv_id: int | None
    turns: list[int | None]
    roles: list[str]
    texts: list[str]

    def faults(self) -> list[str]:
        seen: set[tuple[str, str]] = set()
        out = []
        for row in zip(self.roles, self.texts, strict=True):
            out.append(fault(*row, row in seen))
            seen.add(row)
        return out

    def repaired(self) -> tuple[list[str], int, str, list[tuple[str, str, str]]]:
        """(faults, cost, audit, turns)."""
        faults = self.faults()
        cost, audit = cheapest([(r[:1], f in ("blank", "duplicate"), f == "truncated") for r, f in zip(self.roles, faults, strict=True)])
        return faults, cost, audit, list(apply_edits(list(zip(self.roles, self.texts, strict=True)), audit))

    def report(self) -> tuple:
        faults, cost, audit, turns = self.repaired()
        known = [t for t in self.turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        digest = hashlib.sha256("\n".join(f"{role}:{text}" for _, role, text in turns).encode()).hexdigest()
        return (self.conv_id, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), n_illegal([r[:1] for r in self.roles]), cost, audit, digest)


_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, types = zip(*(f.strip().split(" ") for f in schema.split(",")), strict=True)
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.record_batch([pa.array(c, _TYPES[t]) for c, t in zip(columns, types, strict=True)], list(names))


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[Conversation]:
    """The conversations of sorted rows (conv_id, turn, role, text, copies)."""
    now: Conversation | None = None
    for batch in batches:
        for conv_id, turn, role, text, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    yield now
                now = Conversation(conv_id, [], [], [])
            for _ in range(copies):
                now.turns.append(turn)
                now.roles.append(role)
                now.texts.append(text)
    if now is not None:
        yield now


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for c in _whole(batches):
        rows.append(c.report())
        if len(rows) == 1024:
            yield _batch(rows, _REPORT)
            rows = []
    yield _batch(rows, _REPORT)


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for c in _whole(batches):
        rows += [(c.conv_id, i, *turn) for i, turn in enumerate(c.repaired()[3])]
        if len(rows) >= 1024:
            yield _batch(rows, _REPAIRED)
            rows = []
    yield _batch(rows, _REPAIRED)


def _cut(most_rows: int, most_bytes: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of the sorted rows (conv_id, turn, role, text, copies, first) of a task."""
    task, n = TaskContext.get().partitionId(), 0
    rows: list[tuple] = []  # (role, text, gone, truncated)
    owner, size = None, 0

    def piece() -> pa.RecordBatch:
        nonlocal n, rows, size
        cell = span_cell([(r[:1], g, t) for r, _, g, t in rows])
        costs, audits, sizes = [None] * 16, [None] * 16, [None] * 16
        for p, reached in enumerate(cell):
            for q, cost, audit in reached:
                costs[4 * p + q], audits[4 * p + q], sizes[4 * p + q] = cost, audit, len(audit) - audit.count("D")
        initials = [r[:1] for r, *_ in rows]
        kept = [(None, None) if g else (r, t) for r, t, g, _ in rows]
        out = (owner, task, n, costs, audits, sizes, n_illegal(initials), initials[0], initials[-1], [r for r, _ in kept], [t for _, t in kept])
        n, rows, size = n + 1, [], 0
        return _batch([out], _PIECES)

    for batch in batches:
        for conv_id, _, role, text, copies, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for copy in range(copies):
                if rows and (owner != conv_id or len(rows) == most_rows or size >= most_bytes):
                    yield piece()
                owner = conv_id
                found = fault(role, text, copy > 0 or not first)
                gone = found in ("blank", "duplicate")
                rows.append((role, "" if gone else text, gone, found == "truncated"))
                size += 0 if gone else len(text)
    if rows:
        yield piece()


def _choose(table: pa.Table) -> pa.Table:
    """The edits of every piece of a conversation: which of the piece's audits, and what follows the last one.

    From the end, the cheapest way to go from each state; from the start, the smallest audit among the cheapest.
    """
    rows = sorted(table.to_pylist(), key=lambda r: (r["task"], r["piece"]))
    ahead = [[cost for cost, _ in ENDS]]
    for r in reversed(rows):
        costs = r["costs"]
        ahead.append([min(costs[4 * p + q] + ahead[-1][q] for q in STATES if costs[4 * p + q] is not None) for p in STATES])
    ahead.reverse()
    out, state, start = [], 0, 0
    illegal = sum(r["illegal"] for r in rows) + sum(a["last"] + b["first"] not in LEGAL for a, b in zip(rows[:-1], rows[1:], strict=True))
    for i, r in enumerate(rows):
        best = [q for q in STATES if r["costs"][4 * state + q] is not None and r["costs"][4 * state + q] + ahead[i + 1][q] == ahead[i][state]]
        q = min(best, key=lambda q: r["ranks"][4 * state + q])
        out.append((r["task"], r["piece"], 4 * state + q, start))
        state, start = q, start + r["sizes"][4 * state + q]
    last = len(out) - 1
    rows = [(t, n, ENDS[state][1] if i == last else "", place, at, i == last, ahead[0][0], illegal) for i, (t, n, place, at) in enumerate(out)]
    return pa.Table.from_batches([_batch(rows, _CHOSEN)])


def _edited(row: dict) -> list[tuple[str, str, str]]:
    """The repaired turns of a piece for which an audit was chosen."""
    audit = row["audits"][row["state"]] + row["audit"]
    return list(apply_edits(list(zip(row["roles"], row["texts"], strict=True)), audit, row["state"] // 4))


def _repaired_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
            yield _batch([(row["conv_id"], row["start"] + i, *turn) for i, turn in enumerate(_edited(row))], _REPAIRED)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cost, audit and digest of the conversations whose pieces come in order, one piece at a time."""
    digest, audit, begun = hashlib.sha256(), [], False
    for batch in batches:
        for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
            audit.append(row["audits"][row["state"]] + row["audit"])
            for _, role, text in _edited(row):
                digest.update(f"{chr(10) * begun}{role}:{text}".encode())
                begun = True
            if row["ends"]:
                yield _batch([(row["conv_id"], row["illegal_in_all"], row["cost"], "".join(audit), digest.hexdigest())], "conv_id long, illegal long, cost long, audit string, repaired_sha256 string")
                digest, audit, begun = hashlib.sha256(), [], False


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def _clean(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    filled = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (role, text)}
    return turns.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), filled[role].alias("role"), filled[text].alias("text"), F.lit(1).cast("long").alias("copies"))


def _split(rows: DataFrame, most_rows: int, most_bytes: int) -> tuple[DataFrame, DataFrame]:
    """The rows of conversations that a task can hold, sorted, and those of all others."""
    sizes = rows.groupBy("conv_id").agg(F.sum("copies").alias("n"), F.sum(F.octet_length("text") * F.col("copies")).alias("bytes"))
    long = write_through(sizes.filter((F.col("n") > most_rows) | (F.col("bytes") > most_bytes)).select(F.col("conv_id").alias("long_id")), "long-conversations")
    met = _same(F.col("conv_id"), F.col("long_id"))
    short = rows.join(long, met, "left_anti").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return short, rows.join(long, met, "left_semi")


def _in_pieces(rows: DataFrame, most_rows: int, most_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(counts of faults and turns by conversation, pieces with their chosen edits) of long conversations.

    Equal rows are counted before they are sorted, so that rows of a conversation can be dealt out however many are equal.
    """
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    rows = write_through(rows.withColumn("name", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)), "turns")
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = rows.groupBy("conv_id", "name").agg(F.min(place).alias("place")).select(F.col("conv_id").alias("of"), F.col("name").alias("first_name"), "place")
    marked = rows.join(firsts, _same(F.col("conv_id"), F.col("of")) & (F.col("name") == F.col("first_name")))
    marked = marked.select("conv_id", "turn", "role", "text", "copies", (_same(F.col("place.turn"), F.col("turn"))).alias("first"))

    visible = F.regexp_replace("text", r"[\x20\x09-\x0D]+\z", "")
    blank = F.length(visible) == 0
    first = F.col("first").cast("long")
    counts = marked.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).alias("gaps"),
        F.sum(F.when(blank, F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(blank, 0).otherwise(F.col("copies") - first)).alias("duplicate"),
        F.sum(F.when(blank | F.substr(visible, F.length(visible)).isin(".", "!", "?"), 0).otherwise(first)).alias("truncated"),
    )
    order = ["conv_id", "turn", "role", "text"]
    dealt = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = write_through(dealt.mapInArrow(lambda b: _cut(most_rows, most_bytes, b), _PIECES), "pieces")
    audits = F.array_sort(F.array_compact("audits"))
    ranks = F.transform("audits", lambda a: F.when(a.isNotNull(), F.array_position(audits, a)))
    cells = pieces.select("conv_id", "task", "piece", "costs", "sizes", ranks.alias("ranks"), "illegal", "first", "last")
    chosen = cells.groupBy("conv_id").applyInArrow(_choose, _CHOSEN).withColumnRenamed("illegal", "illegal_in_all")
    return counts, pieces.join(chosen, ["task", "piece"])


def repair(turns: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", most_rows: int = 4096, most_bytes: int = 16 << 20) -> DataFrame:
    """The repaired conversations: (conv_id, position, edit, role, text), one row per turn that is left or inserted.

    The rows of a conversation are taken by turn (nulls first; equal turns by role, then text). A row is blank if its
    text has no other characters than the six ASCII blanks, else a duplicate if an earlier row has its role and text,
    else truncated if its last other character is not one of ``.!?``. Keeping a row costs 0, giving it the role user or
    assistant 2, deleting it 3 (which blank and duplicate rows need), inserting an empty user or assistant turn 2; a
    truncated row that stays adds 1. Roles count by their first character; the repaired ones are nothing, or pairs of
    user and assistant after at most one system turn. Of equally cheap repairs the one with the smallest audit is made.
    ``edit`` is K (kept), R (another role) or I (inserted).

    Null roles and texts are one space; a null conv_id is a conversation like all others, and rows with a null turn come
    first. Conversations of which nothing is left have no rows. Further columns are ignored. An empty table gives none.
    ``most_rows`` and ``most_bytes`` bound what is held at once and do not change the result.
    """
    short, long = _split(_clean(turns, conv_id, turn, role, text), most_rows, most_bytes)
    _, pieces = _in_pieces(long, most_rows, most_bytes)
    return short.mapInArrow(_repaired, _REPAIRED).unionByName(pieces.mapInArrow(_repaired_pieces, _REPAIRED))


def repair_report(turns: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", most_rows: int = 4096, most_bytes: int = 16 << 20) -> DataFrame:
    """Per conversation: its faults, the cost and audit of its repair, and the digest of the repaired turns.

    ``gaps``: turns missing between the smallest and largest; ``blank``, ``duplicate``, ``truncated``: rows by their first
    fault; ``illegal``: adjacent rows whose roles may not follow each other; ``audit``: the initials of the edits (Keep,
    Rerole, Delete, Insert) in order; ``repaired_sha256``: of ``role:text`` of the turns, joined by line feeds. See repair.

    The digest of one conversation can only be taken in order; its pieces are read one at a time for it.
    """
    short, long = _split(_clean(turns, conv_id, turn, role, text), most_rows, most_bytes)
    counts, pieces = _in_pieces(long, most_rows, most_bytes)
    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "task", "piece")
    digests = ordered.mapInArrow(_digests, "conv_id long, illegal long, cost long, audit string, repaired_sha256 string")
    digests = digests.withColumnRenamed("conv_id", "of")
    whole = counts.join(digests, _same(F.col("conv_id"), F.col("of"))).select(*(f.strip().split(" ")[0] for f in _REPORT.split(",")))
    return short.mapInArrow(_reports, _REPORT).unionByName(whole)


def damage(turns: DataFrame) -> DataFrame:
    """Conversations with known faults, by a hash of ``conv_id:turn`` (nulls: one space) modulo 20.

    0 drops a row, 1 empties its text, 2 takes the marks ``.!?`` out of it, 3 repeats it, 4 gives it the role user.
    """
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", part("role").alias("role"), part("text").alias("text"), code.alias("code")).filter("code != 0")
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("code") == 4, "user").otherwise(F.col("role"))
    repeated = F.explode(F.sequence(F.lit(1), F.when(F.col("code") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), repeated.alias("copy")).drop("copy")


def report_on_all(turns: DataFrame, kept: DataFrame, **options) -> DataFrame:
    """The report on the kept rows, with a row for every conversation of ``turns``, also for those without any left."""
    found = repair_report(kept, **options).withColumnRenamed("conv_id", "of")
    every = turns.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    names = [f.strip().split(" ")[0] for f in _REPORT.split(",")][1:]
    none = {n: F.lit(0).cast("long") for n in names[:-2]} | {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit(""), 256)}
    return every.join(found, _same(F.col("conv_id"), F.col("of")), "left").select("conv_id", *(F.coalesce(n, none[n]).alias(n) for n in names))
