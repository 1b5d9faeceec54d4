"""Conversation structure repair: generalised LR over the role grammar.

A repaired conversation is empty or  s? (u a)+  in role initials:

    Body -> s Pairs | Pairs      Pairs -> Pairs Pair | Pair      Pair -> u a

The parser reads the rows of a conversation in order. Before each row it may
insert a user or assistant turn; then it keeps the row, gives it another role
or deletes it, each at its price. All readings live side by side in one
graph-structured stack: readings with the same top and the same rest of stack
are one link, and of those that meet there only the least (cost, audit) stays.
The grammar is left-recursive, so its stacks are few and shallow (``STACKS``,
derived from the rules) and a row costs a bounded number of steps.

Audits are the edits' initials (Keep, Rerole, Delete, Insert). What one row
adds is inserts and then one letter of K, R, D: a prefix-free code, so audits of
the same rows compare chunk by chunk, and a rank per link stands for the string
in every comparison. Two bytes per row and stack lead back from the end.

Scale: faults are column expressions; repeated (role, text) rows are found by
an aggregate of narrow rows and a join on its keys. The parse streams narrow
rows (no texts) sorted by conversation, keeping about ``2 * len(STACKS)`` bytes
a row of one conversation; a second stream applies the audit to the texts and
keeps nothing but running digests. A conversation's parse is one chain of
rows, so it stays in one task, whatever its length; only the audit itself has
to fit in memory.

Defined results: null role or text is one space; rows go by turn, null first,
ties by role and then by the digest of role and text; repeated rows are
duplicates of the first; a null conv_id is a conversation of its own; an empty
table gives no rows; columns other than conv_id, turn, role, text are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialised, table

KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
ROLES = {"u": "user", "a": "assistant"}
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
_SPACES = " \t\n\x0b\f\r"


# --- the grammar -------------------------------------------------------------

def _shift(stack: tuple, initial: str) -> tuple | None:
    """The stack after reading one role initial: shift, then reduce."""
    top = stack[-1:]
    if initial == "s":
        return ("s",) if not stack else None
    if initial == "u":
        return None if top == ("u",) else stack + ("u",)
    if initial == "a" and top == ("u",):  # Pair -> u a, then Pairs -> Pairs Pair | Pair
        rest = stack[:-1]
        return rest if rest[-1:] == ("Pairs",) else rest + ("Pairs",)
    return None


def _stacks() -> list[tuple]:
    found = [()]
    for stack in found:
        found += [s for s in (_shift(stack, i) for i in "sua") if s is not None and s not in found]
    return found


STACKS = _stacks()
MOVE = [{i: STACKS.index(s) for i in "sua" if (s := _shift(stack, i)) is not None} for stack in STACKS]
#: The one role of user and assistant that a stack can take next.
WANTS = ["u" if "u" in m else "a" for m in MOVE]
ACCEPT = [not s or s[-1] == "Pairs" for s in STACKS]
_START = 0
_LETTERS = "KRD"


class Parse:
    """The graph-structured stack of one conversation, row by row.

    ``links[stack]`` is (cost, rank); ``trail`` holds for each row and stack the
    stack before it and the chunk of edits: inserts * 4 + letter."""

    def __init__(self):
        self.links = {_START: (0, 0)}
        self.trail = bytearray()

    def _inserted(self) -> dict:
        """Links after any inserts: stack -> (cost, rank, inserts, stack before)."""
        best = {s: (cost, rank, 0, s) for s, (cost, rank) in self.links.items()}
        todo = list(best)
        while todo:
            s = todo.pop()
            cost, rank, n, origin = best[s]
            to, new = MOVE[s][WANTS[s]], (cost + INSERT, rank, n + 1, origin)
            if to not in best or new[:3] < best[to][:3]:
                best[to] = new
                todo.append(to)
        return best

    def row(self, initial: str, must_go: bool, truncated: bool) -> None:
        met: dict = {}

        def reach(stack, cost, rank, n, letter, origin):
            # "I" sorts after D and before K and R, so (D) < (I..) < (K) < (R)
            chunk = "I" * n + letter
            if stack not in met or (cost, rank, chunk) < met[stack][:3]:
                met[stack] = (cost, rank, chunk, origin)

        extra = CUT if truncated else 0
        for s, (cost, rank, n, origin) in self._inserted().items():
            reach(s, cost + DELETE, rank, n, "D", origin)
            if must_go:
                continue
            if initial in MOVE[s]:
                reach(MOVE[s][initial], cost + KEEP + extra, rank, n, "K", origin)
            reach(MOVE[s][WANTS[s]], cost + REROLE + extra, rank, n, "R", origin)
        place = {a: i for i, a in enumerate(sorted((rank, chunk) for _, rank, chunk, _ in met.values()))}
        cells = bytearray(2 * len(STACKS))
        for s, (_, _, chunk, origin) in met.items():
            cells[2 * s], cells[2 * s + 1] = origin, (len(chunk) - 1) * 4 + _LETTERS.index(chunk[-1])
        self.trail += cells
        self.links = {s: (cost, place[rank, chunk]) for s, (cost, rank, chunk, _) in met.items()}

    def audit(self) -> tuple[int, str]:
        """The least cost and, among its edits, the ASCII-least initials."""
        cost, _, n, s = min(v for k, v in self._inserted().items() if ACCEPT[k])
        parts, width = ["I" * n], 2 * len(STACKS)
        for at in range(len(self.trail) - width, -1, -width):
            s, code = self.trail[at + 2 * s], self.trail[at + 2 * s + 1]
            parts.append("I" * (code // 4) + _LETTERS[code % 4])
        return cost, "".join(reversed(parts))


def applied(audit: str):
    """Yields (edit, role, reads): the role an edit gives (None: the row's own
    or none) and whether it reads a row. The first kept row settles whether a
    system turn leads."""
    stack = _START
    for edit in audit:
        if edit == "D":
            yield edit, None, True
        elif edit == "K":
            initial = yield edit, None, True
            stack = MOVE[stack][initial]
        else:
            want = WANTS[stack]
            yield edit, ROLES[want], edit == "R"
            stack = MOVE[stack][want]


# --- the rows ----------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults planted by crc32 of ``conv_id:turn`` modulo 20:
    conv_id, turn, role, text, copies (0: the row is dropped)."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.pmod(F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn"))), F.lit(20))
    text = name("text")
    return conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.when(fate == 4, "user").otherwise(name("role")).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("copies"))


def undamaged(conversations: DataFrame) -> DataFrame:
    """The rows as they are, each once, in the form :func:`damaged` gives."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                                name("role").alias("role"), name("text").alias("text"), F.lit(1).alias("copies"))


def _known(rows: DataFrame) -> DataFrame:
    """``rows`` with ``code``, the SHA-256 that stands for (role, text)."""
    return rows.withColumn("code", F.unhex(F.sha2(F.concat_ws("\n", F.length("role").cast("string"), "role", "text"), 256)))


def faults(rows: DataFrame) -> DataFrame:
    """Narrow rows: conv_id, turn, role, code, copies and the first fault that
    all copies of the row share; further copies are duplicates of the first."""
    end = F.substring(F.rtrim("text", F.lit(_SPACES)), -1, 1)
    narrow = _known(rows).select(
        "conv_id", "turn", "role", "code", "copies",
        F.when(end == "", BLANK).when(~end.isin(".", "!", "?"), TRUNCATED).otherwise(0).alias("fault"))
    first = (narrow.where("copies > 0 and fault <> 1").groupBy("conv_id", "role", "code")
             .agg(F.min(F.struct("turn")).alias("first"), F.max(F.struct("turn")).alias("last"))
             .where("first <> last"))  # (role, text) found at several turns
    first = first.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("code").alias("d"), "first")
    on = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("code") == F.col("d"))
    again = F.coalesce(F.struct("turn") > F.col("first"), F.lit(False)) & (F.col("fault") != BLANK)
    return narrow.join(first, on, "left").select(
        "conv_id", "turn", "role", "code", "copies", F.when(again, DUPLICATE).otherwise(F.col("fault")).alias("fault"))


def _ordered(rows: DataFrame, *after) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *after, "turn", "role", "code")


REPORT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
_REPORT_TYPES = [pa.int64()] * 7 + [pa.string()]
_LEGAL = ("su", "ua", "au")


def _batch(rows, names, kinds):
    columns = list(zip(*rows)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)


class _Tally:
    def __init__(self, conv):
        self.conv, self.parse, self.counts = conv, Parse(), [0, 0, 0, 0]  # counts by fault
        self.low = self.high = self.before = self.same = None
        self.turns = self.illegal = 0

    def add(self, turn, role, code, copies, fault):
        if turn is not None and copies:
            if self.low is None:
                self.low = turn
            if self.high != turn:
                self.high, self.turns = turn, self.turns + 1
        for _ in range(copies):
            kind = DUPLICATE if fault != BLANK and self.same == (turn, role, code) else fault
            self.same = (turn, role, code)
            self.counts[kind] += 1
            initial = role[:1]
            if self.before is not None and self.before + initial not in _LEGAL:
                self.illegal += 1
            self.before = initial
            self.parse.row(initial, kind in (BLANK, DUPLICATE), kind == TRUNCATED)

    def result(self):
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv, gaps, *self.counts[1:], self.illegal, *self.parse.audit())


def report(rows: DataFrame) -> DataFrame:
    """Per conversation of ``rows`` (see :func:`damaged`): the fault counts, the
    least cost of a repair and its audit."""
    def read(batches):
        tally = None
        for b in batches:
            out = []
            for conv, turn, role, code, copies, fault in zip(*(c.to_pylist() for c in b.columns)):
                if tally is None or tally.conv != conv:
                    if tally is not None:
                        out.append(tally.result())
                    tally = _Tally(conv)
                tally.add(turn, role, code, copies, fault)
            yield _batch(out, REPORT, _REPORT_TYPES)
        if tally is not None:
            yield _batch([tally.result()], REPORT, _REPORT_TYPES)

    return _ordered(faults(rows)).mapInArrow(
        read, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


def _with_audits(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """Rows of each conversation behind its report row, in order."""
    texts = _known(rows).where("copies > 0").select("conv_id", "turn", "role", "text", "code", "copies")
    both = reports.withColumn("head", F.lit(0)).unionByName(texts.withColumn("head", F.lit(1)), allowMissingColumns=True)
    return _ordered(both.select("head", *REPORT, "turn", "role", "text", "code", "copies"), "head")


def _repaired(batches):
    """Yields per batch a list of (report row, edit, role, text), and
    (report row, None, None, None) after the last turn of a conversation."""
    head, edits, pending = None, None, None

    def ahead(out, initial=None):
        """Runs inserts up to the next edit that reads a row."""
        nonlocal pending
        step = edits.send(initial) if initial is not None else next(edits, None)
        while step is not None and not step[2]:
            out.append((head, step[0], step[1], ""))
            step = next(edits, None)
        pending = step

    for b in batches:
        out = []
        names = b.schema.names
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if row[0] == 0:
                if head is not None:
                    out.append((head, None, None, None))
                head = row[1:1 + len(REPORT)]
                edits = applied(head[-1])
                ahead(out)
                continue
            role, text, copies = row[names.index("role")], row[names.index("text")], row[names.index("copies")]
            for _ in range(copies):
                edit, given, _ = pending
                if edit != "D":
                    out.append((head, edit, given or role, text))
                try:
                    ahead(out, role[:1] if edit == "K" else None)
                except StopIteration:
                    pending = None
        yield out
    if head is not None:
        yield [(head, None, None, None)]


def repaired_turns(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """The repaired turns: conv_id, place (from 0), edit, role, text."""
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]

    def write(batches):
        place = 0
        for out in _repaired(batches):
            got = []
            for head, edit, role, text in out:
                if edit is None:
                    place = 0
                else:
                    got.append((head[0], place, edit, role, text))
                    place += 1
            yield _batch(got, ["conv_id", "place", "edit", "role", "text"], kinds)

    return _with_audits(rows, reports).mapInArrow(write, "conv_id long, place long, edit string, role string, text string")


def digests(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """The reports with ``repaired_sha256``: the repaired turns as ``role:text``,
    joined by newlines."""
    def write(batches):
        digest, first = hashlib.sha256(), True
        for out in _repaired(batches):
            got = []
            for head, edit, role, text in out:
                if edit is None:
                    got.append((*head, digest.hexdigest()))
                    digest, first = hashlib.sha256(), True
                else:
                    digest.update((f"{role}:{text}" if first else f"\n{role}:{text}").encode())
                    first = False
            yield _batch(got, [*REPORT, "repaired_sha256"], [*_REPORT_TYPES, pa.string()])

    return _with_audits(rows, reports).mapInArrow(
        write, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(table(spark, sf_dir, "conversations"))
    return digests(rows, materialised(report(rows), "repair-report"))
