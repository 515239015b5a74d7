"""Conversation structure repair with scalar big-integer weights.

Rows of a conversation are kept, reroled, deleted, and empty rows inserted, so that the role
initials read ``(s?(ua)+)?`` at the least cost; among the cheapest edits the ASCII-least
audit string wins.  Both wishes are one integer: the high digits carry the cost, below
them ``3 n + 2`` octal digits hold the audit letters by position (D=1, I=2, K=3, R=4, in ASCII order),
with zeros after the end, so that a shorter audit sorts before its extensions.  Going
from the last row to the first, an edit puts its letter before the rest: it adds to the
cost, shifts the letters one digit down and sets the top digit.  Shifting keeps the order
of any two rests, so the integer minimum over the states (start, after s, after u, after a)
at each row is right for the whole, and the number at the first row holds cost and audit.
Between two rows at most two inserts can pay, hence the width.

Spark deals rows by conversation twice.  First without texts (turn, role initial, digest,
faults): a task streams sorted rows and keeps a byte and a digest a row of one conversation.
Then audit and texts meet: a task walks through the rows and feeds a running SHA-256.  A
conversation is one audit string and one running hash, hence one task's work; the integer
grows with its rows, so its time is quadratic in them (half a second for 4,000 rows, 5 s for 16,000).

Edits: Keep 0, Rerole to user or assistant 1, Delete 2 (required for blank and duplicate rows),
Insert an empty user or assistant row 5; a truncated row that is not deleted adds 5.

Faults, the first counts: blank (no ``[^\\x20\\x09-\\x0D]``), duplicate (role and text seen earlier),
truncated (last such character is none of ``.!?``).

Defined cases: a null role or text is one space, a null conv_id is a conversation of its
own; rows of one turn are ordered by role, then MD5 of the text, null turns come first; a role
without characters has no initial, it can't be kept; extra columns are ignored; a
conversation without rows (all dropped) gives zeros, an empty audit and the hash of the
empty text; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import cut_lineage

INSERT, TRUNCATED = 5, 5
_DELETE, _INSERT, _KEEP, _REROLE = 1, 2, 3, 4  # octal digits in the letters' ASCII order
_LETTERS = str.maketrans("1234", "DIKR")
START, SYSTEM, USER, ASSISTANT = 0, 1, 2, 3     # states: what was written last
KEPT = [{"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER}]
TURN_TO = [USER, USER, ASSISTANT, USER]
FREE, BROKEN, MUST_GO = 0, 1, 2                 # a row's faults as far as edits go: none, truncated, blank or duplicate


def cheapest(rows: Iterable[tuple[str, int]], n: int) -> tuple[int, str]:
    """(cost, audit) of the least edits.  ``rows``: (initial, fault) from the LAST of n rows to the first."""
    digits = 3 * n + 2
    width, top = 3 * digits, 3 * (digits - 1)
    letters = (1 << width) - 1

    def put(rest: int | None, letter: int, cost: int) -> int | None:
        if rest is None:
            return None
        low = rest & letters
        return (rest ^ low) + (cost << width) + (letter << top) + (low >> 3)

    def least(*options: int | None) -> int | None:
        return min((o for o in options if o is not None), default=None)

    def inserted(w: list[int | None]) -> list[int | None]:
        """States before the inserts that may stand here."""
        user, answer = put(w[USER], _INSERT, INSERT), put(w[ASSISTANT], _INSERT, INSERT)
        both = put(answer, _INSERT, INSERT)
        return [least(w[START], user, both), least(w[SYSTEM], user, both), least(w[USER], answer), least(w[ASSISTANT], user)]

    w = inserted([0, None, None, 0])
    for initial, fault in rows:
        extra, new = TRUNCATED * (fault == BROKEN), []
        for state in range(4):
            best = put(w[state], _DELETE, 2)
            if fault != MUST_GO:
                kept = KEPT[state].get(initial)
                if kept is not None:
                    best = least(best, put(w[kept], _KEEP, extra))
                if kept != TURN_TO[state]:
                    best = least(best, put(w[TURN_TO[state]], _REROLE, 1 + extra))
            new.append(best)
        w = inserted(new)
    return w[START] >> width, format(w[START] & letters, f"0{digits}o").rstrip("0").translate(_LETTERS)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults made by the CRC-32 of 'conv_id:turn': (conv_id, turn, role, text, times);
    times 0 is a dropped row, 2 a repeated one."""
    part = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                            F.coalesce(F.col("turn").cast("string"), F.lit(" "))).cast("binary")) % 20
    text = F.coalesce(F.col("text"), F.lit(" "))
    return conversations.select("conv_id", "turn", "role", text.alias("text"), part.alias("part")).select(
        "conv_id", "turn",
        F.when(F.col("part") != 0, F.when(F.col("part") == 4, F.lit("user")).otherwise(F.coalesce("role", F.lit(" ")))).alias("role"),
        F.when(F.col("part") == 0, F.lit(None)).when(F.col("part") == 1, F.lit(""))
        .when(F.col("part") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("part") == 0, 0).when(F.col("part") == 3, 2).otherwise(1).alias("times"))


def _conversations(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """(conv_id, its rows) over sorted batches whose first column is conv_id; the rows must be
    read before the next conversation is asked for."""
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    row = next(rows, None)

    def same(conv) -> Iterator[tuple]:
        nonlocal row
        while row is not None and row[0] == conv:
            yield row
            row = next(rows, None)

    while row is not None:
        yield row[0], same(row[0])


def _per_conversation(result: Callable[[Iterator[tuple]], tuple], names: list[str]):
    """Task function for sorted rows: one output row per conversation."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return

        def batch(convs: list, out: list[tuple]) -> pa.RecordBatch:
            cols = [pa.array(c, pa.string() if isinstance(c[0], str) else pa.int64()) for c in zip(*out)]
            return pa.RecordBatch.from_arrays([pa.array(convs, first.schema.field(0).type), *cols], names=["conv_id", *names])

        convs, out = [], []
        for conv, group in _conversations(chain([first], batches)):
            out.append(result(group))
            convs.append(conv)
            if len(out) == 4096:
                yield batch(convs, out)
                convs, out = [], []
        if out:
            yield batch(convs, out)

    return run


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _plan(group: Iterator[tuple]) -> tuple:
    """Rows (conv_id, turn, times, initial, same, blank, open) of a conversation -> its counts and audit."""
    initials, faults, seen = [], bytearray(), set()
    count = dict.fromkeys(_COUNTS, 0)
    first = last = None
    turns = 0
    for _, turn, times, initial, same, blank, open_ in group:
        for _ in range(times):
            if turn is not None and turn != last:
                first, last, turns = turn if first is None else first, turn, turns + 1
            if initials and initials[-1] + initial not in ("su", "ua", "au"):
                count["illegal"] += 1
            fault = "blank" if blank else "duplicate" if same in seen else "truncated" if open_ else None
            seen.add(same)
            if fault:
                count[fault] += 1
            initials.append(initial)
            faults.append(FREE if fault is None else BROKEN if fault == "truncated" else MUST_GO)
    if turns:
        count["gaps"] = last - first + 1 - turns
    count["cost"], audit = cheapest(zip(reversed(initials), reversed(faults)), len(initials))
    return (*count.values(), audit)


def _repair(group: Iterator[tuple]) -> tuple:
    """The audit row of a conversation, then its rows -> counts, audit and the hash of the repaired text."""
    head = next(group)
    edits, state, sha, some = iter(head[1]), START, hashlib.sha256(), False

    def write(role: str, text: str, to: int) -> None:
        nonlocal state, some
        sha.update((("\n" if some else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        state, some = to, True

    def fresh(text: str) -> None:
        to = TURN_TO[state]
        write("assistant" if to == ASSISTANT else "user", text, to)

    for _, _, role, text, times, *_ in group:
        for _ in range(times):
            while (edit := next(edits)) == "I":
                fresh("")
            if edit == "R":
                fresh(text)
            elif edit == "K":
                write(role, text, KEPT[state][role[0]])
    for _ in edits:  # inserts after the last row
        fresh("")
    return (*head[5:], head[1], sha.hexdigest())


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of (conv_id, turn, role, text, times): gaps, blank, duplicate,
    truncated, illegal, cost, audit, repaired_sha256."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in _COUNTS)
    digest = F.unhex(F.md5(F.col("text").cast("binary")))
    narrow = rows.select(
        "conv_id", "turn", "role", digest.alias("digest"), "times", F.substring("role", 1, 1).alias("initial"),
        F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))).alias("same"),
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("open"))
    plans = narrow.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "digest") \
        .select("conv_id", "turn", "times", "initial", "same", "blank", "open") \
        .mapInArrow(_per_conversation(_plan, [*_COUNTS, "audit"]), f"conv_id {kind}, {counts}, audit string")
    heads = cut_lineage(plans).withColumn("lead", F.lit(0))
    both = heads.unionByName(rows.where("times > 0").select("conv_id", "turn", "role", "text", digest.alias("digest"), "times")
                             .withColumn("lead", F.lit(1)), allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "lead", "turn", "role", "digest") \
        .select("conv_id", "audit", "role", "text", "times", *_COUNTS) \
        .mapInArrow(_per_conversation(_repair, [*_COUNTS, "audit", "repaired_sha256"]),
                    f"conv_id {kind}, {counts}, audit string, repaired_sha256 string")


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """The contract's damage, then the repair, over all of ``conversations``."""
    return repair(damaged(conversations))
