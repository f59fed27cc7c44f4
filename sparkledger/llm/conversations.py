"""Repairing the structure of conversations at the least cost.

A conversation may begin with a system turn and then alternates between user and assistant, ending with the
latter; it may also be empty.  Edits keep, re-role, delete or insert turns.  The cheapest edits are a shortest
path through a graph whose nodes are (rows read, state of that grammar).  A path's weight is one integer: its
cost is in the high digits, and below it the letters of its audit stand at fixed places, first letter first,
the unused ones zero at the end.  So a plain minimum of integers decides by cost and then by the audit in
ASCII order; of two paths to a node with equal costs neither audit is the beginning of the other, so letters
to come never change that decision.

Rows of a conversation come sorted, as a stream.  Letters on which all live paths agree are settled, written
out and shifted away, with the rows they concern, so a worker holds the undecided end of a conversation only,
however long that is.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sparkledger.llm import common

#: Costs of edits, and the digit of each edit's initial in ASCII order.
REROLE, DELETE, INSERT, TRUNCATED_KEPT = 2, 3, 2, 1
DIGITS = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTERS = {d: c for c, d in DIGITS.items()}
#: State of the grammar, then initial, to the next state. An end is possible in ``ENDS``.
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
STEPS = {START: {"s": AFTER_SYSTEM, "u": AFTER_USER}, AFTER_SYSTEM: {"u": AFTER_USER}, AFTER_USER: {"a": AFTER_ASSISTANT}, AFTER_ASSISTANT: {"u": AFTER_USER}}
ENDS = (START, AFTER_ASSISTANT)
#: Initial and role that a turn which is inserted or gets another role has in each state.
TURN_FOR = {START: ("u", "user"), AFTER_SYSTEM: ("u", "user"), AFTER_USER: ("a", "assistant"), AFTER_ASSISTANT: ("u", "user")}
#: Adjacent initials that may follow each other.
LEGAL = {"su", "ua", "au"}
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
#: From any state at most two insertions lead to AFTER_ASSISTANT, and from there what another state would do costs at most three more.
WITHIN = 2 * INSERT + DELETE
#: Bits of a digit; rows after which agreed letters are settled.
DIGIT, BLOCK = 3, 64
_BLANKS = " \t\n\x0b\x0c\r"


class Repair:
    """The cheapest edits of one conversation whose rows are pushed in order; ``turn`` is called with each repaired role and text."""

    def __init__(self, turn):
        self.turn, self.pending, self.audit = turn, deque(), []
        self.places = 4 * BLOCK
        self.paths = {START: (0, 0)}  # state to weight and number of letters
        self.base, self.rows = START, 0

    def _longer(self, path: tuple[int, int], letter: str, cost: int) -> tuple[int, int]:
        weight, n = path
        return weight + (cost << DIGIT * self.places) + (DIGITS[letter] << DIGIT * (self.places - n - 1)), n + 1

    def _insert(self) -> None:
        """Insertions before the next row: a user turn from any other state, then an assistant's; more never pay."""
        for state in (START, AFTER_SYSTEM, AFTER_ASSISTANT, AFTER_USER):
            if state in self.paths:
                self._offer(self.paths, STEPS[state][TURN_FOR[state][0]], self._longer(self.paths[state], "I", INSERT))

    @staticmethod
    def _offer(paths: dict, state: int, path: tuple[int, int]) -> None:
        if state not in paths or path < paths[state]:
            paths[state] = path

    def push(self, role: str, text: str, fault: int) -> None:
        self.pending.append((role, text))
        self._insert()
        after: dict[int, tuple[int, int]] = {}
        late = TRUNCATED_KEPT if fault == TRUNCATED else 0
        for state, path in self.paths.items():
            self._offer(after, state, self._longer(path, "D", DELETE))
            if fault in (BLANK, DUPLICATE):
                continue
            if role[:1] in STEPS[state]:
                self._offer(after, STEPS[state][role[:1]], self._longer(path, "K", late))
            self._offer(after, STEPS[state][TURN_FOR[state][0]], self._longer(path, "R", REROLE + late))
        self.paths = after
        self.rows += 1
        if self.rows % BLOCK == 0:
            self._settle()

    def _settle(self) -> None:
        """Drops paths that can win no more, takes out the letters that the others share, and makes room for those of the next block."""
        least = min(weight for weight, _ in self.paths.values()) >> DIGIT * self.places
        self.paths = {state: path for state, path in self.paths.items() if path[0] >> DIGIT * self.places <= least + WITHIN}
        paths, low = list(self.paths.values()), (1 << DIGIT * self.places) - 1
        differ = 0
        for weight, _ in paths:
            differ |= (weight ^ paths[0][0]) & low
        shared = min(min(n for _, n in paths), self.places - -(-differ.bit_length() // DIGIT))
        self._write(paths[0][0], shared)
        wider = max(0, max(n for _, n in paths) - shared + 4 * BLOCK - self.places)

        def shifted(weight: int) -> int:
            return ((weight >> DIGIT * self.places << DIGIT * self.places) | (weight << DIGIT * shared & low)) << DIGIT * wider

        self.paths = {state: (shifted(weight), n - shared) for state, (weight, n) in self.paths.items()}
        self.places += wider

    def _write(self, weight: int, n: int) -> None:
        """Carries out the first n letters of a path."""
        for k in range(n):
            letter = LETTERS[weight >> DIGIT * (self.places - k - 1) & 7]
            self.audit.append(letter)
            role, text = ("", "") if letter == "I" else self.pending.popleft()
            if letter == "D":
                continue
            if letter != "K":
                role = TURN_FOR[self.base][1]
            self.base = STEPS[self.base][role[0]]
            self.turn(role, text)

    def finish(self) -> tuple[int, str]:
        """Cost and audit."""
        self._insert()
        weight, n = min(self.paths[s] for s in ENDS if s in self.paths)
        self._write(weight, n)
        return weight >> DIGIT * self.places, "".join(self.audit)


class _Conversation:
    """What is told of one conversation, from its sorted rows."""

    def __init__(self, conv, keep: bool):
        self.conv, self.turns, self.place = conv, [] if keep else None, 0
        self.sha, self.first = hashlib.sha256(), True
        self.repair = Repair(self._turn)
        self.faults = [0, 0, 0, 0]
        self.illegal = self.distinct = 0
        self.initial = self.low = self.high = None

    def _turn(self, role: str, text: str) -> None:
        if self.turns is not None:
            self.turns.append((self.conv, self.place, role, text))
            self.place += 1
        self.sha.update(("" if self.first else "\n").encode() + role.encode() + b":" + text.encode())
        self.first = False

    def push(self, turn, role: str, text: str, fault: int) -> None:
        if turn is not None:
            self.distinct += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.illegal += self.initial is not None and self.initial + role[:1] not in LEGAL
        self.initial = role[:1]
        self.faults[fault] += 1
        self.repair.push(role, text, fault)

    def summary(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        cost, audit = self.repair.finish()
        return self.conv, gaps, *self.faults[1:], self.illegal, cost, audit, self.sha.hexdigest()


SUMMARY = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
TURNS = "conv_id long, place long, role string, text string"


def damage(table: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and gone of conversations damaged by crc32 of conv_id:turn modulo 20; nulls read as one space.

    0 drops a row (it stays here, marked gone), 1 empties its text, 2 takes its sentence ends, 3 repeats it, 4 makes it the user's.
    """
    blank = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = table.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), (F.crc32(name.cast("binary")) % 20).alias("_k"))
    rows = rows.withColumns({
        "text": F.when(F.col("_k") == 1, "").when(F.col("_k") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")),
        "role": F.when(F.col("_k") == 4, "user").otherwise(F.col("role")), "gone": F.col("_k") == 0,
    })
    return rows.withColumn("_n", F.explode(F.sequence(F.lit(1), F.when(F.col("_k") == 3, 2).otherwise(1)))).select("conv_id", "turn", "role", "text", "gone")


def faults(rows: DataFrame) -> DataFrame:
    """Adds fault, a row's first of blank, duplicate (role and text were there before) and truncated; a row marked gone has none."""
    end = F.rtrim(F.col("text"), F.lit(_BLANKS))
    # Rows with equal role and text are alike, so any order of those with one turn will do.
    before = F.row_number().over(Window.partitionBy("conv_id", "gone", "role", "text").orderBy(F.asc_nulls_first("turn"))) > 1
    found = F.when(F.col("gone"), NONE).when(end == "", BLANK).when(before, DUPLICATE).when(~F.substring(end, -1, 1).isin(".", "!", "?"), TRUNCATED)
    return rows.withColumn("fault", F.coalesce(found, F.lit(NONE)))


def repair(rows: DataFrame, turns: bool = False) -> DataFrame:
    """Repairs conversations (conv_id, turn, role, text; optional gone, for rows that only say that their conversation exists).

    One row for each conversation: its gaps, faults, illegal neighbours, the cost and audit of the cheapest edits, and the
    SHA-256 of the repaired lines ``role:text``; with ``turns`` the repaired turns instead (conv_id, place, role, text).
    Rows are in order of turn, nulls first, then of role and text.  Null roles and texts are one space; a role that is
    empty or begins with another letter is never kept as it is.  A null conv_id is a conversation like any other.  Other
    columns are passed over.  An empty table gives none.
    """
    gone = F.col("gone") if "gone" in rows.columns else F.lit(False)
    rows = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), gone.alias("gone"))
    width = common.shuffle_width(rows.sparkSession)
    dealt = faults(rows).repartition(width, "conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())] if turns else [
        *[(n, pa.int64()) for n in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)

    def work(batches: Iterator[pa.RecordBatch]):
        now, out = None, []

        def close() -> list[tuple]:
            told = now.summary()
            return now.turns if turns else [told]

        for batch in batches:
            for conv, turn, role, text, gone, fault in zip(*[c.to_pylist() for c in batch.columns]):
                if now is None or now.conv != conv:
                    out += close() if now is not None else []
                    now = _Conversation(conv, turns)
                if not gone:
                    now.push(turn, role, text, fault)
                if turns and len(now.turns) >= 1000:
                    out, now.turns = out + now.turns, []
                if len(out) >= 1000:
                    yield batch_of(out)
                    out = []
        out += close() if now is not None else []
        if out:
            yield batch_of(out)

    return dealt.select("conv_id", "turn", "role", "text", "gone", "fault").mapInArrow(work, TURNS if turns else SUMMARY)
