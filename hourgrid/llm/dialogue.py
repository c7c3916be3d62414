"""Conversation structure repair: secondary-sorted streaming with a dynamic programme over roles.

A conversation is sound when its role initials read ``(s?(ua)+)?`` and no turn is blank, repeated or cut off.
Each turn is kept (0), gets another role (1) or goes (2); an empty turn may be put in anywhere (5). A blank or
repeated turn has to go, a truncated one that stays costs 5 more. Of the cheapest sequences of edits the one with the
ASCII-least initials (D, I, K, R) is taken.

1. Rows are dealt by conversation once. A window over (conversation, role and text) marks repeated turns; it needs no
   further shuffle, and no set of what was seen is held.
2. Within each partition rows are sorted by conversation and turn and streamed through ``mapInPandas``. The state of
   the programme goes from batch to batch: for each of four role states its cost over the cheapest and the rank of its edits
   among the four. A state that can never win is struck out, which bounds the costs; so there are few different states of
   the whole, and each (state, kind of turn) is worked out once a worker and then looked up.
3. A turn's backpointer is the number of that transition, four bytes. Turns and backpointers wait in memory up to
   ``HELD`` bytes; those of a larger conversation are spilled to a file in the shared folder, read backwards for the edits,
   forwards for the repaired turns, and deleted. Only the edits' initials, a byte a turn, are held whole.

Two sequences with equal costs and states after the same turns are compared as prefixes: both have as many letters other
than I, and end in one, so neither begins the other and the order of the whole is that of the prefixes.

Defined results: a null role or text is one blank (the turn is blank, the role fits no place); null turns come first; rows that
tie on the turn are ordered by role, then text; a null conversation id is a conversation of its own; a turn's role stays as
it is when kept, whatever follows its initial; a table without rows gives none. Further columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from array import array
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourgrid.llm.common import filesystem, open_output, table, use_workers
from hourgrid.session import scratch_path

#: Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
HELD = 32 << 20             # bytes of turns of a conversation that wait in memory
OUT = 4 << 20               # bytes of repaired turns of a batch
START, SYSTEM, USER, ASSISTANT = range(4)
#: The role that a new or renamed turn gets after each state, and the state it leads to.
NEXT = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
#: Kinds of turns: the initial's place in "sua" (3: another) plus 4 if truncated; GONE if it has to go.
GONE = 8
#: How far a state's cost may be over that of another before it can no longer win: (better, worse) states.
SLACK = {
    (START, SYSTEM): 0, (START, USER): INSERT, (START, ASSISTANT): 0,
    (ASSISTANT, START): DELETE, (ASSISTANT, SYSTEM): 0, (ASSISTANT, USER): INSERT, (USER, ASSISTANT): INSERT,
}
BLANKS = "\t\n\x0b\x0c\r "


def _kept(state: int, kind: int) -> int | None:
    """The state after a turn that is kept with its role."""
    initial = kind & 3
    if initial == 0:
        return SYSTEM if state == START else None
    if initial == 1:
        return USER if state != USER else None
    return ASSISTANT if initial == 2 and state == USER else None


class Programme:
    """The programme's transitions, each worked out when first met.

    A state of the whole is a tuple of (cost over the cheapest, rank) or None by role state.
    """

    def __init__(self):
        self.known: dict[tuple, int] = {}
        self.wholes: list[tuple] = []
        self.moves: dict[tuple[int, int], tuple[int, int, int]] = {}
        self.back: list[tuple] = []         # by transition: by role state (role state before, letters)
        self.first = self._number(((0, 0), None, None, None))

    def _number(self, whole: tuple) -> int:
        if whole not in self.known:
            self.known[whole] = len(self.wholes)
            self.wholes.append(whole)
        return self.known[whole]

    def step(self, number: int, kind: int) -> tuple[int, int, int]:
        """(number of the next whole, cost added, transition)."""
        found = self.moves.get((number, kind))
        if found is None:
            found = self.moves[number, kind] = self._work_out(self.wholes[number], kind)
        return found

    def _work_out(self, whole: tuple, kind: int) -> tuple[int, int, int]:
        best: dict[int, tuple] = {}
        more = TRUNCATED if kind != GONE and kind & 4 else 0
        for before, held in enumerate(whole):
            if held is None:
                continue
            cost, rank = held
            state = before
            for inserts in range(3):        # after two more, the same states come again
                ways = [("D", DELETE, state)]
                if kind != GONE:
                    ways.append(("R", REROLE + more, NEXT[state][1]))
                    after = _kept(state, kind)
                    if after is not None:
                        ways.append(("K", more, after))
                for letter, own, after in ways:
                    way = (cost + INSERT * inserts + own, rank, "I" * inserts + letter, before)
                    if after not in best or way < best[after]:
                        best[after] = way
                state = NEXT[state][1]
        least = min(way[0] for way in best.values())
        order = sorted((way[1], way[2], after) for after, way in best.items())
        ranks = {after: k for k, (_, _, after) in enumerate(order)}
        lost = {b for (a, b), slack in SLACK.items() if a in best and b in best and best[b][0] > best[a][0] + slack}
        alive = {after: way for after, way in best.items() if after not in lost}
        after = tuple((alive[s][0] - least, ranks[s]) if s in alive else None for s in range(4))
        self.back.append(tuple((best[s][3], best[s][2]) if s in best else None for s in range(4)))
        return self._number(self._ranked(after)), least, len(self.back) - 1

    @staticmethod
    def _ranked(whole: tuple) -> tuple:
        """Ranks without gaps, so that equal situations are one."""
        order = sorted(held[1] for held in whole if held is not None)
        return tuple(None if held is None else (held[0], order.index(held[1])) for held in whole)

    def finish(self, number: int) -> tuple[int, int, str]:
        """(cost added, role state, letters at the end) of the best end."""
        ends = {START: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}
        ways = [(held[0] + INSERT * len(ends[s]), held[1], s) for s, held in enumerate(self.wholes[number]) if held is not None]
        cost, _, state = min(ways)
        return cost, state, ends[state]


_PROGRAMME: list[Programme] = []


def programme() -> Programme:
    """The worker's transitions."""
    if not _PROGRAMME:
        _PROGRAMME.append(Programme())
    return _PROGRAMME[0]


class Turns:
    """Turns and backpointers of one conversation in order; in a file beyond ``held`` bytes."""

    SCHEMA = pa.schema([("role", pa.string()), ("text", pa.large_string()), ("move", pa.uint32())])

    def __init__(self, folder: str, held: int):
        self.folder, self.limit = folder, held
        self.path = self.stream = self.writer = None
        self._clear()

    def _clear(self) -> None:
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.moves = array("I")
        self.size = 0

    def add(self, role: str, text: str, move: int) -> None:
        self.roles.append(role)
        self.texts.append(text)
        self.moves.append(move)
        self.size += len(role) + len(text) + 120
        if self.size > self.limit:
            self._spill()

    def _spill(self) -> None:
        if self.writer is None:
            self.path = f"{self.folder}/turns-{uuid.uuid4().hex}.arrow"
            self.stream = open_output(self.path)
            self.writer = pa.ipc.new_file(self.stream, self.SCHEMA)
        self.writer.write_batch(pa.record_batch([pa.array(self.roles, pa.string()), pa.array(self.texts, pa.large_string()), pa.array(self.moves, pa.uint32())], schema=self.SCHEMA))
        self._clear()

    def chunks(self, backwards: bool = False) -> Iterator[tuple[list[str], list[str], list[int]]]:
        """(roles, texts, moves) of the stored parts and of what is in memory; backwards only the moves are read."""
        own = (self.roles, self.texts, self.moves.tolist())
        if self.writer is None:
            yield own
            return
        if self.stream is not None:
            self.writer.close()
            self.stream.close()
            self.stream = None
        fs, name = filesystem(self.path)
        if backwards:
            yield own
        with fs.open_input_file(name) as file:
            reader = pa.ipc.open_file(file, options=pa.ipc.IpcReadOptions(included_fields=[2] if backwards else None))
            for k in range(reader.num_record_batches)[:: -1 if backwards else 1]:
                batch = reader.get_batch(k)
                yield ([], [], batch.column(0).to_pylist()) if backwards else tuple(batch.column(c).to_pylist() for c in range(3))
        if not backwards:
            yield own

    def close(self) -> None:
        if self.path is not None:
            if self.stream is not None:
                self.writer.close()
                self.stream.close()
            fs, name = filesystem(self.path)
            fs.delete_file(name)
            self.path = None


class Conversation:
    """What is known of the conversation that is being streamed."""

    def __init__(self, key: str, folder: str, held: int):
        self.key = key
        self.turns = Turns(folder, held)
        self.plan = programme()
        self.number, self.cost = self.plan.first, 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.initial: str | None = None
        self.first_turn = self.last_turn = None
        self.distinct = 0

    def add(self, role: str, text: str, turn: int | None, repeated: bool) -> None:
        last = text.rstrip(BLANKS)[-1:]
        fault = "blank" if not last else "duplicate" if repeated else "truncated" if last not in ".!?" else None
        initial = role[:1]
        kind = GONE if fault in ("blank", "duplicate") else (place if (place := "sua".find(initial or "-")) >= 0 else 3) + 4 * (fault == "truncated")
        if fault:
            self.faults[fault] += 1
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.faults["illegal"] += 1
        self.initial = initial
        if turn is not None:
            self.distinct += turn != self.last_turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        self.number, cost, move = self.plan.step(self.number, kind)
        self.cost += cost
        self.turns.add(role, text, move)

    def audit(self) -> str:
        cost, state, end = self.plan.finish(self.number)
        self.cost += cost
        letters = [end]
        for _, _, moves in self.turns.chunks(backwards=True):
            for move in reversed(moves):
                state, suffix = self.plan.back[move][state]
                letters.append(suffix)
        return "".join(reversed(letters))

    def repaired(self, audit: str) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of the turns that the conversation has afterwards."""
        state, at = START, 0
        for roles, texts, _ in self.turns.chunks():
            for role, text in zip(roles, texts):
                while audit[at] == "I":
                    new, state = NEXT[state]
                    yield "I", new, ""
                    at += 1
                edit = audit[at]
                at += 1
                if edit == "R":
                    role, state = NEXT[state]
                elif edit == "K":
                    state = _kept(state, "sua".find(role[:1]))
                if edit != "D":
                    yield edit, role, text
        for _ in audit[at:]:
            new, state = NEXT[state]
            yield "I", new, ""

    def gaps(self) -> int:
        return 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.distinct


REPORT = "key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
TURNS = "key string, place long, edit string, role string, text string"


def _stream(folder: str, held: int, as_turns: bool):
    """A row of each conversation, or a row of each turn it has after the repair."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in (TURNS if as_turns else REPORT).split(", ")]
        out: list[tuple] = []
        size = 0
        now: Conversation | None = None

        def end() -> Iterator[tuple]:
            try:
                audit = now.audit()
                if as_turns:
                    for place, (edit, role, text) in enumerate(now.repaired(audit)):
                        yield now.key, place, edit, role, text
                    return
                digest, first = hashlib.sha256(), True
                for _, role, text in now.repaired(audit):
                    digest.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
                    first = False
                f = now.faults
                yield now.key, now.gaps(), f["blank"], f["duplicate"], f["truncated"], f["illegal"], now.cost, audit, digest.hexdigest()
            finally:
                now.turns.close()

        try:
            for frame in frames:
                columns = [frame[c].tolist() for c in ("key", "role", "text", "turn", "numbered", "repeated")]
                for key, role, text, turn, numbered, repeated in zip(*columns):
                    if now is None or now.key != key:
                        if now is not None:
                            for row in end():
                                out.append(row)
                                size += 200 + sum(len(x) for x in row if isinstance(x, str))
                                if size > OUT:
                                    yield pd.DataFrame(out, columns=names)
                                    out, size = [], 0
                        now = Conversation(key, folder, held)
                    now.add(role, text, int(turn) if numbered else None, repeated)
            if now is not None:
                for row in end():
                    out.append(row)
                    size += 200 + sum(len(x) for x in row if isinstance(x, str))
                    if size > OUT:
                        yield pd.DataFrame(out, columns=names)
                        out, size = [], 0
            if out:
                yield pd.DataFrame(out, columns=names)
        finally:
            if now is not None:
                now.turns.close()

    return run


def _key(conv: Column) -> Column:
    """A text that is never null: a null id has a key of its own."""
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit(""))


def _ordered(df: DataFrame, conv: str, turn: str, role: str, text: str, order: list[str]) -> DataFrame:
    """Rows by conversation and turn within partitions, repeated ones marked."""
    filled = lambda c: F.coalesce(df[c], F.lit(" "))
    rows = df.select(
        _key(df[conv]).alias("key"), F.coalesce(df[turn].cast("long"), F.lit(0)).alias("turn"), df[turn].isNotNull().alias("numbered"),
        filled(role).alias("role"), filled(text).alias("text"), *[df[c].alias(f"by{k}") for k, c in enumerate(order)],
    )
    ties = [f"by{k}" for k in range(len(order))] or ["role", "text"]
    dealt = rows.withColumn("said", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)).repartition("key")
    seen = Window.partitionBy("key", "said").orderBy("numbered", "turn", *ties)
    marked = dealt.withColumn("repeated", F.row_number().over(seen) > 1)
    return marked.sortWithinPartitions("key", "numbered", "turn", *ties).select("key", "role", "text", "turn", "numbered", "repeated")


def _run(df, conv, turn, role, text, order, held, as_turns):
    use_workers(df.sparkSession)
    rows = _ordered(df, conv, turn, role, text, list(order))
    folder = scratch_path(df.sparkSession, "turns")
    out = rows.mapInPandas(_stream(folder, held, as_turns), TURNS if as_turns else REPORT)
    kind = df.schema[conv].dataType
    own = F.when(F.col("key") != "", F.expr("substring(key, 2)")).cast(kind)
    return out.select(own.alias("conv_id"), *[c for c in out.columns if c != "key"])


def report(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", order: tuple[str, ...] = (), held: int = HELD
) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of each conversation.

    ``order`` names columns that order rows of the same turn, instead of role and text.
    """
    return _run(df, conv, turn, role, text, order, held, False)


def repaired(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", order: tuple[str, ...] = (), held: int = HELD
) -> DataFrame:
    """(conv_id, place, edit, role, text): the turns of each conversation after the repair, from place 0."""
    return _run(df, conv, turn, role, text, order, held, True)


def damaged(df: DataFrame) -> DataFrame:
    """Conversations with planted faults by crc32 of ``conv_id:turn``, and what they tie on: (conv_id, turn, role, text, first, second).

    Of twenty remainders: 0 drops the row, 1 empties its text, 2 takes its ends of sentences, 3 repeats it, 4 makes it the user's.
    """
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    fate = F.crc32(F.encode(F.concat(blank(df.conv_id), F.lit(":"), blank(df.turn)), "UTF-8")) % 20
    role, text = blank(df.role), blank(df.text)
    rows = df.select("conv_id", "turn", role.alias("first"), text.alias("second"), fate.alias("fate")).filter("fate <> 0")
    once = F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("first")).alias("role"),
        F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("second", ".!?", "")).otherwise(F.col("second")).alias("text"),
        "first", "second", F.explode(once).alias("again"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and repaired."""
    given = table(spark, sf_dir, "conversations")
    found = report(damaged(given), order=("first", "second", "again"))
    ids = given.select(F.col("conv_id").alias("id")).distinct()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return ids.join(found, ids.id.eqNullSafe(found.conv_id), "left").select(
        F.col("id").alias("conv_id"), *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
