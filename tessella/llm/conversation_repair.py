"""Conversation structure repair: cheapest edits by a Viterbi pass over chunks that run in parallel, stitched by rank convergence.

Roles of a repaired conversation alternate, user first, after a system row at most. A row is kept, given another role, or
deleted, and empty rows can be inserted; blank and repeated rows must go. Costs of the best way to the end, one for each of
four states, are carried backwards through the rows. A conversation is cut into chunks of bounded length. The costs behind a
chunk are unknown at first, so it starts from four speculative cost vectors, one a state: each has that state as cheap as
any true vector may have it, so that a true one is a smallest of shifted speculative ones. Where the four come out equal but
for constants, the chunk's result stands whatever lies behind it. Elsewhere fix-up passes go on from what the chunk behind
has, reaching twice as far each time, until the vectors differ only by constants or the end is met. Decisions compare costs
of one place, so constants do not matter; chunks trace their edits from all states, the states are stitched in the same way
from the front, and the edits are read off: the least letter that lies on a cheapest way, row by row.

Equal rows of one turn are one record with a count from the start; only the first of them can stay. Rows that share a turn
go by the SHA-256 of role and text. The digest of a conversation's text needs its rows in turn, so one task reads them as a
stream; all else is spread by chunk.

Defined cases: null roles and texts are one space, and so are null ids and turns in the damage; a null id is a conversation
of its own and a null turn comes first; an empty role has no initial, so it cannot be kept; repeated rows are duplicates;
a conversation may lose all its rows; texts of any length are read whole; other columns do not matter, whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACES, crc32_sql, discard, materialize

#: Fixed values: costs of the edits Keep, Rerole, Delete, Insert, and of a truncated row that stays.
RECAST, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: States: nothing yet, after a system row, after a user, after an assistant. Where the next user or assistant leads.
_ONWARD = (2, 2, 3, 2)
_KEEP = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "t": {}}
_NAMES = {2: "user", 3: "assistant"}
#: Costs at the end of a conversation: it may be empty or end with an assistant.
_END = (0, 2 * INSERT, INSERT, 0)
#: Records to a chunk, as a power of two.
CHUNK_BITS = 10
#: One letter a record: its initial (t: any other), a capital if truncated; digits for rows that must go, blank or repeated.
_LIVE, _BLANK, _AGAIN = "suat", "1234", "5678"


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: rows damaged by the CRC-32 of conversation and turn."""
    own = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))  # noqa: E731
    fate = F.crc32(F.concat(own("conv_id"), F.lit(":"), own("turn")).cast("binary")) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace(own("text"), "[.!?]", "")).otherwise(own("text"))
    role = F.when(fate == 4, "user").otherwise(own("role"))
    return rows.where(fate != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(fate == 3, 2).otherwise(1).alias("copies"))


def plain_rows(rows: DataFrame) -> DataFrame:
    own = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)  # noqa: E731
    return rows.select("conv_id", "turn", own("role"), own("text"), F.lit(1).alias("copies"))


def _mark(role: str = "role", text: str = "text") -> Column:
    return F.unhex(F.sha2(F.concat(F.length(role), F.lit(":"), role, text), 256))


def _code() -> Column:
    initial = F.substring("role", 1, 1)
    place = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(4)
    last = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    pick = lambda letters: F.substring(F.lit(letters), place, F.lit(1))  # noqa: E731
    return F.when(last == "", pick(_BLANK)).when(last.isin(".", "!", "?"), pick(_LIVE)).otherwise(pick(_LIVE.upper()))


# ---- costs of one chunk

@cache
def speculative() -> tuple[tuple[int, ...], ...]:
    """For each state the vector that has it at 0 and the others as high as they can be above it.

    The bounds hold for the costs of any suffix: an insertion leads on; what an assistant may be followed by may also begin
    a conversation or follow a system row; and a system row at the head can be deleted.
    """
    far = 99
    bound = [[0 if i == j else far for j in range(4)] for i in range(4)]
    for i in range(4):
        bound[i][_ONWARD[i]] = INSERT
    bound[0][3], bound[3][1], bound[3][0] = 0, 0, DELETE
    for k in range(4):
        for i in range(4):
            for j in range(4):
                bound[i][j] = min(bound[i][j], bound[i][k] + bound[k][j])
    return tuple(tuple(bound[i][j] for i in range(4)) for j in range(4))


@cache
def ways(code: str, after: tuple[int, ...]) -> tuple[list[int], list[int], list[int], list[int]]:
    """Costs from before a live record, for each state: by deleting, keeping, recasting it, and the least of all."""
    far, kept = 1 << 40, TRUNCATED * code.isupper()
    delete = [DELETE + x for x in after]
    keep = [kept + after[_KEEP[code.lower()][q]] if q in _KEEP[code.lower()] else far for q in range(4)]
    recast = [kept + RECAST + after[_ONWARD[q]] for q in range(4)]
    least = [min(x) for x in zip(delete, keep, recast, strict=True)]
    for _ in range(2):  # two insertions lead from any state to any that an insertion leads to
        least = [min(x, INSERT + least[_ONWARD[q]]) for q, x in enumerate(least)]
    return delete, keep, recast, least


@cache
def before(code: str, after: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    """The cost vector before a record, less its third part, and that part."""
    if not code.isalpha():
        return after, DELETE
    least = ways(code, after)[3]
    return tuple(x - least[2] for x in least), least[2]


@cache
def edits(code: str, after: tuple[int, ...], state: int) -> tuple[str, int, int]:
    """Letters, next state and cost of a record's cheapest edits, the least letters among equals; `after` as before() gives it."""
    if not code.isalpha():
        return "D", state, DELETE
    delete, keep, recast, least = ways(code, after)
    letters, cost = "", 0
    while least[state] != delete[state] and least[state] == INSERT + least[_ONWARD[state]]:
        letters, cost, state = letters + "I", cost + INSERT, _ONWARD[state]
    kept = TRUNCATED * code.isupper()
    if least[state] == delete[state]:
        return letters + "D", state, cost + DELETE
    if least[state] == keep[state]:
        return letters + "K", _KEEP[code.lower()][state], cost + kept
    return letters + "R", _ONWARD[state], cost + RECAST + kept


def matrix(codes: str) -> list[int]:
    """Row by row, costs before a chunk by state, from each of the speculative vectors behind it. Extra copies shift all alike."""
    now, sums = list(speculative()), [0] * 4
    for code in reversed(codes):
        step = before(code, now[0])
        if now[0] == now[1] == now[2] == now[3]:  # equal but for constants from here on
            now, sums = [step[0]] * 4, [x + step[1] for x in sums]
            continue
        for k in range(4):
            now[k], more = before(code, now[k])
            sums[k] += more
    return [now[k][q] + sums[k] for q in range(4) for k in range(4)]


def vectors(codes: str, end: tuple[int, ...]) -> list[tuple[int, ...]]:
    """The cost vector behind each record."""
    out, now = [], end
    for code in reversed(codes):
        out.append(now)
        now, _ = before(code, now)
    return out[::-1]


def traced(codes: str, copies: list[int], end: tuple[int, ...], last: bool, state: int) -> tuple[int, str, int]:
    """State behind a chunk, letters of its edits, cost. The last chunk also ends the conversation."""
    letters, cost = [], 0
    for code, n, after in zip(codes, copies, vectors(codes, end), strict=True):
        own, state, more = edits(code, after, state)
        letters.append(own if n == 1 else own + "D" * (n - 1))
        cost += more + DELETE * (n - 1)
    while last and state in (1, 2):
        letters.append("I")
        cost, state = cost + INSERT, _ONWARD[state]
    return state, "".join(letters), cost


def ends(codes: str, end: tuple[int, ...]) -> list[int]:
    """The state behind a chunk, for each state before it."""
    states = [0, 1, 2, 3]
    for code, after in zip(codes, vectors(codes, end), strict=True):
        states = [edits(code, after, q)[1] for q in states]
    return states


def counted(codes: str, copies: list[int]) -> tuple[int, int, int, int, str, str]:
    """Blank, repeated and truncated rows, illegal pairs of neighbours, and the first and last initial of a chunk."""
    blank = again = cut = illegal = 0
    who = [_LIVE[int(c) - 1 & 3] if c.isdigit() else c.lower() for c in codes]
    for k, (code, n) in enumerate(zip(codes, copies, strict=True)):
        illegal += n - 1 + (k > 0 and who[k - 1] + who[k] not in ("su", "ua", "au"))
        if code in _BLANK:
            blank += n
        else:
            again += n - (code not in _AGAIN)
            cut += code.isupper()
    return blank, again, cut, illegal, who[0], who[-1]


# ---- chunks as rows

def records(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, mark, code, n, at): equal rows counted, in order over all conversations."""
    counts = rows.select("conv_id", "turn", _mark().alias("mark"), _code().alias("code"), "copies").groupBy("conv_id", "turn", "mark", "code").agg(F.sum("copies").alias("n"))
    order = ["conv_id", "turn", "mark"]
    placed = materialize(counts.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()), "turns-sorted")
    part = F.shiftright("_id", 33)
    base = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))  # a row a partition
    base = base.withColumn("_base", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_part", "_base")
    at = F.col("_base") + F.col("_id") - F.shiftleft("_part", 33)
    return placed.join(F.broadcast(base), part == F.col("_part")).select("conv_id", "turn", "mark", "code", "n", at.alias("at"))


def _per_chunk(rows: DataFrame, inputs: list[str], work: Callable, schema: str, names: list[str]) -> DataFrame:
    """Each row's `inputs` through `work`, which gives the columns of `schema`; conv_id and chunk stay."""
    import pyarrow as pa

    conv = dict(rows.dtypes)["conv_id"]
    kinds = [pa.list_(pa.int64()) if "array" in c else pa.string() if "string" in c else pa.int64() for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 200):
                part = batch.slice(k, 200)
                out = list(zip(*[work(*row) for row in zip(*[c.to_pylist() for c in part.columns[2:]], strict=True)], strict=True))
                yield pa.RecordBatch.from_arrays([*part.columns[:2], *[pa.array(list(c), t) for c, t in zip(out, kinds, strict=True)]], names=["conv_id", "chunk", *names])

    return rows.select("conv_id", "chunk", *inputs).mapInArrow(run, f"conv_id {conv}, chunk long, {schema}")


def chunks(placed: DataFrame, bits: int = CHUNK_BITS) -> DataFrame:
    """(conv_id, chunk, codes, copies, ...): a conversation's records within each stretch of 2 ** bits places, repeats marked."""
    firsts = placed.where(~F.col("code").isin(list(_BLANK))).groupBy("conv_id", "mark").agg(F.min("at").alias("at"))
    own = placed.select("conv_id", F.shiftright("at", bits).alias("chunk"), F.struct("at", "code", "n").alias("record"), F.lit(None).cast("long").alias("first"))
    new = firsts.select("conv_id", F.shiftright("at", bits).alias("chunk"), F.lit(None).cast("struct<at:bigint,code:string,n:bigint>").alias("record"), F.col("at").alias("first"))
    held = own.unionByName(new).groupBy("conv_id", "chunk").agg(F.array_sort(F.collect_list("record")).alias("_held"), F.collect_list("first").alias("firsts"))
    parts = held.select("conv_id", "chunk", F.col("_held.at").alias("places"), F.array_join("_held.code", "").alias("written"), F.col("_held.n").alias("numbers"), "firsts")

    def mark(places: list[int], written: str, numbers: list[int], firsts: list[int]) -> tuple:
        new = set(firsts)
        codes = "".join([c if at in new or c in _BLANK else _AGAIN["suat".index(c.lower())] for c, at in zip(written, places, strict=True)])
        return (codes, numbers, *counted(codes, numbers))

    schema = "codes string, copies array<long>, blank long, duplicate long, truncated long, illegal long, head string, tail string"
    return _per_chunk(parts, ["places", "written", "numbers", "firsts"], mark, schema, ["codes", "copies", "blank", "duplicate", "truncated", "illegal", "head", "tail"])


def resolve(rows: DataFrame, step: int, edge: list[int], algebra: type) -> DataFrame:
    """(conv_id, chunk, value) from (conv_id, chunk, part): what each chunk makes of its neighbour's value, `step` away.

    A chunk whose part is settled has its value whatever its neighbour's. The others take the neighbour's value if it is
    there, else its part, and so reach twice as far in each pass; beyond a conversation's last chunk lies the edge.
    """
    names = ["part", "reach", "value"]
    schema = "part array<long>, reach long, value array<long>"

    def meet(part: list[int], reach: int, missing: bool, other: list[int] | None, further: int | None, value: list[int] | None) -> tuple:
        if missing or value is not None:
            return part, reach, algebra.apply(part, edge if missing else value)
        part = algebra.compose(part, other)
        return part, further, algebra.settled(part)

    begun = _per_chunk(rows, ["part"], lambda part: (part, None, algebra.settled(part)), schema, names)
    now = materialize(begun.withColumn("reach", F.col("chunk") + step), "chunk-parts")
    while not now.where("value is null").isEmpty():
        other = now.select(F.col("conv_id").alias("_conv"), F.col("chunk").alias("_chunk"), F.col("part").alias("_part"), F.col("reach").alias("_reach"), F.col("value").alias("_value"))
        met = now.where("value is null").join(other, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("reach") == F.col("_chunk")), "left")
        met = _per_chunk(met.withColumn("_missing", F.col("_chunk").isNull()), ["part", "reach", "_missing", "_part", "_reach", "_value"], meet, schema, names)
        after = materialize(now.where("value is not null").unionByName(met), "chunk-parts")
        discard(now)
        now = after
    return now.select("conv_id", "chunk", "value")


class Costs:
    """Parts are matrices, row by row; values are cost vectors, less their third part."""

    @staticmethod
    def apply(part: list[int], costs: list[int]) -> list[int]:
        out = [min(part[4 * q + k] + costs[k] for k in range(4)) for q in range(4)]
        return [x - out[2] for x in out]

    @staticmethod
    def compose(part: list[int], other: list[int]) -> list[int]:
        return [min(part[4 * q + k] + other[4 * k + j] for k in range(4)) for q in range(4) for j in range(4)]

    @staticmethod
    def settled(part: list[int]) -> list[int] | None:
        """The vector that all four are but for constants."""
        columns = [[part[4 * q + k] - part[8 + k] for q in range(4)] for k in range(4)]
        return columns[0] if all(c == columns[0] for c in columns) else None


class States:
    """Parts are the states that the four states lead to; a value is one state."""

    @staticmethod
    def apply(part: list[int], state: list[int]) -> list[int]:
        return [part[state[0]]]

    @staticmethod
    def compose(part: list[int], other: list[int]) -> list[int]:
        return [part[q] for q in other]

    @staticmethod
    def settled(part: list[int]) -> list[int] | None:
        return part[:1] if len(set(part)) == 1 else None


def _beside(rows: DataFrame, other: DataFrame, step: int) -> DataFrame:
    """Rows with the columns of the chunk `step` away, null where there is none."""
    renamed = other.select(F.col("conv_id").alias("_conv"), F.col("chunk").alias("_chunk"), *[c for c in other.columns if c not in ("conv_id", "chunk")])
    return rows.join(renamed, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("chunk") + step == F.col("_chunk")), "left").drop("_conv", "_chunk")


_SUMS = ["blank", "duplicate", "truncated", "illegal", "cost"]


def plan(rows: DataFrame, bits: int = CHUNK_BITS) -> DataFrame:
    """(conv_id, blank, duplicate, truncated, illegal, cost, audit, gaps) for each conversation with rows."""
    placed = materialize(records(rows), "turns")
    held = materialize(chunks(placed, bits), "turn-chunks")
    cut = held.groupBy("conv_id").agg(F.count("*").alias("_n")).where("_n > 1").select(F.col("conv_id").alias("_conv"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv"))

    trace = lambda codes, copies, end, last, state: traced(codes, copies, tuple(end), last, state)[1:]  # noqa: E731
    single = held.join(cut, same, "left_anti")
    done = _per_chunk(single, ["codes", "copies"], lambda codes, copies: trace(codes, copies, _END, True, 0), "audit string, cost long", ["audit", "cost"])

    many = materialize(held.join(cut, same, "left_semi"), "chunks-of-many")
    if not many.isEmpty():
        costs = resolve(_per_chunk(many, ["codes"], lambda codes: (matrix(codes),), "part array<long>", ["part"]), 1, list(_END), Costs)
        nexts = many.select("conv_id", "chunk", F.col("head").alias("_head")).join(costs.select(F.col("conv_id").alias("_conv"), F.col("chunk").alias("_own"), F.col("value").alias("end")), same & (F.col("chunk") == F.col("_own"))).drop("_conv", "_own")
        last = F.col("end").isNull()
        linked = _beside(many, nexts, 1).withColumn("last", last).withColumn("end", F.coalesce("end", F.array(*[F.lit(x).cast("long") for x in _END])))
        crossing = (~F.coalesce(F.concat("tail", "_head").isin("su", "ua", "au"), F.lit(True))).cast("long")
        many = materialize(linked.withColumn("illegal", F.col("illegal") + crossing).drop("_head"), "chunks-linked")
        states = resolve(_per_chunk(many, ["codes", "end"], lambda codes, end: (ends(codes, tuple(end)),), "part array<long>", ["part"]), -1, [0], States)
        led = _beside(many, states.select("conv_id", "chunk", F.col("value")[0].alias("state")), -1).withColumn("state", F.coalesce("state", F.lit(0)))
        done = done.unionByName(_per_chunk(led, ["codes", "copies", "end", "last", "state"], trace, "audit string, cost long", ["audit", "cost"]))
    counts = single.select("conv_id", "chunk", *_SUMS[:4]).unionByName(many.select("conv_id", "chunk", *_SUMS[:4]))
    parts = counts.withColumns({"cost": F.lit(0).cast("long"), "audit": F.lit(None).cast("string")}).unionByName(done.select("conv_id", "chunk", *[F.lit(0).cast("long").alias(c) for c in _SUMS[:4]], "cost", "audit"))
    letters = F.collect_list(F.when(F.col("audit").isNotNull(), F.struct("chunk", "audit")))
    whole = parts.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in _SUMS], letters.alias("_letters"))
    turns = placed.groupBy("conv_id", "turn").agg(F.count("*").alias("_n")).groupBy("conv_id").agg(F.min("turn").alias("_low"), F.max("turn").alias("_high"), F.count("turn").alias("_turns"))
    wide = lambda c: F.col(c).cast("decimal(20,0)")  # noqa: E731
    gaps = F.coalesce(wide("_high") - wide("_low") + 1 - F.col("_turns"), F.lit(0)).cast("long")
    turns = turns.select(F.col("conv_id").alias("_conv"), gaps.alias("gaps"))
    whole = whole.select("conv_id", *_SUMS, F.array_join(F.transform(F.array_sort("_letters"), lambda x: x["audit"]), "").alias("audit"))
    return whole.join(turns, same).drop("_conv")


# ---- rows in turn, with their edits

class Repair:
    """Rows of one conversation as they come, and what becomes of them."""

    def __init__(self, audit: str):
        self.audit, self.place, self.state = audit, 0, 0

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.place : self.place + 1] == "I":
            self.place += 1
            self.state = _ONWARD[self.state]
            yield _NAMES[self.state], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        letter = self.audit[self.place]
        self.place += 1
        if letter == "K":
            self.state = _KEEP[role[0]][self.state]
            yield role, text
        elif letter == "R":
            self.state = _ONWARD[self.state]
            yield _NAMES[self.state], text


_RESULT = ["gaps", *_SUMS, "audit"]


def _in_turn(rows: DataFrame, planned: DataFrame, every: DataFrame) -> DataFrame:
    """Each conversation's plan, then its rows, as one stream by partition; `every` names all conversations."""
    result = F.struct(*_RESULT).alias("result")
    nothing = lambda dtype: F.lit(None).cast(dtype)  # noqa: E731
    turn = dict(rows.dtypes)["turn"]
    kind = "struct<gaps:bigint,blank:bigint,duplicate:bigint,truncated:bigint,illegal:bigint,cost:bigint,audit:string>"
    heads = planned.select("conv_id", F.lit(0).alias("kind"), nothing(turn).alias("turn"), nothing("binary").alias("mark"), nothing("string").alias("role"), nothing("string").alias("text"), F.lit(1).alias("copies"), result)
    body = rows.select("conv_id", F.lit(1).alias("kind"), "turn", _mark().alias("mark"), "role", "text", F.col("copies").cast("int").alias("copies"), nothing(kind).alias("result"))
    names = every.select("conv_id").distinct().select("conv_id", F.lit(2).alias("kind"), nothing(turn).alias("turn"), nothing("binary").alias("mark"), nothing("string").alias("role"), nothing("string").alias("text"), F.lit(0).alias("copies"), nothing(kind).alias("result"))
    order = ["conv_id", "kind", "turn", "mark"]
    return heads.unionByName(body).unionByName(names).repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "kind", "role", "text", "copies", "result")


_NONE = dict.fromkeys(_RESULT, 0) | {"audit": ""}


def _walk(batches: Iterator, size: int = 500) -> Iterator[tuple]:
    """("open", conv_id, result), ("row", role, text) and ("close",) events of a partition's conversations."""
    at = object()
    repair = None
    for batch in batches:
        for k in range(0, batch.num_rows, size):  # few whole texts at a time
            part = batch.slice(k, size)
            for conv, kind, role, text, copies, result in zip(*[c.to_pylist() for c in part.columns], strict=True):
                if conv != at or repair is None:
                    if repair is not None:
                        yield from (("row", *x) for x in repair.inserted())
                        yield ("close",)
                    at, repair = conv, Repair(result["audit"] if kind == 0 else "")
                    yield "open", conv, result if kind == 0 else _NONE
                if kind == 1:
                    for _ in range(copies):
                        yield from (("row", *x) for x in repair.row(role, text))
    if repair is not None:
        yield from (("row", *x) for x in repair.inserted())
        yield ("close",)


def repair(rows: DataFrame, every: DataFrame | None = None, bits: int = CHUNK_BITS) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 for each conversation of `every`.

    `rows` hold conv_id, turn, role, text and copies (how often the row stands there), without null roles and texts.
    """
    import pyarrow as pa

    every = rows if every is None else every
    conv_type = dict(rows.dtypes)["conv_id"]
    stream = _in_turn(rows, materialize(plan(rows, bits), "turn-plans"), every)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        first, conv_kind = None, None

        def flush():
            columns = list(zip(*out, strict=True))
            out.clear()
            kinds = [conv_kind, *[pa.int64()] * 6, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names=["conv_id", *_RESULT, "repaired_sha256"])

        def watched():
            nonlocal conv_kind
            for batch in batches:
                conv_kind = batch.column(0).type
                yield batch

        for event in _walk(watched()):
            if event[0] == "open":
                conv, result, sha, first = event[1], event[2], hashlib.sha256(), True
            elif event[0] == "row":
                sha.update((("" if first else "\n") + event[1] + ":" + event[2]).encode())
                first = False
            else:
                out.append((conv, *[result[c] for c in _RESULT], sha.hexdigest()))
                if len(out) >= 1000:
                    yield flush()
        if out:
            yield flush()

    return stream.mapInArrow(digest, f"conv_id {conv_type}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")


def repaired_rows(rows: DataFrame, bits: int = CHUNK_BITS) -> DataFrame:
    """(conv_id, place, role, text): the conversations as they are after repair."""
    import pyarrow as pa

    conv_type = dict(rows.dtypes)["conv_id"]
    stream = _in_turn(rows, materialize(plan(rows, bits), "turn-plans"), rows)

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        kind = None

        def watched():
            nonlocal kind
            for batch in batches:
                kind = batch.column(0).type
                yield batch

        def flush():
            columns = list(zip(*out, strict=True))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (kind, pa.int64(), pa.string(), pa.string()), strict=True)], names=["conv_id", "place", "role", "text"])

        for event in _walk(watched()):
            if event[0] == "open":
                conv, place = event[1], 0
            elif event[0] == "row":
                out.append((conv, place, event[1], event[2]))
                place += 1
                if len(out) >= 500:
                    yield flush()
        if out:
            yield flush()

    return stream.mapInArrow(lay, f"conv_id {conv_type}, place long, role string, text string")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return repair(damage(rows), rows)


_INSERTED = "{{'c': {0}.c + 2, 'a': {0}.a || 'I'}}"
_LEAST = "list_min([{}])"


def _ways(state: str, letter: str, cost: str, when: str = "true") -> str:
    """A way into another state, as (cost, letters); far too dear where it is not open."""
    return f"{{'c': {state}.c + CASE WHEN {when} THEN {cost} ELSE 1000000000 END, 'a': {state}.a || '{letter}'}}"


def _oracle() -> str:
    """The forward pass over single rows: for each state the cheapest way into it, letters breaking ties."""
    closed2 = _LEAST.format(", ".join(["s2", *[_INSERTED.format(s) for s in ("s0", "s1", "s3")]]))
    closed3 = _LEAST.format("s3, " + _INSERTED.format("t2"))
    live, cut = "NOT (blank OR again)", "cut::BIGINT"
    keep = lambda s, who: _ways(s, "K", cut, f"{live} AND who = '{who}'")  # noqa: E731
    recast = lambda s: _ways(s, "R", f"2 + {cut}", live)  # noqa: E731
    after = [
        [_ways("s0", "D", "3")],
        [_ways("s1", "D", "3"), keep("s0", "s")],
        [_ways("t2", "D", "3"), *[f(s) for s in ("s0", "s1", "t3") for f in (lambda s: keep(s, "u"), recast)]],
        [_ways("t3", "D", "3"), keep("t2", "a"), recast("t2")],
    ]
    step = ", ".join(f"{_LEAST.format(', '.join(ways))} AS s{k}" for k, ways in enumerate(after))
    first = ", ".join(f"{{'c': {0 if k == 0 else 1_000_000_000}::BIGINT, 'a': ''}} AS s{k}" for k in range(4))
    shut = lambda rows: f"(SELECT *, {closed3} AS t3 FROM (SELECT *, {closed2} AS t2 FROM {rows}))"  # noqa: E731
    space = r"[^\x20\x09-\x0D]"
    return rf"""
WITH RECURSIVE f0 AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS f FROM conversations
), f1 AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role, CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN f = 3 THEN 2 ELSE 1 END)) AS copy FROM f0 WHERE f <> 0
), f2 AS (SELECT *, sha256(length(role) || ':' || role || text) AS mark, NOT regexp_matches(text, '{space}') AS blank,
  CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 't' END AS who FROM f1
), f3 AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, mark, copy) AS i, NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, mark, copy) > 1 AS again FROM f2
), r AS (SELECT *, NOT blank AND NOT again AND right(regexp_extract(text, '{space}[ 	-]*$')[1:1], 1) NOT IN ('.', '!', '?') AS cut, lag(who) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM f3
), w AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, {first} FROM r
  UNION ALL SELECT p.conv_id, r.i, {step} FROM {shut("w")} AS p JOIN r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i + 1
), best AS (
  SELECT conv_id, list_min([s0, t3]) AS b FROM {shut("w")} QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1
), letters AS (SELECT conv_id, unnest(string_split(b.a, '')) AS x, unnest(range(1, length(b.a) + 1)) AS place FROM best WHERE b.a <> ''
), placed AS (SELECT *, sum((x <> 'I')::INT) OVER (PARTITION BY conv_id ORDER BY place) AS i FROM letters
), output AS (
  SELECT l.conv_id, x, place, role, text, who, row_number() OVER (PARTITION BY l.conv_id ORDER BY place) AS o FROM placed l LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM l.conv_id AND r.i = l.i WHERE x <> 'D'
), headed AS (SELECT *, o - coalesce(bool_or(o = 1 AND x = 'K' AND who = 's') OVER (PARTITION BY conv_id), false)::INT AS nth FROM output
), written AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN x = 'K' THEN role ELSE CASE WHEN nth % 2 = 1 THEN 'user' ELSE 'assistant' END END || ':' || CASE WHEN x = 'I' THEN '' ELSE text END, chr(10) ORDER BY place)) AS sha FROM headed GROUP BY conv_id
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE again) AS duplicate, count(*) FILTER (WHERE cut) AS truncated,
         count(*) FILTER (WHERE before || who NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id
)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(b.c, 0)::BIGINT AS cost, coalesce(b.a, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN written s ON s.conv_id IS NOT DISTINCT FROM a.conv_id
"""


ORACLE = _oracle()
