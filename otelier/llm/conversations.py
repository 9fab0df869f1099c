"""Cheapest repairs of the turn structure of conversations.

Roles must read `(s?(ua)+)?` (system, user, assistant) and no turn may be blank or repeat an earlier one. Each row is
one symbol: the initial of its role and its first fault. An edit (keep, rerole, delete, insert) moves between four
states: start, after s, after u, after a; so a run of rows is a 4 x 4 matrix of the cheapest costs, each with the audit
(the initials of its edits) that is least in ASCII, and a longer run is a min-plus product. Among equal costs no audit
is the beginning of another, as equally many rows with one more insert cost more; so products keep the least audit.

Sequences are compressed by Re-Pair: frequent pairs of symbols become rules, shared by all conversations of a batch.
Each rule's matrix is computed once, from those of its two parts, with audits as ropes that share their parts.

Rows are sorted by range, also within a conversation, and cut into blocks of bounded length. Of each block only costs
and the order of its audits go to the place where the blocks of a conversation are chained, one pair of small matrices
per `BLOCK` rows. The chosen way through each block then goes back to its rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from otelier.llm.staging import staged

BLOCK = 1024
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

START, SYSTEM, USER, ASSISTANT = range(4)
_INITIALS = "sua"
OK, CUT_OFF, BLANK, DUPLICATE = range(4)
BLANKS = " \t\n\x0b\x0c\r"

#: What a kept row of a role leads to, and what an inserted or reroled one does.
_KEPT = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (ASSISTANT, 1): USER, (USER, 2): ASSISTANT}
_MADE = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
_MADE_ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Inserts that complete a conversation which ends in a state.
_TAIL = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}

_MODULUS = (1 << 61) - 1
_BASE = 0x5BD1E995A3C59AC5 % _MODULUS


class Ropes:
    """Audits as trees over shared parts. A 61-bit fingerprint tells equal parts without reading them."""

    def __init__(self):
        self.parts: list = []  # text of a leaf, or (left, right)
        self.size: list[int] = []
        self.print: list[int] = []
        self.power: dict[int, int] = {}
        self.leaves: dict[str, int] = {}

    def leaf(self, text: str) -> int:
        if text not in self.leaves:
            value = 0
            for c in text:
                value = (value * _BASE + ord(c)) % _MODULUS
            self.leaves[text] = self._new(text, len(text), value)
        return self.leaves[text]

    def join(self, left: int, right: int) -> int:
        n = self.size[right]
        power = self.power.get(n)
        if power is None:
            power = self.power[n] = pow(_BASE, n, _MODULUS)
        return self._new((left, right), self.size[left] + n, (self.print[left] * power + self.print[right]) % _MODULUS)

    def _new(self, part, size: int, value: int) -> int:
        self.parts.append(part)
        self.size.append(size)
        self.print.append(value)
        return len(self.parts) - 1

    def less(self, a: list[int], b: list[int]) -> bool:
        """Whether the ropes in `a`, in reverse order, read less than those in `b`; equal parts are skipped whole."""
        a, b = list(a), list(b)
        while a and b:
            x, y = a.pop(), b.pop()
            if isinstance(x, int) and isinstance(y, int) and self.size[x] == self.size[y] and self.print[x] == self.print[y]:
                continue
            text_x = x if isinstance(x, str) else self.parts[x]
            text_y = y if isinstance(y, str) else self.parts[y]
            if isinstance(text_x, str) and isinstance(text_y, str):
                n = min(len(text_x), len(text_y))
                if text_x[:n] != text_y[:n]:
                    return text_x[:n] < text_y[:n]
                if text_x[n:]:
                    a.append(text_x[n:])
                if text_y[n:]:
                    b.append(text_y[n:])
            elif isinstance(text_y, str) or not isinstance(text_x, str) and self.size[x] >= self.size[y]:
                a += [text_x[1], text_x[0]]
                b.append(y)
            else:
                a.append(x)
                b += [text_y[1], text_y[0]]
        return bool(b) and not a

    def text(self, rope: int) -> str:
        out, todo = [], [rope]
        while todo:
            part = self.parts[todo.pop()]
            if isinstance(part, str):
                out.append(part)
            else:
                todo += [part[1], part[0]]
        return "".join(out)


def terminal(code: int) -> int:
    """Symbol of a row code (4 * role + fault): 0 for rows that must go."""
    role, fault = divmod(code, 4)
    return 0 if fault >= BLANK else 1 + 2 * role + fault


class Repairs:
    """Rules and matrices that one task shares among its sequences. A matrix maps (from, to) to (cost, rope)."""

    LARGEST = 1_000_000

    def __init__(self):
        self._reset()

    def _reset(self) -> None:
        self.ropes = Ropes()
        self.rules: dict[tuple[int, int], int] = {}
        self.matrices = [self._terminal(None, False)] + [
            self._terminal(role if role < 3 else 3, cut_off) for role in range(4) for cut_off in (False, True)]

    def _terminal(self, role: int | None, cut_off: bool) -> dict:
        """One row, with the inserts before it; `role` None: it must be deleted."""
        best: dict = {}
        for start in range(4):
            state = start
            for inserts in range(3):
                ways = [("D", DELETE, state)]
                if role is not None:
                    extra = TRUNCATED if cut_off else 0
                    ways.append(("R", REROLE + extra, _MADE[state]))
                    if (state, role) in _KEPT:
                        ways.append(("K", KEEP + extra, _KEPT[state, role]))
                for letter, cost, end in ways:
                    way = (inserts * INSERT + cost, "I" * inserts + letter)
                    best[start, end] = min(best.get((start, end), way), way)
                state = _MADE[state]
        return {ends: (cost, self.ropes.leaf(text)) for ends, (cost, text) in best.items()}

    def product(self, a: dict, b: dict) -> dict:
        out: dict = {}
        for (start, middle), (cost_a, rope_a) in a.items():
            for end in range(4):
                if (middle, end) not in b:
                    continue
                cost_b, rope_b = b[middle, end]
                cost, old = cost_a + cost_b, out.get((start, end))
                if old is None or cost < old[0] or cost == old[0] and self.ropes.less([rope_b, rope_a], [old[2], old[1]]):
                    out[start, end] = (cost, rope_a, rope_b)
        return {ends: (cost, self.ropes.join(x, y)) for ends, (cost, x, y) in out.items()}

    def _rule(self, a: int, b: int) -> int:
        if (a, b) not in self.rules:
            self.matrices.append(self.product(self.matrices[a], self.matrices[b]))
            self.rules[a, b] = len(self.matrices) - 1
        return self.rules[a, b]

    def compress(self, sequences: list[list[int]]) -> list[list[int]]:
        """Re-Pair: replace the most frequent pairs, those that can't overlap at once, until none comes twice."""
        flat = np.array([x for s in sequences for x in (*s, -1)], dtype=np.int64)
        while True:
            inner = np.flatnonzero((flat[:-1] >= 0) & (flat[1:] >= 0))
            pairs = flat[inner] << 32 | flat[inner + 1]
            values, counts = np.unique(pairs, return_counts=True)
            chosen, lefts, rights = {}, set(), set()
            for i in np.argsort(-counts, kind="stable"):
                if counts[i] < 2:
                    break
                a, b = int(values[i]) >> 32, int(values[i]) & 0xFFFFFFFF
                if a == b and chosen or lefts & rights or a in rights or b in lefts:
                    continue
                chosen[int(values[i])] = self._rule(a, b)
                lefts.add(a)
                rights.add(b)
            if not chosen:
                break
            keys = np.array(sorted(chosen), dtype=np.int64)
            place = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)
            at = inner[keys[place] == pairs]
            if lefts & rights:  # a run of one symbol: every other pair
                first = np.concatenate([[True], np.diff(at) > 1])
                at = at[(np.arange(len(at)) - np.flatnonzero(first)[np.cumsum(first) - 1]) % 2 == 0]
            made = np.array([chosen[int(k)] for k in keys])
            flat[at] = made[np.searchsorted(keys, flat[at] << 32 | flat[at + 1])]
            flat = np.delete(flat, at + 1)
        out: list[list[int]] = [[]]
        for x in flat.tolist():
            if x < 0:
                out.append([])
            else:
                out[-1].append(x)
        return out[:-1]

    def transfers(self, sequences: list[list[int]]) -> list[dict]:
        """The matrix of each sequence of symbols, with audits as texts."""
        if len(self.ropes.parts) > self.LARGEST:  # only work kept for later; results do not depend on it
            self._reset()
        out = []
        for symbols in self.compress(sequences):
            matrix = self.matrices[symbols[0]]
            for x in symbols[1:]:
                matrix = self.product(matrix, self.matrices[x])
            out.append({ends: (cost, self.ropes.text(rope)) for ends, (cost, rope) in matrix.items()})
        return out


def chain(costs: list[list[int]], ranks: list[list[int]]) -> tuple[int, list[tuple[int, int]]]:
    """(cost, (from, to) per block) of the cheapest way through blocks, ties to the least audit. Costs below 0 are no way."""
    rest = [[INSERT * _TAIL[s] for s in range(4)]]
    for block in reversed(costs):
        after = rest[-1]
        rest.append([min(block[4 * s + e] + after[e] for e in range(4) if block[4 * s + e] >= 0) for s in range(4)])
    rest.reverse()
    state, way = START, []
    for i, block in enumerate(costs):
        ends = [e for e in range(4) if block[4 * state + e] >= 0 and block[4 * state + e] + rest[i + 1][e] == rest[i][state]]
        end = min(ends, key=lambda e: ranks[i][4 * state + e])
        way.append((state, end))
        state = end
    return rest[0][START], way


def illegal_pairs(codes: str) -> int:
    """Neighbours whose initials are not su, ua or au; `codes` holds a letter per row."""
    roles = [(ord(c) - 65) // 4 for c in codes]
    return sum(pair not in ((0, 1), (1, 2), (2, 1)) for pair in zip(roles, roles[1:]))


# ---------------------------------------------------------------- jobs


def _plain(rows: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, h, text) of the rows; a null role or text is one space."""
    words = F.coalesce(F.col(text).cast("string"), F.lit(" "))
    return rows.select(F.col(key).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
                       F.unhex(F.md5(words)).alias("h"), words.alias("text"))


def _order() -> list[Column]:
    return [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("h")]


def faulty_rows(plain: DataFrame) -> DataFrame:
    """(conv, turn, role, h, at, code): `at` numbers the rows in order, ranges of neighbours to tasks."""
    stripped = F.rtrim("text", F.lit(BLANKS))
    fault = F.when(stripped == "", BLANK).when(F.right(stripped, F.lit(1)).isin(".", "!", "?"), OK).otherwise(CUT_OFF)
    narrow = plain.select("conv", "turn", "role", "h", fault.alias("fault"), F.monotonically_increasing_id().alias("row"))
    order = [*_order(), F.asc("row")]
    placed = staged(narrow.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv", "turn", "role", "h", "fault", F.monotonically_increasing_id().alias("at")), "turns")
    # only numbers of rows meet in the join, so a text that repeats without end is no hot key
    firsts = placed.where(F.col("fault") != BLANK).groupBy("conv", "role", "h").agg(F.min("at").alias("at"))
    seen = placed.join(firsts.select("at", F.lit(True).alias("first")), "at", "left")
    initial = F.array_position(F.array(*map(F.lit, _INITIALS)), F.substring("role", 1, 1)) + 3
    fault = F.when((F.col("fault") != BLANK) & F.col("first").isNull(), DUPLICATE).otherwise(F.col("fault"))
    return seen.select("conv", "turn", "role", "h", "at", (F.pmod(initial, F.lit(4)) * 4 + fault).cast("int").alias("code"))


def block_transfers(faulty: DataFrame) -> DataFrame:
    """(conv, block, rows, codes, illegal, costs, ranks, audits): the matrix of each block as arrays of 16 by 4 * from + to."""
    blocks = faulty.groupBy("conv", F.expr(f"at div {BLOCK}").alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("at", "turn", "role", "h", "code"))).alias("rows"))
    blocks = blocks.withColumn("codes", F.array_join(F.transform("rows", lambda r: F.chr(r["code"] + 65)), ""))
    added = T.StructType().add("illegal", T.LongType()).add("costs", T.ArrayType(T.LongType())).add(
        "ranks", T.ArrayType(T.IntegerType())).add("audits", T.ArrayType(T.StringType()))
    types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.string())]
    names = blocks.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairs = Repairs()
        for batch in batches:
            codes = batch.column("codes").to_pylist()
            known = {}
            distinct = list(dict.fromkeys(codes))
            symbols = [[terminal(ord(c) - 65) for c in text] for text in distinct]
            for text, matrix in zip(distinct, repairs.transfers(symbols) if distinct else []):
                costs, ranks, audits = [-1] * 16, [0] * 16, [""] * 16
                for start in range(4):
                    ends = sorted((matrix[start, e][1], e) for e in range(4) if (start, e) in matrix)
                    for rank, (audit, e) in enumerate(ends):
                        costs[4 * start + e], ranks[4 * start + e], audits[4 * start + e] = matrix[start, e][0], rank, audit
                known[text] = (illegal_pairs(text), costs, ranks, audits)
            made = zip(*[known[c] for c in codes]) if codes else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, names), *[pa.array(list(v), t) for v, t in zip(made, types)]], names=[*names, *added.names])

    return staged(blocks.mapInArrow(run, T.StructType([*blocks.schema.fields, *added.fields])), "transfers")


def chained(transfers: DataFrame) -> DataFrame:
    """(conv, cost, illegal, way): the cheapest way through the blocks of each conversation."""
    gathered = transfers.groupBy("conv").agg(
        F.sum("illegal").alias("illegal"),
        F.array_sort(F.collect_list(F.struct("block", F.concat(F.left("codes", F.lit(1)), F.right("codes", F.lit(1))).alias("borders"),
                                             "costs", "ranks"))).alias("blocks"))
    way = "array<struct<block:bigint,start:int,end:int>>"
    kind = pa.list_(pa.struct([("block", pa.int64()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            costs, illegal, ways = [], [], []
            for within, blocks in zip(batch.column("illegal").to_pylist(), batch.column("blocks").to_pylist()):
                cost, steps = chain([b["costs"] for b in blocks], [b["ranks"] for b in blocks])
                between = sum(illegal_pairs(x["borders"][1] + y["borders"][0]) for x, y in zip(blocks, blocks[1:]))
                costs.append(cost)
                illegal.append(within + between)
                ways.append([{"block": b["block"], "start": s, "end": e} for b, (s, e) in zip(blocks, steps)])
            yield pa.RecordBatch.from_arrays([batch.column("conv"), pa.array(costs, pa.int64()), pa.array(illegal, pa.int64()), pa.array(ways, kind)],
                                             names=["conv", "cost", "illegal", "way"])

    schema = T.StructType([transfers.schema["conv"]]).add("cost", T.LongType()).add("illegal", T.LongType()).add("way", T.DataType.fromDDL(way))
    return staged(gathered.mapInArrow(run, schema), "ways")


_TURNS = [("position", pa.int64()), ("edit", pa.string()), ("turn", None), ("role", pa.string()), ("text", pa.string())]


def repaired_turns(plain: DataFrame, transfers: DataFrame, ways: DataFrame) -> DataFrame:
    """The edits of each conversation in order: conv, position, edit (K, R, D or I), turn, role, text."""
    steps = ways.select(F.col("conv").alias("c"), F.inline("way"))
    chosen = transfers.join(steps, F.col("conv").eqNullSafe(F.col("c")) & (transfers["block"] == steps["block"]))
    edits = F.regexp_extract_all(F.get("audits", F.col("start") * 4 + F.col("end")), F.lit("I*[KRD]"), F.lit(0))
    tokens = chosen.select("conv", F.explode(F.arrays_zip("rows", edits.alias("edit"))).alias("x"))
    marks = tokens.select("conv", "x.rows.turn", "x.rows.role", "x.rows.h", F.lit(0).alias("kind"), "x.rows.at", "x.edit",
                          F.lit(None).cast("string").alias("text"))
    texts = plain.select("conv", "turn", "role", "h", F.lit(1).alias("kind"), F.lit(None).cast("bigint").alias("at"),
                         F.lit(None).cast("string").alias("edit"), "text")
    # equal rows stand together: first their edits, then their texts; a conversation streams through one task
    stream = marks.unionByName(texts).repartition("conv").sortWithinPartitions(*_order(), "kind", "at")
    turn_type = stream.select("turn").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, conv, state, position = False, None, START, 0
        pending: list[list] = []  # [edits of a row, how many rows in a row]

        def insert() -> tuple:
            nonlocal state, position
            state = _MADE[state]
            position += 1
            return conv, position - 1, "I", None, _MADE_ROLE[state], ""

        def finish() -> list[tuple]:
            return [insert() for _ in range(_TAIL[state])] if known else []

        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in ("conv", "turn", "role", "kind", "edit", "text")]
            for c, turn, role, kind, edit, text in zip(*columns):
                if not known or c != conv:
                    out += finish()
                    known, conv, state, position = True, c, START, 0
                if not kind:
                    if pending and pending[-1][0] == edit:
                        pending[-1][1] += 1
                    else:
                        pending.append([edit, 1])
                    continue
                edit = pending[0][0]
                pending[0][1] -= 1
                if not pending[0][1]:
                    pending.pop(0)
                out += [insert() for _ in edit[:-1]]
                letter = edit[-1]
                if letter == "D":
                    role, text = None, None
                elif letter == "R":
                    state = _MADE[state]
                    role = _MADE_ROLE[state]
                else:
                    state = _KEPT[state, _INITIALS.index(role[0])]
                out.append((conv, position, letter, turn, role, text))
                position += 1
            if out:
                yield _batch(out, batch.schema)
        if known and (rest := finish()):
            yield _batch(rest, batch.schema)

    def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        kinds = [schema.field("conv").type, *[t or schema.field("turn").type for _, t in _TURNS]]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), kinds)], names=["conv", *[n for n, _ in _TURNS]])

    schema = T.StructType([transfers.schema["conv"]]).add("position", T.LongType()).add("edit", T.StringType()).add(
        "turn", turn_type["turn"].dataType).add("role", T.StringType()).add("text", T.StringType())
    return stream.mapInArrow(run, schema)


def repair_conversations(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(report, turns) of the cheapest repair of each conversation.

    report has a row per key: gaps, blank, duplicate, truncated, illegal and cost. turns has a row per edit, in order of
    (key, position) within tasks that hold whole conversations: key, position, edit, turn, role, text; deleted rows have
    neither role nor text.

    Rows count by turn (null first), then role, then a hash of the text. A null role or text is one space, a null key a
    conversation of its own. A row's first fault counts: blank, duplicate (role and text seen earlier in the order,
    compared by 128 bits), truncated (the last character that is no blank is none of .!?). Keep costs 0, a role made
    user or assistant 1, delete 2 (blank and duplicate rows must go), an insert of an empty text 5, a truncated row that
    stays 5; ties go to the audit least in ASCII. A role that begins with none of s, u, a (an empty one too) can't be
    kept. gaps is the number of whole turn numbers missing between the least and the largest, 0 without any. Repeated
    rows are duplicates of the first. Very long conversations are cut into blocks for everything but the final stream
    of their turns, which is one task's but holds a batch at a time; texts of any length pass whole. Other columns are
    left out. An empty table gives empty ones.
    """
    plain = _plain(rows, key, turn, role, text)
    faulty = faulty_rows(plain)
    transfers = block_transfers(faulty)
    ways = chained(transfers)

    def having(fault: int) -> Column:
        return F.sum(F.size(F.filter("rows", lambda r: r["code"] % 4 == fault))).cast("bigint")

    faults = transfers.groupBy("conv").agg(having(BLANK).alias("blank"), having(DUPLICATE).alias("duplicate"), having(CUT_OFF).alias("truncated"))
    numbers = plain.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("bigint").alias("gaps"))
    nothing = F.lit(None).cast("bigint")
    columns = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    parts = [df.select("conv", *[F.col(c) if c in df.columns else nothing.alias(c) for c in columns])
             for df in (numbers, faults, ways)]
    report = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("conv").agg(*[F.max(c).alias(c) for c in columns])
    return report.withColumnRenamed("conv", key), repaired_turns(plain, transfers, ways).withColumnRenamed("conv", key)


def turn_digests(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """(key, audit, repaired_sha256) of turns as `repair_conversations` gives them: ordered, whole conversations per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, conv, audit, digest, first, done = False, None, [], sha256(), True, []

        def flush() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], t) for i, t in enumerate((kind, pa.string(), pa.string()))],
                                              names=[key, "audit", "repaired_sha256"])
            done.clear()
            return rows

        kind = None
        for batch in batches:
            kind = batch.schema.field(key).type
            for c, edit, role, text in zip(*[batch.column(x).to_pylist() for x in (key, "edit", "role", "text")]):
                if not known or c != conv:
                    if known:
                        done.append((conv, "".join(audit), digest.hexdigest()))
                    known, conv, audit, digest, first = True, c, [], sha256(), True
                audit.append(edit)
                if edit != "D":
                    digest.update(f"{'' if first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
                    first = False
            if done:
                yield flush()
        if known:
            done.append((conv, "".join(audit), digest.hexdigest()))
            yield flush()

    schema = T.StructType([turns.schema[key]]).add("audit", T.StringType()).add("repaired_sha256", T.StringType())
    return turns.mapInArrow(run, schema)


# ---------------------------------------------------------------- planted damage


def damaged(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with damage that depends on crc32 of `key:turn` modulo 20 (nulls as one space): 0 drops the row, 1 empties the
    text, 2 takes its .!? away, 3 repeats the row, 4 sets the role user."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col(key).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn).cast("string"), space))
    harm = rows.withColumn("__harm", F.crc32(name.cast("binary")) % 20).where("__harm <> 0")
    harm = harm.withColumn(role, F.when(F.col("__harm") == 4, "user").otherwise(F.coalesce(F.col(role), space)))
    words = F.coalesce(F.col(text), space)
    harm = harm.withColumn(text, F.when(F.col("__harm") == 1, "").when(F.col("__harm") == 2, F.translate(words, ".!?", "")).otherwise(words))
    copies = F.array_repeat(F.lit(1), F.when(F.col("__harm") == 3, 2).otherwise(1))
    return harm.withColumn("__copy", F.explode(copies)).drop("__harm", "__copy")
