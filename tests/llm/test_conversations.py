"""Conversation repair against plain versions."""

import itertools
import random
import re
from hashlib import sha256
from zlib import crc32

import pytest

from otelier.llm import conversations as C
from otelier.llm.queries import QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string, cost string, kind int, block string"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        space = lambda v: " " if v is None else v
        harm = crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        if harm == 0:
            continue
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        out += [(conv, turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
    return out


def faults_of(rows):
    """Fault of each row of a conversation in order."""
    seen, out = set(), []
    for _, _, role, text in rows:
        kept = text.strip(C.BLANKS)
        out.append("blank" if not kept else "duplicate" if (role, text) in seen else "truncated" if kept[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain_repair(rows):
    """(cost, audit, lines) row by row over the roles so far."""
    made, first = {"": "u", "s": "u", "a": "u", "u": "a"}, {"u": "user", "a": "assistant"}

    def inserted(ways):
        for _ in range(3):
            for state, (cost, audit, lines) in list(ways.items()):
                to = made[state]
                way = (cost + 5, audit + "I", lines + [first[to] + ":"])
                ways[to] = min(ways.get(to, way), way, key=lambda w: w[:2])
        return ways

    ways = {"": (0, "", [])}
    for (_, _, role, text), fault in zip(rows, faults_of(rows)):
        after = {}

        def offer(state, way):
            after[state] = min(after.get(state, way), way, key=lambda w: w[:2])

        for state, (cost, audit, lines) in inserted(ways).items():
            offer(state, (cost + 2, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 if fault else 0
            offer(made[state], (cost + 1 + extra, audit + "R", lines + [f"{first[made[state]]}:{text}"]))
            if role[:1] and (state + role[0]) in ("s", "u", "su", "ua", "au"):
                offer(role[0], (cost + extra, audit + "K", lines + [f"{role}:{text}"]))
        ways = after
    return min((w for s, w in inserted(ways).items() if s in ("", "a")), key=lambda w: w[:2])


def every_repair(rows):
    """(cost, audit) by trying all edits."""
    best = None
    options = []
    for (_, _, role, _), fault in zip(rows, faults_of(rows)):
        mine = [(2, "D", "")]
        if fault not in ("blank", "duplicate"):
            extra = 5 if fault else 0
            mine += [(extra, "K", role[:1] or "?"), (1 + extra, "R", "u"), (1 + extra, "R", "a")]
        options.append(mine)
    gaps = [(5 * n, "I" * n, "".join(x)) for n in range(3) for x in itertools.product("ua", repeat=n)]
    steps = [gaps]
    for mine in options:
        steps += [mine, gaps]
    for way in itertools.product(*steps):
        if re.fullmatch("(s?(ua)+)?", "".join(x[2] for x in way)):
            found = (sum(x[0] for x in way), "".join(x[1] for x in way))
            best = found if best is None else min(best, found)
    return best


def plain_query(rows):
    convs = {}
    for r in rows:
        convs.setdefault(r[0], [])
    for r in plain_damage(rows):
        convs[r[0]].append(r)
    out = []
    for conv, mine in convs.items():
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], _md5(r[3])))
        turns = {t for _, t, _, _ in mine if t is not None}
        faults, initials = faults_of(mine), [r[2][:1] for r in mine]
        cost, audit, lines = plain_repair(mine)
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                    sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def _md5(text):
    import hashlib
    return hashlib.md5(text.encode()).digest()


def run(spark, df, tmp_path):
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    columns = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return sorted(map(tuple, QUERIES["op12_conversation_repair"](spark, str(tmp_path)).select(*columns).collect()), key=repr)


def test_given_conversations(spark, sf):
    for folder in (sf, "/root/testdata/sf0.01"):
        rows = list(map(tuple, spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()))
        got = QUERIES["op12_conversation_repair"](spark, folder).select(
            "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
        assert sorted(map(tuple, got.collect()), key=repr) == plain_query(rows)


def awkward_rows():
    rng = random.Random(5)
    texts = ["A question?", "An answer.", "cut off", "", " \t", None, "Ä! ", "x" * 5000 + ".", "two\nlines."]
    roles = ["user", "assistant", "system", "tool", None, "", "User", "s"]
    rows = [(rng.randrange(40) if rng.random() > 0.05 else None, rng.choice([None, 0, 1, 2, 3, 5, 9]), rng.choice(roles), rng.choice(texts))
            for _ in range(500)]
    rows += [(7, t, "user" if t % 2 else "assistant", f"turn {t % 900}" + ".!? "[t % 4]) for t in range(5000)]  # most rows
    rows += [(8, 3, "user", "the same.")] * 300 + [(9, None, "tool", "null turns.")] * 3
    return rows


def test_awkward_conversations(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 64)
    rows = awkward_rows()
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(5)
    assert run(spark, df, tmp_path) == plain_query(rows)


def test_empty_conversations(spark, tmp_path):
    assert run(spark, spark.createDataFrame([], SCHEMA), tmp_path) == []


def test_turns_in_order(spark):
    rows = [(1, 0, "system", "Be kind.", None, None, None), (1, 1, "assistant", "Hello.", None, None, None), (1, 2, "assistant", "Hello.", None, None, None)]
    report, turns = C.repair_conversations(spark.createDataFrame(rows, SCHEMA))
    assert [tuple(r) for r in turns.select("position", "edit", "turn", "role", "text").collect()] == [
        (0, "R", 0, "user", "Be kind."), (1, "K", 1, "assistant", "Hello."), (2, "D", 2, None, None)]
    assert [tuple(r) for r in report.collect()] == [(1, 0, 0, 1, 0, 2, 3)]


@pytest.mark.parametrize("seed", range(3))
def test_against_every_edit(seed):
    rng = random.Random(seed)
    for _ in range(25):
        n = rng.randrange(4)
        rows = [(0, t, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b.", "c", ""])) for t in range(n)]
        assert every_repair(rows) == plain_repair(rows)[:2]


def test_grammar_and_ropes():
    rng = random.Random(1)
    sequences = [[rng.choice([1, 3, 5]) for _ in range(rng.randrange(1, 40))] for _ in range(60)] + [[3] * 500, [3, 5] * 400, [0] * 33]
    repairs = C.Repairs()
    direct = C.Repairs()
    for seq, packed, got in zip(sequences, repairs.compress(sequences), repairs.transfers(sequences)):
        parts = {v: k for k, v in repairs.rules.items()}

        def spelled(x):
            return spelled(parts[x][0]) + spelled(parts[x][1]) if x in parts else [x]

        assert [y for x in packed for y in spelled(x)] == seq
        matrix = direct.matrices[seq[0]]
        for x in seq[1:]:
            matrix = direct.product(matrix, direct.matrices[x])
        assert got == {e: (c, direct.ropes.text(r)) for e, (c, r) in matrix.items()}
    assert max(map(len, repairs.compress([[3, 5] * 400]))) < 12


def test_rope_order():
    rng, ropes = random.Random(2), C.Ropes()
    pool = [(x, ropes.leaf(x)) for x in ("K", "D", "R", "IK", "IID")]
    for _ in range(200):
        (a, x), (b, y) = rng.choice(pool), rng.choice(pool)
        pool.append((a + b, ropes.join(x, y)))
    for _ in range(500):
        (a, x), (b, y) = rng.choice(pool), rng.choice(pool)
        assert ropes.less([x], [y]) == (a < b) and ropes.text(x) == a
