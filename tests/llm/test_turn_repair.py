"""Conversation repair against a plain dynamic programme over whole conversations."""

import hashlib
import random
import zlib
from functools import lru_cache

import pytest

from kindred.llm import queries, turn_repair

SF = "/root/testdata/sf0.001"

SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, part int, letters string, _salt string, row string"


def harm(rows):
    for conv, turn, role, text in rows:
        named = lambda v: " " if v is None else v
        fate = zlib.crc32(f"{named(conv)}:{named(turn)}".encode()) % 20
        role, text = named(role), named(text)
        if fate == 0:
            continue
        if fate == 1:
            text = ""
        if fate == 2:
            text = "".join(c for c in text if c not in ".!?")
        if fate == 4:
            role = "user"
        yield from [(conv, turn, role, text)] * (2 if fate == 3 else 1)


def cheapest(rows, flaws):
    """Lowest (cost, audit), and the repaired lines."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    want = {"": "u", "s": "u", "u": "a", "a": "u"}
    long = {"u": "user", "a": "assistant"}

    @lru_cache(None)
    def rest(i, last, inserted):
        found = []
        if inserted < 3:
            w = want[last]
            cost, audit, lines = rest(i, w, inserted + 1)
            found.append((cost + 2, "I" + audit, (f"{long[w]}:", lines)))
        if i == len(rows):
            return min([*found, (0, "", None)] if last in ("", "a") else found, key=lambda f: f[:2], default=(10**9, "", None))
        role, text = rows[i]
        cost, audit, lines = rest(i + 1, last, 0)
        found.append((cost + 3, "D" + audit, lines))
        if flaws[i] not in ("blank", "duplicate"):
            late = int(flaws[i] == "truncated")
            if (to := step.get((last, role[:1]))) is not None:
                cost, audit, lines = rest(i + 1, to, 0)
                found.append((cost + late, "K" + audit, (f"{role}:{text}", lines)))
            w = want[last]
            cost, audit, lines = rest(i + 1, w, 0)
            found.append((cost + late + 2, "R" + audit, (f"{long[w]}:{text}", lines)))
        return min(found, key=lambda f: f[:2])

    for i in range(len(rows), 0, -1):  # so that no recursion is deep
        for last in want:
            rest(i, last, 0)
    cost, audit, lines = rest(0, "", 0)
    out = []
    while lines:
        out.append(lines[0])
        lines = lines[1]
    return cost, audit, "\n".join(out)


def brute(rows):
    done = {conv: [] for conv, *_ in rows}
    for conv, *row in harm(rows):
        done[conv].append(row)
    for conv, own in done.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = {t for t, *_ in own if t is not None}
        seen, flaws = set(), []
        for _, role, text in own:
            bare = text.strip(SPACE)
            flaws.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
            seen.add((role, text))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, text = cheapest([r[1:] for r in own], flaws)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        counts = [flaws.count(f) for f in ("blank", "duplicate", "truncated")]
        yield (conv, gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def rows_of_all_kinds():
    rng = random.Random(11)
    text = lambda: rng.choice(["Yes.", "No", " \t\n", "", "Long " * rng.randint(1, 9) + "end!", "Why?", "é", "x.\x0b\n"])
    role = lambda: rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "unknown", "über"])
    out = [(c, t, role(), text()) for c in range(60) for t in range(rng.randint(0, 12))]
    out += [(77, t, ("user", "assistant")[t % 2], f"Turn {t % 50}.") for t in range(700)]  # one large conversation
    out += [(78, 0, "user", "The same.")] * 90  # repeated rows
    out += [(79, None, role(), text()) for _ in range(9)] + [(None, t, role(), text()) for t in range(8)] + [(None, None, None, None)]
    out += [(80, -5, "user", "A gap."), (80, 900, "assistant", "y" * 200_000 + "."), (81, 3, None, None), (82, 5, "assistant", None)]
    dropped = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return [*out, (dropped, 0, "user", "Gone.")]


FIELDS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize("range_rows", [40, 100_000])
def test_repair_equals_brute_force(spark, range_rows):
    rows = rows_of_all_kinds()
    table = spark.createDataFrame([(*r, 1, "a", "b", "c") for r in rows], SCHEMA).repartition(5)
    done = turn_repair.repair(turn_repair.damaged(table), range_rows=range_rows)
    got = sorted(map(tuple, done.select(*FIELDS).collect()), key=str)
    assert got == sorted(brute(rows), key=str)


def test_the_query_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    got = sorted(map(tuple, queries.conversation_repair(spark, SF).select(*FIELDS).collect()))
    assert got == sorted(brute([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]))


def test_an_empty_table(spark):
    done = turn_repair.repair(turn_repair.damaged(spark.createDataFrame([], SCHEMA)))
    assert done.columns == FIELDS and done.count() == 0


def test_blocks_and_single_rows_agree():
    blocks, single = turn_repair.Tables(), turn_repair.Tables(block=1)
    rng = random.Random(5)
    for n in [*range(0, 20), 1000]:
        symbols = bytes(rng.randrange(turn_repair.SYMBOLS) for _ in range(n))
        assert blocks.trace(symbols) == single.trace(symbols) and blocks.total(symbols) == single.total(symbols)
        assert blocks.summary(symbols) == single.summary(symbols)
