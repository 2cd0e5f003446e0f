"""Conversations repaired at least cost, by Four-Russians block tables.

The roles of a repaired conversation read ``(s?(ua)+)?`` by their initials. Four
states tell what may follow: nothing yet, after s, after u, after a. Every row is one
of nine symbols (role s, u, a or another, truncated or not; or to be deleted). The cost of
repairing the rest of a conversation is a vector over the states. Its lowest
value taken off, only a few dozen vectors exist, so the step from the vector behind a
row to the one before it is a table of vector numbers; composed, the table has
every block of ``BLOCK`` symbols. A conversation is read backward a block at a time by lookup.
Going forward, each block is expanded backward from the vector behind it into the
vectors of its rows, and in every state the first letter in ASCII order that still reaches
the lowest cost is taken; so ties always end in the least audit.

Rows are sorted by conversation and turn over ranges of the whole table, which cuts
conversations of any size. A conversation inside one range is done there. The first and the
last one of a range may go on in its neighbours: these runs are kept as rows, a
run sums up as vectors, costs and states (one small row per run), the sums of a
conversation are put together, and each run is traced from what its neighbours imply. A SHA-256
has to read its text from end to end, so the texts of such a conversation pass through
one task at last, as a stream that is not held.

Defined results: in the damage, a NULL id, turn, role or text is one space; NULL turns
come first; rows of one turn follow each other by the first 64 characters of role and text, and
then by a hash of both; a NULL conv_id is a conversation of its own; repeated rows are
duplicates; an empty or unknown role is retagged or deleted; texts may have any
length; a conversation whose rows were all dropped has zeros and the hash of the empty
text; an empty table gives no rows; other columns are not read. Rows must come from files or
a stored table, so that a repeated task reads them in the same order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.common import map_batches
from kindred.sources.scratch import Scratch

BLANK = " \t\n\x0b\x0c\r"
ENDS = ".!?"
#: Rows and bytes of text of a range of the sort, and of a piece of an unfinished run.
RANGE_ROWS, RANGE_BYTES, PIECE_ROWS, PIECE_BYTES = 200_000, 64 << 20, 2_000, 4 << 20
#: Values of the column that spreads equal rows over ranges.
SALTS = 4_096

KEEP, RETAG, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: States: nothing yet, after s, after u, after a. The role that each one wants next, and the state it leads to.
WANTS = ["u", "u", "a", "u"]
NEXT = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
ACCEPTED = (0, 3)
ROLE = {"u": "user", "a": "assistant"}
#: Symbols: 2 * role + truncated for roles s, u, a and others; then rows to delete.
ROLES = "sua"
SYMBOLS, DROP = 9, 8
BLOCK = 4


def before_inserts(base: list[int]) -> list[int]:
    """Costs per state once insertions in front are allowed."""
    out = list(base)
    for _ in range(3):
        out = [min(out[q], INSERT + out[NEXT[q][WANTS[q]]]) for q in range(4)]
    return out


def choices(symbol: int, q: int) -> list[tuple[str, int, int]]:
    """What may be done with a row in state ``q``: letter, cost, next state; letters ascend."""
    out = [("D", DELETE, q)]
    if symbol != DROP:
        late = TRUNCATED * (symbol % 2)
        role = ROLES[symbol // 2] if symbol < 6 else ""
        if role in NEXT[q] and role:
            out.append(("K", KEEP + late, NEXT[q][role]))
        out.append(("R", RETAG + late, NEXT[q][WANTS[q]]))
    return out


def step(symbol: int, behind: tuple[int, ...]) -> list[int]:
    """Costs before a row from the costs behind it."""
    return before_inserts([min(cost + behind[to] for _, cost, to in choices(symbol, q)) for q in range(4)])


class Tables:
    """All normalised vectors, and the steps over single rows and over blocks."""

    def __init__(self, block: int = BLOCK):
        end = before_inserts([0 if q in ACCEPTED else 1 << 20 for q in range(4)])
        numbers = {tuple(c - min(end) for c in end): 0}
        self.vectors, self.block = list(numbers), block
        rows: list[list[tuple[int, int]]] = []
        at = 0
        while at < len(self.vectors):
            row = []
            for symbol in range(SYMBOLS):
                before = step(symbol, self.vectors[at])
                low = min(before)
                key = tuple(c - low for c in before)
                if key not in numbers:
                    numbers[key] = len(numbers)
                    self.vectors.append(key)
                row.append((numbers[key], low))
            rows.append(row)
            at += 1
        #: By symbol and number of the vector behind: number of the vector before, and cost taken off.
        self.to = np.array([[r[s][0] for r in rows] for s in range(SYMBOLS)], dtype=np.int16)
        self.cost = np.array([[r[s][1] for r in rows] for s in range(SYMBOLS)], dtype=np.int32)
        to, cost = self.to, self.cost
        for _ in range(block - 1):
            # One more row in front of every block so far.
            more = np.concatenate([cost + self.cost[s][to] for s in range(SYMBOLS)])
            to, cost = np.concatenate([self.to[s][to] for s in range(SYMBOLS)]), more
        self.block_to, self.block_cost = to, cost
        self._moves: dict[tuple[int, int, int], tuple[str, int]] = {}
        self._blocks: dict[tuple[bytes, int, int], tuple[tuple[str, ...], int]] = {}
        self.inserts_left = {q: ("" if q in ACCEPTED else "I" if q == 2 else "II") for q in range(4)}

    def cut(self, symbols: bytes) -> tuple[list[bytes], list[int]]:
        """Whole blocks behind a shorter piece in front; and the numbers of the blocks (first symbol highest)."""
        first = len(symbols) % self.block
        parts = [symbols[i : i + self.block] for i in range(first, len(symbols), self.block)]
        whole = np.frombuffer(symbols, dtype=np.uint8, offset=first).reshape(-1, self.block) if parts else np.zeros((0, self.block), np.uint8)
        numbers = whole.astype(np.int64) @ (SYMBOLS ** np.arange(self.block - 1, -1, -1))
        return [symbols[:first], *parts], numbers.tolist()

    def backward(self, symbols: bytes, behind: int) -> tuple[list[bytes], list[int], int]:
        """Blocks, the vector behind each of them, and the vector before all."""
        parts, numbers = self.cut(symbols)
        ends, v = [0] * len(parts), behind
        for i in range(len(parts) - 1, 0, -1):
            ends[i] = v
            v = int(self.block_to[numbers[i - 1], v])
        ends[0] = v
        for s in reversed(parts[0]):
            v = int(self.to[s, v])
        return parts, ends, v

    def total(self, symbols: bytes) -> int:
        """Lowest cost of a whole conversation."""
        _, numbers = self.cut(symbols)
        v, cost = 0, 0
        for n in reversed(numbers):
            cost, v = cost + int(self.block_cost[n, v]), int(self.block_to[n, v])
        for s in reversed(symbols[: len(symbols) % self.block]):
            cost, v = cost + int(self.cost[s, v]), int(self.to[s, v])
        return cost + self.vectors[v][0]

    def move(self, symbol: int, behind: int, q: int) -> tuple[str, int]:
        """Letters up to and with a row's own, and the state behind it."""
        key = (symbol, behind, q)
        if key not in self._moves:
            after, letters = self.vectors[behind], ""
            before = step(symbol, after)
            while True:
                options = choices(symbol, q)
                options.insert(1, ("I", INSERT, -1))
                for letter, cost, to in options:
                    if letter == "I":
                        if before[q] == INSERT + before[NEXT[q][WANTS[q]]]:
                            break
                    elif before[q] == cost + after[to]:
                        break
                letters += letter
                if letter != "I":
                    break
                q = NEXT[q][WANTS[q]]
            self._moves[key] = letters, to
        return self._moves[key]

    def expand(self, part: bytes, behind: int, q: int) -> tuple[tuple[str, ...], int]:
        """Letters of every row of a block: its inner vectors backward, then forward from state ``q``."""
        key = (part, behind, q)
        if key not in self._blocks:
            inner = [behind]
            for s in reversed(part[1:]):
                inner.append(int(self.to[s, inner[-1]]))
            letters = []
            for s, v in zip(part, reversed(inner)):
                one, q = self.move(s, v, q)
                letters.append(one)
            if len(self._blocks) > 500_000:
                self._blocks.clear()
            self._blocks[key] = tuple(letters), q
        return self._blocks[key]

    def trace(self, symbols: bytes, behind: int = 0, q: int = 0) -> tuple[list[str], int]:
        """Letters of every row, and the state behind the last."""
        parts, ends, _ = self.backward(symbols, behind)
        out: list[str] = []
        for part, end in zip(parts, ends):
            letters, q = self.expand(part, end, q) if part else ((), q)
            out.extend(letters)
        return out, q

    def summary(self, symbols: bytes) -> tuple[list[int], list[int], list[int]]:
        """For every vector behind a run: the vector before it, the cost taken off, and the state behind it by state before it."""
        to, costs, states = [], [], []
        for v in range(len(self.vectors)):
            parts, ends, before = self.backward(symbols, v)
            _, numbers = self.cut(symbols)
            cost = sum(int(self.block_cost[n, e]) for n, e in zip(numbers, ends[1:]))
            at = ends[0]
            for s in reversed(parts[0]):
                cost, at = cost + int(self.cost[s, at]), int(self.to[s, at])
            to.append(before)
            costs.append(cost)
            for q in range(4):
                for part, end in zip(parts, ends):
                    q = self.expand(part, end, q)[1] if part else q
                states.append(q)
        return to, costs, states


_TABLES: dict[int, Tables] = {}


def tables() -> Tables:
    """The worker's tables; made once."""
    if BLOCK not in _TABLES:
        _TABLES[BLOCK] = Tables()
    return _TABLES[BLOCK]


def damaged(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, text of the damaged conversations; a dropped row has ``live`` false and no text."""
    space = F.lit(" ")
    named = F.concat_ws(":", F.coalesce(F.col(conv_id).cast("string"), space), F.coalesce(F.col(turn).cast("string"), space))
    fate = F.crc32(named) % 20
    role_, text_ = F.coalesce(F.col(role).cast("string"), space), F.coalesce(F.col(text).cast("string"), space)
    harmed = F.when(fate.isin(0, 1), F.lit("")).when(fate == 2, F.regexp_replace(text_, "[.!?]", "")).otherwise(text_)
    own = rows.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.when(fate == 4, F.lit("user")).otherwise(role_).alias("role"),
        harmed.alias("text"), (fate != 0).alias("live"), F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"),
    )
    return own.withColumn("_copy", F.explode("copies")).drop("copies", "_copy")


class Run:
    """Rows of a conversation in one range: counts, symbols and what is known of their order."""

    def __init__(self, conv):
        self.conv = conv
        self.turns: list = []
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.live: list[bool] = []

    def add(self, turn, role: str, text: str, live: bool) -> None:
        for to, v in ((self.turns, turn), (self.roles, role), (self.texts, text), (self.live, live)):
            to.append(v)


def fault(role: str, text: str, seen: bool) -> int:
    """0 none, 1 blank, 2 duplicate, 3 truncated."""
    bare = text.rstrip(BLANK)
    return 1 if not bare else 2 if seen else 3 * (bare[-1] not in ENDS)


def symbol(role: str, flaw: int) -> int:
    if flaw in (1, 2):
        return DROP
    return 2 * (ROLES.find(role[:1]) if role[:1] and role[:1] in ROLES else 3) + (flaw == 3)


def repaired(roles: list[str], texts: list[str], letters: list[str], q: int) -> Iterator[str]:
    """The lines of the repaired rows, and of what is inserted before each."""
    for role, text, own in zip(roles, texts, letters):
        for letter in own:
            if letter == "D":
                continue
            wanted = WANTS[q]
            if letter == "K":
                q = NEXT[q][role[:1]]
                yield f"{role}:{text}"
                continue
            yield f"{ROLE[wanted]}:{'' if letter == 'I' else text}"
            q = NEXT[q][wanted]


def appended(q: int) -> list[str]:
    """Lines inserted behind the last row."""
    out = []
    while q not in ACCEPTED:
        out.append(f"{ROLE[WANTS[q]]}:")
        q = NEXT[q][WANTS[q]]
    return out


LEGAL = frozenset(["su", "ua", "au"])
RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
PIECES = "part int, run int, piece int, turns array<{turn}>, roles array<string>, texts array<string>, live array<boolean>"


def finished(run: Run) -> dict:
    """The result of a conversation that lies in one range."""
    kept = [i for i, live in enumerate(run.live) if live]
    roles, texts, turns = ([v[i] for i in kept] for v in (run.roles, run.texts, run.turns))
    seen: set[tuple[str, str]] = set()
    flaws = []
    for role, text in zip(roles, texts):
        flaws.append(fault(role, text, (role, text) in seen))
        seen.add((role, text))
    symbols = bytes(symbol(r, f) for r, f in zip(roles, flaws))
    letters, q = tables().trace(symbols)
    named = {t for t in turns if t is not None}
    digest = hashlib.sha256("\n".join([*repaired(roles, texts, letters, 0), *appended(q)]).encode())
    return {
        "gaps": max(named) - min(named) + 1 - len(named) if named else 0,
        "blank": flaws.count(1), "duplicate": flaws.count(2), "truncated": flaws.count(3),
        "illegal": sum(a[:1] + b[:1] not in LEGAL for a, b in zip(roles, roles[1:])),
        "cost": tables().total(symbols), "audit": "".join(letters) + tables().inserts_left[q], "repaired_sha256": digest.hexdigest(),
    }


def sorted_runs(harmed: DataFrame, ranges: int) -> DataFrame:
    """Results of the conversations inside a range; pieces of the others (``piece`` not NULL)."""
    conv, turn = (f.dataType.simpleString() for f in harmed.schema.fields[:2])
    harmed = harmed.withColumn("_salt", F.monotonically_increasing_id() % SALTS)
    order = [
        F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.substring("role", 1, 64), F.substring("text", 1, 64),
        F.xxhash64("role", "text"), F.col("live"), F.col("_salt"),
    ]
    placed = harmed.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    names = [n.split()[0] for n in RESULT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        first, now, number, part = True, None, 0, 0
        out: dict[str, list] = {}

        def fresh() -> None:
            out.clear()
            out.update({k: [] for k in ("conv_id", *names, "part", "run", "piece", "turns", "roles", "texts", "live")})

        def put(**values) -> None:
            for k, to in out.items():
                to.append(values.get(k))

        def piece(r: Run, at: int) -> None:
            put(conv_id=r.conv, part=part, run=number, piece=at, turns=r.turns, roles=r.roles, texts=r.texts, live=r.live)

        def pieces(r: Run) -> None:
            part_of, size, at = Run(r.conv), 0, 0
            for row in zip(r.turns, r.roles, r.texts, r.live):
                part_of.add(*row)
                size += len(row[2])
                if len(part_of.live) >= PIECE_ROWS or size >= PIECE_BYTES:
                    piece(part_of, at)
                    part_of, size, at = Run(r.conv), 0, at + 1
            if part_of.live:
                piece(part_of, at)

        fresh()
        for batch in batches:
            for conv_, turn_, role, text, live, part in zip(*[c.to_pylist() for c in batch.columns]):
                if now is None:
                    now = Run(conv_)
                elif conv_ != now.conv:
                    if first:
                        pieces(now)
                    else:
                        put(conv_id=now.conv, **finished(now))
                    first, now, number = False, Run(conv_), number + 1
                now.add(turn_, role, text, live)
            yield dict(out)
            fresh()
        if now is not None:
            pieces(now)
            yield dict(out)

    schema = f"conv_id {conv}, {RESULT}, {PIECES.format(turn=turn)}"
    return map_batches(placed.select("conv_id", "turn", "role", "text", "live", F.spark_partition_id().alias("part")), run, schema)


def _composed(spans: DataFrame, conv: str) -> DataFrame:
    """Vector behind and state before every run, from the sums of all runs of its conversation (one row per range)."""
    packed = spans.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "run", "to", "costs", "states"))).alias("runs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        t = tables()
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("conv_id", "part", "run", "behind", "state", "cost", "last")}
            for conv_id, runs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                v, cost, behind = 0, 0, []
                for r in reversed(runs):
                    behind.append(v)
                    v, cost = r["to"][v], cost + r["costs"][v]
                q, whole = 0, cost + t.vectors[v][0]
                for i, (r, v) in enumerate(zip(runs, reversed(behind))):
                    for k, value in zip(out, (conv_id, r["part"], r["run"], v, q, whole, i == len(runs) - 1)):
                        out[k].append(value)
                    q = r["states"][4 * v + q]
            yield out

    return map_batches(packed, run, f"conv_id {conv}, part int, run int, behind int, state int, cost long, last boolean")


def _joined(a: DataFrame, b: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Equi-join; NULL conversations meet each other."""
    b = b.withColumnsRenamed({n: f"_r_{n}" for n in names})
    test = F.lit(True)
    for n in names:
        test = test & F.col(n).eqNullSafe(F.col(f"_r_{n}"))
    return a.join(b, test, how).drop(*[f"_r_{n}" for n in names])


def open_runs(pieces: DataFrame, scratch: Scratch) -> DataFrame:
    """Results of the conversations that may lie in several ranges."""
    conv = dict(pieces.dtypes)["conv_id"]
    zipped = F.arrays_zip("turns", "roles", "texts", "live")
    rows = pieces.select("conv_id", "part", "run", "piece", F.posexplode(zipped).alias("at", "row")).select(
        "conv_id", "part", "run", (F.col("piece").cast("long") * PIECE_ROWS + F.col("at")).alias("at"),
        F.col("row.turns").alias("turn"), F.col("row.roles").alias("role"), F.col("row.texts").alias("text"), F.col("row.live").alias("live"),
    )
    place = ["part", "run", "at"]
    live = rows.filter("live")
    bare = F.regexp_replace("text", r"[\x20\x09-\x0D]+$", "")
    initial = F.substring("role", 1, 1)
    facts = scratch.save(
        live.select(
            "conv_id", *place, "turn", "role", F.md5(F.encode("text", "UTF-8")).alias("digest"), initial.alias("initial"),
            (bare == "").alias("blank"), (~F.substring(bare, -1, 1).isin(*ENDS)).alias("open"),
        ),
        "facts",
    )
    # The first of every role and text, by place; a place is unique, so no key of this join is hot.
    firsts = facts.groupBy("conv_id", "role", "digest").agg(F.min(F.struct(*place)).alias("p")).select("p.*", F.lit(True).alias("is_first"))
    judged = facts.join(firsts, place, "left").withColumn(
        "flaw", F.when(F.col("blank"), 1).when(F.col("is_first").isNull(), 2).when(F.col("open"), 3).otherwise(0)
    )
    role_number = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    symbol_ = F.when(F.col("flaw").isin(1, 2), DROP).otherwise(2 * role_number + (F.col("flaw") == 3).cast("int"))
    judged = scratch.save(judged.select("conv_id", *place, "turn", "role", "flaw", symbol_.alias("symbol"), role_number.alias("kind")), "judged")
    # A run has at most the rows of a range.
    runs = judged.groupBy("conv_id", "part", "run").agg(F.sort_array(F.collect_list(F.struct("at", "symbol", "kind"))).alias("rows"))
    runs = scratch.save(runs.select("conv_id", "part", "run", F.col("rows.at").alias("at"), F.col("rows.symbol").alias("symbols"), F.col("rows.kind").alias("kinds")), "runs")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("conv_id", "part", "run", "to", "costs", "states", "illegal", "first", "last")}
            for conv_id, part, run, symbols, kinds in zip(*[c.to_pylist() for c in batch.columns]):
                pairs = sum((a, b) not in ((0, 1), (1, 2), (2, 1)) for a, b in zip(kinds, kinds[1:]))
                for k, v in zip(out, (conv_id, part, run, *tables().summary(bytes(symbols)), pairs, kinds[0], kinds[-1])):
                    out[k].append(v)
            yield out

    spans = map_batches(
        runs.select("conv_id", "part", "run", "symbols", "kinds"), sums,
        f"conv_id {conv}, part int, run int, to array<int>, costs array<long>, states array<int>, illegal long, first int, last int",
    )
    spans = scratch.save(spans, "spans")
    placed = scratch.save(_composed(spans, conv), "placed")
    # Pairs across a border: one row per range, so one conversation has at most as many as there are ranges.
    following = F.lead("first").over(Window.partitionBy("conv_id").orderBy("part", "run"))
    legal = ((F.col("last") == 0) & (F.col("next") == 1)) | ((F.col("last") == 1) & (F.col("next") == 2)) | ((F.col("last") == 2) & (F.col("next") == 1))
    illegal = spans.withColumn("next", following).groupBy("conv_id").agg(
        F.sum(F.col("illegal") + (F.col("next").isNotNull() & ~legal).cast("long")).alias("illegal")
    )

    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("conv_id", "part", "run", "at", "letters", "state", "end", "last")}
            for conv_id, part, run, at, symbols, behind, state, last in zip(*[c.to_pylist() for c in batch.columns]):
                letters, end = tables().trace(bytes(symbols), behind, state)
                for k, v in zip(out, (conv_id, part, run, at, letters, state, end, last)):
                    out[k].append(v)
            yield out

    asked = _joined(runs, placed.drop("cost"), ["conv_id", "part", "run"]).select("conv_id", "part", "run", "at", "symbols", "behind", "state", "last")
    traces = scratch.save(
        map_batches(asked, traced, f"conv_id {conv}, part int, run int, at array<long>, letters array<string>, state int, end int, last boolean"), "traces"
    )
    closing = F.when(F.col("last") & (F.col("end") == 2), "I").when(F.col("last") & (F.col("end") == 1), "II").otherwise("")
    audits = traces.select("conv_id", F.struct("part", "run", F.concat(F.array_join("letters", ""), closing).alias("audit")).alias("s")).groupBy("conv_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("s")), lambda s: s["audit"]), "").alias("audit")
    )
    whole = placed.filter("last").select("conv_id", "cost")
    # Distinct turns first: their number is not bounded by anything.
    turns = judged.groupBy("conv_id", "turn").agg(F.lit(1)).groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps")
    )
    counts = judged.groupBy("conv_id").agg(
        F.count_if(F.col("flaw") == 1).alias("blank"), F.count_if(F.col("flaw") == 2).alias("duplicate"), F.count_if(F.col("flaw") == 3).alias("truncated")
    )
    # The texts stream by in order; letters come from the run's own row right before its rows.
    none = lambda kind: F.lit(None).cast(kind)
    lines = live.select("conv_id", "part", "run", "at", "role", "text", none("array<string>").alias("letters"), none("int").alias("state"))
    heads = traces.select(
        "conv_id", "part", "run", F.lit(-1).cast("long").alias("at"), none("string").alias("role"), none("string").alias("text"), "letters", "state"
    )
    stream = lines.unionByName(heads).repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), "part", "run", "at")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        now, digest, empty, q, letters = (), None, True, 0, iter(())
        out: dict[str, list] = {"conv_id": [], "repaired_sha256": []}

        def feed(items) -> None:
            nonlocal empty
            for line in items:
                digest.update((line if empty else "\n" + line).encode())
                empty = False

        def close() -> None:
            if now:
                feed(appended(q))
                out["conv_id"].append(now[0])
                out["repaired_sha256"].append(digest.hexdigest())

        for batch in batches:
            for conv_id, role, text, own, state in zip(*[c.to_pylist() for c in batch.columns]):
                if now != (conv_id,):
                    close()
                    now, digest, empty, q = (conv_id,), hashlib.sha256(), True, 0
                if own is not None:
                    letters, q = iter(own), state
                    continue
                one = [next(letters)]
                feed(repaired([role], [text], one, q))
                for letter in one[0]:
                    q = q if letter == "D" else NEXT[q][role[:1] if letter == "K" else WANTS[q]]
            yield {k: list(v) for k, v in out.items()}
            out = {"conv_id": [], "repaired_sha256": []}
        close()
        yield out

    hashes = map_batches(stream.select("conv_id", "role", "text", "letters", "state"), hashed, f"conv_id {conv}, repaired_sha256 string")
    done = pieces.select("conv_id").distinct()
    for frame in (turns, counts, illegal, whole, audits, hashes):
        done = _joined(done, frame, ["conv_id"], "left")
    zero = {n: F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return done.select(
        "conv_id", *zero.values(), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )


def repair(harmed: DataFrame, range_rows: int = RANGE_ROWS, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Per conversation of ``damaged`` rows: gaps, faults, cost, audit and hash of its repair."""
    scratch = Scratch(harmed.sparkSession, "turn-repair")
    size = harmed.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("text") + 16), F.lit(0)).alias("bytes")).first()
    ranges = max(1, -(-size.n // range_rows), -(-size.bytes // range_bytes))
    runs = scratch.save(sorted_runs(harmed, ranges), "sorted")
    names = ["conv_id", *[n.split()[0] for n in RESULT.split(", ")]]
    inside = runs.filter(F.col("piece").isNull()).select(*names)
    return inside.unionByName(open_runs(runs.filter(F.col("piece").isNotNull()), scratch).select(*names))
