"""Hard negatives against all pairs in plain Python integers."""

import math
import random

import numpy as np
import pytest

from kindred.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, rid string, parts string, anchor string, round string, slot string, score string"


def brute(rows, every):
    own = []
    for i, (vid, vector, label, *_) in enumerate(rows):
        if label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            own.append((i, vid, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    order = lambda f: (-f[0], f[1] is None, f[1] or 0)
    for i, vid, label, a in own:
        if vid is None or vid % every:
            continue
        scored = [(sum(x * y for x, y in zip(a, b)), v, lab == label) for j, v, lab, b in own if j != i]
        for p, positive, _ in sorted([s for s in scored if s[2]], key=order)[:5]:
            fit = [s for s in scored if not s[2] and 30 * p <= 100 * s[0] <= 90 * p]
            for rank, (n, negative, _) in enumerate(sorted(fit, key=order)[:10], 1):
                yield vid, positive, rank, negative, p, n


def rows_of_all_kinds(scale, seed=3):
    rng = random.Random(seed)
    vector = lambda n=6: [rng.uniform(-1, 1) * scale for _ in range(n)]
    out = [(i, vector(), rng.randrange(4)) for i in range(400)]
    out += [(400 + i, [0.5 * scale] * 6, i % 3) for i in range(150)]  # one vector many times: ties
    out += [(10, vector(), 1), (20, out[20][1], out[20][2]), (20, out[20][1], out[20][2])]  # ids and rows that repeat
    out += [(None, vector(), 1), (600, None, 1), (610, vector(), None), (620, [1.0, None], 2), (630, [float("nan")], 2), (640, [float("inf")], 2)]
    return out + [(650, [], 1), (660, vector(3), 1), (670, vector(9), 2), (-30, vector(), 2), (680, [0.0] * 6, 3)]


@pytest.mark.parametrize(("scale", "round_anchors"), [(1.0, 1000), (1.0, 7), (1e6, 1000)])
def test_negatives_equal_all_pairs(spark, scale, round_anchors):
    rows = rows_of_all_kinds(scale)
    table = spark.createDataFrame([(*r, "a", "b", "c", "d", "e", "f") for r in rows], SCHEMA).repartition(5)
    got = hard_negatives.mine(table, every=10, round_anchors=round_anchors)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute(rows, 10), key=str)


def test_scores_beyond_doubles_are_exact():
    rng = random.Random(1)
    for top in (1, 300, 10**5, 10**30):
        vectors = [np.array([float(rng.randint(-top, top)) for _ in range(rng.randint(0, 7))]) for _ in range(23)]
        fields = hard_negatives.Fields(7, (-top, top), (-top, top))
        assert fields.doubles == (top < 10**5)
        mine, theirs = fields.matrix(vectors[:9], -top), fields.matrix(vectors, -top)
        got = fields.scores(mine, fields.pack(theirs), theirs)
        want = [[sum(int(x) * int(y) for x, y in zip(a, b)) for b in vectors] for a in vectors[:9]]
        # 10**30 is no double; what is compared is what the doubles hold.
        assert [[int(v) for v in row] for row in got] == want


def test_huge_scores_end_at_64_bits(spark):
    rows = [(0, [1e30, 1.0], 1), (1, [1e30, 2.0], 1), (2, [1e30, 3.0], 1), (3, [5e29, 0.0], 2), (4, [6e29, 0.0], 2)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = hard_negatives.mine(table, every=10).collect()
    assert {(r.positive_id, r.rank, r.negative_id) for r in got} == {(1, 1, 4), (1, 2, 3), (2, 1, 4), (2, 2, 3)}
    assert {r.negative_score for r in got} == {2**63 - 1}


def test_no_anchors_and_no_rows(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.mine(empty).count() == 0
    one = spark.createDataFrame([(100, [1.0], 1), (7, [1.0], 2)], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.mine(one).count() == 0
