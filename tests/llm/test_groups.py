import random

import pytest

from plumbline.llm.groups import linked_groups


def brute(pairs):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(parent)}


RNG = random.Random(5)
CASES = {
    "chain": [(i, i + 1) for i in range(90)],
    "ring": [(i, (i + 1) % 17) for i in range(17)],
    "star": [(0, i) for i in range(1, 60)],
    "comb": [(i, i + 1) for i in range(20)] + [(i, 100 + i) for i in range(20)],
    "dense": [(RNG.randrange(30), RNG.randrange(30)) for _ in range(200)],
    "two_rings_and_a_bridge": [(i, (i + 1) % 5) for i in range(5)] + [(10 + i, 10 + (i + 1) % 6) for i in range(6)] + [(2, 13)],
    "mixed": [(RNG.randrange(90), RNG.randrange(90)) for _ in range(70)] + [(None, 1), (1, None), (4, 4), (3, 9), (9, 3), (3, 9)],
    "only_selves": [(1, 1), (2, None)],
    "nothing": [],
}


@pytest.mark.parametrize("name", CASES)
def test_groups_equal_union_find(spark, name):
    ids = list(range(1, 400))
    RNG.shuffle(ids)
    pairs = [tuple(None if x is None else ids[x] for x in p) for p in CASES[name]]
    df = spark.createDataFrame(pairs, "a long, b long").selectExpr("a", "b", "a as u", "b as x", "1 as parent")
    got = [tuple(r) for r in linked_groups(df, "a", "b").collect()]
    assert len(got) == len(dict(got)) and dict(got) == brute(pairs)
