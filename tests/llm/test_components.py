"""Components against a plain search, and how often edges are written until they are found."""

import random

import pytest

from tallyforge.llm import components as c


def brute(edges):
    root = {}

    def find(n):
        while root.setdefault(n, n) != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    ends = {n for e in edges if e[0] != e[1] for n in e}
    return {n: find(n) for n in ends}


def found(spark, edges):
    rows = c.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    got = {r.node: r.component for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.fixture
def writes(monkeypatch):
    seen, written = [], c.written
    monkeypatch.setattr(c, "written", lambda frame, label: seen.append(label) or written(frame, label))
    return seen


def test_long_paths_take_few_rounds(spark, writes):
    names = random.Random(1).sample(range(-(1 << 61), 1 << 61), 3000)
    edges = [*zip(names, names[1:]), (names[0], names[0])]
    random.Random(2).shuffle(edges)
    assert found(spark, edges) == brute(edges)
    assert len(writes) <= 5


def test_stars_are_not_written_again(spark, writes):
    edges = [(0, n) for n in range(1, 50)] + [(100, n) for n in range(101, 120)]
    assert found(spark, edges) == brute(edges)
    assert len(writes) == 1


def test_any_graph(spark):
    toss = random.Random(5)
    edges = [(toss.randrange(400), toss.randrange(400)) for _ in range(260)] + [(900, 900)]
    assert found(spark, edges) == brute(edges)
    assert found(spark, [(7, 7)]) == {}
