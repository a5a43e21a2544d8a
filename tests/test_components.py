"""Components of edges by one task and by steps, and how many tables they take."""

from __future__ import annotations

import random

import pytest

from sparkloom import storage
from sparkloom.llm import near_dup
from sparkloom.operators import components as module


@pytest.fixture
def tables(monkeypatch):
    """Names of the tables that are written."""
    found: list[str] = []

    def written(df, name, values=None, real=storage.written):
        found.append(name)
        return real(df, name, values)

    for place in (storage, module):
        monkeypatch.setattr(place, "written", written)
    return found


def plain(edges):
    low = {x: x for e in edges if e[0] != e[1] for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a != b and low[a] != low[b]:
                low[a] = low[b] = min(low[a], low[b])
                changed = True
    return low


@pytest.fixture(scope="module")
def graph():
    """A chain in mixed order, stars, a pair, a loop; each edge twice, in both directions."""
    r = random.Random(4)
    names = r.sample(range(-500, 500), 300)
    edges = list(zip(names[:120], names[1:120], strict=False)) + [(names[120 + i // 30 * 30], names[120 + i]) for i in range(90) if i % 30] + [(names[298], names[299]), (names[250], names[250])]
    edges += [(b, a) for a, b in edges]
    r.shuffle(edges)
    return edges


@pytest.mark.parametrize(("share", "one_task"), [(0, False), (300, True), (module.SHARE, True)])  # by steps alone, by one task after the first step, by one task
def test_components_against_a_plain_loop(spark, graph, tables, share, one_task):
    edges = spark.createDataFrame(graph, "a long, b long").repartition(20)
    out = [(r["node"], r["component"]) for r in module.components(edges, share).collect()]
    assert len(out) == len(dict(out)) and dict(out) == plain(graph)
    assert len(tables) == (1 if share == module.SHARE else 2) if one_task else len(tables) > 2


@pytest.mark.parametrize("share", [-1, module.SHARE])
def test_no_edges_have_no_components(spark, share):
    edges = spark.createDataFrame([], "a long, b long")
    assert module.components(edges, share).collect() == []


def test_near_duplicates_of_a_small_table_take_few_tables(spark, tables):
    """Each table is a job that a small table pays for in all its tasks, so a long chain of near duplicates takes no more of them."""
    r = random.Random(5)
    words, rows = [f"w{r.randrange(10**6)}" for _ in range(150)], []
    for k in range(40):
        rows.append((r.randrange(10**6), " ".join(words)))
        words = words[6:] + [f"v{k}x{j}" for j in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(20)
    out = near_dup.near_duplicates(docs).collect()
    assert {r["group_id"] for r in out} == {min(d for d, _ in rows)} and len(out) == 40
    assert tables == ["described", "classes", "pairs", "edges", "placed", "links", "edges"]
