import random

import pytest

from lumenflow.llm import components as module
from lumenflow.llm.components import components


def expected(links):
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in links:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return sorted((i, find(i)) for i in root)


def cases_of(kind):
    rng = random.Random(kind)
    name = lambda i: rng.getrandbits(0).to_bytes(1, "big") + i.to_bytes(3, "big")      # noqa: E731
    if kind == 0:
        pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)]
    elif kind == 1:                                     # a chain in falling order, the worst for small labels
        pairs = [(i, i + 1) for i in range(40)]
    elif kind == 2:                                     # stars that meet
        pairs = [(0, i) for i in range(1, 200)] + [(500, i) for i in range(150, 300)] + [(7, 7), (3, 0)]
    else:
        pairs = [(900, 901), (901, 900), (5, 5)]
    return [(name(a), name(b)) for a, b in pairs]


@pytest.mark.parametrize("kind", range(4))
def test_components_equal_union_find(spark, kind):
    links = cases_of(kind)
    got = components(spark.createDataFrame(links, "a binary, b binary"))
    assert sorted((bytes(r["node"]), bytes(r["comp"])) for r in got.collect()) == expected(links)


def test_no_links(spark):
    got = components(spark.createDataFrame([], "a binary, b binary"))
    assert got.columns == ["node", "comp"] and got.collect() == []


def test_settled_links_leave(spark, monkeypatch):
    """A star is one round: its links are not carried on."""
    sizes = []
    real = module.materialize

    def counted(df, name="stage"):
        out = real(df, name)
        if name == "links":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(module, "materialize", counted)
    components(spark.createDataFrame([((0).to_bytes(4, "big"), i.to_bytes(4, "big")) for i in range(1, 500)], "a binary, b binary"))
    assert sizes == [499, 0]
