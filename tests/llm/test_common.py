import random

import pytest

from mendframe.llm import common


def plain(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    linked = {x for a, b in links if a != b for x in (a, b)}
    return {x: find(x) for x in linked}


@pytest.mark.parametrize("chunk", [1 << 20, 40])
def test_components(spark, monkeypatch, chunk):
    """In one task, and over many tasks that each see a part: chains, hubs, loops and repeats."""
    monkeypatch.setattr(common, "CHUNK", chunk)
    generator = random.Random(chunk)
    links = [(i, i + 1) for i in range(0, 120)] + [(1000, 1000 + i) for i in range(1, 90)] + [(5, 5), (3, 4), (4, 3), (-7, 2**62)]
    links += [(generator.randrange(2000, 2300), generator.randrange(2000, 2300)) for _ in range(140)]
    generator.shuffle(links)
    frame = spark.createDataFrame(links, "a long, b long").repartition(6)
    rows = common.components(frame).collect()
    assert {r["node"]: r["root"] for r in rows} == plain(links) and len(rows) == len(plain(links))


def test_no_links(spark):
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert common.components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0
