import random

from churnlane.llm import components as C


def _labels(spark, links):
    rows = C.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(rows) == len({r.node for r in rows})
    return {r.node: r.label for r in rows}


def test_links_that_are_stars_already_need_no_round(spark, monkeypatch):
    kept = []
    cut = C.cut_lineage
    monkeypatch.setattr(C, "cut_lineage", lambda df: kept.append(df) or cut(df))
    assert _labels(spark, [(1, 5), (1, 7), (2, 9)]) == {1: 1, 5: 1, 7: 1, 2: 2, 9: 2}
    assert len(kept) == 1


def test_chains_in_any_order(spark):
    n = 60
    links = [(i, i + 1) for i in range(n)] + [(100 + i, 101 + i) for i in range(n)] + [(7, 7), (None, 3)]
    random.Random(5).shuffle(links)
    df = spark.createDataFrame(links, "a long, b long").repartition(16)
    got = {r.node: r.label for r in C.components(df).collect()}
    assert got == {**dict.fromkeys(range(n + 1), 0), **dict.fromkeys(range(100, 101 + n), 100)}


def _many_hubs(hubs=40, members=300):
    """Members linked with many hubs each, dealt so that no two links of a task touch."""
    return [(h, 1000 + m) for h in range(hubs) for m in range(members)], hubs + members


def test_a_group_with_many_hubs_keeps_fewer_edges_than_nodes(spark, monkeypatch):
    links, nodes = _many_hubs()
    kept = []
    cut = C.cut_lineage
    monkeypatch.setattr(C, "cut_lineage", lambda df: kept.append(cut(df)) or kept[-1])
    df = spark.createDataFrame(links, "a long, b long").repartition(60)
    assert {r.label for r in C.components(df).collect()} == {0}
    assert [x.count() for x in kept[1:]] == [nodes - 1]  # one forest, no rounds


def test_a_round_makes_no_more_rows_than_edges(spark):
    links, _ = _many_hubs(10, 30)
    e = spark.createDataFrame([(b, a) for a, b in links], "u long, v long")
    large = C._large_star(e)
    for df in (large, C._small_star(large)):
        assert df.count() <= len(links)
        assert "Generate" not in df._jdf.queryExecution().executedPlan().toString()


def test_rounds_over_random_links(spark, monkeypatch):
    monkeypatch.setattr(C, "LOCAL", 7)  # several forests, then rounds
    rng = random.Random(11)
    for n, m in ((40, 30), (60, 90)):
        links = [(rng.randrange(-n, n), rng.randrange(-n, n)) for _ in range(m)]
        label = {x: x for link in links if link[0] != link[1] for x in link}
        for _ in range(m):
            for a, b in links:
                if a != b:
                    label[a] = label[b] = min(label[a], label[b])
        df = spark.createDataFrame(links, "a long, b long").repartition(12)
        assert {r.node: r.label for r in C.components(df).collect()} == label
