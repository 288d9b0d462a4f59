"""Connected components against union-find, by broadcast and by shuffle, and the tasks that a path takes."""

import random

import pytest

from civicspark.llm import components
from civicspark.session import drop_cut


def plain(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {x: root(x) for x in parent}


def graph():
    rnd = random.Random(5)
    path = rnd.sample(range(1000, 1060), 60)
    dense = [(rnd.randrange(2000, 2200), rnd.randrange(2000, 2200)) for _ in range(150)]
    return [(1, None), (2, 2), (5, 9), (9, 7), (7, 8), (8, 5), (20, 30), (31, 30), (31, 20), *zip(path, path[1:]), *dense]


@pytest.mark.parametrize("few", [components.FEW, 3])
def test_components_equal_union_find(spark, monkeypatch, few):
    monkeypatch.setattr(components, "FEW", few)
    for edges in ([], graph()):
        out = components.connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b")
        got = [tuple(r) for r in out.select("node", "component").collect()]
        drop_cut(out)
        assert len(got) == len(dict(got))
        assert dict(got) == plain(edges)


def test_a_path_takes_few_tasks(spark):
    """Every exchange is a task for each partition, however few the edges are."""
    settings = {"spark.sql.shuffle.partitions": "50", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    edges = spark.createDataFrame([(k, k + 1) for k in range(1, 60)], "a long, b long")
    sc = spark.sparkContext
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        sc.setJobGroup("path", "path")
        out = components.connected_components(edges, "a", "b")
        assert out.where("component = 1").count() == 60
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    drop_cut(out)
    seen = sc.statusTracker()
    stages = {s for job in seen.getJobIdsForGroup("path") for s in seen.getJobInfo(job).stageIds}
    assert sum(info.numCompletedTasks for s in stages if (info := seen.getStageInfo(s))) < 2100
