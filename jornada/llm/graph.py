"""Connected components of a graph of links, without gathering it anywhere."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Links that one task of a round handles.
TASK_LINKS = 500_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each id that a task's links join to a smaller one, with the smallest it reaches there."""
    above: dict[int, int] = {}

    def top(x):
        while (up := above.get(x, x)) != x:
            above[x] = above.get(up, up)
            x = up
        return x

    for batch in batches:
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            p, q = top(x), top(y)
            if p != q:
                above[max(p, q)] = min(p, q)
    ids = list(above)
    for at in range(0, len(ids), 10_000):
        part = ids[at:at + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array([top(x) for x in part], pa.int64()), pa.array(part, pa.int64())],
                                         ["a", "b"])


def forest(links: DataFrame) -> DataFrame:
    """Links (a, b) that connect whatever the given ones connect: of each task's links one
    star per component, with its smallest id as ``a``. No task's part holds a chain."""
    return links.select("a", "b").mapInArrow(_forest, "a bigint, b bigint")


def connected(links: DataFrame) -> DataFrame:
    """(id, comp) of every linked id: the smallest id reachable over the links.

    Each round gives every node the least label around it, then the label of that label,
    so rounds grow with the logarithm of a chain's length. Chains are at most as long as the number
    of tasks twice over, since each task's links are turned into stars first. The tasks of a
    round follow the number of links; only counts reach the driver.
    """
    links = written(forest(links), "cc-links")
    tasks = links.count() // TASK_LINKS + 1
    stars = written(forest(links.coalesce(tasks)), "cc-stars")
    edges = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b"))).coalesce(tasks)
    labels = written(edges.groupBy("a").agg(F.min("b").alias("m"))
                     .select(F.col("a").alias("id"), F.least("a", "m").alias("comp")).coalesce(tasks), "cc-labels")
    while True:
        around = (edges.join(labels.toDF("b", "near"), "b").groupBy("a").agg(F.min("near").alias("near"))
                  .withColumnRenamed("a", "id"))
        step = labels.join(around, "id").select("id", F.least("comp", "near").alias("comp"), F.col("comp").alias("old"))
        step = step.join(labels.toDF("comp", "further"), "comp").select(
            "id", F.least("comp", "further").alias("comp"), "old")
        step = written(step.coalesce(tasks), "cc-labels")
        labels = step.select("id", "comp")
        if step.where("comp <> old").isEmpty():
            return labels
