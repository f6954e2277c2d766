"""Connected components of a link table, by alternating star steps.

Each step is a grouped minimum and a join, so a node with very many links is
reduced before the shuffle. Every round is written to the shared folder, which
cuts the lineage; nothing is brought to the driver but two numbers a round.
Once there are no more than ``TASK_LINKS`` links, one task finishes them: a
round over so few costs more in tasks than in work. The result is the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textstyle.session import delete_folders, write_through

#: Links (16 bytes each) that one task finishes by itself.
TASK_LINKS = 1 << 21


def components(
    edges: DataFrame, task_links: int = TASK_LINKS, paths: list[str] | None = None
) -> DataFrame:
    """``(node, root)`` of every node of ``edges`` (``u, v``, any orientation).

    ``root`` is the least node of the component. Loops, repeated links and
    rows with a null end add nothing; no edges give no rows. Only the last
    round's table is left; its folder is added to ``paths``.
    """
    links = _oriented(edges.select("u", "v"))
    folders: list[str] = []
    links, state = _written(links, folders)
    while state[0] > task_links:
        before, folders = folders, []
        links, now = _written(_small_star(_large_star(links)), folders)
        delete_folders(links.sparkSession, before)
        if now == state:
            break
        state = now
    if paths is not None:
        paths.extend(folders)
    if state[0] <= task_links:
        return links.coalesce(1).mapInArrow(_finish, "node bigint, root bigint")
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _oriented(links: DataFrame) -> DataFrame:
    """Each link once, from the larger node to the smaller."""
    high, low = F.greatest("u", "v"), F.least("u", "v")
    return links.where("u <> v").select(high.alias("u"), low.alias("v")).distinct()


def _written(links: DataFrame, paths: list[str]) -> tuple[DataFrame, tuple]:
    links = write_through(links, "components", paths)
    sums = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")
    return links, tuple(links.agg(F.count("*").alias("n"), sums).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the node's least neighbour."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    moved = both.where("v > u").join(least, "u")
    return _oriented(moved.select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(links: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the least of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _oriented(moved.unionByName(least.select("u", F.col("m").alias("v"))))


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Least labels along links, with shortcuts, until nothing changes."""
    links = [[b.column(k).to_numpy() for k in range(2)] for b in batches]
    if not links:
        return
    u, v = (np.concatenate([link[k] for link in links]) for k in range(2))
    nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    u, v = place[: len(u)], place[len(u) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[u], label[v])
        new = label.copy()
        for end in (u, v):
            np.minimum.at(new, end, least)
            np.minimum.at(new, label[end], least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    yield pa.RecordBatch.from_arrays(
        [pa.array(nodes), pa.array(nodes[label])], ["node", "root"]
    )
