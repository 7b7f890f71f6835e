"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passgrid.session import stage


LOCAL_LINKS = 200_000
CROWD, MOST_CROWDS = 100, 10_000


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a partition as stars around the smallest node of each of its components."""
    parts = [np.stack([b.column("u").to_numpy(), b.column("v").to_numpy()]) for b in batches if len(b)]
    if not parts:
        return
    nodes, ends = np.unique(np.concatenate(parts, axis=1), return_inverse=True)
    parent = list(range(len(nodes)))

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for x, y in zip(*ends.reshape(2, -1).tolist()):
        x, y = top(x), top(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    roots = np.array([top(i) for i in range(len(nodes))])
    inner = np.flatnonzero(roots != np.arange(len(nodes)))
    yield pa.RecordBatch.from_pydict({"u": nodes[inner], "v": nodes[roots[inner]]})


def _star_round(links: DataFrame) -> DataFrame:
    """Hang a node's larger neighbours, then all but the smallest of its smaller ones, under the smallest of them."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    moved = large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` of every node that a link between different nodes touches; root is the smallest node reachable.

    Links are dealt into portions of about ``LOCAL_LINKS``, each of which a task contracts by itself. They are dealt by
    their larger node, which has one link at most once portions are contracted, so that the many links of one root are
    spread evenly. With several portions, rounds of alternating star contraction follow, whose number grows with the logarithm of the longest path,
    until nothing changes. There neighbourhoods are reduced to their minimum before a shuffle and never collected. A
    round is written to the shared folder, so that a lost executor costs one round. Links with a null end are ignored;
    nodes are 64-bit integers.
    """
    x, y = F.col(a).cast("bigint"), F.col(b).cast("bigint")
    now = stage(edges.filter(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct(), "links")
    state = None
    while True:
        seen = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if seen == state or not seen["n"]:
            break
        state = seen
        portions = -(-seen["n"] // LOCAL_LINKS)
        dealt = now.coalesce(1) if portions == 1 else now.repartition(portions, "u")
        now = dealt.mapInArrow(_contract, "u bigint, v bigint")
        if portions == 1:
            now = stage(now, "links")
            break
        now = stage(_star_round(stage(now, "links")), "links")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def join_crowded(rows: DataFrame, unique: DataFrame, key: str, count: str) -> DataFrame:
    """The inner join on ``key``, of which ``unique`` has one row each with the ``count`` of its ``rows``.

    Keys of more than ``CROWD`` rows and more than one in ``MOST_CROWDS`` of all rows, of which there are fewer than
    ``MOST_CROWDS``, are broadcast; their rows, and those with a null key, aren't shuffled. ``unique`` is read three
    times and should be a written table.
    """
    total = unique.agg(F.coalesce(F.sum(count), F.lit(0))).first()[0]
    crowded = F.col(count) > max(CROWD, -(-total // MOST_CROWDS))
    many = unique.filter(crowded)
    rest = rows.filter(F.col(key).isNotNull()).join(F.broadcast(many.select(key)), key, "left_anti")
    return rows.join(F.broadcast(many), key).unionByName(rest.join(unique.filter(~crowded), key))


def resolve(classes: DataFrame, found: DataFrame) -> DataFrame:
    """``cls, class_id, members, n_links, component_id`` of every class, as a written table.

    ``classes`` has ``cls, class_id, members`` (the smallest id and the number of a class's copies); ``found`` has, once
    for each task that compared a class, ``cls, linked`` (copies linked to it there) and ``other`` (a class to which
    it is linked, directly or not). Copies of a class count as linked.
    """
    linked = found.groupBy("cls").agg(F.sum("linked").alias("linked"))
    reached = components(found, "cls", "other").withColumnRenamed("node", "cls")
    reached = stage(reached, "reached")
    names = reached.join(classes, "cls").groupBy("root")
    names = stage(names.agg(F.min("class_id").alias("component_id"), F.count("*").alias("_n")), "names")
    reached = join_crowded(reached, names, "root", "_n").select("cls", "component_id")
    return stage(
        classes.join(linked, "cls", "left")
        .join(reached, "cls", "left")
        .select(
            "cls",
            "class_id",
            "members",
            (F.col("members") - 1 + F.coalesce("linked", F.lit(0))).cast("bigint").alias("n_links"),
            F.coalesce("component_id", "class_id").alias("component_id"),
        ),
        "resolved",
    )
