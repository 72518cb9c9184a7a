"""Connected components of a table of links, by alternating stars.

Every round hangs the larger neighbours of each node under its least neighbour, then the smaller
ones; links only ever get fewer or point lower, and the number of rounds grows with the logarithm
of the longest path. Minima are partial aggregates and links meet them by a join, so a node with
very many links is not one group in one task. Nothing is collected but two numbers a round.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareweather.llm.tasks import stored

MAX_ROUNDS = 60


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``component`` for every node of a link; the component is its least node.

    Links of a node with itself make it known; null ends are left out.
    """
    pairs = links.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x IS NOT NULL AND y IS NOT NULL")
    edges = stored(pairs.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct())
    before = None
    for _ in range(MAX_ROUNDS):
        edges = stored(_small_stars(_large_stars(edges)))
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if before == now:
            break
        before = now
    else:
        raise RuntimeError(f"links don't settle in {MAX_ROUNDS} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    ).distinct()


def _large_stars(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours, linked with the least of the node and all its neighbours.

    The least neighbours are stored first: then both sides of the join are plain shuffles, of which
    Spark can split what belongs to a node with very many neighbours.
    """
    least = stored(edges.filter("u != v").groupBy(F.col("u").alias("v")).agg(F.min("v").alias("m")))
    return edges.join(least, "v", "left").select("u", F.coalesce("m", "v").alias("v")).distinct()


def _small_stars(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours, linked with the least of them."""
    real = edges.filter("u != v")
    least = real.groupBy("u").agg(F.min("v").alias("m"))
    hung = real.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    alone = edges.filter("u = v")
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).unionByName(alone).distinct()


def merged(hub: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Hubs after joining pairs of hubs: always the least place that can be reached."""
    while len(p):
        low, high = np.minimum(p, q), np.maximum(p, q)
        hub = hub.copy()
        np.minimum.at(hub, high, low)
        while (hub[hub] != hub).any():
            hub = hub[hub]
        p, q = hub[p], hub[q]
        apart = p != q
        p, q = p[apart], q[apart]
    return hub
