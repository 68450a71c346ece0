"""Comparing the members of hash buckets without emitting their pairs.

A bucket of up to ``chunk`` members is one unit of work. A larger one (a hot group may hold a
third of all rows) is dealt into chunks by a hash of the member, and every pair of chunks is a
unit of its own: every pair of members still meets in exactly one unit, no task gets more than
two chunks at a time, and units of one bucket spread over all tasks. Inside a unit numpy
compares the members and only a spanning forest of the links it finds leaves the task.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popweave.llm.common import parts

UNIT = ["key", "ui", "uj"]


def units(members: DataFrame, item: str, chunk: int) -> DataFrame:
    """``members`` has ``key`` (the bucket) and ``item``; buckets of one member go.

    Adds the unit (``ui``, ``uj``) and ``own``, the member's chunk; deals units to partitions
    and sorts them there, ready for ``whole_groups``.
    """
    counts = members.groupBy("key").agg(F.count("*").alias("_n")).filter("_n > 1")
    # buckets grow with the corpus: merged at any size, never broadcast through the driver
    return deal(members.join(counts.hint("merge"), "key"), item, chunk)


def deal(members: DataFrame, item: str, chunk: int) -> DataFrame:
    """``units`` for members that carry their bucket's count ``_n``."""
    chunks = F.ceil(F.col("_n") / F.lit(chunk)).cast("int")
    met = (members.withColumn("own", F.pmod(F.xxhash64(F.lit(7), F.col(item)), chunks).cast("int"))
           .withColumn("_other", F.explode(F.sequence(F.lit(0), chunks - 1)))
           .withColumn("ui", F.least("own", "_other")).withColumn("uj", F.greatest("own", "_other"))
           .drop("_n", "_other"))
    return met.repartition(parts(members), *UNIT).sortWithinPartitions(*UNIT)


def meets(own: np.ndarray, ui: int, uj: int) -> np.ndarray | None:
    """Which pairs of a unit's members are this unit's to compare (None: all)."""
    return None if ui == uj else own[:, None] != own[None, :]


def forest(adjacent: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric boolean matrix."""
    unseen = np.ones(len(adjacent), bool)
    edges = []
    for root in range(len(adjacent)):
        if not unseen[root]:
            continue
        unseen[root] = False
        todo = [root]
        while todo:
            at = todo.pop()
            found = np.flatnonzero(adjacent[at] & unseen)
            if len(found):
                unseen[found] = False
                edges.extend((at, int(x)) for x in found)
                todo.extend(found.tolist())
    return edges
