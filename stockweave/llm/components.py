"""Connected components by contraction over tables in the shared folder.

Every round each node picks its neighbour of smallest hash, points to the
smaller of that one and the one it picked, and the edges are rewritten between
the nodes pointed to. Hashes are salted by the round, so a chain shrinks by a
constant share each time, and two nodes that picked each other become one. A
star of any size is gone after one round: all leaves pick the hub, so all point
to the hub or the leaf that it picked, whichever is smaller. (Were a node free
to keep itself, all leaves of smaller hash than the hub would: a round for each
time e divides the star.) No link or label is ever collected; the driver only
asks whether edges are left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stockweave.llm import common as C


def _ranked(node: Column, turn: int) -> Column:
    return F.struct(F.xxhash64(node, F.lit(turn)).alias("h"), node.alias("v"))


def components(edges: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """node, root for each node of ``edges`` (columns a, b of one orderable type); nodes of one component share a root.

    Repeated edges, both directions and loops may occur; an empty table gives none.
    With ``known``, an earlier result, of the edges it came from and these: only its roots are contracted further.
    """
    kind, spark = edges.schema["a"].dataType, edges.sparkSession
    with C.collected() as old:
        for end in "ab" if known is not None else "":
            own = known.select(F.col("node").alias("v"), "root")
            edges = edges.join(own, F.col(end) == F.col("v"), "left").withColumn(end, F.coalesce("root", end)).select("a", "b")
        # Repeated edges are harmless here; the first round leaves each once.
        edges = C.staged(edges.select("a", "b"), "cc-edges")
    rounds, steps = [], []
    while True:
        turn = len(rounds)
        with C.collected() as new:
            both = edges.union(edges.select("b", "a"))
            lowest = both.groupBy("a").agg(F.min(_ranked(F.col("b"), turn)).alias("m"))
            further = lowest.select(F.col("a").alias("w"), F.col("m").alias("m2"))
            points = lowest.join(further, F.col("m.v") == F.col("w")).select(F.col("a").alias("v"), F.least("m", "m2")["v"].alias("to"))
            points = C.staged(points, "cc-points")
            one = edges.join(points, F.col("a") == F.col("v")).select(F.col("to").alias("a"), "b")
            two = one.join(points, F.col("b") == F.col("v")).select("a", F.col("to").alias("b"))
            edges = C.staged(two.filter(F.col("a") != F.col("b")).distinct(), "cc-edges")
        rounds.append(points)
        steps += new[:1]
        # The next round reads the new edges only; the labels need where the nodes of each round pointed.
        C.discard(spark, old)
        old = new[1:]
        if edges.isEmpty():
            break
    labels = None
    for points in reversed(rounds):
        own = points.select(F.col("v").alias("node"), "to")
        if labels is not None:
            later = labels.select(F.col("node").alias("v"), "root")
            own = own.join(later, F.col("to") == F.col("v"), "left").select("node", F.coalesce("root", "to").alias("to"))
        labels = own.select("node", F.col("to").alias("root"))
    if known is not None:
        # Nodes new to these edges match no known root.
        later = labels.select(F.col("node").alias("v"), F.col("root").alias("to"))
        labels = known.join(later, F.col("root") == F.col("v"), "full_outer").select(F.coalesce("node", "v").alias("node"), F.coalesce("to", "root").alias("root"))
    labels = C.staged(labels, "cc-labels")
    C.discard(spark, [*steps, *old])
    return labels.select(F.col("node").cast(kind), F.col("root").cast(kind))
