"""Connected components of a graph given as pairs of numbers, by repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions.columns import same_key
from tierline.llm.common import stage


def _links(df: DataFrame) -> DataFrame:
    return df.filter("u <> v").distinct()


def _shape(links: DataFrame) -> tuple[bool, bool]:
    """Whether some number hangs on several others, and whether some number that hangs on another has others on it."""
    sides = [links.select(F.col(c).alias("n"), F.lit(i).alias("up"), F.lit(1 - i).alias("down")) for i, c in enumerate("vu")]
    nodes = sides[0].unionByName(sides[1]).groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    row = nodes.agg(F.max(F.col("up") > 1), F.max((F.col("up") > 0) & (F.col("down") > 0))).first()
    return bool(row[0]), bool(row[1])


def _climbed(links: DataFrame) -> DataFrame:
    """Links of trees, each number to its tree's root: who a number hangs on is replaced by who that one hangs on."""
    moved = True
    while moved:
        onward = links.select(F.col("u").alias("n"), F.col("v").alias("m"))
        steps = links.join(onward, F.col("v") == F.col("n"), "left")
        steps = stage(steps.select("u", F.coalesce("m", "v").alias("v"), F.isnotnull("m").alias("moved")), "links")
        links, moved = steps.drop("moved"), not steps.filter("moved").isEmpty()
    return links


def components(pairs: DataFrame) -> DataFrame:
    """``id, component`` for every number in ``pairs`` (``u, v``): the smallest one reachable.

    Links go from larger to smaller numbers. While a number has several links, each round hangs the
    larger neighbours of every node, and then the others, on its smallest neighbour: about log(n)
    rounds for the square of that at worst. When every number has one link, what is left are trees,
    which are climbed in steps of twice the length each time. A node with very many neighbours is
    folded by partial aggregation and split in the join. Every round is written to the shared
    folder. An empty input gives no rows.
    """
    links = stage(
        _links(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))), "links"
    )
    several, chained = _shape(links)
    while several:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
        least = least.withColumn("m", F.least("n", "m"))
        hung = both.join(least, same_key(["u"], ["n"])).filter("v > u")
        links = stage(hung.select(F.col("v").alias("u"), F.col("m").alias("v")), "links")
        least = links.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
        joined = links.join(least, same_key(["u"], ["n"]))
        links = stage(
            _links(
                joined.select(
                    F.explode(
                        F.array(
                            F.struct(F.col("u"), F.col("m").alias("v")),
                            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                        )
                    ).alias("e")
                ).select("e.u", "e.v")
            ),
            "links",
        )
        several, chained = _shape(links)
    if chained:
        links = _climbed(links)
    roots = links.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
