"""Connected components of a link table, by randomised contraction in rounds.

Every round each node hooks to the neighbour (or itself) of smallest hash; links are relabelled,
loops and repeats go.  The number of nodes falls by a constant factor a round, so chains of any
length and hubs of any degree end after a few rounds; no round collects a node's neighbours
anywhere (``min`` is combined before the shuffle, and hub joins are ones that Spark can split).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir


def _hash(c: str, turn: int):
    return F.xxhash64(F.col(c), F.lit(turn))


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every id in ``links`` (a, b); root is one id per component.

    Links may repeat, be reversed or be loops; an empty table gives an empty result.
    """
    ensure_checkpoint_dir(links.sparkSession)
    edges = (links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
             .where("a < b").distinct().checkpoint())
    hooks = []
    while not edges.isEmpty():
        turn = len(hooks)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy(F.col("a").alias("id")).agg(F.min(F.struct(_hash("b", turn).alias("h"), "b")).alias("m"))
        here = F.struct(_hash("id", turn).alias("h"), F.col("id").alias("b"))
        hook = best.select("id", F.least(F.col("m"), here)["b"].alias("to")).checkpoint()
        hooks.append(hook)
        edges = (edges.join(hook.select(F.col("id").alias("a"), F.col("to").alias("ta")), "a")
                 .join(hook.select(F.col("id").alias("b"), F.col("to").alias("tb")), "b")
                 .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b"))
                 .where("a < b").distinct().checkpoint())
    if not hooks:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("root"))
    roots = None
    for hook in reversed(hooks):                     # the last round holds the fewest nodes
        if roots is None:
            roots = hook.select("id", F.col("to").alias("root"))
        else:
            up = roots.select(F.col("id").alias("to"), "root")
            roots = hook.join(up, "to", "left").select("id", F.coalesce("root", "to").alias("root"))
    return roots
