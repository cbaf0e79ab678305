"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import materialize


def components(edges: DataFrame, src: str = "a", dst: str = "b") -> DataFrame:
    """(node, component): one representative for all nodes connected by ``edges``.

    Every round each node hooks on to the smallest of itself and its neighbours, and the
    graph is contracted: edges become edges between the hooks, and those inside one
    node go. With nodes that are hashes (as digests are) a round leaves a constant share
    of the edges, so about log n rounds do. Rounds are written to the checkpoint
    folder; only whether an edge is left reaches the driver. A hub is reduced map-side.
    """
    rest = materialize(edges.select(F.least(src, dst).alias("u"), F.greatest(src, dst).alias("v"))
                       .where("u <> v").distinct(), "edges")
    nodes = rest.select(F.col("u").alias("node")).union(rest.select("v")).distinct()
    labels = materialize(nodes.select("node", F.col("node").alias("component")), "labels")
    while rest.limit(1).count():
        both = rest.select("u", "v").union(rest.select("v", "u"))
        hooks = materialize(both.groupBy("u").agg(F.min("v").alias("m"))
                            .select(F.col("u").alias("at"), F.least("u", "m").alias("hook")), "hooks")
        # a hook's own hook, so that chains shorten faster
        up = hooks.select(F.col("at").alias("mid"), F.col("hook").alias("top"))
        hooks = materialize(hooks.join(up, hooks.hook == up.mid).select("at", F.col("top").alias("hook")), "hooks")
        a, b = (hooks.select(F.col("at").alias(f"at_{x}"), F.col("hook").alias(x)) for x in ("x", "y"))
        moved = rest.join(a, rest.u == a.at_x).join(b, F.col("v") == b.at_y)
        rest = materialize(moved.select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v"))
                           .where("u <> v").distinct(), "edges")
        labels = materialize(
            labels.join(hooks, labels.component == hooks["at"], "left")
            .select("node", F.coalesce("hook", "component").alias("component")), "labels")
    return labels
