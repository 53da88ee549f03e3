"""Connected components of a graph of links, with joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.sources.shared import checkpointed


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every node with a link; the component is its smallest node.

    Each round hooks every node to its smallest neighbour below it, follows the hooks to their
    ends, and goes on with the links between different ends, so a star or a run of copies takes one
    round and any graph a logarithmic number in practice. What a round keeps is checkpointed.

    Links with a null end or from a node to itself are ignored; repeated links are one. Without
    links the result is empty. A hub's links are aggregated on their far ends, which differ.
    """
    kind = links.schema[a].dataType
    # The comparison drops null ends as well.
    edges = checkpointed(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .distinct()
    )
    found = None
    while edges.head(1):
        hooks = _followed(edges.groupBy("hi").agg(F.min("lo").alias("to")))
        # Nodes hooked in this round now point to their ends; earlier ones are led on.
        if found is None:
            found = hooks.select(F.col("hi").alias("node"), F.col("to").alias("component"))
        else:
            led = found.join(hooks, found["component"] == hooks["hi"], "left")
            found = led.select("node", F.coalesce("to", "component").alias("component")).unionAll(
                hooks.select("hi", "to")
            )
        found = checkpointed(found)
        # The larger end first: a hub's links all end there and need no second look.
        moved = edges.join(hooks, "hi").where("to != lo").select(F.col("to").alias("x"), "lo")
        other = moved.join(hooks, moved["lo"] == hooks["hi"], "left")
        other = other.select("x", F.coalesce("to", "lo").alias("y")).where("x != y")
        edges = checkpointed(
            other.select(F.greatest("x", "y").alias("hi"), F.least("x", "y").alias("lo")).distinct()
        )
    spark = links.sparkSession
    if found is None:
        name = kind.simpleString()
        return spark.createDataFrame([], f"node {name}, component {name}")
    roots = found.select(F.col("component").alias("node"), "component").distinct()
    return found.unionAll(roots)


def _followed(hooks: DataFrame) -> DataFrame:
    """Every hook led on to the end of its chain; each step doubles the way."""
    while True:
        hooks = checkpointed(hooks)
        onward = hooks.select(F.col("hi").alias("at"), F.col("to").alias("next"))
        ahead = hooks.join(onward, hooks["to"] == onward["at"], "left")
        if not ahead.where("next IS NOT NULL").head(1):
            return hooks
        hooks = ahead.select("hi", F.coalesce("next", "to").alias("to"))
