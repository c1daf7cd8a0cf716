"""Connected components of a graph given as edges, by repeated min-label rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import drop_table, write_table


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, component) for every end of ``edges`` (a, b); component is the
    smallest id reachable.  Ids may be of any ordered type; null ends and
    loops are ignored.

    Each round sends along every edge the label of one end to the other end
    and to that end's own label (so whole trees hook at once), then replaces
    labels by their labels; messages are pre-aggregated per receiver, so a hub
    with a third of all edges costs one row per task.  Labels are written to
    the shared folder after each round, which ends when none changed.
    """
    links = edges.where("a is not null and b is not null and a != b").select("a", "b")
    both = write_table(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                       f"{name}-edges")
    labels = write_table(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m"))
                         .select("id", F.least("id", "m").alias("component")), f"{name}-labels")
    while True:
        source = labels.select(F.col("id").alias("a"), F.col("component").alias("of_a"))
        target = labels.select(F.col("id").alias("b"), F.col("component").alias("of_b"))
        sent = (both.join(source, "a").join(target, "b").where("of_b < of_a")
                .select(F.explode(F.array("a", "of_a")).alias("id"), F.col("of_b").alias("m"))
                .groupBy("id").agg(F.min("m").alias("m")))
        hooked = write_table(labels.join(sent, "id", "left")
                             .select("id", F.coalesce("m", "component").alias("component")), f"{name}-hooked")
        up = hooked.select(F.col("id").alias("component"), F.col("component").alias("above"))
        jumped = (hooked.join(up, "component", "left")
                  .select("id", F.coalesce("above", "component").alias("component")))
        old, labels = labels, write_table(jumped, f"{name}-labels")
        changed = not labels.join(old.withColumnRenamed("component", "before"), "id").where(
            "component != before").isEmpty()
        drop_table(hooked)
        drop_table(old)
        if not changed:
            drop_table(both)
            return labels
