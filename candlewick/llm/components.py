"""Connected components of a link table, all in joins: nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch

#: Rounds, and jumps in a round, after which the loop gives up; each halves what is left.
MAX_ROUNDS = 60


def connected_components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(vertex, component): each vertex of ``links`` (a, b) with the least vertex it can reach.

    Each round, every vertex hooks onto its least neighbour, pointer jumps flatten the trees this
    makes (in the logarithm of their depth), and links are redrawn between the roots, of which there
    are at most half as many as vertices. A vertex with very many links is one
    row per task in the map-side combined minimum, and its joins have plain keys that adaptive
    execution splits. Self-links are allowed; repeated links do not matter.
    """
    edges = scratch.cut(links.select("a", "b").where("a <> b").distinct(), f"{name}-edges-0")
    ends = edges.select(F.col("a").alias("vertex")).unionByName(edges.select(F.col("b").alias("vertex"))).distinct()
    labels = ends.select("vertex", F.col("vertex").alias("component"))  # written with the first round
    for i in range(1, MAX_ROUNDS + 1):
        if edges.isEmpty():
            return labels if i > 1 else scratch.cut(labels, f"{name}-labels-0")
        both = edges.select(F.col("a").alias("v"), F.col("b").alias("n")).unionByName(edges.select(F.col("b").alias("v"), F.col("a").alias("n")))
        hook = both.groupBy("v").agg(F.min("n").alias("n")).select("v", F.least("v", "n").alias("p"))
        hook = scratch.cut(hook, f"{name}-hook-{i}-0")
        for j in range(1, MAX_ROUNDS + 1):  # two jumps at a time
            one, two = (hook.select(F.col("v").alias(f"u{k}"), F.col("p").alias(f"p{k}")) for k in (1, 2))
            flat = hook.join(one, F.col("p") == F.col("u1")).join(two, F.col("p1") == F.col("u2"))
            flat = scratch.cut(flat.select("v", F.col("p2").alias("p"), (F.col("p1") != F.col("p2")).alias("moved")), f"{name}-hook-{i}-{j}")
            scratch.drop(f"{name}-hook-{i}-{j - 1}")
            hook, settled = flat.drop("moved"), flat.where("moved").isEmpty()
            if settled:
                break
        of_a = hook.select(F.col("v").alias("va"), F.col("p").alias("pa"))
        of_b = hook.select(F.col("v").alias("vb"), F.col("p").alias("pb"))
        moved = edges.join(of_a, F.col("a") == F.col("va")).join(of_b, F.col("b") == F.col("vb")).where("pa <> pb")
        edges = scratch.cut(moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), f"{name}-edges-{i}")
        new = labels.join(of_a, F.col("component") == F.col("va"), "left").select("vertex", F.coalesce("pa", "component").alias("component"))
        labels = scratch.cut(new, f"{name}-labels-{i}")
        scratch.drop(f"{name}-edges-{i - 1}", f"{name}-labels-{i - 1}", f"{name}-hook-{i}-{j}")
    raise RuntimeError("components did not settle")


def merge_components(labels: DataFrame, links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``labels`` (vertex, component) with the components that ``links`` join made one. Only the
    components that are linked, and vertices new to the labels, take part."""
    of_a = labels.select(F.col("vertex").alias("va"), F.col("component").alias("ca"))
    of_b = labels.select(F.col("vertex").alias("vb"), F.col("component").alias("cb"))
    drawn = links.join(of_a, F.col("a") == F.col("va"), "left").join(of_b, F.col("b") == F.col("vb"), "left")
    drawn = scratch.cut(drawn.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).where("a <> b").distinct(), f"{name}-drawn")
    if drawn.isEmpty():
        return labels
    joined = connected_components(drawn, scratch, name).select(F.col("vertex").alias("old"), F.col("component").alias("new"))
    out = labels.join(joined, F.col("component") == F.col("old"), "left").select("vertex", F.coalesce("new", "component").alias("component"))
    fresh = joined.join(labels, F.col("old") == F.col("vertex"), "left_anti").select(F.col("old").alias("vertex"), F.col("new").alias("component"))
    return scratch.cut(out.unionByName(fresh), f"{name}-merged")
