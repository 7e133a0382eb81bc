"""Connected components without collecting the graph, and size-capped clusters."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from archivolt.runtime import discard, materialize


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``node, root``: every node of an edge with the smallest node of its component.

    Distributed union-find: each round takes the smallest root among a node and its
    neighbours, hooks the old root there too, and halves the paths (root of the
    root). Each round is a pair of keyed joins with map-side minima, so a hub of
    any degree is only ever reduced to one value. Rounds grow with the logarithm
    of the longest path. Every round is written to the shared folder, so a lost
    executor costs no more than one round. Self-loops keep their node; nulls are
    ignored; no edges give no rows.
    """
    both = edges.select(F.col(u).alias("node"), F.col(v).alias("other")).where("node is not null and other is not null")
    both = materialize(both.unionByName(both.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct(), "edges")
    labels = materialize(both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("root")), "labels")
    changed = True
    while changed:  # a round lowers some root until every component has its smallest node, so this ends
        root_of = labels.select(F.col("node").alias("other"), F.col("root").alias("seen"))
        near = both.join(root_of, "other").groupBy("node").agg(F.min("seen").alias("seen"))
        offers = labels.join(near, "node").select("node", "root", F.least("root", "seen").alias("low"))
        # a node takes its own best offer and, as somebody's root, the best offer made to its tree
        hooks = offers.where("low < root").groupBy(F.col("root").alias("node")).agg(F.min("low").alias("hook"))
        hooked = offers.join(hooks, "node", "left").select("node", "root", F.least("low", F.coalesce("hook", "low")).alias("next"))
        up = hooked.select(F.col("node").alias("next"), F.col("next").alias("above"))
        moved = hooked.join(up, "next").select("node", F.least("next", "above").alias("new"), "root")
        new = materialize(moved, "labels")
        changed = new.where("new <> root").limit(1).count()
        discard(labels)
        labels = new.select("node", F.col("new").alias("root"))
        labels._archivolt_path = new._archivolt_path
    discard(both)
    return labels


def capped_clusters(edges: DataFrame, cap: int = 15, free: int = 70) -> DataFrame:
    """``node, cluster, size``: clusters grown best edge first under a size cap that edges of at least ``free`` ignore.

    ``edges`` has ``i, j, score`` with i < j. Free edges are order-free, so they are contracted first as
    plain components. Unions never cross a component of the whole graph, so the greedy
    phase then runs within each component on the contracted edges; a component whose clusters
    can never exceed the cap needs no greedy phase at all and is one cluster. Edges are taken by
    score, then larger i, then larger j. ``cluster`` is the smallest node. Nodes without an edge don't occur.
    """
    edges = materialize(edges.select("i", "j", "score"), "cappededges")
    # numbers in the order of the nodes stand for them: smaller to join, and to hold in one task
    names = materialize(numbered(edges.select(F.explode(F.array("i", "j")).alias("name")).distinct(), [F.col("name").asc()], "k"), "names")
    edges = materialize(edges.join(names.select(F.col("name").alias("i"), F.col("k").alias("u")), "i").join(names.select(F.col("name").alias("j"), F.col("k").alias("v")), "j").select(F.col("u").alias("i"), F.col("v").alias("j"), "score"), "cappededges")
    whole = connected_components(edges, "i", "j").withColumnRenamed("root", "component")
    strong = connected_components(edges.where(F.col("score") >= free), "i", "j")
    placed = whole.join(strong, "node", "left").select("node", "component", F.coalesce("root", "node").alias("core"))
    placed = materialize(placed, "placed")
    sizes = placed.groupBy("component").agg(F.count("*").alias("members"))
    easy = sizes.where(F.col("members") <= cap).select("component")
    cores = placed.groupBy("component", "core").agg(F.count("*").alias("n"))
    of = placed.select(F.col("node").alias("i"), F.col("core").alias("core_i"), "component")
    to = placed.select(F.col("node").alias("j"), F.col("core").alias("core_j"))
    # of parallel edges between two cores only the first one tried can matter for a union that the cap allows
    weak = edges.where(F.col("score") < free).join(of, "i").join(to, "j").where("core_i <> core_j").join(easy, "component", "left_anti")
    weak = weak.groupBy("component", F.least("core_i", "core_j").alias("u"), F.greatest("core_i", "core_j").alias("v")).agg(F.max(F.struct("score", "i", "j")).alias("first"))
    hard = weak.select("component", "u", "v", "first.score", "first.i", "first.j", F.lit(0).cast("bigint").alias("n"))
    nothing = F.lit(0).cast("bigint")
    seeds = cores.join(weak.select("component").distinct(), "component", "left_semi").select("component", F.col("core").alias("u"), nothing.alias("v"), F.lit(0).cast(dict(edges.dtypes)["score"]).alias("score"), nothing.alias("i"), nothing.alias("j"), "n")

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        seeds, links = group[group["n"] > 0], group[group["n"] == 0]
        order = np.argsort(seeds["u"].to_numpy())
        cores, sizes = seeds["u"].to_numpy()[order], seeds["n"].to_numpy()[order].tolist()
        parent = list(range(len(cores)))

        def find(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        best = np.lexsort((links["j"], links["i"], links["score"]))[::-1]
        place = lambda c: np.searchsorted(cores, links[c].to_numpy()[best]).tolist()
        for u, v in zip(place("u"), place("v"), strict=True):
            a, b = find(u), find(v)
            if a != b and sizes[a] + sizes[b] <= cap:
                a, b = min(a, b), max(a, b)
                parent[b] = a
                sizes[a] += sizes[b]
        return pd.DataFrame({"core": cores, "grown": cores[[find(x) for x in range(len(cores))]]})

    grown = hard.unionByName(seeds).groupBy("component").applyInPandas(grow, "core bigint, grown bigint")
    named = placed.join(easy.withColumn("easy", F.lit(True)), "component", "left").join(grown, "core", "left")
    out = named.select("node", F.when(F.col("easy"), F.col("component")).otherwise(F.coalesce("grown", "core")).alias("g"))
    out = out.join(names.select(F.col("k").alias("node"), "name"), "node").select(F.col("name").alias("node"), "g")
    labels = out.groupBy("g").agg(F.min("node").alias("cluster"), F.count("*").alias("size"))
    return out.join(labels, "g").select("node", "cluster", "size")


def numbered(df: DataFrame, order: list[Column], name: str = "id") -> DataFrame:
    """Rows numbered from 1 in a global order without a single-partition window.

    The rows are range-sorted and written once; the number is the rank in a row's partition plus the sizes
    of the partitions before it (one row a partition).
    """
    ranged = materialize(df.orderBy(*order).withColumn("_m", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_m", 33)
    sizes = ranged.groupBy(part.alias("_p")).agg(F.count("*").alias("_n"))
    offsets = sizes.withColumn("_before", F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).select("_p", "_before")
    out = ranged.withColumn("_p", part).join(F.broadcast(offsets), "_p")
    return out.withColumn(name, (F.col("_before") + F.col("_m").bitwiseAND((1 << 33) - 1) + 1)).drop("_m", "_p", "_before")
