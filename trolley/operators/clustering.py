"""Constrained clustering of matches: one listing per store, strongest edges first.

Constrained clusters never cross a connected component of the edges, so components are
found first and the greedy pass runs in each of them alone. Components beyond a given
number of edges are worked off by rounds of joins that accept the same edges.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.operators.components import connected_components
from trolley.functions.text import business_key, node_id

#: Stores by priority when a field is chosen.
PRIORITY = ("continente", "pingo-doce", "auchan", "lidl", "aldi")
EDGES = "component long, node_a string, node_b string, store_a string, store_b string, score double, pair_no int"
CLUSTERED = "component long, node string, store string, cluster string, score double"


def match_edges(high: DataFrame) -> DataFrame:
    return high.select(
        node_id(F.col("store_a"), F.col("a.url")).alias("node_a"),
        node_id(F.col("store_b"), F.col("b.url")).alias("node_b"),
        "store_a", "store_b", "score", "pair_no",
    )


def greedy_clusters(pdf: pd.DataFrame) -> pd.DataFrame:
    """Union edges by falling score unless both clusters hold a common store.

    An edge within one cluster counts as accepted. Ties: pair number, then nodes. The
    score of a cluster is the least of its accepted edges.
    """
    parent: dict[str, str] = {}
    stores: dict[str, set[str]] = {}
    least: dict[str, float] = {}
    for e in pdf.itertuples():
        for node, store in ((e.node_a, e.store_a), (e.node_b, e.store_b)):
            parent.setdefault(node, node)
            stores.setdefault(node, {store})

    def root(x: str) -> str:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    order = pdf.sort_values(["score", "pair_no", "node_a", "node_b"], ascending=[False, True, True, True], kind="stable")
    for e in order.itertuples():
        a, b = root(e.node_a), root(e.node_b)
        if a != b:
            if stores[a] & stores[b]:
                continue
            a, b = min(a, b), max(a, b)
            parent[b] = a
            stores[a] |= stores.pop(b)
            least[a] = min(least.get(a, 1.0), least.pop(b, 1.0))
        least[a] = min(least.get(a, 1.0), e.score)
    rows = [(int(pdf["component"].iloc[0]), n, n.split("::")[0], root(n), least.get(root(n))) for n in sorted(parent)]
    return pd.DataFrame(rows, columns=[x.split()[0] for x in CLUSTERED.split(", ")])


def clusters_by_rounds(edges: DataFrame, cut: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """What ``greedy_clusters`` gives, by joins, for components of any size.

    Clusters only grow, so an edge between clusters with a common store will be rejected
    whenever its turn comes. An open edge that comes first among those of both its clusters
    meets them at its turn as they are now, so it is accepted; each round accepts all of
    these. In the end every edge within a cluster has been accepted.
    """
    ends = F.explode(F.array(F.struct(F.col("node_a").alias("node"), F.col("store_a").alias("store")), F.struct(F.col("node_b").alias("node"), F.col("store_b").alias("store"))))
    nodes = edges.select("component", ends.alias("x")).groupBy("component", "x.node").agg(F.min("x.store").alias("store"))
    nodes = cut(nodes.select("*", F.col("node").alias("cluster"), F.array("store").alias("held")), "nodes")
    order = F.struct((-F.col("score")).alias("falling"), "pair_no", "node_a", "node_b", "cluster_a", "cluster_b")
    rest = edges.select("node_a", "node_b", "score", "pair_no")
    for k in count():
        own = lambda side: nodes.select(F.col("node").alias(f"node_{side}"), F.col("cluster").alias(f"cluster_{side}"), F.col("held").alias(f"held_{side}"))  # noqa: E731, B023
        known = rest.join(own("a"), "node_a").join(own("b"), "node_b")
        known = known.filter((F.col("cluster_a") != F.col("cluster_b")) & ~F.arrays_overlap("held_a", "held_b"))
        known = cut(known, f"open{k}")
        if known.isEmpty():
            break
        sides = F.explode(F.array("cluster_a", "cluster_b")).alias("cluster")
        firsts = known.select(order.alias("edge"), F.array_union("held_a", "held_b").alias("held"), sides).groupBy("cluster").agg(
            F.min(F.struct("edge", "held")).alias("first")
        )
        united = firsts.groupBy("first").agg(F.count("*").alias("n")).filter("n = 2").select(
            F.explode(F.array("first.edge.cluster_a", "first.edge.cluster_b")).alias("cluster"),
            F.least("first.edge.cluster_a", "first.edge.cluster_b").alias("into"),
            F.col("first.held").alias("new_held"),
        )
        nodes = nodes.join(united, "cluster", "left").select(
            "component", "node", "store", F.coalesce("into", "cluster").alias("cluster"), F.coalesce("new_held", "held").alias("held")
        )
        nodes = cut(nodes, f"nodes{k}")
        rest = known.select(*rest.columns)
    own = lambda side: nodes.select(F.col("node").alias(f"node_{side}"), F.col("cluster").alias(f"cluster_{side}"))
    inside = edges.select("node_a", "node_b", "score").join(own("a"), "node_a").join(own("b"), "node_b").filter("cluster_a = cluster_b")
    least = inside.groupBy(F.col("cluster_a").alias("cluster")).agg(F.least(F.lit(1.0), F.min("score")).alias("score"))
    return nodes.join(least, "cluster", "left").select("component", "node", "store", "cluster", "score")


def constrained_clusters(
    edges: DataFrame, cut: Callable[[DataFrame, str], DataFrame], most_edges: int = 100_000
) -> DataFrame:
    """(component, node, store, cluster, score) of all clusters of two nodes or more.

    A component of up to ``most_edges`` edges is one group; the others go by rounds.
    """
    edges = cut(edges, "match_edges")
    hashed = edges.select(F.xxhash64("node_a").alias("a"), F.xxhash64("node_b").alias("b"))
    parts = connected_components(hashed, cut)
    edges = edges.join(parts, F.xxhash64("node_a") == F.col("node")).select(*[x.split()[0] for x in EDGES.split(", ")])
    edges = cut(edges, "component_edges")
    large = cut(edges.groupBy("component").count().filter(F.col("count") > most_edges).select("component"), "large")
    found = edges.join(large, "component", "left_anti").groupBy("component").applyInPandas(greedy_clusters, CLUSTERED)
    if not large.isEmpty():
        found = found.unionByName(clusters_by_rounds(edges.join(large, "component", "left_semi"), cut))
    size = found.groupBy("cluster").count().filter("count >= 2").select("cluster")
    return found.join(size, "cluster", "left_semi").select(*found.columns)


def first_filled(column: str):
    """The first value, by store priority, that is not null or empty."""
    filled = F.col(column).isNotNull() & (F.col(column).cast("string") != "")
    order = F.when(filled, F.array_position(F.array(*[F.lit(s) for s in PRIORITY]), F.col("store")))
    return F.min_by(column, order).alias(column)


def canonical_records(clusters: DataFrame, listings: DataFrame) -> DataFrame:
    """One record per cluster; ``listings`` has store, url and the product's fields."""
    members = clusters.join(
        listings.withColumn("node", node_id(F.col("store"), F.col("url"))).drop("store"), "node"
    )
    fields = [c for c in ("name", "brand", "category", "subcategory", "quantity", "quantity_unit", "image_url") if c in listings.columns]
    return (
        members.groupBy("cluster")
        .agg(*[first_filled(c) for c in fields], F.min("score").alias("match_score"), F.count("*").alias("stores"))
        .withColumn("brand", F.coalesce("brand", F.lit("")))
    )


def claim_identities(clusters: DataFrame, records: DataFrame, sources: DataFrame, products: DataFrame) -> DataFrame:
    """(cluster, product_id): the known ids of each cluster, every id claimed by one cluster at most.

    A cluster asks for the ids that its listings (store, url) had, and besides for the oldest
    product with its record's name and brand. An id goes to a cluster that has it by a
    listing before one that has it by name, then to the smallest cluster id; a cluster that
    gets several is fused (``fuse_identities``), one that gets none is new. ``records`` has
    cluster, name and brand, ``products`` product_id, name, brand and created_at; null names
    have no key, null brands count as empty.
    """
    listed = sources.select(node_id(F.col("store"), F.col("url")).alias("node"), "product_id").filter("product_id is not null")
    by_source = clusters.select("cluster", "node").join(listed, "node").select("cluster", "product_id", F.lit(0).alias("_rank"))
    key = business_key(F.col("name"), F.col("brand")).alias("_key")
    oldest = products.filter("name is not null").groupBy(key).agg(F.min_by("product_id", F.struct("created_at", "product_id")).alias("product_id"))
    by_name = records.filter("name is not null").select("cluster", key).join(oldest, "_key").select("cluster", "product_id", F.lit(1).alias("_rank"))
    asked = by_source.unionByName(by_name)
    return asked.groupBy("product_id").agg(F.min_by("cluster", F.struct("_rank", "cluster")).alias("cluster")).select("cluster", "product_id")


def fuse_identities(claims: DataFrame, products: DataFrame) -> DataFrame:
    """(product_id, survivor): of a cluster's several ids the oldest stays, ties by id."""
    dated = claims.join(products.select("product_id", "created_at"), "product_id")
    oldest = dated.groupBy("cluster").agg(F.min_by("product_id", F.struct("created_at", "product_id")).alias("survivor"))
    return claims.join(oldest, "cluster").select("product_id", "survivor").distinct()


def repoint(facts: DataFrame, fused: DataFrame) -> DataFrame:
    """``facts`` with the ids of fused products replaced."""
    return (
        facts.join(fused, "product_id", "left")
        .withColumn("product_id", F.coalesce("survivor", "product_id"))
        .select(*facts.columns)
    )


def kept_image(old, new, stored_marker: str = "/storage/"):
    """An image that is stored already stays; else the new one, else the old one."""
    return F.when(old.contains(stored_marker), old).otherwise(F.coalesce(new, old))


def rebuild_sources(sources: DataFrame, current: DataFrame) -> DataFrame:
    """Source rows of re-clustered products are replaced by ``current`` (product_id, store, url); others stay."""
    touched = current.select("product_id").distinct()
    moved = current.select("store", "url").distinct()
    kept = sources.join(touched, "product_id", "left_anti").join(moved, ["store", "url"], "left_anti")
    return kept.select("product_id", "store", "url").unionByName(current.select("product_id", "store", "url").distinct())
