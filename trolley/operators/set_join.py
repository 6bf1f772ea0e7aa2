"""Set-similarity joins by prefix filtering, and top-k with bounded tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def least_overlap(t: float, size_a: Column, size_b: Column) -> Column:
    """The common elements that sets of these sizes need for a Jaccard similarity of ``t``; what rounding may take is left out."""
    return F.ceil((size_a + size_b) * (t / (1 + t)) - 1e-9)


def rare_first(sets: DataFrame, frequency: DataFrame) -> DataFrame:
    """(id, tokens, size): distinct tokens by rising frequency in (token, n); unknown ones are the rarest.

    Sets without tokens are left out. The rows of a token that many sets hold are joined
    with one row, so adaptive execution can split them.
    """
    tokens = sets.select("id", F.explode(F.array_distinct("tokens")).alias("token"))
    ranked = tokens.join(frequency, "token", "left").select("id", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token").alias("x"))
    sorted_ = ranked.groupBy("id").agg(F.array_sort(F.collect_list("x")).alias("x"))
    return sorted_.select("id", F.col("x.token").alias("tokens"), F.size("x").alias("size"))


def frequencies(sets: DataFrame) -> DataFrame:
    return sets.select(F.explode(F.array_distinct("tokens")).alias("token")).groupBy("token").agg(F.count("*").alias("n"))


def _prefix_postings(sorted_: DataFrame, t: float, side: str) -> DataFrame:
    """(token, id, place, size) of the first tokens, of which a set that is similar enough shares one."""
    kept = (F.col("size") - F.ceil(F.col("size") * t - 1e-9) + 1).cast("int")
    return sorted_.select(
        F.col("id").alias(f"id_{side}"), F.col("size").alias(f"size_{side}"),
        F.posexplode(F.slice("tokens", F.lit(1), kept)).alias(f"place_{side}", "token"),
    )


def similar_candidates(left: DataFrame, right: DataFrame, t: float) -> DataFrame:
    """(id_a, id_b) that may have a Jaccard similarity of ``t``: prefix, length and position filters.

    Both sides come from ``rare_first`` with one frequency table. No pair of at least
    ``t`` is missing.
    """
    a, b = _prefix_postings(left, t, "a"), _prefix_postings(right, t, "b")
    rest = F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b"))
    fits = (F.col("size_a") >= F.col("size_b") * t - 1e-9) & (F.col("size_b") >= F.col("size_a") * t - 1e-9)
    # The first token that both sets share leaves room for the others, so that posting passes.
    reach = rest >= least_overlap(t, F.col("size_a"), F.col("size_b"))
    return a.join(b, "token").filter(fits & reach).select("id_a", "id_b").distinct()


def containing_candidates(asked: DataFrame, sets: DataFrame, t: float) -> DataFrame:
    """(id_a, id_b) where the asked set may hold a share ``t`` of ``full`` of the other.

    ``sets`` has id, tokens (rare first), size and full, the number that the share is of
    (repeated tokens count); each set is reached through its rarest tokens only.
    """
    need = F.ceil(F.col("full") * t - 1e-9)
    kept = sets.filter(F.col("size") >= need).select(
        F.col("id").alias("id_b"), need.alias("need"),
        F.explode(F.slice("tokens", F.lit(1), (F.col("size") - F.greatest(need, F.lit(1)) + 1).cast("int"))).alias("token"),
    )
    a = asked.select(F.col("id").alias("id_a"), F.col("size").alias("size_a"), F.explode("tokens").alias("token"))
    return a.join(kept, "token").filter(F.col("size_a") >= F.col("need")).select("id_a", "id_b").distinct()


def similarity_join(left: DataFrame, right: DataFrame, t: float) -> DataFrame:
    """(id_a, id_b, similarity) of all pairs of (id, tokens) with a Jaccard similarity of at least ``t``, above 0.

    Ids are unique within a side; null ids, null and empty sets have no pairs. Ids and
    sizes go through the join of postings; sets are fetched for the candidates only.
    """
    if not 0 < t <= 1:
        raise ValueError("a threshold above 0 and up to 1 is needed")
    clean = lambda df: df.select("id", "tokens").filter("id is not null")
    n = frequencies(clean(right))
    a, b = rare_first(clean(left), n), rare_first(clean(right), n)
    pairs = similar_candidates(a, b, t)
    both = pairs.join(a.select(F.col("id").alias("id_a"), F.col("tokens").alias("x")), "id_a")
    both = both.join(b.select(F.col("id").alias("id_b"), F.col("tokens").alias("y")), "id_b")
    common = F.size(F.array_intersect("x", "y"))
    scored = both.select("id_a", "id_b", (common / (F.size("x") + F.size("y") - common)).alias("similarity"))
    return scored.filter(F.col("similarity") >= t)


def top_k(df: DataFrame, key: list[str], order: list[Column], k: int, place: str = "place", parts: int = 32) -> DataFrame:
    """The first ``k`` rows of each key by ``order`` (total), with their place from 1.

    A key is ranked in ``parts`` parts first, so the task that ranks it at last sorts at
    most ``parts`` x ``k`` of its rows, however many it has.
    """
    part = F.pmod(F.xxhash64(*[c for c in df.columns]), F.lit(parts))
    inner, outer = Window.partitionBy(*key, "_part").orderBy(*order), Window.partitionBy(*key).orderBy(*order)
    best = df.withColumn("_part", part).withColumn("_r", F.row_number().over(inner)).filter(F.col("_r") <= k)
    return best.drop("_part", "_r").withColumn(place, F.row_number().over(outer)).filter(F.col(place) <= k)
