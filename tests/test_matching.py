"""The golden catalogue: pairs, gates, confidence, clusters."""

import itertools
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from trolley.operators import components, matching
from trolley.operators.clustering import canonical_records, constrained_clusters, greedy_clusters, match_edges
from trolley.operators.components import connected_components
from trolley.sources.catalogue import CATALOGUE, PAIRS, store_pairs
from trolley.sources.shared import written

F_ = "mercearia_doce_salgada"
GOLDEN = [
    ("C1", "Óleo Alimentar Fula 1L", "Fula", F_, None, 2.19, 2.19),
    ("P1", "Óleo Alimentar 1L", "Fula", F_, None, 2.29, 2.29),
    ("A1", "OLEO ALIMENTAR FULA 1 L", "Fula", F_, None, 2.25, 2.25),
    ("C2", "Vinagre de Vinho Branco Gallo 500ml", "Gallo", F_, None, 1.59, 3.18),
    ("C3", "Vinagre de Vinho Branco Chardonnay Gallo 500ml", "Gallo", F_, None, 1.99, 3.98),
    ("A2", "Vinagre de Vinho Branco Gallo 500ml", "Gallo", F_, None, 1.62, 3.24),
    ("C4", "Ice Tea Pêssego", "Lipton", "bebidas", "refrigerantes_sumos", 1.79, 1.19),
    ("P4", "Ice Tea Pêssego Pack 6", "Lipton", "bebidas", "refrigerantes_sumos", 5.34, 3.55),
    ("C5", "Banana", "", "frutas_legumes", "fruta", 1.25, 1.25),
    ("P5", "Banana", "Pingo Doce", "frutas_legumes", "fruta", 1.35, 1.35),
    ("C6", "Pêssego Vermelho", "Continente", "frutas_legumes", "fruta", 2.00, 2.00),
    ("P6", "Pêssego Vermelho", "", "frutas_legumes", "fruta", 3.00, 3.00),
    ("C7", "Alpro Soja Sem Açúcar 1L", "Alpro", "laticinios_ovos", None, 2.49, 2.49),
    ("P7", "Alpro Soja 1L", "Alpro", "laticinios_ovos", None, 2.39, 2.39),
    ("C8", "Arroz Agulha Continente 1kg", "Continente", F_, None, 1.29, 1.29),
    ("P8", "Arroz Agulha 1kg", "Pingo Doce", F_, None, 1.25, 1.25),
    ("C9", "Leite em Pó de Crescimento Optipro 3 +12M Nan 800g", "Nan", "bebe", None, 19.99, 24.99),
    ("P9", "Leite em Pó NAN 2 OptiPro 800g", "Nan", "bebe", None, 20.49, 25.61),
]
STORE = {"C": "continente", "P": "pingo-doce", "A": "auchan"}


@pytest.fixture(scope="module")
def catalogue(spark):
    rows = [(i, STORE[i[0]], n, b, c, s, p, u, f"https://x/{i}", None) for i, n, b, c, s, p, u in GOLDEN]
    return spark.createDataFrame(rows, CATALOGUE)


@pytest.fixture(scope="module")
def found(spark, catalogue):
    return written(matching.with_confidence(matching.match_all(catalogue, store_pairs(spark))), "golden")


def test_golden_pairs(found):
    got = {(r["a"]["id"], r["b"]["id"]): (r["score"], r["confidence"]) for r in found.collect()}
    assert got == {
        ("C1", "P1"): (1.0, "high"),
        ("C1", "A1"): (1.0, "high"),
        ("P1", "A1"): (1.0, "high"),
        ("C2", "A2"): (1.0, "high"),
        ("C3", "A2"): (0.8, "high"),
        ("C5", "P5"): (1.0, "high"),
        ("C9", "P9"): (0.571, "low"),
    }


def test_golden_clusters(spark, catalogue, found):
    clusters = constrained_clusters(match_edges(found.filter("confidence = 'high'")), written)
    groups = {}
    for r in clusters.collect():
        groups.setdefault(r["cluster"], set()).add(r["node"].rsplit("/", 1)[1])
    assert sorted(map(sorted, groups.values())) == [["A1", "C1", "P1"], ["A2", "C2"], ["C5", "P5"]]
    records = {r["name"]: r for r in canonical_records(clusters, catalogue).collect()}
    assert records["Óleo Alimentar Fula 1L"]["stores"] == 3
    assert records["Banana"]["brand"] == "Pingo Doce"


def test_review_rows_skip_known_keys_and_missing_prices(spark, found):
    low = found.filter("confidence = 'low'")
    none = spark.createDataFrame([], "store_a string, store_b string, name_a string, name_b string")
    rows = matching.review_rows(low, none)
    assert rows.count() == 1
    assert matching.review_rows(low, rows.withColumn("name_a", F.upper("name_a"))).count() == 0
    decided = rows.select("store_a", "store_b", "name_a", "name_b", F.lit("approved").alias("status"))
    products = spark.createDataFrame([], "product_id string, name string, brand string")
    last = spark.createDataFrame([], "product_id string, store string, price double")
    after, canonical, prices = matching.apply_decisions(rows, decided, "2024-05-01", products, last)
    assert after.first()["status"] == "approved" and canonical.first()["confidence"] == "manual" and prices.count() == 2
    known = rows.select(F.lit("p1").alias("product_id"), F.col("name_a").alias("name"), "brand")
    last = rows.select(F.lit("p1").alias("product_id"), F.col("store_a").alias("store"), F.col("price_a").alias("price"))
    _, canonical, prices = matching.apply_decisions(rows, decided, "2024-05-01", known, last)
    row = rows.first()
    assert canonical.count() == 0
    assert [(r["product_id"], r["store"], r["price"]) for r in prices.collect()] == [("p1", row["store_b"], row["price_b"])]
    labelled = rows.withColumn("label", F.lit("suspect_quantity"))
    counts = [matching.review_filter(labelled, s, g).count() for s, g in ((row["store_b"], None), ("x", None), (None, "suspect"), (None, "probable"))]
    assert counts == [1, 0, 1, 0]


def test_empty_catalogue(spark, catalogue):
    assert matching.match_all(catalogue.limit(0), store_pairs(spark)).count() == 0


def test_result_does_not_depend_on_partitions(spark, catalogue):
    key = lambda df: sorted((r["a"]["id"], r["b"]["id"], r["score"]) for r in df.collect())
    assert key(matching.match_all(catalogue.repartition(1), store_pairs(spark))) == key(
        matching.match_all(catalogue.repartition(7, "brand"), store_pairs(spark))
    )


def test_clusters_equal_one_global_pass(spark):
    rng = random.Random(3)
    stores = sorted({s for p in PAIRS for s in p})
    rows = []
    for _ in range(400):
        pair_no = rng.randrange(len(PAIRS))
        a, b = PAIRS[pair_no]
        rows.append((f"{a}::{rng.randrange(40)}", f"{b}::{rng.randrange(40)}", a, b, rng.randrange(75, 100) / 100, pair_no))
    edges = spark.createDataFrame(rows, "node_a string, node_b string, store_a string, store_b string, score double, pair_no int")
    got = constrained_clusters(edges, written).toPandas()
    rounds = constrained_clusters(edges, written, most_edges=0).toPandas()
    whole = greedy_clusters(edges.toPandas().assign(component=0))
    whole = whole[whole.groupby("cluster")["node"].transform("size") >= 2]
    shape = lambda d: sorted((tuple(sorted(g["node"])), g["score"].iloc[0]) for _, g in d.groupby("cluster"))
    assert shape(got) == shape(whole) == shape(rounds)
    assert sorted(rounds["cluster"]) == sorted(got["cluster"])
    assert all(g["store"].is_unique for _, g in got.groupby("cluster"))
    assert stores


@pytest.mark.parametrize("most", [components.BROADCAST_EDGES, -1])
def test_components_equal_union_find(spark, monkeypatch, most):
    """Minima broadcast, and joined by salt."""
    monkeypatch.setattr(components, "BROADCAST_EDGES", most)
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000, i) for i in range(1001, 1200)]
    parent = {x: x for x in itertools.chain(*edges)}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    want = {x: root(x) for e in edges if e[0] != e[1] for x in e}
    got = connected_components(spark.createDataFrame(edges, "a long, b long"), written)
    assert {r["node"]: r["component"] for r in got.collect()} == want
    empty = spark.createDataFrame([], "a long, b long")
    assert connected_components(empty, written).count() == 0


def test_greedy_keeps_the_stronger_edge():
    rows = [(0, "a::1", "b::1", "a", "b", 0.9, 0), (0, "a::2", "b::1", "a", "b", 1.0, 0)]
    columns = ["component", "node_a", "node_b", "store_a", "store_b", "score", "pair_no"]
    got = greedy_clusters(pd.DataFrame(rows, columns=columns))
    assert dict(zip(got["node"], got["cluster"], strict=True))["a::2"] == "a::2"
    assert len(set(got["cluster"])) == 2


def test_identities_survive_runs(spark):
    from trolley.operators import clustering as K

    clusters = spark.createDataFrame([("k1", "continente::u1", 1.0), ("k1", "auchan::u2", 1.0), ("k2", "lidl::u3", 1.0)], "cluster string, node string, score double")
    records = spark.createDataFrame([("k1", "Leite", "M"), ("k2", "Arroz ", None)], "cluster string, name string, brand string")
    sources = spark.createDataFrame([("p1", "continente", "u1"), ("p2", "auchan", "u2"), ("p3", "aldi", "u9")], "product_id string, store string, url string")
    products = spark.createDataFrame([("p1", "a", "", 2), ("p2", "b", "", 1), ("p3", "c", "", 1), ("p4", "arroz", "", 1)], "product_id string, name string, brand string, created_at int")
    claims = K.claim_identities(clusters, records, sources, products)
    assert sorted(map(tuple, claims.collect())) == [("k1", "p1"), ("k1", "p2"), ("k2", "p4")]
    fused = K.fuse_identities(claims, products)
    assert dict(map(tuple, fused.collect())) == {"p1": "p2", "p2": "p2", "p4": "p4"}
    facts = spark.createDataFrame([("p1", 1.0), ("p3", 2.0)], "product_id string, price double")
    assert sorted(map(tuple, K.repoint(facts, fused).collect())) == [("p2", 1.0), ("p3", 2.0)]
    current = spark.createDataFrame([("p2", "continente", "u1")], "product_id string, store string, url string")
    assert sorted(map(tuple, K.rebuild_sources(sources, current).collect())) == [("p2", "continente", "u1"), ("p3", "aldi", "u9")]
    images = spark.sql("select '/storage/x' a, 'n' b union all select 'o', 'n' union all select 'o', null")
    assert sorted(r[0] for r in images.select(K.kept_image(F.col("a"), F.col("b"))).collect()) == ["/storage/x", "n", "o"]


def odd_catalogue(spark, n=600):
    rng = random.Random(11)
    words = "leite gordo magro sem gluten com bio queijo fresco azul".split()
    rows = []
    for i in range(n):
        size = rng.choice(["500g", "4x125g", "0,5kg", "480 g", "1l", "", "", "pack 6"])
        name = " ".join(rng.choices(words, k=rng.randint(0, 4)) + [size])
        rows.append((
            f"{rng.randrange(n)}-{i}", rng.choice(["continente", "pingo-doce", "auchan"]), rng.choice([name, name, name, None]) if i % 40 == 0 else name,
            rng.choice(["Mimosa", "mimosa", "Agros", "", None, "Continente", "Pingo Doce", "Auchan"]),
            rng.choice(["frutas_legumes", "frutas_legumes", "bebidas", None]), rng.choice(["agua", "refrigerantes_sumos", "fruta", "", None]),
            rng.choice([1.0, 1.1, 1.2, 1.5, 0.0, None]), rng.choice([1.0, 1.15, 1.2, 1.3225, 2.0, 0.0, None, float("nan")]), f"u{i}", None,
        ))
    return spark.createDataFrame(rows + rows[:20], CATALOGUE)


def all_pairs(prepared, pairs, version):
    """The candidates of every row by the rules, from all pairs."""
    from trolley.functions.quantity import UNIT_PRICE_TOLERANCE, jaccard, qty_matches, unit_price_ratio

    a, b = F.col("a"), F.col("b")
    side = lambda c: prepared.select(F.struct("*").alias(c))
    met = side("a").crossJoin(side("b")).join(pairs, (a["store"] == F.col("store_a")) & (b["store"] == F.col("store_b")))
    fruit = lambda x: F.coalesce(x["category"] == matching.RELAXED, F.lit(False))
    branded = (a["block"] != "OWN") & (a["block"] != "") & (a["block"] == b["block"])
    source = F.when(~fruit(a) & (a["block"] == b["block"]), 0).when(fruit(a) & branded, 0).when(fruit(a) & fruit(b), 1)
    far = F.coalesce(unit_price_ratio(a["price_per_unit"], b["price_per_unit"]) > UNIT_PRICE_TOLERANCE, F.lit(False))
    sub = F.coalesce(F.nullif(a["subcategory"], F.lit("")), b["subcategory"])
    packs = F.coalesce(sub.isin(*matching.PACK_SENSITIVE), F.lit(False)) & (a["packs"] != b["packs"])
    gates = qty_matches(a["qty"], b["qty"], version != "v1")
    if version != "v1":
        gates = gates & ~((fruit(a) | fruit(b)) & ~branded & far) & ~packs
    same = (a["flavour"] == b["flavour"]) & (a["variant"] == b["variant"]) & (a["polarity"] == b["polarity"])
    met = met.withColumn("source", source).filter(F.col("source").isNotNull() & gates & same)
    return met.withColumn("score", jaccard(a["tokens"], b["tokens"]))


@pytest.mark.parametrize("version", ["v2", "v1"])
def test_classes_find_what_all_pairs_find(spark, version):
    catalogue, pairs = odd_catalogue(spark), store_pairs(spark)
    prepared = written(matching.prepare(catalogue, version).withColumn("no", F.monotonically_increasing_id()), "odd")
    met = written(all_pairs(prepared, pairs, version).select("store_a", "store_b", "a", "b", "source", "score"), "odd_pairs")
    best = met.filter(F.col("score") >= matching.THRESHOLD).groupBy("store_a", "store_b", "a.no", F.col("a.id").alias("id_a")).agg(
        F.min(F.struct((-F.col("score")).alias("s"), "source", F.col("b.id").alias("i"))).alias("m")
    )
    want = sorted((r["store_a"], r["store_b"], r["id_a"], r["m"]["i"], round(-r["m"]["s"], 3)) for r in best.collect())
    found = matching.match_all(catalogue, pairs, version).collect()
    assert sorted((r["store_a"], r["store_b"], r["a"]["id"], r["b"]["id"], r["score"]) for r in found) == want and len(want) > 100
    if version == "v2":
        counts = met.groupBy("store_a", "store_b").agg(F.count("*").alias("n"), F.count_distinct("a.id").alias("ids"))
        rows = matching.numbered(prepared.drop("no"), named=False)
        assert sorted(map(tuple, matching.candidate_counts(rows, pairs).collect())) == sorted(map(tuple, counts.collect()))
        near = met.filter("score >= 0.3").groupBy(F.coalesce("a.qty.kind", F.lit("none")), F.coalesce("b.qty.kind", F.lit("none"))).count()
        kinds = matching.candidate_kinds(matching.numbered(prepared.drop("no")), pairs, 0.3)
        assert sorted(map(tuple, kinds.collect())) == sorted(map(tuple, near.collect()))


def test_equal_rows_meet_as_one_class(spark):
    """20,000 equal listings in each of two stores are 400,000,000 pairs and one pair of classes."""
    shape = spark.range(40_000).select(
        F.col("id").cast("string"), F.when(F.col("id") % 2 == 0, "continente").otherwise("lidl").alias("store"), F.lit("Leite Gordo 1l").alias("name"),
        F.lit("Mimosa").alias("brand"), F.lit("laticinios_ovos").alias("category"), F.lit(None).cast("string").alias("subcategory"), F.lit(1.0).alias("price"),
        F.lit(1.0).alias("price_per_unit"), F.col("id").cast("string").alias("url"), F.lit(None).cast("string").alias("image_url"),
    )
    rows, pairs = matching.numbered(matching.prepare(shape)), store_pairs(spark)
    assert sum(x.count() for x in matching.linked_classes(matching.classes_of(rows), pairs, least=0.3).values()) == 1
    assert [tuple(r) for r in matching.candidate_counts(rows, pairs).collect()] == [("continente", "lidl", 400_000_000, 20_000)]
    assert [tuple(r) for r in matching.candidate_kinds(rows, pairs, 0.3).collect()] == [("volume", "volume", 400_000_000)]
    found = matching.match_all(shape, pairs)
    assert [tuple(r) for r in found.groupBy("b.id", "score").count().collect()] == [("1", 1.0, 20_000)]
