"""Set-similarity joins, bounded top-k, search and the matcher's bins against brute force."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from trolley.functions.quantity import qty_matches
from trolley.operators import matching, search
from trolley.operators.set_join import containing_candidates, frequencies, rare_first, similarity_join, top_k


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 0.0


@pytest.mark.parametrize("t", [0.25, 0.5, 0.8, 1.0])
def test_similarity_join_finds_all_pairs(spark, t):
    random.seed(int(t * 100))
    words = [f"w{i}" for i in range(40)]
    weights = [1 / (i + 1) for i in range(40)]  # a few words are in most sets
    sets = lambda n: [(i, random.choices(words, weights, k=random.randint(0, 12))) for i in range(n)]
    a, b = sets(120), sets(150)
    a += [(500, None), (None, ["w1"]), (501, b[3][1])]
    shape = "id int, tokens array<string>"
    got = {(r["id_a"], r["id_b"]): r["similarity"] for r in similarity_join(spark.createDataFrame(a, shape), spark.createDataFrame(b, shape), t).collect()}
    expected = {
        (i, j): s for i, x in a if i is not None for j, y in b if x and y and (s := jaccard(set(x), set(y))) >= t
    }
    assert got == expected and (expected or t == 1.0)


def test_few_pairs_are_candidates(spark):
    """Rare tokens bring similar sets together, common ones bring none."""
    rows = [(i, [f"a{i}", f"b{i}", f"c{i}", "common", "usual"]) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, tokens array<string>")
    n = frequencies(df)
    from trolley.operators.set_join import similar_candidates

    sorted_ = rare_first(df, n)
    assert similar_candidates(sorted_, sorted_, 0.8).count() == 300


def test_containing_candidates_lose_nothing(spark):
    random.seed(4)
    docs = [(i, random.choices("abcdefghij", k=random.randint(1, 9))) for i in range(80)]
    asked = [(i, random.choices("abcdefghijk", k=random.randint(1, 5))) for i in range(40)]
    shape = "id int, tokens array<string>"
    d, a = spark.createDataFrame(docs, shape), spark.createDataFrame(asked, shape)
    n = frequencies(d)
    sets = rare_first(d, n).join(d.select("id", F.size("tokens").alias("full")), "id")
    got = {tuple(r) for r in containing_candidates(rare_first(a, n), sets, 0.4).collect()}
    expected = {(i, j) for i, x in asked for j, y in docs if len(set(x) & set(y)) / len(y) >= 0.4}
    assert expected <= got and expected


def test_top_k_of_a_hot_key(spark):
    df = spark.range(0, 50_000, 1, 8).select(F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id")).alias("key"), (F.col("id") * 7_919 % 50_000).alias("v"), "id")
    got = top_k(df, ["key"], [F.desc("v"), F.asc("id")], 4)
    assert [r["v"] for r in got.filter("key = 0").orderBy("place").collect()] == sorted((i * 7_919 % 50_000 for i in range(50_000) if i % 3 < 2), reverse=True)[:4]
    assert got.filter("key <> 0").count() == 16_666


def brute_search(products, queries, k=60):
    """Tiers, rank and order by the definitions, for lower-case texts without accents."""
    fold = {"oes": "ao", "aes": "ao", "aos": "ao"}

    def lex(s):
        out = []
        for w in "".join(c if c.isascii() and c.isalnum() else " " for c in s.lower()).split():
            if w in search.STOP_WORDS:
                continue
            if w[-3:] in fold:
                w = w[:-3] + "ao"
            elif w.endswith("is") and w[-3:-2] in tuple("aeou"):
                w = w[:-2] + "l"
            elif w.endswith("ns"):
                w = w[:-2] + "m"
            elif w.endswith("es") and w[-3:-2] in ("r", "z"):
                w = w[:-2]
            elif w.endswith("s") and len(w) > 1 and w[-2] != "s":
                w = w[:-1]
            out.append(w)
        return out

    def grams(s):
        return {f"  {w} "[i : i + 3] for w in "".join(c if c.isascii() and c.isalnum() else " " for c in s.lower()).split() for i in range(len(w) + 1)}

    rows = []
    for qid, q in queries:
        q = (q or "").strip().lower()
        found = []
        for pid, name, brand, category, sub in products if q else []:
            text = " ".join(x for x in (name, brand, (category or "").replace("_", " "), (sub or "").replace("_", " ")) if x is not None)
            doc, ql, bl = lex(text), lex(q), lex(brand or "")
            near = max(jaccard(grams(name or ""), grams(q)), jaccard(grams(brand or ""), grams(q)))
            rank = max(near, len(set(ql) & set(doc)) / max(1, len(doc)))
            phrase = any(doc[i : i + len(ql)] == ql for i in range(len(doc) - len(ql) + 1))
            tier = (
                1 if (name or "").strip().lower() == q
                else 2 if ql and set(ql) <= set(bl)
                else 3 if ql and phrase
                else 4 if ql and set(ql) <= set(doc)
                else 5 if near > 0.25 else None
            )
            if tier:
                found.append((tier, -rank, name, pid))
        found.sort(key=lambda r: (r[0], r[1], r[2] is not None, r[2] or "", r[3]))
        rows += [(qid, pid, tier, -rank, i) for i, (tier, rank, _, pid) in enumerate(found[:k], 1)]
    return sorted(rows)


@pytest.mark.parametrize("k", [3, 60])
def test_search_equals_brute_force_with_rank_order_and_limit(spark, k):
    random.seed(k)
    words = "leite gordo magro de pao pães queijo fresco azul limao limoes agua aguas gas 1l 500g bio iogurte iogurtes natural naturais".replace("ã", "a").split()
    some = lambda a, b: " ".join(random.choices(words, k=random.randint(a, b)))
    products = [(f"{i:03d}", some(1, 5), random.choice(["mimosa", "leite bom", "agros", "", None]), random.choice(["laticinios_ovos", "agua_e_gas", None]), random.choice([None, "leite"])) for i in range(140)]
    products += [("900", None, "mimosa", None, None), ("901", products[5][1], products[5][2], products[5][3], products[5][4])]
    queries = [(i, some(1, 3)) for i in range(40)] + [(90, ""), (91, None), (92, "de"), (93, "zzz"), (94, products[5][1]), (95, products[5][1]), (96, "leita gordu"), (97, "natural natural")]
    p = spark.createDataFrame(products, "id string, name string, brand string, category string, subcategory string")
    q = spark.createDataFrame(queries, "query_id int, q string")
    index = search.build_index(search.search_documents(p))
    got = sorted(tuple(r) for r in search.search(index, q, k=k).select("query_id", "id", "tier", "rank", "place").collect())
    expected = brute_search(products, queries, k)
    assert got == expected
    assert {r[2] for r in got} >= {1, 3, 4, 5} or k == 3


def test_search_of_empty_tables(spark):
    p = spark.createDataFrame([], "id string, name string, brand string, category string, subcategory string")
    q = spark.createDataFrame([(1, "leite")], "query_id int, q string")
    assert search.search(search.search_documents(p), q).collect() == []
    one = spark.createDataFrame([("1", "leite", None, None, None)], p.schema)
    assert search.search(search.search_documents(one), q.limit(0)).collect() == []


def test_bins_reach_every_quantity_that_matches(spark):
    random.seed(2)
    sizes = [0.0, 0.1, 0.125, 0.95, 1.0, 95.0, 100.0, 99.9, 105.0, 105.3, 950.0, 1000.0, -1.0, -2.0] + [random.uniform(0.01, 2000) for _ in range(30)]
    rows = [(i, None if i % 11 == 0 else (q, kind, 1)) for i, (q, kind) in enumerate(itertools.product(sizes, ["weight", "volume", "proxy"]))]
    df = spark.createDataFrame(rows, "i int, qty struct<qty:double,kind:string,multiplier:int>")
    for scale in (True, False):
        a, b = df.select(F.col("i").alias("ia"), F.col("qty").alias("qa")), df.select(F.col("i").alias("ib"), F.col("qty").alias("qb"))
        expected = {tuple(r) for r in a.crossJoin(b).filter(qty_matches(F.col("qa"), F.col("qb"), scale)).select("ia", "ib").collect()}
        asked = a.withColumn("w", F.explode(F.array_distinct(matching.wanted_bins(F.col("qa"), scale))))
        lies = b.select("ib", F.coalesce("qb.kind", F.lit("none")).alias("kind"), F.when(F.col("qb").isNull(), 0).otherwise(matching.quantity_bin(F.col("qb.qty"))).alias("bin"))
        found = {tuple(r) for r in asked.join(lies, (F.col("w.kind") == F.col("kind")) & (F.col("w.bin") == F.col("bin"))).select("ia", "ib").collect()}
        assert expected <= found and len(found) < 3 * len(expected)
