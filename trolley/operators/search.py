"""Tiered product search over a table of queries, suggestions and synonyms.

An index is written once: postings with positions, the products' normal forms and their
lexemes and trigrams, rare ones first. Lexeme tiers reach products through the two rarest
lexemes of a query and are decided by positions. The fuzzy tier is a set-similarity join
by prefix filtering; it begins with a high similarity and goes down only for queries
that have too few products, so that no query meets all products. Rank is the highest of the
share of the document's lexemes that the query covers and the two trigram similarities; it
stands in for a text engine's rank and is not equal to it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trolley.functions.quantity import jaccard, trigrams
from trolley.functions.text import plain_ascii, singular, strip_accents
from trolley.operators.set_join import containing_candidates, frequencies, rare_first, similar_candidates, top_k
from trolley.sources.shared import written

#: Portuguese function words, without accents.
STOP_WORDS = (
    "a ao aos as ate com como da das de dela dele do dos e ela ele em entre era essa esse esta este eu foi ha isso isto"
    " ja lhe mais mas me mesmo meu minha muito na nao nas nem no nos o os ou para pela pelo per por qual quando que quem"
    " se sem ser seu so sua tambem te tem um uma voce"
).split()
#: Words that shoppers use for one thing.
SYNONYMS = (
    ("refrigerante", "sumo", "soda"),
    ("detergente", "sabão"),
    ("papel higiénico", "papel wc", "papel higienico"),
    ("iogurte", "yogurte", "yogurt"),
    ("batata frita", "chips", "batatas fritas"),
    ("azeite", "óleo de oliva"),
    ("fiambre", "presunto cozido"),
    ("natas", "creme de leite"),
    ("ketchup", "catchup"),
    ("esparguete", "spaghetti"),
    ("leite em pó", "leite em po"),
    ("gelado", "sorvete"),
    ("bolacha", "biscoito"),
    ("rebuçado", "caramelo"),
)


def folded(c: Column) -> Column:
    return strip_accents(F.lower(F.coalesce(c, F.lit(""))), fold_ligatures=True)


def lexemes(c: Column) -> Column:
    words = F.split(F.regexp_replace(folded(c), "[^a-z0-9]+", " "), " ")
    kept = F.filter(words, lambda w: (w != "") & ~w.isin(*STOP_WORDS))
    return F.transform(kept, singular)


def search_documents(products: DataFrame) -> DataFrame:
    """product columns and the normal forms that search needs; write it once and reuse it."""
    spaced = lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit("_"), F.lit(" "))
    text = F.concat_ws(" ", "name", "brand", spaced(F.col("category")), spaced(F.col("subcategory")))
    return products.select(
        "id", "name", "brand",
        F.trim(folded(F.col("name"))).alias("name_norm"), F.trim(folded(F.col("brand"))).alias("brand_norm"),
        lexemes(text).alias("lexemes"), F.array_distinct(lexemes(F.col("brand"))).alias("brand_lexemes"),
    )


@dataclass
class SearchIndex:
    """Written tables: the products (id, name, class_id); their classes, which search in one way; postings; sorted sets."""

    members: DataFrame
    classes: DataFrame
    postings: DataFrame
    lexeme_counts: DataFrame
    lexeme_sets: DataFrame
    gram_counts: DataFrame
    gram_sets: DataFrame


def build_index(documents: DataFrame) -> SearchIndex:
    """The index of ``search_documents`` rows.

    A class is the products with the same name, brand and lexemes. Postings are (lexeme,
    class_id, positions, in_brand). Sets are distinct: lexemes by class, trigrams by text.
    """
    text = F.concat_ws("\n", "name_norm", "brand_norm", F.array_join("lexemes", " "))
    rows = written(documents.withColumn("class_id", F.unhex(F.sha2(text, 256))), "documents")
    forms = ["name_norm", "brand_norm", "lexemes", "brand_lexemes"]
    classes = rows.groupBy("class_id").agg(*[F.any_value(c).alias(c) for c in forms], F.count("*").alias("n"))
    classes = written(classes.withColumns({"name_grams": trigrams(F.col("name_norm")), "brand_grams": trigrams(F.col("brand_norm"))}), "classes")
    places = F.transform(
        F.array_distinct("lexemes"),
        lambda x: F.struct(
            x.alias("lexeme"),
            F.filter(F.transform("lexemes", lambda y, i: F.when(y == x, i)), lambda i: i.isNotNull()).alias("positions"),
            F.array_contains("brand_lexemes", x).alias("in_brand"),
        ),
    )
    postings = written(classes.select("class_id", F.explode(places).alias("p")).select("p.lexeme", "class_id", "p.positions", "p.in_brand"), "postings")
    counts = written(postings.groupBy(F.col("lexeme").alias("token")).agg(F.count("*").alias("n")), "lexemes")
    sets = rare_first(classes.select(F.col("class_id").alias("id"), F.col("lexemes").alias("tokens")), counts)
    full = classes.select(F.col("class_id").alias("id"), F.size("lexemes").alias("full"))
    names = classes.select(F.col("name_norm").alias("id"), F.col("name_grams").alias("tokens"))
    texts = names.unionByName(classes.select(F.col("brand_norm").alias("id"), F.col("brand_grams").alias("tokens"))).dropDuplicates(["id"])
    texts = written(texts, "texts")
    gram_counts = written(frequencies(texts), "grams")
    return SearchIndex(
        written(rows.select("id", "name", "class_id"), "members"), classes, postings, counts,
        written(sets.join(full, "id"), "lexeme_sets"), gram_counts, written(rare_first(texts, gram_counts), "gram_sets"),
    )


def _lexeme_tiers(index: SearchIndex, asked: DataFrame) -> DataFrame:
    """(q, class_id, tier) of the classes whose name is the query (1) or that hold all its lexemes (2, 3, 4)."""
    exact = asked.join(index.classes.select(F.col("name_norm").alias("q"), "class_id"), "q").select("q", "class_id", F.lit(1).alias("tier"))
    words = asked.select("q", F.size("q_lexemes").alias("n"), F.posexplode("q_lexemes").alias("j", "lexeme"))
    # A query with a lexeme that no product has is out here: its rarest lexeme has no count.
    known = words.join(index.lexeme_counts.withColumnsRenamed({"token": "lexeme", "n": "df"}), "lexeme", "left")
    rarest = known.groupBy("q").agg(F.array_sort(F.collect_set(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "lexeme"))).alias("x"))
    anchors = rarest.filter(F.col("x")[0]["df"] > 0).select("q", F.explode(F.slice("x.lexeme", 1, 2)).alias("lexeme"), F.least(F.size("x"), F.lit(2)).alias("anchors"))
    reached = anchors.join(index.postings.select("lexeme", "class_id"), "lexeme").groupBy("q", "class_id", "anchors").agg(F.count("*").alias("n"))
    reached = reached.filter("n = anchors").select("q", "class_id")
    hits = reached.join(words, "q").join(index.postings, ["lexeme", "class_id"])
    starts = F.transform("positions", lambda p: p - F.col("j"))
    held = hits.groupBy("q", "class_id").agg(
        F.any_value("n").alias("n"), F.count_distinct("j").alias("found"), F.bool_and("in_brand").alias("brand"),
        F.flatten(F.collect_list(starts)).alias("starts"),
    )
    # A start that every lexeme of the query has at its distance begins the phrase.
    phrase = F.exists(F.array_distinct("starts"), lambda s: F.size(F.filter("starts", lambda x: x == s)) == F.col("n"))
    tier = F.when(F.col("brand"), 2).when(phrase, 3).otherwise(4)
    both = exact.unionByName(held.filter("found = n").select("q", "class_id", tier.alias("tier")))
    return both.groupBy("q", "class_id").agg(F.min("tier").alias("tier"))


def search(documents: DataFrame | SearchIndex, queries: DataFrame, k: int = 60, fuzzy: float = 0.25, descent=(0.6, 0.4)) -> DataFrame:
    """query_id, id, tier, rank, place: for each query (query_id, q) its k best products.

    Tiers: 1 the name itself, 2 the brand has all lexemes, 3 phrase, 4 all lexemes,
    5 similar name or brand (above ``fuzzy``). Order: tier, rank, name, id. Null and empty
    queries, and those that nothing is like, have no rows; equal queries are answered once.

    Queries that have k products in tiers 1 to 4 or of a rank from ``descent``'s first
    value on are done: whatever is missing ranks lower. The others go on with the next
    value, and at last with ``fuzzy``. Products of one class tie but for name and id, so
    classes are ranked and the best of each follow.
    """
    index = documents if isinstance(documents, SearchIndex) else build_index(documents)
    q = queries.select("query_id", F.trim(folded(F.col("q"))).alias("q"), lexemes(F.col("q")).alias("q_lexemes")).filter("q <> ''")
    asked = written(q.groupBy("q").agg(F.any_value("q_lexemes").alias("q_lexemes")).withColumn("q_grams", trigrams(F.col("q"))), "asked")
    sure = written(_lexeme_tiers(index, asked), "sure")
    grams = written(rare_first(asked.select(F.col("q").alias("id"), F.col("q_grams").alias("tokens")), index.gram_counts), "asked_grams")
    words = rare_first(asked.select(F.col("q").alias("id"), F.col("q_lexemes").alias("tokens")), index.lexeme_counts)
    left, found = asked, None
    for t in (*[x for x in descent if x > fuzzy], fuzzy):
        open_ = left.select(F.col("q").alias("id"))
        texts = similar_candidates(grams.join(open_, "id", "left_semi"), index.gram_sets, t)
        texts = texts.select(F.col("id_a").alias("q"), F.col("id_b").alias("text"))
        of = lambda c: texts.join(index.classes.select(F.col(c).alias("text"), "class_id"), "text").select("q", "class_id")  # noqa: E731, B023
        pairs = of("name_norm").unionByName(of("brand_norm"))
        if t > fuzzy:
            more = containing_candidates(words.join(open_, "id", "left_semi"), index.lexeme_sets, t)
            pairs = pairs.unionByName(more.select(F.col("id_a").alias("q"), F.col("id_b").alias("class_id")))
        pairs = pairs.unionByName(sure.join(left, "q", "left_semi").select("q", "class_id")).distinct().join(sure, ["q", "class_id"], "left")
        rows = pairs.join(left, "q").join(index.classes.select("class_id", "lexemes", "name_grams", "brand_grams", "n"), "class_id")
        near = F.greatest(jaccard(F.col("name_grams"), F.col("q_grams")), jaccard(F.col("brand_grams"), F.col("q_grams")))
        share = F.size(F.array_intersect("q_lexemes", "lexemes")) / F.greatest(F.size("lexemes"), F.lit(1))
        rows = rows.select("q", "class_id", "n", "tier", near.alias("near"), share.alias("share"))
        rows = rows.filter(F.col("tier").isNotNull() | (F.col("near") > fuzzy))
        rows = rows.select("q", "class_id", "n", F.coalesce("tier", F.lit(5)).alias("tier"), F.greatest("near", "share").alias("rank"))
        rows = written(rows.filter((F.col("tier") < 5) | (F.col("rank") >= t)), "scored")
        enough = rows.groupBy("q").agg(F.sum("n").alias("n")).filter(F.col("n") >= k).select("q")
        done = rows if t == fuzzy else rows.join(enough, "q", "left_semi")
        found = done if found is None else found.unionByName(done)
        if t > fuzzy:
            left = written(left.join(enough, "q", "left_anti"), "left")
    order = [F.asc("tier"), F.desc("rank"), F.asc("name"), F.asc("id")]
    # k classes by tier and rank are enough unless more of them tie with the last: all that tie stay.
    w = Window.partitionBy("q").orderBy("tier", F.desc("rank"))
    levels = found.groupBy("q", "tier", "rank").agg(F.sum("n").alias("n"))
    levels = levels.withColumn("before", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    kept = levels.filter(F.coalesce("before", F.lit(0)) < k).select("q", "tier", "rank")
    classes = found.join(kept, ["q", "tier", "rank"]).select("q", "class_id", "tier", "rank")
    listed = top_k(index.members, ["class_id"], [F.asc("name"), F.asc("id")], k).drop("place")
    best = top_k(classes.join(listed, "class_id"), ["q"], order, k)
    return q.select("query_id", "q").join(best, "q").select("query_id", "id", "tier", "rank", "place")


def suggestions(products: DataFrame, queries: DataFrame, each: int = 20, k: int = 6) -> DataFrame:
    """query_id, label, kind, place: brands, then names, that start with the query; short ones first.

    Labels and queries meet by equality on the prefix of each query's length. Each distinct
    text is answered once, however many queries ask for it.
    """
    q = queries.select("query_id", F.trim(folded(F.col("q"))).alias("q")).filter(F.length("q") > 0)
    lengths = F.broadcast(q.select(F.length("q").alias("n")).distinct())
    label = lambda c, kind, order: products.select(
        F.trim(c).alias("label"), F.lit(kind).alias("kind"), F.lit(order).alias("priority")
    )
    labels = label("brand", "marca", 1).unionByName(label("name", "produto", 2)).filter("label <> ''").distinct()
    tried = labels.withColumn("_l", F.trim(folded(F.col("label")))).join(lengths, F.length("_l") >= F.col("n"))
    hits = tried.withColumn("q", F.expr("substring(_l, 1, n)")).join(q.select("q").distinct(), "q")
    short = [F.length("label"), F.asc("label")]
    top = top_k(hits.drop("_l", "n"), ["q", "kind"], short, each).drop("place")
    top = top_k(top, ["q"], [F.asc("priority"), *short], k)
    return q.join(top, "q").select("query_id", "label", "kind", "place")


def expand_terms(terms: DataFrame) -> DataFrame:
    """(term) -> term, forms: all words of the term's group, else the term itself."""
    pairs = [(plain_ascii(w).lower(), group) for group in SYNONYMS for w in group]
    known = F.create_map(*[x for w, g in dict(pairs).items() for x in (F.lit(w), F.array(*[F.lit(v) for v in g]))])
    return terms.select("term", F.coalesce(known[F.trim(strip_accents(F.lower("term")))], F.array("term")).alias("forms"))
