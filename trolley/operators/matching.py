"""Same product, different store: blocking, gates, name score and the best candidate.

Rows that no gate and no score can tell apart are one class, and classes meet instead of
rows: what a class finds holds for all its rows, and a class offers its smallest id or its
number of rows. Gates that ask for equal sets (flavour, variant, polarity) are signatures
and part of the join key. So is the quantity gate: quantities lie in logarithmic bins as
wide as the tolerance, and a class asks for its own and the neighbouring bins of every kind
it can be compared with; unit prices are met in the same way, where they count. So is, with
a least name score: classes meet over one of their rarest tokens, of which a pair that
scores enough shares one. What remains is a residual on the pair.

Pairs come by links: rows of one block (brand or own brand), whose unit prices count only
where a fruit or vegetable meets another own-brand or unbranded row, and fruit and
vegetables of any brand. The best candidate is an aggregate with a map-side part, not a
window; the fields of a row are fetched for the winners.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.functions.quantity import (
    TOLERANCE,
    UNIT_PRICE_TOLERANCE,
    jaccard,
    pack_count,
    parse_quantity,
    proxy_quantity,
    qty_matches,
    safe_unit_price,
    unit_price_ratio,
)
from trolley.functions.text import brand_norm, is_own_brand, name_tokens, normalized_text, plural_forms
from trolley.operators.history import history_increment
from trolley.operators.set_join import frequencies, least_overlap, rare_first
from trolley.sources.shared import written

THRESHOLD = 0.45
HIGH = 0.75
RELAXED = "frutas_legumes"
#: Flavour words; both sides must have the same ones.
FLAVOURS = (
    "natural queijo chilli chili picante fumado defumado morango chocolate baunilha caramelo caramel manga limao"
    " laranja ananas framboesa mirtilo maracuja pistacio avela cafe canela mel coco banana amora cereja pera maca uva"
    " kiwi pessego tutti frutis menta gengibre alho cebola cebolinho chalota ervas alecrim oregao manjericao tomilho"
    " curcuma curry caril wasabi soja amendoim pistachio salgado salgada doce acido"
).split()
#: Diet and process words, and those that count with their plurals.
VARIANTS = (
    "light zero integral magro magra gordo gorda desnatado desnatada meio meia bio organico organica biologico"
    " biologica diet reforcado reforcada extra premium tradicional classico classica original artesanal caseiro"
    " caseira cremoso cremosa"
).split()
VARIANTS_WITH_PLURALS = (
    "descafeinado descafeinada vegetariano vegetariana halal cru crua cozido cozida"
).split()
#: Nouns whose "sem" and "com" must agree.
POLARITY = "gluten acucar lactose sal gordura cafeina conservantes corantes alcool pele espinha".split()
#: Subcategories where the number of units must agree.
PACK_SENSITIVE = ("refrigerantes_sumos", "agua")
#: What a side of a match carries.
SIDE = ("id", "name", "brand", "price", "price_per_unit", "qty", "url", "image_url", "category", "subcategory")
#: The width of a bin of quantities; a little more than the tolerance, against rounding.
BIN = -math.log(1 - TOLERANCE) * (1 + 1e-9)
#: The bin of negative quantities, which the tolerance cannot tell apart.
NEGATIVE = -1_000_000
#: The width of a bin of unit prices, and the codes of rows without one and of all rows with one.
UNIT_BIN = math.log(1 + UNIT_PRICE_TOLERANCE) * (1 + 1e-9)
NO_UNIT, ANY_UNIT = -1_000_000, -2_000_000
#: What rows of a class have in common, besides the store, the block and the tokens.
COMMON = ("flavour", "variant", "polarity", "amount", "kind", "packs", "sensitive")


def word_signature(tokens: Column, words) -> Column:
    return F.array_join(F.array_sort(F.array_intersect(tokens, F.array(*[F.lit(w) for w in words]))), " ")


def variant_words() -> list[str]:
    return list(dict.fromkeys([*VARIANTS, *(f for w in VARIANTS_WITH_PLURALS for f in plural_forms(w))]))


def polarity_signature(text: Column) -> Column:
    flags = [
        F.when(text.rlike(rf"sem\s+{n}"), f"sem_{n}").when(text.rlike(rf"com\s+{n}"), f"com_{n}") for n in POLARITY
    ]
    return F.concat_ws(" ", *flags)


def prepare(catalogue: DataFrame, version: str = "v2") -> DataFrame:
    """Adds own_brand, qty, packs, tokens, brand_norm, block and the signatures.

    The text work is done once for each distinct store, name and brand. It and the rows are
    dealt over as many tasks as a shuffle has, however few files the catalogue lies in.
    """
    name, brand = F.col("name"), F.trim(F.coalesce("brand", F.lit("")))
    tasks = int(catalogue.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = ["store", "name", "brand"]
    own = is_own_brand(F.col("store"), brand)
    texts = catalogue.select(*key).distinct().repartition(tasks, *key).select(
        *key, own.alias("own_brand"), F.when(own, "").otherwise(brand).alias("_named"), brand_norm(brand).alias("brand_norm")
    )
    named = F.col("_named")
    texts = texts.select(
        "*", parse_quantity(name).alias("_parsed"), F.coalesce(pack_count(name), F.lit(1)).alias("packs"),
        name_tokens(name, named, version).alias("tokens"), polarity_signature(normalized_text(name, named)).alias("polarity"),
    )
    texts = texts.select(
        "*", F.when(F.col("own_brand"), "OWN").otherwise(F.col("brand_norm")).alias("block"),
        word_signature(F.col("tokens"), FLAVOURS).alias("flavour"), word_signature(F.col("tokens"), variant_words()).alias("variant"),
    )
    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"t.{k}")) for k in key]
    rows = catalogue.repartition(tasks).alias("c").join(texts.alias("t"), same)
    qty = F.coalesce("_parsed", proxy_quantity(F.col("price"), F.col("price_per_unit")))
    return rows.select(
        *[f"c.{c}" for c in catalogue.columns], "own_brand", qty.alias("qty"), "packs", "tokens", "polarity", "brand_norm",
        "block", "flavour", "variant",
    )


def quantity_bin(q: Column) -> Column:
    """Quantities within the tolerance of each other have the same bin or neighbouring ones; zero has none."""
    return F.when(q < 0, NEGATIVE).when(q > 0, F.floor(F.ln(q) / BIN)).cast("long")


def wanted_bins(qty: Column, scale: bool) -> Column:
    """array<struct<kind, bin>>: where the rows lie that ``qty`` may match, as ``qty_matches`` scales them."""
    q, times = qty["qty"], 1000.0 if scale else 1.0

    def around(kind, x):
        kind = F.lit(kind) if isinstance(kind, str) else kind
        return F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.struct(kind.alias("kind"), (quantity_bin(x) + d).alias("bin")))

    proxy = F.concat(around("proxy", q), around("weight", q * times), around("volume", q * times))
    none = F.array(F.struct(F.lit("none").alias("kind"), F.lit(0).cast("long").alias("bin")))
    return F.when(qty.isNull(), none).when(qty["kind"] == "proxy", proxy).otherwise(F.concat(around(qty["kind"], q), around("proxy", q / times)))


def numbered(prepared: DataFrame, version: str = "v2", named: bool = True) -> DataFrame:
    """The prepared rows, written once with a number each and the keys of their classes.

    ``block_key`` is of rows of one store and block, ``any_key`` of one store; without
    ``named`` neither depends on the tokens. Besides them only ``unit`` counts, the unit
    price, null where it is not positive. The older rules know neither packs nor unit prices.
    """
    old = F.lit(version == "v1")
    real = ~F.col("own_brand") & (F.col("brand_norm") != "")
    sub = F.nullif("subcategory", F.lit(""))
    rows = prepared.select(
        *[c for c in prepared.columns if c != "packs"],
        F.coalesce(F.col("category") == RELAXED, F.lit(False)).alias("relaxed"), real.alias("real"),
        F.col("qty.qty").alias("amount"), F.col("qty.kind").alias("kind"),
        F.when(old, 0).otherwise(F.col("packs")).alias("packs"), F.when(~old, sub.isin(*PACK_SENSITIVE)).alias("sensitive"),
        F.when(~old & (F.col("price_per_unit") > 0), F.col("price_per_unit")).alias("unit"),
        F.array_sort(F.array_distinct("tokens")).alias("words"),
    )
    common = ["store", *COMMON, *([F.array_join("words", " ")] if named else [])]
    told = lambda c: F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("\u0002"))
    digest = lambda *c: F.unhex(F.sha2(F.concat_ws("\u0001", *[told(x) for x in c]), 256))
    rows = rows.select("*", digest(*common, "block").alias("block_key"), digest(*common).alias("any_key"))
    return written(rows.withColumn("row", F.monotonically_increasing_id()), "prepared")


#: What tells classes apart.
CLASS = ("block_key", "any_key", "unit", "relaxed", "real")


def classes_of(rows: DataFrame) -> DataFrame:
    """The classes of ``numbered`` rows, written: ``n`` rows, of which ``first`` is the smallest (id, row)."""
    key = [*CLASS, "store", "block", "words", *COMMON]
    return written(rows.groupBy(*key).agg(F.count("*").alias("n"), F.min(F.struct("id", "row")).alias("first")), "classes")


def _groups(classes: DataFrame, key: str) -> DataFrame:
    """One row for each ``key``, with what its classes have in common."""
    block = F.col("block") if key == "block_key" else F.lit(None).cast("string").alias("block")
    return classes.select(F.col(key).alias("key"), "store", block, "words", *COMMON).dropDuplicates(["key"])


def _met(a: DataFrame, b: DataFrame, pairs: DataFrame, by_block: bool, scale: bool, least: float, ranked: DataFrame | None) -> DataFrame:
    """(pair_no, key_a, key_b, kind_a, kind_b, score) of groups of ordered store pairs, each pair once.

    They share all signatures and, ``by_block``, the block, and pass the quantity and pack
    gates; with ``least`` above 0 they have that score, without it the score is null.
    ``ranked`` has all token sets (words) with their rarest first (sorted) and their size.
    """
    keys = ["flavour", "variant", "polarity", "lies", "bin"] + (["block"] if by_block else [])
    if least:
        kept = (F.col("size") - F.ceil(F.col("size") * least - 1e-9) + 1).cast("int")
        first = ranked.select("*", F.posexplode(F.slice("sorted", F.lit(1), kept)).alias("place", "token"))
        a, b = a.join(first, "words"), b.join(first, "words")
        keys.append("token")
    else:
        none = {"sorted": F.lit(None).cast("array<string>"), "size": F.lit(0), "place": F.lit(0)}
        a, b = a.withColumns(none), b.withColumns(none)
    qty = F.when(F.col("kind").isNotNull(), F.struct(F.col("amount").alias("qty"), "kind"))
    side = F.struct("key", "sorted", "size", "place", qty.alias("qty"), "packs", "sensitive")
    asked = a.withColumn("_w", F.explode(F.array_distinct(wanted_bins(qty, scale))))
    asked = asked.withColumns({"lies": F.col("_w.kind"), "bin": F.col("_w.bin")}).filter("bin is not null")
    asked = asked.join(F.broadcast(pairs), F.col("store") == F.col("store_a")).select("pair_no", F.col("store_b").alias("store"), side.alias("a"), *keys)
    lies = b.withColumns({"lies": F.coalesce("kind", F.lit("none")), "bin": F.when(F.col("kind").isNull(), F.lit(0)).otherwise(quantity_bin(F.col("amount")))})
    met = asked.join(lies.filter("bin is not null").select("store", side.alias("b"), *keys), ["store", *keys])
    x, y = F.col("a"), F.col("b")
    sensitive = F.coalesce(x["sensitive"], y["sensitive"], F.lit(False))
    met = met.filter(qty_matches(x["qty"], y["qty"], scale) & ~(sensitive & (x["packs"] != y["packs"])))
    score = F.lit(None).cast("double")
    if least:
        rest = F.least(x["size"] - x["place"], y["size"] - y["place"])
        before = lambda z: F.slice(z["sorted"], F.lit(1), z["place"])
        met = met.filter((rest >= least_overlap(least, x["size"], y["size"])) & ~F.arrays_overlap(before(x), before(y)))
        score = jaccard(x["sorted"], y["sorted"])
    met = met.select("pair_no", x["key"].alias("key_a"), y["key"].alias("key_b"), x["qty"]["kind"].alias("kind_a"), y["qty"]["kind"].alias("kind_b"), score.alias("score"))
    return met.filter(F.col("score") >= least) if least else met


def _near_units(met: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """``met`` with the classes (key, unit) of both groups whose unit prices are not too far apart; a missing one is near."""
    place = F.floor(F.ln("unit") / UNIT_BIN).cast("long")
    none, every = F.lit(NO_UNIT).cast("long"), F.lit(ANY_UNIT).cast("long")
    asked = F.when(F.col("unit").isNull(), F.array(none, every)).otherwise(F.array(none, place - 1, place, place + 1))
    lies = F.when(F.col("unit").isNull(), F.array(none)).otherwise(F.array(every, place))
    own = a.select(F.col("key").alias("key_a"), F.col("unit").alias("unit_a"), F.explode(asked).alias("place"))
    other = b.select(F.col("key").alias("key_b"), F.col("unit").alias("unit_b"), "n_b", "first_b", F.explode(lies).alias("place"))
    near = met.join(own, "key_a").join(other, ["key_b", "place"])
    return near.filter(~F.coalesce(unit_price_ratio(F.col("unit_a"), F.col("unit_b")) > UNIT_PRICE_TOLERANCE, F.lit(False)))


def linked_classes(classes: DataFrame, pairs: DataFrame, scale: bool = True, least: float = 0.0, counted: bool = True) -> dict[str, DataFrame]:
    """By link, the classes (``classes_of``) that are candidates of each other.

    pair_no, key_a, unit_a, kind_a, kind_b, score, and of the class of store_b its number
    of rows ``n_b`` and its smallest ``first_b`` (id, row). ``block``: rows of one block,
    fruit and vegetables only of a real brand. ``gated``: of them, another row that is own
    brand or unbranded with fruit or vegetables. ``any``: fruit and vegetables of any brand.
    Pairs of the last that have one real brand are in the first as well: ``double`` lists
    them again where rows are ``counted``; the first comes before the last for the best.
    """
    ranked = None
    if least:
        classes = classes.filter(F.size("words") > 0)
        sets = classes.select(F.col("words").alias("id"), F.col("words").alias("tokens")).distinct()
        ranked = written(rare_first(sets, frequencies(sets)).select(F.col("id").alias("words"), F.col("tokens").alias("sorted"), "size"), "token_sets")
    fruit, branded = F.col("relaxed"), F.col("real")
    links = {
        "block": ("block_key", ~fruit | branded, ~fruit | branded, False),
        "gated": ("block_key", ~fruit & ~branded, fruit & ~branded, True),
        "any": ("any_key", fruit, fruit, True),
    }
    if counted:
        links["double"] = ("block_key", fruit & branded, fruit & branded, True)
    out = {}
    for name, (key, of_a, of_b, by_unit) in links.items():
        a, b = classes.filter(of_a), classes.filter(of_b)
        met = _met(_groups(a, key), _groups(b, key), pairs, key == "block_key", scale, least, ranked)
        unit = F.col("unit") if by_unit else F.lit(None).cast("double")
        by = lambda d: d.groupBy(F.col(key).alias("key"), unit.alias("unit")).agg(F.sum("n").alias("n_b"), F.min("first").alias("first_b"))  # noqa: B023, E731
        if by_unit:
            found = _near_units(met, by(a).select("key", "unit"), by(b))
        else:
            found = met.join(by(b).select(F.col("key").alias("key_b"), "n_b", "first_b"), "key_b").withColumn("unit_a", unit)
        out[name] = found.select("pair_no", "key_a", "unit_a", "kind_a", "kind_b", "score", "n_b", "first_b")
    return out


def _rows_of(name: str, rows: DataFrame, found: DataFrame) -> DataFrame:
    """``found``, one row for each pair_no, key_a and unit_a of a link, with the rows of store_a (or their classes) that it holds for."""
    fruit, branded = F.col("relaxed"), F.col("real")
    own = {"block": ~fruit | branded, "gated": ~fruit & ~branded, "any": fruit, "double": fruit & branded}[name]
    key = "any_key" if name == "any" else "block_key"
    on = F.col(key) == F.col("key_a")
    if name != "block":
        on = on & F.col("unit").eqNullSafe(F.col("unit_a"))
    return rows.filter(own).join(found, on).drop("key_a", "unit_a")


def candidate_counts(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """(store_a, store_b, candidates, rows_a): the pairs of ``numbered`` rows that pass all gates, and the ids of store_a in them."""
    key, classes = list(CLASS), classes_of(rows)
    counts = None
    for name, linked in linked_classes(classes, pairs).items():
        n = linked.groupBy("pair_no", "key_a", "unit_a").agg(F.sum("n_b").alias("n"))
        own = _rows_of(name, classes.select(*key, F.col("n").alias("n_a")), n)
        own = own.withColumn("n", -F.col("n") if name == "double" else F.col("n"))
        counts = own if counts is None else counts.unionByName(own)
    counts = written(counts.groupBy("pair_no", *key, "n_a").agg(F.sum("n").alias("n")).filter("n > 0"), "counts")
    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"r.{k}")) for k in key]
    ids = rows.alias("r").join(counts.alias("c"), same).groupBy("c.pair_no").agg(F.count_distinct("r.id").alias("rows_a"))
    total = counts.groupBy("pair_no").agg(F.sum(F.col("n_a") * F.col("n")).alias("candidates"))
    return total.join(ids, "pair_no").join(F.broadcast(pairs), "pair_no").select("store_a", "store_b", "candidates", "rows_a")


def candidate_kinds(rows: DataFrame, pairs: DataFrame, least: float) -> DataFrame:
    """(kind_a, kind_b, n): the pairs of ``numbered`` rows with that score that pass all gates, by the kinds of their quantities."""
    parts, classes = None, classes_of(rows)
    for name, linked in linked_classes(classes, pairs, least=least).items():
        n = linked.groupBy("pair_no", "key_a", "unit_a", "kind_a", "kind_b").agg(F.sum("n_b").alias("n"))
        sign = -1 if name == "double" else 1
        own = _rows_of(name, classes.select(*CLASS, F.col("n").alias("n_a")), n).select("kind_a", "kind_b", (F.col("n") * F.col("n_a") * sign).alias("n"))
        parts = own if parts is None else parts.unionByName(own)
    kind = lambda c: F.coalesce(c, F.lit("none")).alias(c)
    return parts.groupBy(kind("kind_a"), kind("kind_b")).agg(F.sum("n").alias("n")).filter("n > 0")


def match_all(catalogue: DataFrame, pairs: DataFrame, version: str = "v2") -> DataFrame:
    """The best candidate in store_b of each row of store_a, for all store pairs in one job.

    The prepared catalogue is written once: all branches read it, none repeats the text
    work. Score ties go to the brand bucket, then to the smaller id; several rows may pick the
    same candidate. Columns: store_a, store_b, pair_no, score, own_brand, a, b.
    """
    rows = numbered(prepare(catalogue, version), version)
    best = None
    for name, linked in linked_classes(classes_of(rows), pairs, version != "v1", THRESHOLD, counted=False).items():
        order = F.struct((-F.col("score")).alias("falling"), F.lit(int(name == "any")).alias("source"), "first_b.id", "first_b.row")
        found = linked.groupBy("pair_no", "key_a", "unit_a").agg(F.min(order).alias("m"))
        own = _rows_of(name, rows.select(F.col("row").alias("row_a"), *CLASS), found).select("pair_no", "row_a", "m")
        best = own if best is None else best.unionByName(own)
    best = best.groupBy("pair_no", "row_a").agg(F.min("m").alias("m"))
    best = best.select("pair_no", "row_a", (-F.col("m.falling")).alias("score"), F.col("m.row").alias("row_b"))
    a = rows.select(F.col("row").alias("row_a"), "own_brand", F.struct(*SIDE).alias("a"))
    best = best.join(a, "row_a").join(rows.select(F.col("row").alias("row_b"), F.struct(*SIDE).alias("b")), "row_b")
    best = best.join(F.broadcast(pairs), "pair_no")
    return best.select("store_a", "store_b", "pair_no", F.round("score", 3).alias("score"), "own_brand", "a", "b")


def with_confidence(matches: DataFrame) -> DataFrame:
    """Own-brand matches stay only if a side is fruit or vegetables; adds confidence high or low."""
    fruit = F.coalesce((F.col("a.category") == RELAXED) | (F.col("b.category") == RELAXED), F.lit(False))
    safe = safe_unit_price(F.col("a.price_per_unit"), F.col("b.price_per_unit"))
    high = F.when(F.col("own_brand"), safe).otherwise(F.col("score") >= HIGH)
    return matches.filter(~F.col("own_brand") | fruit).withColumn("confidence", F.when(high, "high").otherwise("low"))


#: The labels that a review filter asks for together.
LABEL_GROUPS = {"suspect": ("suspect_price", "suspect_quantity"), "probable": ("probable",)}


def review_rows(low: DataFrame, existing: DataFrame) -> DataFrame:
    """Low matches that are not in review yet (in any status) and have both prices."""
    key = lambda c: F.lower(F.trim(c))
    rows = low.filter("a.price is not null and b.price is not null").select(
        "store_a", "store_b", F.col("score").alias("match_score"),
        F.col("a.name").alias("name_a"), F.col("b.name").alias("name_b"),
        F.coalesce(F.nullif("a.brand", F.lit("")), F.col("b.brand")).alias("brand"), F.col("a.category").alias("category"),
        F.col("a.price").alias("price_a"), F.col("b.price").alias("price_b"),
        F.coalesce("a.qty.qty", "b.qty.qty").alias("quantity"), F.coalesce("a.qty.kind", "b.qty.kind").alias("quantity_unit"),
        F.col("a.qty.qty").alias("quantity_a"), F.col("b.qty.qty").alias("quantity_b"),
        F.col("a.qty.kind").alias("quantity_unit_a"), F.col("b.qty.kind").alias("quantity_unit_b"),
        F.col("a.price_per_unit").alias("price_per_unit_a"), F.col("b.price_per_unit").alias("price_per_unit_b"),
        F.col("a.url").alias("url_a"), F.col("b.url").alias("url_b"),
        F.col("a.image_url").alias("image_url_a"), F.col("b.image_url").alias("image_url_b"),
        F.lit("pending").alias("status"),
    )
    known = existing.select("store_a", "store_b", key("name_a").alias("_a"), key("name_b").alias("_b")).distinct()
    keyed = rows.withColumns({"_a": key(F.col("name_a")), "_b": key(F.col("name_b"))})
    return keyed.join(known, ["store_a", "store_b", "_a", "_b"], "left_anti").drop("_a", "_b")


def triage_label() -> Column:
    """Of a review row: suspect price, suspect quantity, probable or insufficient."""
    ratio = unit_price_ratio(F.col("price_per_unit_a"), F.col("price_per_unit_b"))
    real = F.col("quantity_unit_a").isin("weight", "volume") & F.col("quantity_unit_b").isin("weight", "volume")
    qa, qb = F.col("quantity_a"), F.col("quantity_b")
    apart = F.coalesce(F.try_divide(F.abs(qa - qb), F.greatest(qa, qb)) > 0.05, F.lit(False))
    return (
        F.when(ratio > 0.5, "suspect_price")
        .when(real & ((F.col("quantity_unit_a") != F.col("quantity_unit_b")) | apart), "suspect_quantity")
        .when(ratio <= UNIT_PRICE_TOLERANCE, "probable")
        .otherwise("insufficient")
    )


def review_filter(review: DataFrame, store: str | None = None, group: str | None = None) -> DataFrame:
    """Labelled review rows with ``store`` on either side and a label of ``group`` (suspect or probable)."""
    if store is not None:
        review = review.filter((F.col("store_a") == store) | (F.col("store_b") == store))
    if group is not None:
        review = review.filter(F.col("label").isin(*LABEL_GROUPS[group]))
    return review


def apply_decisions(
    review: DataFrame, decisions: DataFrame, day: str, existing: DataFrame, latest: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(review with new status, new canonical rows of approved pairs, their changed prices).

    ``decisions`` has the review key and status approved or rejected; the last one given
    is not known, so keys must be unique. ``existing`` (product_id, name, brand) are the
    canonical rows there are: an approved pair with the name and brand of one takes its id
    and gives no row, so nothing is downgraded. Of several pairs of one new product the
    best scored gives the row. ``latest`` (product_id, store, price) are the last prices;
    only prices that differ in cents are returned, of a store given twice the lowest.
    """
    key = ["store_a", "store_b", "name_a", "name_b"]
    new = decisions.select(*key, F.col("status").alias("_new"))
    after = review.join(new, key, "left").withColumn("status", F.coalesce("_new", "status")).drop("_new")
    known = existing.select(F.col("name").alias("_name"), F.col("brand").alias("_brand"), F.col("product_id").alias("_id"))
    approved = review.join(new.filter("_new = 'approved'"), key, "left_semi")
    approved = approved.join(
        known, (F.col("name_a") == F.col("_name")) & F.col("brand").eqNullSafe(F.col("_brand")), "left"
    )
    fresh = F.sha2(F.concat_ws("|", F.lower(F.trim("name_a")), F.lower(F.trim(F.coalesce("brand", F.lit(""))))), 256)
    approved = approved.withColumn("product_id", F.coalesce(F.col("_id").cast("string"), fresh))
    row = F.struct(
        F.col("name_a").alias("name"), "brand", "category", "quantity", "quantity_unit",
        F.coalesce("image_url_a", "image_url_b").alias("image_url"), F.lit("manual").alias("confidence"), "match_score",
    )
    canonical = approved.filter("_id is null").groupBy("product_id").agg(F.max_by(row, F.struct("match_score", *key)).alias("r"))
    sides = F.array(
        F.struct(F.col("store_a").alias("store"), F.col("price_a").alias("price")),
        F.struct(F.col("store_b").alias("store"), F.col("price_b").alias("price")),
    )
    prices = approved.select("product_id", F.explode(sides).alias("p")).groupBy("product_id", "p.store").agg(F.min("p.price").alias("price"))
    last = latest.select(F.col("product_id").cast("string"), "store", "price")
    changed = history_increment(last, prices, ["product_id", "store"])
    return after, canonical.select("product_id", "r.*"), changed.withColumn("day", F.lit(day).cast("date"))
