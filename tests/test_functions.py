"""Literal tables, with expectations worked out from the rules by hand."""

import pytest
from pyspark.sql import functions as F

from trolley.functions import classify as C
from trolley.functions import quantity as Q
from trolley.functions import text as T


def column(spark, values, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(make(F.col("v"))).collect()]


def test_quantities(spark):
    cases = {
        "Leite Meio Gordo 1L": (1000, "ml"),
        "Iogurte 4x125g": (500, "g"),
        "Ração Cão 10-25kg Pedigree 15kg": (15000, "g"),
        "Fraldas 9-15kg T4": None,
        "Fraldas +15kg T7": None,
        "Fraldas <3kg T0": None,
        "Água 1,5L": (1500, "ml"),
        "Cerveja 6x330ml": (1980, "ml"),
        "Vinho 75cl": (750, "ml"),
        "Arroz 500 g": (500, "g"),
        "1 lâmina": (1000, "ml"),
        "": None,
        None: None,
    }
    got = column(spark, list(cases), Q.extract_quantity)
    assert [None if g is None else (g["value"], g["unit"]) for g in got] == list(cases.values())


def test_pack_counts(spark):
    cases = {
        "Ice Tea Pêssego Pack 6": 6,
        "Pack de 4 Iogurtes": 4,
        "Ovos 6UN": 6,
        "Sumo 6x250ml": 6,
        "Sumo Laranja 1L": None,
    }
    assert column(spark, list(cases), Q.pack_count) == list(cases.values())


def test_names_brands_and_hash(spark):
    names = [("Gelado Tiramisu Les Desserts Carte DOr", "Carte D'Or"), (None, None), ("12 un", "")]
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(names)], "i int, n string, b string").orderBy("i")
    rows = df.select(
        T.name_tokens(F.col("n"), F.col("b")), T.name_tokens(F.col("n"), F.col("b"), "v1")
    ).collect()
    assert rows[0][0] == ["gelado", "tiramisu", "les", "desserts"]
    assert rows[0][1] == ["gelado", "tiramisu", "les", "desserts", "carte", "dor"]
    assert rows[1][0] is None and rows[2][0] == []
    assert column(spark, ["123", ""], T.token_hash) == [48690, 0]
    assert column(spark, ["NESTLÉ", " Nova ", "", None, "carte dor"], T.normalize_brand) == [
        "Nestlé",
        "Nova",
        "",
        None,
        "Carte D'Or",
    ]
    assert column(spark, ["A&B  Çá!"], T.slug) == ["a-b-ca"]
    assert column(spark, ["1,59 €", "x"], T.parse_euro) == [1.59, None]
    assert column(spark, ["<b>a</b>&nbsp;&amp; b"], T.html_text) == ["a & b"]


@pytest.mark.parametrize(
    ("word", "forms"),
    [
        ("cao", ["cao", "coes", "caes", "caos"]),
        ("vegetal", ["vegetal", "vegetais"]),
        ("homem", ["homem", "homens"]),
        ("fruta", ["fruta", "frutas"]),
        ("barril", ["barril", "barris"]),
        ("mar", ["mar", "mares"]),
    ],
)
def test_plurals(word, forms):
    assert T.plural_forms(word) == forms


def test_prices(spark):
    df = spark.sql("select * from values (null, 1.99), (1.99, 1.99), (1.99, 2.00) t(p, n)")
    assert [r[0] for r in df.select(Q.price_changed(F.col("p"), F.col("n"))).collect()] == [True, False, True]
    df = spark.sql("select * from values (40.0D), (40.01D) t(p)")
    assert [float(r[0]) for r in df.select(Q.target_threshold(F.col("p"))).collect()] == [0.05, 0.03]
    q = "named_struct('qty', {}, 'kind', '{}', 'multiplier', 1)"
    cases = [
        (q.format("1000D", "weight"), q.format("1D", "proxy"), True),
        (q.format("1000D", "weight"), q.format("1000D", "volume"), False),
        (q.format("0D", "weight"), q.format("0D", "weight"), False),
        (q.format("100D", "weight"), q.format("105D", "weight"), True),
        (q.format("100D", "weight"), q.format("106D", "weight"), False),
    ]
    for a, b, want in cases:
        df = spark.sql(f"select {a} a, {b} b")
        assert df.select(Q.qty_matches(F.col("a"), F.col("b"))).first()[0] is want
    null = spark.sql(f"select cast(null as struct<qty:double,kind:string,multiplier:int>) a, {cases[0][0]} b")
    assert null.select(Q.qty_matches(F.col("a"), F.col("b")), Q.qty_matches(F.col("a"), F.col("a"))).first() == (False, True)


def test_classifiers(spark):
    sub = lambda make: lambda c: make(c)["subcategory"]
    crumbs = ["Mercearia / Bolachas e Bolos", "Caldo Carne, Peixe e Legumes", "", None, "Padaria / Pães"]
    assert column(spark, crumbs, sub(lambda c: C.classify_breadcrumb(c, 2))) == [
        "bolachas_cereais",
        "molhos_temperos",
        None,
        None,
        "pao",
    ]
    assert column(spark, ["Frescos / Gelatina"], sub(lambda c: C.classify_breadcrumb(c, 1))) == ["sobremesas_lacteas"]
    drinks = ["x/Vinho, cerveja e bebidas espirituosas/Cerveja", "x/Vinho, cerveja e bebidas espirituosas/Outro"]
    assert column(spark, drinks, sub(lambda c: C.classify_breadcrumb(c, 3))) == ["cerveja", None]
    urls = [
        "https://x/home/produtos/congelados/x/a-1.html",
        "https://x/home/produtos/charcutaria-e-queijos/charcutaria/a-1.html",
        "https://x/home/produtos/ovos/x/a-1.html",
        "https://x/outro",
    ]
    assert column(spark, urls, sub(C.classify_url_path)) == ["pratos_prontos_congelados", None, "ovos", None]
    names = ["Vinho Tinto Douro", "Água das Pedras", "Chá Verde", "Parafuso"]
    assert column(spark, names, C.classify_beverage) == ["vinho", "agua", "cafe_cha", None]
    assert column(spark, ["Lasanha para Forno", "Arroz Agulha"], sub(C.classify_name)) == [
        "pratos_prontos_congelados",
        "massas_arroz",
    ]
    seeds = spark.createDataFrame([("/alimentacao-infantil/x", "m"), ("/conservas/x", "m")], "u string, d string")
    got = seeds.select(C.classify_seed_url(F.col("u"), F.col("d")).alias("c")).select("c.*").collect()
    assert [tuple(r) for r in got] == [("bebe", "cuidado_bebe"), ("m", "conservas")]
    assert len(C.CATEGORY) == 61


def test_similarity(spark):
    df = spark.sql("select 'cafe' a, 'cafes' b")
    assert df.select(Q.similarity(F.col("a"), F.col("b"))).first()[0] == pytest.approx(4 / 7)
