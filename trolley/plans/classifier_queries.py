"""Queries of the rule tables, over product words put together from the parts' numbers on both sides."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.functions import classify as C
from trolley.plans.registry import query
from trolley.sources.catalogue import table

WORDS = (
    "Leite Iogurtes Queijo Natas Ovos Gelatina Vegegurte Caldo Vitela Porco Frango Camarão Fiambre Bacalhau Chocolates Sumo"
    " Desidratados Frutas Legumes Bolachas Massa Conservas Azeite Molho Pipocas Gomas Mel Croissant Tostas Bolo Pães Gelados"
    " Congelados Carne Pizza Cerveja Vinho Gin Água Refrigerante Chá Champô Desodorizante Depilação Creme Fraldas Papa Toalhitas"
    " Bebé Detergente Roupa Loiça Absorventes Limpeza Ração Cão Gato Areia Animais Parafusos Arroz Atum Lasanha Salteado"
    " Sal Rum Águas Ginástica Chão Cachaço"
).split() + ["Frutos Secos", "Ervas Aromáticas", "Salada Pronta", "Prato Pronto", "Higiene Oral", "Higiene Íntima", "Papel Higiénico", "Sacos do Lixo", "Pizza para Forno"]
PARENTS = (
    "Vinho, cerveja e bebidas espirituosas", "Bebidas", "Frutas e Legumes", "Frutas e Legumes Congelados", "Padaria",
    "Laticínios e Ovos", "Alimentos Congelados", "Animais", "Limpeza", "Queijos, Laticínios e Ovos",
)
LEAVES = (
    "Champanhe e Espumante", "Cerveja", "Bebidas Espirituosas", "Vinho", "Outros", "Água", "Fruta", "Legumes", "Pastelaria",
    "Iogurte", "Leite e Natas", "Gelado", "Carne de Vaca", "Peixe e Marisco", "Peixe e Marisco Congelados", "Sobremesas",
    "Ração para Cão", "Areia de Gato", "Sacos Lixo", "Café",
)
FIRST = (*C.URL_FIRST, *C.URL_SECOND, "outros")
SECOND = tuple(dict.fromkeys(s for seconds in C.URL_SECOND.values() for s in seconds))
#: An address for each rule of the seed list: the first of its alternatives.
SEEDS = tuple(re.sub(r"\(([^|)]*)[^)]*\)", r"\1", pattern).replace("\\", "") for _, pattern in C.URL_RULES)


def _sql_list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _pick(words, step: int = 1, shift: int = 1) -> tuple[Callable[[], Column], str]:
    """A word of each part by its number, as a function for Spark (columns need a session) and in SQL."""
    n = len(words)
    at = f"CAST((p_partkey * {step} + p_partkey // {shift * n}) % {n} AS INTEGER) + 1"

    def column() -> Column:
        key = F.col("p_partkey")
        place = ((key * step + F.floor(key / (shift * n))) % n).cast("int") + 1
        return F.element_at(F.array(*[F.lit(w) for w in words]), place)

    return column, f"{_sql_list(words)}[{at}]"


def _sql_rules(text: str, rules, flags: str = "i") -> str:
    """The rules as a CASE over RE2 patterns, which have no lookaround: an excluded tail is masked first."""
    out = []
    for subcategory, pattern in rules:
        pattern = pattern.replace("(?<![A-Za-z0-9_])", r"\b").replace("(?![A-Za-z0-9_])", r"\b")
        test = text
        if tail := re.fullmatch(r"(.+)\(\?!(.+)\)", pattern):
            pattern = tail[1]
            test = f"replace(lower({text}), '{tail[1]}{tail[2]}', '#')"
        out.append(f"WHEN regexp_matches({test}, '{pattern}', '{flags}') THEN '{subcategory}'")
    return f"CASE {' '.join(out)} END"


def _sql_category(subcategory: str) -> str:
    return "CASE " + " ".join(f"WHEN {subcategory} IN ({_sql_list(s.split())[1:-1]}) THEN '{c}'" for c, s in C.SUBCATEGORIES.items()) + " END"


def _sql(text: str, subcategory: str, name: str) -> str:
    return (
        f"SELECT p_partkey, {name}, {_sql_category('subcategory')} AS category, subcategory"
        f" FROM (SELECT *, {subcategory} AS subcategory FROM (SELECT p_partkey, {text} AS {name} FROM part))"
    )


def _classified(spark, sf_dir: str, text: Column, name: str, classify) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_partkey", text.alias(name))
    return C.classify_distinct(rows, name, classify).select("p_partkey", name, "category", "subcategory")


(first_word, SQL_A), (second_word, SQL_B) = _pick(WORDS), _pick(WORDS, 7, 3)
SQL_CRUMBS = f"{SQL_A} || ' / ' || {SQL_B}"
(parent, SQL_PARENT), (leaf, SQL_LEAF) = _pick(PARENTS), _pick(LEAVES, 3, 2)
SQL_PATH = f"'Loja/' || {SQL_PARENT} || '/' || {SQL_LEAF}"
(first_segment, SQL_ONE), (second_segment, SQL_TWO) = _pick(FIRST), _pick(SECOND, 5)
SQL_URL = f"'https://loja.example/home/produtos/' || {SQL_ONE} || '/' || {SQL_TWO} || '/a-1.html'"
seed, SQL_SEED = _pick(SEEDS)


def _crumbs() -> Column:
    return F.concat(first_word(), F.lit(" / "), second_word())


@query(_sql(SQL_CRUMBS, _sql_rules("strip_accents(crumbs)", C.BREADCRUMB_1), "crumbs"))
def breadcrumb_classes_first(spark, sf_dir):
    return _classified(spark, sf_dir, _crumbs(), "crumbs", lambda c: C.classify_breadcrumb(c, 1))


@query(_sql(SQL_CRUMBS, _sql_rules("strip_accents(crumbs)", C.BREADCRUMB_2), "crumbs"))
def breadcrumb_classes_second(spark, sf_dir):
    return _classified(spark, sf_dir, _crumbs(), "crumbs", lambda c: C.classify_breadcrumb(c, 2))


@query(
    _sql(
        SQL_PATH,
        f"CASE WHEN lower(trim(string_split(strip_accents(crumbs), '/')[2])) = '{C.DRINKS_PARENT}'"
        f" THEN {_sql_rules("trim(string_split(strip_accents(crumbs), '/')[3])", C.DRINKS_LEAF)}"
        f" ELSE {_sql_rules('strip_accents(crumbs)', C.BREADCRUMB_3)} END",
        "crumbs",
    )
)
def breadcrumb_classes_third(spark, sf_dir):
    path = F.concat(F.lit("Loja/"), parent(), F.lit("/"), leaf())
    return _classified(spark, sf_dir, path, "crumbs", lambda c: C.classify_breadcrumb(c, 3))


@query(_sql(f"{SQL_A} || ' ' || p_name || ' ' || {SQL_B}", _sql_rules("strip_accents(lower(name))", C.NAME_5), "name"))
def name_classes(spark, sf_dir):
    name = F.concat(first_word(), F.lit(" "), F.col("p_name"), F.lit(" "), second_word())
    return _classified(spark, sf_dir, name, "name", C.classify_name)


def _sql_url() -> str:
    one = "regexp_extract(url, '/home/produtos/([^/]+)/', 1)"
    two = "regexp_extract(url, '/home/produtos/[^/]+/([^/]+)', 1)"
    out = [f"WHEN {one} = '{a}' THEN '{s}'" for a, s in C.URL_FIRST.items()]
    for a, seconds in C.URL_SECOND.items():
        out += [f"WHEN {one} = '{a}' AND {two} = '{b}' THEN '{s}'" for b, s in seconds.items() if b != "default"]
        out += [f"WHEN {one} = '{a}' THEN '{seconds['default']}'"] if "default" in seconds else []
    return f"CASE {' '.join(out)} END"


@query(_sql(SQL_URL, _sql_url(), "url"))
def url_classes(spark, sf_dir):
    url = F.concat(F.lit("https://loja.example/home/produtos/"), first_segment(), F.lit("/"), second_segment(), F.lit("/a-1.html"))
    return _classified(spark, sf_dir, url, "url", C.classify_url_path)


@query(
    f"""SELECT p_partkey, url, CASE WHEN subcategory = 'cafe_cha' THEN 'bebidas' WHEN contains(url, '/alimentacao-infantil/') THEN 'bebe'
        ELSE 'mercearia_doce_salgada' END AS category, subcategory
    FROM (SELECT *, {_sql_rules('url', C.URL_RULES, 'c')} AS subcategory
        FROM (SELECT p_partkey, 'https://loja.example' || {SQL_SEED} || '/a-' || p_partkey % 3 || '.html' AS url FROM part))"""
)
def seed_url_classes(spark, sf_dir):
    url = F.concat(F.lit("https://loja.example"), seed(), F.lit("/a-"), (F.col("p_partkey") % 3).cast("string"), F.lit(".html"))
    return _classified(spark, sf_dir, url, "url", lambda c: C.classify_seed_url(c, F.lit("mercearia_doce_salgada")))
