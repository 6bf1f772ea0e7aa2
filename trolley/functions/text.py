"""Column functions on names, brands, URLs and messages."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\s\u00a0]"
#: Letters without a decomposition that search folds as well.
LIGATURES = {"ß": "ss", "æ": "ae", "Æ": "AE", "ø": "o", "Ø": "O", "œ": "oe", "Œ": "OE", "đ": "d", "ł": "l", "Ł": "L"}
#: Packaging words that say nothing about the product.
PACK_WORDS = (
    "pack", "un", "uni", "unid", "unidade", "unidades", "embalagem", "emb", "garrafa", "lata", "saco", "cx", "caixa",
    "pacote", "pct", "tabuleiro", "bandeja", "frasco", "tina", "tinas", "bolsa", "bolsas", "goma",
)
#: Brands whose spelling differs between stores.
CANONICAL_BRANDS = (
    "Mimosa", "Nivea", "Cem Porcento", "Nestlé", "L'Oréal Paris", "Margão", "Pantene", "Gullón", "Alpro",
    "Purina One", "Pescanova", "Nacional", "Iglo", "Dove", "Knorr", "Vileda", "Milka", "Lipton", "Colgate", "Salutem",
    "Dodot", "Delta", "Garnier", "Chicco", "Bribon", "Magnum", "Vitakraft", "Origens Bio", "Milaneza", "Renova",
    "Johnson's Baby", "Oral-B", "Air Wick", "Kellogg's", "Lay's", "L'Or", "H&S", "Dompé", "Carte D'Or",
    "Lily's Kitchen", "Scotch-Brite", "Dr. Oetker", "St. Dalfour", "GoGo Squeez", "McVitie's", "Ben & Jerry's",
    "M&M's", "Ach. Brito", "8in1", "Hellmann's", "Capri-Sun", "Jack Daniel's", "Reese's", "Ambi Pur", "PepeTed",
    "Dow's", "Grant's", "H. M. Borges", "Kit&Kin", "Moët & Chandon", "Mr. Cheese", "Dr. Beckmann", "Ballantine's",
    "Gordon's", "Hendrick's", "Fever-Tree", "Werther's", "Taylor's", "Fresh & Clean", "Full Protein", "Blandy's",
    "Nairn's", "Tesori D'Oriente", "Vive Soy", "Justino's", "Martha's", "Driscoll's", "St Michel", "Snatt's", "Carr's",
    "St Pierre", "Cuits", "Gibson's", "Solo Italia", "DemakUp", "Kh-7", "Dr Pepper", "D. Graça", "William Lawson's",
    "Piper-Heidsieck", "Martin Miller's", "Sheridan's", "Out!", "Dr. Bentes", "G'Vine", "Forno D'Oro", "Gold Strike",
    "Quinta dos Aciprestes", "Quinta de S. Francisco", "Quinta dos Carvalhais", "Innocent Maçã",
)
#: Own brands of each store, as anchored prefixes.
OWN_BRANDS = {
    "continente": "continente|da nossa pastelaria",
    "pingo-doce": "pingo doce|nossa |nosso |os nossos|comida fresca",
    "lidl": "chef select|cien|milbona|alesto|freeway|solevita|ocean sea|kania|snack day|formil|silvercrest|parkside"
    "|crivit|tastino|deluxe|w5|vitasan|vemondo|sondey",
    "auchan": "auchan|pouce|cosmia",
    "aldi": "aldi|crofton|frantastique|up2fashion|workzone|cucina|ravini|deco craft|power force|milsani|choceur",
}
#: Entities that the pages use.
ENTITIES = {
    "&quot;": '"', "&euro;": "€", "&#39;": "'", "&apos;": "'", "&nbsp;": "\u00a0", "&lt;": "<", "&gt;": ">", "&amp;": "&",
}


@cache
def _accent_table(fold_ligatures: bool) -> tuple[str, str]:
    """Letters below U+2000 that decompose into an ASCII letter and combining marks, and that letter."""
    source, target = [], []
    for code in range(0xC0, 0x2000):
        parts = unicodedata.normalize("NFD", chr(code))
        if len(parts) > 1 and all("\u0300" <= c <= "\u036f" for c in parts[1:]):
            source.append(chr(code))
            target.append(parts[0])
    if fold_ligatures:
        for letter, plain in LIGATURES.items():
            if len(plain) == 1:
                source.append(letter)
                target.append(plain)
    return "".join(source), "".join(target)


def plain_ascii(s: str) -> str:
    """The same folding for driver-side constants."""
    return "".join(c for c in unicodedata.normalize("NFD", s) if not "\u0300" <= c <= "\u036f")


def strip_accents(c: Column, fold_ligatures: bool = False) -> Column:
    source, target = _accent_table(fold_ligatures)
    out = F.regexp_replace(F.translate(c, source, target), "[\\u0300-\\u036f]", "")
    if fold_ligatures:
        for letter, plain in LIGATURES.items():
            if len(plain) > 1:
                out = F.replace(out, F.lit(letter), F.lit(plain))
    return out


def drop_apostrophes(c: Column) -> Column:
    return F.regexp_replace(c, "['’]", "")


def _spaced(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, f"[^a-z0-9{SPACE[1:-1]}]", " "), f"{SPACE}+", " "))


def without_first(c: Column, part: Column) -> Column:
    """``c`` with the first occurrence of ``part`` turned into a blank."""
    at = F.locate(part, c) if isinstance(part, str) else F.instr(c, part)
    return F.when((F.length(part) > 0) & (at > 0), F.overlay(c, F.lit(" "), at, F.length(part))).otherwise(c)


def name_tokens(name: Column, brand: Column, version: str = "v2") -> Column:
    """Tokens of a product name: first quantity and first brand text removed, pack words and numbers dropped.

    ``v1`` is the older rule set: apostrophes become blanks and the brand goes before the punctuation.
    """
    from trolley.functions.quantity import without_first_quantity

    brand = F.coalesce(brand, F.lit(""))
    if version == "v1":
        s = strip_accents(F.lower(name))
        s = without_first(s, F.trim(strip_accents(F.lower(brand))))
        s = _spaced(without_first_quantity(s))
    else:
        s = _spaced(without_first_quantity(drop_apostrophes(strip_accents(F.lower(name)))))
        s = without_first(s, _spaced(drop_apostrophes(strip_accents(F.lower(brand)))))
    words = F.split(F.trim(F.regexp_replace(s, f"{SPACE}+", " ")), " ")
    return F.filter(words, lambda t: (t != "") & ~t.isin(*PACK_WORDS) & ~t.rlike("^[0-9]+$"))


def normalized_text(name: Column, brand: Column) -> Column:
    """The text that name tokens are cut from, pack words and numbers included."""
    from trolley.functions.quantity import without_first_quantity

    s = _spaced(without_first_quantity(drop_apostrophes(strip_accents(F.lower(name)))))
    s = without_first(s, _spaced(drop_apostrophes(strip_accents(F.lower(F.coalesce(brand, F.lit("")))))))
    return F.trim(F.regexp_replace(s, f"{SPACE}+", " "))


def brand_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(strip_accents(c)), "[^a-z0-9]+", "")


def brand_norm(c: Column) -> Column:
    """The blocking form of a brand; null counts as empty."""
    return strip_accents(F.lower(F.trim(F.coalesce(c, F.lit("")))))


def normalize_brand(c: Column) -> Column:
    """Canonical spelling where the key is known, else the trimmed brand; empty brands stay."""
    known = F.create_map(*[F.lit(x) for b in CANONICAL_BRANDS for x in (_key(b), b)])
    trimmed = F.trim(c)
    return F.when(trimmed == "", c).otherwise(F.coalesce(known[brand_key(trimmed)], trimmed))


def _key(brand: str) -> str:
    return "".join(x for x in plain_ascii(brand).lower() if x.isascii() and x.isalnum())


def is_own_brand(store: Column, brand: Column) -> Column:
    brand = F.trim(F.coalesce(brand, F.lit("")))
    out = F.lit(False)
    for name, prefixes in OWN_BRANDS.items():
        out = out | ((store == name) & brand.rlike(f"(?i)^({prefixes})"))
    return F.coalesce(out, F.lit(False))


def plural_forms(word: str) -> list[str]:
    """The word and the plural that its ending takes."""
    endings = (
        (("ao",), 2, ("oes", "aes", "aos")),
        (("al", "el", "ol", "ul"), 1, ("is",)),
        (("il",), 2, ("is",)),
        (("m",), 1, ("ns",)),
        (("r", "z"), 0, ("es",)),
        (("",), 0, ("s",)),
    )
    for tails, cut, forms in endings:
        if word.endswith(tails):
            stem = word[: len(word) - cut]
            return list(dict.fromkeys([word, *(stem + f for f in forms)]))
    return [word]


def word_form(word: str) -> str:
    """Pattern of the word or its plural as a whole ASCII word."""
    return rf"(?<![A-Za-z0-9_])({'|'.join(plural_forms(word))})(?![A-Za-z0-9_])"


def singular(c: Column) -> Column:
    """A light fold of plurals, for search."""
    return (
        F.when(c.rlike("(oes|aes|aos)$"), F.concat(F.regexp_replace(c, "(oes|aes|aos)$", ""), F.lit("ao")))
        .when(c.rlike("[aeou]is$"), F.regexp_replace(c, "is$", "l"))
        .when(c.rlike("ns$"), F.regexp_replace(c, "ns$", "m"))
        .when(c.rlike("[rz]es$"), F.regexp_replace(c, "es$", ""))
        .when(c.rlike("[^s]s$"), F.regexp_replace(c, "s$", ""))
        .otherwise(c)
    )


def business_key(name: Column, brand: Column) -> Column:
    return F.concat_ws("|", F.lower(F.trim(name)), F.lower(F.trim(F.coalesce(brand, F.lit("")))))


def node_id(store: Column, url: Column) -> Column:
    return F.concat_ws("::", store, url)


def slug(c: Column, most: int = 80) -> Column:
    dashed = F.regexp_replace(strip_accents(F.lower(c)), "[^a-z0-9]+", "-")
    return F.substring(F.regexp_replace(dashed, "^-+|-+$", ""), 1, most)


def url_host(c: Column) -> Column:
    return F.lower(F.regexp_extract(c, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]+)", 1))


def store_of_url(c: Column, stores=("continente", "pingodoce", "auchan", "lidl", "aldi")) -> Column:
    """The store whose name is a label of the URL's host, else 'outro'."""
    host = F.concat(F.lit("."), url_host(c), F.lit("."))
    out = F.lit("outro")
    for store in stores:
        out = F.when(F.contains(host, F.lit(f".{store}.")), store).otherwise(out)
    return out


def image_extension(c: Column) -> Column:
    found = F.lower(F.regexp_extract(c, r"(?i)\.(jpg|jpeg|png|webp)(?:$|[?#])", 1))
    return F.when(found == "", "jpg").otherwise(found)


def html_unescape(c: Column) -> Column:
    for entity, letter in ENTITIES.items():
        c = F.replace(c, F.lit(entity), F.lit(letter))
    return c


def html_text(c: Column) -> Column:
    """Entities decoded, tags turned into blanks, white space collapsed."""
    plain = F.regexp_replace(html_unescape(c), "<[^>]+>", " ")
    return F.trim(F.regexp_replace(plain, f"{SPACE}+", " "))


def parse_number(c: Column, pattern: str = r"([0-9]+[.,][0-9]+)") -> Column:
    return F.replace(F.regexp_extract(c, pattern, 1), F.lit(","), F.lit(".")).try_cast("double")


def parse_euro(c: Column) -> Column:
    return parse_number(c, rf"([0-9]+,[0-9]+){SPACE}*€")


def format_euro(c: Column) -> Column:
    return F.replace(F.format_string("%.2f€", c), F.lit("."), F.lit(","))


def token_hash(c: Column) -> Column:
    """h = (31 h + code) mod 2^32 over the characters."""
    codes = F.transform(F.split(c, ""), F.ascii)
    codes = F.filter(codes, lambda x: x > 0)
    return F.aggregate(codes, F.lit(0).cast("long"), lambda h, x: (h * 31 + x) % F.lit(4294967296))


def unit_label(kind: Column) -> Column:
    return F.when(kind == "volume", "€/L").when(kind == "weight", "€/kg").otherwise("€/un")


def plural_suffix(n: Column, suffix: str = "s") -> Column:
    return F.when(n > 1, suffix).otherwise("")
