"""Ordered rule tables compiled to CASE expressions: the first matching rule wins.

A rule gives a subcategory; its category follows from the fixed pairs below. What no
rule matches is null. Long chains cost one regular expression per rule, so
``classify_distinct`` evaluates them once for each distinct input and joins back.
"""

from __future__ import annotations

import re

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.functions.text import plural_forms, strip_accents, word_form

#: The subcategories of each category.
SUBCATEGORIES = {
    "laticinios_ovos": "leite iogurtes queijos manteiga_natas ovos sobremesas_lacteas bebidas_iogurtes_vegetais",
    "talho_peixaria": "carne_vaca carne_porco aves peixe_fresco marisco charcutaria_enchidos",
    "frutas_legumes": "fruta legumes saladas_prontas frutos_secos ervas_aromaticas",
    "padaria_pastelaria": "pao bolos_pastelaria torradas_tostas croissants_folhados",
    "congelados": "gelados vegetais_congelados peixe_marisco_congelado carne_congelada pratos_prontos_congelados"
    " massa_pizza_congelada",
    "bebidas": "agua refrigerantes_sumos cafe_cha cerveja vinho bebidas_espirituosas",
    "mercearia_doce_salgada": "massas_arroz conservas azeite_oleos molhos_temperos snacks_aperitivos chocolates_doces"
    " bolachas_cereais compotas_mel",
    "higiene_pessoal_beleza": "cuidado_cabelo higiene_oral cuidado_pele higiene_intima desodorizantes depilacao",
    "bebe": "fraldas leite_po_boioes toalhitas cuidado_bebe",
    "casa_limpeza": "detergente_roupa limpeza_casa loica papel_higienico_absorventes sacos_lixo",
    "animais_estimacao": "racao_cao racao_gato areia_gatos acessorios_petiscos",
}
CATEGORY = {sub: cat for cat, subs in SUBCATEGORIES.items() for sub in subs.split()}
_CAO, _GATO = "|".join(plural_forms("cao")), "|".join(plural_forms("gato"))
_VEGETAL, _PAO = "|".join(plural_forms("vegetal")), "|".join(plural_forms("pao"))

#: Breadcrumb rules of the second store, in order (subcategory, pattern).
BREADCRUMB_2 = (
    ("leite", word_form("leite")),
    ("iogurtes", "iogurte"),
    ("queijos", "queijo"),
    ("manteiga_natas", "manteiga|natas"),
    ("ovos", r"\bovos?\b"),
    ("sobremesas_lacteas", "sobremesa.*lacte|lacte.*sobremesa"),
    ("bebidas_iogurtes_vegetais", f"bebida.*({_VEGETAL})|vegegurte"),
    ("molhos_temperos", r"\bcaldo\b"),
    ("carne_vaca", "vaca|bovino|novilho|vitela"),
    ("carne_porco", "porco|suino"),
    ("aves", "frango|aves|peru|pato|coelho"),
    ("marisco", r"marisco|camarao|lulas|polvo|\bchocos?\b"),
    ("charcutaria_enchidos", "charcutaria|fiambre|salame|chourico|presunto|salsicha|linguica"),
    ("peixe_fresco", "peixaria|peixe|bacalhau|salmao"),
    ("chocolates_doces", "chocolate"),
    ("refrigerantes_sumos", r"\bsumo\b|nectar"),
    ("frutos_secos", "frutos secos|desidratad"),
    ("ervas_aromaticas", "ervas aromaticas|especiarias"),
    ("saladas_prontas", "salada.*pronta|4a gama"),
    ("fruta", word_form("fruta")),
    ("legumes", "legum|hortalic"),
    ("bolachas_cereais", "bolacha|biscoito|cereal|barra"),
    ("massas_arroz", "massa|arroz|leguminosa|farinha"),
    ("conservas", "conserva"),
    ("azeite_oleos", "azeite|oleo aliment"),
    ("molhos_temperos", r"molho|tempero|especiaria|sal\b|maionese|ketchup|mostarda"),
    ("snacks_aperitivos", "snack|aperitivo|batata frita"),
    ("chocolates_doces", "chocolate|rebucado|goma"),
    ("compotas_mel", r"compota|doce|mel\b|marmelada"),
    ("croissants_folhados", "croissant|folhado"),
    ("torradas_tostas", "torrada|tosta"),
    ("bolos_pastelaria", "bolo|pastelaria|pasteis"),
    ("pao", rf"\b({_PAO})\b|padaria"),
    ("gelados", "gelado"),
    ("vegetais_congelados", "congelad.*legum|legum.*congelad|congelad.*vegetal"),
    ("peixe_marisco_congelado", "congelad.*peixe|congelad.*marisco|peixe.*congelad"),
    ("carne_congelada", "congelad.*carne|carne.*congelad"),
    ("massa_pizza_congelada", "congelad.*massa|congelad.*pizza|pizza.*congelad"),
    ("pratos_prontos_congelados", "prato.*pronto|refeicao.*pronta"),
    ("cerveja", "cerveja|sidra"),
    ("vinho", "vinho|champanhe|espumante"),
    ("bebidas_espirituosas", r"espirituos|licor|whisky|vodka|gin\b|rum\b"),
    ("agua", word_form("agua")),
    ("refrigerantes_sumos", "sumo|refrigerante|nectar"),
    ("cafe_cha", r"cafe|cha\b|infus"),
    ("cuidado_cabelo", "cabelo|champo|shampoo"),
    ("higiene_oral", "higiene oral|dentifrico|escova.*dente"),
    ("higiene_intima", "higiene intima"),
    ("desodorizantes", "desodorizante"),
    ("depilacao", "depila"),
    ("cuidado_pele", "corpo|rosto|pele|creme|solar|banho|duche"),
    ("fraldas", "fralda"),
    ("leite_po_boioes", r"leite.*bebe|leite.*infantil|papa\b|boiao"),
    ("toalhitas", "toalhita"),
    ("cuidado_bebe", "bebe|infantil"),
    ("detergente_roupa", "detergente.*roupa|roupa.*detergente|lavandaria"),
    ("loica", "loica"),
    ("papel_higienico_absorventes", "papel higienico|absorvente|toalhas.*papel"),
    ("sacos_lixo", "sacos.*lixo"),
    ("limpeza_casa", "limpeza|cuidados do lar"),
    ("racao_cao", rf"racao.*({_CAO})|comida.*({_CAO})|\b({_CAO})\b"),
    ("racao_gato", rf"racao.*({_GATO})|comida.*({_GATO})|\b({_GATO})\b"),
    ("areia_gatos", "areia.*gato"),
    ("acessorios_petiscos", "animais|animal"),
)
#: Breadcrumb rules of the first store, in order.
BREADCRUMB_1 = (
    ("leite", word_form("leite")),
    ("iogurtes", "iogurte"),
    ("queijos", "queijo"),
    ("manteiga_natas", "manteiga|natas|bechamel"),
    ("ovos", r"\bovos?\b"),
    ("sobremesas_lacteas", "gelatina|mousse|pudim"),
    ("bebidas_iogurtes_vegetais", f"bebida.*({_VEGETAL})|vegegurte"),
    ("molhos_temperos", r"\bcaldo\b"),
    ("carne_vaca", "vaca|bovino|novilho|vitela|cabrito|borrego"),
    ("carne_porco", "porco|suino"),
    ("aves", "frango|aves|peru|pato|coelho"),
    ("marisco", r"marisco|camarao|lulas|polvo|\bchocos?\b"),
    ("charcutaria_enchidos", "charcutaria|fiambre|salame|chourico|presunto|salsicha|linguica|pronto a cozinhar"),
    ("peixe_fresco", "peixaria|peixe|bacalhau|salmao"),
    ("chocolates_doces", "chocolate"),
    ("refrigerantes_sumos", r"\bsumo\b|nectar"),
    ("frutos_secos", "frutos secos|desidratad"),
    ("ervas_aromaticas", "ervas aromaticas|especiarias"),
    ("saladas_prontas", "salada.*pronta|4a gama"),
    ("fruta", word_form("fruta")),
    ("legumes", "legum|hortalic"),
    ("bolachas_cereais", "bolacha|biscoito|cereal|barra"),
    ("massas_arroz", "massa|arroz|leguminosa|farinha|couscous|quinoa|bulgur|noodles|pure"),
    ("conservas", "conserva"),
    ("azeite_oleos", "azeite|oleo aliment|vinagre"),
    ("molhos_temperos", r"molho|tempero|especiaria|sal\b|maionese|ketchup|mostarda|sopa"),
    ("snacks_aperitivos", "snack|aperitivo|batata frita|pipoca"),
    ("chocolates_doces", "chocolate|rebucado|goma|bombom"),
    ("compotas_mel", r"compota|doce|mel\b|marmelada|acucar|adocante"),
    ("croissants_folhados", "croissant|folhado"),
    ("torradas_tostas", "torrada|tosta|gressino"),
    ("bolos_pastelaria", "bolo|pastelaria|pasteis|napolitana|queque"),
    ("pao", rf"\b({_PAO})\b|padaria|wrap|tortilha"),
    ("gelados", "gelado"),
    ("vegetais_congelados", "congelad.*legum|legum.*congelad|congelad.*vegetal|congelad.*fruta|fruta.*congelad"),
    ("peixe_marisco_congelado", "congelad.*peixe|congelad.*marisco|peixe.*congelad|douradinho"),
    ("carne_congelada", "congelad.*carne|carne.*congelad|hamburguer|almondega|nugget|crocante"),
    ("massa_pizza_congelada", "congelad.*massa|congelad.*pizza|pizza.*congelad|gnocchi"),
    ("pratos_prontos_congelados", "prato.*pronto|refeicao.*pronta|salteado"),
    ("cerveja", "cerveja|sidra"),
    ("vinho", "vinho|champanhe|espumante"),
    ("bebidas_espirituosas", r"espirituos|licor|whisky|vodka|gin\b|rum\b"),
    ("agua", word_form("agua")),
    ("refrigerantes_sumos", "sumo|refrigerante|nectar|isotonica|energetica"),
    ("cafe_cha", r"cafe|cha\b|infus"),
    ("cuidado_cabelo", "cabelo|champo|shampoo"),
    ("higiene_oral", "higiene oral|dentifrico|escova.*dente"),
    ("higiene_intima", "higiene intima"),
    ("desodorizantes", "desodorizante"),
    ("depilacao", "depila"),
    ("cuidado_pele", "corpo|rosto|pele|creme|solar|banho|duche|sabonete|homem"),
    ("fraldas", "fralda"),
    ("leite_po_boioes", r"leite.*bebe|leite.*infantil|papa\b|boiao|alimentacao infantil"),
    ("toalhitas", "toalhita"),
    ("cuidado_bebe", "bebe|infantil"),
    ("detergente_roupa", "detergente.*roupa|roupa.*detergente|lavandaria"),
    ("loica", "loica"),
    ("papel_higienico_absorventes", "papel higienico|absorvente|toalhas.*papel|guardanapo"),
    ("sacos_lixo", "sacos.*lixo"),
    ("limpeza_casa", "limpeza|cuidados do lar|cozinha|casa de banho|chao|superficie|ambientador|inseticida"),
    ("racao_cao", rf"racao.*({_CAO})|comida.*({_CAO})|\b({_CAO})\b"),
    ("racao_gato", rf"racao.*({_GATO})|comida.*({_GATO})|\b({_GATO})\b"),
    ("areia_gatos", "areia.*gato"),
    ("acessorios_petiscos", "animais|animal"),
)
#: Name rules of the fifth store, in order.
NAME_5 = (
    ("leite", word_form("leite")),
    ("iogurtes", "iogurte"),
    ("queijos", "queijo"),
    ("manteiga_natas", "manteiga|natas"),
    ("ovos", r"\bovos?\b"),
    ("sobremesas_lacteas", "sobremesa.*lacte|lacte.*sobremesa|pudim|mousse"),
    ("bebidas_iogurtes_vegetais", f"bebida.*({_VEGETAL})|vegegurte"),
    ("molhos_temperos", r"\bcaldo\b"),
    ("carne_vaca", "vaca|bovino|novilho|vitela"),
    ("carne_porco", "porco|suino|cachaco|leitao"),
    ("aves", "frango|aves|peru|pato|coelho"),
    ("marisco", r"marisco|camarao|lulas|polvo|\bchocos?\b"),
    ("charcutaria_enchidos", "charcutaria|fiambre|salame|chourico|presunto|salsicha|linguica"),
    ("peixe_fresco", "peixaria|peixe|bacalhau|salmao|atum"),
    ("frutos_secos", "frutos secos|desidratad"),
    ("ervas_aromaticas", "ervas aromaticas|especiarias"),
    ("saladas_prontas", "salada.*pronta|4a gama"),
    ("fruta", word_form("fruta")),
    ("legumes", "legum|hortalic"),
    ("bolachas_cereais", "bolacha|biscoito|cereal|barra"),
    ("pratos_prontos_congelados", r"lasanha|nhoque|gnocchi|\bpara\s+(airfryer|forno|micro-?ondas)\b"),
    ("massas_arroz", "massa|esparguete|arroz|leguminosa|farinha"),
    ("conservas", "conserva|pickles"),
    ("azeite_oleos", "azeite|oleo aliment"),
    ("molhos_temperos", r"molho|tempero|especiaria|sal\b|maionese|ketchup|mostarda"),
    ("snacks_aperitivos", "snack|aperitivo|batata frita|tortilhas"),
    ("chocolates_doces", "chocolate|rebucado|goma|bombons?"),
    ("compotas_mel", r"compota|doce extra|mel\b|marmelada"),
    ("croissants_folhados", "croissant|folhado"),
    ("torradas_tostas", "torrada|tosta"),
    ("bolos_pastelaria", "bolo|pastelaria|pasteis"),
    ("pao", rf"\b({_PAO})\b|padaria"),
    ("gelados", "gelado"),
    ("vegetais_congelados", "congelad.*legum|legum.*congelad|congelad.*vegetal"),
    ("peixe_marisco_congelado", "congelad.*peixe|congelad.*marisco|peixe.*congelad"),
    ("carne_congelada", "congelad.*carne|carne.*congelad"),
    ("massa_pizza_congelada", "congelad.*massa|congelad.*pizza|pizza.*congelad"),
    ("pratos_prontos_congelados", "prato.*pronto|refeicao.*pronta"),
    ("cerveja", "cerveja|sidra"),
    ("vinho", "vinho|champanhe|espumante"),
    ("bebidas_espirituosas", r"espirituos|licor|whisky|vodka|gin\b|rum\b"),
    ("agua", word_form("agua")),
    ("refrigerantes_sumos", "sumo|refrigerante|nectar|energetic"),
    ("cafe_cha", r"cafe|cha\b|infus"),
    ("cuidado_cabelo", "cabelo|champo|shampoo"),
    ("higiene_oral", "higiene oral|dentifrico|escova.*dente"),
    ("higiene_intima", "higiene intima"),
    ("desodorizantes", "desodorizante"),
    ("depilacao", "depila"),
    ("cuidado_pele", "corpo|rosto|pele|creme|solar|banho|duche|sabonete"),
    ("fraldas", "fralda"),
    ("leite_po_boioes", r"leite.*bebe|leite.*infantil|papa\b|boiao"),
    ("toalhitas", "toalhita"),
    ("cuidado_bebe", "bebe|infantil"),
    ("detergente_roupa", "detergente.*roupa|roupa.*detergente|lavandaria"),
    ("loica", "loica"),
    ("papel_higienico_absorventes", "papel higienico|absorvente|toalhas.*papel"),
    ("sacos_lixo", "sacos.*lixo"),
    ("limpeza_casa", "limpeza|cuidados do lar"),
    ("racao_cao", rf"racao.*({_CAO})|comida.*({_CAO})|\b({_CAO})\b"),
    ("racao_gato", rf"racao.*({_GATO})|comida.*({_GATO})|\b({_GATO})\b"),
    ("areia_gatos", "areia.*gato"),
    ("acessorios_petiscos", "animais|animal"),
)
#: Breadcrumb rules of the third store, in order.
BREADCRUMB_3 = (
    ("agua", "bebidas/agua"),
    ("refrigerantes_sumos", "sucos de fruta|refrigerantes"),
    ("cafe_cha", r"cafe|cha\b"),
    ("charcutaria_enchidos", "churrasco e charcutaria"),
    ("carne_vaca", "carne de vaca"),
    ("carne_porco", "carne de porco"),
    ("aves", r"\baves\b"),
    ("peixe_fresco", "peixe e marisco(?! congelados)"),
    ("fruta", "frutas e legumes/fruta$"),
    ("legumes", "frutas e legumes/legumes"),
    ("frutos_secos", "frutos secos e nozes"),
    ("saladas_prontas", "saladas, fruta e antepastos"),
    ("bolos_pastelaria", "padaria/pastelaria"),
    ("pao", "alimentos e quase alimentos/padaria"),
    ("torradas_tostas", "torradas e produtos de panificacao"),
    ("peixe_marisco_congelado", "peixe e marisco congelados"),
    ("gelados", "alimentos congelados.*gelado"),
    ("vegetais_congelados", "frutas e legumes congelados"),
    ("massa_pizza_congelada", "pizzas e petiscos congelados"),
    ("carne_congelada", "alimentos congelados.*carne"),
    ("pratos_prontos_congelados", "refeicoes prontas refrigeradas|refeicoes prontas congeladas"),
    ("iogurtes", "iogurte"),
    ("ovos", r"\bovos\b"),
    ("queijos", r"\bqueijo\b"),
    ("manteiga_natas", "manteiga"),
    ("leite", "leite e natas"),
    ("sobremesas_lacteas", "queijos, laticinios e ovos/sobremesas"),
    ("massas_arroz", "arroz, massa e leguminosas"),
    ("conservas", "conservas"),
    ("azeite_oleos", "oleos e gorduras|gorduras, oleos, vinagre"),
    ("molhos_temperos", "molhos e condimentos"),
    ("snacks_aperitivos", "petiscos salgados"),
    ("chocolates_doces", "produtos de chocolate"),
    ("bolachas_cereais", "bolachas e doces"),
    ("massas_arroz", "ingredientes para panificacao"),
    ("cuidado_pele", "cuidados com o corpo e o rosto"),
    ("higiene_oral", "higiene oral"),
    ("cuidado_cabelo", "cuidados com o cabelo"),
    ("higiene_intima", "higiene intima"),
    ("desodorizantes", "desodoriza"),
    ("depilacao", "depila"),
    ("leite_po_boioes", "alimentos para bebes e leite em po"),
    ("fraldas", "fraldas"),
    ("toalhitas", "toalhitas"),
    ("cuidado_bebe", "bebes e criancas"),
    ("detergente_roupa", "detergentes e cuidados com a roupa"),
    ("limpeza_casa", "produtos de limpeza"),
    ("papel_higienico_absorventes", "papel higienico"),
    ("sacos_lixo", "sacos (de )?lixo"),
    ("loica", "loica"),
    ("racao_cao", r"racao.*cao|comida.*cao\b"),
    ("racao_gato", "racao.*gato|comida.*gato"),
    ("areia_gatos", "areia.*gato"),
    ("acessorios_petiscos", "animais"),
)
#: The mixed drinks parent of the third store, decided by its leaf.
DRINKS_PARENT = "vinho, cerveja e bebidas espirituosas"
DRINKS_LEAF = (
    ("vinho", "champanhe|espumante"),
    ("cerveja", "cerveja"),
    ("bebidas_espirituosas", "espirituosas"),
    ("vinho", "vinho"),
)
#: Beverage name rules, in order.
BEVERAGES = (
    ("cerveja", "cerveja|sidra"),
    (
        "vinho",
        r"vinho|champanhe|espumante|moscatel|lambrusco|frisante|colheita tardia|\btinto\b|\bbranco\b|\brose\b"
        r"|chardonnay|alentejo|douro|bairrada|vinha da madeira|caixa madeira [0-9]+ garraf",
    ),
    (
        "bebidas_espirituosas",
        r"licor|whisky|vodka|\bgin\b|\brum\b|tequila|aguardente|brandy|conhaque|cachaca|absinto|cocktail"
        r"|bebida espirituosa|jeropiga|bagaceira|grappa|calvados|mezcal|pisco|ginja",
    ),
    ("agua", word_form("agua")),
    (
        "refrigerantes_sumos",
        r"sumo|refrigerante|nectar|isotonica|energetica|ice tea|smoothie|dose fruta|kombucha|gasosa|limonada|\bsoda\b"
        r"|mocktail",
    ),
    ("cafe_cha", r"\bcafe\b|\bcha\b|infus|tisana"),
)
#: First URL segment of the fourth store -> subcategory.
URL_FIRST = {
    "aguas-sumos-e-refrigerantes": "refrigerantes_sumos",
    "vinhos": "vinho",
    "espirituosas": "bebidas_espirituosas",
    "cervejas-e-sidras": "cerveja",
    "padaria-e-pastelaria": "pao",
    "peixaria": "peixe_fresco",
    "leite-e-bebidas-vegetais": "leite",
    "manteiga-margarina-e-natas": "manteiga_natas",
    "ovos": "ovos",
    "iogurtes-e-sobremesas": "iogurtes",
    "bolachas-cereais-e-guloseimas": "bolachas_cereais",
    "cafe-cha-e-achocolatados": "cafe_cha",
}
#: First and second segment -> subcategory; "default" holds for other second segments.
URL_SECOND = {
    "mercearia": {
        "temperos-e-molhos": "molhos_temperos",
        "conservas": "conservas",
        "arroz-massa-e-leguminosas": "massas_arroz",
        "farinha-fermento-e-acucar": "massas_arroz",
        "azeite-oleo-e-vinagre": "azeite_oleos",
        "sopas-e-refeicoes-pre-preparadas": "molhos_temperos",
        "batatas-fritas-snacks-e-frutos-secos": "snacks_aperitivos",
        "sobremesas": "compotas_mel",
        "compotas-mel-e-cremes-de-barrar": "compotas_mel",
        "pao-e-bolos-embalados": "pao",
    },
    "charcutaria-e-queijos": {"queijos": "queijos"},
    "talho": {"default": "carne_vaca"},
    "frutas-e-vegetais": {"fruta": "fruta", "fruta1": "fruta", "legumes": "legumes", "default": "legumes"},
    "congelados": {"default": "pratos_prontos_congelados"},
    "higiene-pessoal-e-beleza": {
        "cabelo": "cuidado_cabelo",
        "corpo": "cuidado_pele",
        "rosto": "cuidado_pele",
        "higiene-oral": "higiene_oral",
        "higiene-intima": "higiene_intima",
        "cuidados-solares": "cuidado_pele",
    },
    "bebe-e-crianca": {
        "fraldas-e-toalhitas": "fraldas",
        "alimentacao": "leite_po_boioes",
        "banho-e-higiene": "cuidado_bebe",
        "chupetas-e-acessorios": "cuidado_bebe",
    },
    "limpeza": {
        "roupa": "detergente_roupa",
        "casa": "limpeza_casa",
        "wc": "limpeza_casa",
        "loica": "loica",
        "sacos-do-lixo": "sacos_lixo",
    },
    "animais": {"gato": "racao_gato", "cao": "racao_cao", "outros-animais": "acessorios_petiscos"},
}
#: URL rules of the seed list, in order; case matters.
URL_RULES = (
    ("cafe_cha", "/cafe-cha-e-bebidas-soluveis/"),
    ("cuidado_bebe", "/alimentacao-infantil/"),
    ("massas_arroz", "/arroz-massa-e-farinha/"),
    ("conservas", "/conservas/"),
    ("azeite_oleos", "/azeite-oleo-e-vinagre/"),
    ("molhos_temperos", "/molhos-temperos-e-sal/"),
    ("molhos_temperos", "/sopas-e-refeicoes/"),
    ("massas_arroz", "/cabazes/"),
    ("compotas_mel", "/acucar-e-sobremesas/"),
    ("snacks_aperitivos", "/batatas-fritas-e-aperitivos/"),
    ("bolachas_cereais", "/bolachas-biscoitos-e-tostas/"),
    ("bolachas_cereais", "/cereais-e-barras/"),
    ("chocolates_doces", "/chocolate-gomas-e-rebucados/"),
    ("compotas_mel", "/compotas-cremes-e-mel/"),
    ("leite", "/(laticinios-e-ovos|frescos)/leite/"),
    ("iogurtes", "/iogurtes-e-outros-lacteos/"),
    ("queijos", "/queijos/"),
    ("manteiga_natas", "/manteigas-e-cremes-para-barrar/"),
    ("manteiga_natas", "/natas-e-bechamel/"),
    ("ovos", "/laticinios-e-ovos/ovos/"),
    ("sobremesas_lacteas", "/gelatina-mousse-e-pudins/"),
    ("bebidas_iogurtes_vegetais", "/bebidas-vegetais-e-vegegurtes/"),
    ("bebidas_iogurtes_vegetais", "/laticinios-e-alternativas-vegetais/"),
    ("aves", "/talho/frango-e-peru/"),
    ("aves", "/talho/pato-e-coelho/"),
    ("carne_porco", "/talho/porco/"),
    ("carne_vaca", "/talho/(novilho-vitela-e-vitelao|cabrito-e-borrego)/"),
    ("charcutaria_enchidos", "/talho/pronto-a-cozinhar/"),
    ("marisco", "/peixaria/marisco/"),
    ("marisco", "/peixaria/polvo-lulas-e-chocos/"),
    ("peixe_fresco", "/peixaria/"),
    ("frutos_secos", "/frescos/frutas/frutos-secos-desidratados-e-sementes/"),
    ("fruta", "/frescos/frutas/"),
    ("legumes", "/frescos/legumes/"),
    (
        "pao",
        "/padaria-e-pastelaria/(pao-de-forma-e-embalado|pao-do-dia-e-broa|pao-de-hamburguer-e-cachorro"
        "|wraps-e-tortilhas)/",
    ),
    (
        "bolos_pastelaria",
        "/padaria-e-pastelaria/(bolos-e-sobremesas|pastelaria-sortida|bolas-de-berlim|massas-para-culinaria)/",
    ),
    ("torradas_tostas", "/padaria-e-pastelaria/(biscoitos|tostas-e-gressinos)/"),
    ("croissants_folhados", "/padaria-e-pastelaria/croissants-e-paes-de-leite/"),
    ("gelados", "/congelados/gelados"),
    ("gelados", "/congelados/sobremesas/"),
    ("vegetais_congelados", "/congelados/frutas-e-legumes/"),
    ("vegetais_congelados", "/congelados/batata-frita-e-pure/"),
    ("peixe_marisco_congelado", "/congelados/douradinhos-e-filetes/"),
    (
        "carne_congelada",
        "/congelados/(crocantes-e-hamburgueres|hamburgueres-e-almondegas|nuggets-e-crocantes|vegetariano-e-vegan)/",
    ),
    ("massa_pizza_congelada", "/congelados/(pizzas|salgados-folhados-e-pastelaria)/"),
    ("pratos_prontos_congelados", "/congelados/(refeicoes-prontas|refeicoes-congeladas|congelados-para-air-fryer)"),
    ("agua", "/bebidas-e-garrafeira/agua/"),
    ("refrigerantes_sumos", "/bebidas-e-garrafeira/(sumos-e-refrigerantes|bebidas-energeticas-e-isotonicas)/"),
    ("vinho", "/bebidas-e-garrafeira/(vinhos|champanhe-e-espumante|garrafeira|gama-cave)"),
    ("cerveja", "/bebidas-e-garrafeira/cervejas-e-sidras/"),
    ("bebidas_espirituosas", r"/bebidas-e-garrafeira/(bebidas-espirituosas|0\.0--alcool)/"),
    ("cuidado_cabelo", "/beleza-e-higiene/cabelo/"),
    ("desodorizantes", "/beleza-e-higiene/corpo/desodorizantes/"),
    ("depilacao", "/beleza-e-higiene/corpo/depilacao-e-descoloracao/"),
    ("cuidado_pele", "/beleza-e-higiene/corpo/"),
    ("cuidado_pele", "/beleza-e-higiene/rosto/"),
    ("higiene_oral", "/beleza-e-higiene/higiene-oral/"),
    ("higiene_intima", "/beleza-e-higiene/higiene-intima/"),
    ("desodorizantes", "/beleza-e-higiene/homem/desodorizantes/"),
    ("depilacao", "/beleza-e-higiene/homem/depilatorios/"),
    ("cuidado_pele", "/beleza-e-higiene/homem/"),
    ("cuidado_pele", "/beleza-e-higiene/solares-e-bronzeadores/"),
    ("detergente_roupa", "/limpeza/roupa/"),
    ("loica", "/limpeza/cozinha/(detergente-manual-loica|detergente-maquina-loica|aditivos-maquina-loica)/"),
    ("limpeza_casa", "/limpeza/cozinha/"),
    ("papel_higienico_absorventes", "/limpeza/papel-higienico/"),
    ("papel_higienico_absorventes", "/limpeza/guardanapos-e-rolos/"),
    ("sacos_lixo", "/limpeza/sacos-e-baldes-do-lixo/"),
    (
        "limpeza_casa",
        "/limpeza/(casa-de-banho|chao-e-superficies|velas-e-ambientadores|mopas-esfregonas-e-vassouras"
        "|panos-esfregoes-e-luvas|inseticidas-e-desumidificadores)/",
    ),
    ("racao_gato", "/animais/gato/(racao-seca|comida-humida)/"),
    ("areia_gatos", "/animais/gato/(areias-e-absorventes|caixas-de-areia-e-acessorios)/"),
    ("acessorios_petiscos", "/animais/gato/"),
    ("racao_cao", "/animais/cao/(racao-seca|comida-humida)/"),
    ("acessorios_petiscos", "/animais/cao/"),
    ("acessorios_petiscos", "/animais/(outros-animais|cuidado-de-excelencia)/"),
    ("toalhitas", "/bebe/fraldas-e-toalhitas/toalhitas/"),
    ("fraldas", "/bebe/fraldas-e-toalhitas/"),
    ("cuidado_bebe", "/bebe/banho-e-higiene/"),
)


def category_of(subcategory: Column) -> Column:
    pairs = F.create_map(*[F.lit(x) for pair in CATEGORY.items() for x in pair])
    return pairs[subcategory]


def ascii_boundaries(pattern: str) -> str:
    """Word boundaries that know ASCII words only; the JVM's count other letters too."""
    return re.sub(r"\\b(?=[a-z(])", "(?<![A-Za-z0-9_])", pattern).replace(r"\b", "(?![A-Za-z0-9_])")


def first_rule(c: Column, rules, ignore_case: bool = True) -> Column:
    """Subcategory of the first rule whose pattern ``c`` contains."""
    out = None
    for subcategory, pattern in rules:
        pattern = ascii_boundaries(pattern)
        test = c.rlike(f"(?i){pattern}" if ignore_case else pattern)
        out = F.when(test, subcategory) if out is None else out.when(test, subcategory)
    return out


def _classified(subcategory: Column) -> Column:
    return F.struct(category_of(subcategory).alias("category"), subcategory.alias("subcategory"))


def classify_breadcrumb(crumbs: Column, store: int) -> Column:
    """struct<category, subcategory> of the " / "-joined (stores 1, 2) or "/"-joined (store 3) breadcrumb."""
    text = strip_accents(crumbs)
    if store != 3:
        return _classified(first_rule(text, BREADCRUMB_1 if store == 1 else BREADCRUMB_2))
    parts = F.transform(F.split(text, "/"), F.trim)
    leaf = first_rule(F.coalesce(F.get(parts, 2), F.lit("")), DRINKS_LEAF)
    mixed = F.coalesce(F.lower(F.get(parts, 1)) == DRINKS_PARENT, F.lit(False))
    return _classified(F.when(mixed, leaf).otherwise(first_rule(text, BREADCRUMB_3)))


def classify_name(name: Column) -> Column:
    return _classified(first_rule(strip_accents(F.lower(name)), NAME_5))


def classify_beverage(name: Column) -> Column:
    return first_rule(strip_accents(F.lower(name)), BEVERAGES)


def classify_url_path(url: Column) -> Column:
    """By the first two segments behind /home/produtos/; a null entry means excluded."""
    first = F.regexp_extract(url, "/home/produtos/([^/]+)/", 1)
    second = F.regexp_extract(url, "/home/produtos/[^/]+/([^/]+)", 1)
    flat = {f"{a}/{b}": sub for a, table in URL_SECOND.items() for b, sub in table.items()}
    pairs = F.create_map(*[F.lit(x) for pair in flat.items() for x in pair])
    top = F.create_map(*[F.lit(x) for pair in URL_FIRST.items() for x in pair])
    deep = F.coalesce(pairs[F.concat(first, F.lit("/"), second)], pairs[F.concat(first, F.lit("/default"))])
    return _classified(F.when(first.isin(*URL_SECOND), deep).otherwise(top[first]))


def classify_seed_url(url: Column, default_category: Column) -> Column:
    """URL rules; the first two name their own category, all others keep the default one."""
    sub = first_rule(url, URL_RULES, ignore_case=False)
    own = sub.isin("cafe_cha") | url.rlike("/alimentacao-infantil/")
    category = F.when(own, category_of(sub)).otherwise(default_category)
    return F.struct(category.alias("category"), sub.alias("subcategory"))


def provenance(subcategory: Column, by_name: Column) -> Column:
    return F.when(subcategory.isNotNull(), F.when(by_name, "nome").otherwise("breadcrumb"))


def classify_distinct(df: DataFrame, column: str, classify) -> DataFrame:
    """``df`` with category and subcategory; rules run once for each distinct value of ``column``."""
    known = df.select(column).distinct().withColumn("_class", classify(F.col(column)))
    known = known.select(F.col(column).alias("_value"), "_class.*")
    plain = df.drop("category", "subcategory")
    return plain.join(known, F.col(column).eqNullSafe(F.col("_value")), "left").drop("_value")
