"""Breadcrumbs and names with the class that the rules are to give, written by hand.

"Congelados" holds "gelado", whose rule comes first: such breadcrumbs are ices, as the rules have it.
"""

import pytest
from pyspark.sql import functions as F

from trolley.functions.classify import CATEGORY, classify_breadcrumb, classify_name

FIRST = """
Laticínios e Ovos / Leite = leite
Frescos / Iogurtes = iogurtes
Laticínios / Queijo Flamengo = queijos
Laticínios / Manteiga e Margarinas = manteiga_natas
Mercearia / Béchamel = manteiga_natas
Frescos / Ovos = ovos
Sobremesas / Gelatina = sobremesas_lacteas
Sobremesas / Pudins e Pudim Flan = sobremesas_lacteas
Bebidas Vegetais / Aveia = bebidas_iogurtes_vegetais
Mercearia / Caldo = molhos_temperos
Talho / Vitela = carne_vaca
Talho / Borrego = carne_vaca
Talho / Suíno = carne_porco
Talho / Frango = aves
Talho / Coelho = aves
Peixaria / Camarão = marisco
Peixaria / Chocos = marisco
Charcutaria / Fiambre = charcutaria_enchidos
Charcutaria / Chouriço = charcutaria_enchidos
Peixaria / Bacalhau = peixe_fresco
Doces / Chocolates = chocolates_doces
Bebidas / Sumo de Laranja = refrigerantes_sumos
Bebidas / Néctar = refrigerantes_sumos
Mercearia / Frutos Secos = frutos_secos
Mercearia / Desidratados = frutos_secos
Mercearia / Ervas Aromáticas = ervas_aromaticas
Frescos / Salada Pronta = saladas_prontas
Frescos / Frutas = fruta
Frescos / Hortaliças = legumes
Mercearia / Bolachas = bolachas_cereais
Mercearia / Cereais e Barras = bolachas_cereais
Mercearia / Arroz = massas_arroz
Mercearia / Couscous = massas_arroz
Mercearia / Conservas = conservas
Mercearia / Azeite = azeite_oleos
Mercearia / Vinagre = azeite_oleos
Mercearia / Maionese = molhos_temperos
Mercearia / Sal = molhos_temperos
Mercearia / Pipocas = snacks_aperitivos
Mercearia / Rebuçados = chocolates_doces
Mercearia / Mel = compotas_mel
Mercearia / Açúcar = compotas_mel
Padaria / Croissants = croissants_folhados
Padaria / Tostas = torradas_tostas
Padaria / Queques = bolos_pastelaria
Padaria / Pães = pao
Padaria / Wraps = pao
Congelados / Gelados = gelados
Congelados / Pizza = gelados
Frio / Douradinhos = peixe_marisco_congelado
Frio / Nuggets = carne_congelada
Frio / Gnocchi = massa_pizza_congelada
Frio / Salteados = pratos_prontos_congelados
Garrafeira / Cerveja = cerveja
Garrafeira / Sidra = cerveja
Garrafeira / Vinho Tinto = vinho
Garrafeira / Champanhe = vinho
Garrafeira / Gin = bebidas_espirituosas
Garrafeira / Rum = bebidas_espirituosas
Bebidas / Águas = agua
Bebidas / Refrigerantes = refrigerantes_sumos
Bebidas / Café = cafe_cha
Bebidas / Chá = cafe_cha
Beleza / Champô = cuidado_cabelo
Beleza / Higiene Oral = higiene_oral
Beleza / Higiene Íntima = higiene_intima
Beleza / Desodorizantes = desodorizantes
Beleza / Depilação = depilacao
Beleza / Protetor Solar = cuidado_pele
Bebé / Fraldas = fraldas
Bebé / Papa = leite_po_boioes
Bebé / Toalhitas = toalhitas
Bebé / Chupetas = cuidado_bebe
Casa / Detergente para a Roupa = detergente_roupa
Casa / Lavandaria = detergente_roupa
Casa / Loiça = loica
Casa / Papel Higiénico = papel_higienico_absorventes
Casa / Guardanapos = papel_higienico_absorventes
Casa / Sacos do Lixo = sacos_lixo
Casa / Inseticidas = limpeza_casa
Animais / Cães = racao_cao
Animais / Gatos = racao_gato
Animais / Pássaros = acessorios_petiscos
Bricolage / Parafusos = -
Ginástica = -
"""
THIRD = """
Alimentos e quase alimentos/Vinho, cerveja e bebidas espirituosas/Cerveja = cerveja
Alimentos e quase alimentos/Vinho, cerveja e bebidas espirituosas/Vinho = vinho
Alimentos e quase alimentos/Vinho, cerveja e bebidas espirituosas/Champanhe e espumante = vinho
Alimentos e quase alimentos/Vinho, cerveja e bebidas espirituosas/Bebidas espirituosas = bebidas_espirituosas
Alimentos e quase alimentos/Bebidas/Água = agua
Alimentos e quase alimentos/Bebidas/Sucos de fruta = refrigerantes_sumos
Alimentos e quase alimentos/Bebidas/Café = cafe_cha
Alimentos e quase alimentos/Churrasco e charcutaria = charcutaria_enchidos
Alimentos e quase alimentos/Carne/Carne de vaca = carne_vaca
Alimentos e quase alimentos/Carne/Carne de porco = carne_porco
Alimentos e quase alimentos/Carne/Aves = aves
Alimentos e quase alimentos/Peixe e marisco = peixe_fresco
Alimentos e quase alimentos/Frutas e legumes/Fruta = fruta
Alimentos e quase alimentos/Frutas e legumes/Legumes = legumes
Alimentos e quase alimentos/Petiscos/Frutos secos e nozes = frutos_secos
Alimentos e quase alimentos/Saladas, fruta e antepastos = saladas_prontas
Alimentos e quase alimentos/Padaria/Pastelaria = bolos_pastelaria
Alimentos e quase alimentos/Padaria/Pãezinhos e bolinhos = pao
Alimentos e quase alimentos/Alimentos congelados/Peixe e marisco congelados = peixe_marisco_congelado
Alimentos e quase alimentos/Alimentos congelados/Gelado = gelados
Alimentos e quase alimentos/Frio/Frutas e legumes congelados = vegetais_congelados
Alimentos e quase alimentos/Frio/Pizzas e petiscos congelados = massa_pizza_congelada
Alimentos e quase alimentos/Alimentos congelados/Pizzas e petiscos congelados = gelados
Alimentos e quase alimentos/Alimentos congelados/Refeições prontas congeladas = pratos_prontos_congelados
Alimentos e quase alimentos/Queijos, laticínios e ovos/Iogurte = iogurtes
Alimentos e quase alimentos/Queijos/Queijo = queijos
Alimentos e quase alimentos/Laticínios/Manteiga = manteiga_natas
Alimentos e quase alimentos/Laticínios/Leite e natas = leite
Alimentos e quase alimentos/Arroz, massa e leguminosas = massas_arroz
Alimentos e quase alimentos/Conservas = conservas
Alimentos e quase alimentos/Gorduras, óleos, vinagre = azeite_oleos
Alimentos e quase alimentos/Molhos e condimentos = molhos_temperos
Alimentos e quase alimentos/Petiscos salgados = snacks_aperitivos
Alimentos e quase alimentos/Produtos de chocolate = chocolates_doces
Alimentos e quase alimentos/Bolachas e doces = bolachas_cereais
Beleza/Cuidados com o corpo e o rosto = cuidado_pele
Beleza/Higiene oral = higiene_oral
Beleza/Cuidados com o cabelo = cuidado_cabelo
Bebé/Alimentos para bebés e leite em pó = leite_po_boioes
Bebé/Fraldas = fraldas
Casa/Detergentes e cuidados com a roupa = detergente_roupa
Casa/Produtos de limpeza = limpeza_casa
Casa/Sacos de lixo = sacos_lixo
Casa/Loiça = loica
Animais/Ração para cão = racao_cao
Animais/Areia para gato = areia_gatos
Animais/Brinquedos = acessorios_petiscos
Moda/Camisolas = -
"""
FIFTH = """
Leite Meio Gordo = leite
Iogurte Grego Natural = iogurtes
Queijo Flamengo Fatias = queijos
Natas para Culinária = manteiga_natas
Ovos Classe M = ovos
Pudim de Ovo = ovos
Mousse de Manga = sobremesas_lacteas
Caldo de Galinha = molhos_temperos
Hambúrguer de Novilho = carne_vaca
Costeletas do Cachaço = carne_porco
Rissol de Leitão = carne_porco
Peito de Peru = aves
Miolo de Camarão = marisco
Salsichas Frankfurt = charcutaria_enchidos
Atum em Azeite = peixe_fresco
Salmão Fumado = peixe_fresco
Mistura de Frutos Secos = frutos_secos
Salada Ibérica Pronta = saladas_prontas
Fruta Cortada = fruta
Legumes para Sopa = legumes
Bolachas Maria = bolachas_cereais
Lasanha Bolonhesa = pratos_prontos_congelados
Batata para Airfryer = pratos_prontos_congelados
Esparguete = massas_arroz
Pickles de Pepino = conservas
Azeite Virgem Extra = azeite_oleos
Ketchup = molhos_temperos
Tortilhas de Milho = snacks_aperitivos
Bombons Sortidos = chocolates_doces
Mel de Rosmaninho = compotas_mel
Croissant Simples = croissants_folhados
Tostas Integrais = torradas_tostas
Pastéis de Nata = bolos_pastelaria
Pão de Forma = pao
Gelado de Baunilha = gelados
Cerveja Preta = cerveja
Vinho Branco = vinho
Vodka = bebidas_espirituosas
Água com Gás = agua
Refrigerante de Cola = refrigerantes_sumos
Café Moído = cafe_cha
Champô Anticaspa = cuidado_cabelo
Escova de Dentes = higiene_oral
Desodorizante Roll-on = desodorizantes
Creme de Mãos = cuidado_pele
Fraldas Tamanho 4 = fraldas
Toalhitas Húmidas = toalhitas
Detergente Líquido para Roupa = detergente_roupa
Pastilhas para Loiça = loica
Papel Higiénico 12 Rolos = papel_higienico_absorventes
Sacos para Lixo 30L = sacos_lixo
Comida Húmida para Cão = racao_cao
Ração Seca para Gato = racao_gato
Cabide de Madeira = -
"""


def rows(text):
    return [tuple(x.strip() for x in line.rpartition(" = ")[::2]) for line in text.strip().splitlines()]


@pytest.mark.parametrize(("text", "classify"), [(FIRST, lambda c: classify_breadcrumb(c, 1)), (THIRD, lambda c: classify_breadcrumb(c, 3)), (FIFTH, classify_name)])
def test_hand_written_inputs_have_their_class(spark, text, classify):
    given = rows(text)
    got = {r["c"]: (r["category"], r["subcategory"]) for r in spark.createDataFrame(given, "c string, want string").select("c", classify(F.col("c")).alias("k")).select("c", "k.*").collect()}
    wrong = {c: (got[c][1], want) for c, want in given if (got[c][1] or "-") != want}
    assert not wrong
    assert all(got[c][0] == CATEGORY[want] for c, want in given if want != "-")
