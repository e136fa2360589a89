"""Fixed dimensions the store marts need.

All values below are fixed values: they must equal the source application's
values for the marts to come out the same. They are small (at most 73 rows)
and never grow with the data, so broadcasting them or inlining them as
literals is bounded by construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Order status labels, in code order 1..8 (anything else -> 0).
ORDER_STATUS_LABELS = (
    "delivered", "shipped", "canceled", "unavailable",
    "invoiced", "processing", "created", "approved",
)

# ---------------------------------------------------------------------------
# Principal category groups, in the order the groups are tested
# (first match wins), with each group's category names in source order.
CATEGORY_GROUPS = {
    "beauty": ["perfumaria", "beleza_saude", "fraldas_higiene"],
    "electronics": [
        "pcs", "informatica_acessorios", "consoles_games", "tablets_impressao_imagem",
        "pc_gamer", "eletronicos", "telefonia", "telefonia_fixa", "eletrodomesticos_2",
        "dvds_blu_ray", "portateis_cozinha_e_preparadores_de_alimentos",
        "portateis_casa_forno_e_cafe", "audio", "cine_foto", "eletroportateis",
    ],
    "cars": ["automotivo"],
    "construction": [
        "climatizacao", "construcao_ferramentas_seguranca", "casa_construcao",
        "construcao_ferramentas_construcao", "construcao_ferramentas_ferramentas",
        "sinalizacao_e_seguranca", "construcao_ferramentas_iluminacao",
        "construcao_ferramentas_jardim",
    ],
    "entertainment": [
        "artes", "instrumentos_musicais", "artes_e_artesanato", "livros_interesse_geral",
        "musica", "livros_importados", "cds_dvds_musicais", "livros_tecnicos",
    ],
    "fashion": [
        "fashion_calcados", "fashion_bolsas_e_acessorios", "fashion_underwear_e_moda_praia",
        "fashion_roupa_masculina", "fashion_roupa_feminina", "malas_acessorios",
        "relogios_presentes", "fashion_roupa_infanto_juvenil",
    ],
    "food": ["bebidas", "alimentos_bebidas", "alimentos"],
    "home": [
        "utilidades_domesticas", "moveis_decoracao", "eletrodomesticos", "ferramentas_jardim",
        "moveis_escritorio", "cama_mesa_banho", "moveis_quarto",
        "moveis_cozinha_area_de_servico_jantar_e_jardim", "moveis_sala", "la_cuisine",
        "casa_conforto", "moveis_colchao_e_estofado", "flores", "casa_conforto_2",
        "papelaria", "artigos_de_festas", "pet_shop", "artigos_de_natal", "cool_stuff",
    ],
    "kids": ["bebes", "brinquedos"],
    "services": [
        "agro_industria_e_comercio", "seguros_e_servicos",
        "industria_comercio_e_negocios", "market_place",
    ],
    "sports": ["esporte_lazer", "fashion_esporte"],
}

# ---------------------------------------------------------------------------
# Portuguese stop words, the public list that Spark ML ships, in
# its order.
STOPWORDS_PT = tuple("""
de a o que e do da em um para com não uma os no se na por mais as dos como mas ao ele das à seu
sua ou quando muito nos já eu também só pelo pela até isso ela entre depois sem mesmo aos seus
quem nas me esse eles você essa num nem suas meu às minha numa pelos elas qual nós lhe deles
essas esses pelas este dele tu te vocês vos lhes meus minhas teu tua teus tuas nosso nossa
nossos nossas dela delas esta estes estas aquele aquela aqueles aquelas isto aquilo estou está
estamos estão estive esteve estivemos estiveram estava estávamos estavam estivera estivéramos
esteja estejamos estejam estivesse estivéssemos estivessem estiver estivermos estiverem hei há
havemos hão houve houvemos houveram houvera houvéramos haja hajamos hajam houvesse houvéssemos
houvessem houver houvermos houverem houverei houverá houveremos houverão houveria houveríamos
houveriam sou somos são era éramos eram fui foi fomos foram fora fôramos seja sejamos sejam
fosse fôssemos fossem for formos forem serei será seremos serão seria seríamos seriam tenho tem
temos tém tinha tínhamos tinham tive teve tivemos tiveram tivera tivéramos tenha tenhamos tenham
tivesse tivéssemos tivessem tiver tivermos tiverem terei terá teremos terão teria teríamos
teriam
""".split())

# ---------------------------------------------------------------------------
# Codes of the country's 27 states (ISO 3166-2:BR), in
# alphabetical order.
STATE_CODES = ("AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS", "MT", "PA", "PB", "PE", "PI",
               "PR", "RJ", "RN", "RO", "RR", "RS", "SC", "SE", "SP", "TO")

# ---------------------------------------------------------------------------
# Words that score a fixed polarity when they are the whole
# cleaned text, and that polarity.
OVERRIDE_WORDS = ("boa", "bom", "recomendo")
OVERRIDE_POLARITY = 0.4

# ---------------------------------------------------------------------------
# Products returned when no recommendation can be made.
FALLBACK_PRODUCTS = (
    "43ee88561093499d9e571d4db5f20b79",
    "2265e8aa066cc6c4528d4be900eb5b64",
    "3158c44b08596ff51ee3560fad16cc09",
    "1ae28ef6d0421f92f2e4e6d407e90347",
    "eeba3ee5aa7d1d571752248eb4c81c20",
)

# ---------------------------------------------------------------------------
# Category translation (native name, English name), 71 rows in
# file order.
CATEGORY_TRANSLATION_CSV = """\
beleza_saude,health_beauty
informatica_acessorios,computers_accessories
automotivo,auto
cama_mesa_banho,bed_bath_table
moveis_decoracao,furniture_decor
esporte_lazer,sports_leisure
perfumaria,perfumery
utilidades_domesticas,housewares
telefonia,telephony
relogios_presentes,watches_gifts
alimentos_bebidas,food_drink
bebes,baby
papelaria,stationery
tablets_impressao_imagem,tablets_printing_image
brinquedos,toys
telefonia_fixa,fixed_telephony
ferramentas_jardim,garden_tools
fashion_bolsas_e_acessorios,fashion_bags_accessories
eletroportateis,small_appliances
consoles_games,consoles_games
audio,audio
fashion_calcados,fashion_shoes
cool_stuff,cool_stuff
malas_acessorios,luggage_accessories
climatizacao,air_conditioning
construcao_ferramentas_construcao,construction_tools_construction
moveis_cozinha_area_de_servico_jantar_e_jardim,kitchen_dining_laundry_garden_furniture
construcao_ferramentas_jardim,costruction_tools_garden
fashion_roupa_masculina,fashion_male_clothing
pet_shop,pet_shop
moveis_escritorio,office_furniture
market_place,market_place
eletronicos,electronics
eletrodomesticos,home_appliances
artigos_de_festas,party_supplies
casa_conforto,home_confort
construcao_ferramentas_ferramentas,costruction_tools_tools
agro_industria_e_comercio,agro_industry_and_commerce
moveis_colchao_e_estofado,furniture_mattress_and_upholstery
livros_tecnicos,books_technical
casa_construcao,home_construction
instrumentos_musicais,musical_instruments
moveis_sala,furniture_living_room
construcao_ferramentas_iluminacao,construction_tools_lights
industria_comercio_e_negocios,industry_commerce_and_business
alimentos,food
artes,art
moveis_quarto,furniture_bedroom
livros_interesse_geral,books_general_interest
construcao_ferramentas_seguranca,construction_tools_safety
fashion_underwear_e_moda_praia,fashion_underwear_beach
fashion_esporte,fashion_sport
sinalizacao_e_seguranca,signaling_and_security
pcs,computers
artigos_de_natal,christmas_supplies
fashion_roupa_feminina,fashio_female_clothing
eletrodomesticos_2,home_appliances_2
livros_importados,books_imported
bebidas,drinks
cine_foto,cine_photo
la_cuisine,la_cuisine
musica,music
casa_conforto_2,home_comfort_2
portateis_casa_forno_e_cafe,small_appliances_home_oven_and_coffee
cds_dvds_musicais,cds_dvds_musicals
dvds_blu_ray,dvds_blu_ray
flores,flowers
artes_e_artesanato,arts_and_craftmanship
fraldas_higiene,diapers_and_hygiene
fashion_roupa_infanto_juvenil,fashion_childrens_clothes
seguros_e_servicos,security_and_services"""

TRANSLATION_SCHEMA = T.StructType([
    T.StructField("product_category_name", T.StringType(), False),
    T.StructField("product_category_name_english", T.StringType(), False),
])


def translation_rows() -> list[tuple[str, str]]:
    rows = []
    for line in CATEGORY_TRANSLATION_CSV.strip().splitlines():
        native, english = line.split(",")
        rows.append((native, english))
    return rows


def category_translation(spark: SparkSession) -> DataFrame:
    """The 71-row translation dimension, a fixed size, so it is broadcast."""
    return F.broadcast(spark.createDataFrame(translation_rows(), TRANSLATION_SCHEMA))

