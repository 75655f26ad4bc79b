"""Values of the benefits data set that results depend on."""

# State names and their codes.
STATE_CODES = {
    "Acre": "AC",
    "Alagoas": "AL",
    "Amapá": "AP",
    "Amazonas": "AM",
    "Bahia": "BA",
    "Ceará": "CE",
    "Distrito Federal": "DF",
    "Espírito Santo": "ES",
    "Goiás": "GO",
    "Maranhão": "MA",
    "Mato Grosso": "MT",
    "Mato Grosso do Sul": "MS",
    "Minas Gerais": "MG",
    "Pará": "PA",
    "Paraíba": "PB",
    "Paraná": "PR",
    "Pernambuco": "PE",
    "Piauí": "PI",
    "Rio de Janeiro": "RJ",
    "Rio Grande do Norte": "RN",
    "Rio Grande do Sul": "RS",
    "Rondônia": "RO",
    "Roraima": "RR",
    "Santa Catarina": "SC",
    "São Paulo": "SP",
    "Sergipe": "SE",
    "Tocantins": "TO",
}

# Region of each state code.
REGIONS = {
    "Norte": ["AM", "PA", "AC", "RO", "RR", "AP", "TO"],
    "Nordeste": ["MA", "PI", "CE", "RN", "PB", "PE", "AL", "SE", "BA"],
    "Sudeste": ["MG", "ES", "RJ", "SP"],
    "Sul": ["PR", "SC", "RS"],
    "Centro-Oeste": ["MT", "MS", "GO", "DF"],
}
UNKNOWN_REGION = "Desconhecido"

# Benefit species codes per business group.
SPECIES_GROUPS = {
    "Pensao": [1, 2, 3, 21, 22, 23, 26, 27, 28, 29, 54, 55, 56, 59],
    "Aposentadoria": [
        4, 5, 6, 7, 8, 30, 32, 33, 34, 37, 38, 40, 41, 42, 43,
        44, 45, 46, 47, 48, 49, 51, 57, 58, 72, 79,
    ],
    "Auxilio": [10, 13, 16, 18, 25, 31, 36, 60],
    "Amparo_BPC": [11, 12, 87, 88],
}
OTHER_SPECIES = "Outros"

# Payment method prefix, its code and its label.
PAYMENT_METHODS = {
    "Ccf": ("CCF", "Conta-Corrente Física"),
    "Ccl": ("CCL", "Conta-Corrente Lotérica"),
    "Cmg": ("CMG", "Cartão Magnético"),
}

# Texts that stand for "no information".
SENTINELS = ["{ñ class}", "Nao Informado", ""]

# Columns in which those texts become NULL.
CATEGORY_COLUMNS = ["sexo", "clientela", "ramo_atividade", "despacho"]

# Landing header, in file order, and the bronze names.
LANDING_COLUMNS = {
    "Despacho": "despacho",
    "Sexo.": "sexo",
    "Clientela": "clientela",
    "Tipo Benefício": "tipo_beneficio",
    "UF": "uf",
    "Meio pagamento": "meio_pagamento",
    "Banco": "banco",
    "Mun Pagto": "mun_pagto",
    "Mun Resid": "mun_resid",
    "Vl Líquido": "vl_liquido",
    "Ramo Atividade": "ramo_atividade",
    "Dt início validade": "dt_inicio_validade",
    "Espécie12": "especie_codigo",
    "Espécie13": "especie_descricao",
}

# Separators tried in this order, and the fallback.
SEPARATORS = [";", ",", "\t", "|"]
DEFAULT_SEPARATOR = ";"
