"""Fixed values. They are data, so they keep the feed's own language."""

# CSV header -> staging column.
RAW_HEADERS = {
    "ID_Transacao": "txn_id",
    "ID_Pedido": "order_id",
    "Data_Venda": "sale_date",
    "ID_Cliente": "customer_id",
    "Nome_Produto": "product",
    "Categoria_Produto": "category",
    "Valor_Unitario": "unit_price",
    "Quantidade": "quantity",
    "Localidade_Venda": "location",
    "Metodo_Pagamento": "payment_method",
    "Status_Pedido": "status",
}
STAGING_COLUMNS = list(RAW_HEADERS.values())

# Order status domain, and the statuses that count as a sale.
DELIVERED = "Entregue"
SHIPPED = "Enviado"
PROCESSING = "Processando"
CANCELLED = "Cancelado"
RETURNED = "Devolvido"
STATUSES = [DELIVERED, SHIPPED, PROCESSING, CANCELLED, RETURNED]
COMPLETED = [DELIVERED, SHIPPED]

# Location used when the text does not hold three parts.
UNKNOWN_LOCATION = ("Desconhecida", "ND", "Brasil")

# Key fields in the order they are checked, with the name each
# carries in the reject reason.
KEY_FIELDS = {
    "txn_id": "id_transacao",
    "customer_id": "id_cliente",
    "sale_date": "data_venda",
    "unit_price": "valor_unitario",
    "product": "nome_produto",
}

# Reject reasons and the stage written beside them.
NULL_KEY = "campo chave nulo: "
BAD_DATE = "data invalida"
BAD_PRICE = "valor invalido"
NEGATIVE_PRICE = "valor negativo"
BAD_QUANTITY = "quantidade invalida"
NON_POSITIVE_QUANTITY = "quantidade nao positiva"
BAD_STATUS = "status invalido"
NULL_CATEGORY = "categoria nula"
STAGE = "validacao"

# Our own reasons, for rows that would abort a strict load: fields the target
# table requires, and an amount wider than its column.
NULL_REQUIRED = "campo obrigatorio nulo: "
REQUIRED_FIELDS = {"order_id": "id_pedido", "payment_method": "metodo_pagamento"}
AMOUNT_OVERFLOW = "valor total fora do limite"
# Our own reason for a line of the feed that is no whole record.
MALFORMED = "registro malformado"

# Month names without accents.
MONTH_NAMES = [
    "janeiro", "fevereiro", "marco", "abril", "maio", "junho",
    "julho", "agosto", "setembro", "outubro", "novembro", "dezembro",
]

# Labels of the text-format censuses.
NULL_FORM = "nulo"
INVALID_FORM = "invalido"
DATE_ISO = "iso (aaaa-mm-dd)"
DATE_SLASH = "dd/mm/aaaa"
DATE_DASH = "dd-mm-aaaa"
MONEY_SYMBOL = "R$ 1.234,56"
MONEY_COMMA = "1.234,56"
MONEY_DOT = "1234.56"
DATE_PATTERNS = {
    "aaaa-mm-dd": r"^\d{4}-\d{2}-\d{2}$",
    "dd/mm/aaaa": r"^\d{2}/\d{2}/\d{4}$",
    "dd-mm-aaaa": r"^\d{2}-\d{2}-\d{4}$",
}
NO_PATTERN = "nenhum dos tres"

# RFM segments, the rule in words and the suggested action.
CHAMPIONS = "Campeões"
POTENTIAL_LOYAL = "Potenciais leais"
NEW = "Novos"
LOYAL = "Leais"
NEED_ATTENTION = "Precisam de atenção"
PROMISING = "Promissores"
CANNOT_LOSE = "Não pode perder"
AT_RISK = "Em Risco"
ABOUT_TO_SLEEP = "Prestes a dormir"
LOST = "Perdidos"
SEGMENT_ACTIONS = [
    (CHAMPIONS, "R >= 4 e F >= 4",
     "Proteger. É o grupo que mais concentra receita, e qualquer atrito custa caro."),
    (POTENTIAL_LOYAL, "R >= 4 e F >= 2",
     "Aumentar a frequência com recomendação e recompra programada."),
    (NEW, "R >= 4",
     "Garantir a segunda compra, que é onde a curva de retenção mais cai."),
    (LOYAL, "R = 3 e F >= 4",
     "Reconhecer e manter. Compram sempre, mas não compraram tão recentemente."),
    (NEED_ATTENTION, "R = 3 e F >= 2",
     "Lembrete de recompra antes que a recência avance mais."),
    (PROMISING, "R = 3",
     "Testar oferta de entrada e observar se a frequência sobe."),
    (CANNOT_LOSE, "F >= 4",
     "Contato direto. Compravam muito e pararam, então a perda é grande."),
    (AT_RISK, "F >= 2",
     "Campanha de reativação. Valor comprovado e relação ainda morna."),
    (ABOUT_TO_SLEEP, "R = 2",
     "Reativação barata, por e-mail ou cupom, antes de virar perda."),
    (LOST, "qualquer outro caso",
     "Entender o motivo da perda vale mais do que insistir na reativação."),
]
HIGHLIGHT_SEGMENTS = [CHAMPIONS, AT_RISK, LOST]
OTHER_SEGMENTS = "Demais segmentos"

# Forecast phases, model names and sizes.
TRAIN, TEST, FUTURE = "treino", "teste", "futuro"
MOVING_AVERAGE, REGRESSION = "media_movel", "regressao"
TEST_POINTS = 6
HORIZON = 6
BAND_SIGMAS = 1.96

# Product roles on the growth matrix, period presets.
TOP_VOLUME, TOP_GROWTH, TOP_DECLINE = "maior volume", "maior crescimento", "maior queda"
OTHER_PRODUCTS = "Demais produtos"
PRESET_ALL = "Tudo"
PRESET_DAYS = {"Últimos 30 dias": 30, "Últimos 90 dias": 90, "Últimos 180 dias": 180}
PRESET_YEAR = "Ano corrente"
PRESET_CUSTOM = "Personalizado"

# Days without a purchase after which a customer counts as churned.
CHURN_DAYS = 90
