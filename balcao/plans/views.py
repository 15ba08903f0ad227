"""The datasets as temporary views under the feed's own table and column names.

Existing SQL over those names then runs as it is, without a schema prefix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from balcao import vocab
from balcao.plans.registry import read_view

# View name -> dataset and its columns as (ours, theirs).
VIEWS: dict[str, tuple[str, dict[str, str]]] = {
    "vw_vendas": ("sales", {
        "sale_key": "sk_venda", "txn_id": "id_transacao", "order_id": "id_pedido", "sale_date": "data_venda",
        "year_month": "ano_mes", "year": "ano", "month": "mes", "customer_id": "id_cliente",
        "product": "nome_produto", "category": "categoria", "city": "cidade", "state": "uf",
        "country": "pais", "quantity": "quantidade", "unit_price": "valor_unitario",
        "amount": "valor_total", "payment_method": "metodo_pagamento", "status": "status_pedido",
    }),
    "vw_coorte_retencao": ("cohort_retention", {
        "cohort": "coorte_mes", "months_since": "meses_desde", "cohort_size": "clientes_coorte",
        "retained": "clientes_retidos", "retained_pct": "pct_retido",
    }),
    "vw_curva_retencao": ("retention_curve", {"months_since": "meses_desde", "mean_pct": "pct_medio"}),
    "vw_faturamento_mensal": ("revenue_cube", {
        "year_month": "ano_mes", "year": "ano", "month": "mes", "category": "categoria", "state": "uf",
        "status": "status", "revenue": "faturamento", "items": "itens",
    }),
    "vw_kpis_mensais": ("kpi_monthly", {
        "year_month": "ano_mes", "revenue": "faturamento", "orders": "pedidos", "avg_ticket": "ticket_medio",
        "active_customers": "clientes_ativos", "new_customers": "clientes_novos",
        "avg_ticket_per_customer": "ticket_medio_cliente", "retention_rate": "taxa_retencao",
        "churn_rate": "churn_rate",
    }),
    "vw_rfm": ("rfm", {
        "customer_id": "id_cliente", "recency_days": "recencia_dias", "frequency": "frequencia",
        "monetary": "monetario", "score_r": "score_r", "score_f": "score_f", "score_m": "score_m",
        "segment": "segmento",
    }),
    "vw_receita_top_clientes": ("top_decile_share", {"top_decile_pct": "pct_receita_top10"}),
    "vw_crescimento_categoria": ("category_mom", {
        "year_month": "ano_mes", "category": "categoria", "revenue": "faturamento", "mom_pct": "mom_pct",
    }),
    "vw_produtos_metricas": ("product_metrics", {
        "product": "produto", "category": "categoria", "revenue": "faturamento", "quantity": "quantidade",
        "growth_pct": "crescimento_pct",
    }),
    "vw_pareto_produtos": ("pareto", {
        "product": "produto", "revenue": "faturamento", "share_pct": "pct_faturamento",
        "running_pct": "pct_acumulado", "position": "posicao",
    }),
    "vw_previsao": ("monthly_forecast", {
        "year_month": "ano_mes", "actual": "realizado", "fitted": "ajustado", "forecast": "previsto",
        "band_low": "banda_inf", "band_high": "banda_sup", "phase": "fase",
    }),
    "vw_metricas_modelo": ("model_metrics", {"model": "modelo", "mae": "mae", "mape": "mape", "r2": "r2"}),
}

# The same for the stored tables.
TABLES: dict[str, tuple[str, dict[str, str]]] = {
    "vendas_raw": ("staging", {
        **{name: raw.lower() for raw, name in vocab.RAW_HEADERS.items()}, "loaded_at": "carregado_em",
    }),
    "quarentena": ("quarantine", {
        "record": "registro", "reason": "motivo", "stage": "etapa", "created_at": "criado_em",
    }),
    "dim_cliente": ("dim_customer", {"customer_key": "sk_cliente", "customer_id": "id_cliente"}),
    "dim_produto": ("dim_product", {
        "product_key": "sk_produto", "product": "nome_produto", "category": "categoria",
    }),
    "dim_localidade": ("dim_location", {
        "location_key": "sk_localidade", "city": "cidade", "state": "uf", "country": "pais",
    }),
    "dim_calendario": ("dim_calendar", {
        "day": "data", "year": "ano", "month": "mes", "month_name": "nome_mes", "quarter": "trimestre",
        "year_month": "ano_mes",
    }),
    "fato_vendas": ("fact_sales", {
        "sale_key": "sk_venda", "txn_id": "id_transacao", "order_id": "id_pedido", "sale_date": "data_venda",
        "customer_key": "sk_cliente", "product_key": "sk_produto", "location_key": "sk_localidade",
        "quantity": "quantidade", "unit_price": "valor_unitario", "amount": "valor_total",
        "payment_method": "metodo_pagamento", "status": "status_pedido",
    }),
    "previsao_mensal": ("monthly_forecast", VIEWS["vw_previsao"][1]),
    "metricas_modelo": ("model_metrics", VIEWS["vw_metricas_modelo"][1]),
}


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """The columns under the feed's names; a missing one is an error."""
    return df.select(*[F.col(ours).alias(theirs) for ours, theirs in names.items()])


def register_views(sales: DataFrame, names: list[str] | None = None) -> list[str]:
    """Create the temporary views over an enriched sales frame.

    Datasets with a global ranking write their placed rows on creation, so
    name only the views a session needs.
    """
    chosen = list(VIEWS) if names is None else names
    for view in chosen:
        dataset, columns = VIEWS[view]
        renamed(read_view(dataset, sales), columns).createOrReplaceTempView(view)
    return chosen


def register_tables(house) -> list[str]:
    """Create temporary views over the stored tables of a warehouse."""
    for view, (table, columns) in TABLES.items():
        renamed(house.read(table), columns).createOrReplaceTempView(view)
    return list(TABLES)
