"""Named datasets: how each is built from the enriched sales and which filters it accepts.

Quintiles, cohorts and running shares hold only over the whole base, so their
datasets accept no filter; asking for one is an error instead of a quietly
different question.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from balcao.operators import customers, forecast, kpis, products
from balcao.plans import load
from balcao.operators.selection import (
    ALL_AXES, CATEGORY, MONTH, PERIOD, Selection, apply_selection, axis_test, in_months,
)
from balcao.sources.warehouse import Warehouse


@dataclass(frozen=True)
class Dataset:
    """``looks_back``: rows of a month depend on sales of earlier months, as growth and churn do.

    ``additive``: only sums over the cells of the stored cube are asked for, so the
    cube's rows give the same answer as the items.
    """

    build: Callable[[DataFrame], DataFrame]
    axes: tuple[str, ...] = ()
    looks_back: bool = False
    additive: bool = False


DATASETS: dict[str, Dataset] = {
    "sales": Dataset(lambda sales: sales, ALL_AXES),
    "revenue_cube": Dataset(kpis.revenue_cube, ALL_AXES, additive=True),
    "category_mom": Dataset(products.category_mom, (PERIOD, CATEGORY), looks_back=True, additive=True),
    "kpi_monthly": Dataset(kpis.kpi_monthly, (PERIOD,), looks_back=True),
    "rfm": Dataset(customers.rfm),
    "cohort_retention": Dataset(customers.cohort_retention),
    "retention_curve": Dataset(customers.retention_curve),
    "top_decile_share": Dataset(customers.top_decile_share),
    "product_metrics": Dataset(products.product_metrics),
    "pareto": Dataset(products.pareto),
    "monthly_forecast": Dataset(lambda sales: forecast.model_of(sales).table()),
    "model_metrics": Dataset(lambda sales: forecast.model_of(sales).metrics()),
}


def read_view(name: str, sales: DataFrame) -> DataFrame:
    """The whole dataset as a lazy frame."""
    return DATASETS[name].build(sales).drop(MONTH)


def filtered_view(
    name: str, sales: DataFrame, chosen: Selection, axes: Iterable[str] | None = None
) -> DataFrame:
    """The dataset under the selection, on ``axes`` or on all it accepts.

    The filter sits above the dataset, so windows see what they need; plain
    aggregates let the engine push it down. The months of the period are also
    tested below it, where a stored fact skips whole folders: no dataset depends
    on later months, and those that look back are read from the start.
    """
    accepted = DATASETS[name].axes
    wanted = tuple(accepted if axes is None else axes)
    refused = [a for a in wanted if a not in accepted]
    if refused:
        raise ValueError(f"{name} does not accept the filters {', '.join(refused)}")
    if PERIOD in wanted:
        sales = in_months(sales, None if DATASETS[name].looks_back else chosen.start, chosen.end)
    return apply_selection(DATASETS[name].build(sales), chosen, wanted).drop(MONTH)


def source_of(house: Warehouse, name: str) -> DataFrame:
    """What a dataset is built from in a warehouse: the cube where that can answer, else the enriched sales."""
    return house.read("sales_cube") if DATASETS[name].additive else load.sales_of(house)


def stored_view(house: Warehouse, name: str, chosen: Selection, axes: Iterable[str] | None = None) -> DataFrame:
    """``filtered_view`` over a warehouse, without reading items where sums suffice."""
    return filtered_view(name, source_of(house, name), chosen, axes)


def filter_contract(sales: DataFrame, chosen: Selection) -> DataFrame:
    """Per dataset and axis: whether it accepts the filter, and how many rows the choice keeps (NULL if refused)."""
    schema = "dataset string, axis string, accepted boolean, n_rows long"
    refused = [(name, a, False, None) for name, d in DATASETS.items() for a in ALL_AXES if a not in d.axes]
    out = sales.sparkSession.createDataFrame(refused, schema)
    for name, dataset in DATASETS.items():
        if not dataset.axes:
            continue
        rows = dataset.build(sales)
        kept = rows.agg(*[F.count_if(axis_test(rows, chosen, a)).alias(a) for a in dataset.axes])
        out = out.unionByName(kept.unpivot([], list(dataset.axes), "axis", "n_rows").select(
            F.lit(name).alias("dataset"), "axis", F.lit(True).alias("accepted"), "n_rows"))
    return out
