"""The sales model and the dirty raw feed, derived from the star-schema tables.

``load_sales`` gives the clean enriched sales view (one row per item).
``dirty_feed`` gives the same sales as the all-text feed a shop would export,
with every class of dirt injected by key arithmetic, so another engine can
build the same rows and the feed grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from balcao import vocab
from balcao.functions import dates
from balcao.session import compiled

SALES_COLUMNS = [
    "txn_id", "order_id", "sale_date", "year_month", "year", "month", "customer_id", "product",
    "category", "city", "state", "country", "quantity", "unit_price", "amount", "payment_method",
    "status",
]
_PRODUCT = {"product", "category"}
_PLACE = {"city", "state", "country"}
_ORDER = {"sale_date", "year_month", "year", "month", "customer_id", "payment_method", "status"} | _PLACE


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items, dealt out by key while they are narrow if their file has fewer splits than there are cores."""
    lines, cores = _read(spark, sf_dir, "lineitem"), spark.sparkContext.defaultParallelism
    if lines.rdd.getNumPartitions() >= cores:
        return lines
    return lines.repartition(cores, "l_orderkey", "l_linenumber", "l_partkey")


def _joined(spark: SparkSession, sf_dir: str, wanted: set[str], dealt: bool = False) -> DataFrame:
    """Item rows with only the tables the wanted columns come from.

    No join is hinted: sizes are known from the files, so small sides are
    broadcast below the engine's threshold and shuffled beyond it. Places join
    the orders and parts the bare items, so that wide rows are never moved for
    a table smaller than the orders.
    """
    rows = _lines(spark, sf_dir) if dealt else _read(spark, sf_dir, "lineitem")
    if wanted & _PRODUCT:
        rows = rows.join(_read(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    if wanted & _ORDER:
        orders = _read(spark, sf_dir, "orders")
        if wanted & _PLACE:
            orders = orders.join(_read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        if wanted & {"city", "country"}:
            orders = orders.join(_read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        if "country" in wanted:
            orders = orders.join(_read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows


def _cents() -> Column:
    return F.round(F.col("l_extendedprice") * 100).cast("long")


def _txn_id() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", _cents())


def _status() -> Column:
    other = F.col("o_orderkey") % 3
    return (
        F.when(F.col("o_orderstatus") == "F", vocab.DELIVERED)
        .when(F.col("o_orderstatus") == "O", vocab.SHIPPED)
        .when(other == 0, vocab.PROCESSING)
        .when(other == 1, vocab.CANCELLED)
        .otherwise(vocab.RETURNED)
    )


def load_sales(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The enriched sales view, or only ``columns`` of it."""
    day = F.to_date("o_orderdate")
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    quantity = F.col("l_quantity").cast("int")
    exprs = {
        "txn_id": _txn_id(),
        "order_id": F.col("l_orderkey").cast("string"),
        "sale_date": day,
        "year_month": dates.year_month(day),
        "year": F.year(day),
        "month": F.month(day),
        "customer_id": F.col("o_custkey").cast("string"),
        "product": F.col("p_name"),
        "category": F.col("p_type"),
        "city": F.col("n_name"),
        "state": F.concat(F.lit("S"), F.col("c_nationkey").cast("string")),
        "country": F.col("r_name"),
        "quantity": quantity,
        "unit_price": price,
        "amount": (quantity * price).cast("decimal(14,2)"),
        "payment_method": F.col("o_orderpriority"),
        "status": _status(),
    }
    names = list(columns) or SALES_COLUMNS
    return _joined(spark, sf_dir, set(names)).select(*[exprs[n].alias(n) for n in names])


# The dirt classes and texts a dirty feed carries.
BROKEN_DATES = ["30/02/2024", "2024-14-02", "00/05/2023", "ontem", "2024-03- 31", "2024-03- 07"]
BROKEN_PRICES = ["R$ --", "a combinar", "7,7,7"]
FOREIGN_STATUSES = ["Em rota", "Retido", "Pago"]
PLAIN_VOWELS, ACCENTED_VOWELS = "aeiou", "áêíõú"


def dirty_feed(spark: SparkSession, sf_dir: str, clashing_ids: bool = False) -> DataFrame:
    """The raw all-text feed with ``ordinal``.

    Every dirt class takes the rows whose key sum leaves certain remainders to
    its own prime, so classes overlap freely and rows with two faults occur.
    ``clashing_ids`` names rows by order and line only, which repeats often.
    """
    compiled(spark)
    rows = _joined(spark, sf_dir, set(SALES_COLUMNS), dealt=True)
    rows = rows.withColumn("cents", _cents()).withColumn(
        "k",
        F.col("l_orderkey") * 31 + F.col("l_linenumber") * 17 + F.col("l_partkey") * 7
        + F.col("l_suppkey") * 3 + F.col("cents"),
    )

    def rest(prime: int) -> Column:
        return F.col("k") % prime

    def pick(texts: list[str], prime: int) -> Column:
        return F.element_at(F.array(*map(F.lit, texts)), (F.floor(F.col("k") / prime) % len(texts) + 1).cast("int"))

    day = F.to_date("o_orderdate")
    date_text = (
        F.when(rest(211) == 0, pick(BROKEN_DATES, 211))
        .when(rest(97) < 58, F.date_format(day, "yyyy-MM-dd"))
        .when(rest(97) < 82, F.date_format(day, "dd/MM/yyyy"))
        .otherwise(F.date_format(day, "dd-MM-yyyy"))
    )
    times = F.when(rest(163) == 0, 6 + F.col("k") % 7).otherwise(F.lit(1))
    value = (F.col("cents") * times).cast("decimal(18,0)") / 100
    grouped = F.translate(F.format_number(value, 2), ",.", ".,")
    price_text = (
        F.when(rest(251) == 0, pick(BROKEN_PRICES, 251))
        .when(rest(257) == 0, F.concat(F.lit("R$ -"), grouped))
        .when(rest(89) < 36, F.concat(F.lit("R$ "), grouped))
        .when(rest(89) < 58, grouped)
        .otherwise(value.cast("decimal(18,2)").cast("string"))
    )
    label = F.concat(F.substring("p_type", 1, 1), F.lower(F.expr("substring(p_type, 2)")))
    category_text = (
        F.when(rest(307) == 0, None)
        .when(rest(83) < 4, F.upper(label))
        .when(rest(83) < 8, F.lower(label))
        .when(rest(83) < 12, F.translate(label, PLAIN_VOWELS, ACCENTED_VOWELS))
        .otherwise(label)
    )
    status_text = (
        F.when(rest(199) == 0, pick(FOREIGN_STATUSES, 199))
        .when(rest(79) < 3, F.upper(_status()))
        .when(rest(79) < 6, F.lower(_status()))
        .otherwise(_status())
    )
    quantity_text = (
        F.when(rest(101) == 0, pick(["-2", "-1", "0"], 101))
        .when(rest(401) == 0, F.lit("3.0"))
        .otherwise(F.col("l_quantity").cast("int").cast("string"))
    )
    state = F.concat(F.lit("S"), F.col("c_nationkey").cast("string"))
    location_text = (
        F.when(rest(131) == 0, F.concat_ws("/", "n_name", state))
        .when(rest(131) == 1, F.concat_ws("/", "n_name", state, "r_name", F.lit("x")))
        .when(rest(131) == 2, F.lit(" / / "))
        .when(rest(131) == 3, None)
        .when(rest(131) == 4, F.concat(F.lit(" "), F.concat_ws(" / ", "n_name", state, "r_name"), F.lit(" ")))
        .otherwise(F.concat_ws("/", "n_name", state, "r_name"))
    )
    key = F.concat_ws("-", "l_orderkey", "l_linenumber") if clashing_ids else _txn_id()
    key = F.when(rest(113) == 0, F.concat(F.lit(" "), key, F.lit("\t"))).otherwise(key)
    customer, product = F.col("o_custkey").cast("string"), F.col("p_name")
    copies = F.when(rest(67) == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("copy", F.explode(copies)).select(
        F.when(rest(167) == 5, F.lit("   ")).when(rest(167) != 0, key).alias("txn_id"),
        F.when(rest(503) != 0, F.col("l_orderkey").cast("string")).alias("order_id"),
        F.when(rest(167) != 2, date_text).alias("sale_date"),
        F.when(rest(167) != 1, customer).alias("customer_id"),
        F.when(rest(167) != 4, product).alias("product"),
        category_text.alias("category"),
        F.when(rest(167) != 3, price_text).alias("unit_price"),
        quantity_text.alias("quantity"),
        location_text.alias("location"),
        F.when(rest(509) != 0, F.col("o_orderpriority")).alias("payment_method"),
        status_text.alias("status"),
        F.struct("copy", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "cents").alias("ordinal"),
    )
