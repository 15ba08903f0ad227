"""Validation cascade, dedup, quarantine and the load."""

import json

import pytest
from pyspark.sql import functions as F

from balcao import vocab
from balcao.operators import quality
from balcao.plans import load, views
from balcao.sources import raw
from balcao.sources.raw import read_raw_sales
from balcao.sources.warehouse import Warehouse, quarantine_records

GOOD = {
    "txn_id": "T1", "order_id": "O1", "sale_date": "2025-03-07", "customer_id": "C1", "product": "Mouse",
    "category": "Acessórios", "unit_price": "R$ 89,90", "quantity": "2", "location": "Rio/RJ/Brasil",
    "payment_method": "Pix", "status": "ENTREGUE",
}


def staging(spark, rows):
    schema = "n int, " + ", ".join(f"{c} string" for c in vocab.STAGING_COLUMNS)
    data = [(i, *[{**GOOD, **r}[c] for c in vocab.STAGING_COLUMNS]) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, schema).withColumn("ordinal", F.struct("n"))


CASES = [
    ({}, None),
    ({"txn_id": None}, "campo chave nulo: id_transacao"),
    ({"txn_id": "  ", "customer_id": None}, "campo chave nulo: id_transacao"),
    ({"customer_id": "", "sale_date": "sem data"}, "campo chave nulo: id_cliente"),
    ({"sale_date": None, "unit_price": None}, "campo chave nulo: data_venda"),
    ({"unit_price": " ", "quantity": "-1"}, "campo chave nulo: valor_unitario"),
    ({"product": None, "sale_date": "31/02/2025"}, "campo chave nulo: nome_produto"),
    ({"sale_date": "31/02/2025", "unit_price": "gratis"}, "data invalida"),
    ({"unit_price": "gratis", "quantity": "0"}, "valor invalido"),
    ({"unit_price": "R$", "quantity": "0"}, "valor invalido"),
    ({"unit_price": "R$ -5,00", "quantity": "x"}, "valor negativo"),
    ({"quantity": "3.0", "status": "Extraviado"}, "quantidade invalida"),
    ({"quantity": None}, "quantidade invalida"),
    ({"quantity": "0", "status": "Extraviado"}, "quantidade nao positiva"),
    ({"status": "Extraviado", "category": None}, "status invalido"),
    ({"status": None}, "status invalido"),
    ({"category": "  "}, "categoria nula"),
    ({"order_id": None}, "campo obrigatorio nulo: id_pedido"),
    ({"payment_method": None}, "campo obrigatorio nulo: metodo_pagamento"),
    ({"unit_price": "9999999999", "quantity": "1000"}, "valor total fora do limite"),
    ({"unit_price": "0"}, None),
    ({"order_id": " ", "payment_method": " "}, None),
]


def test_first_matching_reason(spark):
    tagged = quality.tag(staging(spark, [c for c, _ in CASES]))
    got = {r["n"]: r["reason"] for r in tagged.select("ordinal.n", "reason").collect()}
    assert got == {i: want for i, (_, want) in enumerate(CASES)}


def test_dedup_keeps_first_valid_row(spark):
    rows = [
        {"quantity": "0"}, {"quantity": "5"}, {"quantity": "6"}, {"txn_id": " T1\t", "quantity": "7"},
        {"txn_id": "T2", "quantity": "8"},
    ]
    tagged = quality.tag(staging(spark, rows))
    kept = {r["txn_id"]: r["quantity"] for r in quality.accepted(tagged).collect()}
    assert kept == {"T1": 5, "T2": 8}
    balance = quality.load_balance(tagged).first().asDict()
    assert balance == {"staged": 5, "valid": 4, "rejected": 1, "fact": 2, "duplicates": 2, "balanced": True}


def test_dedup_limits_hot_ids_before_the_shuffle(spark):
    plan = quality.dedup_keep_first(
        quality.valid(quality.tag(staging(spark, [{}])))
    )._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[:shuffle] and "WindowGroupLimit" in plan[shuffle:]


def test_quarantine_keeps_the_whole_row(spark):
    rows = quarantine_records(quality.rejected(quality.tag(staging(spark, [{"status": "Extraviado", "location": None}]))))
    row = rows.first()
    assert json.loads(row["record"]) == {**GOOD, "status": "Extraviado", "location": None}
    assert (row["reason"], row["stage"]) == ("status invalido", "validacao")


def test_empty_staging(spark):
    tagged = quality.tag(staging(spark, [{}]).limit(0))
    assert quality.accepted(tagged).count() == 0
    assert quality.null_census(staging(spark, [{}]).limit(0)).count() == 0


def write_csv(path, rows, header=None):
    header = header or list(vocab.RAW_HEADERS)
    lines = [",".join(header)]
    for row in rows:
        full = {**GOOD, **row}
        lines.append(",".join('"' + (full[vocab.RAW_HEADERS[h]] or "") + '"' for h in header))
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_csv_takes_columns_by_name_and_blanks_as_null(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", [{"location": None}, {"product": "TV 40"}], list(vocab.RAW_HEADERS)[::-1])
    rows = read_raw_sales(spark, path).orderBy("ordinal").collect()
    assert [r["product"] for r in rows] == ["Mouse", "TV 40"]
    assert rows[0]["location"] is None and rows[0]["txn_id"] == "T1"


BROKEN = '''{header}
{whole}
"T2",O1,2025-03-07,C1,"Mouse
sem fio",Acessorios,"R$ 89,90",2,Rio/RJ/Brasil,Pix,Entregue
T3,O1,2025-03-07,C1,Mouse,Acessorios,10.00,2,Rio/RJ/Brasil,Pix
T4,O1,2025-03-07,C1,Mouse,Acessorios,10.00,2,Rio/RJ/Brasil,Pix,Entregue,sobra
T5,O1,2025-03-07,C1,"Tela 24""",Acessorios,10.00,2,Rio/RJ/Brasil,Pix,"Entregue"
T6,O1,2025-03-07,C1,Mouse,Acessorios,10.00,2,Rio/RJ/Brasil,Pix,"Entr
egue"
'''


def test_csv_records_of_several_lines(spark, tmp_path):
    path = tmp_path / "a.csv"
    whole = "T1,O1,2025-03-07,C1,Mouse,Acessorios,10.00,2,Rio/RJ/Brasil,Pix,Entregue"
    path.write_text(BROKEN.format(header=",".join(vocab.RAW_HEADERS), whole=whole), encoding="utf-8")
    for multi_line in (False, True):
        records = read_raw_sales(spark, str(path), multi_line).orderBy("ordinal").collect()
        assert [r["txn_id"] for r in records if r["malformed"] is None] == ["T1", "T2", "T5", "T6"]
        assert [r["product"] for r in records if r["malformed"] is None] == ["Mouse", "Mouse\nsem fio", 'Tela 24"', "Mouse"]
        assert [r["malformed"][:3] for r in records if r["malformed"]] == ["T3,", "T4,"]
        assert all(r[c] is None for r in records if r["malformed"] for c in vocab.STAGING_COLUMNS)

    house = Warehouse(spark, str(tmp_path / "house"))
    counts = load.run_load(spark, str(path), house.root)
    # The status of T6 has a line break in it, so it is none.
    assert (counts["staging"], counts["quarantine"], counts["fact_sales"], counts["duplicates"]) == (6, 3, 3, 0)
    kept = house.read("quarantine").filter(F.col("reason") == vocab.MALFORMED)
    assert '{"line":"T3,O1,2025-03-07,C1,Mouse,Acessorios,10.00,2,Rio/RJ/Brasil,Pix"}' in {r["record"] for r in kept.collect()}


def long_feed(n):
    """Records of one to five lines, some with lines that look like records; one in 50 with a field too many."""
    like = "X,O1,2025-03-07,C1,Mouse,Acessorios,10.00,2,Rio/RJ/Brasil,Pix,Entregue"
    out = []
    for i in range(n):
        product = "\n".join(["Mouse", *[like] * (i * 7 % 5)]) if i % 3 == 0 else "Mouse"
        more = ",sobra" if i % 50 == 7 else ""
        out.append(f'T{i},O1,2025-03-07,C1,"{product}",Acessorios,10.00,2,Rio/RJ/Brasil,Pix,Entregue{more}')
    return out


@pytest.mark.parametrize("size", ["700", "20k", "128m"])
def test_records_over_the_borders_of_splits(spark, tmp_path, size):
    """The same rows whatever the splits, in order; a split may lie inside one record."""
    header = ",".join(vocab.RAW_HEADERS)
    long = 'T999,O1,2025-03-07,C1,"' + "\n".join(["Mouse,x"] * 400) + '",Acessorios,10.00,2,Rio/RJ/Brasil,Pix,Entregue'
    feeds = [long_feed(600), [*long_feed(30), long, *long_feed(5)]]
    for i, records in enumerate(feeds):
        (tmp_path / f"{i}.csv").write_text("\n".join([header, *records]) + "\n", encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "0" if size == "700" else "4m")
    try:
        found = read_raw_sales(spark, str(tmp_path))
        rows = found.orderBy("ordinal").collect()
        assert (found.rdd.getNumPartitions() > 2) or size != "700"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    records = sorted(feeds[0]) + sorted(feeds[1])
    assert sorted(r["malformed"] for r in rows if r["malformed"]) == sorted(r for r in records if r.endswith("sobra"))
    want = sorted((r.split(",")[0], r.split('"')[1]) for r in records if not r.endswith("sobra"))
    assert sorted((r["txn_id"], r["product"]) for r in rows if not r["malformed"]) == want
    by_file = {}
    for r in rows:
        by_file.setdefault(r["ordinal"]["file"], []).append(r["txn_id"] or r["malformed"].split(",")[0])
    assert sorted(by_file.values(), key=len) == sorted(([x.split(",")[0] for x in f] for f in feeds), key=len)


def test_stray_and_unclosed_quotes_cost_their_own_lines_only(spark, tmp_path, monkeypatch):
    good = "T{},O1,2025-03-07,C1,{},Acessorios,10.00,2,Rio/RJ/Brasil,Pix,Entregue"
    lines = [good.format(i, 'Tela 24"' if i in (2, 5) else '"Mouse' if i == 8 else "Mouse") for i in range(12)]
    path = tmp_path / "a.csv"
    path.write_text("\n".join([",".join(vocab.RAW_HEADERS), *lines]) + "\n", encoding="utf-8")
    rows = read_raw_sales(spark, str(path)).orderBy("ordinal").collect()
    assert [r["malformed"] for r in rows if r["malformed"]] == [lines[2], lines[5], lines[8]]
    assert [r["txn_id"] for r in rows if not r["malformed"]] == [f"T{i}" for i in range(12) if i not in (2, 5, 8)]
    path.write_text("\n".join([",".join(vocab.RAW_HEADERS), *long_feed(9)]) + "\n", encoding="utf-8")
    monkeypatch.setattr(raw, "MOST_CHARS", 10)
    assert read_raw_sales(spark, str(path)).filter("malformed is null and txn_id like 'T%'").count() < 9


def test_csv_without_a_column_fails(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", [{}], list(vocab.RAW_HEADERS)[:-1])
    with pytest.raises(ValueError, match="Status_Pedido"):
        read_raw_sales(spark, path)


def test_full_load_is_idempotent_and_feeds_the_views(spark, tmp_path):
    rows = [{"txn_id": f"T{i}", "order_id": f"O{i // 2}", "customer_id": f"C{i % 3}", "quantity": str(i % 4),
             "sale_date": f"{1 + i % 28:02d}/{1 + i % 6:02d}/2025"} for i in range(40)]
    path = write_csv(tmp_path / "feed.csv", rows + rows[1:3])
    root = str(tmp_path / "house")
    first = load.run_load(spark, path, root)
    assert load.run_load(spark, path, root) == first
    assert first["staging"] == 42 and first["quarantine"] == 10 and first["duplicates"] == 2
    house = Warehouse(spark, root)
    sales = load.sales_of(house)
    assert sales.count() == 30
    load.run_model(house)
    assert load.metrics_view(house).count() == 2
    views.register_views(sales, ["vw_kpis_mensais", "vw_pareto_produtos"])
    assert "fato_vendas" in views.register_tables(house)
    got = spark.sql("SELECT sum(pedidos) AS n, sum(faturamento) AS f FROM vw_kpis_mensais").first()
    total = spark.sql("SELECT sum(valor_total) AS f FROM fato_vendas").first()["f"]
    assert got["f"] == total and spark.sql("SELECT max(pct_acumulado) AS p FROM vw_pareto_produtos").first()["p"] == 100
    assert {r["item"] for r in house.read("load_report").filter("topic = 'reason'").collect()} == {"quantidade nao positiva"}
    published = house.path("fact_sales")
    with pytest.raises(ValueError):
        load.run_load(spark, write_csv(tmp_path / "bad.csv", rows, list(vocab.RAW_HEADERS)[:-1]), root)
    assert house.path("fact_sales") == published
    keyed = spark.read.parquet(house.path("fact_sales")).select("sale_key").orderBy("sale_key").collect()
    assert [r["sale_key"] for r in keyed] == list(range(1, 31))


def test_skewed_customer_splits_in_the_fact_join(spark):
    """A customer holding most rows is split at run time once the dimension is too large to broadcast."""
    rows = spark.range(200_000).select(
        F.concat(F.lit("T"), "id").alias("txn_id"), F.lit("O").alias("order_id"), F.current_date().alias("sale_date"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("C"), F.col("id") % 5000)).otherwise("HOT").alias("customer_id"),
        F.lit("P").alias("product"), F.lit("K").alias("category"), F.lit("X").alias("city"), F.lit("Y").alias("state"),
        F.lit("Z").alias("country"), F.lit(1).alias("quantity"), F.lit(2).cast("decimal(12,2)").alias("unit_price"),
        F.sha2(F.col("id").cast("string"), 512).alias("payment_method"), F.lit("Entregue").alias("status"),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        tables = load.star_from(rows)
        joined = rows.select("txn_id", "customer_id", "payment_method").join(tables["dim_customer"], "customer_id")
        assert joined.collect() and "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
        assert tables["fact_sales"].count() == 200_000
    finally:
        for key in settings:
            spark.conf.unset(key)
