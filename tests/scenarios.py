"""Small driver tables built from listed sales, so edge cases run through the same SQL."""

import datetime as dt
import random
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq

TYPES = ["ECONOMY", "PROMO", "SMALL"]


def write_tables(folder, sales):
    """``sales``: tuples (customer, order, date, part, quantity, price, order status F/O/P)."""
    folder = Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    orders = {}
    lines = {k: [] for k in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice")}
    for i, (customer, order, day, part, quantity, price, status) in enumerate(sales):
        orders[order] = (customer, day, status)
        for name, value in zip(lines, (order, part, 1, i, float(quantity), float(price))):
            lines[name].append(value)
    parts = sorted({s[3] for s in sales}) or [0]
    people = sorted({s[0] for s in sales}) or [0]

    def save(name, **columns):
        pq.write_table(pa.table(columns), folder / f"{name}.parquet")

    whole, number = pa.int64(), pa.float64()
    kinds = {"l_quantity": number, "l_extendedprice": number, "l_linenumber": pa.int32()}
    save("lineitem", **{k: pa.array(v, kinds.get(k, whole)) for k, v in lines.items()})
    save(
        "orders",
        o_orderkey=pa.array(list(orders), whole),
        o_custkey=pa.array([o[0] for o in orders.values()], whole),
        o_orderstatus=pa.array([o[2] for o in orders.values()], pa.string()),
        o_orderdate=pa.array([dt.datetime.combine(o[1], dt.time()) for o in orders.values()], pa.timestamp("us")),
        o_orderpriority=pa.array(["1-URGENT"] * len(orders), pa.string()),
    )
    save("customer", c_custkey=pa.array(people, whole), c_nationkey=pa.array([p % 3 for p in people], pa.int32()))
    save("nation", n_nationkey=pa.array([0, 1, 2], pa.int32()), n_name=["N0", "N1", "N2"],
         n_regionkey=pa.array([0, 0, 1], pa.int32()))
    save("region", r_regionkey=pa.array([0, 1], pa.int32()), r_name=["R0", "R1"])
    save("supplier", s_suppkey=pa.array([1], whole))
    save("part", p_partkey=pa.array(parts, whole), p_name=[f"part {p // 2}" for p in parts],
         p_type=[TYPES[p % 3] for p in parts])
    return str(folder)


def day(text):
    return dt.date.fromisoformat(text)


def single_month():
    return [(c, c, day(f"2025-03-{c + 1:02d}"), c % 4, 1 + c % 3, 10.25 * (c + 1), "F") for c in range(7)]


def single_customer():
    return [(1, i, day("2024-01-31") + dt.timedelta(days=45 * i), i % 3, 2, 99.9, "O") for i in range(12)]


def gap_and_return():
    """No sales in some months, customers back after more than 90 days, edges of the window."""
    rows = [
        (1, "2024-01-31"), (1, "2024-04-30"), (1, "2024-11-05"), (2, "2024-01-01"), (2, "2024-02-29"),
        (3, "2023-12-31"), (3, "2024-04-01"), (4, "2024-02-10"), (5, "2024-11-30"), (5, "2025-02-28"),
        (2, "2024-11-30"), (4, "2024-03-31"), (6, "2023-12-02"),
    ]
    return [(c, i, day(d), i % 5, 1, 50 + i, "F") for i, (c, d) in enumerate(rows)]


def all_tied():
    return [(c, c, day("2025-05-05"), 0, 1, 10.0, "F") for c in range(23)]


def fewer_than_tiles():
    return [(c, c, day(f"2025-0{c + 1}-10"), c, 1, 5.0 * (c + 1), "F") for c in range(3)]


def short_and_long_series():
    """A series of two years ending in June, and one too short to fit."""
    rows = []
    for i in range(30):
        month = dt.date(2024 + (i // 12), i % 12 + 1, 15)
        rows.append((0, 1000 + i, month, 0, 1, 1000 + 10 * i + 300 * (i % 12 == 6), "F"))
    for i in range(8):
        rows.append((1, 2000 + i, dt.date(2025, i + 1, 3), 1, 1, 500 + i, "F"))
    for i in range(26):
        if i not in (3, 9):
            rows.append((2, 3000 + i, dt.date(2024 + (i // 12), i % 12 + 1, 20), 2, 2, 70 + i * i % 13, "O"))
    return rows


def hot_customer():
    """One customer and one price hold most rows."""
    rows = [(0, i, day("2024-01-01") + dt.timedelta(days=i % 500), 0, 1, 9.99, "F") for i in range(4000)]
    return rows + [(1 + i % 40, 10_000 + i, day("2024-01-01") + dt.timedelta(days=i % 700), i % 9, 1 + i % 4,
                    5 + i % 97, "OFP"[i % 3]) for i in range(2000)]


def shuffled(seed):
    rng = random.Random(seed)
    start = day("2023-11-20")
    orders = [(o, rng.randrange(15), start + dt.timedelta(days=int(rng.random() ** 2 * 900)), rng.choice("FFOP"))
              for o in range(120)]
    return [(c, o, d, rng.randrange(12), rng.randint(1, 4), round(rng.uniform(1, 400), 2), s)
            for o, c, d, s in orders for _ in range(rng.randint(1, 3))]


SCENARIOS = {
    "single_month": single_month, "single_customer": single_customer, "gap_and_return": gap_and_return,
    "all_tied": all_tied, "fewer_than_tiles": fewer_than_tiles, "short_and_long_series": short_and_long_series,
    "hot_customer": hot_customer, "shuffled": lambda: shuffled(1),
}
