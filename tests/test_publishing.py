"""Manifests: several writers, open readers, expiry."""

import json
import threading

import pytest

from balcao.sources.warehouse import Superseded, Warehouse


def table(house, name, value, version):
    return house.store(name, house.spark.range(value, value + 1), version)


def value(house, name):
    return house.read(name).first()[0]


def test_a_refresh_that_began_before_another_was_published_gives_up(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path))
    first = house.new_version()
    table(house, "staging", 1, first)
    assert house.publish(first, ["staging"], house.newest()) == 1
    slow, quick, base = "slow", "quick", house.newest()
    table(house, "staging", 2, slow)
    table(house, "staging", 3, quick)
    house.publish(quick, ["staging"], base)
    with pytest.raises(Superseded):
        house.publish(slow, ["staging"], base)
    assert value(house, "staging") == 3
    table(house, "fact_sales", 4, slow)
    assert house.publish(slow, ["fact_sales"], base) == 3  # another table: nothing of it changed
    assert (value(house, "staging"), value(house, "fact_sales")) == (3, 4)


def test_of_many_writers_each_gets_its_own_number(spark, tmp_path):
    house, got = Warehouse(spark, str(tmp_path)), []
    writers = [threading.Thread(target=lambda i=i, t=t: got.append(Warehouse(spark, str(tmp_path)).publish(f"v{i}", [t], None))) for i, t in
               enumerate(["staging", "quarantine", "fact_sales", "dim_customer", "dim_product", "dim_location"] * 3)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert sorted(got) == list(range(1, 19)) and len(house.versions()) == 6
    assert not [n for n in house.files.list(f"{house.root}/manifest") if n.startswith("draft")]


def test_expiry_spares_open_readers(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path))
    for i in range(4):
        table(house, "staging", i, f"v{i}")
        house.publish(f"v{i}", ["staging"])
        if i == 1:
            opened = house.reading()
            reader = opened.__enter__()
    table(house, "staging", 9, "unpublished")
    assert house.expire() == []  # all were the newest a moment ago
    gone = house.expire(grace=0)
    assert [f.rsplit("/", 1)[1] for f in gone] == ["v0", "v2"]
    assert value(reader, "staging") == 1 and value(house, "staging") == 3
    assert value(house.snapshot(), "staging") == 3
    opened.__exit__(None, None, None)
    assert [f.rsplit("/", 1)[1] for f in house.expire(grace=0)] == ["v1"]
    assert sorted(p.name for p in (tmp_path / "staging").iterdir() if p.is_dir()) == ["unpublished", "v3"]
    (tmp_path / "readers").mkdir(exist_ok=True)
    (tmp_path / "readers" / "dead").write_text(json.dumps({"manifest": 4, "until": 0}))
    table(house, "staging", 5, "v5")
    house.publish("v5", ["staging"])
    assert len(house.expire(grace=0)) == 1 and value(house, "staging") == 5


def test_nothing_published(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path))
    assert house.newest() == 0 and house.versions() == {} and house.expire() == []
    with pytest.raises(ValueError):
        house.read("staging")
