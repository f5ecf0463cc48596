from __future__ import annotations

import pytest

from shiplake.plans import refresh
from shiplake.sources import readers

ORDERS = [
    "Order Item Id,Order Id,order date (DateOrders),Days for shipping (real),Days for shipment (scheduled),"
    "Late_delivery_risk,Sales,Order Profit Per Order,Order Region,Market",
    "1,10,1/31/2018 22:56,3,4,0,327.75,91.25,South of  USA ,USCA",
    "2,10,2/1/2018 0:05,6,4,1,100.5,-3.999,South of USA,USCA",
    "3,11,2/1/2018 7:00,2,2,0,10,1, Europe West,Europe",
]
DIMENSIONS = {
    "dim_warehouse": ["warehouse_id,warehouse_name,region,capacity_units", "WH001,South,South of USA ,10", "WH002,West,Europe West,20"],
    "dim_carrier": ["carrier_id,carrier_name,service_type", "CARR001,One,Express", "CARR002,Two,Standard"],
    "dim_route": ["route_id,origin_market,destination_region", "RT001,USCA,South of USA", "RT002,Europe,Europe West"],
    "dim_date": [
        "date_key,full_date,day,month,quarter,year,day_of_week,is_weekend",
        "20180131,2018-01-31,31,1,1,2018,Wednesday,False", "20180201,2018-02-01,1,2,1,2018,Thursday,False",
    ],
}


@pytest.fixture
def files(tmp_path):
    def write(name, lines):
        path = tmp_path / f"{name}.csv"
        path.write_bytes("\n".join(lines).encode("latin-1"))
        return str(path)

    return write("orders", ORDERS), {name: write(name, lines) for name, lines in DIMENSIONS.items()}


def test_refresh_publishes_and_repeats(spark, files, tmp_path):
    orders, dims = files
    store = refresh.refresh_fact(spark, orders, dims, str(tmp_path / "lake"))
    first = sorted(store.read().collect())
    assert [(r["shipment_id"], r["warehouse_key"], r["route_key"], r["delay_hours"]) for r in first] == [
        ("1", "WH001", "RT001", -24), ("2", "WH001", "RT001", 48), ("3", "WH002", "RT002", 0),
    ]
    again = refresh.refresh_fact(spark, orders, dims, str(tmp_path / "lake"))
    assert again.version() == 2 and sorted(again.read().collect()) == first
    assert readers.layout_report(readers.read_curated(spark, str(tmp_path / "lake/curated/fact_shipment"))).first()["partitions"] == 3
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        refresh.refresh_fact(spark, orders, dims, str(tmp_path / "lake"), mode="errorifexists")


def test_refresh_does_not_publish_what_fails_the_checks(spark, files, tmp_path):
    orders, dims = files
    refresh.refresh_fact(spark, orders, dims, str(tmp_path / "lake"))
    lost = tmp_path / "lost.csv"
    lost.write_text("\n".join([*ORDERS, "4,12,2/1/2018 7:00,2,2,0,10,1,Atlantis,Europe"]))
    with pytest.raises(RuntimeError, match="required keys not null"):
        refresh.refresh_fact(spark, str(lost), dims, str(tmp_path / "lake"))
    with pytest.raises(RuntimeError, match="row count"):
        refresh.refresh_fact(spark, orders, dims, str(tmp_path / "lake"), expected_rows=180519)
    store = refresh.fact_store(spark, str(tmp_path / "lake"))
    assert store.version() == 1 and store.read().count() == 3
