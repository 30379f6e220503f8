"""The command line, on files."""

from tidelake.jobs import arguments, run
from tidelake.plans.pipeline import Lakehouse
from tidelake.schemas import ENTITIES


def test_exports_to_reports(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "orders.csv").write_text("h\no1,c1,delivered,2018-01-15 14:30:00,2018-01-15 15:00:00,,2018-01-22 10:00:00,2018-01-25\n")
    (tmp_path / "in" / "sellers.csv").write_text("h\ns1,01001,sao paulo,SP\n")
    (tmp_path / "in" / "category_translations.csv").write_text("h\nx,y\n")
    root = ["--root", f"{tmp_path}/lake", "--buckets", "2"]
    run(spark, arguments(["init-tables", *root]))
    run(spark, arguments(["load-files", *root, "--folder", f"{tmp_path}/in"]))
    run(spark, arguments(["merge", *root, "--refresh"]))
    lake = Lakehouse(spark, f"{tmp_path}/lake", 2)
    assert lake.state("orders").first().status == "delivered" and lake.state("sellers").count() == 1
    assert lake.reports()["order_funnel"].first().delivered == 1
    # the names queries use hold the data, and see what is merged later
    counts = "SELECT (SELECT count(*) FROM silver.orders), (SELECT count(*) FROM bronze.orders), (SELECT sum(delivered) FROM gold.order_funnel)"
    assert tuple(spark.sql(counts).first()) == (1, 1, 1)
    assert tuple(spark.sql("SELECT order_id, status FROM silver.orders").first()) == ("o1", "delivered")
    (tmp_path / "in" / "orders.csv").write_text("h\no2,c1,shipped,2018-01-16 14:30:00,2018-01-16 15:00:00,,,2018-01-26\n")
    run(spark, arguments(["load-files", *root, "--folder", f"{tmp_path}/in"]))
    run(spark, arguments(["follow", *root, "--checkpoint", f"{tmp_path}/cp", "--once"]))
    assert tuple(spark.sql(counts).first()) == (2, 2, 1)
    assert spark.sql("SELECT count(*) FROM silver.orders WHERE purchased_at_month = DATE'2018-01-01'").first()[0] == lake.state("orders").count() == 2
    assert {t.name: t.tableType for t in spark.catalog.listTables("silver") if not t.isTemporary} == dict.fromkeys(ENTITIES, "EXTERNAL")  # tables, not views
    run(spark, arguments(["rebuild", *root]))
    run(spark, arguments(["refresh", *root]))
    assert lake.state("orders").count() == 2
    assert all(lake.state(name).isEmpty() for name in ENTITIES if name not in ("orders", "sellers"))


def test_options():
    args = arguments(["ingest", "--root", "r", "--servers", "b:9092", "--checkpoint", "c"])
    assert (args.every, args.max_records, args.topic_prefix) == ("30 seconds", None, "shop.public")
    merge = arguments(["merge", "--root", "r", "--no-late-guard", "--delete-keeps-target"])
    assert (merge.no_late_guard, merge.delete_keeps_target) == (True, True)
    assert arguments(["merge", "--root", "r", "--watermark", "2024-01-01T00:00:00"]).watermark.year == 2024
