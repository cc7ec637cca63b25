import pytest

from tests.conftest import SMALL
from tidemark.jobs import main
from tidemark.schemas import TOPICS
from tidemark.sources import exported
from workloads import stores


def test_jobs_one_after_another(spark, folder, tmp_path, capsys):
    inbox, lake = f"{folder}/inbox", f"{folder}/lake"
    for topic in TOPICS:
        spark.read.parquet(stores.topic_path(spark, SMALL, topic)).write.parquet(f"{inbox}/{topic}")
    common = ["--lake", lake, "--buckets", "4"]
    assert main(["land", *common, "--inbox", inbox], spark) == 0
    assert main(["silver", *common], spark) == 0
    assert "'inserted': 1470" in capsys.readouterr().out
    models = tmp_path / "busiest_day.sql"
    models.write_text("SELECT date_key, count(DISTINCT order_id) AS orders FROM {fact_orders} GROUP BY ALL ORDER BY 2 DESC, 1 LIMIT 1")
    shown = f"gold_{folder[-12:]}"
    gold = ["--database", shown, "--first", "2019-01-01"]
    assert main(["gold", *common, *gold, "--models", str(tmp_path)], spark) == 0
    assert spark.table(f"{shown}.busiest_day").count() == 1
    assert spark.table(f"{shown}.dim_date").count() == 2922
    # Lines and payments of deleted orders have lost their order.
    assert main(["check", *common, *gold], spark) == 1
    lines = capsys.readouterr().out.splitlines()
    assert len(lines) == 38
    assert sum(line.startswith("FAIL") for line in lines) == 2
    assert main(["export", *common, "--out", f"{folder}/out", "--files", "1"], spark) == 0
    out = exported(spark, f"{folder}/out").path("orders")
    assert out in capsys.readouterr().out
    assert len(spark.read.parquet(out).inputFiles()) == 1
    assert spark.read.parquet(out).count() == 1470
    with pytest.raises(SystemExit, match="out"):
        main(["export", *common], spark)


def test_silver_by_micro_batches(spark, folder):
    from tidemark.plans.run import read_silver

    inbox, lake = f"{folder}/inbox", f"{folder}/lake"
    for topic in TOPICS:
        spark.read.parquet(stores.topic_path(spark, SMALL, topic)).write.parquet(f"{inbox}/{topic}")
    common = ["--lake", lake, "--buckets", "4", "--limit", "2"]
    assert main(["land", *common, "--inbox", inbox], spark) == 0
    for _ in range(2):  # nothing is left for the second
        assert main(["stream", *common], spark) == 0
        tables = read_silver(spark, f"{lake}/silver", 4)
        assert tables["orders"].count() == 1470
        assert tables["clickstream"].count() == stores.silver(spark, SMALL, "clickstream").count()
