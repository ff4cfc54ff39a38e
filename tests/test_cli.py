from conftest import sf_dir

from velocart.__main__ import main


def test_cli_runs_query_to_parquet(spark, tmp_path, capsys):
    assert main(["list"]) == 0
    assert "r5_top_customers" in capsys.readouterr().out.split()
    out = str(tmp_path / "r2")
    assert main(["run", "r2_daily_orders", "--tables", sf_dir("0.01"), "--out", out]) == 0
    assert spark.read.parquet(out).count() == 9
    # the test session is still usable: the runner only stops sessions it created
    assert spark.range(3).count() == 3


def test_cli_run_all_selected(spark, tmp_path):
    out = str(tmp_path / "all")
    assert main(["run-all", "--tables", sf_dir("0.01"), "--out", out, "--queries", "r2_daily_orders,r8_valuable"]) == 0
    assert spark.read.parquet(f"{out}/r2_daily_orders").count() == 9
    assert spark.read.parquet(f"{out}/r8_valuable").count() == 38
