import json

from trendflow.__main__ import main
from trendflow.plans.gold import read_gold


def test_quality_command_reports_missing_tables(spark, tmp_dir, capsys):
    spark.range(20).selectExpr("cast(id as string) as video_id", "'t' as title",
                               "'c' as channel_title", "id as views", "'us' as region") \
        .write.parquet(f"{tmp_dir}/clean_statistics")
    code = main(["quality", "--silver-root", tmp_dir])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert code == 2 and out["quality_passed"] is False
    failed = [r for r in out["results"] if not r["passed"]]
    assert [r["table"] for r in failed] == ["clean_reference_data"]
    assert failed[0]["check"] == "table_read"


def test_run_command_builds_gold(spark, tmp_dir, capsys):
    import os

    from test_files import REGIONS, land_flat, write_category_docs

    stats, ref = os.path.join(tmp_dir, "bs"), os.path.join(tmp_dir, "br")
    land_flat(spark, stats)
    write_category_docs(ref)
    code = main(["run", "--bronze-statistics", stats, "--bronze-reference", ref,
                 "--silver-root", os.path.join(tmp_dir, "silver"),
                 "--gold-root", os.path.join(tmp_dir, "gold"), "--regions", ",".join(REGIONS)])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert code == 0 and out["quality_passed"] is True
    assert out["gold"]["trending_analytics_rows"] > 0
    assert read_gold(spark, os.path.join(tmp_dir, "gold"), "category_analytics").count() > 0


def test_incremental_command(spark, tmp_dir, capsys):
    import os

    from pyspark.sql import functions as F

    from test_files import REGIONS, land_flat

    bronze, silver = os.path.join(tmp_dir, "b"), os.path.join(tmp_dir, "silver")
    args = ["incremental", "--bronze-statistics", bronze, "--staging", os.path.join(tmp_dir, "staging"), "--silver", silver,
            "--checkpoint", os.path.join(tmp_dir, "ckpt"), "--regions", ",".join(REGIONS)]
    land_flat(spark, bronze, F.col("l_orderkey") % 2 == 0)
    assert main(args) == 0
    first = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    rows = spark.read.parquet(silver).count()
    land_flat(spark, bronze, F.col("l_orderkey") % 2 == 1)
    assert main(args) == 0
    second = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert (first["batches"], second["batches"]) == ([0], [1])
    assert first["metrics"][0]["rows_merged"] == rows < spark.read.parquet(silver).count()
    assert main(args) == 0  # nothing new
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["batches"] == []
