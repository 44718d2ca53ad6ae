import json
import os

import pytest

from pyspark.sql import functions as F

from conftest import SF_SMALL
from trendflow.operators.cleanse import CLEAN_COLUMNS
from trendflow.plans.gold import read_gold
from trendflow.plans.orchestrate import Layout, run_all
from trendflow.plans.silver import build_silver_statistics, read_bronze_statistics, run_silver_statistics
from trendflow.sources import bronze
from trendflow.sources import tables as src

REGIONS = ["america", "asia", "europe"]


def land_flat(spark, root, order_filter=None):
    """Land the sf0.001 statistics mapping as CSV under region=<NAME>/."""
    df = src.flat_bronze_view(spark, SF_SMALL).withColumn("region", F.upper(F.trim("region")))
    if order_filter is not None:
        df = df.filter(order_filter)
    df.write.mode("append").option("header", True).partitionBy("region").csv(root)


def test_files_follow_data_not_tasks(spark, tmp_dir):
    from trendflow.sinks.parquet import write_table
    df = spark.range(4000).repartition(8).withColumn("region", F.concat(F.lit("r"), (F.col("id") % 10).cast("string")))
    write_table(df, tmp_dir)
    files = [f for _, _, names in os.walk(tmp_dir) for f in names if f.endswith(".parquet")]
    assert len(files) == 10 and spark.read.parquet(tmp_dir).count() == 4000


def test_folders_in_any_letter_case(spark, tmp_dir):
    df = spark.createDataFrame([("v", "Us"), ("w", "us"), ("x", "US"), ("y", "gb")], "video_id string, region string")
    df.coalesce(1).write.option("header", True).partitionBy("region").csv(tmp_dir, mode="append")
    assert bronze.read_flat_statistics(spark, tmp_dir, regions=["us"]).count() == 3


def write_category_docs(root):
    names = {"us": [("1", "Film"), ("2", "Autos"), ("23", "Comedy"), ("34", "Comedy")],
             "gb": [("1", "Film"), ("2", "Autos")],
             "europe": [(str(i), f"Cat{i}") for i in range(25)],
             "asia": [(str(i), f"Cat{i}") for i in range(25)],
             "america": [(str(i), f"Cat{i}") for i in range(25)]}
    for region, items in names.items():
        folder = os.path.join(root, f"region={region.upper()}")
        os.makedirs(folder, exist_ok=True)
        doc = {"kind": "list", "etag": "e", "items": [
            {"kind": "cat", "etag": "e", "id": i, "snippet": {"channelId": "c", "title": t,
                                                              "assignable": True}}
            for i, t in items]}
        with open(os.path.join(folder, f"{region}_category_id.json"), "w") as fh:
            json.dump(doc, fh, indent=1)
    with open(os.path.join(root, "no_region.json"), "w") as fh:
        json.dump({"kind": "list", "etag": "e", "items": []}, fh)
    os.makedirs(os.path.join(root, "region=fr"), exist_ok=True)
    with open(os.path.join(root, "region=fr", "broken.json"), "w") as fh:
        fh.write("{ not json")


def test_csv_multiline_quotes(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "region=US")
    os.makedirs(folder)
    header = ",".join(src.flat_bronze_view(spark, SF_SMALL).columns[:-1])
    with open(os.path.join(folder, "a.csv"), "w") as fh:
        fh.write(header + "\n")
        fh.write('v1,17.14.11,"Title, with comma","He said ""hi""",10,2017,"a\nb",100,5,1,2,,False,False,False,"multi\nline"\n')
    df = bronze.read_flat_statistics(spark, tmp_dir, regions=["us"])
    rows = build_silver_statistics(df).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.title == "Title, with comma" and r.channel_title == 'He said "hi"'
    assert r.tags == "a\nb" and r.description == "multi\nline" and r.region == "us"
    assert r._ingested_at is not None


def test_partition_pruning_in_plan(spark, tmp_dir):
    land_flat(spark, tmp_dir)
    df = read_bronze_statistics(spark, tmp_dir, "csv", regions=["asia"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    pruned = plan[plan.index("PartitionFilters"):].split("]")[0]
    assert "lower(trim(region" in pruned and "asia" in pruned  # folders in any letter case
    assert df.count() == spark.read.option("header", True).csv(os.path.join(tmp_dir, "region=ASIA")).count()
    assert {r.region for r in df.select("region").distinct().collect()} == {"ASIA"}


def test_silver_rerun_is_idempotent(spark, tmp_dir):
    bronze_dir, silver_dir = os.path.join(tmp_dir, "b"), os.path.join(tmp_dir, "s")
    land_flat(spark, bronze_dir)
    m1 = run_silver_statistics(spark, bronze_dir, silver_dir, regions=REGIONS)
    n1 = spark.read.parquet(silver_dir).count()
    m2 = run_silver_statistics(spark, bronze_dir, silver_dir, regions=REGIONS)
    assert spark.read.parquet(silver_dir).count() == n1 == m1["rows_written"] == m2["rows_written"]
    assert m1["rows_read"] >= m1["rows_written"] and m1["null_video_id"] == 0
    # a run restricted to one region leaves the other regions untouched
    run_silver_statistics(spark, bronze_dir, silver_dir, regions=["asia"])
    assert spark.read.parquet(silver_dir).count() == n1


def test_end_to_end_gate_and_rerun(spark, tmp_dir):
    layout = Layout(os.path.join(tmp_dir, "bronze_stats"), os.path.join(tmp_dir, "bronze_ref"),
                    os.path.join(tmp_dir, "silver"), os.path.join(tmp_dir, "gold"))
    land_flat(spark, layout.bronze_statistics)
    write_category_docs(layout.bronze_reference)
    res = run_all(spark, layout, regions=REGIONS)
    assert res.quality_passed, res.quality_results
    assert res.reference_summary["documents"] == 7 and res.reference_summary["failed_documents"] == 2
    assert res.gold["channel_analytics_rows"] > 0
    first = {t: sorted(map(tuple, read_gold(spark, layout.gold_root, t)
                           .drop("_aggregated_at").collect()))
             for t in ("trending_analytics", "channel_analytics", "category_analytics")}
    res2 = run_all(spark, layout, regions=REGIONS)
    for t, rows in first.items():
        again = sorted(map(tuple, read_gold(spark, layout.gold_root, t)
                           .drop("_aggregated_at").collect()))
        assert again == rows
    assert res2.gold == res.gold
    # gate: a required table that cannot be read stops Gold
    blocked = Layout(layout.bronze_statistics, layout.bronze_reference,
                     os.path.join(tmp_dir, "silver2"), os.path.join(tmp_dir, "gold2"))
    res3 = run_all(spark, blocked, regions=REGIONS,
                   dq_tables=["clean_statistics", "clean_reference_data", "absent_table"])
    assert not res3.quality_passed and res3.gold is None
    assert not os.path.exists(os.path.join(tmp_dir, "gold2"))


def test_payload_landing_roundtrip(spark, tmp_dir):
    from trendflow.operators.cleanse import flatten_api
    from trendflow.operators.envelope import attach_envelope
    from trendflow.sinks.parquet import land_payloads

    view = src.api_payload_view(spark, SF_SMALL)
    docs = view.drop("ship_day", "document_id")
    # a pull a quarter, of all documents since the last
    landed = attach_envelope(docs, F.date_trunc("quarter", F.to_timestamp("_pipeline_metadata.ingestion_timestamp")),
                             F.upper("_pipeline_metadata.region"))
    meta = landed.select("_pipeline_metadata.*").first()
    assert meta.source == "youtube_data_api_v3" and meta.video_count >= 1 and meta.region.islower()
    land_payloads(landed, tmp_dir)
    back = bronze.read_api_statistics(spark, tmp_dir, regions=None, multi_line=False)
    assert {"region", "date", "hour"} <= set(back.columns)
    flat = flatten_api(back)
    direct = flatten_api(landed)
    assert direct.count() > 0
    cols = ["video_id", "trending_date", "views", "likes", "dislikes", "region"]
    assert sorted(map(tuple, flat.select(*cols).collect())) == \
        sorted(map(tuple, direct.select(*cols).collect()))


def test_reference_landing_replaces_region(spark, tmp_dir):
    from trendflow.operators.reference import reference_rows
    from trendflow.sinks.parquet import land_reference

    nation = src.table(spark, SF_SMALL, "nation")
    region = src.table(spark, SF_SMALL, "region")
    items = F.struct(F.lit("cat").alias("kind"), F.lit("e").alias("etag"),
                     F.col("n_nationkey").cast("string").alias("id"),
                     F.struct(F.lit("c").alias("channelId"), F.col("n_name").alias("title"),
                              F.lit(True).alias("assignable")).alias("snippet"))
    docs = (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .groupBy(F.upper("r_name").alias("region"))
            .agg(F.collect_list(items).alias("items"))
            .select(F.lit("list").alias("kind"), F.lit("e").alias("etag"), "items", "region"))
    land_reference(docs, tmp_dir)
    land_reference(docs.filter(F.col("region") == "ASIA"), tmp_dir)  # replaces one region only
    back = bronze.read_category_documents(spark, tmp_dir)
    assert back.count() == 5
    rows = reference_rows(back, ["source_file", "region"])
    assert rows.count() == 25
    assert {r.region for r in rows.select("region").distinct().collect()} == \
        {"africa", "america", "asia", "europe", "middle east"}


def test_end_to_end_api_json_lane(spark, tmp_dir):
    from trendflow.operators.envelope import attach_envelope
    from trendflow.sinks.parquet import land_payloads

    layout = Layout(os.path.join(tmp_dir, "bronze_stats"), os.path.join(tmp_dir, "bronze_ref"),
                    os.path.join(tmp_dir, "silver"), os.path.join(tmp_dir, "gold"))
    view = src.api_payload_view(spark, SF_SMALL)
    landed = attach_envelope(view.drop("ship_day", "document_id"),
                             F.date_trunc("quarter", F.to_timestamp("_pipeline_metadata.ingestion_timestamp")),
                             F.upper("_pipeline_metadata.region"))
    land_payloads(landed, layout.bronze_statistics)
    write_category_docs(layout.bronze_reference)
    res = run_all(spark, layout, fmt="json", regions=REGIONS, multi_line=False)
    assert res.silver["rows_read"] == view.filter(
        F.col("_pipeline_metadata.region").isin(REGIONS)).agg(F.sum(F.size("items"))).first()[0]
    assert 0 < res.silver["rows_written"] <= res.silver["rows_read"]
    assert res.quality_passed, res.quality_results
    trending = read_gold(spark, layout.gold_root, "trending_analytics")
    assert trending.agg(F.sum("total_videos")).first()[0] == res.silver["rows_written"]
