"""Incremental Silver: merged deliveries against a whole recompute."""

import os

import pytest
from pyspark.sql import functions as F

from test_files import REGIONS, land_flat
from trendflow.catalog import land_flat_delivery
from trendflow.config import SILVER_PARTITIONS
from trendflow.operators.cleanse import CLEAN_COLUMNS
from trendflow.plans.silver import build_silver_statistics, read_bronze_statistics, run_silver_statistics
from trendflow.session import TIDY, tidy_shuffles
from trendflow.sinks import files
from trendflow.streaming import incremental as inc

COLUMNS = [c for c in CLEAN_COLUMNS if c != "_ingested_at"]


def rows_of(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=repr)


class Lane:
    def __init__(self, spark, root):
        self.spark = spark
        self.bronze, self.staging, self.silver, self.checkpoint = (os.path.join(root, x) for x in ("bronze", "staging", "silver", "ckpt"))

    def run(self, **options):
        return inc.incremental_silver(self.spark, self.bronze, self.staging, self.silver, self.checkpoint, regions=REGIONS, **options)

    def stored(self):
        return rows_of(self.spark.read.parquet(self.silver))

    def recomputed(self):
        return rows_of(build_silver_statistics(read_bronze_statistics(self.spark, self.bronze, "csv", REGIONS)))


@pytest.fixture()
def lane(spark, tmp_dir):
    return Lane(spark, tmp_dir)


def test_deliveries_equal_a_recompute(spark, lane):
    land_flat(spark, lane.bronze, F.col("l_orderkey") % 2 == 0)
    first = lane.run()
    assert first["partitions"] and first["metrics"][0]["rows_read"] > first["metrics"][0]["rows_merged"] > 0
    assert lane.run()["partitions"] == []  # nothing new
    land_flat(spark, lane.bronze, F.col("l_orderkey") % 2 == 1)
    land_flat(spark, lane.bronze, F.col("l_orderkey") % 5 == 0)  # delivered again
    lane.run()
    assert lane.stored() == lane.recomputed()
    # audit stamps of rows that stayed are those of their own run
    assert spark.read.parquet(lane.silver).select("_processed_at").distinct().count() == 2
    # staging holds the newest batch only, the manifest all
    stream = next(n for n in os.listdir(lane.staging) if n != "manifest")
    assert os.listdir(os.path.join(lane.staging, stream)) == ["batch=1"]
    manifest = inc.read_manifest(spark, lane.staging)
    assert {r.batch for r in manifest.select("batch").distinct().collect()} == {0, 1}
    whole = {tuple(r) for r in manifest.select(*SILVER_PARTITIONS).distinct().collect()}
    assert whole == {tuple(r) for r in spark.read.parquet(lane.silver).select(*SILVER_PARTITIONS).distinct().collect()}


def test_one_file_at_a_time(spark, lane):
    land_flat(spark, lane.bronze, F.col("l_orderkey") % 2 == 0)
    land_flat(spark, lane.bronze, F.col("l_orderkey") % 2 == 1)
    out = lane.run(max_files_per_batch=4)
    assert len(out["batches"]) > 1 and lane.stored() == lane.recomputed()


def test_only_touched_folders_are_read(spark, lane):
    land_flat(spark, lane.bronze)
    lane.run()
    schema = spark.read.parquet(lane.silver).schema
    touched = [("asia", 199501), ("europe", 199603), ("asia", 205001), (None, None)]  # two of them do not exist
    stored = files.read_partitions(spark, lane.silver, SILVER_PARTITIONS, touched, schema)
    folders = {os.path.relpath(os.path.dirname(p.removeprefix("file://")), lane.silver) for p in stored.inputFiles()}
    assert folders == {"region=asia/trending_month=199501", "region=europe/trending_month=199603"}
    assert {tuple(r) for r in stored.select(*SILVER_PARTITIONS).distinct().collect()} == set(touched[:2])
    merged = inc.merged_rows(spark, stored.inputFiles()[0], lane.silver, schema, touched)
    assert {f for f in merged.inputFiles() if "/region=" in f} == set(stored.inputFiles())


def test_untouched_folders_keep_their_files(spark, lane):
    land_flat(spark, lane.bronze)
    lane.run()
    before = {n: os.listdir(os.path.join(lane.silver, "region=asia", n)) for n in os.listdir(os.path.join(lane.silver, "region=asia"))}
    land_flat(spark, lane.bronze, (F.col("l_shipdate") >= "1995-02-01") & (F.col("l_shipdate") < "1995-03-01"))
    out = lane.run()
    assert {m for _, m in out["partitions"]} == {199502}
    after = {n: os.listdir(os.path.join(lane.silver, "region=asia", n)) for n in before}
    assert [n for n in before if before[n] != after[n]] == ["trending_month=199502"]


@pytest.mark.parametrize("where", ["merge_batch", "publish", "fold_manifest"])
def test_stopped_run_is_taken_up(spark, lane, monkeypatch, where):
    land_flat(spark, lane.bronze, F.col("l_orderkey") % 2 == 0)
    lane.run()
    land_flat(spark, lane.bronze, F.col("l_orderkey") % 2 == 1)

    def stopped(*_):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as m:
        m.setattr(inc, where, stopped)
        with pytest.raises(Exception, match="lost driver"):
            lane.run()
    if where == "publish":  # merged already: the batch is not read again
        monkeypatch.setattr(inc, "merge_batch", stopped)
    assert lane.run()["batches"] == [1]
    assert lane.stored() == lane.recomputed()


def test_full_run_and_increments_share_a_table(spark, lane):
    land_flat(spark, lane.bronze, F.col("l_orderkey") % 2 == 0)
    run_silver_statistics(spark, lane.bronze, lane.silver, regions=REGIONS)
    land_flat(spark, lane.bronze, F.col("l_orderkey") % 2 == 1)
    lane.run()
    assert lane.stored() == lane.recomputed()
    # a full run removes months that a region has no rows of any more
    extra = os.path.join(lane.silver, "region=asia", "trending_month=190001")
    os.makedirs(extra)
    run_silver_statistics(spark, lane.bronze, lane.silver, regions=["asia"])
    assert not os.path.exists(extra) and lane.stored() == lane.recomputed()


def test_manifest_is_folded(spark, tmp_dir):
    for batch in range(12):
        text = '{"stream": "s", "batch": %d, "folders": [{"region": "a", "trending_month": %d}], "rows_read": 1, "rows_staged": 1, "rows_merged": 1}\n'
        files.replace_text(spark, inc._entry_path(tmp_dir, "s", batch), text % (batch, 200001 + batch))
        inc.fold_manifest(spark, tmp_dir, fold=5)
    assert len([n for n in os.listdir(f"{tmp_dir}/manifest") if n.endswith(".json") and not n.startswith(".")]) <= 2 + 5
    assert inc.read_manifest(spark, tmp_dir).count() == 12
    assert inc.touched_since(spark, tmp_dir, {"s": 9}) == ([("a", 200011), ("a", 200012)], {"s": 11})
    assert inc.touched_since(spark, tmp_dir + "/absent", {}) == ([], {})


def test_region_filter_reaches_the_stream(spark, lane):
    land_flat(spark, lane.bronze)
    out = lane.run()
    assert {r for r, _ in out["partitions"]} == set(REGIONS)
    others = spark.read.option("header", True).option("multiLine", True).csv(lane.bronze)
    assert out["metrics"][0]["rows_read"] == others.where(F.lower("region").isin(REGIONS)).count() < others.count()


def test_delivery_without_wanted_regions(spark, lane):
    land_flat(spark, lane.bronze, F.col("r_name") == "AFRICA")
    out = lane.run()
    assert out["partitions"] == [] and out["metrics"][0]["rows_merged"] == 0


@pytest.mark.parametrize("value", ["middle east", "a/b", "x=y", "50%", "q?*", "tab\there", "", None, "ü"])
def test_folder_names_are_those_of_spark(spark, tmp_dir, value):
    spark.createDataFrame([(1, value)], "id int, region string").write.mode("overwrite").partitionBy("region").parquet(tmp_dir)
    assert files.folder_name("region", value) in os.listdir(tmp_dir)


def test_text_files(spark, tmp_dir):
    path = f"{tmp_dir}/deep/state.json"
    assert files.read_text(spark, path) is None and files.children(spark, f"{tmp_dir}/absent") == []
    for text in ("one", "twö\n", ""):
        files.replace_text(spark, path, text)
        assert files.read_text(spark, path) == text
    files.delete(spark, f"{tmp_dir}/deep")
    assert not files.exists(spark, path)


def test_merge_does_not_shuffle_derived_columns(spark, lane):
    land_flat(spark, lane.bronze)
    lane.run()
    stored = spark.read.parquet(lane.silver)
    incoming = os.path.join(lane.staging, "incoming")
    stored.where("region = 'asia'").write.parquet(incoming)
    merged = inc.merged_rows(spark, incoming, lane.silver, stored.schema, [("asia", None)])
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    window = next(line for line in plan.splitlines() if "Window [row_number()" in line)
    sent = [line for line in plan[plan.index(window):].splitlines() if "Project [" in line]  # what is read below lists all columns
    assert sent and not [line for line in sent if "like_ratio" in line]
    assert rows_of(merged) == rows_of(stored.where("region = 'asia'"))


def shuffle_files(spark):
    """Shuffle files that the session holds on its disks."""
    found = set()
    for top in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString():
        for root, _, names in os.walk(top):
            found |= {os.path.join(root, n) for n in names if n.startswith("shuffle_")}
    return found


def test_run_leaves_no_shuffle_files(spark, lane):
    land_flat(spark, lane.bronze)
    before = shuffle_files(spark)
    own = spark.conf.get(TIDY, None)
    lane.run()
    assert not shuffle_files(spark) - before and spark.conf.get(TIDY, None) == own


def test_writes_side_by_side_keep_the_setting(spark):
    own = spark.conf.get(TIDY, None)
    first, second = tidy_shuffles(spark), tidy_shuffles(spark)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(TIDY) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(TIDY, None) == own


@pytest.mark.parametrize("most", [2, 7])  # regions together, and regions by months
def test_merge_in_rounds(spark, lane, monkeypatch, most):
    monkeypatch.setattr(files, "ROUND_BYTES", 1)
    monkeypatch.setattr(files, "MAX_ROUNDS", most)
    dealt, real = [], inc.merge_rounds

    def noted(*args):
        dealt.append(real(*args))
        return dealt[-1]

    monkeypatch.setattr(inc, "merge_rounds", noted)
    for keep in (F.col("l_orderkey") % 3 > 0, F.col("l_orderkey") % 2 == 1):
        land_flat(spark, lane.bronze, keep)
        out = lane.run()
        assert len(dealt[-1]) > 1
        assert sorted((f for some, _ in dealt[-1] for f in some), key=repr) == out["partitions"]
    assert lane.stored() == lane.recomputed()
    silver = spark.read.parquet(lane.silver).select(*SILVER_PARTITIONS).collect()
    assert out["metrics"][0]["rows_merged"] == len([r for r in silver if tuple(r) in set(out["partitions"])])
    stream = next(n for n in os.listdir(lane.staging) if n != "manifest")
    assert not [n for _, _, names in os.walk(os.path.join(lane.staging, stream)) for n in names if n.endswith(".parquet")]


def test_rounds_with_no_region_or_day(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(files, "ROUND_BYTES", 1)
    batch = spark.createDataFrame(
        [(f"v{i}", day, region) for i in range(3) for day in ("2024-01-02", "2024-02-02", "junk") for region in ("us", "", None, "a/b")],
        "video_id string, trending_date string, region string")
    home, silver = f"{tmp_dir}/home", f"{tmp_dir}/silver"
    for n in range(2):
        entry = inc.merge_batch(spark, batch, home, silver)
        assert (entry["rows_read"], entry["rows_staged"]) == (36, 36) and len(entry["folders"]) == 12
        inc.publish(spark, home, silver, entry)
        inc.publish(spark, home, silver, entry)  # repeated by a run that was stopped before its commit
        got = spark.read.parquet(silver)
        want = {(f"v{i}", day, r or None) for i in range(3) for day in ("2024-01-02", "2024-02-02", "junk") for r in ("us", "", None, "a/b")}
        assert {tuple(r) for r in got.select("video_id", "trending_date", "region").collect()} == want


def test_folders_are_moved_once_more(spark, tmp_dir):
    rows = [(1, "us", 202401), (2, "us", None), (3, None, 202401)]
    for at, n in (("old", 10), ("new", 20)):
        spark.createDataFrame([(i + n, r, m) for i, r, m in rows], "id int, region string, trending_month int") \
            .write.partitionBy(*SILVER_PARTITIONS).parquet(f"{tmp_dir}/{at}")
    keys = [(r, m) for _, r, m in rows]
    files.move_partitions(spark, f"{tmp_dir}/new", f"{tmp_dir}/old", SILVER_PARTITIONS, keys[:1])  # and stopped there
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_dir}/old").collect()) == [12, 13, 21]
    files.move_partitions(spark, f"{tmp_dir}/new", f"{tmp_dir}/old", SILVER_PARTITIONS, keys)
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_dir}/old").collect()) == [21, 22, 23]


def test_landed_deliveries_are_compressed(spark, tmp_dir):
    land_flat_delivery(spark, "/root/testdata/sf0.001", tmp_dir, F.col("l_orderkey") % 2 == 0)
    names = [n for _, _, found in os.walk(tmp_dir) for n in found if n.startswith("part-")]
    assert names and all(n.endswith(".csv.gz") for n in names)
