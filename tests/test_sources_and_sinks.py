import json
import uuid
from pathlib import Path
from types import SimpleNamespace

import pytest
from helpers import as_set, line, transactions
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tillroll.config import SegmentationConfig
from tillroll.plans.segmentation import run_segmentation
from tillroll.scratch import scratch_path, shared_folder
from tillroll.sinks import archive as archives
from tillroll.sinks.lists import export_segment
from tillroll.sources.transactions import conform, read_snapshot, read_transactions, stream_transactions

LIST = "customer_id int, country string, recency int, frequency bigint, monetary double, segment string"


@pytest.fixture()
def labeled(spark):
    rows = [(1, "UK", 1, 2, 9.5, "At Risk"), (2, "UK", 1, 2, 8.5, "Champions"), (3, "FR", 1, 2, 7.5, "Champions")]
    return spark.createDataFrame(rows, LIST)


CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
HEADER = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country"
ROW = "489434,0012,BALLS,12,2009-12-01 07:45:00,6.95,13085.0,United Kingdom"


def sales(folder, *lines):
    (folder / "sales.csv").write_text("\n".join(lines) + "\n")
    return str(folder)


@pytest.mark.parametrize("infer", [False, True])
def test_csv_texts_survive(spark, tmp_path, infer):
    rows = [line("1", text=None), line("2", text="  "), line("3", text='"say ""hi"", you"'), line("4", text='say "hi", then\nleave')]
    df = transactions(spark, rows)
    df.write.options(**CSV).csv(f"{tmp_path}/csv")
    assert as_set(read_transactions(spark, f"{tmp_path}/csv", "csv", infer=infer, multi_line=True)) == as_set(df)
    df.filter("invoice <> '4'").write.options(**CSV).csv(f"{tmp_path}/plain")
    assert as_set(read_transactions(spark, f"{tmp_path}/plain", "csv", infer=infer)) == as_set(df.filter("invoice <> '4'"))


@pytest.mark.parametrize("infer", [False, True])
def test_csv_columns_are_found_by_header(spark, tmp_path, infer):
    names, values = HEADER.split(","), ROW.split(",")
    path = sales(tmp_path, ",".join([names[-1], *names[:-1]]), ",".join([values[-1], *values[:-1]]))
    row = read_transactions(spark, path, "csv", infer=infer).first()
    assert (row.invoice, row.stock_code, row.country, row.quantity) == ("489434", "0012", "United Kingdom", 12)


@pytest.mark.parametrize("infer", [False, True])
def test_csv_without_a_declared_column_is_refused(spark, tmp_path, infer):
    path = sales(tmp_path, HEADER.replace("Quantity", "Qty"), ROW)
    with pytest.raises(ValueError, match="quantity"):
        read_transactions(spark, path, "csv", infer=infer)


def test_csv_with_a_malformed_value_or_broken_line_stops(spark, tmp_path):
    for k, bad in enumerate((ROW.replace(",12,", ",12x,"), ROW.replace("BALLS", '"BALLS\nand more"'))):
        (tmp_path / str(k)).mkdir()
        with pytest.raises(Exception, match="(?i)malformed"):
            read_transactions(spark, sales(tmp_path / str(k), HEADER, bad), "csv").collect()


def test_stream_reads_the_same_csv(spark, tmp_path):
    (tmp_path / "in").mkdir()
    sales(tmp_path / "in", HEADER, ROW.replace("BALLS", '"say ""hi"", you"'))
    stream = stream_transactions(spark, f"{tmp_path}/in", headers=HEADER.split(","))
    stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c").option("path", f"{tmp_path}/out").trigger(
        availableNow=True
    ).start().awaitTermination()
    assert as_set(spark.read.parquet(f"{tmp_path}/out")) == as_set(read_transactions(spark, f"{tmp_path}/in", "csv"))
    assert spark.read.parquet(f"{tmp_path}/out").first().description == 'say "hi", you'
    with pytest.raises(ValueError, match="country"):
        stream_transactions(spark, f"{tmp_path}/in", headers=HEADER.split(",")[:-1])


def test_read_several_files_and_repartition(spark, tmp_path, small_tx):
    small_tx.filter("quantity > 10").write.parquet(f"{tmp_path}/a")
    small_tx.filter("quantity <= 10").write.parquet(f"{tmp_path}/b")
    back = read_transactions(spark, [f"{tmp_path}/a", f"{tmp_path}/b"], partitions=5)
    assert back.rdd.getNumPartitions() == 5
    assert back.count() == small_tx.count()


def test_unknown_format(spark):
    with pytest.raises(ValueError):
        read_transactions(spark, "x", "xlsx")


def test_workbook_headers(spark, tmp_path):
    text = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
    text += "489434,85048,BALLS,12,2009-12-01 07:45:00,6.95,13085.0,United Kingdom\n"
    (tmp_path / "sales.csv").write_text(text)
    declared = read_transactions(spark, str(tmp_path), "csv")
    inferred = read_transactions(spark, str(tmp_path), "csv", infer=True)
    assert declared.schema == inferred.schema
    assert as_set(declared) == as_set(inferred)
    assert declared.first().customer_id == 13085.0


def test_conform_keeps_order_of_the_declared_columns(spark):
    df = transactions(spark, [line()])
    turned = conform(df.select(*reversed(df.columns)).withColumn("price", F.lit(1)))
    assert turned.dtypes == df.dtypes
    with pytest.raises(ValueError, match="price, country"):
        conform(df.drop("country", "price"))


def test_export_reports_counts_of_the_same_pass(spark, tmp_path, labeled):
    report = export_segment(labeled, "Champions", f"{tmp_path}/out")
    assert (report.exported, report.customers) == (2, 3)
    assert round(report.coverage_pct, 1) == 66.7
    assert {r[0] for r in as_set(spark.read.schema(LIST).csv(f"{tmp_path}/out", header=True))} == {2, 3}


def test_export_of_an_empty_segment(spark, tmp_path, labeled):
    report = export_segment(labeled, "Lost", f"{tmp_path}/out")
    assert report.exported == 0 and report.coverage_pct == 0.0


def test_snapshot_and_segment_folders(spark, tmp_path, labeled):
    archives.archive(labeled, str(tmp_path), "labeled", "r1")
    assert as_set(read_snapshot(spark, str(tmp_path), "labeled", "r1")) == as_set(labeled)
    archives.archive_by_segment(labeled, f"{tmp_path}/segments")
    assert {p.name for p in Path(f"{tmp_path}/segments").glob("segment_slug=*")} == {
        "segment_slug=at_risk",
        "segment_slug=champions",
    }
    one = spark.read.parquet(f"{tmp_path}/segments").filter("segment_slug = 'at_risk'")
    assert "PartitionFilters: [isnotnull(segment_slug" in one._jdf.queryExecution().executedPlan().toString()
    assert one.first().customer_id == 1


def test_scratch_uses_the_configured_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_folder(spark) == configured.rstrip("/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def cluster_session(spark, conf, written=lambda rows: rows):
    """The test session as a cluster's; ``written`` stands for what the driver finds of the rows that tasks write."""
    context = SimpleNamespace(
        master="spark://cluster:7077", applicationId=uuid.uuid4().hex, defaultParallelism=3, getCheckpointDir=lambda: None
    )
    return SimpleNamespace(
        sparkContext=context, conf=SimpleNamespace(get=lambda key, default=None: conf.get(key, default)),
        _jvm=spark._jvm, _jsc=spark._jsc, range=lambda *bounds: written(spark.range(*bounds)),
    )


@pytest.mark.parametrize("scheme", ["", "file:"])
@pytest.mark.parametrize("key", ["spark.checkpoint.dir", "spark.sql.warehouse.dir"])
def test_scratch_of_a_cluster_is_any_folder_that_its_nodes_share(spark, tmp_path, key, scheme):
    folder = f"{scheme}{tmp_path}"
    session = cluster_session(spark, {key: f"{folder}/"})
    assert shared_folder(session) == folder and not list(tmp_path.iterdir())
    path = scratch_path(session, "rows")
    spark.range(7).write.parquet(path)
    assert path.startswith(folder) and spark.read.parquet(path).count() == 7


@pytest.mark.parametrize("scheme", ["", "file:"])
def test_scratch_of_a_cluster_is_no_folder_of_each_machine(spark, tmp_path, scheme):
    session = cluster_session(spark, {"spark.checkpoint.dir": f"{scheme}{tmp_path}"}, lambda rows: rows.filter("id % 3 = 0"))
    with pytest.raises(RuntimeError, match="4 of 12 files"):
        shared_folder(session)
    assert not list(tmp_path.iterdir())


def test_whole_job(spark, tmp_path, small_tx):
    small_tx.write.parquet(f"{tmp_path}/raw")
    config = SegmentationConfig(
        source=f"{tmp_path}/raw",
        source_format="parquet",
        archive_dir=f"{tmp_path}/archive",
        export_dir=f"{tmp_path}/out",
        k_range=(2, 3),
        sweep_parallelism=2,
    )
    report = run_segmentation(spark, config, run_id="t")
    assert report.counts["total_raw_rows"] == 6079
    assert report.counts["cleaned_rows"] == 4403
    assert report.counts["rfm_customers"] == 112
    assert report.best_k in (2, 3)
    assert -1.0 <= report.test_silhouette <= 1.0

    record = json.loads(next(Path(f"{tmp_path}/archive/pipeline_metadata_t").glob("part-*.json")).read_text())
    assert record == {"timestamp": "t", **report.counts, "best_k": report.best_k}
    champions = read_transactions_list(spark, f"{tmp_path}/out/champions_t")
    assert champions.count() == report.exports[0].exported > 0
    model = PipelineModel.load(f"{tmp_path}/archive/model_t")
    rescored = model.transform(read_snapshot(spark, f"{tmp_path}/archive", "rfm_features", "t"))
    assert rescored.count() == report.labeled.count()
    assert spark.read.parquet(f"{tmp_path}/archive/segments_t").count() == report.counts["final_customers"]


def read_transactions_list(spark, path):
    return spark.read.schema(LIST).csv(path, header=True).filter(F.col("segment") == "Champions")
