from datetime import datetime

import pytest
from conftest import SMALL
from helpers import as_set, line, transactions
from pyspark.sql import functions as F

from tillroll.plans.segmentation import fit_and_label
from tillroll.operators.features import build_rfm, clean
from tillroll.operators.segments import export_rows, label_clusters
from tillroll.sinks import pointer
from tillroll.sinks.pointer import published
from tillroll.sources.transactions import stream_transactions
from tillroll.streaming import revenue
from tillroll.streaming.customer_state import FOLDERS_PER_BUCKET, LINES, TOTALS, absorb, customer_state, rfm_of_state
from tillroll.streaming.live_segments import follow_top_segment

AMOUNT = "quantity * price"


def per_day(df, late_by=None):
    return revenue.daily_revenue(df, "customer_id", "invoice_date", F.expr(AMOUNT), late_by)


def drop_in(df, folder):
    """Add files to a watched folder, as a new arrival."""
    df.coalesce(1).write.mode("append").csv(folder, header=True)


def test_stream_equals_batch_over_two_arrivals(spark, tmp_path):
    first = transactions(spark, [line("1", price=2.0), line("2", customer=None), line("3", when="2011-01-02T23:59:59")])
    second = transactions(spark, [line("4", price=5.5), line("5", customer=2.0)])
    folder, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"
    for arrival in (first, second):
        drop_in(arrival, folder)
        revenue.write_complete(per_day(stream_transactions(spark, folder)), out, state).awaitTermination()
    found = as_set(spark.read.parquet(published(spark, out)))
    assert found == as_set(per_day(first.unionByName(second)))
    assert (1.0, datetime(2011, 1, 1), datetime(2011, 1, 2), 7.5) in found


def test_closed_days_leave_late_rows_out(spark, tmp_path):
    folder, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"

    def run():
        revenue.write_closed_days(per_day(stream_transactions(spark, folder), "1 day"), out, state).awaitTermination()

    drop_in(transactions(spark, [line("1", when="2011-01-01"), line("2", when="2011-01-05")]), folder)
    run()
    assert {r[1] for r in as_set(spark.read.parquet(out))} == {datetime(2011, 1, 1)}
    drop_in(transactions(spark, [line("3", when="2011-01-01", price=99.0), line("4", when="2011-01-08")]), folder)
    run()
    assert {(r[1], r[3]) for r in as_set(spark.read.parquet(out))} == {
        (datetime(2011, 1, 1), 2.0),
        (datetime(2011, 1, 5), 2.0),
    }


def test_console_sink_runs(spark, tmp_path):
    folder = f"{tmp_path}/in"
    drop_in(transactions(spark, [line("1")]), folder)
    query = revenue.write_console(per_day(stream_transactions(spark, folder)), f"{tmp_path}/state")
    query.awaitTermination()
    assert query.exception() is None


@pytest.fixture(scope="module")
def model_path(spark, small_rfm, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("model") / "m")
    fit_and_label(small_rfm, k=3)[1].write().save(path)
    return path


def test_live_top_segment_equals_batch(spark, tmp_path, small_tx, model_path):
    from pyspark.ml import PipelineModel

    halves = [small_tx.filter("length(stock_code) % 2 = 0"), small_tx.filter("length(stock_code) % 2 = 1")]
    out = f"{tmp_path}/champions"
    for half in halves:
        half.drop("description").withColumn("description", F.lit("x")).select(*small_tx.columns).coalesce(1).write.mode(
            "append"
        ).csv(f"{tmp_path}/in", header=True)
        follow_top_segment(
            stream_transactions(spark, f"{tmp_path}/in"), f"{tmp_path}/history", model_path, out, f"{tmp_path}/state"
        ).awaitTermination()
    rfm = build_rfm(clean(small_tx.withColumn("description", F.lit("x"))))
    expected = export_rows(label_clusters(PipelineModel.load(model_path).transform(rfm)), "Champions")
    found = spark.read.schema(expected.schema).csv(published(spark, out), header=True)
    assert as_set(found) == as_set(expected)
    assert found.count() > 0


def test_live_list_keeps_saved_names_and_fences(spark, tmp_path, small_tx, small_rfm):
    from tillroll.operators.outliers import fences, within
    from tillroll.sinks.archive import write_rules

    bounds = fences(small_rfm, 0.5)
    labeled, model, _ = fit_and_label(within(small_rfm, bounds), k=3)
    model.write().save(f"{tmp_path}/model")
    write_rules(labeled, bounds, f"{tmp_path}/rules")
    rows = small_tx.withColumn("description", F.lit("x"))
    for half in (rows.filter("quantity % 2 = 0"), rows.filter("quantity % 2 <> 0")):
        drop_in(half, f"{tmp_path}/in")
        follow_top_segment(
            stream_transactions(spark, f"{tmp_path}/in"), f"{tmp_path}/history", f"{tmp_path}/model", f"{tmp_path}/list",
            f"{tmp_path}/state", rules_path=f"{tmp_path}/rules",
        ).awaitTermination()
    names = labeled.select("prediction", "segment").distinct()
    batch = within(build_rfm(clean(rows)), bounds)
    expected = export_rows(model.transform(batch).join(names, "prediction"), "Champions")
    found = spark.read.schema(expected.schema).csv(published(spark, f"{tmp_path}/list"), header=True)
    assert as_set(found) == as_set(expected) and found.count() > 0
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("list.")]


def test_registered_stream_reads_the_given_events(spark):
    import __spark_entry__ as entry

    batch = entry.queries()["daily_revenue_window"](spark, SMALL)
    assert as_set(entry.queries()["stream_daily_revenue"](spark, SMALL)) == as_set(batch)


def folders(path, part, number):
    return {p.name for p in (path / part / f"change={number:020d}").glob("bucket=*")}


def test_a_batch_of_one_customer_rewrites_one_bucket(spark, tmp_path):
    state = customer_state(spark, str(tmp_path), buckets=16)
    everyone = [line(str(c), customer=float(c), when=f"2011-01-{1 + c % 28:02}") for c in range(1, 60)]
    absorb(state, transactions(spark, everyone), 0)
    assert len(folders(tmp_path, TOTALS, 0)) > 10
    before = {p: p.stat().st_mtime_ns for p in tmp_path.glob("*/change*/bucket*/*.parquet")}
    one = [line("7", customer=7.0, when="2011-01-08", price=3.0), line("900", customer=7.0, when="2011-02-01")]
    absorb(state, transactions(spark, [*one, *one, everyone[6], line(customer=None), line(customer=float("nan"))]), 1)
    assert len(folders(tmp_path, TOTALS, 1)) == len(folders(tmp_path, LINES, 1)) == 1
    assert all(p.stat().st_mtime_ns == t for p, t in before.items() if p.exists())
    assert as_set(rfm_of_state(state)) == as_set(build_rfm(clean(transactions(spark, everyone + one))))


def test_state_equals_batch_over_many_batches(spark, tmp_path):
    """Repeated lines, invoices over several batches, batches that run twice, lines put into one folder."""
    state = customer_state(spark, str(tmp_path), buckets=2)
    batches, sent = FOLDERS_PER_BUCKET + 2, []
    for number in range(batches):
        rows = [line(str(i % 5), stock=str((i * number) % 4), customer=float(i % 3 + 1), when=f"2011-01-{1 + number:02}") for i in range(8)]
        rows += [line("shared", stock=str(number), customer=1.0), line("x", quantity=0), line("y", price=-1.0)] + sent[:3]
        sent += rows
        for _ in range(2):
            absorb(state, transactions(spark, rows), number)
    expected = as_set(build_rfm(clean(transactions(spark, sent))))
    assert as_set(rfm_of_state(state)) == expected and state.last_change() == batches - 1
    assert all(len(changes) <= FOLDERS_PER_BUCKET for changes in state.changes_of(LINES).values())
    # What a stopped batch has left is not read, and the batch takes its place when it runs again.
    transactions(spark, [line("z")]).write.parquet(f"{tmp_path}/{TOTALS}/change={batches:020d}/bucket=0")
    assert as_set(rfm_of_state(state)) == expected
    absorb(state, transactions(spark, []), batches)
    assert as_set(rfm_of_state(state)) == expected
    with pytest.raises(ValueError, match="was made with"):
        customer_state(spark, str(tmp_path), buckets=3).last_change()


def test_updated_days_take_late_rows_and_survive_a_rerun(spark, tmp_path):
    folder, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"
    sent = []

    def arrive(*lines):
        sent.extend(lines)
        drop_in(transactions(spark, list(lines)), folder)
        stream = per_day(stream_transactions(spark, folder), "3 days")
        revenue.write_updated_days(stream, out, state, buckets=4).awaitTermination()
        return revenue.updated_days(spark, out, stream.schema, 4, owner=state)

    arrive(line("1", when="2011-01-05"), line("2", when="2011-01-06", customer=2.0))
    table = arrive(line("3", when="2011-01-04", price=9.0), line("4", when="2011-01-05", price=0.5))
    assert as_set(table.read(revenue.DAYS)) == as_set(per_day(transactions(spark, sent)))
    number, rows = table.last_change(), as_set(table.read(revenue.DAYS))
    table.upsert(number, revenue.DAYS, per_day(transactions(spark, [line("9", when="2011-01-05", price=99.0)])), ["customer_id", "day_start"])
    assert as_set(table.read(revenue.DAYS)) == rows
    arrive(line("5", when="2011-01-20"))
    table = arrive(line("6", when="2011-01-05", price=99.0))  # the day is closed
    assert as_set(table.read(revenue.DAYS)) == as_set(per_day(transactions(spark, sent[:-1])))


def test_repeated_lines_of_a_stream_count_once(spark, tmp_path):
    folder, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"
    again = line("1", when="2011-01-02", price=4.0)
    for lines in ([again, again, line("2", when="2011-01-03")], [again, line("3", when="2011-01-02")], [line("4", when="2011-02-01")]):
        drop_in(transactions(spark, lines), folder)
        lines = revenue.distinct_lines(stream_transactions(spark, folder), "invoice_date", "5 days")
        revenue.write_closed_days(per_day(lines), out, state).awaitTermination()
    assert {(r[1], r[3]) for r in as_set(spark.read.parquet(out))} == {(datetime(2011, 1, 2), 6.0), (datetime(2011, 1, 3), 2.0)}


def test_readers_find_a_whole_list_at_any_time(spark, tmp_path):
    path = str(tmp_path / "list")
    with pytest.raises(FileNotFoundError):
        published(spark, path)
    pointer.publish(spark, path, spark.range(3).write.parquet)

    def stops(folder):
        spark.range(5).write.parquet(folder)
        assert spark.read.parquet(published(spark, path)).count() == 3
        raise InterruptedError

    for _ in range(2):
        with pytest.raises(InterruptedError):
            pointer.publish(spark, path, stops)
        assert spark.read.parquet(published(spark, path)).count() == 3
    old = published(spark, path)
    pointer.publish(spark, path, spark.range(7).write.parquet)
    assert spark.read.parquet(published(spark, path)).count() == 7
    assert spark.read.parquet(old).count() == 3  # for readers that have begun
    assert len([p for p in (tmp_path / "list").iterdir() if p.name.startswith("result-")]) == 2
    with pytest.raises(ValueError, match="already"):
        pointer.advance(spark, path, 1, {})
