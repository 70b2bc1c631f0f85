import datetime
import math

import pytest
from helpers import as_set, line, transactions
from pyspark.sql import functions as F

from tillroll.operators.features import build_rfm, clean, customer_totals
from tillroll.operators import quality


def test_nan_and_null_ids_are_dropped(spark):
    df = transactions(spark, [line(customer=13085.0), line(customer=math.nan), line(customer=None)])
    assert [r.customer_id for r in clean(df).collect()] == [13085]


def test_nan_price_and_missing_values_are_dropped(spark):
    lines = [line(price=math.nan), line(price=None), line(quantity=None), line(quantity=0), line(price=-1.0), line()]
    assert clean(transactions(spark, lines)).count() == 1


def test_ids_beyond_int_stop_the_job_unless_bigint(spark):
    df = transactions(spark, [line(customer=5e9)])
    with pytest.raises(Exception, match="customer id beyond int"):
        clean(df).collect()
    assert clean(df, id_type="bigint").first().customer_id == 5_000_000_000


def test_duplicates_go_and_columns_are_added(spark):
    df = transactions(spark, [line(quantity=3, price=2.5, when="2011-05-06T10:00:00")] * 2)
    row = clean(df).collect()
    assert len(row) == 1
    assert row[0].total_price == 7.5
    assert row[0].date == datetime.date(2011, 5, 6)


def test_rfm_counts_back_from_last_day(spark):
    lines = [
        line("1", when="2011-01-01", price=1.0),
        line("2", when="2011-01-11", price=2.0),
        line("2", "b", when="2011-01-11", price=3.5),
        line("3", when="2011-01-21", customer=2.0),
        line("4", when="2009-01-01", customer=3.0),
    ]
    rfm = build_rfm(clean(transactions(spark, lines)))
    assert as_set(rfm) == {(1, "UK", 10, 2, 6.5), (2, "UK", 0, 1, 2.0)}


def test_rfm_keeps_customer_and_country_apart(spark):
    lines = [line("1"), line("2", country="France")]
    assert build_rfm(clean(transactions(spark, lines))).count() == 2


def test_rfm_as_of_is_positive_days_since(spark):
    rfm = build_rfm(clean(transactions(spark, [line(when="2011-01-01")])), as_of=datetime.date(2011, 1, 31))
    assert rfm.first().recency == 30


def test_rfm_of_nothing_is_empty(spark):
    assert build_rfm(clean(transactions(spark, [line(price=-1.0)]))).count() == 0


def test_distinct_invoices_are_counted_across_keys_first(spark, small_tx):
    """The distinct count may not bring all rows of one customer into one task."""
    plan = customer_totals(clean(small_tx))._jdf.queryExecution().executedPlan().toString()
    keys = [part.split(", 4)")[0] for part in plan.split("hashpartitioning(")[1:]]
    assert any("customer_id" in k and "country" in k and "invoice#" in k and "price" not in k for k in keys)


def test_filters_reach_the_scan_before_duplicates(spark, small_tx):
    plan = clean(small_tx)._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("FileScan"):]
    assert "GreaterThan(quantity,0)" in scan and "IsNotNull(customer_id)" in scan


def test_distinct_tuples_count_nulls(spark):
    df = transactions(spark, [line(text=None), line(text="a"), line(stock="b", text="b")])
    row = quality.uniqueness(df).first()
    assert (row.total_rows, row.unique_invoices, row.unique_entire_rows) == (3, 1, 3)
    assert quality.invoice_versions(df).first().versions == 3


def test_null_invoices_are_no_distinct_invoice(spark):
    df = transactions(spark, [line(invoice=None), line("1")])
    assert quality.uniqueness(df).first().unique_invoices == 1


def test_missing_report_by_type(spark):
    texts = [None, "", "  ", "nan", "x"]
    lines = [line(str(i), text=t, customer=math.nan if i == 0 else 1.0) for i, t in enumerate(texts)]
    df = transactions(spark, lines)
    report = quality.missing_report(df).first()
    assert (report.description, report.customer_id, report.quantity) == (3, 1, 0)
    assert quality.null_counts(df).first().description == 1


def test_removal_reasons_overlap(spark):
    lines = [line(), line(), line("2", customer=None, quantity=-1), line("3", price=None)]
    found = dict(as_set(quality.removal_reasons(transactions(spark, lines))))
    assert found == {"duplicate": 1, "missing_value": 2, "non_positive": 2, "missing_customer": 1}


def test_cleaning_delta(spark):
    lines = [line(), line(), line("2", price=0.0), line("3")]
    row = quality.cleaning_delta(transactions(spark, lines)).first()
    assert tuple(row) == (4, 2, 50.0, 2)


def test_reports_on_an_empty_table(spark):
    empty = transactions(spark, [])
    assert tuple(quality.duplicate_total(empty).first()) == (0, 0, 0)
    assert tuple(quality.uniqueness(empty).first()) == (0, 0, 0)
    assert tuple(quality.cleaning_delta(empty).first()) == (0, 0, None, 0)


def test_invoice_variance_rows_keep_copies(spark):
    lines = [line("1", "a"), line("1", "a"), line("1", "b"), line("2", "a")]
    found = quality.invoice_variance_rows(transactions(spark, lines))
    assert found.count() == 3
    assert found.columns == transactions(spark, lines).columns


def test_column_types(spark):
    kinds = quality.column_types(transactions(spark, []))
    assert kinds["double"] == ["price", "customer_id"]


def test_preview(spark, small_tx):
    assert quality.preview(small_tx, 3).count() == 3


def test_profile_has_all_reports(spark, small_tx):
    from tillroll.plans.profiling import profile

    reports = profile(small_tx)
    assert reports["row_count"].first().rows == 6079
    assert reports["sign_counts"].first().qty_negative == 283


def test_cleaning_matches_documented_counts(spark, small_tx):
    assert clean(small_tx).count() == 4403
    assert small_tx.filter(F.col("customer_id").isNull()).count() == 1280


def test_profile_reads_its_source_once_and_equals_single_reports(spark, small_tx, monkeypatch):
    from tillroll.operators import orders, quality
    from tillroll.plans import profiling

    written = []

    def watched(df, label):
        written.append(set(df.inputFiles()))
        return materialize(df, label)

    from tillroll.scratch import materialize

    monkeypatch.setattr(profiling, "materialize", watched)
    reports = profiling.profile(small_tx)
    source = set(small_tx.inputFiles())
    reads = [*written, *[set(r.inputFiles()) for r in reports.values()]]
    assert source and sum(bool(source & files) for files in reads) == 1
    for name, report in reports.items():
        module = orders if hasattr(orders, name) else quality
        single = quality.frequency_table(small_tx, "country") if name == "count_by_country" else getattr(module, name)(small_tx)
        assert report.dtypes == single.dtypes, name
        assert sorted(map(repr, report.collect())) == sorted(map(repr, single.collect())), name
