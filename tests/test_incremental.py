"""Daily partials, sketches of days, and a job that goes on where it stopped."""

import datetime
import random

import pytest
from helpers import as_set, line, transactions
from pyspark.sql import functions as F

from tillroll.config import SegmentationConfig
from tillroll.operators import partials
from tillroll.operators.features import build_rfm, clean
from tillroll.plans import segmentation


def test_days_merge_and_a_day_put_again_replaces_the_old_one(spark, tmp_path):
    path = str(tmp_path / "days")
    first = [line("1", when="2011-01-01"), line("1", when="2011-01-01"), line("2", when="2011-01-02", customer=2.0)]
    spanning = [line("1", stock="b", when="2011-01-03"), line("3", when="2011-01-03"), line("4", when="2011-01-03", customer=None)]
    wrong = [line("8", when="2011-01-03", price=99.0)]
    assert partials.rfm_of_days(spark, path).count() == 0
    for lines in (first, wrong, spanning):
        partials.put_days(transactions(spark, lines), path)
    assert as_set(partials.rfm_of_days(spark, path)) == as_set(build_rfm(clean(transactions(spark, first + spanning))))
    more = [line("2", when="2011-01-02", customer=2.0, price=7.0)]
    partials.put_days(transactions(spark, more), path)  # one of the two days of the first put
    assert as_set(partials.rfm_of_days(spark, path)) == as_set(build_rfm(clean(transactions(spark, first[:2] + spanning + more))))


def test_a_new_day_does_not_read_others(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "days")
    partials.put_days(transactions(spark, [line("1", when="2011-01-01")]), path)
    for file in (tmp_path / "days" / "put=00000000000000000000").glob("*.parquet"):
        file.write_bytes(b"not to be read")
    partials.put_days(transactions(spark, [line("2", when="2011-01-02")]), path)
    partials.put_days(transactions(spark, [line("3", when="2011-01-01")]), path)  # now nothing is left of the first put
    assert {r.frequency for r in partials.rfm_of_days(spark, path).collect()} == {2}


@pytest.mark.parametrize("span", [1, 3])
def test_bounds_of_days_are_within_the_rank_error(spark, span):
    rng = random.Random(span)
    start = datetime.date(2024, 1, 1)
    rows = [(start + datetime.timedelta(days=rng.choice([0, 1, 2, 5])), rng.lognormvariate(0, 2)) for _ in range(20_000)]
    frame = spark.createDataFrame([*rows, (start, None), (None, 1.0), (start, float("nan"))], "day date, v double")
    found = partials.trailing_bounds(partials.day_sketches(frame, F.col("day"), F.col("v")), span).collect()
    assert len(found) == 4
    for r in found:
        values = sorted(v for d, v in rows if 0 <= (r.day - d).days < span)
        assert r.n == len(values)
        for bound, share in ((r.q1, 0.25), (r.q3, 0.75)):
            assert abs(sum(v <= bound for v in values) / len(values) - share) <= partials.SKETCH_RANK_ERROR + 1 / len(values)
        assert r.upper_bound == pytest.approx(r.q3 + 1.5 * (r.q3 - r.q1))


def test_a_stopped_job_goes_on_from_its_last_stage(spark, tmp_path, small_tx, monkeypatch):
    small_tx.write.parquet(f"{tmp_path}/raw")
    config = SegmentationConfig(
        source=f"{tmp_path}/raw", source_format="parquet", archive_dir=f"{tmp_path}/archive", export_dir=f"{tmp_path}/out",
        k_range=(2, 3), fit_partitions=2, archive_raw=False,
    )

    def stop(*args, **kwargs):
        raise InterruptedError

    with monkeypatch.context() as patch:
        patch.setattr(segmentation, "build_rfm", stop)
        with pytest.raises(InterruptedError):
            segmentation.run_segmentation(spark, config, "r")
    cleaned = {p: p.stat().st_mtime_ns for p in (tmp_path / "archive" / "cleaned_transactions_r").iterdir()}
    with monkeypatch.context() as patch:
        patch.setattr(segmentation, "read_transactions", stop)
        patch.setattr(segmentation, "write_rules", stop)
        with pytest.raises(InterruptedError):
            segmentation.run_segmentation(spark, config, "r")
    with monkeypatch.context() as patch:
        for name in ("read_transactions", "clean", "build_rfm", "choose", "fit_model"):
            patch.setattr(segmentation, name, stop)
        report = segmentation.run_segmentation(spark, config, "r")
    assert {p: p.stat().st_mtime_ns for p in cleaned} == cleaned
    assert report.counts == {"total_raw_rows": 6079, "cleaned_rows": 4403, "rfm_customers": 112, "final_customers": report.labeled.count()}
    assert report.exports[0].exported > 0 and report.best_k in (2, 3)
    again = segmentation.run_segmentation(spark, config, "r")
    assert again.counts == report.counts and again.exports == report.exports
