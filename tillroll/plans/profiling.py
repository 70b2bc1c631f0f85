"""All data-quality reports of a transaction table from one read of it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators import orders, quality
from tillroll.scratch import materialize

# Reports of one row: their aggregates run together.
PLAIN = {
    "row_count": quality.row_count_columns,
    "null_counts": quality.null_count_columns,
    "missing_report": quality.missing_columns,
    "price_summary": quality.price_columns,
    "sign_counts": quality.sign_columns,
    "zero_counts": quality.zero_columns,
}


def profile(df: DataFrame) -> dict[str, DataFrame]:
    """Report name to DataFrame; runs when called.

    The distinct rows and the number of their copies are written once, and so
    is one row with all plain counts. The other reports are lazy and read the
    columns they need of the distinct rows, however often the rows are repeated.
    """
    rows = materialize(quality.with_copies(df), "distinct-rows")
    plain = materialize(rows.agg(*[F.struct(*columns(rows)).alias(name) for name, columns in PLAIN.items()]), "plain-counts")
    return {
        **{name: plain.select(f"{name}.*") for name in PLAIN},
        "count_by_country": quality.frequency_table(rows, "country"),
        "duplicate_total": quality.duplicate_total(rows),
        "duplicate_rows": quality.duplicate_rows(rows),
        "repeated_invoices": quality.repeated_invoices(rows),
        "duplicate_hotspots": quality.duplicate_hotspots(rows),
        "uniqueness": quality.uniqueness(rows),
        "invoice_versions": quality.invoice_versions(rows),
        "removal_reasons": quality.removal_reasons(rows),
        "top_countries": orders.top_countries(rows),
        "daily_orders_top_countries": orders.daily_orders_top_countries(rows),
    }
