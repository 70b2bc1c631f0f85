"""Column expressions: missingness, line validity, exact sums and means."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Amounts of one line, and of one customer, who may hold a third of all revenue. Sums widen by ten digits.
LINE_MONEY = "decimal(18,4)"
CUSTOMER_MONEY = "decimal(28,4)"
# Means of measures, which may be logarithms.
MEASURE = "decimal(28,10)"
# The largest ids a floating value can hold of each type.
ID_LIMITS = {"int": 2147483647.0, "bigint": 9223372036854774784.0}
FLOATING = ("float", "double")


def is_missing(df: DataFrame, name: str, blank_text: bool = False) -> Column:
    """True for null, for NaN in floating columns and, on request, for blank text."""
    kind = dict(df.dtypes)[name]
    missing = F.col(name).isNull()
    if kind in FLOATING:
        return missing | F.isnan(name)
    if kind == "string" and blank_text:
        return missing | (F.trim(name) == "")
    return missing


def is_usable_line(df: DataFrame) -> Column:
    """A sale with a known customer, a positive quantity and a positive price."""
    present = ~is_missing(df, "customer_id") & ~is_missing(df, "quantity") & ~is_missing(df, "price")
    return present & (F.col("quantity") > 0) & (F.col("price") > 0)


def line_value() -> Column:
    return F.col("quantity") * F.col("price")


def exact_sum(amount: Column, kind: str = LINE_MONEY) -> Column:
    """Sum in decimals, so that the result does not depend on the order of the rows.

    An amount that the type cannot hold stops the job, under any ANSI setting.
    """
    whole, digits = (int(x) for x in kind[len("decimal(") : -1].split(","))
    fits = F.abs(amount) < F.lit(10.0 ** (whole - digits))
    too_large = F.raise_error(F.concat(F.lit(f"amount beyond {kind}: "), amount.cast("string"))).cast(kind)
    return F.sum(F.when(amount.isNull(), F.lit(None)).when(fits, amount.cast(kind)).otherwise(too_large))


def checked_id(value: Column, id_type: str) -> Column:
    """Cast an id; one beyond the type's range stops the job, under any ANSI setting."""
    limit = F.lit(ID_LIMITS[id_type])
    too_large = F.raise_error(F.concat(F.lit(f"customer id beyond {id_type}: "), value.cast("string"))).cast(id_type)
    fits = F.abs(value.cast("double")) <= limit
    return F.when(value.isNull(), F.lit(None)).when(fits, value.cast(id_type)).otherwise(too_large)


def exact_mean(amount: Column) -> Column:
    """Mean over customers."""
    return exact_sum(amount, MEASURE).cast("double") / F.count(amount)


def percent(part: Column, whole: Column) -> Column:
    """Share in percent; null where the whole is empty."""
    return F.lit(100.0) * part / F.nullif(whole, F.lit(0))
