"""How many partitions a table of customers is worth."""

import math

from pyspark.sql import DataFrame


def partitions_for(df: DataFrame, rows_each: int) -> int:
    """Enough partitions of about ``rows_each`` rows, whatever the session's setting.

    Counts the rows, so ``df`` should be cheap to read. Explicit partition
    numbers are not merged by adaptive execution; taking the session's number
    as it is would cut small tables into very many pieces, and large ones into
    too few.
    """
    return max(1, math.ceil(df.count() / rows_each))
