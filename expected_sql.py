"""The registered queries once more, as SQL for DuckDB, written independently.

``WITH`` parts are shared; each query names the ones it needs. Prices have two
decimals and quantities are whole, so money is summed in decimals on both sides.
"""

from __future__ import annotations

PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "lines": (
        (),
        """
        SELECT CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 'C' || l_orderkey
                    ELSE cast(l_orderkey AS varchar) END AS invoice,
               cast(l_partkey AS varchar) AS stock_code,
               CASE WHEN l_partkey % 97 = 0 THEN NULL WHEN l_partkey % 89 = 0 THEN '  '
                    WHEN l_partkey % 83 = 0 THEN 'say "hi", ' || p_name ELSE p_name END AS description,
               cast(CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN -l_quantity
                         WHEN l_linenumber = 7 AND l_suppkey % 10 = 0 THEN 0
                         ELSE l_quantity END AS integer) AS quantity,
               o_orderdate AS invoice_date,
               cast(CASE WHEN l_partkey % 113 = 0 THEN 0 WHEN l_partkey % 499 = 0 THEN -p_retailprice
                         ELSE p_retailprice END AS double) AS price,
               cast(CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE o_custkey END AS double) AS customer_id,
               CASE WHEN l_orderkey % 20 = 1 THEN sn.n_name ELSE cn.n_name END AS country,
               (l_orderkey + l_linenumber) % 80 = 0 AS twice
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN nation cn ON c_nationkey = cn.n_nationkey
        JOIN part ON l_partkey = p_partkey
        JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation sn ON s_nationkey = sn.n_nationkey""",
    ),
    "tx": (
        ("lines",),
        """
        SELECT * EXCLUDE (twice) FROM lines
        UNION ALL
        SELECT * EXCLUDE (twice) FROM lines WHERE twice""",
    ),
    "cleaned": (
        ("tx",),
        """
        SELECT DISTINCT invoice, stock_code, description, quantity, invoice_date, price,
               cast(customer_id AS integer) AS customer_id, country,
               quantity * price AS total_price, cast(invoice_date AS date) AS date
        FROM tx WHERE customer_id IS NOT NULL AND quantity > 0 AND price > 0""",
    ),
    "totals": (
        ("cleaned",),
        """
        SELECT customer_id, country, max(date) AS last_date, count(DISTINCT invoice) AS frequency,
               cast(round(sum(cast(total_price AS decimal(18,4))), 2) AS double) AS monetary
        FROM cleaned GROUP BY customer_id, country""",
    ),
    "rfm": (
        ("totals",),
        """
        SELECT * FROM (
            SELECT customer_id, country,
                   cast(date_diff('day', last_date, (SELECT max(last_date) FROM totals)) AS integer) AS recency,
                   frequency, monetary
            FROM totals)
        WHERE recency BETWEEN 0 AND 365""",
    ),
    "long_rfm": (
        ("rfm",),
        """
        SELECT 'recency' AS measure, cast(recency AS double) AS v FROM rfm
        UNION ALL SELECT 'frequency', cast(frequency AS double) FROM rfm
        UNION ALL SELECT 'monetary', monetary FROM rfm""",
    ),
    "quartiles": (
        ("long_rfm",),
        """
        SELECT measure, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3
        FROM long_rfm GROUP BY measure""",
    ),
    "scaled": (
        ("rfm",),
        """
        SELECT rfm.*, recency / s.r AS recency_scaled, frequency / s.f AS frequency_scaled,
               monetary / s.m AS monetary_scaled
        FROM rfm, (SELECT stddev_samp(recency) AS r, stddev_samp(frequency) AS f, stddev_samp(monetary) AS m
                   FROM rfm) s""",
    ),
    "centers": (
        (),
        """
        SELECT * FROM (VALUES (0, 0.5, 2.9, 2.9), (1, 0.8, 2.0, 1.8), (2, 1.5, 1.3, 1.1),
                              (3, 2.6, 1.8, 1.6), (4, 2.2, 0.4, 0.2)) c(id, r, f, m)""",
    ),
    "assigned": (
        ("scaled", "centers"),
        """
        SELECT scaled.*, (SELECT cast(id AS integer) FROM centers
                          ORDER BY (recency_scaled - cast(r AS double)) ** 2
                                 + (frequency_scaled - cast(f AS double)) ** 2
                                 + (monetary_scaled - cast(m AS double)) ** 2, id LIMIT 1) AS prediction
        FROM scaled""",
    ),
    "ranking": (
        ("assigned",),
        """
        SELECT prediction, avg_ltv, cast(row_number() OVER (ORDER BY avg_ltv DESC, prediction) - 1 AS integer) AS ltv_rank
        FROM (SELECT prediction, cast(sum(cast(monetary AS decimal(18,4))) AS double) / count(*) AS avg_ltv
              FROM assigned GROUP BY prediction)""",
    ),
    "labeled": (
        ("ranking",),
        """
        SELECT customer_id, country, recency, frequency, monetary, assigned.prediction,
               CASE ltv_rank WHEN 0 THEN 'Champions' WHEN 1 THEN 'Loyal' WHEN 2 THEN 'Promising'
                             WHEN 3 THEN 'At Risk' WHEN 4 THEN 'Lost' END AS segment
        FROM assigned JOIN ranking ON assigned.prediction = ranking.prediction""",
    ),
    "copies": (("tx",), "SELECT *, count(*) AS n FROM tx GROUP BY ALL"),
    "versions": (
        ("tx",),
        """
        SELECT invoice, count(DISTINCT (stock_code, description, quantity, invoice_date, price, customer_id, country))
               AS versions
        FROM tx GROUP BY invoice""",
    ),
    "leaders": (
        ("tx",),
        """
        SELECT country, count(DISTINCT invoice) AS total_orders FROM tx GROUP BY country
        ORDER BY total_orders DESC, country LIMIT 5""",
    ),
    "ranked": (
        ("rfm",),
        """
        SELECT row_number() OVER w AS rank, customer_id, country, monetary,
               cast(monetary AS decimal(18,2)) AS spend,
               sum(cast(monetary AS decimal(18,2))) OVER w AS running,
               sum(cast(monetary AS decimal(18,2))) OVER () AS everything,
               ceil(count(*) OVER () * 20 / 100) AS cut
        FROM rfm WINDOW w AS (ORDER BY monetary DESC, customer_id, country)""",
    ),
    "trim_recency": (
        ("rfm",),
        """
        SELECT * FROM rfm WHERE recency BETWEEN (SELECT quantile_cont(cast(recency AS double), 0.01) FROM rfm)
                                            AND (SELECT quantile_cont(cast(recency AS double), 0.99) FROM rfm)""",
    ),
    "trim_frequency": (
        ("trim_recency",),
        """
        SELECT * FROM trim_recency
        WHERE frequency BETWEEN (SELECT quantile_cont(cast(frequency AS double), 0.01) FROM trim_recency)
                            AND (SELECT quantile_cont(cast(frequency AS double), 0.99) FROM trim_recency)""",
    ),
    "trimmed": (
        ("trim_frequency",),
        """
        SELECT * FROM trim_frequency WHERE monetary BETWEEN (SELECT quantile_cont(monetary, 0.01) FROM trim_frequency)
                                                        AND (SELECT quantile_cont(monetary, 0.99) FROM trim_frequency)""",
    ),
    "logs": (
        ("trimmed",),
        """
        SELECT customer_id, country, ln(1 + recency) AS recency, ln(1 + frequency) AS frequency, ln(1 + monetary) AS monetary,
               (cast(customer_id AS bigint) % 2147483647 * 1103515245 + 42) % 2147483647 % 100 >= 80 AS tested
        FROM trimmed""",
    ),
    "log_centers": (
        (),
        """
        SELECT * FROM (VALUES (0, 3.1, 4.4, 15.5), (1, 3.9, 3.8, 14.8), (2, 4.4, 2.6, 14.0), (3, 2.2, 3.0, 14.2),
                              (4, 4.6, 1.6, 12.6)) c(id, r, f, m)""",
    ),
    "tested": (
        ("logs", "log_centers"),
        """
        SELECT logs.*, (SELECT cast(id AS integer) FROM log_centers
                        ORDER BY (recency / sr - cast(r AS double)) ** 2 + (frequency / sf - cast(f AS double)) ** 2
                               + (monetary / sm - cast(m AS double)) ** 2, id LIMIT 1) AS prediction
        FROM logs, (SELECT stddev_samp(recency) AS sr, stddev_samp(frequency) AS sf, stddev_samp(monetary) AS sm FROM logs)
        WHERE tested""",
    ),
    # Principal components by power iteration on the covariance matrix, the second after taking out the first.
    "cov": (
        ("rfm",),
        """
        SELECT avg(recency) AS ar, avg(frequency) AS af, avg(monetary) AS am, var_samp(recency) AS rr,
               var_samp(frequency) AS ff, var_samp(monetary) AS mm, covar_samp(recency, frequency) AS rf,
               covar_samp(recency, monetary) AS rm, covar_samp(frequency, monetary) AS fm FROM rfm""",
    ),
    "steps1": (
        ("cov",),
        """
        SELECT 0 AS i, cast(1 AS double) AS x, cast(1 AS double) AS y, cast(1 AS double) AS z
        UNION ALL
        SELECT i + 1, a / sqrt(a*a + b*b + c*c), b / sqrt(a*a + b*b + c*c), c / sqrt(a*a + b*b + c*c)
        FROM (SELECT i, rr*x + rf*y + rm*z AS a, rf*x + ff*y + fm*z AS b, rm*x + fm*y + mm*z AS c
              FROM steps1, cov WHERE i < 60)""",
    ),
    "first_axis": (
        ("steps1",),
        """
        SELECT x, y, z, rr*x*x + ff*y*y + mm*z*z + 2 * (rf*x*y + rm*x*z + fm*y*z) AS size
        FROM steps1, cov WHERE i = 60""",
    ),
    "rest": (
        ("first_axis",),
        """
        SELECT rr - size*x*x AS rr, ff - size*y*y AS ff, mm - size*z*z AS mm, rf - size*x*y AS rf,
               rm - size*x*z AS rm, fm - size*y*z AS fm FROM cov, first_axis""",
    ),
    "steps2": (
        ("rest",),
        """
        SELECT 0 AS i, cast(1 AS double) AS x, cast(1 AS double) AS y, cast(0 AS double) AS z
        UNION ALL
        SELECT i + 1, a / sqrt(a*a + b*b + c*c), b / sqrt(a*a + b*b + c*c), c / sqrt(a*a + b*b + c*c)
        FROM (SELECT i, rr*x + rf*y + rm*z AS a, rf*x + ff*y + fm*z AS b, rm*x + fm*y + mm*z AS c
              FROM steps2, rest WHERE i < 60)""",
    ),
    "axes": (
        ("steps2",),
        """
        SELECT n, x * flip AS x, y * flip AS y, z * flip AS z, size FROM (
            SELECT *, sign(CASE greatest(abs(x), abs(y), abs(z)) WHEN abs(x) THEN x WHEN abs(y) THEN y ELSE z END) AS flip
            FROM (SELECT 1 AS n, * FROM first_axis
                  UNION ALL
                  SELECT 2, x, y, z, rr*x*x + ff*y*y + mm*z*z + 2 * (rf*x*y + rm*x*z + fm*y*z)
                  FROM steps2, rest WHERE i = 60))""",
    ),
    "day_revenue": (
        (),
        """
        SELECT user_id, date_trunc('day', ts) AS day_start, date_trunc('day', ts) + INTERVAL 1 DAY AS day_end,
               cast(round(sum(cast(value AS decimal(18,4))), 2) AS double) AS revenue
        FROM events WHERE user_id IS NOT NULL GROUP BY ALL""",
    ),
}


def _query(needs: str, select: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for inner in PARTS[name][0]:
            add(inner)
        if name not in order:
            order.append(name)

    for name in needs.split():
        add(name)
    parts = ",\n".join(f"{name} AS ({PARTS[name][1]})" for name in order)
    return f"WITH RECURSIVE {parts}\n{select}"


def _mean(column: str) -> str:
    return f"cast(sum(cast({column} AS decimal(18,4))) AS double) / count({column})"


def _fenced(factor: float) -> str:
    tests = [
        f"({m} < (SELECT q1 - {factor}::double * (q3 - q1) FROM quartiles WHERE measure = '{m}') OR "
        f"{m} > (SELECT q3 + {factor}::double * (q3 - q1) FROM quartiles WHERE measure = '{m}'))"
        for m in ("recency", "frequency", "monetary")
    ]
    return " OR ".join(tests)


def _outlier_rows(factor: float) -> str:
    def one(name: str, test: str) -> str:
        return (
            f"SELECT '{name}' AS measure, count(*) FILTER (WHERE {test}) AS outliers, "
            f"round(100.0 * count(*) FILTER (WHERE {test}) / count(*), 1) AS outlier_pct FROM rfm"
        )

    tests = dict(zip(("recency", "frequency", "monetary"), _fenced(factor).split(" OR (")))
    tests = {m: (t if t.startswith("(") else "(" + t) for m, t in tests.items()}
    return " UNION ALL ".join([*[one(m, t) for m, t in tests.items()], one("any", _fenced(factor))])


RAW = "invoice, stock_code, description, quantity, invoice_date, price, customer_id, country"


def expected_sql() -> dict[str, str]:
    q = _query
    cleaned = q("cleaned", "SELECT * FROM cleaned")
    null_columns = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in RAW.split(", "))
    text = ("invoice", "stock_code", "description", "country")
    missing_columns = ", ".join(
        f"count(*) FILTER (WHERE {c} IS NULL" + (f" OR trim({c}) = ''" if c in text else "") + f") AS {c}"
        for c in RAW.split(", ")
    )
    silhouette = """
        , stats AS (SELECT prediction, count(*) AS n, sum(recency_scaled) AS yr, sum(frequency_scaled) AS yf,
                           sum(monetary_scaled) AS ym,
                           sum(recency_scaled ** 2 + frequency_scaled ** 2 + monetary_scaled ** 2) AS psi
                    FROM assigned GROUP BY prediction),
        d AS (SELECT a.customer_id, a.country, a.prediction = s.prediction AS own, s.n,
                     recency_scaled ** 2 + frequency_scaled ** 2 + monetary_scaled ** 2 + psi / n
                     - 2 * (recency_scaled * yr + frequency_scaled * yf + monetary_scaled * ym) / n AS dist
              FROM assigned a, stats s),
        ab AS (SELECT customer_id, country, max(n) FILTER (WHERE own) AS n,
                      max(dist * n / nullif(n - 1, 0)) FILTER (WHERE own) AS a, min(dist) FILTER (WHERE NOT own) AS b
               FROM d GROUP BY customer_id, country)
        SELECT round(avg(CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM ab"""
    summary = f"""
        SELECT * FROM (
        SELECT 'rows' AS metric, cast(count(*) AS double) AS value FROM labeled WHERE segment = 'Champions'
        UNION ALL SELECT 'mean recency', round({_mean('recency')}, 1) FROM labeled WHERE segment = 'Champions'
        UNION ALL SELECT 'mean frequency', round({_mean('frequency')}, 1) FROM labeled WHERE segment = 'Champions'
        UNION ALL SELECT 'mean spend', round({_mean('monetary')}, 0) FROM labeled WHERE segment = 'Champions'
        UNION ALL SELECT 'percent of all rows',
                         round(100.0 * count(*) FILTER (WHERE segment = 'Champions') / count(*), 1) FROM labeled)"""
    norm = ", ".join(
        f"round(({m} - min({m}) OVER ()) / nullif(max({m}) OVER () - min({m}) OVER (), 0), 6) AS {m}"
        for m in ("recency", "frequency", "monetary")
    )
    means = ", ".join(f"{_mean(m)} AS {m}" for m in ("recency", "frequency", "monetary"))
    rounded_means = ", ".join(f"round({_mean(m)}, 6) AS {m}" for m in ("recency", "frequency", "monetary"))
    log_means = ", ".join(f"round(avg(ln(1 + {m})), 6) AS {m}" for m in ("recency", "frequency", "monetary"))
    plain_log_means = ", ".join(f"avg(ln(1 + {m})) AS {m}" for m in ("recency", "frequency", "monetary"))
    describe = " UNION ALL ".join(
        f"SELECT '{m}' AS measure, count({m}) AS n, round({_mean(m)}, 4) AS mean, "
        f"round(stddev_samp({m}), 4) AS stddev, cast(min({m}) AS double) AS min, cast(max({m}) AS double) AS max, "
        f"cast(NULL AS varchar) AS first, cast(NULL AS varchar) AS last FROM rfm"
        for m in ("customer_id", "recency", "frequency", "monetary")
    ) + " UNION ALL SELECT 'country', count(country), NULL, NULL, NULL, NULL, min(country), max(country) FROM rfm"
    members = "SELECT customer_id, country, recency, frequency, monetary, segment FROM labeled"

    return {
        # sources and sinks
        "transactions": q("tx", f"SELECT {RAW} FROM tx"),
        "csv_inferred": q("tx", f"SELECT {RAW} FROM tx"),
        "csv_declared": q("tx", f"SELECT {RAW} FROM tx"),
        "snapshot_roundtrip": cleaned,
        "export_segment": q("labeled", f"{members} WHERE segment = 'Champions'"),
        "segment_archive": q("labeled", f"SELECT *, replace(lower(segment), ' ', '_') AS segment_slug FROM ({members})"),
        "stage_counts": q(
            "quartiles",
            f"""SELECT 'raw' AS stage, count(*) AS rows FROM tx UNION ALL SELECT 'cleaned', count(*) FROM cleaned
                UNION ALL SELECT 'rfm', count(*) FROM rfm
                UNION ALL SELECT 'rfm_within_fences', count(*) FROM rfm WHERE NOT ({_fenced(1.5)})""",
        ),
        "segment_summary": q("labeled", summary),
        # cleaning and filters
        "clean": cleaned,
        "clean_nan": cleaned,
        "dedup_rows": q("tx", "SELECT DISTINCT * FROM tx"),
        "price_negative": q("tx", "SELECT * FROM tx WHERE price < 0"),
        "description_lookup": q("tx", "SELECT * FROM tx WHERE description = 'small ring'"),
        "zero_rows": q("tx", "SELECT invoice, invoice_date, quantity, price, country FROM tx WHERE price = 0 OR quantity = 0"),
        "invalid_rows": q("tx", "SELECT * FROM tx WHERE quantity <= 0 OR price <= 0"),
        "invoice_variance_rows": q(
            "versions",
            """SELECT * FROM tx WHERE invoice IN
               (SELECT invoice FROM versions WHERE versions > 1 ORDER BY versions DESC, invoice LIMIT 5)""",
        ),
        # profiling
        "null_counts": q("tx", f"SELECT {null_columns} FROM tx"),
        "missing_report": q("tx", f"SELECT {missing_columns} FROM tx"),
        "count_by_country": q("tx", "SELECT country, count(*) AS count FROM tx GROUP BY country"),
        "count_by_description": q("tx", "SELECT description, count(*) AS count FROM tx GROUP BY description"),
        "count_by_customer": q("tx", "SELECT customer_id, count(*) AS count FROM tx GROUP BY customer_id"),
        "duplicate_total": q(
            "copies",
            """SELECT cast(sum(n) AS bigint) AS total_rows, count(*) AS distinct_rows,
                      cast(sum(n) - count(*) AS bigint) AS duplicate_rows FROM copies""",
        ),
        "duplicate_rows": q("copies", f"SELECT {RAW}, n AS count FROM copies WHERE n > 1"),
        "repeated_invoices": q("tx", "SELECT invoice, count(*) AS count FROM tx GROUP BY invoice HAVING count(*) > 1"),
        "duplicate_hotspots": q(
            "tx",
            """SELECT country, cast(sum(n) AS bigint) AS repeated_lines
               FROM (SELECT country, invoice, count(*) AS n FROM tx GROUP BY country, invoice HAVING count(*) > 1)
               GROUP BY country""",
        ),
        "uniqueness": q(
            "tx",
            f"""SELECT count(*) AS total_rows, count(DISTINCT invoice) AS unique_invoices,
                       count(DISTINCT ({RAW})) AS unique_entire_rows FROM tx""",
        ),
        "invoice_versions": q("versions", "SELECT * FROM versions WHERE versions > 1"),
        "price_summary": q(
            "tx",
            f"""SELECT max(price) AS max_price, min(price) AS min_price, round({_mean('price')}, 6) AS avg_price,
                       cast(sum(cast(price AS decimal(18,4))) AS double) AS sum_price FROM tx""",
        ),
        "zero_counts": q(
            "tx",
            """SELECT count(*) FILTER (WHERE price = 0) AS zero_price,
                      count(*) FILTER (WHERE quantity = 0) AS zero_quantity FROM tx""",
        ),
        "sign_counts": q(
            "tx",
            """SELECT count(*) FILTER (WHERE quantity = 0) AS qty_zero, count(*) FILTER (WHERE quantity < 0) AS qty_negative,
                      count(*) FILTER (WHERE price = 0) AS price_zero, count(*) FILTER (WHERE price < 0) AS price_negative
               FROM tx""",
        ),
        "cleaning_delta": q(
            "cleaned",
            """SELECT raw_rows, raw_rows - remaining_rows AS removed_rows,
                      round(100.0 * (raw_rows - remaining_rows) / raw_rows, 1) AS removed_pct, remaining_rows
               FROM (SELECT (SELECT count(*) FROM tx) AS raw_rows, (SELECT count(*) FROM cleaned) AS remaining_rows)""",
        ),
        "removal_reasons": q(
            "tx",
            """SELECT 'duplicate' AS reason, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM tx)) AS rows FROM tx
               UNION ALL SELECT 'missing_value', count(*) FROM tx
                         WHERE quantity IS NULL OR price IS NULL OR customer_id IS NULL
               UNION ALL SELECT 'non_positive', count(*) FROM tx WHERE NOT coalesce(quantity > 0 AND price > 0, false)
               UNION ALL SELECT 'missing_customer', count(*) FROM tx WHERE customer_id IS NULL""",
        ),
        # order series
        "top_countries": q("leaders", "SELECT * FROM leaders"),
        "daily_orders": q(
            "tx",
            """SELECT cast(invoice_date AS date) AS date, country, count(DISTINCT invoice) AS order_count
               FROM tx GROUP BY 1, 2""",
        ),
        "daily_orders_top_countries": q(
            "leaders",
            """SELECT cast(invoice_date AS date) AS date, country, count(DISTINCT invoice) AS order_count
               FROM tx WHERE country IN (SELECT country FROM leaders) GROUP BY 1, 2""",
        ),
        # RFM features
        "rfm": q("rfm", "SELECT * FROM rfm"),
        "rfm_incremental": q("rfm", "SELECT * FROM rfm"),
        "daily_iqr_bounds": """
            WITH e AS (SELECT cast(ts AS date) AS day FROM events WHERE ts IS NOT NULL AND value IS NOT NULL)
            SELECT d.day, count(*) AS n, true AS within, true AS fences
            FROM (SELECT DISTINCT day FROM e) d JOIN e ON e.day BETWEEN d.day - 6 AND d.day GROUP BY d.day""",
        "segmentation_run": q(
            "quartiles",
            f"""SELECT (SELECT count(*) FROM tx) AS total_raw_rows, (SELECT count(*) FROM cleaned) AS cleaned_rows,
                       (SELECT count(*) FROM rfm) AS rfm_customers,
                       (SELECT count(*) FROM rfm WHERE NOT ({_fenced(1.5)})) AS final_customers,
                       true AS k_in_range, true AS listed""",
        ),
        "rfm_as_of": q(
            "totals",
            """SELECT * FROM (SELECT customer_id, country,
                      cast(date_diff('day', last_date, DATE '2001-12-31') AS integer) AS recency, frequency, monetary
               FROM totals) WHERE recency BETWEEN 0 AND 365""",
        ),
        "rfm_describe": q("rfm", describe),
        "top_spenders": q("rfm", "SELECT * FROM rfm ORDER BY monetary DESC, customer_id, country LIMIT 10"),
        "rfm_scaled": q(
            "scaled",
            """SELECT customer_id, country, recency, frequency, monetary, round(recency_scaled, 9) AS recency_scaled,
                      round(frequency_scaled, 9) AS frequency_scaled, round(monetary_scaled, 9) AS monetary_scaled
               FROM scaled""",
        ),
        "rfm_log": q(
            "rfm",
            """SELECT customer_id, country, round(ln(1 + recency), 9) AS recency, round(ln(1 + frequency), 9) AS frequency,
                      round(ln(1 + monetary), 9) AS monetary FROM rfm""",
        ),
        "train_test_split": q(
            "rfm",
            """SELECT *, CASE WHEN (cast(customer_id AS bigint) % 2147483647 * 1103515245 + 42) % 2147483647 % 100 < 80
                              THEN 'train' ELSE 'test' END AS split FROM rfm""",
        ),
        # outliers
        "iqr_bounds": q(
            "quartiles",
            """SELECT measure, round(q1, 6) AS q1, round(q3, 6) AS q3, round(q1 - 1.5 * (q3 - q1), 6) AS lower_bound,
                      round(q3 + 1.5 * (q3 - q1), 6) AS upper_bound FROM quartiles""",
        ),
        "outlier_summary": q("quartiles", _outlier_rows(1.5)),
        "outlier_summary_tight": q("quartiles", _outlier_rows(0.5)),
        "rfm_outliers_removed": q("quartiles", f"SELECT * FROM rfm WHERE NOT ({_fenced(1.5)})"),
        "rfm_outliers_removed_tight": q("quartiles", f"SELECT * FROM rfm WHERE NOT ({_fenced(0.5)})"),
        "quantile_trim": q(
            "trim_frequency",
            """SELECT * FROM trim_frequency WHERE monetary BETWEEN (SELECT quantile_cont(monetary, 0.01) FROM trim_frequency)
                                                               AND (SELECT quantile_cont(monetary, 0.99) FROM trim_frequency)""",
        ),
        "rfm_histogram": q(
            "long_rfm",
            """, edges AS (SELECT measure, min(v) AS low, max(v) AS high FROM long_rfm GROUP BY measure),
               counted AS (SELECT measure, least(cast(floor((v - low) / (high - low) * 50) AS integer), 49) AS bin,
                                  count(*) AS n FROM long_rfm JOIN edges USING (measure) GROUP BY ALL)
               SELECT e.measure, cast(b.bin AS integer) AS bin, coalesce(n, 0) AS rows
               FROM edges e CROSS JOIN range(50) b(bin)
               LEFT JOIN counted c ON c.measure = e.measure AND c.bin = b.bin""",
        ),
        "outlier_rows_tight": q("quartiles", f"SELECT * FROM rfm WHERE {_fenced(0.5)}"),
        "outlier_histogram_tight": q(
            "quartiles",
            f""", out AS (SELECT * FROM rfm WHERE {_fenced(0.5)}),
               values_out AS (SELECT 'recency' AS measure, cast(recency AS double) AS v FROM out
                              UNION ALL SELECT 'frequency', cast(frequency AS double) FROM out
                              UNION ALL SELECT 'monetary', monetary FROM out),
               edges AS (SELECT measure, CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS low,
                                CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS high
                         FROM values_out GROUP BY measure),
               counted AS (SELECT measure, least(cast(floor((v - low) / (high - low) * 20) AS integer), 19) AS bin,
                                  count(*) AS n FROM values_out JOIN edges USING (measure) GROUP BY ALL)
               SELECT m.measure, cast(b.bin AS integer) AS bin, coalesce(n, 0) AS rows
               FROM (VALUES ('recency'), ('frequency'), ('monetary')) m(measure) CROSS JOIN range(20) b(bin)
               LEFT JOIN counted c ON c.measure = m.measure AND c.bin = b.bin""",
        ),
        "kmeans_segments": q(
            "quartiles",
            f"SELECT customer_id, country, recency, frequency, monetary, true AS nearest FROM rfm WHERE NOT ({_fenced(1.5)})",
        ),
        "kmeans_log_segments": q("trimmed", "SELECT customer_id, country, recency, frequency, monetary, true AS nearest FROM trimmed"),
        "sweep_of_given_centers": q(
            "scaled centers",
            """, near AS (
                   SELECT k, customer_id, country, any_value(recency_scaled) AS x, any_value(frequency_scaled) AS y,
                          any_value(monetary_scaled) AS z, arg_min(id, (dist, id)) AS c, min(dist) AS dist
                   FROM (SELECT *, (recency_scaled - cast(r AS double)) ** 2 + (frequency_scaled - cast(f AS double)) ** 2
                                   + (monetary_scaled - cast(m AS double)) ** 2 AS dist
                         FROM scaled, centers, (VALUES (2), (3), (4), (5)) ks(k) WHERE id < k)
                   GROUP BY k, customer_id, country),
               stats AS (SELECT k, c, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(z) AS sz, sum(x*x + y*y + z*z) AS psi
                         FROM near GROUP BY k, c),
               d AS (SELECT a.k, a.customer_id, a.country, a.dist, a.c = s.c AS own, s.n,
                            x*x + y*y + z*z + psi / n - 2 * (x*sx + y*sy + z*sz) / n AS mean
                     FROM near a JOIN stats s ON a.k = s.k),
               ab AS (SELECT k, customer_id, country, any_value(dist) AS dist, max(n) FILTER (WHERE own) AS n,
                             max(mean * n / nullif(n - 1, 0)) FILTER (WHERE own) AS a, min(mean) FILTER (WHERE NOT own) AS b
                      FROM d GROUP BY k, customer_id, country),
               scores AS (SELECT k, avg(CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END) AS s, sum(dist) AS e FROM ab GROUP BY k)
               SELECT cast(k AS integer) AS k, round(s, 6) AS silhouette, round(e, 6) AS wssse,
                      k = (SELECT arg_min(k, (-s, k)) FROM scores) AS selected FROM scores""",
        ),
        "pca_projection_log": q(
            "tested axes",
            """SELECT customer_id, country, prediction,
                      round((recency - ar) * p.x + (frequency - af) * p.y + (monetary - am) * p.z, 4) AS pc1,
                      round((recency - ar) * s.x + (frequency - af) * s.y + (monetary - am) * s.z, 4) AS pc2,
                      round(p.size / (rr + ff + mm), 6) AS pc1_ratio, round(s.size / (rr + ff + mm), 6) AS pc2_ratio
               FROM tested, cov, (SELECT * FROM axes WHERE n = 1) p, (SELECT * FROM axes WHERE n = 2) s""",
        ).replace("covar_samp(frequency, monetary) AS fm FROM rfm", "covar_samp(frequency, monetary) AS fm FROM tested"),
        "train_test_random": q("rfm", "SELECT customer_id, country, recency, frequency, monetary, true AS marked, true AS sized FROM rfm"),
        "quantile_trim_approx": """SELECT measure, cast(probability AS double) AS probability, true AS within
            FROM (VALUES ('recency', 0.01), ('recency', 0.99), ('frequency', 0.01), ('frequency', 0.99),
                         ('monetary', 0.01), ('monetary', 0.99), ('kept', 0.0)) v(measure, probability)""",
        "top_segment_profile_approx": q(
            "labeled",
            f"""SELECT round({_mean('recency')}, 1) AS avg_recency, round({_mean('frequency')}, 1) AS avg_frequency,
                       round({_mean('monetary')}, 2) AS avg_monetary, true AS p95_within
                FROM labeled WHERE segment = 'Champions'""",
        ),
        "segment_profile_log": q("labeled", f"SELECT prediction, {log_means} FROM labeled GROUP BY prediction"),
        "segment_profile_norm_log": q(
            "labeled", f"SELECT prediction, {norm} FROM (SELECT prediction, {plain_log_means} FROM labeled GROUP BY prediction)"
        ),
        # segments
        "assign_to_centers": q("assigned", "SELECT customer_id, country, recency, frequency, monetary, prediction FROM assigned"),
        "silhouette": q("assigned", silhouette),
        "cluster_ranking": q(
            "labeled",
            """SELECT DISTINCT r.prediction, round(avg_ltv, 4) AS avg_ltv, ltv_rank, segment
               FROM ranking r JOIN labeled USING (prediction)""",
        ),
        "segment_labels": q("labeled", "SELECT * FROM labeled"),
        "segment_scatter": q("labeled", members),
        "segment_stats": q(
            "labeled",
            f"""SELECT segment, count(*) AS customers, round({_mean('recency')}, 1) AS avg_recency_days,
                       round({_mean('frequency')}, 1) AS avg_frequency, round({_mean('monetary')}, 2) AS avg_monetary
                FROM labeled GROUP BY segment""",
        ),
        "segment_sizes": q("labeled", "SELECT segment, count(*) AS count FROM labeled GROUP BY segment"),
        "segment_coverage": q(
            "labeled",
            """SELECT segment, count(*) AS customers, round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS coverage_pct
               FROM labeled GROUP BY segment""",
        ),
        "top_segment_profile": q(
            "labeled",
            f"""SELECT round({_mean('recency')}, 1) AS avg_recency, round({_mean('frequency')}, 1) AS avg_frequency,
                       round({_mean('monetary')}, 2) AS avg_monetary, round(quantile_cont(monetary, 0.95), 2) AS p95_monetary
                FROM labeled WHERE segment = 'Champions'""",
        ),
        "segment_profile": q("labeled", f"SELECT prediction, {rounded_means} FROM labeled GROUP BY prediction"),
        "segment_profile_norm": q(
            "labeled", f"SELECT prediction, {norm} FROM (SELECT prediction, {means} FROM labeled GROUP BY prediction)"
        ),
        "pca_projection": q(
            "axes",
            """SELECT customer_id, country,
                      round((recency - ar) * p.x + (frequency - af) * p.y + (monetary - am) * p.z, 2) AS pc1,
                      round((recency - ar) * s.x + (frequency - af) * s.y + (monetary - am) * s.z, 2) AS pc2,
                      round(p.size / (rr + ff + mm), 6) AS pc1_ratio, round(s.size / (rr + ff + mm), 6) AS pc2_ratio
               FROM rfm, cov, (SELECT * FROM axes WHERE n = 1) p, (SELECT * FROM axes WHERE n = 2) s""",
        ),
        # declared outcomes
        "top20_customers": q("ranked", "SELECT rank, customer_id, country, monetary FROM ranked WHERE rank <= cut"),
        "pareto_curve": q(
            "ranked",
            """SELECT rank, customer_id, country, monetary,
                      round(cast(running AS double) / cast(everything AS double), 8) AS cumulative_share FROM ranked""",
        ),
        "pareto": q(
            "ranked",
            """SELECT customers, top_customers, revenue, top_revenue, round(100 * top_revenue / revenue, 4) AS top_share_pct,
                      100 * top_revenue / revenue >= 80 AS meets_target
               FROM (SELECT count(*) AS customers, count(*) FILTER (WHERE rank <= cut) AS top_customers,
                            cast(sum(spend) AS double) AS revenue,
                            cast(sum(spend) FILTER (WHERE rank <= cut) AS double) AS top_revenue FROM ranked)""",
        ),
        "ltv_multiple": q(
            "labeled",
            f"""SELECT round(a, 2) AS segment_avg, round(b, 2) AS overall_avg, round(a / b, 4) AS multiple,
                       a / b >= 3 AS meets_target
                FROM (SELECT (SELECT {_mean('monetary')} FROM labeled WHERE segment = 'Champions') AS a,
                             (SELECT {_mean('monetary')} FROM labeled) AS b)""",
        ),
        "segment_performance": q(
            "labeled",
            f"""SELECT segment, count(*) AS customers, cast(sum(cast(monetary AS decimal(18,4))) AS double) AS revenue,
                       round({_mean('monetary')}, 2) AS avg_revenue, round({_mean('frequency')}, 4) AS purchase_frequency,
                       round(100.0 * count(*) FILTER (WHERE frequency >= 2) / count(*), 4) AS retention_pct
                FROM labeled GROUP BY segment""",
        ),
        # streaming
        "stream_top_segment": q(
            "labeled", "SELECT customer_id, country, recency, frequency, monetary, segment FROM labeled WHERE segment = 'Champions'"
        ),
        "stream_updated_days": q("day_revenue", "SELECT * FROM day_revenue"),
        "stream_distinct_revenue": q(
            "cleaned",
            """SELECT cast(customer_id AS double) AS customer_id, date_trunc('day', invoice_date) AS day_start,
                      date_trunc('day', invoice_date) + INTERVAL 1 DAY AS day_end,
                      cast(round(sum(cast(total_price AS decimal(18,4))), 2) AS double) AS revenue
               FROM cleaned GROUP BY ALL
               HAVING day_end <= (SELECT max(invoice_date) FROM cleaned) - INTERVAL 60 DAY""",
        ),
        "daily_revenue_window": q("day_revenue", "SELECT * FROM day_revenue"),
        "stream_daily_revenue": q("day_revenue", "SELECT * FROM day_revenue"),
        "stream_closed_days": q(
            "day_revenue",
            "SELECT * FROM day_revenue WHERE day_end <= (SELECT max(ts) FROM events WHERE user_id IS NOT NULL) - INTERVAL 1 DAY",
        ),
        "stream_csv_revenue": q(
            "tx",
            """SELECT customer_id, date_trunc('day', invoice_date) AS day_start,
                      date_trunc('day', invoice_date) + INTERVAL 1 DAY AS day_end,
                      cast(round(sum(cast(quantity * price AS decimal(18,4))), 2) AS double) AS revenue
               FROM tx WHERE customer_id IS NOT NULL GROUP BY ALL""",
        ),
    }
