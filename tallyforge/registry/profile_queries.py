"""Column profiles and the numbers behind charts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.distributions import (
    box_plot,
    correlation_matrix,
    correlations,
    histogram,
    profile,
    summary,
)
from tallyforge.plans.passengers import fill_gaps, long_report, report
from tallyforge.registry.catalog import Catalog
from tallyforge.registry.quality_queries import GAPPED_SQL, gapped
from tallyforge.sources.tables import Tables

catalog = Catalog()

_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _union(template: str, columns: list[str] = _COLUMNS) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in columns)


@catalog.query(
    _union(
        """SELECT '{c}' AS "column", COUNT({c}) AS "count", ROUND(AVG({c}), 5) AS mean,
                  ROUND(STDDEV_SAMP({c}), 5) AS stddev, MIN({c}) AS "min", MAX({c}) AS "max" FROM lineitem"""
    )
)
def profile_numeric(t: Tables) -> DataFrame:
    return profile(t.lineitem, _COLUMNS).withColumns({c: F.round(c, 5) for c in ("mean", "stddev")})


@catalog.query(
    """WITH s AS (SELECT COUNT(l_quantity) AS n1, AVG(l_quantity) AS m1, STDDEV_SAMP(l_quantity) AS s1,
                         MIN(l_quantity) AS lo1, MAX(l_quantity) AS hi1, COUNT(l_tax) AS n2, AVG(l_tax) AS m2,
                         STDDEV_SAMP(l_tax) AS s2, MIN(l_tax) AS lo2, MAX(l_tax) AS hi2 FROM lineitem)
       SELECT 'count' AS summary, CAST(n1 AS DOUBLE) AS l_quantity, CAST(n2 AS DOUBLE) AS l_tax FROM s
       UNION ALL SELECT 'mean', ROUND(m1, 5), ROUND(m2, 5) FROM s
       UNION ALL SELECT 'stddev', ROUND(s1, 5), ROUND(s2, 5) FROM s
       UNION ALL SELECT 'min', lo1, lo2 FROM s
       UNION ALL SELECT 'max', hi1, hi2 FROM s"""
)
def describe_table(t: Tables) -> DataFrame:
    described = summary(t.lineitem, ["l_quantity", "l_tax"])
    return described.withColumns({c: F.round(F.col(c).cast("double"), 5) for c in ("l_quantity", "l_tax")})


_PAIRS_SQL = " UNION ALL ".join(
    f"""SELECT '{a}' AS "left", '{b}' AS "right", {f"ROUND(CORR({a}, {b}), 6)" if a != b else "CAST(1 AS DOUBLE)"}
        AS correlation FROM lineitem {"" if a != b else "HAVING COUNT(*) > 0"}"""
    for a in _COLUMNS
    for b in _COLUMNS
)


@catalog.query(_PAIRS_SQL)
def corr_pairs(t: Tables) -> DataFrame:
    return correlations(t.lineitem, _COLUMNS).withColumn("correlation", F.round("correlation", 6))


@catalog.query(_PAIRS_SQL)
def corr_matrix(t: Tables) -> DataFrame:
    return correlation_matrix(t.lineitem, _COLUMNS).withColumn("correlation", F.round("correlation", 6))


@catalog.query(
    """WITH r AS (SELECT MIN(o_totalprice) AS lo, (MAX(o_totalprice) - MIN(o_totalprice)) / 20 AS width FROM orders),
            c AS (SELECT LEAST(CAST(FLOOR((o_totalprice - lo) / width) AS BIGINT), 19) AS bin, COUNT(*) AS n
                  FROM orders, r GROUP BY 1)
       SELECT b.bin, ROUND(lo + b.bin * width, 4) AS lower, ROUND(lo + (b.bin + 1) * width, 4) AS upper,
              COALESCE(n, 0) AS "count"
       FROM (SELECT unnest(range(20)) AS bin) b CROSS JOIN r LEFT JOIN c ON b.bin = c.bin"""
)
def histogram_20(t: Tables) -> DataFrame:
    return histogram(t.orders, "o_totalprice", 20).withColumns({c: F.round(c, 4) for c in ("lower", "upper")})


@catalog.query(
    """WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1,
                         quantile_cont(l_extendedprice, 0.5) AS median, quantile_cont(l_extendedprice, 0.75) AS q3
                  FROM lineitem GROUP BY l_returnflag)
       SELECT l_returnflag, CAST(COUNT(*) AS BIGINT) AS "count", MIN(l_extendedprice) AS "min", ROUND(q1, 4) AS q1,
              ROUND(median, 4) AS median, ROUND(q3, 4) AS q3, MAX(l_extendedprice) AS "max",
              ROUND(LEAST(MIN(l_extendedprice) FILTER (l_extendedprice >= q1 - 1.5 * (q3 - q1)), q1), 4) AS whisker_low,
              ROUND(GREATEST(MAX(l_extendedprice) FILTER (l_extendedprice <= q3 + 1.5 * (q3 - q1)), q3), 4) AS whisker_high,
              COUNT(*) FILTER (l_extendedprice NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
       FROM lineitem JOIN q USING (l_returnflag) GROUP BY l_returnflag, q1, median, q3"""
)
def boxplot_summary(t: Tables) -> DataFrame:
    boxes = box_plot(t.lineitem, "l_extendedprice", ["l_returnflag"])
    rounded = ("q1", "median", "q3", "whisker_low", "whisker_high")
    return boxes.withColumns({c: F.round(c, 4) for c in rounded})


@catalog.query(
    f"""WITH {GAPPED_SQL},
            filled AS (SELECT o_orderkey, COALESCE(priority, 'unknown') AS priority,
                              COALESCE(price, (SELECT quantile_disc(price, 0.5) FROM gapped)) AS price FROM gapped)
        SELECT 'price' AS "column", COUNT(price) AS "count", ROUND(AVG(price), 4) AS mean,
               ROUND(STDDEV_SAMP(price), 4) AS stddev, MIN(price) AS "min", MAX(price) AS "max" FROM filled"""
)
def profile_filled(t: Tables) -> DataFrame:
    raw = gapped(t)
    filled = fill_gaps(raw, {"priority": "unknown", "status": "unknown"}, ["price"], accuracy=None)
    statistics = report(raw, filled, ["price"], "priority", "price")["statistics"]
    return statistics.withColumns({c: F.round(c, 4) for c in ("mean", "stddev")})


def _filled_sql() -> str:
    """All tables of the profile of the filled rows as long rows."""
    def long(part: str, item: str, columns: dict[str, str], source: str) -> str:
        return " UNION ALL ".join(
            f"SELECT '{part}' AS part, {item} AS item, '{name}' AS measure, CAST({value} AS DOUBLE) AS value FROM {source}"
            for name, value in columns.items()
        )

    columns = ("o_orderkey", "priority", "status", "price")
    box = ("count", "min", "q1", "median", "q3", "max", "whisker_low", "whisker_high", "outliers")
    parts = [
        long("nulls_before", "''", {c: f"COUNT(*) - COUNT({c})" for c in columns}, "gapped"),
        long("nulls_after", "''", {c: f"COUNT(*) - COUNT({c})" for c in columns}, "filled"),
        *(
            long("statistics", f"'{c}'", {"count": f"COUNT({c})", "mean": f"AVG({c})", "stddev": f"STDDEV_SAMP({c})", "min": f"MIN({c})", "max": f"MAX({c})"}, "filled")
            for c in ("o_orderkey", "price")
        ),
        *(long("percentiles", f"'{c}/{p}'", {"value": f"quantile_disc({c}, {p})"}, "filled") for c in ("o_orderkey", "price") for p in (0.25, 0.5, 0.75)),
        *(
            long("correlations", f"'{a}/{b}'", {"correlation": "1" if a == b else "CORR(o_orderkey, price)"}, "filled" if a != b else "(SELECT 1)")
            for a in ("o_orderkey", "price")
            for b in ("o_orderkey", "price")
        ),
        long("label_counts", "priority", {"count": "COUNT(*)"}, "filled GROUP BY priority"),
        long("histogram", "CAST(bin AS VARCHAR)", {"lower": "lo + bin * width", "upper": "lo + (bin + 1) * width", "count": "COALESCE(n, 0)"}, "bins"),
        long("box_plots", "priority", {c: f'"{c}"' for c in box}, "boxes"),
    ]
    rows = " UNION ALL ".join(parts)
    return f"""WITH {GAPPED_SQL},
        filled AS (SELECT o_orderkey, COALESCE(priority, 'unknown') AS priority, COALESCE(status, 'unknown') AS status,
                          COALESCE(price, (SELECT quantile_disc(price, 0.5) FROM gapped)) AS price FROM gapped),
        r AS (SELECT MIN(price) AS lo, (MAX(price) - MIN(price)) / 20 AS width FROM filled),
        c AS (SELECT LEAST(CAST(FLOOR((price - lo) / width) AS BIGINT), 19) AS bin, COUNT(*) AS n FROM filled, r GROUP BY 1),
        bins AS (SELECT b.bin, lo, width, n FROM (SELECT unnest(range(20)) AS bin) b CROSS JOIN r LEFT JOIN c ON b.bin = c.bin),
        q AS (SELECT priority, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS median,
                     quantile_cont(price, 0.75) AS q3 FROM filled GROUP BY priority),
        boxes AS (SELECT priority, COUNT(*) AS "count", MIN(price) AS "min", q1, median, q3, MAX(price) AS "max",
                         LEAST(MIN(price) FILTER (price >= q1 - 1.5 * (q3 - q1)), q1) AS whisker_low,
                         GREATEST(MAX(price) FILTER (price <= q3 + 1.5 * (q3 - q1)), q3) AS whisker_high,
                         COUNT(*) FILTER (price NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
                  FROM filled JOIN q USING (priority) GROUP BY priority, q1, median, q3),
        long AS ({rows})
        SELECT part, item, measure, ROUND(value, 3) AS value FROM long"""


@catalog.query(_filled_sql())
def passenger_profile(t: Tables) -> DataFrame:
    raw = gapped(t)
    filled = fill_gaps(raw, {"priority": "unknown", "status": "unknown"}, ["price"], accuracy=None)
    tables = report(raw, filled, ["o_orderkey", "price"], "priority", "price")
    labels = {
        "statistics": ["column"],
        "percentiles": ["column", "p"],
        "correlations": ["left", "right"],
        "label_counts": ["priority"],
        "histogram": ["bin"],
        "box_plots": ["priority"],
    }
    return long_report(tables, labels).withColumn("value", F.round("value", 3))
