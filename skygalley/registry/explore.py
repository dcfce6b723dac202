"""Exploratory statistics of the cleaned fresh-food mart."""

from __future__ import annotations

from pyspark.sql import functions as F

from skygalley.forecast.preparation import LEVELS
from skygalley.functions import bucket, ratio
from skygalley.operators import stats
from skygalley.registry.base import Lab, query, register
from skygalley.registry.forecast import features
from skygalley.registry.oracle import rint

_SUMMARY = {
    "flight_key": "string",
    "origin": "string",
    "destination": "string",
    "day_period": "string",
    "pax_bin": "string",
    "item_id": "string",
    "sold_quantity": "bigint",
    "number_of_passengers": "double",
}


@query(
    "eda_summary",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, '{t}' AS type, count(*) - count({c}) AS nulls,
        count(DISTINCT {c}) AS distinct_values FROM fc_features"""
        for c, t in _SUMMARY.items()
    ),
)
def _summary(lab: Lab):
    return stats.summary(features(lab), list(_SUMMARY))


_NUMERIC = ("sold_quantity", "price", "hour_of_departure", "number_of_passengers")


def _round(df, *columns: str):
    """Sums of doubles depend on their order in the last digits; nine decimals do not."""
    return df.select(*[F.round(c, 9).alias(c) if c in columns else F.col(c) for c in df.columns])


@query(
    "eda_describe",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS n, round(avg(CAST({c} AS DOUBLE)), 9) AS mean,
        round(stddev_samp(CAST({c} AS DOUBLE)), 9) AS std, CAST(min({c}) AS DOUBLE) AS min,
        round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 9) AS q25,
        round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 9) AS median,
        round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 9) AS q75,
        CAST(max({c}) AS DOUBLE) AS max FROM fc_features"""
        for c in _NUMERIC
    ),
)
def _describe(lab: Lab):
    return _round(stats.describe(features(lab), _NUMERIC), "mean", "std", "q25", "median", "q75")


@query(
    "eda_skew_kurt",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, round(skewness(CAST({c} AS DOUBLE)), 6) AS skewness,
        round(kurtosis(CAST({c} AS DOUBLE)), 6) AS kurtosis FROM fc_features"""
        for c in _NUMERIC
    ),
)
def _shape(lab: Lab):
    df = stats.shape(features(lab), _NUMERIC)
    return df.select(
        "column_name", F.round("skewness", 6).alias("skewness"), F.round("kurtosis", 6).alias("kurtosis")
    )


@query(
    "eda_quantiles",
    " UNION ALL ".join(
        f"SELECT CAST({p} AS DOUBLE) AS point, round(quantile_cont(CAST(sold_quantity AS DOUBLE), {p}), 9) AS value FROM fc_features"
        for p in stats.PERCENTILES
    ),
)
def _quantiles(lab: Lab):
    return _round(stats.quantiles(features(lab), "sold_quantity"), "value")


_BOUNDS = """SELECT q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM (
    SELECT quantile_cont(CAST(sold_quantity AS DOUBLE), 0.25) AS q1,
           quantile_cont(CAST(sold_quantity AS DOUBLE), 0.75) AS q3 FROM fc_features)"""


@query(
    "eda_iqr",
    f"""SELECT count(*) FILTER (sold_quantity < lower OR sold_quantity > upper) AS outliers, count(*) AS n,
        CAST(count(*) FILTER (sold_quantity < lower OR sold_quantity > upper) AS DOUBLE) / count(*) AS share,
        min(lower) AS lower, min(upper) AS upper FROM fc_features, ({_BOUNDS})""",
)
def _iqr(lab: Lab):
    return stats.outlier_share(features(lab), "sold_quantity")


@query(
    "eda_outliers",
    f"""SELECT flight_key, item_id, sold_quantity FROM fc_features, ({_BOUNDS})
        WHERE sold_quantity < lower OR sold_quantity > upper""",
)
def _outliers(lab: Lab):
    return stats.outliers(features(lab), "sold_quantity").select("flight_key", "item_id", "sold_quantity")


@query(
    "eda_zero_share",
    """SELECT count(*) FILTER (sold_quantity = 0) AS zeros, count(*) FILTER (sold_quantity > 0) AS non_zeros,
       CAST(count(*) FILTER (sold_quantity = 0) AS DOUBLE) / count(*) AS zero_share,
       CAST(count(*) FILTER (sold_quantity > 0) AS DOUBLE) / count(*) AS non_zero_share FROM fc_features""",
)
def _zeros(lab: Lab):
    return stats.zero_share(features(lab), "sold_quantity")


@query(
    "eda_corr",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(corr(CAST({c} AS DOUBLE), CAST(sold_quantity AS DOUBLE)), 9) AS correlation FROM fc_features"
        for c in ("price", "hour_of_departure", "year", "number_of_passengers")
    ),
)
def _corr(lab: Lab):
    columns = ("price", "hour_of_departure", "year", "number_of_passengers")
    return _round(stats.correlations(features(lab), columns, "sold_quantity"), "correlation")


# --- groups -------------------------------------------------------------------------------------

_STATS = f"""{rint("CAST(sum(sold_quantity) AS DOUBLE) / nullif(count(sold_quantity), 0)", 2)} AS mean,
       CAST(sum(sold_quantity) AS BIGINT) AS total, count(sold_quantity) AS observations"""

for _key in (
    "item_id",
    "day_period",
    "is_weekend",
    "price",
    "hour_of_departure",
    "weekday_name",
    "month_name",
    "date",
):
    _column = "CAST(price AS DOUBLE)" if _key == "price" else _key
    register(
        f"eda_group_stats_{_key}",
        lambda lab, k=_key: stats.group_stats(
            features(lab), F.col(k).cast("double") if k == "price" else k, "sold_quantity", k
        ),
        f"SELECT {_column} AS {_key}, {_STATS} FROM fc_features WHERE {_key} IS NOT NULL GROUP BY 1",
    )

_PLACES = {
    "route": (lambda: F.concat("origin", F.lit(" -> "), "destination"), "origin || ' -> ' || destination"),
    "origin": (lambda: F.col("origin"), "origin"),
    "destination": (lambda: F.col("destination"), "destination"),
}
for _name, (_place, _text) in _PLACES.items():
    register(
        f"eda_route_rank_{_name}",
        lambda lab, p=_place, n=_name: stats.flight_rank(features(lab), p(), n, "sold_quantity"),
        f"""SELECT place AS {_name}, {rint("CAST(total_qty AS DOUBLE) / num_flights", 2)} AS avg_qty_per_flight,
            total_qty, num_flights FROM (
              SELECT {_text} AS place, CAST(sum(sold_quantity) AS BIGINT) AS total_qty,
                     count(DISTINCT flight_key) AS num_flights FROM fc_features GROUP BY 1)
            ORDER BY total_qty DESC, place LIMIT 10""",
    )


@query(
    "eda_pax_bin_stats",
    """SELECT pax_bin, CAST(sum(sold_quantity) AS BIGINT) AS total_sales, count(flight_key) AS flights_count,
       round(sum(number_of_passengers), 6) AS total_pax,
       CAST(sum(sold_quantity) AS DOUBLE) / count(flight_key) AS avg_sale_per_flight,
       round(CAST(sum(sold_quantity) AS DOUBLE) / nullif(sum(number_of_passengers), 0), 9) AS avg_sale_per_pax
       FROM fc_features WHERE pax_bin IS NOT NULL GROUP BY pax_bin""",
)
def _pax_bins(lab: Lab):
    bins = features(lab).where("pax_bin is not null").groupBy("pax_bin")
    total, flights, pax = F.sum("sold_quantity"), F.count("flight_key"), F.sum("number_of_passengers")
    return bins.agg(
        total.alias("total_sales"),
        flights.alias("flights_count"),
        F.round(pax, 6).alias("total_pax"),
        ratio(total, flights).alias("avg_sale_per_flight"),
        F.round(ratio(total, pax), 9).alias("avg_sale_per_pax"),
    )


# The price classes of the exploration, scaled to the prices of the test tables.
_PRICE_EDGES, _PRICE_LABELS = (0, 1000, 1500, 3000), ("Low", "Medium", "High")


@query(
    "eda_price_bin",
    f"""SELECT price_bin, {_STATS} FROM (SELECT *, CASE WHEN price <= 0 THEN NULL WHEN price <= 1000 THEN 'Low'
        WHEN price <= 1500 THEN 'Medium' WHEN price <= 3000 THEN 'High' END AS price_bin FROM fc_features)
        WHERE price_bin IS NOT NULL GROUP BY price_bin""",
)
def _price_bins(lab: Lab):
    label = bucket(F.col("price"), _PRICE_EDGES, _PRICE_LABELS)
    return stats.group_stats(features(lab), label, "sold_quantity", "price_bin")


@query(
    "eda_level_coverage",
    " UNION ALL ".join(
        f"""SELECT {i} AS level, count(*) AS total_groups, count(*) FILTER (n < 5) AS groups_below,
        100.0 - 100.0 * (CAST(count(*) FILTER (n < 5) AS DOUBLE) / nullif(count(*), 0)) AS coverage_pct
        FROM (SELECT count(sold_quantity) AS n FROM fc_features GROUP BY {", ".join(keys)})"""
        for i, keys in enumerate(LEVELS[:3], start=1)
    ),
)
def _levels(lab: Lab):
    return stats.level_coverage(features(lab), LEVELS[:3], lab.forecast.min_samples)
