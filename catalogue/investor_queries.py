"""The analyses the warehouse is built for."""

from __future__ import annotations

from catalogue.registry import query
from catalogue.sql_views import rate, unknown_whole
from catalogue.star_queries import Star
from snapstar.plans import facts, investor

_PUBLISHED = "nullif({0}, -1)"
_HOST_STEPS = f"""
    host_steps AS (
      SELECT *, lag(snapshot_date) OVER w AS previous_snapshot,
             lag(status) OVER w AS previous_status,
             lag(response_rate) OVER w AS previous_response_rate,
             lag(acceptance_rate) OVER w AS previous_acceptance_rate
      FROM (SELECT host_id, snapshot_date, host_is_superhost AS status,
                   nullif({rate('host_response_rate')}, -1) AS response_rate,
                   nullif({rate('host_acceptance_rate')}, -1) AS acceptance_rate
            FROM listings
            QUALIFY row_number() OVER (PARTITION BY host_id, snapshot_date ORDER BY id) = 1)
      WINDOW w AS (PARTITION BY host_id ORDER BY snapshot_date))"""
_STEP = """CASE previous_status || status WHEN 'tt' THEN 'Retained' WHEN 'tf' THEN 'Lost'
           WHEN 'ft' THEN 'Gained' WHEN 'ff' THEN 'Never' ELSE 'Unknown' END AS transition"""


@query("listings", f"""WITH {_HOST_STEPS}
    SELECT host_id, snapshot_date, status, previous_snapshot, previous_status, {_STEP}
    FROM host_steps WHERE previous_snapshot IS NOT NULL""")
def superhost_transitions(spark, sf_dir):
    return investor.superhost_transitions(Star(spark, sf_dir).listings)


@query("listings", f"""WITH {_HOST_STEPS}
    SELECT snapshot_date, transition, count(*) AS hosts
    FROM (SELECT snapshot_date, {_STEP} FROM host_steps WHERE previous_snapshot IS NOT NULL)
    GROUP BY snapshot_date, transition""")
def superhost_trend(spark, sf_dir):
    return investor.superhost_trend(Star(spark, sf_dir).listings)


@query("fact_listings", """
    SELECT listing_id, snapshot_date, CASE WHEN has_license = 1 THEN 'Gained' ELSE 'Lost' END
             AS change
    FROM (SELECT listing_id, snapshot_date, has_license,
                 lag(has_license) OVER (PARTITION BY listing_id ORDER BY snapshot_date) AS had
          FROM fact_listings)
    WHERE had <> has_license""")
def license_transitions(spark, sf_dir):
    return investor.license_transitions(Star(spark, sf_dir).listing_facts)


def _price_sql(dim: str, key: str, label: str) -> str:
    return f"""
    SELECT f.snapshot_date, d.{label}, count(*) AS listings, count(price) AS priced,
           CAST(min(price) AS DOUBLE) AS min_price, CAST(max(price) AS DOUBLE) AS max_price,
           CAST(sum(price) AS DOUBLE) / count(price) AS avg_price,
           CAST(quantile_disc(price, 0.5) + (-quantile_disc(-price, 0.5)) AS DOUBLE) / 2
             AS median_price
    FROM fact_listings f JOIN {dim} d ON d.{key} = f.{key}
    GROUP BY f.snapshot_date, d.{label}"""


@query("fact_listings dim_location",
       _price_sql("dim_location", "location_id", "neighbourhood_cleansed"))
def price_by_neighbourhood(spark, sf_dir):
    star = Star(spark, sf_dir)
    return investor.price_by_neighbourhood(
        facts.with_location_key(star.listing_facts, star.dim_location), star.dim_location
    )


@query("fact_listings dim_property_type",
       _price_sql("dim_property_type", "property_id", "property_type"))
def price_by_property_type(spark, sf_dir):
    star = Star(spark, sf_dir)
    return investor.price_by_property_type(
        facts.with_property_key(star.listing_facts, star.dim_property_type),
        star.dim_property_type,
    )


@query("fact_listings dim_location", """
    SELECT snapshot_date, neighbourhood_cleansed, license_status, count(*) AS listings
    FROM fact_listings JOIN dim_location USING (location_id)
    WHERE license_status IN ('Exempt', 'Unknown')
    GROUP BY snapshot_date, neighbourhood_cleansed, license_status""")
def license_by_neighbourhood(spark, sf_dir):
    star = Star(spark, sf_dir)
    return investor.license_by_neighbourhood(
        facts.with_location_key(star.listing_facts, star.dim_location), star.dim_location
    )


@query("fact_reviews", """WITH months AS (
      SELECT date_trunc('month', date) AS m, count(*) AS reviews,
             CAST(sum(is_active) AS BIGINT) AS active
      FROM fact_reviews GROUP BY ALL)
    SELECT CAST(year(a.m) AS INT) AS year, CAST(month(a.m) AS INT) AS month,
           monthname(a.m) AS month_name, a.reviews, a.active, a.reviews - a.active AS dropped,
           CASE WHEN a.m > (SELECT min(m) FROM months)
                THEN a.reviews - coalesce(b.reviews, 0) END AS growth
    FROM months a LEFT JOIN months b ON b.m = a.m - INTERVAL 1 MONTH""")
def review_churn(spark, sf_dir):
    return investor.review_churn(Star(spark, sf_dir).fact_reviews)


def _dbl(expression: str, name: str) -> str:
    return f"CAST({expression} AS DOUBLE) AS {name}"


@query("listings", f"""WITH {_HOST_STEPS}
    SELECT host_id, snapshot_date,
           {_dbl('previous_response_rate', 'previous_response_rate')},
           {_dbl('response_rate', 'response_rate')},
           {_dbl('response_rate - previous_response_rate', 'response_change')},
           {_dbl('previous_acceptance_rate', 'previous_acceptance_rate')},
           {_dbl('acceptance_rate', 'acceptance_rate')},
           {_dbl('acceptance_rate - previous_acceptance_rate', 'acceptance_change')}
    FROM host_steps WHERE previous_status = 't' AND status = 'f'""")
def response_rate_before_loss(spark, sf_dir):
    return investor.response_rate_before_loss(Star(spark, sf_dir).listings)


@query("dim_host", """
    SELECT CAST(sum(r) AS DOUBLE) / count(r) AS avg_response_rate, count(r) AS response_hosts,
           count(*) - count(r) AS response_hosts_without,
           CAST(sum(a) AS DOUBLE) / count(a) AS avg_acceptance_rate, count(a) AS acceptance_hosts,
           count(*) - count(a) AS acceptance_hosts_without
    FROM (SELECT nullif(host_response_rate, -1) AS r, nullif(host_acceptance_rate, -1) AS a
          FROM dim_host WHERE host_id <> 0)""")
def avg_response_rate_excl_sentinel(spark, sf_dir):
    return investor.average_rates(Star(spark, sf_dir).dim_host)


@query("listings", """
    SELECT host_id, host_since, as_of, CAST(as_of - host_since AS INT) AS tenure_days,
           CAST(date_diff('month', host_since, as_of) AS INT) AS tenure_months
    FROM (SELECT host_id, min(host_since) AS host_since, max(snapshot_date) AS as_of
          FROM listings GROUP BY host_id)""")
def host_tenure(spark, sf_dir):
    return investor.host_tenure(Star(spark, sf_dir).listings)


HOST_VERSIONS_SQL = f"""
    SELECT host_id, host_response_time, CAST(rr AS DOUBLE) AS host_response_rate,
           CAST(ar AS DOUBLE) AS host_acceptance_rate, host_is_superhost,
           snapshot_date AS valid_from, lead(snapshot_date) OVER w AS valid_to,
           CASE WHEN lead(snapshot_date) OVER w IS NULL THEN 1 ELSE 0 END AS is_current
    FROM (
      SELECT *, (host_response_time, rr, ar, host_is_superhost) IS DISTINCT FROM
             lag((host_response_time, rr, ar, host_is_superhost))
               OVER (PARTITION BY host_id ORDER BY snapshot_date) AS changed
      FROM (SELECT host_id, snapshot_date,
                   {unknown_whole('host_response_time')} AS host_response_time,
                   {rate('host_response_rate')} AS rr, {rate('host_acceptance_rate')} AS ar,
                   CASE WHEN host_is_superhost = 't' THEN 1 ELSE 0 END AS host_is_superhost
            FROM {{0}}
            QUALIFY row_number() OVER (PARTITION BY host_id, snapshot_date ORDER BY id) = 1))
    WHERE changed
    WINDOW w AS (PARTITION BY host_id ORDER BY snapshot_date)"""


@query("listings", HOST_VERSIONS_SQL.format("listings"))
def dim_host_scd2(spark, sf_dir):
    return investor.host_versions(Star(spark, sf_dir).listings)
