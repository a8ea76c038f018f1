"""The analyses the warehouse is built for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from snapstar import contracts as C
from snapstar.functions import cleaning as clean
from snapstar.operators.latest import latest_per_key
from snapstar.operators.median import grouped_median
from snapstar.session import settled


def host_snapshots(listings: DataFrame, **measures: Column) -> DataFrame:
    """One row per host and snapshot: the host fields of the listing of the lowest id."""
    first = F.min(F.struct("id", *[column.alias(name) for name, column in measures.items()]))
    return listings.groupBy("host_id", "snapshot_date").agg(first.alias("_first")).select(
        "host_id", "snapshot_date", *[f"_first.{name}" for name in measures]
    )


def _before(column: str, key: str) -> Column:
    """The value one snapshot earlier; a key has at most one row per snapshot."""
    return F.lag(column).over(Window.partitionBy(key).orderBy("snapshot_date"))


def superhost_transitions(listings: DataFrame) -> DataFrame:
    """Each host's step from one snapshot to the next: Lost, Gained, Retained or Never.

    Works on the raw history, where an unpublished status stays unknown (it would read as
    "not a superhost" in the fact). A host's first snapshot has no step.
    """
    steps = host_snapshots(listings, status=F.col("host_is_superhost")).select(
        "host_id", "snapshot_date", "status",
        _before("snapshot_date", "host_id").alias("previous_snapshot"),
        _before("status", "host_id").alias("previous_status"),
    ).where(F.col("previous_snapshot").isNotNull())
    was, now = F.col("previous_status") == "t", F.col("status") == "t"
    transition = (
        F.when(was & now, "Retained").when(was & ~now, "Lost").when(~was & now, "Gained")
        .when(~was & ~now, "Never").otherwise(C.UNKNOWN)
    )
    return steps.withColumn("transition", transition)


def superhost_trend(listings: DataFrame) -> DataFrame:
    """Hosts per snapshot and kind of step."""
    return superhost_transitions(listings).groupBy("snapshot_date", "transition").agg(
        F.count("*").alias("hosts")
    )


def license_transitions(fact: DataFrame) -> DataFrame:
    """Listings that gained or lost their licence, at the snapshot that shows it."""
    held = fact.select(
        "listing_id", "snapshot_date", "has_license",
        _before("has_license", "listing_id").alias("had_license"),
    )
    change = F.when(F.col("has_license") > F.col("had_license"), "Gained").when(
        F.col("has_license") < F.col("had_license"), "Lost"
    )
    return held.select("listing_id", "snapshot_date", change.alias("change")).where(
        F.col("change").isNotNull()
    )


def _price_by(fact: DataFrame, key: str, dim: DataFrame, label: str) -> DataFrame:
    """Price spread per snapshot and member.

    The facts are read once, into rows per price; spread and median come from those, and the
    members join last.
    """
    groups = ["snapshot_date", key]
    prices = settled(fact.groupBy(*groups, "price").agg(F.count("*").alias("_rows")))
    priced = F.when(F.col("price").isNotNull(), F.col("_rows"))
    spread = prices.groupBy(*groups).agg(
        F.sum("_rows").alias("listings"), F.coalesce(F.sum(priced), F.lit(0)).alias("priced"),
        F.min("price").alias("min_price"), F.max("price").alias("max_price"),
        clean.mean(F.sum(F.col("price") * F.col("_rows")), F.sum(priced)).alias("avg_price"),
    )
    middle = grouped_median(prices, groups, "price", "_rows")
    names = dim.select(key, label)
    return (
        spread.join(middle.withColumnRenamed("median", "median_price"), groups, "left")
        .join(names, key).drop(key)
    )


def price_by_neighbourhood(fact: DataFrame, locations: DataFrame) -> DataFrame:
    return _price_by(fact, "location_id", locations, "neighbourhood_cleansed")


def price_by_property_type(fact: DataFrame, property_types: DataFrame) -> DataFrame:
    return _price_by(fact, "property_id", property_types, "property_type")


def license_by_neighbourhood(fact: DataFrame, locations: DataFrame) -> DataFrame:
    """Where the unlicensed and exempt listings are, per snapshot."""
    counted = (
        fact.where(F.col("license_status") != "Licensed")
        .groupBy("snapshot_date", "location_id", "license_status")
        .agg(F.count("*").alias("listings"))
    )
    names = locations.select("location_id", "neighbourhood_cleansed")
    return counted.join(names, "location_id").drop("location_id")


def review_churn(fact: DataFrame) -> DataFrame:
    """Reviews per month with those still shown and those dropped, and growth on the month before.

    The month is that of the review's own date, so no calendar can leave a review out. A month
    before without reviews counts as 0; the first month has no growth.
    """
    monthly = fact.groupBy(
        F.year("date").alias("year"), F.month("date").alias("month"),
        F.date_format("date", "MMMM").alias("month_name"),
    ).agg(F.count("*").alias("reviews"), F.sum("is_active").alias("active"))
    in_time = Window.orderBy("year", "month")  # one row per month
    number = F.col("year") * 12 + F.col("month")
    before = F.when(F.lag(number).over(in_time) == number - 1, F.lag("reviews").over(in_time)).when(
        F.lag(number).over(in_time).isNotNull(), 0)
    return monthly.select(
        "*", (F.col("reviews") - F.col("active")).alias("dropped"),
        (F.col("reviews") - before).alias("growth"),
    )


def response_rate_before_loss(listings: DataFrame) -> DataFrame:
    """Hosts that lost superhost status: response rate then and one snapshot earlier.

    Needs the raw history, as the host dimension keeps the newest rate only.
    """
    hosts = host_snapshots(
        listings, status=F.col("host_is_superhost"),
        response_rate=clean.published_rate(F.col("host_response_rate")),
        acceptance_rate=clean.published_rate(F.col("host_acceptance_rate")),
    )
    steps = hosts.select(
        "host_id", "snapshot_date", "status", "response_rate", "acceptance_rate",
        _before("status", "host_id").alias("previous_status"),
        _before("response_rate", "host_id").alias("previous_response_rate"),
        _before("acceptance_rate", "host_id").alias("previous_acceptance_rate"),
    )
    lost = (F.col("previous_status") == "t") & (F.col("status") == "f")
    return steps.where(lost).select(
        "host_id", "snapshot_date", "previous_response_rate", "response_rate",
        (F.col("response_rate") - F.col("previous_response_rate")).alias("response_change"),
        "previous_acceptance_rate", "acceptance_rate",
        (F.col("acceptance_rate") - F.col("previous_acceptance_rate")).alias("acceptance_change"),
    )


def average_rates(hosts: DataFrame) -> DataFrame:
    """Mean host rates over the hosts that publish one, and how many do."""
    known = F.col("host_id") != C.UNKNOWN_KEY

    def of(rate: str, short: str) -> list[Column]:
        published = F.nullif(F.col(rate), F.lit(C.NO_RATE).cast("decimal(5,2)"))
        return [
            clean.mean(F.sum(published), F.count(published)).alias(f"avg_{short}_rate"),
            F.count(published).alias(f"{short}_hosts"),
            (F.count("*") - F.count(published)).alias(f"{short}_hosts_without"),
        ]

    return hosts.where(known).agg(
        *of("host_response_rate", "response"), *of("host_acceptance_rate", "acceptance")
    )


def host_tenure(listings: DataFrame) -> DataFrame:
    """Days and calendar months from joining to the newest snapshot, per host."""
    newest = latest_per_key(
        listings.withColumn("_seen", F.col("snapshot_date")),
        "host_id", "snapshot_date", "id", ["host_since", "_seen"],
    )
    since, seen = F.col("host_since"), F.col("_seen")
    months = (F.year(seen) - F.year(since)) * 12 + F.month(seen) - F.month(since)
    return newest.select(
        "host_id", since.alias("host_since"), seen.alias("as_of"),
        F.date_diff(seen, since).alias("tenure_days"), months.alias("tenure_months"),
    )


def host_fields() -> dict[str, Column]:
    """The values that make a host's version."""
    return {
        "host_response_time": clean.or_unknown_whole(F.col("host_response_time")),
        "host_response_rate": clean.rate(F.col("host_response_rate")),
        "host_acceptance_rate": clean.rate(F.col("host_acceptance_rate")),
        "host_is_superhost": clean.flag(F.col("host_is_superhost")),
    }


def host_versions(listings: DataFrame) -> DataFrame:
    """History of a host's rates and response time: one row per unbroken stretch of values.

    ``valid_to`` is the snapshot at which the next version appears, null for the current one.
    """
    fields = host_fields()
    per_host = Window.partitionBy("host_id").orderBy("snapshot_date")
    state = F.struct(*fields)
    seen = host_snapshots(listings, **fields).withColumn(
        "_changed", ~state.eqNullSafe(F.lag(state).over(per_host))
    )
    starts = seen.where("_changed").drop("_changed")
    return starts.select(
        "host_id", *fields, F.col("snapshot_date").alias("valid_from"),
        F.lead("snapshot_date").over(per_host).alias("valid_to"),
    ).withColumn("is_current", F.col("valid_to").isNull().cast("int"))
