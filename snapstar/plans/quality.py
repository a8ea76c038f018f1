"""Gates and reports on the archives and the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from snapstar import contracts as C
from snapstar.operators.matching import unmatched_rows
from snapstar.operators.tallies import null_rows, repeated_keys, row_counts, stacked

# Table -> its key.
PRIMARY_KEYS = {
    "DimHost": ["host_id"], "DimListings": ["listing_id"], "DimLocation": ["location_id"],
    "DimPropertyType": ["property_id"], "DimRoomType": ["room_id"], "DimDate": ["date_id"],
    "FactListings": ["listing_id", "snapshot_date"], "FactReviews": ["review_id"],
}
# (fact, its key, dimension, its key)
RELATIONS = [
    ("FactListings", "host_id", "DimHost", "host_id"),
    ("FactListings", "property_id", "DimPropertyType", "property_id"),
    ("FactListings", "room_id", "DimRoomType", "room_id"),
    ("FactListings", "location_id", "DimLocation", "location_id"),
    ("FactListings", "listing_id", "DimListings", "listing_id"),
    ("FactReviews", "listing_id", "DimListings", "listing_id"),
    ("FactReviews", "date", "DimDate", "date"),
]


def duplicate_listing_snapshots(listings: DataFrame) -> DataFrame:
    """(id, snapshot_date) pairs that occur more than once; none are allowed."""
    return repeated_keys(listings, ["id", "snapshot_date"])


def untagged(listings: DataFrame, reviews: DataFrame) -> DataFrame:
    """Rows without a snapshot date, and listings without a category; all should be 0."""
    tagged = listings.agg(
        null_rows("snapshot_date").alias("listings.snapshot_date"),
        null_rows("property_category").alias("listings.property_category"),
    )
    names = ["`listings.snapshot_date`", "`listings.property_category`"]
    long = tagged.unpivot([], names, "tag", "untagged_rows")
    dated = reviews.agg(null_rows("snapshot_date").alias("untagged_rows"))
    return long.unionByName(dated.select(F.lit("reviews.snapshot_date").alias("tag"), "*"))


def append_reconcile(staged: dict[str, DataFrame], archived: dict[str, DataFrame]) -> DataFrame:
    """Rows staged and rows archived per table; they must be equal before staging goes."""
    before = row_counts(staged).withColumnRenamed("row_count", "staged_count")
    after = row_counts(archived).withColumnRenamed("row_count", "appended_count")
    return before.join(after, "table_name").withColumn(
        "agrees", F.col("staged_count") == F.col("appended_count")
    )


def history_counts(listings: DataFrame, reviews: DataFrame) -> DataFrame:
    """Rows per archive and snapshot."""
    return row_counts({"listings": listings, "reviews": reviews}, by="snapshot_date")


def orphan_hosts(fact: DataFrame, hosts: DataFrame) -> DataFrame:
    return unmatched_rows(fact, "host_id", hosts, "host_id").toDF("orphaned_host_ids")


def orphan_reviews(fact: DataFrame, listings: DataFrame) -> DataFrame:
    """Reviews of listings no snapshot holds any more; some are expected."""
    orphans = unmatched_rows(fact, "listing_id", listings, "listing_id")
    return orphans.toDF("orphaned_review_listing_ids")


def primary_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Repeated keys per table; all should be 0."""
    return stacked([
        repeated_keys(tables[name], key).agg(F.count("*").alias("duplicate_keys"))
        .select(F.lit(name).alias("table_name"), "duplicate_keys")
        for name, key in PRIMARY_KEYS.items() if name in tables
    ])


def foreign_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Fact rows without a dimension member, per relation.

    Each fact is read once: all its keys are counted together, and the counts, one row per
    relation and key, are matched with the members of all dimensions in one join.
    """
    def number(rows: DataFrame, column: str):
        is_date = dict(rows.dtypes)[column] == "date"
        return F.unix_date(column).cast("bigint") if is_date else F.col(column).cast("bigint")

    used, members = [], []
    for fact in dict.fromkeys(relation[0] for relation in RELATIONS):
        keys = [relation[1] for relation in RELATIONS if relation[0] == fact]
        rows = tables[fact]
        long = rows.select(*[number(rows, key).alias(f"{fact}.{key}") for key in keys]).unpivot(
            [], [f"`{fact}.{key}`" for key in keys], "relation", "key"
        )
        used.append(long.groupBy("relation", "key").agg(F.count("*").alias("_rows")))
    for fact, key, dim, member in RELATIONS:
        members.append(tables[dim].select(
            F.lit(f"{fact}.{key}").alias("relation"), number(tables[dim], member).alias("key")
        ))
    known = stacked(members).withColumn("_known", F.lit(True))
    missing = F.when(F.col("_known").isNull(), F.col("_rows")).otherwise(0)
    return (
        stacked(used).join(known, ["relation", "key"], "left")
        .groupBy("relation").agg(F.sum(missing).alias("orphan_rows"))
    )


_NAMED = {
    "DimRoomType": ("room_id", "room_type"),
    "DimPropertyType": ("property_id", "property_type"),
    "DimLocation": ("location_id", "neighbourhood_cleansed"),
    "DimHost": ("host_id", "host_name"),
    "DimListings": ("listing_id", "name"),
}


def unknown_members(tables: dict[str, DataFrame]) -> DataFrame:
    """The key-0 member of each dimension that has one: dim, id, val."""
    return stacked([
        tables[name].where(F.col(key) == C.UNKNOWN_KEY).select(
            F.lit(name).alias("dim"), F.col(key).cast("bigint").alias("id"),
            F.col(label).alias("val"),
        )
        for name, (key, label) in _NAMED.items()
    ])


def unknown_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Per dimension: members, those under key 0, and those named Unknown under it and besides."""
    def summary(name: str, key: str, label: str) -> DataFrame:
        zero, named = F.col(key) == C.UNKNOWN_KEY, F.col(label) == C.UNKNOWN
        return tables[name].agg(
            F.count("*").alias("members"), F.count_if(zero).alias("unknown_members"),
            F.count_if(zero & named).alias("named_unknown"),
            F.count_if(~zero & named).alias("others_named_unknown"),
        ).select(F.lit(name).alias("dim"), "*")
    return stacked([summary(name, *columns) for name, columns in _NAMED.items()])


def snapshot_distribution(fact: DataFrame) -> DataFrame:
    """Distinct listings and rows per snapshot; the two should be equal."""
    per_listing = fact.groupBy("snapshot_date", "listing_id").agg(F.count("*").alias("_rows"))
    return per_listing.groupBy("snapshot_date").agg(
        F.count("listing_id").alias("distinct_listings"), F.sum("_rows").alias("total_rows")
    )


def price_by_snapshot(fact: DataFrame) -> DataFrame:
    """Lowest, highest and mean price per snapshot, the mean to the cent."""
    priced = fact.groupBy("snapshot_date").agg(
        F.min("price").alias("min_price"), F.max("price").alias("max_price"),
        F.sum("price").alias("_total"), F.count("price").alias("_priced"),
    )
    mean = F.when(
        F.col("_priced") > 0, F.round(F.col("_total") / F.col("_priced").cast("decimal(18,0)"), 2)
    )
    return priced.select("snapshot_date", "min_price", "max_price", mean.alias("avg_price"))


def license_distribution(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("license_status", "has_license")
        .agg(F.count("*").alias("listing_count")).orderBy(F.desc("listing_count"))
    )


def reviews_by_year(fact: DataFrame) -> DataFrame:
    return fact.groupBy(F.year("date").alias("review_year")).agg(
        F.count("*").alias("review_count")
    ).orderBy("review_year")


def reviews_active(fact: DataFrame) -> DataFrame:
    return fact.groupBy("is_active").agg(F.count("*").alias("review_count"))


def date_coverage(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """First and last review day beside the bounds of the calendar, one row per side."""
    def bounds(side: str, days: DataFrame) -> DataFrame:
        return days.agg(F.min("date").alias("first_day"), F.max("date").alias("last_day")).select(
            F.lit(side).alias("side"), "first_day", "last_day"
        )
    return bounds("reviews", fact).unionByName(bounds("calendar", dates))


def column_list(tables: dict[str, DataFrame]) -> list[tuple[str, int, str, str, bool]]:
    """(table, position, column, type, nullable) of every table; reads no data."""
    return [
        (name, position, field.name, field.dataType.simpleString(), field.nullable)
        for name, table in tables.items()
        for position, field in enumerate(table.schema.fields, 1)
    ]


def schema_differences(rows: DataFrame, kind: str) -> list[str]:
    """How ``rows`` differ in name or type from the archive of ``kind``; empty when they agree."""
    expected, have = dict(C.ARCHIVE[kind]), dict(rows.dtypes)
    notes = [f"missing {name}" for name in expected if name not in have]
    notes += [f"unknown {name}" for name in have if name not in expected]
    notes += [
        f"{name} is {have[name]}, not {kind_}" for name, kind_ in expected.items()
        if name in have and have[name] != kind_
    ]
    return notes
