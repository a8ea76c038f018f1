"""History maintenance, run for real in fresh folders of the shared folder."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalogue import inputs
from catalogue.investor_queries import HOST_VERSIONS_SQL
from catalogue.registry import query
from catalogue.sql_views import category
from catalogue.star_queries import _HOST_SQL, Star
from snapstar import contracts as C
from snapstar.functions import cleaning as clean
from snapstar.functions.comparison import relaxed_names
from snapstar.operators.tallies import row_counts, stacked
from snapstar.plans import (
    catalogue as tables, contents, dimensions as dims, editions, facts, history, host_history,
    latest_state, load,
)
from snapstar.session import new_folder, settled
from snapstar.sources import split_csv

# The first snapshot whose files carry the quote columns.
_WIDE_FROM = "2000-12-31"


def _per_snapshot(listings: DataFrame) -> DataFrame:
    return listings.groupBy("snapshot_date").agg(
        F.count("*").alias("row_count"), F.sum("id").alias("id_total"),
        F.count("price_quote_raw").alias("quotes"),
        F.count("property_category").alias("categories"),
    )


_PER_SNAPSHOT_SQL = """
    SELECT snapshot_date, count(*) AS row_count, CAST(sum(id) AS BIGINT) AS id_total,
           count(price_quote_raw) AS quotes, count(*) AS categories
    FROM listings {0} GROUP BY snapshot_date"""


def _archive(spark: SparkSession, sf_dir: str) -> str:
    """An archive filled by two appends, the older one without the quote columns."""
    root = new_folder(spark, "archive")
    listings = history.with_category(
        inputs.listings(spark, sf_dir).withColumn("property_category", F.lit(None).cast("string"))
    )
    older = F.col("snapshot_date") < F.lit(_WIDE_FROM).cast("date")
    history.append(listings.where(older).drop(*C.LISTING_QUOTE_COLUMNS), root, "listings")
    history.append(listings.where(~older), root, "listings")
    return root


@query("listings", _PER_SNAPSHOT_SQL.format(""))
def snapshot_append(spark, sf_dir):
    """What the archive holds after appends of both layouts."""
    root = _archive(spark, sf_dir)
    return _per_snapshot(history.read_archive(spark, root, "listings"))


@query("listings", _PER_SNAPSHOT_SQL.format(
    "WHERE snapshot_date <> (SELECT min(snapshot_date) FROM listings)"))
def snapshot_remove(spark, sf_dir):
    """What the archive holds after its oldest snapshot was taken out."""
    root = _archive(spark, sf_dir)
    archive = history.read_archive(spark, root, "listings")
    oldest = archive.agg(F.min("snapshot_date").alias("day")).first().day
    history.remove(spark, root, oldest)
    return _per_snapshot(history.read_archive(spark, root, "listings"))


@query("reviews", """
    SELECT snapshot_date, count(*) AS row_count, CAST(sum(id) AS BIGINT) AS id_total
    FROM reviews WHERE snapshot_date <> (SELECT min(snapshot_date) FROM reviews)
    GROUP BY snapshot_date""")
def snapshot_remove_reviews(spark, sf_dir):
    """What the review archive holds after its oldest snapshot was taken out."""
    root = new_folder(spark, "archive")
    history.append(inputs.reviews(spark, sf_dir), root, "reviews")
    archive = history.read_archive(spark, root, "reviews")
    history.remove(spark, root, archive.agg(F.min("snapshot_date")).first()[0])
    return history.read_archive(spark, root, "reviews").groupBy("snapshot_date").agg(
        F.count("*").alias("row_count"), F.sum("id").alias("id_total"))


@query("listings", _PER_SNAPSHOT_SQL.format(""))
def archive_retag(spark, sf_dir):
    """Every stored category after a change of rules: half the snapshots carried an old one."""
    root = new_folder(spark, "archive")
    old = F.when(F.year("snapshot_date") % 2 == 0, F.lit("Former label"))
    history.append(history.with_category(
        inputs.listings(spark, sf_dir).withColumn("property_category", old)), root, "listings")
    history.retag_archive(spark, root)
    rows = history.read_archive(spark, root, "listings")
    known = F.col("property_category") != "Former label"
    return _per_snapshot(rows.withColumn(
        "property_category", F.when(known, F.col("property_category"))))


@query("listings reviews", """
    SELECT snapshot_date, snapshot_date IN (SELECT snapshot_date FROM listings) AS already_loaded
    FROM (SELECT snapshot_date FROM listings UNION SELECT snapshot_date FROM reviews)""")
def guard_snapshot_exists(spark, sf_dir):
    """Of all snapshot dates of either feed, which the listings archive holds."""
    star = Star(spark, sf_dir)
    feeds = star.listings.select("snapshot_date").union(star.reviews.select("snapshot_date"))
    return history.loaded_among(feeds, star.listings)


def write_feed(spark: SparkSession, sf_dir: str, feed: str) -> list[str]:
    """The inputs as CSV snapshots, one folder of part files each; the snapshot subfolders."""
    raw = settled(inputs.raw_listings(spark, sf_dir))
    csv = {"header": True, "escape": '"'}
    narrow = raw.drop(*C.LISTING_QUOTE_COLUMNS, "host_profile_id")
    days = [r.snapshot_date for r in raw.select("snapshot_date").distinct().collect()]
    for day in sorted(days):
        layout = raw if day >= _WIDE_FROM else narrow
        layout.where(F.col("snapshot_date") == day).drop("snapshot_date").write.csv(
            f"{feed}/{day}/{day}_listings.csv", **csv
        )
    reviews = inputs.reviews(spark, sf_dir)
    written = [r[0] for r in reviews.select("snapshot_date").distinct().collect()]
    for day in written:
        folder = max(days) if day == max(written) else min(days)
        reviews.where(F.col("snapshot_date") == F.lit(day)).drop("snapshot_date") \
            .write.csv(f"{feed}/{folder}/{day}_reviews.csv", **csv)
    inputs.neighbourhoods(spark, sf_dir).write.csv(
        f"{feed}/{min(days)}/{min(days)}_neighbourhoods.csv", **csv
    )
    # The last snapshot lists each nation's new quarter as well.
    inputs.neighbourhoods(spark, sf_dir).select(
        "neighbourhood_group", F.concat("neighbourhood", F.lit(" (new)")).alias("neighbourhood")
    ).write.csv(f"{feed}/{max(days)}/{max(days)}_neighbourhoods.csv", **csv)
    return sorted(days)


@query("listings reviews", """
    SELECT 'listings after the first load' AS step, count(*) AS value FROM listings
      WHERE snapshot_date < (SELECT max(snapshot_date) FROM listings)
    UNION ALL SELECT 'listings after the second load', count(*) FROM listings
    UNION ALL SELECT 'repeated loads refused', count(DISTINCT snapshot_date) FROM listings
      WHERE snapshot_date = (SELECT max(snapshot_date) FROM listings)
    UNION ALL SELECT 'names waiting', count(*) FROM nation WHERE n_name >= 'K'
    UNION ALL SELECT 'locations', 1 + count(*) + count(*) FILTER (n_name < 'K') FROM nation
    UNION ALL SELECT 'listings without the oldest', count(*) FROM listings
      WHERE snapshot_date > (SELECT min(snapshot_date) FROM listings)
    UNION ALL SELECT 'reviews without the oldest', count(*) FROM reviews
      WHERE snapshot_date > (SELECT min(snapshot_date) FROM reviews)""")
def quarterly_increment(spark, sf_dir):
    """A load on top of earlier ones: approval of names, a refused repeat, a removal."""
    feed, root = new_folder(spark, "feed"), new_folder(spark, "warehouse")
    days = write_feed(spark, sf_dir, feed)
    steps = []

    def note(step: str, rows: DataFrame) -> None:
        steps.append((step, rows.count()))

    archive = lambda kind: history.read_archive(spark, root, kind)
    load.load(spark, feed, root, days[:-1])
    note("listings after the first load", archive("listings"))
    approved = [
        f"{r.neighbourhood} (new)" for r in inputs.neighbourhoods(spark, sf_dir)
        .where(F.col("neighbourhood") < "K").collect()
    ]
    report = load.load(spark, feed, root, days[-1:], approved=approved)
    note("listings after the second load", archive("listings"))
    try:
        load.load(spark, feed, root, days[-1:])
        steps.append(("repeated loads refused", 0))
    except history.SnapshotExists:
        steps.append(("repeated loads refused", 1))
    note("names waiting", report["new_neighbourhoods"])
    names = dims.listed_names(archive("neighbourhoods"))
    note("locations", history.keep_location_keys(spark, root, names))
    for kind in ("listings", "reviews"):
        oldest = archive(kind).agg(F.min("snapshot_date")).first()[0]
        history.remove(spark, root, oldest)
        note(f"{kind} without the oldest", archive(kind))
    return spark.createDataFrame(steps, "step string, value long")


@query("dim_host dim_listings dim_location dim_property_type dim_room_type dim_date "
       "fact_listings fact_reviews", """
    SELECT 'FactListings' AS table_name, count(*) AS row_count FROM fact_listings
    UNION ALL SELECT 'FactReviews', count(*) FROM fact_reviews
    UNION ALL SELECT 'DimHost', count(*) FROM dim_host
    UNION ALL SELECT 'DimListings', count(*) FROM dim_listings
    UNION ALL SELECT 'DimRoomType', count(*) FROM dim_room_type
    UNION ALL SELECT 'DimPropertyType', count(*) FROM dim_property_type
    UNION ALL SELECT 'DimLocation', (SELECT count(*) FROM dim_location) + (SELECT count(*) FROM nation)
    UNION ALL SELECT 'DimDate', count(*) FROM dim_date
    UNION ALL SELECT 'orphaned_host_ids', count(*) FROM fact_listings
      WHERE host_id NOT IN (SELECT host_id FROM dim_host)
    UNION ALL SELECT 'orphaned_review_listing_ids', count(*) FROM fact_reviews
      WHERE listing_id NOT IN (SELECT listing_id FROM dim_listings)
    UNION ALL SELECT 'duplicate_keys', count(*) - count(DISTINCT (listing_id, snapshot_date))
      FROM fact_listings
    UNION ALL SELECT 'unknown_members',
      (SELECT count(*) FROM dim_host WHERE host_id = 0)
      + (SELECT count(*) FROM dim_listings WHERE listing_id = 0)
      + (SELECT count(*) FROM dim_location WHERE location_id = 0)
      + (SELECT count(*) FROM dim_property_type WHERE property_id = 0)
      + (SELECT count(*) FROM dim_room_type WHERE room_id = 0)
    UNION ALL SELECT 'listings_in_history', count(*) FROM fact_listings
    UNION ALL SELECT 'listing_facts', count(*) FROM fact_listings
    UNION ALL SELECT 'schema_differences', 0""")
def quarterly_load(spark, sf_dir):
    """From CSV files to accepted star schema: the whole load, in one batch of snapshots."""
    feed, root = new_folder(spark, "feed"), new_folder(spark, "warehouse")
    write_feed(spark, sf_dir, feed)
    load.load(spark, feed, root)  # the first load takes all listed names
    star = load.rebuild(spark, root)
    report = load.acceptance(spark, root)
    return row_counts(star).unionByName(
        report.select(F.col("check").alias("table_name"), F.col("value").alias("row_count"))
    )


# --- editions and stored state -------------------------------------------------------------------

def _archived(rows: DataFrame, root: str, kind: str) -> list[dt.date]:
    """The dates of ``rows``, in order, whose snapshots are now the archive; the rows are made once."""
    history.append(rows, root, kind)
    held = editions.edition(rows.sparkSession, root)
    return sorted(dt.date.fromisoformat(day) for day in held.parts(f"history/{kind}"))


def _late(days: list[dt.date]) -> list[dt.date]:
    """Every second date, then those between them, which so come late."""
    return days[1::2] + days[0::2]


def _stepwise(spark: SparkSession, rows: DataFrame, kind: str, name: str) -> str:
    """An archive, and its state merged with one snapshot at a time, late ones among them."""
    root = new_folder(spark, "stepwise")
    for day in _late(_archived(rows, root, kind)):
        with editions.change(spark, root) as made:
            latest_state.add(made, [day], names=(name,), first=8)
    return root


@query("dim_host", _HOST_SQL)
def state_dim_host(spark, sf_dir):
    """The host dimension from state that each snapshot in turn was merged with."""
    listings = inputs.listings(spark, sf_dir)
    return latest_state.dim_host(spark, _stepwise(spark, listings, "listings", "hosts"))


@query("dim_listings", "SELECT * FROM dim_listings")
def state_dim_listings(spark, sf_dir):
    """The listing dimension from state that each snapshot in turn was merged with."""
    listings = inputs.listings(spark, sf_dir)
    return latest_state.dim_listings(spark, _stepwise(spark, listings, "listings", "listings"))


@query("reviews", """
    SELECT id AS review_id, listing_id, date, reviewer_id,
           min(snapshot_date) OVER w AS first_snapshot_date,
           CASE WHEN max(snapshot_date) OVER w = (
               SELECT max(snapshot_date) FROM reviews
               WHERE snapshot_date < (SELECT max(snapshot_date) FROM reviews))
                THEN 1 ELSE 0 END AS is_active
    FROM (SELECT * FROM reviews WHERE snapshot_date < (SELECT max(snapshot_date) FROM reviews))
    WINDOW w AS (PARTITION BY id)
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY snapshot_date DESC, listing_id) = 1
    """)
def state_fact_reviews_after_removal(spark, sf_dir):
    """The review fact from state, after the newest snapshot was taken out again."""
    root = _stepwise(spark, inputs.reviews(spark, sf_dir), "reviews", "reviews")
    with editions.change(spark, root) as made:
        last = latest_state.newest_snapshot(made, "reviews")
        history.remove(spark, root, last, made)
        latest_state.take_out(made, last)
    return latest_state.fact_reviews(spark, root)


_LEFT = "(SELECT * FROM listings WHERE snapshot_date <> (SELECT min(snapshot_date) FROM listings))"


@query("listings", HOST_VERSIONS_SQL.format(_LEFT))
def state_host_versions_after_removal(spark, sf_dir):
    """Host versions from intervals: late snapshots split them, the first of all was taken out."""
    root = new_folder(spark, "intervals")
    days = _archived(inputs.listings(spark, sf_dir), root, "listings")
    for day in _late(days):
        with editions.change(spark, root) as made:
            host_history.add(made, [day], 8)
    with editions.change(spark, root) as made:
        history.remove(spark, root, days[0], made)
        host_history.take_out(made, days[0])
    return host_history.host_versions(spark, root)


@query("listings", """
    SELECT 'before' AS edition, snapshot_date, count(*) AS row_count FROM listings
      WHERE snapshot_date < (SELECT max(snapshot_date) FROM listings) GROUP BY snapshot_date
    UNION ALL SELECT 'after a load that died', snapshot_date, count(*) FROM listings
      WHERE snapshot_date < (SELECT max(snapshot_date) FROM listings) GROUP BY snapshot_date
    UNION ALL SELECT 'after a whole load', snapshot_date, count(*) FROM listings
      GROUP BY snapshot_date
    UNION ALL SELECT 'after vacuum', snapshot_date, count(*) FROM listings
      GROUP BY snapshot_date""")
def edition_publish(spark, sf_dir):
    """What readers see of an archive around a load that dies after its files were written."""
    root, rows = new_folder(spark, "editions"), settled(inputs.listings(spark, sf_dir))
    last = rows.agg(F.max("snapshot_date")).first()[0]
    newest = F.col("snapshot_date") == F.lit(last)
    seen = []

    def note(step: str) -> None:
        held = history.read_archive(spark, root, "listings")
        seen.append(settled(held.groupBy("snapshot_date").agg(F.count("*").alias("row_count"))
                            .select(F.lit(step).alias("edition"), "snapshot_date", "row_count")))

    history.append(rows.where(~newest), root, "listings")
    note("before")
    try:
        with editions.change(spark, root) as made:
            history.append(rows.where(newest), root, "listings", made)
            raise InterruptedError("the driver dies here")
    except InterruptedError:
        note("after a load that died")
    history.append(rows.where(newest), root, "listings")
    note("after a whole load")
    editions.vacuum(spark, root, hours=0)
    note("after vacuum")
    return stacked(seen)


@query("listings", """
    SELECT id, snapshot_date, CAST(beds AS DOUBLE)
             + CASE WHEN snapshot_date >= DATE '2000-12-31' AND id % 2 = 0 THEN 0.5 ELSE 0 END AS beds
    FROM listings""")
def archive_widened(spark, sf_dir):
    """A column that turned fractional: later snapshots under an approved wider type, older as written."""
    root, rows = new_folder(spark, "widened"), settled(inputs.listings(spark, sf_dir))
    older = F.col("snapshot_date") < F.lit(_WIDE_FROM).cast("date")
    history.append(rows.where(older), root, "listings")
    halves = F.col("beds").cast("double") + F.when(F.col("id") % 2 == 0, 0.5).otherwise(0.0)
    with editions.change(spark, root) as made:
        history.widen(made, "listings", {"beds": "double"})
        history.append(rows.where(~older).withColumn("beds", halves), root, "listings", made)
    return history.read_archive(spark, root, "listings").select("id", "snapshot_date", "beds")


@query("dim_host dim_listings dim_room_type dim_property_type fact_listings fact_reviews", """
    SELECT 'FactListings' AS table_name, count(*) AS row_count,
           CAST(sum(host_id + property_id + room_id) AS BIGINT) AS key_total FROM fact_listings
    UNION ALL SELECT 'FactReviews', count(*), CAST(sum(listing_id + is_active) AS BIGINT)
      FROM fact_reviews
    UNION ALL SELECT 'DimHost', count(*), CAST(sum(host_id) AS BIGINT) FROM dim_host
    UNION ALL SELECT 'DimListings', count(*), CAST(sum(listing_id) AS BIGINT) FROM dim_listings
    UNION ALL SELECT 'DimRoomType', count(*), CAST(sum(room_id) AS BIGINT) FROM dim_room_type
    UNION ALL SELECT 'DimPropertyType', count(*), CAST(sum(property_id) AS BIGINT)
      FROM dim_property_type""")
def star_refresh(spark, sf_dir):
    """The star schema after a first refresh and one that adds the newest snapshots to it."""
    root = new_folder(spark, "refresh")
    parts = {"listings": settled(inputs.listings(spark, sf_dir)),
             "reviews": settled(inputs.reviews(spark, sf_dir))}
    last = {kind: rows.agg(F.max("snapshot_date")).first()[0] for kind, rows in parts.items()}
    for newest in (False, True):
        with editions.change(spark, root) as made:
            before = {kind: set(made.parts(f"history/{kind}")) for kind in parts}
            for kind, rows in parts.items():
                is_last = F.col("snapshot_date") == F.lit(last[kind])
                history.append(rows.where(is_last if newest else ~is_last), root, kind, made)
            if not newest:
                history.append(inputs.neighbourhoods(spark, sf_dir).withColumn(
                    "snapshot_date", F.lit(last["listings"])), root, "neighbourhoods", made)
            load.merge_state(made, before)
        star = load.refresh(spark, root)
    keys = {
        "FactListings": "host_id + property_id + room_id", "FactReviews": "listing_id + is_active",
        "DimHost": "host_id", "DimListings": "listing_id", "DimRoomType": "room_id",
        "DimPropertyType": "property_id",
    }
    return stacked([
        star[name].agg(F.count("*").alias("row_count"), F.expr(f"sum({total})").alias("key_total"))
        .select(F.lit(name).alias("table_name"), "row_count", "key_total")
        for name, total in keys.items()])


@query("listings", """
    SELECT id, snapshot_date, name, description || chr(10) || 'says "hello"' AS description
    FROM listings""")
def split_csv_rows(spark, sf_dir):
    """Listings written as CSV with quotes and line breaks in their texts, read back across all cuts."""
    folder, columns = new_folder(spark, "split"), ["id", "snapshot_date", "name", "description"]
    texts = inputs.listings(spark, sf_dir).withColumn(
        "description", F.concat("description", F.lit('\nsays "hello"')))
    texts.select(*[F.col(c).cast("string") for c in columns]).write.csv(
        folder, header=True, escape='"', lineSep="\n")
    rows = split_csv.read_split(spark, [folder], columns)
    return rows.select(F.col("id").cast("long"), F.col("snapshot_date").cast("date"), *columns[2:])


@query("listings reviews neighbourhoods", """
    SELECT 'listings_history' AS table_name, 64 AS n_columns, snapshot_date,
           count(*) AS row_count FROM listings GROUP BY snapshot_date
    UNION ALL SELECT 'reviews_history', 7, snapshot_date, count(*) FROM reviews
      GROUP BY snapshot_date
    UNION ALL SELECT 'neighbourhoods_history', 3, (SELECT max(snapshot_date) FROM listings), count(*)
      FROM neighbourhoods""")
def catalogue_tables(spark, sf_dir):
    """What the session catalogue lists after a load, and the rows its tables give by partition."""
    root, database = new_folder(spark, "catalogue"), f"check_{uuid.uuid4().hex}"
    listings = inputs.listings(spark, sf_dir)
    last = listings.agg(F.max("snapshot_date")).first()[0]
    with editions.change(spark, root) as made:
        history.append(listings, root, "listings", made)
        history.append(inputs.reviews(spark, sf_dir), root, "reviews", made)
        history.append(inputs.neighbourhoods(spark, sf_dir).withColumn(
            "snapshot_date", F.lit(last)), root, "neighbourhoods", made)
    tables.register(spark, root, database)
    counts = tables.column_scan(spark, database).groupBy("table_name").agg(
        F.count("*").cast("int").alias("n_columns"))
    rows = stacked([
        spark.table(f"{database}.{name}").groupBy("snapshot_date").agg(
            F.count("*").alias("row_count")).withColumn("table_name", F.lit(name))
        for name in tables.table_list(spark, database)])
    found = settled(rows.join(counts, "table_name").select(
        "table_name", "n_columns", "snapshot_date", "row_count"))
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return found


_SPELT = """CASE id % 3 WHEN 0 THEN upper({0}) WHEN 1 THEN {0} || '  ' ELSE {0} END"""
_MATCHED = "lower(rtrim({0}))"


@query("listings", f"""
    SELECT s.id, s.snapshot_date, coalesce(p.property_id, 0) AS property_id,
           coalesce(r.room_id, 0) AS room_id, {category('s.property_type')} AS property_category
    FROM listings s
    LEFT JOIN (SELECT name, CAST(row_number() OVER (ORDER BY spelling) AS INT) AS property_id FROM (
      SELECT {_MATCHED.format('property_type')} AS name,
             min({_SPELT.format('property_type')}) AS spelling
      FROM listings WHERE property_type IS NOT NULL GROUP BY ALL)) p
      ON p.name = {_MATCHED.format('s.property_type')}
    LEFT JOIN (SELECT name, CAST(row_number() OVER (ORDER BY spelling) AS INT) AS room_id FROM (
      SELECT {_MATCHED.format('room_type')} AS name, min({_SPELT.format('room_type')}) AS spelling
      FROM listings WHERE room_type IS NOT NULL GROUP BY ALL)) r
      ON r.name = {_MATCHED.format('s.room_type')}""")
def names_without_case(spark, sf_dir):
    """Keys and categories of names that come in capitals and with trailing blanks."""
    rows = inputs.listings(spark, sf_dir)
    for name in ("property_type", "room_type"):
        rows = rows.withColumn(name, F.expr(
            f"case id % 3 when 0 then upper({name}) when 1 then {name} || '  ' else {name} end"))
    rows = relaxed_names(rows)
    names = dims.observed_names(rows)
    keyed = facts.with_property_key(rows, dims.dim_property_type(names["property_type"]))
    keyed = facts.with_room_key(keyed, dims.dim_room_type(names["room_type"]))
    return keyed.select("id", "snapshot_date", "property_id", "room_id", clean.property_category(
        F.col("property_type")).alias("property_category"))


@query("listings", """
    WITH ends AS (
      SELECT snapshot_date, min(id) AS low, max(id) AS high, count(*) AS row_count
      FROM listings GROUP BY snapshot_date)
    SELECT g.column_group, e.snapshot_date, e.row_count AS rows_before, e.row_count AS rows_after,
           g.column_group <> 'listing' OR a.price IS NOT DISTINCT FROM b.price AS agrees
    FROM ends e
    JOIN listings a ON a.snapshot_date = e.snapshot_date AND a.id = e.low
    JOIN listings b ON b.snapshot_date = e.snapshot_date AND b.id = e.high,
         (VALUES ('host'), ('quotes'), ('reviews'), ('listing')) g(column_group)""")
def contents_verified(spark, sf_dir):
    """Kept fingerprints against an archive in which two listings of each snapshot changed prices."""
    root, rows = new_folder(spark, "contents"), settled(inputs.listings(spark, sf_dir))
    with editions.change(spark, root) as made:
        history.append(rows, root, "listings", made)
        contents.keep(made, contents.fingerprints(
            history.read_archive(spark, root, "listings", made), "listings"))
    ends = rows.groupBy("snapshot_date").agg(
        F.min(F.struct("id", "price")).alias("low"), F.max(F.struct("id", "price")).alias("high"))
    swapped = rows.join(F.broadcast(ends), "snapshot_date").withColumn(  # a row a snapshot
        "price", F.when(F.col("id") == F.col("low.id"), F.col("high.price"))
        .when(F.col("id") == F.col("high.id"), F.col("low.price")).otherwise(F.col("price")))
    with editions.change(spark, root) as made:
        history.append(swapped.drop("low", "high"), root, "listings", made)
    return contents.verify(spark, root).drop("table_name")
