"""Loading snapshots and rebuilding the star schema. Every write follows its checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from snapstar import contracts as C
from snapstar.functions.comparison import relaxed_names
from snapstar.operators.tallies import row_counts, stacked
from snapstar.plans import (
    catalogue, contents, dimensions as dims, editions, facts, history, host_history, latest_state,
    profiles, quality,
)
from snapstar.plans.editions import Change
from snapstar.session import settled
from snapstar.sources import csv_snapshots, fit

KINDS = ("reviews", "neighbourhoods", "listings")


def stage(
    spark: SparkSession, feed: str, root: str, kind: str, subfolders: list[str] | None = None,
    multi_line: bool = True, split: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Typed staging rows of one kind, stored, and the type report. Rerunning replaces them.

    The files are parsed once, into text columns; profile and casts read those.
    """
    raw = csv_snapshots.read_snapshots(spark, feed, kind, subfolders, multi_line, split)
    csv_snapshots.check_columns(raw, kind)
    if kind == "listings":
        raw = raw.drop(*C.LISTING_DROPPED)
    read = Observation()
    dated = _replaced(
        raw.withColumn("snapshot_date", F.col("snapshot_date").cast("string"))
        .observe(read, F.count("*").alias("rows")), f"{root}/staging/{kind}_text")
    raw = dated
    report = settled(fit.widening_report(raw.drop("snapshot_date"), kind))
    typed = fit.typed(dated, kind, report).withColumn(
        "snapshot_date", F.col("snapshot_date").cast("date")
    )
    staged = _replaced(typed, f"{root}/staging/{kind}")
    if staged.count() != read.get["rows"]:
        raise C.ContractError(f"{kind}: {read.get['rows']} rows read, {staged.count()} staged")
    contents.check(contents.fingerprints(contents.cast_plainly(raw, staged), kind),
                   contents.fingerprints(staged, kind), "read and staged")
    return staged, report


def _replaced(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` stored at ``path`` in place of what was there."""
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def check_staged(staged: dict[str, DataFrame]) -> None:
    """Stop on a null in a required column, an undated row or a repeated listing."""
    gaps = profiles.required_nulls(staged).where(F.col("null_rows") > 0)
    problems = [f"{r.table_name}.{r.column_name}: {r.null_rows} nulls" for r in gaps.collect()]
    repeated = quality.duplicate_listing_snapshots(staged["listings"]).limit(5).collect()
    problems += [f"listing {r.id} twice in {r.snapshot_date}" for r in repeated]
    undated = row_counts(
        {kind: rows.where(F.col("snapshot_date").isNull()) for kind, rows in staged.items()}
    ).where(F.col("row_count") > 0)
    problems += [f"{r.table_name}: {r.row_count} undated rows" for r in undated.collect()]
    if problems:
        raise C.ContractError("; ".join(problems))


def load(
    spark: SparkSession, feed: str, root: str, subfolders: list[str] | None = None,
    approved: list[str] | None = None, multi_line: bool = True,
    wider: dict[str, str] | None = None, split: bool = False,
) -> dict[str, DataFrame]:
    """Load the snapshots of ``subfolders`` into the archives; small, settled reports by name.

    All archives switch together, after every check: a load that dies anywhere, or is refused, leaves
    the edition before. ``wider`` approves wider types of listing columns, such as
    ``{"beds": "double"}``, from this load on. With ``split``, large files are read by many tasks. New neighbourhood names enter the location dimension only when listed in ``approved``; the
    ``new_neighbourhoods`` report shows those still waiting. The first load takes them all.
    """
    history.create(spark, root)
    listed = csv_snapshots.discover(spark, feed, subfolders)
    dates = [
        r.day for r in listed.where(F.col("kind") == "listings")
        .select(history.snapshot_date_of(F.col("snapshot")).alias("day")).distinct().collect()
    ]
    history.guard(spark, root, dates)
    staged, reports = {}, {}
    for kind in KINDS:
        staged[kind], reports[kind] = stage(
            spark, feed, root, kind, subfolders, multi_line, split)
    check_staged(staged)

    known = dims.listed_names(history.read_archive(spark, root, "neighbourhoods"))
    held = editions.edition(spark, root)
    waiting = dims.new_neighbourhoods(matched(staged["neighbourhoods"], held), known)
    names = staged["neighbourhoods"]
    if not history.read_archive(spark, root, "listings").isEmpty():
        names = names.where(F.col("neighbourhood").isin(approved or [])).join(
            waiting, "neighbourhood", "left_semi"
        )
        waiting = waiting.where(~F.col("neighbourhood").isin(approved or []))
    waiting = settled(waiting.select("neighbourhood"))

    batch = {
        "reviews": staged["reviews"], "neighbourhoods": names,
        "listings": history.with_category(
            staged["listings"].withColumn("property_category", F.lit(None).cast("string")),
            lambda rows: matched(rows, held),
        ),
    }
    with editions.change(spark, root) as made:
        history.widen(made, "listings", wider or {})
        # Files of this change are not seen before it is published, so a value that its archive
        # type refuses leaves nothing behind but a folder for the next vacuum.
        before = {kind: set(made.parts(f"history/{kind}")) for kind in ("listings", "reviews")}
        for kind in KINDS:
            history.append(batch[kind], root, kind, made)
        archived = {
            kind: history.read_archive(spark, root, kind, made)
            .join(F.broadcast(staged[kind].select("snapshot_date").distinct()),  # a row a snapshot
                  "snapshot_date", "left_semi")
            for kind in ("listings", "reviews")
        }
        reconciled = settled(
            quality.append_reconcile({kind: staged[kind] for kind in archived}, archived)
        )
        if not reconciled.where(~F.col("agrees")).isEmpty():
            raise C.ContractError(f"staged and archived rows differ: {reconciled.collect()}")
        keep_contents(made, batch)
        merge_state(made, before)
    return {
        "types": stacked([
            report.select(F.lit(kind).alias("table_name"), "*") for kind, report in reports.items()
        ]),
        "reconciled": reconciled,
        "new_neighbourhoods": waiting,
    }


def keep_contents(made: Change, batch: dict[str, DataFrame]) -> None:
    """Compare what was to be archived with what the archives hold now, and keep the fingerprints.

    Only the snapshots of ``batch`` are read.
    """
    for kind, rows in batch.items():
        wanted = settled(contents.fingerprints(
            history.conform(rows, kind, history.types_in_force(kind, made)), kind))
        dates = [r.snapshot_date for r in wanted.select("snapshot_date").distinct().collect()]
        held = history.read_archive(made.spark, made.root, kind, made)
        contents.check(wanted, contents.fingerprints(
            held.where(F.col("snapshot_date").isin(dates)), kind), "staged and archived")
        contents.keep(made, wanted)


def match_names(spark: SparkSession, root: str, without_case: bool) -> None:
    """Choose whether names of a warehouse match without case and trailing blanks, or exactly."""
    with editions.change(spark, root) as made:
        made.settings["names"] = "without case" if without_case else "exact"
        made.tables.pop("star/FactListings", None)  # its keys follow the names


def matched(rows: DataFrame, held: editions.Edition) -> DataFrame:
    """``rows`` whose names compare as the warehouse has chosen."""
    return relaxed_names(rows) if held.settings.get("names") == "without case" else rows


def merge_state(made: Change, before: dict[str, set[str]]) -> None:
    """Bring the state of newest rows up to the snapshots that the change added.

    ``before`` are the dates the archives held; a date loaded again is taken out of the state first.
    """
    after = {kind: set(made.parts(f"history/{kind}")) for kind in before}
    fresh = set().union(*[after[kind] - before[kind] for kind in before])
    if not latest_state.kept(made) or fresh & set().union(*before.values()):
        # State is begun with the first load, and anew if a date stood in one archive only.
        latest_state.start(made.spark, made.root, made)
        host_history.start(made)
        return
    dates = sorted(map(dt.date.fromisoformat, fresh))
    latest_state.add(made, dates)
    if host_history.kept(made):
        host_history.add(made, dates)
    else:
        host_history.start(made)


def remove(spark: SparkSession, root: str, date: dt.date) -> None:
    """Take one snapshot out of archives and state together; refresh the star schema afterwards."""
    with editions.change(spark, root) as made:
        history.remove(spark, root, date, made)
        for kind in ("listings", "reviews"):
            contents.take_out(made, kind, date)
        if latest_state.kept(made):
            latest_state.take_out(made, date)
        if host_history.kept(made):
            host_history.take_out(made, date)


STAR = ("DimLocation", "DimRoomType", "DimPropertyType", "DimHost", "DimListings", "DimDate",
        "FactListings", "FactReviews")


def read_star(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The star schema of the newest edition."""
    held = editions.edition(spark, root)
    return {
        name: spark.read.option("basePath", f"{root}/star/{name}").parquet(*[
            f"{root}/{part.path}" for part in held.parts(f"star/{name}").values()
        ]).drop("load")
        for name in STAR
    }


def rebuild(spark: SparkSession, root: str, change: Change | None = None) -> dict[str, DataFrame]:
    """All dimensions and facts anew from the archives, published together; the stored tables.

    Dimensions are stored first, so the size the fact join decides on is that of real files.
    FactListings is partitioned by snapshot and sorted by listing inside, which lets readers
    skip snapshots and row groups.
    """
    with editions.change(spark, root, change) as made:
        listings = matched(history.read_archive(spark, root, "listings", made), made)
        reviews = history.read_archive(spark, root, "reviews", made)
        neighbourhoods = history.read_archive(spark, root, "neighbourhoods", made)
        store = lambda name, rows: made.store(f"star/{name}", rows)

        names = dims.observed_names(listings)
        star = {
            "DimLocation": store("DimLocation", history.keep_location_keys(
                spark, root, dims.listed_names(neighbourhoods), made)),
            "DimRoomType": store("DimRoomType", dims.dim_room_type(names["room_type"])),
            "DimPropertyType": store(
                "DimPropertyType", dims.dim_property_type(names["property_type"])
            ),
            "DimHost": store("DimHost", dims.dim_host(listings)),
            "DimListings": store("DimListings", dims.dim_listings(listings)),
            "DimDate": store("DimDate", dims.dim_date(spark)),
        }
        made.tables.pop("star/FactListings", None)
        store_listing_facts(made, listings, star)
        store("FactReviews", facts.fact_reviews(reviews).sortWithinPartitions("date"))
    return read_star(spark, root) if change is None else star


def refresh(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The star schema brought up to the archives without reading past snapshots; the tables.

    Hosts, listings and reviews come from stored state, names from those of each snapshot. Listing
    facts are written for snapshots that have none yet; all of them only if a name got another key.
    Equal to ``rebuild`` on the same archives.
    """
    with editions.change(spark, root) as made:
        if not latest_state.kept(made):
            latest_state.start(spark, root, made)
        names = latest_state.observed_names(spark, root, made)
        neighbourhoods = history.read_archive(spark, root, "neighbourhoods", made)
        keyed = {
            "DimLocation": history.keep_location_keys(
                spark, root, dims.listed_names(neighbourhoods), made),
            "DimRoomType": dims.dim_room_type(matched(names["room_type"], made)),
            "DimPropertyType": dims.dim_property_type(matched(names["property_type"], made)),
        }
        star, moved = {}, False
        for name, rows in keyed.items():
            earlier = editions.stored(spark, root, made, f"star/{name}")
            star[name] = made.store(f"star/{name}", rows)
            moved |= earlier is None or not star[name].exceptAll(earlier).isEmpty() or (
                not earlier.exceptAll(star[name]).isEmpty())
        star["DimHost"] = made.store(
            "star/DimHost", latest_state.dim_host(spark, root, made))
        star["DimListings"] = made.store(
            "star/DimListings", latest_state.dim_listings(spark, root, made))
        if not made.parts("star/DimDate"):
            made.store("star/DimDate", dims.dim_date(spark))
        made.store("star/FactReviews", latest_state.fact_reviews(spark, root, made)
                   .sortWithinPartitions("date"))
        wanted, done = set(made.parts("history/listings")), set(made.parts("star/FactListings"))
        for date in done - wanted:
            made.drop("star/FactListings", date)
        missing = sorted(wanted if moved else wanted - done)
        if missing:
            listings = matched(history.read_archive(spark, root, "listings", made), made)
            store_listing_facts(made, listings.where(F.col("snapshot_date").isin(
                [dt.date.fromisoformat(date) for date in missing])), star)
    return read_star(spark, root)


def store_listing_facts(
    made: Change, listings: DataFrame, star: dict[str, DataFrame]
) -> None:
    """Write the listing facts of the snapshots in ``listings``, a part of the table for each."""
    rows = facts.fact_listings(
        listings, star["DimPropertyType"], star["DimRoomType"], star["DimLocation"],
        star["DimHost"],
    )
    folder = made.folder("star/FactListings")
    seen = Observation()
    rows.observe(seen, F.collect_set("snapshot_date").alias("dates")).sortWithinPartitions(
        "snapshot_date", "listing_id"
    ).write.partitionBy("snapshot_date").parquet(f"{made.root}/{folder}")
    for date in seen.get["dates"]:
        made.put("star/FactListings", f"{folder}/snapshot_date={date}", str(date))


def acceptance(
    spark: SparkSession, root: str, database: str = catalogue.DATABASE
) -> DataFrame:
    """Post-load report: check, value, expected (null where any value is fine).

    The tables are registered in the session catalogue first, and what it lists is compared with the
    contract.
    """
    catalogue.register(spark, root, database)
    star = read_star(spark, root)
    listings = history.read_archive(spark, root, "listings")
    repeated = quality.primary_keys(star).agg(F.sum("duplicate_keys").alias("value"))
    checks = [
        (quality.orphan_hosts(star["FactListings"], star["DimHost"]).toDF("value"),
         "orphaned_host_ids", F.lit(0)),
        (quality.orphan_reviews(star["FactReviews"], star["DimListings"]).toDF("value"),
         "orphaned_review_listing_ids", F.lit(None)),
        (repeated, "duplicate_keys", F.lit(0)),
        (quality.unknown_members(star).agg(F.count("*").alias("value")), "unknown_members",
         F.lit(5)),
        (listings.agg(F.count("*").alias("value")), "listings_in_history", F.lit(None)),
        (star["FactListings"].agg(F.count("*").alias("value")), "listing_facts", F.lit(None)),
        (catalogue.differences(spark, root, database).agg(F.count("*").alias("value")),
         "schema_differences", F.lit(0)),
    ]
    return stacked([
        rows.select(F.lit(name).alias("check"), F.col("value").cast("bigint").alias("value"),
                    expected.cast("bigint").alias("expected"))
        for rows, name, expected in checks
    ])
