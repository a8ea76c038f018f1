"""Fingerprints of contents: whether two tables hold the same rows, whatever their order.

Rows that are merely counted can change on their way from a file into an archive and still agree.
Here every row is hashed together with its key, and the hashes are added up, per snapshot and per
group of columns. Sums do not depend on the order of rows, repeated rows count each time, and values
that changed places between two rows show. A load compares the text it parsed with what it staged,
and that with what it archived; the sums of each archived snapshot are kept with the edition, so that
``verify`` finds files that changed later.

A number hashes alike as whole number or double, so widening a column changes no fingerprint. Hashes
have 64 bits; they guard against faults, not against intent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapstar import contracts as C
from snapstar.plans import editions, history
from snapstar.plans.editions import Change, Edition
from snapstar.sources.fit import WHOLE_TYPES

TABLE = "state/contents"
SCHEMA = ("table_name string, snapshot_date date, column_group string, row_count long, "
          "fingerprint decimal(30,0)")
#: What a row is told apart by; hashed into every group.
KEYS = {"listings": ("id",), "reviews": ("id", "listing_id"), "neighbourhoods": ("neighbourhood",)}
#: Groups of columns by how their names begin; the group named last takes the others.
GROUPS = {
    "listings": {
        "host": ("host_",), "quotes": ("price_quote_",),
        "reviews": ("review_scores_", "number_of_reviews", "reviews_per_month"), "listing": (),
    },
    "reviews": {"reviewer": ("reviewer_",), "review": ()},
    "neighbourhoods": {"neighbourhood": ()},
}


def groups(kind: str, columns: list[str]) -> dict[str, list[str]]:
    """Group -> those of ``columns`` that belong to it; the snapshot date belongs to none."""
    out: dict[str, list[str]] = {name: [] for name in GROUPS[kind]}
    for column in sorted(set(columns) - {"snapshot_date"}):
        named = (name for name, starts in GROUPS[kind].items() if column.startswith(starts))
        out[next(named, list(out)[-1])].append(column)
    return out


def _hashed(column: str, kind: str) -> list[str]:
    """What is hashed of a column. Spark's hash passes over nulls, so these are marked."""
    null = f"`{column}` is null"
    if kind in WHOLE_TYPES or kind == "double":
        # A double holds no long exactly, a decimal no fraction of any length.
        return [f"cast(`{column}` as double)", f"try_cast(`{column}` as decimal(38,0))", null]
    return [f"`{column}`", null]


def fingerprints(rows: DataFrame, kind: str) -> DataFrame:
    """Rows and the sum of row hashes per snapshot and column group (``SCHEMA``), in one pass.

    An empty table has no snapshots and gives no rows; rows without a date are a snapshot of their
    own. Only sums leave a task. The sum has room for 10^10 rows of a snapshot.
    """
    types = dict(rows.dtypes)
    sums = [
        F.sum(F.expr("xxhash64(" + ", ".join(
            part for column in (*KEYS[kind], *columns) for part in _hashed(column, types[column])
        ) + ")").cast("decimal(20,0)")).alias(name)
        for name, columns in groups(kind, rows.columns).items()
    ]
    wide = rows.groupBy("snapshot_date").agg(F.count("*").alias("row_count"), *sums)
    return wide.unpivot(
        ["snapshot_date", "row_count"], list(GROUPS[kind]), "column_group", "fingerprint"
    ).select(F.lit(kind).alias("table_name"), "snapshot_date", "column_group", "row_count",
             F.col("fingerprint").cast("decimal(30,0)").alias("fingerprint"))


def compared(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two sets of fingerprints side by side: their counts and whether rows and contents agree."""
    left, right = before.alias("l"), after.alias("r")
    names = ("table_name", "snapshot_date", "column_group")
    same = [F.col(f"l.{name}").eqNullSafe(F.col(f"r.{name}")) for name in names]
    return left.join(right, same, "full_outer").select(
        *[F.coalesce(f"l.{name}", f"r.{name}").alias(name) for name in names],
        F.col("l.row_count").alias("rows_before"), F.col("r.row_count").alias("rows_after"),
        (F.col("l.row_count").eqNullSafe(F.col("r.row_count"))
         & F.col("l.fingerprint").eqNullSafe(F.col("r.fingerprint"))).alias("agrees"),
    )


def check(before: DataFrame, after: DataFrame, step: str) -> None:
    """Stop unless both sets of fingerprints agree; the message names snapshots and groups."""
    differing = compared(before, after).where(~F.col("agrees")).orderBy(
        "table_name", "snapshot_date", "column_group").limit(5).collect()
    if differing:
        raise C.ContractError(f"{step}: " + "; ".join(
            f"{r.table_name} of {r.snapshot_date}, columns of {r.column_group}: contents differ "
            f"({r.rows_before} and {r.rows_after} rows)" for r in differing))


def cast_plainly(text: DataFrame, typed: DataFrame) -> DataFrame:
    """Text rows under the types of ``typed``, by plain casts of their own; misfits are null."""
    columns = []
    for name, target in typed.dtypes:
        value = f"`{name}`"
        if target in WHOLE_TYPES:
            value = f"try_cast(try_cast(trim({value}) as decimal(38,6)) as {target})"
        elif target == "date" and name != "snapshot_date":
            tries = ", ".join(f"try_to_date({value}, '{f}')" for f in C.QUOTE_DATE_FORMATS)
            value = f"coalesce({tries})"
        elif target != "string":
            value = f"try_cast(trim({value}) as {target})"
        columns.append(f"{value} as `{name}`")
    return text.selectExpr(*columns)


def kept(spark: SparkSession, root: str, held: Edition | None = None) -> DataFrame:
    """The fingerprints kept with an edition (the newest); none if it has none."""
    held = editions.edition(spark, root) if held is None else held
    part = held.parts(TABLE).get("")
    if part is None:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(f"{root}/{part.path}")


def keep(made: Change, fresh: DataFrame) -> None:
    """Keep ``fresh`` with the change, in place of what it kept of the same snapshots."""
    earlier = kept(made.spark, made.root, made).join(
        fresh.select("table_name", "snapshot_date").distinct(), ["table_name", "snapshot_date"],
        "left_anti")
    made.store(TABLE, earlier.select(fresh.columns).unionByName(fresh).coalesce(1))


def take_out(made: Change, table: str, date) -> None:
    """Forget the fingerprints of one snapshot of one archive."""
    if made.parts(TABLE):
        gone = (F.col("table_name") == table) & (F.col("snapshot_date") == F.lit(date))
        made.store(TABLE, kept(made.spark, made.root, made).where(~gone).coalesce(1))


def verify(spark: SparkSession, root: str, held: Edition | None = None) -> DataFrame:
    """Every snapshot with kept fingerprints against its files (``compared``), each read once.

    Snapshots without kept fingerprints, such as those of an archive that was rewritten outside a
    load, are left out.
    """
    held = editions.edition(spark, root) if held is None else held
    known = kept(spark, root, held)
    asked = F.broadcast(known.select("table_name", "snapshot_date").distinct())  # a row a snapshot
    found = [
        fingerprints(history.read_archive(spark, root, kind, held).join(
            asked.where(F.col("table_name") == kind).select("snapshot_date"), "snapshot_date",
            "left_semi"), kind)
        for kind in KEYS
    ]
    return compared(known, found[0].unionByName(found[1]).unionByName(found[2]))
