"""Does raw text fit its declared type? Measured in one pass, before anything is written."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from snapstar import contracts as C

NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
WHOLE_TYPES = ("bigint", "int", "smallint")


def _declared(raw: DataFrame, kind: str) -> dict[str, str]:
    return {c: C.staging_type(kind, c) for c in raw.columns}


def _length(declared: str) -> int | None:
    return int(declared[5:-1]) if declared.startswith("text(") else None


def _rows(raw: DataFrame, measures: dict[str, dict[str, str]], labels: dict[str, str]) -> DataFrame:
    """One aggregate over all columns, turned into one row per column.

    ``measures``: column -> {measure: aggregate}; ``labels``: column -> leading struct fields.
    """
    wide = raw.selectExpr(*[
        f"{aggregate} as `{column}.{name}`"
        for column, each in measures.items() for name, aggregate in each.items()
    ])
    structs = ", ".join(
        f"struct('{column}' as column_name, {labels[column]}, "
        + ", ".join(f"`{column}.{name}` as {name}" for name in each) + ")"
        for column, each in measures.items()
    )
    return wide.selectExpr(f"inline(array({structs}))")


def _numeric_measures(column: str) -> dict[str, str]:
    number = f"`{column}` rlike r'{NUMBER}'"
    return {
        "not_numeric": f"count_if(`{column}` is not null and not {number})",
        "fractional": f"count_if({number} and try_cast(trim(`{column}`) as double) % 1 <> 0)",
    }


def numeric_fit(raw: DataFrame, kind: str) -> DataFrame:
    """Whole-number columns: values that are no number, or no whole one, and the verdict.

    ``fit`` is int, float or text; a column without values is int.
    """
    declared = {c: t for c, t in _declared(raw, kind).items() if t in WHOLE_TYPES}
    rows = _rows(
        raw, {c: _numeric_measures(c) for c in declared},
        {c: f"'{t}' as declared" for c, t in declared.items()},
    )
    verdict = F.when(F.col("not_numeric") > 0, "text").when(F.col("fractional") > 0, "float")
    return rows.withColumn("fit", F.coalesce(verdict, F.lit("int")))


def text_fit(raw: DataFrame, kind: str) -> DataFrame:
    """Text columns with an expected length: the longest value and whether it fits."""
    bounded = {c: _length(t) for c, t in _declared(raw, kind).items() if _length(t)}
    rows = _rows(
        raw, {c: {"longest": f"coalesce(max(length(`{c}`)), 0)"} for c in bounded},
        {c: f"{n} as declared_length" for c, n in bounded.items()},
    )
    return rows.withColumn("fits", F.col("longest") <= F.col("declared_length"))


def widening_report(raw: DataFrame, kind: str) -> DataFrame:
    """Declared and final type of every checked column, with the reason where they differ."""
    measures, labels = {}, {}
    for column, declared in _declared(raw, kind).items():
        if declared in WHOLE_TYPES:
            measures[column] = _numeric_measures(column) | {"longest": "cast(null as int)"}
        elif _length(declared):
            measures[column] = {
                "not_numeric": "cast(0 as bigint)", "fractional": "cast(0 as bigint)",
                "longest": f"max(length(`{column}`))",
            }
        else:
            continue
        labels[column] = f"'{declared}' as declared, {_length(declared) or 'null'} as room"
    too_long = F.col("longest") > F.col("room")
    final = (
        F.when((F.col("not_numeric") > 0) | too_long, "text")
        .when(F.col("fractional") > 0, "double").otherwise(F.col("declared"))
    )
    reason = (
        F.when(F.col("not_numeric") > 0, "holds text that is no number")
        .when(F.col("fractional") > 0, "holds fractions")
        .when(too_long, F.concat(F.lit("needs room for "), F.col("longest"), F.lit(" characters")))
    )
    return _rows(raw, measures, labels).select(
        "column_name", F.col("declared").alias("declared_type"), final.alias("final_type"),
        reason.alias("reason"),
    )


def whole(column: str, kind: str) -> str:
    """SQL cast of a floating-point column to whole numbers; a fraction stops the job."""
    value = f"`{column}`"
    message = f"'{column} cannot hold ' || {value} || ' as {kind}'"
    fits = f"{value} % 1 = 0 and try_cast({value} as {kind}) is not null"
    return f"if({value} is null or ({fits}), try_cast({value} as {kind}), raise_error({message}))"


def strict(column: str, kind: str) -> str:
    """SQL cast of a text column that stops the job on a value it cannot take.

    It does so whatever the session's ANSI mode, and names the column and the value.
    """
    text = f"`{column}`"
    if kind in WHOLE_TYPES:
        # Plain digits need no decimal; other spellings of whole numbers (5.0, 1e3) do. The plain
        # cast would strip a delete character, which is no blank.
        number = f"try_cast(trim({text}) as decimal(38,6))"
        value = (f"coalesce(if(contains({text}, chr(127)), null, try_cast({text} as {kind})), "
                 f"if({number} % 1 = 0, try_cast({number} as {kind}), null))")
    elif kind == "date":
        value = ", ".join(f"try_to_date({text}, '{f}')" for f in C.QUOTE_DATE_FORMATS)
        value = f"coalesce({value})"
    else:
        value = f"try_cast(trim({text}) as {kind})"
    message = f"'{column} cannot hold ' || {text} || ' as {kind}'"
    # The value is written once, so it is computed once.
    return f"coalesce({value}, if({text} is null, null, raise_error({message})))"


def typed(raw: DataFrame, kind: str, report: DataFrame) -> DataFrame:
    """``raw`` under its final staging types. The report is one row per column."""
    final = {r.column_name: r.final_type for r in report.collect()}
    columns = []
    for column, declared in _declared(raw, kind).items():
        target = final.get(column, declared)
        value = f"`{column}`" if target.startswith("text") else strict(column, target)
        columns.append(f"{value} as `{column}`")
    return raw.selectExpr(*columns)
