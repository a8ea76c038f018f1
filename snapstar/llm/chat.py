"""Chat formatting by perspective rotation.

Every participant of a conversation is rendered once as the assistant; the other speakers become
users with their names, context roles (system) keep theirs. Mask spans mark what a model learns:
the assistant's words with their end mark.

A dialogue is delivered in blocks of ``BLOCK_TURNS`` turn numbers; the blocks of a perspective in
order of (block, part) are its text. So no conversation, however long, is ever one row or one
task: a block above ``BLOCK_ROWS`` rows (a turn number that repeats) is split once more into
parts of at most so many turns. Its identical turns are counted first and dealt to parts by their
count, so copies of one turn, however many, are not gathered. Spans count code points from the
start of their part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from snapstar.llm.text import table

BLOCK_TURNS, BLOCK_ROWS = 64, 4096
CONTEXT = ("system",)
NAMELESS = "unknown"


def speaker(role: Column) -> Column:
    """A role as a name: trimmed, one line, nameless if null or blank."""
    name = F.trim(F.regexp_replace(F.coalesce(role, F.lit("")), r"[\x00-\x20]+", " "))
    return harmless(F.when(name == "", F.lit(NAMELESS)).otherwise(name))


def harmless(text: Column) -> Column:
    """Text that cannot open a control mark of the template."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def blocks(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text",
) -> DataFrame:
    """(_conv, block, part, turns): ordered turns (at, tie, name, body, times) of each block.

    Turns are ordered by number, null first, those of equal number by the md5 of name and text.
    Identical turns of a large block are one, with their ``times`` in the part.
    """
    turns = rows.select(
        F.col(conv).alias("_conv"), F.col(turn).cast("long").alias("at"),
        speaker(F.col(role)).alias("name"), harmless(F.col(text)).alias("body"),
    ).withColumns({
        "tie": F.md5(F.concat("name", F.lit("\n"), "body").cast("binary")),
        "block": F.coalesce(F.floor(F.col("at") / BLOCK_TURNS), F.lit(-(2**62))).cast("long"),
    })
    large = turns.groupBy("_conv", "block").agg(F.count("*").alias("n")).where(
        F.col("n") > BLOCK_ROWS
    ).select(
        F.col("_conv").alias("_conv2"), F.col("block").alias("block2"),
        F.ceil(F.col("n") / BLOCK_ROWS).alias("ways"),
    )
    same = F.col("_conv").eqNullSafe(F.col("_conv2")) & (F.col("block") == F.col("block2"))
    counted = turns.join(large, same, "left_semi").groupBy(
        "_conv", "block", "at", "tie", "name", "body").agg(F.count("*").alias("n"))
    share = F.conv(F.substring("tie", 1, 8), 16, 10).cast("long") * F.col("ways") / F.lit(2**32)
    offset = F.coalesce(F.col("at") - F.col("block") * BLOCK_TURNS, F.lit(0))
    # A window over one bin holds its distinct turns, about BLOCK_ROWS by the hash.
    within = Window.partitionBy("_conv", "block", "bin").orderBy("at", "tie", "name", "body")
    ranged = counted.join(large, same).withColumn(
        "bin", (offset * F.col("ways") + F.floor(share)).cast("long")
    ).withColumn("end", F.sum("n").over(within)).withColumn("start", F.col("end") - F.col("n"))
    piece = lambda row: F.floor(row / BLOCK_ROWS)
    dealt = ranged.withColumn(
        "piece", F.explode(F.sequence(piece(F.col("start")), piece(F.col("end") - 1)))
    ).select(
        "_conv", "block", (F.shiftleft("bin", 31) + F.col("piece")).alias("part"),
        "at", "tie", "name", "body",
        (F.least("end", (F.col("piece") + 1) * BLOCK_ROWS)
         - F.greatest("start", F.col("piece") * BLOCK_ROWS)).cast("int").alias("times"),
    )
    small = turns.join(large, same, "left_anti").select(
        "_conv", "block", F.lit(0).cast("long").alias("part"), "at", "tie", "name", "body",
        F.lit(1).alias("times"))
    return small.unionByName(dealt).groupBy("_conv", "block", "part").agg(
        F.array_sort(F.collect_list(F.struct(
            F.coalesce("at", F.lit(-(2**63))).alias("at"), "tie", "name", "body", "times"
        ))).alias("turns")
    )


def perspectives(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", context: tuple[str, ...] = CONTEXT,
) -> DataFrame:
    """(conv, participant, block, part, n_turns, text, mask_start, mask_end).

    Each speaker outside ``context`` gives one perspective with all blocks. Repeated rows are
    turns of their own. A null conversation id is one conversation; null or blank roles speak as
    "unknown"; null texts are empty; a conversation of context roles only has no participant and
    no row; empty input gives no rows. Other columns are left out.
    """
    who = rows.select(F.col(conv).alias("_who"), speaker(F.col(role)).alias("participant")).where(
        ~F.col("participant").isin(*context)
    ).distinct()
    views = blocks(rows, conv, turn, role, text).join(
        who, F.col("_conv").eqNullSafe(F.col("_who"))
    )

    def header(name: Column) -> Column:
        return F.when(name == F.col("participant"), F.lit("<|im_start|>assistant\n")).when(
            name.isin(*context), F.concat(F.lit("<|im_start|>"), name, F.lit("\n"))
        ).otherwise(F.concat(F.lit("<|im_start|>user name="), name, F.lit("\n")))

    pieces = F.transform("turns", lambda t: F.struct(
        header(t["name"]).alias("head"), F.concat(t["body"], F.lit("<|im_end|>")).alias("said"),
        (t["name"] == F.col("participant")).alias("own"),
    ))
    spans = F.aggregate(
        "pieces",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("open"),
                 F.array().cast("array<int>").alias("close")),
        lambda state, p: F.struct(
            (state["at"] + F.length(p["head"]) + F.length(p["said"]) + 1).alias("at"),
            F.when(p["own"], F.concat(state["open"], F.array(state["at"] + F.length(p["head"]))))
            .otherwise(state["open"]).alias("open"),
            F.when(p["own"], F.concat(
                state["close"], F.array(state["at"] + F.length(p["head"]) + F.length(p["said"]))
            )).otherwise(state["close"]).alias("close"),
        ),
    )
    each = F.flatten(F.transform("turns", lambda t: F.array_repeat(t, t["times"])))
    shown = views.withColumn("turns", each).withColumn("pieces", pieces).withColumn("spans", spans)
    rendered = F.array_join(
        F.transform("pieces", lambda p: F.concat(p["head"], p["said"], F.lit("\n"))), ""
    )
    return shown.select(
        F.col("_conv").alias(conv), "participant", "block", "part",
        F.size("turns").cast("long").alias("n_turns"), rendered.alias("text"),
        F.col("spans.open").alias("mask_start"), F.col("spans.close").alias("mask_end"),
    )


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from every participant's side; text and masks as digests."""
    views = perspectives(table(spark, sf_dir, "conversations"))
    learned = F.aggregate(
        F.zip_with("mask_start", "mask_end", lambda a, b: (b - a).cast("long")),
        F.lit(0).cast("long"), lambda total, n: total + n,
    )
    return views.select(
        "conv_id", "participant", "block", "part", "n_turns",
        F.size("mask_start").cast("long").alias("n_masked"), learned.alias("masked_chars"),
        F.array_join(F.col("mask_start").cast("array<string>"), ",").alias("mask_starts"),
        F.length("text").cast("long").alias("n_chars"),
        F.md5(F.col("text").cast("binary")).alias("text_md5"),
    )


OP1_SQL = f"""
WITH t AS (
    SELECT conv_id, turn,
           coalesce(replace(nullif(trim(regexp_replace(coalesce(role, ''), '[\\x00-\\x20]+', ' ', 'g'),
                    ' '), ''), '<|', '< |'), '{NAMELESS}') AS name,
           replace(coalesce(text, ''), '<|', '< |') AS body
    FROM conversations),
o AS (
    SELECT *, CAST(floor(turn / {BLOCK_TURNS}) AS BIGINT) AS block,
           row_number() OVER (PARTITION BY conv_id, CAST(floor(turn / {BLOCK_TURNS}) AS BIGINT)
                              ORDER BY turn, md5(name || chr(10) || body)) AS k
    FROM t),
who AS (SELECT DISTINCT conv_id, name AS participant FROM t WHERE name <> 'system'),
seg AS (
    SELECT o.conv_id, participant, block, k, name = participant AS own,
           CASE WHEN name = participant THEN '<|im_start|>assistant' || chr(10)
                WHEN name = 'system' THEN '<|im_start|>system' || chr(10)
                ELSE '<|im_start|>user name=' || name || chr(10) END AS head,
           body || '<|im_end|>' AS said
    FROM o JOIN who ON o.conv_id = who.conv_id),
pos AS (
    SELECT *, CAST(sum(length(head) + length(said) + 1) OVER (
                  PARTITION BY conv_id, participant, block ORDER BY k) AS BIGINT)
              - length(said) - 1 AS opens
    FROM seg)
SELECT conv_id, participant, block, CAST(0 AS BIGINT) AS part, count(*) AS n_turns,
       count(*) FILTER (WHERE own) AS n_masked,
       CAST(coalesce(sum(length(said)) FILTER (WHERE own), 0) AS BIGINT) AS masked_chars,
       coalesce(string_agg(opens::VARCHAR, ',' ORDER BY k) FILTER (WHERE own), '') AS mask_starts,
       CAST(sum(length(head) + length(said) + 1) AS BIGINT) AS n_chars,
       md5(string_agg(head || said || chr(10), '' ORDER BY k)) AS text_md5
FROM pos GROUP BY conv_id, participant, block
"""
