"""Quality rules: lines that many documents of a host share.

Lines are normalised (A-Z in lower case, digits as 0, white space runs as one blank, ends trimmed)
and hashed. For each host the distinct documents holding a line are counted; a line above the
limit is removed from every document of the host, and a document left with too little is rejected.
Documents of equal text count once, so copies of a clean text are not taken for boilerplate. The
limit is the larger of ``MIN_DOCUMENTS`` and the square root of the host's documents: chance
repeats grow with a host, but a template of a large host lies in far more than that. Lines of
fewer than ``MIN_LINE_WORDS`` words carry no sign of a template and are never removed.

Everything is DataFrame functions. What is shuffled are (host, hash) counts, combined on the map
side, so a line that a third of all documents hold is one row per task, and three narrow columns
per line of documents with candidates; texts never move. A text of any length is one row with an
array of its words; its lines travel one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from snapstar.llm.text import BLANK, LOWER, UPPER, WORD, table, words

SYMBOLS = r"#*$%&|<>"
MIN_WORDS, REPEAT_PERCENT = 50, 50
MIN_DOCUMENTS = 20
MIN_LINE_WORDS = 4
#: A document is depleted if removal leaves fewer than ``MIN_WORDS``, or this share of its words.
LEFT_PERCENT = 20
WHITE = " \t\n\x0b\x0c\r"


def lines(text: Column) -> Column:
    """The \\n-separated lines of a text that hold a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(WORD))


def normalised(line: Column) -> Column:
    lowered = F.translate(line, UPPER + "123456789", LOWER + "000000000")
    return F.trim(F.regexp_replace(lowered, BLANK, " "))


def n_repeated(array: Column) -> Column:
    """Words lying in three-word windows that occur twice or more.

    Windows are hashed; only texts with a repeated hash pay for the sort that finds the places.
    """
    size = F.size(array)
    place = F.sequence(F.lit(0), size - 3)
    window = lambda i: F.xxhash64(
        F.get(array, i), F.get(array, i + 1), F.get(array, i + 2)
    )
    hashes = F.transform(place, window)
    ordered = F.array_sort(F.transform(place, lambda i: F.struct(window(i).alias("h"), i.alias("i"))))
    # One struct holds the ordered windows, so that the neighbours are looked up in a value.
    def marked(all_: Column) -> Column:
        same = lambda k, a, b: F.get(all_, a).getField("h") == F.get(all_, b).getField("h")
        hit = F.filter(
            F.sequence(F.lit(0), F.size(all_) - 1),
            lambda k: F.coalesce(same(k, k, k - 1), F.lit(False))
            | F.coalesce(same(k, k, k + 1), F.lit(False)),
        )
        return F.array_sort(F.transform(hit, lambda k: F.get(all_, k).getField("i")))

    starts = F.element_at(F.transform(F.array(ordered), marked), 1)
    covered = F.element_at(F.transform(F.array(starts), lambda at: F.aggregate(
        F.sequence(F.lit(0), F.size(at) - 1), F.lit(0),
        lambda total, k: total + F.least(
            F.lit(3), F.coalesce(F.get(at, k + 1) - F.get(at, k), F.lit(3))),
    )), 1)
    return F.when(size < 3, F.lit(0)).when(
        F.size(F.array_distinct(hashes)) == size - 2, F.lit(0)
    ).otherwise(covered).cast("long")


def base_rules(rows: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed.

    ``rows`` keep their other columns. Null texts count as empty: all counts 0, base_failed true.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    counted = rows.withColumns({"_words": words(F.col(text)), "_lines": lines(F.col(text))})
    counted = counted.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.translate(body, WHITE, "")).cast("long"),
        "n_symbols": (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": n_repeated(F.col("_words")),
    }).drop("_words", "_lines")
    return counted.withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")),
    )


def row_lines(rows: DataFrame, key: str, text: str, host: str) -> DataFrame:
    """(_key, _host, _text, _at, line, words) for each line of at least ``MIN_LINE_WORDS`` words.

    ``_text`` is a hash of the text: rows that share key, host and text are one document.
    """
    plain = F.transform(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), normalised)
    found = F.filter(
        F.transform(plain, lambda line: F.struct(
            F.xxhash64(line).alias("line"), F.size(F.split(line, " ")).alias("words"))),
        lambda line: line["words"] >= MIN_LINE_WORDS,
    )
    return rows.select(*identity(key, text, host), F.posexplode(found).alias("_at", "_line")).select(
        "_key", "_host", "_text", "_at", "_line.line", "_line.words"
    )


def identity(key: str, text: str, host: str) -> list[Column]:
    return [
        F.col(key).alias("_key"), F.coalesce(F.col(host).cast("string"), F.lit("")).alias("_host"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_text"),
    ]


def frequent_lines(rows: DataFrame, key: str, text: str, host: str) -> DataFrame:
    """(_host, line, n_documents) of lines above their host's limit.

    Documents of a host are its distinct texts, null and empty ones together being one.
    """
    held = row_lines(rows, key, text, host).select("_host", "line", "_text").distinct()
    counts = held.groupBy("_host", "line").agg(F.count("*").alias("n_documents"))
    documents = rows.select(*identity(key, text, host)[1:]).distinct()
    sizes = documents.groupBy("_host").agg(F.count("*").alias("n_host"))
    n = F.col("n_documents")
    return counts.where(n > MIN_DOCUMENTS).join(sizes, "_host").where(
        n * n > F.col("n_host")
    ).select("_host", "line", "n_documents")


def removed_words(rows: DataFrame, key: str, text: str, host: str) -> DataFrame:
    """(_key, _host, _text, n_removed): words in lines that go, for documents that lose any."""
    gone = row_lines(rows, key, text, host).join(
        frequent_lines(rows, key, text, host), ["_host", "line"]
    )
    once = gone.select("_key", "_host", "_text", "_at", "words").distinct()
    return once.groupBy("_key", "_host", "_text").agg(F.sum("words").alias("n_removed"))


def _same(a: str = "", b: str = "2") -> Column:
    """Whether two sides mean the same document (``identity``); a null key equals a null key."""
    return F.col(f"_key{a}").eqNullSafe(F.col(f"_key{b}")) & (
        F.col(f"_host{a}") == F.col(f"_host{b}")) & (F.col(f"_text{a}") == F.col(f"_text{b}"))


_OTHER = {"_key": "_key2", "_host": "_host2", "_text": "_text2"}


def _judged(rows: DataFrame, key: str, text: str, host: str) -> DataFrame:
    base = base_rules(
        rows.select(*identity(key, text, host), F.col(text).alias("_body")), "_body"
    ).drop("_body")
    removed = removed_words(rows, key, text, host).withColumnsRenamed(_OTHER)
    gone = F.coalesce(F.col("n_removed"), F.lit(0))
    left = F.col("n_words") - gone
    depleted = (gone > 0) & (
        (left < MIN_WORDS) | (100 * left < LEFT_PERCENT * F.col("n_words"))
    )
    return base.join(removed, _same(), "left").select(
        "_key", "_host", "_text", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", gone.alias("n_removed"),
        (~F.col("base_failed") & ~depleted).alias("kept"),
    )


def judge(rows: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """(key, counts, base_failed, n_removed, kept), one row per input row, repeats included.

    Null texts count as empty and are not kept; null hosts are one host without a name; a null key
    is one document; other columns are left out, so their names cannot clash. Empty input gives no
    rows. Ties at a limit stay (only counts above it go).
    """
    return _judged(rows, key, text, host).withColumnRenamed("_key", key).drop("_host", "_text")


def cleaned(rows: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """(key, text): the texts of kept documents without the lines that go.

    The lines to remove reach a document as an array of hashes of its own lines only. Of rows that
    share a key each text has its own verdict.
    """
    parts = rows.select(*identity(key, text, host), F.col(text).alias("_body"))
    gone = row_lines(rows, key, text, host).join(
        frequent_lines(rows, key, text, host), ["_host", "line"]
    ).groupBy("_key", "_host", "_text").agg(F.collect_set("line").alias("_gone"))
    kept = _judged(rows, key, text, host).where("kept").select("_key", "_host", "_text").distinct()
    whole = parts.join(kept.withColumnsRenamed(_OTHER), _same(), "left_semi").join(
        gone.withColumnsRenamed(_OTHER), _same(), "left")
    stays = F.filter(
        F.split("_body", "\n"),
        lambda line: ~F.coalesce(F.array_contains("_gone", F.xxhash64(normalised(line))), F.lit(False))
        | (F.size(words(line)) < MIN_LINE_WORDS),
    )
    return whole.select(F.col("_key").alias(key), F.array_join(stays, "\n").alias(text))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict of the line rule for every document, by its source."""
    return judge(table(spark, sf_dir, "documents"))


OP10_SQL = f"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
           coalesce(source, '') AS host, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents),
split AS (
    SELECT rid, text, host, unnest(string_split(text, chr(10))) AS raw FROM d),
l AS (
    SELECT rid, text, host, raw,
           len(regexp_extract_all(raw, '[^\\x20\\x09-\\x0D]+')) AS words,
           trim(regexp_replace(translate(raw, '{UPPER}123456789', '{LOWER}000000000'),
                               '[\\x20\\x09-\\x0D]+', ' ', 'g'), ' ') AS line
    FROM split WHERE regexp_matches(raw, '[^\\x20\\x09-\\x0D]')),
dup AS (SELECT rid, count(*) - count(DISTINCT raw) AS n_dup_lines FROM l GROUP BY rid),
hosts AS (SELECT host, count(DISTINCT text) AS n_host FROM d GROUP BY host),
freq AS (
    SELECT host, line FROM l JOIN hosts USING (host) WHERE words >= {MIN_LINE_WORDS}
    GROUP BY host, line, n_host
    HAVING count(DISTINCT text) > {MIN_DOCUMENTS}
       AND count(DISTINCT text) * count(DISTINCT text) > n_host),
gone AS (SELECT rid, sum(words) AS n_removed FROM l JOIN freq USING (host, line) GROUP BY rid),
win AS (
    SELECT rid, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
    FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
hit AS (SELECT rid, a, b, c FROM win GROUP BY ALL HAVING count(*) > 1),
rep AS (
    SELECT rid, count(DISTINCT p) AS n_repeat_words
    FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM win JOIN hit USING (rid, a, b, c))
    GROUP BY rid),
counted AS (
    SELECT doc_id, len(w) AS n_words,
           length(array_to_string(w, '')) AS word_chars,
           CAST(length(text) - length(translate(text, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
           coalesce(n_dup_lines, 0) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words,
           CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed
    FROM d LEFT JOIN dup USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN gone USING (rid)),
judged AS (
    SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words
              AS base_failed,
           n_words - n_removed AS n_left
    FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_removed,
       NOT base_failed AND NOT (n_removed > 0 AND (n_left < {MIN_WORDS}
           OR 100 * n_left < {LEFT_PERCENT} * n_words)) AS kept
FROM judged
"""
