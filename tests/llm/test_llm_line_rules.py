"""The line rule on planted templates: what it rejects, what it spares, and the SQL beside it."""

import random

import duckdb
import pytest

from snapstar.llm import line_rules

TEMPLATE = "Subscribe to our weekly letter and follow us on 12 networks today"
FOOTER = "all rights reserved by the owners of this page since 1998"
SCHEMA = "doc_id long, text string, source string, _host string, _words string, n_words string"


def prose(dice, count):
    return " ".join("".join(dice.choices("abcdefghij", k=6)) for _ in range(count))


def planted():
    """{kind: rows (doc_id, text, source)}; a hot host of 1,600 documents and one of 90."""
    dice = random.Random(11)
    kinds = {}

    def put(kind, text, host):
        put.id += 1
        kinds.setdefault(kind, []).append((put.id, text, host))

    put.id = 0
    for host, many in (("hot", 1400), ("small", 20)):
        for _ in range(many):
            put("clean", prose(dice, 40) + "\n" + prose(dice, 30), host)
        for n in range(60):  # templates with a few own words, in odd case, digits and blanks
            line = TEMPLATE.upper().replace("12", str(10 + n)) if n % 2 else f"  {TEMPLATE}\t"
            put("template", "\n".join([line, prose(dice, 35), FOOTER]), host)
            put("shared line", TEMPLATE + "\n" + prose(dice, 70), host)
        copied = "\n".join(prose(dice, 20) for _ in range(4))
        for _ in range(80):
            put("copies", copied, host)
    for _ in range(30):  # more than MIN_DOCUMENTS, but below the root of a hot host's documents
        put("rare line", prose(dice, 45) + "\nonly thirty of them hold this line here", "hot")
    for n in range(20):  # a tie at MIN_DOCUMENTS stays
        put("tie", prose(dice, 45) + "\nexactly twenty of them hold this one", "small")
    return kinds


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(*row, "x", "x", "x") for part in planted().values() for row in part]
    return spark.createDataFrame(rows, SCHEMA).repartition(6)


def test_templates_go_and_clean_texts_stay(spark, frame):
    found = {r["doc_id"]: r for r in line_rules.judge(frame).collect()}
    assert len(found) == frame.count()
    verdicts = {
        kind: {(found[i]["base_failed"], found[i]["kept"], found[i]["n_removed"] > 0) for i, _, _ in part}
        for kind, part in planted().items()
    }
    assert verdicts == {
        "clean": {(False, True, False)}, "template": {(False, False, True)},
        "shared line": {(False, True, True)}, "copies": {(False, True, False)},
        "rare line": {(False, True, False)}, "tie": {(False, True, False)},
    }


def test_same_as_sql_where_the_rule_decides(frame):
    documents = frame.select("doc_id", "text", "source").toPandas()  # noqa: F841
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
             "base_failed", "n_removed", "kept"]
    expected = duckdb.sql(line_rules.OP10_SQL).df()[names].sort_values("doc_id")
    got = line_rules.judge(frame).toPandas()[names].sort_values("doc_id")
    assert got.values.tolist() == expected.values.tolist()
    assert set(got[~got["base_failed"]]["kept"]) == {True, False}


def test_cleaned_texts(spark, frame):
    texts = {i: text for part in planted().values() for i, text, _ in part}
    kept = {r["doc_id"]: r["text"] for r in line_rules.cleaned(frame).collect()}
    kinds = planted()
    assert not {i for i, _, _ in kinds["template"]} & set(kept)
    for i, text, _ in kinds["shared line"]:
        assert kept[i] == text.split("\n")[1]
    for kind in ("clean", "copies", "rare line", "tie"):
        for i, _, _ in kinds[kind]:
            assert kept[i] == texts[i]


def test_rows_of_one_id_have_their_own_verdict(spark, frame):
    dice = random.Random(5)
    good = prose(dice, 60)
    bad = "\n".join([TEMPLATE, prose(dice, 35), FOOTER])
    both = frame.unionByName(spark.createDataFrame(
        [(999_999, good, "hot", "x", "x", "x"), (999_999, bad, "hot", "x", "x", "x")], SCHEMA))
    assert sorted(r["kept"] for r in line_rules.judge(both).where("doc_id = 999999").collect()) == [
        False, True]
    assert [r["text"] for r in line_rules.cleaned(both).where("doc_id = 999999").collect()] == [good]


def test_very_long_texts(spark):
    dice = random.Random(3)
    rows = [
        (1, prose(dice, 300_000), "a"), (2, "x" * 2_000_000, "a"),
        (3, "\n".join(prose(dice, 5) for _ in range(20_000)), "a"),
    ]
    found = {r["doc_id"]: r for r in line_rules.judge(
        spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert [found[i]["n_words"] for i in (1, 2, 3)] == [300_000, 1, 100_000]
    assert [found[i]["kept"] for i in (1, 2, 3)] == [True, False, True]
