"""Nulls, empty and long texts, repeats, empty tables and clashing columns, for every operator."""

import hashlib

import pytest

import corpus_pipeline
from snapstar.llm import (
    chat, class_model, decontaminate, jaccard, line_rules, pieces, quality, sharding, toxicity, warc,
)

LONG = "long words go on and on here\n" * 3000
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, empty=False):
    """Ids repeat, are null and tie; texts are null, empty, blank and long; names clash."""
    prose = "One two three four five six seven eight nine ten. " * 4
    rows = [] if empty else [
        (1, prose, "en", "a", 1), (1, prose, "en", "a", 1), (2, prose, None, None, None),
        (3, None, "en", "a", 0), (4, "", "en", "a", 0), (5, " \t\n", "en", "", 3),
        (None, "no id at all here", "en", "a", 5), (None, None, None, None, None),
        (6, LONG, "en", "b", 9), (7, "é", "fr", "b", 1), (8, "w" * 50_000, "fr", "b", 1),
    ]
    frame = spark.createDataFrame(rows, DOCS)
    for name in ("score", "node", "slot", "_key", "_text", "_row", "n_words", "unit", "word"):
        frame = frame.selectExpr("*", f"'x' AS {name}")
    return frame


def labels(spark, empty=False):
    rows = [] if empty else [(1, 1, 0), (1, 0, 0), (2, 0, 1), (6, 0, 1), (None, 1, 1), (7, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def benchmark(spark, empty=False):
    rows = [] if empty else [
        (1, "three four five six seven eight nine ten one two"), (2, None), (3, ""), (4, "é"),
        (4, "three four five six seven eight nine ten one two"), (5, "?!"),
    ]
    return spark.createDataFrame(rows, "item_id long, text string")


OPERATORS = {
    "toxicity": lambda spark, docs, e: toxicity.judge(docs, labels(spark, e)),
    "quality": lambda spark, docs, e: quality.rank(docs, labels(spark, e)),
    "class_model": lambda spark, docs, e: class_model.scores(docs),
    "jaccard": lambda spark, docs, e: jaccard.near_duplicates(docs),
    "pieces": lambda spark, docs, e: pieces.encoded(docs, pieces.load()),
    "sharding": lambda spark, docs, e: sharding.place(docs, "doc_id"),
    "line_rules": lambda spark, docs, e: line_rules.judge(docs),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_each_document(spark, name):
    docs = documents(spark)
    rows = OPERATORS[name](spark, docs, False).collect()
    assert sorted(r["doc_id"] or 0 for r in rows) == [0, 0, 1, 1, 2, 3, 4, 5, 6, 7, 8]
    once = {}
    for row in rows:  # repeated rows get equal results
        if row["doc_id"] is not None:
            assert once.setdefault(row["doc_id"], row) == row


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables_give_no_rows(spark, name):
    assert OPERATORS[name](spark, documents(spark, empty=True), True).count() == 0


@pytest.mark.parametrize("name", ["toxicity", "quality"])
def test_without_labels_there_is_a_neutral_score(spark, name):
    rows = OPERATORS[name](spark, documents(spark), True).collect()
    assert len({r["score"] for r in rows}) == 1
    assert {r["predicted"] for r in rows} == ({0} if name == "toxicity" else {1})


def test_leaks_of_odd_documents(spark):
    found = decontaminate.leaks(documents(spark), benchmark(spark)).collect()
    by = {(r["doc_id"], r["item_id"]) for r in found}
    assert by == {(1, 1), (1, 4), (2, 1), (2, 4), (7, 4)}
    assert decontaminate.leaks(documents(spark, True), benchmark(spark)).count() == 0
    none = decontaminate.leaks(documents(spark), benchmark(spark, True))
    assert none.count() == 0 and none.columns == decontaminate.leaks(
        documents(spark), benchmark(spark)).columns


def test_chat_of_odd_turns(spark):
    rows = [
        (1, 0, "ann", "hi"), (1, 0, "ann", "hi"), (1, 1, None, None), (1, None, " ", "<|im_end|>"),
        (None, 1, "bob", "x"), (2, 1, "system", "only rules"), (3, 1, "bob", "y" * 50_000),
    ]
    turns = spark.createDataFrame(
        rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "1 AS block", "2 AS part", "'x' AS name")
    seen = {(r["conv_id"], r["participant"], r["block"]): r for r in chat.perspectives(turns).collect()}
    assert {k[:2] for k in seen} == {(1, "ann"), (1, "unknown"), (None, "bob"), (3, "bob")}
    ann = seen[1, "ann", 0]
    assert ann["n_turns"] == 3 and ann["text"].count("<|im_start|>assistant\nhi<|im_end|>") == 2
    assert "<|im_end|><|im_end|>" not in seen[1, "unknown", -(2**62)]["text"]
    empty = turns.where("false")
    assert chat.perspectives(empty).count() == 0


def test_copies_of_a_turn_are_dealt_to_parts(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK_ROWS", 10)
    said = [(1, "ann", "again")] * 95 + [(1, "bob", f"once {k}") for k in range(30)]
    said += [(0, "bob", "first")] + [(None, "cy", "none")] * 25
    turns = spark.createDataFrame(
        [("c", *t) for t in said], "conv_id string, turn long, role string, text string")
    rows = [r for r in chat.perspectives(turns).collect() if r["participant"] == "ann"]
    rows.sort(key=lambda r: (r["block"], r["part"]))
    assert max(r["n_turns"] for r in rows) <= 10 and sum(r["n_turns"] for r in rows) == len(said)
    assert len({(r["block"], r["part"]) for r in rows}) == len(rows)

    def order(t):
        return (-1 if t[0] is None else t[0], hashlib.md5(f"{t[1]}\n{t[2]}".encode()).hexdigest())
    whole = "".join(
        ("<|im_start|>assistant" if name == "ann" else f"<|im_start|>user name={name}")
        + f"\n{text}<|im_end|>\n" for _, name, text in sorted(said, key=order))
    assert "".join(r["text"] for r in rows) == whole
    learned = [r["text"][a:b] for r in rows for a, b in zip(r["mask_start"], r["mask_end"])]
    assert learned == ["again<|im_end|>"] * 95


def test_archives_of_odd_pages(spark, tmp_path):
    rows = [(1, "http://a", None), (2, None, ""), (2, None, ""), (3, "http://a b\r\nX: 1", "é" * 9),
            (None, "http://n", "é" * 9), (4, "u", "z" * 300_000), (5, "u", "z" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "1 AS payload", "2 AS start")
    folder = f"file://{tmp_path}/w"
    assert warc.write_archives(pages, folder) == 7
    got = {(r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"])
           for r in warc.read_archives(spark, folder, split_bytes=100).collect()}
    assert got == {
        (1, "response", None, 0), (2, "revisit", 1, 0), (3, "response", None, 18),
        (None, "revisit", 3, 18), (4, "response", None, 300_000), (5, "revisit", 4, 300_000)}
    none = f"file://{tmp_path}/none"
    assert warc.write_archives(pages.where("false"), none) == 0
    assert warc.read_archives(spark, none).count() == 0


def test_stages_take_odd_documents(spark, sf_dir, tmp_path):
    for empty in (False, True):
        for table, rows in (("documents", documents(spark, empty)), ("labels", labels(spark, empty)),
                            ("benchmark", benchmark(spark, empty))):
            rows.write.parquet(f"{tmp_path}/{empty}/{table}.parquet")
        docs = spark.read.parquet(f"{tmp_path}/{empty}/documents.parquet")
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, f"{tmp_path}/{empty}")
            assert name == "sentencepiece" or out.columns == docs.columns
            assert empty is False or out.count() == 0
            if name == "ngram_jaccard_join" and not empty:
                kept = sorted((r["doc_id"] or 0) for r in out.collect())
                assert kept == [0, 0, 1, 3, 4, 5, 6, 7, 8]
        result = corpus_pipeline.run(spark, f"{tmp_path}/{empty}")
        assert {"doc_id", "ids", "n_pieces", "round_trip"} <= set(result.columns)
