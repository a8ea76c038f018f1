"""Periodic runs, language identification and tokenizer alignment against plain rules."""

import hashlib
import random
import re
import unicodedata
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapstar.llm import alignment, language, periodic
from snapstar.llm.text import table
from snapstar.session import new_folder

BLANK = re.compile(r"[^\x20\x09-\x0D]+")


# periodic runs

def plain_runs(words):
    found = {}
    for period in range(1, len(words) // 3 + 1):
        start = 0
        while start < len(words) - period:
            end = start
            while end < len(words) - period and words[end] == words[end + period]:
                end += 1
            if end - start + period >= max(24, 3 * period):
                found.setdefault((start, end + period), period)
            start = max(end, start + 1)
    return sorted((a, b - a, q) for (a, b), q in found.items())


def odd_words(rng):
    n, letters = rng.choice([0, 5, 23, 24, 25, 60, 150, 400]), rng.choice([1, 2, 3, 50])
    words = [b"%d" % rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randrange(4) if n > 23 else 0):
        at = rng.randrange(n)
        period = rng.randrange(1, max(2, (n - at) // 3 + 1))
        for k in range(at + period, rng.randrange(at, n + 1)):
            words[k] = words[k - period]
    return words


@pytest.mark.parametrize("cells", [1 << 17, 64])
def test_runs_of_many_texts(monkeypatch, cells):
    monkeypatch.setattr(periodic, "CELLS", cells)
    rng = random.Random(cells)
    for _ in range(12):
        texts = [odd_words(rng) for _ in range(20)]
        assert periodic.found_runs(texts) == [plain_runs(words) for words in texts]


def test_equal_texts_side_by_side_make_no_run_together():
    text = [b"%d" % k for k in range(40)]
    assert periodic.found_runs([text] * 9) == [[]] * 9


def test_runs_survive_weak_hashes(monkeypatch):
    """Prefix hashes that find every stretch equal: the word by word comparison repairs it."""
    monkeypatch.setattr(
        periodic.Words, "same", lambda self, at, length, distance: np.ones(len(at), bool))
    rng = random.Random(3)
    for _ in range(6):
        texts = [odd_words(rng) for _ in range(10)]
        assert periodic.found_runs(texts) == [plain_runs(words) for words in texts]


def test_a_long_text_of_one_word_and_a_word_without_end():
    assert periodic.found_runs([[b"a"] * 300_000]) == [[(0, 300_000, 1)]]
    doubled = b"0"
    for _ in range(13):
        doubled += doubled.translate(bytes.maketrans(b"01", b"10"))
    words = [doubled[k:k + 1] for k in range(len(doubled))]
    assert periodic.found_runs([words]) == [[]]  # no word stands three times in a row in it
    assert periodic.found_runs([words[:1024] * 3]) == [[(0, 3072, 1024)]]


def planted_words(doc_id, text):
    words = BLANK.findall(text or "")
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g = h // 10
    if h % 10 == 0 and words:
        a = g % len(words)
        p = 1 + (len(words) - a) // (3 + g % 8)
        words = words[:a] + [words[a + k % p] for k in range(len(words) - a)]
    return words


def test_runs_query_on_whole_table(spark, sf_dir):
    texts = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    rows = periodic.op11_periodic_runs(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    seen = 0
    for row in rows:
        words = planted_words(row.doc_id, texts[row.doc_id])
        if len(words) > 3000:
            continue  # the plain rule is quadratic
        runs = plain_runs(words)
        seen += bool(runs)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        assert (row.n_runs, row.start, row.length, row.period) == (len(runs), *best)
        assert row.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert row.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()
    assert seen > 10


ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "w" * 100_000), (5, "no run here"), (5, "no run here"),
    (None, "a b " * 30), (None, None), (6, "long words go on and on here\n" * 70_000),
]


def odd_rows(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("_key", "_text", "runs", "part", "pairs", "lang_pred", "score", "n_a", "task"):
        frame = frame.selectExpr("*", f"'x' AS {name}")
    return frame


def test_runs_of_odd_rows(spark):
    rows = periodic.periodic_runs(odd_rows(spark, ODD)).collect()
    got = Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in rows)
    assert got == Counter([
        (1, 0, (), ""), (2, 0, (), ""), (3, 0, (), ""), (4, 1, (), "w" * 100_000),
        (5, 3, (), "no run here"), (5, 3, (), "no run here"), (None, 60, ((0, 60, 2),), "a b"),
        (None, 0, (), ""), (6, 490_000, ((0, 490_000, 7),), "long words go on and on here"),
    ])
    assert periodic.periodic_runs(odd_rows(spark, [])).collect() == []


# language identification

def plain_grams(text):
    marked = "".join(
        c if unicodedata.category(c)[0] in "LM" else " " for c in f" {(text or '').lower()} ")
    marked = re.sub(" +", " ", marked)
    return [
        marked[k:k + n] for n in language.SIZES for k in range(len(marked) - n + 1)
        if marked[k:k + n] != " "
    ]


def test_grams_by_text():
    texts = ["a", "", None, "Ab  c!1é", "12 3", "x" * 9, "été", "\U0001F600 ok"]
    buckets, starts, letters = language.grams(texts)
    number = {}
    for k, text in enumerate(texts):
        end = starts[k + 1] if k + 1 < len(starts) else len(buckets[0])
        held = sorted(
            (size, b) for size, row in zip(language.SIZES, buckets)
            for b in row[starts[k]:end].tolist() if b < language.BUCKETS)
        plain = plain_grams(text)
        assert Counter(size for size, _ in held) == Counter(map(len, plain))
        alone = language.grams([text])[0]
        assert held == sorted(
            (size, b) for size, row in zip(language.SIZES, alone) for b in row.tolist()
            if b < language.BUCKETS)
        for gram in set(plain):
            number.setdefault(gram, set()).add(plain.count(gram))
    assert letters.tolist() == [True, False, False, True, False, True, True, True]


def test_posterior_by_plain_counts(spark):
    rows = [
        (1, "the cat and the dog", "en"), (2, "the end", "en"), (3, "le chat et le chien", "fr"),
        (4, None, "fr"), (5, "42", "fr"), (6, "gar nichts", None), (7, "the the", "en"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = language.train(docs)
    assert model.names == ["en", "fr"]
    hashed = lambda text: [
        b for row in language.grams([text])[0] for b in row.tolist() if b < language.BUCKETS]
    counts = {
        name: Counter(b for _, text, lang in rows if lang == name for b in hashed(text))
        for name in model.names}
    for text in ("the chat", "le dog", "zzz", "", "7"):
        logs = []
        for name, n_docs in (("en", 3), ("fr", 3)):
            total = sum(counts[name].values()) + language.SMOOTHING * language.BUCKETS
            logs.append(np.log(n_docs / 6) + sum(
                np.log((counts[name][b] + language.SMOOTHING) / total) for b in hashed(text)))
        (name,), (score,) = model.predict([text])
        if any(c.isalpha() for c in text):
            assert name == model.names[int(np.argmax(logs))]
            assert score == pytest.approx(1 / sum(np.exp(x - max(logs)) for x in logs))
        else:
            assert (name, score) == ("und", 0.0)


def test_languages_held_out(spark, sf_dir):
    truth = {r.doc_id: r.lang for r in table(spark, sf_dir, "documents").collect()}
    rows = language.op12_language_id(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_languages_of_odd_rows(spark, monkeypatch):
    learned = spark.createDataFrame([("hello there", "en"), ("bonjour", "fr")], "text string, lang string")
    model = language.train(learned)
    rows = language.identify(odd_rows(spark, ODD), model).collect()
    assert Counter((r.doc_id, r.lang_pred) for r in rows if r.lang_pred == "und") == Counter(
        {(1, "und"): 1, (2, "und"): 1, (3, "und"): 1, (None, "und"): 1})
    assert len(rows) == len(ODD)
    assert language.identify(odd_rows(spark, []), model).collect() == []
    empty = language.train(learned.limit(0))
    assert {(r.lang_pred, r.score) for r in language.identify(odd_rows(spark, ODD), empty).collect()} == {
        ("und", 0.0)}
    monkeypatch.setattr(language, "MOST_LANGUAGES", 1)
    with pytest.raises(Exception, match="more than 1 languages"):
        language.train(learned)


# tokenizer alignment

def plain_alignment(texts):
    """The rows of measure() by comparing all ranges."""
    from tokenizers import Tokenizer

    a, b = alignment.ByteLevel(), alignment.Pieces()
    whole = Tokenizer.from_file(alignment.A_FILE)
    whole.encode_special_tokens = True
    out, met = [], Counter()
    for text in texts:
        a_ids = whole.encode(" " + text, add_special_tokens=False).ids if text else []
        b_ids = b.encoder.encode(text) if text else []
        spans = []
        for ids, vocabulary in ((a_ids, a), (b_ids, b)):
            ends = np.cumsum([0] + [len(vocabulary.bytes[k]) for k in ids]).tolist()
            spans.append(list(zip(ids, ends, ends[1:])))
            if text and b"".join(vocabulary.bytes[k] for k in ids) != (" " + text).encode():
                spans = None
                break
        if not text or spans is None:
            out.append(([], [], [], []))
            continue
        links = [(x, y) for x, s, e in spans[0] for y, u, v in spans[1] if s < v and u < e]
        met.update(links)
        cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups = [
            "|".join(",".join(str(k) for k, _, e in side if low < e <= high) for side in spans)
            for low, high in zip([0] + cuts, cuts)]
        out.append((a_ids, b_ids, groups, links))
    top = defaultdict(int)
    for (_, y), n in met.items():
        top[y] = max(top[y], n)
    return [
        (len(x), len(y), len(groups), len(links), sum(met[p] == top[p[1]] for p in links),
         sum(met[p] for p in links), ";".join(groups))
        for x, y, groups, links in out]


MIXED = [
    None, "", " ", "a▁b", "<|endoftext|> x <s></s>", "\x00\x01é😀 \n\n  \t x", "  lead", "é ﬁ ①",
    "　x", "<0x41>", " " * 40, "x" * 300, "x" * 300, "กำ word's they'll 12345",
    " " * 30_000 + "end", "tail" + "\n" * 20_000,
]


def test_alignment_by_ranges(spark, sf_dir):
    texts = [r.text[:400] for r in table(spark, sf_dir, "documents").limit(60).collect()] + MIXED
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    folder = new_folder(spark, "alignment-test")
    alignment.align(docs).write.parquet(folder)
    rows = alignment.measure(spark.read.parquet(folder)).orderBy("doc_id").collect()
    expected = plain_alignment([t if t is None or len(t) < 10_000 else t[:50] for t in texts])
    for row, plain, text in zip(rows, expected, texts):
        if text is None or len(text) < 10_000:
            got = (row.n_a, row.n_b, row.n_groups, row.n_links)
            assert (got, row.groups) == (plain[:4], plain[6]), text
    short = [k for k, t in enumerate(texts) if t is None or len(t) < 10_000]
    folder = new_folder(spark, "alignment-test")
    alignment.align(docs.where(F.col("doc_id").isin(short))).write.parquet(folder)
    rows = alignment.measure(spark.read.parquet(folder)).orderBy("doc_id").collect()
    expected = plain_alignment([texts[k] for k in short])
    assert [(r.n_best, r.count_sum) for r in rows] == [plain[4:6] for plain in expected]


def test_both_encoders_agree():
    vocabulary = alignment.ByteLevel()
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000][::37]
    for first in range(0, len(points), 5000):
        text = "".join(f"a{chr(c)}b {chr(c)}1  {chr(c)}!\n" for c in points[first:first + 5000])
        assert vocabulary.ids([text])[0].as_py() == vocabulary.steady.encode(" " + text).ids


def test_alignment_of_odd_rows(spark):
    rows = alignment.align(odd_rows(spark, ODD)).collect()
    assert Counter(r.doc_id for r in rows) == Counter(k for k, _ in ODD)
    for row in rows:
        assert sum(row.links) == row.n_links and len(set(row.pairs)) == len(row.pairs)
        if row.doc_id in (1, 2):
            assert (row.n_a, row.n_b, row.n_groups, row.groups, row.pairs) == (0, 0, 0, "", [])
    folder = new_folder(spark, "alignment-test")
    alignment.align(odd_rows(spark, [])).write.parquet(folder)
    assert alignment.measure(spark.read.parquet(folder)).collect() == []


def test_alignment_query_on_whole_table(spark, sf_dir):
    rows = alignment.op13_tokenizer_alignment(spark, sf_dir).collect()
    documents = table(spark, sf_dir, "documents").collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in documents)
    chosen = sorted(documents, key=lambda r: len(r.text or ""))[:100]
    plain = dict(zip([r.doc_id for r in chosen], plain_alignment([r.text for r in chosen])))
    for row in rows:
        if row.doc_id in plain:
            assert (row.n_a, row.n_b, row.n_groups, row.n_links) == plain[row.doc_id][:4]
            written = plain[row.doc_id][6]
            assert row.groups_sha256 == (
                hashlib.sha256(written.encode()).hexdigest() if written else "")
