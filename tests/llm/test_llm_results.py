"""Results against SQL, brute force, the published decoder, and held-out labels."""

import io
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from catalogue.compare import connect, difference, spark_result, sql_result
from snapstar.llm import (
    class_model, decontaminate, jaccard, pieces, quality, sharding, toxicity, warc,
)
from snapstar.llm.queries import ENTRIES
from snapstar.llm.text import byte_words, table, word_hashes

WORDS = [f"w{k}" for k in range(400)]


def prose(rng, n):
    return [rng.choice(WORDS) for _ in range(n)]


def changed(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        kind = rng.randrange(3)
        if kind == 0:
            words.insert(at, rng.choice(WORDS))
        elif kind == 1:
            words[at] = rng.choice(WORDS)
        else:
            del words[at]
    return words


@pytest.mark.parametrize("key", sorted(k for k, (_, sql) in ENTRIES.items() if sql))
def test_same_as_sql(spark, sf_dir, key):
    run, sql = ENTRIES[key]
    assert difference(spark_result(run(spark, sf_dir)), sql_result(connect(sf_dir), sql)) is None


# sharding

def test_table_follows_the_turns():
    shards = ("a", "b", "c")
    slots = 101
    orders = {}
    for name in shards:
        start = sharding._hashed("start:" + name) % slots
        step = sharding._hashed("step:" + name) % (slots - 1) + 1
        orders[name] = [(start + k * step) % slots for k in range(slots)]
        assert sorted(orders[name]) == list(range(slots))
    expected = {}
    while len(expected) < slots:
        for number, name in enumerate(shards):
            free = next((s for s in orders[name] if s not in expected), None)
            if free is not None:
                expected[free] = number
    assert sharding.filled_table(shards, slots) == [expected[s] for s in range(slots)]


def test_shards_are_even_and_few_keys_move():
    full = sharding.filled_table(sharding.SHARDS)
    fewer = sharding.filled_table(sharding.SHARDS[:-1])
    counts = Counter(full)
    assert max(counts.values()) - min(counts.values()) <= 1
    last = len(sharding.SHARDS) - 1
    moved = sum(a != b for a, b in zip(full, fewer) if a != last)
    assert moved < 0.25 * len(full)
    with pytest.raises(ValueError):
        sharding.filled_table(("a", "b"), 100)


def test_sharded_rows_are_written_whole(spark, sf_dir, tmp_path):
    docs = table(spark, sf_dir, "documents")
    sharding.write_sharded(docs, "doc_id", f"{tmp_path}/s")
    back = spark.read.parquet(f"{tmp_path}/s")
    assert back.drop("shard").exceptAll(docs).count() == 0 == docs.exceptAll(back.drop("shard")).count()


# pieces

@pytest.fixture(scope="module")
def model():
    return pieces.load()


@pytest.fixture(scope="module")
def published():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def test_ids_are_the_published_ones(spark, sf_dir, model, published):
    rng = random.Random(3)
    parts = [" ", "  ", "a", "the", "in", "\n", "é", "▁", "日", "\t", "ing", " " * 7, "x" * 5, "12",
             "\r\n", "ñ", "́", "😀", "</s>", "<0x0A>", "W" * 40]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += [row["text"] for row in table(spark, sf_dir, "documents").collect()]
    ids, ends = model.encode(texts)
    for text, own in zip(texts, np.split(ids, ends[:-1])):
        assert own.tolist() == published.encode(text)
        assert model.decode(own) == published.decode(own.tolist())
        assert model.decode(own) == text.replace("▁", " ")


def test_words_share_prefixes_in_any_order(model):
    words = ["▁inner", "▁inn", "▁in", "▁outer", "▁out", "▁"]
    alone = {w: next(model.walk([w]))[1] for w in words}
    assert dict(model.walk(sorted(words))) == alone == dict(model.walk(words))


def test_documents_come_back(spark, sf_dir):
    rows = pieces.encoded(table(spark, sf_dir, "documents"), pieces.load())
    assert rows.where("NOT round_trip").count() == 0
    back = rows.withColumn("text", pieces.decoder(pieces.load())(rows["ids"])).select("doc_id", "text")
    assert back.exceptAll(table(spark, sf_dir, "documents").select("doc_id", "text")).count() == 0


# decontamination

def distance(item, line):
    row = [0] * (len(line) + 1)
    for i, a in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(line, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return min(row)


def test_edited_passages_are_found(spark):
    rng = random.Random(5)
    items = [prose(rng, rng.randint(3, 60)) for _ in range(60)]
    docs = []
    for k in range(400):
        line = prose(rng, rng.randint(0, 120))
        if k % 2:
            item = rng.choice(items)
            at = rng.randint(0, len(line))
            line[at:at] = changed(rng, item, rng.randint(0, max(0, len(item) // 4)))
        docs.append((k, " ".join(line)))
    found = decontaminate.leaks(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(
            [(k, " ".join(x).upper() + "!") for k, x in enumerate(items)], "item_id long, text string"),
    ).collect()
    near = {
        (k, i): d for k, text in docs for i, item in enumerate(items)
        if (d := distance(item, text.split())) <= int(decontaminate.MAX_EDITS * len(item))
    }
    got = {(r["doc_id"], r["item_id"]): r for r in found}
    assert set(got) <= set(near)
    assert len(got) >= 0.95 * len(near)
    assert {k for k, d in near.items() if d == 0} <= set(got)
    for key, row in got.items():
        stretch = docs[key[0]][1][row["start"]:row["end"]].split()
        assert row["edits"] >= near[key]
        assert distance(items[key[1]], stretch) == row["edits"]


def test_blocks_of_items_find_the_same(spark, sf_dir, monkeypatch):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    whole = decontaminate.leaks(docs, items)
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 400)
    parts = decontaminate.leaks(docs, items)
    exact = lambda x: {tuple(r) for r in x.where("edits = 0").collect()}
    assert exact(whole) == exact(parts) != set()


def strange(rng, n):
    return rng.integers(1, 2**63, n).astype(np.uint64)


@pytest.mark.parametrize("n", [17, 38])
def test_copies_that_lost_words_at_a_border_are_found(n):
    rng = np.random.default_rng(5)
    items = [strange(rng, n) for _ in range(40)]
    index = decontaminate.Index(list(range(40)), items, 0.2, 0.95)
    lines = []
    for item in items:
        lines += [strange(rng, 30), np.concatenate([item[n // 5:], strange(rng, 30)])]
        lines += [strange(rng, 30), np.concatenate([strange(rng, 30), item[:-(n // 5)]])]
    found = {(text, item) for text, item, *_ in index.search(lines)}
    assert found <= {(4 * k + at, k) for k in range(40) for at in (1, 3)}
    assert len(found) >= 0.95 * 80


def test_each_size_of_items_is_found():
    rng = np.random.default_rng(5)
    sizes = [8] * 60 + [200] * 20 + [400] * 20  # the many short ones must not hide the long ones
    items = [strange(rng, n) for n in sizes]
    index = decontaminate.Index(list(range(100)), items, 0.2, 0.95)
    own = list(range(60, 100)) * 3
    lines = []
    for k in own:
        line = items[k].tolist()
        for _ in range(sizes[k] // 5):
            at, kind = int(rng.integers(0, len(line))), int(rng.integers(0, 3))
            line[at:at + (kind > 0)] = [int(rng.integers(1, 2**63))] * (kind < 2)
        lines.append(np.array(line, np.uint64))
    found = {(text, item) for text, item, *_ in index.search(lines)}
    for n in (200, 400):
        hit = [(at, k) in found for at, k in enumerate(own) if sizes[k] == n]
        assert sum(hit) >= 0.9 * len(hit)


def test_missed_recall_is_an_error(monkeypatch):
    monkeypatch.setattr(decontaminate, "MOST_REPETITIONS", 1)
    with pytest.raises(ValueError, match="64 to 127 words"):
        decontaminate.Index([0], [strange(np.random.default_rng(1), 100)], 0.2, 0.95)


# near duplicates

def components_of(texts, percent=75):
    sets = []
    for text in texts:
        words = byte_words(text)
        width = min(5, len(words))
        sets.append({tuple(words[k:k + width]) for k in range(len(words) - width + 1)} if words else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [len(s) for s in sets], [find(k) for k in range(len(texts))]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_are_those_of_all_pairs(spark, seed):
    rng = random.Random(seed)
    shared = prose(rng, 30)  # a passage that many texts hold
    texts = []
    for _ in range(60):
        base = prose(rng, rng.choice((2, 5, 6, 8, 20, 60, 150)))
        if rng.random() < 0.5:
            base += shared
        chain = base
        for _ in range(rng.choice((1, 1, 3, 12))):
            texts.append(" ".join(chain))
            chain = changed(rng, rng.choice((base, chain)), rng.randint(0, 4)) if len(chain) > 6 else chain
    texts += ["", None, " ", "w1", "W1", "w1 w2"]
    rng.shuffle(texts)
    sizes, roots = components_of(texts)
    rows = jaccard.near_duplicates(spark.createDataFrame(
        list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r["n_shingles"] for r in rows] == sizes
    assert [r["component_id"] for r in rows] == roots


def test_rows_of_a_pair_between_the_extreme_sizes_stay(spark):
    # Sets of 10 and 11 shingles that share 9 link; one of 12 has the token too and is no partner.
    rows = spark.createDataFrame(
        [(7, 1, 10, 1, 1), (7, 2, 11, 2, 1), (7, 3, 12, 0, 1)],
        "token long, node long, n int, at int, least int")
    comps = spark.createDataFrame([], "node long, comp long")
    kept = {r["node"] for r in jaccard.open_rows(rows, comps, 75).collect()}
    assert {1, 2} <= kept


def test_long_chains_become_one_component(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 501)], "a long, b long")
    got = {r["node"]: r["comp"] for r in jaccard.components(links).collect()}
    assert got == {k: 0 for k in range(201)} | {500: 500, 501: 500}


def test_prefixes_grow_with_the_cost():
    free, dear = np.zeros(100, np.float32), np.zeros(100, np.float32)
    dear[:25] = 1000
    assert jaccard.matches(free, 100) == 1
    assert jaccard.matches(dear, 100) == jaccard.MOST_MATCHES


# language model

def test_base_scores_and_gain_over_them(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in table(spark, sf_dir, "documents").collect()}
    rows = {r["doc_id"]: r for r in class_model.scores(table(spark, sf_dir, "documents")).collect()}
    count = Counter()
    for k, text in docs.items():
        if zlib.crc32(str(k).encode()) % 7 != 2:
            count.update([*byte_words(text), b""])
    total = sum(count.values())
    for k, text in docs.items():
        tokens, row = [*byte_words(text), b""], rows[k]
        base = sum(math.log10((count[t] + 1) / (total + len(count) + 1)) for t in tokens)
        assert row["held_out"] == (zlib.crc32(str(k).encode()) % 7 == 2)
        assert (row["n_tokens"], row["train_tokens"]) == (len(tokens), total)
        assert row["n_known"] == sum(count[t] > 0 for t in tokens)
        assert row["base_score"] == pytest.approx(base)
    held = [r for r in rows.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_far_words_score_as_near_ones(spark, sf_dir, monkeypatch):
    docs = table(spark, sf_dir, "documents")
    near = {r["doc_id"]: r["score"] for r in class_model.scores(docs).collect()}
    monkeypatch.setattr(class_model, "NEAR", class_model.HEAD)
    far = {r["doc_id"]: r["score"] for r in class_model.scores(docs).collect()}
    assert near == pytest.approx(far)


def test_exchange_finds_the_two_languages():
    counts = np.zeros((21, 21))
    counts[:10, :10] = np.random.default_rng(4).integers(5, 50, (10, 10))
    counts[10:20, 10:20] = np.random.default_rng(5).integers(5, 50, (10, 10))
    of = class_model.exchange(counts, classes=2)
    assert len(set(of[:10])) == len(set(of[10:20])) == 1
    assert of[0] != of[10] and of[20] == 2


def test_probabilities_of_a_class_sum_to_one(spark):
    texts = spark.createDataFrame([("a b a c",), ("b b d",), ("x y z x",)], "text string")
    model, counts = class_model.train(texts)
    units = class_model._Units({w: u for u, w in enumerate(model.head)} | {b"": class_model.END})
    mass = np.zeros(class_model.CLASSES + 1)
    for row in counts.collect():
        k = model.of[units[bytes(row["word"])]]
        mass[k] += 10 ** (math.log10(row["n"] - class_model.DISCOUNT) - model.tokens[k])
    used = mass > 0
    mass += 10 ** (model.unknown - model.tokens)
    assert mass[used] == pytest.approx(1)
    assert (10 ** model.step).sum(1) == pytest.approx(1)


# classifiers

@pytest.mark.parametrize("run, label", [(quality.rank, "quality"), (toxicity.judge, "toxic")])
def test_held_out_labels(spark, run, label):
    sf_dir = "/root/testdata/sf0.1"
    labels = table(spark, sf_dir, "labels")
    rows = run(table(spark, sf_dir, "documents"), labels).where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r["predicted"] == r[label] for r in rows]) > 0.97
    one = [r["score"] for r in rows if r[label] == 1]
    zero = [r["score"] for r in rows if r[label] == 0]
    assert np.mean([a > b for a in one for b in zero]) > 0.97


def test_swaps_take_the_weight_off_groups():
    texts = [f"the {who} are {what} and live {k}" for k in range(40)
             for who, what, _ in (("women", "vile", 1), ("women", "vile", 1), ("men", "kind", 0))]
    labels = np.array([1, 1, 0] * 40)
    rows = [toxicity.features(t) for t in texts]
    changes = [c for t in texts for c in toxicity.swaps(t)]
    neutral = [toxicity.features(f"the {who} live here") for who in ("women", "men")]
    gap = {}
    for penalty in (0.0, 5.0):
        weights = toxicity.fit(rows, labels, changes, penalty)
        gap[penalty] = abs(weights[neutral[0]].sum() - weights[neutral[1]].sum())
        assert weights[toxicity.features("vile")].sum() > 0
    assert gap[5.0] < 0.2 * gap[0.0]


def test_ranking_cuts_at_the_share_of_bad_rows():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(300, 4))
    labels = (rows[:, 0] > -0.5).astype(int)
    model = quality.fit(rows, labels, float((labels == 0).mean()))
    assert np.mean((model.score(rows) >= quality.THRESHOLD) == labels) > 0.98


# archives

def test_any_split_reads_each_record_once():
    rng = random.Random(2)
    whole, starts = b"", []
    for k in range(40):
        body = bytes(rng.randrange(32, 127) for _ in range(rng.choice((0, 10, 3000, 40_000))))
        starts.append(len(whole))
        whole += warc.member("response", k, f"http://x/{k}", body, "D", len(body))
    for split in (1000, 17_000, 10**9):
        found = [
            at for low in range(0, len(whole), split)
            for at, _, _ in warc.records(io.BytesIO(whole), len(whole), low, low + split)
        ]
        assert found == starts


def test_magic_that_is_no_record_is_passed_over():
    record = warc.member("response", 1, None, b"x", "D", 1)
    noise = b"\x1f\x8b\x08" + b"noise" * 10 + zlib.compress(b"y") + b"\x1f\x8b\x08\x00"
    data = noise + record
    got = list(warc.records(io.BytesIO(data), len(data), 0, len(data)))
    assert [at for at, _, _ in got] == [len(noise)]
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(record[:-6]), len(record) - 6, 0, 100))


# pipeline

def test_pipeline_is_its_stages_one_by_one(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labels, items = table(spark, sf_dir, "labels"), table(spark, sf_dir, "benchmark").collect()
    held = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = quality.train(docs, labels)
    held = {k: t for k, t in held.items()
            if model.score(quality.features(t)[None])[0] >= quality.THRESHOLD}
    weights = toxicity.train(docs.where(docs["doc_id"].isin(list(held))), labels)
    held = {k: t for k, t in held.items()
            if 1 / (1 + math.exp(-(weights[toxicity.features(t)].sum() + weights[-1]))) < 0.5}
    ids = sorted(held)
    _, roots = components_of([held[k] for k in ids])
    held = {k: held[k] for k, root in zip(ids, roots) if ids[root] == k}
    lines = [word_hashes(r["text"], bare=True)[0].tolist() for r in items]
    held = {k: t for k, t in held.items() if not any(
        distance(line, word_hashes(t, bare=True)[0].tolist()) <= int(0.2 * len(line))
        for line in lines if set(line) & set(word_hashes(t, bare=True)[0].tolist()))}
    encode = pieces.load().encode
    rows = {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert set(rows) == set(held)
    for k, text in held.items():
        assert list(rows[k]["ids"]) == encode([text])[0].tolist()
        assert rows[k]["round_trip"]
