"""The sweep over many words: the ids of the walk and of the published library, found once a process."""

from __future__ import annotations

import pickle
import random

import numpy as np
import sentencepiece

from snapstar.llm import pieces


def _words(n: int) -> list[str]:
    draw = random.Random(7)
    syllables = ["the", "ing", "tion", "a", "e", "1", "2024", "①", "漢", "𝄞", "é", "\n", "\t", "<0x41>", "zq"]
    return sorted({
        pieces.MARK * draw.randint(0, 2) + "".join(draw.choices(syllables, k=draw.randint(1, 14)))
        for _ in range(n)})


def test_swept_words_have_the_ids_of_the_walk_and_of_the_library():
    model, words = pieces.load(), _words(6_000)
    assert len([w for w in words if len(w) <= pieces.WIDE]) >= pieces.FEW
    assert any(len(w) > pieces.WIDE for w in words)
    model.forget()  # the words of the probe
    model.learn(words)
    walked = dict(pieces.load().walk(words))
    assert set(model.known) == set(words)
    for word, k in model.known.items():
        assert tuple(model.ids_known[model.ends_known[k]:model.ends_known[k + 1]].tolist()) == walked[word]
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = [" ".join(words[k::50]).replace(pieces.MARK, " ") for k in range(50)] + ["", None]
    ids, ends = pieces.load().encode(texts)
    assert ids.tolist() == [k for text in texts for k in (library.encode(text) if text else [])]
    assert len(ends) == 52 and ends[-1] == ends[-3] == len(ids)


def test_tasks_of_a_process_share_what_was_found(monkeypatch):
    tried = []
    follows = pieces.Model.follows
    monkeypatch.setattr(pieces.Model, "follows", lambda *args: tried.append(1) or follows(*args))
    sent = pickle.dumps(pieces.load())
    words = [w.replace(pieces.MARK, " ") for w in _words(4_000)]
    first = pickle.loads(sent).living
    before = first.encode(words)
    assert tried
    tried.clear()
    again = pickle.loads(sent).living
    after = again.encode(words)
    assert again is first and not tried
    assert np.array_equal(before[0], after[0]) and np.array_equal(before[1], after[1])
    other = pieces.load()
    other.scores[300] -= 1
    assert other.living is other


def test_a_table_keeps_keys_that_meet():
    held = pieces.Table(12)
    keys = np.arange(2_000, dtype=np.int64) << 32
    held.add(keys, np.arange(2_000, dtype=np.int32))
    assert held.find(keys).tolist() == list(range(2_000))
    assert (held.find(keys + 1) == -1).all()


def test_swept_transitions_are_remembered_once():
    model = pieces.load()
    words = sorted({f"{pieces.MARK}{a}{b}ing" for a in "abcdefgh" for b in ("re", "st", "tion", "er")})
    model.pairs.clear()
    model.sweep(words)
    assert model.tested.used and not model.pairs
