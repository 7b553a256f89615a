import itertools
import math
import zlib

import numpy as np
import public_tokenizers
import pytest

from telemetry_spark.llm import langid

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def by_enumeration(model, word, language):
    """The sum over every way to cut a word, each letter that is no piece at the fallback's price."""
    total = 0.0
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        ends = [i + 1 for i, c in enumerate(cuts) if c] + [len(word)]
        parts = [word[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        ids = [model.index.get(p, len(model.pieces) if len(p) == 1 else None) for p in parts]
        if None not in ids:
            total += math.prod(model.table[i, language] for i in ids)
    return total


@pytest.fixture(scope="module")
def small_model():
    pieces = ["▁", "▁a", "a", "b", "ab", "ba", "aba", "bb"]
    table = np.random.default_rng(2).dirichlet(np.ones(len(pieces) + 1), 3).T
    return langid.Model(["x", "y", "z"], pieces, table)


def test_forward_sums_all_segmentations(small_model):
    words = ["▁abab", "▁bbaba", "▁a", "▁acb"]
    logs = small_model.log_probabilities(words)
    for word, own in zip(words, logs, strict=True):
        assert own == pytest.approx([math.log(by_enumeration(small_model, word, i)) for i in range(3)])
        assert small_model.long_word(word) == pytest.approx(own)
    assert np.isfinite(small_model.log_probabilities(["▁" + "ab" * 4000])).all()


def test_expected_counts_add_up(small_model):
    counts = small_model.expected(["▁abab"], np.array([2.0]), 1)
    lengths = np.array([len(p) for p in small_model.pieces] + [1])
    assert (counts * lengths).sum() == pytest.approx(2 * 5)  # each segmentation covers the word


def expected_by_enumeration(model, word, language):
    total, sums = 0.0, np.zeros(len(model.table))
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        ends = [i + 1 for i, c in enumerate(cuts) if c] + [len(word)]
        parts = [word[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        ids = [model.index.get(p, len(model.pieces) if len(p) == 1 else None) for p in parts]
        if None not in ids:
            p = math.prod(model.table[i, language] for i in ids)
            total += p
            np.add.at(sums, ids, p)
    return sums / total


@pytest.mark.parametrize("lot", [1, 3, 100])
def test_long_runs_are_learned_from(small_model, monkeypatch, lot):
    words, counts = ["▁ababbaabab", "▁acbabacc", "▁b"], np.array([2.0, 3.0, 1.0])
    whole = ["▁" + "abbabac" * 9]
    monkeypatch.setattr(langid, "LONG_WORD", 100)
    plain = small_model.expected(whole, np.array([1.0]), 1)
    monkeypatch.setattr(langid, "LONG_WORD", 1)
    monkeypatch.setattr(langid, "LONG_LOT", lot)
    for language in range(3):
        brute = sum(n * expected_by_enumeration(small_model, w, language) for w, n in zip(words, counts, strict=True))
        assert small_model.expected(words, counts, language) == pytest.approx(brute)
    assert small_model.expected(whole, np.array([1.0]), 1) == pytest.approx(plain)
    lengths = np.array([len(p) for p in small_model.pieces] + [1])
    assert (small_model.expected(["▁" + "ab" * 4000], np.array([2.0]), 0) * lengths).sum() == pytest.approx(2 * 8001)


def test_languages_without_spaces(spark):
    """Two languages whose texts are single runs of letters: only what these hold can tell them apart."""
    rng = np.random.default_rng(5)
    rows = [(i, "".join(rng.choice(list("กขคงจ" if i % 2 else "ฉชซญฐ"), 200)), "xa" if i % 2 else "xb") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    found = langid.predict(docs, langid.fit(docs, PIECES, rounds=2)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == 60 and all(r.lang == r.lang_pred and r.score > 0.9 for r in found)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.predict(docs, langid.fit(docs, PIECES, rounds=2)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in found)
    assert len(found) == 1000 and sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)


def test_odd_rows(spark, odd_documents):
    found = langid.predict(odd_documents, langid.fit(odd_documents, PIECES, rounds=1)).collect()
    assert len(found) == odd_documents.count()
    assert {(r.doc_id, r.lang_pred, r.score) for r in found if r.doc_id in (1, 2, 5)} == {(1, "und", 0.0), (2, "und", 0.0), (5, "und", 0.0)}
    empty = odd_documents.limit(0)
    assert {r.lang_pred for r in langid.predict(odd_documents, langid.fit(empty, PIECES)).collect()} == {"und"}
    assert langid.predict(empty, langid.fit(odd_documents, PIECES, rounds=1)).count() == 0
    with pytest.raises(ValueError, match="languages"):
        langid.fit(odd_documents, PIECES, max_languages=1)


def test_sums_do_not_depend_on_how_words_are_remembered(small_model, monkeypatch):
    """Groups of texts, texts longer than the memory and words that come again: always the sum of the words' own logs."""
    rng = np.random.default_rng(5)
    texts = [["".join(rng.choice(list("abc"), rng.integers(1, 6))) for _ in range(n)] for n in (0, 3, 40, 7, 0, 25, 1, 8)]
    want = [small_model.log_probabilities([langid.START + w for w in t]).sum(axis=0) for t in texts]
    for cells in (1, 9, 30, 90, 10_000):
        monkeypatch.setattr(langid, "MEMORY_CELLS", cells)
        monkeypatch.setattr(langid, "LOT_CELLS", cells)
        logs = langid.WordLogs(small_model)
        got = list(logs.sums(texts))
        assert len(got) == len(texts) and all(g == pytest.approx(w) for g, w in zip(got, want, strict=True))
        assert len(logs.places) <= logs.limit


def test_lots_keep_rows_and_their_order(monkeypatch):
    monkeypatch.setattr(langid, "LOT_CHARS", 10)
    batches = [langid.pd.Series(["x" * n, None]) for n in (3, 4, 20, 0, 9)]
    got = list(langid.lots(iter(batches), lambda b: b))
    assert [len(g) for g in got] == [6, 4] and sum((list(g) for g in got), []) == sum((list(b) for b in batches), [])
    assert [len(g) for g in langid.lots(iter(batches), lambda b: b, 2)] == [2] * 5 and list(langid.lots(iter(()), lambda b: b)) == []


def test_three_hundred_languages_stay_within_bounds():
    """The recursion and the remembered words hold so many numbers whatever the number of languages."""
    import tracemalloc

    pieces = ["▁", "▁a", "a", "b", "ab", "ba"]
    model = langid.Model([f"l{i:03d}" for i in range(300)], pieces, np.random.default_rng(3).dirichlet(np.ones(7), 300).T)
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefghij"), 12)) for _ in range(60_000)]
    tracemalloc.start()
    logs = langid.WordLogs(model)
    sums = list(logs.sums([words[:30_000], words[30_000:]]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(sums) == 2 and np.isfinite(sums).all() and peak < 1 << 28
