"""Language identification against sums over listed segmentations, and on held-out documents."""

import math
import time
import zlib
from collections import Counter

import numpy as np
import pytest

from clickstar.llm import language_id
from clickstar.llm.language_id import START, Model, Pieces, default_vocabulary
from clickstar.llm.tables import read

DOCS = "doc_id bigint, text string, lang string, held_out int, score string, lang_pred int"


@pytest.fixture(scope="module")
def pieces():
    return Pieces(default_vocabulary())


def segmentations(pieces, word):
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        if word[:n] in pieces.ids:
            for rest in segmentations(pieces, word[n:]):
                yield [pieces.ids[word[:n]], *rest]
    if word and word[0] not in pieces.ids:
        for rest in segmentations(pieces, word[1:]):
            yield [*pieces.spelled(word[0]), *rest]


WORDS = ["the", "straße", "łódź", "ångström", "aaaaaaaa", "x", "日本語", "\U00010437a", "ﷺ", "thethe"]


def random_model(pieces, languages=3):
    rng = np.random.default_rng(0)
    share = rng.random((pieces.size, languages)) ** 4 + 1e-9
    return Model(default_vocabulary(), [f"l{i}" for i in range(languages)], share / share.sum(axis=0),
                 np.ones(languages))


def test_words_are_summed_over_all_segmentations(pieces):
    model = random_model(pieces)
    got = model.log_words([START + w for w in WORDS])
    for word, row in zip(WORDS, got):
        ways = list(segmentations(pieces, START + word))
        assert len(ways) > 0
        for lang in range(3):
            whole = math.log(sum(math.prod(model.share[i, lang] for i in way) for way in ways))
            assert math.isclose(row[lang], whole, rel_tol=1e-9)


def test_expected_counts(pieces):
    model = random_model(pieces)
    words, row, times = [START + w for w in WORDS], np.arange(len(WORDS)) % 3, np.arange(1, 11)
    got = model.expected(words, row, times) / language_id.UNIT
    want = np.zeros_like(got)
    for word, lang, n in zip(words, row, times):
        ways = list(segmentations(pieces, word))
        weight = [math.prod(model.share[i, lang] for i in way) for way in ways]
        for way, w in zip(ways, weight):
            for i in way:
                want[lang, i] += n * w / sum(weight)
    assert np.abs(got - want).max() < 1e-3


def test_long_words_take_logarithms(pieces):
    """A word beyond LONG, and one whose product leaves the range of a double."""
    model = random_model(pieces)
    for word in ("ab" * 400, "q" * 39):
        (got,) = model.log_words([START + word])
        want = language_id.log_sums(language_id.lattice(pieces, START + word), np.log(model.share))[-1]
        assert np.allclose(got, want, rtol=1e-9)
    assert (model.expected([START + "q" * 39], np.array([0]), np.array([2])).sum() > 0)


def plain_model(rows, pieces, rounds, weight):
    """The same learning over listed segmentations."""
    languages = sorted({lang for _, lang in rows})
    counts = {x: Counter(START + w for t, lang in rows if lang == x for w in language_id.words_of(t))
              for x in languages}
    share = {x: dict.fromkeys(range(pieces.size), 1 / pieces.size) for x in languages}
    for _ in range(rounds):
        seen = {x: Counter() for x in languages}
        for x in languages:
            for word, n in counts[x].items():
                ways = list(segmentations(pieces, word))
                weights = [math.prod(share[x][i] for i in way) for way in ways]
                for way, w in zip(ways, weights):
                    for i in way:
                        seen[x][i] += n * w / sum(weights)
        total = sum(sum(c.values()) for c in seen.values())
        every = {i: (sum(c[i] for c in seen.values()) + 1) / (total + pieces.size) for i in range(pieces.size)}
        share = {x: {i: (seen[x][i] + weight * every[i]) / (sum(seen[x].values()) + weight)
                     for i in range(pieces.size)} for x in languages}
    return languages, share


ROWS = [("the cat and the dog", "en"), ("Der Hund und die Katze", "de"), ("the the word", "en"),
        ("über straßen", "de"), ("le chat et le chien", "fr"), ("", ""), ("łódź 日本", "")]


def test_learning_and_scores_equal_brute_force(llm, pieces):
    df = llm.createDataFrame([(i, t, lang, 1, "s", 2) for i, (t, lang) in enumerate(ROWS)]
                             + [(90, None, "en", 1, "s", 2), (91, "no language", None, 1, "s", 2)], DOCS)
    model = language_id.fit(df.repartition(3), rounds=2, weight=5.0)
    languages, share = plain_model(ROWS, pieces, 2, 5.0)
    assert model.languages == languages
    for j, x in enumerate(languages):
        assert np.allclose(model.share[:, j], [share[x][i] for i in range(pieces.size)], rtol=1e-3, atol=1e-6)
    texts = {i: t for i, (t, _) in enumerate(ROWS)}
    for r in language_id.predict(df, model).collect():
        words = [START + w for w in language_id.words_of(texts.get(r.doc_id) or (
            "no language" if r.doc_id == 91 else ""))]
        if not words:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        logs = [model.prior[j] + sum(math.log(sum(
            math.prod(model.share[i, j] for i in way) for way in segmentations(pieces, w))) for w in words)
            for j in range(len(languages))]
        best = max(range(len(logs)), key=lambda j: logs[j])
        assert r.lang_pred == languages[best]
        assert math.isclose(r.score, 1 / sum(math.exp(v - logs[best]) for v in logs), rel_tol=1e-9)


def test_awkward_texts(llm):
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 _ ½ ² Ⅷ !?", "en"), (None, "the word", None),
            (4, "x" * 5000, None), (5, "the word " * 20000, None), (5, "the word " * 20000, None),
            (6, "the words", "en"), (7, "die worte", "de")]
    df = llm.createDataFrame([(*r, 1, "s", 2) for r in rows], DOCS)
    got = language_id.predict(df, language_id.fit(df)).collect()
    assert len(got) == len(rows)
    assert [r.lang_pred for r in got if r.doc_id in (1, 2, 3)] == ["und"] * 3
    assert all(r.lang_pred == "en" for r in got if r.doc_id == 5) and not got[3].held_out
    none = language_id.fit(df.where("lang = 'xx'"))
    assert {(r.lang_pred, r.score) for r in language_id.predict(df, none).collect()} == {("und", 0.0)}
    assert language_id.predict(df.where("false"), none).collect() == []


def test_model_does_not_depend_on_partitions(llm):
    docs = read(llm, "/root/testdata/sf0.001", "documents", "text", "lang")
    one, many = (language_id.fit(docs.repartition(n)) for n in (1, 7))
    assert (one.share == many.share).all()


def test_held_out_documents(llm):
    """Held out by the contract's remainder; nearly all of them get their language."""
    docs = read(llm, "/root/testdata/sf0.01", "documents", "doc_id", "text", "lang")
    model = language_id.fit(docs.where(~language_id.is_held_out()))
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = 0
    right = 0
    for r in language_id.predict(docs, model).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        if r.held_out and truth[r.doc_id]:
            held += 1
            right += r.lang_pred == truth[r.doc_id]
    assert held > 150 and right >= 0.97 * held


def test_words_of_many_texts_are_those_of_each(pieces):
    texts = ["", "The cat, the CAT", "ΣΑΣ ΟΔΟΣ Σ", "İstanbul ẞ", "12½x²y_zⅧw", "日本語 テキスト", "\U00010437a\U0001F600b",
             "end", "start", "éa­", "x" * 5000, "\n\t", "a\x00b", "ŉ ǅ ﷺ"]
    words, places, offsets = language_id.words_by_text(texts)
    assert len(set(words)) == len(words)
    got = [[words[i] for i in places[a:b]] for a, b in zip(offsets, offsets[1:])]
    assert got == [language_id.words_of(t) for t in texts]
    for none in ([], [""], ["12 !", "_"]):
        words, places, offsets = language_id.words_by_text(none)
        assert words == [] and len(places) == 0 and offsets.tolist() == [0] * (len(none) + 1)


def test_pieces_at_each_place(pieces):
    words = [START + w for w in ("house", "straß", "xqzjk", "łódźa")]
    for m, found in enumerate(pieces.ids_of(words), 1):
        for word, row in zip(words, found):
            assert row[:len(word) - m + 1].tolist() == [
                pieces.ids.get(word[i:i + m], -1) for i in range(len(word) - m + 1)]


def test_a_worker_spends_little_on_repeated_words():
    """Cutting texts and counting their words takes less time than text by text."""
    texts = [" ".join(f"word{chr(97 + i % 26)}{chr(97 + j % 26)} the" for j in range(1000)) for i in range(300)]
    language_id.words_by_text(texts[:1])
    began = time.process_time()
    words, places, _ = language_id.words_by_text(texts)
    counts = dict(zip(words, np.bincount(places).tolist()))
    together = time.process_time() - began
    plain = Counter()
    for t in texts:
        plain.update(language_id.words_of(t))
    assert counts == plain
    assert together < 0.8 * (time.process_time() - began - together)


def test_tasks_that_settle_often_learn_the_same(llm, monkeypatch):
    """Few cached words and small portions change work only."""
    docs = read(llm, "/root/testdata/sf0.001", "documents", "text", "lang").where(
        "text IS NOT NULL AND lang IS NOT NULL").toArrow().combine_chunks().to_batches()
    languages = sorted(set(docs[0]["lang"].to_pylist()))
    size = Pieces(default_vocabulary()).size
    model = Model(default_vocabulary(), languages, np.full((size, len(languages)), 1 / size),
                  np.ones(len(languages)))
    whole = [b.to_pydict() for b in language_id.count_pieces(model)(iter(docs))]
    texts = docs[0]["text"].to_pylist()
    scored = language_id.Scorer(model).portion(texts)
    monkeypatch.setattr(language_id, "CACHED", 500)
    monkeypatch.setattr(language_id, "PORTION", 3000)
    assert [b.to_pydict() for b in language_id.count_pieces(model)(iter(docs))] == whole
    scorer = language_id.Scorer(model)
    assert [scorer.portion([t])[0] for t in texts] == scored
