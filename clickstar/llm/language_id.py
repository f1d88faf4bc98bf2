"""Language identification by unigrams of pieces, summed over all segmentations.

A fixed public vocabulary gives the pieces; each language has a probability for every piece. The
probability of a word is the sum over all its segmentations into pieces of the product of their
probabilities, by the forward algorithm; a text is the product of its words. Words are runs of
letters, in lower case, with the vocabulary's mark of a word's start; a character that is no piece
itself is spelled in the vocabulary's byte pieces. Texts of any length are read whole.

Learning is expectation maximisation: each round counts how often every piece is expected in the
words of each language, over all segmentations, by forward and backward sums under the round
before (at first all pieces are equally likely), and shrinks the shares towards those of all
languages together. Every training text takes part in every round. A task counts its words
and sends one sum for each language and piece, so nothing is shuffled by word and no key is hot;
expectations are whole multiples of 2^-20, so sums do not depend on how the texts lie in tasks.
The model is languages x pieces numbers (256 kB a language with 32,000 pieces), which go
through the driver and into the closure: its size follows the number of languages, not of texts.

Texts are cut into words together, as arrays of code points, and each distinct word of a portion of
texts becomes one string. Words of one length are summed together in numpy, position by position; words
with a spelled character or beyond ``LONG`` characters take their own sum of logarithms. A worker keeps
the sums of the words it met, at most ``CACHED`` or those of one portion, which changes work only.

Defined cases: a null text, or one without letters, is ``und`` with score 0; so is every text if no
language can be learned; otherwise the score is the posterior of the language, with the
training texts' shares as prior; equal posteriors go to the smaller language; a null doc_id is not held
out; an empty string is a language like others; repeated rows are judged, and learned, one by
one; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LETTERS = re.compile(r"[^\W\d_]+")
START = "▁"
LONG = 40
CACHED = 300_000
PORTION = 1 << 21
# Expected counts are counted in this unit.
UNIT = 1 << 20
# Keeps sums of products near 1: about the reciprocal of a character's probability.
LIFT = 64.0


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def words_of(text: str) -> list[str]:
    """Runs of letters; the expression also lets numerals such as fractions pass, which part words."""
    found = LETTERS.findall(text.lower())
    if not found or "".join(found).isalpha():
        return found
    return [w for run in found for w in (
        [run] if run.isalpha() else "".join(c if c.isalpha() else " " for c in run).split())]


_ALPHABETIC: list[np.ndarray] = []


def alphabetic() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _ALPHABETIC:
        _ALPHABETIC.append(np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000))
    return _ALPHABETIC[0]


def words_by_text(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct words of some texts, the place there of each of their words, and each text's
    first word: ``words_of`` over arrays of code points."""
    lowered = [t.lower() for t in texts]
    points = np.frombuffer(("\n".join(lowered) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = alphabetic()[points]
    edges = np.flatnonzero(np.diff(letter, prepend=False))
    starts, ends = edges[::2], edges[1::2]
    offsets = np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in lowered)]))
    bounds = 4 * np.cumsum(np.append(0, ends - starts))
    coded = pa.Array.from_buffers(pa.large_binary(), len(starts), [
        None, pa.py_buffer(bounds), pa.py_buffer(points[letter])]).dictionary_encode()
    _, bounds, letters = coded.dictionary.buffers()
    n = len(coded.dictionary)
    bounds = (np.frombuffer(bounds, np.int64)[:n + 1] // 4).tolist() if n else [0]
    letters = letters.to_pybytes()[:4 * bounds[-1]].decode("utf-32-le") if n else ""
    return ([letters[a:b] for a, b in zip(bounds, bounds[1:])], coded.indices.to_numpy(), offsets)


class Pieces:
    """The vocabulary: pieces by text and by hash, and the pieces of single bytes."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        self.ids, self.bytes = {}, {}
        for i in range(self.size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.ids[piece] = i
        self.unknown = model.unk_id()
        self.longest = max(map(len, self.ids))
        hashes = np.array([self.hash(p) for p in self.ids], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.by_hash = hashes[order], np.array([*self.ids.values()], np.int32)[order]
        # by the upper 20 bits of a hash: its first place, and how many hashes have them
        places = np.searchsorted(self.hashes >> np.uint64(44), np.arange((1 << 20) + 1, dtype=np.uint64))
        self.first, self.several = places[:-1].astype(np.int32), np.diff(places).astype(np.int16)

    FACTOR = np.uint64(0x9E3779B97F4A7C15)

    def hash(self, piece: str) -> np.uint64:
        h = np.zeros(1, np.uint64)
        for c in piece:
            h = self.step(h, np.array([ord(c)], np.uint64))
        return h[0]

    def step(self, h: np.ndarray, points: np.ndarray) -> np.ndarray:
        h = (h ^ points) * self.FACTOR
        return h ^ (h >> np.uint64(29))

    def spelled(self, character: str) -> list[int]:
        return [self.bytes.get(b, self.unknown) for b in character.encode("utf-8", "replace")]

    def ids_of(self, words: list[str]) -> list[np.ndarray]:
        """For words of one length: the pieces of m + 1 characters at each place, or -1."""
        n = len(words[0])
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32
                               ).reshape(len(words), n).astype(np.uint64)
        h, found = np.zeros((len(words), n + 1), np.uint64), []
        for m in range(min(n, self.longest)):
            h = self.step(h[:, :n - m], points[:, m:])
            ids = np.full(h.shape, -1, np.int32)
            upper, flat = (h >> np.uint64(44)).astype(np.int32).ravel(), ids.reshape(-1)
            left = np.flatnonzero(self.several[upper])
            wanted, upper, k = h.ravel()[left], upper[left], 0
            while len(left):
                at = self.first[upper] + k
                hit = self.hashes[at] == wanted
                flat[left[hit]] = self.by_hash[at[hit]]
                k += 1
                more = ~hit & (self.several[upper] > k)
                left, wanted, upper = left[more], wanted[more], upper[more]
            found.append(ids)
        return found


_PIECES: dict[str, Pieces] = {}


def pieces_of(path: str) -> Pieces:
    if path not in _PIECES:
        _PIECES[path] = Pieces(path)
    return _PIECES[path]


def lattice(pieces: Pieces, word: str) -> list[list[tuple[int, list[int]]]]:
    """For each end in the word, the (start, pieces) that lead there."""
    ends: list[list[tuple[int, list[int]]]] = [[]]
    for end in range(1, len(word) + 1):
        steps = [(start, [pieces.ids[word[start:end]]])
                 for start in range(max(0, end - pieces.longest), end) if word[start:end] in pieces.ids]
        if word[end - 1] not in pieces.ids:
            steps.append((end - 1, pieces.spelled(word[end - 1])))
        ends.append(steps)
    return ends


def log_sums(ends: list, logs: np.ndarray) -> np.ndarray:
    """Logarithms of the sums over all segmentations of every prefix; ``logs`` is pieces x languages."""
    total = np.zeros((len(ends), logs.shape[1]))
    for end in range(1, len(ends)):
        total[end] = np.logaddexp.reduce(
            [total[start] + logs[ids].sum(axis=0) for start, ids in ends[end]], axis=0)
    return total


def grouped(pieces: Pieces, words: list[str]) -> Iterator[tuple[np.ndarray, list[np.ndarray] | None]]:
    """Places of words of one length with their pieces; with None, places of words to take alone."""
    size = np.array([len(w) for w in words])
    alone = [np.flatnonzero(size > LONG)]
    for n in range(1, LONG + 1):
        at = np.flatnonzero(size == n)
        for part in np.array_split(at, len(at) // 50_000 + 1) if len(at) else ():
            ids = pieces.ids_of([words[i] for i in part])
            spelled = (ids[0] < 0).any(axis=1)
            if spelled.any():
                alone.append(part[spelled])
                part, ids = part[~spelled], [x[~spelled] for x in ids]
            if len(part):
                yield part, ids
    alone = np.concatenate(alone)
    if len(alone):
        yield alone, None


def forward(ids: list[np.ndarray], share: np.ndarray, row: np.ndarray | None = None) -> np.ndarray:
    """Sums over all segmentations of every prefix, times LIFT per character.

    ``share`` is (pieces + 1) x languages, its last row 0. With ``row``, the language of each
    word, the result has no axis of languages.
    """
    words, n = ids[0].shape
    total = np.zeros((n + 1, words) if row is not None else (n + 1, words, share.shape[1]))
    total[0] = 1
    lift = LIFT ** np.arange(len(ids) + 1)
    for end in range(1, n + 1):
        for m in range(1, min(end, len(ids)) + 1):
            p = ids[m - 1][:, end - m]
            total[end] += total[end - m] * (share[p] if row is None else share[p, row]) * lift[m]
    return total


def backward(ids: list[np.ndarray], share: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The same for every suffix."""
    words, n = ids[0].shape
    total = np.zeros((n + 1, words))
    total[n] = 1
    lift = LIFT ** np.arange(len(ids) + 1)
    for start in range(n - 1, -1, -1):
        for m in range(1, min(n - start, len(ids)) + 1):
            p = ids[m - 1][:, start]
            total[start] += total[start + m] * share[p, row] * lift[m]
    return total


class Model:
    """Languages in order, their priors, and pieces x languages probabilities."""

    def __init__(self, path: str, languages: list[str], share: np.ndarray, texts: np.ndarray) -> None:
        self.path, self.languages, self.share = path, languages, share
        self.prior = np.log(texts / texts.sum()) if len(languages) else np.zeros(0)

    def padded(self) -> np.ndarray:
        return np.vstack([self.share, np.zeros((1, len(self.languages)))])

    def expected(self, words: list[str], row: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Expected counts in UNITs, languages x pieces, of words that stand ``times`` often."""
        pieces, share, logs = pieces_of(self.path), self.padded(), None
        out = np.zeros((len(self.languages), pieces.size), np.int64)

        def add(lang, piece, units, often):
            np.add.at(out, (lang, piece), np.rint(units).astype(np.int64) * often)

        for at, ids in grouped(pieces, words):
            if ids is None:
                logs = np.log(self.share) if logs is None else logs
                for i in at.tolist():
                    self.expect_alone(pieces, words[i], logs[:, [row[i]]], row[i], times[i], add)
                continue
            front = forward(ids, share, row[at])
            if (lost := front[-1] < 1e-250).any():
                logs = np.log(self.share) if logs is None else logs
                for i in at[lost].tolist():
                    self.expect_alone(pieces, words[i], logs[:, [row[i]]], row[i], times[i], add)
                at, front, ids = at[~lost], front[:, ~lost], [x[~lost] for x in ids]
            lang, often = row[at], times[at]
            back = backward(ids, share, lang)
            for m, found in enumerate(ids, 1):
                word, start = np.nonzero(found >= 0)
                piece, one = found[word, start], lang[word]
                units = (front[start, word] * share[piece, one] * LIFT ** m * back[start + m, word]
                         / front[-1, word])
                add(one, piece, units * UNIT, often[word])
        return out

    def expect_alone(self, pieces, word, logs, lang, often, add) -> None:
        ends = lattice(pieces, word)
        front = log_sums(ends, logs)[:, 0]
        back = np.full(len(ends), -np.inf)
        back[-1] = 0
        for end in range(len(ends) - 1, 0, -1):
            for start, ids in ends[end]:
                gain = logs[ids, 0].sum()
                back[start] = np.logaddexp(back[start], gain + back[end])
        for end in range(1, len(ends)):
            for start, ids in ends[end]:
                p = np.exp(front[start] + logs[ids, 0].sum() + back[end] - front[-1])
                for piece in ids:
                    add(lang, piece, p * UNIT, often)

    def log_words(self, words: list[str]) -> np.ndarray:
        """Logarithm of each word's probability in each language."""
        pieces, share = pieces_of(self.path), self.padded()
        out = np.zeros((len(words), len(self.languages)))
        for at, ids in grouped(pieces, words):
            if ids is not None:
                whole = forward(ids, share)[-1]
                out[at] = np.log(np.maximum(whole, 1e-300)) - ids[0].shape[1] * np.log(LIFT)
                at = at[(whole < 1e-250).any(axis=1)]
            if len(at):
                logs = np.log(self.share)
                for i in at.tolist():
                    out[i] = log_sums(lattice(pieces, words[i]), logs)[-1]
        return out


def is_held_out(rest: int = 2, parts: int = 4) -> F.Column:
    remainder = F.crc32(F.col("doc_id").cast("string")) % parts
    return F.coalesce(remainder == rest, F.lit(False))


def fit(docs: DataFrame, path: str | None = None, rounds: int = 2, weight: float = 500.0) -> Model:
    """The model of ``docs`` (text, lang); rows without one of them teach nothing.

    ``weight`` is the number of pieces at which a language's own share counts as much as
    that of all languages together.
    """
    path = path or default_vocabulary()
    taught = docs.select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    seen = {r.lang: r["count"] for r in taught.groupBy("lang").count().collect()}
    languages = sorted(seen)
    size = pieces_of(path).size
    texts = np.array([seen[x] for x in languages], float)
    model = Model(path, languages, np.full((size, len(languages)), 1 / size), texts)
    for _ in range(rounds if languages else 0):
        sums = taught.mapInArrow(count_pieces(model), "lang int, piece int, units bigint").groupBy(
            "lang", "piece").agg(F.sum("units").alias("units")).toArrow()
        counts = np.zeros((size, len(languages)))
        counts[sums["piece"].to_numpy(), sums["lang"].to_numpy()] = sums["units"].to_numpy() / UNIT
        every = (counts.sum(axis=1) + 1) / (counts.sum() + size)
        share = (counts + weight * every[:, None]) / (counts.sum(axis=0) + weight)
        model = Model(path, languages, share, texts)
    return model


def count_pieces(model: Model):
    schema = pa.schema([("lang", pa.int32()), ("piece", pa.int32()), ("units", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {x: i for i, x in enumerate(model.languages)}
        total = np.zeros((len(model.languages), pieces_of(model.path).size), np.int64)
        seen = [Counter() for _ in model.languages]

        def settle():
            for lang, counter in enumerate(seen):
                words = [START + w for w in counter]
                if words:
                    total[:] += model.expected(words, np.full(len(words), lang),
                                               np.fromiter(counter.values(), np.int64, len(words)))
                counter.clear()

        def count(lang, texts):
            words, places, _ = words_by_text(texts)
            if sum(map(len, seen)) + len(words) > CACHED:
                settle()
            seen[lang].update(dict(zip(words, np.bincount(places, minlength=len(words)).tolist())))

        for batch in batches:
            for lang, texts in in_portions(batch["text"], batch["lang"], number):
                count(lang, texts)
        settle()
        lang, piece = np.nonzero(total)
        yield pa.record_batch([pa.array(lang, pa.int32()), pa.array(piece, pa.int32()),
                               pa.array(total[lang, piece])], schema=schema)

    return run


def in_portions(texts: pa.Array, langs: pa.Array, number: dict[str, int]
                ) -> Iterator[tuple[int, list[str]]]:
    """Texts of one language at a time, of about ``PORTION`` characters at most."""
    waiting: dict[int, list[str]] = {}
    held: Counter = Counter()
    for text, lang in zip(texts.to_pylist(), langs.to_pylist()):
        lang = number[lang]
        waiting.setdefault(lang, []).append(text)
        held[lang] += len(text)
        if held[lang] > PORTION:
            yield lang, waiting.pop(lang)
            del held[lang]
    yield from waiting.items()


class Scorer:
    """Scores texts; keeps the words it met."""

    def __init__(self, model: Model) -> None:
        self.model, self.place, self.logs = model, {}, np.zeros((0, len(model.languages)))

    def portion(self, texts: list[str]) -> list[tuple[str, float]]:
        words, places, offsets = words_by_text(texts)
        new = [w for w in words if w not in self.place]
        if len(self.place) + len(new) > CACHED:
            self.place, self.logs, new = {}, self.logs[:0], words
        self.place.update(zip(new, range(len(self.logs), len(self.logs) + len(new))))
        self.logs = np.vstack([self.logs, self.model.log_words([START + w for w in new])])
        at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))[places]
        return [self.judged(at[a:b]) for a, b in zip(offsets, offsets[1:])]

    def judged(self, at: np.ndarray) -> tuple[str, float]:
        if not len(at) or not self.model.languages:
            return "und", 0.0
        total = self.model.prior + np.add.reduce(self.logs[at], axis=0)
        best = int(total.argmax())
        return self.model.languages[best], float(1 / np.exp(total - total[best]).sum())


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()),
                        ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            found, portion, held = [], [], 0
            for text in batch["text"]:
                portion.append(text.as_py() or "")
                held += len(portion[-1])
                if held > PORTION:
                    found += scorer.portion(portion)
                    portion, held = [], 0
            found += scorer.portion(portion)
            yield pa.record_batch([batch["doc_id"], batch["held_out"],
                                   pa.array([r[0] for r in found], pa.string()),
                                   pa.array([r[1] for r in found], pa.float64())], schema=schema)

    return docs.select("doc_id", is_held_out().alias("held_out"), "text").mapInArrow(
        run, "doc_id bigint, held_out boolean, lang_pred string, score double")
