"""Token ids of many texts by a public tokenizer file, each distinct word encoded once.

The tokenizer lower-cases, drops white space and splits a text into letter runs, single
digits, contractions and runs of other signs before it merges inside each of these. So a
text of Latin script is cut by the same rules over arrays of code points, words are looked
up by a 64-bit hash of their lower-case form, and only words not met before are encoded. Those of
ASCII signs need no normalizing, as their bytes stand for themselves in the vocabulary: the
tokenizer's model merges each. Others go through the tokenizer, many at once: each word's last
id is one that ends a word, which tells where the next one begins. Any other text goes through
the tokenizer whole.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np

from clickstar.llm.text_hash import mix, powers

LIMIT = 0x250
SPACE, LETTER, DIGIT, SIGN = 0, 1, 2, 3
# Texts with anything but these signs and letters take the tokenizer's own path.
OTHER_SCRIPT = re.compile("[^\\t\\n\\r\\x20-\\x7e\\xa1-\\u012f\\u0131-\\u0239\\u023c-\\u023d\\u023f-\\u024f]"
                          "|<\\|(?:start|end)oftext\\|>")
# The same for texts of ASCII signs, as bytes.
PLAIN_ASCII = bytes([9, 10, 13, *range(0x20, 0x7f)])
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
CHUNK = 1 << 18


def _tables() -> tuple[np.ndarray, np.ndarray]:
    kinds = np.full(LIMIT, SIGN, np.uint8)
    lower = np.arange(LIMIT, dtype=np.uint32)
    import unicodedata

    for c in range(LIMIT):
        category = unicodedata.category(chr(c))
        if category[0] == "L":
            kinds[c] = LETTER
        elif category[0] == "N":
            kinds[c] = DIGIT
        elif chr(c).isspace():
            kinds[c] = SPACE
        if len(chr(c).lower()) == 1:
            lower[c] = ord(chr(c).lower())
    return kinds, lower


KINDS, LOWER = _tables()


def other_script(text: str) -> bool:
    """Whether OTHER_SCRIPT is found; texts of ASCII signs are told without going letter by letter."""
    if text.isascii() and "<|" not in text:
        return bool(text.encode().translate(None, PLAIN_ASCII))
    return OTHER_SCRIPT.search(text) is not None


def cut(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of one array of lower-case code points."""
    kind = KINDS[np.minimum(points, LIMIT - 1)]
    before = np.concatenate(([SPACE], kind[:-1])).astype(np.uint8)
    starts = (kind != SPACE) & ((kind != before) | (kind == DIGIT))
    for at in np.flatnonzero((points == 39) & (before != SIGN)):
        follow = "".join(map(chr, points[at + 1:at + 3]))
        ending = next((c for c in CONTRACTIONS if follow.startswith(c)), None)
        if ending:
            after = at + 1 + len(ending)
            starts[at + 1:after] = False
            if after < len(kind) and kind[after] != SPACE:
                starts[after] = True
    first = np.flatnonzero(starts)
    gaps = np.flatnonzero((kind == SPACE) & (before != SPACE))
    limits = np.append(first, len(points))[1:]
    place = np.searchsorted(gaps, first, side="right")
    ends = np.minimum(limits, np.append(gaps, len(points))[place])
    return first, ends


class TokenCache:
    """Ids by word hash, held by one Python worker; emptied when it reaches ``most`` words."""

    def __init__(self, path: str, most: int = 1_000_000) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.most = most
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.size = 1 << 18
        self.keys = np.zeros(self.size, np.uint64)
        self.slots = np.full(self.size, -1, np.int32)
        self.n = 0
        self.begin = np.zeros(1 << 16, np.int32)
        self.length = np.zeros(1 << 16, np.int32)
        self.pool = np.zeros(1 << 18, np.int32)
        self.filled = 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Each key's word number, or -1."""
        mask = np.uint64(self.size - 1)
        at = (keys & mask).astype(np.int64)
        found = self.slots[at]
        wrong = np.flatnonzero((found >= 0) & (self.keys[at] != keys))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & (self.size - 1)
            found[wrong] = self.slots[at[wrong]]
            still = (found[wrong] >= 0) & (self.keys[at[wrong]] != keys[wrong])
            wrong = wrong[still]
        return found

    def place(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        """Puts distinct new keys into the table, those that meet in one place one by one."""
        at = (keys & np.uint64(self.size - 1)).astype(np.int64)
        left = np.arange(len(keys))
        while len(left):
            free = left[self.slots[at[left]] < 0]
            self.slots[at[free]] = numbers[free]
            self.keys[at[free]] = keys[free]
            left = left[(self.slots[at[left]] != numbers[left])]
            at[left] = (at[left] + 1) & (self.size - 1)

    def add(self, keys: np.ndarray, words: list[str]) -> bool:
        """Whether the table had to be emptied before."""
        emptied = self.n + len(keys) > self.most
        if emptied:
            self.clear()
        plain, ends, rest = [], [], []
        for at, word in enumerate(words):
            if word.isascii():
                plain += [token.id for token in self.model.tokenize(word)]
                ends.append(len(plain))
            else:
                rest.append(at)
        keys = np.concatenate([np.delete(keys, rest), keys[rest]])
        rest_ids = np.array(self.tokenizer.encode(
            " ".join([words[at] for at in rest]), add_special_tokens=False).ids, np.int32)
        ids = np.concatenate([np.array(plain, np.int32), rest_ids])
        ends = np.concatenate([np.array(ends, np.int64),
                               len(plain) + np.flatnonzero(self.ends_word[rest_ids]) + 1])
        if len(ends) != len(words):
            raise RuntimeError("the tokenizer cut a word in two")
        n, filled = self.n + len(keys), self.filled + len(ids)
        while n > len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
        while filled > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        starts = np.concatenate(([0], ends[:-1]))
        self.pool[self.filled:filled] = ids
        self.begin[self.n:n] = self.filled + starts
        self.length[self.n:n] = ends - starts
        numbers = np.arange(self.n, n, dtype=np.int32)
        while 2 * n > self.size:
            used = self.slots >= 0
            old_keys, old_numbers = self.keys[used], self.slots[used]
            self.size *= 2
            self.keys, self.slots = np.zeros(self.size, np.uint64), np.full(self.size, -1, np.int32)
            self.place(old_keys, old_numbers)
        self.place(keys, numbers)
        self.n, self.filled = n, filled
        return emptied

    def encode(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """The ids of each text, without special tokens."""
        out: list[np.ndarray] = []
        run, held = [], 0
        for text in texts:
            text = text or ""
            if other_script(text):
                out += self.encode_run(run)
                run, held = [], 0
                out.append(np.array(self.tokenizer.encode(
                    text, add_special_tokens=False).ids, np.int32))
                continue
            if held + len(text) > CHUNK and run:
                out += self.encode_run(run)
                run, held = [], 0
            run.append(text)
            held += len(text)
        return out + self.encode_run(run)

    def encode_run(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        joined = "\n".join(texts) + "\n"
        points = LOWER[np.frombuffer(joined.encode("utf-32-le"), np.uint32)]
        starts, ends = cut(points)
        up, down = powers(len(points) + 1)
        sums = np.zeros(len(points) + 1, np.uint64)
        # a code point's value is spread by a multiplication before it is weighted
        np.cumsum((points.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
                  * up[:len(points)], out=sums[1:])
        keys = mix((sums[ends] - sums[starts]) * down[starts]
                   + (ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
        found = self.find(keys)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new, first = np.unique(keys[missing], return_index=True)
            lowered = points.astype("<u4").tobytes().decode("utf-32-le")
            at = missing[first]
            emptied = self.add(new, [lowered[a:b] for a, b in zip(starts[at].tolist(),
                                                                  ends[at].tolist())])
            # words found before are gone if the table was emptied meanwhile
            if emptied:
                found = self.find(keys)
            else:
                found[missing] = self.find(keys[missing])
            if (found < 0).any():
                return [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.int32)
                        for t in texts]
        lengths = self.length[found]
        upto = np.concatenate(([0], np.cumsum(lengths)))
        take = np.arange(upto[-1]) + np.repeat(self.begin[found] - upto[:-1], lengths)
        ids = self.pool[take]
        text_ends = np.cumsum([len(t) + 1 for t in texts])
        edges = upto[np.concatenate(([0], np.searchsorted(starts, text_ends)))]
        return [ids[a:b] for a, b in zip(edges[:-1], edges[1:])]
