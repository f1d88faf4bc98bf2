"""Prefix trie of conversations against a plain one."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from clickstar.llm import prefix_trie
from clickstar.llm.tables import Scratch

TURNS = "conv_id bigint, turn bigint, role string, text string, depth int, ids string, n int"


def brute(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            name = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            convs[c].append(((turn is not None, turn or 0), role, name, text))
    convs = {c: [(t[1], t[3]) for t in sorted(v)] for c, v in convs.items()}
    trie = defaultdict(list)
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        whole = tuple(convs.get(base, [])[:h] + own[h:])
        for d in range(len(whole) + 1):
            trie[whole[:d]].append((c, len(whole) == d))
    out = []
    for node, members in trie.items():
        below = [(n, m) for n, m in trie.items() if n[:len(node)] == node]
        kids = {n for n, _ in below if len(n) == len(node) + 1}
        parents = {n[:-1] for n, _ in below if n}
        ends = sorted(c for c, end in members if end)
        out.append((min(c for c, _ in members), len(node),
                    min(c for c, _ in trie[node[:-1]]) if node else None, len(members), len(kids),
                    sum(n not in parents for n, _ in below),
                    sum((len(m) - 1) * len(n[-1][1]) for n, m in below if n),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0], r[1]))


def found(llm, rows, limit):
    df = llm.createDataFrame([(*r, 9, "x", 1) for r in rows], TURNS)
    got = prefix_trie.trie(prefix_trie.rebuilt(df), Scratch(llm, "trie"), limit)
    return sorted((tuple(r) for r in got.collect()), key=lambda r: (r[0], r[1]))


def chats(seed, n, kinds, longest):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-150, 400), n):
        for turn in range(rng.randint(1, longest)):
            rows.append((c, turn, rng.choice(["user", "assistant"]), "t" * rng.randint(1, kinds)))
    return rows


# limits far below the number of turns make heads burst several rounds deep
@pytest.mark.parametrize("limit", [1, 6, 40, 1 << 16])
def test_trie_equals_brute_force(llm, limit):
    rows = chats(limit, 60, 2, 5)
    rows += [(500 + i, t, "user", "same") for i in range(30) for t in range(9)]  # copies of one path
    rows += [(700, t, "user", "same") for t in range(40)]  # and one that goes on
    assert found(llm, rows, limit) == brute(rows)


def test_awkward_turns(llm):
    rows = [(None, 0, "user", "no conversation"), (1, None, None, None), (1, 0, "user", ""),
            (1, 0, "user", ""), (1, 0, "assistant", "x"), (2, 0, "u", "ser"), (3, 0, "us", "er"),
            (107, 0, "user", "no base"), (8, 3, "user", "Zürich \U0001f600" * 2000),
            (9, 3, "user", "Zürich \U0001f600" * 2000), (0, 1, "user", "base"), (0, 5, "user", "next")]
    for limit in (1, 1 << 16):
        assert found(llm, rows, limit) == brute(rows)


def test_no_conversation_gives_no_node(llm):
    assert found(llm, [(None, 0, "user", "x")], 10) == []
    df = llm.createDataFrame([], TURNS)
    assert prefix_trie.trie(prefix_trie.rebuilt(df), Scratch(llm, "trie")).count() == 0


def test_ends_hash_joins_blocks(llm):
    """Copies whose ids lie in several blocks of 2^16 ids, negative ones included."""
    ids = [-70_000, -1, 0, 1, 65_535, 65_536, 200_000]
    convs = llm.createDataFrame([(c, b"", []) for c in ids], "conv_id bigint, ids binary, chars array<int>")
    (root,) = prefix_trie.trie(convs, Scratch(llm, "trie")).collect()
    assert root.n_convs == 7 and root.ends_sha256 == hashlib.sha256(
        ",".join(map(str, ids)).encode()).hexdigest()
