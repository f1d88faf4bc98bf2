"""Operators over documents against brute force on awkward rows."""

import hashlib
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from clickstar.llm import (bottom_k, license_scan, mixing, ngram_join, packing, queries,
                           toxicity)
from clickstar.llm.license_rules import BASE
from clickstar.llm.tables import Scratch
from tests.llm import brute


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def empty(df):
    return df.where("false")


# --- 1 packing ---------------------------------------------------------------------------


def check_pieces(pieces, ids_of, limits):
    """Every id in one piece, sequences gapless and inside all limits; returns the padding."""
    sequences, at = defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append(p)
        at[p.doc_id].append(p)
    for p in pieces:
        assert any(len(ids) == p.doc_tokens and p.ids_crc32 == zlib.crc32(
            ids[p.start:p.start + p.length].tobytes()) for ids in ids_of[p.doc_id])
    for doc_id, own in at.items():
        assert sum(p.length for p in own) == sum(map(len, ids_of[doc_id]))
    padding = 0
    for own in sequences.values():
        end = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == end
            end += p.length
        assert end <= limits.tokens and len(own) <= limits.segments
        assert sum(p.loss_tokens for p in own) <= limits.loss
        padding += 0 if end & (end - 1) == 0 else limits.tokens - end
    return padding


def test_packing_documents(llm, awkward):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    ids_of = defaultdict(list)
    for doc_id, text in pairs(awkward):
        ids_of[doc_id].append(np.array(
            tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4"))
    limits = packing.Limits()
    pieces = packing.pack_documents(awkward, limits).collect()
    assert check_pieces(pieces, ids_of, limits) == 0
    assert all(list(p.ids) == list(next(
        i for i in ids_of[p.doc_id] if len(i) == p.doc_tokens)[p.start:p.start + p.length])
        for p in pieces if len(ids_of[p.doc_id]) == 1)
    assert packing.pack_documents(empty(awkward)).collect() == []


def test_tiny_documents_leave_little_padding(llm):
    """20,000 documents of three tokens, far more than a sequence has places for in large pieces."""
    df = llm.createDataFrame([(i, "w x" if i % 2 else "") for i in range(20_000)],
                             "doc_id bigint, text string").repartition(4)
    pieces = packing.pack_documents(df, with_ids=False).collect()
    filled = Counter()
    for p in pieces:
        filled[p.sequence_id] += p.length
    places = sum(n if n & (n - 1) == 0 else 4096 for n in filled.values())
    assert sum(filled.values()) == 10_000 * 4 and places <= 1.02 * sum(filled.values())
    assert len({p.doc_id for p in pieces}) == 20_000


@pytest.mark.parametrize("limits", [packing.Limits(64, 4, 64), packing.Limits(64, 64, 20),
                                    packing.Limits(128, 8, 70)])
def test_packing_keeps_all_limits(llm, limits):
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(0, 999, n).tolist(), int(rng.integers(0, n + 1)))
            for i, n in enumerate(rng.integers(1, 200, 150).tolist())] + [(900, [], 0), (901, None, None)]
    ids_of = {i: [np.array(ids or [], "<u4")] for i, ids, _ in rows}
    df = llm.createDataFrame(rows, "doc_id bigint, ids array<int>, loss_from int").repartition(3)
    pieces = packing.pack_instructions(df, limits).collect()
    check_pieces(pieces, ids_of, limits)
    assert {p.doc_id for p in pieces} == {i for i, ids, _ in rows if ids}


@pytest.mark.parametrize("text", [
    "it's 'station 12½ don't ''s O'Re x'ss \"'ve\" ... 3.14", "Ⱥ Ω Σς 日本 <|endoftext|> a",
    "a\x0bb\x85c\xa0d", "İstanbul ıI", "'", "'d'd'd 's's ''ll -'ll", "x́é", ""])
def test_token_ids_equal_the_tokenizers(text):
    from clickstar.llm.token_ids import TokenCache

    cache = TokenCache(packing.tokenizer_path(), most=5)
    for got, one in zip(cache.encode([text, text.upper(), "a b " + text]),
                        [text, text.upper(), "a b " + text]):
        assert got.tolist() == cache.tokenizer.encode(one, add_special_tokens=False).ids


def test_ascii_words_need_no_normalizing(monkeypatch):
    """Words of ASCII signs reach the tokenizer's model only, with the ids of the whole tokenizer."""
    from clickstar.llm import token_ids

    rng = np.random.default_rng(4)
    signs = [chr(c) for c in [9, 10, 13, *range(0x20, 0x7f)]]
    texts = ["".join(rng.choice(signs, 300)) for _ in range(40)]
    texts += ["</w> a</w>b <| |> <|endoftext|", "it's we'LL 12.5 x" + "y" * 500, "Zürich été the end"]
    cache = token_ids.TokenCache(packing.tokenizer_path())
    whole, given = cache.tokenizer, []

    class Noted:
        def encode(self, text, **options):
            given.append(text)
            return whole.encode(text, **options)

    cache.tokenizer = Noted()
    for text, ids in zip(texts, cache.encode(texts)):
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids
    assert " ".join(sorted(" ".join(given).split())) == "zürich été"


@pytest.mark.parametrize("text", ["", "a b", "a\x0bb", "a\x7f", "\x00", "\t\r\n ~", "<|startoftext|>", "<|x",
                                  "é", "日", "\x85", "é<|endoftext|>"])
def test_texts_for_the_tokenizer_alone(text):
    from clickstar.llm import token_ids

    assert token_ids.other_script(text) == bool(token_ids.OTHER_SCRIPT.search(text))


# --- 2 mixing ------------------------------------------------------------------------------


def filled(limits, masses, total):
    """Shares by repeated cutting off and sharing again."""
    full = set()
    while True:
        rest = total - sum(limits[i] for i in full)
        open_ = [i for i in range(len(limits)) if i not in full]
        share = {i: rest * masses[i] / sum(masses[j] for j in open_) for i in open_}
        over = {i for i in open_ if share[i] > limits[i]}
        if not over:
            return [share.get(i, limits[i]) for i in range(len(limits))]
        full |= over


def test_mixing(llm, awkward, scratch):
    size = lambda t: len(brute.words(t))
    rows = [(r.doc_id, r.source, size(r.text)) for r in awkward.collect()]
    sources = sorted({s for _, s, _ in rows}, key=lambda s: (s is None, s or ""))
    sizes = {s: sum(n for _, x, n in rows if x == s) for s in sources}
    want = filled([2.0 * sizes[s] for s in sources], [(3, 1, 2)[i % 3] for i in range(len(sources))],
                  1.5 * sum(sizes.values()))
    mixed = mixing.mix(awkward, scratch).collect()
    assert sorted(map(repr, ((r.doc_id, r.source, r["size"]) for r in mixed))) == sorted(map(repr, rows))
    for s, target in zip(sources, want):
        own = [r for r in mixed if r.source == s]
        assert own[0].target == pytest.approx(target)
        taken = sum(r["size"] * r.copies for r in own)
        assert abs(taken - target) <= max(r["size"] for r in own) / 2 + 1
        assert all(0 <= r.copies <= 2 for r in own)
    again = mixing.mix(awkward.repartition(5), Scratch(llm, "again")).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, mixed))
    assert mixing.mix(empty(awkward), Scratch(llm, "none")).collect() == []


def test_pareto_ranks_choose_the_lowest_odds(llm, awkward, scratch):
    """Within a source no document left out of the sample ranks before one in it."""
    drawn = mixing.mix(awkward, scratch)
    classes = {(r.s, r.c): (r.whole, r.p) for r in llm.read.parquet(f"{scratch.root}/classes").collect()}
    by_source = defaultdict(list)
    for r in drawn.collect():
        c = next((k for k, (least, _) in enumerate(mixing.PREFERENCE) if r["size"] >= max(1, least)), None)
        if c is not None and classes[r.source, c][1] > 0:
            whole, p = classes[r.source, c]
            by_source[r.source].append(((r.u / (1 - r.u)) / (p / (1 - p)), r.copies - whole))
    assert by_source
    for ranks in by_source.values():
        taken = [x for _, x in sorted(ranks)]
        assert taken == sorted(taken, reverse=True)


def test_mix_is_applied_to_rows(llm, awkward, scratch):
    mixed = mixing.mix(awkward, scratch)
    out = mixing.apply_mix(awkward, mixed)
    assert out.columns == awkward.columns
    assert out.count() == sum(r.copies for r in mixed.collect())


def test_rows_are_mixed_in_place_as_the_mix_takes_them(llm, awkward, scratch):
    """Also where rows agree in id, source and size, in the edge cell and away from it."""
    many = awkward.unionByName(awkward.where("doc_id % 3 = 0")).unionByName(
        llm.range(40).select(F.lit(900).alias("doc_id"), F.concat(F.lit("x y "), "id").alias("text"),
                             *[F.lit(None).cast(f.dataType).alias(f.name) for f in awkward.schema
                               if f.name not in ("doc_id", "text")]).select(awkward.columns))
    for n, docs in enumerate((awkward, many)):
        taken = Counter()
        for r in mixing.mix(docs, Scratch(llm, f"mix-{n}")).collect():
            taken[r.doc_id, r.source, r.size] += r.copies
        out = mixing.mix_rows(docs, Scratch(llm, f"rows-{n}"))
        assert out.columns == docs.columns and out.exceptAll(docs.unionAll(docs)).count() == 0
        got = Counter((r.doc_id, r.source, len(brute.words(r.text))) for r in out.collect())
        assert got == +taken
    assert mixing.mix_rows(empty(awkward), Scratch(llm, "none")).collect() == []


def test_mixed_texts_are_not_shuffled(llm, tmp_path):
    path = str(tmp_path / "docs")
    llm.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"),
                          F.repeat(F.lit("word "), F.col("id").cast("int") + 1).alias("text")).write.parquet(path)
    out = mixing.mix_rows(llm.read.parquet(path), Scratch(llm, "plan"))
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text


# --- 3 licenses ------------------------------------------------------------------------------

LICENSED = [
    "This work is licensed under CC BY-NC 4.0. All rights reserved!",
    "cc by cc by, CC-BY; cc  by", "GNU General Public License, version 3 or later",
    "the affero general public license version 3", "Released under the MIT License.",
    "Licensed under the Apache License, Version 2.0", "SPDX-License-Identifier: MIT",
    "accby cc byx cc-by", "all rights reserved", "permission is hereby granted free of charge to "
    "any person obtaining a copy", "no licence words here"]


def test_license_base_places(llm, awkward):
    texts = LICENSED + [t for _, t in pairs(awkward)]
    df = llm.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in license_scan.report(license_scan.scan(df)).collect()}
    for i, text in enumerate(texts):
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(brute.SMALL))
        places = sorted((k, label) for phrase, label in BASE.items() for k in range(len(w))
                        if w[k:k + len(phrase.split())] == phrase.split())
        r = got[i]
        assert (r.n_words, r.n_base) == (len(w), len(places)), text
        assert (r.first_word, r.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1
    assert got[4].labels == "mit" and got[5].labels == "apache-2.0" and got[10].labels == ""
    assert got[2].labels == "gpl,gpl-3.0+" and got[3].labels == "agpl-3.0,gpl"
    assert got[6].labels == "mit"


def test_license_suppression_equals_brute_force(llm):
    """All matches of all rules, without prefilter, then the rule of containment."""
    rules = license_scan.rule_list()
    assert len(rules) > 200
    texts = LICENSED + [" and ".join(LICENSED), "apache license 2 0 apache license"]
    df = llm.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = {r.doc_id: sorted((d.first, d.last, d.rule) for d in r.detections)
           for r in license_scan.scan(df).collect()}
    for i, text in enumerate(texts):
        norm = re.sub("[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", " ", f" {text} ").lower()
        found = []
        for r in rules:
            for m in re.finditer(r["pattern"], norm):
                first = norm[:m.start()].count(" ") - 1
                found.append((first, first + m[0].count(" "), r["rule"], r["priority"]))

        def inside(a, b):
            covers = b[0] <= a[0] and b[1] >= a[1]
            longer, same = b[1] - b[0] > a[1] - a[0], b[1] - b[0] == a[1] - a[0]
            return covers and (b[3] > a[3] or b[3] == a[3] and (longer or same and b[2] < a[2]))

        left = sorted(a[:3] for a in found if not any(inside(a, b) for b in found))
        assert got[i] == left, text


def test_license_scan_of_very_many_mentions(llm):
    """100,000 mentions in one text: every place counts, and what suppresses does so, in seconds."""
    n = 20_000
    unit = "cc by mit license gpl all rights reserved apache license 2 0 general public license x"
    words, start = len(unit.split()), time.monotonic()
    df = llm.createDataFrame([(1, f"{unit} " * n), (2, unit)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in license_scan.scan(df).collect()}
    report = {r.doc_id: r for r in license_scan.report(license_scan.scan(df)).collect()}
    assert time.monotonic() - start < 120
    one = [(d.first, d.last, d.rule) for d in got[2].detections]
    want = [(f + k * words, e + k * words, r) for k in range(n) for f, e, r in one]
    assert [(d.first, d.last, d.rule) for d in got[1].detections] == want and len(one) >= 4
    assert (report[1].n_base, report[2].n_base) == (3 * n, 3) and report[1].labels == report[2].labels
    assert report[1].last_word == report[2].last_word + (n - 1) * words


def samples(pattern):
    """All texts that a rule's pattern matches; it has letters, (?:..|..), [..], ? and digits."""
    part = re.search(r"\(\?:([^()]*)\)(\??)|\[(\w+)\]|([^()])\?", pattern)
    if not part:
        return {pattern}
    choices = [part[4], ""] if part[4] else (part[3] or part[1].split("|"))
    choices = [*choices, ""] if part[2] else choices
    return set().union(*(samples(pattern[:part.start()] + c + pattern[part.end():]) for c in choices))


def test_license_keywords_are_in_every_match(llm):
    """Each text that a rule matches has the keyword of a rule for it, and the scan finds it."""
    wanted, keywords = defaultdict(int), defaultdict(set)
    for r in license_scan.rule_list():
        inner = r["pattern"].removeprefix("(?<= )").removesuffix("(?= )").replace("\\d", "7")
        for text in samples(inner):
            assert re.fullmatch(r["pattern"][6:-5], text), text
            wanted[text] = max(wanted[text], r["priority"])
            keywords[text, r["priority"], r["label"]].add(r["keyword"])
    assert not [k for k, words in keywords.items() if not words & set(k[0].split())]
    for text in ("universal permissive licence", "freebsd license", "responsible ai license",
                 "terms of the licence", "terms of this license"):
        assert text in wanted
    df = llm.createDataFrame(list(enumerate(wanted)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in license_scan.scan(df).collect()}
    for i, text in enumerate(wanted):
        whole = (0, got[i].n_words - 1)
        assert any((d.first, d.last) == whole and d.priority >= wanted[text]
                   for d in got[i].detections), text


# --- 4 n-gram join -----------------------------------------------------------------------------


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80), (2, 60)])
def test_ngram_join(llm, awkward, scratch, width, percent):
    got = ngram_join.near_duplicates(awkward, scratch, width, percent).collect()
    key = lambda r: [(x is not None, x or 0) for x in r]
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=key) == \
        brute.components(pairs(awkward), width, percent)


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_shapes_never_part_a_link(percent):
    """Random sets around the threshold: a pair that links passes; far ones mostly do not."""
    rng = np.random.default_rng(percent)
    pairs, links = [], []
    for k in range(400):
        both = rng.integers(0, 2 ** 63, rng.integers(1, 600), np.uint64)
        own = 1 + len(both) // (4 if k % 3 else 40)
        a, b = (rng.integers(0, 2 ** 63, rng.integers(0, own), np.uint64) for _ in "ab")
        x, y = (np.unique(np.concatenate([both[:len(both) if k % 2 else 0], own, both[:1]])) for own in (a, b))
        common = len(np.intersect1d(x, y))
        links.append(100 * common >= percent * (len(x) + len(y) - common))
        pairs.append((k, -k, len(x), ngram_join.shape(x), len(y), ngram_join.shape(y)))
    batch = pa.RecordBatch.from_pydict(dict(zip(("a", "b", "n_a", "shape_a", "n_b", "shape_b"), zip(*pairs))))
    (kept,) = ngram_join.alike(percent)(iter([batch]))
    kept = set(kept["a"].to_pylist())
    assert {k for k, link in enumerate(links) if link} <= kept and sum(links) > 50
    assert len(kept - {k for k, link in enumerate(links) if link}) < 250


@pytest.mark.parametrize("percent", [80, 90])
def test_shapes_tell_large_sets_apart(percent):
    """Large sets that met by chance do not pass; links do, whatever the sizes and the parts."""
    rng = np.random.default_rng(percent)
    new = lambda n: rng.integers(0, 2 ** 63, n, np.uint64)
    pairs, links = [], set()
    for k, n in enumerate([*rng.integers(2000, 30_000, 60).tolist(), 2040, 4090, 8190]):
        x = np.unique(new(n))
        y = np.unique(np.concatenate([x[n // 50:], new(n // 50 + k % 2 * 40)]) if k % 3 == 0 or k >= 60 else new(n))
        if k % 3 == 0 or k >= 60:
            links.add(k)
        pairs.append((k, -k, len(x), ngram_join.shape(x), len(y), ngram_join.shape(y)))
    heavy = np.arange(1, 400, dtype=np.uint64) << np.uint64(20)  # one part holds all of them
    pairs.append((99, -99, 399, ngram_join.shape(heavy), 399, ngram_join.shape(heavy)))
    batch = pa.RecordBatch.from_pydict(dict(zip(("a", "b", "n_a", "shape_a", "n_b", "shape_b"), zip(*pairs))))
    (kept,) = ngram_join.alike(percent)(iter([batch]))
    assert set(kept["a"].to_pylist()) == links | {99}


def test_ngram_join_follows_chains_and_hot_passages(llm, scratch):
    """A chain whose ends do not link, in any id order, beside a passage that all texts hold."""
    base = [f"c{i}" for i in range(200)]
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for step in range(12):
        chain = [w if i >= 4 * step else f"d{i}" for i, w in enumerate(base)]
        rows.append(((step * 7) % 12, " ".join(chain)))
    for i in range(30):
        own = [f"u{i}x{k}" for k in range(40)]
        rows.append((100 + i, " ".join(own[:20] + passage + own[20:])))
    df = llm.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id)
                 for r in ngram_join.near_duplicates(df, scratch, 3, 90).collect())
    assert got == brute.components(rows, 3, 90)
    assert len({c for d, _, c in got if d < 12}) == 1


def test_ngram_join_on_nothing(llm, awkward, scratch):
    assert ngram_join.near_duplicates(empty(awkward), scratch).collect() == []


def test_one_document_of_each_group_stays(llm, awkward, scratch):
    groups = ngram_join.near_duplicates(awkward, scratch, 5, 80)
    kept = ngram_join.one_per_group(awkward, groups, scratch)
    assert kept.columns == awkward.columns
    ids = [r.doc_id for r in kept.collect()]
    first = {r.component_id for r in groups.collect() if r.doc_id is not None}
    assert sorted(i for i in ids if i is not None) == sorted(first - {None})
    assert ids.count(None) == 2


def test_one_row_of_each_group_stays_whatever_the_ids(llm, scratch):
    """Near copies under one id, under another row's id and without an id."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(5, a), (5, a + " more"), (5, c), (7, b), (7, b + " more"), (3, c + " more"), (9, b),
            (None, a), (None, "d e f"), (None, "d e f"), (None, "d e f"), (2, "g h"), (2, "g h"),
            (None, None), (None, None), (4, ""), (4, "")]
    df = llm.createDataFrame(rows, "doc_id bigint, text string")
    kept = ngram_join.one_per_group(df, ngram_join.near_duplicates(df, scratch, 5, 80), scratch)
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    fixed = [(3, c + " more"), (None, "d e f"), (2, "g h"), (None, None), (None, None), (4, "")]
    assert [r for r in got if r[0] not in (5, 7)] == sorted(fixed, key=repr)
    for i, text in ((5, a), (7, b)):
        assert len([r for r in got if r[0] == i and r[1] in (text, text + " more")]) == 1
    assert len(got) == len(fixed) + 2


def test_texts_of_kept_rows_are_not_shuffled(llm, scratch):
    """Without broadcasts, the rows shuffled beside the marks are those that their groups lose."""
    path = f"{scratch.root}/docs"
    llm.range(300).select(F.col("id").alias("doc_id"), F.concat(
        F.lit("text "), F.when(F.col("id") % 10 == 3, 0).otherwise(F.col("id"))).alias("text")).write.parquet(path)
    docs = llm.read.parquet(path)
    groups = scratch.keep(ngram_join.near_duplicates(docs, scratch), "groups")
    set_to = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: llm.conf.get(k) for k in set_to}
    try:
        for k, v in set_to.items():
            llm.conf.set(k, v)
        kept = ngram_join.one_per_group(docs, groups, scratch)
        ids = {r.doc_id for r in kept.collect()}
    finally:
        for k, v in before.items():
            llm.conf.set(k, v)
    assert ids == {i for i in range(300) if i % 10 != 3}
    moved, left = [], [kept._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        if node.nodeName() == "Exchange" and "_near_text" in node.output().mkString():
            moved.append(node.metrics().apply("shuffleRecordsWritten").value())
        left += [node.children().apply(i) for i in range(node.children().size())]
    assert moved == [30]


# --- 5 toxicity ------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def labelled(llm):
    rng = np.random.default_rng(8)
    rows, labels = [], []
    for i in range(600):
        w = [f"n{k}" for k in rng.integers(0, 300, rng.integers(5, 200))]
        toxic = i % 6 == 0
        if toxic:
            for k in rng.integers(0, len(w), max(1, len(w) // 12)):
                w[k] = ["scum", "vile1", "vile2", "vileness"][rng.integers(0, 4)]
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    return (llm.createDataFrame(rows, "doc_id bigint, text string"),
            llm.createDataFrame(labels + [(0, 1), (1, None), (5000, 1), (None, 0), (2, 7)],
                                "doc_id bigint, toxic int"))


def test_toxicity_on_held_out_rows(llm, labelled):
    docs, labels = labelled
    train = labels.where("doc_id < 400")
    model = toxicity.fit(docs, train)
    assert (np.diff(model.thresholds) > 0).all()
    rows = toxicity.grade(docs.where("doc_id >= 400"), model).collect()
    assert all(r.p_above_0 >= r.p_above_1 >= r.p_above_2 for r in rows)
    assert all(r.severity == pytest.approx(r.p_above_0 + r.p_above_1 + r.p_above_2) for r in rows)
    caught = [r.rejected for r in rows if r.doc_id % 6 == 0]
    clean = [r.rejected for r in rows if r.doc_id % 6]
    assert sum(caught) >= 0.95 * len(caught), [r for r in rows if not r.doc_id % 6]
    assert sum(clean) <= 0.01 * len(clean)


def test_toxicity_gradient_is_right():
    rng = np.random.default_rng(1)
    rows = [(rng.choice(50, 8, replace=False).astype(np.int32), rng.random(8).astype(np.float32))
            for _ in range(200)]
    truth = np.zeros(toxicity.COLUMNS, np.float32)
    truth[:50] = rng.normal(0, 4, 50)
    scores = np.array([truth[c] @ v for c, v in rows])
    grades = np.searchsorted(np.quantile(scores, [0.4, 0.7, 0.9]), scores)
    w, theta = toxicity.fit_ordinal(toxicity.Sparse(rows), grades)
    fitted = np.array([w[c] @ v for c, v in rows])
    assert np.corrcoef(fitted, scores)[0, 1] > 0.9 and (np.diff(theta) > 0).all()


def test_toxicity_keeps_rows_and_defined_cases(llm, labelled, awkward):
    docs, labels = labelled
    model = toxicity.fit(docs, labels)
    kept = toxicity.keep_clean(awkward, model)
    assert kept.columns == awkward.columns
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, awkward.collect()))
    blank = {r.doc_id: r for r in toxicity.grade(awkward, model).collect()}
    assert blank[301].severity == blank[303].severity == 0 and not blank[302].rejected
    nothing = toxicity.fit(docs, labels.where("toxic = 0"))
    assert not any(r.rejected for r in toxicity.grade(docs, nothing).collect())
    assert toxicity.grade(empty(docs), model).collect() == []


# --- 8 sketches ----------------------------------------------------------------------------------------


def test_edited_texts(llm, awkward, scratch):
    rows = [(r.doc_id, r.text or "") for r in awkward.collect()]
    ids = sorted({d for d, _ in rows}, key=lambda d: (d is not None, d or 0))
    first = {d: min((t for x, t in rows if x == d), key=lambda t: (len(t), t.encode())) for d in ids}
    expected = []
    for d, t in rows:
        other = first[ids[(ids.index(d) + 1) % len(ids)]]
        cut = len(t) // 2
        expected.append((d, len(t), t[:len(t) - cut] + other[:cut]))
    got = bottom_k.edited(awkward, scratch).collect()
    assert sorted(map(repr, ((r.doc_id, r.n_chars, r.edited) for r in got))) == sorted(map(repr, expected))
    assert bottom_k.edited(empty(awkward), Scratch(llm, "none")).collect() == []


def test_sketch_estimates(llm):
    from pyspark.sql import functions as F

    w = [f"t{i}" for i in range(3000)]
    texts = [" ".join(w), " ".join(w[:1500]), " ".join(w[1500:]), "", None, "one two", "x y z a b c",
             "X  y z\na b c"]
    df = llm.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    s = df.select("doc_id", bottom_k.sketch(F.col("text")).alias("s"))
    by = {r.doc_id: r.s for r in s.collect()}
    assert by[3] == by[4] == [] and len(by[5]) == 1 and by[6] == by[7] and len(by[6]) == 2
    assert all(x == sorted(set(x)) and len(x) <= bottom_k.K for x in by.values())
    a, b = s.alias("a"), s.alias("b")
    j = {(r.x, r.y): r for r in a.crossJoin(b).select(
        F.col("a.doc_id").alias("x"), F.col("b.doc_id").alias("y"),
        bottom_k.resemblance(F.col("a.s"), F.col("b.s")).alias("near"),
        bottom_k.containment(F.col("b.s"), F.col("a.s")).alias("within"),
        bottom_k.distinct_shingles(F.col("a.s")).alias("n")).collect()}
    assert abs(j[0, 1].near - 0.5) < 0.15 and j[1, 2].near < 0.02 and j[3, 4].near == 1
    assert j[0, 1].within > 0.8 and abs(j[0, 0].n / 2996 - 1) < 0.25 and j[3, 0].near == 0
    merged = bottom_k.merge_all(s.where("doc_id in (1, 2)").withColumn("k", F.lit("all")), "k", "s").first().s
    exact = bottom_k.merge(F.lit(by[1]), F.lit(by[2]))
    assert merged == llm.range(1).select(exact.alias("m")).first().m


def test_edited_digest_is_utf8(llm, scratch):
    df = llm.createDataFrame([(1, "aéb"), (2, "日本語文")], "doc_id bigint, text string")
    got = {r.doc_id: (r.edited, r.d) for r in bottom_k.edited(df, scratch).withColumn(
        "d", F.sha2("edited", 256)).collect()}
    assert got == {i: (t, hashlib.sha256(t.encode()).hexdigest()) for i, t in ((1, "aé日"), (2, "日本aé"))}


def long_hash(data, seed=42):
    """The 64-bit hash of bytes, as the engine's function seeds and signs it."""
    v = xxhash.xxh64_intdigest(data, seed % 2 ** 64)
    return v - 2 ** 64 if v >= 2 ** 63 else v


def brute_sketch(text):
    words = [w for w in re.split("[ \t\n\x0b\f\r]+", text.lower()) if w]
    h = [long_hash(w.encode()) for w in words]

    def chained(values):
        seed = 42
        for v in values:
            seed = long_hash(v.to_bytes(8, "little", signed=True), seed)
        return seed

    spans = [h[i:i + 5] for i in range(len(h) - 4)] if len(h) >= 5 else [h] if h else []
    return sorted({chained(s) for s in spans})[:bottom_k.K]


def brute_resemblance(left, right):
    union = sorted({*left, *right})[:bottom_k.K]
    return len([x for x in union if x in left and x in right]) / len(union) if union else 1.0


def test_sketch_query_against_brute_force(llm, awkward, tmp_path):
    """Every column of the registered query, hashes made again in Python."""
    rows = sorted({r.doc_id: r.text or "" for r in awkward.collect() if r.doc_id is not None}.items())
    llm.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries.QUERIES["op8_bottom_k"](llm, str(tmp_path)).collect()}
    assert len(got) == len(rows)

    def shown(sketch):
        return "".join(f"{x % 2 ** 64:016X}" for x in sketch)

    for (doc_id, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        cut = len(text) // 2
        edited = text[:len(text) - cut] + after[:cut]
        own, changed, other = map(brute_sketch, (text, edited, after))
        assert got[doc_id].asDict() == {
            "doc_id": doc_id, "n_chars": len(text), "fingerprint": shown(own),
            "edited_sha256": hashlib.sha256(edited.encode()).hexdigest(),
            "edited_fingerprint": shown(changed),
            "near_edited": pytest.approx(brute_resemblance(own, changed)),
            "near_next": pytest.approx(brute_resemblance(own, other))}
