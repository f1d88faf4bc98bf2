"""URL filter, WARC archives, nearest neighbours and chat formatting."""

import gzip
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickstar.llm import chat_format, nearest, url_filter, warc
from clickstar.llm.tables import Scratch

PAGES = "page_id bigint, url string, html string, host int, rule string, n int, digest string"


def pages(llm, rows):
    return llm.createDataFrame([(*r, 1, "r", 2, "d") for r in rows], PAGES)


URLS = [
    "http://a.example.net/en/1", "https://EXAMPLE.net/en/", "http://example.net/enx", "http://net/x",
    "http://x.net", "ftp://b.example.com/de/1?x=/fr/", "http://example.com/DE/", "http://q.org/fr/",
    "http://q.org/fr", "nothing", None, "", "http://", "x://y://z.org/fr/", "http://notexample.com/de/",
    "http://m.casino-win.example.com/en/1#top", "http://.net/", "http://a..net/#/", "http://org?/fr/",
    "http://a.net:80/", "http://ads.example.org/fr/1"]


def judged(url):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = rest[:cut].translate({i: i + 32 for i in range(65, 91)})
        path = rest[cut:].split("?")[0].split("#")[0]
    rules = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
    fits = [r for r in rules if (h := r.split("/", 1)[0]) and (host == h or host.endswith("." + h))
            and path.startswith("/" + r.split("/", 1)[1])]
    rule = max(fits, key=len, default=None)
    spam = any(w in host.replace("-", ".").split(".") for w in ("casino", "ads"))
    return host, path, rule, rules[rule] if rule else "block" if spam else "allow"


def test_url_rules(llm, scratch):
    df = pages(llm, [(i, u, None) for i, u in enumerate(URLS * 2)])
    got = url_filter.judge(df, ["net/", "example.com/de/"], ["example.net/en/", "org/fr/"],
                           lambda h: h.where(h.host.rlike(r"(^|[.-])(casino|ads)([.-]|$)")), scratch)
    for r in got.collect():
        assert (r.host, r.path, r.rule, r.verdict) == judged(URLS[r.page_id % len(URLS)])
    none = url_filter.judge(df.where("false"), ["net/"], [], lambda h: h, Scratch(llm, "none"))
    assert none.collect() == []


def test_cascade_is_exact_over_its_universe(llm, scratch):
    universe = llm.range(20000).select(F.concat(F.lit("k"), F.col("id")).alias("key"))
    listed = universe.where(F.xxhash64("key") % 7 == 0)
    cascades = url_filter.build(universe.union(universe), {"some": listed, "none": listed.where("false"),
                                                           "all": universe}, scratch)
    assert len(cascades["some"].levels) > 2 and cascades["none"].levels == ()
    seen = universe.select("key", *[c.holds(F.col("key")).alias(n) for n, c in cascades.items()])
    wrong = seen.where((F.col("some") != (F.xxhash64("key") % 7 == 0)) | F.col("none") | ~F.col("all"))
    assert wrong.count() == 0
    bits = sum(level.bits for level in cascades["some"].levels)
    assert bits < 16 * listed.count()


BIG, SMALL = "é" * 700, "x" * 999


def page_rows():
    return [(1, "http://b.com/1", BIG), (2, "http://a.com/1", BIG), (3, "http://a.com/1", SMALL),
            (4, "http://a.com/1", SMALL), (5, None, None), (6, "", ""),
            (7, "http://a.b.com/x?y#z", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" + "q" * 1000),
            (8, "http://C.com/a\r\nWARC-Type: x", "\r\n\r\n" * 300), (9, "http://c.com/", "\r\n\r\n" * 300),
            (2, "http://a.com/1", BIG), (None, "http://n.com/", BIG), (10, "http://b.com/1", "y" * 1000)]


def test_warc_round_trip(llm, scratch):
    rows = page_rows()
    got = warc.archive_and_index(pages(llm, rows).repartition(3), scratch).collect()
    largest = {}
    for page_id, _, html in rows:
        if html and len(html.encode()) >= 1000 and page_id is not None:
            largest[html] = max(largest.get(html, page_id), page_id)
    expected = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        to = largest.get(html)
        revisit = to is not None and to != page_id
        expected.append((page_id, len(data), hashlib.sha1(data).hexdigest(),
                         "revisit" if revisit else "response", to if revisit else None))
    assert sorted(map(repr, ((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                             for r in got))) == sorted(map(repr, expected))
    in_order = sorted(got, key=lambda r: r.index_pos)
    assert [r.index_pos for r in in_order] == list(range(len(rows)))
    keys = [warc.order((r.url_key, r.ts, r.page_id)) for r in in_order]
    assert keys == sorted(keys)


def test_archives_are_plain_warc(llm, scratch, tmp_path):
    path = str(tmp_path / "w")
    warc.write_archives(pages(llm, page_rows()).coalesce(1), path)
    archive = next((tmp_path / "w").glob("*.gz"))
    raw = gzip.decompress(archive.read_bytes())
    assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n")
    found = list(warc.parsed(warc.unpacked(archive.read_bytes(), 7)))
    assert len(found) == len(page_rows())
    assert all(raw[at:at + 8] == b"WARC/1.1" for at, _, _ in found)


def test_warc_on_nothing(llm, scratch):
    assert warc.archive_and_index(pages(llm, []), scratch).collect() == []


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree(k):
    rng = random.Random(k)
    runs = [sorted(((rng.choice("abc"), str(rng.randint(0, 3)), rng.choice([None, 1, 2])) for _ in
                    range(rng.randint(0, 9))), key=warc.order) for _ in range(k)]
    merged = list(warc.LoserTree(runs))
    assert [warc.order(r) for r in merged] == sorted(warc.order(r) for run in runs for r in run)


def test_ranges_merge_to_one_order(llm, scratch, monkeypatch):
    monkeypatch.setattr(warc, "CAPTURES_PER_RANGE", 40)
    rows = [(i, f"http://h{i % 3}.com/{'hot' if i % 2 else i}", "t") for i in range(300)]
    got = warc.archive_and_index(pages(llm, rows).repartition(4), scratch).collect()
    in_order = sorted(got, key=lambda r: r.index_pos)
    keys = [(r.url_key, r.ts, r.page_id) for r in in_order]
    assert keys == sorted(keys) and len({r.range for r in got}) > 3


@pytest.mark.parametrize("query_rows, candidate_rows", [(1024, 8192), (7, 30)])
def test_nearest_equals_brute_force(llm, query_rows, candidate_rows):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 12)).astype(np.float32)
    x[50:120] = x[50]  # ties
    rows = [(i, v.tolist(), 1, 0.5) for i, v in enumerate(x)]
    rows += [(200, None, 1, 0.), (220, [0.0] * 12, 1, 0.), (240, [float("nan")] * 12, 1, 0.),
             (260, [None] + [1.0] * 11, 1, 0.), (None, [1.0] * 12, 1, 0.), (280, [1.0, 2.0], 1, 0.),
             (281, [3.0, -1.0], 1, 0.), (40, x[40].tolist(), 2, 0.), (300, [], 1, 0.),
             (301, [float("inf")] * 12, 1, 0.)]
    df = llm.createDataFrame(rows, "vec_id bigint, embedding array<float>, rank int, score double")
    got = nearest.nearest(df, F.col("vec_id") % 20 == 0, 20, query_rows, candidate_rows).collect()
    expected = []
    valid = {i: x[i].astype(float) for i in range(200)}
    for group in (valid, {280: np.array([1.0, 2.0]), 281: np.array([3.0, -1.0])}):
        for q in (i for i in group if i % 20 == 0):
            scores = []
            for c in group:
                if c != q:
                    s = 0.0
                    for a, b in zip(group[q].tolist(), group[c].tolist()):
                        s += a * b
                    scores.append((-s, c))
            expected += [(q, n, c, -s) for n, (s, c) in enumerate(sorted(scores)[:20], 1)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(expected)
    assert nearest.nearest(df.where("false"), F.col("vec_id") % 20 == 0).collect() == []


@pytest.mark.parametrize("size", [1.0, 1e39, 1e-60, 1e-150, 1e150])
def test_nearest_of_doubles(llm, size):
    """Scores of double vectors are those of the original values, also beyond float32's range."""
    x = np.random.default_rng(3).normal(size=(60, 8)) * size
    df = llm.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)],
                             "vec_id bigint, embedding array<double>")
    got = nearest.nearest(df, F.col("vec_id") % 20 == 0, 5, 16, 16).collect()
    expected = []
    for q in (0, 20, 40):
        scores = []
        for c in set(range(60)) - {q}:
            s = 0.0
            for a, b in zip(x[q].tolist(), x[c].tolist()):
                s += a * b
            scores.append((-s, c))
        expected += [(q, n, c, -s) for n, (s, c) in enumerate(sorted(scores)[:5], 1)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(expected)


TURNS = "conv_id bigint, turn bigint, role string, text string, body string, formatted int"


def formatted(llm, rows):
    df = llm.createDataFrame([(*r, "b", 1) for r in rows], TURNS)
    typed = df.select("conv_id", "turn", "role",
                      chat_format.parts_of(F.coalesce("text", F.lit(""))).alias("parts"))
    return chat_format.conversations(chat_format.format_turns(typed))


NASTY = ["\\### Assistant: </turn> ok", "</turn>\n<turn assistant>\\l\\b\\g", "\\", "<>", "", None,
         "a ![image 3](img://1) b ![audio](s.mp3)![document 2](d.pdf)", "![image](bad", "![image 1](a\\b<c>)",
         "\U0001f600é\n\n", "![video](x)", "<image 0>"]


def test_chat_round_trip(llm):
    roles = ["user", "assistant", "system", None, "a>b\n<"]
    rows = [(c, t, roles[(c + t) % 5], NASTY[(c * 5 + t) % len(NASTY)]) for c in range(12) for t in range(9)]
    rows += [(50, None, "assistant", "x"), (50, 1, "assistant", "y"), (50, 1, "assistant", "y"),
             (None, 0, "user", "n"), (-7, 0, "user", NASTY[0]), (-7, 1, "assistant", NASTY[0])]
    got = {r.conv_id: r for r in chat_format.read_back(formatted(llm, rows)).collect()}
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append(((t is not None, t or 0), role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns = [x[1:] for x in sorted(turns)]
        assert [(t.role, t.text) for t in got[c].turns] == turns
        assert got[c].loss_text == "".join(text for role, text in turns if role == "assistant")
        assert got[c].formatted.count("</turn>\n") == len(turns)


def test_chat_attachments(llm):
    row = formatted(llm, [(1, 0, "user", NASTY[6]), (1, 1, "assistant", "see ![image](z)")]).first()
    assert row.expanded_tokens == 3 * 256 + 25 + 2 * 512 + 256
    assert [(a.kind, a.ref) for a in row.attachments[0]] == [
        ("image", "img://1"), ("audio", "s.mp3"), ("document", "d.pdf")]
    assert row.formatted == ("<turn user>a <image 0> b <audio 1><document 2></turn>\n"
                             "<turn assistant>see <image 0></turn>\n")


def test_chat_typed_parts_and_nothing(llm):
    df = llm.sql("""SELECT 1L AS conv_id, 0L AS turn, 'user' AS role, array(
        named_struct('kind', 'text', 'text', 'a<', 'ref', null, 'units', 0L, 'raw', 'a<'),
        named_struct('kind', 'image', 'text', null, 'ref', 'r', 'units', null, 'raw', null),
        named_struct('kind', 'hologram', 'text', null, 'ref', 'r', 'units', 1L, 'raw', 'h')) AS parts""")
    row = chat_format.conversations(chat_format.format_turns(df)).first()
    assert row.formatted == "<turn user>a\\l<image 0>h</turn>\n" and row.expanded_tokens == 256
    assert formatted(llm, []).collect() == []
