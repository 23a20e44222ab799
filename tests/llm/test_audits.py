"""WARC revisit resolution, hard-negative mining and the divergence audit, each against a plain version."""

from __future__ import annotations

import gzip
import hashlib
import math
import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import check
from hazardlake.llm import divergence, hard_negatives, queries, warc
from hazardlake.session import new_folder

SF = "/root/testdata/sf0.001"


# --- WARC ---------------------------------------------------------------------------------

LONG = "x\r\n\r\ny" * 300
PAGES = [(1, "http://a", LONG), (2, "u\r\nX-Forged: 1 2", LONG), (5, None, LONG), (5, "rep", LONG), (None, "n", LONG),
         (3, "s", "short"), (4, "s", "short"), (6, "z", None), (7, "z", ""), (8, "t", "é" * 600 + "\r\n"),
         (9, "t", "é" * 600 + "\r\n"), (10, "q", "\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n" * 100),
         (11, "edge", "a" * 1000), (12, "edge", "a" * 1000), (13, "edge", "a" * 999), (14, "edge", "a" * 999),
         (15, "long", "ab\r\n" * 2_000_000), (16, "long", "ab\r\n" * 2_000_000)]


def brute_warc(pages, least=1000):
    groups = defaultdict(list)
    for nr, (page, _, html) in enumerate(pages):
        groups[html or ""].append((page is not None, page or 0, nr, page))
    rows = []
    for html, members in groups.items():
        data = html.encode()
        top = max(members)
        repeated = [m for m in members if m[1] == top[1] and m[0] == top[0]]
        for member in members:
            # of records that repeat the largest id one stays, whichever
            revisit = len(data) >= least and not (member in repeated and member == repeated[0])
            rows.append((member[3], len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response",
                         top[3] if revisit else None))
    return sorted(rows, key=str)


def seen(spark, path):
    return sorted(map(tuple, warc.captures(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def stored_text(path):
    return b"".join(gzip.open(f).read() for f in sorted(Path(path.removeprefix("file:")).glob("*.gz")))


@pytest.fixture(scope="module")
def raw(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    clashing = pages.withColumns({c: F.lit("x") for c in ("kind", "row", "sender", "seq", "digest", "payload", "value", "file")})
    return warc.archived(clashing.repartition(3))


def test_pages_round_trip(spark, raw):
    assert seen(spark, raw) == sorted(
        [(p, len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest(), "response", None) for p, _, h in PAGES], key=str)
    payloads = Counter(bytes(r.payload) for r in warc.records(spark, raw).collect())
    assert payloads == Counter((h or "").encode() for _, _, h in PAGES)


def test_revisits_refer_to_the_largest_id(spark, raw):
    found = warc.deduplicated(spark, raw)
    assert seen(spark, found) == brute_warc(PAGES)
    text = stored_text(found)
    # a payload is stored once, and no URL adds a header
    assert text.count(LONG.encode()) == 1 and b"\r\nX-Forged" not in text
    assert len(text) < len(stored_text(raw)) * 0.6


def test_resolving_again_changes_nothing(spark, raw):
    once = warc.deduplicated(spark, raw)
    assert seen(spark, warc.deduplicated(spark, once)) == seen(spark, once)


def test_revisits_that_were_there(spark, raw):
    """Revisit records of the input follow the response that stays; without one they are kept as they were."""
    body = b"HTTP/1.1 200 OK\r\n\r\n"

    def record(*lines, block=body):
        head = ["WARC/1.0", *lines, f"Content-Length: {len(block)}"]
        return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"

    sha = hashlib.sha1(LONG.encode())
    known = record("WARC-Type: revisit", "WARC-Record-ID: <urn:x:1>", f"WARC-Payload-Digest: sha1:{sha.hexdigest().upper()}",
                   "WARC-Refers-To: <urn:x:gone>", "Content-Type: application/http; msgtype=response")
    unknown = record("WARC-Type: revisit", "WARC-Record-ID: <urn:x:2>", "WARC-Payload-Digest: sha1:" + "7" * 32,
                     "WARC-Refers-To: <urn:x:other>", "WARC-Refers-To-Target-URI: http://there")
    info = record("WARC-Type: warcinfo", "WARC-Record-ID: <urn:x:3>", block=b"software: test\r\n\r\n")
    text = stored_text(raw) + info + known + unknown
    folder = new_folder(spark, "warc-test")
    local = Path(folder.removeprefix("file:"))
    local.mkdir(parents=True)
    (local / "mixed.warc.gz").write_bytes(gzip.compress(text[:len(text) // 2]) + gzip.compress(text[len(text) // 2:]))
    found = warc.deduplicated(spark, folder)
    after = {r.record_id: r for r in warc.records(spark, found).collect()}
    top = next(r.record_id for r in after.values() if r.kind == "response" and bytes(r.payload) == LONG.encode())
    assert after["<urn:x:1>"].refers_to == top
    assert (after["<urn:x:2>"].refers_to, after["<urn:x:2>"].refers_uri) == ("<urn:x:other>", "http://there")
    assert info in stored_text(found)


def test_damaged_archives_raise(spark, raw):
    folder = new_folder(spark, "warc-test")
    local = Path(folder.removeprefix("file:"))
    local.mkdir(parents=True)
    (local / "a.gz").write_bytes(gzip.compress(stored_text(raw)[:-700]))
    with pytest.raises(Exception, match="cut off"):
        warc.records(spark, folder).count()


def test_empty_archives(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert seen(spark, warc.deduplicated(spark, warc.archived(none))) == []


# --- hard negatives -----------------------------------------------------------------------

def brute_negatives(rows):
    kept = [(nr, i, l, [math.floor(256 * x) if abs(x) < 1e15 else int(x) * 256 for x in v])
            for nr, (i, l, v) in enumerate(rows)
            if l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    found = []
    for nr, anchor, label, v in kept:
        if anchor is None or anchor % 100:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), i is None, i or 0, n, i, l)
                         for n, i, l, w in kept if n != nr and len(w) == len(v)))
        for p in [s for s in scored if s[5] == label][:5]:
            within = [s for s in scored if s[5] != label and 80 * -p[0] <= 100 * -s[0] <= 100 * -p[0]]
            found += [(anchor, p[4], rank, s[4], -p[0], -s[0]) for rank, s in enumerate(within[:5], 1)]
    return sorted(found, key=str)


def mined(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    df = df.withColumns({c: F.lit(1) for c in ("at", "id", "anchor", "dims", "block", "group", "rank", "place")})
    found = hard_negatives.mined(df.repartition(3), F.col("vec_id") % 100 == 0, **options)
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.parametrize("size, spread", [(900, 1.0), (700, 0.05)])
def test_negatives_like_brute_force(spark, monkeypatch, size, spread):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 128)
    monkeypatch.setattr(hard_negatives, "GROUP_ANCHORS", 3)
    random = np.random.default_rng(size)
    centres = random.normal(size=(6, 20))
    rows = [(i * 10, int(random.integers(4)), (centres[i % 6] + random.normal(size=20) * spread).tolist()) for i in range(size)]
    assert mined(spark, rows) == brute_negatives(rows) != []


def test_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 2.0]), (0, 1, [1.0, 2.0]), (100, 2, [0.5, 0.25]), (100, 1, [2.0, -1.0]), (None, 1, [1.0, 2.0]),
            (None, 2, [1.0, 1.9]), (1, 2, [1.0, 1.9]), (1, 2, [1.0, 1.9]), (2, None, [1.0, 1.0]), (3, 1, None), (4, 1, [nan, 1.0]),
            (5, 1, [inf, 1.0]), (6, 1, [None, 1.0]), (7, 1, []), (200, 2, []), (8, 2, []), (9, 1, [1.0]), (300, 1, [1.0]),
            (10, 2, [1.0]), (11, 2, [-3.0, -3.0]), (400, 2, [0.0, 0.0]), (12, 1, [0.001, -0.001]), (13, 2, [0.0, 0.0])]
    assert mined(spark, rows) == brute_negatives(rows) != []
    assert mined(spark, []) == []


def test_negatives_beyond_doubles(spark):
    """Products that doubles can't hold are exact."""
    rows = [(0, 1, [3e6, 1.0]), (1, 1, [3e6 + 1 / 256, 1.0]), (2, 2, [3e6, 1 + 1 / 256]), (3, 2, [3e6, 1.0]), (4, 1, [3e6, 2.0]),
            (100, 1, [1e7, 2 ** -8])]
    assert mined(spark, rows) == brute_negatives(rows) != []


def test_one_vector_a_third_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 64)
    random = np.random.default_rng(5)
    common = random.normal(size=8).tolist()
    rows = [(i * 25, int(random.integers(2)), common if i % 3 == 0 else random.normal(size=8).tolist()) for i in range(400)]
    assert mined(spark, rows) == brute_negatives(rows)


# --- divergence -----------------------------------------------------------------------------

def brute_divergence(rows, least=3, top=200):
    documents, uses, sources = Counter(), Counter(), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        sources[lang].add(source)
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        documents.update({(lang, t) for t in found})
        uses.update((lang, source, t) for t in found)
    result = []
    for lang, names in sources.items():
        kept = sorted(t for g, t in documents if g == lang and documents[g, t] >= least)
        count = {s: [uses[lang, s, t] for t in kept] for s in names}
        whole = [sum(column) for column in zip(*count.values())]

        def share(values):
            return [1 + 10 ** 9 * (c + 1) // (sum(values) + len(kept)) for c in values]

        p, q = {s: share(c) for s, c in count.items()}, share(whole)
        for s in names:
            pairs = [(sum((x - y) ** 2 // y for x, y in zip(p[s], p[o])), o) for o in names if o != s]
            terms = [((x - y) ** 2 // y, t) for t, c, x, y in zip(kept, count[s], p[s], q) if c and x > y]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda f: (-f[0], f[1].encode()))
                result += [(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(found[:most], 1)]
    return sorted(result)


def audited(docs, **options):
    names = ("lang", "source", "part", "item", "value", "rank")
    return sorted(tuple(r) for r in divergence.audited(docs, **options).select(*names).collect())


def test_divergence_like_brute_force(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 40)  # tasks send what they gathered several times
    random = np.random.default_rng(3)
    words = ["Fire", "fire", "água", "forest", "Wind", "x", "é", "smoke", "ÁGUA", "ash9b", "zz"] + [f"w{chr(97 + i)}" for i in range(25)]
    rows = [(["pt", "en", None][random.integers(3)], ["a", "b", "Z", "ü", None][int(random.integers(5))],
             " ".join(random.choice(words, random.integers(0, 12), p=None))) for _ in range(300)]
    # a third of all rows from one source with one word, and languages with one source, few terms and none
    rows += [("en", "hot", "fire fire")] * 150 + [("one", "s", "fire")] * 4 + [("few", "s", "rare"), ("few", "t", None), ("few", None, "")]
    docs = spark.createDataFrame(rows, "lang string, source string, text string").repartition(4)
    clashing = docs.withColumns({c: F.lit(1) for c in ("term", "p", "q", "part", "item", "value", "rank", "path", "n")})
    assert audited(clashing) == brute_divergence(rows)


def test_divergence_of_odd_documents(spark, odd, empty):
    rows = [tuple(r) for r in odd.select("lang", "source", "text").collect()]
    assert audited(odd) == brute_divergence(rows)
    assert audited(odd, min_documents=1, top_terms=7) == brute_divergence(rows, 1, 7)
    assert audited(empty) == []


def test_shares_are_exact_for_large_counts(spark):
    rows = [(10 ** 13, 3 * 10 ** 15 + 7), (1, 1), (1, 10 ** 15), (999_999_999_999, 10 ** 12), (0, 5)]
    df = spark.createDataFrame(rows, "c long, total long")
    found = [r[0] for r in df.select(divergence.share(F.col("c"), F.col("total"))).collect()]
    assert found == [1 + 10 ** 9 * c // t for c, t in rows]


# --- queries --------------------------------------------------------------------------------

@pytest.mark.parametrize("name", ["op11_warc", "op12_hard_negatives", "op13_divergence"])
def test_columns(spark, name):
    kinds = {"op11_warc": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
             "op12_hard_negatives": "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, "
                                    "negative_score bigint",
             "op13_divergence": "lang string, source string, part string, item string, value bigint, rank int"}
    assert ", ".join(f"{n} {t}" for n, t in queries.QUERIES[name](spark, SF).dtypes) == kinds[name]
    assert check.compare(spark, check.connect(SF), name, SF) == ""
