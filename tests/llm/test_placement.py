"""Chat formatting, mixing, sharding, nearest neighbours, and the pipeline as a whole."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
import check
import corpus_pipeline
from hazardlake.llm import (
    bpe_codec, chat_format, language_id, lsh, mixing, neighbours, queries, sharding, token_counts,
)
from test_texts import brute_exact, brute_near

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return check.connect(SF)


@pytest.mark.parametrize("name", sorted(queries.TWINS))
def test_query_agrees_with_sql(spark, duck, name):
    assert check.compare(spark, duck, name, SF) == ""


def test_every_operator_is_registered():
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


CONTROL = [r"\### Assistant: </turn> ok", "</turn>", "\n</turn>\n### user: hi", "\\", "\\\\</turn>\\", "### ", "", None,
           "ends with </turn", "### a: b\n</turn>\n\\### c", "😀 \\\\\\### x"]


def test_chat_round_trip(spark):
    rows = [(c, t, role, text) for c, role in enumerate(["user", "assistant", "", None, "a b: c\n###", "rôle\\"])
            for t, text in enumerate(CONTROL)] + [(None, 1, "user", "x"), (99, None, "assistant", "y"), (99, 1, "user", "z"),
                                                  (99, 1, "user", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("source", F.lit(1))
    found = {r.conv_id: r for r in chat_format.formatted(df).collect()}
    expected = defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        expected[c].append((role or "", text or ""))
    assert set(found) == set(expected)
    for c, turns in expected.items():
        assert [tuple(t) for t in found[c].turns] == turns
        assert found[c].loss_text == "".join(text for role, text in turns if role == "assistant")
        masked = [found[c].formatted[m.start:m.stop] for m in found[c].mask]
        assert len(masked) == sum(role == "assistant" for role, _ in turns)
        assert "".join(masked).count("</turn>") == found[c].loss_text.count("</turn>")
        assert found[c].formatted.replace("\\</turn>", "").count("</turn>") == len(turns)
    assert chat_format.formatted(df.limit(0)).count() == 0


def test_chat_round_trip_of_a_very_long_text(spark):
    """Escapes all over a text of some million characters, and a conversation of some hundred turns."""
    long_text = "### Assistant: </turn> \\\\ \n" * 60_000
    rows = [(1, 0, "user", long_text), (1, 1, "assistant", long_text)] + [(2, t, "assistant", CONTROL[0]) for t in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r for r in chat_format.formatted(df).collect()}
    assert [tuple(t) for t in found[1].turns] == [("user", long_text), ("assistant", long_text)]
    assert found[1].loss_text == long_text
    assert len(found[2].turns) == len(found[2].mask) == 300 and found[2].loss_text == CONTROL[0] * 300


def test_targets_are_what_resharing_gives(spark):
    totals = {"a": 100, "b": 10, "c": 1000, "d": 0, "e": 500}
    sources = spark.createDataFrame([(s, False, n) for s, n in totals.items()], "src string, none boolean, total long")
    found = {r.src: r.target for r in mixing.targets(mixing.integrated(mixing.default_schedules(sources))).collect()}
    weight = dict(zip(sorted(totals), [3.0, 1.0, 2.0, 3.0, 1.0]))
    left, open_, target = 1.5 * sum(totals.values()), set(totals), {}
    while True:
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        above = {s for s in open_ if share[s] > 2 * totals[s]}
        if not above:
            break
        target |= {s: 2.0 * totals[s] for s in above}
        left -= sum(2.0 * totals[s] for s in above)
        open_ -= above
    assert found == pytest.approx(target | share)


def test_position_inverts_the_schedule(spark):
    times, rates = [0.0, 0.3, 1.0], [2.0, 0.5, 3.0]
    frame = spark.createDataFrame([(q / 100,) for q in range(101)], "q double").withColumns({
        "times": F.array(*map(F.lit, times)), "rates": F.array(*map(F.lit, rates))})
    got = mixing.integrated(frame).withColumn("at", mixing.position(F.col("q"))).collect()
    grid = np.linspace(0, 1, 200001)
    rate = np.interp(grid, times, rates)
    running = np.concatenate([[0], np.cumsum((rate[1:] + rate[:-1]) / 2 * np.diff(grid))])
    for r in got:
        assert r.at == pytest.approx(np.interp(r.q * running[-1], running, grid), abs=1e-5)


@pytest.mark.parametrize("table", ["documents", "odd", "empty"])
def test_mix(request, table):
    docs = request.getfixturevalue(table)
    taken = mixing.taken(docs).collect()
    assert len(taken) == docs.count()
    assert all(0 <= r.taken <= 2 * r.size for r in taken)
    assert Counter(map(tuple, taken)) == Counter(map(tuple, mixing.taken(docs.repartition(5)).collect()))
    mix = mixing.scheduled(docs)
    rows = mix.collect()
    assert mix.columns == [*docs.columns, "mix_position", "mix_copy"]
    assert [r.mix_position for r in rows] == sorted(r.mix_position for r in rows)
    assert all(0 <= r.mix_position <= 1 for r in rows)
    assert Counter(r.doc_id for r in rows) == sum((Counter({r.doc_id: r.copies}) for r in taken), Counter())


def test_mixing_query_counts_what_the_written_mix_holds(spark, documents, monkeypatch):
    written = {}
    settle = mixing.settle
    monkeypatch.setattr(mixing, "settle", lambda df, label: written.setdefault(label, settle(df, label)))
    taken = queries.op8_mixing(spark, SF).collect()
    mix = written["mixing-mix"].withColumn("file", F.input_file_name())
    rows = mix.select("row.*", "at", "file").collect()
    places = defaultdict(list)
    for r in rows:
        places[r.file].append(r.at)
    assert all(p == sorted(p) for p in places.values())
    spans = sorted((p[0], p[-1]) for p in places.values())
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    expected = mixing.scheduled(documents)
    assert Counter((r.doc_id, r.text, r.at) for r in rows) == Counter(
        (r.doc_id, r.text, r.mix_position) for r in expected.collect())
    # a copy that the mix loses is lost to the query
    monkeypatch.setattr(mixing, "settle", lambda df, label: settle(df, label).filter(
        "copy = 1") if label == "mixing-mix" else settle(df, label))
    fewer = {r.doc_id: r.copies for r in queries.op8_mixing(spark, SF).collect()}
    assert max(r.copies for r in taken) == 2 and fewer == {r.doc_id: min(r.copies, 1) for r in taken}


def test_sources_come_near_their_targets(documents):
    rows = mixing.mixed(documents).groupBy("source").agg(
        F.max("target").alias("target"), F.sum(F.col("size") * F.col("copies")).alias("taken"),
        F.max("size").alias("largest")).collect()
    assert all(abs(r.taken - r.target) <= r.largest for r in rows)


@pytest.mark.parametrize("repeated", [7, None])
def test_mix_with_a_repeated_id(spark, repeated):
    """A third of all rows with one id or none is cut into slices like any others."""
    hot = F.col("id") % 3 == 0
    docs = spark.range(9000).select(
        F.when(hot, F.lit(repeated)).otherwise(F.col("id")).cast("bigint").alias("doc_id"),
        F.when(hot, "the same words everywhere").otherwise(F.concat_ws(" ", F.lit("text"), F.col("id"))).alias("text"),
        F.when(F.col("id") % 5 == 0, "b").otherwise("a").alias("source"))
    placed = mixing.mixed(docs)
    slices = placed.groupBy("slice").count().collect()
    assert len(slices) > 4 and max(r["count"] for r in slices) < 2 * 9000 / len(slices)
    starts = sorted((r.source, r.start, r.start + r.size) for r in placed.collect())
    assert all(a[2] == b[1] for a, b in zip(starts, starts[1:]) if a[0] == b[0])
    taken = mixing.taken(docs).collect()
    assert len(taken) == 9000 and sum(r.copies for r in taken) == mixing.scheduled(docs).count()


NAMES = ("tokens", "bpe", "Language", "mix_position", "mix_copy", "shard_number", "shard_slot", "row", "sender", "seq", "key",
         "at", "copies", "packed", "slice")


def test_columns_with_the_names_of_results(spark, documents):
    """Every operator keeps a column of the input that has the name of its result, and gives that another one."""
    docs = documents.limit(30).withColumns({c: F.lit("mine") for c in NAMES})
    pieces = token_counts.pieces_of(queries.tokenizer_file(queries.UNIGRAM_FILE))
    results = {
        "tokens_": token_counts.counted(docs, pieces), "bpe_": bpe_codec.encoded(docs, queries.tokenizer_file(queries.BPE_FILE)),
        "language_": language_id.identified(docs), "mix_position_": mixing.scheduled(docs), "shard_slot_": sharding.sharded(docs)}
    for name, found in results.items():
        assert name in found.columns and found.columns[:len(docs.columns)] == docs.columns
        rows = found.collect()
        assert rows and all(r[c] == "mine" for r in rows for c in NAMES)
    assert language_id.keep_identified(docs).columns == docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    assert docs.count() and docs.columns == [*documents.columns, *NAMES]


@pytest.mark.parametrize("table", ["documents", "odd", "empty"])
def test_shards(request, table):
    docs = request.getfixturevalue(table)
    texts = [r.text or "" for r in docs.select("text").collect()]
    rows = sharding.placements(docs).collect()
    assert Counter((r.size, r.text_crc32) for r in rows) == Counter((len(t.encode()) + 1, zlib.crc32(t.encode())) for t in texts)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) and 0 <= shard < 16 for shard, s in slots.items())


@pytest.mark.parametrize("table", ["documents", "odd", "empty"])
def test_sharded_rows_are_whole_and_in_their_shards_files(request, table):
    docs = request.getfixturevalue(table)
    out = sharding.sharded(docs)
    assert out.columns == [*docs.columns, "shard_number", "shard_slot"]
    rows = out.withColumn("h", F.xxhash64(F.coalesce("text", F.lit("")))).orderBy("shard_number", "shard_slot").collect()
    assert Counter(tuple(r)[:len(docs.columns)] for r in rows) == Counter(map(tuple, docs.collect()))
    files = {int(f.split("/shard=")[1].split("/")[0]) for f in out.inputFiles() if "/shard=" in f}
    assert files == {r.shard_number for r in rows}
    assert [r.h for r in rows] == sorted(r.h for r in rows)  # shards and slots follow the key
    assert Counter((r.doc_id, r.shard_number) for r in rows) == Counter(
        (r.doc_id, r.shard) for r in sharding.placements(docs).collect())


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def plain_key(doc_id: int, text: str) -> tuple[int, int]:
    """The sort key's first two parts, by another implementation of the hash."""
    return (signed(xxhash.xxh64_intdigest(text.encode(), seed=42)),
            signed(xxhash.xxh64_intdigest(doc_id.to_bytes(8, "little", signed=True), seed=42)))


@pytest.mark.parametrize("shards", [16, 5, 1])
def test_shards_against_a_plain_sort(documents, shards):
    """Rows sorted on one machine and cut: the same order, slots, sizes and checksums; borders within the tolerance."""
    rows = [(plain_key(r.doc_id, r.text or ""), r.doc_id, (r.text or "").encode()) for r in documents.collect()]
    rows.sort(key=lambda r: r[0])
    total = sum(len(text) + 1 for _, _, text in rows)
    found = sharding.sharded(documents, shards).orderBy("shard_number", "shard_slot").collect()
    assert [r.doc_id for r in found] == [name for _, name, _ in rows]
    assert [(r.text or "").encode() for r in found] == [text for _, _, text in rows]
    expected_slot, before, last = 0, 0, 0
    for r, (key, _, text) in zip(found, rows):
        if r.shard_number != last:
            assert r.shard_number == last + 1
            # a border lies within the tolerance, or as near to the wanted place as the row that spans it lets it
            wanted = total * r.shard_number / shards
            assert abs(before - wanted) <= max(sharding.TOLERANCE * total / shards, len(text) + 1, previous)
            expected_slot, last = 0, r.shard_number
        assert r.shard_slot == expected_slot
        expected_slot, before, previous = expected_slot + 1, before + len(text) + 1, len(text) + 1
    assert last == shards - 1


@pytest.mark.parametrize("shards", [16, 7])
def test_splitters_count_what_lies_below_them(spark, shards):
    """Exact bytes below each splitter, added up row by row, with a third of the rows one text."""
    docs = spark.range(9000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "the same text everywhere").otherwise(F.concat(F.lit("text "), F.col("id") % 4000)).alias("text"))
    keyed = sharding.keyed(docs, "doc_id", "text").select("size", *sharding.PARTS)
    rows = [(tuple(r)[1:], r.size) for r in keyed.collect()]
    total = sum(size for _, size in rows)
    largest = max(size for _, size in rows)
    cuts = sharding.splitters(keyed, shards)
    assert len(cuts) == shards - 1 and cuts == sorted(cuts)
    for n, cut in enumerate(cuts, 1):
        below = sum(size for key, size in rows if key < tuple(cut))
        # copies of a short text that take little of a shard stay together
        assert abs(below - total * n / shards) <= sharding.TOLERANCE * total / shards + 3 * largest


def test_shards_are_near_equal_with_a_hot_text(spark):
    docs = spark.range(30000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "the same text everywhere").otherwise(F.concat(F.lit("text number "), F.col("id"))).alias("text"))
    sizes = Counter()
    slots = defaultdict(list)
    shards_of = defaultdict(set)
    for r in sharding.placements(docs).collect():
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
        shards_of[r.text_crc32].add(r.shard)
    mean = sum(sizes.values()) / 16
    assert len(sizes) == 16 and max(abs(s - mean) for s in sizes.values()) < 0.01 * mean
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sum(len(s) > 1 for s in shards_of.values()) == 1  # the hot text alone


@pytest.mark.parametrize("whole, parted", [(0.2, False), (0.005, True)])
def test_copies_stay_in_one_shard_up_to_a_part_of_it(spark, whole, parted):
    """On one side of the limit copies stay together, on the other sizes are as near equal as asked."""
    docs = spark.range(16_000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("text of group "), F.floor(F.col("id") / 100)).alias("text"))
    sizes, shards_of = Counter(), defaultdict(set)
    for r in sharding.sharded(docs, whole=whole).collect():
        sizes[r.shard_number] += len(r.text) + 1
        shards_of[r.text].add(r.shard_number)
    mean = sum(sizes.values()) / 16
    assert (max(len(s) for s in shards_of.values()) > 1) == parted
    assert max(abs(s - mean) for s in sizes.values()) < (0.01 if parted else 0.2) * mean


@pytest.mark.parametrize("repeated", [7, None])
def test_shards_are_near_equal_with_a_repeated_row(spark, repeated):
    hot = F.col("id") % 3 == 0
    docs = spark.range(30000).select(
        F.when(hot, F.lit(repeated)).otherwise(F.col("id")).cast("bigint").alias("doc_id"),
        F.when(hot, "the same text everywhere").otherwise(F.concat(F.lit("text number "), F.col("id"))).alias("text"))
    sizes, slots = Counter(), defaultdict(list)
    for r in sharding.placements(docs).collect():
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    mean = sum(sizes.values()) / 16
    assert len(sizes) == 16 and max(abs(s - mean) for s in sizes.values()) < 0.01 * mean
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_probes_come_in_falling_order_and_once():
    hashes = lsh.Tables(np.zeros((1, 3, 4)), np.zeros((1, 3)), 2.0, 1.0, 0.9)
    found = list(lsh.probes(np.array([0.2, 0.5, 0.9]), hashes))
    chances = [c for c, _ in found]
    assert len({o for _, o in found}) == len(found) and chances == sorted(chances, reverse=True)
    assert found[0][1] == (0, 0, 0) and sum(chances) == pytest.approx(1, abs=1e-3)


def brute_neighbours(rows, k=10):
    """Of each query id the results of its rows; a row leaves out itself only."""
    good = [(i, np.array(v, np.float64)) for i, v in rows
            if v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    found = defaultdict(list)
    for place, (q, x) in enumerate(good):
        if q is not None and q % 100 == 0:
            others = [(float(np.sqrt(((v - x) ** 2).sum())), i is None, i) for n, (i, v) in enumerate(good)
                      if n != place and len(v) == len(x)]
            found[q] += [(d, i) for d, _, i in sorted(others, key=lambda o: (o[0], o[1], o[2] or 0))[:k]]
    return {q: sorted(f, key=lambda o: (o[0], o[1] is None, o[1] or 0)) for q, f in found.items()}


def test_neighbours(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    brute = brute_neighbours([(r.vec_id, r.embedding) for r in vectors.collect()])
    found = defaultdict(list)
    for r in queries.op5_nearest_neighbours(spark, "/root/testdata/sf0.1").orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.score, r.vec_id))
    assert set(found) == set(brute) and all(len(f) == 10 and f == sorted(f) for f in found.values())
    assert sum(len(set(found[q]) & set(brute[q])) for q in brute) / sum(map(len, brute.values())) >= 0.9


@pytest.mark.parametrize("jitter", [0.05, 0.02])
def test_neighbours_of_dense_and_diffuse_vectors(spark, tmp_path, jitter):
    rng = np.random.default_rng(3)
    n = 5 * neighbours.SAMPLE
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    dense = unit(rng.standard_normal((20, 64)))[rng.integers(0, 20, n * 6 // 10)] + jitter * rng.standard_normal((n * 6 // 10, 64))
    points = unit(np.concatenate([dense, rng.standard_normal((n * 4 // 10, 64))])).astype(np.float32)
    ids = rng.permutation(n)
    pq.write_table(pa.table({"vec_id": ids, "embedding": list(points)}), tmp_path / "vectors.parquet")
    found = defaultdict(set)
    for r in neighbours.nearest(spark.read.parquet(str(tmp_path / "vectors.parquet")), F.col("vec_id") % 100 == 0).collect():
        found[r.query_id].add(r.vec_id)
    hits = {True: [], False: []}
    wide = points.astype(np.float64)
    for place in np.flatnonzero(ids % 100 == 0):
        distance = ((wide - wide[place]) ** 2).sum(axis=1)
        distance[place] = np.inf
        hits[bool(place < len(dense))].append(len(found[ids[place]] & set(ids[np.argsort(distance)[:10]])) / 10)
    assert all(np.mean(part) >= 0.9 for part in hits.values()), {k: np.mean(v) for k, v in hits.items()}


def test_neighbours_of_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in rng.standard_normal(64)]) for i in range(95, 130)]
    rows += [(200, rows[0][1]), (300 + 1, rows[0][1]), (302, rows[0][1]), (400, None), (500, [0.0] * 64),
             (600, [float("nan")] * 64), (700, [float("inf")] + [1.0] * 63), (None, rows[0][1]), (800, [1.0] * 63 + [None])]
    # repeated ids, with the same vector and with others, and vectors of other lengths
    rows += [(100, rows[5][1]), (100, rows[5][1]), (100, rows[7][1]), (96, rows[3][1]), (96, rows[1][1])]
    rows += [(i, [float(x) for x in rng.standard_normal(3)]) for i in (900, 901, 902, 100)] + [(1000, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("key", F.lit(1))
    for size in (len(rows), 8):
        part = df.limit(0).unionByName(spark.createDataFrame(rows[:size], "vec_id long, embedding array<float>")
                                       .withColumn("key", F.lit(1)))
        exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows[:size]]
        found = defaultdict(list)
        for r in neighbours.nearest(part, F.col("vec_id") % 100 == 0).orderBy("query_id", "score", "rank").collect():
            found[r.query_id].append((r.score, r.vec_id))
        found = {q: sorted(f, key=lambda o: (o[0], o[1] is None, o[1] or 0)) for q, f in found.items()}
        brute = {q: f for q, f in brute_neighbours(exact).items() if f}
        assert set(found) == set(brute)
        assert all(len(found[q]) == len(brute[q]) for q in brute)
        if size == 8:
            assert dict(found) == brute
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_pipeline(spark, documents):
    steps, docs = [], documents
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.settle(stage(spark, docs, SF), "test")
        steps.append(docs)
    known, exact, near, mix, encoded = steps
    assert all(s.columns == documents.columns for s in steps[:4])
    assert known.count() == documents.count()  # all have letters and a clear language
    rows = [tuple(r) for r in known.select("doc_id", "text").collect()]
    assert {r.doc_id for r in exact.select("doc_id").collect()} == {r[0] for r in brute_exact(rows) if r[3]}
    rows = [tuple(r) for r in exact.select("doc_id", "text").collect()]
    assert {r.doc_id for r in near.select("doc_id").collect()} == {r[1] for r in brute_near(rows)}
    copies = {r.doc_id: r.copies for r in mixing.taken(near).collect()}
    assert Counter(r.doc_id for r in mix.select("doc_id").collect()) == Counter({i: n for i, n in copies.items() if n})
    assert encoded.count() == mix.count() and encoded.filter("NOT round_trip").count() == 0
    again = corpus_pipeline.run(spark, SF)
    digest = lambda df: Counter((r.doc_id, r.ids_sha256) for r in df.select("doc_id", "ids_sha256").collect())
    assert digest(again) == digest(encoded)


def test_pipeline_on_odd_and_empty_tables(spark, odd, empty):
    for docs in (odd, empty):
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.settle(stage(spark, docs, SF), "test")
        assert set(docs.columns) >= {"doc_id", "n_tokens", "ids"}


@pytest.mark.parametrize("unlabelled", ["lang", "doc_id"])
def test_pipeline_keeps_texts_where_no_language_is_known(spark, documents, odd, unlabelled):
    for docs in (documents, odd):
        bare = docs.withColumn(unlabelled, F.lit(None).cast(docs.schema[unlabelled].dataType))
        kept = corpus_pipeline.identify_languages(spark, bare, SF)
        lettered = [r.text for r in docs.collect() if r.text and any(c.isalpha() for c in r.text)]
        assert kept.columns == docs.columns and Counter(r.text for r in kept.collect()) == Counter(lettered)
