"""Approximate nearest neighbours by multiprobe p-stable hashing.

Every vector is put in one bucket per table. A query visits its own and perturbed buckets in the
order of the estimated chance that they hold a neighbour, until the chances add up to the
wanted success for neighbours at the sample's typical distance. Queries whose k-th neighbour is
farther away than that go on probing for the distance they found, and are compared with all rows
where that takes too many buckets. Buckets are stored in blocks of bounded size, queries that visit a bucket
come in blocks too, and a task compares a block of the one with a block of the other; only the
best of each query and block leave it. Distances are exact, on the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from hazardlake.llm import lsh
from hazardlake.llm.common import column, settle, ship

SAMPLE = 2000  # vectors that the hash parameters are fitted to
BUCKET = 1024  # rows per bucket that the number of hash functions aims at: four blocks
BLOCK = 256  # vectors or queries in a block
BUFFER = 200_000  # results that a task merges before it passes them on
TABLES = 4
PROBES = 512  # buckets of a table that a query visits at most in a round; beyond, it is compared with all
PART = 16 * BUCKET  # rows in a part of the exact pass
FARTHEST = 16  # in widths of a cell: queries whose k-th neighbour is farther away are compared with all
RECALL = 0.97


def usable(vector: Column) -> Column:
    """Not null, not zero, all components there and finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0.0), F.lit(False))


def _matrix(values: pa.Array | pa.ChunkedArray) -> np.ndarray:
    lists = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(lists), -1) if len(lists) else np.empty((0, 0))


def _index(hashes: lsh.Tables):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells, _ = lsh.buckets(_matrix(batch["vector"]), hashes)
                keys = lsh.key(cells)
                for table in range(keys.shape[1]):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(keys), table, np.int32)), pa.array(keys[:, table]),
                         batch["at"], batch["ids"], batch["vector"]], names=["t", "key", "at", "ids", "vector"])

    return run


def _visit(hashes: lsh.Tables, limit: int):
    """The buckets of each query. Table -1 stands for a comparison with all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cells, inside = lsh.buckets(_matrix(batch["vector"]), hashes)
            for row in range(batch.num_rows):
                names, keys = [], []
                for table in range(cells.shape[1]):
                    offsets = lsh.visited(inside[row, table], hashes, limit)
                    if offsets is None:
                        names, keys = [-1], [np.zeros(1, np.int64)]
                        break
                    keys.append(lsh.key(cells[row, table] + np.array(offsets, np.int64)))
                    names += [table] * len(offsets)
                one = pa.array(np.full(len(names), row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int32()), pa.array(np.concatenate(keys)), batch["query"].take(one)],
                    names=["t", "key", "query"])

    return run


def _revisit(hashes: lsh.Tables, limit: int):
    """Further buckets of each query for its own radius. Table -1 stands for a comparison with all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cells, inside = lsh.buckets(_matrix(batch["vector"]), hashes)
            for row, radius in enumerate(batch["radius"].to_pylist()):
                own, names, keys = hashes._replace(radius=radius), [], []
                for table in range(cells.shape[1]):
                    wider = None
                    if radius <= FARTHEST * hashes.width:
                        wider = lsh.visited(inside[row, table], own, limit)
                    if wider is None:
                        names, keys = [-1], [np.zeros(1, np.int64)]
                        break
                    # those of a query of this round were within the limit in the first one
                    before = set(lsh.visited(inside[row, table], hashes))
                    fresh = [offset for offset in wider if offset not in before]
                    if fresh:
                        keys.append(lsh.key(cells[row, table] + np.array(fresh, np.int64)))
                        names += [table] * len(fresh)
                if names:
                    one = pa.array(np.full(len(names), row))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names, pa.int32()), pa.array(np.concatenate(keys)), batch["query"].take(one)],
                        names=["t", "key", "query"])

    return run


NAMES = ["query", "vec_id", "at", "place", "score"]
FOUND = "query bigint, vec_id bigint, at bigint, place int, score double"
NONE = np.iinfo(np.int64).max  # stands for a null id inside a task; place and the mask tell it from a real one


def _top(found: list[np.ndarray], k: int) -> list[np.ndarray]:
    """Of queries, ids, entries, places in them, distances and null marks: the k nearest rows of each query, each once."""
    query, vector, at, place, score, null = found
    order = np.lexsort((place, at, vector, null, score, query))
    query, vector, at, place, score, null = (c[order] for c in found)
    fresh = np.ones(len(query), bool)
    fresh[1:] = (query[1:] != query[:-1]) | (at[1:] != at[:-1]) | (place[1:] != place[:-1])
    query, vector, at, place, score, null = (c[fresh] for c in (query, vector, at, place, score, null))
    starts = np.flatnonzero(np.diff(query, prepend=query[0] - 1)) if len(query) else np.empty(0, np.int64)
    rank = np.arange(len(query)) - np.repeat(starts, np.diff(np.append(starts, len(query))))
    return [c[rank < k] for c in (query, vector, at, place, score, null)]


def _batch(found: list[np.ndarray]) -> pa.RecordBatch:
    query, vector, at, place, score, null = found
    return pa.RecordBatch.from_arrays(
        [pa.array(query), pa.array(vector, mask=null), pa.array(at), pa.array(place, pa.int32()), pa.array(score)], names=NAMES)


def _compare(k: int):
    def pairs(batch: pa.RecordBatch) -> Iterator[list[np.ndarray]]:
        for rows, visitors in zip(batch["rows"], batch["visitors"]):
            ids = [r["ids"].as_py() for r in rows]
            x = _matrix(rows.values.field("vector"))
            owner = np.repeat(np.arange(len(ids)), [len(i) for i in ids])
            place = np.concatenate([np.arange(len(i)) for i in ids])
            null = np.array([j is None for i in ids for j in i])
            flat = np.array([NONE if j is None else j for i in ids for j in i], np.int64)
            at = rows.values.field("at").to_numpy()[owner]
            q = _matrix(visitors.values.field("vector"))
            names = visitors.values.field("query_id").to_pylist()
            for query, name, vector in zip(visitors.values.field("query").to_pylist(), names, q):
                distance = np.sqrt(((x - vector) ** 2).sum(axis=1))[owner]
                # of the rows that repeat the query's vector and id, one is the query
                itself = (null if name is None else ~null & (flat == name)) & (x == vector).all(axis=1)[owner]
                other = np.ones(len(flat), bool)
                other[np.flatnonzero(itself)[:1]] = False
                columns = [c[other] for c in (flat, at, place, distance, null)]
                best = np.lexsort((columns[2], columns[1], columns[0], columns[4], columns[3]))[:k]
                yield [np.full(len(best), query, np.int64), *[c[best] for c in columns]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # results of a query in several blocks are merged here, as far as a bounded buffer goes
        held, size = [], 0
        for batch in batches:
            for part in pairs(batch):
                held.append(part)
                size += len(part[0])
                if size >= BUFFER:
                    merged = _top([np.concatenate(c) for c in zip(*held)], k)
                    held, size = [merged], len(merged[0])
                    if size >= BUFFER // 2:
                        yield _batch(merged)
                        held, size = [], 0
        if held:
            yield _batch(_top([np.concatenate(c) for c in zip(*held)], k))

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k nearest of each query; the limit applies before and after the shuffle."""
    order = Window.partitionBy("query").orderBy("score", F.col("vec_id").asc_nulls_last(), "at", "place")
    return found.groupBy("query", "at", "place").agg(F.min("score").alias("score"), F.first("vec_id").alias("vec_id")) \
        .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _blocks(members: DataFrame, keys: list[str], identity: str, name: str, fields: list[str]) -> DataFrame:
    """Members of each key in lists of about a block's size, however many there are."""
    counts = members.groupBy(*keys).agg(F.count("*").alias("n"))
    part = F.pmod(F.xxhash64(identity), F.ceil(F.col("n") / BLOCK)).alias("block")
    return members.join(counts, keys).select(*keys, part, F.struct(*fields).alias("m")) \
        .groupBy(*keys, "block").agg(F.collect_list("m").alias(name)).drop("block")


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id",
            vector_col: str = "embedding", recall: float = RECALL) -> DataFrame:
    """The k nearest of each query row among all other rows, by Euclidean distance.

    Columns: query_id, rank from 1, vec_id, score. Ties go to the smaller id, null ids last. Vectors that are null,
    zero or not finite throughout take no part. Vectors are compared with those of their length, one search
    for each length. Every row counts, also where ids are null or repeat: a query row leaves out itself only, and query
    rows that repeat id and vector have the same results, once for each.
    Equal vectors are one entry of the index with the k + 1 least of their ids, which is all that
    any result can hold. A query whose k-th neighbour found lies beyond the radius of the sample goes on
    probing for that distance. One that needs more than ``PROBES`` buckets of a table, or for which probing finds
    fewer than k, is compared with all rows. An empty table gives no rows.
    """
    ship(vectors.sparkSession)
    rows = vectors.select(column(id_col).cast("bigint").alias("id"), column(vector_col).alias("vector"),
                          F.coalesce(is_query, F.lit(False)).alias("is_query")).filter(usable(F.col("vector")))
    lengths = rows.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n"), F.max("is_query").alias("asked")) \
        .filter("asked").orderBy("d").collect()
    found = [_nearest(rows.filter(F.size("vector") == r.d), r.d, r.n, k, recall) for r in lengths]
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole


def _nearest(rows: DataFrame, dimension: int, total: int, k: int, recall: float) -> DataFrame:
    """Of ``total`` rows (id, vector, is_query) with vectors of one length."""
    sample = rows.select("vector", F.xxhash64("id", "vector").alias("h")).orderBy("h").limit(SAMPLE).select("vector").collect()
    points = np.array([r.vector for r in sample], np.float64).reshape(-1, dimension)
    hashes = lsh.tables_for(points, total, k, BUCKET, TABLES, recall, PROBES)

    # the least ids of equal vectors; the rank filter runs before the shuffle too
    first = Window.partitionBy("vector").orderBy(F.col("id").asc_nulls_last())
    few = rows.select("vector", "id").withColumn("r", F.row_number().over(first)).filter(F.col("r") <= k + 1)
    entries = few.groupBy("vector").agg(F.array_sort(F.collect_list(F.struct("r", "id"))).alias("ids")) \
        .select(F.monotonically_increasing_id().alias("at"), F.transform("ids", lambda i: i["id"]).alias("ids"), "vector")
    # a task numbers its entries and writes them for all tables, so that an entry has one number throughout
    indexed = entries.mapInArrow(
        _index(hashes), f"t int, key bigint, at bigint, ids array<bigint>, vector {rows.schema['vector'].dataType.simpleString()}")
    stored = settle(_blocks(settle(indexed, "lsh-index"), ["t", "key"], "at", "rows", ["at", "ids", "vector"]), "lsh-blocks")

    asked = rows.filter("is_query").groupBy("id", "vector").agg(F.count("*").alias("copies"))
    queries = settle(asked.select(F.monotonically_increasing_id().alias("query"), F.col("id").alias("query_id"), "vector", "copies"),
                     "lsh-queries")
    visits = settle(queries.mapInArrow(_visit(hashes, PROBES), "t int, key bigint, query bigint"), "lsh-visits")

    def probed(visits: DataFrame) -> DataFrame:
        # buckets that hold nothing are not visited
        held = visits.join(stored.select("t", "key").distinct(), ["t", "key"], "left_semi")
        visitors = _blocks(held.join(queries, "query"), ["t", "key"], "query", "visitors", ["query", "query_id", "vector"])
        compared = visitors.join(stored, ["t", "key"]).select("rows", "visitors").mapInArrow(_compare(k), FOUND)
        return settle(_best(compared, k), "lsh-found")

    near = probed(visits.filter("t >= 0"))
    # the k-th distance found is not below the true one, so probing for it is enough
    reached = near.filter(F.col("rank") == k).select("query", F.col("score").alias("radius"))
    again = settle(queries.join(reached.filter(F.col("radius") > hashes.radius), "query").mapInArrow(
        _revisit(hashes, min(PROBES, -(-total // BUCKET))), "t int, key bigint, query bigint"), "lsh-again")
    wider = probed(again.filter("t >= 0"))

    # an exact pass, in blocks, for queries that found too few or would need too many buckets
    enough = reached.select("query").join(again.filter("t < 0").select("query"), "query", "left_anti")
    found = _best(near.join(enough, "query", "left_semi").drop("rank").unionByName(wider.drop("rank")), k)
    poor = settle(queries.join(enough, "query", "left_anti"), "lsh-poor")
    left = poor.count()
    if left:
        # blocks of queries go to every part, of which there are as many as the rows ask for
        parts = -(-total // PART)
        visitors = poor.groupBy(F.pmod(F.xxhash64("query"), F.lit(-(-left // BLOCK))).alias("block")).agg(
            F.collect_list(F.struct("query", "query_id", "vector")).alias("visitors"))
        everywhere = visitors.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        one_table = stored.filter("t = 0").withColumn(
            "part", F.pmod(F.xxhash64("key", F.get("rows", F.lit(0)).getField("at")), F.lit(parts)))
        rest = everywhere.join(one_table, "part").select("rows", "visitors").mapInArrow(_compare(k), FOUND)
        found = found.unionByName(_best(rest, k))
    # each copy of a query row has the results
    return found.join(queries.select("query", "query_id", "copies"), "query") \
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))) \
        .select("query_id", "rank", "vec_id", "score")
