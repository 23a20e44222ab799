"""How the sources of a language differ in their words, by a frequent-pattern tree of term rows.

A term's row lists the sources that use it, each with its share there, in source order. Equal rows are
counted first; the distinct rows with their multiplicities, range-sorted, are inserted in a tree, a task
at a time. Only one path of the tree is held: when the next row leaves it, the nodes below the fork are
complete, and each adds its multiplicity once for itself and once for each of its ancestors, however many
terms share that path.

The divergence of two sources is summed over all kept terms, most of which neither uses. It is the value
of a term that both lack, times the number of terms, plus a correction for each use by one (a node) and by
both (a node and an ancestor).

Shares are in billionths. All arithmetic is on integers.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from hazardlake.llm.common import column, enter, settle, ship

# Bytes of a term stay, A-Z in lower case; all others part terms. Every byte of a character beyond ASCII is over 127.
PARTED = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or 97 <= c <= 122 else 32 for c in range(256))
MIN_DOCUMENTS = 3
TOP_TERMS = 200
HELD = 500_000  # entries that a task gathers before it sends them on
ONE_DOCUMENT = 1 << 40  # a task's entry counts uses below this bit and documents from it on
EXACT = 2.0 ** 62

COUNTED = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()),
                     ("uses", pa.int64()), ("documents", pa.int64())])
WHOLE = pa.decimal128(38, 0)


# --- counts -----------------------------------------------------------------------------------

def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Uses of each term and documents with it, for each language and source."""
    enter("divergence")
    groups: dict[tuple[str, str], dict[bytes, int]] = defaultdict(dict)
    held = 0

    def send() -> Iterator[pa.RecordBatch]:
        for (lang, source), terms in groups.items():
            n, packed = len(terms), np.fromiter(terms.values(), np.int64, len(terms))
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()),
                pa.array(terms, pa.binary(), size=n).cast(pa.string()),
                pa.array(packed % ONE_DOCUMENT), pa.array(packed // ONE_DOCUMENT)], schema=COUNTED)
        groups.clear()

    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts):
            terms = groups[lang, source]
            held -= len(terms)
            known = terms.get
            for term, n in Counter(text.as_py().translate(PARTED).split()).items():
                terms[term] = known(term, 0) + n + ONE_DOCUMENT
            held += len(terms)
            if held > HELD:
                yield from send()
                held = 0
    yield from send()


def counts(docs: DataFrame, lang_col: str, source_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(lang, source, term, uses, documents), and all occurring groups (lang, source)."""
    ship(docs.sparkSession)
    rows = docs.select(*[F.coalesce(column(c).cast("string"), F.lit("")).alias(n)
                         for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    schema = "lang string, source string, term string, uses long, documents long"
    counted = rows.mapInArrow(_counted, schema).groupBy("lang", "source", "term").agg(
        F.sum("uses").alias("uses"), F.sum("documents").alias("documents"))
    return settle(counted, "divergence-counts"), settle(rows.select("lang", "source").distinct(), "divergence-groups")


# --- shares -----------------------------------------------------------------------------------

def share(count: Column, total: Column) -> Column:
    """1 + floor(1000000000 * count / total), as a long division by thousands: no product leaves 64 bits."""
    found, left = F.lit(0).cast("long"), count
    for _ in range(3):
        left = left * 1000
        found = found * 1000 + F.call_function("div", left, total)
        left = left % total
    return found + 1


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q) of two shares."""
    return F.call_function("div", (p - q) * (p - q), q)


def shares(counted: DataFrame, groups: DataFrame, min_documents: int) -> tuple[DataFrame, DataFrame]:
    """The uses of kept terms with their shares, and the groups with the share of a term that they lack.

    Uses: lang, source, term, p (in the source), p0 (of a term that the source lacks), q (in the language).
    Groups: lang, source, terms (kept in the language), p0.
    """
    kept = settle(counted.groupBy("lang", "term").agg(F.sum("documents").alias("documents"), F.sum("uses").alias("in_lang"))
                  .filter(F.col("documents") >= min_documents).drop("documents"), "divergence-kept")
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("in_lang").alias("lang_uses"))
    used = settle(counted.select("lang", "source", "term", "uses").join(kept, ["lang", "term"]), "divergence-used")
    totals = used.groupBy("lang", "source").agg(F.sum("uses").alias("total"))
    groups = groups.join(langs, "lang", "left").join(totals, ["lang", "source"], "left") \
        .fillna(0, ["terms", "lang_uses", "total"]) \
        .withColumn("p0", F.when(F.col("terms") > 0, share(F.lit(1).cast("long"), F.col("total") + F.col("terms"))))
    groups = settle(groups, "divergence-totals")
    shared = used.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", share(F.col("uses") + 1, F.col("total") + F.col("terms")).alias("p"), "p0",
        share(F.col("in_lang") + 1, F.col("lang_uses") + F.col("terms")).alias("q"))
    return settle(shared, "divergence-shares"), groups.select("lang", "source", "terms", "p0")


# --- the tree ---------------------------------------------------------------------------------

NODES = pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("p", pa.int64()), ("value", WHOLE)])


def _value(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class _Combinations:
    """Node-ancestor combinations of a task, each with the number of terms that share both."""

    def __init__(self):
        self.items: dict[tuple, int] = {}  # (lang, source, p, p0), numbered
        self.ancestors, self.nodes, self.terms = [], [], []
        self.alone: Counter = Counter()

    def number(self, item: tuple) -> int:
        return self.items.setdefault(item, len(self.items))

    def add(self, node: int, ancestors: list[int], terms: int) -> None:
        self.alone[node] += terms
        self.ancestors += ancestors
        self.nodes += [node] * len(ancestors)
        self.terms += [terms] * len(ancestors)

    def __len__(self) -> int:
        return len(self.nodes) + len(self.alone)

    def summed(self) -> list[tuple]:
        """Rows of NODES; what was added is forgotten, numbers stay."""
        items = list(self.items)
        found = [(items[i][0], items[i][1], None, items[i][2], n) for i, n in self.alone.items()]
        if self.nodes:
            groups = {g: nr for nr, g in enumerate(dict.fromkeys(i[:2] for i in items))}
            group = np.array([groups[i[:2]] for i in items])
            p, zero = (np.array([i[k] for i in items], np.int64) for k in (2, 3))
            a, b = np.array(self.ancestors), np.array(self.nodes)
            names = list(groups)
            for a, b in ((a, b), (b, a)):
                # beyond what either use alone changes
                both = _value(p[a], p[b]) - _value(p[a], zero[b]) - _value(zero[a], p[b]) + _value(zero[a], zero[b])
                terms = np.array(self.terms)
                if np.abs(both.astype(float)) @ terms > EXACT:
                    both = both.astype(object)
                order = np.lexsort((group[b], group[a]))
                pairs = np.stack([group[a][order], group[b][order]])
                starts = np.flatnonzero(np.append(True, (np.diff(pairs) != 0).any(axis=0)))
                sums = np.add.reduceat((both * terms)[order], starts)
                found += [(names[x][0], names[x][1], names[y][1], None, int(v)) for (x, y), v in zip(pairs[:, starts].T, sums)]
        self.ancestors, self.nodes, self.terms = [], [], []
        self.alone.clear()
        return found


def _tree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the nodes of a task's part of the tree add up to.

    Rows come sorted by (lang, path), so the open path is all that is kept of the tree. For a source ``a``
    alone, with its share ``p`` there, ``value`` is the number of terms; for two sources, in both directions,
    it is the correction for the terms that both use, and ``p`` is null.
    """
    enter("divergence")
    seen = _Combinations()
    path, multiplicity = [], []

    def close(depth: int) -> None:
        """Complete the nodes below a depth, the deepest first."""
        while len(path) > depth:
            node, n = path.pop(), multiplicity.pop()
            if path:
                multiplicity[-1] += n
            seen.add(node, path, n)

    def send() -> Iterator[pa.RecordBatch]:
        found = seen.summed()
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), NODES)], schema=NODES)

    for batch in batches:
        for lang, items, n in zip(*(c.to_pylist() for c in batch.columns)):
            row = [seen.number((lang, i["source"], i["p"], i["p0"])) for i in items]
            depth = 0
            while depth < min(len(path), len(row)) and path[depth] == row[depth]:
                depth += 1
            close(depth)
            path += row[depth:]
            multiplicity += [0] * (len(row) - depth)
            multiplicity[-1] += n
            if len(seen) > HELD:
                yield from send()
    close(0)
    yield from send()


def pair_values(shared: DataFrame, groups: DataFrame) -> DataFrame:
    """The divergence of each source from each other source of its language: lang, source, other, value."""
    rows = shared.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("source", "p", "p0"))).alias("path")) \
        .groupBy("lang", "path").agg(F.count("*").alias("n"))
    # rows that share a prefix stand together; where a range ends within one, both tasks have their part of its nodes
    ordered = settle(rows, "divergence-rows").repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")
    nodes = settle(ordered.select("lang", "path", "n").mapInArrow(
        _tree, "lang string, a string, b string, p long, value decimal(38,0)"), "divergence-nodes")
    both = nodes.filter("b IS NOT NULL").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    alone = nodes.filter("b IS NULL").groupBy("lang", "a", "p").agg(F.sum("value").alias("n"))
    a = groups.select("lang", F.col("source").alias("a"), "terms", F.col("p0").alias("zero_a"))
    b = groups.select("lang", F.col("source").alias("b"), F.col("p0").alias("zero_b"))
    # one row per two sources that the result has, with the shares of terms that they lack
    zero = a.join(b, "lang").filter("a <> b")
    n = F.col("n")
    none = divergence(F.col("zero_a"), F.col("zero_b"))
    uses = alone.join(a.select("lang", "a", "zero_a"), ["lang", "a"])
    by_first = uses.join(b, "lang").filter("a <> b").select(
        "lang", "a", "b", (n * (divergence(F.col("p"), F.col("zero_b")) - none)).alias("value"))
    turned = uses.select("lang", F.col("a").alias("b"), F.col("zero_a").alias("zero_b"), "p", "n")
    by_second = turned.join(a.drop("terms"), "lang").filter("a <> b").select(
        "lang", "a", "b", (n * (divergence(F.col("zero_a"), F.col("p")) - none)).alias("value"))
    lacked = zero.select("lang", "a", "b", F.coalesce(F.col("terms").cast("decimal(20,0)") * none, F.lit(0)).alias("value"))
    parts = [lacked, by_first, by_second, both]
    summed = [d.select("lang", "a", "b", F.col("value").cast("decimal(38,0)").alias("value")) for d in parts]
    total = summed[0]
    for part in summed[1:]:
        total = total.unionByName(part)
    return total.groupBy("lang", F.col("a").alias("source"), F.col("b").alias("other")).agg(
        F.sum("value").cast("long").alias("value"))


def audited(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
            min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """How far each source of a language is from each other one, and the terms it overuses most.

    Terms are runs of ASCII letters and characters beyond ASCII, A-Z in lower case; a language keeps those of at
    least ``min_documents`` of its documents. A kept term's share is 1 + floor(10^9 (count + 1) / (N + V)), with the
    N uses of the V kept terms there. Rows of part ``pair`` have the divergence from another source, summed over all kept
    terms; rows of part ``term`` the kept terms whose share lies above the language's, the ``top_terms`` of largest
    divergence. Ranks are by value descending, then by the item's bytes.

    Null text, lang and source count as ''. A source without terms is compared like any other; a language that keeps
    no term has pairs of value 0; one with a single source has no pairs. Rows that repeat are documents of their own.
    An empty table gives no rows; other columns do not matter.
    """
    shared, groups = shares(*counts(docs, lang_col, source_col, text_col), min_documents)
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    terms = shared.filter("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        divergence(F.col("p"), F.col("q")).alias("value")).withColumn("rank", F.row_number().over(best)) \
        .filter(F.col("rank") <= top_terms)
    pairs = pair_values(shared, groups).select(
        "lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value") \
        .withColumn("rank", F.row_number().over(best))
    return terms.unionByName(pairs)
