"""Secret scanning: fixed patterns and windows of high entropy, in DataFrame functions only.

Candidate strings for the entropy scan are runs of token characters. Over each a window slides one
character at a time; character counts and the sum of c * log2(c) are updated for the character
that enters and the one that leaves, so the entropy of every window costs two updates. A candidate
is a secret when its highest window reaches the limit of its character class and no allowed form
matches it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hazardlake.llm.common import column

# The base patterns.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"  # matches of the open-ended pattern that are shorter are dropped anyway
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
WINDOW = 20
SYMBOLS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-="
# Bits per character in the best window, by character class; a window of 20 can reach 4.32.
LIMITS = {"hex": 3.0, "letters": 4.0, "alnum": 3.6, "base64": 3.8}
ALLOWED = (
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",  # UUIDs
    r"^[0-9]+$",  # plain numbers
    r"^/?(?:[a-z0-9_]+/){2,}[a-z0-9_]+$",  # lower-case paths
    r"EXAMPLE(?:KEY)?$",  # keys of manuals
)
WORDED = r"(?i)[A-Za-z0-9+=]*(?:example|sample|placeholder|abcdefgh|01234567)[A-Za-z0-9+=]*"  # parts with an allowed word
WORDS = r"^[A-Za-z/_-]+$"  # paths and identifiers of letters


def _spans(text: Column, pattern: str, kind: int, value_group: int = 0, least: int = 0) -> Column:
    """Leftmost non-overlapping matches with offsets in code points.

    What lies between the matches comes from splitting at the same pattern, so running sums of both
    lengths give the offsets. The fold keeps the end of the last match.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
    gaps = F.split(text, pattern, -1)
    parts = F.zip_with(F.transform(matches, F.length), F.zip_with(
        F.slice(F.transform(gaps, F.length), 1, F.greatest(F.lit(1), F.size(matches))),
        F.transform(values, F.length), lambda g, v: F.struct(g.alias("gap"), v.alias("value"))),
        lambda m, rest: F.struct(m.alias("match"), rest["gap"].alias("gap"), rest["value"].alias("value")))
    empty = F.expr("CAST(array() AS array<struct<start:bigint,kind:int,stop:bigint>>)")
    found = F.aggregate(
        F.filter(parts, lambda p: p["match"].isNotNull()),
        F.struct(F.lit(0).cast("bigint").alias("at"), empty.alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + p["gap"] + p["match"]).alias("at"),
            F.when(p["value"] >= least, F.array_append(acc["spans"], F.struct(
                (acc["at"] + p["gap"]).alias("start"), F.lit(kind).alias("kind"),
                (acc["at"] + p["gap"] + p["match"]).alias("stop")))).otherwise(acc["spans"]).alias("spans")),
        lambda acc: acc["spans"])
    # most texts have no match; they skip all of this
    return F.when(text.rlike(pattern), found).otherwise(empty)


def _weight(count: Column) -> Column:
    return F.when(count > 0, count * F.log2(count)).otherwise(0.0)


def _entropy(candidate: Column) -> Column:
    """The highest Shannon entropy of a window, in bits per character."""
    codes = F.transform(F.split(candidate, ""), lambda c: F.position(c, F.lit(SYMBOLS)))
    zeros = F.array_repeat(F.lit(0), len(SYMBOLS) + 1)

    def slide(acc: Column, step: Column) -> Column:
        enters, leaves = step["enters"], step["leaves"]
        more = F.get(acc["counts"], enters)
        added = acc["sum"] - _weight(more) + _weight(more + 1)
        fewer = F.get(acc["counts"], leaves) + (enters == leaves).cast("int")
        after = F.when(step["full"], added - _weight(fewer) + _weight(fewer - 1)).otherwise(added)
        counts = F.transform(acc["counts"], lambda n, i: n + (i == enters).cast("int")
                             - (step["full"] & (i == leaves)).cast("int"))
        return F.struct(counts.alias("counts"), after.alias("sum"),
                        F.when(step["ready"], F.least(acc["least"], after)).otherwise(acc["least"]).alias("least"))

    steps = F.transform(codes, lambda c, i: F.struct(
        c.alias("enters"), F.coalesce(F.get(codes, i - WINDOW), F.lit(0)).alias("leaves"),
        (i >= WINDOW).alias("full"), (i >= WINDOW - 1).alias("ready")))
    start = F.struct(zeros.alias("counts"), F.lit(0.0).alias("sum"), F.lit(float("inf")).alias("least"))
    # entropy = log2(w) - sum(c log2 c) / w
    return F.aggregate(steps, start, slide, lambda acc: F.log2(F.lit(float(WINDOW))) - acc["least"] / WINDOW)


def _pieces(run: Column) -> Column:
    """What is judged of a run: long pieces without allowed words."""
    left = F.split(F.regexp_replace(run, WORDED, " "), " ")
    return F.filter(F.flatten(F.transform(
        left, lambda p: F.when(p.rlike(WORDS), F.split(p, "[/_-]")).otherwise(F.array(p)))),
        lambda p: F.length(p) >= WINDOW)


def _limit(candidate: Column) -> Column:
    return F.when(candidate.rlike("^[0-9a-fA-F]+$"), LIMITS["hex"]) \
        .when(candidate.rlike("^[A-Za-z]+$"), LIMITS["letters"]) \
        .when(candidate.rlike("^[A-Za-z0-9]+$"), LIMITS["alnum"]).otherwise(LIMITS["base64"])


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its ``base`` spans and, with those of high entropy, all ``spans``.

    A span has start, kind (a number, see ``KINDS``) and stop; offsets count code points and the end is
    exclusive. Spans stand in the order of start, then kind. An entropy span inside a base span
    is not repeated. Whole texts are scanned; null counts as empty and has no spans. Ids are not
    looked at, so null and repeated ones are kept; other columns do not matter.
    """
    text = F.coalesce(column(text_col), F.lit(""))
    rows = docs.select(column(id_col).alias("id"), text.alias("text"))
    base = F.array_sort(F.concat(
        _spans(F.col("text"), ASSIGN, 0, 2, ASSIGN_VALUE), _spans(F.col("text"), ACCESS, 1),
        _spans(F.col("text"), HEX, 2)))
    found = rows.withColumn("base", base).withColumn("runs", F.filter(
        _spans(F.col("text"), CANDIDATE, 3),
        lambda s: ~F.exists("base", lambda b: (b["start"] <= s["start"]) & (b["stop"] >= s["stop"]))))

    def secret(span: Column) -> Column:
        candidate = F.substring(F.col("text"), (span["start"] + 1).cast("int"),
                                (span["stop"] - span["start"]).cast("int"))
        allowed = F.lit(False)
        for form in ALLOWED:
            allowed = allowed | candidate.rlike(form)
        return F.when(allowed, F.lit(False)).otherwise(
            F.exists(_pieces(candidate), lambda piece: _entropy(piece) >= _limit(piece)))

    return found.select("id", "base", F.array_sort(F.concat("base", F.filter("runs", secret))).alias("spans"))


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def digests(docs: DataFrame) -> DataFrame:
    def number(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    return scanned(docs).select(
        F.col("id").alias("doc_id"), number(0).alias("n_assign"), number(1).alias("n_access"),
        number(2).alias("n_hex"), F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"))
