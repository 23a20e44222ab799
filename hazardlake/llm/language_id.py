"""Language identification with error-correcting output codes over hashed byte trigrams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from hazardlake.llm import ecoc
from hazardlake.llm.common import column, enter, free, give_back, settle, ship

PARTS = 64  # of the table of trigrams, each fitted in one group of a row per language
SALTS = 1024  # first-level groups when counts of tasks are added up
AMBIGUOUS_LEAD = 0.25  # of the second codeword's loss over the first's
ROWS = 64  # texts whose counts are in memory at once, 64 kB each

HAS_LETTER = regex.compile(r"\p{L}").search


def held_out(id_col: str) -> Column:
    """Documents that training leaves out; a null id is in neither part."""
    return F.coalesce(F.crc32(column(id_col).cast("string")) % 4 == 2, F.lit(False))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    enter("language")
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
            found = ecoc.trigrams(text)
            if lang in totals:
                totals[lang] += found
            else:
                totals[lang] = found
    if totals:
        yield pa.RecordBatch.from_pydict({"lang": list(totals), "counts": [c.tobytes() for c in totals.values()]})
    give_back()


def _add(group: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(c, np.int64) for c in group["counts"])
    return pd.DataFrame({"lang": group.lang.iloc[:1], "counts": [total.tobytes()]})


def _total(group: pd.DataFrame) -> pd.DataFrame:
    added = _add(group)
    return added.assign(total=[int(np.frombuffer(c, np.int64).sum()) for c in added["counts"]])


def _cut(numbers: dict[str, int]):
    """The counts of each language in parts of the table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = ecoc.TABLE // PARTS
        for batch in batches:
            for lang, counts in zip(batch["lang"].to_pylist(), batch["counts"].to_pylist()):
                table = np.frombuffer(counts, np.int64)
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array(range(PARTS), pa.int32()), "nr": pa.array([numbers[lang]] * PARTS, pa.int32()),
                    "counts": [table[p * width:(p + 1) * width].tobytes() for p in range(PARTS)]})

    return run


def _fit(codes: np.ndarray, totals: np.ndarray):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        rows = group.sort_values("nr")
        counts = np.stack([np.frombuffer(c, np.int64) for c in rows.counts])
        found = ecoc.weigh(counts, totals[rows.nr], codes)
        return pd.DataFrame({"part": rows.part.iloc[:1], **{n: [f.tobytes()] for n, f in zip(("weights", "high", "low"), found)}})

    return run


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> ecoc.Model:
    """Classifiers from all labelled documents that are not held out.

    Each task counts trigrams per language in one array; the arrays are added up in two levels,
    so a language with most of the documents makes no large group. The bits are fitted in Spark, a part of
    the trigrams at a time over all languages, so their number has no limit. The driver gets the names and sizes of the
    languages and the classifiers, whose number grows with the logarithm of that of the languages.
    Without a labelled document the model has no languages.
    """
    labelled = docs.filter(
        column(lang_col).isNotNull() & column(text_col).isNotNull() & column(id_col).isNotNull()
        & ~held_out(id_col)).select(column(lang_col).cast("string").alias("lang"), column(text_col).alias("text"))
    counted = labelled.mapInArrow(_count, "lang string, counts binary")
    salted = counted.withColumn("salt", F.spark_partition_id() % SALTS)
    added = salted.groupBy("lang", "salt").applyInPandas(_add, "lang string, counts binary")
    tables = settle(added.groupBy("lang").applyInPandas(_total, "lang string, counts binary, total bigint"), "languages")
    sizes = sorted((r.lang, r.total) for r in tables.select("lang", "total").collect())
    codes = ecoc.codewords(len(sizes))
    parts = tables.select("lang", "counts").mapInArrow(
        _cut({lang: nr for nr, (lang, _) in enumerate(sizes)}), "part int, nr int, counts binary")
    fitted = parts.groupBy("part").applyInPandas(
        _fit(codes, np.array([total for _, total in sizes], np.int64)), "part int, weights binary, high binary, low binary")
    found = sorted(fitted.collect(), key=lambda r: r.part)
    arrays = [[np.frombuffer(c) for c in (r.weights, r.high, r.low)] for r in found]
    return ecoc.model_of([lang for lang, _ in sizes], codes,
                         [(w.reshape(ecoc.TABLE // PARTS, codes.shape[1]), h, low) for w, h, low in arrays])


def _predict(model: ecoc.Model):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enter("language")
        for texts in batches:
            langs, scores, doubts = [], [], []
            for lo in range(0, len(texts), ROWS):
                part = texts.slice(lo, ROWS).to_pylist()
                known = [bool(t and HAS_LETTER(t)) and bool(model.languages) for t in part]
                best, score, lead = ecoc.predict(model, np.array(
                    [ecoc.trigrams(t) for t, k in zip(part, known) if k]).reshape(-1, ecoc.TABLE)) \
                    if any(known) else ((), (), ())
                found = iter(zip(best, score, lead))
                for k in known:
                    which, sure, ahead = next(found) if k else (-1, 0.0, 0.0)
                    langs.append(model.languages[which] if k else "und")
                    scores.append(float(sure))
                    doubts.append(not k or bool(ahead < AMBIGUOUS_LEAD))
            yield pa.StructArray.from_arrays(
                [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(doubts, pa.bool_())],
                names=["lang", "score", "ambiguous"])
        give_back()

    return run


def predict(docs: DataFrame, model: ecoc.Model, text_col: str = "text") -> DataFrame:
    """Each row with a struct ``language``: the predicted language, its score in 0 to 1, and
    whether the decision is ambiguous, that is whether another codeword is nearly as close.

    The prediction sees the whole text and nothing else. A text that is null or holds no letter is
    ``und`` with score 0, and so is every text where nothing could be learned. Equal texts get
    equal predictions; repeated rows and other columns pass through. Where ``docs`` has a column
    ``language`` itself, the struct is ``language_``.
    """
    ship(docs.sparkSession)
    udf = F.arrow_udf(_predict(model), "lang string, score double, ambiguous boolean")
    return docs.select("*", udf(column(text_col)).alias(free("language", docs)))


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Train on the documents that are not held out, then predict all of them."""
    ship(docs.sparkSession)
    return predict(docs, train(docs, id_col, text_col, lang_col), text_col)


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents whose language is clear, with their columns.

    Rejected are texts without letters and those that lie between two languages. Where no document
    with a label can be learned from, nothing is known of languages and all texts with a letter stay.
    """
    names = docs.columns
    bare = docs.select(F.struct(*[column(c) for c in names]).alias("row")).select("row", "row.doc_id", "row.text", "row.lang")
    ship(docs.sparkSession)
    model = train(bare)
    if model.languages:
        kept = predict(bare, model).filter((F.col("language.lang") != "und") & ~F.col("language.ambiguous"))
    else:
        kept = bare.filter(F.col("text").rlike(r"\p{L}"))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in names])
