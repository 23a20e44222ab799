"""Exact duplicates by a Golomb-coded exchange of fingerprints.

Each writing task (a sender) sends the sorted distinct fingerprints of its rows, Golomb
coded, to the owners of the fingerprint ranges. An owner returns one bitmap to every sender
that holds a fingerprint seen elsewhere, or more than once. Only rows so marked are suspects:
their texts alone are shuffled, grouped by their bytes and confirmed.

A fingerprint is sent once by each sender however often it occurs there, and copies combine
before every shuffle, so a text that holds a third of all rows fills no task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hazardlake.llm import golomb
from hazardlake.llm.common import enter, is_marked, marks_of, settle, ship, stage, unpacked, with_marks, words_of

FINGERPRINT_BITS = 48  # false suspects cost a verification, nothing else

UPPER_TO_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _lowered(value) -> bytes:
    """UTF-8 bytes with A-Z in lower case; no byte of a longer character lies in that range."""
    return (value.as_py() or "").encode().translate(UPPER_TO_LOWER)


def _digest(texts: pa.Array) -> pa.Array:
    enter("exact")
    shas = [hashlib.sha256(_lowered(t)).digest() for t in texts]
    prints = [int.from_bytes(s[:8], "big") >> (64 - FINGERPRINT_BITS) for s in shas]
    return pa.StructArray.from_arrays(
        [pa.array(prints, pa.int64()), pa.array([s.hex() for s in shas], pa.string())], names=["print", "sha"])


def _normal(texts: pa.Array) -> pa.Array:
    return pa.array([_lowered(t) for t in texts], pa.binary())


def _send(owners: int):
    span = 1 << FINGERPRINT_BITS

    def send(group: pd.DataFrame) -> pd.DataFrame:
        prints, counts = np.unique(group.print.to_numpy(), return_counts=True)
        owner = (prints * owners) >> FINGERPRINT_BITS
        edges = np.flatnonzero(np.diff(owner, prepend=-1))
        rows = []
        for lo, hi in zip(edges, [*edges[1:], len(prints)]):
            base = -((-int(owner[lo]) * span) // owners)  # the least fingerprint of this owner
            rows.append((int(owner[lo]), int(group.sender.iloc[0]),
                         golomb.encode(prints[lo:hi] - base, span // owners + 1),
                         np.packbits(counts[lo:hi] > 1).tobytes()))
        return pd.DataFrame(rows, columns=["owner", "sender", "prints", "repeated"])

    return send


def _answer(group: pd.DataFrame) -> pd.DataFrame:
    """The owner's bitmaps: which of the fingerprints that a sender named occur more than once."""
    lists = [golomb.decode(blob) for blob in group.prints]
    sizes = [len(values) for values in lists]
    values, place, seen = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    again = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(group.repeated, sizes)])
    more = (seen > 1) | (np.bincount(place, again, len(values)) > 0)
    flags = np.split(more[place], np.cumsum(sizes)[:-1])
    rows = [(int(sender), int(owner), np.packbits(bits).tobytes())
            for sender, owner, bits in zip(group.sender, group.owner, flags) if bits.any()]
    return pd.DataFrame(rows, columns=["sender", "owner", "bits"])


def _receive(owners: int):
    def receive(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(answers):
            return pd.DataFrame({"sender": pd.Series([], dtype="int32"), "marks": pd.Series([], dtype=object)})
        prints, place = np.unique(rows.print.to_numpy(), return_inverse=True)
        owner = (prints * owners) >> FINGERPRINT_BITS
        flagged = np.zeros(len(prints), bool)
        for who, bits in zip(answers.owner, answers.bits):
            lo, hi = np.searchsorted(owner, [who, who + 1])
            flagged[lo:hi] = np.unpackbits(np.frombuffer(bits, np.uint8), count=hi - lo)
        hits = rows.seq.to_numpy()[flagged[place]]
        return pd.DataFrame({"sender": rows.sender.iloc[:1], "marks": [words_of(hits)]})

    return receive


def _suspect_marks(staged: DataFrame) -> DataFrame:
    """Bitmaps, one per sender, of the rows whose fingerprint is not unique."""
    owners = int(staged.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    prints = staged.select("sender", "seq", F.col("digest.print").alias("print"))
    sent = prints.groupBy("sender").applyInPandas(
        _send(owners), "owner int, sender int, prints binary, repeated binary")
    answers = sent.groupBy("owner").applyInPandas(_answer, "sender int, owner int, bits binary")
    return prints.groupBy("sender").cogroup(answers.groupBy("sender")).applyInPandas(
        _receive(owners), "sender int, marks array<bigint>")


def _resolve(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Staged rows and, for the suspects alone, their verified groups."""
    ship(docs.sparkSession)
    digest = F.arrow_udf(_digest, "print long, sha string")
    staged = stage(docs, "exact", digest=digest(F.col("row").getField(text_col)))
    marks = settle(_suspect_marks(staged), "exact-marks")
    suspects = with_marks(staged, marks).filter(is_marked())
    identity: Column = F.col("row").getField(id_col).alias("id")
    normal = F.arrow_udf(_normal, "binary")
    # each task sends one row per distinct text, with the bytes to be compared
    verified = suspects.select("digest.sha", normal(F.col("row").getField(text_col)).alias("bytes")) \
        .groupBy("sha", "bytes").agg(F.count("*").alias("n")) \
        .groupBy("sha").agg(F.sum("n").alias("group_size"), F.count("*").alias("texts"))
    narrow = suspects.select("sender", "seq", "digest.sha", identity)
    # the largest id stays; among rows that repeat it, the one written last
    last = F.max(F.struct("id", "sender", "seq")).alias("top")
    # written out, so that both sides of the next join are plain shuffles, which AQE splits when skewed
    groups = settle(narrow.groupBy("sha").agg(last).join(verified, "sha"), "exact-groups")
    stays = (F.col("sender") == F.col("top.sender")) & (F.col("seq") == F.col("top.seq"))
    different = F.raise_error(F.lit("different texts share a SHA-256")).cast("boolean")
    found = narrow.join(groups, "sha").select(
        "sender", "seq", "id", F.col("top.id").alias("keep_id"), "group_size",
        F.when(F.col("texts") > 1, different).otherwise(stays).alias("kept"), "sha")
    alone = with_marks(staged, marks, "left").filter(~is_marked()).select(
        "sender", "seq", identity, F.col("row").getField(id_col).alias("keep_id"),
        F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), "digest.sha")
    return staged, found, alone


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the group of equal texts it is in, and whether it stays.

    Texts are equal when identical after lower-casing A-Z only; null counts as empty. The
    row with the largest id stays (a null id is less than any other); of rows that repeat that
    id, exactly one. An empty table gives no rows. Other columns do not matter.
    """
    _, found, alone = _resolve(docs, id_col, text_col)
    return found.unionByName(alone).select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns. Dropped rows are marked, so no text moves again.

    Null texts are equal to empty ones, so one of all these stays; ties, repeated rows and null ids are as in
    :func:`decisions`. An empty table stays empty.
    """
    staged, found, _ = _resolve(docs, id_col, text_col)
    dropped = marks_of(found.filter("NOT kept").select("sender", "seq"))
    return unpacked(with_marks(staged, dropped, "left").filter(~is_marked()))
