"""Token counts of whole texts under a unigram vocabulary."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hazardlake.llm import unigram
from hazardlake.llm.common import column, free, ship


def pieces_of(model_file: str) -> tuple[tuple[str, float], ...]:
    """Pieces and scores of a sentencepiece model file, read on the driver."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=model_file)
    return tuple((model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size()))


def _count(pieces: tuple[tuple[str, float], ...]):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = unigram.counter(pieces)
        for texts in batches:
            found = [counter.count(t.as_py() or "") for t in texts]
            yield pa.StructArray.from_arrays(
                [pa.array([n for n, _ in found], pa.int64()), pa.array([s for _, s in found], pa.float64())],
                names=["n_tokens", "score"])

    return run


def counted(docs: DataFrame, pieces: tuple[tuple[str, float], ...], text_col: str = "text") -> DataFrame:
    """Each row with a struct ``tokens``: the number of tokens of its whole text and their score.

    The segmentation is the best-scoring one of each word, a word being what a space or the start of
    the text begins. Null and empty texts have no tokens. Rows, ties and other columns pass through; where
    ``docs`` has a column ``tokens`` itself, the struct is ``tokens_``.
    """
    ship(docs.sparkSession)
    udf = F.arrow_udf(_count(pieces), "n_tokens long, score double")
    return docs.select("*", udf(column(text_col)).alias(free("tokens", docs)))
