"""BPE encoding and decoding of whole texts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hazardlake.llm import bpe
from hazardlake.llm.common import column, enter, free, give_back, ship

FIELDS = {"n_tokens": "long", "ids": "binary", "ids_sha256": "string", "decoded": "string", "decoded_sha256": "string"}
LARGE = ("ids", "decoded")  # fields that come only when asked for
KINDS = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}


def _codec(raw: bytes, fields: dict[str, str]):
    kind = pa.struct([(name, KINDS[of]) for name, of in fields.items()])

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enter("bpe", bpe.encoder.cache_clear)
        codec = bpe.encoder(raw)
        for texts in batches:
            rows = []
            for text in texts:
                ids = codec.encode(text.as_py() or "")
                decoded = codec.decode(ids)
                row = {"n_tokens": len(ids) // 4, "ids": ids, "ids_sha256": hashlib.sha256(ids).hexdigest(),
                       "decoded": decoded, "decoded_sha256": hashlib.sha256(decoded.encode()).hexdigest()}
                rows.append({name: row[name] for name in fields})
            yield pa.array(rows, kind)
        give_back()

    return run


def encoded(docs: DataFrame, vocabulary: str, text_col: str = "text", large: tuple[str, ...] = LARGE) -> DataFrame:
    """Each row with a struct ``bpe``: ids, their number and digest, the decoded text and its digest.

    ``vocabulary`` is the JSON file of a byte-level BPE tokenizer; the driver reads it and sends it
    along. Special strings in a text become their single ids. Null counts as empty and gives
    no ids; rows, ties and other columns pass through as they are; no text is cut. Of the large
    fields ``ids`` and ``decoded`` those in ``large`` are returned. Where ``docs`` has a column ``bpe`` itself, the struct
    is ``bpe_``.
    """
    ship(docs.sparkSession)
    raw = Path(vocabulary).read_bytes()
    fields = {name: of for name, of in FIELDS.items() if name not in LARGE or name in large}
    udf = F.arrow_udf(_codec(raw, fields), ", ".join(f"{name} {of}" for name, of in fields.items()))
    return docs.select("*", udf(column(text_col)).alias(free("bpe", docs)))
