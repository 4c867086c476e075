"""Token counts: pieces are counted once per distinct pre-token and joined to the texts' pre-tokens.

A block of texts is cut into pre-tokens; each text's distinct pre-tokens with their frequencies are
joined, by dictionary code, to the table of counts that a worker has made so far, and the products
are summed. No ids are kept. A pre-token is counted once per worker, not once for the whole table:
that would take a shuffle of all documents' frequencies (see the README for its size), and the
counting itself is a small part of the work.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents, trimmed
from tidemark.llm.vocabulary import PieceCounter, tokenizer_path

LIMIT = 4096


@lru_cache(maxsize=2)
def counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def token_counts(df: DataFrame, path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens).

    Null and empty texts have 0 bytes and 0 tokens; texts of any length are counted whole, repeated rows each. The id passes through, null included; other
    columns play no part. An empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = pa.array(counter(path).count(batch.column(1)))
            sizes = pc.cast(pc.fill_null(pc.binary_length(batch.column(1)), 0), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, n, pc.greater(n, limit)], ["_id", "n_bytes", "n_tokens", "over_limit"])

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    return rows.mapInArrow(trimmed(run), f"_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean").withColumnRenamed("_id", id_col)


def op6_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"))


QUERIES = {"op6_token_counts": op6_token_counts}
SQL: dict[str, str] = {}
