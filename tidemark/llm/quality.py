"""Quality by compression: how much better does a dictionary of good text compress it than one of bad text?

Two zstandard dictionaries are trained on texts of either label. A text is compressed in blocks, all
of it, with each; the difference of the two sizes per byte of text is the one input of a logistic
calibration, which was fitted on texts that the dictionaries of the fit had not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import crc_remainder, documents, give_back, table, trimmed
from tidemark.llm.training import labelled, logistic, sigmoid

MODULUS, HELD, THRESHOLD = 5, 0, 0.3
#: Labelled texts of either label that the fit takes at most, bytes of a dictionary and of a block, and the level.
MOST, DICTIONARY, BLOCK, LEVEL = {0: 1500, 1: 2500}, 65536, 512, 3


@dataclass(frozen=True)
class Model:
    bad: bytes
    good: bytes
    slope: float
    intercept: float


def dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary; with too little text to train on, the text itself."""
    blocks = [t[i : i + BLOCK] for t in texts for i in range(0, len(t), BLOCK)]
    try:
        return zstandard.train_dictionary(DICTIONARY, blocks, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[-DICTIONARY:]


@lru_cache(maxsize=8)
def _compressors(bad: bytes, good: bytes) -> tuple[zstandard.ZstdCompressor, ...]:
    def one(data: bytes) -> zstandard.ZstdCompressor:
        own = zstandard.ZstdCompressionDict(data) if data else None
        if own:
            own.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=own, write_content_size=False, write_dict_id=False, write_checksum=False)

    return one(bad), one(good)


def sizes(text: bytes, bad: bytes, good: bytes) -> tuple[int, int]:
    """Compressed sizes of the whole text, block by block, with the bad and with the good dictionary."""
    blocks = [text[i : i + BLOCK] for i in range(0, len(text), BLOCK)]
    b, g = (sum(len(c.compress(x)) for x in blocks) for c in _compressors(bad, good))
    return b, g


def difference(text: bytes, bad: bytes, good: bytes) -> float:
    """By how much the good dictionary does better, per byte of text; 0 for a text without bytes."""
    b, g = sizes(text, bad, good) if text else (0, 0)
    return (b - g) / max(1, len(text))


def fit(rows: list[tuple[str, int]]) -> Model:
    """Cross-fitted in two halves; without texts of both labels the score is the share of label 1."""
    data = [(t.encode("utf-8", "surrogatepass"), y) for t, y in rows]
    y = np.array([k for _, k in data], float)
    if len(set(y.tolist())) < 2:
        return Model(b"", b"", 0.0, float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))))
    by = lambda part, k: dictionary([t for t, label in part if label == k])
    halves = [[r for i, r in enumerate(data) if i % 4 // 2 == h] for h in (0, 1)]
    dictionaries = [(by(h, 0), by(h, 1)) for h in halves]
    d = np.array([difference(t, *dictionaries[1 - i % 4 // 2]) for i, (t, _) in enumerate(data)])
    scale = float(d.std()) + 1e-9
    w = logistic(d[:, None] / scale, y, 1e-4)
    return Model(by(data, 0), by(data, 1), float(w[0]) / scale, float(w[1]))


def score_quality(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, score (0 to 1, higher is better). Null counts as empty; both get a score. Other columns play no part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = np.array([difference((t.as_py() or "").encode("utf-8", "surrogatepass"), model.bad, model.good) for t in batch.column(1)], np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sigmoid(d * model.slope + model.intercept))], ["_id", "score"])

    rows = df.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    return rows.mapInArrow(trimmed(run), T.StructType([rows.schema["_id"], T.StructField("score", T.DoubleType())])).withColumnRenamed("_id", id_col)


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fits on the labelled rows whose crc32 remainder is not held out and scores all: id, held_out, score, predicted.

    A null id is not held out. Null and empty texts are scored by the calibration alone, as texts on
    which the dictionaries do not differ. Texts of any length are compressed whole. Rows that repeat,
    or share an id, are scored each for itself; an id with both labels counts with both. Other columns
    play no part, whatever their names. Without labels of both kinds the score is the same for all. An
    empty table gives an empty result.
    """
    model = fit(labelled(docs, labels, "quality", MODULUS, HELD, MOST, id_col, text_col))
    give_back()  # the driver's Python lives on beside its JVM
    out = score_quality(docs, model, id_col, text_col)
    held = F.coalesce(crc_remainder(id_col, MODULUS) == HELD, F.lit(False))
    return out.select(id_col, held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op1_quality(spark, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


QUERIES = {"op1_quality": op1_quality}
SQL: dict[str, str] = {}
