"""What the two trained classifiers share: bounded labelled samples, and a logistic fit."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import crc_remainder

SEED = 11
#: Characters of a labelled text that a fit takes; longer ones are not among its rows.
LONGEST = 30_000


def labelled(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held: int, most: dict[int, int], id_col: str = "doc_id", text_col: str = "text", longest: int = LONGEST) -> list[tuple[str, int]]:
    """At most ``most[y]`` texts with label y, out of the rows that are not held out; the same ones under any partitioning.

    The ids are chosen by a hash, on the labels alone, and an id that several rows share gives the one of them
    that comes first by a hash of its text; texts of more than ``longest`` characters are not among them. So at most
    ``sum(most.values())`` texts of at most that length reach the driver, which bounds its memory. Ids may be
    of any type. An id with both labels counts with each.
    """
    marks = labels.select(F.col(f"`{id_col}`").alias("_id"), F.col(label).cast("int").alias("_y")).filter("_id IS NOT NULL AND _y IN (0, 1)").distinct()
    marks = marks.filter(crc_remainder("_id", modulus) != held)
    order = [F.xxhash64(F.lit(SEED), "_id"), "_id"]
    parts = [marks.filter(F.col("_y") == y).orderBy(*order).limit(n) for y, n in sorted(most.items())]
    chosen = F.broadcast(parts[0].unionByName(parts[1]).select(F.col("_id").cast("string").alias("_of"), "_y"))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("string").alias("_of"), text.alias("_text")).filter(F.length("_text") <= longest).join(chosen, "_of")
    found = rows.groupBy("_of", "_y").agg(F.min(F.struct(F.xxhash64("_text").alias("h"), F.col("_text").alias("text")))["text"].alias("_text")).collect()
    return [(r["_text"], int(r["_y"])) for r in sorted(found, key=lambda r: (len(r["_of"]), r["_of"], r["_y"]))]


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2, steps: int = 60) -> np.ndarray:
    """Weights of a logistic regression by Newton's method; the last one is the intercept and has no penalty."""
    x = np.column_stack([x, np.ones(len(x))])
    w, keep = np.zeros(x.shape[1]), np.append(np.full(x.shape[1] - 1, penalty), 1e-9)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) / len(x) + np.diag(keep), x.T @ (p - y) / len(x) + keep * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))
