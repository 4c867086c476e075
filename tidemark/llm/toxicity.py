"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A step of the network is a word. Its input is a word embedding (common words of the training texts,
one more for all others) beside the mean of embeddings of the word's character trigrams, so that
forms never seen still look like their relatives. Two gated recurrent units read a window in either
direction, attention pools their states, and a logit comes out per window. All windows of a text
are scored, each overlapping the next by half; the text's logit is the largest, calibrated.

Texts are labelled, windows are not: training starts from the windows of toxic texts that hold the
most telling trigrams, then the network itself picks the windows, and the most toxic windows of
clean texts are added to the negatives.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import crc_remainder, documents, give_back, table, trimmed, unpacked, whole_row
from tidemark.llm.training import labelled, logistic, sigmoid
from tidemark.llm.vocabulary import Remembered, blocks, words_of

MODULUS, HELD, THRESHOLD = 4, 2, 0.3
#: Labelled texts of either label that the fit takes at most.
MOST = {0: 1800, 1: 900}
WINDOW, STRIDE = 12, 6
WORDS, TRIGRAMS, WORD_DIM, CHAR_DIM, HIDDEN, ATTENTION = 4000, 4096, 8, 12, 12, 8
SEED, BATCH, RATE, DECAY, ROUNDS = 5, 256, 0.01, 0.05, ((6, 4), (4, 4), (4, 4), (4, 4))
#: Windows scored at a time, and words that a worker remembers.
AT_ONCE = 1024


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Like ``words_of``, at all white space; white space with a tab or line break in it is one space."""
    return words_of(pc.replace_substring_regex(texts, r"[\x20\x09-\x0D]*[\x09-\x0D][\x20\x09-\x0D]*", " "))


def plain(words: pa.Array) -> pa.Array:
    """Words in lower case, letters and digits only."""
    return pc.replace_substring_regex(pc.utf8_lower(words), r"[^\p{L}\p{N}]+", "")


def trigrams(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte trigrams of all words, with a mark at either end, and where each word's begin (one more at the end)."""
    marked = pc.binary_join_element_wise("<", words, ">", "")
    sizes = pc.binary_length(marked).to_numpy().astype(np.int64)
    if not len(marked):
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    data = np.frombuffer("".join(marked.to_pylist()).encode("utf-8", "surrogatepass"), np.uint8).astype(np.int64)
    code = ((data[:-2] * 31 + data[1:-1]) * 131 + data[2:]) * 2654435761 % 4294967296 >> 12
    counts = np.maximum(sizes - 2, 0)
    starts = np.cumsum(sizes) - sizes
    offsets = np.concatenate([[0], np.cumsum(counts)])
    where = np.repeat(starts - offsets[:-1], counts) + np.arange(offsets[-1])
    return code[where] % TRIGRAMS if len(where) else np.zeros(0, np.int64), offsets


def windows(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts of so many words: each window's text, first word (in all texts' words) and number of words."""
    counts = np.maximum(1, -(-(sizes - WINDOW) // STRIDE) + 1)
    text = np.repeat(np.arange(len(sizes)), counts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    first = nth * STRIDE
    return text, first + np.repeat(np.cumsum(sizes) - sizes, counts), np.minimum(WINDOW, sizes[text] - first)


@dataclass
class Network:
    """Parameters by name; ``vocabulary`` are the words that have an embedding of their own."""

    vocabulary: list[str]
    p: dict[str, np.ndarray]
    calibration: tuple[float, float] = (1.0, 0.0)

    @staticmethod
    def new(vocabulary: list[str], rng: np.random.Generator) -> Network:
        d, h = WORD_DIM + CHAR_DIM, HIDDEN
        shapes = {"word": (len(vocabulary) + 1, WORD_DIM), "char": (TRIGRAMS, CHAR_DIM), "v": (ATTENTION,), "out": (2 * h,)}
        shapes |= {k + s: x for s in "fb" for k, x in {"w": (d, 3 * h), "u": (h, 3 * h)}.items()} | {"att": (2 * h, ATTENTION)}
        scale = {"word": 0.1, "char": 0.1}
        p = {k: (rng.standard_normal(s) * scale.get(k, 1 / np.sqrt(s[0]))).astype(np.float32) for k, s in shapes.items()}
        p |= {"cf": np.zeros(3 * h, np.float32), "cb": np.zeros(3 * h, np.float32), "ca": np.zeros(ATTENTION, np.float32), "bias": np.full(1, -2.0, np.float32)}
        return Network(vocabulary, p)

    def embed(self, ids: np.ndarray, grams: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Inputs of distinct words: the word's embedding beside the mean over its trigrams."""
        counts = np.diff(offsets)
        padded = np.append(grams, 0)  # one more sum ends the last word's; it is dropped
        mean = np.add.reduceat(self.p["char"][padded], offsets, axis=0)[:-1]
        mean = mean / np.maximum(counts, 1)[:, None] * (counts > 0)[:, None]
        return np.concatenate([self.p["word"][ids], mean.astype(np.float32)], axis=1)

    def run(self, x: np.ndarray, mask: np.ndarray | None, keep: list | None = None) -> np.ndarray:
        """Logits of windows; ``x`` holds inputs by step, window and dimension, ``mask`` is 0 beyond a window's end."""
        p, h, (steps, n, _) = self.p, HIDDEN, x.shape
        states = np.empty((steps, n, 2 * h), np.float32)
        # Both directions at once: step i of the second is the text's step steps - 1 - i.
        flat = x.reshape(-1, x.shape[2])
        ahead = (flat @ p["wf"] + p["cf"]).reshape(steps, n, 3 * h)
        back = (flat @ p["wb"] + p["cb"]).reshape(steps, n, 3 * h)
        u, s = np.stack([p["uf"], p["ub"]]), np.zeros((2, n, h), np.float32)
        for t in range(steps):
            other = steps - 1 - t
            g = s @ u
            zr = np.stack([ahead[t, :, : 2 * h], back[other, :, : 2 * h]])
            zr += g[:, :, : 2 * h]
            zr *= 0.5
            np.tanh(zr, out=zr)
            zr *= 0.5
            zr += 0.5
            z, r = zr[:, :, :h], zr[:, :, h:]
            c = r * g[:, :, 2 * h :]
            c[0] += ahead[t, :, 2 * h :]
            c[1] += back[other, :, 2 * h :]
            np.tanh(c, out=c)
            new = s - c
            new *= z
            new += c
            if mask is not None:
                new = s + np.stack([mask[t], mask[other]])[:, :, None] * (new - s)
            if keep is not None:
                keep.append((t, other, s, z, r, c, g[:, :, 2 * h :]))
            s = new
            states[t, :, :h], states[other, :, h:] = s[0], s[1]
        a = np.tanh(states.reshape(-1, 2 * h) @ p["att"] + p["ca"])
        e = np.exp((a @ p["v"]).reshape(steps, n))
        if mask is not None:
            e = e * mask
        w = e / (e.sum(0) + 1e-9)
        pooled = np.einsum("tn,tnh->nh", w, states, optimize=False)
        if keep is not None:
            keep += [a, w, states, pooled]
        return pooled @ p["out"] + p["bias"]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, float]:
        """Gradients of the mean log loss for the parameters past the embeddings, and for the inputs."""
        p, h, (steps, n, _) = self.p, HIDDEN, x.shape
        keep: list = []
        logit = self.run(x, mask, keep)
        q = _sigmoid(logit)
        loss = float(-(y * np.log(q + 1e-7) + (1 - y) * np.log(1 - q + 1e-7)).mean())
        pooled, states, w, a = keep.pop(), keep.pop(), keep.pop(), keep.pop()
        d = (q - y) / n
        g = {"out": pooled.T @ d, "bias": d.sum(keepdims=True)}
        dp = d[:, None] * p["out"]
        ds = w[:, :, None] * dp
        dw = (states * dp).sum(2)
        de = w * (dw - (w * dw).sum(0))
        da = (de.reshape(-1, 1) * p["v"]) * (1 - a * a)
        g |= {"v": a.T @ de.ravel(), "att": states.reshape(-1, 2 * h).T @ da, "ca": da.sum(0)}
        ds = ds + (da @ p["att"].T).reshape(steps, n, 2 * h)
        dx = np.zeros_like(x)
        back = np.zeros((2, n, h), np.float32)
        u, w2 = np.stack([p["uf"], p["ub"]]), np.stack([p["wf"], p["wb"]])
        du, dw2, dc2 = np.zeros_like(u), np.zeros_like(w2), np.zeros((2, 3 * h), np.float32)
        for _ in range(steps):
            t, other, s, z, r, c, gn = keep.pop()
            new = back + np.stack([ds[t, :, :h], ds[other, :, h:]])
            m = np.stack([mask[t], mask[other]])[:, :, None]
            inner, straight = new * m, new * (1 - m)
            dc = inner * (1 - z) * (1 - c * c)
            dz, dr = inner * (s - c) * z * (1 - z), dc * gn * r * (1 - r)
            pre = np.concatenate([dz, dr, dc], axis=2)
            own = np.concatenate([dz, dr, dc * r], axis=2)
            back = straight + inner * z + own @ u.transpose(0, 2, 1)
            du += s.transpose(0, 2, 1) @ own
            dw2[0] += x[t].T @ pre[0]
            dw2[1] += x[other].T @ pre[1]
            dc2 += pre.sum(1)
            dx[t] += pre[0] @ w2[0].T
            dx[other] += pre[1] @ w2[1].T
        g |= {"uf": du[0], "ub": du[1], "wf": dw2[0], "wb": dw2[1], "cf": dc2[0], "cb": dc2[1]}
        return g, dx, loss


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Inputs(Remembered):
    """Inputs of words by code."""

    def __init__(self, network: Network) -> None:
        self.network, self.vocabulary = network, pa.array(network.vocabulary, pa.string())
        super().__init__()

    def clear(self) -> None:
        super().clear()
        self.x = np.zeros((0, WORD_DIM + CHAR_DIM), np.float32)

    def learn(self, new: pa.Array) -> None:
        words = plain(new)
        ids = pc.fill_null(pc.index_in(words, value_set=self.vocabulary), len(self.vocabulary)).to_numpy()
        self.x = np.concatenate([self.x, self.network.embed(ids, *trigrams(words))])

    def codes_of(self, strings: pa.Array) -> np.ndarray:
        if len(self.known) > 150_000:  # an input is larger than a number of tokens
            self.clear()
        return super().codes_of(strings)


def text_logits(inputs: Inputs, texts: pa.Array) -> np.ndarray:
    """The largest logit over all windows of each text."""
    out = np.zeros(len(texts))
    for at, part in blocks(texts):
        words, offsets = split(part)
        codes, sizes = inputs.codes_of(words), np.diff(offsets)
        text, first, many = windows(sizes)
        order = np.argsort(many, kind="stable")[::-1]
        logits = np.empty(len(text), np.float32)
        steps = np.arange(WINDOW)
        for low in range(0, len(order), AT_ONCE):
            k = order[low : low + AT_ONCE]
            longest = int(many[k[0]])
            mask = None if many[k[-1]] == longest else (steps[:longest, None] < many[k][None, :]).astype(np.float32)
            where = np.minimum(first[k][None, :] + steps[:longest, None], len(codes) - 1)
            logits[k] = inputs.network.run(inputs.x[codes[where]], mask)
        out[at : at + len(part)] = np.maximum.reduceat(logits, np.searchsorted(text, np.arange(len(part))))
    return out


def train(rows: list[tuple[str, int]], seed: int = SEED) -> Network | float:
    """The network, or a constant score where the texts don't have both labels."""
    y_text = np.array([y for _, y in rows], np.int64)
    if len(set(y_text.tolist())) < 2:
        return float((y_text.sum() + 1) / (len(y_text) + 2)) if len(rows) else 0.0
    rng = np.random.default_rng(seed)
    texts = pa.array([t for t, _ in rows], pa.string())
    words, offsets = split(texts)
    coded = plain(words).dictionary_encode()
    code, distinct = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    word_text = np.repeat(np.arange(len(rows)), np.diff(offsets))
    grams, gram_at = trigrams(distinct)
    # Words of the vocabulary are in at least three texts.
    pairs = np.unique(code * len(rows) + word_text)
    texts_with = np.bincount(pairs // len(rows), minlength=len(distinct))
    common = np.argsort(-texts_with, kind="stable")[:WORDS]
    common = common[texts_with[common] >= 3]
    network = Network.new([w.as_py() for w in distinct.take(pa.array(common))], rng)
    ids = np.full(len(distinct), len(common), np.int64)
    ids[common] = np.arange(len(common))
    text, first, many = windows(np.diff(offsets))
    steps = np.arange(WINDOW)
    held_words = code.astype(np.int32)[np.minimum(first[:, None] + steps, len(code) - 1)]
    mask = (steps < many[:, None]).astype(np.float32)
    # Log odds of words and trigrams over texts choose the first windows; the network never sees them.
    toxic = y_text == 1
    share = toxic.mean()
    odds = lambda n1, n0: np.log((n1 + share) / (n0 + 1 - share)) - np.log(share / (1 - share))
    hot = toxic[pairs % len(rows)]
    by_word = odds(np.bincount(pairs[hot] // len(rows), minlength=len(distinct)), np.bincount(pairs[~hot] // len(rows), minlength=len(distinct)))
    # Pairs of text and trigram, in parts, as texts hold many.
    parts = (pairs[i : i + 200_000] for i in range(0, len(pairs), 200_000))
    gram_pairs = np.unique(np.concatenate([np.unique((k % len(rows)).repeat(np.diff(gram_at)[k // len(rows)]) * TRIGRAMS + _ragged(grams, gram_at, k // len(rows))) for k in parts]))
    hot = toxic[gram_pairs // TRIGRAMS]
    by_gram = odds(np.bincount(gram_pairs[hot] % TRIGRAMS, minlength=TRIGRAMS), np.bincount(gram_pairs[~hot] % TRIGRAMS, minlength=TRIGRAMS))
    sums = np.concatenate([[0], np.cumsum(by_gram[grams])])
    telling = np.where(texts_with >= 3, by_word, 0) + (sums[gram_at[1:]] - sums[gram_at[:-1]]) / np.maximum(np.diff(gram_at), 1)
    value = np.where(mask > 0, telling.astype(np.float32)[held_words], np.float32(-9.0)).max(1).astype(np.float64)
    held = rng.random(len(rows)) < 0.25 if toxic.sum() >= 24 else np.zeros(len(rows), bool)
    for round_, (epochs, negatives) in enumerate(ROUNDS):
        best = np.full(len(rows), -np.inf)
        np.maximum.at(best, text, value)
        own = toxic[text] & ~held[text]
        positive = np.flatnonzero(own & (value >= best[text] - (0.3 if round_ == 0 else 1.0)) & (value > 0 if round_ else True))
        clean = np.flatnonzero(~toxic[text] & ~held[text])
        hard = clean[np.argsort(-value[clean], kind="stable")[: 2 * len(positive)]]
        negative = np.concatenate([rng.choice(clean, min(len(clean), negatives * len(positive) + 1000), replace=False), hard])
        some, label = np.concatenate([positive, negative]), np.concatenate([np.ones(len(positive), np.float32), np.zeros(len(negative), np.float32)])
        _fit(network, some, label, held_words, mask, ids, grams, gram_at, epochs, rng, round_)
        value = _all_logits(network, held_words, mask, ids, grams, gram_at)
    best = np.full(len(rows), -np.inf)
    np.maximum.at(best, text, value)
    some = held if held.any() and len(set(y_text[held].tolist())) == 2 else np.ones(len(rows), bool)
    w = logistic(best[some][:, None], y_text[some].astype(float), 1e-5)
    network.calibration = (max(float(w[0]), 1e-3), float(w[1]))
    return network


def _ragged(values: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> np.ndarray:
    counts = np.diff(offsets)[rows]
    ends = np.cumsum(counts)
    return values[np.repeat(offsets[rows] - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)]


def _all_logits(network: Network, words: np.ndarray, mask: np.ndarray, ids: np.ndarray, grams: np.ndarray, gram_at: np.ndarray) -> np.ndarray:
    x = network.embed(ids, grams, gram_at)
    return np.concatenate([network.run(x[words[i : i + AT_ONCE].T], mask[i : i + AT_ONCE].T) for i in range(0, len(words), AT_ONCE)]).astype(np.float64)


def _summed(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of ``values`` that share a number."""
    return np.column_stack([np.bincount(rows, values[:, k], n) for k in range(values.shape[1])])


def _fit(network: Network, some: np.ndarray, label: np.ndarray, words: np.ndarray, mask: np.ndarray, ids: np.ndarray, grams: np.ndarray, gram_at: np.ndarray, epochs: int, rng: np.random.Generator, round_: int) -> None:
    """Adam over the chosen windows."""
    m = {k: np.zeros_like(v) for k, v in network.p.items()}
    v = {k: np.zeros_like(x) for k, x in network.p.items()}
    step = 0
    epochs = max(epochs, min(30, 30 * BATCH // max(1, len(some))))
    for epoch in range(epochs):
        order = rng.permutation(len(some))
        for low in range(0, len(order), BATCH):
            k = order[low : low + BATCH]
            distinct, at = np.unique(words[some[k]], return_inverse=True)
            counts = np.diff(gram_at)[distinct]
            own = _ragged(grams, gram_at, distinct)
            # One in ten common words is taken as unknown, so that the trigrams have to carry some of it.
            own_ids = np.where(rng.random(len(distinct)) < 0.1, len(network.vocabulary), ids[distinct])
            x = network.embed(own_ids, own, np.concatenate([[0], np.cumsum(counts)]))
            at = at.reshape(len(k), WINDOW).T
            g, dx, _ = network.gradients(x[at], mask[some[k]].T, label[k])
            by_word = _summed(at.ravel(), dx.reshape(-1, x.shape[1]), len(distinct))
            g["word"] = _summed(own_ids, by_word[:, :WORD_DIM], len(network.p["word"]))
            g["char"] = _summed(own, np.repeat(by_word[:, WORD_DIM:] / np.maximum(counts, 1)[:, None], counts, axis=0), TRIGRAMS)
            step += 1
            rate = RATE * (1.0 if round_ == 0 else 0.5) * (1 - 0.7 * epoch / epochs) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for name, grad in g.items():
                m[name] += 0.1 * (grad - m[name])
                v[name] += 0.001 * (grad * grad - v[name])
                decay = DECAY * network.p[name] if network.p[name].ndim > 1 else 0.0
                network.p[name] -= (rate * (m[name] / (np.sqrt(v[name]) + 1e-8) + decay)).astype(np.float32)


def _scores(inputs: Inputs | None, network: Network | float, texts: pa.Array) -> np.ndarray:
    if inputs is None:
        return np.full(len(texts), network)
    a, b = inputs.network.calibration
    return sigmoid(a * text_logits(inputs, texts) + b)


def score_toxicity(df: DataFrame, network: Network | float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: _id, score. Null counts as empty, which is one window of one empty word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inputs = None if isinstance(network, float) else Inputs(network)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_scores(inputs, network, batch.column(1)), pa.float64())], ["_id", "score"])

    rows = df.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    return rows.mapInArrow(trimmed(run), T.StructType([rows.schema["_id"], T.StructField("score", T.DoubleType())]))


def fitted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Network | float:
    network = train(labelled(docs, labels, "toxic", MODULUS, HELD, MOST, id_col, text_col))
    give_back()  # the driver's Python lives on beside its JVM
    return network


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fits on the labelled rows whose crc32 remainder is not held out and scores all: id, held_out, score, predicted.

    A null id is not held out. Null, empty and blank texts are one window of one empty word. Texts of any
    length are scored whole, window by window. Rows that repeat, or share an id, are scored each for
    itself; an id with both labels counts with both. Other columns play no part, whatever their names.
    Without labels of both kinds the score is the same for all. An empty table gives an empty result.
    """
    out = score_toxicity(docs, fitted(docs, labels, id_col, text_col), id_col, text_col)
    held = F.coalesce(crc_remainder("_id", MODULUS) == HELD, F.lit(False))
    return out.select(F.col("_id").alias(id_col), held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns, whatever their names and kinds.

    Odd rows are scored as in :func:`toxicity`; without labels of both kinds, or of toxic ones, all rows stay
    if the share of toxic labels is below the threshold.
    """
    network, at = fitted(docs, labels, id_col, text_col), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inputs = None if isinstance(network, float) else Inputs(network)
        for batch in batches:
            # Whole rows come as one struct, so that a text crosses to Python once.
            texts = batch.column(0).field(at)
            yield batch.filter(pa.array(_scores(inputs, network, texts.cast(pa.string())) < THRESHOLD))

    rows = docs.select(whole_row(docs).alias("_all"))
    return unpacked(rows.mapInArrow(trimmed(run), rows.schema), docs.columns)


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    return toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


QUERIES = {"op2_toxicity": op2_toxicity}
SQL: dict[str, str] = {}
