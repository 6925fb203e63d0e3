"""Toxicity from compression lengths under two separately trained zstandard dictionaries.

Texts are cut into windows of a few words, set apart by wide gaps. The ordinary dictionary is trained on the windows of
ordinary documents. Toxic documents are mostly ordinary text too, so the toxic dictionary is trained on what sets them apart:
the stretches of their windows made of byte runs that far more toxic documents hold than ordinary ones. Every window is then
compressed twice, with the ordinary dictionary alone and with the toxic one before it, so that both runs find the same
ordinary matches and the difference in length is what the toxic dictionary adds. A logistic curve turns the gains of a
document's windows into a score, with 0.5 as the calibrated threshold; it is fitted on gains of documents under
dictionaries that were trained without them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import zstandard as zs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import in_fold, prepare, trim

#: Words of a window, what stands between them, and the bytes after which a longer window is cut.
WORDS, GAP, WINDOW_BYTES = 4, b"   ", 512
#: Bytes of the dictionaries, of the byte runs that are counted, and of the pieces that dictionaries are built from.
TOXIC_BYTES, ORDINARY_BYTES, RUN, TOXIC_PIECE, ORDINARY_PIECE = 2048, 49152, 6, 16, 64
#: A run is typical if so many toxic documents hold it, and so many times as large a share of them as of ordinary ones.
LEAST, RATIO = 4, 20.0
_EDGES = b".,;:!?\"'()[]|*%&$#@~_-"


def rendered(text: str) -> list[bytes]:
    """The words of a text, A-Z lower-cased, without signs at their ends."""
    return [w for w in (x.strip(_EDGES) for x in text.encode().lower().split()) if w]


def windows(text: str) -> list[bytes]:
    """All of a text in windows of WORDS words; those over WINDOW_BYTES in cuts that overlap by half."""
    ws, out = rendered(text), []
    for i in range(0, len(ws), WORDS):
        w = GAP + GAP.join(ws[i : i + WORDS]) + GAP
        out += [w] if len(w) <= WINDOW_BYTES else [w[k : k + WINDOW_BYTES] for k in range(0, len(w) - WINDOW_BYTES // 2, WINDOW_BYTES // 2)]
    return out


def _runs(window: bytes) -> np.ndarray:
    """The runs of RUN bytes of a window, as integers."""
    x = np.frombuffer(window, np.uint8).astype(np.uint64)
    out = np.zeros(max(0, len(x) - RUN + 1), np.uint64)
    for i in range(RUN if len(out) else 0):
        out = out << np.uint64(8) | x[i : len(x) - RUN + 1 + i]
    return out


class Sample:
    """Labelled texts: their windows, and the runs of those as numbers below the number of different runs."""

    def __init__(self, texts: list[str]):
        self.windows = [windows(t) for t in texts]
        none = np.zeros(0, np.uint64)
        runs_of = lambda ws: np.concatenate([none, *map(_runs, ws)])
        every = np.concatenate([none, *(np.unique(runs_of(ws)) for ws in self.windows)])
        every.sort()
        every = every[np.concatenate([[True], every[1:] != every[:-1]])] if len(every) else every
        self.n_runs = len(every)
        # Numbers take half the room, so the runs themselves are made again, text by text.
        self.runs = [np.searchsorted(every, runs_of(ws)).astype(np.int32) for ws in self.windows]
        self.distinct = [np.unique(r) for r in self.runs]
        self.edges = [np.cumsum([0, *(max(0, len(w) - RUN + 1) for w in ws)]) for ws in self.windows]  # where each window's runs begin

    def holders(self, chosen: list[int]) -> np.ndarray:
        """How many of the chosen texts hold each run."""
        return np.bincount(np.concatenate([np.zeros(0, np.int32), *(self.distinct[i] for i in chosen)]), minlength=self.n_runs)

    def typical(self, toxic: list[int], ordinary: list[int]) -> np.ndarray:
        """Which runs are typical of the toxic texts among the chosen."""
        n, m = self.holders(toxic), self.holders(ordinary)
        return (n >= LEAST) & (n / max(1, len(toxic)) >= RATIO * (m + 0.5) / max(1, len(ordinary))) & bool(ordinary)

    def stretches(self, chosen: list[int], typical: np.ndarray) -> list[bytes]:
        """The stretches of the chosen texts' windows that typical runs cover; of each text, different ones once."""
        out = []
        for i in chosen:
            hits = np.flatnonzero(typical[self.runs[i]])
            of, found = np.searchsorted(self.edges[i], hits, side="right") - 1, {}
            new = np.flatnonzero((np.diff(of, prepend=-1) > 0) | (np.diff(hits, prepend=-RUN - 1) > RUN))
            for a, b in zip(new.tolist(), [*(new[1:] - 1).tolist(), len(hits) - 1]):
                w, begin = self.windows[i][of[a]], int(self.edges[i][of[a]])
                found[GAP + w[hits[a] - begin : hits[b] - begin + RUN].strip() + GAP] = True
            out += found
        return out


def trained(samples: list[bytes], size: int, piece: int) -> bytes:
    """The content of a zstandard dictionary trained on samples; too few of them are their own dictionary."""
    if len(samples) >= 8 and sum(map(len, samples)) > size:
        try:
            return zs.train_dictionary(size, samples, k=piece, d=6 if piece < 32 else 8, level=9).as_bytes()
        except zs.ZstdError:  # the trainer refuses samples with too little in common
            pass
    return b"".join(samples)[:size]


def _compressor(content: bytes) -> zs.ZstdCompressor:
    params = zs.ZstdCompressionParameters(compression_level=9, window_log=20, hash_log=17, chain_log=17, search_log=6, min_match=4, target_length=16, strategy=zs.STRATEGY_BTLAZY2, write_content_size=False, write_checksum=False, write_dict_id=False, format=zs.FORMAT_ZSTD1_MAGICLESS)
    d = zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(compression_params=params)
    return zs.ZstdCompressor(dict_data=d, compression_params=params)


@dataclass
class ToxicityModel:
    toxic: bytes
    ordinary: bytes
    weights: list[float] = field(default_factory=lambda: [-3.0, 0.0, 0.0, 0.0, 0.0])

    def open(self) -> None:
        self._o, self._t = _compressor(self.ordinary + GAP * 3), _compressor(self.toxic + self.ordinary + GAP * 3)

    def gain(self, window: bytes) -> int:
        """Bytes that the toxic dictionary saves."""
        return len(self._o.compress(window)) - len(self._t.compress(window))

    def features(self, text: str) -> tuple[float, float, float, float]:
        """Of the gains of the text's different windows: the mean, the largest, the number of 3 or more and their share."""
        return self.features_of(windows(text))

    def features_of(self, found: list[bytes]) -> tuple[float, float, float, float]:
        gains = [self.gain(w) for w in dict.fromkeys(found)]
        if not gains:
            return 0.0, 0.0, 0.0, 0.0
        strong = sum(g >= 3 for g in gains)
        return sum(gains) / len(gains), float(max(0, min(max(gains), 12))), math.log1p(strong), 10 * strong / len(gains)

    def score(self, text: str) -> float:
        z = self.weights[0] + sum(w * x for w, x in zip(self.weights[1:], self.features(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 400) -> list[float]:
    """Weights, bias first, by Newton's method with a small ridge; both classes count alike."""
    x = np.hstack([np.ones((len(x), 1)), x])
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (weight * (y - p)) - 1e-4 * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def dictionaries(sample: Sample, toxic: list[int], ordinary: list[int]) -> ToxicityModel:
    """A model of the chosen texts, without calibration. Without typical runs the toxic dictionary is empty and nothing gains."""
    stretches = sample.stretches(toxic, sample.typical(toxic, ordinary))
    model = ToxicityModel(trained(stretches, TOXIC_BYTES, TOXIC_PIECE), trained([w for i in ordinary for w in sample.windows[i]], ORDINARY_BYTES, ORDINARY_PIECE))
    model.open()
    return model


def fit(toxic: list[str], ordinary: list[str], parts: int = 3) -> ToxicityModel:
    """A model of labelled texts. Without toxic or ordinary texts, or without runs typical of the toxic ones, every score is low."""
    toxic, ordinary = sorted(set(toxic)), sorted(set(ordinary))
    rng = np.random.default_rng(0)
    toxic, ordinary = ([texts[i] for i in rng.permutation(len(texts))] for texts in (toxic, ordinary))
    sample = Sample([*toxic, *ordinary])
    labels = [[*range(len(toxic))], [*range(len(toxic), len(toxic) + len(ordinary))]]
    model = dictionaries(sample, *labels)
    if not model.toxic or not ordinary:
        return model
    x, y = [], []
    for part in range(parts):
        other = dictionaries(sample, *([i for k, i in enumerate(chosen) if k % parts != part] for chosen in labels))
        for label, chosen in zip((1, 0), labels):
            x += [other.features_of(sample.windows[i]) for i in chosen[part::parts]]
            y += [label] * len(chosen[part::parts])
    model.weights = _logistic(np.array(x), np.array(y))
    return model


_open: dict[bytes, ToxicityModel] = {}


def score_column(model: ToxicityModel, text: Column) -> Column:
    """The score of a text column; null is empty."""
    parts = (model.toxic, model.ordinary, model.weights)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        key = parts[0] + parts[1] + repr(parts[2]).encode()
        if key not in _open:
            _open.clear()
            _open[key] = ToxicityModel(*parts)
            _open[key].open()
        for texts in batches:
            yield pd.Series([_open[key].score(x or "") for x in texts], dtype="float64")
        trim()

    return score(F.coalesce(text.cast("string"), F.lit("")))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = 5, sample: int = 1500, sample_bytes: int = 24 << 20) -> ToxicityModel:
    """A model from labelled documents outside fold 0.

    A classifier's sample is bounded: of each label, the documents of the `sample` smallest id hashes, as far as their whole
    texts add up to no more than `sample_bytes`. Labels that are null or neither 0 nor 1 are not used, nor ids that are null.
    Null texts are empty. Documents repeated with one id are taken once for each text. Without labels every score is low.
    """
    prepare(docs.sparkSession)
    known = labels.select(F.col(id_col).cast("long").alias("__id"), F.col(label_col).cast("int").alias("__label")).where((in_fold(F.col("__id"), folds) != 0) & F.col("__id").isNotNull())
    picked = [known.where(F.col("__label") == v).distinct().orderBy(F.xxhash64("__id"), "__id").limit(sample) for v in (0, 1)]
    chosen = picked[0].unionByName(picked[1])  # at most 2 x sample ids
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text")).join(F.broadcast(chosen), "__id").distinct()
    in_order = Window.partitionBy("__label").orderBy(F.xxhash64("__id"), "__id", F.xxhash64("__text"))
    rows = rows.withColumn("__upto", F.sum(F.octet_length("__text")).over(in_order)).where(F.col("__upto") <= sample_bytes).toPandas()
    model = fit(rows.loc[rows["__label"] == 1, "__text"].tolist(), rows.loc[rows["__label"] == 0, "__text"].tolist())
    del rows
    trim()
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", folds: int = 5) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per input row.

    Null text is empty; an empty text has no windows and gets the score of no gain. A null id counts as the empty text for
    held_out. Ties, repeated rows and other columns play no part: a row's score depends on its text alone. All windows of a
    very long text count. An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    out = docs.select(F.col(id_col).alias("doc_id"), (in_fold(F.col(id_col), folds) == 0).alias("held_out"), score_column(model, F.col(text_col)).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """The rows of docs whose score is under 0.5, with their columns: rows of any id, or none, are judged by their text. An empty table stays empty."""
    prepare(docs.sparkSession)
    return docs.where(score_column(model, F.col(text_col)) < 0.5)
