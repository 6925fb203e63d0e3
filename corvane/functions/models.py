"""What users inject: tokenizers, encoders, rerankers and generators. The defaults are deterministic and need no files."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.batches import bounded


class Tokenizer(Protocol):
    def encode(self, text: str) -> list[int]: ...

    def decode(self, ids: Sequence[int]) -> str: ...


class Encoder(Protocol):
    def encode(self, texts: Sequence[str]) -> np.ndarray: ...

    def dim(self) -> int: ...

    def name(self) -> str: ...


class Reranker(Protocol):
    def scores(self, queries: Sequence[str], texts: Sequence[str]) -> Sequence[float]: ...


class Generator(Protocol):
    def answer(self, prompts: Sequence[str]) -> Sequence[str]: ...


class QuarterTokenizer:
    """One token for four characters; for tests and estimates."""

    def encode(self, text: str) -> list[int]:
        return list(range(len(text) // 4))

    def decode(self, ids: Sequence[int]) -> str:
        return " ".join(map(str, ids))


class HashingEncoder:
    """Words hashed into a fixed number of signed dimensions, normalised."""

    def __init__(self, dimensions: int = 64):
        self.dimensions = dimensions

    def encode(self, texts: Sequence[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dimensions), np.float32)
        for row, text in zip(out, texts):
            for word in (text or "").lower().split():
                h = zlib.crc32(word.encode())
                row[h % self.dimensions] += 1 if h >> 16 & 1 else -1
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)

    def dim(self) -> int:
        return self.dimensions

    def name(self) -> str:
        return f"hashing-{self.dimensions}"


class LetterEncoder:
    """How often each of 64 characters stands in the lower-cased text, normalised; an encoder that SQL can repeat."""

    letters = "abcdefghijklmnopqrstuvwxyz0123456789 .,;:!?-()%&$#@*_/|éèäöüñóíçê"[:64]
    codes = np.array([ord(c) for c in letters])
    last = int(codes.max())

    def encode(self, texts: Sequence[str]) -> np.ndarray:
        counts = np.zeros((len(texts), len(self.letters)))
        for row, text in zip(counts, texts):  # one pass over a text's code points, of which those over `last` are no letters
            codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
            row[:] = np.bincount(np.minimum(codes, self.last + 1), minlength=self.last + 2)[self.codes]
        return (counts / np.maximum(np.sqrt((counts * counts).sum(axis=1, keepdims=True)), 1e-12)).astype(np.float32)

    def dim(self) -> int:
        return len(self.letters)

    def name(self) -> str:
        return "letters"


class OverlapReranker:
    """The share of the query's distinct words that the text holds."""

    def scores(self, queries: Sequence[str], texts: Sequence[str]) -> list[float]:
        out = []
        for q, t in zip(queries, texts):
            words = set((q or "").lower().split())
            out.append(len(words & set((t or "").lower().split())) / len(words) if words else 0.0)
        return out


def rank(reranker: Reranker, query: str, texts: Sequence[str], k: int | None = None, batch: int = 32) -> list[tuple[int, float]]:
    """(place in texts, score), best first, of the k best; blank texts are skipped, but places count them. Texts go in batches."""
    places = [i for i, t in enumerate(texts) if t and t.strip()]
    scores: list[float] = []
    for low in range(0, len(places), batch):
        part = [texts[i] for i in places[low : low + batch]]
        scores += reranker.scores([query] * len(part), part)
    return sorted(zip(places, map(float, scores)), key=lambda x: -x[1])[:k]


OPTION = re.compile(r"^([A-E]): ?(.*)$", re.MULTILINE)


class LongestOptionGenerator:
    """Answers with the letter of the longest option in the prompt, the first of equals; A without options. A stand-in for a model."""

    def answer(self, prompts: Sequence[str]) -> list[str]:
        found = [OPTION.findall(p or "") for p in prompts]
        return [max(options, key=lambda o: len(o[1]))[0] if options else "A" for options in found]


class LetterGenerator:
    """Answers by a model's values for the letters: of a row of values per prompt, only those of the letters count, others are masked. A letter that has several places counts with their sum."""

    def __init__(self, values: Callable[[Sequence[str]], np.ndarray], letters: dict[str, int | Sequence[int]]):
        self.values, self.letters = values, {name: sorted({places} if isinstance(places, int) else set(places)) for name, places in letters.items()}

    def answer(self, prompts: Sequence[str]) -> list[str]:
        rows, names = np.asarray(self.values(prompts), float), [*self.letters]
        sums = np.stack([rows[:, places].sum(axis=1) for places in self.letters.values()], axis=1)
        return [names[i] for i in sums.argmax(axis=1)]


class NextTokenGenerator:
    """Answers with what a base model says next: prompts are cut to their first `longest` tokens, go in batches, and the one new token with the largest value is decoded."""

    def __init__(self, tokenizer: Tokenizer, next_values: Callable[[list[list[int]]], np.ndarray], longest: int = 1024, batch_size: int = 16):
        self.tokenizer, self.next_values, self.longest, self.batch_size = tokenizer, next_values, longest, batch_size

    def answer(self, prompts: Sequence[str]) -> list[str]:
        ids, out = [self.tokenizer.encode(p or "")[: self.longest] for p in prompts], []
        for low in range(0, len(ids), self.batch_size):
            out += [self.tokenizer.decode([int(i)]) for i in np.asarray(self.next_values(ids[low : low + self.batch_size])).argmax(axis=1)]
        return out


class BatchEncoder:
    """An encoder from a function over token ids: texts in batches, with a prefix, cut to a length, normalised if asked for."""

    def __init__(self, tokenizer: Tokenizer, vectors: Callable[[list[list[int]]], np.ndarray], dimensions: int, title: str = "model", prefix: str = "", longest: int = 512, batch_size: int = 32, normalize: bool = True):
        self.tokenizer, self.vectors, self.dimensions, self.title = tokenizer, vectors, dimensions, title
        self.prefix, self.longest, self.batch_size, self.normalize = prefix, longest, batch_size, normalize

    def encode(self, texts: Sequence[str]) -> np.ndarray:
        ids = [self.tokenizer.encode(self.prefix + (t or ""))[: self.longest] for t in texts]
        out = np.zeros((len(ids), self.dimensions), np.float32)
        by_length = sorted(range(len(ids)), key=lambda i: len(ids[i]))  # so that a batch needs little padding
        for low in range(0, len(ids), self.batch_size):
            part = by_length[low : low + self.batch_size]
            out[part] = self.vectors([ids[i] for i in part])
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12) if self.normalize else out

    def dim(self) -> int:
        return self.dimensions

    def name(self) -> str:
        return self.title


def encode_column(make: Callable[[], Encoder], text: Column) -> Column:
    """Vectors of a text column; the model is made once per Python worker and fed Arrow batches."""
    bounded()

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make()
        for texts in batches:
            yield pd.Series(list(model.encode(texts.fillna("").tolist())))

    return encode(text)


def rerank_column(make: Callable[[], Reranker], query: Column, text: Column) -> Column:
    bounded()

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = make()
        for queries, texts in batches:
            found = model.scores(queries.tolist(), texts.tolist())
            if len(found) != len(queries):
                raise ValueError(f"{len(found)} scores for {len(queries)} pairs")
            yield pd.Series(found, dtype="float64")

    return score(query, text)


def generate_column(make: Callable[[], Generator], prompt: Column) -> Column:
    bounded()

    @F.pandas_udf("string")
    def generate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make()
        for prompts in batches:
            yield pd.Series(model.answer(prompts.tolist()), dtype="object")

    return generate(prompt)
