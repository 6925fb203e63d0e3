"""Chunking: child chunks of whole sentences, parent chunks, windows of token ids, and the map from child to parent.

Greedy packing depends on the order of sentences and starts anew whenever a chunk closes, which no window sum expresses;
it runs over Arrow batches, one document at a time, without a shuffle. All that follows is columns and joins.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.text import split_sentences
from ..sources.batches import bounded
from .ordering import number_rows

#: Characters that end sentences, and the margins of budgets.
CHILD_BREAKS, PARENT_BREAKS = r".!?\n。！？;；", r".!?\n。！？;；\r"
TOKEN_BREAKS = (".", "?", "!", "\n", "。", "！", "？", ";", "；")
SPECIAL_TOKENS, LEAST_CHILD, LOOK_BACK = 2, 20, 20

CHILD = "chunk_id string, doc_id string, title string, child_start int, child_end int, parent_start int, parent_end int, chunk_len int"
PARENT = "parent_id string, doc_id string, title string, start_char int, end_char int, text string, token_count int"
TOKENS = "chunk_id string, doc_id string, child_ids array<int>, parent_start int, parent_end int, chunk_len int"


def quarter(text: str) -> int:
    return len(text) // 4


Splitter = Callable[[str], list[tuple[str, int, int]]]


def located(pieces: Iterable[str], text: str) -> list[tuple[str, int, int]]:
    """Sentences of another splitter with their offsets, each sought after the one before; those that are not found are left out."""
    out, at = [], 0
    for piece in map(str.strip, pieces):
        start = text.find(piece, at) if piece else -1
        if start >= 0:
            at = start + len(piece)
            out.append((piece, start, at))
    return out


def child_spans(sentences: list[tuple[str, int, int]], budget: int, count: Callable[[str], int]) -> Iterator[tuple[str, int, int]]:
    """Sentences packed until the next one would exceed the budget; one that is too long alone stays whole."""
    held: list[str] = []
    begin = end = 0
    for sentence, start, stop in sentences:
        if held and count(" ".join([*held, sentence])) > budget:
            yield " ".join(held), begin, end
            held = []
        if not held:
            begin = start
        held.append(sentence)
        end = stop
    if held:
        yield " ".join(held), begin, end


def _snap(point: int, sentences: list[tuple[str, int, int]], to_start: bool) -> int:
    for _, start, stop in sentences:
        if (start <= point < stop) if to_start else (start < point <= stop):
            return start if to_start else stop
    return point


def _resized(text: str, start: int, end: int, target: int) -> tuple[int, int]:
    """The parent range of a child: the breaks nearest its middle, at most 2 x target characters away, but around the child; over 1.2 x target tokens, within it."""
    middle, half = (start + end) // 2, 2 * target
    low, high = max(0, middle - half), min(len(text), middle + half)
    last = max((text.rfind(b, low, middle) for b in TOKEN_BREAKS), default=-1)
    found = [at for at in (text.find(b, middle, high) for b in TOKEN_BREAKS) if at >= 0]
    first, after = min(last + 1 if last >= 0 else low, start), max(min(found) + 1 if found else high, end)
    return (max(start, middle - half), min(end, middle + half)) if (after - first) // 4 > target * 1.2 else (first, after)


def child_chunks(docs: DataFrame, child_size: int = 128, parent_size: int = 512, least_chars: int = 50, count: Callable[[str], int] = quarter, split: Splitter | None = None, resize: int | None = None) -> DataFrame:
    """Child chunks of docs (doc_id, title, text), each with a parent range around it that ends with sentences.

    The title and two special tokens take from the budget, which is 20 at least. Chunks under least_chars are dropped and
    take no number. Blank texts have no chunks. count and split stand for a tokenizer's length and another sentence splitter.
    resize: parent ranges as resized_parents(target=resize) would make them, in this pass instead of a join with the texts.
    """
    split = split or (lambda text: split_sentences(text, CHILD_BREAKS))

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc_id, title, text in zip(pdf["doc_id"], pdf["title"], pdf["text"]):
                found = split(text or "")
                budget = max(LEAST_CHILD, child_size - (count(title) if title else 0) - SPECIAL_TOKENS)
                n, half = 0, parent_size * 4 // 2
                for chunk, start, end in child_spans(found, budget, count):
                    if len(chunk) < least_chars:
                        continue
                    middle = (start + end) // 2
                    first, last = min(max(0, middle - half), start), max(min(len(text), middle + half), end)
                    parent = _resized(text, start, end, resize) if resize else (_snap(first, found, True), _snap(last, found, False))
                    rows.append((f"{doc_id}:chunk:{n}", doc_id, title or "", start, end, *parent, count(chunk)))
                    n += 1
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in CHILD.split(", ")])

    bounded(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("string"), "title", "text").mapInPandas(run, CHILD)


def parent_chunks(docs: DataFrame, parent_size: int = 256, least_tokens: int = 50, count: Callable[[str], int] = quarter, split: Splitter = split_sentences) -> DataFrame:
    """Parent chunks, independent of children: sentences are added while the sum of their tokens fits. A rest under least_tokens joins the chunk before it, or is dropped if there is none."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc_id, title, text in zip(pdf["doc_id"], pdf["title"], pdf["text"]):
                budget = max(least_tokens, parent_size - (count(title) if title else 0) - SPECIAL_TOKENS)
                made: list[list[int]] = []
                start = end = tokens = 0
                for sentence, first, last in split(text or ""):
                    more = count(sentence)
                    if tokens > 0 and tokens + more > budget:
                        made.append([start, end, tokens])
                        start, tokens = first, 0
                    elif tokens == 0:
                        start = first
                    end, tokens = last, tokens + more
                if tokens >= least_tokens:
                    made.append([start, end, tokens])
                elif made and tokens > 0:
                    made[-1][1], made[-1][2] = end, made[-1][2] + tokens
                rows += [(f"{doc_id}:parent:{i}", doc_id, title or "", a, b, text[a:b], t) for i, (a, b, t) in enumerate(made)]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in PARENT.split(", ")])

    bounded(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("string"), "title", "text").mapInPandas(run, PARENT)


def token_windows(n: int, breaks: list[bool], child: int, parent_size: int, least: int) -> Iterator[tuple[int, int, int, int]]:
    """(start, end, parent start, parent end) of windows over n tokens; breaks tells after which a window may end early."""
    start, made = 0, 0
    while start < n:
        end = min(start + child, n)
        if end < n:
            end = next((p + 1 for p in range(end - 1, max(end - 1 - LOOK_BACK, start), -1) if breaks[p]), end)
        if end == n and end - start < least and made:
            return
        middle = (start + end) // 2
        first, last = min(max(0, middle - parent_size // 2), start), max(min(n, middle + parent_size // 2), end)
        if last - first < parent_size:
            last = min(n, first + parent_size)
            first = max(0, min(first, last - parent_size))
        yield start, end, first, last
        start, made = end, made + 1


def token_chunks(docs: DataFrame, child_size: int = 128, parent_size: int = 512, least: int = 32, break_ids: Iterable[int] = (), title_len: str = "title_len", ids: str = "ids") -> DataFrame:
    """Windows over token ids (doc_id, title_len, ids): they look back up to 20 tokens for a break, and a short tail is dropped unless it is all there is."""
    stops = frozenset(break_ids)

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc_id, title, tokens in zip(pdf["doc_id"], pdf["title_len"], pdf["ids"]):
                tokens = [] if tokens is None else [int(t) for t in tokens]
                child = max(LEAST_CHILD, child_size - int(title or 0) - SPECIAL_TOKENS)
                for i, (a, b, c, d) in enumerate(token_windows(len(tokens), [t in stops for t in tokens], child, parent_size, least)):
                    rows.append((f"{doc_id}:chunk:{i}", doc_id, tokens[a:b], c, d, b - a))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in TOKENS.split(", ")])

    bounded(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("string"), F.col(title_len).alias("title_len"), F.col(ids).alias("ids")).mapInPandas(run, TOKENS)


def embedding_ids(title: Column, child: Column, most: int, cls: int | None = 101, sep: int | None = 102) -> Column:
    """[CLS] title [SEP] child [SEP], without the title's part if it is empty; cls None: title and child only. Cut to `most`."""
    title = F.coalesce(title, F.array().cast("array<int>"))
    if cls is None:
        return F.slice(F.concat(title, child), 1, most)
    one = lambda v: F.array(F.lit(v))
    return F.slice(F.concat(one(cls), F.when(F.size(title) > 0, F.concat(title, one(sep))).otherwise(title), child, one(sep)), 1, most)


def parent_of_child(children: DataFrame, parents: DataFrame, cell: int = 4096) -> DataFrame:
    """children (chunk_id, doc_id, child_start, child_end) with parent_id and parent_idx (-1: none): the first parent that holds the child, else the one with the largest overlap, the first of equals.

    Both sides are cut into cells of characters and meet by document and cell, so a long document's chunks only meet
    their neighbours; the best parent is an aggregate per child, not a sort.
    """
    cells = lambda start, end: F.explode(F.expr(f"sequence({start} div {cell}, greatest({start}, {end} - 1) div {cell})"))
    p = parents.select(F.col("doc_id").alias("p_doc"), "parent_id", "start_char", "end_char", F.substring_index("parent_id", ":", -1).cast("int").alias("p_idx"), cells("start_char", "end_char").alias("p_cell"))
    c = children.withColumn("__cell", cells("child_start", "child_end"))
    overlap = F.least("child_end", "end_char") - F.greatest("child_start", "start_char")
    holds = (F.col("start_char") <= F.col("child_start")) & (F.col("child_end") <= F.col("end_char"))
    pairs = c.join(p, (F.col("doc_id") == F.col("p_doc")) & (F.col("__cell") == F.col("p_cell")) & ((overlap > 0) | holds), "left")
    rank = F.when(F.col("parent_id").isNotNull(), F.struct(F.when(holds, 1).otherwise(0).alias("holds"), F.when(holds, 0).otherwise(overlap).alias("overlap"), (-F.col("p_idx")).alias("first"), "parent_id"))
    best = pairs.groupBy(*children.columns).agg(F.max(rank).alias("best"))
    return best.select(*children.columns, F.col("best.parent_id").alias("parent_id"), F.coalesce(-F.col("best.first"), F.lit(-1)).alias("parent_idx"), F.coalesce(F.col("best.holds") == 1, F.lit(False)).alias("contained"))


def with_global_index(parents: DataFrame) -> DataFrame:
    """parents with parent_chunk_idx, their place in the order of doc_id and number."""
    return number_rows(parents, "parent_chunk_idx", "doc_id", F.substring_index("parent_id", ":", -1).cast("int"))


def resized_parents(chunks: DataFrame, docs: DataFrame, target: int = 256) -> DataFrame:
    """chunks with parent_start and parent_end moved: the breaks nearest the child's middle, at most 2 x target characters away, but around the child; over 1.2 x target tokens, within the child."""
    text = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").alias("__text"))
    middle = F.floor((F.col("child_start") + F.col("child_end")) / 2).cast("int")
    out = chunks.join(text, "doc_id", "left").withColumn("__mid", middle)
    half = int(target * 2.0)
    low, high = F.greatest(F.lit(0), F.col("__mid") - half), F.least(F.length("__text"), F.col("__mid") + half)
    start = F.least(T.last_break(F.col("__text"), low, F.col("__mid")), F.col("child_start"))
    end = F.greatest(T.first_break(F.col("__text"), F.col("__mid"), high), F.col("child_end"))
    out = out.withColumns({"__start": start, "__end": end})
    large = F.floor((F.col("__end") - F.col("__start")) / 4) > target * 1.2
    new_start = F.when(large, F.greatest(F.col("child_start"), F.col("__mid") - 2 * target)).otherwise(F.col("__start"))
    new_end = F.when(large, F.least(F.col("child_end"), F.col("__mid") + 2 * target)).otherwise(F.col("__end"))
    keep = F.col("__text").isNull()
    return out.withColumns({"parent_start": F.when(keep, F.col("parent_start")).otherwise(new_start), "parent_end": F.when(keep, F.col("parent_end")).otherwise(new_end)}).drop("__text", "__mid", "__start", "__end")


def slices(chunks: DataFrame, docs: DataFrame, most: int = 2200, how: str = "left") -> DataFrame:
    """chunk_id, child_text, parent_text, embedding_text, display_text; texts of unknown documents are empty, or with how="inner" their chunks are dropped."""
    d = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").alias("__text"))
    cut = lambda a, b: F.coalesce(F.substring("__text", F.col(a) + 1, F.col(b) - F.col(a)), F.lit(""))
    out = chunks.join(d, "doc_id", how).withColumns({"child_text": cut("child_start", "child_end"), "__parent": cut("parent_start", "parent_end")})
    titled = F.coalesce("title", F.lit("")) != ""
    return out.select(
        "chunk_id", "child_text",
        F.left(F.when(titled & (F.col("__parent") != ""), F.concat("title", F.lit("\n\n"), "__parent")).otherwise(F.col("__parent")), F.lit(most)).alias("parent_text"),
        F.when(titled, F.concat("title", F.lit("\n\n"), "child_text")).otherwise(F.col("child_text")).alias("embedding_text"),
        F.concat(F.lit("["), F.coalesce("title", F.lit("")), F.lit("]\n"), "child_text").alias("display_text"),
    )


def parent_statistics(mapped: DataFrame, parents: DataFrame) -> DataFrame:
    """One row of counts, sizes, coverage and children per parent; mapped is what parent_of_child returns."""
    p = parents.agg(F.count("*").alias("total_parent_chunks"), F.countDistinct("doc_id").alias("unique_docs"), F.round(F.avg("token_count"), 2).alias("avg_parent_tokens"), F.min("token_count").cast("long").alias("min_parent_tokens"), F.max("token_count").cast("long").alias("max_parent_tokens"))
    c = mapped.agg(F.count("*").alias("total_child_chunks"), F.count_if("contained").alias("fully_contained_count"), F.count_if(F.col("parent_idx") < 0).alias("unfound_count"))
    per = mapped.where("parent_idx >= 0").groupBy("parent_id").count().agg(F.round(F.avg("count"), 2).alias("avg_children_per_parent"), F.max("count").alias("max_children_per_parent"), F.min("count").alias("min_children_per_parent"), F.count("*").alias("parent_with_children"))
    one = p.join(c, F.lit(True)).join(per, F.lit(True))
    return one.withColumns({"fully_contained_ratio": F.round(F.col("fully_contained_count") / F.col("total_child_chunks"), 4), "coverage_ratio": F.round((F.col("total_child_chunks") - F.col("unfound_count")) / F.col("total_child_chunks"), 4), "parent_without_children": F.col("total_parent_chunks") - F.col("parent_with_children")})


def write_parents(parents: DataFrame, children: DataFrame, path: str) -> DataFrame:
    """Tables below path: parents with their global index, children with their parent, and one row of statistics, which is returned as stored."""
    with_global_index(parents).write.mode("overwrite").parquet(f"{path}/parents")
    stored = parents.sparkSession.read.parquet(f"{path}/parents")
    parent_of_child(children, stored.select(*parents.columns)).write.mode("overwrite").parquet(f"{path}/children")
    mapped = parents.sparkSession.read.parquet(f"{path}/children")
    parent_statistics(mapped, stored).write.mode("overwrite").parquet(f"{path}/statistics")
    return parents.sparkSession.read.parquet(f"{path}/statistics")
