"""The corpus pipeline: from the documents table to tokens, each stage on all that the one before kept.

toxicity    documents scored toxic go
exact       of equal texts, the one with the largest id stays
near        of each component of near duplicates, the document with the smallest id stays
benchmark   documents with passages of the benchmark go
tokens      the rest is encoded, and decoded again as a check

A stage is given a written table, as the contract of STAGES has it, so nothing that earlier stages put aside is read any
more: it is removed when the next stage begins. Whoever runs stages by hand writes each result before the next one.

Stages tell rows apart by numbers of their own, so repeated rows and rows without an id are documents like any other. Tables
may be empty, and have other columns of any name.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from corvane.llm import bpe, decontamination, exact_dedup, jaccard_join, toxicity
from corvane.llm.common import Workspace
from corvane.llm.queries import table, tokenizer_path


_put_aside: list[Workspace] = []


def stage(f: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """f as a stage, which begins with removing what earlier stages put aside."""

    @wraps(f)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _put_aside:
            spent = _put_aside.pop()
            if spent.spark is spark:
                spent.remove()
        before, Workspace.noted = Workspace.noted, []
        try:
            return f(spark, docs, sf_dir)
        finally:
            _put_aside.extend(Workspace.noted)
            Workspace.noted = before

    return run


@stage
def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text scores under 0.5 by a model of the labels; rows of any id, or none, are judged alike."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@stage
def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows with equal texts (null is empty) the one with the largest id stays, rows without an id last."""
    return exact_dedup.drop_copies(docs, keep="largest")


@stage
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the row with the smallest id stays, rows without an id last; blank texts all stay."""
    return jaccard_join.keep_one_of_each(docs)


@stage
def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in whose text no window of the benchmark occurs."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


@stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with ids, n_tokens and round_trip; columns of these names give way."""
    return bpe.with_tokens(docs, tokenizer_path())


STAGES = [("toxicity", without_toxic), ("exact", without_copies), ("near", one_of_each_group), ("benchmark", without_benchmark), ("tokens", tokens)]

#: A compressor's dictionaries and a trained threshold are beyond SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table. Each result is written to the shared folder and read again, so a lost executor never leads back beyond the stage at work."""
    ws, docs = Workspace(spark, "pipeline"), table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = ws.write(stage(spark, docs, sf_dir), name)
        if i:
            ws.drop(STAGES[i - 1][0])
    return docs
