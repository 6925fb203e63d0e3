"""Questions and answers: templates, contexts, parsing, evaluation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The letters of options and the frame of a question.
LETTERS = ("A", "B", "C", "D", "E")
QUESTION, REQUEST = "Question: ", "\nRetrieve background scientific knowledge to help answer."


def query_text(prompt: Column) -> Column:
    return F.concat(F.lit(QUESTION), F.coalesce(prompt, F.lit("")), F.lit(REQUEST))


def widen(ranked: DataFrame, k: int = 3, rank: str = "rank", text: str = "text", prefix: str = "C") -> DataFrame:
    """(query_id, C1..Ck): one row a query, "" where a rank is missing or its text is null. A group-by with k fixed aggregates, not a pivot over data."""
    return ranked.groupBy("query_id").agg(*[F.coalesce(F.max(F.when(F.col(rank) == i, F.col(text))), F.lit("")).alias(f"{prefix}{i}") for i in range(1, k + 1)])


def context(columns: Sequence[str]) -> Column:
    """[Document k] blocks of the non-blank columns; k is the column's place."""
    parts = [F.when(F.trim(F.coalesce(F.col(c), F.lit(""))) != "", F.concat(F.lit(f"[Document {i}]\n"), F.col(c))) for i, c in enumerate(columns, 1)]
    return F.array_join(F.array_compact(F.array(*parts)), "\n\n")


def choice_prompt(question: Column, options: Sequence[Column], context_: Column | None = None) -> Column:
    """A multiple-choice prompt, with the context before the question if there is one."""
    lines = [F.concat(F.lit("Context:\n"), context_, F.lit("\n\n"))] if context_ is not None else []
    lines += [F.lit("Question: "), F.coalesce(question, F.lit("")), F.lit("\n")]
    for letter, option in zip(LETTERS, options):
        lines += [F.lit(f"{letter}: "), F.coalesce(option, F.lit("")), F.lit("\n")]
    return F.concat(*lines, F.lit("Answer:"))


def yes_no_prompt(question: Column, statement: Column) -> Column:
    return F.concat(F.lit("Question: "), F.coalesce(question, F.lit("")), F.lit("\nProposed answer: "), F.coalesce(statement, F.lit("")), F.lit("\nIs it right? Reply 1 for yes, 0 for no:"))


def chat_prompt(system: Column, user: Column) -> Column:
    return F.concat(F.lit("<|system|>\n"), system, F.lit("\n<|user|>\n"), user, F.lit("\n<|assistant|>\n"))


def parse_answer(response: Column, tags: str = r"<[^>]+>", default: str = "A") -> Column:
    """The first letter A-E outside tags, or the default, which also stands for null."""
    found = F.regexp_extract(F.regexp_replace(F.coalesce(response, F.lit("")), tags, ""), "[A-E]", 0)
    return F.when(found == "", default).otherwise(found)


def parse_loose(response: Column) -> Column:
    return parse_answer(response, r"</?think>", "B")


def best_letter(scores: Column) -> Column:
    """The letter with the largest of five scores (array), the first of equals; A if there are none."""
    at = F.array_position(scores, F.array_max(scores)).cast("int")
    return F.when(F.size(scores) > 0, F.element_at(F.array(*map(F.lit, LETTERS)), at)).otherwise("A")


def summed_letters(values: Column, ids: dict[str, Sequence[int]]) -> Column:
    """The values of each letter's token ids (places in the array, from 0) added up, as best_letter takes them. An id outside the array adds nothing."""
    value = lambda i: F.coalesce(F.get(values, F.lit(i)).cast("double"), F.lit(0.0))
    return F.array(*[sum((value(i) for i in dict.fromkeys(ids.get(letter, ()))), F.lit(0.0)) for letter in LETTERS])


def one_if_likelier(p1: Column, p0: Column) -> Column:
    return F.when(p1 >= p0, 1).otherwise(0)


def distribution(rows: DataFrame, label: str) -> DataFrame:
    """(label, n, share)."""
    counts = rows.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(total), F.lit(True)).select("label", "n", (F.col("n") / F.col("total")).alias("share"))  # one row


def accuracy(rows: DataFrame, answer: str, predicted: str) -> DataFrame:
    """One row: accuracy over all rows, over those with an answer (0 if none), and their numbers."""
    same = F.trim(F.coalesce(F.col(answer).cast("string"), F.lit(""))) == F.trim(F.coalesce(F.col(predicted).cast("string"), F.lit("")))
    there = F.trim(F.coalesce(F.col(answer).cast("string"), F.lit(""))) != ""
    return rows.agg(F.count("*").alias("n"), F.count_if(there).alias("n_answered"), F.coalesce(F.avg(same.cast("double")), F.lit(0.0)).alias("accuracy"), F.coalesce(F.avg(F.when(there, same.cast("double"))), F.lit(0.0)).alias("accuracy_answered"))


def error_rows(rows: DataFrame, answer: str, predicted: str) -> DataFrame:
    return rows.where(~F.col(answer).eqNullSafe(F.col(predicted)))


def invalid_answers(rows: DataFrame, predicted: str) -> DataFrame:
    """Rows whose prediction is no letter, with A in its place."""
    return rows.where(~F.coalesce(F.col(predicted).isin(*LETTERS), F.lit(False))).withColumn(predicted, F.lit("A"))


def in_order(ids: DataFrame, metadata: DataFrame, key: str = "chunk_id", position: str = "pos") -> DataFrame:
    """Metadata of a list of ids with positions, in that order; unknown ids have nulls."""
    return ids.join(metadata, key, "left").orderBy(position)


def document_of(candidates: DataFrame, chunks: DataFrame) -> DataFrame:
    """candidates with doc_id, which is the chunk's own id where the chunk is unknown."""
    known = chunks.select("chunk_id", F.col("doc_id").cast("string").alias("__doc"))
    return candidates.join(known, "chunk_id", "left").withColumn("doc_id", F.coalesce("__doc", F.col("chunk_id").cast("string"))).drop("__doc")


def ranks(per: str, order: Sequence[Column]) -> Column:
    return F.row_number().over(Window.partitionBy(per).orderBy(*order))
