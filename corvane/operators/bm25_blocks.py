"""BM25 postings in blocks with their largest weight, and an exact top-k that passes over blocks by that bound.

Texts are numbered by length, so that texts of like weights stand together, and numbers are cut into ranges. The postings of a
token in a range are one block: gaps between numbers, counts, lengths, and the largest weight among them. For a query, the
sum of its blocks' largest weights bounds the score of every text of a range. The most promising ranges of each query are
scored first; the kth best score there is a threshold, and only ranges whose bound reaches it are read after that.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..sources.batches import bounded
from ..sources.scratch import stored
from .bm25 import Bm25Index, asked_in_groups
from .ordering import number_rows

#: Texts of a range, and ranges of a query that are scored first.
RANGE, PROBES = 16, 64
#: Scores this close count as equal, as sums of floating-point numbers depend on their order.
CLOSE = 1e-9


@dataclass
class BlockIndex:
    """blocks (token, range, n, most, gaps, tfs, lens), numbers (chunk_id, number), idf and one row of metadata. most: the largest weight without idf."""

    blocks: DataFrame
    numbers: DataFrame
    idf: DataFrame
    metadata: DataFrame
    size: int


def _groups(batches: Iterable[pa.RecordBatch], *keys: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows that come sorted by keys, without nulls, as tables of whole groups, and where these begin."""
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([held, rows]).combine_chunks() if held is not None else rows
        if not rows.num_rows:
            continue
        change = np.ones(rows.num_rows, bool)
        change[1:] = False
        for key in keys:
            c = rows.column(key).combine_chunks()
            change[1:] |= pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(change)
        if starts[-1]:  # the last group may go on
            yield rows.slice(0, starts[-1]), starts[:-1]
        held = rows.slice(starts[-1])
    if held is not None and held.num_rows:
        yield held, np.zeros(1, np.int64)


def _flat(t: pa.Table, name: str) -> np.ndarray:
    return t.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)


def write_blocks(index: Bm25Index, path: str, size: int = RANGE) -> BlockIndex:
    """The postings of an index in blocks, as tables below path. Postings are numbered by chunk, dealt by ranges of (token, range), sorted, and made blocks as they stand, so a frequent token spreads over files."""
    spark = index.postings.sparkSession
    bounded(spark)
    n, meta = int(spark.conf.get("spark.sql.shuffle.partitions")), index.metadata.first()
    k1, b, avgdl = (float(meta[c]) for c in ("k1", "b", "avgdl"))
    number_rows(index.lengths, "number", "chunk_len", "chunk_id").write.mode("overwrite").parquet(f"{path}/numbers")
    numbers = spark.read.parquet(f"{path}/numbers")
    rows = index.postings.join(numbers, "chunk_id").select("token", F.expr(f"number div {size}").alias("range"), "number", F.col("tf").cast("int").alias("tf"), F.col("chunk_len").cast("int").alias("len"))
    dealt = rows.repartitionByRange(n, "token", "range").sortWithinPartitions("token", "number")

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in _groups(batches, "token", "range"):
            number, of_range, tf, length = (t.column(c).to_numpy() for c in ("number", "range", "tf", "len"))
            gaps = np.diff(number, prepend=0)
            gaps[starts] = number[starts] - of_range[starts] * size
            weight = tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / avgdl))
            ends = pa.array(np.append(starts, t.num_rows), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(v, kind)) for v, kind in ((gaps.astype(np.int16), pa.int16()), (tf, pa.int32()), (length, pa.int32()))]
            counts = np.diff(np.append(starts, t.num_rows)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([t.column("token").combine_chunks().take(pa.array(starts)), pa.array(of_range[starts]), pa.array(counts), pa.array(np.maximum.reduceat(weight, starts)), *lists], names=["token", "range", "n", "most", "gaps", "tfs", "lens"])

    blocks = dealt.mapInArrow(make, "token string, range long, n int, most double, gaps array<short>, tfs array<int>, lens array<int>")
    blocks.write.mode("overwrite").parquet(f"{path}/blocks")
    index.idf.write.mode("overwrite").parquet(f"{path}/idf_table")
    index.metadata.withColumn("size", F.lit(size)).coalesce(1).write.mode("overwrite").parquet(f"{path}/metadata")
    return read_blocks(spark, path)


def read_blocks(spark, path: str) -> BlockIndex:
    metadata = spark.read.parquet(f"{path}/metadata")
    return BlockIndex(spark.read.parquet(f"{path}/blocks"), spark.read.parquet(f"{path}/numbers"), spark.read.parquet(f"{path}/idf_table"), metadata, metadata.first()["size"])


def postings_of(index: BlockIndex) -> DataFrame:
    """(token, chunk_id, tf): the blocks taken apart, once each has met the keys of its range."""
    kind = dict(index.numbers.dtypes)["chunk_id"]
    bounded(index.blocks.sparkSession)
    keys = index.numbers.groupBy(F.expr(f"number div {index.size}").alias("range")).agg(F.array_sort(F.collect_list(F.struct("number", "chunk_id"))).alias("keys")).select("range", F.col("keys.chunk_id").alias("keys"))

    def apart(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = pa.Table.from_batches([batch])
            sizes = pc.list_value_length(batch.column(1)).to_numpy()
            if not len(sizes):
                continue
            gaps, starts = _flat(t, "gaps").astype(np.int64), np.cumsum(sizes) - sizes
            run = np.cumsum(gaps)
            widths = pc.list_value_length(batch.column(3)).to_numpy().astype(np.int64)
            place = run + np.repeat(np.cumsum(widths) - widths - (run[starts] - gaps[starts]), sizes)
            of_block = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(of_block), batch.column(3).flatten().take(pa.array(place)), pa.array(_flat(t, "tfs").astype(np.int64))], names=["token", "chunk_id", "tf"])

    met = index.blocks.select("token", "range", "gaps", "tfs").join(keys, "range").select("token", "gaps", "tfs", "keys")
    return met.mapInArrow(apart, f"token string, chunk_id {kind}, tf long")


def _asked(index: BlockIndex, queries: DataFrame, distinct: bool) -> list[DataFrame]:
    """(query_id, token, weight) in groups that can be broadcast: a token's idf, times its number in the query unless distinct."""
    return [g.select("query_id", "token", (F.col("idf") if distinct else F.col("idf") * F.col("qtf")).alias("weight")) for g in asked_in_groups(queries, index.idf)]


def _score(index: BlockIndex, asked: list[DataFrame], chosen: DataFrame, few: bool = False) -> DataFrame:
    """(query_id, number, score) of all texts of the chosen (query_id, range, least) that reach `least`. few: the chosen ranges can be broadcast."""
    return reduce(DataFrame.unionByName, [_scored(index, a, chosen, few) for a in asked])


def _scored(index: BlockIndex, asked: DataFrame, chosen: DataFrame, few: bool) -> DataFrame:
    """_score for one group of queries. A range's blocks of asked tokens are dealt to one task, once for all queries, and so are the queries that chose it."""
    spark, size = asked.sparkSession, index.size
    bounded(spark)
    kind, meta = asked.schema["query_id"].dataType, index.metadata.first()
    n, (k1, b, avgdl) = int(spark.conf.get("spark.sql.shuffle.partitions")), (float(meta[c]) for c in ("k1", "b", "avgdl"))
    rows = asked.toPandas().sort_values("token", kind="stable")  # about ASKED at most
    names, who = np.unique(rows["query_id"].to_numpy(), return_inverse=True)
    tokens, starts = np.unique(rows["token"].to_numpy(), return_index=True)
    numbers = {name: i for i, name in enumerate(names.tolist())}
    sent = spark.sparkContext.broadcast((names.tolist(), numbers, {t: i for i, t in enumerate(tokens.tolist())}, np.append(starts, len(rows)), who, rows["weight"].to_numpy(float)))
    blocks = index.blocks.join(F.broadcast(asked.select("token").distinct()), "token", "left_semi")
    if few:
        blocks = blocks.join(F.broadcast(chosen.select("range").distinct()), "range", "left_semi")
    held = blocks.select("range", F.lit(None).cast(kind).alias("query_id"), F.lit(0.0).alias("least"), "token", "gaps", "tfs", "lens")
    both = held.unionByName(chosen.select("range", "query_id", "least"), allowMissingColumns=True).repartition(n, "range").sortWithinPartitions("range")

    def add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, number_of, token_of, ptr, who, weight = sent.value
        ids = pa.array(names, to_arrow_type(kind))
        for t, starts in _groups(batches, "range"):
            out, query, token = [], t.column("query_id").to_pylist(), t.column("token").to_pylist()
            of_range, least = t.column("range").to_numpy(), t.column("least").to_numpy()
            is_block = np.array([x is not None for x in token])
            sizes = pc.fill_null(pc.list_value_length(t.column("gaps").combine_chunks()), 0).to_numpy(zero_copy_only=False)
            at = np.append(0, np.cumsum(sizes))
            gaps, tf, lens = _flat(t, "gaps").astype(np.int64), _flat(t, "tfs").astype(float), _flat(t, "lens").astype(float)
            run, part = np.cumsum(gaps), tf * (k1 + 1) / (tf + k1 * (1 - b + b * lens / avgdl))
            for low, high in zip(starts, [*starts[1:], t.num_rows]):
                wanted = [i for i in range(low, high) if not is_block[i] and query[i] in number_of]
                mine = np.flatnonzero(is_block[low:high]) + low
                if not wanted or not len(mine):
                    continue
                table = np.zeros((len(mine), size))
                for r, i in enumerate(mine):
                    x, y = at[i], at[i + 1]
                    table[r, run[x:y] - run[x] + gaps[x]] = part[x:y]
                codes = np.array([token_of[token[i]] for i in mine])
                many = ptr[codes + 1] - ptr[codes]
                entry = np.repeat(ptr[codes] - (np.cumsum(many) - many), many) + np.arange(many.sum())
                q, values = who[entry], table[np.repeat(np.arange(len(mine)), many)] * weight[entry, None]
                found, place = np.unique(q, return_inverse=True)
                score = np.bincount((place[:, None] * size + np.arange(size)).ravel(), values.ravel(), minlength=len(found) * size).reshape(-1, size)
                limit = np.full(len(names), np.inf)
                limit[[number_of[query[i]] for i in wanted]] = least[wanted]
                rows, cols = np.nonzero((score > 0) & (score >= limit[found][:, None]))
                if len(rows):
                    out.append((found[rows], of_range[low] * size + cols, score[rows, cols]))
            if out:
                q, number, score = map(np.concatenate, zip(*out))
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(q)), pa.array(number), pa.array(score)], names=["query_id", "number", "score"])

    return both.mapInArrow(add_up, f"query_id {kind.simpleString()}, number long, score double")


@dataclass
class Choice:
    """bounds (query_id, range, bound, n_blocks) of all ranges, top: those of them that are scored first, first: their scores, left: the ranges still to read, with the score to reach."""

    bounds: DataFrame
    top: DataFrame
    first: DataFrame
    left: DataFrame


def choose(index: BlockIndex, queries: DataFrame, k: int, distinct: bool = False, probes: int = PROBES) -> Choice:
    """bounds, top and first are stored tables. Blocks are dealt by range before queries multiply them, so their bounds are added up where they arise. Tasks pass on their own `probes` largest bounds of a query, so no task sorts all of one."""
    asked = _asked(index, queries, distinct)
    most = [index.blocks.select("token", "range", "most").join(F.broadcast(a.select("token").distinct()), "token", "left_semi").repartition("range").join(F.broadcast(a), "token") for a in asked]
    bounds = stored(reduce(DataFrame.unionByName, [m.groupBy("query_id", "range").agg(F.sum(F.col("weight") * F.col("most")).alias("bound"), F.count("*").alias("n_blocks")) for m in most]))
    by_bound = Window.partitionBy("query_id").orderBy(F.desc("bound"), "range")
    top = stored(bounds.withColumn("place", F.row_number().over(by_bound)).where(F.col("place") <= probes).drop("place"))
    first = stored(_score(index, asked, top.select("query_id", "range", F.lit(float("-inf")).alias("least")), few=True))
    kth = first.withColumn("i", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score")))).where(F.col("i") == k).select("query_id", F.col("score").alias("kth"))
    reach = bounds.join(kth, "query_id", "left").withColumn("least", F.coalesce(F.col("kth") - 2 * CLOSE, F.lit(float("-inf")))).where(F.col("bound") >= F.col("least"))
    return Choice(bounds, top, first, reach.join(top.select("query_id", "range"), ["query_id", "range"], "left_anti").select("query_id", "range", "least", "n_blocks"))


def topk(index: BlockIndex, queries: DataFrame, k: int, distinct: bool = False, probes: int = PROBES) -> DataFrame:
    """(query_id, chunk_id, bm25_score, bm25_rank) as bm25.topk gives them, from the blocks that can matter.

    Queries (query_id, tokens) with no known token have no rows. Bounds take one small row a query and range with a
    common token, and a range's texts are scored together, so no task meets all postings of a frequent token.
    """
    chosen = choose(index, queries, k, distinct, probes)
    rest = _score(index, _asked(index, queries, distinct), chosen.left.drop("n_blocks"))
    best = Window.partitionBy("query_id").orderBy(F.desc(F.round("bm25_score", 9)), "chunk_id")
    found = chosen.first.unionByName(rest).join(index.numbers.select("number", "chunk_id"), "number").select("query_id", "chunk_id", F.col("score").alias("bm25_score"))
    return found.withColumn("bm25_rank", F.row_number().over(best)).where(F.col("bm25_rank") <= k)


def blocks_read(index: BlockIndex, queries: DataFrame, k: int, distinct: bool = False, probes: int = PROBES) -> DataFrame:
    """One row: the blocks that the queries' tokens have, those that topk reads, and their share."""
    chosen = choose(index, queries, k, distinct, probes)
    total = lambda df, name: df.agg(F.coalesce(F.sum("n_blocks"), F.lit(0)).alias(name))
    row = total(chosen.bounds, "blocks").join(total(chosen.top, "first"), F.lit(True)).join(total(chosen.left, "more"), F.lit(True))  # one row each
    return row.select("blocks", (F.col("first") + F.col("more")).alias("blocks_read")).withColumn("share", F.col("blocks_read") / F.col("blocks"))
