"""Log-bilinear language model, trained with noise-contrastive estimation, and its scores.

Words fall into groups: each of the most frequent is a group of its own, the others share classes by their last letters,
and the end of a text is a group too. The number of groups follows the number of training tokens. The model predicts the
group of a token from the two tokens before: each context vector times the matrix of its distance, their sum times the
target's vector, plus a bias. The word within a class is predicted by its smoothed count.

Training uses the counts of all pairs of groups at distances one and two in all training texts, gathered over the whole
corpus, so the contrastive objective is evaluated for every pair at once, with the noise taken in expectation instead of by
sampling, and runs until it stops falling. The weight of the second distance maximises the likelihood of all training
tokens. Batched products of all contexts with all targets give the scores, and the product of the two distances' tables
gives the sum over all targets for every pair of contexts, so log-probabilities are normalised.

Word counts are a distributed table. Its frequent head, of bounded size, is broadcast; occurrences of all other words meet
their counts in a join on the word, where no key can be hot, as each such word is rarer than all of the head. Words over
LONG bytes are counted under a digest of theirs, so that they can be in the head as well.
"""

from __future__ import annotations

import zlib
from collections import Counter
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, arrow_schema, in_fold, prepare, record, trimmed

#: Words whose counts are broadcast: at most 16 MB, as longer words than LONG bytes stand under a digest.
HEAD, LONG = 1 << 18, 64
_COUNTED = 400_000
#: Tokens whose pairs wait to be counted, and cells of a table of pairs that are passed on at once.
AT_ONCE, CELLS = 1 << 18, 1 << 18
_SCORED = "kind int, rid long, doc_id long, held_out boolean, n_tokens long, n_known long, n_rare long, base double, score double, word binary, times int"


def group_sizes(n_tokens: int) -> tuple[int, int]:
    """Groups of single words, and classes of other words: both follow the fourth root of the training tokens, so that pairs of groups grow as its square and each still has more tokens to learn from."""
    single = max(16, round(9 * n_tokens**0.25))
    return single, max(16, single // 5)


def words(text: str) -> list[bytes]:
    """The words of a text; long ones as a digest that no word can be, since it is not UTF-8."""
    return [w if len(w) <= LONG else b"\xff" + blake2b(w, digest_size=24).digest() for w in text.encode().lower().split()]


def class_of(word: bytes, classes: int) -> int:
    """A class by the last three bytes before any punctuation."""
    return zlib.crc32(word.rstrip(b".,;:!?")[-3:]) % classes


@trimmed
def _count(batches):
    """Word counts of a partition, passed on whenever they grow large."""
    schema, counts = arrow_schema("word binary, n long"), Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            counts.update(words(text))
        if len(counts) > _COUNTED:
            yield record(schema, len(counts), word=[*counts], n=[*counts.values()])
            counts = Counter()
    yield record(schema, len(counts), word=[*counts], n=[*counts.values()])


def _class_totals(single, classes: int):
    schema = arrow_schema("class int, total long, distinct long")

    @trimmed
    def add(batches):
        total, distinct = np.zeros(classes, np.int64), np.zeros(classes, np.int64)
        for batch in batches:
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if word not in single.value:
                    total[class_of(word, classes)] += n
                    distinct[class_of(word, classes)] += 1
        yield record(schema, classes, **{"class": range(classes), "total": total, "distinct": distinct})

    return add


class Head:
    """The most frequent words and their counts, most frequent first, as one text and two arrays: a worker makes one dictionary of them, and none for what it only looks up by place."""

    def __init__(self, words: list[bytes], counts: np.ndarray):
        self.text, self.lengths, self.counts = b"".join(words), np.array([len(w) for w in words], np.uint8), np.asarray(counts, np.int64)

    def words(self):
        at = 0
        for n in self.lengths.tolist():
            yield self.text[at : at + n]
            at += n


class Groups:
    """The group of each word, by the place of a word in the head; the end stands behind all words."""

    def __init__(self, head: Head, single: int, classes: int):
        self.single, self.classes, self.end = single, classes, single + classes
        self.place = {w: i for i, w in enumerate(head.words())}
        self.of_place = np.array([*(i if i < single else single + class_of(w, classes) for w, i in self.place.items()), self.end], np.int32)

    def places(self, ws: list[bytes]) -> np.ndarray:
        """Where each word and the end stand in the head; -1 for other words."""
        return np.array([*map(self.place.get, ws, [-1] * len(ws)), len(self.place)], np.int64)

    def of(self, ws: list[bytes], at: np.ndarray) -> np.ndarray:
        """The groups of words, and the end, of these places."""
        g = self.of_place[at].astype(np.int64)
        for i in np.flatnonzero(at < 0):
            g[i] = self.single + class_of(ws[i], self.classes)
        return g


def contexts(g: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The groups one and two tokens before each: before a text stands its end."""
    return np.concatenate([[end], g[:-1]]), np.concatenate([[end, end], g[:-2]])[: len(g)]


def _pairs(head, single: int, classes: int, most: int = 1 << 30):
    """How often each group follows each at distances one and two: the counts of a partition, passed on in parts of CELLS and whenever `most` tokens are counted, so that counts of 32 bits do."""
    schema = arrow_schema("distance int, before int, after int, n long")

    @trimmed
    def count(batches):
        groups, counted = Groups(head.value, single, classes), 0
        size = groups.end + 1
        tables = np.zeros((2, size * size), np.int32)

        def passed_on():
            for distance, table in enumerate(tables):
                for low in range(0, len(table), CELLS):
                    part = table[low : low + CELLS]
                    cells = np.flatnonzero(part)
                    if len(cells):
                        yield record(schema, len(cells), distance=np.full(len(cells), distance, np.int32), before=((cells + low) // size).astype(np.int32), after=((cells + low) % size).astype(np.int32), n=part[cells].astype(np.int64))

        def add(held):
            for table, cells in zip(tables, zip(*held)):
                np.add.at(table, np.concatenate(cells), 1)

        for batch in batches:
            held, n = [], 0
            for text in batch.column(0):
                ws = words(text.as_py())
                if counted and counted + len(ws) >= most:
                    if held:
                        add(held)
                    yield from passed_on()
                    tables[:] = 0
                    held, n, counted = [], 0, 0
                g = groups.of(ws, groups.places(ws))
                held.append([before * size + g for before in contexts(g, groups.end)])
                n, counted = n + len(g), counted + len(g)
                if n > AT_ONCE:
                    add(held)
                    held, n = [], 0
            if held:
                add(held)
        yield from passed_on()

    return count


def _packed_rows(size: int):
    """The counts of one group before as a compressed row, byte planes apart, so that little goes to the driver."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        import zstandard

        row = np.zeros(size, np.int64)
        row[pdf["after"]] = pdf["n"]
        return pd.DataFrame({"distance": pdf["distance"].iloc[:1], "before": pdf["before"].iloc[:1], "row": [zstandard.compress(row.view(np.uint8).reshape(-1, 8).T.tobytes())]})

    return pack


def _unpacked_row(blob: bytes) -> np.ndarray:
    import zstandard

    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(8, -1).T).view(np.int64).ravel()


def train(pairs: np.ndarray, width: int = 24, noise: float = 20.0, rate: float = 0.05, seed: int = 7, check: int = 25, least: float = 2e-5, most: int = 1000) -> np.ndarray:
    """log10 P(after | before) for all groups, from counts of pairs [before, after].

    The score of a pair is (r[before] @ c) @ q[after] + b[after]. Noise-contrastive estimation with `noise` noise tokens a
    data token, drawn from the groups' frequencies: the data should be told from the noise with score - log(noise * p).
    Every `check` steps the loss is compared; when it has fallen by less than a share of `least` in a step on average, the
    rate is halved, and after the fifth time training ends (or after `most` steps).
    """
    size, rng = len(pairs), np.random.default_rng(seed)
    unigram = (pairs.sum(axis=0) + 0.5) / (pairs.sum() + 0.5 * size)
    single = np.float32  # precise enough for gradients; the table is normalised in double
    r, q = rng.normal(0, 0.1, (size, width)).astype(single), rng.normal(0, 0.1, (size, width)).astype(single)
    c, b = np.eye(width, dtype=single), np.log(unigram).astype(single)
    of_before = pairs.sum(axis=1, keepdims=True) + 0.05
    data = ((pairs + 0.05 * unigram) / of_before).astype(single)
    weight = np.sqrt(of_before / of_before.sum())  # contexts that are rare still count
    weight = (weight / weight.sum()).astype(single)
    params, first, second = [r, c, q, b], [0.0] * 4, [0.0] * 4
    offset, noisy = np.log(noise * unigram).astype(single), (noise * unigram).astype(single)
    before, halved = np.inf, 0
    for step in range(1, most + 1):
        h = r @ c
        margin = np.clip(h @ q.T + b - offset, -40, 40)
        is_data = 1 / (1 + np.exp(-margin))
        if step % check == 0:
            loss = float((weight * (np.log1p(np.exp(-margin)) * data + np.log1p(np.exp(margin)) * noisy)).sum())
            if before - loss < least * check * loss:
                halved, rate = halved + 1, rate / 2
                if halved > 4:
                    break
            before = loss
        d = weight * (data - (data + noisy) * is_data)  # gradient by the score
        dh = d @ q
        grads = [dh @ c.T, r.T @ dh, d.T @ h, d.sum(axis=0)]
        for i, g in enumerate(grads):
            g = g / (np.abs(g).mean() + 1e-12)
            first[i], second[i] = 0.9 * first[i] + 0.1 * g, 0.99 * second[i] + 0.01 * g * g
            params[i] += (rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-8)).astype(single)
    logits = (r @ c).astype(float) @ q.T.astype(float) + b
    logits -= logits.max(axis=1, keepdims=True)
    return (logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))) / np.log(10)


def joined(near: np.ndarray, far: np.ndarray, pairs: np.ndarray, far_pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The score tables of the two distances [before, after] and the log10 of their sums over all targets [one before, two before].

    A token's log10 probability is near[one before, it] + far[two before, it] - total[one before, two before]. The far table
    counts as far as it differs from the unigram, with the weight that makes the training tokens likeliest.
    """
    counts = far_pairs.sum(axis=0) + 0.5
    excess = far - np.log10(counts / counts.sum())
    best = None
    for weight in (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.8, 1.0):
        more = weight * excess
        high = more.max(axis=1)
        total = np.log10(10**near @ (10 ** (more - high[:, None])).T) + high
        likelihood = (pairs * near).sum() + (far_pairs * more).sum() - (pairs.T * total).sum()
        if best is None or likelihood > best[0]:
            best = likelihood, more, total
    return near.astype(np.float32), best[1].astype(np.float32), best[2].astype(np.float32)


def _score(head, model, single: int, classes: int, n_all: float, v_all: float, ends: int):
    """Scores of all but the rare words of each text, and the rare words with their numbers."""
    schema = arrow_schema(_SCORED)

    @trimmed
    def score(batches):
        from pyspark import TaskContext

        rid, groups = TaskContext.get().partitionId() << 32, Groups(head.value, single, classes)
        near, far, total, class_floor = model.value
        group_of, head_counts = groups.of_place, head.value.counts
        counts = np.log10(np.append(head_counts, ends).astype(float) + 0.1)
        within = np.where((group_of >= single) & (group_of < groups.end), counts - class_floor[np.clip(group_of - single, 0, classes - 1)], 0.0)
        floor = np.log10(n_all + 0.1 * (v_all + 1))
        seen = np.append(head_counts > 0, ends > 0)
        seldom = np.append(head_counts <= 1, False)  # the end is no word
        for batch in batches:
            docs, rare = [], []
            for doc_id, held_out, text in zip(*(batch.column(i) for i in range(3))):
                doc_id, held_out, ws = doc_id.as_py(), held_out.as_py(), words(text.as_py())
                at = groups.places(ws)
                others = Counter(ws[i] for i in np.flatnonzero(at < 0))
                g = groups.of(ws, at)
                known = at >= 0
                one, two = contexts(g, groups.end)
                lm = (near[one, g] + far[two, g] - total[one, two]).sum(dtype=float) + within[at[known]].sum() - class_floor[g[~known] - single].sum()
                docs.append((rid, doc_id, held_out, len(g), int(seen[at[known]].sum()), int(seldom[at[known]].sum()), float(counts[at[known]].sum() - floor * len(g)), float(lm)))
                rare += [(rid, w, n) for w, n in others.items()]
                rid += 1
            names = ("rid", "doc_id", "held_out", "n_tokens", "n_known", "n_rare", "base", "score")
            yield record(schema, len(docs), kind=[0] * len(docs), **{k: [d[i] for d in docs] for i, k in enumerate(names)})
            if rare:
                yield record(schema, len(rare), kind=[1] * len(rare), rid=[x[0] for x in rare], word=[x[1] for x in rare], times=[x[2] for x in rare])

    return score


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, rare_share: one row per input row.

    Texts whose crc32(id as text) leaves a remainder by `folds` are learned from; the others are held out. Tokens are the
    words (A-Z lower-cased, between ASCII white space) and one end. base_score is the smoothed unigram log10 probability,
    score the model's, rare_share the share of tokens whose word stands at most once in the training text: a text learned
    from has as many as it has words of its own, one that stands there twice has none. Null texts are empty: one token, the end. A null id counts as the empty text for the fold. Equal
    counts are ordered by the word. Repeated rows are learned from and scored each for itself. If nothing can be learned,
    every token is unknown and the model knows no order. A very long text is held whole. An empty table gives no rows. Other
    columns are not read.
    """
    spark = prepare(docs.sparkSession)
    ws = Workspace(spark, "lm")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), (in_fold(F.col(id_col), folds) == 0).alias("held_out"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    learned = source.where(~F.col("held_out")).select("text")
    counts = ws.write(learned.mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "counts")
    ends = learned.count()
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n_all, v_all = n + ends, v + (ends > 0)
    # The head is a range of frequency classes, so that no task has to send more than its share of at most HEAD words.
    single, classes = group_sizes(int(n_all))
    short = counts.withColumn("level", F.floor(64 * F.log2("n")))
    levels = short.groupBy("level").count().toPandas().sort_values("level", ascending=False)  # at most 64 x 63 rows
    fits = levels[levels["count"].cumsum() <= HEAD]["level"]
    top = short.where(F.col("level") >= int(fits.min())).select("word", "n").toPandas() if len(fits) else pd.DataFrame({"word": [], "n": []})
    top["word"] = top["word"].map(bytes)
    top = top.sort_values(["n", "word"], ascending=[False, True])
    head = spark.sparkContext.broadcast(Head([*top["word"]], top["n"].to_numpy(np.int64)))
    alone = spark.sparkContext.broadcast(set(top["word"][:single]))
    totals = counts.mapInArrow(_class_totals(alone, classes), "class int, total long, distinct long").groupBy("class").agg(F.sum("total").alias("total"), F.sum("distinct").alias("distinct")).toPandas().set_index("class").reindex(range(classes), fill_value=0)
    gathered = learned.mapInArrow(_pairs(head, single, classes), "distance int, before int, after int, n long").groupBy("distance", "before", "after").agg(F.sum("n").alias("n"))
    size = single + classes + 1
    pairs = np.zeros((2, size, size))
    for r in gathered.groupBy("distance", "before").applyInPandas(_packed_rows(size), "distance int, before int, row binary").toPandas().itertuples():  # at most 2 size rows
        pairs[r.distance, r.before] = _unpacked_row(bytes(r.row))
    class_floor = np.log10(totals["total"].to_numpy(float) + 0.1 * (totals["distinct"].to_numpy(float) + 1))
    model = spark.sparkContext.broadcast((*joined(train(pairs[0]), train(pairs[1]), *pairs), class_floor))

    scored = ws.write(source.mapInArrow(_score(head, model, single, classes, float(n_all), float(v_all), ends), _SCORED), "scored", "kind")
    ws.drop()
    rare = scored.where("kind = 1").select("rid", "word", "times")
    tail = rare.join(counts, "word", "left").groupBy("rid").agg(F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(0.1))).alias("more"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("known"), F.sum(F.when(F.coalesce("n", F.lit(0)) <= 1, F.col("times")).otherwise(0)).alias("rare"))
    out = scored.where("kind = 0").join(tail, "rid", "left")
    more = F.coalesce("more", F.lit(0.0))
    return out.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(int(n_all)).cast("long").alias("train_tokens"), (F.col("base") + more).alias("base_score"), (F.col("score") + more).alias("score"), ((F.col("n_rare") + F.coalesce("rare", F.lit(0))) / F.col("n_tokens")).alias("rare_share"))
