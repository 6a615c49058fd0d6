"""Toxicity by a classifier chain.

Categories are predicted one after the other by logistic regressions on the words of a text; each later model also
sees the earlier categories' probabilities. For training these are out-of-fold predictions, so a later model
learns from probabilities as good as those it will see. Words and their beginnings are hashed; the features of the
models are those that tell most about a category on the labelled rows used. The labelled rows used are bounded, so
the models of a category, one without each fold and one on all, are fitted side by side, each in a task.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattframe.llm.token_ids import release_memory
from wattframe.session import cut_lineage

#: Labelled rows the chain is fitted on at most (chosen by hash of doc_id), features kept, folds.
TRAIN_ROWS, FEATURES, FOLDS = 20_000, 1024, 3
HASH_BITS, PREFIXES = 22, (4, 5, 6)
REGULARISATION, STEPS, TOLERANCE = 1e-4, 30, 1e-7
#: Rows of a dense block while fitting.
BLOCK_ROWS = 2_048
#: Words whose features a task remembers.
REMEMBERED = 150_000
#: Hash values a share of rows is chosen by.
SHARES = 1 << 20
EDGES = ".,;:!?\"'()[]<>«»…"


@lru_cache(maxsize=50_000)
def word_features(word: str) -> tuple[int, ...]:
    """Hashes of a word, told apart from those of its beginnings."""
    word = word.strip(EDGES)
    if not word:
        return ()
    parts = [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) > n)]
    return tuple({zlib.crc32(p.encode()) >> (32 - HASH_BITS) for p in parts})


def text_features(text: str | None) -> set[int]:
    return {f for w in set((text or "").lower().split()) for f in word_features(w)}


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("text")
        found = [sorted(text_features(t.as_py())) for t in batch.column(at)]
        rest = [n for n in batch.schema.names if n != "text"]
        yield pa.record_batch([*[batch.column(n) for n in rest], pa.array(found, pa.list_(pa.int32()))], names=[*rest, "features"])
    word_features.cache_clear()
    release_memory()


class Chain:
    """Fitted models: for each category a bias, weights of features, and weights of earlier probabilities."""

    def __init__(self, categories: list[str], features: list[int], models: list[tuple[float, np.ndarray]], threshold: float):
        self.categories, self.models, self.threshold = categories, models, threshold
        self.index = {f: i for i, f in enumerate(features)}
        self.known: dict[str, tuple[int, ...]] = {}

    def forget(self) -> None:
        """At a task's end its worker waits for other stages and should hold little."""
        self.known.clear()
        word_features.cache_clear()
        release_memory()

    def score(self, text: str | None) -> list[float]:
        hits: set[int] = set()
        known = self.known
        for w in set((text or "").lower().split()):
            found = known.get(w)
            if found is None:
                if len(known) > REMEMBERED:
                    known.clear()
                found = known[w] = tuple(self.index[f] for f in word_features(w) if f in self.index)
            if found:
                hits.update(found)
        at, out = list(hits), []
        n = len(self.index)
        for bias, weights in self.models:
            z = bias + float(weights[at].sum()) + sum(weights[n + i] * p for i, p in enumerate(out))
            out.append(1 / (1 + math.exp(-max(-700.0, min(700.0, z)))))
        return out


def _scored(batches: Iterator[pa.RecordBatch], chain: Chain) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", *[f"p_{c}" for c in chain.categories], "rejected"]
    for batch in batches:
        scores = np.array([chain.score(t.as_py()) for t in batch.column(1)]).reshape(len(batch), len(chain.categories))
        yield pa.record_batch([batch.column(0), *[pa.array(scores[:, i]) for i in range(scores.shape[1])], pa.array(scores[:, -1] >= chain.threshold)], names=names)
    chain.forget()


def _unrejected(batches: Iterator[pa.RecordBatch], chain: Chain) -> Iterator[pa.RecordBatch]:
    """Rows the chain does not reject; the last column is the text to score and goes."""
    for batch in batches:
        scores = np.array([chain.score(t.as_py()) for t in batch.column(batch.num_columns - 1)]).reshape(len(batch), len(chain.categories))
        rest = pa.RecordBatch.from_arrays(batch.columns[:-1], schema=pa.schema(list(batch.schema)[:-1]))
        yield rest.filter(pa.array(scores[:, -1] < chain.threshold))
    chain.forget()


def best_threshold(scores: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """The threshold with the best F1; in the middle between the two scores it separates."""
    order = np.argsort(-scores, kind="stable")
    s, w = scores[order], weights[order]
    y = labels[order] * w
    f1 = 2 * np.cumsum(y) / (np.cumsum(w) + y.sum())
    f1[:-1][s[1:] == s[:-1]] = -1
    at = int(np.argmax(f1))
    return float((s[at] + s[at + 1]) / 2) if at + 1 < len(s) else float(s[at])


class Examples:
    """Labelled rows of one fit: the features each has, earlier probabilities, label and weight."""

    def __init__(self, at: list[np.ndarray], earlier: np.ndarray, labels: np.ndarray, weights: np.ndarray, features: int):
        self.at, self.earlier, self.labels, self.weights, self.features = at, earlier, labels, weights, features

    def blocks(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Dense rows with a one in front, labels, and weights that sum to one over all blocks."""
        share = self.weights / self.weights.sum()
        for i in range(0, len(self.at), BLOCK_ROWS):
            some = self.at[i : i + BLOCK_ROWS]
            x = np.zeros((len(some), 1 + self.features + self.earlier.shape[1]))
            x[:, 0] = 1
            x[np.repeat(np.arange(len(some)), [len(a) for a in some]), 1 + np.concatenate(some)] = 1
            x[:, 1 + self.features :] = self.earlier[i : i + BLOCK_ROWS]
            yield x, self.labels[i : i + BLOCK_ROWS], share[i : i + BLOCK_ROWS]

    def loss(self, model: np.ndarray, penalty: np.ndarray) -> float:
        parts = (w @ (np.logaddexp(0, z) - y * z) for x, y, w in self.blocks() for z in (x @ model,))
        return sum(parts) + float(penalty @ model**2) / 2


def fit_logistic(rows: Examples) -> np.ndarray:
    """Bias and weights of the ridge-penalised logistic regression, by Newton steps that are halved until they gain."""
    n = 1 + rows.features + rows.earlier.shape[1]
    penalty = np.full(n, REGULARISATION)
    penalty[0] = 0
    model = np.zeros(n)
    loss = rows.loss(model, penalty)
    for _ in range(STEPS):
        slope, bend = penalty * model, np.diag(penalty)
        for x, y, w in rows.blocks():
            p = 1 / (1 + np.exp(-np.clip(x @ model, -700, 700)))
            slope += x.T @ (w * (p - y))
            # Curvature only shapes the step, so half the digits do; slope and loss decide where it ends.
            half = (x * np.sqrt(w * p * (1 - p))[:, None]).astype(np.float32)
            bend += half.T @ half
        step = np.linalg.lstsq(bend, slope, rcond=None)[0] if bend[0, 0] < 1e-12 else np.linalg.solve(bend, slope)
        size = 1.0
        while (ahead := rows.loss(model - size * step, penalty)) > loss and size > 1e-6:
            size /= 2
        if ahead > loss:
            break
        model, gain, loss = model - size * step, loss - ahead, ahead
        if gain < TOLERANCE:
            break
    return model


FITTED = "model int, weights array<double>"


def _indexed(batches: Iterator[pa.RecordBatch], features: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Replace a row's features by the places, in ``features`` (ascending), of those that are there."""
    for batch in batches:
        at = batch.schema.get_field_index("features")
        found = [np.asarray(f, np.int64) for f in batch.column(at).to_pylist()]
        at_most = [np.minimum(np.searchsorted(features, f), max(0, len(features) - 1)) for f in found]
        places = [a[features[a] == f].astype("<u4").tobytes() if len(features) else b"" for a, f in zip(at_most, found)]
        rest = [n for n in batch.schema.names if n != "features"]
        yield pa.record_batch([*[batch.column(n) for n in rest], pa.array(places, pa.binary())], names=[*rest, "_at"])


def _places(column) -> list[np.ndarray]:
    return [np.frombuffer(a, "<u4").astype(np.int64) for a in column.to_pylist()]


def _earlier(column, depth: int) -> np.ndarray:
    return np.array(column.to_pylist(), float).reshape(len(column), depth)


def _fit_task(table: pa.Table, category: str, features: int, depth: int, rate: float) -> pa.Table:
    table = table.sort_by([(n, "ascending") for n in ("doc_id", "_pick", *table.schema.names[2 : table.schema.get_field_index("_w")])])
    labels, weights = np.asarray(table.column(category), float), np.asarray(table.column("_w"), float)
    if len(np.unique(labels)) < 2:
        # All other folds agree: predict the rate of the whole.
        model = np.append(math.log(rate / (1 - rate)), np.zeros(features + depth))
    else:
        model = fit_logistic(Examples(_places(table.column("_at")), _earlier(table.column("_earlier"), depth), labels, weights, features))
        release_memory()
    return pa.table({"model": pa.array([table.column("_model")[0].as_py()], pa.int32()), "weights": pa.array([model], pa.list_(pa.float64()))})


def _fit_on(category: str, features: int, depth: int, rate: float):
    return lambda table: _fit_task(table, category, features, depth, rate)


def _predicted(batches: Iterator[pa.RecordBatch], models: dict[int, np.ndarray], features: int, depth: int) -> Iterator[pa.RecordBatch]:
    """Append to ``_earlier`` what the model that has not seen a row's fold predicts."""
    for batch in batches:
        at, earlier = _places(batch.column("_at")), _earlier(batch.column("_earlier"), depth)
        folds = batch.column("_fold").to_pylist()
        z = [models[k][0] + models[k][1 + a].sum() + e @ models[k][1 + features :] for k, a, e in zip(folds, at, earlier)]
        p = 1 / (1 + np.exp(-np.clip(np.array(z, float), -700, 700)))
        rest = [n for n in batch.schema.names if n != "_earlier"]
        longer = pa.array(np.column_stack([earlier, p]).tolist(), pa.list_(pa.float64()))
        yield pa.record_batch([*[batch.column(n) for n in rest], longer], names=[*rest, "_earlier"])


def _share(df: DataFrame, chosen_by: Column, wanted: int, there: int) -> DataFrame:
    share = min(1.0, wanted / max(1, there))
    return df.where(F.pmod(chosen_by, F.lit(SHARES)) < int(share * SHARES))


def fit_chain(docs: DataFrame, labels: DataFrame, categories: list[str], train_rows: int = TRAIN_ROWS, features: int = FEATURES, folds: int = FOLDS) -> Chain:
    """Fit a chain on ``labels`` (doc_id and one 0/1 column for each category, the deciding one last).

    Of more labelled rows than ``train_rows`` about that many are used, chosen by hash of doc_id and text. Rows with a
    null label or id and labels without a document are left out; a document labelled twice counts twice, as a row of
    double weight. A category that has a single value on the rows used gets that value's constant model; without rows
    nothing is ever rejected.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), *[F.col(c).cast("double").alias(c) for c in categories]).dropna()
    known = known.groupBy("doc_id", *categories).agg(F.count(F.lit(1)).alias("_w"))
    # At most about train_rows narrow rows, so the side that is broadcast is bounded.
    used = _share(known, F.xxhash64("doc_id"), train_rows, known.count())
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(used), "doc_id").withColumn("_pick", F.xxhash64("doc_id", F.lit(2), "text"))
    # Rows of one id and text are one row of more weight, so repeated rows stay few.
    fields = ["doc_id", "_pick", *categories]
    rows = rows.groupBy(*fields).agg(F.sum("_w").alias("_w"), F.any_value("text").alias("text"))
    ddl = ", ".join(["doc_id bigint, _pick bigint", *[f"`{c}` double" for c in categories], "_w bigint, features array<int>"])
    rows = cut_lineage(rows.mapInArrow(_featured, ddl))
    rows = _share(rows, F.col("_pick"), train_rows, rows.count())

    totals = rows.agg(F.sum("_w").alias("n"), *[F.sum(F.col(c) * F.col("_w")).alias(c) for c in categories]).first()
    n = totals["n"]
    if not n:
        return Chain(categories, [], [(-700.0, np.zeros(i)) for i in range(len(categories))], 0.5)
    seen = rows.select(F.explode("features").alias("f"), "_w", *categories).groupBy("f").agg(F.sum("_w").alias("_n"), *[F.sum(F.col(c) * F.col("_w")).alias(c) for c in categories])
    # Signed distance from independence in standard errors, per category.
    told = [F.abs(F.col(c) - F.col("_n") * (totals[c] / n)) / F.sqrt(F.col("_n") * (totals[c] / n) * (1 - totals[c] / n) + 1) for c in categories]
    top = seen.where("_n >= 3").select("f", F.greatest(*told).alias("_told") if len(told) > 1 else told[0].alias("_told"))
    names = sorted(r["f"] for r in top.orderBy(F.desc("_told"), "f").limit(features).collect())
    fold = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(folds)).cast("int")
    ddl = ", ".join(["doc_id bigint, _pick bigint", *[f"`{c}` double" for c in categories], "_w bigint, _fold int, _earlier array<double>, _at binary"])
    state = rows.select(*fields, "_w", fold.alias("_fold"), F.array().cast("array<double>").alias("_earlier"), "features")
    state = state.mapInArrow(lambda it, known=np.array(names, np.int64): _indexed(it, known), ddl)
    order = [*fields, "_w", "_fold", "_at", "_earlier"]
    state = cut_lineage(state.select(*order))
    grown = ddl.replace(", _earlier array<double>, _at binary", ", _at binary, _earlier array<double>")
    models, threshold = [], 0.5
    for i, c in enumerate(categories):
        if totals[c] in (0.0, float(n)):
            models.append((700.0 if totals[c] else -700.0, np.zeros(len(names) + i)))
            state = state.withColumn("_earlier", F.concat("_earlier", F.array(F.lit(1.0 if totals[c] else 0.0))))
            threshold = 0.5
            continue
        # Model k leaves fold k out; the last one is fitted on all.
        cells = state.withColumn("_model", F.explode(F.sequence(F.lit(0), F.lit(folds)))).where("_model != _fold")
        task = _fit_on(c, len(names), i, totals[c] / n)
        fitted = {r["model"]: np.array(r["weights"]) for r in cells.groupBy("_model").applyInArrow(task, FITTED).collect()}
        models.append((float(fitted[folds][0]), fitted[folds][1:]))
        for k in range(folds):
            fitted.setdefault(k, np.append(math.log(totals[c] / (n - totals[c])), np.zeros(len(names) + i)))
        state = state.mapInArrow(lambda it, fitted=fitted, i=i: _predicted(it, fitted, len(names), i), grown)
        if i + 1 == len(categories):
            pairs = state.select(F.col("_earlier")[i].alias("_p"), c, "_w").toPandas()
            threshold = best_threshold(pairs["_p"].to_numpy(), pairs[c].to_numpy(), pairs["_w"].to_numpy())
    return Chain(categories, names, models, threshold)


def score_toxicity(docs: DataFrame, labels: DataFrame, categories: list[str], train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, ``p_<category>`` for each category and ``rejected`` for every row of ``docs``.

    ``rejected``: the last category's probability reaches the threshold with the best F1 out of fold. Whole texts are
    read; a null or empty text has no features. Rows that repeat a doc_id are scored each, null ids too; an empty
    table gives an empty result; other columns are ignored.
    """
    chain = fit_chain(docs, labels, categories, train_rows)
    ddl = ", ".join(["doc_id bigint", *[f"`p_{c}` double" for c in categories], "rejected boolean"])
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(lambda it: _scored(it, chain), ddl)


def without_toxic(docs: DataFrame, labels: DataFrame, categories: list[str], train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``score_toxicity`` does not reject; each row by its own text."""
    chain = fit_chain(docs, labels, categories, train_rows)
    scored = docs.select("*", F.col("text").cast("string").alias("_scored text"))
    return scored.mapInArrow(lambda it: _unrejected(it, chain), docs.schema)
