"""Quality classifier: naive Bayes support vectors.

N-grams of words and of token shapes, hashed into ``2**BITS`` features, count once per document. Their log-count ratios
between the classes come from all labelled documents. A linear model with squared hinge loss is then
fitted on the scaled indicators by dual coordinate descent, over a bounded sample of the labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lonja.llm.rows import byte_column, rows_by_bytes, small_batches
from lonja.llm.words import Hasher, Shapes, mix
from lonja.session import materialized

BITS = 18
#: Most documents of each class in the sample that the linear model is fitted on.
SAMPLE = 3000
#: Most features of all documents of that sample together: beyond it, the sample has fewer documents.
FEATURES = 24_000_000
#: Longest n-gram of token shapes, and the shares of a text's tokens that make features of their own.
SHAPE_GRAM = 4
SHARES = (0.0, 0.05, 0.2)
#: Bytes of text whose features are taken at once; that takes some fifty times as much memory.
SLICE = 256 << 10
ROUNDS = 12
COST = 1.0
#: Added to each count before the ratio is taken.
SMOOTH = 1.0


def _shapes(words: Shapes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code of each token in text order, its text's number, and the token offsets of the texts.

    A token is a word or one other visible ASCII character. A word's code tells its case and whether it
    repeats the word before it; a character's code is the character.
    """
    repeats = np.zeros(len(words.starts), bool)
    repeats[1:] = (words.hashes[1:] == words.hashes[:-1]) & (words.rows[1:] == words.rows[:-1])
    place = np.concatenate([words.starts, words.marks])
    code = np.concatenate([words.case * 2 + repeats + 256, words.data[words.marks].astype(np.int64)])
    row = np.concatenate([words.rows, words.mark_rows])
    order = np.argsort(place, kind="stable")
    return code[order].astype(np.uint64), row[order], np.searchsorted(row[order], np.arange(words.texts + 1))


def features(column: pa.Array, hasher: Hasher, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct feature numbers of each text: ``feature, row, offsets``.

    Features are words, pairs of words, and n-grams of up to ``SHAPE_GRAM`` token shapes; of the last, one
    feature for each share in ``SHARES`` of the text's tokens that the n-gram reaches.
    """
    data, at = byte_column(column)
    found = hasher.shapes(data, at)
    words, rows = found.hashes, found.rows
    inside = rows[1:] == rows[:-1]
    every = [words, mix(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])[inside]]
    owner = [rows, rows[1:][inside]]
    code, code_rows, code_at = _shapes(found)
    tokens = np.maximum(np.diff(code_at), 1)
    gram = np.zeros(len(code), np.uint64)
    for length in range(1, SHAPE_GRAM + 1):
        size = len(code) - length + 1
        if size <= 0:
            break
        gram = gram[:size] * np.uint64(1024) + code[length - 1 :]
        whole = code_rows[:size] == code_rows[length - 1 :]
        key = mix(gram[whole] + np.uint64(length << 60))
        key_rows = code_rows[:size][whole]
        order = np.lexsort((key, key_rows))
        key, key_rows = key[order], key_rows[order]
        first = np.ones(len(key), bool)
        first[1:] = (key[1:] != key[:-1]) | (key_rows[1:] != key_rows[:-1])
        heads = np.flatnonzero(first)
        times = np.diff(np.append(heads, len(key)))
        share = times / tokens[key_rows[heads]]
        for level, least in enumerate(SHARES):
            reached = heads[share >= least]
            every.append(mix(key[reached] + np.uint64(level + 1)))
            owner.append(key_rows[reached])
    owner = np.concatenate(owner).astype(np.uint64)
    # One number holds row and feature, so a plain sort puts equal ones side by side.
    both = np.unique((owner << np.uint64(bits)) | (np.concatenate(every) >> np.uint64(64 - bits)))
    owner = (both >> np.uint64(bits)).astype(np.int64)
    return (both & np.uint64((1 << bits) - 1)).astype(np.int64), owner, np.searchsorted(owner, np.arange(len(at)))


def _counts(labelled: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of each class with each feature and, in the last place, documents of each class.

    Each task sums its documents first; at most ``2**bits + 1`` sums reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        hasher, sums = Hasher(), np.zeros((2, (1 << bits) + 1), np.int64)
        for batch in batches:
            _, places = byte_column(batch.column(0))
            for start, stop in rows_by_bytes(batch, np.diff(places), SLICE):
                part = batch.slice(start, stop - start)
                label = part.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
                feature, row, _ = features(part.column(0), hasher, bits)
                for c in (0, 1):
                    sums[c, : 1 << bits] += np.bincount(feature[label[row] == c], minlength=1 << bits)
                    sums[c, -1] += int((label == c).sum())
        used = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[0, used]), pa.array(sums[1, used])], ["f", "n0", "n1"])

    rows = labelled.select("text", "label").mapInArrow(run, "f long, n0 long, n1 long")
    table = rows.groupBy("f").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
    sums = np.zeros((2, (1 << bits) + 1), np.float64)
    place = table["f"].to_numpy()
    sums[0, place], sums[1, place] = table["n0"].to_numpy(), table["n1"].to_numpy()
    return sums[:, :-1], sums[:, -1]


def _sample_features(sample: DataFrame, bits: int, most: int) -> list[tuple[int, np.ndarray]]:
    """Label and features of the sampled documents in the order of ``turn``, until ``most`` features are reached."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        hasher = Hasher()
        for batch in batches:
            _, places = byte_column(batch.column(0))
            for start, stop in rows_by_bytes(batch, np.diff(places), SLICE):
                part = batch.slice(start, stop - start)
                feature, _, at = features(part.column(0), hasher, bits)
                lists = [feature[a:b].astype(np.int32).tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(1).cast(pa.int64()), part.column(2), pa.array(lists, pa.binary())], ["label", "turn", "features"])

    rows = materialized(sample.select("text", "label", "turn").mapInArrow(run, "label long, turn long, features binary"), "sample")
    # As many small rows as the sample has documents.
    sizes = rows.select("turn", (F.octet_length("features") / 4).cast("long").alias("n")).orderBy("turn").toArrow()
    fits = np.cumsum(sizes["n"].to_numpy()) <= most
    if len(fits) and not fits.all():
        rows = rows.where(F.col("turn") < int(sizes["turn"][max(1, int(fits.sum()))].as_py()))
    rows = rows.orderBy("turn").toArrow()
    return [(y, np.frombuffer(x, np.int32)) for y, x in zip(rows["label"].to_pylist(), rows["features"].to_pylist(), strict=True)]


def _descend(rows: list[tuple[int, np.ndarray]], ratios: np.ndarray, cost: float, rounds: int) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the L2-regularised squared hinge loss; the bias is one more feature of value 1.

    Each class has the same total cost, so that the rarer one is not drowned.
    """
    label = np.array([1 if y else -1 for y, _ in rows])
    share = {c: len(rows) / (2 * max(1, (label == c).sum())) for c in (-1, 1)}
    # Long documents would outweigh short ones by their number of features: each row has length 1.
    scale = np.array([1 / max(1e-12, np.sqrt((ratios[x] ** 2).sum())) for _, x in rows])
    diagonal = np.array([1 / (2 * cost * share[c]) for c in label])
    weights, bias, alpha = np.zeros(len(ratios)), 0.0, np.zeros(len(rows))
    order = np.random.default_rng(7)
    for _ in range(rounds):
        for i in order.permutation(len(rows)):
            x = rows[i][1]
            values = ratios[x] * scale[i]
            gradient = label[i] * (weights[x] @ values + bias) - 1 + diagonal[i] * alpha[i]
            new = max(0.0, alpha[i] - gradient / ((values @ values) + 1 + diagonal[i]))
            if new != alpha[i]:
                step = (new - alpha[i]) * label[i]
                weights[x] += step * values
                bias += step
                alpha[i] = new
    return weights, bias


@dataclass
class Fitted:
    """``score = 1 / (1 + exp(-(slope * margin + offset)))`` with the margin of the document scaled to length 1."""

    ratios: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    offset: float
    bits: int

    def scores(self, column: pa.Array, hasher: Hasher) -> np.ndarray:
        feature, row, _ = features(column, hasher, self.bits)
        n = len(column)
        ratio = self.ratios[feature]
        length = np.sqrt(np.bincount(row, ratio * ratio, minlength=n))
        margin = np.bincount(row, self.weights[feature] * ratio, minlength=n) / np.maximum(length, 1e-12) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -50, 50)))


def fit(labelled: DataFrame, bits: int = BITS, sample: int = SAMPLE, cost: float = COST, rounds: int = ROUNDS) -> Fitted:
    """Fit on ``doc_id, text, label`` (0 or 1; rows with another label or none are left out).

    Ratios are counted over all rows. The linear model sees at most ``sample`` documents of each class, those
    with the smallest hash of their id, and of these as many as have ``FEATURES`` features together. Without rows of both classes every score is the share of label 1
    (0.5 without any row).
    """
    rows = labelled.where("label IN (0, 1)").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "label")
    rows = materialized(rows, "labelled")
    counts, documents = _counts(rows, bits)
    if documents.min() == 0:
        share = 0.5 if documents.max() == 0 else float(documents[1] > 0)
        zero = np.zeros(1 << bits)
        return Fitted(zero, zero, 0.0, 0.0, float(np.log((share + 1e-9) / (1 - share + 1e-9))), bits)
    # Share of a class's documents that hold the feature.
    good = (counts[1] + SMOOTH) / (documents[1] + 2 * SMOOTH)
    bad = (counts[0] + SMOOTH) / (documents[0] + 2 * SMOOTH)
    # A feature of a single document says nothing about others.
    ratios = np.where(counts.sum(axis=0) >= 2, np.log(good / bad), 0.0)
    keyed = rows.withColumn("turn", F.xxhash64(F.col("doc_id").cast("string"), F.lit(9)))
    # The hashes of the chosen documents first, then their texts: no task holds a class's texts.
    last = [keyed.where(F.col("label") == c).select("turn").orderBy("turn").limit(sample).agg(F.max("turn")).first()[0] for c in (0, 1)]
    chosen = keyed.where(F.col("turn") <= F.when(F.col("label") == 0, F.lit(last[0])).otherwise(F.lit(last[1])))
    data = _sample_features(chosen, bits, FEATURES)
    weights, bias = _descend(data, ratios, cost, rounds)
    # Slope and offset of the logistic curve: Newton steps on the same sample, margins clipped at the hinge.
    label = np.array([float(y) for y, _ in data])
    margin = np.array([
        (weights[x] * ratios[x]).sum() / max(1e-12, np.sqrt((ratios[x] ** 2).sum())) + bias for _, x in data
    ])
    slope, offset = _logistic(margin, label)
    return Fitted(ratios, weights, bias, slope, offset, bits)


def _logistic(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    weight = np.where(label == 1, 0.5 / max(1, label.sum()), 0.5 / max(1, (1 - label).sum()))
    theta, design = np.array([1.0, 0.0]), np.stack([margin, np.ones_like(margin)], axis=1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        gradient = design.T @ (weight * (p - label)) + 1e-3 * np.array([theta[0] - 1, 0])
        curve = (design * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ design + 1e-3 * np.eye(2)
        theta = theta - np.linalg.solve(curve, gradient)
    return float(max(theta[0], 0.0)), float(theta[1])


def score(docs: DataFrame, model: Fitted, text: str = "text", output: str = "score") -> DataFrame:
    """All columns of the rows and ``output``, the score from 0 to 1 (a null or empty text gets the bias alone)."""
    small_batches(docs.sparkSession)
    # Its size is fixed by the number of features. Plain values: a broadcast class would be looked up in the package.
    shared = docs.sparkSession.sparkContext.broadcast(tuple(getattr(model, f.name) for f in fields(model)))
    place = docs.columns.index(text)
    names = [*docs.columns, output]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        hasher, fitted = Hasher(), Fitted(*shared.value)
        for batch in batches:
            column = batch.column(place).fill_null("")
            _, at = byte_column(column)
            values = [
                fitted.scores(column.slice(start, stop - start), hasher)
                for start, stop in rows_by_bytes(batch, np.diff(at), SLICE)
            ]
            found = np.concatenate(values) if values else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names)

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{columns}, `{output}` double")


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Fitted:
    """Fit on the labelled documents that are not held out.

    An id with several label rows counts as label 1 only if all of them say so; a null id is never labelled.
    """
    small_batches(docs.sparkSession)
    marks = labels.where("quality IN (0, 1)").groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("label"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where(~held_out("doc_id"))
    # Labels grow with the documents: the same shuffle join at every size, never a broadcast.
    return fit(rows.join(marks.hint("merge"), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "label"))
