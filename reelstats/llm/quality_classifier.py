"""Quality classifier: random indexing and a small network (operator 3).

1. Random indexing. Every word (hashed into V rows) has a fixed sparse random
   index vector; its context vector is the sum of the index vectors of its
   neighbours at distance one, over all words of all documents. Besides the
   words, each position yields a shape word (length, case, digits, symbols, and
   whether the word or the word pair occurred before in the text), whose
   vectors are learnt the same way. Tasks add up a V x D table each and ship it
   in segments; the merged table has a fixed size (V * D * 4 bytes) and is the
   only thing broadcast, besides the network.
2. Pooling. A document's vector is the mean and the mean square of its words'
   unit vectors, the mean over its shape words, and its log length.
3. A two-layer numpy network is trained on the driver on at most `max_rows`
   labelled rows whose crc32(doc_id as text) mod 5 is not 0, chosen by a hash of
   their id. A fifth of those calibrates a temperature; the score is the
   calibrated probability of label 1.

Labels, lang, source and doc_id are never inputs of a score. Without labelled
rows of both kinds every score is the share of label 1 (0.5 with none).

Defined cases: null text is empty and scores like an empty text; rows with a
null or repeated doc_id are scored by themselves; an empty table gives an empty
result; other columns are ignored (`score_documents`) or kept (`keep_good`).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstats.llm import arrowtext as at

ROWS = 1 << 14
DIMS = 32
SHAPE_ROWS = 1 << 10
NONZERO = 2
MAX_ROWS = 8000
FOLDS = 5
CUT = 0.3
SEGMENTS = 16


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Positions and signs of the NONZERO entries of each row's index vector."""
    rng = np.random.RandomState(33)
    n = ROWS + SHAPE_ROWS
    return rng.randint(0, DIMS, (n, NONZERO)), rng.choice([-1.0, 1.0], (n, NONZERO))


def _tokens(arr: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word rows, shape rows, words per text)."""
    buf, off = at.utf8(arr)
    start, end, counts = at.words(buf, off)
    n = len(start)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), counts
    h = at.span_hash(buf, start, end)
    row = at.rows_of(counts)

    def count(lo: int, hi: int) -> np.ndarray:
        flag = np.zeros(256, np.uint8)
        flag[lo:hi] = 1
        return np.add.reduceat(flag[buf], start, dtype=np.int32)  # the bytes after a word are white space

    size = end - start
    upper, lower, digit, high = count(65, 91), count(97, 123), count(48, 58), count(128, 256)
    symbol = size - upper - lower - digit - high

    def seen(key: np.ndarray) -> np.ndarray:
        own = at.mix(key + at.mix(row[: len(key)].astype(at.U64) + at.U64(1)))
        _, first = np.unique(own, return_index=True)
        again = np.ones(len(key), bool)
        again[first] = False
        return again

    word_again = seen(h)
    pair_again = np.zeros(n, bool)
    if n > 1:
        pair_again[1:] = seen(at.mix(h[:-1] * at.U64(3) + h[1:])) & (row[1:] == row[:-1])
    shape = (
        np.minimum(size, 24) // 4 + 7 * (np.minimum(symbol, 3) + 4 * ((upper > 0).astype(int) + (upper > 1) + 3 * ((digit > 0) + 2 * (word_again.astype(int) + pair_again))))
    )
    return (h & at.U64(ROWS - 1)).astype(np.int64), ROWS + shape % SHAPE_ROWS, counts


def context_table(docs: DataFrame) -> np.ndarray:
    """Unit context vectors, (ROWS + SHAPE_ROWS) x DIMS float32, gathered from all documents."""
    n_rows = ROWS + SHAPE_ROWS
    step = n_rows * DIMS // SEGMENTS

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at.forget()  # a worker that has packed token ids holds a tokenizer
        place, sign = _index_vectors()
        table = np.zeros(n_rows * DIMS)
        for batch in batches:
            for part in at.chunks(batch, "text"):
                word, shape, counts = _tokens(part.column("text"))
                row = at.rows_of(counts)
                if len(row) < 2:
                    continue
                near = row[1:] == row[:-1]
                for seq in (word, shape):
                    a, b = seq[:-1][near], seq[1:][near]
                    for x, y in ((a, b), (b, a)):
                        for k in range(NONZERO):
                            np.add.at(table, x * DIMS + place[y, k], sign[y, k])
        if table.any():
            yield pa.record_batch([pa.array(range(SEGMENTS), pa.int32()), pa.array([table[s * step : (s + 1) * step].astype(np.float32).tobytes() for s in range(SEGMENTS)], pa.binary())], names=["segment", "part"])

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(step)
        for batch in batches:
            for x in batch.column("part"):
                total += np.frombuffer(x.as_py(), np.float32)
        yield pa.record_batch([pa.array([key[0].as_py()], pa.int32()), pa.array([total.astype(np.float32).tobytes()], pa.binary())], names=["segment", "part"])

    summed = docs.select("text").mapInArrow(add, "segment int, part binary").groupBy("segment").applyInArrow(merge, "segment int, part binary")
    table = np.zeros(n_rows * DIMS, np.float32)
    for r in summed.toLocalIterator():  # SEGMENTS rows, whatever the input
        table[r["segment"] * step : (r["segment"] + 1) * step] = np.frombuffer(r["part"], np.float32)
    table = table.reshape(n_rows, DIMS)
    # the sum's order differs between runs; a rounded direction doesn't
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    return np.round(np.divide(table, norm, out=np.zeros_like(table), where=norm > 0), 4)


def pooled(arr: pa.Array, table: np.ndarray) -> np.ndarray:
    """One row per text: mean, mean square, shape mean, log length."""
    word, shape, counts = _tokens(arr)
    out = np.zeros((len(counts), 3 * DIMS + 1), np.float32)
    has = np.flatnonzero(counts)
    if len(has):
        first = (np.cumsum(counts) - counts)[has]
        n = counts[has][:, None].astype(np.float32)
        vec = table[word]
        out[has, :DIMS] = np.add.reduceat(vec, first, axis=0) / n
        out[has, DIMS : 2 * DIMS] = np.add.reduceat(vec * vec, first, axis=0) / n
        out[has, 2 * DIMS : 3 * DIMS] = np.add.reduceat(table[shape], first, axis=0) / n
        out[has, -1] = np.log1p(counts[has])
    return out


def document_vectors(docs: DataFrame, table, extra: str = "") -> DataFrame:
    """doc_id, vector (and the column `extra`) of every document; table: the broadcast context table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in at.chunks(batch, "text"):
                x = pooled(part.column("text"), table.value)
                cols, names = [part.column("doc_id"), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float32()))], ["doc_id", "vector"]
                if extra:
                    cols, names = [*cols, part.column(extra)], [*names, extra]
                yield pa.record_batch(cols, names=names)

    schema = "doc_id long, vector array<float>" + (f", {extra} int" if extra else "")
    return docs.select(F.col("doc_id").cast("long"), "text", *([extra] if extra else [])).mapInArrow(run, schema)


class Network:
    """tanh hidden layer, logistic output, temperature; plain numpy."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = 24, epochs: int = 300, seed: int = 3):
        rng = np.random.RandomState(seed)
        self.prior = float(y.mean()) if len(y) else 0.5
        self.fitted = len(set(y.tolist())) == 2
        if not self.fitted:
            return
        hold = rng.permutation(len(y)) % 5 == 0
        if len(set(y[hold].tolist())) < 2:
            hold[:] = False
        train_x, train_y = x[~hold], y[~hold]
        self.mean, self.scale = train_x.mean(0), train_x.std(0) + 1e-3
        z = self._scaled(train_x)
        p = [rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], hidden)), np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
        m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
        weight = np.where(train_y == 1, 0.5 / max(train_y.mean(), 1e-6), 0.5 / max(1 - train_y.mean(), 1e-6))
        step = 0
        for _ in range(epochs):
            for part in np.array_split(rng.permutation(len(z)), max(1, len(z) // 512)):
                a = z[part]
                h = np.tanh(a @ p[0] + p[1])
                out = 1 / (1 + np.exp(-(h @ p[2] + p[3])))
                g = (out - train_y[part]) * weight[part] / len(part)
                gh = np.outer(g, p[2]) * (1 - h * h)
                step += 1
                for i, d in enumerate((a.T @ gh + 1e-4 * p[0], gh.sum(0), h.T @ g + 1e-4 * p[2], np.array([g.sum()]))):
                    m[i] = 0.9 * m[i] + 0.1 * d
                    v[i] = 0.999 * v[i] + 0.001 * d * d
                    p[i] -= 3e-3 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
        self.p = p
        # the weights balance the classes; the offset puts the prior back, the temperature calibrates
        self.offset, self.temperature = float(np.log(max(self.prior, 1e-6) / max(1 - self.prior, 1e-6))), 1.0
        if hold.any():
            logit, own = self._logit(x[hold]), y[hold]
            grid = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
            loss = [np.logaddexp(0, np.where(own == 1, -1, 1) * (logit + self.offset) / t).mean() for t in grid]
            self.temperature = float(grid[int(np.argmin(loss))])

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def _logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(self._scaled(x) @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3]

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(x), self.prior)
        z = np.clip((self._logit(np.asarray(x, float)) + self.offset) / self.temperature, -40, 40)
        return 1 / (1 + np.exp(-z))


def held_out(column: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(column).cast("string")) % FOLDS == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS):
    """(broadcast context table, broadcast network), from at most max_rows labelled rows; of different labels of an id the lowest counts."""
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(context_table(docs))
    chosen = (
        labels.where("doc_id is not null and quality is not null").where(~held_out())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(F.col("quality").cast("int")).alias("_label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    )
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = document_vectors(own.join(F.broadcast(chosen), "doc_id"), table, "_label")
    # a labelled id may stand on any number of rows: the bound holds for those, too
    rows = found.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("vector")).limit(max_rows).toPandas()
    rows = rows.sort_values(["doc_id", "_label"], kind="stable")
    x = np.array(rows["vector"].tolist(), float).reshape(len(rows), 3 * DIMS + 1)
    return table, spark.sparkContext.broadcast(Network(x, rows["_label"].to_numpy(float)))


def _with_score(docs: DataFrame, model) -> DataFrame:
    table, net = model
    from pyspark.sql.types import DoubleType, StructType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in at.chunks(batch, "text"):
                score = net.value.score(pooled(part.column("text"), table.value))
                yield pa.record_batch([*part.columns, pa.array(score, pa.float64())], names=[*part.schema.names, "_quality_score"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields]).add("_quality_score", DoubleType()))


def score_documents(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    scored = _with_score(docs.select("doc_id", "text"), fit(docs, labels, max_rows))
    return scored.select("doc_id", held_out().alias("held_out"), F.col("_quality_score").alias("score"), (F.col("_quality_score") >= CUT).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """The documents that score at least CUT, with their columns."""
    return _with_score(docs, fit(docs, labels, max_rows)).where(F.col("_quality_score") >= CUT).drop("_quality_score")
