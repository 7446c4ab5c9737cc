"""Quality rules: rule statistics and an isolation forest over them (operator 8).

Statistics per text (null: empty), over words `[^\\x20\\x09-\\x0D]+`:
n_words; word_chars (code points in words); n_symbols (characters of
`#*$%&|<>`); n_dup_lines (\\n-split lines with a word that equal an earlier
line of the text); n_repeat_words (words inside 8-word windows that occur
twice or more in the text). Base rule: fewer than 20 words, or more than 30 %
repeated words, fails.

The forest is fitted on the statistics of all rows labelled good (quality 1)
that pass the base rule: its random splits lie over their range, and tasks count
how many of them fall into each leaf (a table of fixed size). Path lengths over
the splits give an anomaly score, and the threshold on it is the one that
separates labelled good from labelled bad rows that pass the base rule, under the
condition that at most `clean_loss` of the good ones go; it is an exact quantile of
the scores of all of them, which are rounded to SCORE_DIGITS. Without any
labelled row only the base rule decides.

Defined cases: null text is empty (all statistics 0, base_failed); rows with a
null or repeated doc_id are scored by themselves, one result row per input row;
an empty table gives an empty result; further input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstats.llm import arrowtext as at
from reelstats.llm.tables import written

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
N_FEATURES = 6
SCORE_DIGITS = 5
_SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in STATS) + ", n_lines long, n_caps long"


def statistics(arr: pa.Array) -> dict[str, np.ndarray]:
    buf, off = at.utf8(arr)
    start, end, n_words = at.words(buf, off)
    rows = len(n_words)

    def per_row(flag: np.ndarray) -> np.ndarray:
        total = np.zeros(len(flag) + 1, np.int64)
        np.cumsum(flag, out=total[1:])
        return total[off[1:]] - total[off[:-1]]

    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    upper = np.zeros(256, bool)
    upper[65:91] = True
    lead = ((buf & 0xC0) != 0x80) & ~at._WS[buf]
    out = {"n_words": n_words, "word_chars": per_row(lead), "n_symbols": per_row(symbol[buf]), "n_caps": per_row(upper[buf])}
    repeated = np.zeros(rows, np.int64)
    first = at.window_starts(n_words, WINDOW)
    if len(first):
        row = at.rows_of(n_words)
        gram = at.ngram_hash(at.span_hash(buf, start, end), WINDOW)[first]
        key = at.mix(gram + at.mix(row[first].astype(at.U64) + at.U64(1)))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        again = np.zeros(len(key), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        hit = at.covered(first[again], WINDOW, len(row))
        repeated = np.bincount(row[hit], minlength=rows)
    dup, lines = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    data = buf.tobytes()
    for i in range(rows):
        own = [x for x in data[off[i] : off[i + 1]].split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
        dup[i], lines[i] = len(own) - len(set(own)), len(own)
    return out | {"n_dup_lines": dup, "n_repeat_words": repeated.astype(np.int64), "n_lines": lines}


def rule_statistics(docs: DataFrame) -> DataFrame:
    """One row of statistics per document, computed inside Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in at.chunks(batch, "text"):
                s = statistics(part.column("text"))
                yield pa.record_batch(
                    [part.column("doc_id")] + [pa.array(s[c], pa.int64()) for c in [*STATS, "n_lines", "n_caps"]],
                    names=["doc_id", *STATS, "n_lines", "n_caps"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _SCHEMA)


def base_failed(s: dict[str, np.ndarray]) -> np.ndarray:
    return (s["n_words"] < 20) | (100 * s["n_repeat_words"] > 30 * s["n_words"])


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    n = np.maximum(s["n_words"], 1).astype(float)
    chars = np.maximum(s["word_chars"], 1).astype(float)
    return np.column_stack([
        s["word_chars"] / n,
        s["n_symbols"] / chars,
        s["n_dup_lines"] / np.maximum(s["n_lines"], 1),
        s["n_repeat_words"] / n,
        s["n_caps"] / chars,
        np.log1p(n),
    ])


class IsolationForest:
    """Trees of random splits over the range of the data, with the share of the data in each node.

    A node's path length ends where at most one row in `sample` is left, as in a tree grown on
    `sample` rows, but the rows are counted, not drawn. The score is 2^(-mean path / expected path), in 0 to 1.
    Made from x, or of a range alone (`over`), to be counted (`leaves`, `masses`) and finished (`weigh`) in parts.
    """

    def __init__(self, x: np.ndarray | None = None, trees: int = 64, sample: int = 256, seed: int = 8):
        self.n_trees, self.most, self.seed = trees, sample, seed
        if x is not None:
            self.over(x.min(0), x.max(0), len(x)).weigh(self.masses(x))

    def over(self, low: np.ndarray, high: np.ndarray, n: int) -> IsolationForest:
        """The splits for n rows in this range."""
        self.n, self.sample = n, min(self.most, n)
        # splits that meet no data are part of every path: two levels more than a tree grown on rows has
        self.depth = int(np.ceil(np.log2(max(self.sample, 2)))) + 2
        # a margin around the data's range: values outside it can be split off at once
        margin = np.maximum((high - low) * 0.5, 1e-6)
        rng = np.random.RandomState(self.seed)
        inner = (1 << self.depth) - 1
        self.feature, self.cut = np.zeros((self.n_trees, inner), int), np.zeros((self.n_trees, inner))
        for t in range(self.n_trees):
            lows, highs = [low - margin], [high + margin]  # by node; the children of i are 2i+1 and 2i+2
            for i in range(inner):
                k = rng.randint(len(low))
                c = rng.uniform(lows[i][k], highs[i][k])
                self.feature[t, i], self.cut[t, i] = k, c
                left_high, right_low = highs[i].copy(), lows[i].copy()
                left_high[k], right_low[k] = c, c
                lows += [lows[i], right_low]
                highs += [left_high, highs[i]]
        return self

    def leaves(self, x: np.ndarray, tree: int) -> np.ndarray:
        node, row = np.zeros(len(x), int), np.arange(len(x))
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[row, self.feature[tree, node]] >= self.cut[tree, node])
        return node - ((1 << self.depth) - 1)

    def masses(self, x: np.ndarray) -> np.ndarray:
        """Rows of x in each leaf, by tree."""
        return np.stack([np.bincount(self.leaves(x, t), minlength=1 << self.depth) for t in range(self.n_trees)])

    def weigh(self, masses: np.ndarray) -> IsolationForest:
        """Path lengths by leaf, from the masses of all rows."""
        share = self.sample / max(self.n, 1)
        self.length = np.empty(masses.shape)
        open_ = np.ones(masses.shape, bool)
        for level in range(self.depth + 1):
            width = 1 << (self.depth - level)
            here = np.repeat(masses.reshape(self.n_trees, -1, width).sum(2) * share, width, axis=1)
            ends = open_ & ((here <= 1) | (level == self.depth))
            self.length[ends] = level + _expected(here[ends])
            open_ &= ~ends
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        path = np.zeros(len(x))
        for t in range(self.n_trees):
            path += self.length[t, self.leaves(x, t)]
        return 2.0 ** (-path / self.n_trees / max(float(_expected(np.array(self.sample))), 1e-9))


def _expected(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search in a tree of n points."""
    n = np.asarray(n, float)
    many = np.maximum(n, 3.0)
    return np.where(n <= 1, 0.0, np.where(n > 2, 2.0 * (np.log(many - 1) + 0.5772156649) - 2.0 * (many - 1) / many, 1.0))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(features, label is 1) of the rows that pass the base rule."""
    for batch in batches:
        s = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names if c != "doc_id"}
        on = ~base_failed(s)
        if on.any():
            yield features(s)[on], s["_label"][on] == 1


def fit(docs: DataFrame, labels: DataFrame, max_rows: int | None = None, clean_loss: float = 0.002):
    """(forest, threshold) from all labelled rows; None without good rows. max_rows: from at most so many, chosen by a hash of their id.

    Of different labels of an id the lowest counts.
    """
    chosen = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(F.col("quality").cast("int")).alias("_label"))
    )
    if max_rows is not None:
        chosen = F.broadcast(chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    # statistics first: seven numbers a document meet the labels, not its text
    found = rule_statistics(docs)
    found = found.join(chosen, "doc_id")
    if max_rows is not None:  # a labelled id may stand on any number of rows
        found = found.orderBy(F.xxhash64("doc_id"), "doc_id", *STATS).limit(max_rows)
    found = written(found.select(*STATS, "n_lines", "n_caps", "_label"), "labelled-statistics")

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, good in _parts(batches):
            if good.any():
                x = x[good]
                yield pa.record_batch([pa.array([len(x)], pa.int64()), pa.array([x.min(0).tolist()]), pa.array([x.max(0).tolist()])], names=["n", "low", "high"])

    each = lambda of, c: [of(F.col(c)[i]).alias(f"{c}{i}") for i in range(N_FEATURES)]
    span = found.mapInArrow(ranges, "n long, low array<double>, high array<double>").agg(F.sum("n").alias("n"), *each(F.min, "low"), *each(F.max, "high")).first()
    if not span["n"]:
        return None
    forest = IsolationForest().over(*(np.array([span[f"{c}{i}"] for i in range(N_FEATURES)]) for c in ("low", "high")), span["n"])

    def masses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for x, good in _parts(batches):
            total = total + forest.masses(x[good])
        if isinstance(total, np.ndarray):
            tree, leaf = np.nonzero(total)
            yield pa.record_batch([pa.array(tree, pa.int32()), pa.array(leaf, pa.int32()), pa.array(total[tree, leaf], pa.int64())], names=["tree", "leaf", "n"])

    counted = found.mapInArrow(masses, "tree int, leaf int, n long").groupBy("tree", "leaf").agg(F.sum("n").alias("n")).toPandas()  # trees * leaves rows at most
    total = np.zeros((forest.n_trees, 1 << forest.depth), np.int64)
    total[counted["tree"], counted["leaf"]] = counted["n"]
    forest.weigh(total)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, good in _parts(batches):
            yield pa.record_batch([pa.array(np.round(forest.score(x), SCORE_DIGITS)), pa.array(good)], names=["score", "good"])

    by_score = found.mapInArrow(scores, "score double, good boolean").groupBy("score").agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")
    ).toPandas().sort_values("score")  # 10^SCORE_DIGITS + 1 rows at most
    score, good, bad = (by_score[c].to_numpy() for c in ("score", "good", "bad"))
    # the quantile as numpy's, between the two scores beside it
    at_ = (good.sum() - 1) * (1 - clean_loss)
    ends = np.cumsum(good)
    lower, upper = (float(score[np.searchsorted(ends, i, side="right")]) for i in (int(np.floor(at_)), int(np.ceil(at_))))
    top = lower + (upper - lower) * (at_ - np.floor(at_))
    # between the highest good scores allowed and the bad ones above them
    above = score[(bad > 0) & (score > top)]
    return forest, float((top + above.min()) / 2 if len(above) else top)


def judge(docs: DataFrame, model) -> DataFrame:
    """doc_id, statistics, base_failed, anomaly score and kept for every document."""
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in STATS) + ", base_failed boolean, kept boolean, anomaly double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names if c != "doc_id"}
            failed = base_failed(s)
            score = np.round(model[0].score(features(s)), SCORE_DIGITS) if model else np.zeros(len(failed))
            kept = ~failed & (score <= model[1] if model else True)
            yield pa.record_batch(
                [batch.column("doc_id"), *(batch.column(c) for c in STATS), pa.array(failed), pa.array(kept), pa.array(score)],
                names=["doc_id", *STATS, "base_failed", "kept", "anomaly"],
            )

    return rule_statistics(docs).mapInArrow(run, schema)


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(docs, fit(docs, labels))
