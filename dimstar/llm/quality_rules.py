"""Quality rules with an isolation forest on their statistics.

Base rules reject very short and self-repeating texts. The other texts get an
anomaly score: random trees split boxes of the statistics' space at random
features and places, each tree grown on ``SAMPLE`` clean labelled rows; a text
whose statistics end in an empty box after few splits is isolated, so its mean
path is short. The splits are drawn over the box of all labelled rows rather
than the tree's own rows: a statistic that is constant among clean texts (no
symbols at all, say) can then isolate a text too.

Fitting is the only step on a bounded sample: about ``POOL`` clean labelled
rows, chosen by the hash of their id, of which each tree draws its own. The boxes and the threshold
come from all labelled rows: of all score bins, the one whose cut makes the
least ``missed + CLEAN_COST * lost`` labelled rows (fewest rejections on a
tie; no labelled junk: nothing is rejected by score).

Defined cases: a null or empty text has no words and fails the base rules;
null or repeated labels count as their smallest non-null value; without clean
labels only the base rules reject; repeated rows each get a result row; extra
columns of the input never meet the operator's own.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hashed_share, materialise, ship
from .text_stats import COUNTS, features, with_counts

TREES = 150
SAMPLE = 256
POOL = 8192
DEPTH = 14
CLEAN_COST = 2.0
BINS = 2000
SEED = 7
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _mean_path(n: float) -> float:
    """Mean depth at which ``n`` rows are told apart by random splits."""
    if n <= 1:
        return 0.0
    return 2.0 * (np.log(n - 1) + np.euler_gamma) - 2.0 * (n - 1) / n if n > 2 else 1.0


class Forest:
    """Trees as flat arrays: feature (-1 at a leaf), place, left child; the
    right child follows the left one. ``depth`` holds a leaf's path length."""

    def __init__(self, rows: np.ndarray, low: np.ndarray, high: np.ndarray, trees: int = TREES,
                 sample: int = SAMPLE, depth: int = DEPTH, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.norm = _mean_path(sample) or 1.0
        # statistics are measured from the clean median in units of the clean spread, then compressed
        self.centre = np.median(rows, axis=0)
        self.unit = np.quantile(rows, 0.99, axis=0) - self.centre + 0.02
        box = np.stack([self._place(low[None, :])[0], self._place(high[None, :])[0]])
        placed = self._place(rows)
        self.trees = [self._grow(placed[rng.permutation(len(rows))[:sample]], box, depth, rng)
                      for _ in range(trees)]

    def _place(self, x: np.ndarray) -> np.ndarray:
        d = (x - self.centre) / self.unit
        return np.sign(d) * np.log1p(np.abs(d))

    @staticmethod
    def _grow(rows: np.ndarray, box: np.ndarray, limit: int, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
        feature, place, left, depth = [-1], [0.0], [0], [0.0]
        todo = [(0, rows, box, 0)]
        while todo:
            at, here, (low, high), level = todo.pop()
            wide = np.flatnonzero(high > low)
            if level >= limit or len(here) <= 1 or not len(wide):
                depth[at] = level + _mean_path(len(here))
                continue
            f = int(rng.choice(wide))
            cut = float(rng.uniform(low[f], high[f]))
            feature[at], place[at], left[at] = f, cut, len(feature)
            below = here[:, f] < cut
            for side, rest in ((0, here[below]), (1, here[~below])):
                sub = np.stack([low, high])
                sub[1 - side, f] = cut
                todo.append((len(feature), rest, sub, level + 1))
                for values, empty in ((feature, -1), (place, 0.0), (left, 0), (depth, 0.0)):
                    values.append(empty)
        return np.array(feature), np.array(place), np.array(left), np.array(depth)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Anomaly in (0, 1]: 2 to the minus mean path over its expectation."""
        placed, total = self._place(x), np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, place, left, depth in self.trees:
            at = np.zeros(len(x), dtype=np.int64)
            inner = rows[feature[at] >= 0]
            while len(inner):
                node = at[inner]
                at[inner] = left[node] + (placed[inner, feature[node]] >= place[node])
                inner = inner[feature[at[inner]] >= 0]
            total += depth[at]
        return 2.0 ** (-total / len(self.trees) / self.norm)


def with_anomaly(stats: DataFrame, forest: Forest) -> DataFrame:
    """``stats`` with a double column ``anomaly``; only the statistics go
    through Python, not the rows."""
    ship(stats.sparkSession)

    @F.pandas_udf("double")
    def anomaly(*x: pd.Series) -> pd.Series:
        return pd.Series(forest.scores(np.column_stack([c.to_numpy() for c in x])))

    return stats.withColumn("anomaly", anomaly(*features().values()))


def fit(labelled: DataFrame, trees: int = TREES, sample: int = SAMPLE, pool: int = POOL) -> tuple[Forest, float] | None:
    """Forest and score threshold from ``labelled`` (id ``key``, counts and
    ``quality``), or None without clean rows."""
    x = features()
    usable = labelled.filter(~base_failed())
    ends = usable.agg(F.count_if(F.col("quality") == 1).alias("n"), *[
        f(c).alias(f"{k}{i}") for i, c in enumerate(x.values()) for k, f in (("lo", F.min), ("hi", F.max))]).first()
    # about ``pool`` rows; the limit only matters if one id repeats very often
    clean = (usable.filter("quality = 1").filter(hashed_share([F.col("key")], pool, ends.n))
             .select(F.array(*x.values()).alias("x"), F.xxhash64("key").alias("h")).limit(2 * pool).collect())
    clean.sort(key=lambda r: (r.h, r.x))
    if not clean:
        return None
    low, high = (np.array([ends[f"{k}{i}"] for i in range(len(x))]) for k in ("lo", "hi"))
    forest = Forest(np.array([r.x for r in clean]), low, high, trees, min(sample, len(clean)))
    bins = (with_anomaly(usable, forest).groupBy(F.ceil(F.col("anomaly") * BINS).alias("bin"))
            .agg(F.sum(F.expr("int(quality = 1)")).alias("clean"), F.sum(F.expr("int(quality = 0)")).alias("junk"))
            .collect())  # at most BINS + 1 rows
    lost = missed = 0
    best, cut = sum(r.junk for r in bins), BINS  # reject nothing
    missed = best
    for r in sorted(bins, key=lambda r: -r.bin):
        lost, missed = lost + r.clean, missed - r.junk
        if missed + CLEAN_COST * lost < best:
            best, cut = missed + CLEAN_COST * lost, r.bin - 1
    return forest, cut / BINS


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           keep_rows: bool = False) -> DataFrame:
    """Per row: ``row`` (the whole input row if ``keep_rows``, else its id),
    the counts, ``base_failed``, ``anomaly``, ``threshold`` and ``kept``.
    ``labels`` has the id and ``quality`` (1 clean, 0 junk)."""
    source = docs if keep_rows else docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    stats = with_counts(source, text_col)
    if not keep_rows:
        stats = stats.select(F.struct(F.col("row")[id_col].alias(id_col)).alias("row"), *COUNTS)
    stats = materialise(stats, "quality-stats")
    known = (labels.select(F.col(f"`{id_col}`").alias("key"), F.col("quality").cast("int").alias("quality"))
             .filter("key IS NOT NULL AND quality IN (0, 1)").groupBy("key").agg(F.min("quality").alias("quality")))
    labelled = materialise(stats.select(F.col("row")[id_col].alias("key"), *COUNTS).join(known, "key"),
                           "quality-labelled")
    model = fit(labelled)
    if model is None:
        scored, threshold = stats.withColumn("anomaly", F.lit(0.0)), 1.0
    else:
        scored, threshold = with_anomaly(stats, model[0]), model[1]
    return (scored.withColumn("base_failed", base_failed()).withColumn("threshold", F.lit(threshold))
            .withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") <= F.col("threshold"))))


def drop_rejected(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns only."""
    return judged(docs, labels, id_col, text_col, keep_rows=True).filter("kept").select("row.*")
