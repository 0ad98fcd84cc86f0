"""Quality classifier: a sparse ensemble of rules.

Small boosted trees are grown on document statistics; every path from a root
to a node is a conjunctive rule. Lasso logistic regression keeps few of the
rules, and the model is compiled into one Spark column expression.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tessera.llm.common import column_of, id_text_crc, spare_prefix, staged, text_list

#: Statistics of a text, in this order; only the text is looked at.
STATISTICS = (
    "n_words", "mean_word", "longest_word", "distinct_share", "top_share", "repeat_share", "dup_line_share", "line_words",
    "upper_share", "digit_share", "symbol_share", "bar_share", "mark_share", "space_share", "wide_share", "short_word_share",
    "end_share", "common_share", "plain_word_share", "capital_share",
)
#: Frequent function words of the languages served.
_COMMON = frozenset(
    "the of and to in a is that for it was on be with as by de la le et les des en un du une que est pour qui dans el y los se del las por con der die und den von zu das mit sich auf ist im".encode().split()
)
_TABLES = {
    "upper": bytes(range(65, 91)), "digit": bytes(range(48, 58)), "symbol": b"#*$%&<>@^~={}[]\\/_+", "bar": b"|", "mark": b".,;:!?'\"()-", "wide": bytes(range(128, 256)), "end": b".!?", "bang": b"!",
}
#: Labelled ids that the classifier is fitted on, about, if there are more
#: (chosen by hash); trees, their depth, cuts a statistic, lasso strength.
SAMPLE_ROWS, TREES, DEPTH, CUTS, RATE, LASSO, STEPS = 20_000, 40, 3, 24, 0.3, 0.002, 400


def statistics(text: str) -> tuple[float, ...]:
    """The statistics of one text; zeros for a text without words."""
    data = text.encode("utf-8", "replace")
    words = data.split()
    n = len(words)
    if not n:
        return (0.0,) * len(STATISTICS)
    size = len(data)
    count = {k: size - len(data.translate(None, t)) for k, t in _TABLES.items()}
    lengths = list(map(len, words))
    letters = sum(lengths)
    seen = Counter(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    pairs = len(set(zip(words, words[1:])))
    plain = sum(map(bytes.isalpha, words))
    return (
        float(n), letters / n, float(max(lengths)), len(seen) / n, max(seen.values()) / n, 1 - pairs / max(1, n - 1), 1 - len(set(lines)) / len(lines), n / len(lines),
        count["upper"] / letters, count["digit"] / letters, count["symbol"] / letters, count["bar"] / n, count["mark"] / n, 1 - letters / size, count["wide"] / letters, sum(x <= 3 for x in lengths) / n,
        count["end"] / n, sum(c for w, c in seen.items() if w in _COMMON) / n, plain / n, sum(w[:1].isupper() for w in words) / n,
    )


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, statistics...) for every row; null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([statistics(t) for t in text_list(b)], dtype=np.float64).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([column_of(b, "doc_id"), *(pa.array(x[:, k]) for k in range(x.shape[1]))], ["doc_id", *STATISTICS])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, " + ", ".join(f"{s} double" for s in STATISTICS))


#: A rule: (statistic number, above the cut?, cut) conditions that all hold.
Rule = tuple[tuple[int, bool, float], ...]


@dataclass
class RuleModel:
    bias: float = 0.0
    rules: list[tuple[Rule, float]] = field(default_factory=list)

    def column(self, prefix: str = "") -> Column:
        """The score as a Spark expression over the statistics' columns."""
        z = F.lit(self.bias)
        for rule, weight in self.rules:
            holds = F.lit(True)
            for k, above, cut in rule:
                c = F.col(prefix + STATISTICS[k])
                holds = holds & (c > cut if above else c <= cut)
            z = z + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.bias + sum((w * holds(r, x) for r, w in self.rules), np.zeros(len(x)))
        return 1 / (1 + np.exp(-z))


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for k, above, cut in rule:
        out &= x[:, k] > cut if above else x[:, k] <= cut
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _grow(x: np.ndarray, cuts: list[np.ndarray], grad: np.ndarray, hess: np.ndarray, rows: np.ndarray, path: Rule, depth: int) -> Iterator[tuple[Rule, np.ndarray, float]]:
    """(path, rows, value) of the nodes below ``path``, leaves with their value."""
    best = (1e-6, None)
    g, h = grad[rows].sum(), hess[rows].sum()
    if depth:
        for k, at in enumerate(cuts):
            if not len(at):
                continue
            bin_of = np.searchsorted(at, x[rows, k])  # x <= at[b]  <=>  bin <= b
            gl, hl = (np.cumsum(np.bincount(bin_of, v[rows], len(at) + 1))[:-1] for v in (grad, hess))
            gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
            gain[(hl < 1) | (h - hl < 1)] = 0
            b = int(gain.argmax())
            if gain[b] > best[0]:
                best = (gain[b], (k, float(at[b])))
    if best[1] is None:
        yield path, rows, -g / (h + 1)
        return
    if path:
        yield path, rows[:0], 0.0
    k, cut = best[1]
    above = x[rows, k] > cut
    yield from _grow(x, cuts, grad, hess, rows[~above], (*path, (k, False, cut)), depth - 1)
    yield from _grow(x, cuts, grad, hess, rows[above], (*path, (k, True, cut)), depth - 1)


def tree_rules(x: np.ndarray, y: np.ndarray, seed: int = 0) -> list[Rule]:
    """Distinct paths of boosted trees, each grown on half of the rows."""
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, CUTS + 2)[1:-1], method="lower")) for c in x.T]
    z, rules = np.full(len(y), 0.0), {}
    for t in range(TREES):
        p = _sigmoid(z)
        rows = np.sort(rng.permutation(len(y))[: max(1, len(y) // 2)])
        for path, _, value in _grow(x, cuts, p - y, p * (1 - p), rows, (), 1 + t % DEPTH):
            if path:
                rules[tuple(sorted(path))] = None
                if value:
                    z += RATE * value * holds(path, x)
    return list(rules)


def lasso(a: np.ndarray, y: np.ndarray, strength: float = LASSO) -> tuple[float, np.ndarray]:
    """Bias and sparse weights of logistic regression by accelerated proximal gradient."""
    n, m = a.shape
    centre, scale = a.mean(axis=0), a.std(axis=0) + 1e-12
    s = (a - centre) / scale
    step = 4 / max(1.0, np.linalg.eigvalsh(s.T @ s / n)[-1]) if m else 1.0
    w, v, b, c, t = np.zeros(m), np.zeros(m), 0.0, 0.0, 1.0
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    b = c = float(np.log(share / (1 - share)))
    for _ in range(STEPS):
        r = _sigmoid(s @ v + c) - y
        new = v - step * (s.T @ r / n)
        new = np.sign(new) * np.maximum(np.abs(new) - step * strength, 0)
        bias = c - 4 * r.mean()
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = new + (t - 1) / t2 * (new - w), bias + (t - 1) / t2 * (bias - b)
        w, b, t = new, bias, t2
    return float(b - (w * centre / scale).sum()), w / scale


def fit(x: np.ndarray, y: np.ndarray, seed: int = 0) -> RuleModel:
    """A rule ensemble from statistics and 0/1 labels; of one class, no rows or
    statistics that tell nothing apart a constant score."""
    if not len(y) or y.min() == y.max():
        return RuleModel(bias=0.0 if not len(y) else (4.0 if y[0] else -4.0))
    rules = tree_rules(x, y, seed)
    if not rules:
        return RuleModel(bias=float(np.log(y.mean() / (1 - y.mean()))))
    a = np.stack([holds(r, x) for r in rules], axis=1).astype(float)
    distinct = np.unique(a, axis=1, return_index=True)[1]  # rules that hold for the same rows: the first
    rules, a = [rules[k] for k in sorted(distinct)], a[:, np.sort(distinct)]
    bias, weight = lasso(a, y)
    return RuleModel(bias, [(r, float(w)) for r, w in zip(rules, weight) if abs(w) > 1e-9])


def sampled_labels(ids: DataFrame, labels: DataFrame, fold: int = 1, folds: int = 3, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, label) of about ``rows`` labelled ids outside the held-out
    fold that occur in ``ids``: those whose hash is below the share wanted."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label")).where("label in (0, 1)")
    known = known.where(id_text_crc("doc_id") % folds != fold).groupBy("doc_id").agg(F.max("label").alias("label"))
    here = staged(known.join(ids.select("doc_id").distinct(), "doc_id"), "labels")
    share = min(1.0, rows / max(1, here.count()))
    return here.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))


def training_rows(stats: DataFrame, sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of the sample, by id; of an id with several rows
    the smallest statistics. The driver gets one row for each sampled id."""
    each = stats.join(sample, "doc_id").groupBy("doc_id").agg(F.min(F.struct(*STATISTICS)).alias("s"), F.max("label").alias("label"))
    rows = sorted(each.collect(), key=lambda r: r["doc_id"])
    x = np.array([list(r["s"]) for r in rows], dtype=np.float64).reshape(len(rows), len(STATISTICS))
    return x, np.array([r["label"] for r in rows], dtype=np.float64)


def sampled_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> RuleModel:
    """The model of ``quality_scores``, from statistics of the sample only."""
    here = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sample = staged(sampled_labels(here, labels), "label-sample")
    rows = here.join(F.broadcast(sample.select("doc_id")), "doc_id")  # about SAMPLE_ROWS ids
    return fit(*training_rows(staged(with_statistics(rows), "statistics"), sample))


def good_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, unchanged, whose score is at least ``least``.

    Null and empty texts have statistics of zero and are scored like any
    other, very long ones whole; repeated rows and null ids stay or go by
    their text; an empty table gives no rows; columns of any name are kept as
    they are."""
    model = sampled_model(docs, labels, id_col, text_col)
    text = docs.columns.index(text_col)
    prefix = spare_prefix(docs, *STATISTICS)
    extra = [prefix + s for s in STATISTICS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([statistics(t or "") for t in b.column(text).to_pylist()], dtype=np.float64).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(x[:, k]) for k in range(x.shape[1]))], [*b.schema.names, *extra])

    schema = StructType([*docs.schema.fields, *(StructField(s, DoubleType()) for s in extra)])
    return docs.mapInArrow(run, schema).where(model.column(prefix) >= least).drop(*extra)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, held_out, score (0 to 1) and predicted.

    Labels are learned only from rows whose crc32(doc_id as text) mod 3 is not
    1, about SAMPLE_ROWS of them where there are more; labels other than 0 and 1 and null ids
    teach nothing, an id labelled twice has its greatest label. Null and empty
    texts have statistics of zero and are scored like any other; without
    labels every score is 0.5. Repeated rows stay; an empty table gives no
    rows; other columns are ignored."""
    stats = staged(with_statistics(docs, id_col, text_col), "statistics")
    model = fit(*training_rows(stats, sampled_labels(stats, labels)))
    out = stats.select("doc_id", (id_text_crc("doc_id") % 3 == 1).alias("held_out"), model.column().alias("score"))
    return out.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
