"""Quality by a sparse rule ensemble over text statistics.

Each text is described by ``STATISTICS``. Shallow trees of a random forest, grown on a bounded labelled sample, give
conjunctions such as ``symbols > 0.1 and distinct <= 0.5`` (every path from a root to a node). A lasso logistic
regression weights the rules; those left with a weight become one Spark column expression that scores all rows.

It learns from at most ``SAMPLE_ROWS`` labelled rows outside the held-out fold (smallest id hashes); rows are
described and scored on their whole text. Without labelled rows of both classes every score is the share of good
ones (0 if there are none). Null and empty texts have statistics 0 and are scored like any other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bound_batches, fold_of, labelled, settle

SAMPLE_ROWS = 20_000
TREES, DEPTH, PENALTY = 12, 3, 0.0005
STATISTICS = [
    "chars", "words", "word_length", "upper", "digits", "marks", "symbols", "bangs", "bars", "lines_per_word",
    "short_words", "distinct_words", "repeated_lines", "capital_words", "top_word",
]

#: Byte classes: 1 upper, 2 digit, 3 sentence marks, 4 symbols, 5 exclamation, 6 bar.
_CLASS = np.zeros(256, np.uint8)
for _kind, _bytes in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:?'\"()-", b"#$%&*@^~+=<>{}[]\\/_`", b"!", b"|"), 1):
    _CLASS[list(_bytes)] = _kind


def describe(text: str | None) -> list[float]:
    """The ``STATISTICS`` of a whole text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    kinds = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=7) if raw else np.zeros(7)
    words, lines = text.split(), text.split("\n")
    n, m = max(len(words), 1), max(len(text), 1)
    tally: dict[str, int] = {}
    for word in words:
        tally[word] = tally.get(word, 0) + 1
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    return [
        float(len(text)), float(len(words)), float(lengths.sum() / n), *(float(k / m) for k in kinds[1:7]),
        len(lines) / n if words else 0.0, float((lengths <= 3).sum() / n), len(tally) / n, 1 - len(set(lines)) / len(lines),
        sum(map(str.istitle, words)) / n, max(tally.values(), default=0) / n,
    ]


def _describer(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [describe(t) for t in batch["text"].to_pylist()]
            columns = list(zip(*found)) or [()] * len(STATISTICS)
            kept = [batch[n] for n in names]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(c, pa.float64()) for c in columns)], names=[*names, *STATISTICS])

    return run


def described(rows: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns and the statistics of each row's text."""
    bound_batches(rows.sparkSession)
    kinds = dict(rows.dtypes)
    schema = ", ".join([*(f"{k} {kinds[k]}" for k in keep), *(f"{s} double" for s in STATISTICS)])
    return rows.select(*keep, F.col("text").cast("string").alias("text")).mapInArrow(_describer(list(keep)), schema)


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, at most?, limit), all of which hold


def tree_rules(text: str) -> list[Rule]:
    """The paths of a printed tree, from the root to each node below it."""
    rules, path = [], {}
    for line in text.splitlines():
        if (m := re.match(r"( *)(If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)) is not None:
            depth = len(m[1])
            path = {k: v for k, v in path.items() if k < depth}
            path[depth] = (int(m[3]), m[4] == "<=", float(m[5]))
            rules.append(tuple(v for _, v in sorted(path.items())))
    return rules


def rule_column(rule: Rule) -> Column:
    holds = F.lit(True)
    for statistic, at_most, limit in rule:
        value = F.col(STATISTICS[statistic])
        holds = holds & ((value <= limit) if at_most else (value > limit))
    return holds.cast("double")


def train(sample: DataFrame) -> tuple[float, list[tuple[float, Rule]]]:
    """(intercept, [(weight, rule)]) from a bounded sample (text, y)."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    # Only the statistics of the sample move into one task; sorted, so that the forest draws the same rows in every run.
    rows = settle(described(sample, "y").repartition(1).sortWithinPartitions("y", *STATISTICS), "quality-sample")
    share = rows.agg(F.coalesce(F.avg("y"), F.lit(0.0))).first()[0]
    if not 0 < share < 1:
        return (40.0 if share else -40.0), []
    vectors = VectorAssembler(inputCols=STATISTICS, outputCol="features").transform(rows).select("features", "y")
    forest = RandomForestClassifier(labelCol="y", numTrees=TREES, maxDepth=DEPTH, maxBins=64, featureSubsetStrategy="0.5", seed=9).fit(vectors)
    rules = sorted({rule for tree in forest.trees for rule in tree_rules(tree.toDebugString)})
    if not rules:
        return float(np.log(share / (1 - share))), []
    names = [f"r{i}" for i in range(len(rules))]
    held = rows.select("y", *(rule_column(r).alias(n) for r, n in zip(rules, names)))
    held = VectorAssembler(inputCols=names, outputCol="features").transform(held).select("features", "y")
    lasso = LogisticRegression(labelCol="y", elasticNetParam=1.0, regParam=PENALTY, maxIter=60, standardization=False).fit(held)
    return float(lasso.intercept), [(float(w), r) for w, r in zip(lasso.coefficients.toArray(), rules) if w]


def score_column(intercept: float, weighted: list[tuple[float, Rule]]) -> Column:
    """The ensemble as one column over the statistics, between 0 and 1."""
    total = F.lit(intercept)
    for weight, rule in weighted:
        total = total + F.lit(weight) * rule_column(rule)
    return 1 / (1 + F.exp(-total))


def quality(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, sample_rows: int = SAMPLE_ROWS, cut: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted; learns only outside the held-out fold."""
    intercept, weighted = train(labelled(docs, labels, "quality", folds, held, sample_rows))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = described(rows, "doc_id").select("doc_id", score_column(intercept, weighted).alias("score"))
    return scored.select("doc_id", fold_of(F.col("doc_id"), folds, held).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
