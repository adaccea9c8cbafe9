"""Quality classifier: a sparse ensemble of rules over text statistics (after Friedman and Popescu, 2008).

Statistics of every text are Spark column expressions. A random forest of shallow trees is grown on labelled rows; each
path from a root to a node is a rule, a conjunction of limits on statistics. A lasso logistic regression gives most rules
no weight, and what is left is compiled into one column expression, so that scoring is a projection without Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellgrid.llm._shared import stored, words

#: At most so many labelled rows are used for fitting.
MOST_ROWS = 200_000


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a text, all finite; a null text counts as empty."""
    text = F.coalesce(text, F.lit(""))
    chars = F.char_length(text)
    own = words(text)  # split once for both counts
    n = F.size(own)
    per_char = lambda c: c / F.greatest(chars, F.lit(1))
    per_word = lambda c: c / F.greatest(n, F.lit(1))
    count = lambda pattern: F.regexp_count(text, F.lit(pattern))
    one = lambda c: chars - F.char_length(F.replace(text, F.lit(c), F.lit("")))
    return {
        "log_words": F.log1p(n.cast("double")),
        "word_chars": per_word(chars),
        "capitals": per_char(count(r"\p{Lu}")),
        "digits": per_char(count("[0-9]")),
        "marks": per_word(count("[!?]")),
        "symbols": per_word(count("[#$%&*+=<>@^_~{}\\\\]")),
        "bars": per_word(one("|")),
        "stops": per_word(count("[.,;:]")),
        "lines": per_word(one("\n")),
        "distinct": per_word(F.size(F.array_distinct(own))),
    }


@dataclass(frozen=True)
class Rule:
    """A conjunction of limits: statistic, whether it must be at most the limit, limit."""

    limits: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        out = F.lit(True)
        for name, below, limit in self.limits:
            out = out & ((F.col(name) <= limit) if below else (F.col(name) > limit))
        return out


@dataclass(frozen=True)
class RuleEnsemble:
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    bias: float

    def score(self) -> Column:
        """Probability of label 1, from columns named as the statistics."""
        total = F.lit(self.bias)
        for rule, weight in zip(self.rules, self.weights):
            total = total + F.when(rule.column(), weight).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-total))


def tree_rules(root, names: list[str]) -> set[Rule]:
    """The rule of each node of a tree but its root; of several limits of one kind on a path, the tightest."""
    out: set[Rule] = set()

    def walk(node, limits: dict[tuple[str, bool], float]) -> None:
        if limits:
            out.add(Rule(tuple(sorted((n, b, x) for (n, b), x in limits.items()))))
        if node.getClass().getSimpleName() == "InternalNode":
            name, limit = names[node.split().featureIndex()], float(node.split().threshold())
            for child, below in ((node.leftChild(), True), (node.rightChild(), False)):
                old = limits.get((name, below), limit)
                walk(child, limits | {(name, below): min(old, limit) if below else max(old, limit)})

    walk(root, {})
    return out


def fit(rows: DataFrame, label: str = "label", trees: int = 12, depth: int = 3, lasso: float = 0.0005, seed: int = 17, most_rows: int = MOST_ROWS) -> RuleEnsemble:
    """Fit an ensemble to ``rows``: the columns of :func:`statistics` and a label of 0 or 1.

    Rows without a label are left out; of more than ``most_rows`` others, a share chosen by a hash of their statistics
    is used. With one class alone, or no rows, the score is constant (the share of label 1; 0.5 for none).
    """
    names = list(statistics(F.lit("")))
    rows = rows.where(F.col(label).isin(0, 1)).select(*names, F.col(label).cast("double").alias("label"))
    total, ones = rows.agg(F.count("*"), F.sum("label")).first()
    if not total or ones in (0, total):
        return RuleEnsemble((), (), 0.0 if not total else 6.0 if ones else -6.0)
    if total > most_rows:
        rows = rows.where(F.pmod(F.xxhash64(*names), F.lit(1_000_000)) < int(1_000_000 * most_rows / total))
    rows = stored(rows)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, featureSubsetStrategy="onethird", seed=seed, subsamplingRate=0.7)
    grown = forest.fit(VectorAssembler(inputCols=names, outputCol="features").transform(rows))
    found = set().union(*(tree_rules(t._call_java("rootNode"), names) for t in grown.trees))
    rules = sorted(found, key=lambda r: r.limits)
    marked = rows.select("label", F.array(*[r.column().cast("double") for r in rules]).alias("x"))
    from pyspark.ml.functions import array_to_vector

    marked = marked.select("label", array_to_vector("x").alias("features"))
    model = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=60, standardization=False).fit(marked)
    weights = [float(w) for w in model.coefficients]
    used = [i for i, w in enumerate(weights) if w]
    return RuleEnsemble(tuple(rules[i] for i in used), tuple(weights[i] for i in used), float(model.intercept))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned: crc32 of the id as text is divisible by 5."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def _labelled(stats: DataFrame, labels: DataFrame) -> DataFrame:
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("label"))
    return stats.where(~held_out(F.col("doc_id"))).join(known, "doc_id")


def score_quality(docs: DataFrame, labels: DataFrame, limit: float = 0.3, **fitting) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each row of ``docs``: the probability that its quality is 1.

    Labels of held-out rows are not used, and a score depends on the text alone. Null and empty texts are scored as
    texts without words, texts of any length whole; repeated rows have one score each; of several labels of an id the
    greatest counts, and an id without one (or null) is not learned from; an empty table gives no rows.
    """
    stats = stored(docs.select(F.col("doc_id"), *[c.alias(n) for n, c in statistics(F.col("text")).items()]))
    ensemble = fit(_labelled(stats, labels), **fitting)
    scored = stats.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), ensemble.score().alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= limit, 1).otherwise(0))


def keep_good(docs: DataFrame, labels: DataFrame, limit: float = 0.3, **fitting) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``limit``."""
    names = {f"__{n}": c for n, c in statistics(F.col("text")).items()}
    both = stored(docs.withColumns(names))
    stats = both.select("doc_id", *[F.col(n).alias(n[2:]) for n in names])
    ensemble = fit(_labelled(stats, labels), **fitting)
    renamed = both.withColumnsRenamed({c: f"col {i}" for i, c in enumerate(docs.columns)}).withColumnsRenamed({n: n[2:] for n in names})
    kept = renamed.where(ensemble.score() >= limit).drop(*[n[2:] for n in names])
    return kept.toDF(*docs.columns)
