"""Quality classifier: a sparse ensemble of rules over statistics of a text.

Statistics (lengths, shares of kinds of characters, repetition of words and lines) are
column expressions. A random forest of shallow trees is grown on labelled rows, and the path
to every node below a root becomes a rule: a conjunction of bounds on statistics. A logistic
regression with a lasso penalty weighs the rules and the statistics themselves (cut at their
outer hundredths); most weights become zero. What is left is compiled into one column
expression, so that scoring is a projection of the scan without Python.

The classifier is fitted on a bounded sample: up to ``max_docs`` labelled rows, those with the
smallest hash of their doc_id. Every text is scored.

Defined results: a null text counts as empty; an empty text has all statistics 0 and gets the
score of that. A doc_id labelled more than once has quality 0 if any of its labels is 0.
Labels other than 0 and 1, and null ids, are not learned from. With labels of one class, every
score is that class; without labels it is 0.5. Repeated rows give repeated rows, an empty
table none. ``score`` returns the columns that are asked for, ``keep`` all columns of the rows
that stay; columns of any other names may be there.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsearch.llm import common as C

MAX_DOCS = 20_000
TREES, DEPTH = 40, 3
#: Least rows of the sample in a node, and the weight of the lasso penalty.
NODE_ROWS = 8
PENALTY = 0.002
SEED = 11

#: A rule: ``(statistic, lower, upper)`` for each bound statistic, true if lower < value <= upper.
Rule = tuple[tuple[str, float, float], ...]


def _count(pattern: str) -> Column:
    return F.regexp_count("text", F.lit(pattern)).cast("double")


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def statistics(docs: DataFrame) -> DataFrame:
    """``docs`` (with ``text``, and no column named like a statistic) with a column for each of
    ``STATISTICS``."""
    parts = docs.withColumn("text", F.coalesce("text", F.lit(""))).withColumns({
        "_words": F.filter(F.split("text", C.SPACE), lambda w: w != ""),
        "_lines": F.filter(F.split("text", r"\n"), lambda x: x != ""),
    })
    counted = parts.withColumns({
        "chars": F.length("text").cast("double"), "words": F.size("_words").cast("double"),
        "lines": F.size("_lines").cast("double"),
        "_letters": _count(r"\p{L}"), "_upper": _count(r"\p{Lu}"), "_digits": _count(r"\p{Nd}"),
        "_marks": _count(r"[.,;:!?'\"()\-]"), "_other": _count(r"[^\p{L}\p{N}\s.,;:!?'\"()\-]"),
        "_ends": _count(r"[.!?](?=\s|$)"),
        "_twice": _count(r"(?<!\S)(\S+)(?=\s+\1(?!\S))"),
        "_capitals": _count(r"(?<!\S)\p{Lu}"),
        "_kinds": F.size(F.array_distinct("_words")).cast("double"),
        "_line_kinds": F.size(F.array_distinct("_lines")).cast("double"),
    })
    c = F.col
    return counted.withColumns({
        "word_length": _share(c("chars"), c("words")), "line_words": _share(c("words"), c("lines")),
        "letters": _share(c("_letters"), c("chars")), "digits": _share(c("_digits"), c("chars")),
        "upper": _share(c("_upper"), c("_letters")), "marks": _share(c("_marks"), c("words")),
        "other": _share(c("_other"), c("words")), "sentence_ends": _share(c("_ends"), c("words")),
        "repeats": _share(c("_twice"), c("words")), "capitals": _share(c("_capitals"), c("words")),
        "word_kinds": _share(c("_kinds"), c("words")),
        "line_kinds": _share(c("_line_kinds"), c("lines")),
    }).drop("_words", "_lines", "_letters", "_upper", "_digits", "_marks", "_other", "_ends",
            "_twice", "_capitals", "_kinds", "_line_kinds")


STATISTICS = (
    "chars", "words", "lines", "word_length", "line_words", "letters", "digits", "upper", "marks",
    "other", "sentence_ends", "repeats", "capitals", "word_kinds", "line_kinds",
)


def condition(rule: Rule) -> Column:
    """A rule as a condition on the columns of the statistics."""
    bounds = []
    for name, lower, upper in rule:
        if lower > float("-inf"):
            bounds.append(F.col(name) > lower)
        if upper < float("inf"):
            bounds.append(F.col(name) <= upper)
    return reduce(Column.__and__, bounds)


def tree_rules(description: str, names: tuple[str, ...] = STATISTICS) -> list[Rule]:
    """The path to every node below the root, from the printed form of a tree."""
    rules, path = [], []
    for line in description.splitlines():
        found = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if not found:
            continue
        depth = len(found[1])
        path = [step for step in path if step[0] < depth]
        path.append((depth, names[int(found[2])], found[3], float(found[4])))
        bounds: dict[str, tuple[float, float]] = {}
        for _, name, sign, value in path:
            lower, upper = bounds.get(name, (float("-inf"), float("inf")))
            bounds[name] = (max(lower, value), upper) if sign == ">" else (lower, min(upper, value))
        rules.append(tuple(sorted((n, *b) for n, b in bounds.items())))
    return rules


@dataclass(frozen=True)
class Ensemble:
    """Weighted rules, weighted statistics ``(name, lower, upper, weight)``, and the intercept."""

    intercept: float
    rules: list[tuple[Rule, float]] = field(default_factory=list)
    linear: list[tuple[str, float, float, float]] = field(default_factory=list)

    def column(self) -> Column:
        """The score as one expression over the columns of the statistics."""
        terms = [F.when(condition(rule), F.lit(w)).otherwise(F.lit(0.0)) for rule, w in self.rules]
        terms += [_within(name, lower, upper) * w for name, lower, upper, w in self.linear]
        total = reduce(Column.__add__, terms, F.lit(self.intercept))
        return 1.0 / (1.0 + F.exp(-total))


def _within(name: str, lower: float, upper: float) -> Column:
    return F.least(F.greatest(F.col(name), F.lit(lower)), F.lit(upper))


def _sample(docs: DataFrame, labels: DataFrame, learn: Column | None, max_docs: int) -> DataFrame:
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    if learn is not None:
        known = known.filter(learn)
    ids = known.groupBy("doc_id").agg(F.min("quality").cast("double").alias("label"))
    chosen = C.written(ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs), "sample")
    # Bounded by max_docs rows of two numbers.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return C.written(statistics(texts).drop("text"), "labelled")


def _assembled(rows: DataFrame, columns: list[Column], features: str) -> DataFrame:
    named = {f"_f{i}": c.cast("double") for i, c in enumerate(columns)}
    wide = rows.select("label", *STATISTICS, *[c.alias(n) for n, c in named.items()])
    return VectorAssembler(inputCols=list(named), outputCol=features).transform(wide).drop(*named)


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None,
        max_docs: int = MAX_DOCS, penalty: float = PENALTY) -> Ensemble:
    """Learn from the labelled rows for which ``learn`` (a condition on doc_id) holds."""
    rows = _sample(docs, labels, learn, max_docs)
    share = rows.agg(F.avg("label")).first()[0]
    if share is None:
        return Ensemble(0.0)
    if share in (0.0, 1.0):
        return Ensemble(40.0 if share else -40.0)
    plain = C.written(_assembled(rows, [F.col(s) for s in STATISTICS], "features"), "features")
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, minInstancesPerNode=NODE_ROWS, subsamplingRate=0.5,
        featureSubsetStrategy="onethird", maxBins=64, seed=SEED).fit(plain)
    rules = sorted({r for tree in forest.trees for r in tree_rules(tree.toDebugString)})
    cuts = plain.approxQuantile(list(STATISTICS), [0.01, 0.99], 0.001)
    linear = [(s, lower, upper) for s, (lower, upper) in zip(STATISTICS, cuts, strict=True)
              if lower < upper]
    columns = [condition(r) for r in rules] + [_within(*x) for x in linear]
    terms = C.written(_assembled(plain, columns, "terms").select("label", "terms"), "terms")
    lasso = LogisticRegression(featuresCol="terms", elasticNetParam=1.0, regParam=penalty,
                               maxIter=100).fit(terms)
    weights = lasso.coefficients.toArray().tolist()
    return Ensemble(
        lasso.intercept,
        [(r, w) for r, w in zip(rules, weights) if w],
        [(*x, w) for x, w in zip(linear, weights[len(rules):], strict=True) if w])


def _scored(docs: DataFrame, ensemble: Ensemble) -> DataFrame:
    """``caller`` (a struct of all columns of ``docs``) and ``score``."""
    inside = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_caller"),
                         F.col("text"))
    return statistics(inside).select(
        F.col("_caller").alias("caller"), ensemble.column().alias("score"))


def score(docs: DataFrame, ensemble: Ensemble, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The given columns of ``docs`` and ``score``, the probability of good quality."""
    return _scored(docs.select("text", *[c for c in columns if c != "text"]), ensemble).select(
        *[F.col(f"caller.`{c}`") for c in columns], "score")


def keep(docs: DataFrame, ensemble: Ensemble, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score at or above the threshold."""
    return _scored(docs, ensemble).filter(F.col("score") >= threshold).select("caller.*")
