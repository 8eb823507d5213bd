"""URL filters: rules, and a ratio of character language models where no rule fits.

A rule is a host, a path and a verdict. It fits the host and its subdomains if the
path of the URL starts with the rule's; the longest rule wins, of equal ones the
first. For the rest, two variable-order Markov models of characters, of accepted and of
rejected URLs, give a log-likelihood difference, divided by the length. A
character has the counts after the longest contexts of up to ``ORDER`` characters,
smoothed with those of each shorter one (Witten-Bell). The models learn from three of four, by
hash, of all different URLs on which the rules speak; a logistic curve fitted on the others
calibrates the difference, and a URL is accepted from one half on.

The models are tables. What a character adds depends on it and the ``ORDER`` characters
before it, so each different window of ``ORDER + 1`` characters is weighed once, from its last
character up to the whole of it, and the windows of a URL are joined and summed. The driver
holds none of these tables: only windows that are more than one in ``_FREQUENT`` of all
characters are broadcast, which are fewer than ``_FREQUENT`` for any input. The rest are
shuffled, where none of them can fill a task.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z in lower case.
Path: then up to ``?``, ``#`` or the end.

Defined results: a null URL or one without ``://`` has an empty host and path and no
rule. With URLs of one verdict only to learn from, that is the verdict of the rest;
with none, the rest is allowed. Repeated rows are judged each. An empty table gives
no rows. Columns other than the id and url are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsearch.llm.common import written

ORDER = 5
_CHARACTERS = 1 << 16
# One part in so many of the URLs with a verdict calibrates.
_PARTS = 4
# Hashes are put in 4,096 ranges to number them.
_RANGE_SHIFT = 52
# A window that is more than one in so many characters is joined by a broadcast.
_FREQUENT = 1 << 13
# Logarithms are summed as whole numbers, so the sum has no order.
_UNIT = 2.0 ** 36
_STEPS = 100
_VERDICTS = ("allow", "block")

Rule = tuple[str, str, str]


def with_parts(pages: DataFrame) -> DataFrame:
    """Adds ``host`` and ``path``."""
    url = F.coalesce(F.col("url"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(coalesce(url, ''), instr(url, '://') + 3)")
                  ).otherwise(F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return pages.withColumn("__rest", rest).withColumn(
        "host", F.regexp_extract("__rest", r"^[^/?#]*", 0)).withColumn(
        "path", F.regexp_extract(
            F.expr("substring(__rest, length(host) + 1)"), r"^[^?#]*", 0)).withColumn(
        "host", F.translate("host", upper, lower)).drop("__rest")


class RuleBook:
    """Rules by host, longest first."""

    def __init__(self, rules: list[Rule]):
        self.by_host: dict[str, list] = {}
        ordered = sorted(enumerate(rules), key=lambda r: (-len(r[1][0] + r[1][1]), r[0]))
        for place, (_, (host, path, verdict)) in enumerate(ordered):
            self.by_host.setdefault(host, []).append((place, path, host + path, verdict))

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        best = None
        at = 0
        while True:
            for rule in self.by_host.get(host[at:], ()):
                if path.startswith(rule[1]) and (best is None or rule[0] < best[0]):
                    best = rule
            dot = host.find(".", at)
            if dot < 0:
                return best and best[2:]
            at = dot + 1


class MarkovModel:
    """Characters after contexts of every length up to ``order``."""

    def __init__(self, texts: list[str], order: int = ORDER):
        self.order, self.counts = order, {}
        for text in texts:
            data = self._framed(text)
            for at in range(order, len(data)):
                for k in range(order + 1):
                    seen = self.counts.setdefault(data[at - k:at], {})
                    seen[data[at]] = seen.get(data[at], 0) + 1
        self.totals = {c: (sum(n.values()), len(n)) for c, n in self.counts.items()}

    def _framed(self, text: str) -> str:
        return "\x02" * self.order + text + "\x03"

    def log_likelihood(self, text: str) -> float:
        data, result = self._framed(text), 0.0
        for at in range(self.order, len(data)):
            p = 1 / _CHARACTERS
            for k in range(self.order + 1):
                context = data[at - k:at]
                if context not in self.totals:
                    break
                total, kinds = self.totals[context]
                p = (self.counts[context].get(data[at], 0) + kinds * p) / (total + kinds)
            result += math.log(p)
        return result


class Judge:
    """The same models and curve over a few URLs, in memory."""

    def __init__(self, urls: dict[str, list[str]], order: int = ORDER):
        self.fixed = None
        if not urls["allow"] or not urls["block"]:
            self.fixed = float(bool(urls["allow"]) or not urls["block"])
            return
        apart = {v: [u for i, u in enumerate(x) if i % 4 == 3] for v, x in urls.items()}
        learn = {v: [u for i, u in enumerate(x) if i % 4 != 3] or x for v, x in urls.items()}
        self.models = [MarkovModel(learn[v], order) for v in ("allow", "block")]
        self.scale, self.offset = 1.0, 0.0
        values = [np.array([self.difference(u) for u in apart[v] or learn[v]])
                  for v in ("allow", "block")]
        self._calibrate(values)

    def difference(self, text: str) -> float:
        a, b = (m.log_likelihood(text) for m in self.models)
        return (a - b) / (len(text) + 1)

    def _calibrate(self, values: list[np.ndarray]) -> None:
        """Logistic curve by gradient steps on a convex loss, both verdicts counting alike."""
        x = np.concatenate(values)
        hit = np.repeat([1.0, 0.0], [len(v) for v in values])
        weight = np.where(hit == 1, 0.5 / len(values[0]), 0.5 / len(values[1]))
        spread = max(x.std(), 1e-6)
        design = np.stack([x / spread, np.ones(len(x))], 1)
        beta = np.zeros(2)
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(design @ beta, -35, 35)))
            gradient = design.T @ (weight * (p - hit)) + 1e-3 * beta * np.array([1, 0])
            hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + np.diag([1e-3, 1e-9])
            beta -= np.linalg.solve(hessian, gradient)
        self.scale, self.offset = beta[0] / spread, beta[1]

    def score(self, text: str) -> float:
        if self.fixed is not None:
            return self.fixed
        at = self.scale * self.difference(text) + self.offset
        return 1 / (1 + math.exp(-max(min(at, 35.0), -35.0)))


def _ruled(book: RuleBook):
    """Columns id, host, path: adds the rule that fits and its verdict."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [book.find(h, p) or (None, None) for h, p in zip(
                batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([
                *batch.columns, pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.string())],
                names=[*batch.schema.names, "rule", "spoken"])
    return run


# --- the models as tables ---------------------------------------------------------


def _dealt(urls: DataFrame) -> DataFrame:
    """URLs with ``apart``: every fourth of those with a verdict, in order of their hash.

    The place of a URL is that in its range of hashes, after the URLs of the ranges before.
    Each URL gets a ``number`` of its own, which stands for it where its windows are shuffled.
    """
    ranged = urls.filter("spoken is not null").withColumn("hash", F.xxhash64("url")).withColumn(
        "range", F.shiftright("hash", _RANGE_SHIFT))
    sizes = ranged.groupBy("spoken", "range").count()
    earlier = Window.partitionBy("spoken").orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = sizes.select("spoken", "range", F.coalesce(
        F.sum("count").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy("spoken", "range").orderBy("hash", "url")
    place = F.col("start") + F.row_number().over(inside) - 1
    dealt = ranged.join(F.broadcast(starts), ["spoken", "range"]).withColumn(
        "apart", place % _PARTS == _PARTS - 1).select("url", "spoken", "apart")
    return dealt.unionByName(urls.filter("spoken is null").withColumn(
        "apart", F.lit(False))).withColumn("number", F.monotonically_increasing_id())


def _windows(urls: DataFrame, order: int, *columns: str | Column) -> DataFrame:
    """Each character of ``url`` with the ``order`` characters before it."""
    framed = F.concat(F.lit("\x02" * order), "url", F.lit("\x03"))
    at = F.sequence(F.lit(1), F.length("url") + 1)
    return urls.select(*columns, F.explode(F.transform(
        at, lambda i: F.substr(framed, i, F.lit(order + 1)))).alias("window"))


def _weights(learned: DataFrame, wanted: DataFrame, order: int) -> DataFrame:
    """``window, weight, asked``: by how much each window speaks for allow, in units of
    ``_UNIT``, and how often it is asked for.

    ``learned`` holds URLs with ``spoken``, ``wanted`` the URLs to be weighed.
    """
    seen = _windows(learned, order, "spoken").unionByName(
        _windows(wanted, order, F.lit("asked").alias("spoken")))
    base = written(seen.groupBy("window").agg(*[
        F.count_if(F.col("spoken") == v).alias(v) for v in (*_VERDICTS, "asked")]), "windows")
    level = None
    for k in range(order + 1):
        gram = F.substring("window", order + 1 - k, k + 1)
        counts = base.groupBy(gram.alias("gram")).agg(
            *[F.sum(v).alias(v) for v in (*_VERDICTS, "asked")])
        # A context has at most as many rows here as there are characters.
        context = Window.partitionBy(F.substring("gram", 1, k))
        if level is None:
            counts = counts.withColumns({f"p_{v}": F.lit(1 / _CHARACTERS) for v in _VERDICTS})
        counts = counts.withColumns({
            **{f"total_{v}": F.sum(v).over(context) for v in _VERDICTS},
            **{f"kinds_{v}": F.count_if(F.col(v) > 0).over(context) for v in _VERDICTS}})
        if level is not None:
            # Joins of stored tables name their kind: Spark goes by the size of the files, and
            # would broadcast tables that are many times larger in memory.
            counts = counts.withColumn("shorter", F.substring("gram", 2, k)).join(
                level.drop("asked").withColumnRenamed("gram", "shorter").hint("merge"), "shorter")
        level = counts.select("gram", "asked", *[
            F.when(F.col(f"total_{v}") > 0, (F.col(v) + F.col(f"kinds_{v}") * F.col(f"p_{v}")) / (
                F.col(f"total_{v}") + F.col(f"kinds_{v}"))).otherwise(F.col(f"p_{v}")).alias(f"p_{v}")
            for v in _VERDICTS])
    weight = F.round((F.log("p_allow") - F.log("p_block")) * _UNIT).cast("long")
    # Of the whole windows each is a row of its own.
    return level.filter("asked > 0").select(
        F.col("gram").alias("window"), weight.alias("weight"), "asked")


def _differences(urls: DataFrame, weights: DataFrame, order: int) -> DataFrame:
    """Log-likelihood difference of each URL, divided by its length.

    ``urls`` hold ``number``, ``url`` and what else is wanted of them, ``weights`` all their windows.
    """
    windows = _windows(urls, order, "number")
    least = weights.agg(F.sum("asked")).first()[0] // _FREQUENT
    often = F.broadcast(weights.filter(F.col("asked") > least).select("window", "weight"))
    seldom = weights.filter(F.col("asked") <= least).select("window", "weight")
    found = windows.join(often, "window").unionByName(
        windows.join(often, "window", "left_anti").join(seldom.hint("merge"), "window"))
    total = found.groupBy("number").agg(F.sum("weight").alias("total"))
    return urls.join(total.hint("merge"), "number").withColumn(
        "difference", F.col("total") / _UNIT / (F.length("url") + 1)).drop("number", "total")


def _curve(values: DataFrame) -> tuple[float, float]:
    """Logistic curve by Newton steps on sums over all rows, both verdicts counting alike.

    ``values`` hold ``difference`` and ``hit``.
    """
    shape = values.agg(
        F.count_if("hit").alias("hits"), F.count_if(~F.col("hit")).alias("others"),
        F.stddev_pop("difference").alias("spread")).first()
    spread = max(shape["spread"] or 0.0, 1e-6)
    weight = F.when(F.col("hit"), 0.5 / shape["hits"]).otherwise(0.5 / shape["others"])
    rows = values.select((F.col("difference") / spread).alias("x"), weight.alias("w"),
                         F.col("hit").cast("double").alias("y"))
    beta = np.zeros(2)
    for _ in range(_STEPS):
        at = F.greatest(F.least(F.col("x") * float(beta[0]) + float(beta[1]), F.lit(35.0)), F.lit(-35.0))
        p = 1 / (1 + F.exp(-at))
        off, bend = F.col("w") * (p - F.col("y")), F.col("w") * p * (1 - p)
        s = rows.agg(F.sum(off * F.col("x")), F.sum(off), F.sum(bend * F.col("x") * F.col("x")),
                     F.sum(bend * F.col("x")), F.sum(bend)).first()
        gradient = np.array([s[0] + 1e-3 * beta[0], s[1]])
        hessian = np.array([[s[2] + 1e-3, s[3]], [s[3], s[4] + 1e-9]])
        step = np.linalg.solve(hessian, gradient)
        beta -= step
        if np.abs(step).max() < 1e-10:
            break
    return float(beta[0] / spread), float(beta[1])


def judge(pages: DataFrame, rules: list[Rule], id_column: str = "page_id",
          order: int = ORDER) -> DataFrame:
    """The id with ``host``, ``path``, ``rule``, ``verdict`` (allow or block) and ``score``."""
    parts = with_parts(pages.select(id_column, "url")).select(
        F.col(id_column).alias("id"), "host", "path")
    schema = T.StructType([*parts.schema.fields, T.StructField("rule", T.StringType()),
                           T.StructField("spoken", T.StringType())])
    ruled = written(parts.mapInArrow(_ruled(RuleBook(rules)), schema).withColumn(
        "url", F.concat("host", "path")), "ruled")
    urls = written(_dealt(ruled.select("url", "spoken").distinct()), "urls")
    kinds = {(r["spoken"], r["apart"]): r["count"]
             for r in urls.groupBy("spoken", "apart").count().collect()}
    held = {v: kinds.get((v, False), 0) + kinds.get((v, True), 0) for v in _VERDICTS}
    if not all(held.values()):
        fixed = float(bool(held["allow"]) or not held["block"])
        scored = ruled.withColumn("score", F.when(F.col("rule").isNull(), F.lit(fixed)))
    else:
        # A verdict that has URLs on one side only uses them for both.
        whole = {side: [v for v in _VERDICTS if not kinds.get((v, side))] for side in (True, False)}
        of_verdict = F.col("spoken").isNotNull()
        learned = urls.filter(of_verdict & (~F.col("apart") | F.col("spoken").isin(whole[False])))
        calibrates = F.col("apart") | F.col("spoken").isin(whole[True])
        wanted = urls.filter(~of_verdict | calibrates).select("number", "url", "spoken")
        weights = written(_weights(learned, wanted, order), "weights")
        found = written(_differences(wanted, weights, order), "differences")
        scale, offset = _curve(written(found.filter(of_verdict).select(
            "difference", (F.col("spoken") == "allow").alias("hit")), "calibrating"))
        at = F.greatest(F.least(F.col("difference") * scale + offset, F.lit(35.0)), F.lit(-35.0))
        unruled = found.filter(~of_verdict).select("url", "difference")
        scored = ruled.join(unruled.hint("merge"), "url", "left").withColumn("score", F.when(
            F.col("rule").isNull(), F.round(1 / (1 + F.exp(-at)), 12)))
    verdict = F.when(F.col("rule").isNotNull(), F.col("spoken")).otherwise(
        F.when(F.col("score") >= 0.5, "allow").otherwise("block"))
    return scored.select(F.col("id").alias(id_column), "host", "path", "rule",
                         verdict.alias("verdict"), "score")
