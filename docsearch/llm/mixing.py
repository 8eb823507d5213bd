"""Mixing sources to target weights by entropy balancing.

The rates r (copies of a document) minimise the relative entropy to a common
rate q over documents, under one token constraint for each source, the sum of
r * size, and under r <= ``max_copies``. The solution is an exponential tilt,
r = min(max_copies, q * exp(lambda_source * size / mean size of the source)).
Newton steps on the convex dual find the lambdas: in each step Spark sums the
tokens and their derivative for every source over a table of (source, size,
documents), which is small against the documents; the driver holds a few numbers
for each source. A step that leaves the bracket of the root is replaced by its
middle, so the iterations always end. A source whose target is all of its copies
has that rate without iterations.

Rounding is systematic: documents are ordered by size, and the running sum of
rates passes whole numbers as often as copies are made, so the tokens of a group
miss their target by less than its largest document. Groups are a source or, for
a large source, its part of a number of rows. What a source still lacks or has
too much is then given to or taken from a few documents of each order of size,
largest first.

Sources are few (``max_sources``, more is an error): their totals are collected.

Defined results: a null text has size 0 and rate q, and takes 0 words. Sources
are ordered by code point, null last; a null source is a source. A source of size
0 has target 0. Repeated rows are rounded each on its own. An empty table gives
no rows. ``mix`` keeps the columns of its input and repeats rows, in no order.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsearch.llm import common as C

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_COPIES = 2
MAX_SOURCES = 100_000
GROUP_ROWS = 5_000
CANDIDATES = 8
_LIMIT = 700.0


@dataclass
class Source:
    """A source with its totals, target in tokens and tilt."""

    name: str | None
    size: int
    rows: int
    target: float = 0.0
    tilt: float = 0.0
    full: bool = False


def n_words() -> Column:
    """Number of words of the text; null has none."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sizes: list[int], weights=WEIGHTS, share: float = SHARE,
            max_copies: float = MAX_COPIES) -> list[float]:
    """Tokens for each source: ``share`` of all sizes by weight, none above ``max_copies``
    times its size; the excess goes to the others by weight until none is above."""
    open_ = {i: float(weights[i % len(weights)]) for i in range(len(sizes))}
    out, left = [0.0] * len(sizes), share * sum(sizes)
    while open_:
        whole = sum(open_.values())
        above = [i for i, w in open_.items() if left * w / whole > max_copies * sizes[i]]
        if not above:
            for i, w in open_.items():
                out[i] = left * w / whole
            break
        for i in above:
            out[i] = float(max_copies * sizes[i])
            del open_[i]
        left -= sum(out[i] for i in above)
    return out


def _rate(tilt: Column, size: Column, mean: Column, q: float, max_copies: float) -> Column:
    power = F.least(F.greatest(tilt * size / mean, F.lit(-_LIMIT)), F.lit(_LIMIT))
    return F.least(F.lit(q) * F.exp(power), F.lit(float(max_copies)))


def _key(column: str) -> Column:
    """Sources as a key without nulls: the null source is the empty array."""
    return F.when(F.col(column).isNull(), F.array().cast("array<string>")).otherwise(
        F.array(column))


def _tilts(spark, sources: list[Source]) -> DataFrame:
    rows = [([] if s.name is None else [s.name], s.tilt, s.size / s.rows if s.size else 1.0,
             s.target, s.full) for s in sources]
    return F.broadcast(spark.createDataFrame(
        rows, "key array<string>, tilt double, mean double, target double, full boolean"))


def balance(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
            max_copies: int = MAX_COPIES, max_sources: int = MAX_SOURCES,
            tolerance: float = 1e-9) -> list[Source]:
    """Targets and tilts from rows of (key, size)."""
    spark = sizes.sparkSession
    table = C.written(sizes.groupBy("key", "size").agg(F.count("*").alias("n")), "sizes")
    totals = table.groupBy("key").agg(
        F.sum(F.col("size") * F.col("n")).alias("size"), F.sum("n").alias("rows")
    ).limit(max_sources + 1).collect()
    if len(totals) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    sources = sorted(
        (Source(r["key"][0] if r["key"] else None, r["size"], r["rows"]) for r in totals),
        key=lambda s: (s.name is None, s.name or ""))
    q = share
    for source, target in zip(
            sources, targets([s.size for s in sources], weights, share, max_copies), strict=True):
        source.target = target
        source.full = source.size > 0 and target >= max_copies * source.size
    moving = {s.name: s for s in sources if s.size and not s.full}
    low, high = dict.fromkeys(moving, -_LIMIT), dict.fromkeys(moving, _LIMIT)
    for _ in range(200):
        if not moving:
            break
        size = F.col("size").cast("double")
        rate = _rate(F.col("tilt"), size, F.col("mean"), q, max_copies)
        tokens = F.col("n") * size * rate
        sums = table.join(_tilts(spark, list(moving.values())), "key").groupBy("key").agg(
            F.sum(tokens).alias("tokens"),
            F.sum(F.when(rate < max_copies, tokens * size / F.col("mean")).otherwise(0.0))
            .alias("slope"), F.max("target").alias("target")).collect()
        for r in sums:
            name = r["key"][0] if r["key"] else None
            source, gap = moving[name], r["tokens"] - r["target"]
            if abs(gap) <= tolerance * max(r["target"], 1.0):
                del moving[name]
                continue
            (high if gap > 0 else low)[name] = source.tilt
            step = source.tilt - gap / r["slope"] if r["slope"] > 0 else math.inf
            if not low[name] < step < high[name]:
                step = (low[name] + high[name]) / 2
            if step == source.tilt or high[name] - low[name] < 1e-13:
                del moving[name]
            source.tilt = step
    return sources


def _adjust(max_copies: int):
    def run(key: tuple, found: pd.DataFrame) -> pd.DataFrame:
        """Give or take copies, largest documents first, until the gap is met."""
        gap, change = float(found["gap"].iloc[0]), []
        for row in found.sort_values(["words", "tie", "row"], ascending=[False, True, True]).itertuples():
            size = row.words
            room = max_copies - row.copies if gap > 0 else row.copies
            n = min(room, int((abs(gap) + size / 2) // size))
            if n > 0:
                n = n if gap > 0 else -n
                gap -= n * size
                change.append((row.row, n))
        return pd.DataFrame(change, columns=["row", "change"]).astype("int64")
    return run


def copies(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, max_copies: int = MAX_COPIES,
           max_sources: int = MAX_SOURCES) -> DataFrame:
    """``docs`` needs row (unique long), doc_id, source and size; the result has row,
    source_size, target, rate and copies.

    Ties of size are ordered by a hash of doc_id, so a rerun with other splits agrees.
    """
    spark = docs.sparkSession
    rows = C.written(docs.select("row", F.xxhash64("doc_id").alias("tie"),
                                 _key("source").alias("key"), "size"), "rows")
    sources = balance(rows.select("key", "size"), weights, share, max_copies, max_sources)
    if not sources:
        return docs.select("row", F.lit(0).cast("long").alias("source_size"),
                           F.lit(0.0).alias("target"), F.lit(0.0).alias("rate"),
                           F.lit(0).cast("long").alias("copies"))
    of_source = F.broadcast(spark.createDataFrame(
        [([] if s.name is None else [s.name], s.size, -(-s.rows // GROUP_ROWS))
         for s in sources], "key array<string>, source_size long, groups long"))
    rate = F.when(F.col("full"), F.lit(float(max_copies))).otherwise(
        _rate(F.col("tilt"), F.col("size"), F.col("mean"), share, max_copies))
    rated = rows.join(_tilts(spark, sources), "key").join(of_source, "key").select(
        "key", "row", "tie", "size", "source_size", "target", rate.alias("rate"),
        F.pmod(F.hash("tie"), "groups").alias("part"))
    sums = F.expr("sum(rate) over (partition by key, part order by size desc, tie, row)")
    offset = F.pmod(F.xxhash64("key", "part"), F.lit(1000)) / 1000.0
    # The last decimals of a running sum may differ; whole rates stay whole.
    upto = F.floor(F.round(F.col("upto") + offset, 6))
    before = F.floor(F.round(F.col("upto") - F.col("rate") + offset, 6))
    rounded = C.written(rated.withColumn("upto", sums).withColumn(
        "copies", F.least(upto - before, F.lit(max_copies)).cast("long")), "rounded")
    gaps = rounded.groupBy("key").agg(
        (F.max("target") - F.sum(F.col("copies") * F.col("size"))).alias("gap"))
    # A few documents of each order of size that can be taken once more, or once less.
    movable = (F.col("gap") > 0) & (F.col("copies") < max_copies) | (
        F.col("gap") < 0) & (F.col("copies") > 0)
    able = rounded.join(F.broadcast(_few(gaps, len(sources))), "key").filter(
        movable & (F.col("size") > 0)).select(
        "key", "row", "tie", "copies", "gap", "size", F.floor(F.log2("size")).alias("order"),
        F.pmod(F.hash("tie"), F.lit(64)).alias("salt"))

    def first(df: DataFrame, *by: str) -> DataFrame:
        by = ", ".join(by)
        return df.withColumn("nth", F.expr(
            f"row_number() over (partition by {by} order by tie, row)")).filter(
            F.col("nth") <= CANDIDATES)

    few = first(first(able, "key", "order", "salt"), "key", "order").withColumnRenamed(
        "size", "words")
    changes = few.groupBy("key").applyInPandas(_adjust(max_copies), "row long, change long")
    return rounded.join(changes, "row", "left").select(
        "row", "source_size", "target", "rate",
        (F.col("copies") + F.coalesce("change", F.lit(0))).alias("copies"))


def _few(df: DataFrame, rows: int) -> DataFrame:
    """A table with one row for each source, whose number was checked."""
    return df.limit(rows)


def mix(docs: DataFrame, **options) -> DataFrame:
    """The columns of ``docs``, every row as often as the mix takes it."""
    caller = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("caller")
    numbered = C.written(
        docs.select(caller, F.monotonically_increasing_id().alias("row")), "numbered")
    taken = copies(numbered.select("row", "caller.doc_id", "caller.source", "caller.text").select(
        "row", "doc_id", "source", n_words().alias("size")), **options)
    many = taken.select("row", "copies").filter("copies > 0")
    return numbered.join(many, "row").select(
        "caller", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("caller.*")
