"""Quality rules: base text statistics, then robust multivariate outliers.

Method. Every document is described by four transformed statistics
(``FEATURES``). For each (language, source) group the location and scatter of
the vectors are estimated by the minimum covariance determinant: from two
deterministic starts (median and absolute deviations; the classical moments),
concentration steps keep the ``SUPPORT`` share of rows with the smallest
Mahalanobis distances and re-estimate from them; the start whose final
determinant is smaller wins. Scatter is scaled to be consistent at the normal
model, and a document is rejected when its squared distance exceeds ``cutoff``.

Distribution. Only DataFrame functions. The text is scanned once; what follows
works on a table of numbers. A group never meets in one task: its moments are
partial sums, and its order statistics come from a histogram of logarithmic
distances (``BINS`` per unit), counted the same way. Features are integers
(ten-thousandths), so sums are exact and the result does not depend on how the
rows are dealt out.

Cases. Null and empty text: no words, so ``base_failed``. A null language or
source is a group of its own. A group with fewer than ``min_rows`` documents
that pass the base rules is judged by the estimate of the next wider group that
has as many: its language, then all documents. Only in a table with fewer than
``min_rows`` of them altogether do documents keep the base verdict. Repeated
rows are judged one by one. Extra columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, small, word_split, written

MIN_WORDS = 50
REPEAT_PERCENT = 50
#: Share of rows an estimate rests on: outliers below half of a group can't enter.
SUPPORT = 0.5
STEPS = 4
BINS = 32
#: Rows below which a group takes the estimate of the next wider one.
MIN_ROWS = 12
SCALE = 10_000
#: Squared distance of rejection: far beyond the 0.9999 quantile (23.5) of a
#: chi-square with four degrees of freedom, because clean text isn't normal.
CUTOFF = 40.0
#: Median of a chi-square with four degrees of freedom.
CHI2_MEDIAN = 3.3567
#: Least standard deviation of each feature, in feature units: a statistic that
#: is constant in a group (no symbols at all) must not reject on a trifle.
FLOORS = (0.1, 0.03, 0.06, 0.1)
FEATURES = ("word_length", "symbols", "capitals", "repeats")
P = len(FEATURES)
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]


def _chars(text: Column, pattern: str) -> Column:
    """Characters that are left when those matching ``pattern`` are removed."""
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), pattern, "")).cast("long")


def base_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_capitals, n_dup_lines,
    n_repeat_words and base_failed."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    df = docs.withColumns({"_w": word_split(F.col(text)), "_l": lines})
    df = df.withColumns({
        "n_words": F.size("_w").cast("long"),
        "word_chars": _chars(F.col(text), "[\\x20\\x09-\\x0D]+"),
        "n_symbols": _chars(F.col(text), "[^#*$%&|<>]+"),
        "n_capitals": _chars(F.col(text), "[^A-Z]+"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        # hash of the three-word window at each position
        "_h": F.when(
            F.size("_w") >= 3,
            F.transform(F.sequence(F.lit(0), F.size("_w") - 3), lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2))),
        ).otherwise(F.array().cast("array<bigint>")),
    }).drop("_l")
    df = df.withColumn("_more", F.size(F.array_distinct("_h")) < F.size("_h"))
    # positions sorted by hash: a repeated window has an equal neighbour
    order = F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("_s", F.when(F.col("_more"), order))
    twice = F.filter("_s", lambda x, j: (x["h"] == F.get("_s", j - 1)["h"]) | (x["h"] == F.get("_s", j + 1)["h"]))
    df = df.withColumn("_p", F.when(F.col("_more"), F.sort_array(F.transform(twice, lambda x: x["i"]))))
    gaps = F.transform("_p", lambda p, j: F.least(F.lit(3), F.coalesce(F.get("_p", j + 1) - p, F.lit(3))))
    df = df.withColumn("n_repeat_words", F.when(F.col("_more"), F.aggregate(gaps, F.lit(0), lambda a, x: a + x)).otherwise(F.lit(0)).cast("long"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return df.drop("_w", "_h", "_more", "_s", "_p").withColumn("base_failed", failed)


def features(df: DataFrame) -> DataFrame:
    """The four statistics as whole ten-thousandths; null without words."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    c = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    raw = (F.sqrt(c / n), F.sqrt(F.col("n_symbols") / c), F.sqrt(F.col("n_capitals") / c), F.col("n_repeat_words") / n)
    return df.withColumns({f"x{i}": F.round(r * SCALE).cast("long") for i, r in enumerate(raw)})


def _cholesky(est: DataFrame) -> DataFrame:
    """Lower factor ``l{i}{j}`` and ``logdet`` of the scatter ``c{j}{i}``."""
    out = est
    for j in range(P):
        s = F.col(f"c{j}{j}")
        for k in range(j):
            s = s - F.col(f"l{j}{k}") * F.col(f"l{j}{k}")
        out = out.withColumn(f"l{j}{j}", F.sqrt(F.greatest(s, F.lit(1e-9))))
        for i in range(j + 1, P):
            s = F.col(f"c{j}{i}")
            for k in range(j):
                s = s - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            out = out.withColumn(f"l{i}{j}", s / F.col(f"l{j}{j}"))
    det = sum((F.ln(F.col(f"l{i}{i}")) for i in range(P)), F.lit(0.0))
    return out.withColumn("logdet", F.round(2 * det, 9))


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution."""
    z: list[Column] = []
    for i in range(P):
        v = F.col(f"x{i}") / F.lit(float(SCALE)) - F.col(f"m{i}")
        for k in range(i):
            v = v - F.col(f"l{i}{k}") * z[k]
        z.append(v / F.col(f"l{i}{i}"))
    return sum((v * v for v in z), F.lit(0.0))


def _moments(df: DataFrame, keys: list[str]) -> DataFrame:
    """Mean ``m{i}`` and floored covariance ``c{i}{j}`` from exact sums."""
    wide = [F.col(f"x{i}").cast("decimal(19,0)") for i in range(P)]
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.sum(w).alias(f"s{i}") for i, w in enumerate(wide)]
    aggs += [F.sum((F.col(f"x{i}") * F.col(f"x{j}")).cast("decimal(19,0)")).alias(f"q{i}{j}") for i, j in PAIRS]
    out = df.groupBy(*keys).agg(*aggs)
    s = [F.col(f"s{i}").cast("double") / F.col("n") / SCALE for i in range(P)]
    cols = {f"m{i}": s[i] for i in range(P)}
    for i, j in PAIRS:
        c = F.col(f"q{i}{j}").cast("double") / F.col("n") / (SCALE * SCALE) - s[i] * s[j]
        cols[f"c{i}{j}"] = c + FLOORS[i] ** 2 if i == j else c
    return out.withColumns(cols).drop(*[f"s{i}" for i in range(P)], *[f"q{i}{j}" for i, j in PAIRS])


def _bin(distance: Column) -> Column:
    return F.floor(F.ln(distance + F.lit(1e-6)) * BINS).cast("int")


def _order_statistic(df: DataFrame, keys: list[str], bins: Column, share: float, name: str) -> DataFrame:
    """For each group the least bin up to which ``share`` of its rows lie."""
    counts = df.select(*keys, bins.alias("_b")).groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*keys)
    run = counts.select(*keys, "_b", F.sum("_n").over(w.orderBy("_b")).alias("_c"), F.sum("_n").over(w).alias("_t"))
    return run.where(F.col("_c") >= F.ceil(F.col("_t") * F.lit(share))).groupBy(*keys).agg(F.min("_b").alias(name))


def _median(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Median and absolute deviation of each feature as mean and scatter, read
    off histograms whose bins are a hundredth of a feature unit wide."""
    step, by = SCALE // 100, [*keys, "f"]
    tall = rows.select(*keys, F.posexplode(F.array(*[F.col(f"x{i}") for i in range(P)])).alias("f", "x"))
    mid = checkpointed(_order_statistic(tall, by, F.floor(F.col("x") / step).cast("int"), 0.5, "b"))
    dev = _order_statistic(_with_estimate(tall, mid, by), by, F.floor(F.abs(F.col("x") / step - F.col("b") - 0.5)).cast("int"), 0.5, "d")
    both = _with_estimate(mid, checkpointed(dev), by)
    out = both.groupBy(*keys).agg(*[F.max(F.when(F.col("f") == i, F.col(c))).alias(f"{c}{i}") for i in range(P) for c in "bd"])
    cols = {f"m{i}": (F.col(f"b{i}") + 0.5) / 100 for i in range(P)}
    for i, j in PAIRS:
        sd = 1.4826 * (F.col(f"d{i}") + 0.5) / 100
        cols[f"c{i}{j}"] = sd * sd + FLOORS[i] ** 2 if i == j else F.lit(0.0)
    return out.withColumns(cols).drop(*[f"{c}{i}" for i in range(P) for c in "bd"])


def _with_estimate(rows: DataFrame, est: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` joined to the estimates of their group (null-safe keys)."""
    e = small(est.withColumnsRenamed({k: f"_{k}" for k in keys}))
    cond = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return rows.join(e, cond, "left").drop(*[f"_{k}" for k in keys])


def mcd(rows: DataFrame, keys: list[str], min_rows: int) -> DataFrame:
    """Location ``m{i}``, Cholesky factor ``l{i}{j}`` and consistency
    ``factor`` of each group of ``rows`` (columns ``keys`` and x0..x3) that
    has ``min_rows`` rows: one row a group."""
    start = [*keys, "start"]
    classical = checkpointed(_moments(rows, keys))
    sizes = classical.select(*keys, F.col("n").alias("size"))
    est = classical.drop("n").withColumn("start", F.lit(0)).unionByName(_median(rows, keys).withColumn("start", F.lit(1)))
    est = checkpointed(_cholesky(est))
    both = rows.withColumn("start", F.explode(F.array(F.lit(0), F.lit(1))))
    for _ in range(STEPS):
        near = _with_estimate(both, est, start).select(*start, *[f"x{i}" for i in range(P)], _bin(_distance()).alias("_d"))
        edge = checkpointed(_order_statistic(near, start, F.col("_d"), SUPPORT, "edge"))
        inside = _with_estimate(near, edge, start).where(F.col("_d") <= F.col("edge"))
        est = checkpointed(_cholesky(_moments(inside, start).drop("n")))
    turn = Window.partitionBy(*keys).orderBy("logdet", "start")
    best = checkpointed(est.withColumn("_r", F.row_number().over(turn)).where("_r = 1").drop("_r", "start"))
    near = _with_estimate(rows, best, keys).select(*keys, _bin(_distance()).alias("_d"))
    mid = checkpointed(_order_statistic(near, keys, F.col("_d"), 0.5, "mid"))
    out = _with_estimate(_with_estimate(best, mid, keys), sizes, keys).where(F.col("size") >= min_rows)
    # the floors already widen the scatter, so the factor never narrows it
    factor = F.greatest(F.exp((F.col("mid") + 1) / BINS) / CHI2_MEDIAN, F.lit(1.0))
    return checkpointed(out.select(*keys, factor.alias("factor"), *[f"m{i}" for i in range(P)], *[f"l{i}{j}" for i in range(P) for j in range(i + 1)]))


def _at_levels(df: DataFrame, keys: list[str], levels: Column) -> DataFrame:
    """``df`` once for each of its ``levels``: at level v the columns ``_w{i}``
    hold the keys but the last v, which are null."""
    df = df.withColumn("_lv", F.explode(levels))
    return df.withColumns({f"_w{i}": F.when(F.col("_lv") < len(keys) - i, F.col(k)) for i, k in enumerate(keys)})


def estimates(rows: DataFrame, keys: list[str], min_rows: int) -> DataFrame:
    """The estimate of each group of ``rows``, or that of the narrowest wider
    group with ``min_rows`` rows: one row a group, unless all rows are fewer."""
    wide = ["_lv", *[f"_w{i}" for i in range(len(keys))]]
    every = F.array(*[F.lit(v) for v in range(len(keys) + 1)])
    each = checkpointed(_at_levels(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), keys, every))
    totals = checkpointed(each.groupBy(*wide).agg(F.sum("_n").alias("_t")))
    level = _with_estimate(each, totals, wide).where(F.col("_t") >= min_rows).groupBy(*keys).agg(F.array(F.min("_lv")).alias("_v"))
    chosen = checkpointed(_at_levels(level, keys, F.col("_v")).drop("_v"))
    # a row counts only at the levels that some group is judged at
    asked = checkpointed(chosen.select(*wide).distinct().withColumn("_asked", F.lit(True)))
    many = _with_estimate(_at_levels(rows, keys, every), asked, wide).where("_asked")
    est = mcd(written(many.select(*wide, *[f"x{i}" for i in range(P)]), "quality-levels"), wide, min_rows)
    return checkpointed(_with_estimate(chosen, est, wide).drop(*wide))


def judge(docs: DataFrame, text: str = "text", keys: tuple[str, ...] = ("lang", "source"), carry: tuple[str, ...] = ("doc_id",),
          cutoff: float = CUTOFF, min_rows: int = MIN_ROWS) -> DataFrame:
    """One row a document: ``carry``, the base statistics, ``base_failed``,
    ``distance2`` (null without an estimate) and ``kept``."""
    k = [f"_k{i}" for i in range(len(keys))]
    rows = docs.select(*carry, *[F.col(c).cast("string").alias(a) for c, a in zip(keys, k)], F.col(text).alias("_text"))
    rows = features(base_statistics(rows, "_text")).drop("_text")
    rows = written(rows, "quality-statistics")
    passing = rows.where(~F.col("base_failed")).select(*k, *[f"x{i}" for i in range(P)])
    est = estimates(passing, k, min_rows)
    out = _with_estimate(rows, est, k).withColumn("distance2", F.when(~F.col("base_failed"), F.round(_distance() / F.col("factor"), 6)))
    kept = ~F.col("base_failed") & (F.coalesce(F.col("distance2"), F.lit(0.0)) <= F.lit(cutoff))
    return out.select(*carry, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "distance2")


def keep(docs: DataFrame, text: str = "text", keys: tuple[str, ...] = ("lang", "source"), doc_id: str = "doc_id", cutoff: float = CUTOFF, min_rows: int = MIN_ROWS) -> DataFrame:
    """The rows of ``docs`` that the rules keep, columns unchanged. Rows are
    found again by (id, hash of text, keys): equal rows have equal verdicts."""
    tag = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    k = [f"key{i}" for i in range(len(keys))]
    names = ["id", "tag", *k]
    rows = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("id"), F.col(text).alias("text"), tag.alias("tag"), *[F.col(c).alias(a) for c, a in zip(keys, k)])
    verdict = judge(rows.drop("row"), "text", tuple(k), tuple(names), cutoff, min_rows)
    bad = written(verdict.where(~F.col("kept")).select(*[F.col(n).alias(f"bad_{n}") for n in names]).distinct(), "quality-rejected")
    return rows.join(small(bad), [F.col(n).eqNullSafe(F.col(f"bad_{n}")) for n in names], "left_anti").select("row.*")
