"""Quality rules: text statistics, and robust multivariate outliers per language and source.

The statistics come from built-in functions over whole texts. Four transformed statistics make a
vector per document. Each language and source, however small, gets its minimum-covariance-determinant
estimate: from three deterministic starts (medians with absolute deviations; the same with the
correlation of the scores' tanh; with that of their directions) concentration steps repeatedly take
the three quarters of the documents nearest by Mahalanobis distance and re-estimate mean and
covariance on them, until the determinant no longer falls; the start that ends lowest counts. A
document is rejected beyond the chi-square quantile ``LEVEL``.

The covariance is regularized: it counts as if ``PRIOR`` further documents had the target's variances,
which are the squared deviations of all documents from their groups' medians. So a group of few
documents leans on what all share and a large one on itself, without a size at which the rule changes.
Statistics that most documents share exactly would have no spread: ``FLOOR`` is added to each standard
deviation, squared.

Nothing sorts or gathers a group: a group's quantile comes from counts of fixed-width bins (so the
nearest three quarters end at a bin's edge), its moments from sums, both combined before the shuffle.
A source with a third of all rows costs one row per bin and task.

Defined results. A group's only document is its own centre, so the base rules decide on it. Null text has no words and fails the base rules. Null language or source is a value
of its own. Rows that repeat are counted each. Further columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from wearlens.llm.store import forget, keep, let, own

BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
SHARE = 0.75
PRIOR = 20.0  # documents that the target counts for
GAIN = 1e-6  # a step has to lower the log determinant by so much
LEVEL = 0.9999
FLOOR = (0.3, 0.05, 0.5, 0.5)
P = len(FLOOR)


def _chi4(x: float) -> float:
    return 1 - math.exp(-x / 2) * (1 + x / 2)


def _chi6(x: float) -> float:
    return 1 - math.exp(-x / 2) * (1 + x / 2 + x * x / 8)


def chi4_quantile(p: float) -> float:
    lo, hi = 0.0, 200.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if _chi4(mid) < p else (lo, mid)
    return lo


#: makes the covariance of the nearest three quarters that of all, if they are normal
CONSISTENT = SHARE / _chi6(chi4_quantile(SHARE))
CUT = chi4_quantile(LEVEL)


def _repeated(words: Column) -> Column:
    """Words inside 3-word windows that occur at least twice."""
    windows = F.when(
        F.size(words) >= 3,
        F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))),
    ).otherwise(F.array().cast("array<bigint>"))

    def covered(at: Column) -> Column:  # each repeated window adds what the next one doesn't cover
        width = F.transform(at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3))))
        return F.aggregate(width, F.lit(0).cast("long"), lambda s, x: s + x)

    def positions(seen: Column) -> Column:
        same = lambda s, other: F.coalesce(s["h"] == other["h"], F.lit(False))
        return F.filter(seen, lambda s, k: same(s, F.get(seen, k - 1)) | same(s, F.get(seen, k + 1)))

    def of(grams: Column) -> Column:
        placed = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        at = let(placed, lambda seen: F.sort_array(F.transform(positions(seen), lambda s: s["i"])))
        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0).cast("long")).otherwise(let(at, covered))

    return let(windows, of)


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = F.coalesce("text", F.lit(""))
    words = F.array_remove(F.split(text, BLANK), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    of_words = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), F.length(F.array_join(w, "")).cast("long").alias("chars"), _repeated(w).alias("repeated")))
    plain = own(docs, "doc_id", "lang", "source", "text")
    counted = plain.select(
        "doc_id", "lang", "source",
        of_words.alias("w"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    )
    out = counted.select("doc_id", "lang", "source", F.col("w.n").alias("n_words"), F.col("w.chars").alias("word_chars"), "n_symbols", "n_dup_lines", F.col("w.repeated").alias("n_repeat_words"))
    return out.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def vectors(stats: DataFrame) -> DataFrame:
    """``stats`` of documents that pass the base rules, with x0..x3: length, word length, symbols, repetition."""
    n = F.col("n_words").cast("double")
    return stats.filter(~F.col("base_failed")).withColumns(
        {
            "x0": F.log(n),
            "x1": F.log(F.col("word_chars") / n),
            "x2": F.log(1 + 100 * F.col("n_symbols") / n),
            "x3": F.log(1 + 100 * F.col("n_repeat_words") / n),
        }
    )


def cut_points(rows: DataFrame, keys: list[str], bin_: str, share: float) -> DataFrame:
    """Per key the lowest bin up to which at least ``share`` of its rows lie."""
    from pyspark.sql import Window

    counts = rows.groupBy(*keys, bin_).agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*keys).orderBy(bin_))
    total = F.sum("n").over(Window.partitionBy(*keys))
    at = counts.withColumns({"upto": upto, "total": total}).filter(F.col("upto") >= share * F.col("total"))
    return at.groupBy(*keys).agg(F.min(bin_).alias("cut"))


def _x(i: int) -> str:
    return f"x{i}"


PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]
MEANS = [f"m{i}" for i in range(P)]
FACTOR = [f"l{i}{j}" for i, j in PAIRS]


def scales(rows: DataFrame) -> tuple[DataFrame, list[float]]:
    """Per group medians m0..m3 and deviations d0..d3; and the four target variances, from all rows."""
    long = rows.select("g", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.floor(F.col(_x(i)) * 1000).alias("q")) for i in range(P)])).alias("v")).select("g", "v.*")
    median = keep(cut_points(long, ["g", "i"], "q", 0.5).withColumnRenamed("cut", "median"), "medians")
    off = long.join(median, ["g", "i"]).select("g", "i", F.abs(F.col("q") - F.col("median")).alias("q"))
    spread = cut_points(off, ["g", "i"], "q", 0.5).join(median, ["g", "i"])
    pick = lambda i, c: F.max(F.when(F.col("i") == i, F.col(c))) / 1000
    sd = lambda i: F.sqrt(F.pow(1.4826 * pick(i, "cut"), F.lit(2.0)) + FLOOR[i] ** 2)
    wide = keep(spread.groupBy("g").agg(*[pick(i, "median").alias(m) for i, m in enumerate(MEANS)], *[sd(i).alias(f"d{i}") for i in range(P)]), "scales")
    all_rows = {r["i"]: r["cut"] / 1000 for r in cut_points(off, ["i"], "q", 0.5).collect()}  # four numbers
    forget(median)
    return wide, [(1.4826 * all_rows.get(i, 0.0)) ** 2 + FLOOR[i] ** 2 for i in range(P)]


def starts(rows: DataFrame, wide: DataFrame) -> DataFrame:
    """Per group three first estimates k around its medians: no correlation, that of tanh, that of directions."""
    z = [((F.col(_x(i)) - F.col(f"m{i}")) / F.col(f"d{i}")).alias(f"z{i}") for i in range(P)]
    scaled = rows.join(wide, "g").select("g", *z)
    norm = F.sqrt(sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(P)), F.lit(0.0)))
    one = {"t": lambda i: F.tanh(f"z{i}"), "u": lambda i: F.when(norm > 0, F.col(f"z{i}") / norm).otherwise(F.lit(0.0))}
    sums = scaled.groupBy("g").agg(*[F.sum(of(i) * of(j)).alias(f"{name}{i}{j}") for name, of in one.items() for i, j in PAIRS])

    def correlation(name: str, i: int, j: int) -> Column:
        if i == j:
            return F.lit(1.0)
        both = F.col(f"{name}{i}{i}") * F.col(f"{name}{j}{j}")
        return F.when(both > 0, F.col(f"{name}{i}{j}") / F.sqrt(both)).otherwise(F.lit(0.0)) if name else F.lit(0.0)

    def shape(k: int, name: str) -> Column:
        cov = [(correlation(name, i, j) * F.col(f"d{i}") * F.col(f"d{j}") + (FLOOR[i] ** 2 if i == j else 0.0)).alias(f"s{i}{j}") for i, j in PAIRS]
        return F.struct(F.lit(k).alias("k"), *cov)

    begun = wide.join(sums, "g").select("g", *MEANS, F.explode(F.array(*[shape(k, name) for k, name in enumerate(("", "t", "u"))])).alias("s"))
    # a start has no determinant to beat: the first step from it always counts
    return factored(begun.select("g", *MEANS, "s.*")).withColumn("logdet", F.lit(1e300)).withColumn("moved", F.lit(True))


def factored(params: DataFrame) -> DataFrame:
    """l<row><column>, the lower triangular factor of each covariance s<row><column>, and logdet."""
    for i, j in PAIRS:
        rest = F.col(f"s{i}{j}") - sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
        params = params.withColumn(f"l{i}{j}", F.sqrt(rest) if i == j else rest / F.col(f"l{j}{j}"))
    logdet = 2 * sum((F.log(f"l{i}{i}") for i in range(1, P)), F.log("l00"))
    return params.select("g", "k", *MEANS, *FACTOR, logdet.alias("logdet"))


def with_distance(rows: DataFrame, params: DataFrame) -> DataFrame:
    """``rows`` once per estimate of their group, with k and d2, the squared Mahalanobis distance."""
    out = rows.join(params.select("g", "k", *MEANS, *FACTOR), "g")
    for i in range(P):
        rest = F.col(_x(i)) - F.col(f"m{i}") - sum((F.col(f"l{i}{k}") * F.col(f"y{k}") for k in range(i)), F.lit(0.0))
        out = out.withColumn(f"y{i}", rest / F.col(f"l{i}{i}"))
    d2 = sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(P)), F.lit(0.0))
    return out.withColumn("d2", d2).select(*rows.columns, "k", "d2")


def concentrate(rows: DataFrame, params: DataFrame, target: list[float]) -> DataFrame:
    """One step: estimates from the nearest three quarters of each group under each of ``params``."""
    near = with_distance(rows, params).withColumn("bin", F.floor(F.log(1 + F.col("d2")) * 200))
    edge = keep(cut_points(near, ["g", "k"], "bin", SHARE), "edges")
    inside = near.join(edge, ["g", "k"]).filter(F.col("bin") <= F.col("cut"))
    n = F.col("n")
    sums = inside.groupBy("g", "k").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(_x(i)).alias(f"m{i}") for i in range(P)],
        *[F.avg(F.col(_x(i)) * F.col(_x(j))).alias(f"e{i}{j}") for i, j in PAIRS],
    )

    def cov(i: int, j: int) -> Column:
        raw = F.col(f"e{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}")
        if i != j:
            return n * CONSISTENT * raw / (n + PRIOR)
        return (n * (CONSISTENT * F.greatest(raw, F.lit(0.0)) + FLOOR[i] ** 2) + PRIOR * target[i]) / (n + PRIOR)

    return factored(sums.select("g", "k", *MEANS, *[cov(i, j).alias(f"s{i}{j}") for i, j in PAIRS]))


def estimates(rows: DataFrame) -> DataFrame:
    """Per group g of ``rows`` (g, x0..x3) the estimate of lowest determinant: k, mean, factor, logdet."""
    wide, target = scales(rows)
    params = keep(starts(rows, wide), "estimates")
    columns = [*MEANS, *FACTOR, "logdet"]
    while not params.filter("moved").isEmpty():
        # an estimate that a step did not lower stays as it is: only the others take a further step
        step = concentrate(rows, params.filter("moved"), target).select("g", "k", F.struct(*columns).alias("new"))
        lower = F.coalesce(F.col("new.logdet") < F.col("logdet") - GAIN, F.lit(False))
        both = params.drop("moved").join(step, ["g", "k"], "left").withColumn("moved", lower)
        after = keep(both.select("g", "k", *[F.when(F.col("moved"), F.col(f"new.{c}")).otherwise(F.col(c)).alias(c) for c in columns], "moved"), "estimates")
        forget(params)
        params = after
    order = F.struct(F.round("logdet", 6), "k")  # starts that met have one determinant up to rounding
    return params.groupBy("g").agg(F.min_by(F.struct("k", *columns), order).alias("best")).select("g", "best.*")


def judge(docs: DataFrame) -> DataFrame:
    """``statistics`` of every document with d2 (null where the base rules reject it) and kept."""
    # every row gets a number of its own, so that the verdicts come back to rows that repeat
    stats = keep(statistics(docs).withColumn("row", F.monotonically_increasing_id()), "statistics")
    group = F.to_json(F.struct("lang", "source")).alias("g")
    rows = keep(vectors(stats).select("row", group, *map(_x, range(P))), "vectors")
    best = keep(estimates(rows.drop("row")), "best")
    far = with_distance(rows, best).select("row", "d2")
    found = stats.join(far, "row", "left")
    return found.withColumn("kept", ~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= CUT)).drop("row")
