"""Quality rules: plain counts of a text, and robust multivariate outliers per language and source.

DataFrame operations only. The minimum covariance determinant is found by concentration steps that run as aggregations
over all documents; no group is brought together in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skytally.llm.common import stored

NO_WORD = r"[\x20\x09-\x0D]+"
A_WORD = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

# The vector and, for each part, the least standard deviation that counts as usual prose: the estimate is regularised with
# it, so a source of near-copies does not make all other documents outliers.
FLOORS = {"x0": 1.0, "x1": 0.08, "x2": 0.7, "x3": 0.7, "x4": 0.5}
PARTS = list(FLOORS)
INSIDE = 0.75  # share of a group that the determinant is minimised over
STEPS = 3  # concentration steps
LEAST_GROUP = 50  # smaller groups are judged with their language, smaller languages not at all
GRID = 64  # cells per unit in which quantiles are found
MEDIAN_CHI2 = 4.3515  # of five degrees of freedom
CUTOFF = 30.86  # chi-square of five degrees of freedom, upper 1e-5


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns but the text, and the counts. Null text has no words and no lines."""
    kept = [c for c in docs.columns if c != text]
    raw = F.coalesce(F.col(text), F.lit(""))
    df = docs.select(*kept, raw.alias("__t"))
    df = df.withColumn("__w", F.array_remove(F.split("__t", NO_WORD), ""))
    lines = F.filter(F.split("__t", "\n"), lambda x: x.rlike(A_WORD))
    df = df.withColumn("__l", lines)
    word = lambda i: F.get("__w", i)
    windows = F.transform("__w", lambda w, i: F.xxhash64(w, word(i + 1), word(i + 2)))
    df = df.select(
        *kept,
        F.size("__w").cast("long").alias("n_words"),
        F.length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        F.regexp_count("__t", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.slice(windows, F.lit(1), F.greatest(F.size("__w") - 2, F.lit(0))).alias("__h"),
    )
    # Most texts repeat no window: only the others are sorted.
    pairs = F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    repeats = F.size(F.array_distinct("__h")) < F.size("__h")
    df = df.withColumn("__s", F.when(repeats, F.array_sort(pairs)))
    same = lambda e, k: F.get("__s", k)["h"] == e["h"]
    twice = F.filter("__s", lambda e, k: F.coalesce(same(e, k + 1), F.lit(False)) | F.coalesce((k > 0) & same(e, k - 1), F.lit(False)))
    df = df.withColumn("__p", F.sort_array(F.transform(twice, lambda e: e["i"])))
    covered = F.transform("__p", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("__p", k + 1) - p, F.lit(3))))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    return df.select(*kept, *COUNTS[:-1], F.coalesce(total, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def vector() -> dict[str, Column]:
    """Length, word length, symbols, repeated words and repeated lines, on scales on which usual prose is about normal."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "x0": F.log(words),
        "x1": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words),
        "x2": F.log1p(100 * F.col("n_symbols") / words),
        "x3": F.log1p(100 * F.col("n_repeat_words") / words),
        "x4": F.log1p(F.col("n_dup_lines").cast("double")),
    }


def grid_quantile(rows: DataFrame, keys: list[str], value: str, share: float) -> DataFrame:
    """keys, q: the upper edge of the grid cell in which the share of the rows of a key is reached.

    Rows are counted by cell first, so the window sees one row per cell."""
    cells = rows.groupBy(*keys, F.floor(F.col(value) * GRID).alias("cell")).agg(F.count("*").alias("n"))
    whole = Window.partitionBy(*keys)
    so_far = whole.orderBy("cell")
    summed = cells.select(*keys, "cell", F.sum("n").over(so_far).alias("upto"), F.sum("n").over(whole).alias("all"))
    reached = summed.filter(F.col("upto") >= share * F.col("all"))
    return reached.groupBy(*keys).agg(((F.min("cell") + 1) / GRID).alias("q"))


def _start(rows: DataFrame) -> DataFrame:
    """Medians and median absolute deviations of each part, per group."""
    long = rows.select("gid", F.posexplode(F.array(*PARTS)).alias("part", "x"))
    median = grid_quantile(long, ["gid", "part"], "x", 0.5).withColumnRenamed("q", "m")
    apart = long.join(median, ["gid", "part"]).withColumn("d", F.abs(F.col("x") - F.col("m")))
    spread = grid_quantile(apart, ["gid", "part"], "d", 0.5).withColumnRenamed("q", "s")
    both = median.join(spread, ["gid", "part"])
    picks = [
        F.max(F.when(F.col("part") == k, F.col(c))).alias(f"{c}{k}") for k in range(len(PARTS)) for c in ("m", "s")
    ]
    return both.groupBy("gid").agg(*picks)


def _moments(inside: DataFrame) -> DataFrame:
    """Centre and Cholesky factor of the regularised covariance, per group."""
    sums = [F.avg(p).alias(f"m{k}") for k, p in enumerate(PARTS)]
    sums += [F.covar_pop(PARTS[i], PARTS[j]).alias(f"c{i}{j}") for i in range(len(PARTS)) for j in range(i + 1)]
    df = inside.groupBy("gid").agg(*sums)
    for i, part in enumerate(PARTS):
        for j in range(i + 1):
            value = F.col(f"c{i}{j}") + F.lit(FLOORS[part] ** 2 if i == j else 0.0)
            for k in range(j):
                value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            df = df.withColumn(f"l{i}{j}", F.sqrt(value) if i == j else value / F.col(f"l{j}{j}"))
    return df


def _distance(rows: DataFrame, model: DataFrame) -> DataFrame:
    """The columns of ``rows`` with d2, the squared Mahalanobis distance by the group's model."""
    df = rows.join(model, "gid")
    for i, part in enumerate(PARTS):
        value = F.col(part) - F.col(f"m{i}")
        for k in range(i):
            value = value - F.col(f"l{i}{k}") * F.col(f"z{k}")
        df = df.withColumn(f"z{i}", value / F.col(f"l{i}{i}"))
    squares = [F.col(f"z{i}") * F.col(f"z{i}") for i in range(len(PARTS))]
    return df.select(*rows.columns, sum(squares[1:], squares[0]).alias("d2"))


def _inside(scored: DataFrame) -> DataFrame:
    q = grid_quantile(scored, ["gid"], "d2", INSIDE)
    return scored.join(q, "gid").filter("d2 < q")


def estimates(rows: DataFrame) -> DataFrame:
    """gid, centre, Cholesky factor and scale: the minimum covariance determinant of each group.

    From medians and deviations, each step keeps the share ``INSIDE`` of rows nearest to the centre and takes mean and covariance
    of them, which never raises the determinant. The scale brings the median distance
    down to where it belongs; it never widens distances, which the floors have shortened.
    """
    rows = stored(rows.select("gid", *PARTS).distinct(), "vectors")  # copies of a text count once
    start = _start(rows)
    apart = [((F.col(p) - F.col(f"m{k}")) / (1.4826 * F.col(f"s{k}") + FLOORS[p])) for k, p in enumerate(PARTS)]
    first = rows.join(start, "gid").select("gid", *PARTS, sum((a * a for a in apart[1:]), apart[0] * apart[0]).alias("d2"))
    model = stored(_moments(_inside(first)), "step")
    for _ in range(STEPS - 1):
        model = stored(_moments(_inside(_distance(rows, model))), "step")
    middle = grid_quantile(_distance(rows, model), ["gid"], "d2", 0.5)
    return stored(model.join(middle.select("gid", F.greatest(F.col("q") / MEDIAN_CHI2, F.lit(1.0)).alias("scale")), "gid"), "estimates")


def quality(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """key, the counts, base_failed, kept and the squared robust distance d2 (null where no estimate applies).

    A document is rejected when the base rule fails or d2 exceeds ``CUTOFF``. Estimates come from the documents that pass the base
    rule, equal vectors counted once, per language and source; groups of fewer than ``LEAST_GROUP`` are judged by their
    language over all such groups, and if that is too small as well, by the base rule alone. Null language or
    source is a value like any other. Null or blank text has no words and fails. Repeated rows are
    judged alike; other columns are not read.
    """
    base = docs.select(F.col(key).alias("key"), F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).alias("text"))
    base = stored(with_counts(base).withColumn("base_failed", base_failed()), "counts")
    passed = base.filter(~F.col("base_failed")).withColumns(vector())
    sizes = passed.groupBy("lang", "source").agg(F.count("*").alias("n"))
    own = F.xxhash64("lang", "source", F.lit(1))
    pooled = F.xxhash64("lang", F.lit(0))
    groups = sizes.select("lang", "source", "n", F.when(F.col("n") >= LEAST_GROUP, own).otherwise(pooled).alias("gid"))
    large = groups.groupBy("gid").agg(F.sum("n").alias("total")).filter(F.col("total") >= LEAST_GROUP)
    groups = stored(groups.join(large, "gid", "left_semi").select(F.xxhash64("lang", "source").alias("pair"), "gid"), "groups")
    grouped = passed.withColumn("pair", F.xxhash64("lang", "source")).join(groups, "pair")
    model = estimates(grouped)
    judged = base.withColumns(vector()).withColumn("pair", F.xxhash64("lang", "source")).join(groups, "pair", "left")
    columns = [c for c in judged.columns if c != "gid"]
    known = _distance(judged.filter(F.col("gid").isNotNull()), model.drop("scale")).join(model.select("gid", "scale"), "gid")
    known = known.select(*columns, (F.col("d2") / F.col("scale")).alias("d2"))
    rest = judged.filter(F.col("gid").isNull()).select(*columns, F.lit(None).cast("double").alias("d2"))
    verdict = ~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= CUTOFF)
    return known.unionByName(rest).select(F.col("key").alias(key), *COUNTS, "base_failed", verdict.alias("kept"), "d2")
