"""Secrets in texts: candidates by form, false positives removed by a random forest.

DataFrame and ML-pipeline operations only; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.llm.common import row_key, stored

RUN = r"[A-Za-z0-9+/_\-]{16,}"
CANDIDATE = r"(?=[A-Za-z0-9+/_\-]*[0-9])" + RUN
NO_WORD = r"[\x20\x09-\x0D]+"
KEYWORD = r"(?i)(token|secret|passw|pwd|api[_-]?key|access[_-]?key|private[_-]?key|credential|bearer|auth)"
SAMPLE_PATH = r"(?i)(test|example|sample|mock|fixture|doc)"

# Formats that leave no doubt, as labels for training where no labelled findings are given.
SURE = (
    r"^(AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^(sk|rk)_(live|test)_[A-Za-z0-9]{16,}$"
    r"|^xox[abprs]-[A-Za-z0-9-]{10,}$|^glpat-[A-Za-z0-9_-]{20}$"
)
NEVER = r"^[0-9+/_-]+$|^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"

FEATURES = [
    "n_chars", "digits", "uppers", "lowers", "hexes", "distinct_chars", "changes", "longest_letters",
    "dictionary", "slashes", "in_url", "sample_path", "keyword_near", "keyword_before", "assigned", "quoted", "known_before", "known_after",
]
LEAST_TEXTS = 5  # a word of the dictionary is in so many texts
LABELLED = 20_000  # most labelled findings the forest is fitted on
TREES, DEPTH, SEED = 24, 6, 7
THRESHOLD = 0.5


def candidates(docs: DataFrame, key: str, text: str, path: str) -> DataFrame:
    """One row per run of 16 characters or more with a digit: key, path, word_index, run_index, run, the word's part before it,
    the word and its neighbours."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(path), F.lit("")).alias("path"), F.col(text).alias("text"))
    rows = rows.filter(F.col("text").rlike(CANDIDATE)).withColumn("rid", row_key("key", "text"))
    rows = rows.withColumn("w", F.split("text", NO_WORD))
    at = lambda i: F.coalesce(F.get("w", i), F.lit(""))
    near = F.transform(
        "w",
        lambda x, i: F.when(
            (F.length(x) >= 16) & x.rlike(CANDIDATE),
            F.struct(i.alias("word_index"), x.alias("word"), at(i - 2).alias("two_before"), at(i - 1).alias("before"), at(i + 1).alias("after")),
        ),
    )
    found = rows.select("key", "path", "rid", F.explode(F.array_compact(near)).alias("c")).select("key", "path", "rid", "c.*")
    runs = F.regexp_extract_all("word", F.lit(CANDIDATE), F.lit(0))
    found = found.select("*", F.posexplode(runs).alias("run_index", "run"))
    return found.withColumn("head", F.expr("substring_index(word, run, 1)"))


def dictionary(docs: DataFrame, text: str) -> DataFrame:
    """Words of 3 to 20 letters that are in ``LEAST_TEXTS`` texts or more, over all texts; counted per split first."""
    words = F.array_distinct(F.split(F.lower(text), r"[^\p{L}]+"))
    each = docs.select(F.explode(words).alias("part")).filter(F.length("part").between(3, 20))
    return each.groupBy("part").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_TEXTS).select("part")


def _share(pattern: str) -> Column:
    return F.regexp_count("run", F.lit(pattern)) / F.length("run")


def with_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """The candidates with the columns ``FEATURES``."""
    found = found.withColumn("cid", F.xxhash64("rid", "word_index", "run_index", "run"))
    clean = lambda c: F.regexp_replace(F.lower(c), r"[^\p{L}]+", "")
    parts = F.array_distinct(F.regexp_extract_all(F.lower("run"), F.lit(r"[a-z]{3,}"), F.lit(0)))
    asked = F.concat(
        F.transform(parts, lambda p: F.struct(F.lit("inside").alias("role"), p.alias("part"))),
        F.array(*[F.struct(F.lit(c).alias("role"), clean(c).alias("part")) for c in ("before", "after")]),
    )
    each = found.select("cid", F.explode(asked).alias("a")).select("cid", "a.role", "a.part").filter("part != ''").distinct()
    known = each.join(words, "part").groupBy("cid").agg(
        F.sum(F.when(F.col("role") == "inside", F.length("part"))).alias("covered"),
        F.max((F.col("role") == "before").cast("double")).alias("known_before"),
        F.max((F.col("role") == "after").cast("double")).alias("known_after"),
    )
    size = F.length("run").cast("double")
    change = r"(?<=[a-z])(?=[A-Z0-9])|(?<=[A-Z])(?=[a-z0-9])|(?<=[0-9])(?=[A-Za-z])"
    letters = F.transform(F.regexp_extract_all("run", F.lit("[A-Za-z]+"), F.lit(0)), F.length)
    around = F.concat_ws(" ", "two_before", "before", "head")
    flag = lambda c: c.cast("double")
    return found.join(known, "cid", "left").select(
        *[c for c in found.columns if c != "cid"],
        size.alias("n_chars"),
        _share("[0-9]").alias("digits"),
        _share("[A-Z]").alias("uppers"),
        _share("[a-z]").alias("lowers"),
        _share("[0-9a-f]").alias("hexes"),
        (F.size(F.array_distinct(F.split("run", ""))) / size).alias("distinct_chars"),
        ((F.length(F.regexp_replace("run", change, " ")) - size) / size).alias("changes"),
        (F.coalesce(F.array_max(letters), F.lit(0)) / size).alias("longest_letters"),
        F.least(F.lit(1.0), F.coalesce("covered", F.lit(0)) / size).alias("dictionary"),
        flag(F.regexp_count("word", F.lit("/"))).alias("slashes"),
        flag(F.col("word").rlike(r"://|www\.")).alias("in_url"),
        flag(F.col("path").rlike(SAMPLE_PATH)).alias("sample_path"),
        flag(around.rlike(KEYWORD)).alias("keyword_near"),
        flag(F.col("head").rlike(KEYWORD)).alias("keyword_before"),
        flag(F.concat("before", "head").rlike(r"[=:]\s*[\"']?$")).alias("assigned"),
        flag(F.col("head").rlike(r"[\"']$")).alias("quoted"),
        F.coalesce("known_before", F.lit(0.0)).alias("known_before"),
        F.coalesce("known_after", F.lit(0.0)).alias("known_after"),
    )


def label_by_rule() -> Column:
    """1 for formats and assignments that leave no doubt, 0 for numbers, identifiers and words, null for the rest."""
    assigned = (F.col("keyword_near") > 0) & (F.col("assigned") > 0) & (F.col("digits") < 1)
    plain = F.col("run").rlike(NEVER) | (F.col("dictionary") > 0.6) | (F.col("in_url") > 0)
    return F.when(F.col("run").rlike(SURE), 1.0).when(plain, 0.0).when(assigned, 1.0)


def fit(labelled: DataFrame) -> RandomForestClassificationModel | None:
    """A forest from findings with ``FEATURES`` and label (0 or 1); of more than ``LABELLED`` those of least hash. None without both labels."""
    known = labelled.filter(F.col("label").isNotNull()).select(*FEATURES, "label").distinct()
    drawn = known.withColumn("drawn", F.xxhash64(*FEATURES)).orderBy("drawn", "label").limit(LABELLED)
    drawn = stored(drawn.coalesce(1), "labelled")  # the order of rows decides what each tree sees
    if drawn.select("label").distinct().count() < 2:
        return None
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(drawn.coalesce(1).sortWithinPartitions("drawn", "label"))
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    return forest.fit(vectors)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = "source", labelled: DataFrame | None = None) -> DataFrame:
    """One row per candidate: key, word_index, run_index, run, probability and is_secret.

    A candidate is a run of 16 or more of A-Z a-z 0-9 + / _ - with a digit among them, in any text as a whole. The forest looks at its
    length, character classes and their changes, the share that dictionary words of the texts cover, the path, and the neighbouring
    words. ``labelled`` findings (columns ``FEATURES`` and label) train it; without them ``label_by_rule`` labels the sure ones among the
    candidates. If they are all of one kind there is no forest: the rule decides, and what it leaves open is no secret.
    Null text has no candidate, null path is empty, a null key stays null, repeated rows give repeated findings, and other columns are not read.
    """
    found = stored(candidates(docs, key, text, path), "candidates")
    parts = dictionary(docs.select(text), text)
    scored = stored(with_features(found, parts).withColumn("label", label_by_rule()), "features")
    forest = fit(scored if labelled is None else labelled)
    if forest is None:
        probability = F.coalesce("label", F.lit(0.0))
    else:
        vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(scored)
        scored = forest.transform(vectors)
        probability = F.round(vector_to_array("probability")[1], 9)
    scored = scored.withColumn("chance", probability)
    return scored.select(
        F.col("key").alias(key), F.col("word_index").cast("long").alias("word_index"), F.col("run_index").cast("long").alias("run_index"), "run",
        F.col("chance").alias("probability"), (F.col("chance") >= THRESHOLD).alias("is_secret"), "rid",
    )


MASK = "[SECRET]"


def mask(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """``docs`` with each secret replaced by ``MASK``; rows and other columns stay."""
    secret = scan(docs, key, text, path).filter("is_secret").groupBy("rid").agg(F.collect_set("run").alias("__runs"))
    # Longer runs first: one may be part of another.
    ordered = F.reverse(F.array_sort(F.transform("__runs", lambda r: F.struct(F.length(r).alias("n"), r.alias("r")))))
    secret = stored(secret.select("rid", ordered.alias("__runs")), "secrets")
    joined = docs.withColumn("__rid", row_key(key, text)).join(secret.withColumnRenamed("rid", "__rid"), "__rid", "left")
    masked = F.when(F.col("__runs").isNull(), F.col(text)).otherwise(
        F.aggregate("__runs", F.col(text), lambda t, r: F.replace(t, r["r"], F.lit(MASK)))
    )
    return joined.select(*[masked.alias(c) if c == text else F.col(c) for c in docs.columns])
