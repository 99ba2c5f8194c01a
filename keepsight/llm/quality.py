"""Quality rules: fixed limits, and robust multivariate outliers per language and source.

Each document's statistics become a vector (`VECTOR`). Every group of one language and source
gets a minimum-covariance-determinant estimate: from two starting points (medians with quartile
widths, and the moments of all rows), the half of the group that is nearest by Mahalanobis
distance gives the next mean and covariance, `STEPS` times; the start with the smaller
determinant wins. Documents too far from their group's centre are rejected.

Halves and medians come from counts of fixed bins, so groups are never sorted or gathered: each
step is sums by group, folded on the map side, and a table of one row per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepsight.llm.store import WORD_GAP, stored, words

SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\x0b\x0c\r"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

#: The vector's coordinates and the width that each group's spread has at least.
VECTOR = {
    "x0": ("ln(n_words)", 1.0),
    "x1": ("ln(word_chars / n_words)", 0.1),
    "x2": ("n_symbols / word_chars", 0.0125),
    "x3": ("log1p(n_dup_lines)", 0.5),
    "x4": ("n_repeat_words / n_words", 0.1),
}
X = list(VECTOR)
#: Rows a group needs; smaller groups are pooled by language, and those pools by all.
GROUP_ROWS = 40
STEPS = 3
#: The 0.9999 quantile of chi-square with five degrees of freedom.
FARTHEST = 25.74
#: Consistency factor of the covariance of a normal sample's nearest half, five dimensions.
HALF_FACTOR = 1.92
#: Bins of a coordinate per least width, and of a distance per unit of its logarithm.
BINS = 32


def _steps(first: Column, second: Column, size: Column, f) -> Column:
    """`f` over an array and another, both cut to `size`."""
    size = F.greatest(size, F.lit(0))
    return F.zip_with(F.slice(first, F.lit(1), size), F.slice(second, F.lit(1), size), f)


def _after(array: Column, skipped: int) -> Column:
    return F.slice(array, F.lit(skipped + 1), F.greatest(F.size(array) - skipped, F.lit(0)))


def statistics(docs: DataFrame) -> DataFrame:
    """`n_words`, `word_chars`, `n_symbols`, `n_dup_lines`, `n_repeat_words` in place of `text`.

    Within each text: windows of three words are hashed; if any hash comes twice, hashes sort
    together with their places, neighbours that are equal give the places of repeated windows,
    and the words these cover are added up along the text.
    """
    rest = [c for c in docs.columns if c != "text"]
    text = F.coalesce("text", F.lit(""))
    with_line = F.filter(F.split(text, "\n"), lambda x: F.regexp_replace(x, WORD_GAP, "") != "")
    s = docs.select(
        *rest,
        F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("w"),
        F.length(F.translate(text, SPACE, "")).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        with_line.alias("lines"),
    )
    kept = [*rest, "word_chars", "n_symbols"]
    s = s.select(
        *kept,
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.size("w").cast("bigint").alias("n_words"),
        "w",
        _steps(F.col("w"), _after(F.col("w"), 1), F.size("w") - 1, lambda a, b: F.xxhash64(a, b)).alias("pairs"),
    )
    kept += ["n_dup_lines", "n_words"]
    s = s.select(
        *kept,
        _steps(
            F.col("pairs"), _after(F.col("w"), 2), F.size("w") - 2, lambda a, b: F.xxhash64(a, b)
        ).alias("windows"),
    )
    placed = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    repeated = F.size(F.array_distinct("windows")) < F.size("windows")
    s = s.select(*kept, F.when(repeated, F.sort_array(placed)).alias("sorted"))
    both = _steps(
        F.col("sorted"),
        _after(F.col("sorted"), 1),
        F.size("sorted") - 1,
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])),
    )
    places = F.sort_array(F.array_distinct(F.flatten(F.filter(both, lambda x: x.isNotNull()))))
    s = s.select(*kept, F.when(F.col("sorted").isNotNull(), places).alias("at"))
    covered = _steps(
        F.col("at"), _after(F.col("at"), 1), F.size("at") - 1, lambda a, b: F.least(b - a, F.lit(3))
    )
    total = F.aggregate(covered, F.lit(3), lambda x, y: x + y)
    s = s.select(*kept, F.when(F.col("at").isNotNull(), total).otherwise(0).cast("bigint").alias("n_repeat_words"))
    return s.select(*rest, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _tag(name: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit("-"))


def _grouped(stats: DataFrame) -> DataFrame:
    """The rows that estimates are made of, with `group`: language and source, or a pool."""
    own = F.concat(_tag("lang"), F.lit("\n"), _tag("source"))
    pools = [own, F.concat(_tag("lang"), F.lit("\n*")), F.lit("*")]
    sizes = stats.where("not base_failed").groupBy(own.alias("own"), pools[1].alias("by_lang")).count()
    large = F.col("count") >= GROUP_ROWS
    small = sizes.where(~large).groupBy("by_lang").agg(F.sum("count").alias("pooled"))
    sizes = sizes.join(small, "by_lang", "left")
    chosen = F.when(large, F.col("own")).when(F.col("pooled") >= GROUP_ROWS, F.col("by_lang"))
    named = stored(sizes.select("own", F.coalesce(chosen, pools[2]).alias("group")), "groups")
    return stats.withColumn("own", own).join(named, "own", "left").drop("own")


def _covariances() -> list[tuple[str, str, str]]:
    return [(f"c{i}{j}", X[i], X[j]) for i in range(len(X)) for j in range(i + 1)]


def _moments(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.avg(x).alias(f"m{i}") for i, x in enumerate(X)],
        *[F.covar_pop(a, b).alias(name) for name, a, b in _covariances()],
    )


def _medians(rows: DataFrame) -> DataFrame:
    """One row per group: medians, and variances from the quartiles, from counts of bins."""
    bins = [
        F.struct(F.lit(i).alias("i"), F.floor(F.col(x) / VECTOR[x][1] * BINS).alias("bin"))
        for i, x in enumerate(X)
    ]
    counts = (
        rows.select("group", F.explode(F.array(*bins)).alias("b"))
        .groupBy("group", "b.i", "b.bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    along = Window.partitionBy("group", "i").orderBy("bin")
    total = F.sum("n").over(Window.partitionBy("group", "i"))
    placed = counts.withColumn("upto", F.sum("n").over(along)).withColumn("total", total)
    marks = placed.groupBy("group", "i").agg(
        *[
            F.min(F.when(4 * F.col("upto") >= part * F.col("total"), F.col("bin"))).alias(f"q{part}")
            for part in (1, 2, 3)
        ]
    )

    def of(i: int, value: Column) -> Column:
        return F.max(F.when(F.col("i") == i, value))

    out = []
    for i, x in enumerate(X):
        width = VECTOR[x][1] / BINS
        out.append(of(i, (F.col("q2") + 0.5) * width).alias(f"m{i}"))
        spread = (F.col("q3") - F.col("q1")) * (width / 1.349)
        out.append(of(i, spread * spread).alias(f"c{i}{i}"))
    zero = [F.lit(0.0).alias(name) for name, a, b in _covariances() if a != b]
    return marks.groupBy("group").agg(*out).select("*", *zero)


def _factored(estimates: DataFrame, factor: float) -> DataFrame:
    """Cholesky factor (`l..`) and log determinant of each estimate's widened covariance."""
    out = estimates
    for i in range(len(X)):
        for j in range(i + 1):
            value = F.col(f"c{i}{j}") * factor
            for k in range(j):
                value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            if i == j:
                least = VECTOR[X[i]][1] ** 2
                value = F.sqrt(F.greatest(value, F.lit(0.0)) + least)
            else:
                value = value / F.col(f"l{j}{j}")
            out = out.withColumn(f"l{i}{j}", value)
    determinant = sum(F.log(F.col(f"l{i}{i}")) for i in range(len(X)))
    return out.withColumn("log_determinant", determinant)


def _with_distance(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """The rows with `distance`, their squared Mahalanobis distance, by group (and start)."""
    factor = [f"l{i}{j}" for i in range(len(X)) for j in range(i + 1)]
    keys = [c for c in ("group", "start") if c in estimates.columns]
    means = [f"m{i}" for i in range(len(X))]
    out = rows.join(estimates.select(*keys, *means, *factor), "group", "left")
    for i, x in enumerate(X):
        value = F.col(x) - F.col(f"m{i}")
        for j in range(i):
            value = value - F.col(f"l{i}{j}") * F.col(f"y{j}")
        out = out.withColumn(f"y{i}", value / F.col(f"l{i}{i}"))
    distance = sum(F.col(f"y{i}") * F.col(f"y{i}") for i in range(len(X)))
    return out.withColumn("distance", distance).drop(*means, *factor, *[f"y{i}" for i in range(len(X))])


def _concentrated(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Moments of the half of each group that is nearest by the estimates."""
    placed = _with_distance(rows, estimates).withColumn(
        "bin", F.floor(F.log(F.col("distance") + 1e-9) * BINS)
    )
    counts = placed.groupBy("group", "start", "bin").agg(F.count(F.lit(1)).alias("n"))
    of = Window.partitionBy("group", "start")
    upto = counts.withColumn("upto", F.sum("n").over(of.orderBy("bin"))).withColumn(
        "total", F.sum("n").over(of)
    )
    half = 2 * F.col("upto") >= F.col("total") + len(X) + 1
    cut = upto.groupBy("group", "start").agg(
        F.coalesce(F.min(F.when(half, F.col("bin"))), F.max("bin")).alias("cut")
    )
    near = placed.join(stored(cut, "cuts"), ["group", "start"]).where("bin <= cut")
    return _moments(near, "group", "start")


def estimate(rows: DataFrame) -> DataFrame:
    """One row per group of `rows` (`group` and the vector): centre and Cholesky factor."""
    rows = rows.select("group", *X)
    names = ["group", *[f"m{i}" for i in range(len(X))], *[name for name, _, _ in _covariances()]]
    first = _medians(rows).select(*names, F.lit(0).alias("start"))
    second = _moments(rows, "group").select(*names, F.lit(1).alias("start"))
    estimates = stored(_factored(first.union(second), 1.0), "estimates")
    for _ in range(STEPS):
        moments = _concentrated(rows, estimates).select(*names, "start")
        estimates = stored(_factored(moments, HALF_FACTOR), "estimates")
    least = F.struct("log_determinant", "start")
    best = estimates.groupBy("group").agg(F.min(least).alias("least"))
    chosen = estimates.join(best, "group").where(F.col("start") == F.col("least.start"))
    return stored(chosen.drop("start", "least", "log_determinant"), "estimates")


def judge_quality(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    source_column: str = "source",
    farthest: float = FARTHEST,
) -> DataFrame:
    """Statistics and verdict of every whole text.

    Returns per row `doc_id`, `n_words`, `word_chars`, `n_symbols`, `n_dup_lines`,
    `n_repeat_words`, `base_failed` (too few words, or too many in repeated windows), `kept`
    (neither base_failed nor an outlier) and `distance` (squared, robust, from the group's
    centre).

    A text NULL or empty has no words and fails the base rules. Estimates are made of rows that
    pass them; a language or source that is NULL is a group like any other; groups and pools of
    fewer than `GROUP_ROWS` rows have no estimate, so their rows are kept (distance NULL). Tied,
    repeated rows and ids NULL are judged one by one. An empty table gives no rows; other
    columns are not read.
    """
    named = docs.select(
        F.col(id_column).alias("doc_id"),
        F.col(lang_column).alias("lang"),
        F.col(source_column).alias("source"),
        F.col(text_column).alias("text"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    stats = stored(statistics(named).withColumn("base_failed", failed), "statistics")
    vector = [
        F.when(F.col("n_words") > 0, F.expr(value)).alias(x)
        for x, (value, _) in VECTOR.items()
    ]
    rows = stored(_grouped(stats).select("*", *vector), "vectors")
    passed = rows.where("not base_failed")
    sizes = passed.groupBy("group").count().where(F.col("count") >= GROUP_ROWS).select("group")
    centres = estimate(passed.join(stored(sizes, "groups"), "group", "left_semi"))
    judged = _with_distance(rows, centres)
    near = F.coalesce(F.col("distance") <= farthest, F.lit(True))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & near).alias("kept"),
        "distance",
    )
