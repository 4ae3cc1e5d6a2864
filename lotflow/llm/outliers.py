"""Quality rules with robust multivariate outliers, in DataFrame functions alone.

For each text four counts are taken (see ``text_counts``). Fixed base rules fail texts that are too
short or repeat themselves. The others are judged by a vector of four transformed statistics: per
language and source the minimum-covariance-determinant estimate of centre and scatter is found by
concentration steps (start at quartiles, keep the half of the rows that is nearest, take its mean and
covariance, again until the means settle). Of the starts the one with the least determinant counts. It is
stretched, then taken anew from all rows near it, and a text is rejected whose Mahalanobis distance is
too large. Junk that is less than half of a group does not pull the estimate to it.

A group's estimate leans on its language's, and that on the estimate of all rows, with the weight of
``LEAN`` rows, so small groups need no rule of their own. A null text has no words; null and empty
languages or sources are one group. Each row gives one row; repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotflow.llm.texts import checkpointed

MIN_WORDS, MAX_REPEATED_PCT = 50, 50
#: Share of a group that the concentration keeps, most steps, and rows' worth of the wider group's estimate.
KEPT_SHARE, STEPS, LEAN = 0.5, 20, 100
#: Rows of a partition during the concentration, of vectors and of groups' estimates; a row takes some 100 or 400 bytes.
#: Up to GROUPS_TOGETHER estimates, which are counted first, are sent to all executors (20 MB), so that no step moves the rows.
ROWS_TOGETHER, GROUPS_TOGETHER = 1_000_000, 50_000
#: Quantiles at which the concentration starts, and the move of a mean, in least deviations, below which it has settled.
STARTS, SETTLED = (0.5, 0.25, 0.75), 0.01
#: 0.999 quantile of chi-squared with four degrees of freedom, its median, and the 0.975 quantile up to which rows are taken anew.
CUTOFF, CHI2_MEDIAN, NEAR = 18.467, 3.357, 11.143
#: Least standard deviations: differences below them are no news in any group.
FLOORS = (0.08, 0.06, 0.25, 0.20)
_SPACE = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
DIMS = range(4)
_GROUP, _KEYS = ["g_lang", "g_source"], ["g_lang", "g_source", "g_start"]


def text_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines; the text goes."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    bare = F.btrim(text, F.lit(_SPACE))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))
    others = [name for name in docs.columns if name != text_col]
    rows = docs.select(*others, text.alias("__text"), words.alias("__words"))

    n = F.size("__words")
    shifted = lambda by: F.slice("__words", by, F.greatest(n - 2, F.lit(0)))
    windows = F.transform(F.arrays_zip(shifted(1).alias("a"), shifted(2).alias("b"), shifted(3).alias("c")), lambda w: F.xxhash64(w["a"], w["b"], w["c"]))
    left = F.col("__text")
    for symbol in _SYMBOLS:
        left = F.replace(left, F.lit(symbol), F.lit(""))
    lines = F.filter(F.split("__text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select(
        *others,
        n.cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        (F.length("__text") - F.length(left)).cast("long").alias("n_symbols"),
        lines.alias("__lines"),
        F.when(n >= 3, windows).otherwise(F.array().cast("array<bigint>")).alias("__windows"),
    )

    # only texts that have a window twice are sorted: equal windows then stand side by side
    placed = F.array_sort(F.transform("__windows", lambda w, k: F.struct(w.alias("w"), k.alias("k"))))
    rows = rows.select("*", F.when(F.size(F.array_distinct("__windows")) < F.size("__windows"), placed).alias("__sorted"))
    size = F.size("__sorted")
    neighbours = F.arrays_zip(
        F.col("__sorted").alias("here"),
        F.concat(F.array(F.lit(None).cast("bigint")), F.transform(F.slice("__sorted", 1, size - 1), lambda s: s["w"])).alias("before"),
        F.transform(F.slice("__sorted", 2, size), lambda s: s["w"]).alias("after"),
    )
    again = F.filter(neighbours, lambda s: (s["here"]["w"].eqNullSafe(s["before"])) | (s["here"]["w"].eqNullSafe(s["after"])))
    rows = rows.withColumn("__places", F.when(size > 0, F.sort_array(F.transform(again, lambda s: s["here"]["k"]))))
    # windows of three words that begin at sorted places: each brings three words or as many as lie before the next
    steps = F.zip_with("__places", F.slice("__places", 2, F.size("__places")), lambda p, q: F.least(F.lit(3), F.coalesce(q - p, F.lit(3))))
    covered = F.aggregate(steps, F.lit(0), lambda total, step: total + step)
    return rows.select(
        *others, "n_words", "word_chars", "n_symbols",
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("__places") > 0, covered).otherwise(0).cast("long").alias("n_repeat_words"),
        F.size("__lines").cast("long").alias("n_lines"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PCT * F.col("n_words"))


def _vector() -> list[Column]:
    """Logarithm of the mean word length; square roots of the shares of symbols, repeated lines and repeated words."""
    share = lambda part, whole: F.sqrt(F.col(part) / F.greatest(F.col(whole), F.lit(1)))
    length = F.log((F.col("word_chars") + 1) / (F.col("n_words") + 1))
    return [length, share("n_symbols", "word_chars"), share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words")]


def _pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in DIMS for j in DIMS if j <= i]


def _moments(rows: DataFrame, *keys: str) -> DataFrame:
    """Number, sums and sums of products per group: all add up, so groups of groups come from them."""
    sums = [F.sum(f"x{i}").alias(f"s{i}") for i in DIMS]
    products = [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}{j}") for i, j in _pairs()]
    return rows.groupBy(*keys).agg(F.count("*").cast("double").alias("n"), *sums, *products)


def _added(moments: DataFrame, *keys: str) -> DataFrame:
    names = ["n", *[f"s{i}" for i in DIMS], *[f"p{i}{j}" for i, j in _pairs()]]
    return moments.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in names])


def _leaning(moments: DataFrame) -> DataFrame:
    """Centre ``m`` and scatter ``c`` per group and start, each leaning on the wider group's."""
    every: dict[str, Column] = {}
    for total in _added(moments, "g_start").collect():  # a row of sums for each start
        n = total["n"] or 1.0
        mean = {i: (total[f"s{i}"] or 0.0) / n for i in DIMS}
        values = {f"em{i}": mean[i] for i in DIMS} | {f"ec{i}{j}": (total[f"p{i}{j}"] or 0.0) / n - mean[i] * mean[j] for i, j in _pairs()}
        here = F.col("g_start") == total["g_start"]
        every = {name: every[name].when(here, value) if every else F.when(here, F.lit(value)) for name, value in values.items()}
    every = every or {name: F.lit(0.0) for name in [f"em{i}" for i in DIMS] + [f"ec{i}{j}" for i, j in _pairs()]}

    def lean(rows: DataFrame, wide: str, out: str) -> DataFrame:
        weight = F.col("n") + LEAN
        centre = [((F.col(f"s{i}") + LEAN * F.col(f"{wide}m{i}")) / weight).alias(f"{out}m{i}") for i in DIMS]
        scatter = []
        for i, j in _pairs():
            # second moments about the leaning centre, of the group and of the wider estimate
            own = F.col(f"p{i}{j}") + LEAN * (F.col(f"{wide}c{i}{j}") + F.col(f"{wide}m{i}") * F.col(f"{wide}m{j}"))
            product = (F.col(f"s{i}") + LEAN * F.col(f"{wide}m{i}")) * (F.col(f"s{j}") + LEAN * F.col(f"{wide}m{j}"))
            scatter.append((own / weight - product / weight / weight).alias(f"{out}c{i}{j}"))
        return rows.select("*", *centre, *scatter)

    by_lang = lean(_added(moments, "g_lang", "g_start").withColumns(every), "e", "l")
    wide = [f"lm{i}" for i in DIMS] + [f"lc{i}{j}" for i, j in _pairs()]
    groups = lean(moments.join(by_lang.select("g_lang", "g_start", *wide), ["g_lang", "g_start"]), "l", "")
    return groups.select(*_KEYS, *[f"m{i}" for i in DIMS], *[f"c{i}{j}" for i, j in _pairs()])


def _factored(groups: DataFrame, scale: Column | float = 1.0) -> DataFrame:
    """Centres and the Cholesky factor of the scatter, whose diagonal never falls below the floors."""
    factor = F.lit(scale) if isinstance(scale, float) else scale
    rows = groups.withColumns({f"a{i}{j}": F.col(f"c{i}{j}") * factor + (F.lit(FLOORS[i] ** 2) if i == j else F.lit(0.0)) for i, j in _pairs()})
    for j in DIMS:
        inner = lambda i: sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))  # noqa: E731, B023
        rows = rows.withColumn(f"l{j}{j}", F.sqrt(F.greatest(F.col(f"a{j}{j}") - inner(j), F.lit(FLOORS[j] ** 2 / 16))))
        rows = rows.withColumns({f"l{i}{j}": (F.col(f"a{i}{j}") - inner(i)) / F.col(f"l{j}{j}") for i in DIMS if i > j}) if j < 3 else rows
    keys = [key for key in _KEYS if key in groups.columns]
    return rows.select(*keys, *[f"m{i}" for i in DIMS], *[f"l{i}{j}" for i, j in _pairs()])


def _with_distance(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows with the squared Mahalanobis distance from their group's centre, once for each start."""
    solved: list[Column] = []
    for i in DIMS:
        rest = F.col(f"x{i}") - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * solved[k]
        solved.append(rest / F.col(f"l{i}{i}"))
    distance = sum((part * part for part in solved[1:]), solved[0] * solved[0])
    starts = [key for key in ("g_start",) if key in groups.columns]
    return rows.join(groups, _GROUP).select(*rows.columns, *starts, distance.alias("distance"))


def _start(rows: DataFrame, beside: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Quartiles as centres, one start each, and squared scaled deviations from the medians as a diagonal scatter."""
    centres = rows.groupBy(*_GROUP).agg(*[F.percentile_approx(f"x{i}", list(STARTS)).alias(f"q{i}") for i in DIMS])
    off = rows.join(beside(centres), _GROUP).groupBy(*_GROUP).agg(
        *[F.percentile_approx(F.abs(F.col(f"x{i}") - F.col(f"q{i}")[0]), 0.5).alias(f"d{i}") for i in DIMS]
    )
    scatter = [(F.pow(F.col(f"d{i}") * 1.4826, 2) if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in _pairs()]
    started = centres.join(off, _GROUP).withColumn("g_start", F.explode(F.array(*map(F.lit, range(len(STARTS))))))
    return started.select(*_KEYS, *[F.col(f"q{i}")[F.col("g_start")].alias(f"m{i}") for i in DIMS], *scatter)


def _moved(before: DataFrame, after: DataFrame) -> float:
    """The farthest that a group's mean went between two steps, in least standard deviations."""
    old, new = (moments.select(*_KEYS, *[(F.col(f"s{i}") / F.col("n")).alias(f"{name}{i}") for i in DIMS]) for name, moments in (("o", before), ("w", after)))
    far = F.greatest(*[F.abs(F.col(f"o{i}") - F.col(f"w{i}")) / FLOORS[i] for i in DIMS])
    return old.join(new, _KEYS).agg(F.max(far).alias("far")).head()["far"] or 0.0


def _together(groups: DataFrame, parts: int) -> DataFrame:
    """A table of groups kept in a few files; else each of its uses would write a file for each shuffle partition.

    The second step moves nothing: it tells Spark that a single part needs no further shuffle.
    """
    return checkpointed(groups.repartition(parts)).coalesce(parts)


def _stretched(estimate: DataFrame, near: DataFrame, parts: int) -> DataFrame:
    """Centres and factors with the scatter stretched until the median distance of the rows is that of chi-squared, if it is below."""
    middle = near.groupBy(*_GROUP).agg(F.percentile_approx("distance", 0.5).alias("middle"))
    return _together(_factored(estimate.join(middle, _GROUP), F.greatest(F.col("middle") / CHI2_MEDIAN, F.lit(1.0))), parts)


def robust_estimates(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """Centre and scatter's factor per language and source of rows with g_lang, g_source and x0 to x3."""
    estimates = rows.select(*_GROUP).distinct().count() * len(STARTS)
    parts = estimates // GROUPS_TOGETHER + 1
    beside = F.broadcast if estimates <= GROUPS_TOGETHER else lambda groups: groups
    groups, before = _together(_factored(_start(rows, beside)), parts), None
    for _ in range(steps):
        near = _with_distance(rows, beside(groups))
        bounds = near.groupBy(*_KEYS).agg(F.percentile_approx("distance", KEPT_SHARE).alias("bound"))
        moments = _together(_moments(near.join(beside(bounds), _KEYS).where("distance <= bound"), *_KEYS), parts)
        estimate = _together(_leaning(moments), parts)
        groups = _factored(estimate)
        if before is not None and _moved(before, moments) < SETTLED:
            break
        before = moments
    size = sum((F.log(f"l{i}{i}") for i in DIMS), F.lit(0.0))
    best = groups.groupBy(*_GROUP).agg(F.min(F.struct(size.alias("size"), "g_start"))["g_start"].alias("g_start"))
    estimate = _together(estimate.join(best, _KEYS).drop("g_start"), parts)
    # the nearest half spreads less than all rows
    groups = _stretched(estimate, _with_distance(rows, beside(_factored(estimate))), parts)
    inside = _with_distance(rows, beside(groups)).where(F.col("distance") <= NEAR).drop("distance")
    moments = _together(_moments(inside.withColumn("g_start", F.lit(0)), *_KEYS), parts)
    estimate = _together(_leaning(moments).drop("g_start"), parts)
    return beside(_stretched(estimate, _with_distance(inside, beside(_factored(estimate))), parts))


def _gathered(rows: DataFrame) -> DataFrame:
    """Few large partitions instead of many small ones: each sends a row for each group and start in every step."""
    return rows.coalesce(max(rows.sparkSession.sparkContext.defaultParallelism, rows.count() // ROWS_TOGETHER + 1))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Per row: id, the counts, base_failed, kept, distance (squared; none where the base rules fail)."""
    slim = docs.select(
        F.col(id_col), F.coalesce(F.col(lang_col), F.lit("")).alias("g_lang"), F.coalesce(F.col(source_col), F.lit("")).alias("g_source"), F.col(text_col)
    )
    counts = text_counts(slim, text_col)
    vector = counts.select("*", base_failed().alias("base_failed"), *[x.alias(f"x{i}") for i, x in enumerate(_vector())])
    rows = _gathered(checkpointed(vector))
    estimates = robust_estimates(rows.where("NOT base_failed"))
    shown = [id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    passed = _with_distance(rows.where("NOT base_failed"), estimates)
    judged = passed.select(*shown, (F.col("distance") <= CUTOFF).alias("kept"), "distance")
    failed = rows.where("base_failed").select(*shown, F.lit(False).alias("kept"), F.lit(None).cast("double").alias("distance"))
    return judged.unionAll(failed)
