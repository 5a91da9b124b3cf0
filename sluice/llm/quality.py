"""Quality rules: word and line statistics, and robust multivariate outliers.

Each text gets counts over its whole length and a vector of transformed
statistics. Location and scatter of the vectors are estimated per language and
source, per language and over all rows, by the minimum covariance determinant:
several deterministic starts (a diagonal one, and the correlations of squashed
and of sign vectors) each go through concentration steps, which take the
``SHARE`` of a group's rows nearest by Mahalanobis distance and estimate anew,
until the determinant falls no further; of the starts the least determinant
wins. A row whose squared distance, scaled so that the group's median is at most
that of a chi-squared variable, exceeds ``CUTOFF`` is rejected. Groups below
``LEAST_ROWS`` rows are judged by the estimate of their language, and failing
that of all rows.

All of it is DataFrame expressions. A step is one pass for all groups and
starts: each row adds its deviations and their products to a narrow bin of its
distance, with map-side combination, and the nearest rows are the sums of the
first bins and a share of the last. So no sort, no second pass for the limit,
and what meets in one place is a row per task, group, start and bin; a hot
source is summed in every task that reads it.

Defined cases: a null text counts as empty and fails the base rules; null
languages and sources are groups of their own; repeated rows are judged one by
one; a group whose rows are all alike has the floor as its scatter and rejects
what is far from them; an empty table gives an empty one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import cut, fresh

#: Share of a group's rows in the estimate, rows that a group needs, fall of the determinant's logarithm that a step has to bring.
SHARE, LEAST_ROWS, LEAST_FALL = 0.75, 200, 0.02
#: Bins of squared distances: so many for each factor e, between these limits.
BINS, NEAREST, FARTHEST = 10, 1e-3, 1e6
#: Tasks over which the rows of one group are dealt.
SALTS = 16
#: Quantile of the chi-squared distribution of 5 degrees of freedom at 0.999, and its median.
CUTOFF, MEDIAN = 20.515, 4.3515
#: Smallest standard deviation of each transformed statistic. Most texts have no symbol, repeated line or
#: repeated words at all; against such a group about 9 % of the lines or words repeated is the limit.
FLOORS = (0.25, 0.05, 0.30, 0.5, 0.5)
#: One repeated line, or the words of one (or of one repeated run of three words), is at most so many
#: standard deviations, so that in a short text, whose shares are coarse, it does not decide alone.
ONCE = 3.0
NAMES = ("v1", "v2", "v3", "v4", "v5")
_DIMS = range(len(NAMES))

#: The statistics of one text; the lambdas bind what is used more than once, so nothing is computed twice.
_STATISTICS = r"""
transform(array(filter(split(coalesce({text}, ''), '[\\x20\\x09-\\x0D]+'), x -> x != '')), w -> struct(
  cast(size(w) as bigint) as n_words,
  cast(length(concat_ws('', w)) as bigint) as word_chars,
  cast(regexp_count(concat_ws('', w), '[#*$%&|<>]') as bigint) as n_symbols,
  transform(array(filter(split(coalesce({text}, ''), '\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')), l ->
    struct(cast(size(l) as bigint) as n, cast(size(l) - size(array_distinct(l)) as bigint) as dup))[0] as lines,
  if(size(w) < 3, 0L,
    transform(array(transform(sequence(0, greatest(size(w) - 3, 0)), i -> concat_ws(' ', w[i], w[i + 1], w[i + 2]))), g ->
      if(size(array_distinct(g)) = size(g), 0L,
        transform(array(sort_array(transform(g, (x, i) -> struct(x as x, i as i)))), s ->
          aggregate(
            sort_array(transform(filter(s, (p, k) -> p.x <=> get(s, k - 1).x or p.x <=> get(s, k + 1).x), p -> p.i)),
            struct(-3 as last, 0L as total),
            (a, p) -> struct(p as last, a.total + least(3, p - a.last) as total),
            a -> a.total))[0]))[0]) as n_repeat_words
))[0]
"""


def with_statistics(docs: DataFrame, out: str) -> DataFrame:
    """``docs`` with a struct column ``out`` of the counts and the transformed vector."""
    raw = fresh(docs, "raw")
    df = docs.withColumn(raw, F.expr(_STATISTICS.format(text="text")))
    c = lambda name: F.col(f"{raw}.{name}").cast("double")
    words = F.greatest(c("n_words"), F.lit(1.0))
    vector = (
        F.log1p(c("n_words")),
        F.log(F.greatest(c("word_chars"), F.lit(1.0)) / words),
        F.log1p(100 * c("n_symbols") / F.greatest(c("word_chars"), F.lit(1.0))),
        F.log1p(100 * c("lines.dup") / F.greatest(c("lines.n"), F.lit(1.0))),
        F.log1p(100 * c("n_repeat_words") / words),
    )
    failed = (F.col(f"{raw}.n_words") < 50) | (100 * F.col(f"{raw}.n_repeat_words") > 50 * F.col(f"{raw}.n_words"))
    fields = [F.col(f"{raw}.{x}").alias(x) for x in ("n_words", "word_chars", "n_symbols")]
    fields += [F.col(f"{raw}.lines.dup").alias("n_dup_lines"), F.col(f"{raw}.n_repeat_words").alias("n_repeat_words")]
    # By how much the variance of v4 and v5 is raised for a text whose shares are coarser than the floors.
    coarse = [
        F.greatest(F.pow(F.log1p(100 * one / total) / ONCE, 2) - floor**2, F.lit(0.0)).alias(name)
        for name, one, total, floor in (
            ("e4", 1, F.greatest(c("lines.n"), F.lit(1.0)), FLOORS[3]), ("e5", F.greatest(F.lit(6.0), 2 * words / F.greatest(c("lines.n"), F.lit(1.0))), words, FLOORS[4])
        )
    ]
    fields += [*coarse, failed.alias("base_failed"), *(x.alias(n) for n, x in zip(NAMES, vector))]
    return df.withColumn(out, F.struct(*fields)).drop(raw)


def _cholesky(cov: list[list[Column]], floors=FLOORS) -> list[tuple[str, Column]]:
    """Steps ``(name, expression)`` for the lower triangle ``l_i_j``; the floors are added to the diagonal."""
    steps = []
    for i in _DIMS:
        for j in range(i + 1):
            dot = reduce(lambda a, k: a - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}"), range(j), cov[i][j])
            if i == j:
                value = F.sqrt(F.greatest(dot, F.lit(floors[i] ** 2 * 1e-3)))
            else:
                value = dot / F.col(f"l_{j}_{j}")
            steps.append((f"l_{i}_{j}", value))
    return steps


_PARTS = [f"m_{i}" for i in _DIMS] + [f"l_{i}_{j}" for i in _DIMS for j in range(i + 1)]
_PAIRS = [(i, j) for i in _DIMS for j in range(i + 1)]


def _factored(est: DataFrame, keys: list[str], cov) -> DataFrame:
    """``est`` with the Cholesky factor of ``cov(i, j)`` and the logarithm of its determinant; the floors are added."""
    full = [[cov(i, j) + F.lit(FLOORS[i] ** 2 if i == j else 0.0) for j in range(i + 1)] for i in _DIMS]
    for name, value in _cholesky(full):
        est = est.withColumn(name, value)
    fall = reduce(lambda a, i: a + 2 * F.log(F.col(f"l_{i}_{i}")), _DIMS, F.lit(0.0))
    return est.select(*keys, *_PARTS, fall.alias("logdet"))


def _distance(of=F.col, value=F.col) -> Column:
    """Squared Mahalanobis distance by forward substitution, from joined estimate columns."""
    z: list[Column] = []
    for i in _DIMS:
        rest = reduce(lambda a, j: a - of(f"l_{i}_{j}") * z[j], range(i), value(NAMES[i]) - of(f"m_{i}"))
        z.append(rest / of(f"l_{i}_{i}"))
    return reduce(lambda a, b: a + b, [x * x for x in z])


def _own_distance(est: str) -> Column:
    """``_distance`` under the scatter with ``e4`` and ``e5`` added to the last two variances.

    To be longer than others is no fault, so a length above the group's location counts as that.
    """
    l33, l43, l44 = (F.col(f"{est}.l_{i}_{j}") for i, j in ((3, 3), (4, 3), (4, 4)))
    a = F.sqrt(l33 * l33 + F.col("e4"))
    b = l43 * l33 / a
    own = {"l_3_3": a, "l_4_3": b, "l_4_4": F.sqrt(l44 * l44 + l43 * l43 - b * b + F.col("e5"))}
    names = [f"m_{i}" for i in _DIMS] + [f"l_{i}_{j}" for i in _DIMS for j in range(i + 1)]
    value = lambda n: F.least(n, f"{est}.m_0") if n == "v1" else F.col(n)
    return F.transform(
        F.array(F.struct(*(own.get(n, F.col(f"{est}.{n}")).alias(n) for n in names))), lambda x: _distance(lambda n: x[n], value)
    )[0]


def _joined(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows`` with the columns of their language and source; a group's rows are dealt over ``SALTS`` tasks."""
    salted = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(salted, ["g_lang", "g_source", "salt"])


def _levels() -> Column:
    """The three groups of a row: its language and source, its language, all."""
    return F.array(F.concat_ws("\x1f", F.lit("2"), "g_lang", "g_source"), F.concat_ws("\x1f", F.lit("1"), "g_lang"), F.lit("0"))


def _with(rows: DataFrame, groups: DataFrame, table: DataFrame) -> DataFrame:
    """Every row with each row of ``table`` (by ``g``) for one of its groups, as ``e``."""
    each = groups.withColumn("g", F.explode(_levels())).join(table, "g")
    fields = F.struct("g", *(c for c in table.columns if c != "g"))
    each = each.groupBy("g_lang", "g_source").agg(F.collect_list(fields).alias("es"))  # at most three groups times the starts
    return _joined(rows, each).select(*NAMES, F.explode("es").alias("e")).select(*NAMES, "e.*")


def _starts(rows: DataFrame, groups: DataFrame, least_rows: int) -> DataFrame:
    """``g, start``, a location and a scatter each, of the groups with enough rows."""
    counts = rows.groupBy("g_lang", "g_source").agg(F.count(F.lit(1)).alias("n")).withColumn("g", F.explode(_levels()))
    large = counts.groupBy("g").agg(F.sum("n").alias("n")).filter((F.col("n") >= least_rows) | (F.col("g") == "0"))
    middle = rows.select(F.explode(_levels()).alias("g"), *NAMES).groupBy("g").agg(
        *(F.percentile_approx(NAMES[i], [0.25, 0.5, 0.75], 1000).alias(f"q_{i}") for i in _DIMS)
    )
    scale = lambda i: F.greatest((F.col(f"q_{i}")[2] - F.col(f"q_{i}")[0]) / 1.349, F.lit(FLOORS[i]))
    middle = middle.join(large.select("g"), "g", "left_semi").select(
        "g", *(F.col(f"q_{i}")[1].alias(f"m_{i}") for i in _DIMS), *(scale(i).alias(f"s_{i}") for i in _DIMS)
    )
    middle = cut(middle, "middle")
    z = [(F.col(NAMES[i]) - F.col(f"m_{i}")) / F.col(f"s_{i}") for i in _DIMS]
    away = _with(rows, groups, middle).select("g", *(x.alias(f"z_{i}") for i, x in enumerate(z)))
    length = F.greatest(reduce(lambda a, i: a + F.col(f"z_{i}") * F.col(f"z_{i}"), _DIMS, F.lit(0.0)), F.lit(1e-9))
    away = away.select("g", *(F.tanh(f"z_{i}").alias(f"t_{i}") for i in _DIMS), *(F.col(f"z_{i}") for i in _DIMS), length.alias("r"))
    sums = away.groupBy("g").agg(
        *(F.covar_pop(f"t_{i}", f"t_{j}").alias(f"t_{i}_{j}") for i, j in _PAIRS),
        *(F.avg(F.col(f"z_{i}") * F.col(f"z_{j}") / F.col("r")).alias(f"z_{i}_{j}") for i, j in _PAIRS),
    )
    both = cut(middle.join(sums, "g"), "starts")
    size = lambda i, j: F.col(f"s_{i}") * F.col(f"s_{j}")
    spread = lambda i: F.sqrt(F.greatest(F.col(f"t_{i}_{i}"), F.lit(1e-6)))
    scatters = (
        lambda i, j: size(i, j) if i == j else F.lit(0.0),
        lambda i, j: size(i, j) * F.col(f"t_{i}_{j}") / (spread(i) * spread(j)),
        lambda i, j: size(i, j) * len(_DIMS) * F.col(f"z_{i}_{j}"),
    )
    made = [_factored(both, ["g"], cov).withColumn("start", F.lit(k)) for k, cov in enumerate(scatters)]
    return reduce(lambda a, b: a.unionByName(b), made)


def _step(rows: DataFrame, groups: DataFrame, state: DataFrame) -> DataFrame:
    """One concentration step of every ``(g, start)`` of ``state``: the new estimate, and ``middle``, the old one's median distance."""
    away = _with(rows, groups, state.select("g", "start", *_PARTS)).withColumn("d2", _distance())
    bin_ = F.floor(F.log(F.least(F.greatest("d2", F.lit(NEAREST)), F.lit(FARTHEST))) * BINS).cast("int")
    away = away.select("g", "start", bin_.alias("bin"), *((F.col(NAMES[i]) - F.col(f"m_{i}")).alias(f"y_{i}") for i in _DIMS))
    sums = away.groupBy("g", "start", "bin").agg(
        F.count(F.lit(1)).alias("n"), *(F.sum(f"y_{i}").alias(f"s_{i}") for i in _DIMS),
        *(F.sum(F.col(f"y_{i}") * F.col(f"y_{j}")).alias(f"p_{i}_{j}") for i, j in _PAIRS),
    )
    group = Window.partitionBy("g", "start")  # a row per bin
    before = F.coalesce(F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select("*", before.alias("before"), F.sum("n").over(group).alias("all"))
    part = lambda share: F.least(F.greatest((share * F.col("all") - F.col("before")) / F.col("n"), F.lit(0.0)), F.lit(1.0))
    sums = sums.withColumn("w", part(SHARE)).withColumn("half", part(0.5))
    near = sums.groupBy("g", "start").agg(
        F.sum(F.col("w") * F.col("n")).alias("n"), *(F.sum(F.col("w") * F.col(f"s_{i}")).alias(f"s_{i}") for i in _DIMS),
        *(F.sum(F.col("w") * F.col(f"p_{i}_{j}")).alias(f"p_{i}_{j}") for i, j in _PAIRS),
        # The last bin of the nearer half, and how far into it the median lies.
        F.max(F.when(F.col("half") > 0, F.struct("bin", "half"))).alias("last"),
    )
    near = near.join(state.select("g", "start", *(F.col(f"m_{i}").alias(f"o_{i}") for i in _DIMS)), ["g", "start"])
    mean = lambda i: F.col(f"s_{i}") / F.col("n")
    near = near.select("*", *((F.col(f"o_{i}") + mean(i)).alias(f"m_{i}") for i in _DIMS), F.exp((F.col("last.bin") + F.col("last.half")) / BINS).alias("middle"))
    return _factored(near, ["g", "start", "middle"], lambda i, j: F.col(f"p_{i}_{j}") / F.col("n") - mean(i) * mean(j))


def fit(rows: DataFrame, least_rows: int) -> DataFrame:
    """Minimum-covariance-determinant estimates ``g, m_i, l_i_j, scale`` of all groups with ``least_rows`` rows, and of all rows.

    Every start goes on while a step lowers its determinant; that ends, since the floors bound it from below.
    """
    groups = cut(rows.select("g_lang", "g_source").distinct(), "groups")
    active = cut(_starts(rows, groups, least_rows), "state")
    done = None
    while True:
        new = cut(_step(rows, groups, active), "state")
        old = active.select("g", "start", F.col("logdet").alias("old"))
        # A start's own scatter is no covariance of any rows, so the first step counts as a fall.
        falls = F.lit(True) if done is None else F.col("logdet") < F.col("old") - LEAST_FALL
        both = new.join(old, ["g", "start"]).withColumn("falls", falls)
        ended = both.filter(~F.coalesce("falls", F.lit(False))).select("g", "start")
        last = active.join(ended, ["g", "start"], "left_semi").select("g", "start", *_PARTS, "logdet")
        done = last if done is None else done.unionByName(last)
        active = cut(both.filter("falls").select("g", "start", *_PARTS, "logdet"), "state")
        if active.isEmpty():
            break
    best = Window.partitionBy("g").orderBy("logdet", "start")  # a row per start
    best = cut(done.withColumn("place", F.row_number().over(best)).filter("place = 1").drop("place"), "scatter")
    middle = _step(rows, groups, best).select("g", F.greatest(F.col("middle") / MEDIAN, F.lit(1.0)).alias("scale"))
    return best.join(middle, "g").select("g", *_PARTS, "scale")


def judge(docs: DataFrame, least_rows: int = LEAST_ROWS, carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns (default: the id) with the statistics and the verdict ``kept``.

    Column names of ``docs`` are kept apart from those made here.
    """
    carry = ["doc_id"] if carry is None else carry
    stats = fresh(docs, "stats")
    made = with_statistics(docs, stats)
    rows = made.select(
        F.struct(*(F.col(c) for c in carry)).alias("own"),
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("g_lang"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("g_source"),
        F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("salt"),
        f"{stats}.*",
    )
    rows = cut(rows, "quality")  # written down, the salts stay
    sample = rows.filter("not base_failed").select("g_lang", "g_source", "salt", *NAMES)
    table = cut(fit(sample, least_rows), "scatter")
    groups = rows.select("g_lang", "g_source").distinct()
    level = groups.select("g_lang", "g_source", F.posexplode(_levels()).alias("level", "g")).join(table, "g")
    nearest = level.groupBy("g_lang", "g_source").agg(F.min_by(F.struct(*_PARTS, "scale"), "level").alias("e"))
    table = cut(groups.join(nearest, ["g_lang", "g_source"], "left"), "scatter")
    judged = _joined(rows, table).withColumn("d2", _own_distance("e") / F.col("e.scale"))
    return judged.select(
        "own.*", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(F.col("d2") <= CUTOFF, F.lit(True))).alias("kept"), "d2",
    )


def keep_good(docs: DataFrame, least_rows: int = LEAST_ROWS) -> DataFrame:
    """The rows of ``docs`` that are not rejected, all columns kept."""
    whole = fresh(docs, "row")
    wrapped = docs.select("text", "lang", "source", F.struct(*(F.col(c) for c in docs.columns)).alias(whole))
    return judge(wrapped, least_rows, [whole]).filter("kept").select(f"{whole}.*")
