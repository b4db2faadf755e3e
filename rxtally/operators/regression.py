"""Linear models as Spark aggregations: fit, statistics, predictions of sums.

A row's regressors are kept sparse, as an array of named terms: a categorical
column adds one entry, a crossing adds one more, zeros are left out. The sums
behind a fit are then a group-by over pairs of entries, with no list of levels
on the driver and no wide rows. Rows that share all categories are one design
point: its number of rows, its means and its centred products, which Spark
merges across tasks in one pass. All later steps work on the points, so their
work is bounded by the label combinations, not by the data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxtally.functions.least_squares import INTERCEPT, fit_candidates, with_residuals
from rxtally.session import cut_lineage

MODEL = "MODEL"


@dataclass(frozen=True)
class Numeric:
    column: str


@dataclass(frozen=True)
class Categorical:
    column: str


@dataclass(frozen=True)
class Crossed:
    """Two categorical columns with their main effects and their interaction."""

    left: str
    right: str


@dataclass(frozen=True)
class Formula:
    """Response, regressors; the intercept is always there.

    Categorical columns use treatment contrasts: the first level found in a
    group is its reference and gets no coefficient.
    """

    response: str
    terms: tuple[Numeric | Categorical | Crossed, ...]

    def effects(self) -> list[tuple[str, ...]]:
        """Column tuples in order: main effects as written, then interactions."""
        main: list[tuple[str, ...]] = []
        crossed: list[tuple[str, ...]] = []
        for term in self.terms:
            if isinstance(term, Crossed):
                main += [(term.left,), (term.right,)]
                crossed.append((term.left, term.right))
            else:
                main.append((term.column,))
        return main + crossed

    def numeric(self) -> list[str]:
        return [term.column for term in self.terms if isinstance(term, Numeric)]

    def columns(self) -> list[str]:
        return list(dict.fromkeys(name for effect in self.effects() for name in effect))


def _level(column: str) -> Column:
    return F.col(column).cast("string")


def _label(column: str) -> Column:
    return F.concat(F.lit(f"{column}["), _level(column), F.lit("]"))


def _entries(
    effects: Sequence[tuple[str, ...]], numeric: Iterable[str], one: Column, numeric_value: Callable[[str], Column]
) -> Column:
    """A row's regressors: position of the effect, levels, name, value; a missing one has no name or no value."""
    numeric = set(numeric)
    none = F.lit(None).cast("string")

    def entry(position, left, right, name, value):
        return F.struct(
            F.lit(position).alias("pos"),
            left.alias("left"),
            right.alias("right"),
            name.alias("term"),
            value.cast("double").alias("value"),
        )

    entries = [entry(0, none, none, F.lit(INTERCEPT), one)]
    for position, effect in enumerate(effects, start=1):
        first = effect[0]
        if len(effect) == 2:
            second = effect[1]
            name = F.concat(_label(first), F.lit(":"), _label(second))
            entries.append(entry(position, _level(first), _level(second), name, one))
        elif first in numeric:
            entries.append(entry(position, none, none, F.lit(first), numeric_value(first)))
        else:
            entries.append(entry(position, _level(first), none, _label(first), one))
    return F.filter(F.array(*entries), lambda e: e["value"].isNotNull() & e["term"].isNotNull())


def design(formula: Formula) -> Column:
    """Non-zero regressors of a row."""
    entries = _entries(formula.effects(), formula.numeric(), F.lit(1.0), F.col)
    return F.filter(entries, lambda e: e["value"] != 0)


def complete_rows(df: DataFrame, formula: Formula) -> DataFrame:
    """Rows with a response and every regressor; the others take no part in a fit."""
    return df.dropna(subset=[formula.response, *formula.columns()])


def _weighted(formula: Formula) -> Column:
    """Weighted regressors of a design point, or an error where one of its rows lacks a regressor."""
    numeric = formula.numeric()
    gap = F.col("_gap")
    for name in formula.columns():
        if name not in numeric:
            gap = gap | F.col(name).isNull()
    entries = _entries(formula.effects(), numeric, F.col("_sw"), lambda name: F.col(f"_wx{numeric.index(name)}"))
    message = F.lit("missing regressor in a row to be predicted: one of " + ", ".join(formula.columns()))
    return F.when(gap, F.raise_error(message).cast(_DESIGN)).otherwise(entries)


def _require_regressors(formula: Formula) -> Column:
    """The design, or an error on a row to be predicted that lacks a regressor."""
    missing = F.lit(False)
    for name in formula.columns():
        missing = missing | F.col(name).isNull()
    message = F.concat(F.lit("missing regressor in a row to be predicted: "), F.to_json(
        F.struct(*[F.col(name) for name in formula.columns()])
    ))
    return F.when(missing, F.raise_error(message).cast(_DESIGN)).otherwise(design(formula))


_ENTRY = T.StructType(
    [
        T.StructField("pos", T.IntegerType()),
        T.StructField("left", T.StringType()),
        T.StructField("right", T.StringType()),
        T.StructField("term", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)
_DESIGN = T.ArrayType(_ENTRY)


def gram_sums(
    df: DataFrame,
    response: str,
    effects: Sequence[tuple[str, ...]],
    numeric: Iterable[str],
    by: Sequence[str],
) -> DataFrame:
    """Sums of products of every pair of terms, and of each term with the response.

    Rows in long form: one per group and pair (``j_term`` NULL for products with
    the response, both NULL for its square). ``missing`` lists the effects a row
    has no value for, so that each model can leave those rows out. Response and
    numeric columns are taken from their means in the group, which come along as
    ``_cy`` and ``_c0``, ``_c1``, ...: sums of large numbers lose the digits that
    a fit depends on. The data are read once: a design point has its own means and
    the products around them, and is moved to the group's means afterwards.
    """
    numeric = list(numeric)
    columns = list(dict.fromkeys(name for effect in effects for name in effect))
    groups = [name for name in columns if name not in numeric]
    y, xs = F.col(response).cast("double"), [F.col(x).cast("double") for x in numeric]
    missing = F.array(
        *[F.when(reduce(or_, [F.col(name).isNull() for name in effect]), position) for position, effect in enumerate(effects, 1)]
    )
    gaps = [F.col(x).isNull().alias(f"_gap{i}") for i, x in enumerate(numeric)]
    places = range(len(numeric))
    rows = F.count(F.lit(1))

    def around(a: Column, b: Column, name: str) -> Column:
        """Sum of products around the point's means; nothing where a numeric column is missing."""
        return F.coalesce(F.covar_pop(a, b) * rows, F.lit(0.0)).alias(name)

    points = (
        df.filter(F.col(response).isNotNull())
        .withColumn("missing", F.array_compact(missing))
        .groupBy(*by, *groups, *gaps, "missing")
        .agg(
            rows.cast("double").alias("_n"),
            F.avg(y).alias("_y"),
            around(y, y, "_syy"),
            *[F.avg(x).alias(f"_x{i}") for i, x in enumerate(xs)],
            *[around(x, y, f"_sy{i}") for i, x in enumerate(xs)],
            *[around(xs[i], xs[j], f"_s{i}_{j}") for i in places for j in places if i <= j],
        )
    )
    # Any number near the mean will do as a centre: it only keeps the sums small.
    group = W.partitionBy(*by)

    def centre_of(name: str) -> Column:
        known = F.when(F.col(name).isNotNull(), F.col("_n"))
        return F.coalesce(F.try_divide(F.sum(known * F.col(name)).over(group), F.sum(known).over(group)), F.lit(0.0))

    centre = ["_cy", *[f"_c{i}" for i in places]]
    points = points.withColumns({"_cy": centre_of("_y"), **{f"_c{i}": centre_of(f"_x{i}") for i in places}})
    n, off_y = F.col("_n"), F.col("_y") - F.col("_cy")
    # The categories share the first place among the moments: their regressor is one in every row.
    off = [F.lit(1.0), *[F.coalesce(F.col(f"_x{i}") - F.col(f"_c{i}"), F.lit(0.0)) for i in places]]

    def moment(i: int, j: int) -> Column:
        own = n * off[i] * off[j]
        return own if i == 0 or j == 0 else F.col(f"_s{min(i, j) - 1}_{max(i, j) - 1}") + own

    def moment_y(i: int) -> Column:
        return n * off_y if i == 0 else F.col(f"_sy{i - 1}") + n * off[i] * off_y

    def place(name: str) -> Column:
        """Where a numeric column's sums are among the moments."""
        return F.when(~F.col(f"_gap{numeric.index(name)}"), numeric.index(name) + 1)

    points = points.select(
        *by, *centre, "missing",
        F.array(*[F.array(*[moment(i, j) for j in range(len(off))]) for i in range(len(off))]).alias("_m"),
        F.array(*[moment_y(i) for i in range(len(off))]).alias("_my"),
        (F.col("_syy") + n * off_y * off_y).alias("_yy"),
        _entries(effects, numeric, F.lit(0.0), place).alias("_x"),
    )
    nobody = F.lit(None).cast(_ENTRY)

    def pair(i, j, value):
        return F.struct(i.alias("i"), j.alias("j"), value.alias("product"))

    def products(entry, position):
        following = F.slice(F.col("_x"), position + 1, F.size("_x") - position)
        own = lambda e: e["value"].cast("int")  # noqa: E731  place of the term's column in the moments
        with_terms = F.transform(
            following, lambda other: pair(entry, other, F.get(F.get(F.col("_m"), own(entry)), own(other)))
        )
        return F.concat(with_terms, F.array(pair(entry, nobody, F.get(F.col("_my"), own(entry)))))

    pairs = F.concat(
        F.flatten(F.transform("_x", products)), F.array(pair(nobody, nobody, F.col("_yy")))
    )
    parts = [f"{side}.{field}" for side in "ij" for field in ("pos", "left", "right", "term")]
    names = [part.replace(".", "_") for part in parts]
    return (
        points.select(*by, *centre, "missing", F.explode(pairs).alias("_p"))
        .select(
            *by,
            *centre,
            "missing",
            *[F.col(f"_p.{part}").alias(name) for part, name in zip(parts, names, strict=True)],
            F.col("_p.product").alias("product"),
        )
        .groupBy(*by, *centre, "missing", *names)
        .agg(F.sum("product").alias("product"))
    )


_FIT_FIELDS = [
    T.StructField("terms", T.ArrayType(T.StringType())),
    T.StructField("known_terms", T.ArrayType(T.StringType())),
    T.StructField("coef", T.ArrayType(T.DoubleType())),
    T.StructField("std_error", T.ArrayType(T.DoubleType())),
    T.StructField("t_value", T.ArrayType(T.DoubleType())),
    T.StructField("p_value", T.ArrayType(T.DoubleType())),
    T.StructField("cov_unscaled", T.ArrayType(T.ArrayType(T.DoubleType()))),
    T.StructField("r_squared", T.DoubleType()),
    T.StructField("adj_r_squared", T.DoubleType()),
    T.StructField("sigma", T.DoubleType()),
    T.StructField("sigma2", T.DoubleType()),
    T.StructField("statistic", T.DoubleType()),
    T.StructField("statistic_p", T.DoubleType()),
    T.StructField("df", T.LongType()),
    T.StructField("rank", T.LongType()),
    T.StructField("log_lik", T.DoubleType()),
    T.StructField("aic", T.DoubleType()),
    T.StructField("bic", T.DoubleType()),
    T.StructField("deviance", T.DoubleType()),
    T.StructField("df_resid", T.LongType()),
    T.StructField("nobs", T.LongType()),
    T.StructField("t_quantiles", T.ArrayType(T.DoubleType())),
]


def fit_many(
    df: DataFrame,
    candidates: Mapping[str, Formula],
    by: Sequence[str],
    levels: Sequence[float] = (0.95, 0.99),
) -> DataFrame:
    """Fit every candidate in every group; one row per candidate and group.

    The sums are taken once for all candidates together: the matrix of each one
    is a block of the whole. Each group handed to Python is such a matrix in long
    form, whatever the number of data rows behind it. The fit runs at once and its
    rows are saved, since several steps read them. Where next to nothing of the
    response is left over, the residuals are summed from the rows themselves.
    """
    responses = {formula.response for formula in candidates.values()}
    if len(responses) != 1:
        raise ValueError("candidates must share one response")
    effects = list(dict.fromkeys(e for formula in candidates.values() for e in formula.effects()))
    numeric = sorted({name for formula in candidates.values() for name in formula.numeric()})
    sums = gram_sums(df, responses.pop(), effects, numeric, by)
    wanted = {name: formula.effects() for name, formula in candidates.items()}
    levels = tuple(levels)
    keys = list(by)

    def solve_group(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        rows = fit_candidates(group, effects, wanted, numeric, levels)
        return pd.DataFrame([{**dict(zip(keys, key, strict=True)), **row} for row in rows])

    model = T.StructField(MODEL, T.StringType())
    schema = T.StructType([*[sums.schema[name] for name in keys], model, *_FIT_FIELDS])
    models = cut_lineage(sums.groupBy(*keys).applyInPandas(solve_group, schema))
    return _with_exact_residuals(df, models, candidates, keys, levels)


_SUBTRACTION = 1e-9  # share of the total sum of squares below which a residual sum needs the rows


def _with_exact_residuals(
    df: DataFrame, models: DataFrame, candidates: Mapping[str, Formula], by: Sequence[str], levels: Sequence[float]
) -> DataFrame:
    """Models whose residual sum is too small a share of the total to come from subtraction get it from the rows.

    The rows are read a second time only if there is such a model, and only those of its groups. Rows of a group
    whose key is NULL find no model and keep the subtraction.
    """
    close = models.filter(1 - F.col("r_squared") < _SUBTRACTION)
    names = [row[MODEL] for row in close.select(MODEL).distinct().collect()]  # at most the candidates
    if not names:
        return models
    sums = []
    for name in names:
        formula = candidates[name]
        rows = predict(complete_rows(df, formula), close.filter(F.col(MODEL) == name), formula, by)
        y = F.col(formula.response).cast("double")
        rest = rows.groupBy(*by).agg(
            F.sum((y - F.col("fitted")) ** 2).alias("_rss"), (F.var_pop(y) * F.count(y)).alias("_total")
        )
        sums.append(rest.withColumn(MODEL, F.lit(name)))
    exact = reduce(DataFrame.unionByName, sums)

    def replace(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for batch in batches:
            rows = batch.drop(columns=["_rss", "_total"]).astype(object).to_dict("records")
            found = zip(rows, batch["_rss"], batch["_total"], strict=True)
            yield pd.DataFrame([with_residuals(row, rss, total, levels) for row, rss, total in found])

    again = close.join(exact, [*by, MODEL]).select(*models.columns, "_rss", "_total")
    redone = cut_lineage(again.mapInPandas(replace, models.schema))
    return models.join(redone.select(*by, MODEL), [*by, MODEL], "left_anti").unionByName(redone)


def fit(
    df: DataFrame, formula: Formula, by: Sequence[str], levels: Sequence[float] = (0.95, 0.99)
) -> DataFrame:
    """One model row per group."""
    return fit_many(df, {"model": formula}, by, levels)


GLANCE = [
    "r_squared", "adj_r_squared", "sigma", "statistic", "statistic_p", "df",
    "log_lik", "aic", "bic", "deviance", "df_resid", "nobs",
]


def fit_statistics(models: DataFrame, by: Sequence[str]) -> DataFrame:
    return models.select(MODEL, *by, *GLANCE)


def coefficient_table(models: DataFrame, by: Sequence[str]) -> DataFrame:
    """Estimate, standard error, t and p per term; NULL where a term is aliased."""
    rows = F.arrays_zip(
        F.col("terms").alias("term"),
        F.col("coef").alias("estimate"),
        F.col("std_error"),
        F.col("t_value"),
        F.col("p_value"),
    )
    return models.select(MODEL, *by, F.inline(rows))


def rank_by_aic(models: DataFrame, by: Sequence[str]) -> DataFrame:
    """Candidates per group from lowest to highest AIC."""
    order = W.partitionBy(*by).orderBy("aic", MODEL)
    return fit_statistics(models, by).withColumn("aic_rank", F.row_number().over(order))


def _dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda a, b: a * F.coalesce(b, F.lit(0.0)))
    return F.aggregate(products, F.lit(0.0), lambda total, value: total + value)


def _quadratic(vector: Column, matrix: Column) -> Column:
    """v' M v."""
    return _dot(F.transform(matrix, lambda row: _dot(row, vector)), vector)


def _check_terms(names: Column, known: Column) -> Column:
    """True, or an error for a term the fit has never seen."""
    unseen = F.array_except(names, known)
    message = F.concat(F.lit("level not seen in training: "), F.array_join(unseen, ", "))
    return F.when(F.size(unseen) > 0, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))


def _aligned(values: Column, terms: Column) -> Column:
    """Vector in the order of the model's terms from a map of term to value."""
    return F.transform(terms, lambda term: F.coalesce(values[term], F.lit(0.0)))


def _with_places(
    df: DataFrame, models: DataFrame, formula: Formula, by: Sequence[str], extra: Sequence[str] = ()
) -> DataFrame:
    """Data rows beside their model and the ``extra`` columns of it; ``_v`` lists place and value of each non-zero regressor.

    Known terms are stored with the reported ones first, so a place beyond those
    is a reference level and counts as zero.
    """
    joined = df.withColumn("_x", _require_regressors(formula)).join(
        models.select(*by, "terms", "known_terms", "coef", *extra), list(by)
    )
    places = F.transform(
        "_x",
        lambda e: F.struct(
            F.array_position(F.col("known_terms"), e["term"]).cast("int").alias("k"),
            e["value"].alias("v"),
        ),
    )
    return joined.withColumn("_places", places).withColumn(
        "_v",
        F.when(
            F.exists("_places", lambda p: p["k"] == 0),
            F.raise_error(F.lit("level not seen in training")).cast(_PLACES),
        ).otherwise(F.filter("_places", lambda p: p["k"] <= F.size("terms"))),
    )


_PLACES = "array<struct<k:int,v:double>>"
_MODEL_COLUMNS = [
    "_x", "_places", "_v", "terms", "known_terms", "coef",
]


def _sum_places(value) -> Column:
    return F.aggregate("_v", F.lit(0.0), lambda total, p: total + p["v"] * value(p["k"] - 1))


def _fitted() -> Column:
    return _sum_places(lambda k: F.coalesce(F.col("coef")[k], F.lit(0.0)))


def predict(df: DataFrame, models: DataFrame, formula: Formula, by: Sequence[str]) -> DataFrame:
    """Point prediction of every row as ``fitted``; aliased terms count as zero."""
    rows = _with_places(df, models, formula, by)
    return rows.withColumn("fitted", _fitted()).drop(*_MODEL_COLUMNS)


def residual_diagnostics(
    df: DataFrame, models: DataFrame, formula: Formula, by: Sequence[str]
) -> DataFrame:
    """Fitted value, residual, leverage, standardised residual and Cook's distance per row.

    What the categories add is worked out once for each design point: their part of the prediction and of the leverage,
    and one factor for each numeric column. Rows join their point and only put their own numbers in. The points are
    saved, so that Spark knows their number before it plans that join.
    """
    rows = complete_rows(df, formula)
    numeric = formula.numeric()
    labels = [name for name in formula.columns() if name not in numeric]
    ones = Formula(formula.response, tuple(t for t in formula.terms if not isinstance(t, Numeric)))
    points = _with_places(
        rows.select(*by, *labels).distinct(), models, ones, by, ["cov_unscaled", "sigma2", "rank"]
    )
    place = [F.array_position("terms", F.lit(name)).cast("int") - 1 for name in numeric]

    def cov(i: Column, j: Column) -> Column:
        return F.col("cov_unscaled")[i][j]

    points = points.select(
        *by, *labels, F.col("sigma2").alias("_sigma2"), F.col("rank").alias("_rank"),
        _fitted().alias("_fit"),
        _sum_places(lambda k: _sum_places(lambda j: cov(k, j))).alias("_lev"),
        F.array(*[F.coalesce(F.col("coef")[i], F.lit(0.0)) for i in place]).cast("array<double>").alias("_slope"),
        F.array(*[_sum_places(lambda k, i=i: cov(i, k)) for i in place]).cast("array<double>").alias("_cross"),
        F.array(*[F.array(*[cov(i, j) for j in place]) for i in place]).cast("array<array<double>>").alias("_square"),
    )
    rows = rows.join(cut_lineage(points), [*by, *labels])
    x = [F.col(name).cast("double") for name in numeric]
    fitted, leverage = F.col("_fit"), F.col("_lev")
    for i, value in enumerate(x):
        fitted = fitted + value * F.col("_slope")[i]
        leverage = leverage + 2 * value * F.col("_cross")[i]
        for j, other in enumerate(x):
            leverage = leverage + value * other * F.col("_square")[i][j]
    room = 1 - F.col("leverage")
    return (
        rows.withColumns({"fitted": fitted, "leverage": leverage})
        .withColumn("residual", F.col(formula.response) - F.col("fitted"))
        .withColumns(
            {
                "std_residual": F.try_divide(
                    F.col("residual"), F.sqrt(F.col("_sigma2") * F.greatest(room, F.lit(0.0)))
                ),
                "cooks_distance": F.try_divide(
                    F.col("residual") ** 2 * F.col("leverage"),
                    F.col("_rank") * F.col("_sigma2") * room**2,
                ),
            }
        )
        .drop("_sigma2", "_rank", "_fit", "_lev", "_slope", "_cross", "_square")
    )


def predict_sums(
    df: DataFrame,
    models: DataFrame,
    formula: Formula,
    by: Sequence[str],
    within: Sequence[str],
    weight: Column | None = None,
) -> DataFrame:
    """Prediction of the weighted sum over each group of rows.

    One row per ``by`` and ``within``: mean, variance of the mean, and the half
    widths of the confidence and prediction intervals at each of the model's
    levels. Only the sums of the weighted regressors and of the squared weights
    are needed: rows are added up by their categories first, those few sums are
    spread over the terms, and the matrix is used once per group.
    """
    w = F.lit(1.0) if weight is None else weight.cast("double")
    keys = [*by, *within]
    numeric = formula.numeric()
    labels = [name for name in formula.columns() if name not in [*numeric, *keys]]
    gaps = [F.count(F.lit(1)) > F.count(name) for name in numeric]
    points = (
        df.withColumn("_w", w)
        .groupBy(*keys, *labels)
        .agg(
            F.sum("_w").alias("_sw"),
            F.sum(F.col("_w") * F.col("_w")).alias("_ww"),
            reduce(or_, gaps, F.lit(False)).alias("_gap"),
            *[F.sum(F.col("_w") * F.col(name).cast("double")).alias(f"_wx{i}") for i, name in enumerate(numeric)],
        )
        .withColumn("_x", _weighted(formula))
    )
    sums = (
        points.select(*keys, "_ww", F.explode("_x").alias("_e"))
        .groupBy(*keys, F.col("_e.term").alias("_term"))
        .agg(F.sum("_e.value").alias("_s"), F.sum("_ww").alias("_ww"))
        .groupBy(*keys)
        .agg(
            F.map_from_entries(F.collect_list(F.struct("_term", "_s"))).alias("_s"),
            F.max(F.when(F.col("_term") == INTERCEPT, F.col("_ww"))).alias("_ww"),
        )
    )
    joined = sums.join(
        models.select(*by, "terms", "known_terms", "coef", "cov_unscaled", "sigma2", "t_quantiles"), list(by)
    ).filter(_check_terms(F.map_keys("_s"), F.col("known_terms")))
    vector = _aligned(F.col("_s"), F.col("terms"))
    return (
        joined.withColumn("_v", vector)
        .withColumns(
            {
                "mean": _dot(F.col("_v"), F.col("coef")),
                "var": F.col("sigma2") * _quadratic(F.col("_v"), F.col("cov_unscaled")),
            }
        )
        .withColumns(
            {
                "ci_half": F.transform(
                    "t_quantiles", lambda t: t * F.sqrt(F.col("var"))
                ),
                "pi_half": F.transform(
                    "t_quantiles",
                    lambda t: t * F.sqrt(F.col("var") + F.col("sigma2") * F.col("_ww")),
                ),
            }
        )
        .select(*keys, "mean", "var", "ci_half", "pi_half")
    )


def monthly_expected(
    df: DataFrame,
    models: DataFrame,
    formula: Formula,
    by: Sequence[str] = ("SECTION_CODE",),
    levels: Sequence[float] = (0.95, 0.99),
) -> DataFrame:
    """Expected total per section and month with its prediction intervals.

    ``levels`` are those the models were fitted with. The bounds at 95% are ``PIlwr`` and ``PIupr``, those at other
    levels have the level in their names, as ``PIlwr99``.
    """
    out = predict_sums(df, models, formula, by, ["YEAR_MONTH"])
    mean, half = F.col("mean"), F.col("pi_half")
    bounds = []
    for place, level in enumerate(levels):
        name = "" if level == 0.95 else f"{level * 100:g}".replace(".", "_")
        bounds += [(mean - half[place]).alias(f"PIlwr{name}"), (mean + half[place]).alias(f"PIupr{name}")]
    return out.select(*by, "YEAR_MONTH", mean.alias("mean_fit"), "var", *bounds)


def outside_interval(df: DataFrame) -> DataFrame:
    """Say whether the actual total lies below, inside or above the 95% interval."""
    total = F.col("total_items")
    return df.withColumn(
        "outside",
        F.when(total < F.col("PIlwr"), "below")
        .when(total > F.col("PIupr"), "above")
        .when(F.col("PIlwr").isNotNull(), "inside"),
    )
