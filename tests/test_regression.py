import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rxtally.operators import regression
from rxtally.operators.regression import Categorical, Crossed, Formula, Numeric
from rxtally.plans import model

BY = ["SECTION_CODE"]


def sample(seed=1, months=48, sections=("0401", "0403"), drop=0.0):
    rng = np.random.default_rng(seed)
    rows = []
    for section in sections:
        for index in range(1, months + 1):
            days = int(rng.integers(22, 28))
            for gender in "FM":
                for band in ("00-19", "20-39", "40-59"):
                    if rng.random() < drop:
                        continue
                    y = 50 + index + 3 * days + (gender == "M") * 9 + rng.normal(0, 5)
                    rows.append((section, 201500 + index, index, days, index % 12 + 1, gender, band, y))
    names = ["SECTION_CODE", "YEAR_MONTH", "MONTH_INDEX", "DISPENSING_DAYS", "MONTH_NUM", "PDS_GENDER",
             "BAND_20YR", "ITEM_COUNT"]
    return pd.DataFrame(rows, columns=names)


def matrix(pdf):
    """Treatment-contrast design of the published formula, straight in NumPy."""
    columns = [np.ones(len(pdf)), pdf.MONTH_INDEX, pdf.DISPENSING_DAYS]
    columns += [(pdf.MONTH_NUM == m) * 1.0 for m in range(2, 13)]
    male = (pdf.PDS_GENDER == "M") * 1.0
    bands = [(pdf.BAND_20YR == b) * 1.0 for b in ("20-39", "40-59")]
    columns += [male, *bands, *[male * b for b in bands]]
    return np.column_stack(columns).astype(float)


@pytest.mark.parametrize("drop", [0.0, 0.3])
def test_fit_equals_lstsq(spark, drop):
    pdf = sample(drop=drop)
    models = regression.fit(spark.createDataFrame(pdf), model.FINAL, BY).collect()
    assert len(models) == 2
    for row in models:
        part = pdf[pdf.SECTION_CODE == row["SECTION_CODE"]]
        x, y = matrix(part), part.ITEM_COUNT.to_numpy()
        coef, rss, rank, _ = np.linalg.lstsq(x, y, rcond=None)
        assert row["rank"] == rank and row["nobs"] == len(y)
        np.testing.assert_allclose(row["coef"], coef, rtol=1e-7, atol=1e-7)
        sigma2 = rss[0] / (len(y) - rank)
        error = np.sqrt(sigma2 * np.diag(np.linalg.inv(x.T @ x)))
        np.testing.assert_allclose(row["std_error"], error, rtol=1e-7)
        n = len(y)
        assert row["aic"] == pytest.approx(n * (np.log(2 * np.pi * rss[0] / n) + 1) + 2 * (rank + 1))


def test_predicted_sums_equal_the_matrix_formula(spark):
    pdf = sample(seed=3)
    train, test = pdf[pdf.YEAR_MONTH <= 201536], pdf[pdf.YEAR_MONTH > 201536].copy()
    test["w"] = np.arange(len(test)) % 4 + 0.5
    models = regression.fit(spark.createDataFrame(train), model.FINAL, BY)
    found = regression.predict_sums(
        spark.createDataFrame(test), models, model.FINAL, BY, ["YEAR_MONTH"], F.col("w")
    ).collect()
    points = regression.predict(spark.createDataFrame(test), models, model.FINAL, BY).toPandas()
    assert len(found) == 24
    for row in found:
        part = train[train.SECTION_CODE == row["SECTION_CODE"]]
        x, y = matrix(part), part.ITEM_COUNT.to_numpy()
        coef, rss, rank, _ = np.linalg.lstsq(x, y, rcond=None)
        sigma2 = rss[0] / (len(y) - rank)
        rows = test[(test.SECTION_CODE == row["SECTION_CODE"]) & (test.YEAR_MONTH == row["YEAR_MONTH"])]
        xp, w = matrix(rows), rows.w.to_numpy()
        s = xp.T @ w
        var = sigma2 * s @ np.linalg.inv(x.T @ x) @ s
        assert row["mean"] == pytest.approx(w @ (xp @ coef), rel=1e-9)
        assert row["var"] == pytest.approx(var, rel=1e-7)
        noise = sigma2 * (w @ w)
        assert row["pi_half"][0] / row["ci_half"][0] == pytest.approx(np.sqrt((var + noise) / var), rel=1e-7)
        assert row["pi_half"][1] > row["pi_half"][0] > row["ci_half"][0]
        mine = points[(points.SECTION_CODE == row["SECTION_CODE"]) & (points.YEAR_MONTH == row["YEAR_MONTH"])]
        assert row["mean"] == pytest.approx((mine.fitted * mine.w).sum(), rel=1e-9)


def test_single_row_sum_is_its_point_prediction(spark):
    pdf = sample(seed=5)
    data = spark.createDataFrame(pdf)
    models = regression.fit(data, model.FINAL, BY)
    keys = ["YEAR_MONTH", "PDS_GENDER", "BAND_20YR"]
    single = regression.predict_sums(data, models, model.FINAL, BY, keys)
    points = regression.predict(data, models, model.FINAL, BY)
    joined = single.join(points, [*BY, *keys])
    assert joined.count() == len(pdf)
    assert joined.filter(F.abs(F.col("mean") - F.col("fitted")) > 1e-8).count() == 0


def test_month_flags_fit_like_the_factor(spark):
    from rxtally.operators.reshape import with_month_flags

    data = with_month_flags(spark.createDataFrame(sample()))
    fitted = regression.fit_many(data, {"factor": model.FINAL, "flags": model.FINAL_FLAGS}, BY)
    found = {(r["MODEL"], r["SECTION_CODE"]): r["aic"] for r in fitted.collect()}
    for section in ("0401", "0403"):
        assert found["factor", section] == pytest.approx(found["flags", section], rel=1e-12)


def test_diagnostics_match_the_hat_matrix(spark):
    pdf = sample(sections=("0401",), drop=0.2)
    data = spark.createDataFrame(pdf)
    models = regression.fit(data, model.FINAL, BY)
    found = regression.residual_diagnostics(data, models, model.FINAL, BY).toPandas()
    x, y = matrix(found), found.ITEM_COUNT.to_numpy()
    hat = x @ np.linalg.inv(x.T @ x) @ x.T
    h = np.diag(hat)
    residual = y - hat @ y
    sigma2 = residual @ residual / (len(y) - x.shape[1])
    np.testing.assert_allclose(found.leverage, h, rtol=1e-6)
    np.testing.assert_allclose(found.residual, residual, atol=1e-6)
    np.testing.assert_allclose(found.std_residual, residual / np.sqrt(sigma2 * (1 - h)), atol=1e-6)
    cooks = residual**2 * h / (x.shape[1] * sigma2 * (1 - h) ** 2)
    np.testing.assert_allclose(found.cooks_distance, cooks, atol=1e-8)


def test_aliased_terms_have_no_coefficient(spark):
    pdf = sample(sections=("0401",)).assign(TWICE=lambda d: 2 * d.MONTH_INDEX)
    formula = Formula("ITEM_COUNT", (Numeric("MONTH_INDEX"), Numeric("TWICE"), Categorical("PDS_GENDER")))
    row = regression.fit(spark.createDataFrame(pdf), formula, BY).first()
    coef = dict(zip(row["terms"], row["coef"], strict=True))
    assert coef["TWICE"] is None and coef["MONTH_INDEX"] is not None
    assert row["rank"] == 3


def test_combination_never_seen_is_aliased(spark):
    pdf = sample(sections=("0401",))
    pdf = pdf[~((pdf.PDS_GENDER == "M") & (pdf.BAND_20YR == "40-59"))]
    row = regression.fit(spark.createDataFrame(pdf), model.FINAL, BY).first()
    coef = dict(zip(row["terms"], row["coef"], strict=True))
    assert coef["PDS_GENDER[M]:BAND_20YR[40-59]"] is None
    assert row["rank"] == len(row["terms"]) - 1


def test_reference_level_is_the_first_of_each_group(spark):
    pdf = sample()
    pdf = pdf[~((pdf.SECTION_CODE == "0403") & (pdf.BAND_20YR == "00-19"))]
    formula = Formula("ITEM_COUNT", (Categorical("BAND_20YR"),))
    found = {r["SECTION_CODE"]: r["terms"] for r in regression.fit(spark.createDataFrame(pdf), formula, BY).collect()}
    assert found["0401"] == ["(Intercept)", "BAND_20YR[20-39]", "BAND_20YR[40-59]"]
    assert found["0403"] == ["(Intercept)", "BAND_20YR[40-59]"]


def test_rows_without_a_regressor_are_left_out_per_candidate(spark):
    pdf = sample(sections=("0401",))
    data = spark.createDataFrame(pdf).withColumn(
        "DISPENSING_DAYS", F.when(F.col("MONTH_INDEX") > 10, F.col("DISPENSING_DAYS"))
    )
    candidates = {
        "days": Formula("ITEM_COUNT", (Numeric("DISPENSING_DAYS"),)),
        "index": Formula("ITEM_COUNT", (Numeric("MONTH_INDEX"),)),
    }
    found = {r["MODEL"]: r for r in regression.fit_many(data, candidates, BY).collect()}
    assert found["days"]["nobs"] == (pdf.MONTH_INDEX > 10).sum()
    assert found["index"]["nobs"] == len(pdf)
    part = pdf[pdf.MONTH_INDEX > 10]
    slope = np.polyfit(part.DISPENSING_DAYS, part.ITEM_COUNT, 1)[0]
    assert found["days"]["coef"][1] == pytest.approx(slope, rel=1e-8)


def test_prediction_needs_its_regressors_and_known_levels(spark):
    pdf = sample(sections=("0401",))
    data = spark.createDataFrame(pdf)
    models = regression.fit(data, model.FINAL, BY)
    gap = data.withColumn("DISPENSING_DAYS", F.lit(None).cast("int"))
    with pytest.raises(Exception, match="missing regressor"):
        regression.monthly_expected(gap, models, model.FINAL).collect()
    new = data.withColumn("BAND_20YR", F.lit("never"))
    with pytest.raises(Exception, match="not seen in training"):
        regression.monthly_expected(new, models, model.FINAL).collect()
    with pytest.raises(Exception, match="not seen in training"):
        regression.predict(new, models, model.FINAL, BY).collect()


def test_many_rows_reduce_to_design_points(spark):
    """Only distinct regressor rows reach the pair step, however many rows there are."""
    data = spark.range(50_000).select(
        F.lit("0401").alias("SECTION_CODE"),
        (F.col("id") % 2).cast("string").alias("g"),
        (F.col("id") % 3).cast("string").alias("b"),
        (F.col("id") % 7).alias("ITEM_COUNT"),
    )
    formula = Formula("ITEM_COUNT", (Crossed("g", "b"),))
    row = regression.fit(data, formula, BY).first()
    assert row["nobs"] == 50_000 and row["rank"] == 6
    pdf = data.toPandas()
    cells = pdf.groupby(["g", "b"]).ITEM_COUNT.transform("mean")
    assert row["deviance"] == pytest.approx(((pdf.ITEM_COUNT - cells) ** 2).sum(), rel=1e-9)


@pytest.mark.parametrize("offset, shift", [(0.0, 0.0), (1e6, 0.0), (1e8, 0.0), (0.0, 1e6), (1e8, 1e6)])
def test_large_offsets_keep_their_digits(spark, offset, shift):
    """Residual sum and slope against a solver that works on the rows, with large responses and regressors."""
    draw = np.random.default_rng(4)
    x = shift + 0.1 * np.arange(60)
    y = offset + 2.5 * (x - shift) + draw.normal(size=60)
    rows = [("a", float(v), float(w), "k" if i % 3 else "m") for i, (v, w) in enumerate(zip(x, y, strict=True))]
    frame = spark.createDataFrame(rows, "g string, x double, y double, c string")
    found = regression.fit(frame, Formula("y", (Numeric("x"), Categorical("c"))), ["g"]).first()
    level = np.array([float(r[3] == "m") for r in rows])
    design = np.column_stack([np.ones(60), x - shift, level])
    expected, *_ = np.linalg.lstsq(design, y - offset, rcond=None)
    rss = float(((y - offset - design @ expected) ** 2).sum())
    coef = dict(zip(found["terms"], found["coef"], strict=True))
    assert found["rank"] == 3
    assert found["deviance"] == pytest.approx(rss, rel=1e-6)
    assert coef["x"] == pytest.approx(expected[1], rel=1e-6)


def test_many_effects(spark):
    """More effects than a machine word has bits."""
    names = [f"x{i}" for i in range(66)]
    draw = np.random.default_rng(5)
    values = draw.integers(0, 2, (90, 66))
    y = values @ np.arange(66.0) + 3
    rows = [("a", *map(str, v), float(w)) for v, w in zip(values.tolist(), y, strict=True)]
    frame = spark.createDataFrame(rows, "g string, " + ", ".join(f"{n} string" for n in names) + ", y double")
    found = regression.fit(frame, Formula("y", tuple(Categorical(n) for n in names)), ["g"]).first()
    coef = dict(zip(found["terms"], found["coef"], strict=True))
    assert coef["x65[1]"] == pytest.approx(65.0) and coef["(Intercept)"] == pytest.approx(3.0)


def test_numeric_regressors_are_no_grouping_key(spark):
    frame = spark.range(100).selectExpr("'a' g", "id * 0.5 x", "id * 1.5 y")
    plan = regression.gram_sums(frame, "y", [("x",)], ["x"], ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" in plan
    assert not any("x#" in part for part in plan.split("hashpartitioning(")[1:] for part in [part.split(")")[0]])


@pytest.mark.parametrize("scale", [1e-2, 1e-5])
def test_residuals_far_below_the_response(spark, scale):
    """R squared up to 1 - 1e-14 and beyond: the residual sum agrees with a solver that works on the rows."""
    draw = np.random.default_rng(8)
    x = np.arange(200.0)
    y = 1e6 + 3 * x + scale * draw.normal(size=200)
    rows = [(g, float(v), float(w) if g == "near" else float(5 * n)) for g in ("near", "far") for v, w, n in zip(x, y, draw.normal(size=200), strict=True)]
    frame = spark.createDataFrame(rows, "g string, x double, y double")
    found = {r["g"]: r for r in regression.fit(frame, Formula("y", (Numeric("x"),)), ["g"]).collect()}
    for group, row in found.items():
        own = np.array([r[1:] for r in rows if r[0] == group])
        design = np.column_stack([np.ones(200), own[:, 0] - own[:, 0].mean()])
        q, _ = np.linalg.qr(design)
        rest = own[:, 1] - own[:, 1].mean()
        rss = float(((rest - q @ (q.T @ rest)) ** 2).sum())
        assert row["deviance"] == pytest.approx(rss, rel=1e-6 if scale == 1e-2 else 1e-3)
        assert row["sigma2"] == pytest.approx(row["deviance"] / 198)
        assert row["aic"] == pytest.approx(200 * (np.log(2 * np.pi * row["deviance"] / 200) + 1) + 6)


def _plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def _items(spark, folder):
    frame = spark.range(2_000).selectExpr(
        "concat('s', id % 5) section", "id % 2 g", "id % 3 b", "cast(id % 11 as double) x", "cast(id % 7 as double) y", "id % 4 month"
    )
    frame.write.mode("overwrite").parquet(folder)
    return spark.read.parquet(folder)


def test_a_fit_reads_the_items_once(spark, tmp_path):
    items = _items(spark, str(tmp_path / "items"))
    effects = [("x",), ("g",), ("b",), ("g", "b")]
    plan = _plan(regression.gram_sums(items, "y", effects, ["x"], ["section"]))
    assert plan.count("FileScan") == 1 and "Join" not in plan
    below = plan[plan.rindex("Exchange"):]  # nearest to the scan
    assert below.count("HashAggregate") == 1, "items are added up before they are sent"


def test_diagnostics_and_sums_work_on_design_points(spark, tmp_path):
    items = _items(spark, str(tmp_path / "items"))
    formula = Formula("y", (Numeric("x"), Crossed("g", "b")))
    models = regression.fit(items, formula, ["section"])
    sums = _plan(regression.predict_sums(items, models, formula, ["section"], ["month"], F.col("y")))
    assert sums.count("Generate explode") >= 1
    scan = sums[sums.rindex("Generate explode"):]  # all that lies below the expansion
    assert "HashAggregate" in scan and "Exchange" in scan
    rows = _plan(regression.residual_diagnostics(items, models, formula, ["section"]))
    assert "cov_unscaled" not in rows and "known_terms" not in rows


def test_weighted_sums_with_numeric_and_missing_weights(spark):
    pdf = sample(seed=9)
    data = spark.createDataFrame(pdf)
    models = regression.fit(data, model.FINAL, BY)
    rows = data.withColumn("w", F.when(F.col("MONTH_NUM") != 3, F.col("DISPENSING_DAYS") / 7))
    found = regression.predict_sums(rows, models, model.FINAL, BY, ["PDS_GENDER"], F.col("w")).collect()
    points = regression.predict(rows, models, model.FINAL, BY).toPandas()
    assert len(found) == 4
    for row in found:
        own = points[(points.SECTION_CODE == row["SECTION_CODE"]) & (points.PDS_GENDER == row["PDS_GENDER"])]
        assert row["mean"] == pytest.approx((own.fitted * own.w).sum(), rel=1e-9)
