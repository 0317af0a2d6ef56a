"""Seasonal forecasts for many series at once.

The model of each series is an ARIMA with lagged regressors, estimated by the
least squares of Hannan and Rissanen (Biometrika, 1982): a long autoregression
gives innovations, a second regression uses their lags.  If asked for, the
errors of that model's own recursion, its MA part kept invertible, take the
place of the innovations for one more regression.  Differences, lags and
innovations are windows over blocks, the recursion is chained from block to
block; only summed cross products reach a solver.  Estimates are conditional,
so information criteria do not equal those of an exact-likelihood fit.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from functools import cached_property, reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.functions.calendar import key_safe
from isobar.operators.columns import last_n
from isobar.operators.grid import without_holes
from isobar.operators.leastsquares import dot, least_squares
from isobar.operators.metrics import regression_metrics, residual_stats
from isobar.operators.ordered import BLOCK, BLOCK_ROWS, HALO, Series, arrange, attach, largest_group
from isobar.operators.series import complete_rows, enough_rows, lag_columns, lagged, time_split
from isobar.staging import discard, stage

#: Roots of an MA part stay this far out, or its recursion would not forget where it began.
NEAREST_ROOT = 1.02
Z95 = 1.959963984540054  # standard normal quantile of a two-sided 95 % interval


def _lag_set(short: int, seasonal: int, period: int) -> list[int]:
    """Lags with a coefficient in the product of a short and a seasonal polynomial."""
    return sorted({i + period * j for i in range(short + 1) for j in range(seasonal + 1)} - {0})


@dataclass(frozen=True)
class Orders:
    """(p, d, q) x (P, D, Q, s), optionally with a constant; ``long`` sets the lags of the first-stage autoregression."""

    order: tuple[int, int, int] = (2, 1, 1)
    seasonal: tuple[int, int, int, int] = (1, 1, 1, 24)
    constant: bool = False
    long: int | None = None

    @cached_property
    def ar(self) -> list[int]:
        return _lag_set(self.order[0], self.seasonal[0], self.seasonal[3])

    @cached_property
    def ma(self) -> list[int]:
        return _lag_set(self.order[2], self.seasonal[2], self.seasonal[3])

    @cached_property
    def difference(self) -> np.ndarray:
        """Coefficients of (1-L)^d (1-L^s)^D by lag."""
        poly = np.array([1.0])
        for _ in range(self.order[1]):
            poly = np.convolve(poly, [1.0, -1.0])
        step = np.zeros(self.seasonal[3] + 1)
        if self.seasonal[1]:
            step[0], step[-1] = 1.0, -1.0
        for _ in range(self.seasonal[1]):
            poly = np.convolve(poly, step)
        return poly

    @cached_property
    def first_stage(self) -> int:
        """Lags of the first-stage autoregression; none are needed without MA terms.

        Two more seasons than the model itself spans: over-differenced series
        have MA roots near 1, which a shorter autoregression misses.
        """
        if self.ma and self.long is not None:
            return self.long
        return max([*self.ar, *self.ma, 4]) + 2 * self.seasonal[3] if self.ma else 0

    @property
    def memory(self) -> int:
        """Rows of the series that one prediction depends on."""
        return len(self.difference) - 1 + max(self.ar, default=0)

    @property
    def depth(self) -> int:
        """Rows before a row that its regression inputs depend on."""
        return len(self.difference) - 1 + max([*self.ar, self.first_stage]) + max(self.ma, default=0)

    def error_recurrence(self, coefficients) -> np.ndarray:
        """b with e_t = sum b_k e_{t-k} + (what the AR part, regressors and constant leave of w_t); no root of the MA part within 1.02.

        An MA part that is not invertible is shrunk, lag k by the k-th power of
        one factor, which moves its roots out and keeps its lags.
        """
        poly = np.zeros(max(self.ma, default=0) + 1)
        poly[0] = 1.0
        poly[self.ma] = np.asarray(coefficients, float)[len(self.ar) : len(self.ar) + len(self.ma)]
        roots = np.roots(np.trim_zeros(poly, "b")[::-1])
        nearest = float(np.abs(roots).min(initial=np.inf))
        if nearest < NEAREST_ROOT:
            poly *= (nearest / NEAREST_ROOT) ** np.arange(len(poly))
        return -poly[1:]

    def recurrence(self, ar: np.ndarray) -> np.ndarray:
        """a with y_t = sum a_k y_{t-k} + input, the AR and difference polynomials combined."""
        poly = np.zeros(max(self.ar, default=0) + 1)
        poly[0] = 1.0
        for lag, value in zip(self.ar, ar):
            poly[lag] = -value
        return -np.convolve(poly, self.difference)[1:]


@dataclass(frozen=True)
class Fitted:
    """Models of one specification, one row per series.

    The model without regressors is fitted on first use where there are
    regressors, since most uses never need it.
    """

    spec: Forecaster
    rows: DataFrame
    with_exog: DataFrame | None
    longest: int
    plain: DataFrame | None = None

    @cached_property
    def no_exog(self) -> DataFrame:
        return self.spec.estimate(self.rows, [], self.longest) if self.plain is None else self.plain


@dataclass(frozen=True)
class Forecaster:
    """One model specification for every series of ``keys`` along ``time``.

    ``unit`` ("hour", say) puts series on a regular grid of ``time`` before lags are
    taken, with lines through holes of the target and the regressors; without
    it rows are taken to follow each other regularly.  ``refine`` is how often
    MA terms are estimated again from the model's own errors: once for models
    whose MA part is all that shapes them; on over-differenced series, whose
    MA roots lie near 1, the two-stage fit forecasts better.
    """

    keys: list[str]
    time: list[str]
    target: str = "temperature"
    exog: tuple[str, ...] = ()
    exog_lags: int = 1
    orders: Orders = Orders()
    lag_exog: bool = True
    block_rows: int = BLOCK_ROWS
    unit: str | None = None
    refine: int = 0

    @property
    def refined(self) -> bool:
        return bool(self.orders.ma and self.refine)

    @property
    def regressors(self) -> list[str]:
        return lag_columns(list(self.exog), self.exog_lags) if self.lag_exog else list(self.exog)

    # ---- preparation -------------------------------------------------------

    # ``longest`` bounds the rows of a series: a caller that knows it saves a count in every step.

    def prepare(
        self, df: DataFrame, *, minimum: int = 200, minimum_complete: int = 100, longest: int | None = None
    ) -> DataFrame:
        """Series long enough, with lagged regressors and complete rows only."""
        out = enough_rows(df, self.keys, minimum)
        if self.unit:
            if len(self.time) != 1:
                raise ValueError("a regular grid needs one time column")
            used = [c for c in dict.fromkeys([self.target, *self.exog]) if c in out.columns]
            filled = without_holes(out.select(*self.keys, *self.time, *used), self.keys, self.time[0], used, unit=self.unit, block_rows=self.block_rows)
            out, longest = stage(filled, "grid"), None  # longer than the rows that were counted
        if self.exog and self.lag_exog:
            out = lagged(
                out, self.keys, self.time, list(self.exog), lags=self.exog_lags, block_rows=self.block_rows, longest=longest
            )
        return enough_rows(complete_rows(out), self.keys, minimum_complete)

    def split(self, prepared: DataFrame, test_size: float = 0.2, *, longest: int | None = None) -> DataFrame:
        return time_split(
            prepared, self.keys, self.time, test_size=test_size, block_rows=self.block_rows, longest=longest
        )

    # ---- estimation --------------------------------------------------------

    def _inputs(self, rows: DataFrame, regressors: list[str], longest: int) -> Series:
        """Differenced target ``__w`` with its past values, differenced regressors ``__x``, by block."""
        o = self.orders
        series = arrange(rows, self.keys, self.time, look_back=o.depth, block_rows=self.block_rows, longest=longest)
        along = series.window

        def differenced(name: str) -> Column:
            terms = [
                float(c) * (F.lag(name, k).over(along) if k else F.col(name)) for k, c in enumerate(o.difference) if c
            ]
            return reduce(lambda a, b: a + b, terms)

        frame = series.frame.withColumns(
            {"__w": differenced(self.target), "__x": F.array(*[differenced(r) for r in regressors]).cast("array<double>")}
        )
        reach = max([*o.ar, o.first_stage])
        past = F.collect_list("__w").over(along.rowsBetween(-reach, -1)) if reach else F.array().cast("array<double>")
        return series.with_frame(frame.withColumn("__past", past))

    def _training(self, series: Series) -> DataFrame:
        rows = series.frame
        if series.split:
            rows = rows.filter(~F.col(HALO))
        return rows.filter("is_train") if "is_train" in rows.columns else rows

    def _long_design(self, series: Series) -> Series:
        lags = self.orders.first_stage
        ready = (F.size("__past") >= lags) & ~F.exists("__x", lambda v: v.isNull())
        design = F.concat(F.reverse(F.slice("__past", -lags, lags)), F.col("__x"))
        return series.with_frame(series.frame.withColumn("__long", F.when(ready, design)))

    def _lags_of(self) -> Column:
        return F.array(*[F.get("__past", F.size("__past") - k) for k in self.orders.ar]).cast("array<double>")

    def _own_errors(self, series: Series, model: DataFrame, regressors: list[str]) -> DataFrame:
        """``(keys, time, __e)``: errors of a model's own recursion along the training rows, from zero at their beginning."""
        o, width = self.orders, len(regressors)
        rows = attach(self._training(series), model.select(*self.keys, F.col("coefficients").alias("__beta")), self.keys)
        parts = [F.slice("__beta", 1, len(o.ar)), F.slice("__beta", len(o.ar) + len(o.ma) + 1, width + (1 if o.constant else 0))]
        known = F.concat(self._lags_of(), F.col("__x"), *([F.array(F.lit(1.0))] if o.constant else []))
        left = F.col("__w") - (dot(known, F.concat(*parts)) if len(o.ar) + width + o.constant else F.lit(0.0))
        drive = F.when(~F.exists(known, lambda v: v.isNull()), left)
        block = F.col(BLOCK) if series.split else F.lit(0).cast("long")
        rows = rows.filter("__beta is not null")
        rows = rows.select(*self.keys, *self.time, F.lit(0.0).alias("actual"), block.alias("block"), F.coalesce(drive, F.lit(0.0)).alias("drive"))
        reach = max(o.ma)
        start = model.filter("coefficients is not null").select(*self.keys, F.array_repeat(F.lit(0.0), reach).alias("state"), "coefficients")
        errors = _follow(rows, start, self, series.split, o.error_recurrence, reach)
        return errors.select(*self.keys, *self.time, F.col("prediction").alias("__e"))

    def _with_innovations(self, series: Series, first_stage: DataFrame | None, errors: DataFrame | None = None) -> Series:
        """Add the second-stage design ``__z``: AR lags, lagged innovations, regressors.

        Innovations before the first full autoregression, and those of rows not
        trained on, are 0.  ``errors`` of the model's own recursion take their place.
        """
        o = self.orders
        frame, along = series.frame, series.window
        innovations = F.array().cast("array<double>")
        if errors is not None:
            frame = attach(frame, errors, [*self.keys, *self.time]).withColumn("__e", F.coalesce("__e", F.lit(0.0)))
            innovations = F.array(*[F.coalesce(F.lag("__e", k).over(along), F.lit(0.0)) for k in o.ma])
        elif o.ma:
            beta = first_stage.select(*self.keys, F.col("coefficients").alias("__beta"))
            frame = attach(self._long_design(series).frame, beta, self.keys)
            row = F.concat("__long", F.array(F.lit(1.0))) if o.constant else F.col("__long")
            trained = F.col("is_train") if "is_train" in frame.columns else F.lit(True)
            e = F.coalesce(F.when(trained, F.col("__w") - dot(row, F.col("__beta"))), F.lit(0.0))
            frame = frame.withColumn("__e", e).drop("__beta", "__long")
            innovations = F.array(*[F.coalesce(F.lag("__e", k).over(along), F.lit(0.0)) for k in o.ma])
        else:
            frame = frame.withColumn("__e", F.lit(0.0))
        frame = frame.withColumns({"__ar": self._lags_of(), "__ma": innovations})
        whole = F.concat("__ar", "__ma", "__x")
        return series.with_frame(frame.withColumn("__z", F.when(~F.exists(whole, lambda v: v.isNull()), whole)))

    def estimate(self, rows: DataFrame, regressors: list[str], longest: int) -> DataFrame:
        """All stages; each result is one small row per series, written once.

        A series with too few rows for the orders asked for keeps its row, with
        NULL coefficients; it takes no part in predictions.
        """
        o = self.orders
        series = self._inputs(rows, regressors, longest)
        first = None
        if o.ma:
            long_rows = self._training(self._long_design(series))
            first = stage(
                least_squares(
                    long_rows,
                    self.keys,
                    "__long",
                    "__w",
                    o.first_stage + len(regressors),
                    constant=o.constant,
                ),
                "first-stage",
            )
        second = self._training(self._with_innovations(series, first))
        width = len(o.ar) + len(o.ma) + len(regressors)
        model = least_squares(second, self.keys, "__z", "__w", width, constant=o.constant)
        before = None
        for _ in range(self.refine if o.ma else 0):
            before = stage(model.select(*self.keys, "coefficients"), "model")
            errors = stage(self._own_errors(series, before, regressors), "errors")
            third = self._training(self._with_innovations(series, None, errors))
            model = stage(least_squares(third, self.keys, "__z", "__w", width, constant=o.constant), "model")
            discard(errors)
        if before is not None:
            model = model.join(before.select(*self.keys, F.col("coefficients").alias("error_model")), self.keys)
        if first is not None:
            model = model.join(first.select(*self.keys, F.col("coefficients").alias("first_stage")), self.keys)
        else:
            model = model.withColumn("first_stage", F.lit(None).cast("array<double>"))
        return stage(model, "model")

    def fit(self, rows: DataFrame, *, longest: int | None = None) -> Fitted:
        """Fit every series, with its regressors and (when asked for) without.

        Only rows with ``is_train`` are used if ``rows`` has that column.
        """
        longest = largest_group(rows, self.keys) if longest is None else longest
        if not self.regressors:
            return Fitted(self, rows, None, longest, self.estimate(rows, [], longest))
        return Fitted(self, rows, self.estimate(rows, self.regressors, longest), longest)

    def parameter_names(self, exog: bool = True) -> list[str]:
        o = self.orders
        names = [f"ar.L{k}" for k in o.ar] + [f"ma.L{k}" for k in o.ma]
        return names + (self.regressors if exog else []) + (["intercept"] if o.constant else [])

    # ---- use of a fit ------------------------------------------------------

    def _choice(self, fitted: Fitted) -> tuple[list[str], DataFrame, str]:
        if fitted.with_exog is not None:
            return self.regressors, _solved(fitted.with_exog), "with_exog"
        return [], _solved(fitted.no_exog), "no_exog"

    def _design(self, rows: DataFrame, regressors: list[str], model: DataFrame, longest: int) -> Series:
        inputs = self._inputs(rows, regressors, longest)
        if self.refined:
            errors = self._own_errors(inputs, model.select(*self.keys, F.col("error_model").alias("coefficients")), regressors)
            return self._with_innovations(inputs, None, stage(errors, "errors"))
        return self._with_innovations(inputs, model.select(*self.keys, F.col("first_stage").alias("coefficients")))

    def residuals(self, fitted: Fitted) -> DataFrame:
        """In-sample one-step errors of the chosen model."""
        regressors, model, _ = self._choice(fitted)
        rows = self._training(self._design(fitted.rows, regressors, model, fitted.longest))
        row = F.concat("__z", F.array(F.lit(1.0))) if self.orders.constant else F.col("__z")
        rows = attach(rows, model.select(*self.keys, "coefficients"), self.keys)
        residual = F.col("__w") - dot(row, F.col("coefficients"))
        return rows.select(*self.keys, *self.time, residual.alias("residual")).filter(F.col("residual").isNotNull())

    def diagnostics(self, fitted: Fitted) -> DataFrame:
        """Fit statistics, parameters with p-values, and residual moments per series."""
        _, model, used = self._choice(fitted)
        names = F.array(*[F.lit(n) for n in self.parameter_names(used == "with_exog")])
        stats = residual_stats(self.residuals(fitted), "residual", self.keys).drop("n")
        stats = stats.withColumnsRenamed({c: f"resid_{c}" for c in ("mean", "std", "skew", "kurtosis")})
        return model.select(
            *self.keys,
            "aic",
            "bic",
            "llf",
            "sigma2",
            "n_obs",
            F.map_from_arrays(names, "coefficients").alias("params"),
            F.map_from_arrays(names, "p_values").alias("pvalues"),
        ).join(stats, self.keys)

    def test_predictions(self, fitted: Fitted) -> DataFrame:
        """Multi-step predictions of the rows after the training part.

        One row per test row, in place of per-series arrays, so a long series
        stays spread out.  Regressors of the test rows are known; innovations
        are 0 beyond the training part.
        """
        regressors, model, _ = self._choice(fitted)
        series, o = self._design(fitted.rows, regressors, model, fitted.longest), self.orders
        frame = series.frame if not series.split else series.frame.filter(~F.col(HALO))
        frame = attach(frame.filter(~F.col("is_train")), model.select(*self.keys, "coefficients"), self.keys)
        known = F.concat("__ma", "__x", F.array(F.lit(1.0))) if o.constant else F.concat("__ma", "__x")
        width = len(o.ma) + len(regressors) + (1 if o.constant else 0)
        drive = dot(known, F.slice("coefficients", len(o.ar) + 1, width)) if width else F.lit(0.0)
        rows = frame.select(
            *self.keys,
            *self.time,
            F.col(self.target).alias("actual"),
            (F.col(BLOCK) if series.split else F.lit(0).cast("long")).alias("block"),
            drive.alias("drive"),
        )
        history = last_n(fitted.rows.filter("is_train"), self.keys, self.time, max(o.memory, 1))
        start = history.groupBy(*self.keys).agg(
            F.sort_array(F.collect_list(F.struct(*self.time, F.col(self.target).alias("__y")))).alias("__h")
        )
        start = start.select(*self.keys, F.transform("__h", lambda r: r["__y"]).alias("state"))
        start = start.join(model.select(*self.keys, "coefficients"), self.keys)
        return _follow(rows, start, self, series.split)

    def evaluate(self, fitted: Fitted) -> DataFrame:
        """One row per series: errors on the test rows, fit statistics and sizes."""
        regressors, model, used = self._choice(fitted)
        scores = regression_metrics(self.test_predictions(fitted), keys=self.keys)
        sizes = fitted.rows.groupBy(*self.keys).agg(
            F.count_if("is_train").alias("train_size"), F.count_if(~F.col("is_train")).alias("test_size")
        )
        return (
            scores.drop("n")
            .join(model.select(*self.keys, "aic", "bic"), self.keys)
            .join(sizes, self.keys)
            .withColumns({"exog_features": F.lit(len(regressors)), "model_used": F.lit(used)})
        )

    def future_exog(self, rows: DataFrame, steps: int = 24, *, mode: str = "reference") -> DataFrame:
        """Regressors of the next ``steps`` rows from each series' last values.

        ``mode="reference"`` walks backwards through the buffer as the step
        grows and falls back to its last value; ``"hold_last"`` repeats the last
        value for times that are still unknown.  Moving means stay constant.
        """
        exog = list(self.exog)
        buffered = max(self.exog_lags, 6)
        tail = last_n(rows, self.keys, self.time, buffered)
        newest = tail.groupBy(*self.keys).agg(
            *[
                F.transform(
                    F.sort_array(F.collect_list(F.struct(*self.time, F.col(c).alias("__v")))), lambda r: r["__v"]
                ).alias(f"__{c}")
                for c in exog
            ]
        )
        step = newest.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))))

        def value(c: str, lag: int) -> Column:
            buffer, size = F.col(f"__{c}"), F.size(f"__{c}")
            back = F.col("step") + lag if mode == "reference" else F.greatest(F.lit(lag) - F.col("step"), F.lit(1))
            return F.element_at(buffer, -F.when(back <= size, back).otherwise(F.lit(1)))

        def mean(c: str, width: int) -> Column:
            buffer = F.col(f"__{c}")
            total = F.aggregate(F.slice(buffer, -width, width), F.lit(0.0), lambda a, v: a + v)
            return F.when(F.size(buffer) >= width, total / width)

        out = {}
        for c in exog:
            out |= {f"{c}_lag_{i}": value(c, i) for i in range(1, self.exog_lags + 1)}
            out |= {f"{c}_ma_{w}": mean(c, w) for w in (3, 6)}
        made = step.select(*self.keys, "step", *[v.alias(n) for n, v in out.items()])
        # What the buffer lacks is taken from the steps before, else after; at most ``steps`` rows per series.
        steps_before = Window.partitionBy(*self.keys).orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
        steps_after = Window.partitionBy(*self.keys).orderBy(F.col("step").desc()).rowsBetween(Window.unboundedPreceding, 0)
        filled = {n: F.coalesce(F.last(n, ignorenulls=True).over(steps_before), F.last(n, ignorenulls=True).over(steps_after)) for n in out}
        return made.withColumns(filled)

    def forecast(
        self, fitted: Fitted, steps: int = 24, *, future: DataFrame | None = None, mode: str = "reference"
    ) -> DataFrame:
        """The next ``steps`` values with a 95 % interval.

        A series whose regressor forecast is not finite, or that has no model
        with regressors, falls back to the model without; only such series are
        fitted for it.
        """
        if fitted.with_exog is None:
            plain = self._forecast(fitted.rows, [], _solved(fitted.no_exog), None, steps)
            return plain.withColumn("model_used", F.lit("no_exog"))
        if future is None:
            future = self.future_exog(fitted.rows, steps, mode=mode)
        full = self._forecast(fitted.rows, self.regressors, _solved(fitted.with_exog), future, steps)
        full = stage(full.withColumn("model_used", F.lit("with_exog")), "forecast")  # steps rows per series
        good = F.col("prediction").isNotNull() & ~F.isnan("prediction") & (F.abs("prediction") < float("inf"))
        usable = full.groupBy(*self.keys).agg(F.bool_and(good).alias("__good")).filter("__good").select(*self.keys)
        others = fitted.rows.select(*self.keys).distinct().join(usable, self.keys, "left_anti")
        if others.isEmpty():
            return full
        rows = fitted.rows.join(others, self.keys, "left_semi")
        model = fitted.plain if fitted.plain is not None else self.estimate(rows, [], fitted.longest)
        plain = self._forecast(rows, [], _solved(model), None, steps).withColumn("model_used", F.lit("no_exog"))
        return full.join(usable, self.keys, "left_semi").unionByName(plain)

    def _forecast(
        self, rows: DataFrame, regressors: list[str], model: DataFrame, future: DataFrame | None, steps: int
    ) -> DataFrame:
        o, schema_of = self.orders, rows.schema
        keep = max(o.memory, len(o.difference), max(o.ma, default=0), 1)
        # Only the end of each series matters: a fixed number of rows, whatever its length.
        near = keep + o.depth + (20 * max(o.ma) + 200 if self.refined else 0)  # the recursion has forgotten its beginning
        series = self._design(last_n(rows, self.keys, self.time, near), regressors, model, near)
        rows = series.rows().select(
            *self.keys, *self.time, F.col(self.target).alias("__y"), F.col("__e"), *regressors
        )
        tail = last_n(rows, self.keys, self.time, keep)  # a fixed number of rows per series
        tail = tail.join(model.select(*self.keys, "coefficients", "sigma2"), self.keys)
        if future is None:
            lone = F.sequence(F.lit(0), F.lit(steps - 1))
            future = model.select(*self.keys).withColumn("step", F.explode(lone))
        future = future.select(*self.keys, "step", *regressors)
        keys, time = self.keys, self.time
        schema = T.StructType(
            [
                *[schema_of[k] for k in keys],
                T.StructField("step", T.IntegerType()),
                *[T.StructField(c, T.DoubleType()) for c in ("prediction", "lower", "upper")],
            ]
        )

        def run(past: pd.DataFrame, ahead: pd.DataFrame) -> pd.DataFrame:
            if past.empty or ahead.empty:
                return pd.DataFrame()
            past, ahead = past.sort_values(time), ahead.sort_values("step")
            beta = np.asarray(past["coefficients"].iloc[0])
            ar, ma = beta[: len(o.ar)], beta[len(o.ar) : len(o.ar) + len(o.ma)]
            gamma = beta[len(o.ar) + len(o.ma) :][: len(regressors)]
            x = np.vstack([past[regressors].to_numpy(float), ahead[regressors].to_numpy(float)])
            h, n = len(ahead), len(past)
            drive = np.full(h, beta[-1] if o.constant else 0.0)
            for k, c in enumerate(o.difference):
                if regressors and c:
                    drive += c * (x[n - k : n - k + h] @ gamma)
            e = past["__e"].to_numpy(float)
            for value, lag in zip(ma, o.ma):
                known = min(lag, h)
                drive[:known] += value * e[n - lag :][:known]
            a = o.recurrence(ar)
            mean = _recur(a, past["__y"].to_numpy(float)[n - o.memory :], drive)
            psi = _psi(a, dict(zip(o.ma, ma)), h)
            half = Z95 * np.sqrt(past["sigma2"].iloc[0] * np.cumsum(psi**2))
            return pd.DataFrame(
                {
                    **{k: [past[k].iloc[0]] * h for k in keys},
                    "step": ahead["step"].to_numpy() + 1,
                    "prediction": mean,
                    "lower": mean - half,
                    "upper": mean + half,
                }
            )

        return _cogroup(tail, future, keys).applyInPandas(run, schema)

    # ---- persistence -------------------------------------------------------

    def save(self, fitted: Fitted, path: str, metrics: DataFrame | None = None, version: str = "1.0.0") -> None:
        """Both model tables under path-safe model names, and one row of metadata.

        ``metrics`` (such as ``evaluate``'s rows) is kept beside them.
        """
        key = F.concat_ws("_", *[key_safe(F.col(k).cast("string")) for k in self.keys])
        for label, model in (("exog", fitted.with_exog), ("no_exog", fitted.no_exog)):
            if model is not None:
                named = model.withColumn("model_name", F.concat(F.lit(f"temp_model_{label}_"), key))
                named.write.mode("overwrite").parquet(f"{path}/{label}")
        spark = fitted.no_exog.sparkSession
        o = self.orders
        meta = spark.range(1).select(
            F.array(*[F.lit(c) for c in self.exog]).cast("array<string>").alias("exog_columns"),
            F.array(*[F.lit(c) for c in self.regressors]).cast("array<string>").alias("regressors"),
            F.array(*[F.lit(v) for v in o.order]).alias("order"),
            F.array(*[F.lit(v) for v in o.seasonal]).alias("seasonal_order"),
            F.lit(o.constant).alias("constant"),
            F.lit(self.exog_lags).alias("exog_lags"),
            F.lit(self.lag_exog).alias("lag_exog"),
            F.lit(self.target).alias("target"),
            F.lit(self.refine).alias("refine"),
            F.array(*[F.lit(c) for c in self.keys]).cast("array<string>").alias("keys"),
            F.array(*[F.lit(c) for c in self.time]).cast("array<string>").alias("time"),
            F.lit(version).alias("version"),
            F.current_timestamp().alias("saved_at"),
        )
        if metrics is not None:
            metrics.write.mode("overwrite").parquet(f"{path}/metrics")
        meta.write.mode("overwrite").parquet(f"{path}/metadata")

    def load(self, spark: SparkSession, path: str, rows: DataFrame) -> Fitted:
        """Models written by ``save``, to be used on ``rows``."""
        meta = spark.read.parquet(f"{path}/metadata").first()
        spec = replace(
            self,
            exog=tuple(meta["exog_columns"]),
            exog_lags=meta["exog_lags"],
            lag_exog=meta["lag_exog"],
            target=meta["target"],
            refine=meta["refine"],
            keys=list(meta["keys"]),
            time=list(meta["time"]),
            orders=Orders(tuple(meta["order"]), tuple(meta["seasonal_order"]), meta["constant"]),
        )
        with_exog = spark.read.parquet(f"{path}/exog").drop("model_name") if spec.regressors else None
        no_exog = spark.read.parquet(f"{path}/no_exog").drop("model_name")
        return Fitted(spec, rows, with_exog, largest_group(rows, spec.keys), no_exog)


def _solved(model: DataFrame) -> DataFrame:
    """The series that have a model."""
    return model.filter(F.col("coefficients").isNotNull())


# ---- the recurrence y_t = sum a_k y_{t-k} + drive_t ---------------------------


def _steps(a: np.ndarray, states: np.ndarray, drives: np.ndarray) -> np.ndarray:
    """Paths of several runs side by side: one row per run, one numpy step per column."""
    k, (runs, length) = len(a), drives.shape
    path = np.empty((runs, k + length))
    path[:, :k] = states
    back = a[::-1]
    for t in range(length):
        path[:, k + t] = path[:, t : k + t] @ back + drives[:, t]
    return path[:, k:]


def _companion(a: np.ndarray) -> np.ndarray:
    step = np.eye(len(a), len(a), 1)
    if len(a):
        step[-1] = a[::-1]
    return step


def _recur(a: np.ndarray, state: np.ndarray, drive: np.ndarray, *, width: int | None = None) -> np.ndarray:
    """The path from ``state``; a long one is cut into pieces that run side by side.

    Each piece first runs from zero, the ends are chained through the power of
    the companion matrix, and all run again from their true states: about twice
    the square root of the rows in Python steps.
    """
    k, n = len(a), len(drive)
    width = max(k, math.isqrt(n)) if width is None else max(k, width)
    runs = n // width if n >= 400 and width else 0
    if runs < 2:
        return _steps(a, state[None, :], drive[None, :])[0]
    pieces = drive[: runs * width].reshape(runs, width)
    ends = _steps(a, np.zeros((runs, k)), pieces)[:, width - k :]
    jump = np.linalg.matrix_power(_companion(a), width)
    states = np.empty((runs + 1, k))
    states[0] = state
    for r in range(runs):
        states[r + 1] = jump @ states[r] + ends[r]
    done = _steps(a, states[:runs], pieces).ravel()
    return np.concatenate((done, _steps(a, states[runs:], drive[None, runs * width :])[0]))


def _psi(a: np.ndarray, ma: dict[int, float], steps: int) -> np.ndarray:
    """Effect of one innovation on the level 0, 1, ... steps later."""
    psi = np.zeros(steps)
    for j in range(steps):
        psi[j] = 1.0 if j == 0 else ma.get(j, 0.0)
        for i in range(1, min(j, len(a)) + 1):
            psi[j] += a[i - 1] * psi[j - i]
    return psi


def _last(values: np.ndarray, k: int, state: np.ndarray) -> np.ndarray:
    return np.concatenate([state, values])[-k:] if k else np.zeros(0)


def _cogroup(left: DataFrame, right: DataFrame, keys: list[str]):
    """Pair the groups of two frames; the right one is renamed onto itself as they may share lineage."""
    return left.groupBy(*keys).cogroup(right.toDF(*right.columns).groupBy(*keys))


def _follow(rows: DataFrame, start: DataFrame, spec: Forecaster, split: bool, recurrence=None, memory: int | None = None) -> DataFrame:
    """Run the recurrence (that of the series, or the given one of ``memory`` rows) along each series' rows, block by block.

    The recurrence is linear: a block's last state is a fixed matrix times its
    first state plus what the block's own drive adds.  So every block first runs
    from zero, the block ends are chained per series (one row per block), and
    every block then runs again from its true state.
    """
    keys, time, o = spec.keys, spec.time, spec.orders
    k = o.memory if memory is None else memory
    key_fields = [rows.schema[c] for c in keys]
    state_type = T.StructField("state", T.ArrayType(T.DoubleType()))
    model = start.select(*keys, "coefficients")

    if recurrence is None:

        def recurrence(coefficients) -> np.ndarray:
            return o.recurrence(np.asarray(coefficients)[: len(o.ar)])

    if split:
        rows = stage(rows, "drive")  # read three times below
        blocks = [*keys, "block"]

        def from_zero(pdf: pd.DataFrame, fit: pd.DataFrame) -> pd.DataFrame:
            if pdf.empty or fit.empty:
                return pd.DataFrame()
            drive = pdf.sort_values(time)["drive"].to_numpy(float)
            zero = np.zeros(k)
            end = _last(_recur(recurrence(fit["coefficients"].iloc[0]), zero, drive), k, zero)
            return pd.DataFrame(
                {**{c: [pdf[c].iloc[0]] for c in blocks}, "rows": [len(drive)], "state": [end.tolist()]}
            )

        def chain(ends: pd.DataFrame, begin: pd.DataFrame) -> pd.DataFrame:
            if ends.empty or begin.empty:
                return pd.DataFrame()
            a = recurrence(begin["coefficients"].iloc[0])
            companion = _companion(a)
            held = begin["state"].iloc[0]
            state, out = np.asarray(held, float)[len(held) - k :], []
            for _, row in ends.sort_values("block").iterrows():
                out.append({**{c: row[c] for c in blocks}, "state": state.tolist()})
                state = np.linalg.matrix_power(companion, int(row["rows"])) @ state + np.asarray(row["state"])
            return pd.DataFrame(out)

        block_type = T.StructField("block", T.LongType())
        per_block = rows.select(*blocks).distinct().join(model, keys)
        ended = T.StructType([*key_fields, block_type, T.StructField("rows", T.LongType()), state_type])
        ends = _cogroup(rows, per_block, blocks).applyInPandas(from_zero, ended)
        begun = T.StructType([*key_fields, block_type, state_type])
        states = _cogroup(ends, start, keys).applyInPandas(chain, begun).join(model, keys)
    else:
        blocks = keys
        states = start

    schema = T.StructType(
        [
            *key_fields,
            *[rows.schema[c] for c in time],
            T.StructField("actual", T.DoubleType()),
            T.StructField("prediction", T.DoubleType()),
        ]
    )

    def run(pdf: pd.DataFrame, begin: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty or begin.empty or len(begin["state"].iloc[0]) < k:
            return pd.DataFrame()
        pdf = pdf.sort_values(time)
        state = np.asarray(begin["state"].iloc[0], float)[len(begin["state"].iloc[0]) - k :]
        path = _recur(recurrence(begin["coefficients"].iloc[0]), state, pdf["drive"].to_numpy(float))
        return pdf[[*keys, *time, "actual"]].assign(prediction=path)

    return _cogroup(rows, states, blocks).applyInPandas(run, schema)


def single_series(
    time: list[str], target: str = "temperature", exog: tuple[str, ...] = (), orders: Orders | None = None
) -> Forecaster:
    """One series over the whole table: (1,1,1) with a constant unless told otherwise.

    Regressors are used as they are.  Rows need the constant key ``series``
    (see ``as_single_series``).
    """
    plain = Orders((1, 1, 1), (0, 0, 0, 0), constant=True)
    return Forecaster(["series"], time, target, tuple(exog), orders=orders or plain, lag_exog=False)


def as_single_series(df: DataFrame) -> DataFrame:
    return df.withColumn("series", F.lit("all"))

