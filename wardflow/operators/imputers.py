"""Chained-equation imputers as estimators: fitted on one table, applied to any.

``ChainedLinear`` regresses every column on the others in rounds.  An imputed
value is at every moment an affine function of the row's observed values, and
the same one for all rows with the same columns missing.  So the fit reads the
table twice (means, then one moment matrix per missingness pattern, at most
``2**p`` rows) and runs all rounds on those matrices; the result is one affine
fill per pattern, and a transform is one projection without any iteration.

``ChainedForest`` does the same with random forests, which have no such short
form: each round fits MLlib forests on the rows that observe a column, and the
model keeps the forests of all rounds, to be replayed on other tables.

Both are ``pyspark.ml`` estimators (usable in a ``Pipeline``).  Cells start at
the training mean; columns are visited from the least to the most often
missing one; observed cells never change.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.sources.io import write_scratch

#: columns up to which all missingness patterns are tabulated
MAX_COLS = 12


def pattern(cols: list[str]) -> Column:
    """Missingness pattern of a row: bit i is set where column i is null."""
    return sum([F.col(c).isNull().cast("int") * (1 << i) for i, c in enumerate(cols)], F.lit(0))


def least_squares(s: np.ndarray, xy: np.ndarray, yy: float, n: float) -> np.ndarray:
    """Coefficients from centred moments."""
    return np.linalg.lstsq(s, xy, rcond=None)[0]


def evidence_ridge(s: np.ndarray, xy: np.ndarray, yy: float, n: float, rounds: int = 300, tol: float = 1e-3) -> np.ndarray:
    """Ridge coefficients whose noise and weight precision maximise the
    evidence (MacKay's fixed point, gamma priors of 1e-6), from centred
    moments ``s = X'X``, ``xy = X'y``, ``yy = y'y`` of ``n`` rows."""
    prior = 1e-6
    w, v = np.linalg.eigh(s)
    w = np.maximum(w, 0.0)
    noise, weight = 1.0 / (yy / n + np.finfo(float).eps), 1.0

    def solve() -> np.ndarray:
        return v @ ((v.T @ xy) / (w + weight / noise))

    old = None
    for _ in range(rounds):
        b = solve()
        rest = max(yy - 2 * b @ xy + b @ s @ b, 0.0)
        used = float(np.sum(noise * w / (weight + noise * w)))
        weight = (used + 2 * prior) / (b @ b + 2 * prior)
        noise = (n - used + 2 * prior) / (rest + 2 * prior)
        if old is not None and np.abs(old - b).sum() < tol:
            break
        old = b
    return solve()


REGRESSIONS = {"evidence": evidence_ridge, "ols": least_squares}


class ChainedLinear(Estimator):
    """Chained linear regressions (``regression``: ``evidence`` ridge or
    ``ols``), at most ``max_rounds`` rounds, fewer when no imputed value can
    have changed by more than ``tol`` times the largest absolute value."""

    def __init__(self, cols: list[str], max_rounds: int = 30, tol: float = 1e-3, regression: str = "evidence"):
        super().__init__()
        if len(cols) > MAX_COLS:
            raise ValueError(f"at most {MAX_COLS} columns")
        self.cols, self.max_rounds, self.tol, self.regress = list(cols), max_rounds, tol, REGRESSIONS[regression]

    def _moments(self, df: DataFrame, mean: np.ndarray) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
        """Per pattern: moment matrix of (1, centred values, 0 where missing),
        and the largest absolute centred values."""
        p = len(self.cols)
        x = [F.lit(1.0), *[F.coalesce(F.col(c) - F.lit(float(m)), F.lit(0.0)) for c, m in zip(self.cols, mean)]]
        sums = [F.sum(x[i] * x[j]).alias(f"s{i}_{j}") for i in range(p + 1) for j in range(i, p + 1)]
        rows = df.groupBy(pattern(self.cols).alias("pattern")).agg(*sums, *[F.max(F.abs(x[i + 1])).alias(f"a{i}") for i in range(p)]).collect()
        out = {}
        for r in rows:                                   # at most 2**p rows
            m = np.zeros((p + 1, p + 1))
            for i in range(p + 1):
                for j in range(i, p + 1):
                    m[i, j] = m[j, i] = r[f"s{i}_{j}"]
            out[r["pattern"]] = (m, np.array([r[f"a{i}"] for i in range(p)]))
        return out

    def _fit(self, df: DataFrame) -> ChainedLinearModel:
        p = len(self.cols)
        basics = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(self.cols)], *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(self.cols)]).first()
        mean = np.array([basics[f"m{i}"] or 0.0 for i in range(p)])
        moments = self._moments(df, mean)
        order = sorted(range(p), key=lambda i: (basics[f"n{i}"] or 0, i))
        fills = {k: start(k, p) for k in moments}
        largest = np.max([a for _, a in moments.values()], axis=0) if moments else np.zeros(p)
        limit = self.tol * float(np.max(np.abs(largest + np.abs(mean)), initial=0.0))
        steps, changes = [], []
        for _ in range(self.max_rounds if moments else 0):
            before = {k: f.copy() for k, f in fills.items()}
            for c in order:
                b = self._regress(c, fills, moments)
                steps.append((c, b))
                update(fills, c, b)
            changes.append(max(float(np.max(np.abs(fills[k] - before[k]) @ np.concatenate([[1.0], moments[k][1]]))) for k in fills))
            if changes[-1] <= limit:
                break
        return ChainedLinearModel(self.cols, mean, steps, changes, bool(changes and changes[-1] <= limit))

    def _regress(self, c: int, fills: dict[int, np.ndarray], moments: dict) -> np.ndarray:
        """Intercept and coefficients (0 for ``c`` itself) over the rows that
        observe ``c``, with their other missing cells as filled so far."""
        p = len(self.cols)
        m = np.zeros((p + 1, p + 1))
        for k, f in fills.items():
            if not k >> c & 1:
                row = np.vstack([np.eye(1, p + 1), f])
                m += row @ moments[k][0] @ row.T
        out = np.zeros(p + 1)
        others = [i + 1 for i in range(p) if i != c]
        n = m[0, 0]
        if n > 0:
            mu = m[0] / n
            s = m - n * np.outer(mu, mu)
            if others:
                out[others] = self.regress(s[np.ix_(others, others)], s[others, c + 1], s[c + 1, c + 1], n)
            out[0] = mu[c + 1] - out[1:] @ mu[1:]
        return out


def start(k: int, p: int) -> np.ndarray:
    """Affine map of pattern ``k`` before the first round: observed cells
    themselves, missing ones 0 (the mean, as values are centred)."""
    f = np.zeros((p, p + 1))
    for i in range(p):
        if not k >> i & 1:
            f[i, i + 1] = 1.0
    return f


def update(fills: dict[int, np.ndarray], c: int, b: np.ndarray) -> None:
    """Column ``c`` predicted anew in every pattern that misses it."""
    for k, f in fills.items():
        if k >> c & 1:
            f[c] = b[1:] @ f
            f[c, 0] += b[0]


class ChainedLinearModel(Model):
    """``steps``: (column, coefficients) in the order of the rounds;
    ``changes``: bound on the largest change of a cell per round;
    ``converged`` tells whether the last one was small enough."""

    def __init__(self, cols: list[str], mean: np.ndarray, steps: list, changes: list[float], converged: bool):
        super().__init__()
        self.cols, self.mean, self.steps, self.changes, self.converged = cols, mean, steps, changes, converged

    @property
    def rounds(self) -> int:
        return len(self.changes)

    def fills(self) -> dict[int, np.ndarray]:
        """Affine maps of all patterns, in the columns' own units."""
        p = len(self.cols)
        out = {k: start(k, p) for k in range(1 << p)}
        for c, b in self.steps:
            update(out, c, b)
        for f in out.values():
            f[:, 0] += self.mean
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        p = len(self.cols)
        x = [F.coalesce(F.col(c) - F.lit(float(m)), F.lit(0.0)) for c, m in zip(self.cols, self.mean)]
        table = F.array(*[F.array(*map(F.lit, map(float, f.ravel()))) for _, f in sorted(self.fills().items())]) if p <= 4 else None
        d = df.withColumn("_pattern", pattern(self.cols))
        if table is not None:
            d = d.withColumn("_fill", F.get(table, F.col("_pattern")))
        else:
            rows = df.sparkSession.createDataFrame([(k, f.ravel().tolist()) for k, f in self.fills().items()], "_p int, _fill array<double>")
            d = d.join(F.broadcast(rows), F.col("_pattern") == F.col("_p")).drop("_p")      # 2**p rows, p <= MAX_COLS
        out = {}
        for i, c in enumerate(self.cols):
            fill = sum([F.get("_fill", F.lit(i * (p + 1) + 1 + j)) * v for j, v in enumerate(x)], F.get("_fill", F.lit(i * (p + 1))))
            out[c] = F.coalesce(F.col(c).cast("double"), fill)
        return d.withColumns(out).drop("_pattern", "_fill")


class ChainedForest(Estimator):
    """Chained random forests.  Rounds end when the relative change of the
    imputed cells (sum of squared changes over sum of squares) grows, and the
    round before is kept, or after ``max_rounds``.  Each round is written to
    the shared folder, so lineage stays short and a lost executor repeats one
    round at most."""

    def __init__(self, cols: list[str], max_rounds: int = 10, trees: int = 20, depth: int = 5, seed: int = 42):
        super().__init__()
        self.cols, self.max_rounds, self.trees, self.depth, self.seed = list(cols), max_rounds, trees, depth, seed

    def _fit(self, df: DataFrame) -> ChainedForestModel:
        cols = self.cols
        basics = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)], *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)],
                        F.count(F.lit(1)).alias("n")).first()
        mean = [basics[f"m{i}"] or 0.0 for i in range(len(cols))]
        order = [c for _, c in sorted((basics[f"n{i}"], c) for i, c in enumerate(cols)) if basics["n"] and basics[f"n{cols.index(c)}"] < basics["n"]]
        cur = write_scratch(begin(df.select(*cols), cols, mean), "forest")
        rounds, changes = [], []
        for _ in range(self.max_rounds if basics["n"] else 0):
            models, new = [], cur
            for c in order:
                others = VectorAssembler(inputCols=[o for o in cols if o != c], outputCol="_f")
                forest = RandomForestRegressor(featuresCol="_f", labelCol=c, predictionCol="_p", numTrees=self.trees, maxDepth=self.depth, seed=self.seed)
                models.append((c, forest.fit(others.transform(new.filter(~F.col(f"_miss_{c}"))))))
                new = replay(new, cols, [models[-1:]])
            keep = {c: F.col(c).alias(f"_old_{c}") for c in cols}
            new = write_scratch(replay(cur.select("*", *keep.values()), cols, [models]), "forest")
            gap = [F.sum(F.when(F.col(f"_miss_{c}"), F.pow(F.col(c) - F.col(f"_old_{c}"), 2.0))) for c in cols]
            size = [F.sum(F.when(F.col(f"_miss_{c}"), F.pow(F.col(c), 2.0))) for c in cols]
            change = new.agg((sum([F.coalesce(g, F.lit(0.0)) for g in gap], F.lit(0.0)) /
                              F.greatest(sum([F.coalesce(s, F.lit(0.0)) for s in size], F.lit(0.0)), F.lit(1e-300))).alias("x")).first()[0]
            if changes and change > changes[-1]:
                break
            rounds.append(models)
            changes.append(change)
            cur = new.drop(*[f"_old_{c}" for c in cols])
            if change == 0:
                break
        return ChainedForestModel(cols, mean, rounds, changes, len(changes) < self.max_rounds)


def begin(df: DataFrame, cols: list[str], mean: list[float]) -> DataFrame:
    """Flags of missing cells, and those cells at the mean."""
    return df.withColumns({**{f"_miss_{c}": F.col(c).isNull() for c in cols},
                           **{c: F.coalesce(F.col(c).cast("double"), F.lit(float(m))) for c, m in zip(cols, mean)}})


def replay(df: DataFrame, cols: list[str], rounds: list) -> DataFrame:
    for models in rounds:
        for c, model in models:
            x = VectorAssembler(inputCols=[o for o in cols if o != c], outputCol="_f").transform(df)
            df = model.transform(x).withColumn(c, F.when(F.col(f"_miss_{c}"), F.col("_p")).otherwise(F.col(c))).drop("_f", "_p")
    return df


class ChainedForestModel(Model):
    """Forests of every kept round, the relative change of each, and whether
    the change stopped shrinking within the allowed rounds."""

    def __init__(self, cols: list[str], mean: list[float], steps: list, changes: list[float], converged: bool):
        super().__init__()
        self.cols, self.mean, self.steps, self.changes, self.converged = cols, mean, steps, changes, converged

    @property
    def rounds(self) -> int:
        return len(self.steps)

    def _transform(self, df: DataFrame) -> DataFrame:
        return replay(begin(df, self.cols, self.mean), self.cols, self.steps).drop(*[f"_miss_{c}" for c in self.cols])
