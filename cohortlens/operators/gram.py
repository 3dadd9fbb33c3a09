"""Linear learners from sufficient statistics.

With z = (1, x, y) a row's contribution to any least-squares fit is z z'. Its sum over rows, the Gram
matrix of a part of the data, is all that fits and squared-error scores need:

* one partial and final aggregate gives the matrix of every fold (``collect_grams``): a task sums its
  rows in numpy and hands one entry list a fold to the shuffle, whatever its rows;
* training matrices of a fold are the total less the fold's own;
* every ridge penalty is solved from one eigenvalue decomposition, lasso by coordinate descent on the
  matrix, and the RMSE and R^2 of a part follow from its matrix, so a search over any number of
  penalties and folds reads the data once and starts no job per trial.

Values are shifted by the means of a few rows before they are multiplied (any constant gives the same
fit, a near one keeps the digits). The matrices are the only thing collected: (features + 2)^2 entries
a fold, at most ``MAX_FEATURES`` features. Rows with a null feature or label are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from cohortlens import constants as K

MAX_FEATURES = 2_000
SHIFT_ROWS = 100


@dataclass
class Gram:
    """Sum of z z' with z = (1, x - shift_x, y - shift_y)."""

    zz: np.ndarray
    shift: np.ndarray     # of (x, y)

    @property
    def n(self) -> float:
        return float(self.zz[0, 0])

    def __add__(self, other: "Gram") -> "Gram":
        return Gram(self.zz + other.zz, self.shift)

    def __sub__(self, other: "Gram") -> "Gram":
        return Gram(self.zz - other.zz, self.shift)

    def centred(self) -> tuple[np.ndarray, np.ndarray, float, np.ndarray]:
        """(S_xx, S_xy, S_yy, means of (x, y) less the shift)."""
        mean = self.zz[0, 1:] / max(self.n, 1.0)
        s = self.zz[1:, 1:] - self.n * np.outer(mean, mean)
        return s[:-1, :-1], s[:-1, -1], float(s[-1, -1]), mean

    def intercept(self, w: np.ndarray) -> float:
        mean = self.centred()[3] + self.shift
        return float(mean[-1] - mean[:-1] @ w)

    def ridge(self, penalties) -> np.ndarray:
        """One row of coefficients a penalty: S_xx + penalty I, solved from one decomposition.
        Directions without spread get no weight (the least-norm solution at penalty 0)."""
        sxx, sxy, _, _ = self.centred()
        values, vectors = np.linalg.eigh(sxx)
        floor = max(values.max(initial=0.0), 0.0) * len(values) * np.finfo(float).eps * 16
        along = np.where(values > floor, vectors.T @ sxy, 0.0)
        return np.array([vectors @ (along / np.where(values > floor, values + p, 1.0)) for p in penalties]).reshape(len(penalties), len(sxy))

    def linear(self) -> np.ndarray:
        return self.ridge([0.0])[0]

    def lasso(self, penalty: float, rounds: int = 10_000, tol: float = 1e-12) -> np.ndarray:
        """Half the mean square + penalty |w|, by coordinate descent on the matrix."""
        sxx, sxy, syy, _ = self.centred()
        w, left = np.zeros(len(sxy)), sxy.copy()
        for _ in range(rounds):
            moved = 0.0
            for j in np.flatnonzero(np.diag(sxx) > 0):
                rho = left[j] + sxx[j, j] * w[j]
                new = np.sign(rho) * max(abs(rho) - penalty * self.n, 0.0) / sxx[j, j]
                if new != w[j]:
                    left -= sxx[:, j] * (new - w[j])
                    moved = max(moved, abs(new - w[j]) * np.sqrt(sxx[j, j]))
                    w[j] = new
            if moved <= tol * np.sqrt(max(syy, 1e-300)):
                break
        return w

    def rss(self, w: np.ndarray, intercept: float) -> float:
        """Sum of squared errors of a linear model over this part's rows."""
        v = np.concatenate([[-(intercept + self.shift[:-1] @ w - self.shift[-1])], -w, [1.0]])
        return max(float(v @ self.zz @ v), 0.0)

    def scores(self, w: np.ndarray, intercept: float) -> tuple[float | None, float | None]:
        """RMSE and R^2 (null when the label is constant) of a linear model over this part's rows."""
        if not self.n:
            return None, None
        rss, tss = self.rss(w, intercept), self.centred()[2]
        return float(np.sqrt(rss / self.n)), (1 - rss / tss if tss > 0 else None)


def _partial(shift: np.ndarray):
    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(keys), -1)
            z = np.concatenate([np.ones((len(keys), 1)), x - shift], axis=1)
            for k in np.unique(keys):
                own = z[keys == k]
                sums[int(k)] = sums.get(int(k), 0) + own.T @ own
        i, j = np.triu_indices(len(shift) + 1)
        for k, s in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), k), pa.int64()), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(s[i, j])],
                names=["part", "i", "j", "s"])
    return run


def collect_grams(df: DataFrame, features: list[str] | str, label: str = K.TARGET, part: Column | None = None) -> dict[int, Gram]:
    """Gram matrix of every part (an integer expression; one part by default) in one aggregate.

    ``features`` names numeric columns, or one column of vectors or arrays."""
    if isinstance(features, str):
        x = F.col(features) if isinstance(df.schema[features].dataType, ArrayType) else vector_to_array(features)
    else:
        x = F.array(*[F.col(c).cast("double") for c in features])
    z = F.concat(x, F.array(F.col(label).cast("double")))
    rows = (df.select((F.lit(0) if part is None else part).cast("long").alias("part"), z.alias("z"))
            .where(F.col("part").isNotNull() & F.forall("z", lambda v: v.isNotNull())))
    near = [r.z for r in rows.select("z").limit(SHIFT_ROWS).collect()]
    if not near:
        return {}
    shift = np.mean(near, axis=0)
    if len(shift) - 1 > MAX_FEATURES:
        raise ValueError(f"{len(shift) - 1} features exceed {MAX_FEATURES}: fit by gradient instead")
    sums = rows.mapInArrow(_partial(shift), "part long, i int, j int, s double").groupBy("part", "i", "j").agg(F.sum("s").alias("s"))
    out: dict[int, Gram] = {}
    for r in sums.collect():  # (features + 2)^2 / 2 rows a part
        zz = out.setdefault(r.part, Gram(np.zeros((len(shift) + 1,) * 2), shift)).zz
        zz[r.i, r.j] = zz[r.j, r.i] = r.s
    return out


def total(grams: dict[int, Gram]) -> Gram:
    parts = list(grams.values())
    if not parts:
        raise ValueError("no complete rows to fit")
    out = parts[0]
    for g in parts[1:]:
        out = out + g
    return out


def solve(g: Gram, kind: str, penalty: float = 0.0) -> tuple[np.ndarray, float]:
    """Coefficients and intercept of 'linear', 'ridge' or 'lasso'."""
    w = g.lasso(penalty) if kind == "lasso" else g.ridge([0.0 if kind == "linear" else penalty])[0]
    return w, g.intercept(w)


def fold_rmse(train: list[Gram], valid: list[Gram], kind: str, penalty: float):
    """Validation RMSE fold by fold, one at a time (a pruner may stop in between)."""
    for tr, va in zip(train, valid):
        yield va.scores(*solve(tr, kind, penalty))[0]


def predictions(df: DataFrame, features: list[str], models: dict[int, tuple[np.ndarray, float]], label: str = K.TARGET,
                part: Column | None = None, keep: list[str] | None = None) -> DataFrame:
    """y_true and y_pred of every complete row under its part's model: one plan for all parts. The
    models (one a part) are literals of the plan."""
    key = (F.lit(0) if part is None else part).cast("int")
    pred = F.lit(None).cast("double")
    for k, (w, b) in models.items():
        value = F.lit(float(b))
        for c, x in zip(features, w):
            value = value + F.col(c).cast("double") * F.lit(float(x))
        pred = F.when(key == k, value).otherwise(pred)
    return (df.select(*(keep or []), F.col(label).cast("double").alias("y_true"), pred.alias("y_pred"))
            .where(F.col("y_true").isNotNull() & F.col("y_pred").isNotNull()))
