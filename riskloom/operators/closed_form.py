"""Classifiers fitted from sufficient statistics and applied as column expressions.

A fitted model is a handful of numbers per class; scoring is arithmetic in the
projection, so it is code-generated and never leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.scalars import quoted
from riskloom.operators.features import anova_scores, principal_axes
from riskloom.operators.moments import ByClass, Moments, all_but, class_moments, complete_rows, gaps, merge

SMOOTHING = 1e-9

# Names a model number as a column: a literal for one model, a column of the parameter
# table when every fold has its own model.
Value = Callable[[str], Column]


def _total(terms: list[Column]) -> Column:
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


@dataclass
class GaussianNaiveBayes:
    """Independent normal densities per class."""

    features: list[str]
    priors: dict[float, float]
    means: dict[float, np.ndarray]
    variances: dict[float, np.ndarray]

    @staticmethod
    def fit(stats: ByClass, features: list[str], smoothing: float = SMOOTHING) -> "GaussianNaiveBayes":
        n = sum(m.n for m in stats.values())
        extra = smoothing * merge(list(stats.values())).variance.max()
        return GaussianNaiveBayes(
            features,
            {c: m.n / n for c, m in stats.items()},
            {c: m.mean for c, m in stats.items()},
            {c: m.variance + extra for c, m in stats.items()},
        )

    def numbers(self) -> dict[str, float]:
        out = {}
        for c, prior in self.priors.items():
            mean, var = self.means[c], self.variances[c]
            out[f"constant_{c:g}"] = np.log(prior) - 0.5 * np.log(2 * np.pi * var).sum()
            out.update({f"mean_{c:g}_{j}": m for j, m in enumerate(mean)})
            out.update({f"scale_{c:g}_{j}": -0.5 / v for j, v in enumerate(var)})
        return out

    def inputs(self, value: Value) -> list[Column]:
        return [quoted(c).cast("double") for c in self.features]

    def scores(self, inputs: list[Column], value: Value) -> dict[float, Column]:
        out = {}
        for c in self.priors:
            terms = [value(f"constant_{c:g}")]
            for j, x in enumerate(inputs):
                gap = x - value(f"mean_{c:g}_{j}")
                terms.append(gap * gap * value(f"scale_{c:g}_{j}"))
            out[c] = _total(terms)
        return out

    def to_table(self, spark: SparkSession) -> DataFrame:
        rows = [
            (c, f, float(self.priors[c]), float(m), float(v))
            for c in self.priors
            for f, m, v in zip(self.features, self.means[c], self.variances[c])
        ]
        return spark.createDataFrame(
            rows, "label double, feature string, prior double, mean double, variance double"
        ).withColumn("position", F.array_position(F.lit(self.features), F.col("feature")))

    @staticmethod
    def from_table(df: DataFrame) -> "GaussianNaiveBayes":
        rows = df.orderBy("label", "position").collect()
        classes = list(dict.fromkeys(r["label"] for r in rows))
        of = lambda c, name: [r[name] for r in rows if r["label"] == c]
        return GaussianNaiveBayes(
            of(classes[0], "feature"),
            {c: of(c, "prior")[0] for c in classes},
            {c: np.array(of(c, "mean")) for c in classes},
            {c: np.array(of(c, "variance")) for c in classes},
        )


@dataclass
class LinearDiscriminant:
    """Normal densities with one shared covariance matrix."""

    features: list[str]
    weights: dict[float, np.ndarray]
    constants: dict[float, float]

    @staticmethod
    def fit(stats: ByClass, features: list[str]) -> "LinearDiscriminant":
        n = sum(m.n for m in stats.values())
        within = sum(m.scatter for m in stats.values()) / (n - len(stats))
        # Constant or collinear indicators make the matrix singular.
        inverse = np.linalg.pinv(within, rcond=1e-10, hermitian=True)
        weights = {c: inverse @ m.mean for c, m in stats.items()}
        constants = {
            c: float(-0.5 * m.mean @ weights[c] + np.log(m.n / n)) for c, m in stats.items()
        }
        return LinearDiscriminant(features, weights, constants)

    def numbers(self) -> dict[str, float]:
        out = {f"constant_{c:g}": k for c, k in self.constants.items()}
        for c, weights in self.weights.items():
            out.update({f"weight_{c:g}_{j}": w for j, w in enumerate(weights)})
        return out

    def inputs(self, value: Value) -> list[Column]:
        return [quoted(c).cast("double") for c in self.features]

    def scores(self, inputs: list[Column], value: Value) -> dict[float, Column]:
        return {
            c: _total(
                [value(f"constant_{c:g}")] + [x * value(f"weight_{c:g}_{j}") for j, x in enumerate(inputs)]
            )
            for c in self.weights
        }


@dataclass
class UnionBayes:
    """Two principal axes beside the k best features by F score, then naive Bayes on them.

    Class means and variances of a projection follow from the class scatter matrix, so
    this pipeline too is fitted from the statistics alone.
    """

    features: list[str]
    block: np.ndarray
    offset: np.ndarray
    bayes: GaussianNaiveBayes

    @staticmethod
    def fit(stats: ByClass, features: list[str], components: int = 2, k: int = 6) -> "UnionBayes":
        pooled = merge(list(stats.values()))
        axes, _ = principal_axes(pooled, components)
        best = np.argsort(-anova_scores(stats), kind="stable")[:k]
        chosen = sorted(int(i) for i in best)
        block = np.vstack([axes, np.eye(len(features))[chosen]])
        offset = np.concatenate([axes @ pooled.mean, np.zeros(len(chosen))])
        projected = {
            c: Moments(m.n, block @ m.mean - offset, block @ m.scatter @ block.T) for c, m in stats.items()
        }
        names = [f"pca_{i}" for i in range(components)] + [features[i] for i in chosen]
        return UnionBayes(features, block, offset, GaussianNaiveBayes.fit(projected, names))

    def numbers(self) -> dict[str, float]:
        out = {f"offset_{i}": -o for i, o in enumerate(self.offset)}
        for i, row in enumerate(self.block):
            out.update({f"block_{i}_{j}": w for j, w in enumerate(row)})
        return {**out, **self.bayes.numbers()}

    def inputs(self, value: Value) -> list[Column]:
        columns = [quoted(c).cast("double") for c in self.features]
        return [
            _total([value(f"offset_{i}")] + [x * value(f"block_{i}_{j}") for j, x in enumerate(columns)])
            for i in range(len(self.block))
        ]

    def scores(self, inputs: list[Column], value: Value) -> dict[float, Column]:
        return self.bayes.scores(inputs, value)


def needs_products(fitter) -> bool:
    """Naive Bayes looks at variances only."""
    return fitter is not GaussianNaiveBayes.fit


FITTERS = {"NB": GaussianNaiveBayes.fit, "LDA": LinearDiscriminant.fit, "UNION": UnionBayes.fit}


def _apply(df: DataFrame, model, value: Value, positive: float) -> DataFrame:
    """Add ``prediction`` (lowest class on ties) and the positive class's ``probability``.

    Inputs and scores are projected one after the other: each is used several times.
    """
    inputs = model.inputs(value)
    staged = df.withColumns({f"_z{j}": z for j, z in enumerate(inputs)})
    scores = model.scores([F.col(f"_z{j}") for j in range(len(inputs))], value)
    classes = sorted(scores)
    staged = staged.withColumns({f"_s{i}": scores[c] for i, c in enumerate(classes)})
    named = {c: F.col(f"_s{i}") for i, c in enumerate(classes)}
    best = F.greatest(*named.values()) if len(classes) > 1 else named[classes[0]]
    prediction = F.when(F.lit(False), F.lit(0.0))
    for c in classes:
        prediction = prediction.when(named[c] == best, F.lit(float(c)))
    probability = F.lit(0.0)
    if positive in named:
        probability = 1 / _total([F.exp(named[c] - named[positive]) for c in classes])
    return staged.select(*[quoted(c) for c in df.columns], prediction.alias("prediction"), probability.alias("probability"))


def predict(df: DataFrame, model, positive: float = 1.0) -> DataFrame:
    numbers = model.numbers()
    return _apply(complete_rows(df, model.features), model, lambda name: F.lit(float(numbers[name])), positive)


def predict_every(df: DataFrame, model, positive: float = 1.0) -> DataFrame:
    """``predict`` that keeps all rows and columns and adds ``unscored``.

    A row that lacks features has a NULL prediction and probability, and ``unscored``
    names them; it is NULL for the others.
    """
    numbers = model.numbers()
    lacking = F.concat_ws(",", F.array_compact(F.array(*[F.when(g, F.lit(c)) for c, g in gaps(df, model.features).items()])))
    marked = df.withColumn("unscored", F.nullif(lacking, F.lit("")))
    scored = _apply(marked, model, lambda name: F.lit(float(numbers[name])), positive)
    whole = F.col("unscored").isNull()
    return scored.withColumns({c: F.when(whole, F.col(c)) for c in ("prediction", "probability")})


def fit(df: DataFrame, fitter, features: list[str]):
    """Fit on all rows of ``df`` (with a ``label`` column) from one statistics pass."""
    moments = class_moments(df, features, products=needs_products(fitter))
    return fitter(all_but(moments, None), features)


def cross_predict(
    df: DataFrame,
    fitter,
    features: list[str],
    fold: str = "fold",
    positive: float = 1.0,
    moments: dict[int, ByClass] | None = None,
    models: dict[int, object] | None = None,
) -> DataFrame:
    """Out-of-fold predictions: every row is scored by the model fitted without its fold.

    One statistics pass fits all folds. Their numbers form a parameter table with one
    row per fold, which is all that is broadcast; one scoring pass then applies the
    same expression to every row with its fold's numbers. Several models can share
    the statistics by passing ``moments``; models that are already fitted come as ``models``.
    """
    if models is None:
        moments = moments or class_moments(df, features, fold, needs_products(fitter))
        models = {f: fitter(all_but(moments, f), features) for f in sorted(moments)}
    numbers = {f: {n: float(x) for n, x in model.numbers().items()} for f, model in models.items()}
    # The model with the most classes names all numbers; a class that a fold's training
    # rows lack gets an impossible score there.
    widest = max(numbers, key=lambda f: len(numbers[f]))
    names = list(numbers[widest])
    rows = [
        (f, *[numbers[f].get(n, -1e300 if n.startswith("constant") else 0.0) for n in names]) for f in sorted(numbers)
    ]
    schema = "fold int, " + ", ".join(f"`p_{n}` double" for n in names)
    parameters = df.sparkSession.createDataFrame(rows, schema).withColumnRenamed("fold", "_fold")
    joined = complete_rows(df, features).join(
        F.broadcast(parameters), quoted(fold) == F.col("_fold")
    )
    scored = _apply(joined, models[widest], lambda name: F.col(f"p_{name}"), positive)
    return scored.select(*[quoted(c) for c in df.columns], "prediction", "probability")
