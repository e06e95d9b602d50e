"""Feature and drift specifications (small frozen config objects)."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class FeatureSpec:
    """Column roles of a tabular data set."""

    num: tuple[str, ...]
    cat: tuple[str, ...] = ()
    label: str | None = None
    key: str | None = None

    @property
    def columns(self) -> list[str]:
        cols = list(self.num) + list(self.cat)
        if self.label:
            cols.append(self.label)
        return cols


class FeatureNames:
    """The columns that the feature stages read and add."""

    def __init__(self, spec: FeatureSpec):
        self.num, self.cat = list(spec.num), list(spec.cat)
        self.filled = [f"{name}_imp" for name in self.num]
        self.indexed = [f"{name}_idx" for name in self.cat]
        self.slots = [f"{name}_oh" for name in self.cat]


@dataclass(frozen=True)
class DriftSpec:
    """PSI settings.

    ``levels``: ``"exact"`` uses k/n quantile levels, ``"linspace"`` uses
    k*(1/n) (the float-noisy spelling of an evenly spaced grid),
    ``"percent"`` uses (k*(100/n))/100.
    ``expected``: ``"empirical"`` compares with the baseline's stored bin
    shares, ``"uniform"`` assumes 1/bins per bin (wrong under tied edges, kept
    for compatibility).
    """

    features: tuple[str, ...]
    n_bins: int = 10
    warn: float | None = 0.10
    alert: float = 0.25
    eps: float = 1e-12
    levels: str = "exact"
    expected: str = "empirical"
    quantile_method: str = "exact"


# Default PSI settings (warn level, alert level, epsilon,
# floor for empty shares in the raw-sample formula, closing offset of the last
# breakpoint in the raw-sample formula).
DEFAULT_WARN = 0.10
DEFAULT_ALERT = 0.25
PSI_EPS = 1e-12
RAW_SHARE_FLOOR = 1e-6
RAW_LAST_EDGE_PAD = 1e-6

# The synthetic drifted batch (rows sampled, sampling seed,
# shift added to one column, factor applied to another).
DRIFT_BATCH_ROWS = 300
DRIFT_BATCH_SEED = 123
DRIFT_BATCH_SHIFT = 8.0
DRIFT_BATCH_SCALE = 1.5


# Example configuration: the 12-column passenger table the reference trains
# on (declared instead of inferred; the label is absent in scoring files).
PASSENGER_SPEC = FeatureSpec(num=("Age", "SibSp", "Parch", "Fare"), cat=("Sex", "Embarked", "Pclass"),
                             label="Survived", key="PassengerId")
PASSENGER_COLUMNS = (
    ("PassengerId", "int"), ("Survived", "int"), ("Pclass", "int"), ("Name", "string"),
    ("Sex", "string"), ("Age", "double"), ("SibSp", "int"), ("Parch", "int"), ("Ticket", "string"),
    ("Fare", "double"), ("Cabin", "string"), ("Embarked", "string"),
)


def passenger_schema(with_label: bool = True):
    from pyspark.sql import types as T
    names = {"int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType()}
    return T.StructType([T.StructField(c, names[t], True) for c, t in PASSENGER_COLUMNS
                         if with_label or c != "Survived"])
