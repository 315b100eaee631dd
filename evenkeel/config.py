"""Names, thresholds and small configuration records shared by all operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

# Results depend on them, so they are stated once and plainly.
KEY = "USER_ID"
LABEL = "default"
PREDICTION = "prediction"
DATE = "monitoring_date"
PAY_COLUMNS = ("PAY_1", "PAY_2", "PAY_3", "PAY_4", "PAY_5", "PAY_6")
PAY_AMOUNT_COLUMNS = (
    "PAY_AMT1", "PAY_AMT2", "PAY_AMT3", "PAY_AMT4", "PAY_AMT5", "PAY_AMT6",
)
BILL_AMOUNT_COLUMNS = (
    "BILL_AMT1", "BILL_AMT2", "BILL_AMT3", "BILL_AMT4", "BILL_AMT5", "BILL_AMT6",
)
PROTECTED = {"SEX": (1,), "MARRIAGE": (1,)}
FAIRNESS_METRICS = ("demographic_parity", "equal_opportunity", "equal_odds")
PRIMARY_FAIRNESS_METRIC = "equal_opportunity"
FAIR_THRESHOLD = 0.43
PARITY_GATE = 0.1
SIGNIFICANCE = 0.05
DISTANCE_LIMIT = 0.1
SPLIT_SEED = 123
TEST_PERCENT = 25
LOGISTIC_C = 0.1
LOGISTIC_MAX_ITER = 4000
THRESHOLD_BINS = 100

Protected = Mapping[str, Sequence]


@dataclass(frozen=True)
class ColumnRoles:
    """Which column plays which part in a drift or quality report."""

    target: str | None = None
    prediction: str | None = None
    datetime: str | None = None
    numerical: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    target_is_numeric: bool = False

    def __post_init__(self):
        both = set(self.numerical) & set(self.categorical)
        if both:
            raise ValueError(f"columns listed as numerical and categorical: {sorted(both)}")

    @property
    def targets(self) -> tuple[str, ...]:
        return tuple(c for c in (self.target, self.prediction) if c)

    @property
    def columns(self) -> tuple[str, ...]:
        """All columns of a report, each once."""
        return tuple(dict.fromkeys((*self.numerical, *self.categorical, *self.targets)))


@dataclass(frozen=True)
class Window:
    """An open date interval: both bounds are excluded."""

    start: str
    end: str


@dataclass(frozen=True)
class FeatureLookup:
    """Features to bring in from one keyed table (a table name or a DataFrame)."""

    table: str | DataFrame
    feature_names: tuple[str, ...]
    lookup_key: tuple[str, ...] = field(default=(KEY,))


CREDIT_ROLES = ColumnRoles(
    target=LABEL,
    prediction=PREDICTION,
    datetime=DATE,
    numerical=("LIMIT_BAL", "AGE"),
    categorical=("SEX", "EDUCATION", "MARRIAGE"),
)
REFERENCE_WINDOW = Window("2022-01-01", "2022-06-30")
PRODUCTION_WINDOW = Window("2022-07-01", "2022-12-31")
