"""One declarative contract: schema, table checks and record checks derive from it."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

ADDON_COLUMNS = (
    "OnlineSecurity",
    "OnlineBackup",
    "DeviceProtection",
    "TechSupport",
    "StreamingTV",
    "StreamingMovies",
)


@dataclass(frozen=True)
class Rule:
    """What one column may hold.

    ``allowed`` is a closed domain, ``low``/``high`` a closed range. ``in_table`` says
    that the domain and lower bound are also enforced on the stored table, not only on
    single records. ``in_record`` is false for columns a record to score does not carry.
    """

    name: str
    type: T.DataType = field(default_factory=T.StringType)
    nullable: bool = False
    allowed: tuple = ()
    low: float | None = None
    high: float | None = None
    numeric_text: bool = False
    in_table: bool = False
    in_record: bool = True


@dataclass(frozen=True)
class Contract:
    rules: tuple[Rule, ...]
    id_column: str
    target: str
    positive: str

    @property
    def names(self) -> list[str]:
        return [r.name for r in self.rules]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(r.name, r.type, True) for r in self.rules])

    @property
    def record_rules(self) -> list[Rule]:
        return [r for r in self.rules if r.in_record]

    @property
    def text_columns(self) -> list[str]:
        return [r.name for r in self.rules if isinstance(r.type, T.StringType)]

    def rule(self, name: str) -> Rule:
        return next(r for r in self.rules if r.name == name)

    def narrowed(self, **changes: dict) -> Contract:
        """A copy with some rules changed, e.g. ``narrowed(tenure={"high": 60})``."""
        return replace(
            self,
            rules=tuple(
                replace(r, **changes[r.name]) if r.name in changes else r for r in self.rules
            ),
        )


# Domains, ranges and column names of the telco customer table.
_YES_NO = ("Yes", "No")
_YES_NO_INTERNET = ("Yes", "No", "No internet service")
TELCO = Contract(
    rules=(
        Rule("customerID", in_record=False),
        Rule("gender", allowed=("Female", "Male")),
        Rule("SeniorCitizen", T.ShortType(), allowed=(0, 1), in_table=True),
        Rule("Partner", allowed=_YES_NO),
        Rule("Dependents", allowed=_YES_NO),
        Rule("tenure", T.IntegerType(), low=0, high=200, in_table=True),
        Rule("PhoneService", allowed=_YES_NO),
        Rule("MultipleLines", allowed=("Yes", "No", "No phone service")),
        Rule("InternetService", allowed=("DSL", "Fiber optic", "No"), in_table=True),
        *(Rule(name, allowed=_YES_NO_INTERNET) for name in ADDON_COLUMNS),
        Rule(
            "Contract",
            allowed=("Month-to-month", "One year", "Two year"),
            in_table=True,
        ),
        Rule("PaperlessBilling", allowed=_YES_NO),
        Rule(
            "PaymentMethod",
            allowed=(
                "Electronic check",
                "Mailed check",
                "Bank transfer (automatic)",
                "Credit card (automatic)",
            ),
        ),
        Rule("MonthlyCharges", T.DecimalType(10, 2), low=0, high=1000),
        Rule("TotalCharges", nullable=True, numeric_text=True, low=0, high=100000),
        Rule("Churn", allowed=_YES_NO, in_table=True, in_record=False),
    ),
    id_column="customerID",
    target="Churn",
    positive="Yes",
)
