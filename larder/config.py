"""Fixed values of the food case and the names of the columns that carry it.

Operators take these as arguments and use them only as defaults, so the same
code labels any entity that carries a nested array of measurements.
"""

from __future__ import annotations

from dataclasses import dataclass

# Measurement identifier of each wide column, in feature order.
NUTRIENT_IDS = {
    "calories": 1008,
    "protein": 1003,
    "total_fat": 1004,
    "total_sugars": 2000,
    "sodium": 1093,
    "fiber": 1079,
    "saturated_fat": 1258,
    "cholesterol": 1253,
}

# The measurements compared across categories and sources.
COMPARED_IDS = (1008, 1003, 1004, 2000)

# Wide columns a food must have before it can be labelled.
REQUIRED = ("calories", "protein", "total_fat")

# Fixed value: points needed, out of six, to count as healthy.
HEALTHY_MIN = 4

FEATURES = tuple(NUTRIENT_IDS)


@dataclass(frozen=True)
class Rule:
    """One strict threshold test on one wide column.

    ``op`` is ``"<"`` or ``">"``. ``null_as`` replaces a missing value before
    the test; without it the null mode of the scoring decides.
    """

    column: str
    op: str
    bound: float
    null_as: float | None = None

    def __post_init__(self):
        if self.op not in ("<", ">"):
            raise ValueError(f"a rule compares with '<' or '>', not {self.op!r}")


# The six health rules.
HEALTH_RULES = (
    Rule("calories", "<", 300),
    Rule("total_sugars", "<", 10),
    Rule("sodium", "<", 400, null_as=0),
    Rule("saturated_fat", "<", 5, null_as=0),
    Rule("fiber", ">", 3, null_as=0),
    Rule("protein", ">", 5, null_as=0),
)


@dataclass(frozen=True)
class Layout:
    """Column names of a nested document and of one measurement inside it."""

    id: str = "fdcId"
    description: str = "description"
    kind: str = "dataType"
    category: str = "foodCategory"
    source: str = "sourceCollection"
    array: str = "foodNutrients"
    measure_id: str = "nutrientId"
    measure_name: str = "nutrientName"
    unit: str = "unitName"
    value: str = "value"

    @property
    def attributes(self) -> tuple[str, ...]:
        return (self.description, self.kind, self.category)


FOODS = Layout()


@dataclass(frozen=True)
class Dataset:
    """A source: the value of its source column and its landing folder."""

    name: str
    landing: str

    @property
    def frame(self) -> str:
        return f"{self.name}_food"


# The three sources and the folders their snapshots land in.
DATASETS = {
    d.name: d
    for d in (
        Dataset("survey", "survey_all"),
        Dataset("legacy", "legacy_all"),
        Dataset("foundation", "foundation_all"),
    )
}
