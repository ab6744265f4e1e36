"""The two labelling paths, which differ in corner cases, as options."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.config import DATASETS, FOODS, HEALTH_RULES, HEALTHY_MIN, NUTRIENT_IDS, REQUIRED, Dataset, Layout, Rule
from larder.operators.labeling import label
from larder.operators.nested import pivot
from larder.operators.raw_queries import of_source


@dataclass(frozen=True)
class LabelOptions:
    """What a path does with repeats, gaps and copies.

    ``dup``: value of a measurement that a document repeats.
    ``missing_value``: value of an entry that carries none.
    ``null_compare``: how rules compare a column that is still missing.
    ``grain``: a row per id within a source, or per document.
    ``category_default`` and ``text_default``: missing text attributes.
    ``keep_empty``: keep documents without any wanted measurement.
    """

    dup: str
    missing_value: float | None
    null_compare: str
    grain: str
    category_default: str | None
    text_default: str | None
    keep_empty: bool

    @property
    def shuffles(self) -> bool:
        return self.grain == "id"


DOCUMENT_PATH = LabelOptions(
    dup="max",
    missing_value=None,
    null_compare="lowest",
    grain="id",
    category_default=None,
    text_default=None,
    keep_empty=False,
)

SPARK_PATH = LabelOptions(
    dup="last",
    missing_value=0.0,
    null_compare="sql",
    grain="document",
    category_default="Unknown",
    text_default="",
    keep_empty=True,
)


def widen(
    docs: DataFrame,
    options: LabelOptions,
    *,
    measures: Mapping[str, int] = NUTRIENT_IDS,
    order_by: Sequence[str] = (),
    layout: Layout = FOODS,
) -> DataFrame:
    """Nested documents of all sources to wide rows, in one plan."""
    wide = pivot(
        docs,
        measures,
        dup=options.dup,
        missing_value=options.missing_value,
        grain=options.grain,
        order_by=order_by,
        keep_empty=options.keep_empty,
        layout=layout,
    )
    defaults = {
        layout.category: options.category_default,
        layout.description: options.text_default,
        layout.kind: options.text_default,
    }
    return wide.fillna({name: text for name, text in defaults.items() if text is not None})


def label_foods(
    docs: DataFrame,
    options: LabelOptions,
    *,
    rules: Sequence[Rule] = HEALTH_RULES,
    required: Sequence[str] = REQUIRED,
    minimum: int = HEALTHY_MIN,
    measures: Mapping[str, int] = NUTRIENT_IDS,
    order_by: Sequence[str] = (),
    layout: Layout = FOODS,
) -> DataFrame:
    """Labelled rows of nested documents; nothing is written.

    Rows that miss a ``required`` measure are dropped; ``minimum`` points make a row healthy.
    """
    wide = widen(docs, options, measures=measures, order_by=order_by, layout=layout)
    return label(wide, rules, required=required, minimum=minimum, null_compare=options.null_compare)


def wide_frames(
    docs: DataFrame,
    options: LabelOptions = SPARK_PATH,
    datasets: Mapping[str, Dataset] = DATASETS,
    layout: Layout = FOODS,
) -> dict[str, DataFrame]:
    """One wide frame per source, and ``all_foods`` as their union."""
    frames = {
        d.frame: widen(of_source(docs, d.name, layout), options, layout=layout)
        for d in datasets.values()
    }
    union = None
    for frame in frames.values():
        union = frame if union is None else union.unionByName(frame)
    return {**frames, "all_foods": union}
