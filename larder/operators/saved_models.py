"""Fitted models that outlive the step that fitted them.

A saved model is a fitted pipeline with a manifest that says what it was fitted on:
features, label rules, split, settings and the version of the labelled table. Saving
writes both as one version (``larder.sources.versions``), so a reader sees a whole model or the one
before. Scoring names what it expects, and a model fitted on anything else is refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, fields

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from larder.config import FEATURES, FOODS, HEALTH_RULES, HEALTHY_MIN, Layout, Rule
from larder.operators.models import Fitted, Trained, evaluate
from larder.sources import versions


class ModelMismatch(ValueError):
    """The saved model was fitted on something else."""


@dataclass(frozen=True)
class Basis:
    """What a model is fitted on; two equal ones give the same model."""

    kind: str
    settings: dict[str, float]
    data: str
    features: tuple[str, ...] = FEATURES
    rules: tuple[Rule, ...] = HEALTH_RULES
    minimum: int = HEALTHY_MIN
    key: str = FOODS.id
    percent: int = 80

    def text(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @staticmethod
    def of(text: str) -> Basis:
        content = json.loads(text)
        rules = tuple(Rule(**r) for r in content.pop("rules"))
        return Basis(**{**content, "features": tuple(content["features"]), "rules": rules})

    def differences(self, other: Basis) -> list[str]:
        return [f.name for f in fields(self) if getattr(self, f.name) != getattr(other, f.name)]


@dataclass(frozen=True)
class Saved:
    """A model read back, with its basis and the facts noted when it was fitted."""

    model: PipelineModel
    basis: Basis
    facts: dict[str, float] = field(default_factory=dict)


def save(spark: SparkSession, fitted: Fitted, basis: Basis, path: str) -> versions.Version:
    """Save a fitted model as the newest version at a path."""
    base, commit = versions.version(spark, path), uuid.uuid4().hex
    note = json.dumps({"basis": basis.text(), "facts": fitted.facts})
    try:
        fitted.model.write().save(f"{path}/data/{versions.COMMIT}={commit}")
        return versions.publish(spark, path, base, [versions.Part(commit, note, 1, "model")])
    except BaseException:
        versions.discard(spark, path, commit)
        raise


def _note(spark: SparkSession, path: str, number: int | None) -> tuple[str, Basis, dict[str, float]] | None:
    parts = versions.version(spark, path, number).of("model")
    if not parts:
        return None
    content = json.loads(parts[0].value)
    return parts[0].commit, Basis.of(content["basis"]), content["facts"]


def is_saved(spark: SparkSession, path: str, expected: Basis) -> bool:
    """Is the newest model at a path one of this basis?"""
    note = _note(spark, path, None)
    return note is not None and not note[1].differences(expected)


def load(spark: SparkSession, path: str, expected: Basis | None = None, number: int | None = None) -> Saved:
    """A saved model, the newest if no version is given; refused if it differs from what is expected."""
    note = _note(spark, path, number)
    if note is None:
        raise FileNotFoundError(f"no model is saved at {path}")
    commit, basis, facts = note
    if expected is not None and (different := basis.differences(expected)):
        raise ModelMismatch(f"the model at {path} was fitted with other {', '.join(different)}")
    return Saved(PipelineModel.load(f"{path}/data/{versions.COMMIT}={commit}"), basis, facts)


def score(saved: Saved, rows: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """Predictions for any rows that have the model's features, missing values as 0.0."""
    wanted = list(saved.basis.features if features is None else features)
    if wanted != list(saved.basis.features):
        raise ModelMismatch(f"the model was fitted on {list(saved.basis.features)}")
    if missing := [f for f in wanted if f not in rows.columns]:
        raise ModelMismatch(f"the rows have no {', '.join(missing)}")
    return saved.model.transform(rows.fillna(0.0, subset=wanted)).drop("features")


def evaluate_saved(saved: Saved, labeled: DataFrame, layout: Layout = FOODS) -> Trained:
    """The model's predictions and metrics on the test part of the labelled rows that it was fitted on."""
    basis = saved.basis
    fitted = Fitted(saved.model, saved.facts)
    return evaluate(fitted, labeled, features=basis.features, key=basis.key, percent=basis.percent, layout=layout)
