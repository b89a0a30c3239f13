"""Job configuration: defaults, validation, loading."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field, fields, replace
from pathlib import Path

from rowmill.operators.metrics import METRICS
from rowmill.operators.models import check_params


@dataclass(frozen=True)
class JobConfig:
    """Settings that change the job's result.

    ``fit_on`` says which rows the scaler and the feature scores are fitted on:
    "train" keeps the test rows out; "all" uses every row before splitting.
    ``partitions`` is the layout a forest is grown in (None: from the rows), ``keep_stages`` also stores
    the raw target and the table with all features scaled.
    """

    # Defaults of the job.
    test_size: float = 0.3
    random_state: int = 42
    n_features: int = 20
    use_scaling: bool = True
    algorithm: str = "random_forest"
    random_forest: Mapping = field(default_factory=dict)
    logistic_regression: Mapping = field(default_factory=dict)
    metrics: tuple[str, ...] = METRICS
    fit_on: str = "train"
    partitions: int | None = None
    keep_stages: bool = False

    def __post_init__(self):
        if self.fit_on not in ("train", "all"):
            raise ValueError(f"fit_on must be 'train' or 'all', got {self.fit_on!r}")
        unknown = [m for m in self.metrics if m not in METRICS]
        if unknown:
            raise ValueError(f"unknown metrics {unknown}; known: {list(METRICS)}")
        check_params(self.algorithm, self.model_params())

    def model_params(self) -> Mapping:
        """Hyper-parameters of the chosen algorithm."""
        return {
            "random_forest": self.random_forest,
            "logistic_regression": self.logistic_regression,
        }.get(self.algorithm, {})

    @classmethod
    def from_mapping(cls, config: Mapping) -> JobConfig:
        """From the nested form with sections feature_engineering, model, evaluation
        and, for our own switches, job. Other sections are ignored."""
        prepare = config.get("feature_engineering") or {}
        model = config.get("model") or {}
        own = config.get("job") or {}
        found = {
            "test_size": prepare.get("test_size"),
            "random_state": prepare.get("random_state"),
            "n_features": prepare.get("n_features_to_select"),
            "use_scaling": prepare.get("use_scaling"),
            "algorithm": model.get("algorithm"),
            "random_forest": model.get("random_forest"),
            "logistic_regression": model.get("logistic_regression"),
            "metrics": (config.get("evaluation") or {}).get("metrics"),
            "fit_on": own.get("fit_on"),
            "partitions": own.get("partitions"),
            "keep_stages": own.get("keep_stages"),
        }
        given = {name: value for name, value in found.items() if value is not None}
        if "metrics" in given:
            given["metrics"] = tuple(given["metrics"])
        return cls(**given)

    @classmethod
    def load(cls, path: str) -> JobConfig:
        """From a .json file, or a .yml/.yaml file if PyYAML is installed."""
        text = Path(path).read_text(encoding="utf-8")
        if str(path).endswith(".json"):
            return cls.from_mapping(json.loads(text))
        try:
            import yaml
        except ImportError as error:
            raise ValueError("reading YAML needs PyYAML; use a JSON file instead") from error
        return cls.from_mapping(yaml.safe_load(text) or {})

    def with_changes(self, **changes) -> JobConfig:
        """A copy with some settings replaced."""
        known = {f.name for f in fields(self)}
        unknown = sorted(set(changes) - known)
        if unknown:
            raise TypeError(f"unknown settings: {unknown}")
        return replace(self, **changes)
