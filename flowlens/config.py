"""Thresholds and model settings, as one frozen value that every job takes as an argument."""

from __future__ import annotations

from dataclasses import dataclass, field


# Gate, drift, split and adaptation thresholds.
@dataclass(frozen=True)
class GateConfig:
    min_f1: float = 0.90
    min_precision: float = 0.85
    min_recall: float = 0.85
    min_f1_improvement: float = 0.002


@dataclass(frozen=True)
class DriftConfig:
    psi_bins: int = 10
    psi_floor: float = 1e-4
    min_side_rows: int = 50
    psi_warn: float = 0.10
    psi_drift: float = 0.20
    ks_alpha: float = 0.01
    min_feature_drift_share: float = 0.20
    min_recent_rows: int = 5000
    window_hours: float = 24.0
    perf_min_f1: float = 0.85
    perf_min_rows: int = 500


@dataclass(frozen=True)
class SplitConfig:
    train: float = 0.70
    validation: float = 0.15
    test: float = 0.15


@dataclass(frozen=True)
class AdaptConfig:
    min_rows: int = 3000
    min_confidence: float = 0.85
    anchor_rows: int = 20000


@dataclass(frozen=True)
class ModelConfig:
    models: tuple[str, ...] = (
        "random_forest", "boosted_trees", "isolation_forest", "one_class_svm", "autoencoder",
    )
    candidate: str = "boosted_trees"
    seed: int = 42
    forest_trees: int = 300
    forest_depth: int = 20
    boost_rounds: int = 400
    boost_depth: int = 7
    boost_step: float = 0.1
    boost_subsample: float = 0.85
    boost_columns: float = 0.85
    tree_bins: int = 64
    iforest_trees: int = 200
    iforest_sample: int = 256
    contamination: float = 0.05
    svm_nu: float = 0.05
    svm_features: int = 256
    svm_iterations: int = 30
    encoding_dim: int = 8
    encoder_epochs: int = 30
    recon_quantile: float = 0.99
    clusters: int = 4
    min_benign: int = 100


@dataclass(frozen=True)
class Config:
    gate: GateConfig = field(default_factory=GateConfig)
    drift: DriftConfig = field(default_factory=DriftConfig)
    split: SplitConfig = field(default_factory=SplitConfig)
    adapt: AdaptConfig = field(default_factory=AdaptConfig)
    model: ModelConfig = field(default_factory=ModelConfig)


DEFAULT = Config()
