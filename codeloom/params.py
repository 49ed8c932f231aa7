"""Parameters of one run. Defaults are fixed values of the data contract."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class PrepParams:
    embedding_dim: int = 128
    embedding_set_version: str = "product_emb-v1"
    val_fraction: float = 0.10
    split_seed: int = 42
    strata_columns: tuple[str, ...] = ("league", "team")


@dataclass(frozen=True)
class WeightParams:
    hot_bucket_top_k: int = 20
    hot_bucket_weight: float = 5.0
    hot_market_weight: float = 5.0


@dataclass(frozen=True)
class QuantizerParams:
    W: int = 512
    L: int = 3
    d: int = 32
    beta: float = 0.25
    gamma: float = 0.99
    kmeans_init: bool = True
    kmeans_iterations: int = 20
    # "spread": different residuals that lie apart; "rows": W rows by hash.
    kmeans_start: str = "spread"
    # Rows for the k-means start and for dead codes; None: all rows.
    init_probe_rows: int | None = None
    dead_code_reset: bool = True
    dead_code_reset_threshold: float = 0.01
    # True: a code is dead below threshold * (1 / W), its fair share.
    # False: the threshold is compared with the plain share of assignments.
    dead_threshold_relative: bool = True
    dead_code_reset_every: int = 1
    reset_probe_rows: int | None = None
    # Rows with a large error that are kept for dead codes; None: as many as there are codes.
    reset_pool_rows: int | None = None


@dataclass(frozen=True)
class TrainParams:
    lr: float = 1.0e-3
    batch_size: int = 4096
    max_epochs: int = 200
    patience: int = 10
    min_delta: float = 1.0e-4
    seed: int = 42
    # "sync": exact optimizer steps on batch_size rows; a barrier stage takes all steps of an epoch in one job (where
    # Spark runs none, under dynamic allocation or for a large model, each step is a job that sums the gradients).
    # "local": every shard takes local steps of batch_size / shards rows, Spark averages the states.
    mode: str = "local"
    # Logical parts of a round; a row's part depends on its key alone. With more executors, raise it and batch_size.
    shards: int = 16
    # Train on a seeded sample of about this many rows; None trains on all rows.
    sample_rows: int | None = None
    # Rows read per round; an epoch has ceil(rows / rows_per_round) rounds.
    rows_per_round: int = 50_000_000


@dataclass(frozen=True)
class EvalParams:
    hot_bucket_top_k: int = 20
    taxonomy_fields: tuple[str, ...] = ("league", "team")


@dataclass(frozen=True)
class RunParams:
    prep: PrepParams = field(default_factory=PrepParams)
    weights: WeightParams = field(default_factory=WeightParams)
    quantizer: QuantizerParams = field(default_factory=QuantizerParams)
    training: TrainParams = field(default_factory=TrainParams)
    evaluation: EvalParams = field(default_factory=EvalParams)
    code_version: str = "v1"
