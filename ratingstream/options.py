"""Options and their defaults.

Fixed values that must equal the reference job's defaults:
k = 5, decay factor = 1.0, centre dimension = 1128, initial weight = 0.0,
bootstrap servers = "localhost:6667", topics = "test",
consumer group = "KMean_Consumer", batch interval = 120 seconds,
prediction sample = 1 %, source cap = 2000 records per second per partition,
producer acks = "0", retries = 3, retry backoff = 100 ms, compression = "none"
("gzip" when the codec is asked for without a name), linger = 1000 ms,
request timeout = 1500 ms, metadata max age = 300000 ms, max block = 60000 ms,
send buffer = 102400 bytes, batch size = 16384 bytes,
buffer memory = 33554432 bytes, security protocol = "PLAINTEXT".
"""

from __future__ import annotations

from dataclasses import dataclass, field

DEFAULT_DIM = 1128


@dataclass(frozen=True)
class KMeansOptions:
    k: int = 5
    decay: float = 1.0
    dim: int = DEFAULT_DIM
    weight: float = 0.0
    time_unit: str = "batches"  # or "points"
    seed: int | None = None

    def __post_init__(self):
        if self.k < 1:
            raise ValueError("k must be >= 1")
        if not 0.0 <= self.decay <= 1.0:
            raise ValueError("decay must lie in [0, 1]")
        if self.time_unit not in ("batches", "points"):
            raise ValueError("time_unit must be 'batches' or 'points'")
        if self.weight < 0:
            raise ValueError("weight must be >= 0")

    @classmethod
    def from_properties(cls, props: dict, prefix: str = "kMeans.") -> "KMeansOptions":
        """Options from the reference job's ``kMeans.*`` settings.

        The job reads the decay factor and the initial weight as 32-bit floats
        before the model widens them to doubles; the same rounding is kept so
        a setting such as ``0.9`` gives the same model.
        """
        import numpy as np

        p = {k[len(prefix):] if k.startswith(prefix) else k: str(v).strip() for k, v in props.items()}
        return cls(
            k=int(p.get("K", "5")),
            decay=float(np.float32(p.get("DecayFactor", "1.0"))),
            dim=int(p.get("RandomCenters.dim", str(DEFAULT_DIM))),
            weight=float(np.float32(p.get("RandomCenters.weight", "0"))),
        )

    @staticmethod
    def decay_from_half_life(half_life: float) -> float:
        """Forgetting factor whose weight halves after ``half_life`` time units."""
        import math

        if half_life <= 0:
            raise ValueError("half_life must be > 0")
        return math.exp(math.log(0.5) / half_life)


@dataclass(frozen=True)
class StreamOptions:
    interval_s: int = 120
    sample_fraction: float = 0.01
    sample_seed: int = 17
    scale_by_rating: bool = False
    on_error: str = "quarantine"  # or "fail"
    max_records_per_s_per_partition: int = 2000  # 0: no cap
    broadcast_limit_bytes: int = 256 * 1024 * 1024
    assign_method: str = "arrow"  # or "sql", "incremental" (kept bounds, see operators.bounds); the same results
    hot_movie_rows: int = 1_000_000  # ratings of one movie beyond this are salted in shuffled joins
    report_span: int = 1_000_000  # offsets per line of the prediction report
    # Replay the empty intervals between two batches as empty model updates
    # (decay and the dying-cluster check), as a timer-driven stream would run
    # them. Off by default: Structured Streaming runs no batch without data.
    replay_idle_intervals: bool = False
    # Batches that keep folders of their own, and segments of a level, before they are merged into one.
    compact_every: int = 16
    # Log what became of every batch's commit (streaming.commit_log).
    commit_log: bool = True


@dataclass(frozen=True)
class KafkaOptions:
    bootstrap_servers: str = "localhost:6667"
    topics: str = "test"
    group_id: str = "KMean_Consumer"
    starting_offsets: str = "latest"
    # Spark tasks per micro-batch at least this many: the reference's topic has
    # two partitions (user parity), which alone would give two parse tasks.
    min_partitions: int | None = None
    # Expired or truncated offsets fail the query (Spark's default) unless this is turned off.
    fail_on_data_loss: bool = True
    extra: dict = field(default_factory=dict)  # passed through with a "kafka." prefix


def kafka_options_from_properties(props: dict, prefix: str = "kafkaStream.") -> KafkaOptions:
    """Options from the reference job's ``kafkaStream.*`` settings.

    ``topics``, ``bootstrap.servers``, ``group.id`` and ``auto.offset.reset``
    map to their fields; other client settings pass through (deserializer
    settings are dropped: the Spark source reads keys and values as bytes).
    """
    p = {k[len(prefix):] if k.startswith(prefix) else k: str(v).strip() for k, v in props.items()}
    known = {"topics", "bootstrap.servers", "group.id", "auto.offset.reset"}
    extra = {k: v for k, v in p.items() if k not in known and not k.endswith(".deserializer")}
    return KafkaOptions(
        bootstrap_servers=p.get("bootstrap.servers", "localhost:6667"),
        topics=p.get("topics", "test"),
        group_id=p.get("group.id", "KMean_Consumer"),
        starting_offsets=p.get("auto.offset.reset", "latest"),
        extra=extra,
    )


@dataclass(frozen=True)
class PublishOptions:
    bootstrap_servers: str = "localhost:6667"
    topic: str = "test"
    partitions: int = 2
    acks: str = "0"
    retries: int = 3
    retry_backoff_ms: int = 100
    compression: str | None = "none"  # None = codec asked for without a name
    linger_ms: int = 1000
    request_timeout_ms: int = 1500
    metadata_max_age_ms: int = 300000
    max_block_ms: int = 60000
    send_buffer_bytes: int = 102400
    batch_size: int = 16384
    buffer_memory: int = 33554432
    security_protocol: str = "PLAINTEXT"
    extra: dict = field(default_factory=dict)
