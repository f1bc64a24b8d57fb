"""Every operator of the inventory under its build id, in one place."""

from __future__ import annotations

from .functions.text import drop_last_field, encode_int_key
from .functions.vectors import format_vector
from .jobs import clusterer_job, publish_stream, publisher_job, stream_progress_offsets
from .operators.features import (
    array_to_features,
    assemble_tag_vectors,
    join_ratings_features,
    label_points,
    project_features,
    sample_rows,
    scale_features,
)
from .operators.kmeans import (
    assign_clusters,
    cluster_stats,
    decay_weights,
    init_centers,
    latest_model,
    split_dying_cluster,
    train_step,
    update_centers,
)
from .operators.parse import (
    parse_rating,
    project_value,
    reject_bad_lines,
    rekey_by_movie,
    stamp_time,
    user_parity_key,
)
from .operators.publish import publish_ratings, publish_summary
from .operators.reports import model_report, offset_ranges, prediction_report
from .plans.pipeline import fold_batches, materialize_vectors
from .sources.files import count_lines, scan_rating_lines, scan_tag_scores
from .sources.kafka import kafka_writer_options, stream_ratings, stream_source_rate
from .streaming.job import process_batch, run_stream


def stream_start_position(position: str = "latest") -> dict[str, str]:
    """Where a Kafka stream starts without a checkpoint: ``latest``, ``earliest`` or JSON offsets."""
    return {"startingOffsets": position}


# build ids whose implementation carries a more general name
encode_key = encode_int_key
format_center = format_vector
stream_offset_report = offset_ranges
publish_options = kafka_writer_options
cache_static_side = materialize_vectors
stream_transform = process_batch
per_batch_output = process_batch
train_then_predict = process_batch
stateful_model = run_stream
micro_batch_trigger = run_stream
checkpoint = run_stream
commit_offsets = run_stream
run_until_stopped = clusterer_job

__all__ = [
    "array_to_features", "assemble_tag_vectors", "assign_clusters", "cache_static_side", "checkpoint",
    "cluster_stats", "clusterer_job", "commit_offsets", "count_lines", "decay_weights", "drop_last_field",
    "encode_key", "fold_batches", "format_center", "init_centers", "join_ratings_features", "label_points",
    "latest_model", "micro_batch_trigger", "model_report", "parse_rating", "per_batch_output",
    "prediction_report", "project_features", "project_value", "publish_options", "publish_ratings",
    "publish_stream", "publish_summary", "publisher_job", "rekey_by_movie", "reject_bad_lines", "run_until_stopped",
    "sample_rows", "scale_features", "scan_rating_lines", "scan_tag_scores", "split_dying_cluster",
    "stamp_time", "stateful_model", "stream_offset_report", "stream_progress_offsets", "stream_ratings",
    "stream_source_rate", "stream_start_position", "stream_transform", "train_step", "train_then_predict",
    "update_centers", "user_parity_key",
]
