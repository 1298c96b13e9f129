"""Fixed schemas."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DoubleType, IntegerType, StringType, StructField, StructType

_KINDS = {"STRING": StringType(), "INT": IntegerType(), "DOUBLE": DoubleType(), "BOOLEAN": BooleanType(), "BINARY": BinaryType(), "ARRAY<INT>": ArrayType(IntegerType())}


def _schema(text: str) -> StructType:
    """Needs no session, unlike a DDL parser."""
    return StructType([StructField(name, _KINDS[kind]) for name, kind in (part.split() for part in text.split(","))])


VIDEOS = _schema(
    "path STRING, video_id STRING, compression STRING, gen_method STRING, resolution STRING, background_type STRING, video_name STRING,"
    " group_id STRING, label INT, class_name STRING, split STRING, dataset_id STRING, media_type STRING, split_locked BOOLEAN"
)
FRAMES = _schema(
    "video_id STRING, frame_index INT, timestamp DOUBLE, candidate_id INT, face_image BINARY, bbox ARRAY<INT>, detect_confidence DOUBLE, repair_flag BOOLEAN,"
    " missing_face_flag BOOLEAN, quality_score DOUBLE, motion_score DOUBLE, ssim_to_prev_selected DOUBLE, hard_invalid BOOLEAN"
)
SEQUENCES = _schema(
    "sequence_id STRING, dataset_id STRING, video_id STRING, group_id STRING, label INT, class_name STRING, split STRING, compression STRING, gen_method STRING,"
    " resolution STRING, media_type STRING, background_type STRING, video_name STRING, frame_paths STRING, start_time DOUBLE, end_time DOUBLE, start_frame INT,"
    " end_frame INT, candidate_fps DOUBLE, model_fps DOUBLE, seq_len INT, image_size INT, image_format STRING, avg_quality DOUBLE, avg_motion DOUBLE,"
    " duplicate_ratio DOUBLE, missing_face_ratio DOUBLE, repair_ratio DOUBLE, window_score DOUBLE, pipeline_version STRING, pipeline_fingerprint STRING"
)
SPLIT_ROWS = _schema(
    "dataset_id STRING, video_id STRING, group_id STRING, split STRING, label INT, class_name STRING, compression STRING, gen_method STRING, resolution STRING,"
    " media_type STRING, background_type STRING, video_name STRING"
)
