from trackside.functions.columns import (
    build_session_id,
    clean_real,
    duration_seconds,
    duration_text,
    is_classified,
    race_name,
    session_type_name,
    to_real,
    whole_number,
)

__all__ = [
    "build_session_id",
    "clean_real",
    "duration_seconds",
    "duration_text",
    "is_classified",
    "race_name",
    "session_type_name",
    "to_real",
    "whole_number",
]
