from trackside.streaming.incremental import incremental_session_append

__all__ = ["incremental_session_append"]
