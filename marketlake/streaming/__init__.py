"""File-stream incremental loads (``readStream`` + ``foreachBatch`` upsert)."""
from marketlake.streaming.file_upsert import stream_upsert  # noqa: F401
