from sensorlake.streaming.ingest import ingest_new_files, run_new_files

__all__ = ["ingest_new_files", "run_new_files"]
