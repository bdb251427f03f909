from sensorlake.operators import incremental, ingest, metrics, quality, summaries

__all__ = ["incremental", "ingest", "metrics", "quality", "summaries"]
