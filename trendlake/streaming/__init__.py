from trendlake.streaming.ingest import ingest_reference, ingest_stats, merge_latest

__all__ = ["ingest_reference", "ingest_stats", "merge_latest"]
