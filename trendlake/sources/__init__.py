from trendlake.sources.reference import read_reference_docs, stream_reference_docs
from trendlake.sources.stats import read_stats, read_stats_api, read_stats_csv, stream_stats
from trendlake.sources.tables import read_optional, read_table

__all__ = [
    "read_optional",
    "read_reference_docs",
    "read_stats",
    "read_stats_api",
    "read_stats_csv",
    "read_table",
    "stream_reference_docs",
    "stream_stats",
]
