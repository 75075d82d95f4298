from trendlake.sinks.tables import overwrite_partitions, register_table, write_partitioned

__all__ = ["overwrite_partitions", "register_table", "write_partitioned"]
