from tidelake.sources.event_log import append_events, read_events, read_new_events
from tidelake.sources.files import load_csv, read_record_files
from tidelake.sources.jdbc import block_ranges, jdbc_options, read_table
from tidelake.sources.kafka import kafka_options, read_topics
from tidelake.sources.tables import ReportTable, StateTable

__all__ = [
    "append_events", "read_events", "read_new_events", "load_csv", "read_record_files",
    "block_ranges", "jdbc_options", "read_table", "kafka_options", "read_topics", "ReportTable", "StateTable",
]
