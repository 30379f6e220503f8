from tidelake.operators.envelope import events_of, log_rows, parse_records, record_kind, snapshot_events
from tidelake.operators.extract import chosen_image, extract, reject_counts
from tidelake.operators.latest import latest_change, latest_per_key
from tidelake.operators.merge import insert_absent, merge
from tidelake.operators.percentiles import exact_percentiles
from tidelake.operators.retention import first_two_purchases

__all__ = [
    "events_of", "log_rows", "parse_records", "record_kind", "snapshot_events", "chosen_image", "extract", "reject_counts",
    "latest_change", "latest_per_key", "insert_absent", "merge", "exact_percentiles",
    "first_two_purchases",
]
