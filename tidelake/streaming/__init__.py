from tidelake.streaming.histogram import start_histogram
from tidelake.streaming.ingest import start_ingest
from tidelake.streaming.state import start_state

__all__ = ["start_histogram", "start_ingest", "start_state"]
