from tidelake.functions.decode import as_type, from_epoch_days, from_epoch_micros, json_fields
from tidelake.functions.layout import bucket_of, day_of, folder_of, month_of, transform
from tidelake.functions.measures import money, percent, start_of_month, start_of_week

__all__ = [
    "as_type", "from_epoch_days", "from_epoch_micros", "json_fields", "bucket_of", "day_of", "folder_of", "month_of",
    "transform", "money", "percent", "start_of_month", "start_of_week",
]
