"""Declared schemas: stream record, change envelope, event log, and the seven shop entities.

Nothing is inferred from data. An entity is described by its current-state columns, its key and
the source field behind each renamed column; every job is driven by that description.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

TEXT = T.StringType()
WHOLE = T.IntegerType()
LONG = T.LongType()
MONEY = T.DecimalType(10, 2)
CLOCK = T.TimestampNTZType()
DAY = T.DateType()
REAL = T.DoubleType()


def struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# One record as the message broker's reader delivers it.
RECORD = struct(
    key=T.BinaryType(), value=T.BinaryType(), topic=TEXT, partition=WHOLE, offset=LONG,
    timestamp=T.TimestampType(), timestampType=WHOLE,
)

# The parts of a change envelope the log needs. Row images stay text: declaring them as strings
# makes the JSON reader hand over the raw sub-documents in the same single parse.
ENVELOPE = struct(
    op=TEXT, ts_ms=LONG,
    source=struct(ts_ms=LONG, table=TEXT, db=TEXT, lsn=LONG),
    before=TEXT, after=TEXT,
)

# Event log ("Bronze"): one schema for all entities.
EVENT = struct(
    _cdc_op=TEXT, _cdc_source_ts_ms=LONG, _cdc_event_ts_ms=LONG, _cdc_ingested_at=T.TimestampType(),
    _cdc_topic=TEXT, _cdc_partition=WHOLE, _cdc_offset=LONG, before_json=TEXT, after_json=TEXT,
)
# Folders of the log, outermost first: one table's history can be listed and read on its own,
# then pruned by day; the last two name the batch, so that a repeated batch replaces itself.
EVENT_FOLDERS = struct(source_table=TEXT, ingest_date=DAY, run_id=TEXT, batch_id=LONG)
EVENT_FILE = T.StructType(EVENT.fields + EVENT_FOLDERS.fields)
REQUIRED_IN_EVENT = (
    "_cdc_op", "_cdc_source_ts_ms", "_cdc_event_ts_ms", "_cdc_ingested_at",
    "_cdc_topic", "_cdc_partition", "_cdc_offset",
)

# Columns every current-state ("Silver") table carries after its own.
AUDIT = struct(
    _cdc_op=TEXT, _cdc_source_ts_ms=LONG, _cdc_offset=LONG, is_deleted=T.BooleanType(),
    _silver_updated_at=CLOCK,
)


class Entity(NamedTuple):
    """A captured table: what its rows are called, keyed by, and stored as."""

    name: str
    key: tuple[str, ...]
    columns: dict[str, T.DataType]
    layout: tuple[str, str]  # partition transform and its column
    clustered: str | None  # column whose hash puts rows into buckets: only of the large tables, joined by it
    renamed: dict[str, str] = {}  # column -> field of the source row

    def source_field(self, column: str) -> str:
        return self.renamed.get(column, column)

    @property
    def payload(self) -> T.StructType:
        """The row image read as text, so that one parse serves every column and type."""
        return T.StructType([T.StructField(self.source_field(c), TEXT) for c in self.columns])

    @property
    def source(self) -> T.StructType:
        return T.StructType([T.StructField(self.source_field(c), kind) for c, kind in self.columns.items()])

    @property
    def state(self) -> T.StructType:
        return T.StructType([T.StructField(c, kind) for c, kind in self.columns.items()] + AUDIT.fields)

    @property
    def required(self) -> tuple[str, ...]:
        return (*self.key, "is_deleted", "_silver_updated_at")


ENTITIES: dict[str, Entity] = {
    entity.name: entity
    for entity in (
        Entity(
            "orders", ("order_id",),
            dict(
                order_id=TEXT, customer_id=TEXT, status=TEXT, purchased_at=CLOCK, approved_at=CLOCK,
                delivered_carrier_at=CLOCK, delivered_customer_at=CLOCK, estimated_delivery_date=DAY,
            ),
            ("month", "purchased_at"), "order_id",
            dict(
                status="order_status", purchased_at="order_purchase_timestamp",
                approved_at="order_approved_at", delivered_carrier_at="order_delivered_carrier",
                delivered_customer_at="order_delivered_customer",
                estimated_delivery_date="order_estimated_delivery",
            ),
        ),
        Entity(
            "order_items", ("order_id", "order_item_id"),
            dict(
                order_id=TEXT, order_item_id=WHOLE, product_id=TEXT, seller_id=TEXT,
                shipping_limit_date=CLOCK, price=MONEY, freight_value=MONEY,
            ),
            ("bucket", "order_id"), "order_id",
        ),
        Entity(
            "customers", ("customer_id",),
            dict(
                customer_id=TEXT, customer_unique_id=TEXT, customer_zip_code=TEXT,
                customer_city=TEXT, customer_state=TEXT,
            ),
            ("identity", "customer_state"), None,
        ),
        Entity(
            "products", ("product_id",),
            dict(
                product_id=TEXT, product_category=TEXT, product_name_length=WHOLE,
                product_desc_length=WHOLE, product_photos_qty=WHOLE, product_weight_g=WHOLE,
                product_length_cm=WHOLE, product_height_cm=WHOLE, product_width_cm=WHOLE,
            ),
            ("identity", "product_category"), None,
        ),
        Entity(
            "sellers", ("seller_id",),
            dict(seller_id=TEXT, seller_zip_code=TEXT, seller_city=TEXT, seller_state=TEXT),
            ("identity", "seller_state"), None,
        ),
        Entity(
            "order_payments", ("order_id", "payment_sequential"),
            dict(
                order_id=TEXT, payment_sequential=WHOLE, payment_type=TEXT,
                payment_installments=WHOLE, payment_value=MONEY,
            ),
            ("bucket", "order_id"), "order_id",
        ),
        Entity(
            "order_reviews", ("review_id", "order_id"),
            dict(
                review_id=TEXT, order_id=TEXT, review_score=WHOLE, review_comment_title=TEXT,
                review_comment_msg=TEXT, review_creation_date=CLOCK, review_answer_date=CLOCK,
            ),
            ("month", "review_creation_date"), "order_id",
        ),
    )
}

# Lookup tables that are loaded from files but never captured as changes.
LOOKUPS: dict[str, T.StructType] = {
    "geolocation": struct(
        geolocation_zip_code=TEXT, geolocation_lat=REAL, geolocation_lng=REAL,
        geolocation_city=TEXT, geolocation_state=TEXT,
    ),
    "category_translations": struct(product_category_name=TEXT, product_category_name_english=TEXT),
}

# (child table, its column, parent table): the parent's key column has the same name.
FOREIGN_KEYS = (
    ("orders", "customer_id", "customers"),
    ("order_items", "order_id", "orders"),
    ("order_items", "product_id", "products"),
    ("order_items", "seller_id", "sellers"),
    ("order_payments", "order_id", "orders"),
    ("order_reviews", "order_id", "orders"),
)

TOTAL = T.DecimalType(20, 2)
GOLD: dict[str, T.StructType] = {
    "daily_revenue": struct(
        order_date=DAY, category=TEXT, total_revenue=TOTAL, total_freight=TOTAL,
        order_count=LONG, unique_customers=LONG,
    ),
    "top_sellers": struct(
        seller_id=TEXT, seller_city=TEXT, seller_state=TEXT, total_orders=LONG, gmv=TOTAL,
        total_freight=TOTAL, delivery_rate_pct=REAL, avg_delivery_days=REAL,
    ),
    "review_sentiment_by_state": struct(
        customer_state=TEXT, review_count=LONG, avg_score=REAL, positive_count=LONG,
        neutral_count=LONG, negative_count=LONG, positive_rate_pct=REAL,
    ),
    "order_funnel": struct(
        order_week=CLOCK, total_created=LONG, approved=LONG, invoiced_or_later=LONG, shipped=LONG,
        delivered=LONG, canceled=LONG, delivery_rate_pct=REAL,
    ),
}

# How stored reports are split: partition transform and its column, a group's first key.
GOLD_LAYOUT: dict[str, tuple[str, str]] = {
    "daily_revenue": ("month", "order_date"),
    "top_sellers": ("bucket", "seller_id"),
    "review_sentiment_by_state": ("identity", "customer_state"),
    "order_funnel": ("month", "order_week"),
}
# The column by which a stored report's files are sorted, largest first, so that a filter on it reads their heads only.
GOLD_LARGEST_FIRST: dict[str, str] = {
    "daily_revenue": "order_date", "top_sellers": "gmv", "review_sentiment_by_state": "review_count", "order_funnel": "order_week",
}
