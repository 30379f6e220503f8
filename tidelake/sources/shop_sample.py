"""The driver's warehouse tables seen as the shop: current-state rows and their change history.

All of it is derived by Spark from the tables in a folder, row for row, so every use of it grows
with them. The history gives each order a life that ends in its mapped row: a snapshot, updates,
repeats, late and tied events, deletes and re-inserts. Which events an order gets depends on its
number; every order takes part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidelake.operators.latest import latest_per_key
from tidelake.schemas import ENTITIES, Entity
from tidelake.sources.storage import totals

T0_MS = 1_704_067_200_000  # fixed value: 2024-01-01 00:00:00 UTC
TOPIC_PREFIX = "shop.public"

c = F.col


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def size(spark: SparkSession, folder: str) -> int:
    """Bytes of the files that the shop is made of."""
    return sum(totals(spark, f"{folder}/{name}.parquet")[1] for name in ("customer", "supplier", "part", "orders", "lineitem"))


def _text(column: Column) -> Column:
    return column.cast("string")


def _days(count: Column) -> Column:
    return F.make_dt_interval(days=count.cast("int"))


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    m, state, day = c("o_orderkey"), c("o_orderstatus"), c("o_orderdate")
    fifth = F.array(*[F.lit(s) for s in ("canceled", "processing", "invoiced", "approved", "unavailable")])
    return _table(spark, folder, "orders").select(
        m.alias("m"),
        _text(m).alias("order_id"), _text(c("o_custkey")).alias("customer_id"),
        F.when(state == "F", "delivered").when(state == "O", "shipped")
        .otherwise(F.get(fifth, (m % 5).cast("int"))).alias("status"),
        (day + F.make_dt_interval(secs=(m * 7919 % 86400).cast("decimal(18,6)"))).alias("purchased_at"),
        F.when(~((state == "P") & (m % 5 == 0)), day + _days(1 + m % 2)).alias("approved_at"),
        F.when(state.isin("F", "O"), day + _days(1 + m % 7)).alias("delivered_carrier_at"),
        F.when(state == "F", day + _days(1 + m % 20)).alias("delivered_customer_at"),
        F.to_date(day + _days(1 + m % 30)).alias("estimated_delivery_date"),
        ((m % 97 == 0) & (m % 194 != 0)).alias("is_deleted"),
    )


LINE_ORDER = (
    "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
)


def latest_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines repeat their key; the last one by all other columns is the current row."""
    return latest_per_key(
        _table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], [c(n).desc() for n in LINE_ORDER]
    )


def _order_items(spark: SparkSession, folder: str) -> DataFrame:
    return latest_lines(spark, folder).select(
        (c("l_orderkey") * 10 + c("l_linenumber")).alias("m"),
        _text(c("l_orderkey")).alias("order_id"), c("l_linenumber").cast("int").alias("order_item_id"),
        _text(c("l_partkey")).alias("product_id"), _text(c("l_suppkey")).alias("seller_id"),
        c("l_shipdate").alias("shipping_limit_date"), c("l_extendedprice").cast("decimal(10,2)").alias("price"),
        c("l_quantity").cast("decimal(10,2)").alias("freight_value"), (c("l_orderkey") % 89 == 0).alias("is_deleted"),
    )


def _with_state(rows: DataFrame, nation_key: str, spark: SparkSession, folder: str) -> DataFrame:
    nations = _table(spark, folder, "nation").select(c("n_nationkey").alias(nation_key), "n_name")
    return rows.join(nations, nation_key)


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    m = c("c_custkey")
    return _with_state(_table(spark, folder, "customer"), "c_nationkey", spark, folder).select(
        m.alias("m"), _text(m).alias("customer_id"), _text(m % 500).alias("customer_unique_id"),
        _text(10000 + m).alias("customer_zip_code"), c("c_mktsegment").alias("customer_city"),
        c("n_name").alias("customer_state"), (m % 211 == 0).alias("is_deleted"),
    )


def _sellers(spark: SparkSession, folder: str) -> DataFrame:
    m = c("s_suppkey")
    return _with_state(_table(spark, folder, "supplier"), "s_nationkey", spark, folder).select(
        m.alias("m"), _text(m).alias("seller_id"), _text(20000 + m).alias("seller_zip_code"),
        c("s_name").alias("seller_city"), c("n_name").alias("seller_state"), (m % 41 == 0).alias("is_deleted"),
    )


def _products(spark: SparkSession, folder: str) -> DataFrame:
    m, size = c("p_partkey"), c("p_size")
    whole = lambda column, name: column.cast("int").alias(name)
    return _table(spark, folder, "part").select(
        m.alias("m"), _text(m).alias("product_id"), F.when(m % 113 != 0, c("p_type")).alias("product_category"),
        whole(F.length("p_name"), "product_name_length"), whole(size * 10, "product_desc_length"),
        whole(m % 6, "product_photos_qty"), whole(size * 100, "product_weight_g"),
        whole(size, "product_length_cm"), whole(size + 1, "product_height_cm"), whole(size + 2, "product_width_cm"),
        (m % 103 == 0).alias("is_deleted"),
    )


def _order_payments(spark: SparkSession, folder: str) -> DataFrame:
    m = c("o_orderkey")
    numbers = F.when(m % 20 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        _table(spark, folder, "orders").withColumn("n", F.explode(numbers)).select(
            (m * 10 + c("n")).alias("m"), _text(m).alias("order_id"), c("n").alias("payment_sequential"),
            F.lower(F.substring("o_orderpriority", 3, 20)).alias("payment_type"), (1 + m % 12).cast("int").alias("payment_installments"),
            c("o_totalprice").cast("decimal(10,2)").alias("payment_value"), F.lit(False).alias("is_deleted"),
        )
    )


def _order_reviews(spark: SparkSession, folder: str) -> DataFrame:
    m, day = c("o_orderkey"), c("o_orderdate")
    return _table(spark, folder, "orders").select(
        (m * 10 + 1).alias("m"), _text(m * 10 + 1).alias("review_id"), _text(m).alias("order_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("review_score"),
        F.when(m % 5 != 0, c("o_orderpriority")).alias("review_comment_title"),
        F.lit(None).cast("string").alias("review_comment_msg"),
        (day + _days(m % 30)).alias("review_creation_date"),
        (day + _days(m % 30 + m % 5)).alias("review_answer_date"), (m % 307 == 0).alias("is_deleted"),
    )


_MAPPED = {
    "orders": _orders, "order_items": _order_items, "customers": _customers, "products": _products,
    "sellers": _sellers, "order_payments": _order_payments, "order_reviews": _order_reviews,
}


def mapped(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Rows of an entity with their number ``m``, the state their history ends in."""
    return _MAPPED[name](spark, folder)


def current(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return mapped(spark, folder, name).drop("m")


def current_tables(spark: SparkSession, folder: str, names: Iterable[str] = tuple(ENTITIES)) -> dict[str, DataFrame]:
    return {name: current(spark, folder, name) for name in names}


# ---- change history ----------------------------------------------------------------------------


def _event(kind: str, when: Column, batch: int, late_ms: int, seq: int, status: Column | None = None) -> Column:
    """An entry of a row's history, NULL where the row does not get it."""
    return F.when(
        when,
        F.struct(
            F.lit(kind).alias("kind"), F.lit(batch).alias("batch"), (F.lit(T0_MS + late_ms)).alias("ts_ms"),
            F.lit(seq).alias("seq"), (F.lit(None).cast("string") if status is None else status).alias("status"),
        ),
    )


def _history(entity: Entity) -> Column:
    m = c("m")
    always = F.lit(True)
    if entity.name != "orders":
        return F.array(_event("r", always, 1, 0, 0), _event("d", c("is_deleted"), 2, 2000, 4))
    first_status = F.when(m % 3 == 0, "created")
    return F.array(
        _event("r", always, 1, 0, 0, first_status),
        _event("r", m % 53 == 0, 1, 0, 0, first_status),
        _event("u", m % 3 == 0, 2, 1000, 1, F.when(m % 177 == 0, "tie_loser")),
        _event("u", m % 59 == 0, 2, 1000, 2),
        _event("u", m % 101 == 0, 2, -1000, 3, F.lit("late")),
        _event("d", m % 97 == 0, 2, 2000, 4),
        _event("tombstone", m % 97 == 0, 2, 2000, 4),
        _event("junk", m % 500 == 0, 2, 0, 0),
        _event("c", m % 194 == 0, 3, 3000, 5),
    )


def _encoded(column: Column, kind, as_epoch: bool) -> Column:
    name = kind.typeName()
    if name == "timestamp_ntz":
        return F.unix_micros(column.cast("timestamp")) if as_epoch else column
    if name == "date":
        return F.unix_date(column) if as_epoch else column
    return column.cast("string") if name == "decimal" and as_epoch else column


def _image(entity: Entity, as_epoch: bool, row: str) -> Column:
    """The row as the source holds it: source field names, times in one of the two encodings."""
    fields = []
    for name, kind in entity.columns.items():
        value = c(f"{row}.{name}")
        if entity.name == "orders" and name == "status":
            value = F.coalesce(c("event.status"), value)
        fields.append(_encoded(value, kind, as_epoch).alias(entity.source_field(name)))
    return F.struct(*fields)


def _envelope(entity: Entity, as_epoch: bool, row: str) -> Column:
    op = c("event.kind")
    image = _image(entity, as_epoch, row)
    source = F.struct(
        c("event.ts_ms").alias("ts_ms"), F.lit(entity.name).alias("table"), F.lit("shop").alias("db"), c("m").alias("lsn")
    )
    doc = F.struct(
        op.alias("op"), (c("event.ts_ms") + 200).alias("ts_ms"), source.alias("source"),
        F.when(op.isin("u", "d"), image).alias("before"), F.when(op != "d", image).alias("after"),
    )
    return F.to_json(doc, {"ignoreNullFields": "false"})


def _by_name(names: Iterable[str], value: Callable[[str], Column]) -> Column:
    first, *others = names
    return reduce(lambda chosen, n: chosen.when(c("name") == n, value(n)), others, F.when(c("name") == first, value(first)))


def _records(rows: DataFrame, names: Iterable[str]) -> DataFrame:
    """The histories of rows that stand, by the ``name`` of their entity, in a column of that name."""
    rows = rows.withColumn("event", F.explode(F.array_compact(_by_name(names, lambda n: _history(ENTITIES[n])))))
    text_times = (c("event.batch") == 1) & (c("m") % 2 == 0)
    value = (
        F.when(c("event.kind") == "tombstone", None).when(c("event.kind") == "junk", "not json")
        .when(text_times, _by_name(names, lambda n: _envelope(ENTITIES[n], False, n)))
        .otherwise(_by_name(names, lambda n: _envelope(ENTITIES[n], True, n)))
    )
    arrived_ms = c("event.ts_ms") + (c("m") % 60) * 1000 + 250
    return rows.select(
        _text(c("m")).cast("binary").alias("key"), value.cast("binary").alias("value"),
        F.concat(F.lit(f"{TOPIC_PREFIX}."), "name").alias("topic"), (c("m") % 3).cast("int").alias("partition"),
        (c("m") * 6 + c("event.seq")).alias("offset"), F.timestamp_millis(arrived_ms).alias("timestamp"),
        F.lit(0).alias("timestampType"), c("event.batch").alias("batch"),
    )


def _named_rows(spark: SparkSession, folder: str, name: str, names: Iterable[str]) -> DataFrame:
    """Mapped rows in a column of their entity's name, beside a null one for each other entity."""
    row = F.struct(*ENTITIES[name].columns)
    others = {n: F.lit(None).cast(T.StructType([T.StructField(k, kind) for k, kind in ENTITIES[n].columns.items()])) for n in names}
    return mapped(spark, folder, name).select("m", "is_deleted", F.lit(name).alias("name"), *[(row if n == name else others[n]).alias(n) for n in names])


def changes(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The history of one entity as broker records, with the ``batch`` each arrives in.

    Odd rows of a first batch carry epoch numbers and even ones ISO text, as the two loaders do.
    A record's time is its commit time plus ``m % 60`` seconds and 250 ms.
    """
    return _records(_named_rows(spark, folder, name, [name]), [name])


def all_changes(spark: SparkSession, folder: str, names: Iterable[str] = tuple(ENTITIES)) -> DataFrame:
    first, *others = [changes(spark, folder, name) for name in names]
    for other in others:
        first = first.unionByName(other)
    return first


def dealt_changes(spark: SparkSession, folder: str, parts: int, names: Iterable[str] = tuple(ENTITIES)) -> DataFrame:
    """As :func:`all_changes`, in ``parts`` parts of records of all entities: rows are exchanged, not the
    records made of them, which have their texts once or twice."""
    names = list(names)
    rows = reduce(DataFrame.unionByName, [_named_rows(spark, folder, name, names) for name in names])
    return _records(rows.repartition(parts, "name", "m"), names)
