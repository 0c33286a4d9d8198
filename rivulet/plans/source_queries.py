"""Registered queries of sources, positions, the change log and values, each with its SQL."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import normalize as norm
from ..functions.types import AvroColumn, log_column
from ..operators import changes, envelope, snapshot
from ..operators.envelope import parse_position
from ..operators.storage import shared_folder
from ..operators.tables import FileTable
from ..sources import catalog, jdbc
from ..sources.backend import FolderBackend
from ..streaming import apply
from ..streaming.changelog import ChangeLogSource, write_log
from .config import SinkConfig, SourceConfig
from .queries import LAST_SQL, event_log, query, read
from .source import Source

LAST_ROW = (1 << 31) - 1


def folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"


def source_of(spark: SparkSession, sf_dir: str, rules: str, log: DataFrame | None = None, place: str | None = None, position: str = "", primary: dict | None = None, **options: str) -> Source:
    """A source over the folder's tables, with ``log`` beside them."""
    place = place or folder(spark)
    write_log(event_log(spark, sf_dir).limit(0) if log is None else log, f"{place}/log")
    config = SourceConfig.from_options({"dsn": "user:secret@tcp(host)/db", "tables": rules, "sdk.batch.delay.ms": "0", **{k.replace("__", "."): v for k, v in options.items()}})
    keys = primary or {"orders": ("o_orderkey",), "conversations": ("conv_id", "turn"), "customer": ("c_custkey",), "events": ("event_id",)}
    return Source.open(spark, config, FolderBackend(spark, sf_dir, f"{place}/log", keys, "7"), position)


# ---- options and discovery -----------------------------------------------------


@query("SELECT unnest(['benchmark', 'conversations', 'customer', 'documents', 'embeddings', 'events', 'labels', 'lineitem', 'nation', 'orders', 'pages', 'part', 'region', 'supplier']) AS table_name")
def list_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = FolderBackend(spark, sf_dir, "").tables()
    return spark.createDataFrame([(n,) for n in names], "table_name string")


@query("""
SELECT * FROM (VALUES ('batch_delay_ms', '1000'), ('batch_size', '10000'), ('database', 'db'), ('fetch_size', '10000'), ('snapshot', 'True'), ('sorting', 'users=at'), ('tables', '*,-x'), ('unsafe', 'False'), ('url', 'jdbc:mysql://host:3306/db'), ('parseTime', 'true')) t(name, value)
""")
def config_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .config import Dsn

    dsn = "user:secret@tcp(host)/db"
    c = SourceConfig.from_options({"dsn": dsn, "tables": "*, -x", "tableConfig.users.sortingColumn": " at ", "snapshot.fetchSize": "0"})
    rows = {"batch_delay_ms": c.batch_delay_ms, "batch_size": c.batch_size, "database": c.database, "fetch_size": c.fetch_size, "snapshot": c.snapshot, "sorting": ",".join(f"{k}={v}" for k, v in c.sorting.items()), "tables": ",".join(c.tables), "unsafe": c.unsafe, "url": Dsn.parse(dsn).jdbc_url(), "parseTime": Dsn.parse(dsn).params["parseTime"]}
    return spark.createDataFrame([(k, str(v)) for k, v in rows.items()], "name string, value string")


@query("SELECT * FROM (VALUES ('batch_size', '500'), ('burst', '10'), ('keys', 'users=id'), ('rate_per_second', '100.0'), ('placeholder', '%s')) t(name, value)")
def sink_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .source import Sink

    sink = Sink.open(SinkConfig("user@tcp(host)/db", 500, 0, 100.0, 10, {"users": ("id",)}), connect=lambda: None)
    rows = {"batch_size": sink.config.batch_size, "burst": sink.config.burst, "keys": ",".join(f"{t}={'+'.join(k)}" for t, k in sink.config.keys.items()), "rate_per_second": sink.config.rate_per_second, "placeholder": sink.db.placeholder}
    return spark.createDataFrame([(k, str(v)) for k, v in rows.items()], "name string, value string")


@query("SELECT * FROM (VALUES ('orders', 'o_orderkey', 1), ('events', 'event_id', 2), ('orders', 'o_orderkey', 2)) t(table_name, key, look_ups)")
def key_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen: list[str] = []
    keys = {"orders": ("o_orderkey",), "events": ("event_id",)}
    cache = catalog.KeyCache(lambda t: seen.append(t) or keys[t])
    return spark.createDataFrame([(t, "+".join(cache.get(t)), len(seen)) for t in ("orders", "events", "orders")], "table_name string, key string, look_ups int")


@query("SELECT * FROM (VALUES ('lock', 'FLUSH TABLES `a```, `b` WITH READ LOCK'), ('unlock', 'UNLOCK TABLES'), ('server id', 'SELECT @@server_id AS server_id')) t(name, statement)")
def lock_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a connection is told while bounds and mark are taken, recorded by one that does nothing else."""
    said: list[str] = []

    class Connection:
        def cursor(self) -> Connection:
            return self

        def execute(self, statement: str) -> None:
            said.append(statement)

        def close(self) -> None:
            said.append("closed")

    with jdbc.locked(Connection, jdbc.Database("jdbc:mysql://h/db", "d"), ["b", "a`"]):
        pass
    return spark.createDataFrame([("lock", said[0]), ("unlock", said[1]), ("server id", jdbc.server_id_sql())], "name string, statement string")


@query("SELECT 'KeyNotInTable' AS error, 'no column o_none' AS message, count(*) AS n_rows FROM orders")
def key_not_in_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders")
    try:
        snapshot.plan(orders, "orders", ("o_none",))
        found = ("none", "")
    except snapshot.KeyNotInTable as e:
        found = (type(e).__name__, str(e))
    return orders.agg(F.lit(found[0]).alias("error"), F.lit(found[1]).alias("message"), F.count("*").alias("n_rows"))


@query("""
SELECT 'conversations' AS table_name, 'composite' AS strategy, 'conv_id+turn' AS sort_key, (SELECT conv_id || ',' || turn FROM conversations ORDER BY conv_id, turn LIMIT 1) AS first, (SELECT conv_id || ',' || turn FROM conversations ORDER BY conv_id DESC, turn DESC LIMIT 1) AS last
UNION ALL SELECT 'customer', 'single', 'c_custkey', min(c_custkey)::VARCHAR, max(c_custkey)::VARCHAR FROM customer
UNION ALL SELECT 'nation', 'offset', '', '', ''
UNION ALL SELECT 'orders', 'single', 'o_orderkey', min(o_orderkey)::VARCHAR, max(o_orderkey)::VARCHAR FROM orders
""")
def source_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a source finds when it opens: the tables that the rules include, their keys, strategies and bounds."""
    source = source_of(spark, sf_dir, "customer,^orders$,conv,+^nation$,-embed", snapshot__unsafe="true")
    text = lambda key: ",".join(map(str, key or ()))
    return spark.createDataFrame([(t, s.strategy, "+".join(s.keys), text(s.start), text(s.end)) for t, s in source.plan.scans.items()], "table_name string, strategy string, sort_key string, first string, last string")


# ---- snapshots with positions --------------------------------------------------


@query("""
SELECT o_orderkey, 'orders' AS collection, '7' AS server_id, 'mysql.orders_payload' AS payload_subject,
  '{"snapshot_position":{"snapshots":{"orders":{"key_name":"o_orderkey","last_read":' || o_orderkey || ',"snapshot_end":' || (SELECT max(o_orderkey) FROM orders) || '}},"mark":{"name":"","pos":-1,"idx":-1}}}' AS position
FROM orders
""")
def snapshot_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each record's cumulative position, as the text that a restart reads."""
    found = source_of(spark, sf_dir, "^orders$").snapshot()["orders"]
    return found.select("after.o_orderkey", "collection", F.col("metadata")[envelope.SERVER_ID_KEY].alias("server_id"), F.col("metadata")["payload_schema_subject"].alias("payload_subject"), "position")


PAGES = 4


@query(f"""
WITH n AS (SELECT (count(*) + {PAGES} - 1) // {PAGES} AS size, max(c_custkey) AS last FROM customer),
p AS (SELECT c_custkey, (row_number() OVER (ORDER BY c_custkey) - 1) // size AS page, last FROM customer, n)
SELECT c_custkey, page, max(c_custkey) OVER (PARTITION BY page) AS read_to, last AS snapshot_end FROM p
""")
def snapshot_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table in four pages, each read by a source that opened at the position after the one before."""
    size = -(-read(spark, sf_dir, "customer").count() // PAGES)
    position, out = "", None
    for page in range(PAGES):
        source = source_of(spark, sf_dir, "customer", position=position, snapshot__fetchSize=str(size))
        _, records, position = next(source.pages())
        at = parse_position(position)
        read_to, end = (at[0]["customer"][0].last_read, at[0]["customer"][0].snapshot_end) if isinstance(at, tuple) else (source.plan.scans["customer"].end[0],) * 2
        found = records.select("after.c_custkey", F.lit(page).cast("long").alias("page"), F.lit(read_to).cast("long").alias("read_to"), F.lit(end).cast("long").alias("snapshot_end"))
        out = found if out is None else out.unionByName(found)
    return out


@query("SELECT conv_id, turn, 'conv_id' AS key_1, 'turn' AS key_2, turn AS last_2, (SELECT max(conv_id) FROM conversations) AS end_1 FROM conversations")
def snapshot_key_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions of composite keys name every key."""
    found = source_of(spark, sf_dir, "conv").snapshot()["conversations"]
    keys = F.from_json(F.get_json_object("position", "$.snapshot_position.snapshots.conversations"), "array<struct<key_name: string, last_read: long, snapshot_end: long>>")
    return found.withColumn("k", keys).select("after.conv_id", "after.turn", F.col("k")[0]["key_name"].alias("key_1"), F.col("k")[1]["key_name"].alias("key_2"), F.col("k")[1]["last_read"].alias("last_2"), F.col("k")[0]["snapshot_end"].alias("end_1"))


@query("SELECT o_orderkey, o_orderkey // 7 AS k FROM orders WHERE o_orderkey % 7 <> 0")
def snapshot_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose sort key is null are in no range."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, F.floor(F.col("o_orderkey") / 7)).alias("k"))
    return snapshot.scan(orders, snapshot.plan(orders, "orders", ("k",)))


# ---- the change log as a source ------------------------------------------------


@query("SELECT * FROM (VALUES (0, 'file', 'string'), (1, 'pos', 'bigint'), (2, 'idx', 'int'), (3, 'n_rows', 'int'), (4, 'ts', 'bigint'), (5, 'server_id', 'bigint'), (6, 'database', 'string'), (7, 'collection', 'string'), (8, 'action', 'string'), (9, 'before', 'string'), (10, 'after', 'string')) t(place, name, type)")
def log_source_registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.dataSource.register(ChangeLogSource)
    schema = spark.read.format("changelog").option("path", "/").load().schema
    return spark.createDataFrame([(i, f.name, f.dataType.simpleString()) for i, f in enumerate(schema.fields)], "place int, name string, type string")


@query("""
SELECT printf('binlog.%06d', event_id // 1000 + 1) AS file, event_id % 1000 * 10 + 4 AS pos, 0 AS idx, CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete' ELSE 'update' END AS action,
  user_id, CASE event_type WHEN 'error' THEN NULL ELSE value END AS after_value
FROM events WHERE event_id > (SELECT max(event_id) // 3 FROM events)
""")
def log_source_from_a_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log's files, read by the registered source from inside a file on; other databases and tables are left out."""
    place = folder(spark)
    log = event_log(spark, sf_dir)
    other = log.where("pos % 3 = 0").withColumns({"pos": F.col("pos") + 1, "database": F.lit("other")}).unionByName(log.where("pos % 5 = 0").withColumns({"pos": F.col("pos") + 2, "action": F.lit("ddl")}))
    write_log(log.unionByName(other), f"{place}/log")
    spark.dataSource.register(ChangeLogSource)
    last = read(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] // 3
    start = json.dumps({"name": f"binlog.{last // 1000 + 1:06d}", "pos": last % 1000 * 10 + 4, "idx": LAST_ROW})
    found = spark.read.format("changelog").option("path", f"{place}/log").option("database", "db").option("tables", "users").option("startingposition", start).load()
    image = F.from_json(F.coalesce("after", "before"), "user_id long, value double")
    return found.select("file", "pos", "idx", "action", image["user_id"].alias("user_id"), F.when(F.col("after").isNotNull(), image["value"]).alias("after_value"))


MOST_ROWS = 4000


@query(f"SELECT event_id, CAST((row_number() OVER (ORDER BY event_id) - 1) // {MOST_ROWS} AS BIGINT) AS batch FROM events")
def log_source_bounded_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log streamed by the registered source, at most 4,000 rows a micro-batch, which are numbered here."""
    place = folder(spark)
    log = event_log(spark, sf_dir)
    write_log(log, f"{place}/log")
    spark.dataSource.register(ChangeLogSource)
    stream = spark.readStream.format("changelog").option("path", f"{place}/log").option("maxrows", str(MOST_ROWS)).option("checkpoint", f"{place}/checkpoint").load()

    def keep(batch: DataFrame, number: int) -> None:
        number_of = F.regexp_extract("file", r"(\d+)$", 1).cast("long")
        batch.select(((number_of - 1) * 1000 + (F.col("pos") - 4) / 10).cast("long").alias("event_id"), F.lit(number).cast("long").alias("batch")).write.mode("overwrite").parquet(f"{place}/out/n={number}")

    apply.drain(stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{place}/checkpoint").start())
    return spark.read.parquet(f"{place}/out").select("event_id", "batch")


@query(f"""
{LAST_SQL}
SELECT user_id, event_type, value FROM l WHERE r = 1 AND event_type <> 'error'
""")
def cdc_stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log streamed by the registered source, in micro-batches of a bounded number of rows, into a file table."""
    place = folder(spark)
    write_log(event_log(spark, sf_dir), f"{place}/log")
    spark.dataSource.register(ChangeLogSource)
    schema = "user_id long, event_type string, value double"
    target = FileTable(spark, f"{place}/users", ("user_id",), buckets=8)
    target.write(spark.createDataFrame([], schema))
    stream = spark.readStream.format("changelog").option("path", f"{place}/log").option("database", "db").option("maxrows", str(MOST_ROWS)).option("checkpoint", f"{place}/checkpoint").load()
    apply.drain(apply.start(stream, {"users": (target, schema, ("user_id",))}, f"{place}/checkpoint", delay_ms=0))
    return target.read()


#: Log files that come while the stream runs.
LATE_FILES = 8


SINCE = """
WITH l AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events)
SELECT user_id AS c_custkey, event_type AS c_mktsegment, value AS c_acctbal FROM l WHERE r = 1 AND event_type <> 'error'
UNION ALL SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)
"""


@query(SINCE)
def source_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From options to a table: the source opens, its snapshot is written, the log that came meanwhile is caught up with,
    what comes later is streamed in, the source is torn down."""
    place = folder(spark)
    log = event_log(spark, sf_dir).withColumns({"collection": F.lit("customer"), "rows": F.transform("rows", lambda r: F.struct(r["user_id"].alias("c_custkey"), r["event_type"].alias("c_mktsegment"), r["value"].alias("c_acctbal")))})
    read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal").write.parquet(f"{place}/tables/customer.parquet")
    source = source_of(spark, f"{place}/tables", "customer", log.limit(0), place, sdk__batch__size=str(MOST_ROWS))
    last = read(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] or 0
    late = F.col("file") > f"binlog.{max(0, last // 1000 - LATE_FILES + 1):06d}"
    write_log(log.where(~late), f"{place}/log")  # after the mark was taken
    target = FileTable(spark, f"{place}/customer", buckets=8)
    stream = source.run({"customer": target}, f"{place}/checkpoint")
    write_log(log.where(late), f"{place}/log")
    apply.drain(stream)
    source.teardown()
    return target.read()


@query("SELECT event_id, 'update' AS operation FROM events WHERE event_type NOT IN ('signup', 'error') UNION ALL SELECT event_id, CASE event_type WHEN 'signup' THEN 'create' ELSE 'delete' END FROM events WHERE event_type IN ('signup', 'error')")
def snapshot_disabled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the snapshot off a source has no scans, and its feed is the log alone."""
    from . import combined

    log = event_log(spark, sf_dir)
    source = source_of(spark, sf_dir, "customer", snapshot__enabled="false")
    if source.plan.scans or source.snapshot():
        raise AssertionError("a source without snapshot has no scans")
    keys = {**source.keys, "users": catalog.TableKeys((), ())}
    found = combined.feed({"customer": read(spark, sf_dir, "customer")}, keys, {"users": log}, combined.Plan(source.plan.scans, None))
    place = F.split("key", "_")
    event = ((F.regexp_extract(place[0], r"(\d+)$", 1).cast("long") - 1) * 1000 + (place[1].cast("long") - 4) / 10).cast("long")
    return found.select(event.alias("event_id"), "operation")


@query("""
WITH e AS (SELECT event_id, printf('binlog.%06d', event_id // 1000 + 1) AS file, event_id % 1000 * 10 + 4 AS pos FROM events),
p AS (SELECT *, lag(file) OVER (ORDER BY event_id) AS pf, lag(pos) OVER (ORDER BY event_id) AS pp FROM e)
SELECT event_id, '{"cdc_position":{"name":"' || file || '","pos":' || pos || CASE WHEN pf IS NULL THEN '' ELSE ',"prev":{"name":"' || pf || '","pos":' || pp || '}' END || '}}' AS position FROM p
""")
def cdc_position_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions of log records as the text that a restart reads."""
    found = changes.records(event_log(spark, sf_dir), ())
    at = F.col("position")
    event = ((changes.file_number(at["name"]) - 1) * 1000 + (at["pos"] - 4) / 10).cast("long")
    return found.select(event.alias("event_id"), envelope.position_json(at).alias("position"))


# ---- types and values ----------------------------------------------------------


@query("""
SELECT * FROM (VALUES ('int(11) unsigned', 'long'), ('bigint(20) unsigned', 'long'), ('tinyint(1)', 'int'), ('smallint unsigned zerofill', 'int'), ('decimal(10,2)', 'double'), ('float', 'float'), ('double(10,2)', 'double'), ('bit(8)', 'fixed'), ('varchar(255)', 'string'), ('varbinary(10)', 'bytes'), ('longblob', 'bytes'), ('datetime(6)', 'string'), ('time', 'string'), ('year(4)', 'int'), ('enum(''a'',''b'')', 'string'), ('json', 'string'), ('point', 'string')) t(declared, avro)
""")
def log_column_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = ["int(11) unsigned", "bigint(20) unsigned", "tinyint(1)", "smallint unsigned zerofill", "decimal(10,2)", "float", "double(10,2)", "bit(8)", "varchar(255)", "varbinary(10)", "longblob", "datetime(6)", "time", "year(4)", "enum('a','b')", "json", "point"]
    return spark.createDataFrame([(d, log_column("c", d).avro) for d in declared], "declared string, avro string")


@query("SELECT 'c' AS name, 'c_fixed' AS type_name, 'fixed' AS type, 8 AS size")
def avro_bit_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = log_column("c", "bit(3)").field()
    return spark.createDataFrame([(f["name"], f["type"]["name"], f["type"]["type"], f["type"]["size"])], "name string, type_name string, type string, size int")


@query("SELECT p_partkey, p_name AS text FROM part")
def normalize_bytes_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "part").select("p_partkey", F.encode("p_name", "UTF-8").alias("text"))
    return norm.normalize(rows, [AvroColumn("text", "string")])


@query("SELECT p_partkey, p_name AS kept, encode(p_name) AS raw FROM part")
def normalize_text_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("kept"), F.col("p_name").alias("raw"))
    return norm.normalize(rows, [AvroColumn("raw", "bytes")])


@query("SELECT p_partkey, CAST(p_size AS BIGINT) AS wide FROM part")
def normalize_int_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "part").select("p_partkey", F.col("p_size").alias("wide"))
    return norm.normalize(rows, [AvroColumn("wide", "long")])


@query("SELECT o_orderkey, 9223372036854775807 - o_orderkey AS value FROM orders")
def normalize_uint64_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unsigned 64-bit numbers come as decimals; those that fit are longs to the last digit."""
    rows = read(spark, sf_dir, "orders").select("o_orderkey", (F.lit("9223372036854775807").cast("decimal(20,0)") - F.col("o_orderkey").cast("decimal(20,0)")).cast("decimal(20,0)").alias("value"))
    return norm.normalize(rows, [AvroColumn("value", "long")])


@query("SELECT c_custkey, c_custkey % 3 <> 0 AS flag FROM customer")
def normalize_int8_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % 3).cast("tinyint").alias("flag"))
    return norm.normalize(rows, [AvroColumn("flag", "boolean")])


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN lpad(to_hex(c_custkey), 16, '0') ELSE 'FFFF' || lpad(to_hex(c_custkey), 12, '0') END AS fixed_hex FROM customer")
def normalize_bit_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of a BIT column: the last eight, with zeros before fewer."""
    short = F.unhex(F.lpad(F.hex("c_custkey"), 12, "0"))
    rows = read(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, short).otherwise(F.concat(F.unhex(F.lit("01FFFF")), short)).alias("fixed"))
    return norm.normalize(rows, [AvroColumn("fixed", "fixed")]).select("c_custkey", F.hex("fixed").alias("fixed_hex"))


@query("SELECT c_custkey, CAST(c_acctbal AS FLOAT) AS single, c_acctbal AS same FROM customer")
def normalize_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").cast("float").alias("single"), F.col("c_acctbal").alias("same"))
    return norm.normalize(rows, [AvroColumn("single", "float"), AvroColumn("same", "double")])
