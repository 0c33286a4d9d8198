"""The registered queries of the engine, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import normalize as norm
from ..functions.types import AvroColumn, SchemaRegistry, canonical, columns_of, record_schema
from ..operators import changes, envelope, sink, snapshot
from ..operators.envelope import KeyPosition, LogPosition
from ..operators.ordering import with_row_number
from ..operators.snapshot import ScanSpec
from ..sources import catalog

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents"]
RULES = ["*", "-.*s$", "+^orders$", "-^region"]


# ---- discovery -----------------------------------------------------------------


@query("""
SELECT name, CASE WHEN regexp_matches(name, '^region') THEN false WHEN regexp_matches(name, '^orders$') THEN true WHEN regexp_matches(name, '.*s$') THEN false ELSE true END AS included
FROM (VALUES ('region'), ('nation'), ('customer'), ('supplier'), ('part'), ('orders'), ('lineitem'), ('events'), ('documents')) t(name)
""")
def table_filter_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(t,) for t in TABLES], "name string").select("name", catalog.rule_column(F.col("name"), RULES).alias("included"))


@query("SELECT * FROM (VALUES ('conversations', 1, 'conv_id'), ('conversations', 2, 'turn'), ('events', 1, 'ts'), ('orders', 1, 'o_orderkey')) t(table_name, ordinal, sort_key)")
def key_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    usage = [("db", "PRIMARY", "conversations", "turn", 2), ("db", "PRIMARY", "conversations", "conv_id", 1), ("db", "PRIMARY", "orders", "o_orderkey", 1), ("db", "PRIMARY", "events", "event_id", 1), ("other", "PRIMARY", "orders", "x", 1), ("db", "u1", "orders", "o_custkey", 1)]
    frame = spark.createDataFrame(usage, "table_schema string, constraint_name string, table_name string, column_name string, ordinal_position int")
    keys = catalog.resolve_keys(["conversations", "events", "orders"], catalog.primary_keys_in(frame, "db"), {"events": "ts"})
    return spark.createDataFrame([(t, i, k) for t, found in keys.items() for i, k in enumerate(found.sort, 1)], "table_name string, ordinal int, sort_key string")


# ---- bounds --------------------------------------------------------------------


@query("SELECT min(o_orderkey) AS min_o_orderkey, max(o_orderkey) AS max_o_orderkey FROM orders")
def key_bounds_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.key_bounds(read(spark, sf_dir, "orders"), ("o_orderkey",))


@query("SELECT min(conv_id) AS min_conv_id, max(conv_id) AS max_conv_id, min(turn) AS min_turn, max(turn) AS max_turn FROM conversations")
def key_bounds_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.key_bounds(read(spark, sf_dir, "conversations"), ("conv_id", "turn"))


@query("SELECT * FROM (SELECT min(o_orderkey) AS min_o_orderkey, max(o_orderkey) AS max_o_orderkey FROM orders WHERE false) WHERE min_o_orderkey IS NOT NULL")
def key_bounds_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.key_bounds(read(spark, sf_dir, "orders").where("false"), ("o_orderkey",))


@query("SELECT count(*) AS total FROM lineitem")
def count_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.count_total(read(spark, sf_dir, "lineitem"))


# ---- snapshots -----------------------------------------------------------------

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query("""
SELECT 'orders' AS collection, 'snapshot' AS operation, o_orderkey AS key_o_orderkey, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
  o_orderkey AS last_read, (SELECT max(o_orderkey) FROM orders) AS snapshot_end
FROM orders
""")
def snapshot_single_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders")
    found = snapshot.records(orders, snapshot.plan(orders, "orders", ("o_orderkey",)))
    return found.select("collection", "operation", F.col("key.o_orderkey").alias("key_o_orderkey"), *[f"after.{c}" for c in ORDER_COLUMNS], F.col("last_read.o_orderkey").alias("last_read"), F.col("snapshot_end.o_orderkey").alias("snapshot_end"))


@query("""
WITH e AS (SELECT conv_id, turn FROM conversations ORDER BY conv_id DESC, turn DESC LIMIT 1)
SELECT 'conversations' AS collection, 'snapshot' AS operation, c.conv_id, c.turn, c.role, c.text, e.conv_id AS end_conv_id, e.turn AS end_turn FROM conversations c, e
""")
def snapshot_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations")
    found = snapshot.records(rows, snapshot.plan(rows, "conversations", ("conv_id", "turn")))
    return found.select("collection", "operation", F.col("key.conv_id"), F.col("key.turn"), "after.role", "after.text", F.col("snapshot_end.conv_id").alias("end_conv_id"), F.col("snapshot_end.turn").alias("end_turn"))


@query("SELECT 'nation_' || (row_number() OVER (ORDER BY n_nationkey) - 1) AS key, 'snapshot' AS operation, n_nationkey, n_name, n_regionkey FROM nation")
def snapshot_no_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read(spark, sf_dir, "nation")
    return snapshot.records(nation, snapshot.plan(nation, "nation", ()), order=["n_nationkey"]).select("key", "operation", "after.*")


@query("SELECT event_id, ts AS last_read, (SELECT max(ts) FROM events) AS snapshot_end FROM events")
def snapshot_sorting_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events")
    keys = catalog.resolve_keys(["events"], {"events": ("event_id",)}, {"events": "ts"})["events"]
    found = snapshot.records(rows, snapshot.plan(rows, "events", keys.sort), keys.record)
    return found.select("key.event_id", F.col("last_read.ts").alias("last_read"), F.col("snapshot_end.ts").alias("snapshot_end"))


@query("SELECT o_orderkey, o_custkey FROM orders, (SELECT min(o_orderkey) AS a, max(o_orderkey) AS b FROM orders) WHERE o_orderkey > a + (b - a) // 3 AND o_orderkey <= b")
def snapshot_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of a scan that stopped after a third of the keys."""
    orders = read(spark, sf_dir, "orders")
    ((a,), (b,)) = snapshot.lexical_bounds(orders, ("o_orderkey",))
    return snapshot.scan(orders, snapshot.plan(orders, "orders", ("o_orderkey",), [KeyPosition("o_orderkey", a + (b - a) // 3, b)])).select("o_orderkey", "o_custkey")


@query("SELECT o_orderkey, o_custkey FROM orders, (SELECT min(o_orderkey) AS a, max(o_orderkey) AS b FROM orders) WHERE o_orderkey > a + (b - a) // 3 AND o_orderkey <= b ORDER BY o_orderkey LIMIT 250")
def snapshot_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next page of the same scan, 250 rows by key."""
    orders = read(spark, sf_dir, "orders")
    ((a,), (b,)) = snapshot.lexical_bounds(orders, ("o_orderkey",))
    spec = snapshot.plan(orders, "orders", ("o_orderkey",), [KeyPosition("o_orderkey", a + (b - a) // 3, b)], fetch_size=250)
    return snapshot.page(orders, spec).select("o_orderkey", "o_custkey")


@query("""
WITH m AS (SELECT min(conv_id) + (max(conv_id) - min(conv_id)) // 3 AS c FROM conversations)
SELECT conv_id, turn, role FROM conversations, m WHERE conv_id > c OR (conv_id = c AND turn > 1)
""")
def snapshot_resume_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations")
    (a, _), (b, last) = snapshot.lexical_bounds(rows, ("conv_id", "turn"))
    spec = snapshot.plan(rows, "conversations", ("conv_id", "turn"), [KeyPosition("conv_id", a + (b - a) // 3, b), KeyPosition("turn", 1, last)])
    return snapshot.scan(rows, spec).select("conv_id", "turn", "role")


@query("SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS chunk FROM orders")
def chunk_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders")
    return snapshot.chunked(orders, snapshot.plan(orders, "orders", ("o_orderkey",), fetch_size=1000)).select("o_orderkey", "chunk")


@query("SELECT l_orderkey, l_linenumber, n, CAST(sum(n) OVER (ORDER BY l_orderkey, l_linenumber) AS BIGINT) AS upto FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2)")
def chunk_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with equal sort keys are on one side of a page's edge or the other, never lost: numbers go up by their count."""
    rows = read(spark, sf_dir, "lineitem")
    ties = [c for c in rows.columns if c not in ("l_orderkey", "l_linenumber")]
    numbered = with_row_number(rows, ["l_orderkey", "l_linenumber", *ties], "rv_row")
    return numbered.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"), (F.max("rv_row") + 1).alias("upto"))


@query("SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 50 OFFSET 100")
def page_limit_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.offset_page(read(spark, sf_dir, "part"), ["p_partkey"], 100, 50).select("p_partkey", "p_name")


@query("""
SELECT 'region' AS collection, 'snapshot' AS operation, CAST(r_regionkey AS BIGINT) AS id, r_name AS name FROM region
UNION ALL SELECT 'nation', 'snapshot', CAST(n_nationkey AS BIGINT), n_name FROM nation
""")
def multi_table_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    region, nation = read(spark, sf_dir, "region"), read(spark, sf_dir, "nation")
    empty = nation.where("false")
    tables = {"region": (region, snapshot.plan(region, "region", ("r_regionkey",))), "nation": (nation, snapshot.plan(nation, "nation", ("n_nationkey",))), "none": (empty, snapshot.plan(empty, "none", ("n_nationkey",)))}
    parsed = F.from_json("after", "r_regionkey long, r_name string, n_nationkey long, n_name string")
    return snapshot.multi_table(tables).withColumn("r", parsed).select("collection", "operation", F.coalesce("r.r_regionkey", "r.n_nationkey").alias("id"), F.coalesce("r.r_name", "r.n_name").alias("name"))


SPELLINGS = "SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN upper(c_mktsegment) WHEN 1 THEN lower(c_mktsegment) WHEN 2 THEN replace(c_mktsegment, 'U', 'Ü') ELSE replace(lower(c_mktsegment), 'e', 'é') END AS spelt FROM customer"


@query(f"SELECT row_number() OVER (ORDER BY strip_accents(lower(spelt)), c_custkey) - 1 AS place, c_custkey, spelt FROM ({SPELLINGS})")
def collation_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words in four spellings, in an order that ignores case and accents; equal words by key."""
    read(spark, sf_dir, "customer").createOrReplaceTempView("customer")
    keyed = spark.sql(SPELLINGS).withColumn("k", F.collate("spelt", "UNICODE_CI_AI"))
    return with_row_number(keyed, ["k", "c_custkey"], "place").select("place", "c_custkey", "spelt")


# ---- values --------------------------------------------------------------------


@query("SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), '') AS segment, coalesce(nullif(c_nationkey, 3), 0) AS nation, coalesce(CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END, 0) AS balance FROM customer")
def normalize_null_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "customer").select("c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"), F.nullif(F.col("c_nationkey"), F.lit(3)).alias("nation"), F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"))
    return norm.normalize(rows)


@query("SELECT c_custkey, CAST(c_custkey * 7 AS INTEGER) AS narrow FROM customer")
def normalize_int_narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") * 7).alias("narrow"))
    return norm.normalize(rows, [AvroColumn("narrow", "int")])


@query("SELECT p_partkey, CAST(p_size AS DOUBLE) / 4 AS parsed, CAST(0 AS DOUBLE) AS unparsed FROM part")
def normalize_double_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "part").select("p_partkey", F.encode((F.col("p_size") / 4).cast("string"), "UTF-8").alias("parsed"), F.col("p_name").alias("unparsed"))
    return norm.normalize(rows, [AvroColumn("parsed", "double"), AvroColumn("unparsed", "double")], strict=False)


@query("SELECT c_custkey, lpad(to_hex(c_custkey), 16, '0') AS fixed_hex FROM customer")
def normalize_bit_fixed8(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "customer").select("c_custkey", F.col("c_custkey").alias("fixed"))
    return norm.normalize(rows, [AvroColumn("fixed", "fixed")]).select("c_custkey", F.hex("fixed").alias("fixed_hex"))


@query("SELECT c_custkey, c_custkey AS value, CAST(0 AS BIGINT) AS empty FROM customer")
def normalize_bytes_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "customer").select("c_custkey", F.unhex(F.hex("c_custkey")).alias("value"), F.lit(b"").alias("empty"))
    return norm.normalize(rows, [AvroColumn("value", "long"), AvroColumn("empty", "long")])


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT00:00:00Z') AS day, o_orderpriority AS kept FROM orders")
def normalize_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.col("o_orderpriority").alias("kept"))
    return norm.normalize(rows, [AvroColumn("day", "string", True), AvroColumn("kept", "string", True)])


@query("""
SELECT * FROM (VALUES ('o_orderkey', 'long'), ('o_custkey', 'long'), ('o_orderstatus', 'string'), ('o_totalprice', 'double'), ('o_orderdate', 'string'), ('o_orderpriority', 'string')) t(field, type)
""")
def avro_payload_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = record_schema("orders_payload", columns_of(read(spark, sf_dir, "orders").schema))
    text = spark.createDataFrame([(canonical(schema),)], "schema string")
    parsed = F.from_json("schema", "name string, fields array<struct<name: string, type: string>>")
    return text.select(F.explode(parsed["fields"]).alias("f")).select(F.col("f.name").alias("field"), F.col("f.type").alias("type"))


@query("SELECT * FROM (VALUES ('mysql.orders_key', 1, 1), ('mysql.orders_payload', 1, 1), ('mysql.orders_payload', 2, 2)) t(subject, version, attempt)")
def schema_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry, columns = SchemaRegistry(), columns_of(read(spark, sf_dir, "orders").schema)
    found = [(*registry.key("orders", columns, ("o_orderkey",)), 1), (*registry.payload("orders", columns), 1), (*registry.payload("orders", [*columns, AvroColumn("o_extra", "int")]), 2)]
    registry.payload("orders", columns)
    return spark.createDataFrame(found, "subject string, version int, attempt int")


# ---- change log ----------------------------------------------------------------


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a log of one row an event: signup inserts, error deletes, the rest update (the image before has value 0)."""
    e = read(spark, sf_dir, "events")
    row = lambda value: F.struct("user_id", "event_type", value.alias("value"))
    action = F.when(F.col("event_type") == "signup", "insert").when(F.col("event_type") == "error", "delete").otherwise("update")
    rows = F.when(action == "update", F.array(row(F.lit(0.0)), row(F.col("value")))).otherwise(F.array(row(F.col("value"))))
    file = F.format_string("binlog.%06d", F.floor(F.col("event_id") / 1000) + 1)
    return e.select(file.alias("file"), (F.col("event_id") % 1000 * 10 + 4).alias("pos"), F.unix_timestamp("ts").alias("ts"), F.lit(1).alias("server_id"), F.lit("db").alias("database"), F.lit("users").alias("collection"), action.alias("action"), rows.alias("rows"))


def grouped_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a log of updates: ten rows make one event, each with an image before (value -1) and one after."""
    e = read(spark, sf_dir, "events")
    group = F.floor(F.col("event_id") / 10)
    image = lambda r, value: F.struct(r["event_id"].alias("event_id"), r["user_id"].alias("user_id"), value.alias("value"))
    rows = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "user_id", "value"))), lambda r: F.array(image(r, F.lit(-1.0)), image(r, r["value"]))))
    log = e.groupBy(group.alias("g")).agg(rows.alias("rows"), F.min(F.unix_timestamp("ts")).alias("ts"))
    file = F.format_string("binlog.%06d", F.floor(F.col("g") / 50) + 1)
    return log.select(file.alias("file"), (F.col("g") % 50 * 100 + 4).alias("pos"), "ts", F.lit(1).alias("server_id"), F.lit("db").alias("database"), F.lit("users").alias("collection"), F.lit("update").alias("action"), "rows")


@query("""
SELECT 'users' AS collection, CASE event_type WHEN 'signup' THEN 'create' WHEN 'error' THEN 'delete' ELSE 'update' END AS operation, user_id AS key_user_id,
  CASE event_type WHEN 'signup' THEN NULL WHEN 'error' THEN value ELSE 0.0 END AS before_value, CASE event_type WHEN 'error' THEN NULL ELSE value END AS after_value,
  strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS created_at, '1' AS server_id
FROM events
""")
def cdc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = changes.records(event_log(spark, sf_dir), ("user_id",))
    return found.select("collection", "operation", F.col("key.user_id").alias("key_user_id"), F.col("before.value").alias("before_value"), F.col("after.value").alias("after_value"), F.col("metadata")["created_at"].alias("created_at"), F.col("metadata")[envelope.SERVER_ID_KEY].alias("server_id"))


@query("""
SELECT event_id AS before_id, event_id AS after_id, -1.0::DOUBLE AS before_value, value AS after_value, CAST(row_number() OVER (PARTITION BY event_id // 10 ORDER BY event_id) - 1 AS INTEGER) AS idx FROM events
""")
def cdc_update_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = changes.pairs(grouped_log(spark, sf_dir))
    return found.select(F.col("before.event_id").alias("before_id"), F.col("after.event_id").alias("after_id"), F.col("before.value").alias("before_value"), F.col("after.value").alias("after_value"), "idx")


LOG_SQL = """
WITH g AS (SELECT event_id // 10 AS g, event_id, row_number() OVER (PARTITION BY event_id // 10 ORDER BY event_id) - 1 AS i FROM events),
k AS (SELECT DISTINCT g FROM g),
e AS (SELECT g, printf('binlog.%06d', g // 50 + 1) AS file, g % 50 * 100 + 4 AS pos FROM k),
p AS (SELECT *, lag(file) OVER (ORDER BY g) AS prev_file, lag(pos) OVER (ORDER BY g) AS prev_pos FROM e),
r AS (SELECT p.*, g.event_id AS after_id, CAST(g.i AS INTEGER) AS idx FROM p JOIN g USING (g))
"""


@query(f"{LOG_SQL} SELECT file, pos, idx, prev_file, coalesce(prev_pos, -1) AS prev_pos, after_id FROM r")
def cdc_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = changes.records(grouped_log(spark, sf_dir), ())
    return found.select(F.col("position.name").alias("file"), "position.pos", "position.idx", F.col("position.prev.name").alias("prev_file"), F.coalesce("position.prev.pos", F.lit(-1).cast("long")).alias("prev_pos"), F.col("after.event_id").alias("after_id"))


@query(f"{LOG_SQL} SELECT file, pos, idx, prev_file, prev_pos, after_id FROM r WHERE file > 'binlog.000002' OR (file = 'binlog.000002' AND (pos > 504 OR (pos = 504 AND idx > 2)))")
def cdc_resume_mid_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = changes.records(grouped_log(spark, sf_dir), (), LogPosition("binlog.000002", 504, 2))
    return found.select(F.col("position.name").alias("file"), "position.pos", "position.idx", F.col("position.prev.name").alias("prev_file"), F.col("position.prev.pos").alias("prev_pos"), F.col("after.event_id").alias("after_id"))


@query("SELECT printf('binlog.%06d', event_id // 1000 + 1) || '_' || (event_id % 1000 * 10 + 4) AS key, user_id FROM events")
def cdc_key_no_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = changes.records(event_log(spark, sf_dir), ())
    return found.select("key", F.coalesce("after.user_id", "before.user_id").alias("user_id"))


@query("SELECT event_type, count(*) AS n FROM events WHERE event_id % 3 = 0 AND event_type <> 'view' GROUP BY event_type")
def cdc_table_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of other databases, other tables and other kinds of events are left out."""
    e = read(spark, sf_dir, "events")
    log = e.select(F.when(F.col("event_id") % 3 == 0, "db").otherwise("dbx").alias("database"), F.concat(F.lit("t_"), "event_type").alias("collection"), F.when(F.col("event_type") == "view", "ddl").otherwise("insert").alias("action"), "event_type")
    kinds = [f"t_{k}" for k in ("signup", "purchase", "error", "view", "click")]
    return changes.row_events(catalog.in_tables(log, "db", kinds)).groupBy("event_type").agg(F.count("*").alias("n"))


# ---- sink ----------------------------------------------------------------------


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    operation = F.when(F.col("event_type") == "signup", "create").when(F.col("event_type") == "error", "delete").otherwise("update")
    return e.select(F.col("event_id").alias("seq"), F.concat(F.lit("t"), F.col("user_id") % 2).alias("collection"), operation.alias("operation"), "user_id", "event_type", "value")


@query("""
WITH k AS (SELECT event_id AS seq, 't' || (user_id % 2) AS collection, CASE event_type WHEN 'error' THEN 'delete' ELSE 'upsert' END AS kind FROM events),
c AS (SELECT *, CASE WHEN lag(kind) OVER (ORDER BY seq) = kind AND lag(collection) OVER (ORDER BY seq) = collection THEN 0 ELSE 1 END AS s FROM k)
SELECT seq, collection, kind, CAST(sum(s) OVER (ORDER BY seq) - 1 AS BIGINT) AS batch FROM c
""")
def sink_run_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sink.run_batches(event_records(spark, sf_dir)).select("seq", "collection", "kind", "batch")


LAST_SQL = "WITH l AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events)"


@query("""
WITH l AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events WHERE event_type <> 'error')
SELECT user_id AS c_custkey, event_type AS c_mktsegment, value AS c_acctbal FROM l WHERE r = 1
UNION ALL SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE event_type <> 'error')
""")
def sink_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    records = event_records(spark, sf_dir).where("operation <> 'delete'").select("seq", F.col("user_id").alias("c_custkey"), F.col("event_type").alias("c_mktsegment"), F.col("value").alias("c_acctbal"))
    return sink.upsert(target, records, ["c_custkey"])


@query("SELECT c_custkey, c_mktsegment FROM customer UNION ALL SELECT user_id, event_type FROM events")
def sink_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return sink.append(target, event_records(spark, sf_dir).select("seq", F.col("user_id").alias("c_custkey"), F.col("event_type").alias("c_mktsegment")))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE event_type = 'error')")
def sink_delete_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    doomed = event_records(spark, sf_dir).where("operation = 'delete'").select(F.col("user_id").alias("c_custkey"))
    return sink.delete(read(spark, sf_dir, "customer"), doomed, ["c_custkey"]).select("c_custkey", "c_name")


@query("SELECT conv_id, turn, role FROM conversations c WHERE NOT EXISTS (SELECT 1 FROM conversations d WHERE d.role = 'user' AND d.conv_id = c.conv_id AND d.turn = c.turn)")
def sink_delete_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations")
    return sink.delete(rows, rows.where("role = 'user'"), ["conv_id", "turn"]).select("conv_id", "turn", "role")


@query(f"""
{LAST_SQL}
SELECT user_id AS c_custkey, event_type AS c_mktsegment, value AS c_acctbal FROM l WHERE r = 1 AND event_type <> 'error'
UNION ALL SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)
""")
def sink_replay_final_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    records = event_records(spark, sf_dir).select("seq", "operation", F.col("user_id").alias("c_custkey"), F.col("event_type").alias("c_mktsegment"), F.col("value").alias("c_acctbal"))
    return sink.replay(target, records, ["c_custkey"])


MEMBERS = "SELECT c_custkey AS k, c_custkey + 9007199254740993 AS id, 'm' || c_custkey AS login, CASE WHEN c_custkey % 5 <> 0 THEN c_custkey % 1000 END AS room, c_custkey // 1000 AS floor FROM customer"


@query(f"""
WITH m AS ({MEMBERS})
SELECT CASE k % 4 WHEN 0 THEN id + 4000000000000000000 WHEN 1 THEN CASE WHEN room IS NULL THEN id ELSE id + 4000000000000000000 END ELSE id END AS id,
  CASE WHEN k % 4 = 1 AND room IS NOT NULL THEN 'n' || k ELSE login END AS login, CASE WHEN k % 4 = 0 THEN NULL ELSE room END AS room, floor FROM m
UNION ALL SELECT id + 4000000000000000000, 'n' || k, room, floor FROM m WHERE k % 4 = 1 AND room IS NULL
UNION ALL SELECT id + 4000000000000000000, 'n' || k, NULL, NULL FROM m WHERE k % 4 = 2
""")
def sink_unique_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three unique keys, ids beyond 2**53 and nulls: a quarter of the records meet a row by its login, a quarter by its
    room and floor (or none, where the room is null), a quarter no row; a quarter of the rows meet no record."""
    read(spark, sf_dir, "customer").createOrReplaceTempView("customer")
    m = spark.sql(MEMBERS.replace("//", "DIV"))
    far, kind = F.col("id") + 4000000000000000000, F.col("k") % 4
    new = m.where(kind < 3).select(
        F.col("k").alias("seq"), far.alias("id"), F.when(kind == 0, F.col("login")).otherwise(F.concat(F.lit("n"), "k")).alias("login"),
        F.when(kind == 1, F.col("room")).alias("room"), F.when(kind < 2, F.col("floor")).alias("floor"),
    )
    return sink.fold_conflicts(m.drop("k"), new, [["id"], ["login"], ["room", "floor"]])


@query("SELECT o_orderkey + 9007199254740993 AS id, o_orderpriority AS name FROM orders")
def sink_key_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "orders").select((F.col("o_orderkey") + 9007199254740993).alias("id"), F.col("o_orderpriority").alias("name"))
    records = rows.select(F.to_json(F.struct("id", "name")).alias("key"))
    return envelope.from_json_key(records, "id long, name string").select("id", "name")


# ---- combined ------------------------------------------------------------------


@query("""
SELECT 0 AS stage, 'snapshot' AS operation, c_custkey AS user_id, c_mktsegment AS label FROM customer
UNION ALL SELECT 1, CASE event_type WHEN 'signup' THEN 'create' WHEN 'error' THEN 'delete' ELSE 'update' END, user_id, event_type FROM events WHERE event_id >= 2000
""")
def combined_snapshot_then_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import combined

    customer = read(spark, sf_dir, "customer")
    keys = {"customer": catalog.TableKeys(("c_custkey",), ("c_custkey",)), "users": catalog.TableKeys(("user_id",), ("user_id",))}
    log = event_log(spark, sf_dir)
    run = combined.plan({"customer": customer}, keys, LogPosition("binlog.000002", 9994, (1 << 31) - 1))
    found = combined.feed({"customer": customer}, keys, {"users": log}, run)
    image = F.from_json(F.coalesce("after", "before"), "c_custkey long, c_mktsegment string, user_id long, event_type string")
    return found.withColumn("r", image).select("stage", "operation", F.coalesce("r.c_custkey", "r.user_id").alias("user_id"), F.coalesce("r.c_mktsegment", "r.event_type").alias("label"))


from . import source_queries  # noqa: E402, F401  (registers the rest)
