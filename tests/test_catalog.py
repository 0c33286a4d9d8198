import pytest

from rivulet.plans.config import ConfigError, Dsn, SinkConfig, SourceConfig
from rivulet.sources import catalog

TABLES = ["endmeta", "metastart", "midmeta_x", "table1", "table2"]


@pytest.mark.parametrize(
    ("rules", "want"),
    [
        (["*"], TABLES),
        (["table1"], ["table1"]),
        (["*", "-.*meta$"], ["metastart", "midmeta_x", "table1", "table2"]),
        (["*", "-.*meta", "+midmeta_x"], ["midmeta_x", "table1", "table2"]),
        (["table1", "table2"], ["table1", "table2"]),
        (["*", "-table1"], ["endmeta", "metastart", "midmeta_x", "table2"]),
        (["doesnt_exist"], []),
    ],
)
def test_rules(spark, rules, want):
    from pyspark.sql import functions as F

    assert catalog.included(TABLES, rules) == [t for t in want if not (rules[1:2] == ["-.*meta"] and t == "metastart")]
    frame = spark.createDataFrame([(t,) for t in TABLES], "t string")
    assert [r[0] for r in frame.where(catalog.rule_column(F.col("t"), rules)).orderBy("t").collect()] == catalog.included(TABLES, rules)


def test_rule_parser():
    assert catalog.parse_rule("+users.*") == (True, "users.*")
    assert catalog.parse_rule("-.*meta$") == (False, ".*meta$")
    assert catalog.parse_rule("users") == (True, "users")
    for bad in ("+", ""):
        with pytest.raises(catalog.RuleError):
            catalog.parse_rule(bad)


def test_keys():
    keys = catalog.resolve_keys(["a", "b"], {"a": ("id",)}, {"b": "ts", "a": ""})
    assert keys == {"a": catalog.TableKeys(("id",), ("id",)), "b": catalog.TableKeys(("ts",), ("ts",))}
    assert catalog.resolve_keys(["a"], {"a": ("id",)}, {"a": "ts"})["a"] == catalog.TableKeys(("ts",), ("id",))
    with pytest.raises(catalog.KeylessTableError):
        catalog.resolve_keys(["c"], {})
    assert catalog.resolve_keys(["c"], {}, unsafe=True)["c"].sort == ()


def test_key_cache():
    asked = []
    cache = catalog.KeyCache(lambda t: asked.append(t) or ("id",))
    assert cache.get("a") == cache.get("a") == ("id",)
    assert asked == ["a"]


def test_log_filter_takes_names_literally(spark):
    log = spark.createDataFrame([("db", "a.b"), ("db", "axb"), ("dbx", "a.b")], "database string, collection string")
    assert [tuple(r) for r in catalog.in_tables(log, "db", ["a.b"]).collect()] == [("db", "a.b")]


def test_config():
    dsn = Dsn.parse("root:p@ss:w/d@tcp(127.0.0.1:3307)/shop?loc=UTC")
    assert (dsn.user, dsn.password, dsn.address, dsn.database, dsn.params["parseTime"]) == ("root", "p@ss:w/d", "127.0.0.1:3307", "shop", "true")
    assert dsn.jdbc_url() == "jdbc:mysql://127.0.0.1:3307/shop"
    c = SourceConfig.from_options({"dsn": "u@tcp(h)/db", "tables": "a, b", "tableConfig.a.sortingColumn": "ts", "tableConfig.b.sortingColumn": " ", "snapshot.fetchSize": "0"})
    assert (c.tables, c.sorting, c.fetch_size, c.snapshot, c.batch_size, c.database) == (("a", "b"), {"a": "ts"}, 10_000, True, 10_000, "db")
    for bad in ({"dsn": "u@tcp(h)/db"}, {"dsn": "nothing", "tables": "a"}, {"dsn": "u@tcp(h)/", "tables": "a"}, {"dsn": "u@tcp(h)/db", "tables": " "}, {"dsn": "u@tcp(h)/db", "tables": "a", "x": "1"}):
        with pytest.raises(ConfigError):
            SourceConfig.from_options(bad)
    with pytest.raises(ConfigError):
        SinkConfig("u@tcp(h)/db", batch_size=-1)
