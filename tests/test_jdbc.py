import pytest

from rivulet.operators import snapshot
from rivulet.operators.snapshot import ScanSpec
from rivulet.sources import jdbc

DERBY = jdbc.Database("jdbc:derby:memory:rivulet;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver", quote='"')
MY = jdbc.Database("jdbc:mysql://h/db", "com.mysql.cj.jdbc.Driver")


@pytest.fixture(scope="module")
def users(spark):
    df = spark.range(1, 101).selectExpr("id", "id % 7 AS grp", "concat('u', id) AS name")
    try:
        df.write.format("jdbc").options(**DERBY.options(), dbtable='"users"').mode("overwrite").save()
    except Exception as e:  # the driver is not part of every Spark distribution
        pytest.skip(f"no Derby: {e}")
    return df


def test_bounds_and_partitions(spark, users):
    assert tuple(jdbc.bounds(spark, DERBY, "users", ["id"]).first()) == (1, 100)
    assert jdbc.count(spark, DERBY, "users") == 100
    spec = ScanSpec("users", ("id",), (10,), (90,), True)
    df = jdbc.read(spark, DERBY, spec, partitions=4)
    assert df.rdd.getNumPartitions() == 4
    assert sorted(r.id for r in df.collect()) == list(range(11, 91))


def test_composite_range(spark, users):
    spec = ScanSpec("users", ("grp", "id"), (2, 50), (4, 30), True)
    got = sorted((r.grp, r.id) for r in jdbc.read(spark, DERBY, spec).collect())
    assert got == sorted((r.grp, r.id) for r in snapshot.scan(users, spec).collect())
    assert got and all((2, 50) < k <= (4, 30) for k in got)


def test_append(spark, users):
    jdbc.append(spark.createDataFrame([(500, 1, "x")], "id long, grp long, name string"), DERBY, "users")
    assert jdbc.count(spark, DERBY, "users") == 101


def test_statements():
    assert jdbc.upsert_sql(MY, "t", ["id", "v"], 2) == "INSERT INTO `t` (`id`, `v`) VALUES (?, ?), (?, ?) ON DUPLICATE KEY UPDATE `id` = VALUES(`id`), `v` = VALUES(`v`)"
    assert jdbc.delete_sql(MY, "t", ["id"], 3) == "DELETE FROM `t` WHERE `id` IN (?, ?, ?)"
    assert jdbc.delete_sql(MY, "t", ["a", "b"], 2) == "DELETE FROM `t` WHERE (`a` = ? AND `b` = ?) OR (`a` = ? AND `b` = ?)"
    with pytest.raises(ValueError, match="needs a key"):
        jdbc.delete_sql(MY, "t", [])
    assert jdbc.lock_sql(MY, ["b", "a`"]) == ("FLUSH TABLES `a```, `b` WITH READ LOCK", "UNLOCK TABLES")
    assert jdbc.literal("o'x") == "'o''x'" and jdbc.literal(b"\x01") == "X'01'"


def test_texts_with_backslashes():
    assert jdbc.literal("a\\") == "'a\\\\'" and jdbc.literal("a\\' OR 1=1 --") == "'a\\\\'' OR 1=1 --'"
    assert jdbc.literal("a\\", escapes=False) == "'a\\'"
    assert MY.escapes and not DERBY.escapes
    spec = ScanSpec("t", ("k",), ("a\\",), ("b",), True)
    assert jdbc.where_sql(MY, spec) == "`k` IS NOT NULL AND ((`k` > 'a\\\\')) AND ((`k` <= 'b'))"


def test_keys_with_backslashes_and_quotes(spark, users):
    names = ["a\\", "a\\b", "b'c", "c\\'d", "e"]
    df = spark.createDataFrame([(n,) for n in names], "k string")
    df.write.format("jdbc").options(**DERBY.options(), dbtable='"texts"', createTableColumnTypes="k VARCHAR(20)").mode("overwrite").save()
    for start in names:
        got = jdbc.read(spark, DERBY, ScanSpec("texts", ("k",), (start,), (max(names),), True))
        assert sorted(r.k for r in got.collect()) == sorted(n for n in names if n > start)


def test_placeholders():
    db = jdbc.Database("jdbc:mysql://h/db", "d", placeholder="%s")
    assert jdbc.delete_sql(db, "100%", ["id"], 2) == "DELETE FROM `100%%` WHERE `id` IN (%s, %s)"
    assert jdbc.upsert_sql(db, "t", ["id"]) == "INSERT INTO `t` (`id`) VALUES (%s) ON DUPLICATE KEY UPDATE `id` = VALUES(`id`)"
