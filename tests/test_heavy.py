from pyspark.sql import functions as F

from ledgerloom.operators import heavy
from ledgerloom.operators.contracts import with_contract_type, with_contract_type_of_many


def _skewed(spark, n=20_000):
    """Half of the rows are one contract's, a tenth have none."""
    key = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 10 == 1, None).otherwise(F.concat(F.lit("c"), F.col("id") % 997))
    return spark.range(n).select(key.alias("contract_address"), "id", F.lit(-1).alias("contract_type"), F.lit("x").alias("_clash"))


def _contracts(spark):
    return spark.createDataFrame([("hot", 3, "extra")] + [(f"c{k}", k % 5, "extra") for k in range(0, 997, 2)],
                                 "contract_address string, contract_type int, _clash string")


def test_same_rows_as_the_plain_join(spark):
    left, right = _skewed(spark), _contracts(spark)
    for rows in (left, left.limit(0), left.unionAll(left)):
        got, want = with_contract_type_of_many(rows, right), with_contract_type(rows, right)
        assert sorted(got.columns) == sorted(want.columns)
        got = got.select(*want.columns)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    nothing = with_contract_type_of_many(left, right.limit(0))
    assert nothing.filter("contract_type <> 127").isEmpty() and nothing.count() == left.count()


def test_a_frequent_key_without_a_partner(spark):
    typed = with_contract_type_of_many(_skewed(spark), _contracts(spark).filter("contract_address <> 'hot'"))
    assert typed.filter("contract_address = 'hot' and contract_type = 127").count() == 10_000


def test_frequent_keys_are_few_and_frequent(spark):
    assert [r[0] for r in heavy.frequent_keys(_skewed(spark), "contract_address").collect()] == ["hot"]
    assert heavy.frequent_keys(_skewed(spark).limit(0), "contract_address").isEmpty()
    even = spark.range(10_000).select((F.col("id") % 100).cast("string").alias("k"))
    assert heavy.frequent_keys(even, "k", most=7).count() == 7


def test_no_task_holds_the_hot_key(spark):
    """Without AQE, which would deal skewed partitions out by itself, and without a broadcast of all contracts."""
    names = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)

        def sizes(df):
            return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())

        even = sizes(with_contract_type_of_many(_skewed(spark), _contracts(spark)))
        assert len(even) == 8 and even[-1] <= 2 * even[4]
        assert sizes(with_contract_type(_skewed(spark), _contracts(spark)))[-1] > 10_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_rows_with_maps_pass(spark):
    rows = spark.range(100).select(F.lit("hot").alias("contract_address"), F.create_map(F.lit("a"), "id").alias("m"))
    assert with_contract_type_of_many(rows, _contracts(spark)).filter("contract_type = 3").count() == 100
