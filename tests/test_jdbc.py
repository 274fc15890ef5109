"""JDBC wiring without a database (none may be started here): Spark's own
jdbc entry points are replaced by recorders, so these tests check the
options martline passes, not a connection."""

from pyspark.sql.readwriter import DataFrameReader, DataFrameWriter

from martline.sources import jdbc


def test_partitioned_read_options(spark, monkeypatch):
    seen = {}

    def fake_jdbc(self, url, table, column=None, lowerBound=None, upperBound=None,
                  numPartitions=None, predicates=None, properties=None):
        seen.update(url=url, table=table, column=column, lower=lowerBound, upper=upperBound,
                    parts=numPartitions, props=properties)
        return spark.range(1)

    monkeypatch.setattr(DataFrameReader, "jdbc", fake_jdbc)
    jdbc.read_table(spark, "jdbc:x://h/db", "customer", {"user": "u"},
                    partition_column="customer_id", lower=1, upper=1000, num_partitions=16)
    assert (seen["column"], seen["lower"], seen["upper"], seen["parts"]) == \
        ("customer_id", 1, 1000, 16)
    assert seen["props"] == {"user": "u", "fetchsize": "10000"}
    jdbc.read_table(spark, "jdbc:x://h/db", "store", {"user": "u"})
    assert seen["table"] == "store" and seen["column"] is None


def test_append_caps_connections_and_batches(spark, monkeypatch):
    seen = {}

    def fake_jdbc(self, url, table, mode=None, properties=None):
        seen.update(url=url, table=table, mode=mode, props=properties)

    monkeypatch.setattr(DataFrameWriter, "jdbc", fake_jdbc)
    captured = {}
    original_option = DataFrameWriter.option

    def spy_option(self, key, value):
        captured[key] = value
        return original_option(self, key, value)

    monkeypatch.setattr(DataFrameWriter, "option", spy_option)
    jdbc.append_table(spark.range(5), "jdbc:x://h/db", "sales_team_data_mart", {"user": "u"},
                      num_partitions=4, batch_size=500)
    assert seen["mode"] == "append" and seen["table"] == "sales_team_data_mart"
    assert captured == {"batchsize": "500", "numPartitions": "4"}
