from pyspark.sql import functions as F

from tidemark.llm import shared


def test_written_tables_leave_no_shuffle_files(spark):
    def shuffles():
        return spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()

    before, setting = shuffles(), spark.conf.get(shared.CLEANUP, None)
    table = shared.written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n")), "counts")
    assert shuffles() <= before and spark.conf.get(shared.CLEANUP, None) == setting
    assert table.agg(F.sum("n")).first()[0] == 1000 and table.count() == 7
    shared.dropped(table)
