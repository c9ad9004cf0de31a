"""What the operators share."""

from pyspark.sql import functions as F

from registrum.llm import common


def test_rows_keep_their_numbers_with_fewer_cores(spark, corpus, tmp_path):
    """The parallelism of leaves stands for cores, which fall when executors are lost."""
    at = f"file://{tmp_path}/docs"
    corpus([f"text {k}" for k in range(400)]).repartitionByRange(16, "doc_id").write.parquet(at)
    keys = ("spark.sql.files.minPartitionNum", "spark.sql.leafNodeDefaultParallelism")
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.unset(k)
        rows = common.numbered(spark.read.parquet(at), "row")
        numbers = {}
        for cores in (8, 1):
            spark.conf.set("spark.sql.leafNodeDefaultParallelism", cores)
            numbers[cores] = {r.doc_id: r.row for r in rows.filter(F.col("doc_id") >= 0).select("row", "doc_id").collect()}
        assert len(set(numbers[8].values())) == 400 and numbers[8] == numbers[1]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
