from pyspark.sql import functions as F

from tessera.plans import sources_q as S
from tessera.sources import records as R


def test_array_files_grow_in_number_not_in_size(spark, tmp, monkeypatch):
    """No task sorts or writes the whole table; the files keep the order."""
    monkeypatch.setattr(S, "ARRAY_ROWS", 50)
    rows = [(s, f"p{s}", "T", None, None, None) for s in range(220)]
    loans = spark.createDataFrame(rows, "seq long, borrower_name string, book_title string, borrow_date date, return_date date, due_date date").repartition(3)
    dealt = S._large_files(loans)
    sizes = [r["n"] for r in dealt.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 5 and sum(sizes) == 220 and max(sizes) <= 75
    R.write_loans(dealt, tmp, "array")
    assert [r.borrower_name for r in R.read_loans(spark, tmp).orderBy("seq").collect()] == [f"p{s}" for s in range(220)]
    assert S._large_files(loans.limit(0)).collect() == []
