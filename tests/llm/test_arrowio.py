"""Arrow batches stay bounded, and cut pieces hold all rows in order."""

import pyarrow as pa

from tessera.llm.arrowio import bounded_batches, pieces


def test_batches_of_texts_stay_under_the_limit(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "64m")
        df = spark.range(0, 3000, 1, 1).selectExpr("repeat('x', 10000) AS text")

        def sizes(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "b"])

        got = bounded_batches(df, 1 << 20).mapInArrow(sizes, "n long, b long").collect()
        assert sum(r["n"] for r in got) == 3000 and max(r["b"] for r in got) < 2 << 20
        spark.conf.set(key, "1000")  # a lower limit of the session stays
        bounded_batches(df)
        assert spark.conf.get(key).rstrip("b") == "1000"
    finally:
        spark.conf.set(key, before)


def test_pieces_keep_all_rows():
    texts = ["a" * n for n in (0, 5, 100, 3, 0, 50, 50)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    cut = list(pieces(batch, 0, 60))
    assert len(cut) > 2 and [t for b in cut for t in b.column(0).to_pylist()] == texts
