"""What comes to the driver."""

from pyspark.sql.classic.dataframe import DataFrame

from custoria.llm import quality


def test_counts_come_to_the_driver_as_columns(spark, monkeypatch):
    docs = spark.createDataFrame([(i, " ".join(f"w{(i * 7 + k * k) % 997}" for k in range(60))) for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    rows, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: rows.append(collect(self)) or rows[-1])
    fitted = quality.fit(docs, labels)
    assert len(set(fitted.ratios)) > 2 and max(map(len, rows), default=0) <= 40
    # the ratios by hand: how often each bucket occurs in all documents and in the trusted ones that count
    code = "xxhash64(w)"
    words = docs.selectExpr("doc_id", f"transform(split(text, ' '), w -> {code}) AS c")
    grams = words.selectExpr("doc_id", "explode(concat(c, transform(sequence(0, size(c) - 2), i -> xxhash64(c[i], c[i + 1])))) AS g")
    total = grams.count()
    counted = [r["doc_id"] for r in labels.where("quality = 1 AND pmod(xxhash64(doc_id), 2) = 0").collect()]
    good = grams.where(grams["doc_id"].isin(counted)).count()
    empty = quality.log(quality.SMOOTHING / (good + quality.BUCKETS)) - quality.log(quality.SMOOTHING / (total + quality.BUCKETS))
    assert round(empty, 9) in fitted.ratios
