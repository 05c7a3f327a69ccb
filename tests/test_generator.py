from pyspark.sql import functions as F

from bramble.sources import generator as G


def test_schema_and_default_size(spark):
    df = G.generate_reviews(spark, 1000)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in G.REVIEW_SCHEMA]
    assert df.count() == 1000


def test_independent_of_partitioning(spark):
    a = G.generate_reviews(spark, 3000, seed=5, partitions=1).collect()
    b = G.generate_reviews(spark, 3000, seed=5, partitions=8).collect()
    assert sorted(map(tuple, a), key=repr) == sorted(map(tuple, b), key=repr)
    c = G.generate_reviews(spark, 3000, seed=6).collect()
    assert sorted(map(tuple, a), key=repr) != sorted(map(tuple, c), key=repr)


def test_distributions_and_hierarchy(spark):
    n = 100_000
    df = G.generate_reviews(spark, n, seed=42).persist()
    agg = df.agg(
        F.avg(F.col("Age").isNull().cast("double")).alias("null_age"),
        F.avg(F.col("Rating").isNull().cast("double")).alias("null_rating"),
        F.avg(F.col("Title").isNull().cast("double")).alias("null_title"),
        F.avg(F.col("Division_Name").isNull().cast("double")).alias("null_div"),
        F.min("Age").alias("min_age"),
        F.max("Age").alias("max_age"),
        F.max("Positive_Feedback_Count").alias("max_fb"),
    ).collect()[0]
    assert abs(agg.null_age - 0.03) < 0.005 and abs(agg.null_rating - 0.05) < 0.005
    assert abs(agg.null_title - 0.01) < 0.005 and abs(agg.null_div - 0.02) < 0.005
    assert (agg.min_age, agg.max_age, agg.max_fb) == (18, 70, 25)
    rated = df.filter(F.col("Rating").isNotNull())
    m = rated.count()
    shares = {r.Rating: r["count"] / m for r in rated.groupBy("Rating").count().collect()}
    for r, w in zip(G.RATINGS, G.RATING_WEIGHTS):
        assert abs(shares[r] - w) < 0.01
    hi = rated.filter("Rating >= 4").agg(F.avg("Recommended_IND")).collect()[0][0]
    lo = rated.filter("Rating < 3").agg(F.avg("Recommended_IND")).collect()[0][0]
    assert abs(hi - 0.9) < 0.01 and abs(lo - 0.1) < 0.01
    assert rated.filter("Rating < 4 AND Positive_Feedback_Count > 5").count() == 0
    pairs = {(r.Department_Name, r.Class_Name) for r in df.select("Department_Name", "Class_Name").distinct().collect()}
    allowed = {(d, c) for d, cs in G.CLASS_BY_DEPARTMENT.items() for c in cs} | {("Jackets", "Jackets")}
    assert pairs <= allowed
    div_dept = {(r.Division_Name, r.Department_Name) for r in df.select("Division_Name", "Department_Name").distinct().collect()}
    for d, dept in div_dept:
        if d == "Initmates":
            assert dept == "Intimate"
        elif d == "Trend":
            assert dept == "Trend"
    titles = df.filter(F.col("Title").contains("{product}")).count()
    assert titles == 0
    df.unpersist()


def test_csv_round_trip(spark, tmp_path):
    from bramble.sources.sinks import read_csv, write_csv

    df = G.generate_reviews(spark, 500, seed=1)
    path = write_csv(df, str(tmp_path / "reviews"))
    back = read_csv(spark, path, schema=G.REVIEW_SCHEMA)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
