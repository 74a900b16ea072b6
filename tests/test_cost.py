"""What is done to each value of order items is done once."""

from pyspark.sql import functions as F

from starmill.functions import numbers, text


def _code(spark, df):
    debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return getattr(debug, "MODULE$").codegenString(df._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_the_text_of_an_amount_is_parsed_once(spark):
    rows = spark.range(3).selectExpr("CAST(id AS STRING) AS amount")
    code = _code(spark, rows.select(numbers.to_amount(F.col("amount")).alias("amount")))
    assert code.count("Double.valueOf(") == 1


def test_amounts_keep_their_value_and_only_finite_ones(spark):
    written_as = ["-0.0", "12.50", "1e308", "4.9e-324", "NaN", "Infinity", "-inf", "1e999", "n.a.", "", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(written_as)], "id int, amount string")
    got = [r[0] for r in rows.orderBy("id").select(numbers.to_amount(F.col("amount"))).collect()]
    assert got == [0.0, 12.5, 1e308, 5e-324] + [None] * 7 and str(got[0]) == "-0.0"


def test_every_one_of_the_characters_goes(spark):
    rows = spark.createDataFrame([("$1$,2,$",), ("$",), ("",), ("3",), (None,)], "t string")
    got = [r[0] for r in rows.select(text.without_characters(F.col("t"), "$,")).collect()]
    assert got == ["12", "", "", "3", None]
