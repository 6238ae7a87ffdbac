"""The streaming price changes, over files that arrive in two batches."""

from alluvium.streaming.prices import streaming_price_changes

def test_decimal_prices_stay_decimals(spark, tmp_path):
    def arrive(rows):
        spark.sql(f"SELECT CAST(id AS long) id, 's' AS source, 'a' AS sku, CAST(price AS DECIMAL(12,2)) price, CAST(at AS timestamp) created_at FROM VALUES {rows} AS t(id, price, at)").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        schema = "id long, source string, sku string, price decimal(12,2), created_at timestamp"
        query = (
            streaming_price_changes(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
            .writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start(str(tmp_path / "out"))
        )
        assert query.awaitTermination(120)
        out = spark.read.parquet(str(tmp_path / "out"))
        assert dict(out.dtypes)["price"] == "decimal(12,2)"
        return sorted((r.id, str(r.price)) for r in out.collect())

    assert arrive("(1, 10.10, '2024-01-01'), (2, 10.10, '2024-01-02')") == [(1, "10.10")]
    assert arrive("(3, 10.10, '2024-01-03'), (4, 0.30, '2024-01-04')") == [(1, "10.10"), (4, "0.30")]


SCHEMA = "id long, source string, sku string, price double, created_at timestamp"


def test_changes_over_batches(spark, tmp_path):
    def arrive(n, rows):
        spark.sql(f"SELECT * FROM VALUES {rows} AS t(id, source, sku, price, created_at)").selectExpr(
            "CAST(id AS long) id", "source", "sku", "CAST(price AS double) price", "CAST(created_at AS timestamp) created_at"
        ).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        query = (
            streaming_price_changes(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")))
            .writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start(str(tmp_path / "out"))
        )
        assert query.awaitTermination(120)
        return sorted((r.sku, r.id, r.price) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    first = arrive(1, "(1, 's', 'a', 10, '2024-01-01'), (2, 's', 'a', 10, '2024-01-02'), (3, 's', 'b', 5, '2024-01-01'), (4, 's', NULL, 5, '2024-01-01'), (5, 's', 'b', NULL, '2024-01-02')")
    assert first == [("a", 1, 10.0), ("b", 3, 5.0)]
    second = arrive(2, "(6, 's', 'a', 10, '2024-01-03'), (7, 's', 'a', 12, '2024-01-04'), (8, 's', 'b', 5, '2024-01-03'), (9, 's', 'c', 1, '2024-01-03')")
    assert second == [("a", 1, 10.0), ("a", 7, 12.0), ("b", 3, 5.0), ("c", 9, 1.0)]
