"""Many equal rows are encoded once and come back each."""

from alluvium.llm import word_bpe


def test_equal_rows_leave_their_block(spark):
    n = 3 * word_bpe.MANY
    hot = spark.range(n).selectExpr("7L AS doc_id", "'one two three' AS text", "1 AS copies")
    none = spark.range(word_bpe.MANY).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "CAST(NULL AS STRING) AS text", "1 AS copies")
    rest = spark.createDataFrame([(i, "word " * (i % 9), 1) for i in range(100)] + [(7, "other text", 2)] * 2, "doc_id long, text string, copies int")
    docs = hot.unionByName(none).unionByName(rest)
    assert word_bpe._counted(docs).count() == 104
    got = word_bpe.encode_decode(docs)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert got.count() == n + word_bpe.MANY + 102
    of = {(r["doc_id"], r["n_tokens"]): r["count"] for r in got.groupBy("doc_id", "n_tokens").count().collect()}
    assert of[7, 3] >= n and of[None, 0] == word_bpe.MANY
