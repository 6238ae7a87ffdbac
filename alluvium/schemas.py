"""Table schemas of the bronze, silver and gold layers, as DDL."""

SNAPSHOT = (
    "id BIGINT NOT NULL, source STRING NOT NULL, request_url STRING NOT NULL, request_headers MAP<STRING,STRING> NOT NULL, "
    "request_params MAP<STRING,STRING> NOT NULL, status_code INT NOT NULL, response_headers MAP<STRING,STRING> NOT NULL, "
    "content_type STRING NOT NULL, body STRING NOT NULL, created_at TIMESTAMP_NTZ NOT NULL"
)
ARTICLE = (
    "id BIGINT, bronze_id BIGINT, source STRING, source_url STRING, title STRING, body STRING, authors ARRAY<STRING>, "
    "published_at TIMESTAMP_NTZ, section STRING, tags ARRAY<STRING>, image_urls ARRAY<STRING>, created_at TIMESTAMP_NTZ"
)
PRODUCT = (
    "id BIGINT, bronze_id BIGINT, source STRING, source_url STRING, sku STRING, name STRING, brand STRING, "
    "price DECIMAL(12,2), currency STRING, unit STRING, image_urls ARRAY<STRING>, created_at TIMESTAMP_NTZ"
)
DIM_PRODUCT = (
    "product_key BIGINT NOT NULL, source STRING NOT NULL, sku STRING NOT NULL, name STRING, brand STRING, unit STRING, currency STRING, "
    "image_urls ARRAY<STRING>, first_seen_at TIMESTAMP_NTZ, last_seen_at TIMESTAMP_NTZ"
)
FACT_PRICE = (
    "id BIGINT NOT NULL, product_key BIGINT NOT NULL, price DECIMAL(12,2) NOT NULL, currency STRING, "
    "observed_at TIMESTAMP_NTZ NOT NULL, bronze_id BIGINT"
)
DEFAULT_CURRENCY = "PYG"

#: What is unique in a table beside what is NOT NULL, and what refers to another table's column.
UNIQUE = {
    "snapshot": [["id"]],
    "article": [["id"]],
    "product": [["id"]],
    "dim_product": [["product_key"], ["source", "sku"]],
    "fact_price": [["id"], ["product_key", "observed_at"]],
}
REFERENCES = {"fact_price": [("product_key", "dim_product", "product_key")]}
