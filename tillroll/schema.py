"""Column layout of the tables the library reads and writes."""

from pyspark.sql import types as T

TRANSACTIONS = T.StructType(
    [
        T.StructField("invoice", T.StringType()),
        T.StructField("stock_code", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("invoice_date", T.TimestampType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("customer_id", T.DoubleType()),
        T.StructField("country", T.StringType()),
    ]
)

# Header names of the retail workbook, as exported to CSV.
WORKBOOK_HEADERS = {
    "Invoice": "invoice",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "Price": "price",
    "Customer ID": "customer_id",
    "Country": "country",
}

CUSTOMER_KEYS = ["customer_id", "country"]
MEASURES = ["recency", "frequency", "monetary"]
EXPORT_COLUMNS = [*CUSTOMER_KEYS, *MEASURES, "segment"]
