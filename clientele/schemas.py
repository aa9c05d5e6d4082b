"""Fixed schemas of inputs and outputs."""

from pyspark.sql import types as T

_MONEY = T.DecimalType(18, 4)

DOCUMENT_LINE = T.StructType([
    T.StructField("Id", T.LongType()),
    T.StructField("DocumentId", T.LongType()),
    T.StructField("SalesOrderId", T.LongType()),
    T.StructField("ItemId", T.StringType()),
    T.StructField("AmountWithoutVat", _MONEY),
    T.StructField("DiscountAmountWithoutVat", _MONEY),
    T.StructField("__ts_ms", T.TimestampType()),
])

DOCUMENT = T.StructType([
    T.StructField("Id", T.LongType()),
    T.StructField("OrderId", T.LongType()),
    T.StructField("BillToEmail", T.StringType()),
    T.StructField("CurrencyCode", T.StringType()),
    T.StructField("CreatedOn", T.TimestampType()),
    T.StructField("__ts_ms", T.TimestampType()),
])

EXCHANGE_RATES = T.StructType([
    T.StructField("CurrencyCode", T.StringType()),
    T.StructField("Date", T.DateType()),
    T.StructField("Rate", T.DoubleType()),
])

TRAIN = T.StructType([
    T.StructField("userId", T.StringType()),
    T.StructField("order_date", T.DateType()),
    T.StructField("order_value", T.DoubleType()),
])

REVENUE = T.StructType([
    T.StructField("userId", T.StringType()),
    T.StructField("current_total_revenue", T.DoubleType()),
])

RFM = T.StructType([
    T.StructField("userId", T.StringType()),
    T.StructField("frequency", T.DoubleType()),
    T.StructField("recency", T.DoubleType()),
    T.StructField("T", T.DoubleType()),
    T.StructField("monetary_value", T.DoubleType()),
])

PREDICTION = T.StructType([
    T.StructField("userId", T.StringType()),
    T.StructField("clv", T.DoubleType()),
    T.StructField("churn_probability", T.DoubleType()),
    T.StructField("predicted_value_next_6_month", T.DoubleType()),
    T.StructField("current_total_revenue", T.DoubleType()),
])

SEGMENTED = T.StructType(PREDICTION.fields + [
    T.StructField("clv_segment", T.StringType()),
    T.StructField("churn_probability_segment", T.StringType()),
])

MODEL = T.StructType([
    T.StructField("model_name", T.StringType()),
    T.StructField("frequency", T.StringType()),
    T.StructField("params", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("penalizer", T.DoubleType()),
    T.StructField("n_customers", T.LongType()),
    T.StructField("log_likelihood", T.DoubleType()),
    T.StructField("steps", T.LongType()),
    T.StructField("converged", T.BooleanType()),
    T.StructField("fitted_on", T.DateType()),
    T.StructField("model_type", T.StringType()),
])
