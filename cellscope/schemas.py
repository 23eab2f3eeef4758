"""Record layouts (explicit, never inferred) and the portrait catalogue."""

from __future__ import annotations

from pyspark.sql import types as T

# Signalling record: imsi|laccell|latitude|longitude|procedureStartTime(ms)
SIGNAL = T.StructType([
    T.StructField("imsi", T.StringType()),
    T.StructField("laccell", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("procedureStartTime", T.LongType()),
])

# Cell -> administrative region: region_id|laccell
REGION_CELL = T.StructType([
    T.StructField("region_id", T.StringType()),
    T.StructField("laccell", T.StringType()),
])

# User profile: imsi|gender|age   (gender '1' male, '0' female)
USER_INFO = T.StructType([
    T.StructField("imsi", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("age", T.IntegerType()),
])

USER_INDEX = T.StructType([
    T.StructField("imsi", T.StringType()),
    T.StructField("bitmap_id", T.LongType()),
])

# Enter/leave event of a user between regions.
REGION_FLOW = T.StructType([
    T.StructField("imsi", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("is_in", T.IntegerType()),
    T.StructField("region_id", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("age", T.IntegerType()),
])

# --- Fixed values (must equal the reference's catalogue) -------------------
# Persona counters kept per region.
PERSONA_COLUMNS = ["man", "women", "age_10_20", "age_20_40", "age_40"]
# Portrait catalogue: (portrait_id, portrait_value, comment).
# Gender portraits take the gender code as value, age portraits the band flag.
PORTRAITS = [
    (1, "1", "男性"),
    (2, "0", "女性"),
    (3, "10", "10-20岁人员"),
    (4, "20", "20-40岁人员"),
    (5, "40", "40岁以上人员"),
]
# Age bands are half-open: [10,20) -> '10', [20,40) -> '20', [40,inf) -> '40'.
MIN_PORTRAIT_AGE = 10
# ---------------------------------------------------------------------------

# Labels by portrait id.
LABELS = {i: label for i, _, label in PORTRAITS}
