"""Transaction sources (S1-S5) and result sinks (K1, K2).

The reference reads one CSV of purchase lines. Here the same 10-column table
can come from a CSV / parquet file or be mapped from the star-schema test
tables (``lineitem ⋈ orders ⋈ customer ⋈ part``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopseg.functions.scalar import na_to_null

# Column names and reader types of the transaction table (fixed by the data model).
TRANSACTION_COLUMNS = ["User_ID", "Product_ID", "Gender", "Age", "Occupation", "City_Category",
                       "Stay_In_Current_City_Years", "Marital_Status", "Product_Category", "Purchase"]
BASKET_COLUMNS = ["User_ID", "Product_ID", "Product_Category", "Purchase"]

# Raw read schema: text for the columns that need pandas-style coercion later.
RAW_SCHEMA = T.StructType([
    T.StructField("User_ID", T.IntegerType()),
    T.StructField("Product_ID", T.StringType()),
    T.StructField("Gender", T.StringType()),
    T.StructField("Age", T.StringType()),
    T.StructField("Occupation", T.ShortType()),
    T.StructField("City_Category", T.StringType()),
    T.StructField("Stay_In_Current_City_Years", T.StringType()),
    T.StructField("Marital_Status", T.ByteType()),
    T.StructField("Product_Category", T.StringType()),
    T.StructField("Purchase", T.FloatType()),
])

ASSIGNMENT_SCHEMA = T.StructType([
    T.StructField("User_ID", T.IntegerType()),
    T.StructField("cluster", T.IntegerType()),
])


def _typed(df: DataFrame) -> DataFrame:
    """Cast a text or typed frame to the raw transaction types; pandas NA tokens -> NULL."""
    out = []
    for f in RAW_SCHEMA.fields:
        c = F.col(f.name)
        if f.name not in df.columns:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            out.append(na_to_null(c.cast("string")).alias(f.name))
        elif isinstance(df.schema[f.name].dataType, T.NumericType):
            out.append(c.cast(f.dataType).alias(f.name))
        else:
            out.append(na_to_null(F.trim(c.cast("string"))).try_cast(f.dataType).alias(f.name))
    return df.select(*out)


def read_transactions(spark: SparkSession, path: str, fmt: str | None = None,
                      columns: list[str] | None = None) -> DataFrame:
    """Typed, column-pruned read of the transaction table.

    CSV is read as text (no schema inference) and coerced the way the
    reference's reader does; parquet keeps its own types and is cast.
    ``columns`` prunes to a subset (S2 uses ``BASKET_COLUMNS``).
    """
    fmt = fmt or ("csv" if path.endswith(".csv") else "parquet")
    if fmt == "csv":
        raw = (spark.read.option("header", True).option("inferSchema", False)
               .option("nullValue", "").csv(path))
    else:
        raw = spark.read.format(fmt).load(path)
    wanted = columns or TRANSACTION_COLUMNS
    return _typed(raw.select(*[c for c in wanted if c in raw.columns])).select(*wanted)


REJECTED = "__line"


def read_transactions_rescued(spark: SparkSession, path: str, columns: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """S1 / S4 for CSV files that may hold bad lines: ``(transactions, rejected)``.

    ``rejected`` has a row per line kept apart: ``reason`` and ``line``. A line is ``fields`` if it has more or fewer fields
    than the header, and ``bytes`` if it is no valid UTF-8. Lines that are whole but hold values of a wrong type are not bad:
    such values become NULL, as in ``read_transactions``.
    """
    header = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    schema = T.StructType([*(T.StructField(c, T.StringType()) for c in header), T.StructField(REJECTED, T.StringType())])
    lines = spark.read.option("header", True).option("mode", "PERMISSIVE").option("nullValue", "") \
        .option("columnNameOfCorruptRecord", REJECTED).schema(schema).csv(path)
    whole = F.concat_ws("\x1f", *[F.col(f"`{c}`") for c in header])
    reason = F.when(F.col(REJECTED).isNotNull(), "fields").when(whole.contains("\ufffd"), "bytes")
    wanted = columns or TRANSACTION_COLUMNS
    good = lines.where(reason.isNull()).select(*[F.col(f"`{c}`") for c in header if c in wanted])
    rejected = lines.withColumn("reason", reason).where(F.col("reason").isNotNull()) \
        .select("reason", F.coalesce(REJECTED, F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in header])).alias("line"))
    return _typed(good).select(*wanted), rejected


def read_raw_strings(spark: SparkSession, path: str) -> DataFrame:
    """Every column as text, nothing dropped or deduplicated (the batch input of ``write_split``)."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def read_assignments(spark: SparkSession, path: str) -> DataFrame:
    """S3: ``User_ID, cluster`` written by the segmentation."""
    if path.endswith(".csv"):
        return spark.read.option("header", True).schema(ASSIGNMENT_SCHEMA).csv(path)
    return spark.read.parquet(path).select(F.col("User_ID").cast("int"), F.col("cluster").cast("int"))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path of any store that Spark reads exists."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def optional_assignments(spark: SparkSession, source: str | DataFrame | None) -> DataFrame | None:
    """The per-segment mining level runs only when assignments exist (a path, or a table already at hand)."""
    if isinstance(source, DataFrame):
        return source.select(F.col("User_ID").cast("int"), F.col("cluster").cast("int"))
    if not source or not path_exists(spark, source):
        return None
    return read_assignments(spark, source)


# ---------------------------------------------------------------------------
# Mapping from the star-schema test tables (FIXTURES.md §2)
# ---------------------------------------------------------------------------

def _tables(spark: SparkSession, sf_dir: str):
    def t(name, cols):
        return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)
    li = t("lineitem", ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
                        "l_discount", "l_tax", "l_returnflag", "l_linestatus"])
    o = t("orders", ["o_orderkey", "o_custkey", "o_orderpriority"])
    c = t("customer", ["c_custkey", "c_nationkey"])
    p = t("part", ["p_partkey", "p_brand", "p_type", "p_size"])
    return li, o, c, p


def star_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase lines joined to their order, customer and part (the lines, the largest table, meet the customers with their orders)."""
    li, o, c, p = _tables(spark, sf_dir)
    return li.join(o.join(c, o.o_custkey == c.c_custkey), li.l_orderkey == o.o_orderkey) \
        .join(p, li.l_partkey == p.p_partkey)


def transactions_from_tables(spark: SparkSession, sf_dir: str, variant: str = "clean") -> DataFrame:
    """The transaction table mapped from the test tables.

    ``variant``: ``clean``; ``dirty`` (nulls and junk text injected by rule);
    ``planted`` (every 50th customer buys only category 26 at 5 % prices,
    a niche the segmentation must find); ``dup`` (every line twice).
    """
    j = star_lines(spark, sf_dir)
    brand_no = F.substring_index(F.col("p_brand"), "#", -1)
    category = F.when(F.col("p_size") == 50, F.lit(None).cast("string")).otherwise(brand_no)
    purchase = F.col("l_extendedprice")
    product = F.concat(F.lit("P"), F.lpad(F.col("l_partkey").cast("string"), 8, "0"))
    stay = F.when(F.col("l_linenumber") >= 4, F.lit("4+")).otherwise(F.col("l_linenumber").cast("string"))
    age = F.col("o_orderpriority")
    if variant == "dirty":
        purchase = F.when(F.col("l_quantity") == 50, F.lit(None)).otherwise(purchase)
        stay = F.when(F.col("l_discount") == F.lit(0.1), F.lit(None)).otherwise(stay)
        age = F.when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(age)
        product = F.when(F.col("l_partkey") % 97 == 0, F.lit(None)).otherwise(product)
        category = F.when(F.col("p_size") == 49, F.lit("abc")).otherwise(category)
        stay = F.when((F.col("l_linenumber") == 2) & (F.col("l_quantity") < 10), F.lit("2.0")).otherwise(stay)
    if variant == "planted":
        planted = F.col("o_custkey") % 50 == 0
        category = F.when(planted, F.lit("26")).otherwise(category)
        purchase = F.when(planted, F.lit(5.0) * F.col("l_extendedprice") / F.lit(100.0)).otherwise(purchase)
    user = F.col("o_custkey")
    if variant == "dirty":
        user = F.when(F.col("o_orderkey") % 101 == 0, F.lit(None)).otherwise(user)
    out = j.select(
        user.cast("int").alias("User_ID"),
        product.alias("Product_ID"),
        F.col("l_linestatus").alias("Gender"),
        age.alias("Age"),
        F.col("c_nationkey").cast("smallint").alias("Occupation"),
        F.col("l_returnflag").alias("City_Category"),
        stay.alias("Stay_In_Current_City_Years"),
        F.when(F.col("l_tax") >= F.lit(0.04), F.lit(1)).otherwise(F.lit(0)).cast("tinyint").alias("Marital_Status"),
        category.alias("Product_Category"),
        purchase.cast("float").alias("Purchase"),
    )
    if variant == "dup":
        out = out.unionByName(out)
    return out


def region_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A given segmentation of the test users: the customer's region key."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_nationkey")
    n = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_regionkey")
    return (c.join(n, c.c_nationkey == n.n_nationkey)
             .select(F.col("c_custkey").cast("int").alias("User_ID"),
                     F.col("n_regionkey").cast("int").alias("cluster")))


def basket_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User x item lines for rule mining on the test tables.

    ``category_item`` is ``brand/type`` (a plain brand is too dense to give
    lift), ``product_item`` the part key.
    """
    j = star_lines(spark, sf_dir)
    return j.select(
        F.col("o_custkey").cast("int").alias("User_ID"),
        F.concat_ws("/", F.col("p_brand"), F.col("p_type")).alias("category_item"),
        F.col("l_partkey").cast("string").alias("product_item"),
    )


# ---------------------------------------------------------------------------
# Sinks
# ---------------------------------------------------------------------------

def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K1: one result table, header on for CSV, overwritten."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)


def write_split(raw: DataFrame, segments: DataFrame, path: str, fmt: str = "csv") -> None:
    """K2: route raw rows to ``segment=core`` / ``segment=niche`` folders in one job.

    ``segments`` is ``(User_ID, segment)``; rows of users without a segment are
    not written (the reference writes only users seen by the segmentation).
    Always recomputed: stale files are overwritten, never reused.
    """
    routed = raw.join(segments, raw["User_ID"].cast("int") == segments["User_ID"], "inner") \
                .drop(segments["User_ID"])
    w = routed.write.mode("overwrite").partitionBy("segment")
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)
