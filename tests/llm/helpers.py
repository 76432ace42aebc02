"""Small fixtures the tests of the training-data operators share."""

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

ODD = ["", None, " ", "\n", "a", "Word", "Ä", "x" * 5000, "one two three four five six seven eight nine ten eleven",
       "It's a dog's life, isn't it?  Two  spaces\n\nand\ttabs \n newline", "1 2 3 4", "12345678901234567890 " * 50,
       "<|endoftext|> is text, too<|endoftext|>", "no\xa0break  space here", "日本語のテキスト", "naïve café",
       "same line that is long\nsame line that is long\nother", "Same line that is long  \nunique here"]


def table(spark, texts, **extra):
    """A ``documents`` table of these texts with ids from 0, nulls in the other columns, clashing extra columns."""
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA)
    for c, v in ({"part": "p", "size": 1, "key": "k", "h1": 2, "start": None, "length": "l"} | extra).items():
        df = df.withColumn(c, F.lit(v).cast("string") if v is None else F.lit(v))
    return df


def corpus(spark, sf="sf0.001"):
    return spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
