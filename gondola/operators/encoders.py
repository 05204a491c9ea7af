"""Text encoders (UDF-4): a pluggable slot plus a native default.

* ``hashed_tfidf``: char_wb n-grams hashed into ``dims`` buckets (md5 → integer, mod dims), idf over
  the corpus, L2-normalised, as a dense ``array<double>`` — pure Spark, no model download.
* ``embed_with``: any batch encoder ``f(list[str]) -> 2-D array`` (e.g. an ONNX sentence model) runs
  in ``mapInPandas``; it is loaded once per Python worker (module-level cache), never per row.
The encoder id travels with the vectors so vectors of different encoders are never mixed (pin D19).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gondola.functions.text import char_wb_windows, strip_accents
from gondola.session import spread


def hashed_tfidf(df: DataFrame, key: str, text_col: str, dims: int = 256) -> DataFrame:
    """(key, encoder, vector array<double>[dims]) — native hashed char-n-gram TF-IDF."""
    grams = char_wb_windows(strip_accents(F.lower(F.col(text_col))))
    bucket = (F.conv(F.substring(F.md5(F.col("gram")), 1, 8), 16, 10).cast("long") % dims).cast("int")
    tf = (spread(df).select(key, F.explode(grams).alias("gram")).filter(F.instr("gram", "  ") == 0)
          .withColumn("b", bucket)
          .groupBy(key, "b").agg(F.count(F.lit(1)).alias("tf")))
    n = df.select(F.count(F.lit(1))).scalar()
    idf = tf.groupBy("b").agg(F.log((F.lit(1) + n) / (F.lit(1) + F.count(F.lit(1)))).alias("_i"))
    w = tf.join(F.broadcast(idf), "b").withColumn("w0", F.col("tf") * (F.col("_i") + 1.0))
    w = w.withColumn("w", F.col("w0") / F.sqrt(F.sum(F.col("w0") * F.col("w0")).over(Window.partitionBy(key))))
    sparse = w.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("b", "w"))).alias("_m"))  # ≤ dims
    dense = F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda i: F.coalesce(F.col("_m")[i], F.lit(0.0)))
    return sparse.select(key, F.lit(f"hashed_tfidf_{dims}").alias("encoder"), dense.alias("vector"))


def embed_with(df: DataFrame, key: str, text_col: str, encoder_id: str,
               load: Callable[[], Callable[[list[str]], object]], dims: int) -> DataFrame:
    """Pluggable encoder in Arrow batches; ``load()`` builds the model once per Python worker."""
    import numpy as np
    import pandas as pd

    cache: dict = {}

    def run(batches):
        if "f" not in cache:
            cache["f"] = load()
        for pdf in batches:
            vecs = np.asarray(cache["f"](pdf[text_col].fillna("").tolist()), dtype=float).reshape(len(pdf), dims)
            yield pd.DataFrame({key: pdf[key], "encoder": encoder_id, "vector": list(vecs)})

    key_type = dict(df.dtypes)[key]
    return df.select(key, text_col).mapInPandas(run, f"{key} {key_type}, encoder string, vector array<double>")
