"""K1: all result tables of a run, committed together.

Tables are written to ``<root>/tables/<run>/<name>``. When all are there, a manifest with every table's row count, columns and
content hash is written to ``<root>/manifests/<run>``, last of all; a run counts once its manifest is complete, so a
run that fails between two tables leaves the one before it as the newest. Readers resolve tables through the manifest.
Nothing is ever overwritten; runs are numbered in order of their commit.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopseg.plans.levels import Mined
from shopseg.plans.segmentation import HybridResult, VariantResult, sample_assignments
from shopseg.operators.profile import cluster_sizes

MANIFEST = "number long, run string, name string, path string, rows long, columns array<string>, hash string"


def _content(df: DataFrame) -> tuple[int, str]:
    """Row count and a hash that does not depend on the rows' order."""
    digest = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)")
    r = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(digest), F.lit(0)).cast("string").alias("hash")).first()
    return r["rows"], r["hash"]


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path`` that Spark finished writing (of any store that Spark reads)."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(fs_path):
        return []
    done = spark._jvm.org.apache.hadoop.fs.Path
    return [s.getPath().getName() for s in fs.listStatus(fs_path) if fs.exists(done(s.getPath(), "_SUCCESS"))]


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """The manifests of all committed runs: a row per table."""
    runs = _folders(spark, f"{root}/manifests")
    if not runs:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(*[f"{root}/manifests/{r}" for r in runs])


def write_run(spark: SparkSession, root: str, tables: dict[str, DataFrame], run: str | None = None) -> str:
    """Write ``tables`` and commit them as one run; returns the run's name (a new one if not given)."""
    run = run or uuid.uuid4().hex
    if run in _folders(spark, f"{root}/manifests"):
        raise ValueError(f"run {run!r} is committed already")
    attempt, rows = uuid.uuid4().hex, []  # an earlier attempt at the same run is left alone
    for name, df in tables.items():
        path = f"tables/{run}/{attempt}/{name}"
        df.write.parquet(f"{root}/{path}")
        rows.append((name, path, *_content(spark.read.parquet(f"{root}/{path}")), df.columns))
    newest = manifests(spark, root).agg(F.max("number")).first()[0]
    number = 0 if newest is None else newest + 1
    spark.createDataFrame([(number, run, name, path, n, columns, digest) for name, path, n, digest, columns in rows], MANIFEST) \
        .coalesce(1).write.parquet(f"{root}/manifests/{run}")
    return run


def read_run(spark: SparkSession, root: str, name: str, run: str | None = None, verify: bool = False) -> DataFrame:
    """Table ``name`` of a committed run (the newest one by default); ``verify`` checks it against the manifest."""
    listed = manifests(spark, root)
    if run is None:  # of runs committed at the same time, which share a number, the last by name
        newest = listed.orderBy(F.desc("number"), F.desc("run")).first()
        run = newest["run"] if newest else None
    row = listed.where((F.col("run") == run) & (F.col("name") == name)).first()
    if row is None:
        raise ValueError(f"no committed table {name!r} in {root}" + (f", run {run!r}" if run else ""))
    df = spark.read.parquet(f"{root}/{row.path}")
    if verify and (_content(df) != (row["rows"], row["hash"]) or df.columns != row["columns"]):
        raise ValueError(f"table {name!r} of run {row['run']!r} does not match its manifest")
    return df


# ---------------------------------------------------------------------------
# What the runners write
# ---------------------------------------------------------------------------

def rules_tables(mined: Mined, top: int = 200) -> dict[str, DataFrame]:
    """Rules in both forms, the first ``top`` of each level by lift, item support, the run summary, and itemset rules if mined."""
    from shopseg.operators.rules import top_rules

    out = {"rules": mined.rules, "rules_directed": mined.directed, "rules_top": top_rules(mined.rules, top),
           "item_support": mined.basket.item_counts, "run_summary": mined.summary}
    return out | ({"itemset_rules": mined.itemset_rules} if mined.itemset_rules is not None else {})


def hybrid_tables(result: HybridResult, p: int = 50, rejected: DataFrame | None = None) -> dict[str, DataFrame]:
    """Assignments, sizes, niches and core of both passes, profile, silhouettes, merge tails and a sample."""
    spark = result.final.sparkSession
    scores = [("detect", result.silhouette_detect, result.detect_certain), ("core", result.silhouette_core, result.core_certain)]
    out = {
        "detect_assignments": result.detect_labels, "detect_sizes": result.detect_sizes, "niche_users": result.niche_users,
        "core_users": result.core_users, "core_assignments": result.core_labels, "core_sizes": cluster_sizes(result.core_labels),
        "final_assignments": result.final, "final_profile": result.profile, "sample_assignments": sample_assignments(result.final),
        "silhouettes": spark.createDataFrame(scores, "pass string, silhouette double, certain boolean"),
        "detect_merges": result.detect_tree.tail(p), "core_merges": result.core_tree.tail(p)}
    return out | ({"rejected_lines": rejected} if rejected is not None else {})


def variant_tables(result: VariantResult, profile: DataFrame, p: int = 50) -> dict[str, DataFrame]:
    """Assignments, profile, silhouette per k, the chosen k and the merge tail of a one-pass variant."""
    spark = profile.sparkSession
    return {"assignments": result.labels, "profile": profile,
            "silhouette_by_k": spark.createDataFrame([(k, float(s)) for k, s in result.scores], "k int, silhouette double"),
            "best_k": spark.createDataFrame([(result.variant, result.linkage, result.metric, result.k, result.certain)],
                                            "variant string, linkage string, metric string, k int, certain boolean"),
            "merges": result.tree.tail(p)}
