"""Small DataFrame helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def join_null_safe(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null matches null (pandas semantics for
    group keys); each key column appears once, taken from ``a`` (or from
    ``b`` for rows only ``b`` has in outer joins)."""
    keys = list(keys)
    if not keys:
        raise ValueError("keys required")
    rb = b
    for k in keys:
        rb = rb.withColumnRenamed(k, f"_jr_{k}")
    cond = None
    for k in keys:
        c = a[k].eqNullSafe(rb[f"_jr_{k}"])
        cond = c if cond is None else cond & c
    j = a.join(rb, cond, how)
    from pyspark.sql import functions as F
    key_cols = [F.coalesce(a[k], rb[f"_jr_{k}"]).alias(k) if how in ("full_outer", "outer", "right")
                else a[k] for k in keys]
    rest_a = [a[c] for c in a.columns if c not in keys]
    rest_b = [rb[c] for c in rb.columns if not c.startswith("_jr_")]
    return j.select(*key_cols, *rest_a, *rest_b)


BROADCAST_MAX_BYTES = 16 << 20


def small_side(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint only behind a measured size, the bytes of its rows as
    JSON (``df`` should be a small table such as a feature list or a
    combination table); above the bound the join is left to Spark."""
    from pyspark.sql import functions as F
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    size = df.agg(F.sum(F.octet_length(row))).first()[0] or 0
    return F.broadcast(df) if size <= max_bytes else df


def run_all(fn, items, parallelism: int = 3):
    """Run independent Spark jobs from a few driver threads (the scheduler
    interleaves their stages); results keep the input order."""
    items = list(items)
    if parallelism <= 1 or len(items) <= 1:
        return [fn(x) for x in items]
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=min(parallelism, len(items))) as pool:
        return list(pool.map(fn, items))


def materialize(df: DataFrame, folders: str | None = None) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared checkpoint folder
    and read it back.

    Used where an operator makes several passes (quantile sketch, running
    sums, final join): the upstream plan runs once instead of once per pass,
    and the lineage is cut, so a lost executor re-reads files rather than
    recomputing the whole upstream plan.  The folder comes from
    ``spark.checkpoint.dir`` (shared storage on a cluster); Parquet is
    smaller and faster to read than serialised row checkpoints.  Frames that
    read the table are lazy, so it lives as long as the application: all its
    tables lie in one folder, which the file system deletes when the driver
    ends.  With ``folders`` the rows of each value of that text column lie in
    a folder of their own."""
    import uuid

    from churnkit.session import shared_path
    spark = df.sparkSession
    own = shared_path(spark, f"churnkit-tmp/{spark.sparkContext.applicationId}")
    path = f"{own}/{uuid.uuid4().hex}"
    write = df.write.mode("overwrite")
    (write.partitionBy(folders) if folders else write).parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(own)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return (spark.read.schema(df.schema) if folders else spark.read).parquet(path)
