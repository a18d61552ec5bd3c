"""Helpers shared by the operators: table access, folds, scratch tables in the shared folder."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package where the driver runs it from its source folder.

    On a cluster the package is installed or shipped with ``--py-files``; the extra path is harmless.
    """
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as empty text (crc32 0)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and read it back.

    Cuts the lineage: later jobs and lost executors reread the files instead of repeating
    the work.  The folder is the one the cluster names in ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    importable(spark)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidemark-llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def share_below(h: Column, share: float | Column) -> Column:
    """Whether a 64-bit hash column falls in the lowest ``share`` (0 to 1) of all hashes."""
    return (h.cast("double") + F.lit(2.0**63)) < F.lit(2.0**64) * share


def resolve(df: DataFrame, name: str) -> str:
    """The column of ``df`` called ``name``, found as Spark finds it (case does not matter unless the session
    says so); ``ValueError`` if there is none or more than one, so no other column is read in its place."""
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    found = [c for c in df.columns if c == name or (not exact and c.lower() == name.lower())]
    if len(found) != 1:
        raise ValueError(f"{'no' if not found else 'more than one'} column {name!r} among {df.columns}")
    return found[0]


def bounded_sample(df: DataFrame, by: list[str], rows: int) -> DataFrame:
    """The ``rows`` rows of smallest hash of ``by``, in hash order: rows equal in ``by`` count once (all
    distinct ones if there are fewer).

    A first cut by hash, set from the row count to let about twice as many through, keeps what
    tasks send on near ``rows`` in total however many tasks there are.  Where copies leave too few
    behind the cut, it is widened until there are enough or all rows have passed.
    """
    h = fresh(df, "_h")
    hashed = df.withColumn(h, F.xxhash64(*by))
    share = (2.0 * rows + 100) / max(1, df.count())
    while share < 0.5 and hashed.where(share_below(F.col(h), share)).select(h).distinct().limit(rows).count() < rows:
        share *= 8
    if share < 0.5:
        hashed = hashed.where(share_below(F.col(h), share))
    return hashed.dropDuplicates([h]).orderBy(h, *by).limit(rows).drop(h)


def salt(key: Column, n: int) -> Column:
    """A salt in [0, n) from the hash of ``key`` (any column, nulls included)."""
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def within_broadcast(df: DataFrame) -> bool:
    """Whether the planner's size of ``df`` is under the session's broadcast threshold."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size <= df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def lookup(df: DataFrame, small: DataFrame, on: list[str], spread: Column, n_salts: int = 32,
           how: str = "left") -> DataFrame:
    """Equi-join ``df`` with a table of at most one row per key, hot keys split.  Keys compare null-safe.

    A ``small`` under the session's broadcast threshold (a written table: by its size) is joined as it is, so
    Spark's own size-checked broadcast applies.  Beyond it ``small`` is copied ``n_salts`` times and ``df``
    is dealt by (key, salt of ``spread``): a key holding a third of all rows still lands in ``n_salts`` tasks.
    The copies are never broadcast, as the planner does not count them.
    """
    keys = {c: fresh(df, f"_key_{i}") for i, c in enumerate(on)}
    rest = [c for c in small.columns if c not in on]
    right = small.select(*[F.col(c).alias(k) for c, k in keys.items()], *rest)
    cond = F.lit(True)
    for c, k in keys.items():
        cond = cond & df[c].eqNullSafe(F.col(k))
    if within_broadcast(small):
        return df.join(right, cond, how).drop(*keys.values())
    part, there = fresh(df, "_salt"), fresh(df, "_there")
    left = df.withColumn(part, salt(spread, n_salts))
    right = right.withColumn(there, F.explode(F.sequence(F.lit(0), F.lit(n_salts - 1)))).hint("merge")
    cond = F.col(part) == F.col(there)
    for c, k in keys.items():
        cond = cond & left[c].eqNullSafe(F.col(k))
    return left.join(right, cond, how).drop(part, there, *keys.values())
