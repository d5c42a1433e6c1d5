"""Publishing: app records as rows of the table `apps`, staged and swapped, and its metadata."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import APPS

SAMPLE = 1000
NEEDED = ("id", "name", "short_description", "packages_json")  # columns that are never null


def bool_column(x: Column) -> Column:
    """1, 0 or null."""
    return x.cast("int")


def json_column(x: Column) -> Column:
    """JSON text; null stays null, an empty list is []."""
    return F.to_json(x)


def to_rows(apps: DataFrame) -> DataFrame:
    """Apps to the columns of APPS, in order. Fields that the apps do not have are null; what is text already counts as JSON."""
    texts = {c for c, kind in apps.dtypes if kind == "string"}

    def column(name: str, kind: str, path: str) -> Column:
        if path.split(".")[0] not in apps.columns:
            return F.lit(None).cast(kind).alias(name)
        x = F.col(path)
        return (json_column(x) if name.endswith("_json") and path not in texts else bool_column(x) if kind == "int" else x.cast(kind)).alias(name)

    return apps.select(*(column(*c) for c in APPS))


def apps_table_sql(table: str, folder: str | None = None) -> str:
    columns = ", ".join(f"{n} {k.upper()}" + (" NOT NULL" if n in NEEDED else "") for n, k, _ in APPS)
    return f"CREATE TABLE {table} ({columns}) USING parquet" + (f" LOCATION '{folder}'" if folder else "")


def upsert_meta(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """The rows of new (key, value), and those of old under other keys."""
    return new if old is None else old.join(new.select("key"), "key", "left_anti").select("key", "value").unionByName(new.select("key", "value"))


def meta_rows(spark: SparkSession, generated_at: str, apps: DataFrame) -> DataFrame:
    total = apps.agg(F.count("*").cast("string").alias("value")).select(F.lit("totalApps").alias("key"), "value")
    return total.unionByName(spark.range(1).select(F.lit("generatedAt").alias("key"), F.lit(generated_at).alias("value")))


def has_table(spark: SparkSession, table: str) -> bool:
    return bool(spark.sql(f"SHOW TABLES LIKE '{table}'").head(1))


def _location(spark: SparkSession, table: str) -> str:
    return next(r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r["col_name"] == "Location")


def _folder(spark: SparkSession, table: str) -> str:
    """A new folder for a table's rows, so that changing names moves no data."""
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table}-{uuid4().hex}"


def _stage(rows: DataFrame, table: str) -> None:
    """rows as {table}_next."""
    spark = rows.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {table}_next")
    rows.write.option("path", _folder(spark, table)).saveAsTable(f"{table}_next")


def _checked(spark: SparkSession, table: str) -> DataFrame:
    """The rows of a staged table of apps, whose ids are there once and whose needed columns are never null; else it raises."""
    stored = spark.table(table)
    gaps = stored.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in NEEDED)).first().asDict()
    if any(gaps.values()):
        raise ValueError(f"null in {', '.join(c for c, n in gaps.items() if n)}")
    if stored.groupBy("id").count().where("count > 1").head(1):
        raise ValueError("ids are not unique")
    return stored


def _swap(spark: SparkSession, tables: list[str]) -> None:
    """Each {table}_next takes its name, all or none: what fails on the way is put back. What had the names before goes with its files."""
    moved, gone = [], []
    try:
        for table in tables:
            spark.sql(f"DROP TABLE IF EXISTS {table}_old")
            if has_table(spark, table):
                gone.append(_location(spark, table))
                spark.sql(f"ALTER TABLE {table} RENAME TO {table}_old")
                moved.append((f"{table}_old", table))
            spark.sql(f"ALTER TABLE {table}_next RENAME TO {table}")
            moved.append((table, f"{table}_next"))
    except Exception:
        for now, before in reversed(moved):
            spark.sql(f"ALTER TABLE {now} RENAME TO {before}")
        raise
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}_old")
    for path in gone:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def publish(apps: DataFrame, generated_at: str, table: str = "apps", meta: str = "meta") -> None:
    """Replaces the table by these apps, and upserts generatedAt and totalApps.

    Rows go to staging tables; only when both are complete and the apps are found sound, tables change names, all of them or none,
    so a failure leaves the old ones. The renames are not one transaction of the store: a reader between them finds no table.
    """
    spark = apps.sparkSession
    rows = to_rows(apps)
    spark.sql(f"DROP TABLE IF EXISTS {table}_next")
    spark.sql(apps_table_sql(f"{table}_next", _folder(spark, table)))
    rows.write.insertInto(f"{table}_next")
    stored = _checked(spark, f"{table}_next")
    _stage(upsert_meta(spark.table(meta) if has_table(spark, meta) else None, meta_rows(spark, generated_at, stored)), meta)
    _swap(spark, [table, meta])


def sample(apps: DataFrame, rows: int = SAMPLE) -> DataFrame:
    """The first apps in group order."""
    return apps.orderBy("label").limit(rows)
