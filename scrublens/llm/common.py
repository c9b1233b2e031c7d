"""What the operators of this subpackage share: tables, folds and written steps."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scrublens.operators.columns import column

#: Fixed value: white space between words, as a character class of regular expressions.
SPACE = r"\x20\x09-\x0D"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(value: Column) -> Column:
    """A-Z to a-z, all other characters as they are."""
    return F.translate(value, UPPER, LOWER)


def fold(key: Column, folds: int) -> Column:
    """Remainder of the CRC-32 of the key as text; a null key counts as empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return (F.crc32(text.cast("binary")) % folds).cast("int")


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder that driver and executors share: below ``spark.checkpoint.dir``, or
    where that is unset, below the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.sql.warehouse.dir"
    )
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


#: Whether the shuffle files of a query go when it ends.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, group_rows: int | None = None, free_shuffles: bool = False) -> DataFrame:
    """``df`` as a table in the shared folder. Cuts the lineage: what was written does not
    depend on executors that ran it, and later steps read it again at the cost of a scan.
    For wide rows, ``group_rows`` bounds the rows that a reader holds at once. With
    ``free_shuffles``, what was shuffled for the step goes when it is written."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table"
    writer = df.write.option("compression", "zstd")
    if group_rows:
        writer = writer.option("parquet.block.row.count.limit", group_rows)
    if not free_shuffles:
        writer.parquet(path)
    else:
        before = spark.conf.get(_FREE_SHUFFLES, "false")
        spark.conf.set(_FREE_SHUFFLES, "true")
        try:
            writer.parquet(path)
        finally:
            spark.conf.set(_FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def removed(*tables: DataFrame) -> None:
    """Remove the files of tables from ``written`` that no later step reads."""
    for df in tables:
        spark = df.sparkSession
        folders = {name.rsplit("/", 1)[0] for name in df.inputFiles()}
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder).getParent()
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def row_key(id_col: str, text_col: str) -> Column:
    """What tells a document from others, whatever its id: the id and a digest of the text.
    Rows that agree in it are true copies. Orders as the id does, null first."""
    text = F.coalesce(column(text_col), F.lit(""))
    return F.struct(column(id_col).alias("id"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))


def keep_rows(df: DataFrame, ids: DataFrame, id_col: str, how: str) -> DataFrame:
    """Rows of ``df`` whose id is (``left_semi``) or is not (``left_anti``) among ``ids``,
    a table of one column. Null ids match null ids. All columns stay as they are."""
    other = ids.toDF("_kept_id")
    return df.join(other, column(id_col).eqNullSafe(F.col("_kept_id")), how)
