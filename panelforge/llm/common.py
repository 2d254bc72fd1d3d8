"""Helpers shared by the corpus operators: scratch tables, folds, Arrow batch size."""
from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelforge.session import checkpoint_dir

#: Rows of a text table per Arrow batch: bounds a Python worker's memory when texts are long.
TEXT_BATCH_ROWS = 1000


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package's code to the executors once per application (``addPyFile``).

    The archive is a file of the driver alone, from which Spark serves it; it holds no data.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="panelforge-code-")) / "panelforge_code.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent).as_posix())
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the given tables; text batches sent to Python stay small."""
    ship_code(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: For tables whose rows are megabytes: a writer looks at the size of what it holds after each row, not after a
#: hundred, and a reader, which takes a row group's rows at once, finds small ones.
LARGE_ROWS = {"parquet.page.size.row.check.min": "1", "parquet.block.size": str(32 << 20), "parquet.enable.dictionary": "false"}


def scratch_table(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` once as Parquet to the shared checkpoint folder and read it back.

    Cuts the lineage for good: a lost executor re-reads the files, nothing upstream runs again.
    Every call takes a new folder. ``options``: the writer's, such as ``LARGE_ROWS``.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/panelforge-llm/{name}-{uuid.uuid4().hex}"
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_fold(doc_id: Column, folds: int, fold: int) -> Column:
    """True for ids with crc32(id as text) mod ``folds`` = ``fold``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int,
                    max_per_class: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``text, y`` to learn a label from: never held-out ids, at most ``max_per_class`` a class.

    The ids kept are those with the smallest hash, so reruns agree; a doc labelled more than once
    takes its largest label; unlabelled rows and null ids are left out. The id list is bounded by
    2 * ``max_per_class``, hence the broadcast.
    """
    picked = (labels.select(F.col(id_col).alias("i"), F.col(label).cast("int").alias("y"))
              .filter("i is not null and y is not null").groupBy("i").agg(F.max("y").alias("y"))
              .filter(~in_fold(F.col("i"), folds, held_out)).withColumn("h", F.xxhash64("i")))
    ids = None
    for value in (0, 1):
        part = picked.filter(F.col("y") == value).orderBy("h", "i").limit(max_per_class)
        ids = part if ids is None else ids.unionByName(part)
    texts = docs.select(F.col(id_col).alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.join(F.broadcast(ids.select("i", "y")), "i").select("text", "y")


def drop_scratch(*tables: DataFrame) -> None:
    """Delete the files of tables made by ``scratch_table`` that nothing will read any more."""
    for table in tables:
        files = table.inputFiles()
        if not files:
            continue
        context = table.sparkSession.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        if folder.getParent().getName() == "panelforge-llm":
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
