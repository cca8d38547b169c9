"""Shared helpers: column expressions, the shared scratch folder, fresh names."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ASCII white space, the separator of every contract in this package.
SPACE_CLASS = r"\x20\x09-\x0D"
WORD_PATTERN = rf"[^{SPACE_CLASS}]+"


def text_of(col: str | Column) -> Column:
    """The text, with NULL as the empty text."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def utf8_bytes(col: str | Column) -> Column:
    return F.octet_length(text_of(col)).cast("long")


def unsigned_crc32(col: str | Column) -> Column:
    """CRC-32 of the UTF-8 bytes as an unsigned long (NULL as empty)."""
    return F.crc32(F.encode(text_of(col), "UTF-8"))


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """True for the fold that no model may learn from (a NULL id counts as '')."""
    return (F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds) == 0


def fresh(df: DataFrame, name: str) -> str:
    """A column name based on ``name`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def quoted(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def all_but(df: DataFrame, *names: str) -> list[Column]:
    """The columns of ``df`` except those named (case does not matter)."""
    out = {n.lower() for n in names}
    return [quoted(c) for c in df.columns if c.lower() not in out]


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Where it is unset, a local session (tests) gets a new temporary folder;
    a cluster session must name one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='cardwatch-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends here,
    so a lost executor costs its own tasks and nothing upstream.  ``options``
    go to the writer."""
    path = new_folder(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the executors (once a session), for
    Python workers that do not have it on their path."""
    sc, package = spark.sparkContext, Path(__file__).resolve().parents[1]
    if sc.applicationId in _shipped or not package.is_dir():  # not a folder: it came by --py-files
        return
    archive = Path(tempfile.mkdtemp(prefix="cardwatch-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


def python_workers(spark: SparkSession, rows: int = 256) -> None:
    """What operators with Python code need: the package on the executors and
    Arrow batches bounded in rows (few for texts, more for narrow rows) and
    bytes, so that long texts fit."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
