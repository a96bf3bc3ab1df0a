"""Small helpers shared by the text operators."""

from __future__ import annotations

import os
import re
import shutil
import tempfile

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graticule.session import configure, materialize

WHITE = r"[\x20\x09-\x0D]+"  # the white space that separates words, everywhere in this package


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that their Python can import it."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        archive = os.path.join(tempfile.mkdtemp(prefix="graticule-"), "graticule-package")
        spark.sparkContext.addPyFile(shutil.make_archive(archive, "zip", root, "graticule"))
        _SHIPPED.add(app)
    # texts can be long: small batches bound what a Python worker holds at once
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def settled(docs: DataFrame) -> DataFrame:
    """The rows as files: docs itself where it only reads, selects and filters files, else a written copy.

    Operators that read a table twice know a row by its file and its place there, which
    hold whatever becomes of splits, executors and columns read.
    """
    nodes = re.findall(r"^[ :+|-]*(\w+)", docs._jdf.queryExecution().analyzed().toString(), re.MULTILINE)
    if set(nodes) <= {"Project", "Filter", "Relation", "SubqueryAlias"}:
        try:
            docs.select(docs.metadataColumn("_metadata")["row_index"])
            return docs
        except AnalysisException:
            pass
    return materialize(docs, "rows")


def row_tag(docs: DataFrame) -> Column:
    """A 63-bit hash, not negative, of a settled row's file and its place there."""
    place = docs.metadataColumn("_metadata")
    return F.xxhash64(place["file_path"], place["row_index"]).bitwiseAND(F.lit((1 << 63) - 1))


def tagged(docs: DataFrame, *columns: Column) -> DataFrame:
    """The columns wanted of settled rows plus ``_tag``, which tells repeated rows apart."""
    return docs.select(*columns, row_tag(docs).alias("_tag"))


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The settled rows whose tags are not among the dropped ones; same columns.

    The dropped side holds tags only and is the hashed one, so the texts are not sorted.
    """
    rows = tagged(docs, F.struct(*[docs[c] for c in docs.columns]).alias("_row"))
    return rows.join(dropped.select("_tag").hint("shuffle_hash"), "_tag", "left_anti").select("_row.*")
