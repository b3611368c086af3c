"""Corpus, training-set, archive, sample and feature-table readers."""

import io
import os
import zipfile
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import LABEL_ALIASES, TEXT_ALIASES
from ..functions.state import cut_lineage
from ..operators.quality import require_columns

BASE_SCHEMA = T.StructType([
    T.StructField("text", T.StringType()), T.StructField("label", T.StringType()),
    T.StructField("prompt_name", T.StringType()), T.StructField("source", T.StringType()),
])


def read_table(spark: SparkSession, path: str, *, schema: T.StructType | None = None,
               fmt: str | None = None) -> DataFrame:
    """CSV (quoted, multi-line), JSON lines or Parquet, by name or by ``fmt``.

    Without a schema CSV columns are strings: values are checked, never guessed.
    """
    kind = fmt or next((k for k in ("csv", "json", "parquet") if f".{k}" in path), "parquet")
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if kind == "csv":
        return reader.csv(path, header=True, multiLine=True, quote='"', escape='"',
                          enforceSchema=False)
    return reader.json(path) if kind == "json" else reader.parquet(path)


CORRUPT = "_corrupt_record"


def quoted_line_breaks(spark: SparkSession, path: str) -> bool:
    """Whether a CSV file has line breaks inside quotes: then some line has an odd number of quotes."""
    odd = F.length(F.regexp_replace("value", '[^"]', "")) % 2 == 1
    return not spark.read.text(path).where(odd).isEmpty()


def typed_csv(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejected)`` of a CSV with a header: rows that fit the schema, and the text of records
    that do not, such as one with a word where a number belongs or with too few fields.

    A file without quoted line breaks is split by lines over many tasks; only others are read as a
    whole. Records are read once and stored, so that both tables come from the same reading.
    """
    read = spark.read.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])).csv(
        path, header=True, multiLine=quoted_line_breaks(spark, path), quote='"', escape='"', mode="PERMISSIVE",
        columnNameOfCorruptRecord=CORRUPT)
    stored = cut_lineage(read)
    return stored.where(F.col(CORRUPT).isNull()).drop(CORRUPT), stored.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on an input with fewer splits than cores, e.g. one small file.

    Large inputs already have more splits than cores and are left where they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def base_corpus(df: DataFrame, *, keep: Iterable[str] = ()) -> DataFrame:
    """``text, label, source, prompt`` of the base corpus, and the columns to keep."""
    return df.withColumnRenamed("prompt_name", "prompt").select("text", "label", "source", "prompt", *keep)


def resolve_columns(df: DataFrame, *, name: str = "input", text_aliases=TEXT_ALIASES,
                    label_aliases=LABEL_ALIASES, keep: Iterable[str] = ()) -> DataFrame:
    """Rename the columns of an extra corpus to ``text`` and ``label``; ``keep`` names others to carry on.

    Names are compared without case and outer blanks, in the order of the aliases, except
    that an exact ``label`` column wins; further candidates are left alone.
    """
    found = {}
    for column in df.columns:
        found.setdefault(column.strip().lower(), column)
    wanted_label = ("label", *[a for a in label_aliases if a != "label"])
    text = next((found[a] for a in text_aliases if a in found), None)
    label = next((found[a] for a in wanted_label if a in found), None)
    if text is None or label is None:
        raise ValueError(f"{name} lacks a column for text or label; it has {', '.join(df.columns)}")
    return df.select(F.col(f"`{text}`").alias("text"), F.col(f"`{label}`").alias("label"), *keep)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on its own file system, local or not."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(target)
    return found is not None and len(found) > 0


def training_dataset(spark: SparkSession, path: str, *, text_column: str = "text",
                     label_column: str = "label", zip_member: str | None = None,
                     columns: Iterable[str] = (), schema: T.StructType | None = None,
                     rejected_path: str | None = None) -> DataFrame:
    """The table a training run starts from: ``text``, ``label`` and whatever else it has.

    With a ``schema`` a CSV is typed; records that do not fit are left out, and written as a table
    of their own where ``rejected_path`` is given.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no file or folder at {path}")
    if path.lower().endswith(".zip"):
        raw = zipped_csv(spark, path, columns=list(columns) or None, member=zip_member)
    elif schema is not None and ".csv" in path.lower():
        raw, rejected = typed_csv(spark, path, schema)
        if rejected_path:
            rejected.write.mode("overwrite").parquet(rejected_path)
    else:
        raw = read_table(spark, path, schema=schema)
    require_columns(raw, {text_column, label_column})
    if text_column != "text":
        raw = raw.drop("text").withColumnRenamed(text_column, "text")
    if label_column != "label":
        raw = raw.drop("label").withColumnRenamed(label_column, "label")
    return raw


def _member(archive: zipfile.ZipFile, wanted: str | None) -> str:
    """The member to read: the one named, else the archive's only CSV file."""
    tables = [i.filename for i in archive.infolist() if not i.is_dir() and i.filename.lower().endswith(".csv")]
    if wanted is None and len(tables) == 1:
        return tables[0]
    if wanted in archive.namelist():
        return wanted
    raise ValueError(f"name one member to read; the archive holds {tables}")


def zipped_csv(spark: SparkSession, path: str, *, columns: list[str] | None = None,
               member: str | None = None, batch_rows: int = 10_000) -> DataFrame:
    """CSV rows out of ZIP archives, all columns as strings, one task per archive: a convenience
    for small files, not for scale.

    ``columns`` names the columns to read; without it the header of the first archive does.
    """
    archives = spark.read.format("binaryFile").load(path).select("content")

    def rows_of(content: bytes, **options) -> Iterator[pd.DataFrame]:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            with archive.open(_member(archive, member)) as handle:
                yield from pd.read_csv(handle, dtype=str, keep_default_na=False, na_values=[""],
                                       chunksize=batch_rows, **options)

    if columns is None:
        def headers(batches):
            for batch in batches:
                for content in batch["content"]:
                    names = list(next(rows_of(content, nrows=1)).columns)
                    yield pd.DataFrame({"names": [names]})

        columns = list(archives.mapInPandas(headers, "names array<string>").first()["names"])

    def unzip(batches):
        for batch in batches:
            for content in batch["content"]:
                for chunk in rows_of(content):
                    yield chunk.reindex(columns=columns).astype(object).where(
                        lambda x: x.notna(), None)

    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return archives.mapInPandas(unzip, schema)


def sample_sets(spark: SparkSession, path: str, *, sets=("ai_samples", "clean_controls")) -> DataFrame:
    """``set, sample, text`` from a JSON file of string lists; ``sample`` counts from 1."""
    schema = T.StructType([T.StructField(s, T.ArrayType(T.StringType())) for s in sets])
    raw = spark.read.schema(schema).json(path, multiLine=True)
    frames = [
        raw.select(F.lit(s).alias("set"), F.posexplode(s).alias("sample", "text"))
        .withColumn("sample", F.col("sample") + 1)
        for s in sets
    ]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def feature_table(spark: SparkSession, path: str | None = None, *, columns=None) -> DataFrame:
    """A stored feature table; ``DATA_PATH`` names it when no path is given."""
    located = path or os.environ.get("DATA_PATH")
    if not located:
        raise ValueError("give a path or set DATA_PATH")
    table = read_table(spark, located)
    return table.select(*columns) if columns else table
