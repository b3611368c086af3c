"""Labels, keys, merging and exact de-duplication."""

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from ..functions.constants import CORPUS_LABELS, LABEL_NAMES, LOADER_LABELS
from ..functions.state import cut_lineage
from .running import dense_index, running_total


def _lookup(key: Column, mapping: Mapping[str, int]) -> Column:
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)


def map_corpus_labels(
    df: DataFrame, *, label_col: str = "label", mapping: Mapping[str, int] = CORPUS_LABELS
) -> DataFrame:
    """Case-sensitive label vocabulary; labels outside it become null. Numbers pass."""
    if isinstance(df.schema[label_col].dataType, T.StringType):
        mapped = _lookup(tx.strip(F.col(label_col)), mapping)
    else:
        mapped = F.col(label_col).cast("int")
    return df.withColumn(label_col, mapped)


def loader_label(label: Column) -> Column:
    """Case-insensitive label of the training loader; null when unsupported."""
    key = F.lower(tx.strip(label.cast("string")))
    return _lookup(F.regexp_replace(key, r"^([01])\.0$", "$1"), LOADER_LABELS)


def label_name(label: Column) -> Column:
    return F.when(label == 0, LABEL_NAMES[0]).when(label == 1, LABEL_NAMES[1])


def label_audit(df: DataFrame, *, raw_col: str, mapped_col: str) -> DataFrame:
    """Rows per raw label and what it maps to (null: unmapped, dropped later)."""
    return df.groupBy(raw_col, mapped_col).agg(F.count(F.lit(1)).alias("rows"))


def tag_source(df: DataFrame, *, source: str | None = None, prompt: str = "unknown") -> DataFrame:
    """Set ``source`` to a name, or to the stem of the file or of the folder of part files each row
    was read from; a folder counts if it is called like a table, ``name.parquet``."""
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)\.(?:parquet|csv|json|jsonl)/", 1)
    stem = F.lit(source) if source else F.when(folder != "", folder).otherwise(
        F.regexp_replace(F.col("_metadata.file_name"), r"\.\w+$", ""))
    return df.withColumns({"source": stem, "prompt": F.lit(prompt)})


def with_defaults(df: DataFrame, *, columns=("source", "prompt"), default: str = "unknown") -> DataFrame:
    """Null or absent provenance becomes ``unknown``."""
    return df.withColumns({
        c: F.coalesce(F.col(c), F.lit(default)) if c in df.columns else F.lit(default)
        for c in columns
    })


def numeric_ids(df: DataFrame, columns) -> DataFrame:
    """Text columns whose values are all whole numbers become numbers, so that they sort as such.

    A value counts as a number if writing the number gives the value again: ``007`` stays text,
    and with it its column.
    """
    names = [c for c in columns if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)]
    if not names:
        return df
    odd = df.agg(*[F.count_if(F.col(c).isNotNull() & ~F.coalesce(
        F.expr(f"cast(try_cast(`{c}` as bigint) as string)") == F.col(c), F.lit(False))).alias(c) for c in names]).first()
    return df.withColumns({c: F.col(c).cast("long") for c in names if odd[c] == 0})


def with_keys(df: DataFrame, *, id_column: str | None = "id") -> DataFrame:
    """Settle ``doc_id`` and ``sent_id``: stored key, else ``id_column``, else row number.

    Rows are numbered in the order of their files where they come from files, else in the order
    in which Spark holds them.
    """
    if "doc_id" not in df.columns:
        if id_column and id_column in df.columns:
            df = df.withColumn("doc_id", F.col(id_column))
        else:
            files = {"_file": F.col("_metadata.file_path"), "_start": F.col("_metadata.file_block_start")}
            try:
                placed = df.select("*", *[v.alias(k) for k, v in files.items()])
            except AnalysisException:  # a computed table has no files
                placed = df.select("*", F.lit("").alias("_file"), F.lit(0).alias("_start"))
            placed = cut_lineage(placed.withColumn("_row", F.monotonically_increasing_id()))
            place = ["_file", "_start", "_row"]
            df = dense_index(placed, order=place, out="doc_id").drop(*place)
    return df if "sent_id" in df.columns else df.withColumn("sent_id", F.lit(0))


def with_sample_id(df: DataFrame) -> DataFrame:
    return df.withColumn("sample_id", F.concat_ws(":", F.col("doc_id").cast("string"),
                                                  F.col("sent_id").cast("string")))


def merge_corpora(frames: list[DataFrame], *, columns=("text", "label", "source", "prompt")) -> DataFrame:
    """Union by name; ``source_rank`` keeps the order of the inputs."""
    ranked = [f.select(*columns, "row_ord", F.lit(i).alias("source_rank"))
              for i, f in enumerate(frames)]
    merged = ranked[0]
    for frame in ranked[1:]:
        merged = merged.unionByName(frame)
    return merged


def keep_first(df: DataFrame, *, key: str = "text", order: list[str]) -> DataFrame:
    """One row per key, the first in ``order``.

    Keys meet by their SHA-256, so sorting and comparing never touches a text. Copies are
    merged on the map side: a text making up a third of the rows sends one row per task.
    """
    first = F.min_by(F.struct(*df.columns), F.struct(*order)).alias("_row")
    return df.groupBy(text_key(F.col(key)).alias("_key")).agg(first).select("_row.*")


def text_key(text: Column) -> Column:
    """256 bits that stand for a text in groups and joins; null stays null."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def document_fingerprints(df: DataFrame, *, span: int = 4096) -> DataFrame:
    """128-bit fingerprint and length of each document's text, in sentence order.

    Equal when the sentences joined by spaces are equal, wherever the sentences were cut, and
    otherwise different up to a collision of 128 bits: every space-separated token is hashed
    with its position in the document.
    Positions come from running totals over spans of sentence numbers and the hashes
    combine by XOR, so no document is ever assembled in one place.
    """
    tokens = F.split("text", " ")
    placed = running_total(
        df.select("doc_id", "sent_id", "text"), keys=["doc_id"],
        bucket=F.floor(F.col("sent_id") / span), order=["sent_id"],
        value=F.size(tokens), out="_end",
    ).withColumn("_tokens", tokens).withColumn("_start", F.col("_end") - F.size("_tokens"))

    def mixed(seed: int) -> Column:
        hashes = F.transform(
            "_tokens", lambda t, i: F.xxhash64(F.lit(seed), t, F.col("_start") + i)
        )
        return F.aggregate(hashes, F.lit(0).cast("long"), lambda a, h: a.bitwiseXOR(h))

    return placed.select("doc_id", "_end", mixed(1).alias("_a"), mixed(2).alias("_b")).groupBy(
        "doc_id"
    ).agg(F.bit_xor("_a").alias("fp_a"), F.bit_xor("_b").alias("fp_b"),
          F.max("_end").alias("tokens"))


def duplicate_documents(fingerprints: DataFrame) -> DataFrame:
    """``doc_id`` of every document equal to one with a smaller id. The fingerprints, one narrow row a
    document, are stored, since both sides of the join read them."""
    fingerprints = cut_lineage(fingerprints)
    firsts = fingerprints.groupBy("fp_a", "fp_b", "tokens").agg(F.min("doc_id").alias("doc_id"))
    return fingerprints.join(firsts, "doc_id", "left_anti").select("doc_id")


def drop_duplicate_documents(df: DataFrame) -> DataFrame:
    return df.join(duplicate_documents(document_fingerprints(df)), "doc_id", "left_anti")


def conflicting_texts(df: DataFrame) -> DataFrame:
    """Texts seen with more than one label, with their row counts."""
    return (
        df.groupBy(text_key(F.col("text")).alias("_key"))
        .agg(F.min("label").alias("_lo"), F.max("label").alias("_hi"),
             F.count(F.lit(1)).alias("rows"), F.any_value("text").alias("text"))
        .where("_lo <> _hi").select("text", "rows")
    )


def drop_conflicting_texts(df: DataFrame) -> DataFrame:
    """Remove every row of a text seen with more than one label."""
    keyed = df.withColumn("_key", text_key(F.col("text")))
    bad = keyed.groupBy("_key").agg(F.min("label").alias("_lo"), F.max("label").alias("_hi")).where("_lo <> _hi")
    return keyed.join(bad.select("_key"), "_key", "left_anti").select(*df.columns)


def drop_sentence_overlap(df: DataFrame) -> DataFrame:
    """Conflicting texts removed and one row kept per remaining text, in one shuffle."""
    grouped = df.groupBy(text_key(F.col("text")).alias("_key")).agg(
        F.min_by(F.struct(*df.columns), F.struct("doc_id", "sent_id")).alias("_row"),
        F.min("label").alias("_lo"), F.max("label").alias("_hi"),
    )
    return grouped.where("_lo = _hi").select("_row.*")


def dedup_audit(df: DataFrame) -> DataFrame:
    """One row of before/after counts for the two de-duplication steps.

    The sentences are stored once, then only their keys are: all counts come from narrow tables.
    """
    df = cut_lineage(df.select("doc_id", "sent_id", "label", "text"))
    prints = cut_lineage(document_fingerprints(df))
    keyed = df.select("doc_id", "sent_id", "label", text_key(F.col("text")).alias("_key"))
    surviving = keyed.join(duplicate_documents(prints), "doc_id", "left_anti")
    texts = surviving.groupBy("_key").agg(
        F.count(F.lit(1)).alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi"),
        F.min(F.struct("doc_id", "sent_id")).alias("first"),
    )
    texts = cut_lineage(texts)
    same = F.col("lo") == F.col("hi")
    by_text = texts.agg(F.struct(
        F.coalesce(F.sum(F.when(~same, F.col("n"))), F.lit(0)).alias("conflicts"),
        F.coalesce(F.sum(F.when(same, F.col("n") - 1)), F.lit(0)).alias("repeats"),
        F.count_if(same).alias("rows"),
    )).scalar()
    kept_documents = texts.where(same).groupBy("first.doc_id").agg(F.lit(1)).agg(
        F.count(F.lit(1))).scalar()
    groups = prints.groupBy("fp_a", "fp_b", "tokens").agg(F.count(F.lit(1)).alias("n"))
    by_document = groups.agg(F.struct(
        F.coalesce(F.sum("n"), F.lit(0)).alias("documents"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeats"),
    )).scalar()
    return df.agg(F.count(F.lit(1)).alias("original_rows")).select(
        "original_rows",
        by_document["documents"].alias("original_documents"),
        by_document["repeats"].alias("duplicate_documents_removed"),
        by_text["conflicts"].alias("conflicting_sentence_rows_removed"),
        by_text["repeats"].alias("duplicate_sentence_rows_removed"),
        by_text["rows"].alias("final_rows"),
        kept_documents.alias("final_documents"),
    )
