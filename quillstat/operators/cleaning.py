"""Text cleaning over a corpus table, its filters and its audit."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import chars, text as tx


def clean_corpus(df: DataFrame, *, text_col: str = "text") -> DataFrame:
    """Run the cleaning chain over one column; filters on the result do not run it again."""
    return df.withColumn(text_col, tx.computed_once(tx.clean_chain(F.col(text_col))))


def clean_stages(df: DataFrame, *, text_col: str = "text") -> DataFrame:
    """The text after each cleaning stage, for audits: ``stage_clean`` .. ``stage_final``."""
    return (
        df.withColumn("stage_clean", tx.clean_text(F.col(text_col)))
        .withColumn("stage_url", tx.replace_urls(F.col("stage_clean")))
        .withColumn("stage_blob", tx.strip_blobs(F.col("stage_url")))
        .withColumn("stage_stutter", tx.strip_stutter(F.col("stage_blob")))
        .withColumn("stage_final", tx.strip_dash_runs(F.col("stage_stutter")))
    )


def cleaning_audit(df: DataFrame, *, text_col: str = "text") -> DataFrame:
    """One row: rows seen, missing, changed by each stage, and left as valid entries."""
    before = [text_col, "stage_clean", "stage_url", "stage_blob", "stage_stutter"]
    after = ["stage_clean", "stage_url", "stage_blob", "stage_stutter", "stage_final"]
    names = ["clean", "url", "blob", "stutter", "dash"]
    present = F.col(text_col).isNotNull()
    blank = F.length("stage_final") == 0
    invalid = tx.invalid_entry(F.col("stage_final"))
    changed = [
        F.count_if(F.col(a) != F.col(b)).alias(f"rows_{n}_changed")
        for n, a, b in zip(names, before, after)
    ]
    return clean_stages(df, text_col=text_col).agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(~present | blank).alias("rows_missing"),
        *changed,
        F.count_if(present & ~blank & invalid).alias("rows_invalid"),
        F.count_if(present & ~blank & ~invalid).alias("rows_valid"),
    )


def missing_flag(text_col: str = "text", label_col: str = "label"):
    """True where text or label is null, or the text is blank."""
    text = F.col(text_col)
    return text.isNull() | F.col(label_col).isNull() | ~text.rlike(chars.NOT_WS)


def drop_missing(df: DataFrame, *, text_col: str = "text", label_col: str = "label") -> DataFrame:
    return df.where(~missing_flag(text_col, label_col))


def drop_invalid(df: DataFrame, *, text_col: str = "text") -> DataFrame:
    """Remove entries that are too short or dominated by non-letters."""
    return df.where(~tx.invalid_entry(F.col(text_col)))


def normalise_for_scoring(df: DataFrame, *, text_col: str = "text") -> DataFrame:
    """Add the tamper-folded text and whether folding changed anything."""
    return (
        df.withColumn("normalised", tx.security_normalise(F.col(text_col)))
        .withColumn("normalisation_applied", F.col("normalised") != tx.strip(F.col(text_col)))
    )


def standardise_text(df: DataFrame, *, text_col: str = "text") -> DataFrame:
    """Null becomes the empty string, other types become strings, ends are stripped."""
    return df.withColumn(
        text_col, tx.strip(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    )
