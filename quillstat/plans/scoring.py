"""Batch scoring with admission: the twin of the online service."""

from pyspark.sql import DataFrame

from ..operators import quality
from ..operators.scoring import Scorer, two_level_scores


def score_batch(df: DataFrame, *, sentence_scorer: Scorer, document_scorer: Scorer,
                id_col: str = "doc_id", **limits) -> tuple[DataFrame, DataFrame]:
    """Accepted texts with nested verdicts, and quarantined texts with their codes."""
    return score_checked(quality.admit(df, **limits), sentence_scorer=sentence_scorer,
                         document_scorer=document_scorer, id_col=id_col)


def score_checked(checked: DataFrame, *, sentence_scorer: Scorer, document_scorer: Scorer,
                  id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """The same for rows that already have their admission code."""
    scored = two_level_scores(
        quality.accepted(checked), sentence_scorer=sentence_scorer,
        document_scorer=document_scorer, id_col=id_col)
    return scored, quality.quarantined(checked)
