"""All queries of this subpackage."""

from . import (  # noqa: F401
    alignment, decontaminate, host_rules, jaccard_join, language, licenses, line_dedup, mixing, quotes,
    spelling, suffix_dedup, url_filter, warc,
)
from .common import ORACLES, QUERIES  # noqa: F401
