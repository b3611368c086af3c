"""Registered queries over the driver tables, each with its SQL twin where SQL has one."""

from . import cluster, corpus, evaluate, explore, features, jobs, quality, robustness, stream, text, train
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "cluster", "corpus", "evaluate", "explore", "features", "jobs",
           "quality", "robustness", "stream", "text", "train"]
