"""Imports every query module of the subpackage."""

from driftwell.llm import (  # noqa: F401
    q_bagminhash,
    q_bpe,
    q_bwt,
    q_divergence,
    q_fingerprints,
    q_licenses,
    q_mixing,
    q_neighbours,
    q_pieces,
    q_recompression,
    q_seeds,
    q_sharding,
    q_spectra,
)
from driftwell.llm.catalog import LLM_QUERIES

__all__ = ["LLM_QUERIES"]
