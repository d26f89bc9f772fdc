"""Operators by name, with options from a JSON file (unknown options ignored)."""

from __future__ import annotations

import inspect
import json
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame

from loglens.operators import bloom, running, sample, sliding, summary, windowed
from loglens.schema import BLOOM_BITS, BLOOM_HASHES
from loglens.sources.patterns import read_patterns


def _filter(df: DataFrame, filter_file: str, m_bits: int, k_hashes: int) -> DataFrame:
    return bloom.bloom_build(read_patterns(df.sparkSession, filter_file), m_bits=int(m_bits), k_hashes=int(k_hashes))


def bloom_forward(df: DataFrame, filter_file: str, m_bits: int = BLOOM_BITS,
                  k_hashes: int = BLOOM_HASHES) -> DataFrame:
    """Events whose message is in the pattern file's Bloom filter."""
    return bloom.bloom_forward(df, _filter(df, filter_file, m_bits, k_hashes), m_bits=int(m_bits), k_hashes=int(k_hashes))


def bloom_hit_ratio(df: DataFrame, filter_file: str, m_bits: int = BLOOM_BITS,
                    k_hashes: int = BLOOM_HASHES, batch: str = "batch_id") -> DataFrame:
    """Per batch the share of events that the pattern file's Bloom filter forwards."""
    return bloom.bloom_hit_ratio(df, _filter(df, filter_file, m_bits, k_hashes), batch,
                                 m_bits=int(m_bits), k_hashes=int(k_hashes))

OPERATORS: dict[str, Callable[..., DataFrame]] = {
    "running_success_rate": running.running_success_rate,
    "running_success_rate_target": running.running_success_rate_target,
    "running_time_span": running.running_time_span,
    "sliding_failures": sliding.sliding_failures,
    "sliding_failure_rate": sliding.sliding_failure_rate,
    "reservoir_sample": sample.reservoir_sample,
    "reservoir_sample_by_batch": sample.reservoir_sample_by_batch,
    "reservoir_mode": sample.reservoir_mode,
    "reservoir_mode_by_batch": sample.reservoir_mode_by_batch,
    "service_success_summary": summary.service_success_summary,
    "windowed_success_rate": windowed.windowed_success_rate,
    "hopping_success_rate": windowed.hopping_success_rate,
    "bloom_forward": bloom_forward,
    "bloom_hit_ratio": bloom_hit_ratio,
}

# option names of the shipped JSON configs -> operator keywords
ALIASES = {"reservoir_size": "k", "window_duration": "window_duration",
           "slide_duration": "slide_duration"}


def load_options(path: str | None) -> dict[str, Any]:
    """Options from a JSON object file; ``None`` gives no options."""
    if not path:
        return {}
    with open(path, encoding="utf-8") as f:
        opts = json.load(f)
    if not isinstance(opts, dict):
        raise ValueError(f"options file {path} must hold a JSON object")
    return opts


def run(name: str, df: DataFrame, **options: Any) -> DataFrame:
    """Apply the named operator; options it does not take are ignored."""
    try:
        fn = OPERATORS[name]
    except KeyError:
        raise ValueError(f"unknown operator {name!r}; known: {sorted(OPERATORS)}") from None
    params = inspect.signature(fn).parameters
    kw = {}
    for k, v in options.items():
        k = ALIASES.get(k, k)
        if k in params:
            kw[k] = v
    return fn(df, **kw)
