"""Registered queries of this package; ``oracle_sql`` has the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from popcenter.llm.decontamination import op10_suffix_arrays
from popcenter.llm.exact import op12_digest_index
from popcenter.llm.licenses import op2_licenses
from popcenter.llm.lines import op9_line_frequency
from popcenter.llm.mixing import op8_mix
from popcenter.llm.neardup import op4_near_duplicates
from popcenter.llm.oracles import oracle_sql
from popcenter.llm.periods import op13_periodic_runs
from popcenter.llm.quality import op7_quality
from popcenter.llm.secrets import op1_secrets
from popcenter.llm.sharding import op3_interleaved_shards
from popcenter.llm.spelling import op11_spelling
from popcenter.llm.substrings import op5_substrings
from popcenter.llm.urls import op6_url_filter


__all__ = ["oracle_sql", "queries"]


def queries():
    return {
        "op1_secrets": op1_secrets,
        "op2_licenses": op2_licenses,
        "op3_interleaved_shards": op3_interleaved_shards,
        "op4_near_duplicates": op4_near_duplicates,
        "op5_substrings": op5_substrings,
        "op6_url_filter": op6_url_filter,
        "op7_quality": op7_quality,
        "op8_mix": op8_mix,
        "op9_line_frequency": op9_line_frequency,
        "op10_suffix_arrays": op10_suffix_arrays,
        "op11_spelling": op11_spelling,
        "op12_digest_index": op12_digest_index,
        "op13_periodic_runs": op13_periodic_runs,
    }

