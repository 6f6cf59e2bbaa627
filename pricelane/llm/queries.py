"""The queries of this subpackage and their SQL, for the driver's entry module."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

#: query -> module that holds it
PLACES = {
    "op1_pii_crf": "pii_crf",
    "op2_toxicity_ordinal": "toxicity_ordinal",
    "op3_slot_sharding": "slot_sharding",
    "op4_bpe_reuse": "bpe_reuse",
    "op5_spaced_seeds": "spaced_seeds",
    "op6_chat_template": "chat_template",
    "op7_suffix_dedup": "suffix_dedup",
    "op8_repetition": "repetition",
    "op9_html_blocks": "html_blocks",
    "op10_minhash_oph": "minhash_oph",
    "op11_whitening": "whitening",
    "op12_treap_search": "treap_search",
    "op13_va_search": "va_search",
}

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Tasks get the operators with the job, wherever the session was started from.
for _place in ("_common", "_vectors"):
    cloudpickle.register_pickle_by_value(importlib.import_module(f"pricelane.llm.{_place}"))
for _name, _place in PLACES.items():
    _module = importlib.import_module(f"pricelane.llm.{_place}")
    cloudpickle.register_pickle_by_value(_module)
    QUERIES[_name] = getattr(_module, _name)
    if hasattr(_module, "ORACLE_SQL"):
        ORACLE[_name] = _module.ORACLE_SQL
