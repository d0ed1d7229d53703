"""The package's registered queries, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from emberlink.llm import bpe, dart_minhash, dialogue, html_text, langid, packing, rabitq, secrets, spelling, suffix_dedup, topk, urls, warc
from emberlink.llm.common import use_utc


def _in_utc(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(use_utc(spark), sf_dir)

    run.__doc__ = query.__doc__
    return run


QUERIES = {
    q.__name__: _in_utc(q)
    for q in (
        langid.op1_language, bpe.op2_bpe_round_trip, packing.op3_pack, secrets.op4_secrets, html_text.op5_main_text, urls.op6_url_verdicts, dart_minhash.op7_near_duplicates,
        suffix_dedup.op8_suffix_dedup, rabitq.op9_rabitq_search, topk.op10_exact_topk, spelling.op11_spelling_variants, warc.op12_warc_round_trip,
        dialogue.op13_conversation_repair,
    )
}
ORACLES = {
    "op6_url_verdicts": urls.OP6_SQL,
    "op7_near_duplicates": dart_minhash.OP7_SQL,
    "op8_suffix_dedup": suffix_dedup.OP8_SQL,
    "op10_exact_topk": topk.OP10_SQL,
    "op11_spelling_variants": spelling.OP11_SQL,
    "op12_warc_round_trip": warc.OP12_SQL,
    "op13_conversation_repair": dialogue.OP13_SQL,
}
