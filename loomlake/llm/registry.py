"""Names of the subpackage's queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomlake.llm import ann, bpe, hilbert, langid, language_model, minhash, mixing, simhash, token_counts, url_filter


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_token_counts": token_counts.op1_token_counts,
    "op2_langid": langid.op2_langid,
    "op3_hilbert": hilbert.op3_hilbert,
    "op4_simhash": simhash.op4_simhash,
    "op5_mixing": mixing.op5_mixing,
    "op6_minhash": minhash.op6_minhash,
    "op7_language_model": language_model.op7_language_model,
    "op8_ann": ann.op8_ann,
    "op9_byte_bpe": bpe.op9_byte_bpe,
    "op10_url_filter": url_filter.op10_url_filter,
    "pipeline": pipeline,
}
ORACLE_SQL = {
    "op8_ann": ann.ORACLE,
    "op10_url_filter": url_filter.ORACLE,
}
