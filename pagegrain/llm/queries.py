"""The queries of this package, and their SQL where SQL can express them."""

from pyspark.sql import DataFrame, SparkSession

from pagegrain.llm import language, maxscore, near_dedup, packing, passages, pii, piece_codec, prefix_trie, quality_rules, sharding, token_orc, turn_repair, warc



def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # it imports this package

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_pii": pii.op1_pii,
    "op2_bbit_minhash": near_dedup.op2_bbit_minhash,
    "op3_token_orc": token_orc.op3_token_orc,
    "op4_ring_shards": sharding.op4_ring_shards,
    "op5_pack_nnls": packing.op5_pack_nnls,
    "op6_maxscore": maxscore.op6_maxscore,
    "op7_warc": warc.op7_warc,
    "op8_decision_list": quality_rules.op8_decision_list,
    "op9_piece_codec": piece_codec.op9_piece_codec,
    "op10_language": language.op10_language,
    "op11_fm_passages": passages.op11_fm_passages,
    "op12_turn_repair": turn_repair.op12_turn_repair,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
    "pipeline": pipeline,
}

ORACLES: dict[str, str] = {
    "op2_bbit_minhash": near_dedup.ORACLE_SQL,
    "op6_maxscore": maxscore.ORACLE_SQL,
    "op7_warc": warc.ORACLE_SQL,
    "op11_fm_passages": passages.ORACLE_SQL,
    "op12_turn_repair": turn_repair.ORACLE_SQL,
    "op13_prefix_trie": prefix_trie.ORACLE_SQL,
}
