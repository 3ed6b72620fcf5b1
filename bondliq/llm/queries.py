"""The registered queries of the training-data operators and the pipeline."""

from __future__ import annotations

import public_tokenizers

from bondliq.llm import bpe, codes, jaccard, langid, lm, mih, mixing, neardup, packing, pii, quality, spelling, token_files
from bondliq.llm.common import table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_bpe(spark, sf):
    return bpe.round_trip_digests(table(spark, sf, "documents"), BYTE_BPE)


def op2_token_files(spark, sf):
    return token_files.written_and_read(table(spark, sf, "documents"), BYTE_BPE, end_id=2)


def op3_quality(spark, sf):
    return quality.score(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op4_neardup(spark, sf):
    return neardup.near_duplicates(table(spark, sf, "embeddings"))


def op5_pii(spark, sf):
    return pii.report(table(spark, sf, "documents"))


def op6_langid(spark, sf):
    return langid.predict(table(spark, sf, "documents"))


def op7_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"), WORD_BPE, end_id=1, tokens=4096)


def op8_jaccard(spark, sf):
    return jaccard.join(table(spark, sf, "documents"), threshold=(85, 100), width=4)


def op9_mih(spark, sf):
    rows = table(spark, sf, "embeddings")
    return mih.search(rows, rows.where("vec_id % 100 = 0"), k=10)


def op10_lm(spark, sf):
    return lm.score(table(spark, sf, "documents"), min_count=lm.EVERY)


def op11_spelling(spark, sf):
    return spelling.variants(table(spark, sf, "documents"))


def op12_mixing(spark, sf):
    return mixing.mix(table(spark, sf, "documents"))


def op13_codes(spark, sf):
    return codes.vector_codes(table(spark, sf, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_bpe, op2_token_files, op3_quality, op4_neardup, op5_pii, op6_langid, op7_packing, op8_jaccard, op9_mih, op10_lm,
                                  op11_spelling, op12_mixing, op13_codes)}
#: DuckDB SQL where SQL can express the query
ORACLE = {"op11_spelling": spelling.oracle(), "op12_mixing": mixing.oracle(), "op13_codes": codes.oracle()}
