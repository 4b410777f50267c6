"""Texts that hold a tokenizer's added tokens."""

import zlib

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from txrisk.llm import packing, queries

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "hello <|endoftext|> x", "a<|startoftext|>b", "<|endoftext|><|endoftext|>",
    "Upper <|ENDOFTEXT|> Case", "plain words, no marks", "<|endoftext", "",
]


def test_registered_query_gives_the_ids_of_the_library(spark, documents, tmp_path):
    documents(list(enumerate(TEXTS))).write.parquet(str(tmp_path / "documents.parquet"))
    tokenizer = Tokenizer.from_file(TOKENIZER)
    found = {r.doc_id: r for r in queries.op8_packing(spark, str(tmp_path)).collect()}
    for doc_id, text in enumerate(TEXTS):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, packing.END_ID]
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (found[doc_id].doc_tokens, found[doc_id].ids_crc32) == (len(ids), zlib.crc32(raw))


def test_pipeline_stage_gives_them_too(spark, documents):
    import corpus_pipeline

    packed = dict(corpus_pipeline.STAGES)["packing"](spark, documents([(1, TEXTS[0])]), "")
    assert packed.agg(F.sum("doc_tokens")).first()[0] == 4
