"""The pipeline's last stage against the tokenizer on whole texts."""

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from tenderlens.llm import tokens


def test_rows_carry_their_ids(spark, documents):
    docs = documents.limit(40)
    tokenizer = Tokenizer.from_file(tokens.vocabulary())
    ids = {}
    for r in corpus_pipeline.pack_sequences(spark, docs, "").orderBy("doc_id", "piece").collect():
        own = np.frombuffer(r.ids, "<u4").tolist()
        assert len(own) == r.length
        ids[r.doc_id] = ids.get(r.doc_id, []) + own
    assert ids == {r.doc_id: tokenizer.encode(r.text, add_special_tokens=False).ids + [1] for r in docs.collect()}
