"""Registered queries on the smallest tables: columns, rows and, where SQL expresses them, values."""

import pytest

import corpus_pipeline
from areaflow.llm.queries import CHECK_SQL, QUERIES
from tests.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_mixing": ("documents", {"doc_id", "mix_copies"}),
    "op2_simhash": ("documents", {"doc_id", "fingerprint", "component_id"}),
    "op3_language": ("documents", {"doc_id", "held_out", "lang_pred", "score"}),
    "op4_html": ("pages", {"page_id", "visible_text"}),
    "op5_packing": (None, {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}),
    "op6_warc": ("pages", {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"}),
    "op7_quality": ("documents", {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"}),
    "op8_hmm": ("documents", {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"}),
    "op9_vectors": ("embeddings", {"vec_id", "n_links", "component_id", "kept"}),
    "op10_toxicity": ("documents", {"doc_id", "held_out", "score", "predicted"}),
    "op11_spelling": (None, {"word", "form", "root", "n", "n_near", "form_n"}),
    "op12_decontaminate": ("documents", {"doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"}),
    "op13_whitening": (None, {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"}),
}


@pytest.mark.parametrize("name", COLUMNS)
def test_query(spark, name):
    given, columns = COLUMNS[name]
    result = QUERIES[name](spark, SF_DIR)
    assert columns <= set(result.columns)
    rows = result.toPandas()
    if name in CHECK_SQL:
        assert difference(rows, connect(SF_DIR).execute(CHECK_SQL[name]).df()) is None
    if given and name != "op1_mixing":
        assert len(rows) == spark.read.parquet(f"{SF_DIR}/{given}.parquet").count()


def test_pipeline(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "toxicity", "simhash_dedup", "mixing", "packing"]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:2]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns
    pieces = corpus_pipeline.run(spark, SF_DIR).toPandas()
    assert pieces["length"].between(1, 2048).all() and len(pieces) > 100
    assert (pieces.groupby("sequence_id")["length"].sum() == pieces.groupby("sequence_id")["sequence_tokens"].first()).all()
