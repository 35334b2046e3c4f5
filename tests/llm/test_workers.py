"""What workers hold: one encoder for all their tasks, and short batches while stages of Python rows are written."""

import gc
import weakref
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import public_tokenizers
import pytest

import corpus_pipeline
from tablebridge import session
from tablebridge.llm import bpe, token_files

DOCS = [(1, "some words"), (2, "more words"), (3, None)]


def test_a_worker_builds_its_word_encoder_once(monkeypatch):
    built = []

    class Counted(bpe.WordBpe):
        def __init__(self, file):
            built.append(1)
            super().__init__(file)

    monkeypatch.setattr(bpe, "WordBpe", Counted)
    context = SimpleNamespace(broadcast=lambda value: SimpleNamespace(value=value))
    task = bpe._per_batch(SimpleNamespace(sparkContext=context), bpe.read_tokenizer(public_tokenizers.path("word_bpe_49k.json")),
                          lambda encoder, texts: {"n": pa.array([len(encoder.encode(t or "")) for t in texts.to_pylist()])})
    batch = pa.RecordBatch.from_pydict({"doc_id": [d for d, _ in DOCS], "text": [t for _, t in DOCS]})
    first, second = ([b.to_pydict() for b in task(iter([batch]))] for _ in range(2))
    assert first == second and len(built) == 1


def test_a_passing_encoder_goes_with_its_task():
    held = []
    context = SimpleNamespace(broadcast=lambda value: SimpleNamespace(value=value))

    def ids(encoder, texts):
        held.append(weakref.ref(encoder))
        return {"n": pa.array([len(encoder.encode(t or "")) for t in texts.to_pylist()])}

    file = bpe.read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    batch = pa.RecordBatch.from_pydict({"doc_id": [d for d, _ in DOCS], "text": [t for _, t in DOCS]})
    rows = [[b.to_pydict() for b in bpe._per_batch(SimpleNamespace(sparkContext=context), file, ids, lasting)(iter([batch]))] for lasting in (True, False)]
    gc.collect()
    assert rows[0] == rows[1] and held[1]() is None


@pytest.mark.parametrize("name", ["secret scans", "BPE encoding and decoding"])
def test_staged_rows_of_the_pipeline_are_small(spark, sf, name, monkeypatch, tmp_path):
    """What a stage leaves on the shared disk takes less than Spark's default codec would."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    monkeypatch.setattr(session, "staging_path", lambda spark, label: f"{tmp_path}/{label}")
    staged = dict(corpus_pipeline.STAGES)[name](spark, docs, sf)
    left = [pq.ParquetFile(f).metadata for f in tmp_path.glob(("secret-scans" if name[0] == "s" else "tokens") + "/*.parquet")]
    assert sum(f.num_rows for f in left) == staged.count() == docs.count()
    assert {f.row_group(0).column(c).compression for f in left if f.num_rows for c in range(f.num_columns)} == {"ZSTD"}


def test_plain_pieces_are_the_files_own():
    encoder = bpe.WordBpe(bpe.read_tokenizer(public_tokenizers.path("word_bpe_49k.json")))
    text = "".join(c for c in map(chr, range(0x10000)) if bpe.PLAIN.fullmatch(c))
    for part in (text, " ".join(text), "it's 'TIS 12 \u0130x \u023a\u023e"):
        assert encoder.plain_pieces.findall(part.lower()) == encoder.pieces.findall(part.lower())


def test_new_pieces_keep_the_order_of_the_known():
    encoder = token_files.ByteBpe(bpe.read_tokenizer(public_tokenizers.path("byte_bpe_50k.json")))
    for text in ("one two three", "four five one", "three six"):
        token_files_of(encoder, text)
        assert (encoder.known[1:] > encoder.known[:-1]).all()
    assert token_files_of(encoder, "six four two one") == encoder.library.encode("six four two one", add_special_tokens=False).ids


def token_files_of(encoder, text):
    return encoder.encode(np.frombuffer(text.encode(), dtype=np.uint8), np.array([0, len(text)]))[0].tolist()


@pytest.mark.parametrize("step", [corpus_pipeline.without_secrets, corpus_pipeline.tokens])
def test_python_stages_are_written_in_short_batches(spark, step):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    rows = step(spark, docs, "")
    assert "MapInArrow" not in rows._jdf.queryExecution().toString() and rows.count() == len(DOCS)
