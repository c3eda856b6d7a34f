"""Chunks that must not change the ids, spans of long texts, a bounded dictionary sample, and ids that many rows share."""

import random
import time

import numpy as np
import pytest

from tallyforge.llm import chunk_bpe as cb
from tallyforge.llm import dictionary_ids as di
from tallyforge.llm import random_secrets as rs
from tallyforge.llm.unit_encoder import vocabulary
from tallyforge.session import work_folder

PIECES = ["a", "word", " ", "  ", "\n", "\n\n\t", "é", "日本", "1", "123", "'s", "'ll", "!", "...", "　", "\x85", "\x1c", "🙂", " the", "x" * 30]


@pytest.mark.parametrize("how", [cb.Chunking(small=8, margin=3), cb.Chunking(small=16, margin=12), cb.Chunking(small=5, margin=1), cb.Chunking(small=64, margin=32)])
def test_chunks_do_not_change_the_ids(how):
    path, toss = vocabulary("byte_bpe_multi_50k.tiktoken"), random.Random(3)
    whole, cut = cb.encoding(path)[0], 0
    for _ in range(2_000):
        text = "".join(toss.choice(PIECES) for _ in range(toss.randint(0, 60)))
        parts = cb.pieces(text, how)
        assert "".join(parts) == text
        ids, raw, n = cb.encode(text, path, how)
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode_ordinary(text) and raw == text.encode() and n == len(ids) // 4, repr(text)
        cut += len(parts) > 1
    assert cut > (300 if how.margin > 1 else 50)


def test_ordinary_texts_are_cut(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect() if r.text]
    parts = [len(cb.pieces(text, cb.Chunking())) for text in texts]
    assert sum(n > 1 for n in parts) > 0.1 * len(texts) and all(n >= len(t) // 8_192 for n, t in zip(parts, texts))


def test_large_chunks_over_tasks_do_not_change_the_ids(spark):
    path, toss = vocabulary("byte_bpe_multi_50k.tiktoken"), random.Random(4)
    rows = [(i, "".join(toss.choice(PIECES) for _ in range(400))) for i in range(40)] + [(99, "para.\n\nNext one's\n\n" * 200)]
    how = cb.Chunking(chunk=128, overlap=24, small=32, margin=12)
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in cb.chunk_bpe(spark.createDataFrame(rows, "doc_id int, text string"), how).collect()}
    import hashlib

    for doc_id, text in rows:
        ids = np.array(cb.encoding(path)[0].encode_ordinary(text), "<u4")
        assert got[doc_id] == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())


def test_candidates_outside_of_base_spans():
    """Sorted lists are merged; the plain form asks every span."""
    toss = random.Random(8)
    hexed = lambda n: "".join(toss.choice("0123456789abcdef") for _ in range(n))
    token = lambda n: "".join(toss.choice("ABCDEFabcdefGHIghi0123456789+/") for _ in range(n))
    for _ in range(200):
        text = toss.choice([" ", "", "."]).join(
            toss.choice([hexed(30), token(30), f"token={token(22)}", "AKIA" + token(20).upper().replace("/", "X").replace("+", "Y"), "words", "\n"]) for _ in range(30)
        )
        spans, candidates, _ = rs.scan(text)
        plain = [
            (m.start(), m.end())
            for m in rs.CANDIDATE.finditer(text)
            if not rs.is_word(m[0]) and len(m[0]) >= rs.LEAST and any(c.isdigit() for c in m[0]) and not any(s < m.end() and m.start() < e for s, _, e in spans)
        ]
        assert [c[:2] for c in candidates] == plain


def test_long_text_of_many_spans_takes_linear_time():
    text = " ".join(f"{i * 2654435761:032x} tok{i}En{i * 40503:x}Xy9{i}" for i in range(20_000))
    began = time.process_time()
    spans, _, _ = rs.scan(text)
    assert len(spans) == 20_000 and time.process_time() - began < 20


def test_dictionary_sample_is_bounded_by_its_parameter(spark):
    frame = spark.range(3_000).selectExpr("id AS doc_id", "repeat(concat('document number ', id, ' with words '), 50) AS text")
    copies = spark.range(20_000).selectExpr("CAST(7 AS BIGINT) AS doc_id", "'the same row ' AS text")
    few = di.Format(sample_docs=16, sample_bytes=100)
    for docs in (frame, frame.unionByName(copies), copies, frame.limit(0)):
        assert di.train(docs, few)


def test_rows_without_an_id_are_dealt_over_tasks(spark):
    rows = [(None, f"text of row {i}") for i in range(400)] + [(5, "a"), (5, "b"), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    path = work_folder(spark, "ids-without")
    got = di.dictionary_ids(docs, path).collect()
    assert len(got) == 403 and len({r.part for r in got}) > 1
    starts = sorted((r.start, r.n_tokens) for r in got)
    assert starts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))
    with_ids = sorted((r.start, r.doc_id) for r in got if r.doc_id)
    assert [d for _, d in with_ids] == [5, 5, 6] and with_ids[0][0] > max(r.start for r in got if r.doc_id is None)
