"""Line quality, packing, chunked BPE, shards and id volumes against brute force, on odd rows and on a small table."""

import base64
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tallyforge.llm import line_quality as lq
from tallyforge.llm.chunk_bpe import Chunking, chunk_bpe
from tallyforge.llm.dictionary_ids import Format, dictionary_ids, read_ids
from tallyforge.llm.feistel_shards import Shuffle, feistel_shards
from tallyforge.llm.tier_packing import Packing, tier_packing
from tallyforge.llm.unit_encoder import UnitEncoder, blocks, units
from tallyforge.session import work_folder

ODD = [
    (1, "One two three. One two three. One two three."),
    (1, "One two three. One two three. One two three."),
    (2, None),
    (3, ""),
    (4, " \n\t \n"),
    (5, "don't  stop...\r\nat   3.14, né?! \x00 日本語 'll " * 40),
    (None, "no id"),
    (6, "x" * 5000),
    (7, "word, word. " * 3000),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, 9, "x") for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id bigint, text string, n_words int, slot string").repartition(3)


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: made.encode(text or "", add_special_tokens=False).ids


def raw(ids):
    return np.array(ids, "<u4").tobytes()


def measured(text):
    """The base measures by the plainest means."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_line_quality(odd):
    got = sorted((tuple(r)[:6] for r in lq.line_quality(odd).collect()), key=repr)
    assert got == sorted(((i, *measured(t)) for i, t in ODD), key=repr)
    assert lq.line_quality(odd.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("line", "rule"),
    [
        ("A plain sentence ends here.", None),
        ("no end in sight", "punctuation"),
        ("THE!! END!! IS!! NEAR!!", "marks"),
        ("Home | About | News | Shop.", "navigation"),
        ("All rights reserved.", "boilerplate"),
    ],
)
def test_line_rules(line, rule):
    assert lq.line_fails(line) == rule


def test_document_that_loses_too_much():
    names = ["".join(chr(97 + (i * 7 + k * (i + 3)) % 26) for k in range(6)) for i in range(60)]
    good = "\n".join(f"The {a} found {b} beside {c} again." for a, b, c in zip(names[::3], names[1::3], names[2::3]))
    assert lq.measure(good)[6]
    assert not lq.measure(good + "\n" + "\n".join(f"menu{i} | item{i} | more{i} | home{i}" for i in range(60)))[6]


def test_units_encode_like_the_text(library):
    encoder = UnitEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [t or "" for _, t in ODD] + ["x <|endoftext|> y", "x  <|endoftext|>", ".<|endoftext|>,", "<|endoftext", "a.b,c", "..a", " .", "1.5.", "á.", "_.x"]
    assert encoder.encode(texts) == [raw(library(t)) for t in texts]
    assert all("".join(units(t)) == t and "".join(blocks(t, 100)) == t for t in texts)


def test_packing(odd, library):
    rows = tier_packing(odd, Packing(waiting=3), with_ids=True).collect()
    total = Counter()
    for r in rows:
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
        total[r.sequence_id] += r.length
    assert all(n == n & -n and n <= 1024 for n in total.values())
    by_sequence = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == by_sequence.get(r.sequence_id, 0)
        by_sequence[r.sequence_id] = r.offset + r.length
    pieces = Counter()
    for r in rows:
        pieces[r.doc_id] += r.length
    wanted = Counter()
    for i, t in ODD:
        wanted[i] += len(library(t)) + 1
    assert pieces == wanted
    texts = dict(ODD)
    for r in rows:
        assert bytes(r.ids) == raw([*library(texts[r.doc_id]), 0][r.start : r.start + r.length])
    assert tier_packing(odd.limit(0)).count() == 0


@pytest.mark.parametrize("how", [Chunking(), Chunking(50, 12), Chunking(400, 30)])
def test_chunked_bpe(odd, how):
    with open(public_tokenizers.path(how.ranks), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    whole = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def want(text):
        ids = whole.encode_ordinary(text or "")
        return len(ids), hashlib.sha256(raw(ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()

    assert sorted(map(tuple, chunk_bpe(odd, how).collect()), key=repr) == sorted(((i, *want(t)) for i, t in ODD), key=repr)
    assert chunk_bpe(odd.limit(0), how).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 50, 1000])
def test_shards(spark, n):
    frame = spark.range(n).selectExpr("id AS doc_id", "CASE WHEN id % 7 > 0 THEN repeat('é', CAST(id % 5 AS INT)) END AS text")
    rows = feistel_shards(frame, Shuffle(buckets=8)).collect()
    texts = {r.doc_id: r.text or "" for r in frame.collect()}
    assert len(rows) == n and len({(r.shard, r.slot) for r in rows}) == n
    per_shard = Counter(r.shard for r in rows)
    assert n < 16 or max(per_shard.values()) - min(per_shard.values()) <= 1
    assert all(0 <= r.slot < per_shard[r.shard] for r in rows)
    assert all((r.size, r.text_crc32) == (len(texts[r.doc_id].encode()) + 1, zlib.crc32(texts[r.doc_id].encode())) for r in rows)
    assert rows and {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}


def test_shards_of_odd_rows(odd):
    rows = feistel_shards(odd).collect()
    assert len(rows) == len(ODD) and len({(r.shard, r.slot) for r in rows}) == len(ODD)
    assert feistel_shards(odd.limit(0)).count() == 0


def test_id_volumes(spark, odd, library):
    path = work_folder(spark, "ids")
    rows = dictionary_ids(odd, path, Format(volume_bytes=300)).collect()
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_crc32) for r in rows) == sorted(
        (i or -1, len(library(t)) + 1, zlib.crc32(raw([*library(t), 2]))) for i, t in ODD
    )
    before = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == before
        before += r.n_tokens
    assert {r.doc_id: r.ids for r in read_ids(spark, path, [5, 7, 99]).collect()} == {i: [*library(t), 2] for i, t in ODD if i in (5, 7)}
    assert dictionary_ids(odd.limit(0), work_folder(spark, "ids")).count() == 0
