"""The trie of conversations, pieces with source spans, and draws towards a target, against plain restatements."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyforge.llm import euler_trie as et
from tallyforge.llm import piece_offsets as po
from tallyforge.llm import target_resampling as tr
from tallyforge.llm.common import table
from tallyforge.llm.queries import ORACLES, QUERIES
from tallyforge.llm.unit_encoder import vocabulary

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- op12 -----------------------------------------------------------------------------------------------------


def plain_trie(rows, group=20, most=3):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % (most + 1)
        whole = tuple(own.get(c - int(math.fmod(c, group)), [])[:h] + own[c][h:])
        ends[whole].append(c)
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
    children = Counter(k[:-1] for k in members if k)
    words = lambda k: len(WORD.findall(k[-1][1].decode())) if k else 0
    out = []
    for key, who in members.items():
        under = [k for k in members if k[: len(key)] == key]
        digest = hashlib.sha256(",".join(map(str, sorted(ends.get(key, [])))).encode()).hexdigest()
        saved = sum((len(members[k]) - 1) * words(k) for k in under)
        parent = min(members[key[:-1]]) if key else None
        out.append((min(who), len(key), parent, len(who), children[key], sum(k not in children for k in under), saved, digest))
    return sorted(out, key=repr)


def trie(spark, rows, how=et.Trie()):
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, depth string, c string")
    return sorted(map(tuple, et.euler_trie(frame, how).collect()), key=repr)


def made_conversations(n, seed):
    toss, rows = random.Random(seed), []
    for c in range(n):
        for turn in range(toss.choice([1, 2, 2, 3, 5, 9])):
            rows.append((c, turn, "user" if turn % 2 == 0 else "assistant", toss.choice(["hello there", "yes", "", "a b  c", None])))
    return rows


def wide(rows):
    return [(*r, "clash", "clash") for r in rows]


@pytest.mark.parametrize("how", [et.Trie(), et.Trie(span=2, walked=8)])
def test_trie_equals_plain_form(spark, how):
    rows = made_conversations(60, 3)
    rows += [(7, None, "system", "first of all"), (7, None, None, None), (None, 1, "user", "nobody's"), (rows[5][0], *rows[5][1:]), (-33, 0, "user", "below zero")]
    rows += [(200, turn, "user", f"turn {turn} " + "long " * (turn % 3)) for turn in range(40)] + [(20_000_000_000, 0, "user", "long " * 50_000)]
    assert trie(spark, wide(rows), how) == plain_trie(rows)


def test_trie_of_copies_of_one_conversation(spark):
    rows = [(c, t, "user", "same words here") for c in range(300) for t in range(4)]
    assert trie(spark, wide(rows), et.Trie(span=16, walked=4)) == plain_trie(rows)


def test_trie_with_one_beginning_and_many_ends(spark):
    rows = [(c, t, "user", f"end {c}" if t == 4 else "common start") for c in range(200) for t in range(5)]
    assert trie(spark, wide(rows), et.Trie(span=8, walked=16)) == plain_trie(rows)


def test_trie_of_nothing_and_of_one_turn(spark):
    assert trie(spark, []) == [] and trie(spark, wide([(None, 1, "user", "x")])) == []
    assert trie(spark, wide([(40, None, None, None)])) == plain_trie([(40, None, None, None)])


def test_contraction_keeps_the_sums(spark):
    n = 500
    rows = [(i, 0, 0, i + 1 if i + 1 < n else None, 0 if i + 1 < n else None, 0 if i + 1 < n else None, 1, i % 3, i) for i in range(n)]
    schema = "c bigint, d bigint, x int, nc bigint, nd bigint, nx int, n bigint, leaves bigint, saved bigint"
    got = et.ranked(spark.createDataFrame(rows, schema), et.Trie(walked=4)).collect()
    assert sorted(map(tuple, got)) == [(i, 0, 0, i, sum(j % 3 for j in range(i)), i * (i - 1) // 2) for i in range(n)]


# --- op11 -----------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))


def fuzzed(alphabet, n, longest, seed=5):
    toss = random.Random(seed)
    return ["".join(toss.choice(alphabet) for _ in range(toss.randint(0, longest))) for _ in range(n)]


def test_ids_spans_and_texts_equal_the_library(library):
    encoder = po.piece_encoder(vocabulary("piece_bpe_32k.model"))
    texts = [*fuzzed(" ▁a b\n\t\0éß日　🙂xyz<s>0123.,'", 2_000, 40), "", " ", "▁", "a ", "<s>x</s>", "  two  gaps ", "\n"]
    for text, (ids, starts, ends) in zip(texts, encoder.encode(texts)):
        assert ids.tolist() == library.encode(text, add_bos=True, add_eos=True), repr(text)
        assert encoder.decode(ids) == library.decode(ids.tolist())
        size = len(text.encode())
        assert (starts[0], ends[0], starts[-1], ends[-1]) == (0, 0, size, size)
        for piece, i, start, end in zip(library.encode_as_proto(text).pieces, ids[1:-1].tolist(), starts[1:-1], ends[1:-1]):
            assert library.is_byte(i) or (piece.begin, piece.end) == (start, end), repr(text)
        source, covered = text.encode(), b"".join(text.encode()[s:e] for s, e in zip(starts, ends))
        assert covered == source


def test_blocks_of_a_long_text_encode_as_the_whole(library, monkeypatch):
    text = ("some words, 12 numbers  and\n\nlines " * 300).strip() + "x" * 500
    normalised, _ = po.Normaliser(po.CharacterMap(b""))(text)
    cut = po.blocks(normalised, 64)
    assert "".join(cut) == normalised and len(cut) > 50 and all(b.startswith(po.MARK) for b in cut)
    monkeypatch.setattr(po, "BLOCK", 64)
    monkeypatch.setattr(po.blocks, "__defaults__", (64,))
    assert po.piece_encoder(vocabulary("piece_bpe_32k.model")).encode([text])[0][0].tolist() == library.encode(text, add_bos=True, add_eos=True)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nmt_nfkc_cf", "identity"])
def test_longest_prefix_normalisation_equals_the_library(rule):
    """The library's own compiled maps, with its offsets: one per character of the result, in characters of the source."""
    from sentencepiece import SentencePieceNormalizer, sentencepiece_model_pb2

    theirs = SentencePieceNormalizer(rule_name=rule)
    spec = sentencepiece_model_pb2.ModelProto.FromString(theirs.serialized_model_proto()).normalizer_spec
    ours = po.Normaliser(po.CharacterMap(spec.precompiled_charsmap), spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces)
    for text in fuzzed("  ﬁÅÅＡ①á 　 \n\tx日ｶﾞ㌀ß", 2_000, 12):
        expected, offsets = theirs.normalize(text, with_offsets=True)
        made, aligned = ours(text)
        assert made == expected, repr(text)
        places = np.cumsum([0, *[len(ch.encode()) for ch in made]])
        source = np.cumsum([0, *[len(ch.encode()) for ch in text]])
        assert aligned[places].tolist() == source[offsets].tolist(), repr(text)


def test_pieces_of_odd_rows(spark, library):
    rows = [(1, None), (2, ""), (None, "no id"), (4, "twice"), (4, "twice"), (5, "very long " * 60_000), (6, "🙂\0")]
    frame = spark.createDataFrame([(*r, b"clash", 7) for r in rows], "doc_id int, text string, ids binary, n_tokens int")
    got = [(r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), r.decoded) for r in po.piece_offsets(frame).collect()]
    ids = {text: library.encode(text or "", add_bos=True, add_eos=True) for _, text in rows}
    assert sorted(got, key=repr) == sorted([(i, ids[text], text or "") for i, text in rows], key=repr)
    assert po.piece_offsets(frame.limit(0)).count() == 0


def test_piece_query(spark, library):
    docs = table(spark, SMALL, "documents", "doc_id", "text").collect()
    expected = []
    for doc_id, text in docs:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        raw, decoded = np.array(ids, "<u4").tobytes(), library.decode(ids).encode()
        expected.append((doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded).hexdigest()))
    assert sorted(map(tuple, QUERIES["op11_piece_offsets"](spark, SMALL).collect())) == sorted(expected)


# --- op13 -----------------------------------------------------------------------------------------------------


def plain_draw(docs, target, how=tr.Resampling()):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        runs = [" ".join(words[i : i + k]) for k in range(1, how.longest + 1) for i in range(len(words) - k + 1)]
        return len(words), [zlib.crc32(r.encode()) % how.buckets for r in runs]

    found = [(i, *features(text)) for i, text in docs]
    s, t = Counter(b for _, _, f in found for b in f), Counter(b for text in target for b in features(text)[1])
    big_s, big_t = sum(s.values()) + how.buckets, sum(t.values()) + how.buckets
    rows = []
    for i, n, f in found:
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * big_s / ((s[b] + 1) * big_t))) for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{how.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in rows if r[1] >= how.least_words), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    for rank, row in enumerate(able[: how.percent * len(able) // 100]):
        row[5] = rank + 1
    return sorted(map(tuple, rows), key=repr)


def draw(spark, docs, target, how=tr.Resampling()):
    frame = spark.createDataFrame([(*d, "clash", 1) for d in docs], "doc_id bigint, text string, score string, rank int")
    got = tr.target_resampling(frame, spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int"), how)
    return sorted(map(tuple, got.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=repr)


def test_scan_emits_every_run_of_words():
    scans = tr.patterns(3)
    line = tr.line_of("  One-two THREE,Äé 4\n")
    assert line == "one two three Äé 4".encode()
    spans = [[m[0].decode() for m in scan.finditer(line, overlapped=True)] for scan in scans]
    assert spans == [["one", "two", "three", "Äé", "4"], ["one two", "two three", "three Äé", "Äé 4"], ["one two three", "two three Äé", "three Äé 4"]]
    assert [len(f) for f in tr.buckets_of(" .,\n", scans, 10)] == [0, 0, 0]


@pytest.mark.parametrize("how", [tr.Resampling(), tr.Resampling(longest=3, buckets=50, least_words=2, percent=60, seed=11)])
def test_draws_equal_plain_form(spark, how):
    toss = random.Random(2)
    text = lambda: " ".join(toss.choice(["alpha", "Beta", "gamma-9", "δ", "..", "x"]) for _ in range(toss.randint(0, 60)))
    docs = [(i, text()) for i in range(200)] + [(300, None), (301, ""), (None, text() + " x" * 30), (5, text()), (302, "Zeta word " * 40_000)]
    docs += [(400 + i, "the same document in many copies " * 4) for i in range(100)] + [(77, "repeated row " * 20)] * 3
    target = [text() for _ in range(20)] + [None, "", "alpha alpha beta"]
    assert draw(spark, docs, target, how) == plain_draw(docs, target, how)


def test_draws_of_empty_tables(spark):
    assert draw(spark, [], ["a b"]) == []
    docs = [(i, "word " * 30) for i in range(8)]
    assert draw(spark, docs, []) == plain_draw(docs, [])


@pytest.mark.parametrize("name", ["op12_euler_trie", "op13_target_resampling"])
def test_queries_equal_their_sql(spark, name):
    from compare import connect, normal

    answer = connect("/root/testdata/sf0.01").execute(ORACLES[name])
    columns, rows = [c[0] for c in answer.description], answer.fetchall()
    got = QUERIES[name](spark, "/root/testdata/sf0.01")
    assert normal(got.columns, [tuple(r) for r in got.collect()]) == normal(columns, rows)
