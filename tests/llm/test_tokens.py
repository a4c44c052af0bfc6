"""Encoders against the public libraries, shards against a round trip."""

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewatch.llm import bpe, pretoken, repair
from tidewatch.llm.queries import RANKS, TOKENIZER, pattern, vocabulary

ODD = ["", None, "it's we'll 'S 's x''s 're", "  two  blanks \n\n\tand more 　", "12 3a4 ²٠", "a<|endoftext|>b", "\U0001f600\U0001f468‍\U0001f469 fin", "'", "''ll'd", "x" * 3000, " " * 500, "é üß 中文 عر"]


@pytest.fixture(scope="module")
def odd(spark, texts):
    rows = [*texts, *((1000 + i, t) for i, t in enumerate(ODD))]
    return spark.createDataFrame(rows, "doc_id bigint, text string"), rows


@pytest.fixture(scope="module")
def tik():
    import tiktoken

    return tiktoken.Encoding("t", pat_str=pattern(), mergeable_ranks=bpe.read_ranks(vocabulary(RANKS)), special_tokens={})


def test_digests_equal_the_library(odd, tik):
    frame, rows = odd
    got = {r.doc_id: r for r in bpe.digests(frame, vocabulary(RANKS), pattern(), with_ids=True).collect()}
    assert len(got) == len(rows)
    for doc, text in rows:
        ids = tik.encode_ordinary(text or "")
        assert got[doc].ids == ids and got[doc].n_tokens == len(ids)
        assert got[doc].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[doc].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_encode_and_decode_keep_other_columns(spark):
    frame = spark.createDataFrame([(1, "a b", "old", 2.5)], "doc_id bigint, text string, ids string, x double")
    coded = bpe.encode(frame, vocabulary(RANKS), pattern())
    row = bpe.decode(coded, vocabulary(RANKS)).first()
    assert bytes(row.bytes) == b"a b" and row.x == 2.5


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab'sStrevmld 1\n\t 　é中٠²!?_") | st.characters(exclude_categories=["Cs"]), max_size=25), max_size=4))
def test_slices_equal_the_pattern(parts):
    import regex

    raw = [p.encode() for p in parts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(r) for r in raw])).astype(np.int64)
    starts, first = pretoken.slices(data, offsets)
    got = [data[a:b].tobytes().decode() for a, b in zip(starts[:-1], starts[1:])]
    assert got == [m for p in parts for m in regex.findall(pattern(), p)]
    assert first[-1] == len(got)


def test_shards_equal_the_library(spark, odd, tmp_path):
    from tokenizers import Tokenizer

    frame, rows = odd
    path = str(tmp_path / "shards")
    repair.write_shards(frame, path, vocabulary(TOKENIZER), shard_ids=2000)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in repair.read_shards(spark, path).collect()}
    library, start = Tokenizer.from_file(vocabulary(TOKENIZER)), 0
    for doc, text in sorted(rows):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        assert got[doc] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_long_slices_of_equal_sums():
    """Thue-Morse words and their complements have equal sums of powers modulo 2**64, but other ids."""
    word = "a"
    while len(word) < 2048:
        word += word.translate(str.maketrans("ab", "ba"))
    words = [word, word.translate(str.maketrans("ab", "ba"))]
    cache, library = repair.library_cache(vocabulary(TOKENIZER))
    data, offsets = np.frombuffer("".join(words).encode(), np.uint8), np.array([0, 2048, 4096])
    got = [ids.tolist() for ids in repair.encode_batch(cache, library, [], data, offsets)]
    assert got == [library.encode(w, add_special_tokens=False).ids for w in words]


def test_joined_slices_equal_the_library_one_by_one():
    words = [" a", "\n", "'s", "'", " '", "''", " ", "\u00a0", "\n\n", " \u00fcber", "\u4e2d\u6587", " 12", "\u0663", "!?", "\x1c", "\u0085", " \x1c!", "x" * 700, "\u3000"]
    cache, library = repair.library_cache(vocabulary(TOKENIZER))
    ids, first, counts = cache.merge([w.encode() for w in words])
    for word, a, n in zip(words, first.tolist(), counts.tolist()):
        assert ids[a : a + n].tolist() == library.encode(word, add_special_tokens=False).ids
    calls = cache.merge([w.encode() for w in words * 100])
    assert [calls[0][a : a + n].tolist() for a, n in zip(*calls[1:])] == [ids[a : a + n].tolist() for a, n in zip(first, counts)] * 100


def test_cache_finds_slices_that_probe_on_and_begins_anew(monkeypatch):
    """All hashes fall into one home slot and its neighbours; the table grows and is cleared."""
    plain = bpe.textscan.word_hashes
    monkeypatch.setattr(bpe.textscan, "word_hashes", lambda *x: plain(*x) % np.uint64(1 << 20))
    cache = bpe.WordCache(lambda words: bpe.flattened([[int(w), *w] for w in words]), limit=700)
    for begin in (0, 100, 0, 600, 550, 0):
        words = [str(k % (begin + 300)).zfill(4).encode() for k in range(begin, begin + 400)]
        starts = np.append(0, np.cumsum([len(w) for w in words]))
        ids, counts = cache.encode(np.frombuffer(b"".join(words), np.uint8), starts)
        assert ids.tolist() == [x for w in words for x in (int(w), *w)] and counts.tolist() == [5] * len(words)


def test_null_ids_come_first(spark, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary(TOKENIZER))
    rows = [(5, "five words of plain text"), (None, "no id"), (-3, None), (None, None), (0, "zero"), (None, "no id either, and longer")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    path = str(tmp_path / "nulls")
    for shard_ids in (4, 2000):
        repair.write_shards(frame, path, vocabulary(TOKENIZER), shard_ids=shard_ids)
        got = sorted(map(tuple, repair.read_shards(spark, path).collect()), key=lambda r: r[1])
        assert [r[0] for r in got] == [None] * 3 + [-3, 0, 5]
        assert [r[1] for r in got] == [sum(n for _, _, n, _ in got[:i]) for i in range(6)]
        coded = [(d, [*library.encode(t or "", add_special_tokens=False).ids, 0]) for d, t in rows]
        want = sorted((str(d), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for d, ids in coded)
        assert sorted((str(d), n, crc) for d, _, n, crc in got) == want


def test_random_access(spark, odd, tmp_path):
    frame, _ = odd
    path = str(tmp_path / "shards")
    repair.write_shards(frame, path, vocabulary(TOKENIZER), shard_ids=5000)
    for shard in spark.read.parquet(path).collect():
        whole = repair.unpack(shard.asDict())
        for a, b in ((0, 1), (len(whole) // 3, len(whole) // 2), (len(whole) - 1, len(whole) + 5), (4, 4)):
            assert (repair.stretch(shard.asDict(), a, b) == whole[a:b]).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=400))
def test_grammar_round_trip(ids):
    symbols, rules, lengths = repair.compress(np.array(ids, np.int32), least=2)
    assert repair.expand(symbols, rules).tolist() == ids
    assert int(repair._lengths(symbols, lengths).sum()) == len(ids)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=1, max_size=200))
def test_many_symbols_of_few_rules(ids):
    symbols, rules, _ = repair.compress(np.array(ids, np.int32), least=2)
    assert repair.expand(np.tile(symbols, 1 + len(rules)), rules).tolist() == ids * (1 + len(rules))


def test_grammar_shrinks_repeats():
    ids = np.tile(np.arange(16), 500)
    assert len(repair.compress(ids)[0]) <= len(ids) / 8


def test_empty_tables(spark, nothing, tmp_path):
    assert bpe.digests(nothing, vocabulary(RANKS), pattern()).count() == 0
    repair.write_shards(nothing, str(tmp_path / "none"), vocabulary(TOKENIZER))
    assert repair.read_shards(spark, str(tmp_path / "none")).count() == 0
