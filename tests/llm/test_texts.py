"""Encoding, leaks and shared spans."""

import random

import numpy as np
import pytest
from harness import rows
from pyspark.sql import functions as F

from quarrylight.llm import bpe, hashing, queries, shared_spans
from quarrylight.llm.leaks import leaks

TEXTS = ["", " ", "Hello world's  end\n\n  x", "don't we'll 'quote' ''s", "日本語 text — émigré 👩‍🔬🚀", "a" * 3000, " " * 700 + "b", "\t\n" * 300, "<|endoftext|> is text", "0123456789" * 60, "=-" * 500 + "x", "ab " * 400, "  x​", "Ünïcödé" * 90, "\x00\x07 control"]


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.BPE(bpe.load_ranks(queries.VOCABULARY))


@pytest.fixture(scope="module")
def library():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=bpe.load_ranks(queries.VOCABULARY), special_tokens={})


def noise(rng, n):
    return "".join(rng.choice(["a", "e", "the", " ", "  ", "\n", "'s", "é", "日", "9", "-", "=", "😀", "ing", "'"]) for _ in range(n))


def test_encoding_against_the_library(vocabulary, library):
    rng = random.Random(1)
    for text in [*TEXTS, *[noise(rng, rng.randrange(400)) for _ in range(200)]]:
        assert vocabulary.encode(text).tolist() == library.encode_ordinary(text)


def test_fed_in_parts(vocabulary, library):
    rng = random.Random(2)
    for text in [*TEXTS, *[noise(rng, 300) for _ in range(100)]]:
        encoder, ids, at = bpe.StreamEncoder(vocabulary), [], 0
        while at < len(text):
            n = rng.choice([1, 2, 7, 1000])
            ids += encoder.feed(text[at : at + n])
            at += n
        assert ids + encoder.finish() == library.encode_ordinary(text)


def test_memory_is_bounded_by_the_lookahead(vocabulary, library):
    rng = random.Random(3)
    for piece in ("a" * 20_000, "".join(rng.choices("abcdefgh", k=20_000)), "".join(rng.choices("etaoins", k=20_000)), "=" * 20_000, "é" * 5000):
        run = bpe.Transducer(vocabulary)
        ids = run.feed(piece.encode()) + run.finish()
        assert ids == library.encode_ordinary(piece)
        assert run.behind <= vocabulary.lookahead


def test_all_bytes_go_through_the_transducer(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 0)
    monkeypatch.setattr(bpe, "SHORT", -1)
    own = bpe.BPE(vocabulary.ranks, vocabulary.parts)
    rng = random.Random(4)
    for text in [*TEXTS, *[noise(rng, 2000) for _ in range(10)]]:
        before = own.transduced
        assert own.encode(text, part=rng.choice([10, 100, 1000])).tolist() == library.encode_ordinary(text)
        assert own.transduced - before == len(text.encode())


def test_parts_are_what_merging_makes(vocabulary):
    def merged(token):
        left = [token[k : k + 1] for k in range(len(token))]
        while len(left) > 2:
            _, k = min((vocabulary.ranks.get(left[k] + left[k + 1], 1 << 60), k) for k in range(len(left) - 1))
            left[k : k + 2] = [left[k] + left[k + 1]]
        return tuple(vocabulary.ranks[x] for x in left)

    for rank in random.Random(5).sample(sorted(vocabulary.parts), 2000):
        assert vocabulary.parts[rank] == merged(vocabulary.tokens[rank])


def test_decoding_byte_by_byte(vocabulary):
    for text in TEXTS:
        decoder = bpe.StreamDecoder(vocabulary)
        assert "".join(decoder.feed([i]) for i in vocabulary.encode(text)) + decoder.finish() == text
    byte = vocabulary.ranks[b"\xe6"]
    decoder = bpe.StreamDecoder(vocabulary)
    assert decoder.feed([byte]) == "" and decoder.finish() == "�"


def test_encoded_and_decoded_tables(spark):
    texts = [*TEXTS, None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc long, text string").withColumn("ids", F.lit("clash"))
    ids = bpe.encoded(df, queries.VOCABULARY)
    assert {r["doc"]: r["ids"] for r in ids.collect()}[len(TEXTS)] == []
    back = dict(map(tuple, bpe.decoded(ids, queries.VOCABULARY).collect()))
    assert back == {k: t or "" for k, t in enumerate(texts)}
    assert bpe.encoded(df.limit(0), queries.VOCABULARY).count() == 0


def contained(docs, items, window=12):
    want = set()
    for item, text in items:
        words = hashing.words_of(text) if text else []
        n = min(window, len(words))
        runs = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if n else set()
        for doc, other in docs:
            own = hashing.words_of(other) if other else []
            if n and any(tuple(own[k : k + n]) in runs for k in range(len(own) - n + 1)):
                want.add((doc, item))
    return want


@pytest.mark.parametrize("broadcast", [10**6, 0])
def test_leaks_against_every_run(spark, broadcast):
    rng = random.Random(6)
    say = lambda n: " ".join(rng.choices(["red", "green", "blue", "one", "two", "three", "é", "x9"], k=n))
    items = [(k, say(rng.choice([1, 2, 5, 11, 12, 13, 40]))) for k in range(40)] + [(100, None), (101, ""), (102, "!?"), (103, "same words"), (104, "Same, WORDS!")]
    docs = []
    for k in range(120):
        parts = [say(rng.randrange(30))]
        for _ in range(rng.randrange(3)):
            words = hashing.words_of(rng.choice(items[:40])[1])
            cut = rng.randrange(len(words))
            parts += [", ".join(words[cut : cut + rng.randrange(10, 30)]).upper(), say(3)]
        docs.append((k, " ".join(parts)))
    docs += [(500, None), (501, ""), (502, "same words " * 20_000), (503, items[5][1])]
    df = spark.createDataFrame(docs, "doc long, text string").withColumn("item", F.lit("clash"))
    listed = spark.createDataFrame(items, "item long, text string").withColumn("doc", F.lit("clash"))
    got = leaks(df.union(df.limit(5)), listed.union(listed.limit(5)), broadcast_runs=broadcast)
    want = contained(docs, items)
    assert set(rows(got)) == want and len(want) > 100 and got.count() == len(want)


@pytest.mark.parametrize("broadcast", [10**6, 0])
def test_leaks_of_nothing(spark, broadcast):
    docs = spark.createDataFrame([(1, "some text")], "doc long, text string")
    items = spark.createDataFrame([(1, "some text")], "item long, text string")
    assert leaks(docs, items.limit(0), broadcast_runs=broadcast).count() == 0
    assert leaks(docs.limit(0), items, broadcast_runs=broadcast).count() == 0


def shared(docs, least):
    """By brute force: every stretch of least characters, and where it occurs."""
    at = {}
    for doc, text in docs:
        for k in range(len(text or "") - least + 1):
            at.setdefault(text[k : k + least], set()).add(doc)
    out = set()
    for doc, text in docs:
        covered = [False] * (len(text or "") + 1)
        for k in range(len(text or "") - least + 1):
            if at[text[k : k + least]] - {doc}:
                covered[k : k + least] = [True] * least
        start = None
        for k, c in enumerate(covered):
            if c and start is None:
                start = k
            if not c and start is not None:
                out.add((doc, start, k))
                start = None
    return out


@pytest.mark.parametrize("often", [16, 3, 0])
def test_shared_spans_against_every_stretch(spark, often):
    rng = random.Random(8)
    say = lambda n: "".join(rng.choices("abcdé 日😀", k=n))
    passages = [say(rng.randrange(25, 90)) for _ in range(6)]
    docs = []
    for k in range(40):
        text = say(rng.randrange(60))
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            cut = rng.randrange(len(p))
            text += rng.choice([p, p[cut:], p[:cut]]) + say(rng.randrange(20))
        docs.append((k, text))
    docs += [(100, docs[0][1]), (101, docs[0][1] + "!"), (102, "x" * 300), (103, "x" * 100), (104, "xy" * 100 + "x" * 40), (105, "yx" * 60), (106, None), (107, ""), (108, say(5000) + passages[0])]
    df = spark.createDataFrame(docs, "doc long, text string").withColumn("from", F.lit("clash")).withColumn("rid", F.lit("clash"))
    got = shared_spans.shared_spans(df.union(df.limit(7)), least=30, k=15, often=often)
    want = shared(docs, 30)
    assert set(rows(got)) == want and len(want) > 15 and got.count() == len(want)


def test_no_spans(spark):
    df = spark.createDataFrame([(1, "only one"), (2, None)], "doc long, text string")
    assert shared_spans.shared_spans(df).count() == 0 and shared_spans.shared_spans(df.limit(0)).count() == 0


def test_fingerprints_dont_depend_on_the_place(monkeypatch):
    codes = shared_spans.code_points("".join(random.Random(9).choices("abc日", k=3000)))
    whole = shared_spans.fingerprints(codes, 50)
    assert (shared_spans.fingerprints(codes[700:900], 50) == whole[700:851]).all()
    monkeypatch.setattr(shared_spans, "PIECE", 256)
    assert (shared_spans.fingerprints(codes, 50) == whole).all()


def test_chains_are_collinear():
    anchors = [(0, 0), (10, 10), (20, 20), (5, 100), (30, 5), (20, 20)]
    paths = shared_spans.chains(anchors, 15)
    assert paths[0] == [(0, 0), (10, 10), (20, 20)] and sorted(sum(paths, [])) == sorted(set(anchors))
    for path in paths:
        assert all(a < c and b < d for (a, b), (c, d) in zip(path, path[1:]))


def test_sliding_minimum():
    rng = np.random.default_rng(1)
    for n in (1, 5, 64, 1000):
        x = rng.integers(0, 1 << 63, n).astype(np.uint64)
        for w in (1, 2, 7, 64, 999):
            assert hashing.sliding_min(x, w).tolist() == [min(x[k : k + w]) for k in range(n - w + 1)]


def test_words():
    for text in ("Plain ASCII, text_with 9 lives!", "Ünï ﬁ x² ١٢ İ", "", " \t"):
        assert hashing.words_of(text) == hashing.WORD.findall(text.lower())
