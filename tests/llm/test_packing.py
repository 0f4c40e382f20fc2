import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from citylake.llm import packing as pk
from tests.llm.fixtures import clashing, docs_of, documents, empty_documents, odd_documents, texts

ODD = ["", " ", "a", " a", "a ", "a  b", "a\n b", "a \nb", "x\n\n y", "it's  a\t b's", "　 x", " \n a",
       "<|endoftext|> a <|endoftext|>", "a\x1c b", "a\x85 b 日本 語", "\x00 a", "tab\t x", "end\n"]


@pytest.fixture(scope="module")
def encoder():
    return pk.WordEncoder(pk.tokenizer_path())


def test_ids_are_the_tokenizers(spark, encoder):
    every = ODD + list(texts(spark).values())
    want = [x.ids for x in encoder.tokenizer.encode_batch(every, add_special_tokens=False)]
    assert [list(x) for x in encoder.encode(pa.array(every))] == want


def test_ids_are_those_of_default_settings(spark, encoder):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(pk.tokenizer_path())
    every = ODD + ["a <|endoftext|> b", "<|endoftext|>", "one two<|endoftext|>three four", "<|endoftext|", "b a"] + list(texts(spark).values())
    want = [plain.encode(x, add_special_tokens=False).ids for x in every]
    got = [list(x) for x in encoder.encode(pa.array(every))]
    assert got == want and got[len(ODD)] == [64, 220, 50256, 275]
    row = pk.pack(docs_of(spark, [(1, "a <|endoftext|> b")])).first()
    assert row["length"] == 5 and row["ids_crc32"] == zlib.crc32(np.array([64, 220, 50256, 275, 0], "<u4").tobytes())


def test_added_tokens_with_spaces(tmp_path):
    from tokenizers import AddedToken, Tokenizer

    more = Tokenizer.from_file(pk.tokenizer_path())
    more.add_tokens([AddedToken("é end", normalized=False), AddedToken("<x>", normalized=False)])
    more.save(path := str(tmp_path / "more.json"))
    every = ["a é", "b end é", "b <x> c", "an é end here", "the end <x>é end", "c é é", "end a end"]
    want = [x.ids for x in Tokenizer.from_file(path).encode_batch(every, add_special_tokens=False)]
    assert [list(x) for x in pk.WordEncoder(path).encode(pa.array(every))] == want


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_best_fit_decreasing_one_by_one(seed):
    rnd = random.Random(seed)
    room = rnd.choice([7, 16, 50])
    items = [rnd.randint(1, room) for _ in range(rnd.randint(0, 300))]
    left = []
    for size in sorted(items, reverse=True):
        fits = [(free, k) for k, free in enumerate(left) if free >= size]
        if fits:
            left[min(fits)[1]] -= size
        else:
            left.append(room - size)
    bins, ranks = defaultdict(list), defaultdict(list)
    for length, low, high, first, per, at in pk.plan_bins(Counter(items), room):
        ranks[length] += range(low, high)
        for k in range(high - low):
            bins[first + k // per].append((at + k % per * length, length))
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in Counter(items).items()}
    assert sorted(room - sum(n for _, n in b) for b in bins.values()) == sorted(left)
    for b in bins.values():
        assert [at for at, _ in sorted(b)] == list(np.cumsum([0] + [n for _, n in sorted(b)])[:-1])


def check(docs, found, room, encoder):
    want = Counter()
    for r in docs.collect():
        ids = [*encoder.tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        for k, (start, length) in enumerate(pk.cut(len(ids), room)):
            crc = zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())
            want[(r["doc_id"], k, start, length, crc)] += 1
    rows = found.collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        ends = 0
        for at, n in sorted(b):
            assert at == ends
            ends += n
        assert ends <= room
    return len(bins)


def test_round_trip(spark, encoder):
    docs = documents(spark)
    n = check(docs, pk.pack(docs), 2048, encoder)
    assert n <= 1.02 * sum(r["length"] for r in pk.pack(docs).collect()) / 2048 + 1
    odd = clashing(odd_documents(spark), "rank", "piece", "length")
    check(odd, pk.pack(odd, 64), 64, encoder)


def test_cut_shortens_only_the_first():
    assert pk.cut(5, 8) == [(0, 5)] and pk.cut(8, 8) == [(0, 8)]
    assert pk.cut(19, 8) == [(0, 3), (3, 8), (11, 8)]


def test_empty(spark):
    assert pk.pack(empty_documents(spark)).count() == 0
