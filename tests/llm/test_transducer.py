"""The transducer against the tiktoken library, word by word and in Spark; the decoder on pieces of any size."""

import hashlib
import random
from pathlib import Path

import pytest

from mendtable.llm import transducer


@pytest.fixture(scope="module")
def model():
    import public_tokenizers

    return transducer.Model(Path(transducer.rank_file()).read_text(), public_tokenizers.PATTERN, transducer.character_classes())


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken

    ranks = transducer.read_ranks(Path(transducer.rank_file()).read_text())
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def samples(dice, tokens):
    alphabets = ["ab", "abcdefgh etaoin", "éàü漢字あア한글🙂", "0123456789 ²½Ⅻ", "  \n\t\r.!?'s", "'ll've'S x", "  ᠎​\u0085x", "͸\U0001e900a"]
    for _ in range(600):
        letters = dice.choice(alphabets) + dice.choice(alphabets)
        yield "".join(dice.choice(letters) for _ in range(dice.choice([1, 3, 10, 60])))
    for _ in range(600):
        yield b"".join(dice.choice(tokens) for _ in range(dice.randint(1, 6))).decode("utf-8", "ignore")


def test_same_ids_as_the_library(model, library, plain_docs, odd_texts):
    dice = random.Random(5)
    texts = [*samples(dice, list(model.table.transducer.ranks)), *(t or "" for _, t in [*plain_docs, *odd_texts])]
    for text in texts:
        assert model.table.encode(text) == library.encode_ordinary(text)


@pytest.mark.parametrize("word", ["a" * 5000, " " * 3000 + "x", "ab" * 3000, "漢" * 2000, "=-" * 1000])
def test_long_words_need_few_states(model, library, word):
    before = len(model.table.transducer.members)
    assert model.table.encode(word) == library.encode_ordinary(word)
    assert len(model.table.transducer.members) - before < 600


def test_forgetting_within_a_word(library):
    ranks = transducer.read_ranks(Path(transducer.rank_file()).read_text())
    small, dice = transducer.Transducer(ranks, states=20), random.Random(1)
    for size in (5, 50, 3000):
        word = "".join(dice.choice("etaoinshrdlu") for _ in range(size))
        assert small.encode(word.encode()) == library.encode_ordinary(word)
        assert len(small.members) <= 23


def test_pair_tests_are_those_of_bpe(model):
    walker, dice = model.table.transducer, random.Random(2)
    assert walker.growing
    tokens = [t for t in walker.bytes_of if t in walker.formed]
    common = [t for t in tokens if walker.bytes_of[t].isalpha() and len(walker.bytes_of[t]) < 5]
    seen = set()
    for _ in range(20_000):
        one, two = dice.choice(common), dice.choice(common if dice.random() < 0.8 else tokens)
        whole = walker.merged(walker.bytes_of[one] + walker.bytes_of[two])
        assert walker.may_follow(one, two) == (whole == (one, two))
        seen.add(whole == (one, two))
    assert seen == {True, False}
    for token in dice.sample(sorted(walker.bytes_of), 3000):
        assert walker.may_follow(-1, token) == (walker.merged(walker.bytes_of[token]) == (token,))


def test_ranks_that_do_not_grow():
    import tiktoken

    ranks = {bytes([b]): b + 10 for b in range(256)} | {b"ab": 9, b"abc": 3, b"bc": 5, b"abcd": 1, b"cd": 2, b"aa": 4, b"aaa": 7}
    ranks |= {token: rank for rank, token in zip((0, 6, 8), (b"dabc", b"da", b"bcd"))}
    walker, dice = transducer.Transducer(ranks), random.Random(8)
    library = tiktoken.Encoding("odd", pat_str=".+", mergeable_ranks=ranks, special_tokens={})
    assert not walker.growing
    for _ in range(3000):
        word = "".join(dice.choice("abcd") for _ in range(dice.randint(1, 14)))
        assert walker.encode(word.encode()) == library.encode_ordinary(word)


def test_tokens_leave_as_soon_as_they_are_settled(model):
    walker = model.table.transducer
    for word in (b"internationalisation", b"antidisestablishmentarianism"):
        state, out = 0, []
        for byte in word:
            state, emitted = walker.steps.get(state << 8 | byte) or walker._step(state, byte)
            out += emitted
            held = sum(len(walker.bytes_of[t]) for t in walker.last[state])
            assert sum(len(walker.bytes_of[t]) for t in out) + held <= len(word)
        assert out and [*out, *walker.last[state]] == list(walker.merged(word))


def test_word_table_forgets(model, library, plain_docs):
    table = transducer.WordTable(model.table.transducer, model.table.words, remembered=40)
    for _, text in plain_docs[:40]:
        assert table.encode(text) == library.encode_ordinary(text)
        assert len(table.ids) <= 20 and len(table.older) <= 20


def test_streaming_decoder(model):
    text = "naïve café – 漢字 🙂 x"
    ids = [model.table.transducer.ranks[bytes([b])] for b in text.encode()]
    for size in range(1, 9):
        pieces = list(transducer.decoded_pieces(model.bytes_of, ids, size))
        assert "".join(p.decode() for p in pieces) == text
    for broken in (b"\xc3", b"\xe6\xbc", b"\xf0\x9f\x99", b"a\xff\xe6b\xf0\x9f", b"\xe6\xbc\xff\x80\x80", b"\xed\xa0\x80\xf5\xc0"):
        ids = [model.table.transducer.ranks[bytes([b])] for b in broken]
        for size in (1, 2, 5):
            pieces = list(transducer.decoded_pieces(model.bytes_of, ids, size))
            assert b"".join(pieces) == broken
            assert "".join(p.decode("utf-8", "replace") for p in pieces) == broken.decode("utf-8", "replace")


@pytest.mark.parametrize("which", ["odd", "plain", "empty"])
def test_round_trip(docs_of, library, odd_texts, plain_docs, which):
    rows = {"odd": odd_texts, "plain": plain_docs, "empty": []}[which]

    def sha(data):
        return hashlib.sha256(data).hexdigest()

    want = []
    for i, text in rows:
        ids = library.encode_ordinary(text or "")
        want.append((i, len(ids), sha(",".join(map(str, ids)).encode()), sha(library.decode_bytes(ids))))
    docs = docs_of(rows)
    got = transducer.round_trip(docs)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    back = transducer.decode(transducer.encode(docs))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(((i, t or "") for i, t in rows), key=repr)


def test_other_vocabularies(spark, plain_docs):
    import public_tokenizers
    import tiktoken

    path = transducer.rank_file("byte_bpe_50k.tiktoken")
    pattern = r"\p{L}+|[^\p{L}\s]"
    library = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=transducer.read_ranks(Path(path).read_text()), special_tokens={})
    docs = spark.createDataFrame(plain_docs[:30], "doc_id bigint, text string")
    got = {r.doc_id: r.ids for r in transducer.encode(docs, path=path, pattern=pattern).collect()}
    assert got == {i: library.encode_ordinary(t) for i, t in plain_docs[:30]}
    assert public_tokenizers.PATTERN != pattern
