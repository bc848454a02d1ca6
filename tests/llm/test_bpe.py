import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfrank.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
VOCAB = bpe.vocabulary(PATH)
LIBRARY = Tokenizer.from_file(PATH)
MEMORY = bpe._Memory(VOCAB)


def own(text, part=None):
    e = bpe.Encoder(VOCAB, MEMORY)
    if part is None:
        out = list(e.encode(text))
    else:
        out = [x for i in range(0, len(text), part) for x in e.feed(text[i:i + part])] + list(e.finish())
    return np.frombuffer(b"".join(out), "<u4").tolist()


def decoded(ids, part=3):
    d = bpe.Decoder(VOCAB)
    return "".join(d.feed(ids[i:i + part]) for i in range(0, len(ids), part)) + d.finish()


def same(text, parts):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    assert own(text) == want
    for part in parts:
        assert own(text, part) == want
    assert decoded(want) == LIBRARY.decode(want, skip_special_tokens=False)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abe th's'll \n\t0123é日 　!?<|endoftext>"), st.characters(exclude_categories=["Cs", "Cn"])), max_size=60))
def test_equals_the_library(text):
    same(text, (1, 7))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50256), max_size=12))
def test_decodes_any_ids(ids):
    assert decoded(ids, 1) == LIBRARY.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", [
    "x" * 150_000, "ab" * 80_000, " " * 140_000, " " * 70_000 + "x", "é" * 70_000, " " + "the" * 40_000 + " end", "9" * 140_000,
    "!" * 131_072 + "'s", "\n" * 65_536 + " a", "<|endoftext|>", "a<|endoftext|> b  <|endoftext|>", "y" * 65_530 + "<|endoftext|>z"])
def test_long_runs_and_special_tokens(text):
    same(text, (5000, 65_537))


def test_memory_stays_bounded():
    rnd = random.Random(1)
    e = bpe.Encoder(VOCAB, MEMORY)
    for _ in range(40):
        for _ in e.feed("".join(rnd.choice("abcdefgh") for _ in range(60_000))):
            pass
        assert len(e.text) < 2 * bpe.CHUNK and len(e.merger.held) < 2 * bpe.CHUNK


def test_lookahead_suffices():
    """Tokens that end ``lookahead`` bytes before the end stay whatever follows."""
    rnd = random.Random(3)
    merges = [(b"a", b"b"), (b"b", b"a"), (b"ab", b"a"), (b"c", b"ab"), (b"b", b"c"), (b"a", b"a"), (b"c", b"c")]
    look = bpe.sufficient_lookahead(merges)

    def merge(text):
        parts = [text[i:i + 1] for i in range(len(text))]
        for a, b in merges:
            i = 0
            while i + 1 < len(parts):
                if parts[i] == a and parts[i + 1] == b:
                    parts[i:i + 2] = [a + b]
                i += 1
        return parts
    for _ in range(300):
        head = bytes(rnd.choice(b"abc") for _ in range(look + 20))
        kept, at = [], 0
        for t in merge(head):
            at += len(t)
            if at > len(head) - look:
                break
            kept.append(t)
        for _ in range(5):
            tail = bytes(rnd.choice(b"abc") for _ in range(10))
            assert merge(head + tail)[:len(kept)] == kept


def test_tables(spark, docs):
    rows = [(1, None), (2, ""), (3, "Ein Text, don't!"), (3, "Ein Text, don't!"), (None, "日本 x"), (5, "w " * 70_000)]
    got = bpe.encode(docs(rows, extra=True), PATH, decoded=True)
    back = bpe.decode(got, PATH, to="again").collect()
    assert len(back) == len(rows)
    for r in back:
        ids = LIBRARY.encode(r.text or "", add_special_tokens=False).ids
        assert (r.ids, r.n_tokens, r.decoded, r.again) == (ids, len(ids), r.text or "", r.text or "")
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert bpe.encode(docs([]), PATH).collect() == []
