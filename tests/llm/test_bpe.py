import hashlib
import random

import numpy as np
import pytest

from slotwise.llm.bpe import Codec, cuts, encode_documents
from slotwise.llm.queries import tokenizer_path

from tests.llm.conftest import words


@pytest.fixture(scope="module")
def codec():
    return Codec(tokenizer_path())


def odd_texts():
    draw = random.Random(5)
    letters = ["a", "B", " ", "  ", "\n", "'s", "'re", "é", "日", "<|endoftext|>", "1", ",", ".", "\t", " ", "\u0085", "\x1c", "🙂", "the "]
    made = ["".join(draw.choice(letters) for _ in range(draw.randrange(0, 400))) for _ in range(200)]
    return [
        "", " ", "x", "x" * 5000, " " * 3000, "it's  we're   " * 200, "日本語" * 2000, "a b<|endoftext|> c " * 400, "  a" * 999,
        words(5000, 1), words(5000, 1) + " end", words(40, 2) + "\n" + words(5000, 1), *made,
    ]


@pytest.mark.parametrize("bits, least", [(10, 256), (3, 1), (5, 20)])
def test_ids_are_those_of_the_tokenizer(codec, bits, least):
    texts = odd_texts()
    got = codec.encode([t.encode() for t in texts], bits, least)
    for text, ids, want in zip(texts, got, codec.tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert ids.tolist() == want.ids, text[:80]
        assert codec.decode(ids).decode() == codec.tokenizer.decode(want.ids, skip_special_tokens=False)


def test_cuts_depend_on_content():
    text = words(4000, 3).encode()
    ends = {len(text) - e for e in cuts(text)}
    moved = b"something before it " + text
    assert len(ends & {len(moved) - e for e in cuts(moved)}) >= len(ends) - 3
    assert cuts(b"") == [] and cuts("é".encode() * 3000, 2, 1)[-1] == 6000
    assert all(e % 2 == 0 for e in cuts("é".encode() * 3000, 2, 1))


def test_documents(make, codec):
    rows = [(1, "one two"), (2, None), (None, "x y" * 5000), (1, "one two")]
    got = encode_documents(make(rows), tokenizer_path()).collect()
    assert sorted((r.doc_id or 0, r.decoded, r.kept, r.h) for r in got) == sorted((d or 0, t or "", "x", 7) for d, t in rows)
    made = encode_documents(make(rows).select("doc_id", "text"), tokenizer_path(), digests=True).collect()
    for r in made:
        text = dict(rows)[r.doc_id] or ""
        ids = np.array(codec.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert encode_documents(make([]), tokenizer_path()).count() == 0
