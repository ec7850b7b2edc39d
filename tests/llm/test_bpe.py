import hashlib
import random
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def codec():
    with open(PATH, "rb") as f:
        return bpe.Codec(f.read())


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def hard_texts():
    r = random.Random(7)
    yield from ["", " ", "\n\n  \n", "a" * 3000, "ab" * 2000, "7" * 2500, "!" * 2500, " " * 2500, "\t \r\n" * 700, "漢字" * 1500]
    yield "don't we'll " * 300
    yield "x<|endoftext|>y" * 200
    yield "<|endoftext|>" * 300
    yield "<<<<<<<<<<<<<<<<<<<<|endoftext|>>>>>>>>>>>>>>>>>>>>" * 60
    yield "'s" * 1000 + "'" * 1000 + "l" * 1000
    yield "é́" * 1500 + "नमस्ते" * 400 + "🙂👩‍👩‍👧" * 300
    for alphabet in ("ab", "the quick", "aé漢 \n", "09 .,'lsd", "<|endoftext>|", "  \n\tx"):
        yield "".join(r.choice(alphabet) for _ in range(4000))
    yield "".join(chr(r.choice((r.randrange(32, 127), r.randrange(160, 0x800), r.randrange(0x4E00, 0x9FFF)))) for _ in range(5000))


def test_codec_equals_the_library(codec, library):
    for text in hard_texts():
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text).tolist() == ids
        assert codec.decode(codec.encode(text)) == library.decode(ids, skip_special_tokens=False)


def test_every_character_between_letters(codec, library):
    points = [p for p in range(0x3000) if not 0xD800 <= p < 0xE000] + list(range(0xFE00, 0xFF10)) + list(range(0x1F300, 0x1F400))
    made = ["a%c b%c%c 1%cx" % ((chr(p),) * 4) for p in points]
    for text, e in zip(made, library.encode_batch(made, add_special_tokens=False)):
        assert codec.encode(text).tolist() == e.ids, repr(text)


@pytest.mark.parametrize("leaf", [1, 7, 50, 333])
def test_tree_equals_one_piece(codec, leaf):
    for text in hard_texts():
        text = text[: 400 * leaf]
        leaves = [(codec.encode(p), p.encode()) for p in bpe.halves(text, leaf)]
        assert bpe.join_tree(codec, leaves).tolist() == codec.encode(text).tolist(), (leaf, text[:40])


def test_operator(spark, library):
    rows = [(k, t, "x") for k, t in enumerate(hard_texts())] + [(None, "a b", "y"), (900, None, "z")]
    rows += [(5, "repeated row " * 50, "x")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.encode_decode(docs, PATH, leaf_chars=100).collect()
    want = sorted((str(k), library.encode(t or "", add_special_tokens=False).ids, t or "") for k, t, _ in rows)
    assert sorted((str(r.doc_id), list(r.ids), r.decoded) for r in got) == want
    digests = bpe.encode_decode(docs, PATH, bpe.digests, leaf_chars=100).collect()
    sha = lambda ids: hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in digests) == sorted(
        (k, len(ids), sha(ids), hashlib.sha256(t.encode()).hexdigest()) for k, ids, t in want
    )
    assert bpe.encode_decode(docs.limit(0), PATH).count() == 0


def test_query_equals_the_library(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = {}
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want[d.doc_id] = (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.op8_bpe_roundtrip(spark, sf).collect()}
    assert got == want
