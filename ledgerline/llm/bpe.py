"""Byte-level BPE encoding and decoding by tree concatenation.

A text of ordinary length is encoded in one piece. A long one is halved until
its pieces are short; the pieces are encoded in parallel, as rows spread over
all tasks, and neighbours are joined level by level. Every node of the tree
holds the exact encoding of its own stretch of text, and a join keeps that:

* A window around the join is encoded anew. An end of the window is settled if
  it is the end of the text, if it is a place where the pattern always splits,
  or if it lies inside a run of one character class and both sides agree there:
  the outermost token of the window is the very token the half had at that
  place. BPE output is exactly a sequence whose neighbouring pairs encode to
  themselves, so agreement on the shared token makes the whole sequence exact.
* While an end is not settled, the window doubles on that side; at most it
  becomes the whole half, which is exact by definition.

The tokens come from the vocabulary file alone; ``tiktoken`` applies its merges
(several times faster than the ``tokenizers`` library, with the same ids, which
the tests check). The file is read on the driver and broadcast (1.5 MB, fixed).

Defined cases: null text counts as empty; an empty text has no tokens and decodes
to itself; strings of special tokens in a text become those tokens; rows equal in
id and text are counted and given back as often; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import query, table, texts

#: Longer texts (code points) are halved until their pieces are no longer than this.
LEAF_CHARS = 32768
FIRST_WINDOW = 64
#: Characters of one class wanted on both sides of a place where two halves may agree.
MARGIN = 16

#: The split pattern of the vocabulary (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable Latin-1 bytes stand for themselves; the others follow from U+0100 on.
    """
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Codec:
    """Encoder and decoder for one byte-level vocabulary file (its JSON text)."""

    def __init__(self, vocabulary: bytes):
        import tiktoken

        read = json.loads(vocabulary)
        byte_of = _byte_of_char()
        special = {t["content"]: t["id"] for t in read["added_tokens"] if t["special"]}
        ranks = {bytes(byte_of[c] for c in word): i for word, i in read["model"]["vocab"].items() if word not in special}
        self._coder = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.byte_lengths = np.zeros(max([*ranks.values(), *special.values()]) + 1, dtype=np.int64)
        for word, i in ranks.items():
            self.byte_lengths[i] = len(word)
        for word, i in special.items():
            self.byte_lengths[i] = len(word.encode())

    def encode(self, text: str) -> np.ndarray:
        return self._coder.encode_to_numpy(text, allowed_special="all", disallowed_special=())

    def decode(self, ids: np.ndarray) -> str:
        return self._coder.decode_bytes(ids.tolist()).decode("utf-8", "replace")


def _kind(char: str) -> str | None:
    if char in " \t\n\r":
        return "S"
    first = unicodedata.category(char)[0]
    return {"L": "L", "N": "N", "P": "P", "S": "P"}.get(first)


def _settles(data: bytes, at: int) -> str | None:
    """What a window may do that ends at byte ``at``: 'split', 'agree' or None.

    'split': the pattern always splits there, whatever stands around: after a
    letter, digit or mark before white space, between letters and digits, after
    either before a mark. ('|' ends no such pair: special tokens contain it.)
    """
    if at >= len(data) or at <= 0 or data[at] & 0xC0 == 0x80:
        return None
    before = data[max(0, at - 4 * MARGIN) : at].decode("utf-8", "ignore")[-MARGIN:]
    after = data[at : at + 4 * MARGIN].decode("utf-8", "ignore")[:MARGIN]
    pair = (_kind(before[-1]), _kind(after[0])) if before and after else (None, None)
    if pair[1] == "S" and pair[0] in ("L", "N", "P"):
        return "split"
    if pair in (("L", "N"), ("N", "L"), ("N", "P"), ("L", "P")) and after[0] != "|":
        return "split"
    kinds = {_kind(c) for c in before + after}
    if len(before) == len(after) == MARGIN and len(kinds) == 1 and None not in kinds:
        return "agree"
    return None


def _cut(starts: np.ndarray, data: bytes, near: int, step: int) -> tuple[int, str] | None:
    """The first token, from byte ``near`` on in direction ``step``, where a window may end."""
    k = int(np.searchsorted(starts, near, "left" if step > 0 else "right")) - (step < 0)
    for i in range(k, k + 32 * step, step):
        if 0 < i < len(starts) and (how := _settles(data, int(starts[i]))):
            return i, how
    return None


def join_halves(codec: Codec, left: tuple[np.ndarray, bytes], right: tuple[np.ndarray, bytes]) -> tuple[np.ndarray, bytes]:
    """The exact encoding of two neighbouring stretches from that of each."""
    (a_ids, a), (b_ids, b) = left, right
    a_starts = np.concatenate(([0], np.cumsum(codec.byte_lengths[a_ids])))
    b_starts = np.concatenate(([0], np.cumsum(codec.byte_lengths[b_ids])))
    a_reach = b_reach = FIRST_WINDOW
    while True:
        a_cut = _cut(a_starts, a, len(a) - a_reach, -1) if a_reach < len(a) else (0, "end")
        b_cut = _cut(b_starts, b, b_reach, 1) if b_reach < len(b) else (len(b_ids), "end")
        if a_cut and b_cut:
            i, a_how = a_cut
            j, b_how = b_cut
            window = codec.encode((a[a_starts[i] :] + b[: b_starts[j]]).decode("utf-8"))
            a_good = a_how != "agree" or (len(window) > 0 and window[0] == a_ids[i])
            b_good = b_how != "agree" or (len(window) > 0 and window[-1] == b_ids[j - 1])
            if a_good and b_good:
                return np.concatenate((a_ids[:i], window, b_ids[j:])), a + b
        else:
            a_good, b_good = a_cut is not None, b_cut is not None
        a_reach *= 1 if a_good else 2
        b_reach *= 1 if b_good else 2


def halves(text: str, leaf_chars: int) -> list[str]:
    """The pieces of a text halved until none is longer than ``leaf_chars``."""
    if len(text) <= leaf_chars:
        return [text]
    middle = len(text) // 2
    return halves(text[:middle], leaf_chars) + halves(text[middle:], leaf_chars)


def join_tree(codec: Codec, leaves: list[tuple[np.ndarray, bytes]]) -> np.ndarray:
    while len(leaves) > 1:
        pairs = [join_halves(codec, *leaves[k : k + 2]) for k in range(0, len(leaves) - 1, 2)]
        leaves = pairs + leaves[2 * len(pairs) :]
    return leaves[0][0]


_CODECS: dict[bytes, Codec] = {}


def _codec(shared) -> Codec:
    """One codec per worker process and vocabulary."""
    if shared.value not in _CODECS:
        _CODECS[shared.value] = Codec(shared.value)
    return _CODECS[shared.value]


def ids_and_text(codec: Codec, ids: list[np.ndarray]) -> dict:
    return {
        "ids": pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32())),
        "decoded": [codec.decode(i) for i in ids],
    }


def digests(codec: Codec, ids: list[np.ndarray]) -> dict:
    return {
        "n_tokens": [len(i) for i in ids],
        "ids_sha256": [hashlib.sha256(i.astype("<u4").tobytes()).hexdigest() for i in ids],
        "decoded_sha256": [hashlib.sha256(codec.decode(i).encode()).hexdigest() for i in ids],
    }


#: Documents whose ids and decoded texts a worker holds at once.
ROWS = 200

#: What a finish makes of the token ids of each document.
FINISHES = {
    ids_and_text: ("ids array<int>, decoded string", {"ids": pa.list_(pa.int32()), "decoded": pa.string()}),
    digests: (
        "n_tokens long, ids_sha256 string, decoded_sha256 string",
        {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()},
    ),
}


def encode_decode(docs: DataFrame, vocabulary_path: str, finish: Callable = ids_and_text, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """Per document: doc_id and what ``finish`` gives (by default ids and the decoded text)."""
    spark = docs.sparkSession
    with open(vocabulary_path, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())
    columns, kinds = FINISHES[finish]
    schema = f"doc_id long, {columns}"
    arrow = pa.schema([("doc_id", pa.int64()), *kinds.items()])
    docs = texts(docs)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                made = finish(codec, [codec.encode(t) for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), **made}, schema=arrow)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                pieces = halves(text, leaf_chars)
                digest = hashlib.sha256(text.encode()).digest()
                n = len(pieces)
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": pa.array([doc_id] * n, pa.int64()), "digest": [digest] * n, "part": pa.array(range(n), pa.int32()), "piece": pieces}
                )

    def encode_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for batch in batches:
            for at in range(0, batch.num_rows, 16):
                part = batch.slice(at, 16)
                ids = [codec.encode(t).astype("<u4").tobytes() for t in part.column("piece").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ids, pa.binary())], names=[*part.schema.names, "ids"])

    def join_document(pdf: pd.DataFrame) -> pd.DataFrame:
        codec = _codec(shared)
        copies = int((pdf["part"] == 0).sum())
        leaves = pdf.drop_duplicates("part").sort_values("part")
        ids = join_tree(codec, [(np.frombuffer(i, "<u4"), p.encode()) for i, p in zip(leaves["ids"], leaves["piece"])])
        made = pa.RecordBatch.from_pydict({"doc_id": [pdf["doc_id"].iloc[0]], **finish(codec, [ids])}).to_pandas()
        return pd.concat([made] * copies, ignore_index=True)

    long_text = F.length("text") > leaf_chars
    pieces = docs.filter(long_text).mapInArrow(split, "doc_id long, digest binary, part int, piece string")
    joined = (
        pieces.repartition("doc_id", "digest", "part")
        .mapInArrow(encode_pieces, "doc_id long, digest binary, part int, piece string, ids binary")
        .groupBy("doc_id", "digest")
        .applyInPandas(join_document, schema)
    )
    return docs.filter(~long_text).mapInArrow(whole, schema).unionByName(joined)


def with_digests(encoded: DataFrame) -> DataFrame:
    """Add to ``ids`` and ``decoded`` the columns of ``digests``, derived from them."""

    def little_endian(i):
        told = F.lpad(F.hex(i), 8, "0")
        return F.concat(*[F.substring(told, k, 2) for k in (7, 5, 3, 1)])

    return encoded.withColumns(
        {
            "n_tokens": F.size("ids").cast("long"),
            "ids_sha256": F.sha2(F.unhex(F.array_join(F.transform("ids", little_endian), "")), 256),
            "decoded_sha256": F.sha2(F.col("decoded").cast("binary"), 256),
        }
    )


@query("op8_bpe_roundtrip")
def op8_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), digests)
