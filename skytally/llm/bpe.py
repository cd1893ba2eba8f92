"""Byte-level BPE through a sentencepiece model that is written out from the vocabulary itself."""

from __future__ import annotations

import base64
import hashlib
from collections import ChainMap
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2 as pb

from skytally.llm.common import per_worker, slices

SLICE_BYTES = 4 << 20  # of text that is split and looked up at once
MOST_CACHED = 600_000  # words a worker remembers
UNKNOWN = "⁇"  # never produced: all 256 bytes are pieces


def byte_chars() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, the rest from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank, from a file of lines `base64 rank`."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    return [ranks[i] for i in range(len(ranks))]


def model_bytes(tokens: list[bytes]) -> bytes:
    """A serialised BPE model: piece = bytes as characters, score = negative rank, identity normalisation."""
    chars = byte_chars()
    model = pb.ModelProto()
    for rank, token in enumerate(tokens):
        model.pieces.add(piece="".join(chars[b] for b in token), score=-float(rank))
    model.pieces.add(piece=UNKNOWN, score=0.0, type=pb.ModelProto.SentencePiece.UNKNOWN)
    model.trainer_spec.model_type = pb.TrainerSpec.BPE
    model.trainer_spec.vocab_size = len(model.pieces)
    model.trainer_spec.unk_id = len(tokens)
    model.trainer_spec.unk_piece = UNKNOWN
    model.trainer_spec.bos_id = model.trainer_spec.eos_id = model.trainer_spec.pad_id = -1
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = False
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = False
    return model.SerializeToString()


def _packed(ids: Iterable[list[int]]) -> bytes:
    return np.fromiter(chain.from_iterable(ids), "<u4").tobytes()


class Codec:
    """Encodes texts and decodes ids."""

    def __init__(self, path: str, pattern: str):
        self.tokens = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(self.tokens))
        self.split = regex.compile(pattern).findall
        self.chars = dict(enumerate(byte_chars()))
        back = {c: b for b, c in self.chars.items()}
        self.decoded = [bytes(map(back.get, self.model.id_to_piece(i))) for i in range(len(self.tokens))]
        self.whole = {token: rank for rank, token in enumerate(self.tokens)}
        self.cache: dict[str, bytes | None] = {}  # by word; full once the frequent words are in

    def ids(self, pre_tokens: list[str]) -> list[list[int]]:
        """Ids of pre-tokens; one that is a token as a whole is that token."""
        raw = [p.encode() for p in pre_tokens]
        merged = self.model.encode([r.decode("latin-1").translate(self.chars) for r in raw], num_threads=1)
        return [[self.whole[r]] if r in self.whole else found for r, found in zip(raw, merged)]

    def learn(self, words: list[str]) -> dict[str, bytes | None]:
        """Ids of words that stand behind a single space; None where the pattern may not cut before that space."""
        split = [None if not w or w[0].isspace() or w[-1].isspace() else self.split(" " + w) for w in words]
        flat = iter(self.ids([p for pre in split if pre for p in pre]))
        return {w: pre and _packed(next(flat) for _ in pre) for w, pre in zip(words, split)}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers.

        The pattern takes a single space between two other characters together with what follows, and looks
        at nothing before it. So texts are looked up word by word, unless white space meets white space: those
        are split by the pattern as a whole.
        """
        words = [t.split(" ") for t in texts]
        new = self.learn(list(set().union(*(w[1:] for w in words)).difference(self.cache)))
        known = self.cache
        if len(known) + len(new) > MOST_CACHED:
            known = ChainMap(new, known)
        else:
            known.update(new)
        heads, tails = [], []
        for text, own in zip(texts, words):
            try:
                if len(own) > 1 and own[0][-1:].isspace():
                    raise TypeError
                tails.append(b"".join(map(known.__getitem__, own[1:])))
                heads.append(self.split(own[0]))
            except TypeError:  # a word without ids of its own
                tails.append(b"")
                heads.append(self.split(text))
        flat = iter(self.ids([p for pre in heads for p in pre]))
        return [_packed(next(flat) for _ in pre) + tail for pre, tail in zip(heads, tails)]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.decoded.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode_decode(
    docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text", digests: bool = False
) -> DataFrame:
    """key, n_tokens, and the ids (little-endian unsigned 32-bit) with the bytes they decode to.

    Every match of ``pattern`` is encoded separately by the ranks of the file ``path``; there are no special tokens,
    so their strings are ordinary text. Null text is empty text: no token, no byte. With ``digests`` the
    columns ids_sha256 and decoded_sha256 (lowercase hex) stand in for the two binary columns.
    Rows are independent of each other; other columns are not read.
    """
    docs = docs.select(key, text)
    kind = docs.schema[key].dataType.simpleString()
    results = "ids_sha256 string, decoded_sha256 string" if digests else "ids binary, decoded binary"

    def shown(data: list[bytes]) -> pa.Array:
        if digests:
            return pa.array([hashlib.sha256(x).hexdigest() for x in data], pa.string())
        return pa.array(data, pa.binary())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = per_worker(f"codec {path} {pattern}", lambda: Codec(path, pattern))
        for batch in batches:
            for part in slices(batch, text, SLICE_BYTES):
                ids = codec.encode([x or "" for x in part.column(text).to_pylist()])
                counts = pa.array([len(x) // 4 for x in ids], pa.int64())
                columns = [part.column(key), counts, shown(ids), shown([codec.decode(x) for x in ids])]
                names = [key, "n_tokens", *(c.split()[0] for c in results.split(", "))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(work, f"`{key}` {kind}, n_tokens long, {results}")
