"""Byte-level BPE through a sentencepiece model that is serialised directly from a rank vocabulary.

The vocabulary's byte strings become pieces by mapping each byte to one printable character; a piece's score is its
negative rank, so sentencepiece merges the pair with the lowest rank first and the leftmost of equals, as byte-pair
encoders do. Normalisation is the identity. Pre-tokens are encoded one by one; decoding maps pieces back to bytes.
"""

from __future__ import annotations

import base64
import gc
import struct
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy.llm.shared import decoded, quoted, raw, with_columns

#: Runs between white space: PATTERN never matches across these, so each can be split and kept on its own.
CHUNKS = r" ?\S+|\s+(?!\S)|\s+"


def byte_characters() -> list[str]:
    """One printable character for each byte: itself where printable and no space, else one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    own = set(plain)
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Lines of ``base64 rank``."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value) -> bytes:
    """One protocol-buffer field: ints and bools as varints, floats as 32 bits, bytes with their length."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(int(value))
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def serialise(ranks: dict[bytes, int]) -> bytes:
    """The model: a piece's id is its rank; an unknown piece, which byte-mapped text never needs, follows last."""
    letters = byte_characters()
    ordered = sorted(ranks, key=ranks.get)
    if [ranks[t] for t in ordered] != list(range(len(ordered))) or any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("ranks must be gapless from 0 and hold every single byte")
    pieces = [
        _field(1, _field(1, "".join(letters[b] for b in token).encode()) + _field(2, float(-rank)) + _field(3, 1))
        for rank, token in enumerate(ordered)
    ]
    pieces.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2)))
    trainer = _field(3, 2) + _field(4, len(pieces)) + _field(40, len(ordered)) + _field(41, 0xFFFFFFFFFFFFFFFF)
    trainer += _field(42, 0xFFFFFFFFFFFFFFFF) + _field(43, 0xFFFFFFFFFFFFFFFF)
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normaliser)


class ByteBpe:
    """Encodes texts; remembers the ids of chunks, within a task and up to a bound.

    Chunks over LONG characters, such as whole texts in scripts without spaces, are split into pre-tokens before they are
    looked up, and pre-tokens over LONG are not remembered. A pre-token by itself is split no further.
    """

    MOST, LONG = 300_000, 64

    def __init__(self, model: bytes, pattern: str):
        import regex
        import sentencepiece

        self.known: dict[str, tuple[int, ...]] = {}
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.size = self.processor.get_piece_size() - 1
        self.matches, self.chunks = regex.compile(pattern).findall, regex.compile(CHUNKS).findall
        self.to_letters = dict(enumerate(byte_characters()))
        # A pre-token that is a piece is that piece, also where merges would end elsewhere: such pieces, if any, are listed.
        pieces = [self.processor.id_to_piece(i) for i in range(self.size)]
        self.whole = {p: (i,) for i, (p, ids) in enumerate(zip(pieces, self.processor.encode(pieces, num_threads=1), strict=True)) if ids != [i]}

    def mapped(self, token: str) -> str:
        return token.encode().decode("latin-1").translate(self.to_letters)

    def merged(self, tokens: list[str]) -> list[tuple[int, ...]]:
        """Ids of pre-tokens, all in one call."""
        mapped = list(map(self.mapped, tokens))
        ids = map(tuple, self.processor.encode(mapped, num_threads=1) if mapped else [])
        return [self.whole.get(m) or own for m, own in zip(mapped, ids, strict=True)] if self.whole else list(ids)

    def learn(self, chunks: set[str]) -> None:
        """Remembers the ids of ``chunks``. A word of letters, with a space or not, is one pre-token; the pattern splits the rest."""
        simple = [c for c in chunks if c[c[0] == " " :].isalpha()]
        self.known.update(zip(simple, self.merged(simple), strict=True))
        split = [(c, self.matches(c)) for c in chunks.difference(simple)]
        answers = iter(self.merged([token for _, tokens in split for token in tokens]))
        for chunk, tokens in split:
            self.known[chunk] = tuple(chain.from_iterable(next(answers) for _ in tokens))

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text. The collector of cycles, of which there are none here, would walk all that is remembered, again and again."""
        collects = gc.isenabled()
        gc.disable()
        try:
            return self._encode(texts)
        finally:
            if collects:
                gc.enable()

    def _encode(self, texts: list[str]) -> list[list[int]]:
        out = []
        for k in range(0, len(texts), 32):
            split = [self.chunks(text) for text in texts[k : k + 32]]
            own = set().union(*split)
            if long := {c for c in own if len(c) > self.LONG}:
                split = [list(chain.from_iterable(self.matches(c) if c in long else (c,) for c in chunks)) for chunks in split]
                own = set().union(*split)
            new = own.difference(self.known)
            if len(self.known) + len(new) > self.MOST:
                self.known.clear()
                new = own
            self.learn(new)
            out += [list(chain.from_iterable(map(self.known.__getitem__, chunks))) for chunks in split]
            for c in new if long else ():
                if len(c) > self.LONG:
                    del self.known[c]
        return out

    def forget(self) -> None:
        self.known.clear()


class ByteDecoder:
    """Ids to bytes by the inverse mapping of the model's pieces; keeps a table only, not the model."""

    def __init__(self, model: bytes, pattern: str = ""):
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        back = {c: b for b, c in enumerate(byte_characters())}
        self.bytes_of = [bytes(back[c] for c in processor.id_to_piece(i)) for i in range(processor.get_piece_size() - 1)]

    def decode(self, ids: list[list[int]]) -> list[bytes]:
        return [b"".join(map(self.bytes_of.__getitem__, own)) for own in ids]

    def forget(self) -> None:
        pass

_own: dict[tuple[str, int], ByteBpe | ByteDecoder] = {}


def _codec(method: str, model: bytes, pattern: str):
    """One encoder or decoder per worker process; another model replaces it."""
    key = method, hash((model, pattern))
    if key not in _own:
        _own.clear()
        _own[key] = (ByteBpe if method == "encode" else ByteDecoder)(model, pattern)
    return _own[key]


def _lists(column: pa.Array) -> list:
    """Texts of bytes; lists of numbers by way of numpy, which is ten times as fast."""
    if not pa.types.is_list(column.type):
        return list(map(decoded, column.to_pylist()))
    values, ends = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy().cumsum()
    return [values[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends, strict=True)]


class Bpe:
    """Encode and decode DataFrames; ``path`` names the rank file and ``pattern`` splits text into pre-tokens.

    The file is read on the driver; its model, of a fixed size below a few MB, is broadcast. Null texts count as empty;
    empty texts give no ids and decode to no bytes. Bytes of a text that are no UTF-8 are encoded as U+FFFD. Texts of any length
    are encoded whole, and equal texts and repeated rows alike. Other columns pass through; a column that has the name of a
    result is replaced. Empty tables give empty results.
    """

    def __init__(self, spark, path: str, pattern: str):
        self.model = spark.sparkContext.broadcast((serialise(read_ranks(path)), pattern))

    def _with(self, df: DataFrame, source: Column, name: str, kind: T.DataType, arrow: pa.DataType, method: str) -> DataFrame:
        model = self.model

        def start():
            call = getattr(_codec(method, *model.value), method)
            return lambda column: [pa.array(call(_lists(column)), arrow)]

        def end():
            _codec(method, *model.value).forget()  # idle workers hold no texts

        return with_columns(df, source, [T.StructField(name, kind)], start, end)

    def encode(self, df: DataFrame, text: str = "text", to: str = "tokens") -> DataFrame:
        """Adds ``to``: the ids of the whole text, without special tokens."""
        return self._with(df, raw(df, text), to, T.ArrayType(T.IntegerType()), pa.list_(pa.int32()), "encode")

    def decode(self, df: DataFrame, ids: str = "tokens", to: str = "decoded") -> DataFrame:
        """Adds ``to``: the bytes of the ids; null ids count as none."""
        source = F.coalesce(quoted([ids])[0], F.expr("cast(array() as array<int>)"))
        return self._with(df, source, to, T.BinaryType(), pa.binary(), "decode")


def digests(df: DataFrame) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded bytes, inside the JVM."""
    return df.select(
        "doc_id",
        F.size("tokens").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("tokens").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
