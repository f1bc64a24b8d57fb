"""Byte-level BPE encoding and decoding with a fixed public vocabulary.

The vocabulary's pattern never joins text across a blank between two words, so each
different word (with the blank before it) is split by the pattern and merged by the
``tokenizers`` library's BPE model once per worker; whole Arrow batches are then put
together in numpy. Texts with runs of white space are split by the pattern whole. Offsets come from the byte table: a token's bytes
are known, so byte offsets are running sums, and a byte belongs to the character whose
first byte is the last at or before it. Tokens may begin or end inside a character.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import PieceTable, batches, binary_column, kept, texts_of, with_columns

VOCABULARY = "byte_bpe_50k.json"


def byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable Latin-1 characters stand for themselves; the other bytes, in order, are the
    characters from 256 on.
    """
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def byte_table(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(all tokens' bytes joined, first byte, number of bytes) by id."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    to_byte = byte_of_character()
    tokens: dict[int, bytes] = {i: bytes(to_byte[c] for c in t) for t, i in spec["model"]["vocab"].items()}
    for t in spec["added_tokens"]:
        tokens[t["id"]] = t["content"].encode("utf-8")
    joined = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
    size = np.array([len(t) for t in joined], np.int64)
    return np.frombuffer(b"".join(joined), np.uint8), np.cumsum(size) - size, size


@lru_cache(maxsize=1)
def _byte_characters() -> dict[int, str]:
    return {b: c for c, b in byte_of_character().items()}


def merger(path: str):
    """A function from a piece of text (one match of the pattern) to its ids, by the library's BPE model."""
    model = Tokenizer.from_file(path).model
    tokenize, to_character = model.tokenize, _byte_characters()
    seen: dict[str, tuple[int, ...]] = {}
    blank = to_character[ord(" ")]

    def merge(piece: str) -> tuple[int, ...]:
        ids = seen.get(piece)
        if ids is None:
            if len(seen) >= 100_000:
                seen.clear()
            word = piece[1:] if piece[0] == " " else piece
            if word.isascii() and word.isalnum():  # stands for itself
                mapped = word if word is piece else blank + word
            else:
                mapped = piece.encode("utf-8").decode("latin-1").translate(to_character)
            ids = seen[piece] = tuple([t.id for t in tokenize(mapped)])
        return ids

    return merge


_RUN = regex.compile(r"[\s\x1c-\x1f]{2}").search


def units(text: str, split) -> list:
    """Parts of a text that can be encoded one by one: bytes stand for a word after a blank, strings for themselves."""
    if not text:
        return []
    if _RUN(text):
        return split(text)
    first, *rest = text.encode("utf-8").split(b" ")
    return [first.decode("utf-8"), *rest]


def _tokenizer(path: str) -> PieceTable:
    merge, split = merger(path), regex.compile(public_tokenizers.PATTERN).findall

    def encode(parts: list) -> list[list[int]]:
        out = []
        for u in parts:
            pieces = split(" " + u.decode("utf-8") if isinstance(u, bytes) else u)
            out.append(merge(pieces[0]) if len(pieces) == 1 else [i for p in pieces for i in merge(p)])
        return out

    return PieceTable(encode, 600_000)


def token_offsets(texts: list[str], ids: np.ndarray, sizes: np.ndarray, path: str) -> dict[str, np.ndarray]:
    """Per token its text's byte span and the span of characters it touches, and whether it cuts a character."""
    n = byte_table(path)[2][ids]
    doc = np.repeat(np.arange(len(sizes)), sizes)
    end = np.cumsum(n)
    data = np.frombuffer("".join(texts).encode("utf-8"), np.uint8)
    first = (data & 0xC0) != 0x80  # a character's first byte
    number = np.cumsum(first) - 1  # the character that a byte belongs to
    opens = np.append(first, True)
    doc_bytes = np.bincount(doc, n, len(sizes)).astype(np.int64)
    doc_start = np.cumsum(doc_bytes) - doc_bytes
    chars = np.array([len(t) for t in texts], np.int64)
    char_start = np.cumsum(chars) - chars
    begin = end - n
    return {
        "byte_start": begin - doc_start[doc],
        "byte_end": end - doc_start[doc],
        "char_start": (number[begin] if len(begin) else begin) - char_start[doc],
        "char_end": (number[end - 1] + 1 if len(end) else end) - char_start[doc],
        "cuts": ~opens[begin] | ~opens[end],
    }


def encode(docs: DataFrame, text: str = "text", offsets: bool = True, path: str | None = None) -> DataFrame:
    """``docs`` without ``text``, plus ``ids`` and ``n_tokens``; with ``offsets`` also the spans.

    ``ids`` is binary: little-endian unsigned 32-bit integers. ``byte_start``, ``byte_end``,
    ``char_start`` and ``char_end`` are binary in the same form, one number per token (a token
    that cuts a character spans it whole in characters); ``n_cut`` counts tokens that begin
    or end inside a character. Null and empty texts have no tokens. Input columns with these
    names are replaced. One row in, one row out, no shuffle; whole texts are read.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    spans = ["byte_start", "byte_end", "char_start", "char_end"] if offsets else []
    new = {"ids": "binary", "n_tokens": "long"} | {s: "binary" for s in spans} | ({"n_cut": "long"} if offsets else {})
    keep = [c for c in docs.columns if c not in (text, *new)]
    src = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).alias("\x01text"))
    schema = src.drop("\x01text")
    for c, t in new.items():
        schema = schema.withColumn(c, F.lit(None).cast(t))
    schema = schema.schema
    split = regex.compile(public_tokenizers.PATTERN).findall

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = kept("byte_bpe", path, lambda: _tokenizer(path))
        for b in batches(it, "\x01text", 1 << 20):
            texts = [t or "" for t in texts_of(b, "\x01text")]
            ids, sizes = table.ids([units(t, split) for t in texts])
            cols = {"ids": binary_column(ids, sizes), "n_tokens": pa.array(sizes)}
            if offsets:
                o = token_offsets(texts, ids, sizes, path)
                cols |= {s: binary_column(o[s].astype(np.uint32), sizes) for s in spans}
                doc = np.repeat(np.arange(len(sizes)), sizes)
                cols["n_cut"] = pa.array(np.bincount(doc[o["cuts"]], minlength=len(sizes)))
            kinds = {"binary": pa.binary(), "long": pa.int64()}
            arrow = pa.schema([b.schema.field(c) for c in keep] + [pa.field(c, kinds[t]) for c, t in new.items()])
            yield with_columns(b, arrow, **cols)

    return src.mapInArrow(run, schema)


def decode(tokens: DataFrame, ids: str = "ids", out: str = "decoded", path: str | None = None) -> DataFrame:
    """``tokens`` without ``ids``, plus the decoded bytes in ``out``.

    Bytes rather than text: a run of tokens may begin or end inside a character
    (``decode_text`` shows those as U+FFFD). Null ids decode to no bytes; unknown ids raise.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    keep = [c for c in tokens.columns if c not in (ids, out)]
    src = tokens.select(*[F.col(f"`{c}`") for c in keep], F.col(ids).alias("\x01ids"))
    schema = src.drop("\x01ids").withColumn(out, F.lit(None).cast("binary")).schema

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, "\x01ids", 1 << 20):
            rows = [r or b"" for r in b.column(b.schema.get_field_index("\x01ids")).to_pylist()]
            data, sizes = decode_ids(np.frombuffer(b"".join(rows), "<u4"), np.array([len(r) // 4 for r in rows], np.int64), path)
            arrow = pa.schema([b.schema.field(c) for c in keep] + [pa.field(out, pa.binary())])
            yield with_columns(b, arrow, **{out: binary_column(data, sizes)})

    return src.mapInArrow(run, schema)


def _digests(data: np.ndarray, sizes: np.ndarray) -> list[str]:
    """SHA-256 of consecutive runs of an array's elements, as lowercase hex."""
    raw, ends = memoryview(np.ascontiguousarray(data)).cast("B"), np.cumsum(sizes) * data.itemsize
    return [hashlib.sha256(raw[i:j]).hexdigest() for i, j in zip(ends - sizes * data.itemsize, ends)]


def round_trip(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """``docs`` without ``text``, plus digests of what :func:`encode` and then :func:`decode` give, in one pass.

    ``n_tokens``, ``n_cut``, ``ids_sha256`` (of the ids as little-endian unsigned 32-bit integers) and
    ``decoded_sha256`` (of the decoded bytes). The ids themselves stay in the task. Odd rows and clashing
    names are treated as by ``encode``.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    new = {"n_tokens": "long", "n_cut": "long", "ids_sha256": "string", "decoded_sha256": "string"}
    keep = [c for c in docs.columns if c not in (text, *new)]
    src = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).alias("\x01text"))
    schema = src.drop("\x01text").withColumns({c: F.lit(None).cast(t) for c, t in new.items()}).schema
    split = regex.compile(public_tokenizers.PATTERN).findall

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = kept("byte_bpe", path, lambda: _tokenizer(path))
        for b in batches(it, "\x01text", 1 << 20):
            texts = [t or "" for t in texts_of(b, "\x01text")]
            ids, sizes = table.ids([units(t, split) for t in texts])
            cuts = token_offsets(texts, ids, sizes, path)["cuts"]
            doc = np.repeat(np.arange(len(sizes)), sizes)
            data, n_bytes = decode_ids(ids, sizes, path)
            cols = {
                "n_tokens": pa.array(sizes),
                "n_cut": pa.array(np.bincount(doc[cuts], minlength=len(sizes))),
                "ids_sha256": _digests(ids.astype("<u4"), sizes),
                "decoded_sha256": _digests(data, n_bytes),
            }
            kinds = {"string": pa.string(), "long": pa.int64()}
            arrow = pa.schema([b.schema.field(c) for c in keep] + [pa.field(c, kinds[t]) for c, t in new.items()])
            yield with_columns(b, arrow, **cols)

    return src.mapInArrow(run, schema)


def decode_ids(ids: np.ndarray, sizes: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, bytes per document) of ids laid end to end."""
    flat, start, size = byte_table(path)
    n = size[ids]
    end = np.cumsum(n)
    data = flat[np.repeat(start[ids] - (end - n), n) + np.arange(int(end[-1]) if len(end) else 0)]
    bound = np.concatenate([[0], end])[np.cumsum(np.concatenate([[0], sizes]))]
    return data, np.diff(bound)


def decode_text(data: bytes) -> str:
    return data.decode("utf-8", errors="replace")
