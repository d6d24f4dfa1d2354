"""Token counts: batches balanced by bytes, long texts split at safe boundaries, lengths only.

Texts go to the tokenizer in batches of about ``BATCH_BYTES``. A text longer than ``PIECE_BYTES`` is cut
before a single space that follows an ordinary character. No vocabulary piece has a word mark after an
ordinary character (checked when the model is loaded; otherwise nothing is cut), so no token crosses such a
cut, and the mark that the tokenizer puts before each part stands for the space at the cut. The counts of
the parts therefore add up to the count of the whole text. Only lengths leave the function.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows each get their row; an empty
table gives an empty result; a text without spaces is encoded whole.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from lakestrata.llm._common import by_bytes, id_and_text, public_id, table

BATCH_BYTES = 1 << 20
PIECE_BYTES = 1 << 14
MARK = "▁"

_SCHEMA = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def tokenizer_path(name: str) -> str:
    """The place of a public vocabulary file on this machine (executors resolve it for themselves)."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def _piece_model(name: str):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(name))
    cuttable = not any(MARK in model.id_to_piece(i).lstrip(MARK) for i in range(model.get_piece_size()))
    return model, cuttable


@lru_cache(maxsize=2)
def _json_tokenizer(name: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path(name))
    t.no_truncation()
    t.no_padding()
    return t


def safe_parts(text: str, size: int = PIECE_BYTES) -> list[str]:
    """Cut a long text before single spaces; joining the parts with one space gives the text back."""
    if len(text) <= size:
        return [text]
    parts, begin = [], 0
    while len(text) - begin > size:
        at = text.find(" ", begin + size)
        while at > 0 and (text[at - 1] in (" ", MARK) or at + 1 >= len(text)):
            at = text.find(" ", at + 1)
        if at < 0:
            break
        parts.append(text[begin:at])
        begin = at + 1
    parts.append(text[begin:])
    return parts


def _lengths(texts: list[str], name: str) -> list[int]:
    """Token counts of a list of texts, encoded in batches balanced by bytes."""
    if not name.endswith(".model"):
        t = _json_tokenizer(name)
        out: list[int] = []
        for b, e in by_bytes([len(x) for x in texts], BATCH_BYTES):
            out += [len(x.ids) for x in t.encode_batch(texts[b:e], add_special_tokens=False)]
        return out
    model, cuttable = _piece_model(name)
    parts, owner = [], []
    for i, text in enumerate(texts):
        for part in safe_parts(text) if cuttable else [text]:
            parts.append(part)
            owner.append(i)
    counts = [0] * len(texts)
    for b, e in by_bytes([len(x) for x in parts], BATCH_BYTES):
        for i, ids in zip(owner[b:e], model.encode(parts[b:e], num_threads=1)):
            counts[i] += len(ids)
    return counts


def token_counts(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_bytes`` (UTF-8) and ``n_tokens`` of every text under a public tokenizer file."""

    def count(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            sizes = [len(t) if t.isascii() else len(t.encode()) for t in texts]
            for b, e in by_bytes(sizes, 8 * BATCH_BYTES):
                yield table(_SCHEMA, batch.column("id")[b:e], sizes[b:e], _lengths(texts[b:e], model))

    out = id_and_text(docs, id_col, text_col).mapInArrow(count, "id long, n_bytes long, n_tokens long")
    return out.select(public_id().alias(id_col), "n_bytes", "n_tokens")
