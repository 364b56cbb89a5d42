"""Token counts of texts (operator 1).

An Arrow function encodes batches and returns lengths only. Texts are cut at boundaries that the tokenizer's own
pattern never crosses, equal pieces are encoded once, and pieces reach the encoder in batches of equal bytes.
"""

from __future__ import annotations

import os
import re
import sys
from collections import ChainMap
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BATCH_BYTES = 1 << 20
# Memory of the pieces whose lengths a task remembers, as Python holds them; beyond it forgets them and starts anew.
MEMORY_BYTES = 96 << 20
# Longer pieces hardly come again and are not remembered.
LONGEST_KNOWN = 64
# What an entry of the memory takes beside its text.
ENTRY_BYTES = 100
MAX_TOKENS = 512

# A piece is white space and what follows. The pattern of the tokenizer takes at most one blank in front of a word and
# never a character after it, so a cut between a printing character and white space changes no token.
_PIECE = re.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
# White space of one of the two libraries that is not in the set above; such texts are cut at plain ASCII places only.
_ODD = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_PLAIN_CUT = re.compile(r"(?<=[!-~])(?= )")
# No token of the pattern holds a letter and, behind it, a sign, so writing without blanks is cut there as well. Only letters
# and signs that are such in every version of Unicode; < | > belong to special strings.
_SIGN_CUT = re.compile(
    "(?<=[A-Za-z\u0400-\u04ff\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3])"
    "(?=[!-/:;=?@\u3001\u3002\u300c\u300d\uff01\uff08\uff09\uff0c\uff1a\uff1b\uff1f])"
)


def safe_pieces(text: str) -> list[str]:
    """Pieces of a text whose token counts add up to that of the whole text."""
    pieces = _PLAIN_CUT.split(text) if _ODD.search(text) else _PIECE.findall(text)
    if max(map(len, pieces), default=0) <= LONGEST_KNOWN:
        return pieces
    return [part for piece in pieces for part in (_SIGN_CUT.split(piece) if len(piece) > LONGEST_KNOWN else (piece,))]


def n_bytes(text: str) -> int:
    """Length in UTF-8."""
    return len(text) if text.isascii() else len(text.encode())


def _byte_batches(pieces: list[str], limit: int) -> Iterator[list[str]]:
    """Runs of pieces of about ``limit`` bytes; short ones also count for what the encoder keeps of each."""
    batch, size = [], 0
    for piece in pieces:
        batch.append(piece)
        size += n_bytes(piece) + 32
        if size >= limit:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


def token_lengths(tokenizer_json: str, batch_bytes: int = BATCH_BYTES, memory: int = MEMORY_BYTES):
    """The Arrow function from texts to numbers of tokens, for the tokenizer file at a path or with its JSON."""

    def lengths(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(tokenizer_json)
        known: dict[str, int] = {}
        held = 0

        def encode(pieces: list[str]) -> dict[str, int]:
            found: dict[str, int] = {}
            for batch in _byte_batches(pieces, batch_bytes):
                found.update(zip(batch, map(len, tokenizer.encode_batch_fast(batch, add_special_tokens=False))))
            return found

        for texts in batches:
            out, first = [], 0
            sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_pylist()
            while first < len(texts):
                cut, size = [], 0
                while first < len(texts) and size < batch_bytes:
                    cut.append(safe_pieces(texts[first].as_py() or ""))
                    size += sizes[first]
                    first += 1
                new = list(set().union(*cut).difference(known))
                short = [piece for piece in new if len(piece) <= LONGEST_KNOWN]
                size = sum(map(sys.getsizeof, short)) + ENTRY_BYTES * len(short)
                if held + size > memory:
                    known.clear()
                    held = 0
                    new = list(set().union(*cut))
                    short = [piece for piece in new if len(piece) <= LONGEST_KNOWN]
                    size = sum(map(sys.getsizeof, short)) + ENTRY_BYTES * len(short)
                held += size
                known |= encode(short)
                own = known
                if len(short) < len(new):
                    own = ChainMap(encode([piece for piece in new if len(piece) > LONGEST_KNOWN]), known)
                out += [sum(map(own.__getitem__, pieces)) for pieces in cut]
            yield pa.array(out, pa.int64())

    return lengths


def n_tokens(text: Column, tokenizer_path: str, batch_bytes: int = BATCH_BYTES) -> Column:
    """Number of tokens of a text column, without begin, end or added tokens; null counts as empty.

    The driver reads the file once; its text travels with the function, so executors need no copy of it.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        run = token_lengths(file.read(), batch_bytes)
    return F.arrow_udf(run, "long")(text.cast("string"))


def count_tokens(
    docs: DataFrame, tokenizer_path: str, text_col: str = "text", max_tokens: int = MAX_TOKENS, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """Every row and column of ``docs`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` behind them.

    Null texts count as empty: 0 bytes, 0 tokens. Columns of these names that were there before are replaced. There
    is no shuffle; a task holds one batch of texts, by bytes, and a memory of short pieces bounded in bytes. A text of one
    piece longer than a batch, such as letters alone without a blank or sign, is encoded at once.
    """
    counted = docs.withColumns(
        {
            "n_bytes": F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long"),
            "n_tokens": n_tokens(F.col(text_col), tokenizer_path, batch_bytes),
        }
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > max_tokens)
