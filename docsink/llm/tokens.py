"""Tokens of the public word-piece vocabulary: counts by distinct pre-token, and ids.

A text is lower-cased and cut into pre-tokens (letters, single digits, runs of other signs); the pieces of a
pre-token do not depend on what stands around it. So each distinct pre-token of a Python worker goes through the
tokenizer once, and documents only join their pre-token frequencies to that table. Texts of printable Latin-1
are cut by an expression of this module; others by the tokenizer's own normaliser and a wider expression, between the special
tokens that they hold, so the pre-tokens of any script are counted once. Each character is tried on the tokenizer's own pre-tokenizer
first; a text with one that it takes for another kind is cut by that.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, table, texts_of, utf8

VOCABULARY = "word_bpe_49k.json"
#: A document of more tokens is over the limit.
LIMIT = 2048
#: Pre-tokens that a Python worker remembers, about 150 bytes each; beyond it begins anew (the counts are the same).
REMEMBERED = 150_000
#: Bytes of text whose pre-tokens are counted together.
BLOCK_BYTES = 1 << 20

PLAIN = re.compile(r"[\t\n\r\x20-\x7E\xA1-\xFF]*")
PRE_TOKEN = re.compile(r"[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|'(?:[stmd]|re|ve|ll)|[0-9\xb2\xb3\xb9\xbc-\xbe]|[^\t\n\r\x20a-z0-9\xaa\xb2\xb3\xb5\xb9\xba\xbc-\xbe\xdf-\xf6\xf8-\xff]+")

ANY_PRE_TOKEN = regex.compile(r"'(?:[stmd]|re|ve|ll)|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def pre_tokens(text: str) -> list[str] | None:
    """The pre-tokens in order, or None where the tokenizer itself is to cut the text."""
    return PRE_TOKEN.findall(text.lower()) if PLAIN.fullmatch(text) and "<|" not in text else None


class Pieces:
    """The distinct pre-tokens that a task has met: how many pieces each has, or with `ids` their ids as packed bytes."""

    def __init__(self, path: str, ids: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.ids = Tokenizer.from_file(path), ids
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)  # the last piece of a pre-token says so
        self.ends[[k for piece, k in vocabulary.items() if piece.endswith("</w>")]] = True
        self.special = {t.content: k for k, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.at_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.trusted: dict[str, bool] = {chr(c): True for c in range(32, 127)}
        self.forget()

    def forget(self) -> None:
        self.known = {x: np.array([k], "<u4").tobytes() if self.ids else 1 for x, k in self.special.items()}

    def cut(self, text: str) -> list[str]:
        """The text's pre-tokens and special tokens, in order."""
        plain = pre_tokens(text)
        if plain is not None:
            return plain
        out = []
        for part in self.at_special.split(text) if self.at_special else [text]:
            if part in self.special:
                out.append(part)
            elif part:
                part = self.tokenizer.normalizer.normalize_str(part)
                if all([self.trusted[c] if c in self.trusted else self.trust(c) for c in set(part)]):
                    out += ANY_PRE_TOKEN.findall(part)
                else:
                    out += [part[i:j] for _, (i, j) in self.tokenizer.pre_tokenizer.pre_tokenize_str(part)]
        return out

    def trust(self, c: str) -> bool:
        """Whether the tokenizer takes a character for the same kind as ANY_PRE_TOKEN does: their tables of characters may be of different years."""
        probe = f"!{c}{c}"
        made = [probe[i:j] for _, (i, j) in self.tokenizer.pre_tokenizer.pre_tokenize_str(probe)]
        return self.trusted.setdefault(c, made == ANY_PRE_TOKEN.findall(probe))

    def encoded(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def learn(self, wanted: set[str]) -> None:
        """The new ones go through the tokenizer as one text, which is cut at the ends of pre-tokens."""
        new = list(wanted.difference(self.known))
        if len(self.known) + len(new) > REMEMBERED:
            self.forget()
            new = list(wanted.difference(self.known))
        ids = self.encoded(" ".join(new))
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(new):  # some are told apart from their neighbours by more than a space
            several = [self.encoded(x) for x in new]
            ids, stops = np.concatenate([np.zeros(0, "<u4"), *several]), np.cumsum([len(x) for x in several])
        if self.ids:
            own, stops = ids.tobytes(), [0, *(4 * stops).tolist()]
            self.known.update(zip(new, [own[i:j] for i, j in zip(stops, stops[1:])], strict=True))
        else:
            self.known.update(zip(new, np.diff(stops, prepend=0).tolist(), strict=True))


@lru_cache(maxsize=2)
def pieces_of_worker(path: str, ids: bool = False) -> Pieces:
    """One for a Python worker, whose later tasks know what its earlier ones met."""
    return Pieces(path, ids)


def _text_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str], np.ndarray]]:
    for batch in batches:
        at = utf8(batch.column("text"))[1]
        for i, j in blocks(at, BLOCK_BYTES):
            yield batch.column("doc_id").slice(i, j - i), batch.column("text").slice(i, j - i).to_pylist(), np.diff(at[i : j + 1])


def _counter(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of_worker(path)
        for ids, texts, sizes in _text_blocks(batches):
            frequencies = [Counter(pieces.cut(t)) for t in texts]
            pieces.learn(set().union(*frequencies))
            known = pieces.known
            totals = [sum([n * known[x] for x, n in f.items()]) for f in frequencies]
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes), pa.array(totals, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    return count


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit.

    A null or empty text has no tokens; repeated rows, and rows without a doc_id, each have a row; no rows give none; other columns stay out.
    """
    counted = texts_of(docs).mapInArrow(_counter(path or vocabulary_path()), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def ids_of(texts: list[str], pieces: Pieces) -> list[bytes]:
    """Each text's ids as little-endian unsigned 32-bit numbers, by pieces with `ids`."""
    cut = [pieces.cut(t) for t in texts]
    pieces.learn(set().union(*cut))
    of = pieces.known.__getitem__
    return [b"".join(map(of, c)) for c in cut]


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
