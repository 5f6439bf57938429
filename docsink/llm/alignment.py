"""Alignment of two tokenizers over the same bytes, by lockstep vectorised merging.

All documents of a lot advance together: one state vector holds for each of them the pointers to its current A and B
token. A step links every document's two tokens, marks a cut where both end at one byte, and moves the pointer of
whichever token ends first (or both); finished documents are dropped from the vector. A document of more than LANE
tokens takes several lanes of the vector, each beginning at one of its A tokens, so that a lot takes about as many steps
as a lane has links, however long its texts are.

Both tokenizers part a text before a space that follows a character which is not white space, whatever stands around;
so texts are cut there into units, and each distinct unit of a Python worker goes through the tokenizers once.

How often a pair of ids is linked in the whole corpus is summed from lots, each of which holds a pair once; the sums go
back to the lots that hold the pair, where the documents of a lot look them up. So no links are exchanged, and
a pair that is everywhere is one row for each lot.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import blocks, table, texts_of, utf8, written
from .tokens import vocabulary_path

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: A tokens of a lane.
LANE = 512
#: Bytes of text in a lot, about; a longer text is a lot of its own.
LOT_BYTES = 1 << 21
#: Units that a Python worker remembers; beyond it begins anew (the results are the same).
REMEMBERED = 300_000
#: Before spaces that follow a character which is white space to no tokenizer, unless they end the text.
CUT = re.compile(r"(?<=[^\s\u180e])(?= +[^ ])")
SPACE = "▁"


def byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 itself, the others in order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Encoders:
    """Tokenizers A (byte-level, a .json) and B (sentencepiece, a .model), the bytes of their tokens, and units met so far."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        self.forget()
        self.a.encode_special_tokens = True
        of = byte_level()
        vocabulary = self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for piece, k in vocabulary.items():
            self.bytes_a[k] = bytes(of[c] for c in piece) if all(c in of for c in piece) else piece.encode()
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("a piece of this vocabulary goes over the begin of a word")
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace(SPACE, " ").encode() for k, p in enumerate(pieces)]
        self.long_a, self.long_b = (np.array([len(x) for x in t]) for t in (self.bytes_a, self.bytes_b))
        self.digits = np.array([str(k) for k in range(max(len(self.bytes_a), len(self.bytes_b)))], "S")

    def learn(self, wanted: set[str]) -> None:
        """Numbers the new units and keeps both tokenizers' ids of them; `like` says whether their tokens' bytes are their own."""
        new = list(wanted.difference(self.known))
        if len(self.known) + len(new) > REMEMBERED:
            self.forget()
            new = list(wanted)
        # Units that end in white space may not stand before another one, so they come last, each by itself.
        apart = [u for u in new if u[-1].isspace()]
        new = [u for u in new if not u[-1].isspace()] + apart
        long = np.fromiter(map(len, map(str.encode, new)), np.int64, len(new))
        made = self.a.encode_batch_fast(["".join(new[: len(new) - len(apart)]), *apart], add_special_tokens=False)
        ids_a = np.fromiter(chain.from_iterable(e.ids for e in made), np.int64)
        stops = np.searchsorted(np.cumsum(self.long_a[ids_a]), np.cumsum(long)) + 1
        pieces = self.b.encode([u[1:] for u in new], num_threads=1)  # which adds the space
        ids_b = np.fromiter(chain.from_iterable(pieces), np.int64)
        text = "".join(new).encode()
        if b"".join(map(self.bytes_a.__getitem__, ids_a.tolist())) != text:
            raise ValueError("the tokens of vocabulary A are not the bytes of the text")
        long_b = np.fromiter(map(len, pieces), np.int64, len(new))
        like = np.ones(len(new), bool)
        if b"".join(map(self.bytes_b.__getitem__, ids_b.tolist())) != text:
            like[:] = [b"".join(map(self.bytes_b.__getitem__, p)) == u.encode() for u, p in zip(new, pieces, strict=True)]
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        self.like = np.append(self.like, like)
        self.units = [(np.append(ids, i), np.append(at, at[-1] + np.cumsum(n))) for (ids, at), i, n in zip(self.units, (ids_a, ids_b), (np.diff(stops, prepend=0), long_b), strict=True)]

    def forget(self) -> None:
        self.known, self.like = {}, np.zeros(0, bool)
        self.units = [(np.zeros(0, np.int64), np.zeros(1, np.int64))] * 2

    def encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All texts' A ids and each text's first, and so for B; a text without tokens has none of either."""
        units = [CUT.split(" " + t) if t else [] for t in texts]
        self.learn(set(chain.from_iterable(units)))
        at = np.append(0, np.cumsum(list(map(len, units)))).astype(np.int64)
        found = np.fromiter(map(self.known.__getitem__, chain.from_iterable(units)), np.int64, at[-1])
        unlike = np.append(0, np.cumsum(~self.like[found]))[at]
        shown = np.repeat(unlike[1:] == unlike[:-1], np.diff(at))
        out = []
        for ids, of in self.units:
            n = np.where(shown, of[found + 1] - of[found], 0)
            ends = np.cumsum(n)
            out += [ids[np.repeat(of[found] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)], np.append(0, ends)[at]]
        return tuple(out)


@lru_cache(maxsize=1)
def encoders_of_worker(path_a: str, path_b: str) -> Encoders:
    return Encoders(path_a, path_b)


def lockstep(end_a: np.ndarray, first_a: np.ndarray, end_b: np.ndarray, lane: int = LANE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links (A token, B token) in order, and whether each is a cut.

    end_a, end_b: where the tokens end, the documents laid end to end; first_a: each document's first A token, and their number.
    """
    lanes = -(-np.diff(first_a) // lane)
    begin = np.repeat(first_a[:-1], lanes) + lane * (np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes))
    stop = np.minimum(begin + lane, np.repeat(first_a[1:], lanes))
    opening = np.searchsorted(end_b, np.append(0, end_a)[begin], "right")
    closing = np.searchsorted(end_b, end_a[stop - 1], "left")
    room = (stop - begin) + (closing - opening)
    links_a, links_b, cuts = np.full(room.sum(), -1), np.empty(room.sum(), np.int64), np.zeros(room.sum(), bool)
    state = np.stack([begin, opening, np.cumsum(room) - room, stop])
    while state.shape[1]:
        a, b, place, last = state
        links_a[place], links_b[place] = a, b
        over_a, over_b = end_a[a], end_b[b]
        cuts[place] = over_a == over_b
        a += over_a <= over_b
        b += over_b <= over_a
        place += 1
        going = a < last
        if not going.all():
            state = state[:, going]
    made = links_a >= 0
    return links_a[made], links_b[made], cuts[made]


def spelled(digits: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`a,a|b;a|b,b;` of all groups as bytes, and where each token's begins (one entry more). cut_*: the last token of each group."""
    last_a, last_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
    last_a[cut_a], last_b[cut_b] = True, True
    place_a = np.arange(len(ids_a)) + np.append(0, cut_b + 1)[np.cumsum(last_a) - last_a]
    place_b = np.arange(len(ids_b)) + (cut_a + 1)[np.cumsum(last_b) - last_b]
    wide = digits.dtype.itemsize
    rows = digits.view(np.uint8).reshape(-1, wide)
    out = np.empty((len(ids_a) + len(ids_b), wide + 1), np.uint8)
    out[place_a, :wide], out[place_b, :wide] = rows[ids_a], rows[ids_b]
    out[place_a, wide] = np.where(last_a, ord("|"), ord(","))
    out[place_b, wide] = np.where(last_b, ord(";"), ord(","))
    used = out != 0
    return out[used], np.append(0, np.cumsum(used.sum(axis=1)))


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
_LOTS = "lot long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, codes binary, times binary, lot_codes binary, lot_times binary"


def _packed(values: np.ndarray, at: np.ndarray) -> pa.Array:
    """Runs of values, as little-endian bytes."""
    own = np.ascontiguousarray(values)
    ends = pa.array(at * own.itemsize, pa.int64())
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, ends.buffers()[1], pa.py_buffer(own)]).cast(pa.binary())


def _aligner(path_a: str, path_b: str, code_type: str):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders, lots = encoders_of_worker(path_a, path_b), 0
        size_b = len(encoders.bytes_b)
        for batch in batches:
            sizes = utf8(batch.column("text"))[1]
            part = batch.column("part")
            for i, j in blocks(sizes, LOT_BYTES):
                ids_a, first_a, ids_b, first_b = encoders.encoded(batch.column("text").slice(i, j - i).to_pylist())
                links_a, links_b, cuts = lockstep(np.cumsum(encoders.long_a[ids_a]), first_a, np.cumsum(encoders.long_b[ids_b]))
                cut_a, cut_b = links_a[cuts], links_b[cuts]
                text, at = spelled(encoders.digits, ids_a, ids_b, cut_a, cut_b)
                at = at[first_a + first_b].tolist()
                digests = [hashlib.sha256(text[x : y - 1]).hexdigest() if x < y else "" for x, y in zip(at, at[1:])]
                link_at = np.searchsorted(links_a, first_a)
                n_links = np.diff(link_at)

                # Each document's distinct pairs, then the lot's.
                size = len(encoders.bytes_a) * size_b
                keys, times = np.unique(np.repeat(np.arange(j - i), n_links) * size + ids_a[links_a] * size_b + ids_b[links_b], return_counts=True)
                codes, code_at = keys % size, np.searchsorted(keys, np.arange(j - i + 1) * size)
                lot_codes, own = np.unique(codes, return_inverse=True)
                lot_times = np.bincount(own, times, len(lot_codes)).astype("<u4")
                lot = (part[0].as_py() << 32) + lots
                lots += 1
                n, none = j - i, pa.nulls(j - i, pa.binary())
                columns = [pa.array(np.full(n, lot)), batch.column("doc_id").slice(i, n), *map(pa.array, (np.diff(first_a), np.diff(first_b), np.diff(np.searchsorted(cut_a, first_a)), n_links)), pa.array(digests, pa.string())]
                yield pa.RecordBatch.from_arrays([*columns, _packed(codes.astype(code_type), code_at), _packed(times.astype("<u4"), code_at), none, none], schema=SCHEMA)
                if len(lot_codes):
                    yield pa.RecordBatch.from_arrays([pa.array([lot]), *(pa.nulls(1, t) for t in SCHEMA.types[1:9]), pa.array([lot_codes.astype(code_type).tobytes()]), pa.array([lot_times.tobytes()])], schema=SCHEMA)

    return align


SCHEMA = pa.schema([(c.split()[0], {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[c.split()[1]]) for c in _LOTS.split(", ")])


def _unpacker(code_type: str):
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lot, codes, times in zip(*(batch.column(c).to_pylist() for c in ("lot", "lot_codes", "lot_times")), strict=True):
                codes = np.frombuffer(codes, code_type).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(codes), lot)), pa.array(codes), pa.array(np.frombuffer(times, "<u4").astype(np.int64))], names=["lot", "code", "n"])

    return unpack


def _scorer(code_type: str):
    def score(docs: pa.Table, pairs: pa.Table) -> pa.Table:
        """The documents of a lot, with what the corpus-wide counts of its pairs say of their links."""
        known = pairs.column("code").to_numpy()
        order = np.argsort(known)
        known, totals, best = known[order], pairs.column("total").to_numpy()[order], pairs.column("best").to_numpy()[order]
        n_best, count_sum = [], []
        for codes, times in zip(docs.column("codes"), docs.column("times"), strict=True):
            k = np.searchsorted(known, np.frombuffer(codes.as_buffer(), code_type))
            n = np.frombuffer(times.as_buffer(), "<u4").astype(np.int64)
            n_best.append(int(n[best[k]].sum()))
            count_sum.append(int((n * totals[k]).sum()))
        own = {c: docs.column(c) for c in COLUMNS if c in docs.column_names}
        own |= {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}
        return pa.table([own[c] for c in COLUMNS], names=COLUMNS)

    return score


def align_tokenizers(spark: SparkSession, docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Per document doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256; and the pairs of the corpus: id_a, id_b, total, best.

    A null or empty text, and one whose tokens' bytes are not a space and the text (such as one with U+2581), has no
    tokens: all numbers are 0 and the digest is ''. Rows that repeat a doc_id, or have none, each have a row; no rows give none; other
    columns stay out.
    """
    path_a, path_b = path_a or vocabulary_path(VOCABULARY_A), path_b or vocabulary_path(VOCABULARY_B)
    own = encoders_of_worker(path_a, path_b)
    size_b = len(own.bytes_b)
    code_type = "<u4" if len(own.bytes_a) * size_b <= 1 << 32 else "<u8"
    texts = texts_of(docs).withColumn("part", F.spark_partition_id())
    lots = written(spark, texts.mapInArrow(_aligner(path_a, path_b, code_type), _LOTS), "aligned")

    of_lots = lots.where("lot_codes is not null").select("lot", "lot_codes", "lot_times").mapInArrow(_unpacker(code_type), "lot long, code long, n long")
    totals = of_lots.groupBy("code").agg(F.sum("n").alias("total"))
    # A B id is linked with no more A ids than there are.
    most = F.max("total").over(Window.partitionBy(F.col("code") % size_b))
    pairs = written(spark, totals.select("code", "total", (F.col("total") == most).alias("best")), "pairs")

    held = of_lots.select("lot", "code").join(pairs, "code").groupBy("lot")
    schema = ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'long'}" for c in COLUMNS)
    scored = lots.where("codes is not null").groupBy("lot").cogroup(held).applyInArrow(_scorer(code_type), schema)
    return scored, pairs.select(F.floor(F.col("code") / size_b).alias("id_a"), (F.col("code") % size_b).alias("id_b"), "total", "best")


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(spark, table(spark, sf_dir, "documents"))[0]
